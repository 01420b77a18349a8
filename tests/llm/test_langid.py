"""Languages of many letters."""

import math
import random
import zlib

from ledgerfold.llm import langid

from . import brute


def words(rng, letters, n):
    """Prose of n words, of which each language has its own."""
    known = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 3))) for _ in range(300)]
    return lambda: " ".join(rng.choice(known) for _ in range(n))


def test_no_learned_letter_is_thrown_away():
    rng = random.Random(9)
    prose = {"en": words(rng, "abcdefghijklmnop", 60), "ja": words(rng, [chr(0x4E00 + i) for i in range(0, 1500, 2)], 60), "zh": words(rng, [chr(0x4E00 + i) for i in range(1, 1500, 2)], 60)}
    samples = {lang: [p() for _ in range(n)] for (lang, p), n in zip(prose.items(), (60, 5, 20))}
    model = langid.Model(samples)
    assert model.letters > 600
    texts = [(lang, p()) for lang, p in prose.items() for _ in range(20)]
    lang, _, rate, _ = model.predict([t for _, t in texts])
    assert lang == [g for g, _ in texts] and max(r for r, (g, _) in zip(rate, texts) if g != "ja") < 0.6


def test_parse_of_many_letters_is_exact():
    rng = random.Random(4)
    letters = [chr(0x4E00 + i) for i in range(150)] + list("abc ")
    samples = {g: ["".join(rng.choice(letters[k : k + 120]) for _ in range(900))] for g, k in (("x", 0), ("y", 34))}
    model = langid.Model(samples)
    cuts = [(g, rng.randrange(850)) for g in "xyxyxyxy"]
    texts = ["".join(samples[g][0][i : i + 12] + rng.choice(letters) + "\u9f00" for g, i in rng.sample(cuts, 4)) for _ in range(30)] + [""]
    sym, at, _ = langid.symbols(texts, model.alphabet)
    got = model.phrases(sym, at)
    for k, lang in enumerate(model.langs):
        learned = "".join(map(chr, langid.symbols(samples[lang], model.alphabet)[0].astype(int) + 65))
        for i in range(len(texts)):
            own = "".join(map(chr, sym[at[i] : at[i + 1]].astype(int) + 65))
            assert got[i, k] == (brute.cross_parse(own, learned) if own else 0)


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def plain_prediction(text, samples):
    """(language, score) by parsing each block with each language's sample, symbol by symbol."""
    letters = {c for t in samples.values() for x in t for c in x.lower() if c.isalpha()}

    def symbols_of(t):
        out = []
        for c in t.lower():
            s = (c if c in letters else "\0") if c.isalpha() else " "
            if s != " " or not out or out[-1] != " ":
                out.append(s)
        return "".join(out)

    costs = {}
    for lang in sorted(samples):
        own = "".join(symbols_of(x) for x in samples[lang])[: min(langid.SAMPLE_SYMBOLS, langid.ALL_SYMBOLS // len(samples) + 1)]
        sym = symbols_of(text)
        blocks = [sym[i : i + langid.BLOCK] for i in range(0, len(sym), langid.BLOCK)]
        costs[lang] = sum(brute.cross_parse(b, own) for b in blocks) * math.log2(len(own) + 1.0)
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    best, second = sorted(costs.values())[:2]
    return min(costs, key=lambda g: (costs[g], g)), max(0.0, 1 - best / second)


def test_whole_predictions(spark, hard, hard_rows):
    samples = langid.learn(hard)
    found = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in langid.annotated(hard.select("doc_id", "text"), samples).collect()}
    short = [r for r in hard_rows if len(r[1] or "") < 1500 and "\x00" not in (r[1] or "")]
    assert len(short) > 50
    for r in short:
        lang, score = found[r[0], r[1]]
        want = plain_prediction(r[1] or "", samples.texts)
        assert lang == want[0] and abs(score - want[1]) < 1e-9, r[0]


def test_predictions_come_from_texts_only(spark, hard, hard_rows):
    """Neither what is held out, nor the language, source or id of a row, has a part in a prediction."""
    schema = "doc_id long, text string, lang string, source string"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    rows = [r[:4] for r in hard_rows]
    assert sum(held(r[0]) for r in rows) > 10
    before = langid.learn(frame(rows))
    changed = [(d, "zzz qqq" if held(d) else t, "xx" if held(d) else lang, "elsewhere") for d, t, lang, _ in rows]
    after = langid.learn(frame(changed))
    assert before.texts == after.texts and "xx" not in after.texts
    predicted = lambda table, samples: sorted((r["text"] or "", r["lang_pred"], r["score"]) for r in langid.annotated(table, samples).collect())
    moved = [(None if i % 3 else d, t, None, "moved") for i, (d, t, _, _) in enumerate(rows)]
    assert predicted(frame(rows), before) == predicted(frame(moved), before)
    flags = {r["doc_id"]: r["held_out"] for r in frame(rows).select("doc_id", langid.held_out().alias("held_out")).collect()}
    assert all(flags[d] == held(d) for d in flags)
