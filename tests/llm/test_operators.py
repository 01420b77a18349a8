"""Each operator over hard rows against its plain version, and over an empty table."""

import json
import os
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from dataclasses import replace
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerfold.llm import ann, decontam, langid, lines, minhash, mixing, passages, pii, registry, substrings, suffixes, tokens
from ledgerfold.llm.common import Workspace
from ledgerfold.llm.components import components
from ledgerfold.llm.gsaca import suffix_array
from ledgerfold.llm.kernels import BLANK, Words

from . import brute

SF = "/root/testdata/sf0.001"


def by_id(df, *names):
    out = defaultdict(set)
    for r in df.collect():
        out[r["doc_id"]].add(tuple(r[n] for n in names))
    return out


# ---- 1: mixing ----


def water(sizes, cycle=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % 3] for i, s in enumerate(names)}
    full, target = set(), dict.fromkeys(names, 0.0)
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        target |= {s: rest * weight[s] / total for s in names if s not in full} if total else {}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else target[s] for s in names}
        full |= over


def test_mix(spark, hard, hard_rows, nothing):
    rows = mixing.mix(hard).collect()
    assert len(rows) == len(hard_rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in hard_rows:
        sizes[r[3]] += size(r[1])
    want, taken = water(sizes), Counter()
    most = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= 2 * most[s] for s in want)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(hard.repartition(5)).collect()))
    assert mixing.mix(nothing).count() == 0
    only = hard.where("text is null").limit(1)
    assert mixing.mix(only).first()["taken"] == 0


def test_mix_counts_the_words_of_a_long_text_in_little_memory():
    """24 MB of one-letter words in an executor of 640 MB: a list of them doesn't fit."""
    code = """
from pyspark.sql import SparkSession
from ledgerfold.llm import mixing
spark = SparkSession.builder.master("local[1]").config("spark.driver.memory", "640m").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
docs = spark.range(1).selectExpr("'d' AS doc_id", "'s' AS source", "repeat('a ', 12000000) AS text")
print("words", mixing.mix(docs).first()["size"])
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=300)
    assert "words 12000000" in run.stdout, run.stderr[-2000:]


def test_words_are_counted_as_the_pattern_finds_them(spark):
    rng, signs = random.Random(5), " \t\n\x0b\x0c\r  ab$\\\\é😀\x85\x1c\x00\xa0\u2028"
    texts = [None, "", " ", "\n\n", " a", "a ", "x" * 100_000, " " * 100_000, *("".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(2000))]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", mixing.words(F.col("text")).alias("n")).collect()
    assert all(r["n"] == (None if r["text"] is None else len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))) for r in rows)


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    ours, theirs = registry.queries()[name](spark, SF).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    key = lambda t: sorted(map(tuple, t[sorted(t.columns)].astype(object).values.tolist()))
    assert key(ours) == key(theirs)


# ---- 2: language ----


def test_cross_parsing_counts():
    rng = random.Random(3)
    samples = {"x": ["".join(rng.choice("abc ") for _ in range(300))], "y": ["".join(rng.choice("bcd") for _ in range(300))]}
    model = langid.Model(samples)
    texts = ["".join(rng.choice("abcd é") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    sym, at, _ = langid.symbols(texts, model.alphabet)
    got = model.phrases(sym, at)
    for i in range(len(texts)):
        own = "".join(chr(65 + s) for s in sym[at[i] : at[i + 1]])
        for k, lang in enumerate(model.langs):
            learned, _, _ = langid.symbols(samples[lang], model.alphabet)
            want = brute.cross_parse(own, "".join(chr(65 + s) for s in learned)) if own else 0
            assert got[i, k] == want, (own, lang)


def test_language(spark, hard, hard_rows, nothing):
    rows = langid.identify(hard, langid.learn(hard)).collect()
    assert len(rows) == len(hard_rows)
    texts = Counter((r[0], r[1]) for r in hard_rows)
    for r in rows:
        letters = any(any(c.isalpha() for c in t or "") for (d, t) in texts if d == r["doc_id"])
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.identify(docs, langid.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out())
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count() > 0
    assert langid.identify(nothing, langid.learn(nothing)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(hard, langid.Samples({})).collect()} == {"und"}


# ---- 3: tokens ----


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder()


def test_tokens(spark, hard, hard_rows, nothing, tmp_path, encoder):
    coded = encoder.encode([r[1] or "" for r in hard_rows])
    want = Counter((r[0], len(c)) for r, c in zip(hard_rows, coded))
    assert encoder.width == 2
    assert Counter(map(tuple, tokens.document_tokens(hard, encoder, file=5000, block=1000).collect())) == want
    assert tokens.document_tokens(nothing, encoder).count() == 0
    for n, flat in enumerate(([t for c in coded for t in (*c, 50256)], [1, 2, 3], [50256, 50256, 5], [])):
        np.array(flat, "<u2").tofile(tmp_path / f"{n}.bin")
    blocks = tokens.read_token_files(spark, f"file://{tmp_path}/*.bin", size=97)
    rows = tokens.count_tokens(blocks).orderBy("stream", "nth").collect()
    assert [r["n_tokens"] for r in rows] == [*map(len, coded), 3, 0, 0, 1]
    assert [r["ended"] for r in rows] == [True] * len(coded) + [False, True, True, False]


def test_a_token_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "TASK", 1000)
    rng = np.random.default_rng(3)
    flat = rng.integers(0, 200_000, 50_000).astype("<u4")
    flat[rng.integers(0, len(flat), 40)] = 199_999
    flat.tofile(tmp_path / "one.bin")
    blocks = tokens.read_token_files(spark, f"file://{tmp_path}/one.bin", width=4, size=250)
    assert blocks.rdd.getNumPartitions() == 50 and blocks.select(F.spark_partition_id()).distinct().count() > 20
    cuts = np.flatnonzero(flat == 199_999)
    rows = tokens.count_tokens(blocks, 199_999, 4).orderBy("nth").collect()
    assert [r["n_tokens"] for r in rows] == [*(np.diff(np.concatenate([[-1], cuts])) - 1).tolist(), len(flat) - cuts[-1] - 1]
    whole = spark.read.format("binaryFile").load(f"file://{tmp_path}/one.bin").select("path", "content").mapInArrow(lambda it: tokens.whole_batches(it, 333, 4), "stream string, block long, tokens binary")
    assert [r["n_tokens"] for r in tokens.count_tokens(whole, 199_999, 4).orderBy("nth").collect()] == [r["n_tokens"] for r in rows]


def test_long_blanks_make_the_same_tokens(spark, encoder):
    rng = random.Random(8)
    encoder.encode([""])
    for _ in range(60):
        text = "".join(rng.choice(("ab's ", "x1", "\u3000", "!", "'", " ", "\x1c", "\u00e9 ")) + rng.choice((" ", "\n", " \n", "\t ", "\u2003")) * rng.choice((0, 1, 3, 1023, 1024, 1500, 2100)) for _ in range(rng.randint(1, 6)))
        assert encoder.encode([text])[0] == encoder.inner.encode_ordinary(text)
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "a" + "\n" * 1_000_000 + "b"), (3, "!" * 1_000_000), (4, "\u2003" * 300_000 + "x")], "doc_id long, text string")
    found = dict(map(tuple, tokens.document_tokens(docs, encoder).collect()))
    assert found[1] == 1_000_000 and found[2] == 1 + len(encoder.inner._encode_single_piece("\n" * 999_999)) + 2 and set(found) == {1, 2, 3, 4}


# ---- 4, 8: passages ----


def test_suffix_arrays():
    rng = random.Random(5)
    for _ in range(500):
        x = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_arrays_of_anything(x):
    x = [*x, 0]
    assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def test_repeated_bytes(spark, hard, pairs, hard_rows, nothing):
    out = suffixes.repeated_bytes(hard)
    assert out.count() == len(hard_rows)
    want = brute.cut_bytes(pairs)
    found = by_id(out, "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found.pop(None) == {(len(pairs_text(pairs, None)), 0, 0, brute.sha(pairs_text(pairs, None).encode()))}
    assert found == {d: {w} for d, w in want.items()}
    assert suffixes.repeated_bytes(nothing).count() == 0


def pairs_text(pairs, d):
    return next(t for i, t in pairs if i == d)


def test_repeated_words(spark, hard, pairs, hard_rows, nothing):
    out = substrings.FingerprintIndex(spark, buckets=4).add(hard, keep=False)
    assert out.count() == len(hard_rows)
    found = by_id(out, "n_words", "n_removed", "kept_sha256")
    assert found.pop(None)
    assert found == {d: {w} for d, w in brute.cut_words(pairs).items()}
    assert substrings.FingerprintIndex(spark).add(nothing, keep=False).count() == 0


def test_batches_make_no_difference(spark, hard, pairs, monkeypatch):
    monkeypatch.setattr(substrings, "FANOUT", 2)
    index, found = substrings.FingerprintIndex(spark, buckets=4), {}
    for a, b in ((0, 30), (30, 1012), (1012, 1030), (1030, 2000)):
        found |= by_id(index.add(hard.where((F.col("doc_id") >= a) & (F.col("doc_id") < b))), "n_words", "n_removed", "kept_sha256")
    assert len(index.runs) <= 2
    assert found == {d: {w} for d, w in brute.cut_words(pairs).items()}


def test_the_query_goes_through_history(spark, hard, pairs, hard_rows, nothing, monkeypatch):
    compacted = []
    monkeypatch.setattr(substrings.FingerprintIndex, "compact", lambda self, f=substrings.FingerprintIndex.compact: compacted.append(len(self.runs)) or f(self))
    out = substrings.deduplicated(hard, n=4)
    assert compacted == [2, 2] and out.count() == len(hard_rows)
    found = by_id(out, "n_words", "n_removed", "kept_sha256")
    assert found.pop(None) and found == {d: {w} for d, w in brute.cut_words(pairs).items()}
    assert substrings.deduplicated(nothing).count() == 0


def phrase_in_many_places(n, words):
    """Texts that share a phrase in surroundings of their own, and at last two that repeat the surroundings too."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))
    phrase = " ".join(word() for _ in range(words))
    texts = [" ".join([*(word() for _ in range(20)), phrase, *(word() for _ in range(20))]) for _ in range(n)]
    return [(i, t) for i, t in enumerate([*texts, texts[7] + " more", "less " + texts[n // 2][30:]])]


def test_a_phrase_in_many_places(spark):
    """Its anchor is asked about for each place; beyond `hot` places no group holds all of them."""
    rows = phrase_in_many_places(400, 11)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few, buckets = replace(suffixes.SCHEME, hot=50), passages.buckets_for(docs)
    assert by_id(substrings.deduplicated(docs, scheme=replace(substrings.SCHEME, hot=50)), "n_words", "n_removed", "kept_sha256") == {d: {w} for d, w in brute.cut_words(rows).items()}
    want = {d: {w} for d, w in brute.cut_bytes(rows).items()}
    most = {}
    for scheme in (few, suffixes.SCHEME):
        assert by_id(suffixes.repeated_bytes(docs, scheme), "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
        table = passages.gather(docs, passages.settle(docs, scheme, buckets), Workspace(spark, "t"), [])
        groups = passages.ask(table, scheme, buckets, suffixes.pack_sides).groupBy("hot", "bucket").agg(F.sum("n").alias("n"))
        most[scheme.hot] = max(r["n"] / (few.reach if r["hot"] else 1) for r in groups.collect())
    assert most[50] < 100 and most[suffixes.SCHEME.hot] >= 400


def test_stretches_make_no_difference(monkeypatch):
    """The anchors of a long text, and of many texts, whether looked at together or in stretches."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 5)))
    texts = [" ".join(word() for _ in range(n)).encode() for n in (3000, 0, 5, 40, 700, 12, 13, 14)]
    for scheme in (suffixes.SCHEME, substrings.SCHEME):
        found = []
        for stretch in (4 << 20, 1000, 101):
            monkeypatch.setattr(passages, "STRETCH", stretch)
            found.append([x.tolist() for x in passages.Text(texts, scheme).anchors()])
        assert found[0] == found[1] == found[2] and len(found[0][0]) > 50
        at = np.arange(200)
        h = passages.Text(texts, scheme)
        assert all((a == b).all() for a, b in zip(h.passages(at), (passages.gram_hashes(h.units(slice(None), s), scheme.length)[at] for s in (1, 2))))


def test_covered_runs():
    rng = random.Random(13)
    for _ in range(200):
        n, scheme = rng.randint(0, 60), passages.Scheme("byte", 7, 3, True)
        hits = [rng.randint(0, max(0, n - 3)) for _ in range(rng.randint(0, 6))]
        pairs = [(x, x + rng.randint(1, 9)) for x in (rng.randint(0, 60) for _ in range(rng.randint(0, 3)))]
        flags = [False] * n
        starts = {s for p in hits for s in range(max(0, p - 4), min(p, n - 7) + 1)} | {s for a, b in pairs for s in range(a, min(b, n - 6))}
        for s in starts:
            flags[s : s + 7] = [True] * 7
        a, b = passages.covered(n, scheme, [np.array([p * 4 for p in hits], np.int64).tobytes()], [np.array(pairs, np.int32).tobytes()])
        assert list(zip(a.tolist(), b.tolist())) == brute.runs(flags)


# ---- 5: neighbours ----


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    v = {i: rng.normal(size=16).tolist() for i in range(400)}
    for i in range(100, 130):  # one very common vector
        v[i] = v[100]
    v |= {500: None, 501: [0.0] * 16, 502: [float("nan")] * 16, 503: [None] * 16, 504: [float("inf")] * 16, 505: [], 506: [1.0, 2.0], 600: [3.0, 1.0], 700: [1.0]}
    df = spark.createDataFrame([*v.items(), (None, v[1])], "vec_id long, embedding array<float>").repartition(3).withColumn("pivots", F.lit(1))
    rows = ann.search(df, df.where("vec_id % 100 = 0")).collect()
    good = {i: np.array(np.array(x, np.float32), float) for i, x in v.items() if x and len(x) == 16 and None not in x and np.isfinite(x).all() and any(x)}
    for q in (0, 100, 200, 300):
        order = sorted((np.sqrt(((good[i] - good[q]) ** 2).sum()), i) for i in good if i != q)[:10]
        own = sorted((r["rank"], r["score"], r["vec_id"]) for r in rows if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, 11))
        assert [i for _, i in order] == [r[2] for r in own] and np.allclose([d for d, _ in order], [r[1] for r in own])
    assert [(r["vec_id"], r["rank"]) for r in rows if r["query_id"] == 600] == [(506, 1)]
    assert not [r for r in rows if r["query_id"] in (500, 700)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    t = vectors.toPandas()
    x, ids = np.stack(t["embedding"].to_numpy()).astype(float), t["vec_id"].to_numpy()
    found = ann.search(vectors, vectors.where("vec_id % 100 = 0")).toPandas()
    hit = 0
    for q, own in found.groupby("query_id"):
        d = ((x - x[ids == q][0]) ** 2).sum(1)
        d[ids == q] = np.inf
        hit += len(set(ids[np.lexsort((ids, d))[:10]]) & set(own["vec_id"]))
    assert hit >= 0.9 * len(found) and len(found) == 200


@pytest.mark.parametrize("table", ["sf0.1", "check_s"])
def test_recall_of_little(spark, table):
    """With shards so large that most rows are never ranked by distance."""
    path = f"/root/testdata/{table}/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("not there")
    vectors = spark.read.parquet(path).repartition(2)
    queries = vectors.where("vec_id % 100 = 0")
    shares = {r: ann.recall(vectors, queries, rerank=r) for r in (0.05, ann.RERANK)}
    assert shares[ann.RERANK] >= 0.9, shares


def test_files_give_the_footrule():
    rng = np.random.default_rng(4)
    pivots = rng.normal(size=(ann.PREFIX * 2, 8))
    orders = ann.permutations(rng.normal(size=(50, 8)), pivots)
    q = ann.permutations(rng.normal(size=(1, 8)), pivots)[0]
    place = lambda o: np.array([list(o).index(p) if p in o else ann.PREFIX for p in range(len(pivots))])
    footrule = np.array([np.abs(place(o) - place(q)).sum() for o in orders])
    assert (footrule == ann.PREFIX * (ann.PREFIX + 1) - 2 * ann.Inverted(orders).nearness(q)).all()


def test_neighbours_of_several_rows_and_lengths(spark):
    """An id on several rows is one query; lengths that the sample of pivots lacks are compared whole."""
    rows = [(i, [float(i), 1.0]) for i in range(1, 40)] + [(100, [0.0, 1.0]), (100, [20.2, 1.0]), (100, [20.2, 1.0]), (200, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, ann.search(df, df.where("vec_id in (100, 200)"), k=4).collect()))
    assert [f[:3] for f in found] == [(100, 1, 20), (100, 2, 21), (100, 3, 1), (100, 4, 19), (200, 1, 7)]


# ---- 6: near duplicates ----


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(spark, hard, pairs, hard_rows, nothing, n):
    out = minhash.near_duplicates(hard, shingle=n)
    assert out.count() == len(hard_rows)
    want = brute.near(pairs, n)
    sizes = defaultdict(set)
    for d, t in pairs:
        sizes[d].add(len(brute.shingles(t, n)))
    for r in out.collect():
        d = r["doc_id"]
        assert r["n_shingles"] in sizes[d]
        assert r["component_id"] == want.get(d) and r["kept"] == (d is None or want[d] == d)
    if n == 2:
        assert minhash.near_duplicates(nothing).count() == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(70)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "t"), "c").collect()}
    top = {x: x for e in links for x in e}
    for _ in top:
        for a, b in links:
            top[a] = top[b] = min(top[a], top[b])
    assert found == {n: c for n, c in top.items() if n != c}


# ---- 7: decontamination ----


def items_of(spark):
    own = [(900, "one two"), (901, "ONE"), (902, "!!"), (903, None), (904, ""), (905, "written by nobody on day 3 of this long year"), (905, "written by nobody on day 3 of this long year")]
    return spark.read.parquet(f"{SF}/benchmark.parquet").limit(40).unionByName(spark.createDataFrame(own, "item_id long, text string"))


@pytest.mark.parametrize("block", [10**9, 2000])
def test_decontamination(spark, hard, hard_rows, pairs, nothing, block):
    items = items_of(spark)
    found = decontam.report(decontam.matches(hard, items, block_terms=block)).collect()
    want = defaultdict(set)
    for (d, _), w in zip(pairs, brute.leaks(pairs, [(r["item_id"], r["text"]) for r in items.collect()])):
        want[d].add(w)
    assert len(found) == len(hard_rows)
    assert {d: w for d, w in want.items()} == {d: {tuple(r)[1:] for r in found if r["doc_id"] == d} for d in want}
    assert decontam.report(decontam.matches(nothing, items)).count() == 0
    assert not decontam.report(decontam.matches(hard, items.limit(0))).where("contaminated").count()


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a x b c x d"), (3, "a x x x b c d")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    hit = lambda slop: {r["doc_id"] for r in decontam.matches(docs, item, slop=slop).where("size(items) > 0").collect()}
    assert hit(0) == {1} and hit(2) == {1, 2} and hit(3) == {1, 2, 3}


# ---- 9: personal data ----


def test_personal_data(spark, hard, hard_rows, nothing):
    found = pii.find(hard)
    rows = found.select("doc_id", "id", F.transform("base", pii.named).alias("base"), F.transform("terms", pii.named).alias("terms")).collect()
    assert len(rows) == len(hard_rows)
    import hashlib

    want = {(r[0], hashlib.md5((r[1] or "").encode()).hexdigest()): brute.personal(r[1]) for r in hard_rows}
    for r in rows:
        assert r["base"] == want[r["doc_id"], r["id"]]
    assert pii.find(nothing).count() == 0


def test_clues_are_found_and_generalised(spark):
    rows = [(i, f"ask zorblatt quickly the boss j.doe@ex.org here {'x' * i}") for i in range(3)] + [(10 + i, f"quickly the boss is here {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["terms"] for r in pii.find(docs).collect()}
    assert [(t["start"], t["end"]) for t in spans[0]] == [(4, 12), (0, 3)][::-1] and not spans[10]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "zorblatt" not in clean[1] and "j.doe" not in clean[1] and "<EMAIL>" in clean[1] and "quickly the boss" in clean[1] and clean[15] == rows[8][1]


# ---- 10: lines ----


def test_lines(spark, hard, hard_rows, pairs, nothing):
    found = {(r["doc_id"], r["nth"]) for r in lines.recurring(hard.select("doc_id", "text")).collect()}
    assert found == brute.template_lines(pairs)
    assert any(d == 1041 for d, _ in found)
    out = lines.drop_lines(hard)
    assert out.columns == [*hard.columns, "n_lines_dropped"] and out.count() == len(hard_rows)
    texts = defaultdict(set)
    for d, t in pairs:
        texts[d].add(None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in found))
    for r in out.collect():
        assert r["text"] in texts[r["doc_id"]] and r["hits"] == "x"
    assert lines.drop_lines(nothing).count() == 0


def test_word_hashes_do_not_depend_on_neighbours():
    long = b"q" * 3_000_000
    a, b = Words([b"x yy", b"", b"yy  z" + long], BLANK), Words([b"yy", long + b" z" + long], BLANK)
    h, k = a.hashes(), b.hashes()
    assert h[1] == h[2] == k[0] and h[3] == k[2] and len(set(h.tolist())) == 3 and a.doc_at.tolist() == [0, 2, 2, 4]


def test_registry_names():
    assert json.dumps(sorted(registry.queries())) and {f"op{i}_" for i in range(1, 11)} == {re.match(r"op\d+_", n)[0] for n in registry.queries() if n != "pipeline"}
