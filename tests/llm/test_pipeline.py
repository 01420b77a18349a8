"""The pipeline against plain versions of its stages, each on the input it had."""

from collections import Counter

import corpus_pipeline
from ledgerfold.llm import langid
from ledgerfold.llm.common import Workspace

from . import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, hard, hard_rows):
    ws, docs, held = Workspace(spark, "t"), hard, {}
    for name, stage in corpus_pipeline.STAGES:
        held[name] = (docs, ws.put(stage(spark, docs, SF), name))
        docs = held[name][1]
    rows = {n: ([tuple(r) for r in a.collect()], [tuple(r) for r in b.collect()]) for n, (a, b) in held.items()}
    for name in list(rows)[:-1]:
        assert held[name][1].columns == hard.columns

    before, after = rows["language"]
    lang, _, rate, size = langid.learn(hard).model().predict([r[1] or "" for r in before])
    assert Counter(after) == Counter(r for r, g, p, n in zip(before, lang, rate, size) if g != "und" and (n < corpus_pipeline.LEAST_SYMBOLS or p <= corpus_pipeline.MOST_PHRASES))
    assert len(after) > 60

    before, after = rows["line_dedup"]
    gone = brute.template_lines([(r[0], r[1]) for r in before])
    cut = lambda r: "\n".join(x for i, x in enumerate(r[1].split("\n")) if (r[0], i) not in gone)
    assert Counter(after) == Counter((r[0], cut(r), *r[2:4], len(cut(r)), *r[5:]) for r in before)

    before, after = rows["near_duplicates"]
    group = brute.near([(r[0], r[1]) for r in before], 5)
    assert Counter(after) == Counter(r for r in before if r[0] is None or group[r[0]] == r[0])

    before, after = rows["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = brute.leaks([(r[0], r[1]) for r in before], items)
    assert Counter(after) == Counter(r for r, h in zip(before, hit) if not h[4])

    before, after = rows["mix"]
    assert sorted(str(r[0]) for r in before) == sorted(str(r[0]) for r in after)


def test_rows_are_judged_by_themselves(spark, hard, hard_rows):
    """Rows that share a doc_id, or have none, and rows whose columns are named as a stage's own."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    prose = next(r[1] for r in hard_rows if r[2] == "en" and r[1] and len(r[1]) > 400 and "@" not in r[1])
    rows = [(7000, prose, "en"), (7000, "qx0zj vkq9w jzxv qqzk wvxj kzqj xxvk zqwj vvkx jqzx", "en"), (None, prose + " " + item, "en"), (None, prose, "en")]
    docs = spark.createDataFrame([(*r, "s", 0.5, "u", b"t") for r in rows], "doc_id long, text string, lang string, source string, score double, lang_pred string, text_id binary")
    both = docs.unionByName(hard, allowMissingColumns=True).cache()
    kept = corpus_pipeline.language(spark, both, SF)
    assert kept.columns == both.columns and [(r["text"], r["score"], r["lang_pred"]) for r in kept.where("doc_id = 7000").collect()] == [(prose, 0.5, "u")]
    kept = corpus_pipeline.decontamination(spark, docs, SF)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted((r[0] or 0, r[1]) for r in rows if item not in r[1])


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() <= 200 and "taken" in out.columns


def test_empty(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
