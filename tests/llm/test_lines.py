"""All templates of a leaf, against a plain version."""

import random
import re
from collections import defaultdict

import corpus_pipeline
from ledgerfold.llm import lines


def plain(docs, similar=0.7, min_docs=3, min_chars=20):
    """(doc_id, nth) of the lines to drop; in each leaf templates are formed until no line is left."""
    at, leaves, template, docs_of = [], defaultdict(lambda: defaultdict(set)), {}, defaultdict(set)
    for d, t in docs:
        for i, line in enumerate(t.split("\n")):
            mask = tuple("<*>" if re.search("[0-9]", w) else w for w in re.findall(r"[^\x20\x09-\x0D]+", line))
            if mask and len(line) >= min_chars:
                at.append((d, i, (len(mask), *mask[:3]), mask))
                leaves[at[-1][2]][mask].add(d)
    for leaf, found in leaves.items():
        left = set(found)
        while left:
            seed = min(left, key=lambda x: (-len(found[x]), " ".join(x).encode()))
            took = {x for x in left if sum(a == b for a, b in zip(x, seed)) / len(x) >= similar}
            template |= {(leaf, x): seed for x in took}
            left -= took
    for d, _, leaf, mask in at:
        docs_of[leaf, template[leaf, mask]].add(d)
    return {(d, i) for d, i, leaf, mask in at if len(docs_of[leaf, template[leaf, mask]]) >= min_docs and d != min(docs_of[leaf, template[leaf, mask]])}


def dropped(spark, docs, **options):
    found = lines.recurring(spark.createDataFrame(docs, "doc_id long, text string"), **options)
    return {(r["doc_id"], r["nth"]) for r in found.collect()}


def test_second_family_of_a_leaf(spark):
    names = ("anna", "berta", "carla", "dora")
    docs = [(i, f"this is a page of the old site of {n} and friends\nthis is a note from {n} to all those who wait here") for i, n in enumerate(names)]
    docs += [(10 + i, "this is a page of the old site of emil and friends") for i in range(3)]
    assert dropped(spark, docs) == plain(docs) == {(i, 0) for i in (1, 2, 3, 10, 11, 12)} | {(i, 1) for i in (1, 2, 3)}


def test_templates_until_no_line_is_left(spark, monkeypatch):
    rng = random.Random(5)
    docs = []
    for i in range(400):
        n = rng.choice((5, 7, 10, 13))
        kind = [f"{'stuv'[rng.randrange(4)]}{'abc'[j % 3]}word" for j in range(n)]
        docs.append((i, " ".join(["same", "old", "start"] + [w if rng.random() < 0.8 else rng.choice(("other", "place", "x7")) for w in (kind[:1] * (n - 3))])))
    assert dropped(spark, docs) == plain(docs)
    assert dropped(spark, docs, similar=0.9) == plain(docs, similar=0.9) != plain(docs)
    # leaves too large to be gathered, in rounds
    monkeypatch.setattr(lines.further, "__defaults__", (4,))
    assert dropped(spark, docs) == plain(docs)
    monkeypatch.setattr(lines.further, "__defaults__", (0,))
    assert dropped(spark, docs, similar=0.9) == plain(docs, similar=0.9)


def test_lines_of_variable_fields_and_short_lines(spark):
    docs = [(i, f"2024-01-0{i} 12:33:01 10.0.0.17 200\nread more\n \nown text {'abcd'[i]}") for i in range(4)]
    assert dropped(spark, docs) == plain(docs) == {(i, 0) for i in (1, 2, 3)}
    assert dropped(spark, docs, min_chars=1) == plain(docs, min_chars=1) == {(i, n) for i in (1, 2, 3) for n in (0, 1)}
    kept = corpus_pipeline.line_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {0: docs[0][1]} | {i: f" \nown text {'abcd'[i]}" for i in (1, 2, 3)}
