"""Clues anywhere in a document that holds an entity."""

import hashlib

import pytest

from ledgerfold.llm import pii

from . import brute


def told(rows):
    return {(r["id"], r["text"][t["start"] : t["end"]].lower()): round(float(t["value"]), 9) for r in rows for t in r["terms"]}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_clues_of_real_rows(spark, sf):
    """All terms found in all documents, against a plain version of the estimate."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0"))
    found = pii.find(docs).join(docs.selectExpr("text", "md5(coalesce(text, '')) AS id").distinct(), "id").collect()
    want = brute.clues([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    clear = {}
    for t, terms in want.items():
        spans = [tuple(map(int, s.split(":")[1:])) for s in brute.personal(t)]
        for x, share in terms.items():
            if any(m.group().lower() == x and not any(a < m.end() and m.start() < b for a, b in spans) for m in brute.regex.finditer(r"\p{L}{3,}", t)):
                clear[hashlib.md5(t.encode()).hexdigest(), x] = round(share, 9)
    assert told(found) == clear and (clear or sf == "sf0.001")


def test_clues_to_groups_and_kinds(spark):
    """A term that stands with a mail domain, whoever's address it is, and one that stands with cards of all kinds."""
    plain = "plain words of no weight at all"
    rows = [(i, f"{plain} {'abcdefgh'[i] * 4} helpdesk {chr(97 + i)}@corp.example.com") for i in range(6)]
    rows += [(20 + i, f"{plain} payable {n}") for i, n in enumerate(("4111 1111 1111 1111", "5500005555555559", "340000000000009", "6011000000000004", "3530111333300000"))]
    rows += [(100 + i, f"{plain} {i}") for i in range(300)]
    rows += [(500, f"{plain} payable"), (501, "one coincidence z@corp.example.com")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: sorted({dict(rows)[r["doc_id"]][t["start"] : t["end"]] for t in r["terms"]}) for r in pii.find(docs).collect()}
    assert all(found[i] == ["helpdesk"] for i in range(6)) and found[501] == [] and found[500] == []
    want = brute.clues(rows)
    assert all(found[d] == sorted(set(want[t]) - {"corp", "example", "com"}) for d, t in rows)  # these are in addresses


def test_clues_far_from_the_entity(spark):
    far = "plain words of no weight " * 20
    rows = [(i, f"Zorblatt {i} {far}mail j.doe@ex.org {far}zorblatt signs") for i in range(3)] + [(10 + i, f"{far}mail signs {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["terms"] for r in pii.find(docs).collect()}
    text = rows[1][1]
    assert [text[t["start"] : t["end"]] for t in found[1]] == ["Zorblatt", "zorblatt"] and {t["value"] for t in found[1]} == {"1.0"}
    assert not any(found[d] for d, _ in rows[3:])
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "zorblatt" not in clean[1].lower() and "signs" in clean[1] and clean[15] == rows[8][1]
