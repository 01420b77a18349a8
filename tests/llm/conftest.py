import random

import duckdb
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hits string, `key` string, node int, bucket int, spans string, leaf int, term string"
SF = "/root/testdata/sf0.001"


def made(rows):
    return [(d, t, lang, s, len(t or ""), "x", "k", 1, 2, "y", 3, "z") for d, t, lang, s in rows]


@pytest.fixture(scope="session")
def hard_rows():
    """Real rows, and what is hard: nulls, empty and long texts, repeated rows, copies, near copies, chains of them."""
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT 60").fetchall()
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))
    words = [word() for _ in range(400)]
    text = lambda ws: " ".join(ws)
    own = [(None, "no id here, call +1 (444) 555-3382", "en", "a"), (1000, None, "en", None), (1001, "", None, "a"), (1002, " \n\t ", "en", ""), (1003, "12345 !!! 6789", "en", "é")]
    own += [(1010, "a" * 150_000, "en", "a"), (1011, "ab " * 9000, "en", "a"), (1012, "line number 7 of the same old text\n" * 300, "en", None), (1013, "0" * 8000 + "." + "@" * 50 + "x" * 8000, "de", "b")]
    own += [(1020, text(words[:200]), "en", "b"), (1020, text(words[:200]), "en", "b"), (1021, text(words[:200]), "en", "b"), (1022, text(words[:200]).upper(), "en", "b")]
    chain = words[:200]
    for i in range(6):  # each is near the one before it, the last is not near the first
        chain = chain[: 20 * i] + [word() for _ in range(8)] + chain[20 * i + 8 :]
        own.append((1030 + i, text(chain), "en", "c"))
    own += [(1040 + i, f"{word()} Häuser ü {i}\nWritten by Nobody on day {i} of this long year\nmail joe.b%l@ex-ample.co.uk. or 10.0.0.{i * 60} 4111 1111 1111 1111\n" + text(words[250:270]) + "\n" + text([word() for _ in range(30)]), "fr", "d") for i in range(6)]
    own += [(1050, "one two", "en", "d"), (1051, "one two", "en", "d"), (1052, "one", "en", "d"), (1053, "ONE", "en", "d")]
    return made(rows + own)


@pytest.fixture(scope="session")
def hard(spark, hard_rows):
    return spark.createDataFrame(hard_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def pairs(hard_rows):
    return [(r[0], r[1]) for r in hard_rows]
