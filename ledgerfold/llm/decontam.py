"""Operator 7: benchmark decontamination with a distributed positional inverted index.

Index: the training text is cut into segments of a few MB of whole documents.  A segment is one stored row: its terms,
sorted, with the sorted list of word positions of each, and where its documents begin.  Written once, the index answers
any number of test sets.  A term that stands everywhere is as many short lists as there are segments, so no list is hot
and no two segments ever exchange rows.

Search: one pass over the stored terms counts how often the corpus has each test term.  Then each segment takes the
windows whose terms it all has, shifts the list of the window's rarest term by the term's offset, and intersects it
with the lists of the others, from the rarest on, for all windows at once.  What is left are exact phrase matches; with
slop > 0 the other terms may stand up to so many words from their place (proximity matches).

The test set is a stated query set: it is cut into blocks of at most block_terms terms, each sent to all segments.

Words are lower-cased (A-Z only) runs of ASCII letters, digits and non-ASCII characters.  A window is n consecutive
words of an item; an item of fewer words, but not none, is one window.  Terms are 64-bit hashes of words.  Null and
empty texts have no words and are clean; items without words never match; an item without an id has the id "";
repeated rows each get their result; equal item ids count once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, fields, ship
from .kernels import NOT_ALNUM, U, Words, pieces, spans_of

#: Terms of the windows in one block of the test set; 16 bytes each are sent.
BLOCK_TERMS = 4_000_000
#: Starts looked at together.
AT_ONCE = 1 << 20
#: Bytes of stored segments in a row group, so that readers hold few of them.
GROUP_BYTES = 16 << 20

POSTINGS = "terms binary, sizes binary, positions binary"
MATCHES = "n_words long, hit_starts array<int>, hit_ends array<int>, items array<string>, text_id binary"


def segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each piece of text: the documents with their word counts and digests, and the postings."""
    for part, texts in pieces(batches):
        words = Words(texts, NOT_ALNUM, lower=True)
        h = words.hashes()
        positions = np.argsort(h, kind="stable")
        terms, sizes = np.unique(h, return_counts=True)
        ids = part.column(0)
        one = lambda kind, values: pa.array([values], pa.list_(kind))
        yield pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                one(pa.int64(), np.diff(words.doc_at)),
                one(pa.binary(), [hashlib.md5(t).digest() for t in texts]),
                *(pa.array([x.tobytes()], pa.binary()) for x in (terms, sizes.astype("<i4"), positions.astype("<i4"))),
            ],
            names=["docs", "n_words", "text_ids", "terms", "sizes", "positions"],
        )


def build(docs: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """The stored index of docs (doc_id, text): a row a segment."""
    ship(docs.sparkSession)
    ws = ws or Workspace(docs.sparkSession, "positions")
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = fields(docs, "doc_id", "text").mapInArrow(segment_batches, f"docs array<{key}>, n_words array<long>, text_ids array<binary>, {POSTINGS}")
    return ws.put(rows, "segments", **{"parquet.block.size": GROUP_BYTES})


class Owners:
    """The items of each window: lists one after another."""

    def __init__(self, window: np.ndarray, item: np.ndarray, n: int):
        pairs = np.unique(np.stack([window, item], axis=1), axis=0)
        self.items, self.first = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(n + 1))

    def __getitem__(self, window: int) -> np.ndarray:
        return self.items[self.first[window] : self.first[window + 1]]


class Phrases:
    """The distinct windows of a block of items, as rows of term numbers, by their length."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        w = Words([t for _, t in items], NOT_ALNUM, lower=True)
        h, size = w.hashes(), np.diff(w.doc_at)
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        own = np.array([number[name] for name, _ in items], np.int64)
        self.terms, self.by_length = np.unique(h), {}
        for m in np.unique(np.minimum(size[size > 0], n)).tolist():
            start = np.arange(len(h) - m + 1)
            start = start[(w.doc[start] == w.doc[start + m - 1]) & ((size[w.doc[start]] == m) | (m == n))]
            rows = np.ascontiguousarray(h[start[:, None] + np.arange(m)])
            _, one, which = np.unique(rows.view(f"V{8 * m}").ravel(), return_index=True, return_inverse=True)
            terms = np.searchsorted(self.terms, rows[one])
            self.by_length[m] = (terms, np.tile(np.arange(m), (len(one), 1)), Owners(which.ravel(), own[w.doc[start]], len(one)))

    def ordered(self, often: np.ndarray) -> Phrases:
        """With each window's terms, and the offsets they stand at, from the corpus's rarest on."""
        for m, (terms, offsets, owners) in self.by_length.items():
            by = np.argsort(often[terms], axis=1, kind="stable")
            self.by_length[m] = (np.take_along_axis(terms, by, 1), np.take_along_axis(offsets, by, 1), owners)
        return self


class Segment:
    """A stored segment as a search sees it; place[t] is the number here of test term t, or the number of terms."""

    def __init__(self, row: dict, phrases: Phrases):
        terms, self.size = np.frombuffer(row["terms"], U), np.append(np.frombuffer(row["sizes"], "<i4").astype(np.int64), 0)
        self.positions = np.frombuffer(row["positions"], "<i4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        at = np.minimum(np.searchsorted(phrases.terms, terms), max(len(phrases.terms) - 1, 0))
        known = np.flatnonzero(phrases.terms[at] == terms) if len(terms) and len(phrases.terms) else np.zeros(0, np.int64)
        self.place = np.full(len(phrases.terms), len(terms), np.int64)
        self.place[at[known]] = known
        # lists one after another are one sorted list of (term, position)
        self.listed = (np.repeat(np.arange(len(terms)), self.size[:-1]) << 32) | self.positions
        self.doc_at = np.concatenate([[0], np.cumsum(row["n_words"])]).astype(np.int64)

    def next_of(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The first listed position of each term that is not before the one given, or a far one."""
        i = np.searchsorted(self.listed, (term << 32) | np.maximum(position, 0))
        ok = i < self.first[term + 1]
        return np.where(ok, self.positions[np.minimum(i, len(self.positions) - 1)], 1 << 40)

    def starts(self, terms: np.ndarray, offsets: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(windows, starts of their matches); terms and offsets from the rarest on."""
        m, alive = terms.shape[1], np.arange(len(terms))
        for k in range(m):
            alive = alive[self.size[self.place[terms[alive, k]]] > 0]
        many = np.cumsum(self.size[self.place[terms[alive, 0]]])
        cuts = np.searchsorted(many, np.arange(AT_ONCE, int(many[-1]) if len(many) else 0, AT_ONCE))
        for group in np.split(alive, np.unique(cuts)):
            place = self.place[terms[group]]
            n = self.size[place[:, 0]] if len(group) else np.zeros(0, np.int64)
            w = np.repeat(np.arange(len(group)), n)
            if not len(w):
                continue
            at = self.positions[np.repeat(self.first[place[:, 0]] - (np.cumsum(n) - n), n) + np.arange(len(w))] - offsets[group[w], 0]
            ok = (at >= 0) & (at + m <= self.doc_at[-1])
            w, at = w[ok], at[ok]
            ok = np.searchsorted(self.doc_at, at, side="right") == np.searchsorted(self.doc_at, at + m - 1, side="right")
            w, at = w[ok], at[ok]
            for k in range(1, m):
                if not len(w):
                    break
                want = at + offsets[group[w], k]
                ok = self.next_of(place[w, k], want - slop) <= want + slop
                w, at = w[ok], at[ok]
            if len(w):
                yield group[w], at


def count_batches(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """(term number, count) over all segments of a task."""
    known, total = sent.value.terms, np.zeros(len(sent.value.terms), np.int64)
    for batch in batches:
        for terms, sizes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            t = np.frombuffer(terms, U)
            at = np.minimum(np.searchsorted(known, t), len(known) - 1)
            ok = known[at] == t
            total[at[ok]] += np.frombuffer(sizes, "<i4")[ok]
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["term", "n"])


def counted(index: DataFrame, phrases: Phrases) -> np.ndarray:
    """How often the corpus has each term of a block of the test set."""
    sent = index.sparkSession.sparkContext.broadcast(phrases)
    rows = index.select("terms", "sizes").mapInArrow(lambda it: count_batches(it, sent), "term long, n long")
    table = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a number for each term of the block
    sent.destroy()
    often = np.zeros(len(phrases.terms), np.int64)
    often[table.column("term").to_numpy()] = table.column("n").to_numpy()
    return often


def match_batches(batches: Iterator[pa.RecordBatch], blocks: list, slop: int) -> Iterator[pa.RecordBatch]:
    """blocks: broadcasts of Phrases; beyond one, a worker keeps just the one in use."""
    for batch in batches:
        for i in range(len(batch)):
            one = batch.slice(i, 1)
            row = {n: one.column(k)[0].as_py() for k, n in enumerate(one.schema.names) if n != "docs"}
            doc_at = np.concatenate([[0], np.cumsum(row["n_words"])]).astype(np.int64)
            hit = np.zeros(doc_at[-1] + 1, np.int32)
            items: list[set[str]] = [set() for _ in row["n_words"]]
            for sent in blocks if doc_at[-1] else ():
                phrases = sent.value
                segment = Segment(row, phrases)
                for m, (terms, offsets, owners) in phrases.by_length.items():
                    for w, at in segment.starts(terms, offsets, slop):
                        np.add.at(hit, at, 1)
                        np.add.at(hit, at + m, -1)
                        doc = np.searchsorted(doc_at, at, side="right") - 1
                        for d, x in np.unique(np.stack([doc, w], 1), axis=0).tolist():
                            items[d].update(phrases.names[k] for k in owners[x])
                if len(blocks) > 1:
                    sent.unpersist_local()
            covered = np.cumsum(hit)[:-1] > 0
            spans = [spans_of(covered[a:b]) if own else ([], []) for a, b, own in zip(doc_at[:-1], doc_at[1:], items)]
            yield pa.RecordBatch.from_arrays(
                [
                    one.column(0).flatten(),
                    pa.array(row["n_words"], pa.int64()),
                    *(pa.array([list(s[k]) for s in spans], pa.list_(pa.int32())) for k in (0, 1)),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    pa.array(row["text_ids"], pa.binary()),
                ],
                names=["doc_id", "n_words", "hit_starts", "hit_ends", "items", "text_id"],
            )


def blocks_of(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items, in blocks of bounded size; the driver holds one block at a time."""
    block, terms = [], 0
    for r in fields(benchmark, "item_id", "text").where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("i"), "text").toLocalIterator():
        text = (r["text"] or "").encode()
        if block and terms + len(text) > limit:
            yield block
            block, terms = [], 0
        block.append((r["i"] if r["i"] is not None else "", text))
        terms += len(text)
    if block:
        yield block


class Sent:
    """A broadcast whose copy in a Python worker can be let go."""

    def __init__(self, inner):
        self.inner = inner

    @property
    def value(self) -> Phrases:
        return self.inner.value

    def unpersist_local(self) -> None:
        self.inner.__dict__.pop("_value", None)


def search(index: DataFrame, benchmark: DataFrame, n: int = 10, slop: int = 0, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Per document of the index: doc_id, n_words, the maximal runs of hit words, the items with matches, sorted as
    strings, and text_id, the MD5 of its text."""
    sc, sent = index.sparkSession.sparkContext, []
    for p in (Phrases(b, n) for b in blocks_of(benchmark, block_terms)):
        if len(p.terms):
            sent.append(Sent(sc.broadcast(p.ordered(counted(index, p)))))
    kind = f"doc_id {index.schema['docs'].dataType.elementType.simpleString()}, {MATCHES}"
    return index.mapInArrow(lambda batches: match_batches(batches, sent, slop), kind)


def matches(docs: DataFrame, benchmark: DataFrame, n: int = 10, slop: int = 0, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """search() over an index of docs made for it."""
    return search(build(docs), benchmark, n, slop, block_terms)


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs, bench = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return report(matches(docs, bench))


def report(found: DataFrame) -> DataFrame:
    """One row per document from search()."""
    size = F.aggregate(F.arrays_zip("hit_starts", "hit_ends"), F.lit(0).cast("long"), lambda a, x: a + (x["hit_ends"] - x["hit_starts"]))
    return found.select("doc_id", "n_words", size.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"))
