"""Repeated passages of a fixed length over a whole corpus: what operators 4 and 8 share.

A passage is `length` consecutive units (bytes, or words) of one document.  Of each passage the `gram` units with the
lowest hash (leftmost first) are its anchor; equal passages have equal anchors, so they meet wherever they are, and
about 2 / (length - gram + 2) of all positions are anchors.

1. `postings`: each piece of a few MB of text finds its anchors, with a fingerprint of the anchor and two of its context
   (all units of the passages around it), and writes them as sorted runs, one for each bucket of fingerprints.  What
   repeats a context within the piece is settled there and not sent.
2. `settle`: per bucket the sorted runs are merged.  Where a context has occurred before, all its passages have; equal
   contexts are those with equal fingerprints, 48 bits to meet by and 64 more to verify.  Anchors with several different
   contexts are asked about: their first occurrences are looked at unit by unit.
3. `gather`: settled and asked positions join the text, once; documents without either are done.
4. The operator's own method compares the asked contexts, bucket by bucket; those of anchors with more than `hot` contexts
   are compared passage by passage, each passage dealt out by its own hash (`windows`), so that a phrase that stands in
   any number of surroundings is never one group.
5. `marked`: per document, the passages found become covered units.

Rows between the steps hold packed arrays, a bucket holds a bounded share of the anchors, and a context that very many
documents share is one entry for each piece.  Positions are relative to the document.

Rows without a doc_id take no part.  Rows that share a doc_id are taken as one document told twice: neither repeats the
other, and what is found at a position holds for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace
from .kernels import BLANK, U, Words, constants, pieces, splitmix

#: Text whose anchors share a bucket, and the number of buckets at least.
BUCKET_BYTES = 12 << 20
LEAST_BUCKETS = 48
PIECE = 3 << 20
#: Units looked at together; longer pieces (a single long text) are gone through in overlapping stretches.
STRETCH = 4 << 20
HOT = 1024
#: What is said of a position: its context has occurred before; it is asked about; it is asked about and its anchor hot.
BEFORE, ASKED, ASKED_HOT = 0, 1, 2
RUN = "bucket int, doc_id long, packed binary"
FOUND = "doc_id long, packed binary"


@dataclass(frozen=True)
class Scheme:
    """unit: byte or word.  same_document: an earlier start in the same document counts too.  hot: contexts of an anchor
    beyond which its passages are dealt out by themselves."""

    unit: str
    length: int
    gram: int
    same_document: bool
    hot: int = HOT

    @property
    def reach(self) -> int:
        return self.length - self.gram


def combine(h: np.ndarray, step: int, m: np.uint64) -> np.ndarray:
    x = h[..., : h.shape[-1] - step] * m + h[..., step:]
    return x ^ (x >> U(29))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive entries of the last axis of h, by doubling."""
    mul = constants(64, 91) | U(1)
    parts, size, level = [], 1, 0
    need = n
    while True:
        if need & size:
            parts.append((size, h))
        if size * 2 > n:
            break
        h = combine(h, size, mul[level])
        size, level = size * 2, level + 1
    size, out = parts[-1]
    for k, (s, part) in enumerate(reversed(parts[:-1])):
        count = out.shape[-1] - s
        out = out[..., :count] * mul[32 + k] + part[..., size : size + count]
        out ^= out >> U(31)
        size += s
    return splitmix(out)


class Text:
    """Some texts as one array of unit hashes h, document i from at[i] to at[i + 1]."""

    def __init__(self, texts: list[bytes], scheme: Scheme):
        if scheme.unit == "byte":
            self.buf = np.frombuffer(b"".join(texts), np.uint8)
            self.at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            self.words = None
        else:
            self.words = Words(texts, BLANK)
            self.at = self.words.doc_at
        self.scheme, self._h = scheme, {}

    def units(self, where, seed: int = 1) -> np.ndarray:
        """Hashes of some units; those of bytes are looked up, so a very long text takes no eight bytes a byte."""
        if self.words is None:
            return constants(256, 91 + seed)[self.buf[where]]
        if seed not in self._h:
            self._h[seed] = self.words.hashes(seed)
        return self._h[seed][where]

    def passages(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the passages that start at these units."""
        if len(at) * 8 > self.at[-1] and self.at[-1] < 4 * STRETCH:
            return tuple(gram_hashes(self.units(slice(None), seed), self.scheme.length)[at] for seed in (1, 2))
        return tuple(self.at_places(at, self.scheme.length, seed) for seed in (1, 2))

    def at_places(self, at: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
        """gram_hashes of these places only."""
        out = [gram_hashes(self.units(at[i : i + 8192, None] + np.arange(n), seed), n)[:, 0] for i in range(0, len(at), 8192)]
        return np.concatenate(out) if out else np.zeros(0, U)

    def anchors(self) -> tuple[np.ndarray, ...]:
        """(document, position, fingerprint, and two fingerprints of the context) of each anchor."""
        s, n, out = self.scheme, int(self.at[-1]), []
        for first in range(0, n - s.length + 1, STRETCH):
            lo, hi = max(0, first - s.reach), min(n, first + STRETCH + s.reach + s.length)
            out.append(self._anchors(lo, hi, first - lo, min(n, first + STRETCH) - lo))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U), np.zeros(0, U)
        at, *rest = out[0] if len(out) == 1 else (np.concatenate(x) for x in zip(*out))
        if len(out) > 1:  # one at a seam may be found from both sides
            at, own = np.unique(at, return_index=True)
            rest = [x[own] for x in rest]
        doc = np.searchsorted(self.at, at, side="right") - 1
        return doc, at - self.at[doc], *rest

    def _anchors(self, lo: int, hi: int, first: int, end: int) -> tuple[np.ndarray, ...]:
        """(place, fingerprint, fingerprints of the context) of the anchors of the passages that start in [lo + first,
        lo + end); all they need is in [lo, hi)."""
        s = self.scheme
        grams = gram_hashes(self.units(slice(lo, hi)), s.gram)
        low = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U)
        width, size = s.reach + 1, 1
        while size * 2 <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
        low = low[:end]
        doc_at = np.clip(self.at - lo, 0, hi - lo)
        doc = np.repeat(np.arange(len(doc_at) - 1), np.diff(doc_at))
        inside = doc[: len(low)] == doc[s.length - 1 : s.length - 1 + len(low)]
        inside[:first] = False
        at = (low[inside] & U(0xFFFFFFFF)).astype(np.int64)
        if len(at):
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
        return at + lo, grams[at], *self.contexts(doc[at], at, grams, doc_at, lo)

    def contexts(self, doc: np.ndarray, at: np.ndarray, grams: np.ndarray, doc_at: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        s = self.scheme
        lo, hi = np.maximum(at - s.reach, doc_at[doc]), np.minimum(at + s.length, doc_at[doc + 1])
        full = (lo == at - s.reach) & (hi == at + s.length)
        out, check = np.zeros(len(at), U), np.zeros(len(at), U)
        first, last = at[full] - s.reach, at[full] + s.reach
        x, y = np.zeros(len(first), U), np.full(len(first), U(0x5851F42D4C957F2D))
        for k in [*range(0, 2 * s.reach, s.gram), None]:
            g = grams[last if k is None else first + k]
            x, y = splitmix(x ^ g), (y ^ (g >> U(32)) ^ (g << U(17))) * U(0xD1342543DE82EF95) + g
        out[full], check[full] = x, splitmix(y)
        for i in np.flatnonzero(~full):
            where = slice(base + int(lo[i]), base + int(hi[i]))
            raw = self.buf[where] if s.unit == "byte" else self.units(where)
            own = hashlib.blake2b(raw.tobytes(), digest_size=16, salt=int(at[i] - lo[i]).to_bytes(8, "little")).digest()
            out[i], check[i] = int.from_bytes(own[:8], "little"), int.from_bytes(own[8:], "little")
        return out, check


def six(x: np.ndarray) -> bytes:
    """The low six bytes of each 64-bit word."""
    return x.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def from_six(raw: bytes, n: int, start: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, start).reshape(n, 6)
    return out.view(U).ravel()


def pack_run(grams, contexts, checks, docs, positions) -> bytes:
    """One sorted immutable run of postings."""
    return six(grams) + six(contexts) + checks.tobytes() + docs.astype(np.int64).tobytes() + positions.astype(np.int32).tobytes()


def unpack_run(raw: bytes) -> tuple[np.ndarray, ...]:
    n = len(raw) // 32
    return from_six(raw, n, 0), from_six(raw, n, 6 * n), np.frombuffer(raw, U, n, 12 * n), np.frombuffer(raw, np.int64, n, 20 * n), np.frombuffer(raw, np.int32, n, 28 * n)


def runs_of(values: list[np.ndarray]) -> np.ndarray:
    """The starts of the runs of equal rows in sorted columns, with the length at the end."""
    n = len(values[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.any([v[1:] != v[:-1] for v in values], axis=0)
    return np.append(np.flatnonzero(new), n)


def dealt(grams: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its entries) for the buckets that have any."""
    to = (grams % U(buckets)).astype(np.int64)
    by = np.argsort(to, kind="stable")
    at = runs_of([to[by]])
    for a, b in zip(at[:-1], at[1:]):
        yield int(to[by[a]]), by[a:b]


def per_document(docs: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(document, its packed values) of int64 values, given in any order."""
    order = np.argsort(docs, kind="stable")
    docs, values = docs[order], values[order].astype(np.int64)
    at = runs_of([docs])
    for a, b in zip(at[:-1], at[1:]):
        yield int(docs[a]), values[a:b].tobytes()


def merged_order(grams, contexts, checks, docs, positions) -> np.ndarray:
    """The order by (anchor, context, check, document, position).  Sorted runs that follow one another are merged: the
    stable sort finds them, and only postings that agree in what it compares are looked at closer."""
    key = (grams << U(16)) | ((contexts >> U(32)) & U(0xFFFF))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    tied = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(k) else np.zeros(0, bool)
    at = np.flatnonzero(tied)
    if len(at):
        own = order[at]
        order[at] = own[np.lexsort((positions[own], docs[own], checks[own], contexts[own], key[own]))]
    return order


def repeats(grams, contexts, checks, docs, positions, same_document: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by (anchor, context, document, position); in that order, whether the context has occurred before, and
    whether the posting is of its first occurrences."""
    order = merged_order(grams, contexts, checks, docs, positions)
    g, c, k, d, p = (x[order] for x in (grams, contexts, checks, docs, positions))
    at = runs_of([g, c, k])
    first = np.repeat(at[:-1], np.diff(at))
    before = d > d[first]
    if same_document:
        before |= (d == d[first]) & (p > p[first])
    return order, before, ~before


def posting_batches(batches: Iterator[pa.RecordBatch], scheme: Scheme, buckets: int) -> Iterator[pa.RecordBatch]:
    for part, texts in pieces(batches, limit=PIECE):
        ids = part.column(0).to_numpy(zero_copy_only=False)
        doc, pos, grams, contexts, checks = Text(texts, scheme).anchors()
        docs = ids[doc].astype(np.int64)
        # to meet by, a fingerprint is six bytes from here on
        grams, contexts = grams & U(0xFFFFFFFFFFFF), contexts & U(0xFFFFFFFFFFFF)
        order, before, first = repeats(grams, contexts, checks, docs, pos, scheme.same_document)
        g, c, k, d, p = (x[order] for x in (grams, contexts, checks, docs, pos))
        out = [(-1 - i % buckets, i, raw) for i, raw in per_document(d[before], p[before] * 4 + BEFORE)]
        g, c, k, d, p = (x[first] for x in (g, c, k, d, p))
        for b, own in dealt(g, buckets):
            out.append((b, None, pack_run(g[own], c[own], k[own], d[own], p[own])))
        yield rows(out, ("bucket", "doc_id", "packed"), (pa.int32(), pa.int64(), pa.binary()))


def rows(values: list[tuple], names: tuple, kinds: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v[i] for v in values], k) for i, k in enumerate(kinds)], names=list(names))


def settle_group(bucket: pa.Table, scheme: Scheme) -> pa.Table:
    """doc_id, packed: positions times four, plus what is said of them.  With a column `new`, nothing is said of postings
    that aren't, but that they are asked about where a new context has their anchor."""
    fresh = bucket.column("new").to_pylist() if "new" in bucket.schema.names else [True] * len(bucket)
    given = list(zip(bucket.column("doc_id").to_pylist(), bucket.column("packed").to_pylist(), fresh))
    ready = [(d, raw) for d, raw, new in given if d is not None and new]
    runs = [(unpack_run(raw), new) for d, raw, new in given if d is None]
    if runs:
        g, c, k, d, p = (np.concatenate(x) for x in zip(*(r for r, _ in runs)))
        new = np.repeat([n for _, n in runs], [len(r[0]) for r, _ in runs])
        order, before, first = repeats(g, c, k, d, p, scheme.same_document)
        g, c, k, d, p, new = (x[order] for x in (g, c, k, d, p, new))
        at = runs_of([g])
        context = np.ones(len(g), np.int64)
        context[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (k[1:] != k[:-1])
        size = np.diff(at)
        contexts = np.repeat(np.add.reduceat(context, at[:-1]), size)
        any_new = np.repeat(np.logical_or.reduceat(new, at[:-1]), size)
        use = (before & new) | (first & (contexts > 1) & any_new)
        said = np.where(before, BEFORE, np.where(contexts > scheme.hot, ASKED_HOT, ASKED))
        ready += per_document(d[use], p[use].astype(np.int64) * 4 + said[use])
    return pa.table({"doc_id": pa.array([d for d, _ in ready], pa.int64()), "packed": pa.array([r for _, r in ready], pa.binary())})


def buckets_for(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))


def settle(docs: DataFrame, scheme: Scheme, buckets: int) -> DataFrame:
    """(doc_id, packed) from docs (doc_id, text)."""
    own = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    runs = own.mapInArrow(lambda it: posting_batches(it, scheme, buckets), RUN)
    return runs.groupBy("bucket").applyInArrow(lambda t: settle_group(t, scheme), FOUND)


def together(found: DataFrame, name: str) -> DataFrame:
    return found.groupBy("doc_id").agg(F.collect_list("packed").alias(name)).withColumnRenamed("doc_id", f"__{name}")


def gather(docs: DataFrame, found: DataFrame, ws: Workspace, plain: list, *more: str, name: str = "gathered") -> DataFrame:
    """docs with hits (list of packed); documents without any keep the columns of `plain` and lose their text."""
    hits = together(found, "hits")
    t = docs.join(hits, docs["doc_id"] == hits["__hits"], "left").drop("__hits")
    none = F.col("hits").isNull()
    return ws.put(t.select("doc_id", *more, F.when(~none, F.col("text")).alias("text"), "hits", *[F.when(none, c).alias(n) for n, c in plain]), name)


def asked(hits: list[bytes] | None) -> np.ndarray:
    """The positions asked about, times four, plus what is said of them."""
    if not hits:
        return np.zeros(0, np.int64)
    x = np.frombuffer(b"".join(hits), np.int64)
    return np.unique(x[(x & 3) != BEFORE])


def packed_windows(text: Text, ids: np.ndarray, doc: np.ndarray, pos: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, number, packed) of the passages around some positions: two hashes, document and start, each once, by bucket
    of the first hash."""
    s = text.scheme
    start = pos[:, None] - s.reach + np.arange(s.reach + 1)
    there = (start >= 0) & (start + s.length <= np.diff(text.at)[doc][:, None])
    at = np.unique((text.at[doc][:, None] + start)[there])
    owner = np.searchsorted(text.at, at, side="right") - 1
    one, two = text.passages(at)
    names, local = ids[owner].astype(np.int64), (at - text.at[owner]).astype(np.int32)
    for b, own in dealt(one, buckets):
        yield b, len(own), one[own].tobytes() + two[own].tobytes() + names[own].tobytes() + local[own].tobytes()


def ask_batches(batches: Iterator[pa.RecordBatch], scheme: Scheme, buckets: int, pack: Callable | None) -> Iterator[pa.RecordBatch]:
    """Packs what is asked about: the passages around hot positions (or all, without pack), and of the other contexts what
    the method needs, pack(text, document, id, position, anchor) -> bytes."""
    for part, texts in pieces(batches, limit=PIECE):
        want = [asked(h) for h in part.column(part.schema.get_field_index("hits")).to_pylist()]
        doc = np.repeat(np.arange(len(texts)), [len(w) for w in want])
        if not len(doc):
            continue
        text, said = Text(texts, scheme), np.concatenate(want)
        pos, hot = said >> 2, ((said & 3) == ASKED_HOT) | (pack is None)
        # with rows that share a doc_id, a position may be beyond the end of one
        ok = pos + scheme.gram <= np.diff(text.at)[doc]
        doc, pos, hot = doc[ok], pos[ok], hot[ok]
        ids, out = part.column(0).to_numpy(zero_copy_only=False), []
        if hot.any():
            out += [(b, True, n, raw) for b, n, raw in packed_windows(text, ids, doc[hot], pos[hot], buckets)]
        doc, pos = doc[~hot], pos[~hot]
        if len(doc):
            grams = text.at_places(text.at[doc] + pos, scheme.gram) & U(0xFFFFFFFFFFFF)
            names = ids[doc].astype(np.int64)
            out += [(b, False, len(own), pack(text, doc[own], names[own], pos[own], grams[own])) for b, own in dealt(grams, buckets)]
        yield rows(out, ("bucket", "hot", "n", "packed"), (pa.int32(), pa.bool_(), pa.int32(), pa.binary()))


def window_group(bucket: pa.Table, same_document: bool) -> pa.Table:
    """doc_id, packed (first, after the last) pairs of the passages that occur before."""
    parts = [(np.frombuffer(raw, U, n), np.frombuffer(raw, U, n, 8 * n), np.frombuffer(raw, np.int64, n, 16 * n), np.frombuffer(raw, np.int32, n, 24 * n)) for n, raw in zip(bucket.column("n").to_pylist(), bucket.column("packed").to_pylist())]
    a, b, d, p = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((p, d, b, a))
    a, b, d, p = (x[order] for x in (a, b, d, p))
    at = runs_of([a, b])
    first = np.repeat(at[:-1], np.diff(at))
    found = d > d[first]
    if same_document:
        found |= (d == d[first]) & (p > p[first])
    d, p = d[found], p[found].astype(np.int64)
    order = np.lexsort((p, d))
    d, p = d[order], p[order]
    fresh = np.ones(len(d), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1)
    start, end = np.flatnonzero(fresh), np.flatnonzero(np.append(fresh[1:], True)[: len(d)])
    return paired(d[start], p[start], p[end] + 1)


def ask(gathered: DataFrame, scheme: Scheme, buckets: int, pack: Callable | None = None) -> DataFrame:
    """bucket, hot, n, packed of what is asked about."""
    some = gathered.where(F.col("text").isNotNull()).select("doc_id", "text", "hits")
    return some.mapInArrow(lambda it: ask_batches(it, scheme, buckets, pack), "bucket int, hot boolean, n int, packed binary")


def answered(asked_about: DataFrame, scheme: Scheme, method: Callable | None = None) -> DataFrame:
    """doc_id, packed: the answers of the method, and those by the passages themselves where these were packed."""

    def one(key: tuple, bucket: pa.Table) -> pa.Table:
        return window_group(bucket, scheme.same_document) if key[0].as_py() else method(bucket, scheme)

    return asked_about.groupBy("hot", "bucket").applyInArrow(one, FOUND)


def with_answers(gathered: DataFrame, answers: DataFrame) -> DataFrame:
    """gathered with answers: list of packed (first passage, passage after the last) pairs."""
    a = together(answers, "answers")
    return gathered.join(a, gathered["doc_id"] == a["__answers"], "left").drop("__answers")


def covered(n: int, scheme: Scheme, hits: list[bytes] | None, answers: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs, of n units, that found passages cover."""
    first = last = np.zeros(0, np.int64)
    if n >= scheme.length:
        if hits:
            x = np.frombuffer(b"".join(hits), np.int64)
            p = x[(x & 3) == BEFORE] >> 2
            first, last = np.maximum(p - scheme.reach, 0), np.minimum(p, n - scheme.length)
        if answers:
            x = np.frombuffer(b"".join(answers), np.int32).astype(np.int64).reshape(-1, 2)
            first, last = np.concatenate([first, x[:, 0]]), np.concatenate([last, np.minimum(x[:, 1] - 1, n - scheme.length)])
    ok = first <= last
    order = np.argsort(first[ok], kind="stable")
    start, end = first[ok][order], last[ok][order] + scheme.length
    if not len(start):
        return start, end
    end = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return start[new], end[np.append(np.flatnonzero(new)[1:], len(end)) - 1]


def answers_of(docs: np.ndarray, starts: np.ndarray, found: np.ndarray) -> pa.Table:
    """found[i, s]: passage starts[i] + s of document docs[i] occurs before.  Rows of (doc_id, packed pairs)."""
    wide = np.zeros((len(found), found.shape[1] + 2), np.int8)
    wide[:, 1:-1] = found
    step = np.diff(wide, axis=1)
    r, a = np.nonzero(step == 1)
    _, b = np.nonzero(step == -1)
    return paired(docs[r], starts[r] + a, starts[r] + b)


def paired(docs: np.ndarray, first: np.ndarray, after: np.ndarray) -> pa.Table:
    pairs = np.stack([first, after], axis=1).astype(np.int32)
    order = np.argsort(docs, kind="stable")
    d, pairs = docs[order], pairs[order]
    at = runs_of([d])
    return pa.table({"doc_id": pa.array(d[at[:-1]] if len(d) else [], pa.int64()), "packed": pa.array([pairs[x:y].tobytes() for x, y in zip(at[:-1], at[1:])], pa.binary())})
