"""Operator 4: suffix-array dedup of byte passages.

Removes each byte that lies in a `length`-byte string which also starts earlier: in a document with a smaller doc_id, or
in the same document.  Strings never cross documents, overlaps count, and all are judged on the input.

Passages meet by anchors (see passages).  Where an anchor has different contexts, the bucket's suffix arrays decide: one
over what follows the anchors and one over what precedes them, read backwards, both built by linear grouping of Lyndon
prefixes (see gsaca).  Their symbols are eight bytes each; as every context is aligned at its anchor, the order of those
is the order of the bytes.  Contexts that agree in s bytes after the anchor are neighbours in the one, those that agree
in the rest before it in the other, so two running numbers name each passage, and the first context with a name keeps it.

What contexts that are equal as a whole repeat is known from their fingerprints (112 bits) without a suffix array, and
anchors with more than `hot` contexts are compared passage by passage; see passages.

Null and empty texts are empty; rows without a doc_id lose nothing; see passages for rows that share one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, fields, ship
from .gsaca import suffix_array
from .kernels import U, pieces, splitmix
from .passages import Scheme, answered, answers_of, ask, buckets_for, covered, gather, runs_of, settle, with_answers

SCHEME = Scheme("byte", 100, 32, True)


def sides(scheme: Scheme) -> int:
    """Bytes of each side of a context, in whole symbols."""
    return -(-scheme.reach // 8) * 8


def pack_sides(text, doc, ids, pos, grams) -> bytes:
    """Of each context: fingerprint, id, position, bytes there are before and after the anchor, and those bytes, padded."""
    s = text.scheme
    w = sides(s)
    at, lo, hi = text.at[doc] + pos, text.at[doc], text.at[doc + 1]
    before, after = np.minimum(pos, s.reach), np.minimum(hi - at - s.gram, s.reach)
    k = np.arange(w)
    buf = text.buf
    left = np.where(k < before[:, None], buf[np.maximum(at[:, None] - 1 - k, lo[:, None])], 0).astype(np.uint8)
    right = np.where(k < after[:, None], buf[np.minimum(at[:, None] + s.gram + k, hi[:, None] - 1)], 0).astype(np.uint8)
    return b"".join(x.tobytes() for x in (grams, ids, pos.astype(np.int32), before.astype(np.uint8), after.astype(np.uint8), left, right))


def unpack_sides(raw: bytes, n: int, w: int) -> tuple[np.ndarray, ...]:
    out, start = [], 0
    for kind, size in ((U, 8), (np.int64, 8), (np.int32, 4), (np.uint8, 1), (np.uint8, 1)):
        out.append(np.frombuffer(raw, kind, n, start))
        start += n * size
    for _ in range(2):
        out.append(np.frombuffer(raw, np.uint8, n * w, start).reshape(n, w))
        start += n * w
    return tuple(out)


def ordered(group: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of equal rows, by rank in the order of (group, bytes); agreement in bytes of each class with the one before).

    A suffix array over the distinct rows, one after another, each led by its group.
    """
    n, w = side.shape
    key = np.concatenate([group.astype(">u8").view(np.uint8).reshape(n, 8), side], axis=1)
    width = w // 8 + 1
    symbols = np.ascontiguousarray(key).view(">u8").reshape(n, width).astype(U)
    name = np.zeros(n, U)
    for k in range(width):
        name = splitmix((name ^ symbols[:, k]) + U(k + 1))
    _, one, which = np.unique(name, return_index=True, return_inverse=True)
    m = len(one)
    _, ranks = np.unique(symbols[one].ravel(), return_inverse=True)
    sa = np.array(suffix_array([*(ranks.ravel() + 1).tolist(), 0]), np.int64)
    # a row's suffix runs on into the next row; but no two rows are equal, so their own symbols decide
    rows = sa[(sa % width == 0) & (sa < m * width)] // width
    rank = np.empty(m, np.int64)
    rank[rows] = np.arange(m)
    data = key[one[rows]]
    unlike = data[1:] != data[:-1]
    agree = np.where(unlike.any(axis=1), unlike.argmax(axis=1), w + 8) - 8
    return rank[which.ravel()], np.concatenate([[-1], agree])


def names(cls: np.ndarray, agree: np.ndarray, depth: int) -> np.ndarray:
    """Equal for contexts of one group that agree in depth bytes."""
    return np.cumsum(agree < depth)[cls]


def answer_group(bucket: pa.Table, scheme: Scheme) -> pa.Table:
    w = sides(scheme)
    parts = [unpack_sides(raw, n, w) for n, raw in zip(bucket.column("n").to_pylist(), bucket.column("packed").to_pylist())]
    g, d, p, before, after, left, right = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((p, d))
    g, d, p, before, after, left, right = (x[order] for x in (g, d, p, before, after, left, right))
    _, group = np.unique(g, return_inverse=True)
    group = group.ravel() + 1
    r_cls, r_agree = ordered(group, right)
    l_cls, l_agree = ordered(group, left)
    found = np.zeros((len(g), scheme.reach + 1), bool)
    for s in range(scheme.reach + 1):  # s bytes after the anchor; the passage starts reach - s before it
        valid = np.flatnonzero((after >= s) & (before >= scheme.reach - s))
        name = names(r_cls, r_agree, s)[valid] * (len(g) + 2) + names(l_cls, l_agree, scheme.reach - s)[valid]
        by = np.argsort(name, kind="stable")
        at = runs_of([name[by]])
        first = np.repeat(by[at[:-1]], np.diff(at))
        own, one = valid[by], valid[first] if len(by) else valid
        found[own, s] = (d[own] > d[one]) | ((d[own] == d[one]) & (p[own] > p[one]))
    return answers_of(d, p.astype(np.int64) - scheme.reach, found)


def cut_batches(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    none = np.zeros(0, np.int64)
    for part, texts in pieces(batches):
        col = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names) if n in ("hits", "answers", "n_bytes", "sha")}
        n_bytes, removed, spans, sha, starts, ends = [], [], [], [], [], []
        for i, t in enumerate(texts):
            a, b = covered(len(t), scheme, col["hits"][i], col["answers"][i]) if col["hits"][i] else (none, none)
            if col["hits"][i]:
                kept = b"".join(t[x:y] for x, y in zip([0, *b], [*a, len(t)]))
                n_bytes.append(len(t))
                sha.append(hashlib.sha256(kept).hexdigest())
            else:
                n_bytes.append(col["n_bytes"][i])
                sha.append(col["sha"][i])
            removed.append(int((b - a).sum()))
            spans.append(len(a))
            starts.append(a)
            ends.append(b)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"])


def repeated_bytes(docs: DataFrame, scheme: Scheme = SCHEME) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts and ends of the removed runs."""
    spark = docs.sparkSession
    ship(spark)
    ws = Workspace(spark, "suffixes")
    docs = fields(docs, "doc_id", "text")
    key = docs.schema["doc_id"].dataType.simpleString()
    buckets = buckets_for(docs)
    text = F.coalesce("text", F.lit(""))
    table = gather(docs, settle(docs, scheme, buckets), ws, [("n_bytes", F.octet_length(text).cast("long")), ("sha", F.sha2(text, 256))])
    answers = answered(ask(table, scheme, buckets, pack_sides), scheme, answer_group)
    kind = f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<int>, ends array<int>"
    return with_answers(table, answers).mapInArrow(lambda it: cut_batches(it, scheme), kind)


def op4_suffixes(spark, sf_dir: str) -> DataFrame:
    return repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("starts", "ends")
