"""Operator 5: approximate nearest neighbours with a permutation index.

Pivots are PIVOTS vectors of a bounded sample.  A vector is represented by its PREFIX nearest pivots, in order.  The
index, written once, holds every row, in shards of up to SHARD rows.  A search posts each row of a shard in the inverted
files of its PREFIX pivots only, with the place the pivot has in the row's order, and reads for a query the files of the
query's own pivots.  A pivot that both have at places a and b brings their footrule distance down by
2 * (PREFIX - max(a, b)) from what two orders without a common pivot have, so the files read give every row's footrule.
The RERANK part of the shard with the smallest footrule is ranked again by Euclidean distance in double precision, and
the shards' best meet per query.  Shards of up to LEAST rows are ranked whole.

Queries are a stated set: they are rows packed in blocks of up to QUERIES, and each block meets each shard once, in tasks
of their own; neither goes through the driver.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an id.
Only vectors of the same length are compared; of a length that no pivot has, all are.  Rows with the query's id are its
own and no candidates; otherwise rows that repeat are candidates of their own.  Ties go to the smaller id.  A query id
that stands on several rows is one query, and each candidate's score is the nearest to any of them.  Without candidates a
query has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, fields, ship

SAMPLE = 2048
PIVOTS = 1024
PREFIX = 64
RERANK = 0.12
LEAST = 256
SHARD = 16384
QUERIES = 4096
#: Bytes of packed rows in a row group, so that readers hold few of them.
GROUP_BYTES = 16 << 20

PACKED = "shard long, size int, n int, ids binary, vectors binary, orders binary"
FOUND = "query_id long, vec_id long, shard long, row long, score double"


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def by_length(batch: pa.RecordBatch, column: str = "embedding") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors as rows of doubles) for each length of vector."""
    v = batch.column(batch.schema.get_field_index(column))
    flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(v.offsets.to_numpy())
    first = np.concatenate([[0], np.cumsum(size)])
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield rows, flat[first[rows][:, None] + np.arange(n)]


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T


def permutations(v: np.ndarray, pivots: np.ndarray | None) -> np.ndarray:
    """The PREFIX nearest pivots of each vector, in order; none without pivots."""
    if pivots is None:
        return np.zeros((len(v), 0), np.int16)
    k, out = min(PREFIX, len(pivots)), []
    for i in range(0, len(v), 1024):
        d = squares(v[i : i + 1024], pivots)
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        own = np.take_along_axis(d, near, 1)
        out.append(np.take_along_axis(near, np.lexsort((near, own), axis=1), 1).astype(np.int16))
    return np.concatenate(out)


def fit(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Pivots for each length of vector, from the SAMPLE usable vectors whose ids hash lowest."""
    rows = fields(vectors, "vec_id", "embedding").where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(SAMPLE).collect()
    out: dict[int, dict[tuple, None]] = {}
    for r in rows:
        own = out.setdefault(len(r["embedding"]), {})
        if len(own) < PIVOTS:
            own.setdefault(tuple(r["embedding"]))
    return {n: np.array(list(v), np.float64) for n, v in out.items()}


def packed_batches(batches: Iterator[pa.RecordBatch], pivots, size: int) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, embedding) as packed rows of up to size vectors of one length each, with their orders."""
    from pyspark import TaskContext

    held: dict[int, list] = {}
    number = count(TaskContext.get().partitionId() << 32)

    def pack(n: int, parts: list) -> pa.RecordBatch:
        ids, v = np.concatenate([i for i, _ in parts]), np.concatenate([x for _, x in parts])
        orders = permutations(v, pivots.value.get(n))
        raw = [ids.astype(np.int64), v, orders]
        return pa.RecordBatch.from_arrays([pa.array([next(number)], pa.int64()), pa.array([n], pa.int32()), pa.array([len(ids)], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in raw)], names=["shard", "size", "n", "ids", "vectors", "orders"])

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for rows, v in by_length(batch):
            own, n = held.setdefault(v.shape[1], []), v.shape[1]
            at = 0
            while at < len(rows):
                take = min(size - sum(len(i) for i, _ in own), len(rows) - at)
                own.append((ids[rows[at : at + take]], v[at : at + take]))
                at += take
                if sum(len(i) for i, _ in own) == size:
                    yield pack(n, own)
                    own.clear()
    for n, own in held.items():
        if own:
            yield pack(n, own)


def packed(vectors: DataFrame, pivots, size: int, ws: Workspace, name: str) -> DataFrame:
    """The usable rows of vectors, packed and written."""
    rows = fields(vectors, "vec_id", "embedding").where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return ws.put(rows.mapInArrow(lambda it: packed_batches(it, pivots, size), PACKED), name, **{"parquet.block.size": GROUP_BYTES})


def unpacked(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, size = row[f"{prefix}n"], row[f"{prefix}size"]
    orders = np.frombuffer(row[f"{prefix}orders"], np.int16)
    return np.frombuffer(row[f"{prefix}ids"], np.int64), np.frombuffer(row[f"{prefix}vectors"], np.float64).reshape(n, size), orders.reshape(n, -1) if len(orders) else np.zeros((n, 0), np.int16)


class Inverted:
    """One file per pivot over some rows: the rows that have the pivot in their order, and at what place."""

    def __init__(self, orders: np.ndarray):
        n, self.prefix = orders.shape
        pivot = orders.ravel()
        by = np.argsort(pivot, kind="stable")
        self.rows, self.places = by // max(self.prefix, 1), by % max(self.prefix, 1)
        self.first = np.searchsorted(pivot[by], np.arange(int(pivot.max(initial=-1)) + 2))
        self.n = n

    def nearness(self, order: np.ndarray) -> np.ndarray:
        """By how much, halved, each row's footrule distance from the order is below that of one without its pivots."""
        out = np.zeros(self.n, np.int64)
        for place, p in enumerate(order):
            if p + 1 < len(self.first):
                own = slice(self.first[p], self.first[p + 1])
                out[self.rows[own]] += self.prefix - np.maximum(self.places[own], place)
        return out


class Shard:
    def __init__(self, ids: np.ndarray, v: np.ndarray, orders: np.ndarray, k: int, rerank: float):
        by_id = np.argsort(ids, kind="stable")
        self.rows, self.ids, self.k = by_id, ids[by_id], k
        v = v[by_id]
        # equal vectors stand for one, so that a very common one can't fill the list
        _, one, which = np.unique(np.ascontiguousarray(v).view(f"V{8 * v.shape[1]}").ravel(), return_index=True, return_inverse=True)
        self.copies = np.argsort(which, kind="stable")  # by vector, then by id
        self.at = np.searchsorted(which[self.copies], np.arange(len(one) + 1))
        self.first = np.minimum(self.at[:-1] + k + 1, self.at[1:])  # more copies than these can't be among the k nearest
        self.v = v[one]
        self.most = max(LEAST, int(np.ceil(rerank * len(one))))
        self.files = Inverted(orders[by_id][one]) if orders.shape[1] and self.most < len(one) else None

    def nearest(self, q_id: int, q: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ids, distance) of the k nearest found, nearest first; the query's own row may take a place more."""
        near = np.arange(len(self.v))
        if self.files is not None:
            near = np.argpartition(-self.files.nearness(order), self.most - 1)[: self.most]
        d = np.sqrt(((self.v[near] - q) ** 2).sum(axis=1))
        if len(d) > self.k:
            ok = d <= np.partition(d, self.k)[self.k]
            near, d = near[ok], d[ok]
        each = self.first[near] - self.at[near]
        found = self.copies[np.repeat(self.at[near], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)]
        d = np.repeat(d, each)
        other = self.ids[found] != q_id
        found, d = found[other], d[other]
        best = np.lexsort((self.ids[found], d))[: self.k]
        return found[best], d[best]


def search_batches(batches: Iterator[pa.RecordBatch], k: int, rerank: float) -> Iterator[pa.RecordBatch]:
    """The k nearest of each query of a block in a shard, for pairs of a shard and a block."""
    last, shard = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != last:
                last, shard = row["shard"], Shard(*unpacked(row), k, rerank)
            ids, q, orders = unpacked(row, "q_")
            found = [shard.nearest(i, x, o) for i, x, o in zip(ids, q, orders)]
            at = np.concatenate([f for f, _ in found]) if found else np.zeros(0, np.int64)
            out = [np.repeat(ids, [len(f) for f, _ in found]), shard.ids[at], np.full(len(at), last), shard.rows[at], np.concatenate([d for _, d in found])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["query_id", "vec_id", "shard", "row", "score"])


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, rerank: float = RERANK, shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query."""
    spark = vectors.sparkSession
    ship(spark)
    ws = Workspace(spark, "ann")
    pivots = spark.sparkContext.broadcast(fit(vectors))
    index = packed(vectors, pivots, min(shard, 1 << 20), ws, "index")
    blocks = packed(fields(queries, "vec_id", "embedding").dropDuplicates(), pivots, QUERIES, ws, "queries")
    pivots.destroy()
    # a difference, as an equality would deal all vectors of a length to one task
    pairs = index.crossJoin(blocks.select(*[F.col(c).alias(f"q_{c}") for c in blocks.columns])).where(F.col("size") - F.col("q_size") == 0)
    out = ws.put(pairs.mapInArrow(lambda it: search_batches(it, k, rerank), FOUND), "found")
    out = out.groupBy("query_id", "shard", "row", "vec_id").agg(F.min("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id", "shard", "row")
    return out.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(vectors: DataFrame, queries: DataFrame, k: int = 10, rerank: float = RERANK, shard: int = SHARD) -> float:
    """The share of the k nearest by brute force (the same pass, all rows ranked) that a search finds."""
    found, exact = search(vectors, queries, k, rerank, shard), search(vectors, queries, k, 1.0, shard)
    hit = exact.join(found, ["query_id", "vec_id"], "left_semi").count()
    return hit / max(1, exact.count())


def op5_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0))
