"""Operator 6: near duplicates by MinHash, banding, verification and connected components.

A document's set are its distinct shingles of `shingle` words (with fewer words, the whole sequence as one).  Equal sets
are one node, under the smallest doc_id, before anything else is done.  BANDS * ROWS universal hash minima make BANDS
keys; nodes that share a key are candidates (at a similarity of 0.8 a pair is missed with a probability of 3e-6).
Links are confirmed by the sizes, then by the signatures, then by the full sets.

Within the nodes of a key no list of all pairs is made.  The node that most others meet is compared with all others of
its key, the links found merge components, and the node is done with; then the same with the weightiest node outside
the key's largest component.  Where nodes not done with are still of several components, the few pairs that may be
similar are found exactly, by their rarest shingles.  So every pair is compared, connected, or known not to be similar.

Null texts and texts without words have empty sets and link with nothing.  Rows with the same doc_id are one document
with several sets; a row without a doc_id is alone (component_id null, kept).  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, fields, ship
from .components import components
from .kernels import BLANK, U, Words, constants, pieces, splitmix

BANDS, ROWS = 32, 5
#: Signatures that agree in less than this share of places are no link; 6 standard deviations below 0.8.
DOUBT = 0.6


def shingle_hashes(words: Words, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles."""
    h = words.hashes()
    many = h[: max(0, len(h) - n + 1)].copy()
    for k in range(1, n):
        many = splitmix(many * U(0x9E3779B97F4A7C15) + h[k : k + len(many)])
    out = []
    for a, b in zip(words.doc_at[:-1], words.doc_at[1:]):
        if b - a >= n:
            out.append(np.unique(many[a : b - n + 1]))
        elif b > a:
            x = h[a : a + 1]
            for k in range(a + 1, b):
                x = splitmix(x * U(0x9E3779B97F4A7C15) + h[k : k + 1])
            out.append(splitmix(x + U(int(b - a))))
        else:
            out.append(np.zeros(0, U))
    return out


class Hashes:
    """BANDS * ROWS hash functions x -> (a * x + b) >> 32 of the 2-universal multiply-shift family."""

    def __init__(self):
        n = BANDS * ROWS
        self.a, self.b = (constants(n, 61) | U(1))[:, None], constants(n, 62)[:, None]
        self.band = constants(BANDS, 63)

    def minima(self, items: np.ndarray) -> np.ndarray:
        out = None
        for i in range(0, len(items), 2048):
            m = (((self.a * items[None, i : i + 2048]) + self.b) >> U(32)).min(axis=1)
            out = m if out is None else np.minimum(out, m)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        rows = minima.reshape(BANDS, ROWS)
        x = self.band.copy()
        for k in range(ROWS):
            x = splitmix(x ^ rows[:, k]) + U(k)
        return x.view(np.int64)


def digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def sketch_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    hashes = Hashes()
    for part, texts in pieces(batches):
        sets = shingle_hashes(Words(texts, BLANK, lower=True), n)
        minima = [hashes.minima(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                part.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([hashes.keys(m) if m is not None else None for m in minima], pa.list_(pa.int64())),
                pa.array([(m & U(255)).astype(np.uint8).view(np.int8) if m is not None else None for m in minima], pa.list_(pa.int8())),
            ],
            names=["doc_id", "n", "set_id", "keys", "sig"],
        )


def set_batches(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for part, texts in pieces(batches):
        sets = shingle_hashes(Words(texts, BLANK, lower=True), n)
        ids = part.column(part.schema.get_field_index("set_id")).to_pylist()
        rows = [i for i, s in enumerate(sets) if len(s) and digest(s) == ids[i]]
        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), pa.array([ids[i] for i in rows], pa.binary()), pa.array([sets[i].view(np.int64) for i in rows], pa.list_(pa.int64()))], names=["node", "set_id", "items"])


# Minima by key are written before they are joined back, so that a key of very many nodes is a join that Spark can split.


def first_of(members: DataFrame, ws: Workspace) -> DataFrame:
    """Of each key its weightiest node, as rep, and all its other nodes."""
    best = members.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), "node")).alias("best")).select("key", F.col("best.node").alias("rep"))
    best = ws.put(best, "best-0")
    return members.join(best.hint("merge"), "key").where(F.col("node") != F.col("rep"))


def still_open(rest: DataFrame, of: DataFrame, ws: Workspace, turn: int) -> DataFrame:
    """Of (key, node, weight) the keys whose nodes are of several components, with component and top, the key's largest
    one."""
    labelled = rest.select("key", "node", "weight").join(of.hint("merge"), "node", "left").select("key", "node", "weight", F.coalesce("component", "node").alias("component"))
    labelled = ws.put(labelled, f"labelled-{turn}")
    each = labelled.groupBy("key", "component").agg(F.count("*").alias("n"), F.min(F.struct((-F.col("weight")).alias("w"), "node")).alias("best"))
    top = each.groupBy("key").agg(F.min(F.struct((-F.col("n")).alias("n"), "best", "component")).alias("top"), F.count("*").alias("parts")).where(F.col("parts") > 1).select("key", F.col("top.component").alias("top"))
    top = ws.put(top, f"top-{turn}")
    return labelled.join(top.hint("merge"), "key")


def next_of(open_keys: DataFrame, ws: Workspace) -> DataFrame:
    """Of each open key its weightiest node outside the top component, as rep, and all its other nodes."""
    outside = open_keys.where(F.col("component") != F.col("top"))
    best = outside.groupBy("key").agg(F.min(F.struct((-F.col("weight")).alias("w"), "node", "component")).alias("best"))
    best = ws.put(best.select("key", F.col("best.node").alias("rep"), F.col("best.component").alias("rep_component")), "best-1")
    return open_keys.join(best.hint("merge"), "key").where(F.col("node") != F.col("rep"))


def prefixes(open_keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rarest items of the nodes' sets, so many that sets similar enough share one: node, component, outside (in a
    key whose top component it isn't of), n, item, and the item's place i in the order from the rarest."""
    nodes = open_keys.groupBy("node", "component").agg(F.max((F.col("component") != F.col("top")).cast("int")).alias("outside"))
    items = sets.join(nodes.hint("merge"), "node").select("node", "component", "outside", F.size("items").alias("n"), "set_id", F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count("*").alias("often")).where(F.col("often") > 1)
    rarest = Window.partitionBy("node", "set_id").orderBy("often", "item")
    placed = items.join(often.hint("merge"), "item", "left").withColumn("often", F.coalesce("often", F.lit(1))).withColumn("i", F.row_number().over(rarest))
    # an item of one set pairs nothing, but it takes a place
    return placed.where((F.col("i") <= F.col("n") - F.ceil(percent * F.col("n") / 100) + 1) & (F.col("often") > 1)).drop("set_id", "often")


def remaining_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components that may be similar enough: sets of so large a share in common share one
    of their rarest items, at places that leave enough items after them.  Nodes of a key's top component are not paired
    with each other."""
    side = lambda t, s: t.select("item", F.col("node").alias(s), F.col("component").alias(f"c{s}"), F.col("n").alias(f"n{s}"), F.col("i").alias(f"i{s}"))
    left = 1 + F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    pairs = side(placed.where("outside = 1"), "a").join(side(placed, "b").hint("merge"), "item").where((F.col("ca") != F.col("cb")) & ((100 + percent) * left >= percent * (F.col("na") + F.col("nb"))))
    return in_order(pairs)


def in_order(pairs: DataFrame) -> DataFrame:
    """(a, ca, b, cb), each pair once, the smaller node first."""
    swap = F.col("a") > F.col("b")
    return pairs.select(*[F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("ca", "cb"), ("b", "a"), ("cb", "ca"))]).distinct()


def verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(ca, cb) of the pairs with 100 * intersection >= percent * union of their full sets."""

    def side(t: DataFrame, s: str) -> DataFrame:
        return t.select(*[F.col(c).alias(s if c == "node" else f"{s}_{c}") for c in t.columns]).hint("merge")

    sized = pairs.join(side(nodes, "a"), "a").join(side(nodes, "b"), "b")
    sized = sized.where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    same = F.aggregate(F.zip_with("a_sig", "b_sig", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    likely = sized.where(same >= (DOUBT if percent >= 80 else 0) * BANDS * ROWS).select("a", "b", "ca", "cb", "a_set_id", "b_set_id")
    full = likely.join(side(sets, "a"), ["a", "a_set_id"]).join(side(sets, "b"), ["b", "b_set_id"])
    common = F.size(F.array_intersect("a_items", "b_items"))
    return full.where(100 * common >= percent * (F.size("a_items") + F.size("b_items") - common)).select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def merged(of: DataFrame, links: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """of (node, component), with the components that links (a, b) join made one."""
    step = components(links, ws, f"{name}-merge")
    moved = of.join(step.select(F.col("node").alias("component"), F.col("component").alias("to")).hint("merge"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return ws.put(moved.unionAll(step.join(of.select("node").hint("merge"), "node", "left_anti")), name)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs."""
    spark = docs.sparkSession
    ship(spark)
    ws = Workspace(spark, "minhash")
    docs = fields(docs, "doc_id", "text")
    key = docs.schema["doc_id"].dataType.simpleString()
    sketch = ws.put(docs.mapInArrow(lambda it: sketch_batches(it, shingle), f"doc_id {key}, n long, set_id binary, keys array<long>, sig array<tinyint>"), "sketch")
    known = sketch.where(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull())
    own = known.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.min_by(F.struct("n", "keys", "sig"), "doc_id").alias("x"))
    own = ws.put(own.select("set_id", "node", "x.*"), "nodes")
    nodes = own.select("node", "set_id", "n", "sig")
    # the keys that several nodes have, in one row a node; a node that meets many others there is what they are likely copies of
    keyed = own.select("node", "set_id", F.explode(F.array_distinct("keys")).alias("key"))
    shared = ws.put(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1), "shared")
    met = keyed.join(shared.hint("merge"), "key").groupBy("node", "set_id").agg(F.collect_list("key").alias("keys"), F.sum("n").alias("weight"))
    met = ws.put(met, "met")
    sets = docs.join(met.select("node", "set_id").hint("merge"), docs["doc_id"] == F.col("node")).select("node", "set_id", "text")
    sets = sets.mapInArrow(lambda it: set_batches(it, shingle), f"node {key}, set_id binary, items array<long>")
    sets = ws.put(sets.dropDuplicates(["node", "set_id"]), "sets")
    # rows of one doc_id belong together, whatever their sets
    several = known.groupBy("doc_id").agg(F.min("set_id").alias("x"), F.max("set_id").alias("y")).where(F.col("x") != F.col("y")).select("doc_id")
    several, found = ws.counted(several, "several")
    links = None
    if found["n"]:
        links = known.join(several.hint("merge"), "doc_id").join(own.select("set_id", "node").hint("merge"), "set_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where(F.col("a") != F.col("b")).distinct()
    rest = ws.put(first_of(met.select("node", "weight", F.explode("keys").alias("key")), ws), "rest-0")
    pairs = rest.select(F.col("rep").alias("a"), F.col("rep").alias("ca"), F.col("node").alias("b"), F.col("node").alias("cb"))
    found = verified(ws.put(in_order(pairs), "pairs-0"), nodes, sets, percent)
    of = components(found if links is None else found.unionAll(links), ws, "components-0")
    for turn in (1, 2):
        open_keys, some = ws.counted(still_open(rest, of, ws, turn), f"open-{turn}")
        if not some["n"]:
            break
        if turn == 1:
            rest = ws.put(next_of(open_keys, ws), "rest-1")
            pairs = in_order(rest.where(F.col("component") != F.col("rep_component")).select(F.col("rep").alias("a"), F.col("rep_component").alias("ca"), F.col("node").alias("b"), F.col("component").alias("cb")))
        else:
            pairs = remaining_pairs(ws.put(prefixes(open_keys, sets, percent), "prefixes"), percent)
        of = merged(of, verified(ws.put(pairs, f"pairs-{turn}"), nodes, sets, percent), ws, f"components-{turn}")
    for name in ("met", "shared", "sets", "several", "prefixes", *[f"{n}-{t}" for t in range(3) for n in ("best", "labelled", "top", "rest", "open", "pairs")]):
        ws.drop(name)  # the result reads sketch, nodes and components only
    labels = own.select("set_id", "node").join(of.hint("merge"), "node", "left").select("set_id", F.coalesce("component", "node").alias("component_id"))
    # empty sets all have the same null name; they are not dealt out by it
    alone = sketch.where(F.col("set_id").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = sketch.where(F.col("set_id").isNotNull()).join(labels.hint("merge"), "set_id", "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")).unionAll(alone)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def op6_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=2)
