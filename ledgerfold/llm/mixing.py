"""Operator 1: mixing sources to target weights by systematic sampling.

Per source, documents stand in an order of (size class, salt, size, id); with e expected copies each, document k is
emitted once for each integer between (k-1)*e + u and k*e + u, u being the one random offset.  The order makes
neighbours alike in size, so the words taken follow the target closely.

Ranks come from a two-level prefix sum: a window over (source, size class, salt), never a whole source, plus the
counts of the groups before it.  A source of a third of all rows is so spread over many tasks.

Null text has size 0; null sources are a source of their own, ordered last.  Rows that repeat are documents of their
own.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, fields

CYCLE = (3, 1, 2)
OFFSET_STEPS = 1 << 20


#: What words end at, as in WORD.
BLANKS = r"\x20\x09-\x0D"


def words(text: Column) -> Column:
    """The number of words, without a list of them: that is many times the text.  Each word with the blanks after it
    becomes one letter."""
    return F.length(F.regexp_replace(F.ltrim(text, F.lit(" \t\n\x0b\x0c\r")), f"[^{BLANKS}]++[{BLANKS}]*+", "x")).cast("long")


def size_class(size: Column) -> Column:
    """Integers that grow with the size: the number of its bits and its four leading ones (steps of 7 to 12 %)."""
    bits = F.length(F.bin(size + 1))
    lead = F.call_function("shiftright", size + 1, F.greatest(bits - 4, F.lit(0)))
    return (bits * 16 + lead).cast("int")


def targets(totals: DataFrame, cycle: tuple[int, ...] = CYCLE, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target): share of all sizes by weight, none above most times its own.

    Sources fill up in the order of their limit over their weight, so those at their limit are a prefix of that order
    and the level of the rest follows from running sums.  One row per source is all that meets here.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), ((F.row_number().over(by_name) - 1) % len(cycle)).cast("int") + 1)
    by_limit = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    out = totals.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    out = out.withColumn("ratio", F.col("limit") / F.col("weight")).withColumn("level", level)
    # the first source that its level doesn't fill fixes the level of all after it
    out = out.withColumn("open", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
    return out.select("source", "source_size", F.least("limit", F.coalesce(F.col("open") * F.col("weight"), F.col("limit"))).alias("target"))


def mix(docs: DataFrame, cycle: tuple[int, ...] = CYCLE, share: float = 1.5, most: float = 2.0, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (times the mix emits the document), taken."""
    ws = Workspace(docs.sparkSession, "mixing")
    size = F.coalesce(words(F.col("text")), F.lit(0).cast("long"))
    sized = ws.put(fields(docs, "doc_id", "source", "text").select("doc_id", "source", size.alias("size")), "sized")
    sized = sized.withColumn("class", size_class(F.col("size"))).withColumn("salt", F.coalesce(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 2), F.lit("")))
    groups = sized.groupBy("source", "class", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    ordered = Window.partitionBy("source").orderBy("class", "salt").rowsBetween(Window.unboundedPreceding, -1)
    first = groups.withColumn("first", F.coalesce(F.sum("n").over(ordered), F.lit(0)))
    goal = targets(groups.groupBy("source").agg(F.sum("words").alias("source_size")), cycle, share, most)
    first = first.alias("a").join(goal.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.source", "class", "salt", "first", "source_size", "target")
    first = ws.put(first, "groups")  # one row per source, size class and salt
    within = Window.partitionBy("source", "class", "salt").orderBy("size", "doc_id")
    ranked = sized.withColumn("nth", F.row_number().over(within))
    # grows with the corpus, so it is never broadcast
    rows = ranked.alias("a").join(first.hint("merge").alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.class") == F.col("b.class")) & (F.col("a.salt") == F.col("b.salt")))
    rows = rows.select("doc_id", "a.source", "size", "source_size", "target", (F.col("first") + F.col("nth")).alias("k"))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = offset(seed)
    return rows.withColumn("copies", (F.floor(F.col("k") * each + u) - F.floor((F.col("k") - 1) * each + u)).cast("long")).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def offset(seed: int) -> float:
    """In [0, 1), of few bits, so that sums with whole numbers are exact."""
    from .kernels import constants

    return int(constants(1, seed)[0] >> 44) / OFFSET_STEPS


def op1_mix(spark, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def mix_sql(documents: str = "documents", seed: int = 17) -> str:
    """What op1_mix returns, as DuckDB SQL over the whole table."""
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM {documents}),
classed AS (
  SELECT *, length(bin(size + 1)) * 16 + ((size + 1) >> greatest(length(bin(size + 1)) - 4, 0)::BIGINT) AS class,
         coalesce(substr(md5(doc_id::VARCHAR), 1, 2), '') AS salt FROM sized),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, salt, size, doc_id NULLS FIRST) AS k FROM classed),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS cap FROM named),
levelled AS (
  SELECT *, cap / weight AS ratio,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, ratio) FROM levelled WHERE ratio > level) * weight, cap)) AS target FROM levelled)
SELECT doc_id, size, g.source_size, g.target,
       (floor(k * (CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END) + {offset(seed)!r}::DOUBLE)
        - floor((k - 1) * (CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END) + {offset(seed)!r}::DOUBLE))::BIGINT * size AS taken
FROM ranked r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source"""
