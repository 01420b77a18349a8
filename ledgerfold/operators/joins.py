"""Joins that SQL engines lack a word for: as-of and interval lookups, and the comparison of two results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str], strict: bool = False) -> DataFrame:
    """Each left row with `values` of the last right row of the same key whose time is not after (strict: before) its own.

    Both sides are laid in one order and the last value is carried on, so there is one shuffle, and no left row meets
    more than one right row.  Rows without a match have nulls.  Of right rows with equal times the last by values counts.
    """
    a = left.withColumns({"__t": F.col(left_time), "__side": F.lit(0 if strict else 1)})
    b = right.select(*on, F.col(right_time).alias("__t"), F.lit(1 if strict else 0).alias("__side"), F.struct(*values).alias("__r")).where(F.col("__t").isNotNull())
    both = a.unionByName(b, allowMissingColumns=True)
    order = Window.partitionBy(*on).orderBy("__t", "__side", F.col("__r").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("__last", F.last("__r", ignorenulls=True).over(order)).where(F.col("__side") == (0 if strict else 1))
    keep = [c for c in left.columns if c not in values]
    return carried.select(*keep, *[F.col(f"__last.{v}").alias(v) for v in values])


def interval_join(left: DataFrame, right: DataFrame, on: list[str], time: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Each left row with the right row of the same key in whose [start, end) its time lies (end null: open)."""
    pairs = reduce(lambda x, y: x & y, [left[c] == right[c] for c in on])
    within = (left[time] >= right[start]) & (right[end].isNull() | (left[time] < right[end]))
    drop = [right[c] for c in on]
    out = left.join(right, pairs & within, "left")
    for c in drop:
        out = out.drop(c)
    return out


def last_revision(revisions: DataFrame, on: str, as_of: str) -> DataFrame:
    """The rows of the revision in force on a day: the last whose effective_from is not after it."""
    last = revisions.where(F.col("effective_from") <= F.lit(as_of)).agg(F.max("effective_from").alias("__last"))
    return revisions.join(F.broadcast(last), revisions["effective_from"] == last["__last"]).drop("__last").select(on, *[c for c in revisions.columns if c != on])  # one row


def with_label(rows: DataFrame, revisions: DataFrame, time: str, label: str = "label") -> DataFrame:
    """rows with the label of the revision that took effect at their time, null where none did; revisions: effective_from,
    label.  The label is no part of what is observed, and this gets it back."""
    named = revisions.select(F.col("effective_from").alias("__from"), F.col("label").alias(label)).dropDuplicates(["__from"])
    return rows.join(named, rows[time] == named["__from"], "left").drop("__from")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one that the other lacks, with side "left" or "right"; copies count."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionAll(b.exceptAll(a).withColumn("side", F.lit("right")))
