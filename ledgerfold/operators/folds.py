"""Folds: the state of every entity as believed at a moment, its versions, and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.envelope import FOREVER


def known_by(log: DataFrame, as_of: str) -> DataFrame:
    """What was recorded by then.  A log partitioned by record_date is pruned by it as well."""
    out = log.where(F.col("record_time") <= F.lit(as_of))
    return out.where(F.col("record_date") <= F.lit(as_of[:10])) if "record_date" in log.columns else out


def rescinded(log: DataFrame, as_of: str = FOREVER) -> DataFrame:
    """event_id of the events declared errors by then."""
    return known_by(log, as_of).where("is_error_declaration").select("event_id").distinct()


def visible(log: DataFrame, as_of: str = FOREVER) -> DataFrame:
    """Events recorded by then and not declared errors by then: the moment is applied first, so that before its
    declaration a wrong event is what was believed."""
    events = known_by(log, as_of).where(~F.col("is_error_declaration"))
    return events.join(rescinded(log, as_of), "event_id", "left_anti")


def fold_state(log: DataFrame, as_of: str = FOREVER) -> DataFrame:
    """The latest visible event of each entity by (record_time, seq).

    Spark limits each task's rows to one an entity before they are dealt out (WindowGroupLimit), so an entity with very
    many events doesn't gather in one task.
    """
    latest = Window.partitionBy("entity_id").orderBy(F.col("record_time").desc(), F.col("seq").desc())
    return visible(log, as_of).withColumn("__nth", F.row_number().over(latest)).where("__nth = 1").drop("__nth")


def fold_state_max_by(log: DataFrame, as_of: str = FOREVER) -> DataFrame:
    """The same by aggregation, which also runs on streams."""
    events = visible(log, as_of)
    last = F.max_by(F.struct(*[c for c in events.columns if c != "entity_id"]), F.struct("record_time", "seq"))
    return events.groupBy("entity_id").agg(last.alias("__last")).select("entity_id", "__last.*").select(*events.columns)


def history(log: DataFrame, include_rescinded: bool = True) -> DataFrame:
    """Every version with the interval [valid_from, valid_to) in which it was the last recorded one."""
    events = log.where(~F.col("is_error_declaration")) if include_rescinded else visible(log)
    later = Window.partitionBy("entity_id").orderBy("record_time", "seq")
    return events.select("entity_id", "source", "event_type", "event_time", F.col("record_time").alias("valid_from"), F.lead("record_time").over(later).alias("valid_to"), "payload", "payload_hash", "seq")


def aggregates(log: DataFrame) -> DataFrame:
    """Counts and first and last record of each source and event type."""
    events = log.where(~F.col("is_error_declaration"))
    return events.groupBy("source", "event_type").agg(F.count("*").alias("events"), F.count_distinct("entity_id").alias("entities"), F.min("record_time").alias("first_record"), F.max("record_time").alias("last_record"))


def source_event_counts(log: DataFrame, registry: DataFrame) -> DataFrame:
    """Events and entities of every registered source, also of those without any: one pass over the log for all."""
    counted = log.where(~F.col("is_error_declaration")).groupBy("source").agg(F.count("*").alias("events"), F.count_distinct("entity_id").alias("entities"))
    return registry.select("source").join(counted, "source", "left").select("source", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("entities", F.lit(0)).alias("entities"))


def belief_changes(log: DataFrame, then: str, now: str = FOREVER) -> DataFrame:
    """entity_id and the hash and time of what was believed then and now, where these differ."""
    side = lambda t, n: fold_state(log, t).select("entity_id", F.col("payload_hash").alias(f"{n}_hash"), F.col("record_time").alias(f"{n}_record_time"))
    both = side(then, "then").join(side(now, "now"), "entity_id", "full_outer")
    return both.where(~F.col("then_hash").eqNullSafe(F.col("now_hash")))


def field(path: str, kind: str = "string") -> Column:
    """A field of the payload; numbers are cast at once, as their text differs between engines."""
    return F.get_json_object("payload", f"$.{path}").cast(kind)
