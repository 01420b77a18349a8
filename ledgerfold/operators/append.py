"""Idempotent appends and error declarations.

An observation is a no-op when its replay key is in the log, or when its payload equals that of the observation just
before it.  "Before" is by record_time among what the log shows and the batch (mode "record"): replaying anything at any
time then adds nothing, also after a restart.  In mode "arrival" it is by order of arrival: the log's last observation,
then the batch's own.  A revert (A, B, A) is a change and is appended.

One moment's observations in a batch are in order of event_time, hash and type, so that reruns agree; so are those of
the log that the batch brings again, as they were when they were appended.  What else the log has of that moment goes before
them, by seq.

Known limits of a log of changes under late backfill: an interval split by a late change keeps a redundant row, and an
observation left out as unchanged is lost if a change before it arrives later, until it is observed again.  Where an entity
has several observations at one moment, a replay of a part (not all of them, or only what follows them) can append what was
left out as unchanged: the log alone doesn't tell that from a revert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.envelope import COLUMNS, REPLAY_KEY, InvalidEvents, validated, with_defaults
from ledgerfold.operators.folds import rescinded
from ledgerfold.storage import Workspace


ORDER = ("entity_id", "event_type", "payload_hash", "event_time")


def sequenced(events: DataFrame, base: int, order: tuple[str, ...] = ORDER) -> DataFrame:
    """events with seq = base, base + 1, ... by record_time and order.

    The events are dealt out by range of (record_time, order), so that any one moment is as many tasks as it needs, and
    written so, each with its place in its task; a task's first number is the sum of the counts of those before it.
    """
    ws, order = Workspace(events.sparkSession, "sequenced"), ("record_time", *order)
    events = events.drop("seq")
    placed = events.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__task": F.spark_partition_id(), "__nth": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    placed = ws.put(placed, "placed")
    counts = placed.groupBy("__task").agg(F.count("*").alias("__n"))
    # one row a task of the write above
    first = counts.select("__task", (F.sum("__n").over(Window.orderBy("__task")) - F.col("__n")).alias("__first"))
    return placed.join(F.broadcast(first), "__task").withColumn("seq", F.lit(base) + F.col("__first") + F.col("__nth")).drop("__task", "__nth", "__first")


def between(log: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """The part of the log that was recorded on these days, by its partitions where it has any."""
    if "record_date" not in log.columns or first is None or last is None:
        return log
    return log.where(F.col("record_date").between(first[:10], last[:10]))


def not_replayed(batch: DataFrame, log: DataFrame) -> DataFrame:
    """The batch without what the log has under the same replay key."""
    known = log.where(~F.col("is_error_declaration")).select(*REPLAY_KEY)
    return batch.dropDuplicates(list(REPLAY_KEY)).join(known, list(REPLAY_KEY), "left_anti")


def changes(batch: DataFrame, log: DataFrame, mode: str = "record", last: str | None = None, whole: DataFrame | None = None) -> DataFrame:
    """The batch's observations whose payload differs from the one before them.  last: the batch's last moment, if known;
    in mode "record" no observation of a later day is read.  whole: the batch with what of it the log has already."""
    if mode not in ("record", "arrival"):
        raise ValueError(f"mode is record or arrival, not {mode}")
    touched = batch.select("entity_id").distinct()
    told = between(log, "0000-00-00", last) if mode == "record" else log
    known = told.where(~F.col("is_error_declaration")).join(rescinded(log), "event_id", "left_anti").join(touched, "entity_id", "left_semi").select("entity_id", "event_type", "event_time", "record_time", "payload_hash", "seq", F.lit(0).alias("__new"))
    known = known.withColumn("__own", F.lit(0))
    if mode == "record" and whole is not None and "seq" not in batch.columns:
        again = whole.select(*REPLAY_KEY).distinct().withColumn("__again", F.lit(1))
        known = known.join(again, list(REPLAY_KEY), "left").withColumn("__own", F.coalesce("__again", F.lit(0))).drop("__again")
    fresh = batch.withColumns({"__new": F.lit(1), "__own": F.lit(1)})
    both = fresh.unionByName(known, allowMissingColumns=True)
    if mode == "record":
        clock = ["record_time", "__own", F.when((F.col("__own") == 0) | (F.col("__new") == 1), F.col("seq"))]
    else:
        clock = ["__new", F.when(F.col("__new") == 1, F.col("record_time")), "seq", "record_time"]
    before = Window.partitionBy("entity_id").orderBy(*clock, "event_time", "payload_hash", "__new", "event_type")
    out = both.withColumn("__before", F.lag("payload_hash").over(before)).where((F.col("__new") == 1) & ~F.col("payload_hash").eqNullSafe(F.col("__before")))
    return out.drop("__new", "__own", "__before", *([] if "seq" in batch.columns else ["seq"]))


def append(log: DataFrame, batch: DataFrame, mode: str = "record", top: int | None = None) -> DataFrame:
    """The envelope rows that batch adds to log.

    batch: event_type, source, entity_id, event_time, record_time, payload, and event_id if it has its own.
    top: the log's highest seq, if it is known (-1: the log is empty); else the log is asked.

    Of a log that is partitioned by record_date, replay keys are read for the batch's days only, and in mode "record"
    nothing is read that was recorded after the batch's last day.
    """
    ready = with_defaults(validated(batch))
    days = batch.agg(F.min("record_time"), F.max("record_time")).first() if "record_date" in log.columns else (None, None)
    fresh = not_replayed(ready, between(log, *days))
    fresh = changes(fresh, log, mode, days[1], ready)
    if top is None:
        top = log.agg(F.max("seq")).first()[0]
    return sequenced(fresh, 0 if top is None else top + 1).select(*COLUMNS)


def declare_errors(log: DataFrame, declarations: DataFrame) -> DataFrame:
    """The envelope rows that rescind events.  declarations: event_id, declaration_time, reason, corrective_event_ids
    (array of text, pointing forward to replacements).

    A declaration repeats its event under the same id.  Unknown ids and second declarations are refused.
    """
    asked = declarations.select("event_id", F.col("declaration_time").alias("__at"), F.col("reason").alias("__why"), F.to_json(F.coalesce("corrective_event_ids", F.array().cast("array<string>"))).alias("__next"))
    state = log.join(F.broadcast(asked.select("event_id").distinct()) if _small(asked) else asked.select("event_id").distinct(), "event_id", "left_semi").groupBy("event_id").agg(F.max((~F.col("is_error_declaration")).cast("int")).alias("there"), F.max(F.col("is_error_declaration").cast("int")).alias("declared"))
    checked = asked.join(state, "event_id", "left").agg(F.count_if(F.coalesce("there", F.lit(0)) == 0).alias("unknown"), F.count_if(F.col("declared") == 1).alias("twice"), F.count("*").alias("n"), F.count_distinct("event_id").alias("ids")).first()
    if checked["unknown"]:
        raise InvalidEvents(f"{checked['unknown']} declarations name an event that the log doesn't have")
    if checked["twice"] or checked["n"] != checked["ids"]:
        raise InvalidEvents("an event can be declared an error once")
    top = log.agg(F.max("seq")).first()[0] or 0
    rows = log.where(~F.col("is_error_declaration")).join(asked, "event_id")
    rows = rows.withColumns({"record_time": F.col("__at"), "declaration_time": F.col("__at"), "reason": F.col("__why"), "corrective_event_ids": F.col("__next"), "is_error_declaration": F.lit(True)})
    return sequenced(rows.drop("seq"), top + 1, ("event_id",)).select(*COLUMNS)


def _small(df: DataFrame, rows: int = 10_000) -> bool:
    """Whether a frame has at most so many rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows
