"""The event envelope: one append-only table for every source.

Both clocks are ISO-8601 text and compare as text, so a date alone sorts before every moment of that day: an as-of of
2026-07-30 means the start of that day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_type", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("record_time", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("payload_hash", T.StringType()),
        T.StructField("is_error_declaration", T.BooleanType()),
        T.StructField("declaration_time", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("corrective_event_ids", T.StringType()),
    ]
)
COLUMNS = tuple(ENVELOPE.fieldNames())
REPLAY_KEY = ("event_type", "entity_id", "event_time", "record_time", "payload_hash")
#: As of this moment everything is known.
FOREVER = "9999-12-31"
ISO = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"


class InvalidEvents(ValueError):
    """A batch holds events that the log must not take."""


def payload_hash(payload: Column | str) -> Column:
    """The first 16 hex digits of the payload text's SHA-256."""
    return F.substring(F.sha2(F.col(payload) if isinstance(payload, str) else payload, 256), 1, 16)


def canonical_payload(*fields: Column | str) -> Column:
    """JSON text of these columns in the order of their names, nulls included, so that equal contents are equal text."""
    named = sorted((f if isinstance(f, str) else f._jc.toString(), f) for f in fields) if not all(isinstance(f, str) for f in fields) else [(f, f) for f in sorted(fields)]
    return F.to_json(F.struct(*[F.col(f) if isinstance(f, str) else f for _, f in named]), {"ignoreNullFields": "false"})


def event_id() -> Column:
    """From the replay key, which idempotent appends keep unique; so a retried task makes the same id."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in REPLAY_KEY]), 256)


def faults(events: DataFrame) -> DataFrame:
    """The events with a missing id, entity, source or type, or with a clock that isn't ISO text, and why."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in ("entity_id", "source", "event_type", "payload") if c in events.columns]
    checks += [F.when(F.coalesce(~F.col(c).rlike(ISO), F.lit(True)), F.lit(f"{c} is not ISO")) for c in ("event_time", "record_time") if c in events.columns]
    return events.withColumn("fault", F.concat_ws("; ", *checks)).where(F.col("fault") != "")


def validated(events: DataFrame) -> DataFrame:
    """events, whose evaluation fails at the first faulty one; nothing is counted or collected for that."""
    clocks = [F.coalesce(F.col(c).rlike(ISO), F.lit(False)) for c in ("event_time", "record_time")]
    present = [F.col(c).isNotNull() for c in ("entity_id", "source", "event_type", "payload")]
    ok = present[0]
    for c in (*present[1:], *clocks):
        ok = ok & c
    checked = F.when(ok, F.col("entity_id")).otherwise(F.raise_error(F.concat(F.lit("event not fit for the log, entity "), F.coalesce("entity_id", F.lit("null")), F.lit(", record_time "), F.coalesce("record_time", F.lit("null")))))
    return events.withColumn("entity_id", checked)


def with_defaults(events: DataFrame) -> DataFrame:
    """Fills what an observation needn't say: hash, id, and the columns of declarations."""
    out = events.withColumn("payload_hash", payload_hash("payload")) if "payload_hash" not in events.columns else events
    out = out.withColumn("event_id", F.coalesce("event_id", event_id()) if "event_id" in out.columns else event_id())
    out = out.withColumn("is_error_declaration", F.lit(False))
    return out.withColumns({"declaration_time": F.lit(None).cast("string"), "reason": F.lit(None).cast("string"), "corrective_event_ids": F.lit("[]")})
