"""Structured Streaming.  Nothing late is dropped from the log: lateness is what record_time after event_time says.
Watermarks bound the state of duplicate removal only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ledgerfold.storage import exists, scope

STATE = ("entity_id", "record_time", "seq", "payload_hash")
CHANGED = "entity_id string, record_time string, seq long, payload_hash string"


def current_state(events: DataFrame) -> DataFrame:
    """The last event of each entity, for update or complete mode.  A stream can't be joined with its own declarations,
    so it holds declarations as well: is_error_declaration tells where the last word was one."""
    last = F.max_by(F.struct("event_id", "event_type", "payload", "record_time", "seq", "is_error_declaration"), F.struct("record_time", "seq"))
    return events.groupBy("entity_id").agg(last.alias("last")).select("entity_id", "last.*")


def changes(batch: DataFrame, known: DataFrame) -> DataFrame:
    """The batch's observations whose payload differs from the entity's one before by (record_time, seq), among those
    known and the batch's own; so a late one is compared with what it follows, not with what came last."""
    touched = batch.select("entity_id").distinct()
    rows = batch.select(*STATE, F.lit(True).alias("new")).unionAll(known.select(*STATE, F.lit(False).alias("new")).join(touched, "entity_id", "left_semi"))
    before = F.lag("payload_hash").over(Window.partitionBy("entity_id").orderBy("record_time", "seq", "new"))
    return rows.withColumn("before", before).where(F.col("new") & ~F.col("payload_hash").eqNullSafe(F.col("before"))).select(*STATE)


def run_changes(events: DataFrame, root: str) -> DataFrame:
    """Runs change detection over all input there is and returns the table of changes, which is also its state: each
    micro-batch is compared with the changes written before it, and overwrites what a failed attempt has written."""
    spark, table = events.sparkSession, f"{root}/changes"
    read = lambda: spark.read.schema(f"{CHANGED}, batch long").parquet(table) if exists(spark, table) else spark.createDataFrame([], f"{CHANGED}, batch long")

    def write(batch: DataFrame, n: int) -> None:
        changes(batch, read().where(F.col("batch") < n)).write.mode("overwrite").parquet(f"{table}/batch={n}")

    query = events.select(*STATE).writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return read().drop("batch")


def deduplicated(events: DataFrame, clock: str = "ts", within: str = "2 days") -> DataFrame:
    """Events once by event_id, however often they are delivered within the time given."""
    return events.withColumn(clock, F.col(clock).cast("timestamp")).withWatermark(clock, within).dropDuplicatesWithinWatermark(["event_id"])


def append_to_log(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends each micro-batch to the log once: what a failed attempt has written of it already is not written again."""
    from ledgerfold.operators.append import append
    from ledgerfold.sources.files import read_log, top_seq, write_log

    def write(batch: DataFrame, _: int) -> None:
        with scope():
            write_log(append(read_log(batch.sparkSession, path), batch, top=top_seq(batch.sparkSession, path)), path)

    return events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(df: DataFrame, mode: str, root: str) -> DataFrame:
    """Runs a query over all input there is and returns the table it wrote: in mode "append" all micro-batches, else the
    last one's state.  A micro-batch that is run again overwrites what it had written."""
    spark, done = df.sparkSession, []

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/table/batch={n}")
        done.append(n)

    query = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    if not done:
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(*[f"{root}/table/batch={n}" for n in (sorted(set(done)) if mode == "append" else done[-1:])])
