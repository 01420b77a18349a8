"""Files to tables.  Schemas are given, never inferred, where the format has a fixed one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerfold.envelope import COLUMNS, ENVELOPE
from ledgerfold.functions.fingerprint import is_ole
from ledgerfold.functions.normalize import month_start
from ledgerfold.storage import exists

TARIFF_LINES = "array<struct<htsno:string,indent:string,description:string,general:string,special:string,other:string,units:array<string>>>"
SDMX = """struct<data:struct<dataSets:array<struct<series:map<string,struct<observations:map<string,array<string>>>>>>,
structures:array<struct<dimensions:struct<observation:array<struct<id:string,values:array<struct<value:string>>>>>>>>>"""


# Fixed value: the sheet of the published index.
INDEX_SHEET = "GSCPI Monthly Data"


class EmptySource(ValueError):
    """A source answered, but with nothing in it: an error, never an empty table."""


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The event log; where there is none yet, an empty one.  Partition columns stay, for pruning."""
    if not exists(spark, path):
        return spark.createDataFrame([], ENVELOPE)
    return spark.read.schema(f"{ENVELOPE.simpleString()[7:-1].replace(':', ' ').replace(',', ', ')}, record_date string").parquet(path)


def write_log(events: DataFrame, path: str) -> None:
    """Appends; nothing in the log is ever rewritten.  Files are clustered by the columns that queries prune by: small
    days share a task, and a source's large day is split over as many as its size asks for.  The batch's highest seq is
    noted beside the log, under a name that readers of the log pass over."""
    dated = events.select(*COLUMNS).withColumn("record_date", F.substring("record_time", 1, 10))
    seen = Observation()
    dated = dated.hint("rebalance", "source", "record_date").observe(seen, F.max("seq").alias("top"))
    dated.write.mode("append").partitionBy("source", "record_date").parquet(path)
    top = seen.get.get("top")
    if top is not None:
        events.sparkSession.createDataFrame([(top,)], "top long").coalesce(1).write.mode("append").parquet(f"{path}/_tops")


def top_seq(spark: SparkSession, path: str) -> int | None:
    """The highest seq of a log: -1 if there is no log, None if nothing was noted of it."""
    if not exists(spark, path):
        return -1
    return spark.read.schema("top long").parquet(f"{path}/_tops").agg(F.max("top")).first()[0] if exists(spark, f"{path}/_tops") else None


def read_jsonl_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE).json(path) if exists(spark, path) else spark.createDataFrame([], ENVELOPE)


def write_jsonl_log(events: DataFrame, path: str) -> None:
    """An export; the log itself is Parquet."""
    events.select(*COLUMNS).write.mode("overwrite").json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The records of a document {meta, results: [...]}, with their position."""
    whole = spark.read.option("multiLine", True).json(path)
    if "results" not in whole.columns:
        raise EmptySource(f"no results in {path}")
    return whole.select(F.posexplode("results").alias("position", "r")).select("position", "r.*")


def read_vintages(spark: SparkSession, path: str) -> DataFrame:
    """One row per observation date, one column per vintage the document has."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("observations").alias("o")).select("o.*")


def parse_sdmx(documents: DataFrame, content: str = "value") -> DataFrame:
    """period, value of an SDMX-JSON cube.  Observations are keyed by the position of their period; the first of each
    array is the value.  A document without series raises when it is read."""
    d = documents.select(F.from_json(content, SDMX).alias("d"))
    series = F.coalesce(F.get("d.data.dataSets", F.lit(0))["series"], F.create_map().cast("map<string,struct<observations:map<string,array<string>>>>"))
    ok = F.when(F.size(series) > 0, series).otherwise(F.raise_error(F.lit("the source answered with zero series: check the order of dimensions")))
    periods = F.transform(F.get(F.get("d.data.structures", F.lit(0))["dimensions"]["observation"], F.lit(0))["values"], lambda v: v["value"])
    rows = d.select(periods.alias("periods"), F.explode(ok).alias("key", "s")).select("periods", F.explode("s.observations").alias("i", "cell"))
    return rows.select(F.get("periods", F.col("i").cast("int")).alias("period"), F.get("cell", F.lit(0)).cast("double").alias("value")).where(F.col("value").isNotNull())


def read_sdmx(spark: SparkSession, path: str) -> DataFrame:
    return parse_sdmx(spark.read.text(path, wholetext=True))


def read_revisions(spark: SparkSession, index: str, folder: str) -> DataFrame:
    """effective_from, label, code, description, general_rate_raw of every line of the revisions an index names."""
    named = spark.read.option("multiLine", True).json(index).select(F.explode("revisions").alias("r")).select("r.effective_from", "r.label", "r.file")
    files = [f"{folder}/{r['file']}" for r in named.select("file").collect()]  # the index: one row a revision
    text = spark.read.text(files, wholetext=True).withColumn("file", F.substring_index(F.col("_metadata.file_path"), f"/{folder.rstrip('/').rsplit('/', 1)[-1]}/", -1))
    lines = text.select("file", F.explode(F.coalesce(F.from_json("value", TARIFF_LINES), F.from_json(F.get_json_object("value", "$.lines"), TARIFF_LINES), F.from_json(F.get_json_object("value", "$.results"), TARIFF_LINES))).alias("l"))
    return lines.join(F.broadcast(named), "file").select("effective_from", "label", F.col("l.htsno").alias("code"), F.col("l.description").alias("description"), F.col("l.general").alias("general_rate_raw"))


def read_index_series(spark: SparkSession, path: str, sheet: str | int = INDEX_SHEET) -> DataFrame:
    """period (first of the month), value from a two-column table, by position; rows without a date or a number go.

    Parquet and CSV are read by Spark.  Workbooks are for pandas, if it has a reader for the kind that their first bytes
    tell (they are a few hundred rows); the sheet is read by its name, or by its place where it has no sheet of that name.
    """
    if path.endswith(".parquet"):
        raw = spark.read.parquet(path)
    elif path.endswith(".csv"):
        raw = spark.read.csv(path, header=True)
    else:
        raw = _read_workbook(spark, path, sheet)
    return index_series(raw)


def index_series(raw: DataFrame) -> DataFrame:
    period, value = raw.columns[:2]
    rows = raw.select(month_start(F.col(period).cast("string")).alias("period"), F.round(F.col(value).try_cast("double"), 6).alias("value"))
    return rows.where(F.col("value").isNotNull() & F.col("period").isNotNull())


def _read_workbook(spark: SparkSession, path: str, sheet: str | int) -> DataFrame:
    import io

    import pandas as pd

    file = spark.read.format("binaryFile").load(path).select("content", is_ole(F.col("content")).alias("ole")).first()
    book = pd.ExcelFile(io.BytesIO(bytes(file["content"])), engine="xlrd" if file["ole"] else "openpyxl")
    table = book.parse(sheet if sheet in book.sheet_names else 0).iloc[:, :2].dropna()
    table.columns = ["period", "value"]
    return spark.createDataFrame(table.astype({"period": str, "value": float}))
