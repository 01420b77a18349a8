"""The registered sources.  A source is one row here and a mapping to observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "source string, lane string, event_type string, natural_key string, cadence string, has_native_history boolean"
# The sources and what they are called in the log.
SOURCES = [
    ("alfred", "vintage_replay", "series_value_observed", "series:observation_date", "on_release", True),
    ("openfda", "snapshot_hash_diff", "fda_shortage_observed|fda_recall_observed", "shortage_fingerprint|recall_number", "daily", False),
    ("imf_imts", "mirror_reconciliation", "trade_mirror_observed", "pair:year", "monthly", False),
    ("pharma_synthetic", "epcis_movement_stream", "epcis_commission|epcis_aggregate|epcis_ship|epcis_receive", "lot:ndc:lot_no", "on_demand", True),
    ("usitc_hts", "effective_dated_reference", "duty_rate_observed", "hts_code", "on_revision", True),
    ("gscpi", "snapshot_hash_diff", "index_value_observed", "series:observation_date", "monthly", False),
]


def registry(spark: SparkSession, rows: list[tuple] = SOURCES) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def write_seed(spark: SparkSession, path: str) -> None:
    registry(spark).coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).csv(path, header=True)
