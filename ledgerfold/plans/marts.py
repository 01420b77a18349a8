"""Marts: typed views of the state of one kind of event.  Each filters by event type or source before its fold, which
gives the same rows, as entities are of one type, and reads less."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.envelope import FOREVER
from ledgerfold.operators.folds import field, fold_state, history

PHARMA = "pharma_synthetic"
LEAVES = ("seq", "entity_id", "event_type", "source", "event_time", "record_time", "payload")


def _state(log: DataFrame, event_type: str, as_of: str = FOREVER) -> DataFrame:
    return fold_state(log.where(F.col("event_type") == event_type), as_of)


def shortage_current(log: DataFrame) -> DataFrame:
    names = ("generic_name", "company_name", "status", "availability", "update_date")
    return _state(log, "fda_shortage_observed").select("entity_id", *[field(n).alias(n) for n in names], F.col("record_time").alias("observed_at"))


def index_series(log: DataFrame) -> DataFrame:
    return _state(log, "index_value_observed").select(field("observation_date").alias("period"), field("value", "double").alias("gscpi"), F.col("record_time").alias("observed_at")).orderBy(F.col("period").asc_nulls_last())


def duty_rates(log: DataFrame, as_of: str | None = None) -> DataFrame:
    """The schedule in force: now, or as it stood on a day, which is then a column."""
    out = _state(log, "duty_rate_observed", as_of or FOREVER).select(
        *[field(n).alias(n) for n in ("hts_code", "description", "general_rate_raw")], field("ad_valorem_rate", "double").alias("ad_valorem_rate"), field("rate_kind").alias("rate_kind"), F.col("event_time").alias("effective_from")
    )
    return (out.withColumn("as_of", F.lit(as_of)) if as_of else out).orderBy(F.col("hts_code").asc_nulls_last())


def trade_asymmetry(log: DataFrame) -> DataFrame:
    numbers = {"importer_reported_cif_usd": "importer_cif_usd", "exporter_reported_fob_usd": "exporter_fob_usd", "gap_usd": "gap_usd", "gap_pct": "gap_pct", "valuation_component_usd": "valuation_component_usd", "residual_attribution_usd": "residual_attribution_usd"}
    return _state(log, "trade_mirror_observed").select(field("pair").alias("pair"), field("year").alias("year"), *[field(k, "double").alias(v) for k, v in numbers.items()], field("within_tolerance").alias("within_tolerance")).orderBy(F.col("pair").asc_nulls_last(), F.col("year").asc_nulls_last())


def reconciliation_report(asymmetry: DataFrame) -> DataFrame:
    """Pairs by how much of their gap nothing explains."""
    share = F.round(100.0 * F.col("residual_attribution_usd") / F.nullif(F.col("gap_usd"), F.lit(0.0)), 1)
    ranked = asymmetry.orderBy(F.abs("residual_attribution_usd").desc_nulls_last())
    return ranked.select("pair", "year", "gap_usd", "gap_pct", F.col("valuation_component_usd").alias("explained_valuation_usd"), F.col("residual_attribution_usd").alias("residual_usd"), share.alias("residual_share_pct"))


def lot_location(log: DataFrame, source: str = PHARMA) -> DataFrame:
    return fold_state(log.where(F.col("source") == source)).select(F.col("entity_id").alias("lot"), field("ndc").alias("ndc"), field("holder_after").alias("holder"), F.col("event_type").alias("last_event"), "event_time", "record_time")


def chain_of_custody(log: DataFrame, source: str = PHARMA) -> DataFrame:
    """Every handoff and how long it held."""
    rows = history(log.where(F.col("source") == source)).orderBy("entity_id", "valid_from", "seq")
    return rows.select(F.col("entity_id").alias("lot"), field("ndc").alias("ndc"), "event_type", field("site").alias("site"), field("to").alias("shipped_to"), "event_time", "valid_from", "valid_to")
