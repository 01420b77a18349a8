"""Assertions about tables.  Each gives its violations as rows; none means it holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.sources.registry import SOURCES

NO_RATE = ("specific", "compound", "unparsed")
RATE = ("ad_valorem", "free")


def not_unique(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values) -> DataFrame:
    """Null passes."""
    return df.where(~F.col(column).isin(list(values)))


def reused_ids(log: DataFrame) -> DataFrame:
    """An event id occurs twice only through its declaration."""
    counts = log.groupBy("event_id").agg(F.count("*").alias("n"), F.sum(F.when(F.col("is_error_declaration"), 1).otherwise(0)).alias("decls"))
    return counts.where((F.col("n") > 2) | ((F.col("n") == 2) & (F.col("decls") == 0)))


def gap_not_explained(asymmetry: DataFrame, within: float = 1.0) -> DataFrame:
    return asymmetry.where(F.col("valuation_component_usd").isNotNull() & (F.abs(F.col("valuation_component_usd") + F.col("residual_attribution_usd") - F.col("gap_usd")) > within))


def rate_without_kind(rates: DataFrame) -> DataFrame:
    """A rate is a number exactly where its kind says so."""
    lost = F.col("rate_kind").isin(list(RATE)) & F.col("ad_valorem_rate").isNull()
    made_up = F.col("rate_kind").isin(list(NO_RATE)) & F.col("ad_valorem_rate").isNotNull()
    return rates.select("hts_code", "rate_kind", "ad_valorem_rate").where(lost | made_up)


def inverted_intervals(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("valid_to") < F.col("valid_from"))


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """check, violations: one row each."""
    each = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in checks.items()]
    return reduce(DataFrame.unionAll, each)


def counted(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """check, violations of conditions on single rows: one pass over the table for all of them."""
    one = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks.values())])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(checks)])).alias("c")).select("c.*")


def log_summary(log: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """check, violations of log_checks: those on single rows in one pass, those on keys in one each."""
    each, names = log_checks(log, sources), sources or [s[0] for s in SOURCES]
    rows = {f"{c}_not_null": F.col(c).isNull() for c in ("seq", "entity_id", "record_time", "source")} | {"source_accepted": ~F.col("source").isin(names)}
    return counted(log, rows).unionAll(summary({n: each[n] for n in each if n not in rows}))


def log_checks(log: DataFrame, sources: list[str] | None = None) -> dict[str, DataFrame]:
    names = sources or [s[0] for s in SOURCES]
    return {
        "seq_unique": not_unique(log, "seq"),
        **{f"{c}_not_null": is_null(log, c) for c in ("seq", "entity_id", "record_time", "source")},
        "source_accepted": not_accepted(log, "source", names),
        "event_id_reuse": reused_ids(log),
    }


def model_checks(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Of the models by name: current_state, history, duty_rate_current, duty_rate_as_of, trade_asymmetry."""
    state, rates, then = tables["current_state"], tables["duty_rate_current"], tables["duty_rate_as_of"]
    return {
        "current_state_entity_unique": not_unique(state, "entity_id"),
        "current_state_entity_not_null": is_null(state, "entity_id"),
        "history_entity_not_null": is_null(tables["history"], "entity_id"),
        "history_intervals": inverted_intervals(tables["history"]),
        "duty_rate_code_unique": not_unique(rates, "hts_code"),
        "duty_rate_code_not_null": is_null(rates, "hts_code"),
        "duty_rate_kind_not_null": is_null(rates, "rate_kind"),
        "duty_rate_kind_accepted": not_accepted(rates, "rate_kind", RATE + NO_RATE),
        "duty_rate_as_of_code_unique": not_unique(then, "hts_code"),
        "duty_rate_as_of_code_not_null": is_null(then, "hts_code"),
        "asymmetry_sums": gap_not_explained(tables["trade_asymmetry"]),
        "duty_rate_or_flagged": rate_without_kind(rates),
    }
