"""Change capture: from what sources publish to observations (entity_id, event_time, record_time, payload)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.envelope import payload_hash
from ledgerfold.functions.rates import parse_rate


def changed_only(rows: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """The rows whose value differs from that of the row before them; so A, B, A keeps all three."""
    before = F.lag(value).over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__before", before).where(~F.col(value).eqNullSafe(F.col("__before"))).drop("__before")


# ---- snapshots ----


def snapshot_diff(snapshot: DataFrame, prior: DataFrame, key: str = "entity_id", value: str = "payload_hash") -> DataFrame:
    """The snapshot's rows that are new or have changed against prior (key, value).  What has vanished from a snapshot
    makes no row: the log has no tombstones."""
    old = prior.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    return snapshot.join(old, F.col(key) == F.col("__k"), "left").where(F.col("__k").isNull() | ~F.col(value).eqNullSafe(F.col("__v"))).drop("__k", "__v")


def last_hashes(log: DataFrame) -> DataFrame:
    """entity_id, payload_hash of the last observation of each; takes the place of a file of remembered hashes."""
    events = log.where(~F.col("is_error_declaration"))
    return events.groupBy("entity_id").agg(F.max_by("payload_hash", F.struct("record_time", "seq")).alias("payload_hash"))


# ---- vintage matrices ----


def vintage_columns(df: DataFrame, series: str) -> dict[str, str]:
    """Column name to ISO date of the vintages SERIES_YYYYMMDD that the table happens to have."""
    import re

    found = {c: re.fullmatch(rf"{re.escape(series)}_(\d{{4}})(\d{{2}})(\d{{2}})", c) for c in df.columns}
    return {c: "-".join(m.groups()) for c, m in sorted(found.items()) if m}


def vintage_cells(matrix: DataFrame, series: str, date: str = "date") -> DataFrame:
    """observation_date, vintage, value of the cells that say something (not null, empty or a dot)."""
    names = vintage_columns(matrix, series)
    if not names:
        raise ValueError(f"no vintage of {series} among the columns")
    long = matrix.select(date, *[F.col(c).cast("string").alias(v) for c, v in names.items()]).unpivot([date], list(names.values()), "vintage", "value")
    return long.where(F.col("value").isNotNull() & ~F.col("value").isin("", ".")).select(F.col(date).alias("observation_date"), "vintage", "value")


def vintage_replay(matrix: DataFrame, series: str, date: str = "date") -> DataFrame:
    """Observations as each vintage changed them; the vintage is when a value became known."""
    cells = changed_only(vintage_cells(matrix, series, date), ["observation_date"], ["vintage"], "value")
    payload = F.to_json(F.struct("observation_date", F.lit(series).alias("series"), "value", "vintage"))
    return cells.select(F.concat(F.lit(f"{series}:"), "observation_date").alias("entity_id"), F.col("observation_date").alias("event_time"), F.col("vintage").alias("record_time"), payload.alias("payload"), F.lit("series_value_observed").alias("event_type"))


def vintage_answer(matrix: DataFrame, series: str, vintage: str, date: str = "date") -> DataFrame:
    """observation_date, value as one vintage has them: what a fold as of that vintage has to give."""
    return vintage_cells(matrix, series, date).where(F.col("vintage") == vintage).drop("vintage")


# ---- effective-dated revisions ----


def revision_replay(lines: DataFrame) -> DataFrame:
    """Observations of the codes whose rate, raw text or description a revision changed.

    lines: effective_from, label, code, description, general_rate_raw.  Both clocks are the effective date; the label
    is no part of the payload, so a new revision alone changes nothing.
    """
    rate = parse_rate(F.col("general_rate_raw"))
    rows = rated_lines(lines).withColumn("r", rate)
    payload = F.to_json(F.struct(F.col("r.rate").alias("ad_valorem_rate"), "description", "general_rate_raw", F.col("code").alias("hts_code"), F.col("r.kind").alias("rate_kind")), {"ignoreNullFields": "false"})
    rows = rows.select(F.concat(F.lit("HTS:"), "code").alias("entity_id"), F.col("effective_from").alias("event_time"), F.col("effective_from").alias("record_time"), payload.alias("payload"), F.lit("duty_rate_observed").alias("event_type"))
    return changed_only(rows.withColumn("__h", payload_hash("payload")), ["entity_id"], ["record_time"], "__h").drop("__h")


def rated_lines(lines: DataFrame) -> DataFrame:
    """Lines with a code and a rate; headers have none."""
    trimmed = lines.withColumns({"code": F.trim("code"), "description": F.trim("description")})
    return trimmed.where((F.col("code") != "") & F.col("general_rate_raw").isNotNull() & (F.col("general_rate_raw") != ""))


# ---- mirror reports ----


def reconcile(importer: DataFrame, exporter: DataFrame, importer_fob: DataFrame, tolerance_pct: float = 10.0) -> DataFrame:
    """Two reports of the same trade: importer_cif, exporter_fob and importer_fob each have (pair, year, value).

    The gap is split into what the importer's own valuation explains (cif - fob) and the rest.  A gap of exactly 0 %, or
    a value of 0, has no percentage; no percentage counts as within tolerance.
    """
    named = lambda t, n: t.select("pair", "year", F.col("value").alias(n))
    both = named(importer, "importer_cif").join(named(exporter, "exporter_fob"), ["pair", "year"]).join(named(importer_fob, "importer_fob"), ["pair", "year"], "left")
    gap = F.col("importer_cif") - F.col("exporter_fob")
    percent = F.when((F.col("importer_cif") != 0) & (gap != 0), 100.0 * gap / F.col("importer_cif"))
    out = both.withColumns({"gap": gap, "gap_pct": percent, "valuation": F.col("importer_cif") - F.col("importer_fob")})
    return out.withColumns({"residual": F.col("gap") - F.col("valuation"), "within_tolerance": F.coalesce(F.abs("gap_pct"), F.lit(0.0)) <= tolerance_pct})


def mirror_observations(reconciled: DataFrame, record_time: str) -> DataFrame:
    """Observations of reconciled years, for the log.  The years compared are the rows of reconciled; the years changed
    are what an append makes of these."""
    payload = F.to_json(
        F.struct(
            F.col("exporter_fob").alias("exporter_reported_fob_usd"),
            F.bround("gap_pct", 2).alias("gap_pct"),
            F.col("gap").alias("gap_usd"),
            F.col("importer_cif").alias("importer_reported_cif_usd"),
            F.col("importer_fob").alias("importer_reported_fob_usd"),
            "pair",
            F.col("residual").alias("residual_attribution_usd"),
            F.col("valuation").alias("valuation_component_usd"),
            "within_tolerance",
            "year",
        ),
        {"ignoreNullFields": "false"},
    )
    return reconciled.select(F.concat_ws(":", "pair", "year").alias("entity_id"), F.col("year").cast("string").alias("event_time"), F.lit(record_time).alias("record_time"), payload.alias("payload"), F.lit("trade_mirror_observed").alias("event_type"))


def index_observations(series: DataFrame, record_time: str, name: str = "GSCPI") -> DataFrame:
    """Observations of a series (period, value) that is published whole each time."""
    payload = F.to_json(F.struct(F.col("period").alias("observation_date"), F.lit(name).alias("series"), "value"))
    return series.select(F.concat(F.lit(f"{name}:"), "period").alias("entity_id"), F.col("period").alias("event_time"), F.lit(record_time).alias("record_time"), payload.alias("payload"), F.lit("index_value_observed").alias("event_type"))


def record_observations(records: DataFrame, entity: Column, event_time: Column, fetched_at: str, event_type: str) -> DataFrame:
    """Observations of whole records; an empty or missing event time falls back to the day of the fetch."""
    payload = F.to_json(F.struct(*[F.col(c) for c in sorted(records.columns)]))
    return records.select(entity.alias("entity_id"), F.coalesce(F.nullif(event_time, F.lit("")), F.lit(fetched_at)).alias("event_time"), F.lit(fetched_at).alias("record_time"), payload.alias("payload"), F.lit(event_type).alias("event_type"))
