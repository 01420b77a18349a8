"""An event log, vintages, tariff lines and mirror reports made of the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.envelope import COLUMNS, payload_hash

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
DECLARED = 1_000_000_000
REVISIONS = (("2024-05-15", "2024 rev 5"), ("2025-07-01", "2025 rev 12"), ("2026-03-20", "2026 rev 3"))
VINTAGE_DAYS = (7, 14, 21, 28)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(ts) -> F.Column:
    return F.date_format(ts, ISO_SECONDS)


def observations(events: DataFrame) -> DataFrame:
    """Every event as an observation of its user; each seventh was recorded six hours late."""
    late = F.when(F.col("event_id") % 7 == 0, F.expr("ts + interval 6 hours")).otherwise(F.col("ts"))
    source = F.when(F.col("event_type").isin("click", "view"), "web").when(F.col("event_type") == "error", "ops").otherwise("commerce")
    rows = events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("ev-"), F.col("event_id").cast("string")).alias("event_id"),
        "event_type",
        source.alias("source"),
        F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("entity_id"),
        iso("ts").alias("event_time"),
        iso(late).alias("record_time"),
        F.col("props").alias("payload"),
        payload_hash("props").alias("payload_hash"),
        F.lit(False).alias("is_error_declaration"),
        F.lit(None).cast("string").alias("declaration_time"),
        F.lit(None).cast("string").alias("reason"),
        F.lit("[]").alias("corrective_event_ids"),
        "ts",
    )
    return rows


def event_log(events: DataFrame) -> DataFrame:
    """The observations, and a declaration a day later for each fiftieth."""
    base = observations(events)
    day_later = iso(F.expr("ts + interval 1 day"))
    wrong = base.where(F.col("seq") % 50 == 0).withColumns({"seq": F.col("seq") + DECLARED, "record_time": day_later, "is_error_declaration": F.lit(True), "declaration_time": day_later, "reason": F.lit("every fiftieth")})
    return base.unionByName(wrong).select(*COLUMNS)


LOG_SQL = """base AS (
  SELECT event_id AS seq, 'ev-' || event_id AS event_id, event_type,
    CASE WHEN event_type IN ('click', 'view') THEN 'web' WHEN event_type = 'error' THEN 'ops' ELSE 'commerce' END AS source,
    'user:' || user_id AS entity_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_time,
    strftime(CASE WHEN event_id % 7 = 0 THEN ts + INTERVAL 6 HOUR ELSE ts END, '%Y-%m-%dT%H:%M:%S') AS record_time,
    props AS payload, substr(sha256(props), 1, 16) AS payload_hash, false AS is_error_declaration,
    NULL::VARCHAR AS declaration_time, NULL::VARCHAR AS reason, '[]' AS corrective_event_ids, ts
  FROM events),
e AS (
  SELECT * EXCLUDE (ts) FROM base UNION ALL
  SELECT seq + 1000000000, event_id, event_type, source, entity_id, event_time, strftime(ts + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S'),
    payload, payload_hash, true, strftime(ts + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S'), 'every fiftieth', '[]'
  FROM base WHERE seq % 50 = 0)"""


def fold_sql(as_of: str, name: str = "state", log: str = "e") -> str:
    return f"""{name} AS (
  SELECT * FROM {log} WHERE record_time <= '{as_of}' AND NOT is_error_declaration
    AND NOT EXISTS (SELECT 1 FROM {log} d WHERE d.is_error_declaration AND d.record_time <= '{as_of}' AND d.event_id = {log}.event_id)
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY record_time DESC, seq DESC) = 1)"""


def vintage_matrix(events: DataFrame) -> DataFrame:
    """One row a user, one column a vintage: the value believed at the end of a day of January 2024."""
    end = lambda d: F.lit(f"2024-01-{d:02d} 23:59:59").cast("timestamp_ntz")
    last = [F.max_by(F.when(F.col("ts") <= end(d), F.floor("value")), F.when(F.col("ts") <= end(d), F.struct("ts", "event_id"))).cast("string").alias(f"LAST_202401{d:02d}") for d in VINTAGE_DAYS]
    return events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).groupBy(F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("date")).agg(*last)


VINTAGE_SQL = "cells AS (" + " UNION ALL ".join(
    f"SELECT 'user-' || user_id AS observation_date, '2024-01-{d:02d}' AS vintage, arg_max(floor(value)::BIGINT, (ts, event_id))::VARCHAR AS value FROM events WHERE ts <= TIMESTAMP '2024-01-{d:02d} 23:59:59' GROUP BY user_id" for d in VINTAGE_DAYS
) + ")"


def tariff_lines(part: DataFrame) -> DataFrame:
    """Three revisions of a schedule with a line a part; some kinds and numbers change from one to the next."""
    revisions = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(d).alias("effective_from"), F.lit(n).alias("label")) for i, (d, n) in enumerate(REVISIONS)])
    rows = part.select("p_partkey", "p_name", "p_size", F.explode(revisions).alias("r"))
    kind = (F.col("p_partkey") + F.when(F.col("p_partkey") % 10 == F.col("r.i"), 1).otherwise(0)) % 6
    size = (F.col("p_size") + F.when(F.col("p_partkey") % 7 == F.col("r.i"), F.col("r.i")).otherwise(0)).cast("string")
    raw = F.when(kind == 0, "Free").when(kind == 1, F.concat(size, F.lit("%"))).when(kind == 2, F.concat(size, F.lit(".5 %"))).when(kind == 3, F.concat(size, F.lit(" cents/kg"))).when(kind == 4, F.concat(size, F.lit("% + 2.5 cents/kg"))).otherwise(F.lit("see note"))
    return rows.select(F.col("r.effective_from").alias("effective_from"), F.col("r.label").alias("label"), F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias("code"), F.col("p_name").alias("description"), raw.alias("general_rate_raw"))


TARIFF_SQL = """revisions AS (SELECT * FROM (VALUES (0, '2024-05-15'), (1, '2025-07-01'), (2, '2026-03-20')) t(i, effective_from)),
numbered AS (
  SELECT p_partkey::VARCHAR AS code, p_name AS description, effective_from,
    (p_partkey + CASE WHEN p_partkey % 10 = i THEN 1 ELSE 0 END) % 6 AS k, (p_size + CASE WHEN p_partkey % 7 = i THEN i ELSE 0 END)::VARCHAR AS n
  FROM part, revisions),
lines AS (
  SELECT code, description, effective_from, CASE k WHEN 0 THEN 'Free' WHEN 1 THEN n || '%' WHEN 2 THEN n || '.5 %' WHEN 3 THEN n || ' cents/kg' WHEN 4 THEN n || '% + 2.5 cents/kg' ELSE 'see note' END AS raw,
    CASE k WHEN 0 THEN 'free' WHEN 1 THEN 'ad_valorem' WHEN 2 THEN 'ad_valorem' WHEN 3 THEN 'specific' WHEN 4 THEN 'compound' ELSE 'unparsed' END AS kind,
    CASE k WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN round(n::DOUBLE / 100, 6) WHEN 2 THEN round((n || '.5')::DOUBLE / 100, 6) END AS rate
  FROM numbered),
changed AS (
  SELECT * FROM lines QUALIFY coalesce(lag(raw || description) OVER (PARTITION BY code ORDER BY effective_from), '') <> raw || description)"""


def mirror_reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(importer cif, exporter fob, importer fob) of (pair, year, value): what customers' nations say they bought by the
    year of the order, and what suppliers' nations say they sold by the year of the shipment.  In whole ten-thousandths,
    so that sums are exact in any order."""
    li, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer, supplier = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cents, tax, off = F.round(F.col("l_extendedprice") * 100).cast("long"), F.round(F.col("l_tax") * 100).cast("long"), F.round(F.col("l_discount") * 100).cast("long")
    rows = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    pair = F.concat_ws("-", F.col("c_nationkey").cast("string"), F.col("s_nationkey").cast("string"))
    slim = rows.select(pair.alias("pair"), F.year("o_orderdate").cast("string").alias("ordered"), F.year("l_shipdate").cast("string").alias("shipped"), (cents * (100 + tax)).alias("cif"), (cents * (100 - off)).alias("fob"), (cents * 100).alias("list"))
    value = lambda c: (F.sum(c) / 10000.0).alias("value")
    by_order, by_ship = slim.groupBy("pair", F.col("ordered").alias("year")), slim.groupBy("pair", F.col("shipped").alias("year"))
    return by_order.agg(value("cif")), by_ship.agg(value("fob")), by_order.agg(value("list")).where(F.col("year") >= "1996")


MIRROR_SQL = """sales AS (
  SELECT c_nationkey || '-' || s_nationkey AS pair, year(o_orderdate)::VARCHAR AS ordered, year(l_shipdate)::VARCHAR AS shipped,
    round(l_extendedprice * 100)::BIGINT AS cents, round(l_tax * 100)::BIGINT AS tax, round(l_discount * 100)::BIGINT AS off
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
cif AS (SELECT pair, ordered AS year, sum(cents * (100 + tax))::BIGINT / 10000.0::DOUBLE AS importer_cif, sum(cents * 100)::BIGINT / 10000.0::DOUBLE AS list FROM sales GROUP BY ALL),
fob AS (SELECT pair, shipped AS year, sum(cents * (100 - off))::BIGINT / 10000.0::DOUBLE AS exporter_fob FROM sales GROUP BY ALL),
gaps AS (
  SELECT pair, year, importer_cif, exporter_fob, CASE WHEN year >= '1996' THEN list END AS importer_fob, importer_cif - exporter_fob AS gap
  FROM cif JOIN fob USING (pair, year)),
mirror AS (
  SELECT *, CASE WHEN importer_cif <> 0 AND gap <> 0 THEN 100.0::DOUBLE * gap / importer_cif END AS gap_pct, importer_cif - importer_fob AS valuation,
    gap - (importer_cif - importer_fob) AS residual,
    coalesce(abs(CASE WHEN importer_cif <> 0 AND gap <> 0 THEN 100.0::DOUBLE * gap / importer_cif END), 0) <= 10 AS within_tolerance
  FROM gaps)"""
