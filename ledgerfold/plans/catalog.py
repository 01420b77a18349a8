"""The named queries over the test tables, each with SQL that says the same to another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.envelope import COLUMNS, FOREVER, payload_hash
from ledgerfold.functions import fingerprint, normalize, rates
from ledgerfold.operators import append as appends
from ledgerfold.operators import capture, custody, folds, joins
from ledgerfold.plans import marts, quality
from ledgerfold.plans.derived import DECLARED, LOG_SQL, MIRROR_SQL, TARIFF_SQL, VINTAGE_DAYS, VINTAGE_SQL, event_log, fold_sql, iso, mirror_reports, observations, table, tariff_lines, vintage_matrix
from ledgerfold.sources import files
from ledgerfold.storage import Workspace
from ledgerfold.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
THEN, NOON = "2024-01-15", "2024-01-15T12:00"
STATE = ("seq", "event_id", "event_type", "source", "entity_id", "event_time", "record_time", "payload", "payload_hash")
ALL = ", ".join(STATE)


def query(name: str, sql: str | None = None):
    def take(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return take


def log_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(table(spark, sf_dir, "events"))


def _fold(as_of: str, max_by: bool = False) -> Query:
    fold = folds.fold_state_max_by if max_by else folds.fold_state
    return lambda spark, d: fold(log_of(spark, d), as_of).select(*STATE)


for _name, _as_of, _max_by in (("fold_current_state", FOREVER, False), ("fold_point_in_time_date", THEN, False), ("fold_point_in_time_datetime", NOON, False), ("fold_max_by", FOREVER, True)):
    query(_name, f"WITH {LOG_SQL}, {fold_sql(_as_of)} SELECT {ALL} FROM state")(_fold(_as_of, _max_by))


@query(
    "fold_belief_vs_now",
    f"""WITH {LOG_SQL}, {fold_sql(THEN, "a")}, {fold_sql(FOREVER, "b")}
SELECT coalesce(a.entity_id, b.entity_id) AS entity_id, a.payload_hash AS then_hash, a.record_time AS then_record_time, b.payload_hash AS now_hash, b.record_time AS now_record_time
FROM a FULL JOIN b ON a.entity_id = b.entity_id WHERE a.payload_hash IS DISTINCT FROM b.payload_hash""",
)
def fold_belief_vs_now(spark, d):
    return folds.belief_changes(log_of(spark, d), THEN)


@query("rescinded_ids", f"WITH {LOG_SQL} SELECT DISTINCT event_id FROM e WHERE is_error_declaration AND record_time <= '{NOON}'")
def rescinded_ids(spark, d):
    return folds.rescinded(log_of(spark, d), NOON)


@query("visible_events", f"WITH {LOG_SQL} SELECT {ALL} FROM e WHERE NOT is_error_declaration AND record_time <= '{NOON}' AND event_id NOT IN (SELECT event_id FROM e WHERE is_error_declaration AND record_time <= '{NOON}')")
def visible_events(spark, d):
    return folds.visible(log_of(spark, d), NOON).select(*STATE)


_HISTORY = "SELECT entity_id, source, event_type, event_time, record_time AS valid_from, lead(record_time) OVER (PARTITION BY entity_id ORDER BY record_time, seq) AS valid_to, payload, payload_hash, seq FROM"


@query("history_scd2", f"WITH {LOG_SQL} {_HISTORY} e WHERE NOT is_error_declaration")
def history_scd2(spark, d):
    return folds.history(log_of(spark, d))


@query("history_visible_only", f"WITH {LOG_SQL} {_HISTORY} e WHERE NOT is_error_declaration AND seq % 50 <> 0")
def history_visible_only(spark, d):
    return folds.history(log_of(spark, d), include_rescinded=False)


@query("aggregates_by_source_type", f"WITH {LOG_SQL} SELECT source, event_type, count(*) AS events, count(DISTINCT entity_id) AS entities, min(record_time) AS first_record, max(record_time) AS last_record FROM e WHERE NOT is_error_declaration GROUP BY ALL")
def aggregates_by_source_type(spark, d):
    return folds.aggregates(log_of(spark, d))


@query("registry_source_counts", f"WITH {LOG_SQL}, r AS (SELECT * FROM (VALUES ('web'), ('ops'), ('commerce'), ('unused')) t(source)) SELECT r.source, count(seq) AS events, count(DISTINCT entity_id) AS entities FROM r LEFT JOIN e ON r.source = e.source AND NOT is_error_declaration GROUP BY r.source")
def registry_source_counts(spark, d):
    return folds.source_event_counts(log_of(spark, d), spark.createDataFrame([(s,) for s in ("web", "ops", "commerce", "unused")], "source string"))


# ---- quality ----


def flawed_log(spark, d) -> DataFrame:
    """The log with faults to find: ids used again without a declaration, entities and sources missing."""
    log = log_of(spark, d)
    again = log.where((F.col("seq") % 1000 == 1) & ~F.col("is_error_declaration")).withColumn("seq", F.col("seq") + 2 * DECLARED)
    return log.unionByName(again).withColumns({"entity_id": F.when(F.col("seq") % 500 != 3, F.col("entity_id")), "source": F.when(F.col("seq") % 700 != 5, F.col("source"))})


FLAWED_SQL = f"""{LOG_SQL}, both_ AS (SELECT * FROM e UNION ALL SELECT * REPLACE (seq + 2000000000 AS seq) FROM e WHERE seq % 1000 = 1 AND NOT is_error_declaration),
f AS (SELECT * REPLACE (CASE WHEN seq % 500 <> 3 THEN entity_id END AS entity_id, CASE WHEN seq % 700 <> 5 THEN source END AS source) FROM both_)"""


@query("quality_event_id_reuse", f"WITH {FLAWED_SQL} SELECT event_id, count(*) AS n, sum(CASE WHEN is_error_declaration THEN 1 ELSE 0 END)::BIGINT AS decls FROM f GROUP BY event_id HAVING count(*) > 2 OR (count(*) = 2 AND decls = 0)")
def quality_event_id_reuse(spark, d):
    return quality.reused_ids(flawed_log(spark, d))


@query(
    "quality_unique_not_null",
    f"""WITH {FLAWED_SQL}
SELECT 'seq_unique' AS "check", (SELECT count(*) FROM (SELECT seq FROM f WHERE seq IS NOT NULL GROUP BY seq HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'seq_not_null', count(*) FROM f WHERE seq IS NULL UNION ALL SELECT 'entity_id_not_null', count(*) FROM f WHERE entity_id IS NULL
UNION ALL SELECT 'record_time_not_null', count(*) FROM f WHERE record_time IS NULL UNION ALL SELECT 'source_not_null', count(*) FROM f WHERE source IS NULL
UNION ALL SELECT 'source_accepted', count(*) FROM f WHERE source NOT IN ('web', 'ops')
UNION ALL SELECT 'event_id_reuse', count(*) FROM (SELECT event_id FROM f GROUP BY event_id HAVING count(*) > 2 OR (count(*) = 2 AND count_if(is_error_declaration) = 0))""",
)
def quality_unique_not_null(spark, d):
    return quality.log_summary(flawed_log(spark, d), ["web", "ops"])


@query("quality_accepted_values", f"WITH {FLAWED_SQL} SELECT seq, source FROM f WHERE source NOT IN ('web', 'ops')")
def quality_accepted_values(spark, d):
    return quality.not_accepted(flawed_log(spark, d), "source", ["web", "ops"]).select("seq", "source")


@query("quality_interval_order", f"WITH {LOG_SQL}, h AS ({_HISTORY} e WHERE NOT is_error_declaration) SELECT count(*) AS versions, count_if(valid_to IS NULL)::BIGINT AS open_versions, count_if(valid_to < valid_from)::BIGINT AS inverted, count_if(valid_to < event_time)::BIGINT AS superseded_before_event FROM h")
def quality_interval_order(spark, d):
    h = folds.history(log_of(spark, d))
    return h.agg(F.count("*").alias("versions"), F.count_if(F.col("valid_to").isNull()).alias("open_versions"), F.count_if(F.col("valid_to") < F.col("valid_from")).alias("inverted"), F.count_if(F.col("valid_to") < F.col("event_time")).alias("superseded_before_event"))


# ---- scalars ----


@query("json_extract_props", f"WITH {LOG_SQL} SELECT seq, json_extract_string(payload, '$.k')::DOUBLE AS k, json_extract_string(payload, '$.none') AS absent FROM e")
def json_extract_props(spark, d):
    return log_of(spark, d).select("seq", folds.field("k", "double").alias("k"), folds.field("none").alias("absent"))


@query("normalize_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS from_ymd, strftime(o_orderdate, '%Y-%m-%d') AS from_mdy, strftime(o_orderdate, '%d.%m.%Y') AS other FROM orders")
def normalize_dates(spark, d):
    day = lambda f: F.date_format("o_orderdate", f)
    return table(spark, d, "orders").select("o_orderkey", normalize.ymd_to_iso(day("yyyyMMdd")).alias("from_ymd"), normalize.mdy_to_iso(day("MM/dd/yyyy")).alias("from_mdy"), normalize.mdy_to_iso(normalize.ymd_to_iso(day("dd.MM.yyyy"))).alias("other"))


@query(
    "normalize_enums_with_notes",
    """WITH r AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Avaliable' WHEN 1 THEN 'On-Going' WHEN 2 THEN 'Unvailable' ELSE o_orderpriority END AS status,
  CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'unknown' END AS reported FROM orders)
SELECT o_orderkey, CASE status WHEN 'Avaliable' THEN 'Available' WHEN 'On-Going' THEN 'Ongoing' WHEN 'Unvailable' THEN 'Unavailable' ELSE status END AS status,
  regexp_replace(reported, '^(\\d{4})(\\d{2})(\\d{2})$', '\\1-\\2-\\3') AS reported,
  nullif(concat_ws('|', CASE status WHEN 'Avaliable' THEN 'enum:status:Avaliable->Available' WHEN 'On-Going' THEN 'enum:status:On-Going->Ongoing' WHEN 'Unvailable' THEN 'enum:status:Unvailable->Unavailable' END,
    CASE WHEN reported <> 'unknown' THEN 'date:reported:YYYYMMDD->ISO' END), '') AS notes FROM r""",
)
def normalize_enums_with_notes(spark, d):
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderkey") % 4 == 0, "Avaliable").when(F.col("o_orderkey") % 4 == 1, "On-Going").when(F.col("o_orderkey") % 4 == 2, "Unvailable").otherwise(F.col("o_orderpriority"))
    rows = o.select("o_orderkey", status.alias("status"), F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("unknown").alias("reported"))
    return normalize.normalize_records(rows, ymd=("reported",)).select("o_orderkey", "status", "reported", F.array_join("_normalizations", "|").alias("notes"))


@query("fingerprint_keys", "SELECT s_suppkey, 'supplier:' || substr(sha1(s_name || '|' || '' || '|' || s_nationkey), 1, 16) AS key, substr(sha256(s_name), 1, 16) AS payload_hash, substr(sha256(s_name::BLOB), 1, 12) AS digest FROM supplier")
def fingerprint_keys(spark, d):
    key = fingerprint.record_key("supplier", F.col("s_name"), F.lit(None).cast("string"), F.col("s_nationkey").cast("string"))
    return table(spark, d, "supplier").select("s_suppkey", key.alias("key"), payload_hash("s_name").alias("payload_hash"), fingerprint.content_digest(F.col("s_name").cast("binary")).alias("digest"))


@query("month_truncation", "SELECT strftime(date_trunc('month', ts), '%Y-%m-01') AS period, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def month_truncation(spark, d):
    return table(spark, d, "events").groupBy(normalize.month_start(F.col("ts").cast("string")).alias("period")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


# ---- appends and change capture ----


@query("replay_anti_join", f"WITH {LOG_SQL} SELECT seq, event_id FROM e WHERE NOT is_error_declaration AND seq % 2 = 0 AND seq % 3 = 0")
def replay_anti_join(spark, d):
    log = log_of(spark, d)
    return appends.not_replayed(log.where((F.col("seq") % 2 == 0) & ~F.col("is_error_declaration")), log.where(F.col("seq") % 3 != 0)).select("seq", "event_id")


def bucketed(spark, d) -> DataFrame:
    """Observations of a value that seldom changes."""
    payload = F.concat(F.lit('{"b": '), (F.get_json_object("payload", "$.k").cast("int") % 3).cast("string"), F.lit("}"))
    return observations(table(spark, d, "events")).select("event_type", "source", "entity_id", "event_time", "record_time", payload.alias("payload"))


BUCKETED_SQL = f"""{LOG_SQL}, b AS (
  SELECT DISTINCT event_type, entity_id, event_time, record_time, substr(sha256('{{"b": ' || (json_extract_string(payload, '$.k')::INT % 3) || '}}'), 1, 16) AS payload_hash FROM base),
kept AS (
  SELECT * FROM b QUALIFY payload_hash IS DISTINCT FROM lag(payload_hash) OVER (PARTITION BY entity_id ORDER BY record_time, event_time, payload_hash))"""


@query("change_only_append", f"WITH {BUCKETED_SQL} SELECT row_number() OVER (ORDER BY record_time, entity_id, event_type, payload_hash) - 1 AS seq, entity_id, event_type, event_time, record_time, payload_hash FROM kept")
def change_only_append(spark, d):
    none = log_of(spark, d).limit(0)
    return appends.append(none, bucketed(spark, d)).select("seq", "entity_id", "event_type", "event_time", "record_time", "payload_hash")


@query("replay_after_restart", f"WITH {BUCKETED_SQL} SELECT entity_id, event_type, event_time, record_time, payload_hash FROM kept")
def replay_after_restart(spark, d):
    """Half the batch, then all of it again as by another process: together what one append of all makes."""
    batch, none = bucketed(spark, d), log_of(spark, d).limit(0)
    first = appends.append(none, batch.where(F.col("record_time") < THEN))
    return first.unionByName(appends.append(first, batch)).select("entity_id", "event_type", "event_time", "record_time", "payload_hash")


@query("error_declarations", f"WITH {LOG_SQL} SELECT event_id, record_time, reason, corrective_event_ids FROM (SELECT event_id, '2024-03-01' AS record_time, 'wrong unit' AS reason, '[\"ev-1\"]' AS corrective_event_ids FROM base WHERE seq % 77 = 1)")
def error_declarations(spark, d):
    log = observations(table(spark, d, "events")).select(*COLUMNS)
    wrong = log.where(F.col("seq") % 77 == 1).select("event_id", F.lit("2024-03-01").alias("declaration_time"), F.lit("wrong unit").alias("reason"), F.array(F.lit("ev-1")).alias("corrective_event_ids"))
    return appends.declare_errors(log, wrong).select("event_id", "record_time", "reason", "corrective_event_ids")


@query("snapshot_hash_diff", f"WITH {LOG_SQL}, {fold_sql('2024-01-15', 'a')}, {fold_sql('2024-01-16', 'b')} SELECT b.entity_id, b.payload_hash FROM b LEFT JOIN a USING (entity_id) WHERE a.payload_hash IS DISTINCT FROM b.payload_hash")
def snapshot_hash_diff(spark, d):
    log = log_of(spark, d)
    day = lambda t: folds.fold_state(log, t).select("entity_id", "payload_hash")
    return capture.snapshot_diff(day("2024-01-16"), day("2024-01-15"))


@query("series_value_diff", "WITH daily AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, floor(max(value) / 25)::BIGINT AS value FROM events GROUP BY ALL) SELECT event_type, day, value FROM daily QUALIFY value IS DISTINCT FROM lag(value) OVER (PARTITION BY event_type ORDER BY day)")
def series_value_diff(spark, d):
    daily = table(spark, d, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.floor(F.max("value") / 25).cast("long").alias("value"))
    return capture.changed_only(daily, ["event_type"], ["day"], "value")


@query("vintage_unpivot_replay", f"WITH {VINTAGE_SQL} SELECT 'LAST:' || observation_date AS entity_id, observation_date AS event_time, vintage AS record_time, value FROM cells QUALIFY value IS DISTINCT FROM lag(value) OVER (PARTITION BY observation_date ORDER BY vintage)")
def vintage_unpivot_replay(spark, d):
    return capture.vintage_replay(vintage_matrix(table(spark, d, "events")), "LAST").select("entity_id", "event_time", "record_time", folds.field("value").alias("value"))


@query("vintage_oracle_match", f"WITH {VINTAGE_SQL} SELECT vintage, count(*) AS cells, 0::BIGINT AS differences FROM cells GROUP BY vintage")
def vintage_oracle_match(spark, d):
    """The fold as of each vintage against that vintage's own column."""
    matrix = vintage_matrix(table(spark, d, "events"))
    log = capture.vintage_replay(matrix, "LAST").withColumns({"event_id": F.sha2(F.concat_ws("|", "entity_id", "record_time"), 256), "is_error_declaration": F.lit(False), "seq": F.lit(0).cast("long")})
    out = None
    for day in VINTAGE_DAYS:
        v = f"2024-01-{day:02d}"
        folded = folds.fold_state(log, v).select(F.col("event_time").alias("observation_date"), folds.field("value").alias("value"))
        answer = capture.vintage_answer(matrix, "LAST", v)
        wrong = joins.differences(folded, answer).agg(F.count("*").alias("differences"))
        one = answer.agg(F.count("*").alias("cells")).join(wrong, F.lit(True)).select(F.lit(v).alias("vintage"), "cells", "differences")
        out = one if out is None else out.unionAll(one)
    return out


# ---- tariffs ----


@query("duty_rate_parse", f"WITH {TARIFF_SQL} SELECT effective_from, code, raw, rate, kind FROM lines")
def duty_rate_parse(spark, d):
    r = rates.parse_rate(F.col("general_rate_raw"))
    return capture.rated_lines(tariff_lines(table(spark, d, "part"))).select("effective_from", "code", F.col("general_rate_raw").alias("raw"), r["rate"].alias("rate"), r["kind"].alias("kind"))


def tariff_log(spark, d) -> DataFrame:
    rows = capture.revision_replay(tariff_lines(table(spark, d, "part")))
    return rows.withColumns({"event_id": F.sha2(F.concat_ws("|", "entity_id", "record_time"), 256), "is_error_declaration": F.lit(False), "seq": F.lit(0).cast("long"), "source": F.lit("usitc_hts"), "payload_hash": payload_hash("payload")})


@query("effective_dated_replay", f"WITH {TARIFF_SQL} SELECT 'HTS:' || code AS entity_id, effective_from AS record_time, rate, kind FROM changed")
def effective_dated_replay(spark, d):
    return tariff_log(spark, d).select("entity_id", "record_time", folds.field("ad_valorem_rate", "double").alias("rate"), folds.field("rate_kind").alias("kind"))


_RATES = "SELECT code AS hts_code, description, raw AS general_rate_raw, rate AS ad_valorem_rate, kind AS rate_kind, effective_from"


@query("duty_rate_current", f"WITH {TARIFF_SQL} {_RATES} FROM changed QUALIFY row_number() OVER (PARTITION BY code ORDER BY effective_from DESC) = 1")
def duty_rate_current(spark, d):
    return marts.duty_rates(tariff_log(spark, d))


@query("duty_rate_as_of", f"WITH {TARIFF_SQL} {_RATES}, '2025-08-01' AS as_of FROM changed WHERE effective_from <= '2025-08-01' QUALIFY row_number() OVER (PARTITION BY code ORDER BY effective_from DESC) = 1")
def duty_rate_as_of(spark, d):
    return marts.duty_rates(tariff_log(spark, d), "2025-08-01")


@query("tariff_revision_in_force", f"WITH {TARIFF_SQL} SELECT code, raw, effective_from FROM lines WHERE effective_from = (SELECT max(effective_from) FROM revisions WHERE effective_from <= '2025-08-01')")
def tariff_revision_in_force(spark, d):
    last = joins.last_revision(tariff_lines(table(spark, d, "part")), "code", "2025-08-01")
    return last.select(F.trim("code").alias("code"), F.col("general_rate_raw").alias("raw"), "effective_from")


def shipments(spark, d) -> DataFrame:
    """Line items with the date on which they are priced, 27 years later, so that they meet the revisions."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.concat(F.lit("HTS:"), F.col("l_partkey").cast("string")).alias("entity_id"), F.date_format(F.expr("l_shipdate + interval 27 years"), "yyyy-MM-dd").alias("shipped"))


_SHIPMENTS = "shipments AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_partkey::VARCHAR AS code, strftime(l_shipdate + INTERVAL 27 YEAR, '%Y-%m-%d') AS shipped FROM lineitem)"
_PRICED = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, shipped, rate, kind, CASE WHEN rate IS NULL THEN 'needs_quantity' ELSE 'computed' END AS duty_status, round(l_extendedprice::DECIMAL(18, 4) * rate::DECIMAL(12, 6), 2)::DOUBLE AS duty FROM shipments s ASOF LEFT JOIN changed c ON s.code = c.code AND s.shipped >= c.effective_from"


def priced(rows: DataFrame) -> DataFrame:
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "shipped", "rate", "kind", rates.duty_status(F.col("rate")).alias("duty_status"), rates.landed_duty(F.col("l_extendedprice"), F.col("rate"), F.col("kind")).alias("duty"))


@query("landed_duty_status", f"WITH {TARIFF_SQL}, {_SHIPMENTS} {_PRICED}")
def landed_duty_status(spark, d):
    versions = tariff_log(spark, d).select("entity_id", "record_time", folds.field("ad_valorem_rate", "double").alias("rate"), folds.field("rate_kind").alias("kind"))
    return priced(joins.as_of_join(shipments(spark, d), versions, ["entity_id"], "shipped", "record_time", ["rate", "kind"]))


@query("interval_join_rate", f"WITH {TARIFF_SQL}, {_SHIPMENTS} {_PRICED}")
def interval_join_rate(spark, d):
    versions = folds.history(tariff_log(spark, d)).select("entity_id", "valid_from", "valid_to", folds.field("ad_valorem_rate", "double").alias("rate"), folds.field("rate_kind").alias("kind"))
    return priced(joins.interval_join(shipments(spark, d), versions, ["entity_id"], "shipped"))


@query(
    "asof_join_rate",
    """WITH v AS (SELECT user_id, ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT p.event_id, p.user_id, v.view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def asof_join_rate(spark, d):
    events = table(spark, d, "events")
    views = events.where("event_type = 'view'").select("user_id", F.col("ts").alias("viewed"), F.col("event_id").alias("view_id"))
    return joins.as_of_join(events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, ["user_id"], "ts", "viewed", ["view_id"]).select("event_id", "user_id", "view_id")


# ---- mirror reports ----


@query("mirror_reconciliation", f"WITH {MIRROR_SQL} SELECT pair, year, importer_cif, exporter_fob, importer_fob, gap, gap_pct, valuation, residual FROM mirror")
def mirror_reconciliation(spark, d):
    return capture.reconcile(*mirror_reports(spark, d)).select("pair", "year", "importer_cif", "exporter_fob", "importer_fob", "gap", "gap_pct", "valuation", "residual")


@query("tolerance_flag", f"WITH {MIRROR_SQL} SELECT pair, year, within_tolerance FROM mirror")
def tolerance_flag(spark, d):
    return capture.reconcile(*mirror_reports(spark, d)).select("pair", "year", "within_tolerance")


def asymmetry(spark, d) -> DataFrame:
    """Through the log: observations, fold, typed mart."""
    rows = capture.mirror_observations(capture.reconcile(*mirror_reports(spark, d)), "2024-06-01")
    log = rows.withColumns({"event_id": F.col("entity_id"), "is_error_declaration": F.lit(False), "seq": F.lit(0).cast("long")})
    return marts.trade_asymmetry(log)


@query("trade_asymmetry_mart", f"WITH {MIRROR_SQL} SELECT pair, year, importer_cif AS importer_cif_usd, exporter_fob AS exporter_fob_usd, gap AS gap_usd, valuation AS valuation_component_usd, residual AS residual_attribution_usd, within_tolerance::VARCHAR AS within_tolerance FROM mirror")
def trade_asymmetry_mart(spark, d):
    return asymmetry(spark, d).select("pair", "year", "importer_cif_usd", "exporter_fob_usd", "gap_usd", "valuation_component_usd", "residual_attribution_usd", "within_tolerance")


@query(
    "reconciliation_report",
    f"""WITH {MIRROR_SQL} SELECT pair, year, gap AS gap_usd, round_even(gap_pct, 2) AS gap_pct, valuation AS explained_valuation_usd, residual AS residual_usd,
  round(100.0::DOUBLE * residual / nullif(gap, 0), 1) AS residual_share_pct FROM mirror ORDER BY abs(residual) DESC NULLS LAST""",
)
def reconciliation_report(spark, d):
    """All rows of the mart, also those without a residual."""
    return marts.reconciliation_report(asymmetry(spark, d))


# ---- custody ----


def custody_log(spark, d) -> DataFrame:
    """Users as lots: each event hands the lot to a holder named after its k."""
    k = F.get_json_object("payload", "$.k")
    payload = F.concat(F.lit('{"ndc": "'), F.substring_index("entity_id", ":", -1), F.lit('", "site": "'), F.col("source"), F.lit('", "holder_after": "H'), (k.cast("int") % 10).cast("string"), F.lit('", "to": "D'), (k.cast("int") % 4).cast("string"), F.lit('"}'))
    return log_of(spark, d).withColumns({"payload": payload, "source": F.lit(marts.PHARMA)})


CUSTODY_SQL = f"""{LOG_SQL}, c AS (
  SELECT seq, event_id, event_type, source, entity_id, entity_id AS lot, substr(entity_id, 6) AS ndc, event_time, record_time, is_error_declaration,
    'H' || (json_extract_string(payload, '$.k')::INT % 10) AS holder, 'D' || (json_extract_string(payload, '$.k')::INT % 4) AS shipped_to FROM e)"""
_CHAIN = """firsts AS (SELECT lot, holder, min((record_time, seq)) AS first_at FROM c WHERE NOT is_error_declaration AND seq % 50 <> 0 GROUP BY ALL),
chains AS (SELECT lot, string_agg(holder, ' -> ' ORDER BY first_at) AS chain FROM firsts GROUP BY lot)"""


@query("custody_chain", f"WITH {CUSTODY_SQL}, {_CHAIN} SELECT lot AS entity_id, chain FROM chains")
def custody_chain(spark, d):
    return custody.holder_chain(folds.history(custody_log(spark, d), include_rescinded=False))


@query("lot_current_location", f"WITH {CUSTODY_SQL}, {fold_sql(FOREVER, 'state', 'c')} SELECT lot, ndc, holder, event_type AS last_event, event_time, record_time FROM state")
def lot_current_location(spark, d):
    return marts.lot_location(custody_log(spark, d))


@query("chain_of_custody", f"WITH {CUSTODY_SQL} SELECT lot, ndc, event_type, source AS site, shipped_to, event_time, record_time AS valid_from, lead(record_time) OVER (PARTITION BY lot ORDER BY record_time, seq) AS valid_to FROM c WHERE NOT is_error_declaration")
def chain_of_custody(spark, d):
    return marts.chain_of_custody(custody_log(spark, d))


@query("recall_drill", f"WITH {CUSTODY_SQL}, {_CHAIN}, {fold_sql(NOON, 'state', 'c')} SELECT lot, ndc, holder, event_type AS last_event, chain FROM state LEFT JOIN chains USING (lot) WHERE ndc::INT % 7 = 0")
def recall_drill(spark, d):
    recalled = table(spark, d, "part").where("p_partkey % 7 = 0").select(F.col("p_partkey").cast("string").alias("ndc"))
    return custody.drill(custody_log(spark, d), recalled, NOON, marts.PHARMA)


@query("set_ops", f"WITH {LOG_SQL}, w AS (SELECT DISTINCT entity_id FROM e WHERE source = 'web' AND record_time < '{THEN}'), o AS (SELECT DISTINCT entity_id FROM e WHERE source = 'ops' AND record_time >= '{THEN}') SELECT 'both' AS side, entity_id FROM (SELECT * FROM w INTERSECT SELECT * FROM o) UNION ALL SELECT 'web only', entity_id FROM (SELECT * FROM w EXCEPT SELECT * FROM o) UNION ALL SELECT 'all', entity_id FROM (SELECT * FROM w UNION SELECT * FROM o)")
def set_ops(spark, d):
    log = log_of(spark, d)
    web = log.where((F.col("source") == "web") & (F.col("record_time") < THEN)).select("entity_id").distinct()
    ops = log.where((F.col("source") == "ops") & (F.col("record_time") >= THEN)).select("entity_id").distinct()
    side = lambda n, x: x.select(F.lit(n).alias("side"), "entity_id")
    return side("both", web.intersect(ops)).unionAll(side("web only", web.join(ops, "entity_id", "left_anti"))).unionAll(side("all", web.unionAll(ops).distinct()))


# ---- streams ----


def _stream(spark, d) -> DataFrame:
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").load(d, format="parquet")


def _run(df: DataFrame, mode: str) -> DataFrame:
    return incremental.run_to_table(df, mode, Workspace(df.sparkSession, "stream").root)


@query("stream_current_state", f"WITH {LOG_SQL} SELECT entity_id, event_id, event_type, payload, record_time, seq, is_error_declaration FROM e WHERE NOT is_error_declaration QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY record_time DESC, seq DESC) = 1")
def stream_current_state(spark, d):
    return _run(incremental.current_state(observations(_stream(spark, d))), "complete")


@query("stream_change_detect", f"WITH {LOG_SQL}, b AS (SELECT entity_id, record_time, seq, (json_extract_string(payload, '$.k')::INT % 3)::VARCHAR AS payload_hash FROM base) SELECT * FROM b QUALIFY payload_hash IS DISTINCT FROM lag(payload_hash) OVER (PARTITION BY entity_id ORDER BY record_time, seq)")
def stream_change_detect(spark, d):
    rows = observations(_stream(spark, d)).withColumn("payload_hash", (F.get_json_object("payload", "$.k").cast("int") % 3).cast("string"))
    return incremental.run_changes(rows, Workspace(spark, "changes").root)


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, d):
    """Every event delivered twice, kept once."""
    rows = _stream(spark, d)
    twice = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return _run(incremental.deduplicated(twice).select("event_id", "user_id", "event_type"), "append")


@query("stream_daily_counts", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(spark, d):
    rows = _stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    return _run(rows.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n")).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n"), "complete")


# ---- documents of sources ----

_SDMX = '{"data":{"dataSets":[{"series":{"0:0":{"attributes":[],"observations":{"0":["640",null],"1":["1200.25"],"2":[null]}}}}],"structures":[{"dimensions":{"series":[],"observation":[{"id":"TIME_PERIOD","values":[{"value":"2020"},{"value":"2021"},{"value":"2022"}]}]}}]}}'


@query("sdmx_parse", "SELECT * FROM (VALUES ('2020', 640.0::DOUBLE), ('2021', 1200.25::DOUBLE)) t(period, value)")
def sdmx_parse(spark, d):
    return files.parse_sdmx(spark.createDataFrame([(_SDMX,)], "value string"))


@query("index_series_parse", "SELECT * FROM (VALUES ('1998-01-01', 0.5::DOUBLE), ('1998-02-01', -1.25::DOUBLE)) t(period, value)")
def index_series_parse(spark, d):
    return files.index_series(spark.createDataFrame([("1998-01-31", "0.5"), ("1998-02-28", "-1.25"), ("not a date", "3"), ("1998-03-31", None)], "a string, b string"))


@query("shortage_mart", f"WITH {LOG_SQL}, {fold_sql(FOREVER)} SELECT entity_id, event_type AS generic_name, json_extract_string(payload, '$.k') AS status, record_time AS observed_at FROM state WHERE event_type IS NOT NULL")
def shortage_mart(spark, d):
    payload = F.concat(F.lit('{"generic_name": "'), F.col("event_type"), F.lit('", "status": "'), F.get_json_object("payload", "$.k"), F.lit('"}'))
    log = log_of(spark, d).withColumns({"payload": payload, "event_type": F.lit("fda_shortage_observed")})
    return marts.shortage_current(log).select("entity_id", "generic_name", "status", "observed_at")


@query("index_series_mart", f"WITH {LOG_SQL}, {fold_sql(FOREVER)} SELECT entity_id AS period, json_extract_string(payload, '$.k')::DOUBLE AS gscpi, record_time AS observed_at FROM state")
def index_series_mart(spark, d):
    payload = F.concat(F.lit('{"observation_date": "'), F.col("entity_id"), F.lit('", "value": '), F.get_json_object("payload", "$.k"), F.lit("}"))
    log = log_of(spark, d).withColumns({"payload": payload, "event_type": F.lit("index_value_observed")})
    return marts.index_series(log)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every entity as believed at a moment, corrections honoured."""
    return QUERIES["fold_point_in_time_datetime"](spark, sf_dir)


__all__ = ["QUERIES", "SQL", "entry", "iso"]
