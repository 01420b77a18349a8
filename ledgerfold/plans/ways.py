"""Queries that go the whole way: through files that are written and read again, sources, models and appends.

Their documents are made of the test tables, in as many files as the tables ask for, and kept in a workspace.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.envelope import FOREVER, event_id
from ledgerfold.functions import fingerprint, normalize
from ledgerfold.operators import append as appends
from ledgerfold.operators import capture, custody, folds, joins
from ledgerfold.plans import catalog, marts, quality
from ledgerfold.plans.catalog import ALL, BUCKETED_SQL, CUSTODY_SQL, STATE, THEN, bucketed, custody_log, log_of, query, tariff_log
from ledgerfold.plans.derived import LOG_SQL, MIRROR_SQL, REVISIONS, TARIFF_SQL, VINTAGE_SQL, fold_sql, observations, table, tariff_lines, vintage_matrix
from ledgerfold.plans.models import Build
from ledgerfold.sources import files, landing, registry
from ledgerfold.storage import Workspace

# ---- logs and documents on disk ----


@query("log_round_trip", f"WITH {LOG_SQL} SELECT {ALL} FROM e")
def log_round_trip(spark, d):
    path = f"{Workspace(spark, 'log').root}/log"
    files.write_log(log_of(spark, d), path)
    return files.read_log(spark, path).select(*STATE)


@query("log_scan_as_of", f"WITH {LOG_SQL}, {fold_sql(THEN)} SELECT {ALL} FROM state")
def log_scan_as_of(spark, d):
    """A fold over the log on disk, whose later days are never read."""
    path = f"{Workspace(spark, 'log').root}/log"
    files.write_log(log_of(spark, d), path)
    return folds.fold_state(files.read_log(spark, path), THEN).select(*STATE)


@query("jsonl_round_trip", f"WITH {LOG_SQL} SELECT {ALL}, is_error_declaration, declaration_time, reason, corrective_event_ids FROM e")
def jsonl_round_trip(spark, d):
    path = f"{Workspace(spark, 'jsonl').root}/log"
    files.write_jsonl_log(log_of(spark, d), path)
    return files.read_jsonl_log(spark, path).select(*STATE, "is_error_declaration", "declaration_time", "reason", "corrective_event_ids")


def documents(rows: DataFrame, by: str, name: str) -> str:
    """Writes one JSON document for each value of `by`, from (by, value) texts; gives the folder."""
    path = f"{Workspace(rows.sparkSession, name).root}/{name}"
    rows.select(by, "value").repartition(by).write.partitionBy(by).text(path)
    return path


_SUPPLIED = "SELECT s_suppkey, s_name, CASE s_suppkey % 3 WHEN 0 THEN 'Avaliable' WHEN 1 THEN 'Unvailable' ELSE 'Limited' END AS a, CASE WHEN s_suppkey % 4 = 0 THEN '02/03/20' || lpad((10 + s_suppkey % 20)::VARCHAR, 2, '0') ELSE '2030-01-02' END AS u FROM supplier"


@query(
    "fda_json_scan",
    f"""SELECT s_name AS generic_name, CASE a WHEN 'Avaliable' THEN 'Available' WHEN 'Unvailable' THEN 'Unavailable' ELSE a END AS availability,
  CASE WHEN s_suppkey % 4 = 0 THEN u[7:] || '-02-03' ELSE u END AS update_date,
  nullif(concat_ws('|', CASE WHEN a <> 'Limited' THEN 'enum:availability:' || a || '->' || CASE a WHEN 'Avaliable' THEN 'Available' ELSE 'Unavailable' END END, CASE WHEN s_suppkey % 4 = 0 THEN 'date:update_date:MM/DD/YYYY->ISO' END), '') AS notes
FROM ({_SUPPLIED})""",
)
def fda_json_scan(spark, d):
    """Records in documents {meta, results: [...]}, one for each nation, read and repaired."""
    key = F.col("s_suppkey")
    status = F.when(key % 3 == 0, "Avaliable").when(key % 3 == 1, "Unvailable").otherwise("Limited")
    date = F.when(key % 4 == 0, F.concat(F.lit("02/03/20"), F.lpad((10 + key % 20).cast("string"), 2, "0"))).otherwise("2030-01-02")
    record = F.struct(F.col("s_name").alias("generic_name"), status.alias("availability"), date.alias("update_date"))
    each = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.to_json(F.struct(F.struct(F.lit("made").alias("disclaimer")).alias("meta"), F.collect_list(record).alias("results"))).alias("value"))
    read = files.read_results(spark, documents(each, "s_nationkey", "fda"))
    return normalize.normalize_records(read.drop("position", "s_nationkey"), mdy=("update_date",)).select("generic_name", "availability", "update_date", F.array_join("_normalizations", "|").alias("notes"))


@query("vintage_json_scan", f"WITH {VINTAGE_SQL} SELECT 'LAST:' || observation_date AS entity_id, vintage AS record_time, value FROM cells QUALIFY value IS DISTINCT FROM lag(value) OVER (PARTITION BY observation_date ORDER BY vintage)")
def vintage_json_scan(spark, d):
    """Matrices of vintages in documents {observations: [...]}, read and replayed."""
    matrix = vintage_matrix(table(spark, d, "events"))
    cells = F.struct(*[F.coalesce(c, F.lit(".")).alias(c) for c in matrix.columns])
    each = matrix.groupBy(F.pmod(F.crc32("date"), F.lit(8)).alias("part")).agg(F.to_json(F.struct(F.collect_list(cells).alias("observations"))).alias("value"))
    return capture.vintage_replay(files.read_vintages(spark, documents(each, "part", "vintages")), "LAST").select("entity_id", "record_time", folds.field("value").alias("value"))


def tariff_documents(spark, d) -> DataFrame:
    """The lines of all revisions, by way of an index and a document for each revision."""
    root = Workspace(spark, "tariffs").root
    line = F.struct(F.col("code").alias("htsno"), F.lit("1").alias("indent"), "description", F.col("general_rate_raw").alias("general"), F.array(F.lit("No.")).alias("units"))
    each = tariff_lines(table(spark, d, "part")).groupBy("effective_from").agg(F.to_json(F.collect_list(line)).alias("value"))
    each.repartition(len(REVISIONS), "effective_from").write.partitionBy("effective_from").text(f"{root}/revisions")
    path = F.substring_index(F.col("_metadata.file_path"), "/revisions/", -1)
    names = {r["effective_from"]: r["name"] for r in spark.read.schema("value string, effective_from string").text(f"{root}/revisions").select("effective_from", path.alias("name")).distinct().collect()}
    index = [{"effective_from": t, "label": label, "file": names[t]} for t, label in REVISIONS if t in names]
    spark.createDataFrame([(json.dumps({"revisions": index}),)], "value string").coalesce(1).write.text(f"{root}/index")
    return files.read_revisions(spark, f"{root}/index", f"{root}/revisions")


@query("tariff_json_scan", f"WITH {TARIFF_SQL} SELECT code, effective_from, raw AS general_rate_raw, description FROM lines")
def tariff_json_scan(spark, d):
    return capture.rated_lines(tariff_documents(spark, d)).select("code", "effective_from", "general_rate_raw", "description")


@query(
    "tariff_label_recovery",
    f"WITH {TARIFF_SQL} SELECT 'HTS:' || code AS entity_id, effective_from AS record_time, CASE effective_from " + " ".join(f"WHEN '{t}' THEN '{label}'" for t, label in REVISIONS) + " END AS label FROM changed",
)
def tariff_label_recovery(spark, d):
    """The label of a revision, which observations leave out, by their effective date."""
    return joins.with_label(tariff_log(spark, d).select("entity_id", "record_time"), spark.createDataFrame(REVISIONS, "effective_from string, label string"), "record_time")


@query("index_csv_scan", "SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period, o_totalprice::DOUBLE AS value FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0")
def index_csv_scan(spark, d):
    """A series in two columns of a CSV file; rows without a date or a number go."""
    path = f"{Workspace(spark, 'index').root}/index.csv"
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.when(key % 5 == 0, "never").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("when"), F.when(key % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("what"))
    rows.write.csv(path, header=True)
    return files.read_index_series(spark, path)


@query("registry_seed", "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() for v in r) + ")" for r in registry.SOURCES) + ") t(source, lane, event_type, natural_key, cadence, has_native_history)")
def registry_seed(spark, d):
    path = f"{Workspace(spark, 'registry').root}/seed"
    registry.write_seed(spark, path)
    return registry.read_seed(spark, path)


@query("registry_empty", f"WITH {LOG_SQL} SELECT source, 0::BIGINT AS events FROM e WHERE false")
def registry_empty(spark, d):
    return folds.source_event_counts(log_of(spark, d), spark.createDataFrame([], "source string")).select("source", "events")


@query("landed_documents", "SELECT 'nations/2030-01-01_' || n_name || '_' || substr(sha256(n_name || n_regionkey), 1, 12) AS name, true AS intact FROM nation")
def landed_documents(spark, d):
    """A document for each nation, landed twice, listed, and held against the digests in the names."""
    root = f"{Workspace(spark, 'landing').root}/landing"
    folder = root.removeprefix("file://") if root.startswith("file:///") else root.removeprefix("file:")
    for r in table(spark, d, "nation").collect():
        for _ in range(2):
            landing.land(folder, "nations", r["n_name"], f"{r['n_name']}{r['n_regionkey']}".encode(), "2030-01-01")
    names = spark.createDataFrame([(f"nations/{p.name}",) for p in landing.landed(folder)], "name string")
    wrong = landing.tampered(spark, root).select(F.concat(F.lit("nations/"), F.element_at(F.split("path", "/"), -1)).alias("name"), F.lit(True).alias("wrong"))
    return names.join(wrong, "name", "left").select("name", F.col("wrong").isNull().alias("intact"))


# ---- models ----


@query("model_build", f"WITH {LOG_SQL}, {fold_sql(FOREVER)}, {fold_sql(THEN, 'earlier')} SELECT 'current_state' AS model, count(*) AS n FROM state UNION ALL SELECT 'point_in_time', count(*) FROM earlier UNION ALL SELECT 'history', count(*) FROM e WHERE NOT is_error_declaration UNION ALL SELECT 'aggregates', count(*) FROM (SELECT DISTINCT source, event_type FROM e WHERE NOT is_error_declaration)")
def model_build(spark, d):
    """Models written as tables, each after its parents, and read by their names."""
    build = Build(log_of(spark, d), THEN, f"{Workspace(spark, 'models').root}/models")
    names = ("current_state", "point_in_time", "history", "aggregates")
    build.run(*names)
    out = [spark.table(n).agg(F.count("*").alias("n")).select(F.lit(n).alias("model"), "n") for n in names]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


def flawed_asymmetry(spark, d) -> DataFrame:
    """The mart with parts that don't add up for every seventh year."""
    mart = catalog.asymmetry(spark, d)
    return mart.withColumn("residual_attribution_usd", F.col("residual_attribution_usd") + F.when(F.col("year").cast("int") % 7 == 0, 2.5).otherwise(0.5))


@query("quality_gap_not_explained", f"WITH {MIRROR_SQL} SELECT pair, year FROM mirror WHERE valuation IS NOT NULL AND year::INT % 7 = 0")
def quality_gap_not_explained(spark, d):
    return quality.gap_not_explained(flawed_asymmetry(spark, d)).select("pair", "year")


def flawed_rates(spark, d) -> DataFrame:
    """The schedule with rates lost, made up, of no kind and of a kind there isn't."""
    n = F.col("hts_code").cast("int")
    kind = F.when(n % 97 == 1, "guess").when(n % 89 != 2, F.col("rate_kind"))
    return marts.duty_rates(tariff_log(spark, d)).withColumns({"ad_valorem_rate": F.when(n % 11 == 0, 0.5).when(n % 13 != 0, F.col("ad_valorem_rate")), "rate_kind": kind})


_FLAWED_RATES = f"""{TARIFF_SQL},
flawed AS (SELECT code AS hts_code, CASE WHEN code::INT % 11 = 0 THEN 0.5::DOUBLE WHEN code::INT % 13 <> 0 THEN rate END AS ad_valorem_rate,
  CASE WHEN code::INT % 97 = 1 THEN 'guess' WHEN code::INT % 89 <> 2 THEN kind END AS rate_kind FROM (SELECT * FROM changed QUALIFY row_number() OVER (PARTITION BY code ORDER BY effective_from DESC) = 1))"""


@query("quality_rate_without_kind", f"WITH {_FLAWED_RATES} SELECT hts_code, rate_kind, ad_valorem_rate FROM flawed WHERE (rate_kind IN ('ad_valorem', 'free') AND ad_valorem_rate IS NULL) OR (rate_kind IN ('specific', 'compound', 'unparsed') AND ad_valorem_rate IS NOT NULL)")
def quality_rate_without_kind(spark, d):
    return quality.rate_without_kind(flawed_rates(spark, d))


@query(
    "quality_models",
    f"""WITH {LOG_SQL}, {fold_sql(FOREVER)}, {_FLAWED_RATES.replace('WITH ', '')},
versions AS (SELECT record_time AS valid_from, lead(record_time) OVER (PARTITION BY entity_id ORDER BY record_time, seq) AS valid_to, entity_id FROM e WHERE NOT is_error_declaration), {MIRROR_SQL}
SELECT 'current_state_entity_unique' AS "check", 0::BIGINT AS violations UNION ALL SELECT 'current_state_entity_not_null', count(*) FROM state WHERE entity_id IS NULL
UNION ALL SELECT 'history_entity_not_null', count(*) FROM versions WHERE entity_id IS NULL UNION ALL SELECT 'history_intervals', count(*) FROM versions WHERE valid_to < valid_from
UNION ALL SELECT 'duty_rate_code_unique', count(*) FROM (SELECT hts_code FROM flawed GROUP BY ALL HAVING count(*) > 1) UNION ALL SELECT 'duty_rate_code_not_null', count(*) FROM flawed WHERE hts_code IS NULL
UNION ALL SELECT 'duty_rate_kind_not_null', count(*) FROM flawed WHERE rate_kind IS NULL UNION ALL SELECT 'duty_rate_kind_accepted', count(*) FROM flawed WHERE rate_kind = 'guess'
UNION ALL SELECT 'duty_rate_as_of_code_unique', count(*) FROM (SELECT code FROM lines WHERE effective_from = '2024-05-15') WHERE false UNION ALL SELECT 'duty_rate_as_of_code_not_null', 0
UNION ALL SELECT 'asymmetry_sums', count(*) FROM mirror WHERE valuation IS NOT NULL AND year::INT % 7 = 0
UNION ALL SELECT 'duty_rate_or_flagged', count(*) FROM flawed WHERE (rate_kind IN ('ad_valorem', 'free') AND ad_valorem_rate IS NULL) OR (rate_kind IN ('specific', 'compound', 'unparsed') AND ad_valorem_rate IS NOT NULL)""",
)
def quality_models(spark, d):
    log = log_of(spark, d)
    tables = {"current_state": folds.fold_state(log), "history": folds.history(log), "duty_rate_current": flawed_rates(spark, d), "duty_rate_as_of": marts.duty_rates(tariff_log(spark, d), "2024-12-31"), "trade_asymmetry": flawed_asymmetry(spark, d)}
    return quality.summary(quality.model_checks(tables))


# ---- appends and observations ----


@query("last_hashes", f"WITH {LOG_SQL} SELECT entity_id, arg_max(payload_hash, (record_time, seq)) AS payload_hash FROM e WHERE NOT is_error_declaration GROUP BY entity_id")
def last_hashes(spark, d):
    """What a file of remembered hashes would hold."""
    return capture.last_hashes(log_of(spark, d))


@query("event_ids", f"WITH {LOG_SQL} SELECT seq, sha256(concat_ws('|', event_type, entity_id, event_time, record_time, payload_hash)) AS id FROM base")
def event_ids(spark, d):
    return observations(table(spark, d, "events")).select("seq", event_id().alias("id"))


@query("new_events_per_run", f"WITH {BUCKETED_SQL}, runs AS (SELECT CASE WHEN record_time < '{THEN}' THEN 1 ELSE 2 END AS run FROM kept) SELECT r.run, count(k.run) AS n FROM (VALUES (1), (2), (3)) r(run) LEFT JOIN runs k ON r.run = k.run GROUP BY r.run")
def new_events_per_run(spark, d):
    """Three runs over a log on disk: the first days, all days, and all again, which adds nothing."""
    path, out = f"{Workspace(spark, 'runs').root}/log", []
    batch = bucketed(spark, d)
    for run, rows in ((1, batch.where(F.col("record_time") < THEN)), (2, batch), (3, batch)):
        before = files.top_seq(spark, path)
        fresh = appends.append(files.read_log(spark, path), rows, top=before)
        files.write_log(fresh, path)
        out.append((run, files.top_seq(spark, path) - before))
    return spark.createDataFrame(out, "run int, n long")


@query("event_time_fallback", "SELECT 'order:' || o_orderkey AS entity_id, CASE o_orderkey % 3 WHEN 0 THEN '2030-05-05' WHEN 1 THEN '2030-05-05' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS event_time, '2030-05-05' AS record_time, o_orderstatus AS status FROM orders")
def event_time_fallback(spark, d):
    """Records whose own date is missing or empty take the day of the fetch."""
    o = table(spark, d, "orders")
    date = F.when(F.col("o_orderkey") % 3 == 1, "").when(F.col("o_orderkey") % 3 == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = o.select(F.col("o_orderkey").alias("key"), date.alias("date"), F.col("o_orderstatus").alias("status"))
    return capture.record_observations(rows, F.concat(F.lit("order:"), F.col("key").cast("string")), F.col("date"), "2030-05-05", "order_observed").select("entity_id", "event_time", "record_time", folds.field("status").alias("status"))


@query("workbook_kinds", "SELECT s_suppkey, s_suppkey % 3 = 0 AS is_ole FROM supplier")
def workbook_kinds(spark, d):
    """Old workbooks told from zipped ones by their first bytes."""
    head = F.when(F.col("s_suppkey") % 3 == 0, F.unhex(F.lit("D0CF11E0A1B11AE1"))).when(F.col("s_suppkey") % 3 == 1, F.unhex(F.lit("504B0304"))).otherwise(F.unhex(F.lit("D0")))
    return table(spark, d, "supplier").select("s_suppkey", fingerprint.is_ole(F.concat(head, F.col("s_name").cast("binary"))).alias("is_ole"))


# ---- custody ----


@query("recall_pick", "SELECT 'R-' || o_orderkey AS recall_number, list_transform(generate_series(1, least(3, (o_orderkey % 5)::INT)), lambda x: o_custkey || '-' || x).array_to_string(',') AS ndcs, substr(repeat(o_orderpriority || ' ', 20), 1, 80) AS description FROM orders WHERE o_orderkey % 5 > 0 AND o_orderkey % 4 = 3 ORDER BY o_orderkey LIMIT 1")
def recall_pick(spark, d):
    """The first record that names product codes; others have none, an empty list, or no such field."""
    key = F.col("o_orderkey")
    codes = F.when(key % 5 > 0, F.transform(F.sequence(F.lit(1), (key % 5).cast("int")), lambda i: F.concat_ws("-", F.col("o_custkey").cast("string"), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    named = F.when(key % 4 == 3, F.struct(codes.alias("product_ndc"))).when(key % 4 == 2, F.struct(F.lit(None).cast("array<string>").alias("product_ndc")))
    rows = table(spark, d, "orders").select(key.alias("position"), F.concat(F.lit("R-"), key.cast("string")).alias("recall_number"), named.alias("openfda"), F.expr("repeat(o_orderpriority || ' ', 20)").alias("product_description"))
    return custody.pick_recall(rows).select("recall_number", F.array_join("ndcs", ",").alias("ndcs"), "description")


@query("movement_steps", "SELECT s.event_type, (SELECT count(*) FROM nation) * 3 * s.n AS n, (SELECT count(*) FROM nation) * s.late AS late, s.clocks FROM (VALUES ('epcis_commission', 1, 0, 0::BIGINT), ('epcis_aggregate', 1, 0, 0), ('epcis_ship', 2, 0, 0), ('epcis_receive', 2, 1, 0)) s(event_type, n, late, clocks)")
def movement_steps(spark, d):
    """Lots of a product for each nation on their way: steps of each kind, those recorded late, and ill-formed clocks."""
    codes = [r["n_name"] for r in table(spark, d, "nation").select("n_name").collect()]
    rows = custody.movements(spark, codes, "2030-01-01")
    bad = ~F.col("event_time").rlike(r"^2030-01-01T([01][0-9]|2[0-3]):[0-5][0-9]$")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("record_time") > F.col("event_time")).alias("late"), F.count_if(bad).alias("clocks"))


@query("drill_text", f"WITH {CUSTODY_SQL}, {catalog._CHAIN}, {fold_sql(FOREVER, 'state', 'c')} SELECT lot, rpad(lot, 24, ' ') || ' ' || rpad(holder, 10, ' ') || ' ' || coalesce(chain, '') AS line FROM state LEFT JOIN chains USING (lot) WHERE ndc::INT % 5 = 0")
def drill_text(spark, d):
    recalled = table(spark, d, "part").where("p_partkey % 5 = 0").select(F.col("p_partkey").cast("string").alias("ndc"))
    return custody.lines(custody.drill(custody_log(spark, d), recalled, FOREVER, marts.PHARMA))

