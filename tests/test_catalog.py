"""Every query of the catalogue against its SQL, and streams against batches."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from ledgerfold.operators import folds
from ledgerfold.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df):
    text = lambda v: "null" if v is None or v is pd.NA or v is pd.NaT or v != v else repr(float(v)).removesuffix(".0") if isinstance(v, float) else str(v)
    return sorted(tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, other, name):
    ours, theirs = catalog.QUERIES[name](spark, SF).toPandas(), other.sql(catalog.SQL[name]).df()
    ours = ours.astype({c: object for c in ours if str(ours[c].dtype) == "float64" and str(theirs[c].dtype) != "float64"})
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_report_has_every_pair_and_year(spark):
    report = catalog.QUERIES["reconciliation_report"](spark, SF).toPandas()
    assert len(report) == catalog.QUERIES["trade_asymmetry_mart"](spark, SF).count() > 50
    missing = report["residual_usd"].isna()
    assert 0 < missing.sum() < len(report) and missing.is_monotonic_increasing
    assert report["residual_usd"][~missing].abs().is_monotonic_decreasing


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.SQL) <= set(__spark_entry__.oracle_sql()) and set(catalog.QUERIES) <= set(__spark_entry__.queries())


def test_log_on_disk_is_pruned(spark, tmp_path):
    from ledgerfold.sources.files import read_jsonl_log, read_log, write_jsonl_log, write_log

    log = catalog.log_of(spark, SF)
    write_log(log, str(tmp_path / "log"))
    back = read_log(spark, str(tmp_path / "log"))
    early = folds.fold_state(back, "2024-01-10")
    assert "record_date" in early._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]
    assert early.count() == folds.fold_state(log, "2024-01-10").count()
    write_jsonl_log(log, str(tmp_path / "json"))
    assert read_jsonl_log(spark, str(tmp_path / "json")).count() == log.count()
    assert read_log(spark, str(tmp_path / "none")).count() == 0 == read_jsonl_log(spark, str(tmp_path / "none")).count()


def test_streaming_append(spark, tmp_path):
    from ledgerfold.sources.files import read_log
    from ledgerfold.streaming.incremental import append_to_log

    for _ in range(2):  # a restart without the checkpoint delivers all of it again
        rows = catalog.bucketed(spark, SF)
        rows.write.mode("overwrite").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        append_to_log(stream, str(tmp_path / "log"), str(tmp_path / f"checkpoint{_}")).awaitTermination()
    assert read_log(spark, str(tmp_path / "log")).count() == catalog.QUERIES["change_only_append"](spark, SF).count()


def test_registry_seed(spark, tmp_path):
    from ledgerfold.sources.registry import SOURCES, read_seed, write_seed

    write_seed(spark, str(tmp_path / "seed"))
    assert sorted(map(tuple, read_seed(spark, str(tmp_path / "seed")).collect())) == sorted(SOURCES)


def test_late_changes_are_compared_with_what_they_follow(spark, tmp_path):
    from ledgerfold.streaming.incremental import run_changes

    schema = "entity_id string, record_time string, seq long, payload_hash string"
    for n, rows in enumerate(([("e", "1", 1, "A"), ("e", "5", 2, "B"), ("f", "1", 3, "A")], [("e", "3", 4, "A"), ("e", "4", 5, "C"), ("f", "2", 6, "A")], [("f", "3", 7, None), ("f", "4", 8, None)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        found = run_changes(stream, f"{tmp_path}/out")
    assert sorted(r["seq"] for r in found.collect()) == [1, 2, 3, 5, 7]


def events_table(spark, path, rows):
    """rows: (event_id, seconds after 2024-01-10, user_id, event_type, k); each seventh id is recorded six hours late."""
    made = spark.createDataFrame(rows, "event_id long, at long, user_id long, event_type string, k int")
    made.selectExpr("event_id", "timestamp_seconds(unix_timestamp(timestamp'2024-01-10 00:00:00') + at) AS ts", "user_id", "event_type", "0D AS value", "concat('{\"k\": ', k, '}') AS props").write.parquet(f"{path}/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet/*.parquet'")
    return con


NOON = 12 * 3600
#: Users with several observations recorded at one moment: 1 and 2 have first what is unchanged, then a change; 3's are
#: numbered in another order than they are compared in, and what follows them is unchanged.
MOMENTS = [(1, 0, 1, "view", 0), (7, NOON // 2, 1, "view", 0), (2, NOON, 1, "view", 1), (3, 0, 2, "view", 0), (4, NOON, 2, "view", 0), (5, NOON, 2, "click", 1), (6, NOON, 2, "view", 2)]
MOMENTS += [(14, NOON // 2, 3, "view", 0), (8, NOON, 3, "click", 1), (9, NOON + 60, 3, "view", 1)]


def test_a_replay_of_several_observations_of_a_moment_adds_nothing(spark, tmp_path):
    con = events_table(spark, tmp_path, MOMENTS)
    ours = {r["run"]: r["n"] for r in catalog.QUERIES["new_events_per_run"](spark, str(tmp_path)).collect()}
    assert ours == dict(con.sql(catalog.SQL["new_events_per_run"]).fetchall()) and ours[2] == ours[3] == 0


#: A user's observations that are equal but for their types, delivered in four orders.
TIED = [(7 * u + i + 1, u, u, ("view", "click", "signup", "error")[(u + i) % 4], 0) for u in range(100) for i in range(4)]


def completed(name):
    """The SQL with the ties of its orders resolved: by type, and by event_time."""
    kept, seq = "ORDER BY record_time, event_time, payload_hash", "ORDER BY record_time, entity_id, event_type, payload_hash"
    return catalog.SQL[name].replace(f"{kept})", f"{kept}, event_type)").replace(f"{seq})", f"{seq}, event_time)")


def test_of_observations_equal_but_for_their_types_the_first_by_type_is_kept(spark, tmp_path):
    con, name = events_table(spark, tmp_path, TIED), "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # so that a user's observations come from several tasks
    try:
        ours = catalog.QUERIES["change_only_append"](spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.set(name, before)
    assert rows(ours) == rows(con.sql(completed("change_only_append")).df())
    assert set(ours["event_type"]) == {"click"} and len(ours) == 100


def test_a_restart_makes_what_one_append_of_all_makes(spark, tmp_path):
    """Several observations of a moment, on both sides of the restart, equal ones among them."""
    later = [(7 * n + (3 if n % 7 else 0) + 1000 * 7, at + 5 * 86400 * (u % 2), u, t, k) for n, (_, at, u, t, k) in enumerate(MOMENTS)]
    con = events_table(spark, tmp_path, MOMENTS + later + [(7001, NOON, 1, "click", 1), (7002, NOON, 3, "error", 1)])
    ours = catalog.QUERIES["replay_after_restart"](spark, str(tmp_path)).toPandas()
    assert rows(ours) == rows(con.sql(completed("replay_after_restart")).df())
