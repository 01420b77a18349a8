"""The envelope, appends, declarations and folds."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from ledgerfold.envelope import ENVELOPE, InvalidEvents
from ledgerfold.operators import folds
from ledgerfold.operators.append import append, declare_errors

BATCH = "event_type string, source string, entity_id string, event_time string, record_time string, payload string"


def empty(spark):
    return spark.createDataFrame([], ENVELOPE)


def batch(spark, rows):
    """rows: (entity, value, event_time, record_time)"""
    return spark.createDataFrame([("t", "s", e, et, rt, f'{{"v": {v}}}') for e, v, et, rt in rows], BATCH)


MICRO = [("E1", 1, "2026-01-01", "2026-01-02"), ("E1", 2, "2026-01-01", "2026-01-05"), ("E2", 9, "2026-01-01", "2026-01-03")]


def grown(log, rows):
    return log.unionByName(append(log, rows))


def state(log, as_of="9999-12-31"):
    return {r["entity_id"]: r["v"] for r in folds.fold_state(log, as_of).select("entity_id", folds.field("v", "int").alias("v")).collect()}


def test_sequence_and_ids(spark):
    log = append(empty(spark), batch(spark, MICRO)).orderBy("seq").collect()
    assert [r["seq"] for r in log] == [0, 1, 2] and [r["record_time"] for r in log] == ["2026-01-02", "2026-01-03", "2026-01-05"]
    assert len({r["event_id"] for r in log}) == 3 and all(len(r["payload_hash"]) == 16 for r in log)


def test_rescission_counts_from_its_own_time(spark):
    log = append(empty(spark), batch(spark, MICRO)).cache()
    wrong = log.where("payload = '{\"v\": 2}'").first()["event_id"]
    one = spark.createDataFrame([(wrong, "2026-01-06", "typo", ["x"])], "event_id string, declaration_time string, reason string, corrective_event_ids array<string>")
    log = log.unionByName(declare_errors(log, one)).cache()
    assert state(log, "2026-01-05") == {"E1": 2, "E2": 9}
    assert state(log, "2026-01-07") == {"E1": 1, "E2": 9}
    assert log.where(f"event_id = '{wrong}'").count() == 2
    with pytest.raises(InvalidEvents):
        declare_errors(log, one)
    with pytest.raises(InvalidEvents):
        declare_errors(log, one.selectExpr("'nothing' AS event_id", "declaration_time", "reason", "corrective_event_ids"))
    # what is seen again after it was rescinded is compared with what is visible
    assert append(log, batch(spark, [("E1", 2, "2026-01-01", "2026-01-08")])).count() == 1
    assert append(log, batch(spark, [("E1", 1, "2026-01-01", "2026-01-08")])).count() == 0


def test_a_date_means_the_start_of_its_day(spark):
    log = append(empty(spark), batch(spark, [("E", 1, "2026-07-29", "2026-07-29"), ("E", 2, "2026-07-30", "2026-07-30T06:00")]))
    assert state(log, "2026-07-30") == {"E": 1} and state(log, "2026-07-30T06:00") == {"E": 2}


def test_revert_is_a_change_and_replay_is_none(spark):
    rows = batch(spark, [("E", 1, "2026-01-01", "2026-01-01"), ("E", 1, "2026-01-01", "2026-01-02"), ("E", 2, "2026-01-01", "2026-01-03"), ("E", 1, "2026-01-01", "2026-01-04")])
    log = append(empty(spark), rows).cache()
    assert log.count() == 3
    assert append(log, rows).count() == 0
    until_b = rows.where("record_time <= '2026-01-03'")
    log = append(empty(spark), until_b)
    assert append(log, until_b).count() == 0
    assert append(log, until_b, mode="arrival").count() == 1  # the observation left out at first comes after B
    with pytest.raises(ValueError):
        append(log, rows, mode="other")


def test_late_backfill(spark):
    log = append(empty(spark), batch(spark, [("E", 1, "2026-01-01", "2026-01-01"), ("E", 1, "2026-01-01", "2026-01-03")]))
    log = grown(log, batch(spark, [("E", 2, "2026-01-01", "2026-01-02")])).cache()
    assert state(log, "2026-01-02") == {"E": 2}
    assert grown(log, batch(spark, [("E", 1, "2026-01-01", "2026-01-03")])).count() == 3


def test_faulty_events_are_refused(spark):
    for bad in (("E", 1, "01/02/2026", "2026-01-01"), (None, 1, "2026-01-01", "2026-01-01")):
        with pytest.raises(Exception, match="not fit"):
            append(empty(spark), batch(spark, [bad])).collect()


def by_hand(events, as_of):
    seen = [e for e in events if e[3] <= as_of]
    gone = {e[1] for e in seen if e[4]}
    out = {}
    for e in sorted((e for e in seen if not e[4] and e[1] not in gone), key=lambda e: (e[3], e[0])):
        out[e[2]] = e[0]
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data())
def test_folds_equal_a_fold_by_hand(spark, data):
    n = data.draw(st.integers(0, 12))
    day = st.integers(1, 6).map(lambda d: f"2026-01-0{d}")
    events = [(i, f"id{i}", data.draw(st.sampled_from("ABC")), data.draw(day), False) for i in range(n)]
    wrong = data.draw(st.lists(st.sampled_from(range(n)), unique=True, max_size=3)) if n else []
    events += [(n + k, f"id{i}", events[i][2], data.draw(day), True) for k, i in enumerate(wrong)]
    log = spark.createDataFrame([(s, i, "t", "s", e, t, t, "{}", "h", d, None, None, "[]") for s, i, e, t, d in events], ENVELOPE)
    as_of = data.draw(day)
    want = by_hand(events, as_of)
    for fold in (folds.fold_state, folds.fold_state_max_by):
        assert {r["entity_id"]: r["seq"] for r in fold(log, as_of).collect()} == want


def test_history_and_counts(spark):
    log = append(empty(spark), batch(spark, MICRO))
    rows = {(r["entity_id"], r["valid_from"]): r["valid_to"] for r in folds.history(log).collect()}
    assert rows == {("E1", "2026-01-02"): "2026-01-05", ("E1", "2026-01-05"): None, ("E2", "2026-01-03"): None}
    registered = spark.createDataFrame([("s",), ("none",)], "source string")
    assert {tuple(r) for r in folds.source_event_counts(log, registered).collect()} == {("s", 3, 2), ("none", 0, 0)}


def test_the_fold_limits_before_it_shuffles(spark):
    log = append(empty(spark), batch(spark, MICRO))
    plan = folds.fold_state(log)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_one_day_is_numbered_by_many_tasks(spark):
    """A snapshot's events all have one record_time; no task gets more than its share."""
    from ledgerfold.operators.append import sequenced

    n = 40_000
    events = spark.range(n).selectExpr("'2031-01-01' AS record_time", "concat('e', id) AS entity_id", "'t' AS event_type", "sha2(cast(id AS string), 256) AS payload_hash", "'2031-01-01' AS event_time")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sequenced(events, 7).cache()
        assert out.selectExpr("min(seq) a", "max(seq) b", "count(DISTINCT seq) n").first() == (7, n + 6, n)
        placed = out.select("seq", "entity_id").orderBy("seq").collect()
        assert [r["entity_id"] for r in placed] == sorted(f"e{i}" for i in range(n))
        tasks = events.repartitionByRange("record_time", "entity_id").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) == 4 and max(r["count"] for r in tasks) < n / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_scopes_remove_what_they_made(spark, tmp_path):
    import os

    from ledgerfold.storage import Workspace, scope

    kept = Workspace(spark, "kept")
    with scope():
        gone = Workspace(spark, "gone")
        out = kept.put(gone.put(spark.range(5), "a"), "b")
        with pytest.raises(ValueError), scope():
            inner = Workspace(spark, "inner")
            inner.put(spark.range(1), "c")
            raise ValueError
        assert not os.path.exists(inner.root.removeprefix("file://")) and os.path.exists(gone.root.removeprefix("file://"))
    assert out.count() == 5 and not os.path.exists(gone.root.removeprefix("file://"))


def test_a_large_day_is_written_by_many_tasks(spark, tmp_path):
    from ledgerfold.sources.files import read_log, top_seq, write_log

    log = spark.range(60_000).selectExpr("id AS seq", "concat('i', id) AS event_id", "'t' AS event_type", "'s' AS source", "concat('e', id) AS entity_id", "'2031-01-01' AS event_time", "'2031-01-01' AS record_time", "sha2(cast(id AS string), 512) AS payload", "'h' AS payload_hash", "false AS is_error_declaration", "CAST(NULL AS string) AS declaration_time", "CAST(NULL AS string) AS reason", "'[]' AS corrective_event_ids").repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        assert top_seq(spark, str(tmp_path / "log")) == -1
        write_log(log, str(tmp_path / "log"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "log" / "source=s" / "record_date=2031-01-01").glob("*.parquet"))) > 3
    assert top_seq(spark, str(tmp_path / "log")) == 59_999 and read_log(spark, str(tmp_path / "log")).count() == 60_000


def test_append_reads_the_batch_s_days_only(spark, tmp_path):
    from ledgerfold.operators import append as appends
    from ledgerfold.sources.files import read_log, top_seq, write_log

    path = str(tmp_path / "log")
    row = lambda e, day, v: ("t", "s", e, day, day, v)
    batch = lambda *rows: spark.createDataFrame(rows, "event_type string, source string, entity_id string, event_time string, record_time string, payload string")
    for b in (batch(row("a", "2031-01-01", "1"), row("b", "2031-01-01", "1")), batch(row("a", "2031-01-05", "2")), batch(row("a", "2031-01-03", "1"), row("b", "2031-01-03", "2"))):
        write_log(appends.append(read_log(spark, path), b, top=top_seq(spark, path)), path)
    log = read_log(spark, path)
    assert sorted((r["seq"], r["entity_id"], r["record_time"]) for r in log.collect()) == [(0, "a", "2031-01-01"), (1, "b", "2031-01-01"), (2, "a", "2031-01-05"), (3, "b", "2031-01-03")]
    # what was said on the fifth is wrong; that was declared after the batch's last day, and counts
    write_log(appends.declare_errors(log, spark.createDataFrame([(log.where("seq = 1").first()["event_id"], "2031-02-01", "no", [])], "event_id string, declaration_time string, reason string, corrective_event_ids array<string>")), path)
    again = appends.append(read_log(spark, path), batch(row("b", "2031-01-02", "1")), top=top_seq(spark, path))
    assert [(r["seq"], r["entity_id"]) for r in again.collect()] == [(5, "b")]
    plan = appends.not_replayed(appends.with_defaults(batch(row("a", "2031-01-05", "2"))), appends.between(read_log(spark, path), "2031-01-05", "2031-01-05"))._jdf.queryExecution().executedPlan().toString()
    assert "record_date#" in plan.split("PartitionFilters")[1][:200]


def test_a_revert_within_a_moment_is_appended(spark):
    """What another batch says of a moment comes after what the log has of it, whichever hash is smaller."""
    log = empty(spark)
    for day, a, b in (("2026-01-01", 1, 2), ("2026-01-02", 2, 1), ("2026-01-02", 1, 2)):
        log = grown(log, batch(spark, [("E1", a, "2026-01-01", day), ("E2", b, "2026-01-01", day)])).cache()
        assert state(log) == {"E1": a, "E2": b}
