"""Change capture of each kind of source, marts and quality, and the whole way from documents."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerfold import cli
from ledgerfold.functions import normalize, rates
from ledgerfold.operators import capture, custody, folds, joins
from ledgerfold.plans import marts, quality
from ledgerfold.plans.models import MODELS, Build
from ledgerfold.sources import files
from ledgerfold.sources.landing import land, landed, tampered

SERIES = "MNFCTRIRSA"


def vintage_matrix(days, believed):
    """believed: for each observation date what each vintage said of it, None where that vintage has no such cell."""
    cell = lambda d: f"{SERIES}_{d.replace('-', '')}"
    return {"observations": [{"date": at} | {cell(d): v for d, v in zip(days, said) if v is not None} for at, said in believed.items()]}


VINTAGE_DAYS = ("2031-04-10", "2031-05-12", "2031-06-09")
BELIEVED = {
    "2031-01-01": ("7.10", "7.10", "7.25"),  # revised late
    "2031-02-01": (".", "7.02", "7.02"),  # not known at first
    "2031-03-01": (None, "6.90", "6.95"),
    "2031-04-01": (None, None, "6.80"),
    "2031-05-01": ("", ".", None),  # never known
}
VINTAGES = vintage_matrix(VINTAGE_DAYS, BELIEVED)
CODES = {
    "0101.10.00.00": ("Free",) * 3,
    "0202.20.30.10": ("Free", "2.75%", "2.75%"),
    "5555.55.00.05": ("6%", "6%", " 8 % "),
    "6161.70.40.00": ("12.5%", "13%", "12.5%"),
    "7000.00.11.22": ("45 cents/doz",) * 3,
    "8181.90.90.90": ("1% + 9 cents/kg",) * 3,
}
DATES = ("2030-02-01", "2031-02-01", "2032-02-01")
CIF = {"2020": "900", "2021": "1250.5", "2022": None}
FOB = {"2020": "640", "2021": "1200.25", "2023": "17"}


def sdmx(values):
    periods = sorted(values)
    return {"data": {"dataSets": [{"series": {"0:0": {"attributes": [], "observations": {str(i): [values[p], None] for i, p in enumerate(periods)}}}}], "structures": [{"dimensions": {"series": [], "observation": [{"id": "TIME_PERIOD", "values": [{"value": p} for p in periods]}]}}]}}


@pytest.fixture
def documents(tmp_path):
    d = tmp_path / "documents"
    d.mkdir()
    put = lambda n, x: (d / n).write_text(json.dumps(x))
    put("vintages.json", VINTAGES)
    put("revisions.json", {"revisions": [{"effective_from": t, "label": f"rev {i}", "file": f"rev{i}.json", "federal_register": "-"} for i, t in enumerate(DATES)]})
    for i in range(3):
        lines = [{"htsno": "3304", "indent": "0", "description": "heading", "general": "", "units": [], "footnotes": []}]
        put(f"rev{i}.json", lines + [{"htsno": f" {c} ", "indent": "1", "description": f"goods {c}", "general": r[i], "units": ["No."], "footnotes": []} for c, r in CODES.items()])
    put("importer_cif.json", sdmx(CIF))
    put("exporter_fob.json", sdmx(FOB))
    put("importer_fob.json", sdmx({"2020": "820"}))
    put("shortages.json", {"meta": {}, "results": [{"generic_name": "Quietol", "company_name": "Mill & Son", "presentation": "drops", "package_ndc": "71", "status": "Current", "availability": "Avaliable", "update_date": "03/05/2031"}, {"generic_name": "Noisol", "company_name": None, "presentation": "drops", "package_ndc": "72", "status": "Current", "availability": "Limited", "update_date": ""}]})
    put("recalls.json", {"meta": {}, "results": [{"recall_number": "R-500", "status": "On-Going", "report_date": "20310301", "product_description": "unnamed goods", "openfda": {}}, {"recall_number": "R-501", "status": "Terminated", "reason_for_recall": "wrong label", "report_date": "20310302", "product_description": "e" * 120, "openfda": {"product_ndc": ["90-1", "90-2", "90-3", "90-4"]}}]})
    (d / "index.csv").write_text("when,what\n2029-01-31,0.75\n2029-02-28,-2.5\nnever,3\n2029-03-31,\n")
    return d


def test_from_documents_to_models_and_again(spark, documents, tmp_path):
    out = tmp_path / "out"
    first = cli.ingest(spark, documents, out, today="2031-07-01")
    assert first == {"fda": 4, "alfred": 6, "hts": 10, "imf": 2, "gscpi": 2, "pharma": 54}
    assert not any(cli.ingest(spark, documents, out, today="2031-07-01").values())
    log = files.read_log(spark, f"{out}/log")
    assert sorted(r["seq"] for r in log.select("seq").collect()) == list(range(78))
    # a field that changes is one event
    recalls = json.loads((documents / "recalls.json").read_text())
    recalls["results"][0]["termination_date"] = "20310624"
    recalls["results"][1]["termination_date"] = None
    (documents / "recalls.json").write_text(json.dumps(recalls))
    assert cli.ingest(spark, documents, out, "fda", "2031-07-02") == {"fda": 1}
    build = Build(files.read_log(spark, f"{out}/log"), "2031-07-01")
    made = build.run()
    assert set(made) == set(MODELS)
    assert {r["check"]: r["violations"] for r in build.violations().collect() if r["violations"]} == {}
    assert made["fda_shortage_current"].where("entity_id like 'shortage:%' and availability = 'Available' and update_date = '2031-03-05'").count() == 1
    assert [(r["period"], r["gscpi"]) for r in made["gscpi_series"].collect()] == [("2029-01-01", 0.75), ("2029-02-01", -2.5)]
    report = made["reconciliation_report"].collect()
    assert report[0]["year"] == "2020" and report[0]["residual_usd"] == 180 and report[0]["residual_share_pct"] == 69.2
    assert {(r["source"], r["events"]) for r in made["source_event_counts"].collect()} >= {("alfred", 6), ("usitc_hts", 10)}
    assert made["lot_current_location"].count() == 9 and made["chain_of_custody"].count() == 54
    assert build.get("current_state") is made["current_state"]


def test_vintage_folds_equal_the_columns(spark, documents):
    matrix = files.read_vintages(spark, str(documents / "vintages.json"))
    rows = capture.vintage_replay(matrix, "MNFCTRIRSA")
    log = rows.withColumns({"event_id": F.concat("entity_id", "record_time"), "is_error_declaration": F.lit(False), "seq": F.lit(0).cast("long")})
    assert rows.count() == 6
    for v, n in zip(VINTAGE_DAYS, (1, 3, 4)):
        folded = folds.fold_state(log, v).select(F.col("event_time").alias("observation_date"), folds.field("value").alias("value"))
        answer = capture.vintage_answer(matrix, "MNFCTRIRSA", v)
        assert answer.count() == n and joins.differences(folded, answer).count() == 0
    with pytest.raises(ValueError):
        capture.vintage_cells(matrix, "OTHER")


def test_tariffs_equal_the_revision_in_force(spark, documents):
    lines = files.read_revisions(spark, str(documents / "revisions.json"), str(documents))
    log = capture.revision_replay(lines).withColumns({"event_id": F.concat("entity_id", "record_time"), "is_error_declaration": F.lit(False), "seq": F.lit(0).cast("long")}).cache()
    assert log.count() == 10
    for day in ("2030-01-31", "2030-02-01", "2031-01-31", "2031-02-01", "2032-02-01", "2040-01-01"):
        mart = marts.duty_rates(log, day).select(F.col("hts_code").alias("code"), "general_rate_raw")
        in_force = capture.rated_lines(joins.last_revision(lines, "code", day)).select("code", "general_rate_raw")
        assert joins.differences(mart, in_force).count() == 0, day
    assert quality.rate_without_kind(marts.duty_rates(log)).count() == 0
    # no price changes after the fact
    goods = spark.createDataFrame([(200.02, "HTS:6161.70.40.00", "2030-06-01"), (200.02, "HTS:6161.70.40.00", "2031-09-01"), (1.0, "HTS:7000.00.11.22", "2032-09-01"), (1.0, "HTS:none", "2032-09-01")], "value double, entity_id string, day string")
    versions = log.select("entity_id", "record_time", folds.field("ad_valorem_rate", "double").alias("rate"), folds.field("rate_kind").alias("kind"))
    priced = joins.as_of_join(goods, versions, ["entity_id"], "day", "record_time", ["rate", "kind"])
    duty = {(r["entity_id"], r["day"]): r["d"] for r in priced.select("entity_id", "day", rates.landed_duty(F.col("value"), F.col("rate"), F.col("kind")).alias("d")).collect()}
    assert duty == {("HTS:6161.70.40.00", "2030-06-01"): 25.0, ("HTS:6161.70.40.00", "2031-09-01"): 26.0, ("HTS:7000.00.11.22", "2032-09-01"): None, ("HTS:none", "2032-09-01"): None}
    with pytest.raises(Exception, match="no ad valorem duty"):
        priced.where("kind = 'specific'").select(rates.landed_duty(F.col("value"), F.col("rate"), F.col("kind"), strict=True)).collect()


@pytest.mark.parametrize(
    "raw, want",
    [("Free", (0.0, "free")), (" free ", (0.0, "free")), ("2.75%", (0.0275, "ad_valorem")), (" 10 % ", (0.1, "ad_valorem")), ("4% + 11 cents/kg", (None, "compound")), ("45 cents/doz", (None, "specific")), ("$1.50 each", (None, "specific")), ("5/ KG", (None, "specific")), ("see note", (None, "unparsed")), ("", (None, "unparsed")), (None, (None, "unparsed")), ("Free (A)", (None, "unparsed"))],
)
def test_rates(spark, raw, want):
    r = spark.createDataFrame([(raw,)], "raw string").select(rates.parse_rate(F.col("raw")).alias("r")).first()["r"]
    assert tuple(r) == want


def test_mirrors(spark):
    t = lambda rows: spark.createDataFrame([("p", y, v) for y, v in rows], "pair string, year string, value double")
    rows = {r["year"]: r for r in capture.reconcile(t([("1", 100.0), ("2", 0.0), ("3", 50.0), ("4", 1.0), ("5", 100.0)]), t([("1", 60.0), ("2", 5.0), ("3", 50.0), ("5", 95.0)]), t([("1", 90.0)])).collect()}
    assert set(rows) == {"1", "2", "3", "5"}
    assert (rows["1"]["gap"], rows["1"]["gap_pct"], rows["1"]["valuation"], rows["1"]["residual"], rows["1"]["within_tolerance"]) == (40.0, 40.0, 10.0, 30.0, False)
    assert rows["2"]["gap_pct"] is None and rows["2"]["within_tolerance"] and rows["3"]["gap_pct"] is None
    assert rows["5"]["residual"] is None and rows["5"]["within_tolerance"]


def test_an_empty_cube_is_an_error(spark):
    with pytest.raises(Exception, match="zero series"):
        files.parse_sdmx(spark.createDataFrame([('{"data":{"dataSets":[{"series":{}}]}}',)], "value string")).collect()


def test_normalization_and_its_notes(spark):
    rows = spark.createDataFrame([("On-Going", "20310809", "02/03/2031", "13/45/2031"), ("Ongoing", "2031080", None, "x")], "status string, a string, b string, c string")
    one, two = normalize.normalize_records(rows, ymd=("a", "missing"), mdy=("b", "c")).collect()
    assert (one["status"], one["a"], one["b"], one["c"]) == ("Ongoing", "2031-08-09", "2031-02-03", "2031-13-45")
    assert one["_normalizations"] == ["enum:status:On-Going->Ongoing", "date:a:YYYYMMDD->ISO", "date:b:MM/DD/YYYY->ISO", "date:c:MM/DD/YYYY->ISO"]
    assert two["_normalizations"] is None and two["a"] == "2031080"


def test_snapshots(spark):
    t = lambda rows: spark.createDataFrame(rows, "entity_id string, payload_hash string")
    new = capture.snapshot_diff(t([("a", "1"), ("b", "2"), ("c", None), ("d", None)]), t([("a", "1"), ("b", "1"), ("c", None), ("gone", "1")]))
    assert sorted(r["entity_id"] for r in new.collect()) == ["b", "d"]


def test_drill_shows_belief_and_fact(spark):
    codes = ["90-1", "90-2", "90-3"]
    rows = custody.movements(spark, codes, "2031-05-06")
    log = rows.withColumns({"source": F.lit(marts.PHARMA), "event_id": F.concat("entity_id", "event_time"), "is_error_declaration": F.lit(False), "seq": F.row_number().over(__import__("pyspark").sql.Window.orderBy("entity_id", "event_time")).cast("long"), "payload_hash": F.sha2("payload", 256)}).cache()
    assert log.count() == 54 and log.where("record_time > event_time").count() == 3
    noon = custody.drill(log, codes, "2031-05-06T10:45", marts.PHARMA).collect()
    now = custody.drill(log, codes, "9999-12-31", marts.PHARMA)
    assert len(noon) == 9 and all(r["holder"].startswith("HUB") for r in noon)
    assert all(r["holder"].startswith("SHOP-") and r["chain"].startswith("MAKER -> HUB") and r["chain"].endswith(r["holder"]) for r in now.collect())
    assert all(r["chain"].count("->") == 1 for r in custody.drill(log, codes, "2031-05-06T10:45", marts.PHARMA, as_of_chain=True).collect())
    text = custody.render(now, "Recall")
    assert text.splitlines()[0] == "Recall" and len(text.splitlines()) == 10
    told = custody.render(now, "Recall", {"recall_number": "R-501", "status": "Ongoing", "description": "goods", "reason": "x" * 200})
    assert told.splitlines()[1:3] == ["R-501 [Ongoing] goods", "because: " + "x" * 90] and len(told.splitlines()) == 12
    assert custody.drill(log, spark.createDataFrame([("90-1",)], "ndc string"), "9999-12-31", marts.PHARMA).count() == 3


def test_late_recording_alone_changes_the_holder(spark):
    from ledgerfold.envelope import ENVELOPE

    row = lambda seq, step, holder, at, known: (seq, f"i{seq}", step, "s", "lot:1", at, known, json.dumps({"ndc": "1", "holder_after": holder}), "h", False, None, None, "[]")
    log = spark.createDataFrame([row(0, "ship", "TRUCK", "2031-05-06T08:00", "2031-05-06T08:00"), row(1, "receive", "SHOP", "2031-05-06T09:00", "2031-05-06T21:15")], ENVELOPE)
    held = lambda t: custody.drill(log, ["1"], t, "s").first()["holder"]
    assert held("2031-05-06T12:00") == "TRUCK" and held("2031-05-06T22:00") == "SHOP"


def test_recall_picker(spark, documents):
    picked = custody.pick_recall(files.read_results(spark, str(documents / "recalls.json"))).first()
    assert picked["recall_number"] == "R-501" and picked["ndcs"] == ["90-1", "90-2", "90-3"] and len(picked["description"]) == 80 and picked["reason"] == "wrong label"


def test_landing(spark, tmp_path):
    a = land(tmp_path, "src", "x.json", b"one", "2026-08-01")
    assert land(tmp_path, "src", "x.json", b"one", "2026-08-01") == a and landed(tmp_path) == [a]
    land(tmp_path, "src", "x.json", b"two", "2026-08-01")
    assert tampered(spark, str(tmp_path)).count() == 0
    a.write_bytes(b"changed")
    assert tampered(spark, str(tmp_path)).count() == 1


@pytest.mark.parametrize("head, engine", [(b"\xd0\xcf\x11\xe0rest", "xlrd"), (b"PK\x03\x04rest", "openpyxl")])
def test_workbooks_by_their_first_bytes_and_sheet(spark, tmp_path, monkeypatch, head, engine):
    """Which reader is asked, and for which sheet; the readers themselves may not be installed."""
    import pandas as pd

    asked = []

    class Book:
        def __init__(self, content, engine):
            asked.append((content.read()[:4], engine))
            self.sheet_names = ["About", files.INDEX_SHEET]

        def parse(self, sheet):
            asked.append(sheet)
            return pd.DataFrame({"Date": ["2031-01-31", "2031-02-28", "no date", None], "Index": [0.25, -1.5, 3.0, 4.0], "more": [1, 2, 3, 4]})

    monkeypatch.setattr(pd, "ExcelFile", Book)
    (tmp_path / "index.xlsx").write_bytes(head)
    rows = files.read_index_series(spark, str(tmp_path / "index.xlsx")).collect()
    assert [tuple(r) for r in rows] == [("2031-01-01", 0.25), ("2031-02-01", -1.5)] and asked == [(head[:4], engine), files.INDEX_SHEET]
    files.read_index_series(spark, str(tmp_path / "index.xlsx"), "no such sheet").collect()
    assert asked[-1] == 0
