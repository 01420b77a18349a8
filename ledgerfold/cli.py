"""python -m ledgerfold.cli: from published documents to the log, and on to the models.

Lanes run in a fixed order, which fixes the order of seq: snapshots, vintages, tariffs, mirrors, index, movements.
A lane whose documents aren't there is left out.  The log is only ever appended to; a second run over the same
documents appends nothing.
"""

from __future__ import annotations

import argparse
import datetime
import json
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.envelope import FOREVER
from ledgerfold.functions.fingerprint import record_key
from ledgerfold.functions.normalize import normalize_records
from ledgerfold.operators import capture, custody
from ledgerfold.operators.append import append
from ledgerfold.plans.models import Build
from ledgerfold.session import session
from ledgerfold.sources import client as live
from ledgerfold.sources import files
from ledgerfold.sources.landing import land
from ledgerfold.sources.registry import write_seed
from ledgerfold.storage import scope

Lane = Callable[[SparkSession, Path, str], list[DataFrame]]
SERIES = "MNFCTRIRSA"


def _sourced(rows: DataFrame, source: str) -> DataFrame:
    return rows.withColumn("source", F.lit(source))


def snapshots(spark: SparkSession, folder: Path, today: str) -> list[DataFrame]:
    out = []
    if (folder / "shortages.json").exists():
        r = normalize_records(files.read_results(spark, str(folder / "shortages.json")).drop("position"), mdy=("update_date", "initial_posting_date", "change_date", "discontinued_date"))
        key = record_key("shortage", *[F.col(c) if c in r.columns else F.lit(None).cast("string") for c in ("generic_name", "company_name", "presentation", "package_ndc")])
        out.append(capture.record_observations(r, key, F.col("update_date"), today, "fda_shortage_observed"))
    if (folder / "recalls.json").exists():
        r = normalize_records(files.read_results(spark, str(folder / "recalls.json")).drop("position"), ymd=("recall_initiation_date", "report_date", "termination_date", "center_classification_date"))
        key = F.concat(F.lit("recall:"), F.coalesce("recall_number", F.lit("UNKNOWN")))
        out.append(capture.record_observations(r, key, F.col("report_date"), today, "fda_recall_observed"))
    return [_sourced(o, "openfda") for o in out]


def vintages(spark: SparkSession, folder: Path, today: str) -> list[DataFrame]:
    path = folder / "vintages.json"
    return [_sourced(capture.vintage_replay(files.read_vintages(spark, str(path)), SERIES), "alfred")] if path.exists() else []


def tariffs(spark: SparkSession, folder: Path, today: str) -> list[DataFrame]:
    path = folder / "revisions.json"
    return [_sourced(capture.revision_replay(files.read_revisions(spark, str(path), str(folder))), "usitc_hts")] if path.exists() else []


def mirrors(spark: SparkSession, folder: Path, today: str) -> list[DataFrame]:
    names = ("importer_cif.json", "exporter_fob.json", "importer_fob.json")
    if not all((folder / n).exists() for n in names):
        return []
    sides = [files.read_sdmx(spark, str(folder / n)).select(F.lit("CAN-CHN").alias("pair"), F.col("period").alias("year"), "value") for n in names]
    rows = capture.mirror_observations(capture.reconcile(*sides), today)
    return [_sourced(rows.withColumn("event_time", F.concat("event_time", F.lit("-12-31"))), "imf_imts")]


def index(spark: SparkSession, folder: Path, today: str) -> list[DataFrame]:
    found = [p for p in (folder / "index.parquet", folder / "index.csv", folder / "index.xlsx", folder / "index.xls") if p.exists()]
    return [_sourced(capture.index_observations(files.read_index_series(spark, str(found[0])), today), "gscpi")] if found else []


def pharma(spark: SparkSession, folder: Path, today: str) -> list[DataFrame]:
    path = folder / "recalls.json"
    if not path.exists():
        return []
    picked = custody.pick_recall(files.read_results(spark, str(path))).first()
    if picked is None:
        raise files.EmptySource("no recall names a product code")
    return [_sourced(custody.movements(spark, list(picked["ndcs"]), today), "pharma_synthetic")]


LANES: dict[str, Lane] = {"fda": snapshots, "alfred": vintages, "hts": tariffs, "imf": mirrors, "gscpi": index, "pharma": pharma}


#: What each lane reads, of which it lands what is there.
DOCUMENTS = {
    "fda": ("shortages.json", "recalls.json"),
    "alfred": ("vintages.json",),
    "hts": ("revisions.json",),
    "imf": ("importer_cif.json", "exporter_fob.json", "importer_fob.json"),
    "gscpi": ("index.parquet", "index.csv", "index.xlsx", "index.xls"),
    "pharma": (),
}
# The keys of the bilateral reports.
PAIR_KEYS = {"importer_cif.json": "CAN.MG_CIF_USD.CHN.A", "exporter_fob.json": "CHN.XG_FOB_USD.CAN.A", "importer_fob.json": "CAN.MG_FOB_USD.CHN.A"}


def clients(**options) -> dict[str, live.Client]:
    """One client for each live source, so that pacing and circuit hold across all its calls."""
    return {name: live.Client(name, spacing=spacing, **options) for name, spacing in (("openfda", 0.6), ("alfred", 1.0), ("imf", 1.0), ("gscpi", 1.0))}


def fetch(folder: Path, source: str = "all", key: str | None = None, by: dict[str, live.Client] | None = None) -> list[str]:
    """Fetches what has a live source into the folder of documents; the names of what was fetched."""
    by, got = by or clients(), {}
    if source in ("all", "fda"):
        got |= {f"{kind}.json": live.fetch_snapshot(by["openfda"], kind) for kind in ("shortages", "recalls")}
    if source in ("all", "alfred") and (key or "").strip():
        got["vintages.json"] = live.fetch_vintages(by["alfred"], SERIES, key)
    if source in ("all", "imf"):
        got |= {name: live.fetch_series(by["imf"], series) for name, series in PAIR_KEYS.items()}
    if source in ("all", "gscpi"):
        got["index.xlsx"] = live.fetch_index(by["gscpi"])
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in got.items():
        (folder / name).write_bytes(content)
    return list(got)


def fetch_tariffs(folder: Path, revisions: list[dict], client: live.Client | None = None) -> None:
    """Fetches these revisions (effective_from, label, and the name the archive has for them) and their index."""
    client = client or live.Client("usitc_hts", spacing=1.0)
    folder.mkdir(parents=True, exist_ok=True)
    index = [{"effective_from": r["effective_from"], "label": r["label"], "file": f"{r['name']}.json"} for r in revisions]
    for r, entry in zip(revisions, index):
        (folder / entry["file"]).write_bytes(live.fetch_revision(client, r["name"]))
    (folder / "revisions.json").write_text(json.dumps({"revisions": index}))


def land_documents(folder: Path, landing: Path, lane: str, today: str) -> list[Path]:
    """Lands the bytes of a lane's documents, as they were read."""
    return [land(landing, lane, name, (folder / name).read_bytes(), today) for name in DOCUMENTS[lane] if (folder / name).exists()]


def ingest(spark: SparkSession, documents: str | Path, out: str | Path, source: str = "all", today: str | None = None) -> dict[str, int]:
    """Runs the lanes; gives the number of events each has appended to out/log.  What they read is in out/landing."""
    today = today or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d")
    log_path, counts = f"{out}/log", {}
    for name, lane in LANES.items():
        if source not in ("all", name):
            continue
        land_documents(Path(documents), Path(out) / "landing", name, today)
        rows = lane(spark, Path(documents), today)
        if not rows:
            continue
        columns = ("event_type", "source", "entity_id", "event_time", "record_time", "payload")
        batch = reduce(DataFrame.unionAll, [r.select(*columns) for r in rows])
        with scope():
            fresh = append(files.read_log(spark, log_path), batch, top=files.top_seq(spark, log_path)).cache()
            counts[name] = fresh.count()
            if counts[name]:
                files.write_log(fresh, log_path)
            fresh.unpersist()
    write_seed(spark, f"{out}/registry")
    return counts


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--documents", required=True, help="folder of published documents")
    p.add_argument("--out", required=True, help="folder of the log and the models")
    p.add_argument("--source", default="all", choices=["all", *LANES])
    p.add_argument("--as-of", help="record time of snapshots (default: today, UTC), and the moment of as-of models")
    p.add_argument("--live", action="store_true", help="fetch documents first")
    p.add_argument("--key", help="key of the vintage source")
    p.add_argument("--build", action="store_true", help="write the models and report violations")
    a = p.parse_args(argv)
    spark = session()
    if a.live:
        fetch(Path(a.documents), a.source, a.key)
    print(ingest(spark, a.documents, a.out, a.source, a.as_of))
    if a.build:
        build = Build(files.read_log(spark, f"{a.out}/log"), a.as_of or FOREVER, f"{a.out}/models")
        build.run()
        failed = build.violations().where("violations > 0").collect()
        for r in failed:
            print(f"{r['check']}: {r['violations']} violations")
        if failed:
            raise SystemExit(1)


if __name__ == "__main__":
    main()
