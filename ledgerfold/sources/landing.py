"""The landing zone: what was fetched, byte for byte, under a name made of its content."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def land(folder: str | Path, source: str, name: str, content: bytes, fetched_at: str) -> Path:
    """Writes once; the same content fetched again the same day is the same file."""
    path = Path(folder) / source / f"{fetched_at}_{name}_{hashlib.sha256(content).hexdigest()[:12]}"
    path.parent.mkdir(parents=True, exist_ok=True)
    if not path.exists():
        part = path.with_name(f".{path.name}.part")
        part.write_bytes(content)
        part.rename(path)
    return path


def landed(folder: str | Path) -> list[Path]:
    """All landed files, by folder and name."""
    return sorted(p for p in Path(folder).rglob("*") if p.is_file() and not p.name.startswith("."))


def tampered(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files whose name doesn't end with the digest of their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.substring(F.sha2("content", 256), 1, 12).alias("digest")).where(~F.endswith("path", "digest"))
