"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_own_dirs: dict[str, str] = {}
_scopes: list[list[Workspace]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or by setCheckpointDir; where neither is set (tests, one machine), a
    temporary one.  On a cluster a folder of this machine would lose rows, so there one has to be named."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if sc.applicationId not in _own_dirs:
        _own_dirs[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="ledgerfold-")
        atexit.register(lambda d: shutil.rmtree(d.removeprefix("file://"), ignore_errors=True), _own_dirs[sc.applicationId])
    return _own_dirs[sc.applicationId]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


#: Shuffle files of a query go as soon as it has ended, not when the driver happens to collect its garbage.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """While a table is written; what it was made of is not needed again."""
    before = spark.conf.get(CLEAN, None)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN) if before is None else spark.conf.set(CLEAN, before)


@contextmanager
def scope() -> Iterator[None]:
    """Workspaces made within are removed at the end: for callers that have written what they wanted of them."""
    _scopes.append([])
    try:
        yield
    finally:
        for ws in _scopes.pop():
            ws.drop()


class Workspace:
    """Written tables under the shared folder.  They cut lineage, so a lost executor costs only the running stage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        if _scopes:
            _scopes[-1].append(self)

    def put(self, df: DataFrame, name: str, **options) -> DataFrame:
        with cleaned(self.spark):
            df.write.options(compression="zstd", **options).parquet(f"{self.root}/{name}")
        return self.get(df, name)

    def counted(self, df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
        """put(), and what an aggregate of the rows written gives: seen while they are written, without another job.
        Recomputed tasks may count rows twice, so only none or some can be told from a number."""
        seen = Observation()
        out = self.put(df.observe(seen, *[c.alias(n) for n, c in (counts or {"n": F.count(F.lit(1))}).items()]), name)
        return out, {k: v or 0 for k, v in seen.get.items()}

    def get(self, df: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
