"""What the operators share: intermediate tables in the cluster's shared folder, and code shipped to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

from ledgerfold.storage import Workspace, shared_dir

_shipped: set[str] = set()

#: Words end at ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once an application, wherever they start from."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerfold-code-"), "ledgerfold_code.zip")
    with zipfile.ZipFile(out, "w") as z:
        for d, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(d, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(out)
    _shipped.add(app)


def fields(df: DataFrame, *names: str) -> DataFrame:
    """Just these columns; what else the table has, under whatever name, plays no part."""
    return df.select(*[df[n] for n in names])


__all__ = ["WORD", "Workspace", "fields", "shared_dir", "ship"]
