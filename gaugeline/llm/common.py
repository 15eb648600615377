"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import fresh_path

# Words of a text: maximal runs of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes of rows that Spark hands to a Python worker at a time, where the session says nothing: texts differ
# in length by a factor of thousands, so a number of rows alone doesn't bound a worker's memory.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the cluster's shared folder and read again, which also cuts its lineage."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, as `--py-files` does; once per application.

    The archive only passes through a temporary folder of the driver, which serves it to the executors.
    Batches are bounded in bytes, too, unless the session has a bound of its own.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="gaugeline-py-"), "gaugeline_py.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores in front until no column of `df` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
