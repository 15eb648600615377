"""Session settings and the shared folder for tables written between stages."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Pools larger than this are joined by shuffle instead of being broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


def local_session(app: str, cores: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Skips the per-column call-site capture while a plan is built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only a local master may fall back to a temporary one.

    Sets the session's checkpoint folder if none is set. A `file:` folder is refused on a cluster: it
    would be another one on each machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="gaugeline-")
    if folder.startswith("file:") and not sc.master.startswith("local"):
        raise ValueError(f"{folder} isn't a folder that every executor can reach")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder. `drop_intermediate` deletes what was written there."""
    path = f"{shared_dir(spark).rstrip('/')}/gaugeline-{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_intermediate(spark: SparkSession) -> int:
    """Delete the tables that operators of this application wrote between stages; how many there were.

    Only the caller knows when results that read them are used up.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def broadcast_if_small(df: DataFrame, text_col: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark `df` for broadcast once its measured size is known to fit, else leave the join to Spark.

    `df` is read once to be measured, so it should be cheap to recompute (checkpointed or tiny).
    """
    per_row = 64  # row header, fixed columns and hash-table slot
    size = df.agg(F.sum(F.octet_length(text_col) + F.lit(per_row)).alias("b")).first()["b"] or 0
    return F.broadcast(df) if size <= limit else df
