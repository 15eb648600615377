"""Median run time per entry and the ranking by it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.operators.order import sorted_table, with_position
from gaugeline.session import shared_dir


def upper_median(runs: DataFrame, key: str, value: str) -> DataFrame:
    """key, median: the value at 0-based index floor(n/2) of each key's sorted values. Exact.

    Equal values of a key are counted before anything is moved. The counts are sorted by key and value
    over all partitions; with a row count per key and partition it is known in which partition a key's
    middle lies, and only there are rows counted on. A key with most of the rows is spread like any other.
    """
    counts = (
        runs.select(F.col(key).alias("k"), F.col(value).alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy("k", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = sorted_table(counts, "k", "v")
    # One row per key, and one more for each border between partitions.
    parts = placed.groupBy("k", "_part").agg(F.sum("n").alias("rows"))
    by_key = Window.partitionBy("k")
    upto = F.sum("rows").over(by_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    rank = F.floor(F.sum("rows").over(by_key) / 2) + 1
    parts = parts.select("k", "_part", "rows", upto.alias("upto"), rank.alias("rank"))
    found = parts.where("upto >= rank AND upto - rows < rank").select(
        F.col("k").alias("hk"), F.col("_part").alias("hp"), (F.col("rank") - F.col("upto") + F.col("rows")).alias("need")
    )
    near = placed.join(found, F.col("k").eqNullSafe(F.col("hk")) & (F.col("_part") == F.col("hp")))
    running = F.sum("n").over(Window.partitionBy("k", "_part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    middle = near.withColumn("running", running).where("running >= need AND running - n < need")
    return middle.select(F.col("k").alias(key), F.col("v").alias("median"))


def leaderboard(runs: DataFrame) -> DataFrame:
    """rank, entry, median_s from run times (entry, seconds and, if present, ok)."""
    if "ok" in runs.columns:
        runs = runs.where("ok")
    # One row per entry, kept so that the sort's sampling does not compute the medians again.
    shared_dir(runs.sparkSession)
    medians = upper_median(runs, "entry", "seconds").withColumnRenamed("median", "median_s").checkpoint()
    return with_position(medians, "median_s", "entry", name="rank").select("rank", "entry", "median_s")
