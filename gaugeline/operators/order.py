"""Positions in a global order without moving all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.session import fresh_path, shared_dir

# `monotonically_increasing_id` holds the partition above bit 33 and the row number below.
_ROW_BITS = 33

# Rows of one task where the number of tasks follows the table instead of spark.sql.shuffle.partitions.
TASK_ROWS = 1 << 17


def tasks_for(rows: int, each: int | None = None) -> int:
    return max(1, -(-rows // (each or TASK_ROWS)))


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read again."""
    shared_dir(df.sparkSession)
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_table(df: DataFrame, *order: str, tasks: int | None = None) -> DataFrame:
    """`df` sorted over all partitions and written, with _part (the partition, in order) and _row (the row in it).

    Written, because counts per partition and the rows must come from the same sort even if an
    executor is lost in between. `tasks` is the number of partitions, else the session's.
    """
    ordered = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order) if tasks else df.orderBy(*order)
    placed = stored(ordered.select(*df.columns, F.monotonically_increasing_id().alias("_id")), "sorted")
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.select(*df.columns, F.shiftright("_id", _ROW_BITS).alias("_part"), row.alias("_row"))


def run_starts(df: DataFrame, order: list[str], counts: list[str]) -> DataFrame:
    """`df` with start_<c> for each column c of `counts`: its sum over all rows before, in the order of `order`.

    A row stands for a run of c equal ones, so that positions cost as much as there are distinct values. The sums
    before a partition are one row per sort partition; inside, each partition adds up its own rows.
    `df` is read three times (its number of rows, the sort's sample, the rows), so it should be a `stored` one.
    """
    tasks = tasks_for(df.count())
    placed = sorted_table(df, *order, tasks=tasks)
    sums = placed.groupBy("_part").agg(*(F.sum(c).alias(f"_sum_{c}") for c in counts))
    # One row per sort partition, TASK_ROWS times fewer than rows.
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_part", *(F.coalesce(F.sum(f"_sum_{c}").over(above), F.lit(0)).alias(f"_base_{c}") for c in counts))
    before = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    dealt = placed.repartition(tasks, "_part")
    within = dealt.select("_part", *df.columns, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_in_{c}") for c in counts))
    starts = [(F.col(f"_base_{c}") + F.col(f"_in_{c}")).cast("bigint").alias(f"start_{c}") for c in counts]
    return within.join(F.broadcast(bases), "_part").select(*df.columns, *starts)


def with_position(df: DataFrame, *order: str, name: str = "pos", unique: bool = True) -> DataFrame:
    """Add the 1-based position in the order of `order`.

    The sort is range partitioned. Each partition numbers its own rows; adding the row counts of
    the partitions before it gives the position. The counts read one number column only.

    With `unique=False` many rows may be equal in `order`. They get an arbitrary order among
    themselves from a row id, so that one repeated value can be split over partitions; the input is
    checkpointed first, which keeps that id the same when a task is run again.
    """
    shared_dir(df.sparkSession)
    keys, rows = list(order), df
    if not unique:
        rows = df.checkpoint().withColumn("_tie", F.monotonically_increasing_id())
        keys.append("_tie")
    placed = sorted_table(rows, *keys)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per sort partition: bounded by spark.sql.shuffle.partitions, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_row") + 1).alias(name)
    )
