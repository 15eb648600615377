"""Comparison of two reports, by station or line by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.text import REPORT_NUMBERS, parse_report
from gaugeline.operators.order import run_starts, stored, tasks_for


def diff_by_station(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """station, status, expected, actual for two frames with a `report` column.

    Both sides are tagged, united and aggregated: one shuffle with map-side partials, and a station
    that a damaged report repeats many times costs no more than its rows. Numbers count as equal by
    value, so `-0.0` equals `0.0`.
    """
    sides = (
        parse_report(expected)
        .withColumn("side", F.lit(0))
        .unionByName(parse_report(actual).withColumn("side", F.lit(1)))
    )

    def count_of(side: int):
        return F.count_if(F.col("side") == side)

    def first_of(side: int):
        return F.min(F.when(F.col("side") == side, F.col("report")))

    # Per distinct triple of numbers first (0.0 and -0.0 are one), so that repeated lines can be matched.
    lines = sides.groupBy("station", "parsed", *REPORT_NUMBERS).agg(
        count_of(0).alias("n_expected"),
        count_of(1).alias("n_actual"),
        first_of(0).alias("expected"),
        first_of(1).alias("actual"),
    )
    both = lines.groupBy("station", "parsed").agg(
        F.sum("n_expected").alias("n_expected"),
        F.sum("n_actual").alias("n_actual"),
        F.count_if(F.col("n_expected") != F.col("n_actual")).alias("n_unmatched"),
        F.min("expected").alias("expected"),
        F.min("actual").alias("actual"),
    )
    status = (
        F.when(F.col("n_actual") == 0, "missing")
        .when(F.col("n_expected") == 0, "extra")
        .when(F.col("n_unmatched") == 0, "equal")
        .otherwise("changed")
    )
    return both.select("station", status.alias("status"), "expected", "actual")


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# Positions that one row is expanded to at a time.
_STEP = 1 << 16

# Positions of both reports per task of the last grouping, of which those that differ arrive there.
_TASK_POSITIONS = 1 << 19


def diff_by_position(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """pos, expected, actual where the lines at the same position of the sorted reports differ.

    Equal lines of both reports are counted first, and each distinct line becomes a run of positions in
    either report. Where the two runs of a line overlap the reports agree; only positions outside of the
    overlap become rows. The cost follows the distinct lines and the differences, not the length of the reports.
    """

    def side(report: DataFrame, nr: int) -> DataFrame:
        # A report that still has its station column isn't parsed again.
        rows = report if "station" in report.columns else parse_report(report)
        return rows.select("station", "report", F.lit(nr).alias("side"))

    lines = side(expected, 0).unionByName(side(actual, 1)).groupBy("station", "report")
    counted = lines.agg(F.count_if(F.col("side") == 0).alias("e"), F.count_if(F.col("side") == 1).alias("a"))
    counted = stored(counted, "runs")
    length = counted.agg(F.sum(F.col("e") + F.col("a"))).first()[0] or 0
    runs = run_starts(counted, ["station", "report"], ["e", "a"])
    runs = runs.withColumn("lo", F.greatest("start_e", "start_a")).withColumn("hi", F.expr("least(start_e + e, start_a + a)"))

    def outside(nr: int) -> list[Column]:
        """Pieces of one report's run that aren't in the overlap; without an overlap the first is the whole run."""
        first, last = (F.col("start_e"), F.col("start_e") + F.col("e")) if nr == 0 else (F.col("start_a"), F.col("start_a") + F.col("a"))
        lo, hi = (F.when(F.col("lo") < F.col("hi"), c).otherwise(last) for c in (F.col("lo"), F.col("hi")))
        return [F.struct(F.lit(nr).alias("side"), x.alias("at"), y.alias("to")) for x, y in ((first, lo), (hi, last))]

    rows = runs.select("report", F.explode(F.array(*outside(0), *outside(1))).alias("p")).select("report", "p.*").where("at < `to`")
    rows = rows.select("report", "side", "to", F.explode(F.expr(f"sequence(at, `to` - 1, {_STEP}L)")).alias("at"))
    rows = rows.select("report", "side", F.explode(F.expr(f"sequence(at, least(`to`, at + {_STEP}L) - 1)")).alias("at"))
    # One row per position and side: a grouping pairs them without a join. They are dealt first, as a grouping
    # ahead of the shuffle would sort them for nothing.
    rows = rows.select("report", "side", (F.col("at") + 1).alias("pos"))
    rows = rows.repartition(tasks_for(length, _TASK_POSITIONS), "pos")
    sides = [F.max(F.when(F.col("side") == nr, F.col("report"))).alias(name) for nr, name in enumerate(("expected", "actual"))]
    return rows.groupBy("pos").agg(*sides)
