"""Files in and out: lines, separated values, reports and state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.numbers import decimal, is_number, units_of, wide
from gaugeline.operators.parse import BLANKS


def read_lines(spark: SparkSession, path: str | list[str], line_sep: str | None = None) -> DataFrame:
    r"""Lines as `value`. Without `line_sep` all of \n, \r\n and \r end a line."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(path)


def read_csv_measurements(spark: SparkSession, path: str | list[str], scale: int = 1) -> DataFrame:
    """`measurements` rows through the CSV parser: all NULL where a row is not a name and a number.

    Quotes are part of the station.
    """
    return csv_fields(read_lines(spark, path), scale).select("station", "t", "big")


def csv_fields(lines: DataFrame, scale: int = 1) -> DataFrame:
    """value, station, t, big, reason: each line parsed as separated values; `reason` as `parse_lines` gives it.

    The lines are read as text first: the CSV reader replaces bytes that are not UTF-8, which would
    make one key of several, and loses blank lines.
    """
    options = {"sep": ";", "quote": "", "escape": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    fields = F.from_csv("value", "station string, number string, bad string", options)
    rows = lines.select("value", F.is_valid_utf8("value").alias("valid"), fields.alias("f")).select("value", "valid", "f.*")
    # The decimal is a column of its own, as the units name it more than once.
    two = F.col("valid") & F.col("bad").isNull()
    rows = rows.select("*", two.alias("two"), F.when(two & is_number("number"), decimal("number", scale)).alias("exact"))
    rows = rows.select("*", F.expr(units_of("exact", scale)).alias("t"), F.when(F.col("two"), wide("number", "exact")).alias("big"))
    counts = F.col("t").isNotNull() | F.col("big").isNotNull()
    reason = (
        F.when(~F.col("valid"), "bad_utf8")
        .when(counts, None)
        .when(F.btrim("value", F.lit(BLANKS)) == "", "blank")
        .when(~F.contains("value", F.lit(";")), "no_separator")
        .when(F.col("bad").isNotNull(), "extra_separator")
        .otherwise("bad_number")
    )
    # An empty key reads as NULL.
    name = F.coalesce("station", F.lit(""))
    return rows.select("value", F.when(counts, name).alias("station"), "t", "big", reason.alias("reason"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "report")


def write_report(report: DataFrame, path: str) -> None:
    """Text in station order: the part files in name order form the report.

    A range-partitioned sort writes them in parallel; a small report ends up as one file, because
    adaptive execution joins small partitions.
    """
    report.orderBy("station").select("report").write.option("lineSep", "\n").text(path)


def write_measurements(generated: DataFrame, path: str) -> None:
    generated.select("line").write.option("lineSep", "\n").text(path)


def write_state(state: DataFrame, path: str, mode: str = "append") -> None:
    """Add partial states to a state table; `merge_states(read_state(...))` sums it up."""
    state.write.mode(mode).parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
