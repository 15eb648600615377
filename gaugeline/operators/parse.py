"""Lines `station;number` to typed rows, and the reasons for the lines that are none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.numbers import decimal, is_number, units_of, wide

SEPARATOR = ";"
# What counts as outer blank of a line.
BLANKS = " \t\n\r\x0b\x0c"


def _fields(lines: DataFrame, scale: int, trim_station: bool) -> DataFrame:
    """Columns value, line, left, t, big. Both are NULL unless the line is two fields, the second a number.

    t has the units of the number; one of 10^18 units and more is the double `big` instead.

    The number is what follows the last separator. The key is the bytes before it, cut by length:
    that needs no second search and keeps bytes that are not UTF-8 as they are. A key that holds a
    separator itself shows that there were more than two fields.
    """
    line = F.btrim("value", F.lit(BLANKS)) if trim_station else F.col("value")
    cut = (
        lines.select("value", line.alias("line"))
        .selectExpr("value", "line", f"substring_index(line, '{SEPARATOR}', -1) AS right")
        .selectExpr(
            "value",
            "line",
            "right",
            "cast(substring(cast(line AS BINARY), 1, octet_length(line) - octet_length(right) - 1) AS STRING) AS left",
        )
    )
    two = F.expr(f"octet_length(right) < octet_length(line) AND NOT contains(left, '{SEPARATOR}')")
    # The decimal is a column of its own, as the units name it more than once.
    number = F.when(two & is_number("right"), decimal("right", scale))
    cut = cut.select("value", "line", "left", "right", two.alias("two"), number.alias("number"))
    large = F.when(F.col("two"), wide("right", "number"))
    return cut.select("value", "line", "left", F.expr(units_of("number", scale)).alias("t"), large.alias("big"))


def measurements(lines: DataFrame, scale: int = 1, trim_station: bool = False) -> DataFrame:
    """Hot path: station and t, both NULL for a malformed line; `big` in place of t for a very large number.

    Nothing is filtered here: a filter on `t` would make Spark parse each line twice. All malformed
    lines share the NULL key, so they collapse in the partial aggregation however many there are.
    The key is not yet known to be UTF-8; `measurement_state` tests that once per station.
    """
    rows = _fields(lines, scale, trim_station)
    return rows.selectExpr("if(t IS NULL AND big IS NULL, NULL, left) AS station", "t", "big")


def parse_lines(lines: DataFrame, scale: int = 1, trim_station: bool = False) -> DataFrame:
    """value, station, t, big, reason: `reason` is NULL for good lines, station, t and big for the others."""
    rows = _fields(lines, scale, trim_station)
    separators = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(SEPARATOR), F.lit("")))
    reason = (
        F.when(~F.is_valid_utf8("value"), "bad_utf8")
        .when(F.col("t").isNotNull() | F.col("big").isNotNull(), None)
        .when(F.btrim("value", F.lit(BLANKS)) == "", "blank")
        .when(separators == 0, "no_separator")
        .when(separators > 1, "extra_separator")
        .otherwise("bad_number")
    )
    rows = rows.withColumn("reason", reason)
    good = F.col("reason").isNull()
    return rows.select(
        "value",
        F.when(good, F.col("left")).alias("station"),
        F.when(good, F.col("t")).alias("t"),
        F.when(good, F.col("big")).alias("big"),
        "reason",
    )


def reject_counts(lines: DataFrame, scale: int = 1, trim_station: bool = False) -> DataFrame:
    """reason, n over the malformed lines."""
    counts = parse_lines(lines, scale, trim_station).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    # The test names n as well, so that it stays above the aggregation (one parse per line).
    return counts.where(F.when(F.col("reason").isNotNull(), F.col("n")).otherwise(0) > 0)
