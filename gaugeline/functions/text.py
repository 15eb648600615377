"""Text forms: one-decimal numbers, report lines, byte sizes and time spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.numbers import NUMBER

REPORT_NUMBERS = ("min_v", "mean_v", "max_v")

# Words that count as numbers in a report.
WORDS = "^[+-]?(inf|infinity|nan)$"


def fixed(value: Column, places: int = 1) -> Column:
    """`places` decimals, the exact binary value rounded half even, no thousands separator.

    Known exception of the JVM formatter: exactly +-0.0005 at three places gives 0.000, not 0.001.
    """
    return F.call_function("format_number", value, F.lit("0." + "0" * places))


def units_text(units: Column, scale: int = 1) -> Column:
    return fixed(units.cast("double") / F.lit(float(10**scale)))


def parse_report(lines: DataFrame) -> DataFrame:
    """report, station, parsed, min_v, mean_v, max_v from report lines in column `report`.

    The last `=` separates, so a station name may hold `=` and `/` itself. A line that is no report
    line stands for itself as station, without numbers.
    """
    cut = lines.selectExpr("report", "substring_index(report, '=', -1) AS tail").selectExpr(
        "report",
        "cast(substring(cast(report AS BINARY), 1, octet_length(report) - octet_length(tail) - 1) AS STRING) AS name",
        "if(octet_length(tail) < octet_length(report), split(tail, '/', -1), array()) AS numbers",
    )
    values = cut.selectExpr(
        "report",
        "name",
        *[f"if(size(numbers) = 3, numbers[{i}], NULL) AS {field}" for i, field in enumerate(REPORT_NUMBERS)],
    )
    # The DOUBLE cast alone would take `1.0d` and `1f`.
    values = values.select(
        "report",
        "name",
        *[
            F.when(F.col(field).rlike(NUMBER) | F.lower(F.trim(field)).rlike(WORDS), F.col(field).try_cast("double")).alias(field)
            for field in REPORT_NUMBERS
        ],
    )
    parsed = " AND ".join(f"{field} IS NOT NULL" for field in REPORT_NUMBERS)
    return values.selectExpr("*", f"{parsed} AS parsed").selectExpr(
        "report",
        "if(parsed, name, report) AS station",
        "parsed",
        *[f"if(parsed, {field}, NULL) AS {field}" for field in REPORT_NUMBERS],
    )


# Unit names in steps of 1024.
BYTE_UNITS = ("bytes", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")


def byte_text(size: Column) -> Column:
    """One decimal and a unit; the last unit has no upper bound."""
    size = size.cast("double")
    out = None
    for power, unit in enumerate(BYTE_UNITS):
        part = size / F.lit(1024.0**power)
        text = F.concat(fixed(part), F.lit(f" {unit}"))
        fits = (part < 1024.0) | F.lit(unit == BYTE_UNITS[-1])
        out = F.when(fits, text) if out is None else out.when(fits, text)
    return out


def elapsed_text(seconds: Column) -> Column:
    """`1.500 seconds`, `2 minutes 5 seconds`, `1 hours 2 minutes 3 seconds`."""
    seconds = seconds.cast("double")

    def whole(x: Column) -> Column:
        return F.floor(x).cast("string")

    secs = F.concat(whole(F.pmod(seconds, F.lit(60.0))), F.lit(" seconds"))
    in_hour = F.floor(F.pmod(seconds, F.lit(3600.0)) / 60)
    hours = F.concat(whole(seconds / 3600), F.lit(" hours "))
    minutes = F.concat(in_hour.cast("string"), F.lit(" minutes "))
    return (
        F.when(seconds < 60, F.concat(fixed(seconds, 3), F.lit(" seconds")))
        .when(seconds < 3600, F.concat(minutes, secs))
        .when(in_hour == 0, F.concat(hours, secs))
        .otherwise(F.concat(hours, minutes, secs))
    )
