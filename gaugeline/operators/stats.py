"""Mergeable per-station state, its merge, and the final text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.numbers import DIGITS
from gaugeline.operators.parse import measurements

# |t| < 2^60 splits into three parts below 2^20 each, so every BIGINT sum holds 2^43 rows per
# station. One plain BIGINT sum could be overflowed by a handful of absurd but legal numbers,
# and a DECIMAL(38) sum would leave Spark's fast aggregation map.
_LIMB = 20
_MASK = (1 << _LIMB) - 1
_LIMBS = {
    "hi": f"shiftright({{t}}, {2 * _LIMB})",
    "mid": f"shiftright({{t}}, {_LIMB}) & {_MASK}L",
    "lo": f"{{t}} & {_MASK}L",
}


def _total(hi: str, mid: str, lo: str) -> str:
    return f"cast(cast({hi} AS DECIMAL(38,0)) * {1 << 2 * _LIMB} + cast({mid} AS DECIMAL(38,0)) * {1 << _LIMB} + {lo} AS DECIMAL(38,0))"


_TOTAL = _total("hi", "mid", "lo")


def _limb_sums(t: str) -> list[Column]:
    return [F.expr(f"sum({part.format(t=t)}) AS {name}") for name, part in _LIMBS.items()]


def exact_sum(t: str) -> Column:
    """The sum of any BIGINT column as DECIMAL(38,0), good for 2^40 rows; a plain sum overflows by few large numbers."""
    return F.expr(_total(*(f"sum({part.format(t=t)})" for part in _LIMBS.values())))


def aggregate_state(rows: DataFrame, keys: Sequence[str] = ("station",)) -> DataFrame:
    """keys + mn, mx, s, n from rows with a whole-number column `t`, |t| < 2^60."""
    parts = rows.groupBy(*keys).agg(
        F.expr("min(t) AS mn"),
        F.expr("max(t) AS mx"),
        *_limb_sums("t"),
        F.expr("count(t) AS n"),
    )
    return parts.selectExpr(*keys, "mn", "mx", f"{_TOTAL} AS s", "n")


# The state of numbers of 10^18 units and more, doubles: how many, extremes, and the sum scaled down, so that
# even a sum of the largest doubles stays finite. n counts them, too; mn, mx and s leave them out.
_SCALE_DOWN = "18446744073709551616D"
_WIDE = {"n_big": "sum(n_big)", "low": "min(low)", "high": "max(high)", "small": "sum(small)"}


def measurement_state(rows: DataFrame) -> DataFrame:
    """State of `measurements` rows, with very large numbers beside the exact ones (n_big, low, high, small).

    Malformed lines and stations that are not UTF-8 are left out.
    """
    parts = rows.groupBy("station").agg(
        F.expr("min(t) AS mn"),
        F.expr("max(t) AS mx"),
        *_limb_sums("t"),
        F.expr("count(t) AS n"),
        F.expr("count(big) AS n_big"),
        F.expr("min(big) AS low"),
        F.expr("max(big) AS high"),
        F.expr(f"sum(big / {_SCALE_DOWN}) AS small"),
    )
    state = parts.selectExpr("station", "mn", "mx", f"{_TOTAL} AS s", "n + n_big AS n", *_WIDE)
    # One expression over n and the key: it cannot be pushed below the aggregation, so the
    # UTF-8 test runs once per station and the lines are parsed once.
    return state.where("if(is_valid_utf8(station), n, 0) > 0")


def station_state(lines: DataFrame, scale: int = 1, trim_station: bool = False) -> DataFrame:
    return measurement_state(measurements(lines, scale, trim_station))


def merge_states(state: DataFrame, keys: Sequence[str] = ("station",)) -> DataFrame:
    """Any number of partial states per key to one."""
    return state.groupBy(*keys).agg(
        F.min("mn").alias("mn"),
        F.max("mx").alias("mx"),
        F.sum("s").cast("decimal(38,0)").alias("s"),
        F.sum("n").alias("n"),
        *(F.expr(f"{total} AS {name}") for name, total in _WIDE.items() if name in state.columns),
    )


def state_text(state: DataFrame, scale: int = 1) -> DataFrame:
    """station, min_s, mean_s, max_s with one decimal."""
    unit = f"{10**scale}D"
    low, mean, high = f"mn / {unit}", f"cast(s AS DOUBLE) / n / {unit}", f"mx / {unit}"
    if "n_big" in state.columns:
        # least and greatest pass over the NULL of a station that has numbers of one kind only.
        low, high = f"least({low}, low)", f"greatest({high}, high)"
        all_small = f"(coalesce(cast(s AS DOUBLE), 0D) / {unit} / {_SCALE_DOWN} + small)"
        mean = f"if(n_big = 0, {mean}, {all_small} / n * {_SCALE_DOWN})"
    return state.selectExpr(
        "station", f"format_number({low}, '0.0') AS min_s", f"format_number({mean}, '0.0') AS mean_s", f"format_number({high}, '0.0') AS max_s"
    )


def finalize(state: DataFrame, scale: int = 1) -> DataFrame:
    """`state_text` in byte order of the station."""
    return state_text(state, scale).orderBy("station")


def summarize_lines(lines: DataFrame, scale: int = 1, trim_station: bool = False) -> DataFrame:
    """The whole query: lines to the sorted min/mean/max table."""
    return finalize(station_state(lines, scale, trim_station), scale)


def report(result: DataFrame) -> DataFrame:
    """station, report: `station=min/mean/max`."""
    return result.selectExpr("station", "concat(station, '=', min_s, '/', mean_s, '/', max_s) AS report")


def frame_stats(frame: DataFrame, key: str, value: str, scale: int = 1) -> DataFrame:
    """The same table from a typed frame, over all finite numbers.

    Numbers are scaled to whole units and summed exactly. In a group that holds one of 10^18 units or
    more, the mean is that of doubles. `frame_rejects` counts what is no finite number.
    """
    unit = f"{10**scale}D"
    units = (F.col(value).try_cast(f"decimal({DIGITS},{scale})") * F.lit(10**scale)).cast("bigint")
    rows = frame.select(F.col(key).alias("station"), units.alias("t"), F.col(value).cast("double").alias("v"))
    rows = rows.selectExpr("station", "t", "if(abs(v) < double('inf') AND NOT isnan(v), v, NULL) AS v")
    state = rows.groupBy("station").agg(
        F.min("t").alias("mn"),
        F.max("t").alias("mx"),
        *_limb_sums("t"),
        F.count("v").alias("n"),
        F.expr("count_if(t IS NULL AND v IS NOT NULL) AS n_big"),
        F.expr("min(if(t IS NULL, v, NULL)) AS low"),
        F.expr("max(if(t IS NULL, v, NULL)) AS high"),
        # Scaled down, so that a sum of the largest doubles stays finite.
        F.expr("sum(v / 18446744073709551616D) AS small"),
    )
    texts = state.where("n > 0").selectExpr(
        "station",
        f"format_number(least(mn / {unit}, low), '0.0') AS min_s",
        f"""format_number(if(n_big = 0, cast({_TOTAL} AS DOUBLE) / n / {unit}, small / n * 18446744073709551616D), '0.0')
            AS mean_s""",
        f"format_number(greatest(mx / {unit}, high), '0.0') AS max_s",
    )
    return texts.orderBy("station")


def frame_rejects(frame: DataFrame, key: str, value: str) -> DataFrame:
    """station, reason (`null`, `nan`, `infinite`), n: the rows that `frame_stats` leaves out."""
    number = F.col(value).cast("double")
    reason = (
        F.when(number.isNull(), "null").when(F.isnan(number), "nan").when(F.abs(number) == float("inf"), "infinite")
    )
    counts = frame.groupBy(F.col(key).alias("station"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("reason IS NOT NULL")
