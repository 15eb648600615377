"""Station lists: reading, limits and the size of a file made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.text import byte_text

# Line boundaries in a station list besides \n; \r\n is one boundary.
OTHER_BREAK = r"[\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}]"

# Stated limits of the input format.
MAX_STATIONS = 10_000
MAX_NAME_BYTES = 100

# Average bytes of a number in -99.9 ... 99.9, and of separator plus line end.
AVG_NUMBER_BYTES = 4.400200100050025
SEPARATOR_BYTES = 2


def text_lines(texts: DataFrame, column: str) -> DataFrame:
    """One row per line; a break at the very end starts no further line.

    The pattern is several times slower than a split at one character, so it is kept for texts
    that hold one of the rarer breaks.
    """
    text = F.col(column)
    rare = text.rlike(OTHER_BREAK)
    pieces = F.when(rare, F.split(text, LINE_BREAK, -1)).otherwise(F.split(text, "\n", -1))
    open_end = F.element_at("p", -1) == ""
    lines = F.when(open_end, F.slice("p", 1, F.size("p") - 1)).otherwise(F.col("p"))
    return texts.select(pieces.alias("p")).select(F.explode(lines).alias("line"))


def station_names(texts: DataFrame, column: str = "value") -> DataFrame:
    """Distinct first fields of all lines in `column`; lines with a `#` are comments."""
    return (
        text_lines(texts, column)
        .where(~F.contains("line", F.lit("#")))
        .select(F.substring_index("line", ";", 1).alias("station"))
        .distinct()
    )


def name_limits(
    names: DataFrame, max_stations: int = MAX_STATIONS, max_bytes: int = MAX_NAME_BYTES
) -> DataFrame:
    """One row: n_stations, max_bytes, n_too_long, within_limits."""
    size = F.octet_length("station")
    facts = (
        names.select("station")
        .distinct()
        .agg(
            F.count("station").alias("n_stations"),
            F.max(size).cast("bigint").alias("max_bytes"),
            F.count_if(size > max_bytes).alias("n_too_long"),
        )
    )
    return facts.withColumn(
        "within_limits", (F.col("n_stations") <= max_stations) & (F.col("n_too_long") == 0)
    )


def estimate_file_size(names: DataFrame, n_rows: int | None = None) -> DataFrame:
    """n_names, avg_bytes, est_bytes, est_text for a file of `n_rows` lines over the distinct names.

    Without `n_rows`, one line per row of `names`.
    """
    facts = (
        names.groupBy("station")
        .agg(F.count(F.lit(1)).alias("c"))
        .agg(
            F.count("station").alias("n_names"),
            F.sum(F.octet_length("station")).alias("total"),
            F.sum("c").alias("rows"),
        )
    )
    rows = F.lit(n_rows) if n_rows is not None else F.col("rows")
    avg = F.col("total").cast("double") / F.col("n_names")
    return (
        facts.select("n_names", avg.alias("avg_bytes"), rows.alias("rows"))
        .withColumn(
            "est_bytes",
            F.col("rows") * (F.col("avg_bytes") + F.lit(AVG_NUMBER_BYTES) + F.lit(SEPARATOR_BYTES)),
        )
        .select("n_names", "avg_bytes", "est_bytes", byte_text(F.col("est_bytes")).alias("est_text"))
    )
