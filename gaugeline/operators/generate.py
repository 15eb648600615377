"""Reproducible test measurements: the same id always yields the same line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.text import units_text
from gaugeline.operators.order import with_position
from gaugeline.session import broadcast_if_small

# Fixed values of the generated data.
POOL_SLOTS = 10_000
COLDEST, HOTTEST = -999, 999  # tenths
CITIES = ("CityA", "CityB", "CityC", "CityD", "CityE")
INT_LOW, INT_HIGH = -1000, 1000

# One stream of draws per purpose.
_POOL, _STATION, _NUMBER, _CITY, _INT = range(1, 6)

_WORD = 1 << 32
_MULTIPLIER = 73244475  # odd; a 32-bit product with it stays inside BIGINT
_STREAM = 2654435769  # 2^32 / golden ratio


def draw(key: Column, stream: int, n: int) -> Column:
    """Whole number in 0 ... n-1, a fixed function of `key` and `stream`; any BIGINT key >= 0."""
    x = (key.bitwiseXOR(F.shiftright(key, 32)).bitwiseAND(F.lit(_WORD - 1)) + stream * _STREAM) % _WORD
    for _ in range(2):
        x = (x.bitwiseXOR(F.shiftright(x, 16)) * _MULTIPLIER) % _WORD
    return x.bitwiseXOR(F.shiftright(x, 16)) % n


def measurement_ids(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Ids 0 ... n-1 to generate from when no table supplies them."""
    return spark.range(0, n, 1, partitions) if partitions else spark.range(n)


def station_pool(names: DataFrame, slots: int = POOL_SLOTS) -> DataFrame:
    """slot, station: `slots` draws with replacement from the distinct names; names that no draw hits never occur.

    Starts jobs: the names are numbered in a written table and counted.
    """
    ranked = with_position(names.select("station").distinct(), "station")
    n_names = ranked.count()
    if n_names == 0:
        raise ValueError("no station names to draw from")
    drawn = names.sparkSession.range(slots).select(
        F.col("id").alias("slot"), (draw(F.col("id"), _POOL, n_names) + 1).alias("pos")
    )
    # Pairs of integers, a few hundred kB at the default.
    return ranked.join(F.broadcast(drawn), "pos").select("slot", "station")


def generate_measurements(ids: DataFrame, names: DataFrame, slots: int = POOL_SLOTS) -> DataFrame:
    """id, station, tenths, line: one measurement per row of `ids` (column id)."""
    pool = broadcast_if_small(station_pool(names, slots).checkpoint(), "station")
    rows = ids.select(
        "id",
        draw(F.col("id"), _STATION, slots).alias("slot"),
        (draw(F.col("id"), _NUMBER, HOTTEST - COLDEST + 1) + COLDEST).alias("tenths"),
    )
    return rows.join(pool, "slot").select(
        "id",
        "station",
        "tenths",
        F.concat("station", F.lit(";"), units_text(F.col("tenths"))).alias("line"),
    )


def city_integers(ids: DataFrame) -> DataFrame:
    """id, city, measurement: five cities, whole numbers."""
    city = F.element_at(
        F.array(*[F.lit(c) for c in CITIES]), (draw(F.col("id"), _CITY, len(CITIES)) + 1).cast("int")
    )
    number = draw(F.col("id"), _INT, INT_HIGH - INT_LOW + 1) + INT_LOW
    return ids.select("id", city.alias("city"), number.alias("measurement"))
