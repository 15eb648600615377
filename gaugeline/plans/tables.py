"""Inputs of the registered queries, rendered from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.numbers import DIGITS
from gaugeline.functions.text import fixed
from gaugeline.operators.order import tasks_for
from gaugeline.operators.stats import aggregate_state, report, state_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line `type;value`, and behind one in five of them a damaged line."""
    kind, number = F.col("event_type"), fixed(F.col("value"))
    form = F.pmod("event_id", F.lit(20))
    planted = (
        F.when(form == 0, kind)
        .when(form == 1, F.concat(kind, F.lit(";1;2")))
        .when(form == 2, F.concat(kind, F.lit(";x")))
        .when(form == 3, F.lit(""))
    )
    good = F.concat(kind, F.lit(";"), number)
    lines = F.when(form < 4, F.array(good, planted)).otherwise(F.array(good))
    return table(spark, sf_dir, "events").select(F.explode(lines).alias("value"))


# The same lines for the oracle.
EVENT_LINES = """
  SELECT event_type || ';' || printf('%.1f', value) AS value FROM events
  UNION ALL
  SELECT CASE event_id % 20
           WHEN 0 THEN event_type
           WHEN 1 THEN event_type || ';1;2'
           WHEN 2 THEN event_type || ';x'
           ELSE ''
         END AS value
  FROM events WHERE event_id % 20 < 4
"""

# Good lines of it, parsed without any of our own rules.
EVENT_GOOD = f"""
  SELECT p[1] AS station, CAST(round(CAST(p[2] AS DOUBLE) * 10) AS BIGINT) AS t
  FROM (SELECT string_split(value, ';') AS p FROM ({EVENT_LINES}))
  WHERE len(p) = 2 AND TRY_CAST(p[2] AS DOUBLE) IS NOT NULL
"""

EVENT_SUMMARY = f"""
  SELECT station,
         printf('%.1f', min(t) / 10.0) AS min_s,
         printf('%.1f', CAST(sum(t) AS DOUBLE) / count(t) / 10.0) AS mean_s,
         printf('%.1f', max(t) / 10.0) AS max_s
  FROM ({EVENT_GOOD})
  GROUP BY station
"""

EVENT_REPORT = f"""
  SELECT station, station || '=' || min_s || '/' || mean_s || '/' || max_s AS report
  FROM ({EVENT_SUMMARY})
"""


def event_hundredths(spark: SparkSession, sf_dir: str, *keys) -> DataFrame:
    """Keys and `t` in hundredths from the two-decimal event values."""
    units = (F.col("value").try_cast(f"decimal({DIGITS},2)") * 100).cast("bigint")
    return table(spark, sf_dir, "events").select(*keys, units.alias("t"))


def order_report(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Report of the quantities per order over the line items with one status; F and O hold them all.

    Orders are nearly as many as line items. So these are dealt by order first, over tasks that follow their
    number (the files' own count): a state per split would shuffle as much and hold a split's orders in memory.
    """
    items = table(spark, sf_dir, "lineitem")
    tasks = tasks_for(items.count())
    rows = items.where(F.col("l_linestatus") == status).selectExpr(
        "concat('Order ', l_orderkey) AS station", "cast(l_quantity * 10 AS BIGINT) AS t"
    )
    return report(state_text(aggregate_state(rows.repartition(tasks, "station"))))


def order_report_sql(status: str) -> str:
    return f"""
      SELECT station, station || '=' || printf('%.1f', lo) || '/' || printf('%.1f', total / n) || '/'
                      || printf('%.1f', hi) AS report
      FROM (SELECT 'Order ' || l_orderkey AS station, min(l_quantity) AS lo, max(l_quantity) AS hi,
                   sum(l_quantity) AS total, count(*) AS n
            FROM lineitem WHERE l_linestatus = '{status}' GROUP BY l_orderkey)
    """
