"""Registered queries around the per-station summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.text import fixed
from gaugeline.operators.order import with_position
from gaugeline.operators.stats import (
    aggregate_state,
    finalize,
    frame_stats,
    measurement_state,
    merge_states,
    report,
    summarize_lines,
)
from gaugeline.plans.tables import (
    EVENT_REPORT,
    EVENT_SUMMARY,
    event_hundredths,
    event_lines,
    table,
)
from gaugeline.session import fresh_path
from gaugeline.sources.files import (
    read_csv_measurements,
    read_lines,
    read_report,
    read_state,
    write_measurements,
    write_report,
    write_state,
)


def station_min_mean_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize_lines(event_lines(spark, sf_dir))


def station_frame_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_stats(table(spark, sf_dir, "events"), "event_type", "value", scale=2)


def station_report_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = report(station_min_mean_max(spark, sf_dir))
    return with_position(lines, "station").select("pos", "report")


def station_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "report")
    write_report(report(station_min_mean_max(spark, sf_dir)), path)
    return read_report(spark, path)


def station_state_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = aggregate_state(
        event_hundredths(
            spark, sf_dir, F.col("event_type").alias("station"), F.col("ts").cast("date").alias("part")
        ),
        ("station", "part"),
    )
    merged = merge_states(daily)
    return merged.withColumn("s", F.col("s").cast("bigint"))


def _quantity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as `Supplier <key>;<quantity>`."""
    station = F.concat(F.lit("Supplier "), F.col("l_suppkey"))
    line = F.concat(station, F.lit(";"), fixed(F.col("l_quantity")))
    return table(spark, sf_dir, "lineitem").select(line.alias("line"))


def measurement_file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    write_measurements(_quantity_lines(spark, sf_dir), path)
    return summarize_lines(read_lines(spark, path))


def measurement_csv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    write_measurements(_quantity_lines(spark, sf_dir), path)
    return finalize(measurement_state(read_csv_measurements(spark, path)))


def station_state_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of single days, appended to a state table in two turns, read and merged."""
    path = fresh_path(spark, "state")
    events = event_hundredths(
        spark, sf_dir, F.col("event_type").alias("station"), F.col("ts").cast("date").alias("part")
    )
    daily = aggregate_state(events, ("station", "part"))
    odd = F.dayofmonth("part") % 2 == 1
    for turn in (odd, ~odd):
        write_state(daily.where(turn), path)
    merged = merge_states(read_state(spark, path))
    return merged.withColumn("s", F.col("s").cast("bigint"))


def large_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as `<flag>;<order key>000000000.5`: numbers up to 10^13 and beyond."""
    line = F.concat("l_returnflag", F.lit(";"), "l_orderkey", F.lit("000000000.5"))
    return summarize_lines(table(spark, sf_dir, "lineitem").select(line.alias("value")))


def city_int_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("city"), F.col("l_quantity").cast("bigint").alias("t")
    )
    return aggregate_state(rows, ("city",)).withColumn("s", F.col("s").cast("bigint"))


QUERIES = {
    "station_min_mean_max": station_min_mean_max,
    "station_frame_agg": station_frame_agg,
    "station_report_positions": station_report_positions,
    "station_report_text": station_report_text,
    "station_state_merge": station_state_merge,
    "measurement_file_summary": measurement_file_summary,
    "measurement_csv_summary": measurement_csv_summary,
    "station_state_store": station_state_store,
    "large_values": large_values,
    "city_int_agg": city_int_agg,
}

_QUANTITIES = """
  SELECT 'Supplier ' || l_suppkey AS station,
         printf('%.1f', min(l_quantity)) AS min_s,
         printf('%.1f', sum(CAST(round(l_quantity * 10) AS BIGINT))::DOUBLE / count(*) / 10.0) AS mean_s,
         printf('%.1f', max(l_quantity)) AS max_s
  FROM lineitem GROUP BY l_suppkey
"""

_STATES = """
  SELECT event_type AS station, min(t) AS mn, max(t) AS mx,
         CAST(sum(t) AS BIGINT) AS s, count(t) AS n
  FROM (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS t FROM events)
  GROUP BY event_type
"""

ORACLES = {
    "station_min_mean_max": f"{EVENT_SUMMARY} ORDER BY station",
    "station_frame_agg": """
      SELECT event_type AS station,
             printf('%.1f', min(t) / 100.0) AS min_s,
             printf('%.1f', CAST(sum(t) AS DOUBLE) / count(t) / 100.0) AS mean_s,
             printf('%.1f', max(t) / 100.0) AS max_s
      FROM (SELECT event_type, CAST(round(value * 100) AS BIGINT) AS t FROM events)
      GROUP BY event_type ORDER BY station
    """,
    "station_report_positions": f"""
      SELECT row_number() OVER (ORDER BY station) AS pos, report FROM ({EVENT_REPORT})
    """,
    "station_report_text": f"SELECT report FROM ({EVENT_REPORT})",
    "station_state_merge": _STATES,
    "station_state_store": _STATES,
    "large_values": """
      SELECT l_returnflag AS station, printf('%.1f', min(l_orderkey) * 1000000000 + 0.5) AS min_s,
             printf('%.1f', CAST(sum(l_orderkey * 10000000000 + 5) AS DOUBLE) / count(*) / 10.0) AS mean_s,
             printf('%.1f', max(l_orderkey) * 1000000000 + 0.5) AS max_s
      FROM lineitem GROUP BY l_returnflag
    """,
    "measurement_file_summary": _QUANTITIES,
    "measurement_csv_summary": _QUANTITIES,
    "city_int_agg": """
      SELECT l_returnflag AS city, min(CAST(l_quantity AS BIGINT)) AS mn,
             max(CAST(l_quantity AS BIGINT)) AS mx, CAST(sum(l_quantity) AS BIGINT) AS s,
             count(l_quantity) AS n
      FROM lineitem GROUP BY l_returnflag
    """,
}
