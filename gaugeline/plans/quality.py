"""Registered queries on line quality, parsing and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.numbers import to_units, units_from_digits, units_truncated
from gaugeline.functions.text import byte_text, elapsed_text, fixed
from gaugeline.operators.names import estimate_file_size, name_limits, station_names
from gaugeline.operators.parse import parse_lines, reject_counts
from gaugeline.operators.stats import exact_sum, frame_rejects, summarize_lines
from gaugeline.plans.tables import EVENT_LINES, event_lines, table
from gaugeline.session import shared_dir
from gaugeline.sources.files import csv_fields


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(event_lines(spark, sf_dir))


def station_names_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_names(table(spark, sf_dir, "documents"), "text")


def station_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_limits(station_names_query(spark, sf_dir))


def parse_path_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, n_rows, n_mismatch (against the decimal path), sum_tenths over all event values and long numbers.

    The long numbers' sum grows with the square of the events: sum_tenths is a BIGINT where all three fit, else a
    DECIMAL(38,0). The three rows are computed at call time to know which.
    """
    paths = {"decimal": to_units, "digits": units_from_digits, "truncated_double": units_truncated}
    events = table(spark, sf_dir, "events")
    # As given, whole and long, and too large for any path.
    forms = F.array(
        fixed(F.col("value")), F.concat(F.col("event_id") + 1, F.lit("000000")), F.concat(F.col("event_id") + 1, F.lit("0" * 20))
    )
    text = events.select(F.explode(forms).alias("text"))
    parsed = text.select(*[f("text").alias(name) for name, f in paths.items()])
    one = parsed.agg(
        *[
            F.struct(
                F.lit(name).alias("path"),
                F.count(name).alias("n_rows"),
                F.count_if(~F.col(name).eqNullSafe(F.col("decimal"))).alias("n_mismatch"),
                exact_sum(name).alias("sum_tenths"),
            ).alias(name)
            for name in paths
        ]
    )
    shared_dir(spark)
    rows = one.select(F.inline(F.array(*paths))).checkpoint()
    whole = F.col("sum_tenths").try_cast("bigint")
    beyond = rows.where(F.col("sum_tenths").isNotNull() & whole.isNull())
    return rows.withColumn("sum_tenths", whole) if beyond.isEmpty() else rows


def trimmed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of lines with blanks at both ends; only the inner blank belongs to the station."""
    line = F.concat(F.lit(" \t"), "event_type", F.lit(" ;"), fixed(F.col("value")), F.lit(" \x0b "))
    return summarize_lines(table(spark, sf_dir, "events").select(line.alias("value")), trim_station=True)


def invalid_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """route, reason, n: all events as lines, one in ten with two more whose stations are no UTF-8, by either parser."""
    good = F.concat(F.col("event_type"), F.lit(";"), fixed(F.col("value")))
    bad = [F.expr(f"cast(concat(X'{key}', cast('{end}' AS BINARY)) AS STRING)") for key, end in (("FFFE", ";1.0"), ("FFFD", ";2.0"))]
    lines = F.when(F.col("event_id") % 10 == 0, F.array(good, *bad)).otherwise(F.array(good))
    lines = table(spark, sf_dir, "events").select(F.explode(lines).alias("value"))
    routes = [
        f(lines).select(F.lit(name).alias("route"), F.coalesce("reason", F.lit("good")).alias("reason"))
        for name, f in (("text", parse_lines), ("csv", csv_fields))
    ]
    return routes[0].unionByName(routes[1]).groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n"))


def wide_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as lines; the odd suppliers' numbers are 10^17 times the line number, that is 10^18 tenths and more."""
    wide = F.when(F.col("l_orderkey") % 2 == 0, F.concat("l_linenumber", F.lit("0" * 17))).otherwise(F.concat("l_linenumber", F.lit("E17")))
    number = F.when(F.col("l_suppkey") % 2 == 1, wide).otherwise(fixed(F.col("l_quantity")))
    line = F.concat(F.lit("Line "), "l_linenumber", F.lit(" of "), "l_suppkey", F.lit(";"), number)
    return summarize_lines(table(spark, sf_dir, "lineitem").select(line.alias("value")))


def frame_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is no finite number among event values divided by a number that is 0 at times."""
    number = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).when(F.col("event_id") % 13 == 0, F.lit(float("-inf")))
    value = F.coalesce(number, F.try_divide(F.col("value"), F.col("event_id") % 7))
    return frame_rejects(table(spark, sf_dir, "events").select("event_type", value.alias("v")), "event_type", "v")


def estimated_file_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate_file_size(table(spark, sf_dir, "part").select(F.col("p_name").alias("station")))


def size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = (
        table(spark, sf_dir, "documents")
        .groupBy("source")
        .agg(F.sum(F.octet_length("text").cast("bigint")).alias("b"))
    )
    return sizes.select("source", "b", byte_text(F.col("b")).alias("bytes_h"))


def span_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg((F.max("ts") - F.min("ts")).cast("interval second").cast("decimal(18,6)").alias("d"))
        .select("user_id", F.col("d").cast("double").alias("s"))
    )
    return spans.select("user_id", "s", elapsed_text(F.col("s")).alias("elapsed_h"))


QUERIES = {
    "malformed_lines": malformed_lines,
    "trimmed_lines": trimmed_lines,
    "invalid_bytes": invalid_bytes,
    "wide_values": wide_values,
    "frame_reject_counts": frame_reject_counts,
    "station_names": station_names_query,
    "station_constraints": station_constraints,
    "parse_path_parity": parse_path_parity,
    "estimated_file_size": estimated_file_size,
    "size_report": size_report,
    "span_report": span_report,
}

_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"

_NAMES = f"""
  SELECT DISTINCT split_part(line, ';', 1) AS station
  FROM (SELECT unnest(regexp_split_to_array(regexp_replace(text, '(?:{_BREAK})$', ''), '{_BREAK}')) AS line
        FROM documents WHERE text <> '')
  WHERE line NOT LIKE '%#%'
"""

_PATHS = """
  SELECT CAST(round(x * 10) AS BIGINT) AS d,
         CAST(replace(v, '.', '') AS BIGINT) AS g,
         CAST(trunc(x * 10) AS BIGINT) AS f
  FROM (SELECT v, CAST(v AS DOUBLE) AS x FROM (SELECT printf('%.1f', value) AS v FROM events))
  UNION ALL SELECT (event_id + 1) * 10000000, (event_id + 1) * 10000000, (event_id + 1) * 10000000 FROM events
  UNION ALL SELECT NULL, NULL, NULL FROM events
"""

ORACLES = {
    "wide_values": """
      SELECT station, printf('%.1f', min(v)) AS min_s,
             printf('%.1f', if(max(v) < 1e17, sum(CAST(round(v * 10) AS HUGEINT))::DOUBLE / count(*) / 10.0, max(v))) AS mean_s,
             printf('%.1f', max(v)) AS max_s
      FROM (SELECT 'Line ' || l_linenumber || ' of ' || l_suppkey AS station,
                   if(l_suppkey % 2 = 1, l_linenumber * 1e17, CAST(l_quantity AS DOUBLE)) AS v FROM lineitem)
      GROUP BY station
    """,
    "malformed_lines": f"""
      SELECT reason, count(*) AS n
      FROM (SELECT CASE WHEN value = '' THEN 'blank'
                        WHEN len(p) = 1 THEN 'no_separator'
                        WHEN len(p) > 2 THEN 'extra_separator'
                        WHEN TRY_CAST(p[2] AS DOUBLE) IS NULL THEN 'bad_number' END AS reason
            FROM (SELECT value, string_split(value, ';') AS p FROM ({EVENT_LINES})))
      WHERE reason IS NOT NULL GROUP BY reason
    """,
    "trimmed_lines": """
      SELECT station, printf('%.1f', min(t) / 10.0) AS min_s,
             printf('%.1f', CAST(sum(t) AS DOUBLE) / count(t) / 10.0) AS mean_s, printf('%.1f', max(t) / 10.0) AS max_s
      FROM (SELECT event_type || ' ' AS station, CAST(round(CAST(printf('%.1f', value) AS DOUBLE) * 10) AS BIGINT) AS t
            FROM events)
      GROUP BY station
    """,
    "invalid_bytes": """
      SELECT route, reason, n
      FROM (SELECT 'good' AS reason, count(*) AS n FROM events
            UNION ALL SELECT 'bad_utf8', 2 * count(*) FROM events WHERE event_id % 10 = 0) AS counted,
           (SELECT 'text' AS route UNION ALL SELECT 'csv') AS routes
    """,
    "frame_reject_counts": """
      SELECT station, reason, count(*) AS n
      FROM (SELECT event_type AS station,
                   CASE WHEN event_id % 11 = 0 THEN 'nan' WHEN event_id % 13 = 0 THEN 'infinite'
                        WHEN event_id % 7 = 0 THEN 'null' END AS reason FROM events)
      WHERE reason IS NOT NULL GROUP BY station, reason
    """,
    "station_names": _NAMES,
    "station_constraints": f"""
      SELECT count(*) AS n_stations, CAST(max(strlen(station)) AS BIGINT) AS max_bytes,
             count(*) FILTER (strlen(station) > 100) AS n_too_long,
             count(*) <= 10000 AND count(*) FILTER (strlen(station) > 100) = 0 AS within_limits
      FROM ({_NAMES})
    """,
    "parse_path_parity": f"""
      SELECT path, count(t) AS n_rows, count(*) FILTER (t IS DISTINCT FROM d) AS n_mismatch,
             CAST(sum(t) AS BIGINT) AS sum_tenths
      FROM (SELECT 'decimal' AS path, d AS t, d FROM ({_PATHS})
            UNION ALL SELECT 'digits', g, d FROM ({_PATHS})
            UNION ALL SELECT 'truncated_double', f, d FROM ({_PATHS}))
      GROUP BY path
    """,
    "estimated_file_size": """
      SELECT n_names, avg_bytes, est_bytes,
             CASE WHEN est_bytes < 1024 THEN printf('%.1f bytes', est_bytes)
                  WHEN est_bytes < 1048576 THEN printf('%.1f KiB', est_bytes / 1024)
                  WHEN est_bytes < 1073741824 THEN printf('%.1f MiB', est_bytes / 1048576)
                  WHEN est_bytes < 1099511627776 THEN printf('%.1f GiB', est_bytes / 1073741824)
                  ELSE printf('%.1f TiB', est_bytes / 1099511627776)
             END AS est_text
      FROM (SELECT n_names, avg_bytes,
                   CAST(n_rows AS DOUBLE) * (avg_bytes + CAST(4.400200100050025 AS DOUBLE) + 2) AS est_bytes
            FROM (SELECT count(*) AS n_names, CAST(sum(strlen(p_name)) AS DOUBLE) / count(*) AS avg_bytes,
                         sum(c) AS n_rows
                  FROM (SELECT p_name, count(*) AS c FROM part GROUP BY p_name)))
    """,
    "size_report": """
      SELECT source, b,
             CASE WHEN b < 1024 THEN printf('%.1f bytes', CAST(b AS DOUBLE))
                  WHEN b < 1048576 THEN printf('%.1f KiB', b / 1024.0)
                  WHEN b < 1073741824 THEN printf('%.1f MiB', b / 1048576.0)
                  WHEN b < 1099511627776 THEN printf('%.1f GiB', b / 1073741824.0)
                  ELSE printf('%.1f TiB', b / 1099511627776.0)
             END AS bytes_h
      FROM (SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS b FROM documents GROUP BY source)
    """,
    "span_report": """
      SELECT user_id, s,
             CASE WHEN s < 60 THEN printf('%.3f seconds', s)
                  WHEN s < 3600 THEN printf('%d minutes %d seconds', w // 60, w % 60)
                  WHEN (w % 3600) // 60 = 0 THEN printf('%d hours %d seconds', w // 3600, w % 60)
                  ELSE printf('%d hours %d minutes %d seconds', w // 3600, (w % 3600) // 60, w % 60)
             END AS elapsed_h
      FROM (SELECT user_id, s, CAST(floor(s) AS BIGINT) AS w
            FROM (SELECT user_id, date_diff('microsecond', min(ts), max(ts)) / 1000000.0 AS s
                  FROM events GROUP BY user_id))
    """,
}
