"""Registered queries that compare reports, rank run times and generate measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.compare import diff_by_position, diff_by_station, diff_summary
from gaugeline.operators.generate import city_integers, generate_measurements
from gaugeline.operators.leaderboard import leaderboard
from gaugeline.plans.tables import order_report, order_report_sql, table


def _reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Quantities of all orders, fulfilled against open line items."""
    return order_report(spark, sf_dir, "F"), order_report(spark, sf_dir, "O")


def report_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff_summary(diff_by_station(*_reports(spark, sf_dir)))


def report_diff_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten positions that differ."""
    return diff_by_position(*_reports(spark, sf_dir)).orderBy("pos").limit(10)


def runtime_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entry"), F.col("value").alias("seconds")
    )
    return leaderboard(runs)


def price_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median price per return flag: three keys, one with half of all rows."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("entry"), F.col("l_extendedprice").alias("seconds")
    )
    return leaderboard(items)


def repeated_report_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions that differ between two lists of one report line per line item; lines repeat."""

    def lines(status: str) -> DataFrame:
        text = F.concat(F.lit("Size "), F.col("l_quantity").cast("bigint"), F.lit("=1.0/1.0/1.0"))
        items = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == status)
        return items.select(text.alias("report"))

    return diff_by_position(lines("F"), lines("O"))


def _event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))


def generate_measurements_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One measurement per event over the names of all parts."""
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("station"))
    return generate_measurements(_event_ids(spark, sf_dir), names)


def generate_city_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_integers(_event_ids(spark, sf_dir))


QUERIES = {
    "report_diff": report_diff,
    "report_diff_positional": report_diff_positional,
    "runtime_leaderboard": runtime_leaderboard,
    "price_medians": price_medians,
    "repeated_report_diff": repeated_report_diff,
    "generate_measurements": generate_measurements_query,
    "generate_city_integers": generate_city_integers,
}


def _repeated(status: str) -> str:
    return f"""
      SELECT row_number() OVER (ORDER BY split_part(report, '=', 1)) AS pos, report
      FROM (SELECT 'Size ' || CAST(l_quantity AS BIGINT) || '=1.0/1.0/1.0' AS report
            FROM lineitem WHERE l_linestatus = '{status}')
    """


def _draw(key: str, stream: int, n: str) -> str:
    """The generator's draw as SQL text."""
    first = f"((xor({key}, {key} >> 32) & 4294967295) + {stream * 2654435769}) % 4294967296"
    second = f"(xor({first}, ({first}) >> 16) * 73244475) % 4294967296"
    third = f"(xor({second}, ({second}) >> 16) * 73244475) % 4294967296"
    return f"(xor({third}, ({third}) >> 16) % {n})"


ORACLES = {
    "report_diff": f"""
      SELECT CASE WHEN a.station IS NULL THEN 'missing' WHEN e.station IS NULL THEN 'extra'
                  WHEN e.report = a.report THEN 'equal' ELSE 'changed' END AS status,
             count(*) AS n
      FROM ({order_report_sql('F')}) e FULL JOIN ({order_report_sql('O')}) a ON e.station = a.station
      GROUP BY 1
    """,
    "report_diff_positional": f"""
      SELECT coalesce(e.pos, a.pos) AS pos, e.report AS expected, a.report AS actual
      FROM (SELECT row_number() OVER (ORDER BY station) AS pos, report FROM ({order_report_sql('F')})) e
      FULL JOIN (SELECT row_number() OVER (ORDER BY station) AS pos, report FROM ({order_report_sql('O')})) a
        ON e.pos = a.pos
      WHERE e.report IS DISTINCT FROM a.report
      ORDER BY 1 LIMIT 10
    """,
    "runtime_leaderboard": """
      SELECT row_number() OVER (ORDER BY median_s, entry) AS rank, entry, median_s
      FROM (SELECT event_type AS entry, list_sort(list(value))[count(value) // 2 + 1] AS median_s
            FROM events GROUP BY event_type)
    """,
    "price_medians": """
      SELECT row_number() OVER (ORDER BY median_s, entry) AS rank, entry, median_s
      FROM (SELECT l_returnflag AS entry, list_sort(list(l_extendedprice))[count(l_extendedprice) // 2 + 1] AS median_s
            FROM lineitem GROUP BY l_returnflag)
    """,
    "repeated_report_diff": f"""
      SELECT coalesce(e.pos, a.pos) AS pos, e.report AS expected, a.report AS actual
      FROM ({_repeated('F')}) e FULL JOIN ({_repeated('O')}) a ON e.pos = a.pos
      WHERE e.report IS DISTINCT FROM a.report
    """,
    "generate_measurements": f"""
      WITH names AS (SELECT p_name AS station, row_number() OVER (ORDER BY p_name) AS pos
                     FROM (SELECT DISTINCT p_name FROM part)),
           pool AS (SELECT slot, station
                    FROM (SELECT slot, {_draw('slot', 1, '(SELECT count(*) FROM names)')} + 1 AS pos
                          FROM (SELECT range AS slot FROM range(10000)))
                    JOIN names USING (pos)),
           numbers AS (SELECT event_id AS id, {_draw('event_id', 2, '10000')} AS slot,
                              {_draw('event_id', 3, '1999')} - 999 AS tenths
                       FROM events)
      SELECT id, station, tenths, station || ';' || printf('%.1f', tenths / 10.0) AS line
      FROM numbers JOIN pool USING (slot)
    """,
    "generate_city_integers": f"""
      SELECT event_id AS id, 'City' || substr('ABCDE', {_draw('event_id', 4, '5')} + 1, 1) AS city,
             {_draw('event_id', 5, '2001')} - 1000 AS measurement
      FROM events
    """,
}
