"""Every registered query against its DuckDB oracle on the given tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as contract
from gaugeline.plans import quality, summary, verify

LIBRARY = {**summary.QUERIES, **quality.QUERIES, **verify.QUERIES}

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = [f[: -len(".parquet")] for f in sorted(os.listdir(DATA))] if os.path.isdir(DATA) else []

pytestmark = pytest.mark.skipif(not TABLES, reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(LIBRARY) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, DATA)
    got = df.collect()
    want = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    want_rows = want.fetchall()
    assert got and len(got) == len(want_rows)
    assert _rows(df.columns, got) == _rows(columns, want_rows)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r.station for r in rows] == sorted(r.station for r in rows) and rows


def test_queries_read_whole_tables(spark):
    """The good lines hold every event, the two reports every line item."""
    from gaugeline import aggregate_state, parse_lines
    from gaugeline.plans import tables

    lines = parse_lines(tables.event_lines(spark, DATA))
    events = tables.table(spark, DATA, "events")
    assert lines.where("reason IS NULL").count() == events.count()
    states = [
        aggregate_state(tables.table(spark, DATA, "lineitem").where(f"l_linestatus = '{status}'").selectExpr("l_orderkey AS station", "1L AS t"))
        for status in "FO"
    ]
    items = sum(row.n for state in states for row in state.collect())
    assert items == tables.table(spark, DATA, "lineitem").count()
