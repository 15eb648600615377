"""What only large tables meet: sums beyond BIGINT, tasks that grow with the table."""

from collections import Counter, defaultdict
from decimal import Decimal
from itertools import zip_longest

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import compare, order
from gaugeline.operators.stats import exact_sum
from gaugeline.plans import quality, tables, verify


def _events(spark, folder, first, n):
    rows = spark.range(first, first + n).select(F.col("id").alias("event_id"), F.lit(2.5).alias("value"))
    rows.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_exact_sum(spark):
    values = [2**63 - 1] * 5 + [-(2**63)] * 2 + [1, -1, None]
    df = spark.createDataFrame([(v,) for v in values], "t long")
    assert df.select(exact_sum("t")).first()[0] == Decimal(sum(v for v in values if v is not None))
    assert df.where("t IS NULL").select(exact_sum("t")).first()[0] is None


def test_parse_path_parity_beyond_bigint(spark, tmp_path):
    first, n = 9 * 10**10, 40
    want = 25 * n + sum((i + 1) * 10**7 for i in range(first, first + n))
    assert want > 2**63
    df = quality.parse_path_parity(spark, _events(spark, tmp_path, first, n))
    assert dict(df.dtypes)["sum_tenths"] == "decimal(38,0)"
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(path, 2 * n, 0, Decimal(want)) for path in ("decimal", "digits", "truncated_double")]


def test_parse_path_parity_keeps_bigint_where_it_fits(spark, tmp_path):
    df = quality.parse_path_parity(spark, _events(spark, tmp_path / "a", 0, 3))
    assert dict(df.dtypes)["sum_tenths"] == "bigint"
    assert {r.sum_tenths for r in df.collect()} == {3 * 25 + 6 * 10**7}
    none = quality.parse_path_parity(spark, _events(spark, tmp_path / "b", 0, 0))
    assert dict(none.dtypes)["sum_tenths"] == "bigint" and {(r.n_rows, r.sum_tenths) for r in none.collect()} == {(0, None)}


@pytest.fixture
def few_partitions(spark, monkeypatch):
    """Two partitions by the session's setting, tasks of 100 rows by the table's size."""
    monkeypatch.setattr(order, "TASK_ROWS", 100)
    monkeypatch.setattr(compare, "_TASK_POSITIONS", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _largest(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_tasks_follow_the_line_items(spark, few_partitions, tmp_path):
    items = [(None if k % 97 == 0 else k // 3, float(k % 50 + 1), "FFO"[k * k % 7 % 3]) for k in range(4000)]
    rows = spark.createDataFrame(items, "l_orderkey long, l_quantity double, l_linestatus string")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    reports = []
    for status in "FO":
        quantities = defaultdict(list)
        for key, quantity, s in items:
            if s == status:
                quantities[key].append(quantity)
        want = {
            None if key is None else f"Order {key}": (min(v), sum(v) / len(v), max(v)) for key, v in quantities.items()
        }
        df = tables.order_report(spark, str(tmp_path), status)
        assert df.rdd.getNumPartitions() == 40
        got = {r.station: r.report for r in df.collect()}
        assert got.keys() == want.keys() and got[None] is None
        for key, report in got.items():
            if key is not None:
                assert [float(x) for x in report.split("=")[1].split("/")] == pytest.approx(want[key], abs=0.0501)
        reports.append([got[k] for k in sorted(got, key=lambda k: (k is not None, k))])
    want = [(i, x, y) for i, (x, y) in enumerate(zip_longest(*reports), 1) if x != y]
    diff = compare.diff_by_position(*verify._reports(spark, str(tmp_path)))
    assert sorted(tuple(r) for r in diff.collect()) == want
    assert [tuple(r) for r in verify.report_diff_positional(spark, str(tmp_path)).collect()] == want[:10]


def test_tasks_follow_the_distinct_lines(spark, few_partitions):
    counts = [(f"k{i:05d}", i % 4, i % 3) for i in range(4000)]
    df = order.run_starts(spark.createDataFrame(counts, "k string, e long, a long"), ["k"], ["e", "a"])
    assert _largest(df) <= 1000
    e = a = 0
    for row, (key, n_e, n_a) in zip(sorted(df.collect()), counts, strict=True):
        assert tuple(row) == (key, n_e, n_a, e, a)
        e, a = e + n_e, a + n_a


def test_tasks_follow_the_positions(spark, few_partitions):
    sides = [[f"s{k * step % 2003:04d}=1/1/1" for k in range(n)] for n, step in ((3000, 7), (2500, 11))]
    df = compare.diff_by_position(*(spark.createDataFrame([(x,) for x in s], "report string") for s in sides))
    assert _largest(df) <= 200
    want = [(i, x, y) for i, (x, y) in enumerate(zip_longest(*map(sorted, sides)), 1) if x != y]
    assert Counter(tuple(r) for r in df.collect()) == Counter(want)
