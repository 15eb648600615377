"""States, text forms, reports, rankings, names and generated data."""

import math
import os
import random
import subprocess
import sys
from collections import Counter
from itertools import zip_longest

import pytest
from pyspark.sql import functions as F

from gaugeline.operators import compare
from gaugeline import (
    aggregate_state,
    city_integers,
    diff_by_position,
    diff_by_station,
    diff_summary,
    estimate_file_size,
    finalize,
    frame_rejects,
    frame_stats,
    generate_measurements,
    leaderboard,
    measurement_ids,
    merge_states,
    name_limits,
    read_lines,
    read_report,
    read_state,
    report,
    station_names,
    summarize_lines,
    upper_median,
    with_position,
    write_measurements,
    write_report,
    write_state,
)
from gaugeline.functions.text import byte_text, elapsed_text, fixed, parse_report
from gaugeline.session import broadcast_if_small, fresh_path


def _values(spark, seed=3, n=5000):
    rng = random.Random(seed)
    rows = [(rng.choice("abcde" + "h" * 5), rng.randint(-999, 999), rng.randint(0, 9)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "station string, t long, part int")


def test_merge_law(spark):
    _, df = _values(spark)
    direct = aggregate_state(df).orderBy("station").collect()
    for parts in (["part"], ["part", "t"]):
        partial = aggregate_state(df, ("station", *parts))
        assert merge_states(partial).orderBy("station").collect() == direct
        assert merge_states(merge_states(partial, ("station", "part"))).orderBy("station").collect() == direct


def test_state_table_grows_by_appending(spark, tmp_path):
    rows, df = _values(spark)
    path = str(tmp_path / "state")
    for part in range(10):
        write_state(aggregate_state(df.where(F.col("part") == part), ("station", "part")), path)
    got = finalize(merge_states(read_state(spark, path))).collect()
    assert got == finalize(aggregate_state(df)).collect()


def test_fixed_matches_python(spark):
    xs = [k / 20 for k in range(-2000, 2001)] + [random.Random(1).uniform(-100, 100) for _ in range(2000)]
    xs += [-2034.5, 1e6 + 0.25, -0.04, 0.05, 0.15, 0.25]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r.s for r in df.select(fixed(F.col("x")).alias("s")).collect()] == [f"{x:.1f}" for x in xs]
    assert [r.s for r in df.select(fixed(F.col("x"), 3).alias("s")).collect()] == [f"{x:.3f}" for x in xs]


@pytest.mark.parametrize("tenths, want", [((2, 3), "0.2"), ((7, 8), "0.8"), ((0, 0, -1), "-0.0")])
def test_mean_text(spark, tenths, want):
    df = spark.createDataFrame([("a", t) for t in tenths], "station string, t long")
    assert finalize(aggregate_state(df)).first().mean_s == want


def test_frame_stats(spark):
    df = spark.createDataFrame([("b", 1.25), ("a", -3.5), ("b", 2.0), ("a", None)], "k string, v double")
    got = [tuple(r) for r in frame_stats(df, "k", "v", scale=2).collect()]
    assert got == [("a", "-3.5", "-3.5", "-3.5"), ("b", "1.2", "1.6", "2.0")]


def test_frame_stats_keeps_every_finite_number(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", 1e11), ("a", 2.0), ("b", inf), ("c", nan), ("c", 1.0), ("d", 1e300), ("d", -1.0), ("d", None), ("e", None), ("f", 1.7e308), ("f", 1.7e308), ("f", -inf)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.station: (float(r.min_s), float(r.mean_s), float(r.max_s)) for r in frame_stats(df, "k", "v").collect()}
    assert got == {"a": (2.0, 50000000001.0, 1e11), "c": (1.0, 1.0, 1.0), "d": (-1.0, 5e299, 1e300), "f": (1.7e308, 1.7e308, 1.7e308)}
    rejects = {(r.station, r.reason): r.n for r in frame_rejects(df, "k", "v").collect()}
    assert rejects == {("b", "infinite"): 1, ("c", "nan"): 1, ("d", "null"): 1, ("e", "null"): 1, ("f", "infinite"): 1}


def test_byte_text(spark):
    want = {
        0: "0.0 bytes",
        1: "1.0 bytes",
        1023: "1023.0 bytes",
        1024: "1.0 KiB",
        1536: "1.5 KiB",
        10**6: "976.6 KiB",
        2**20 - 1: "1024.0 KiB",
        2**20: "1.0 MiB",
        5 * 10**8: "476.8 MiB",
        2**30: "1.0 GiB",
        10**12: "931.3 GiB",
        2**40 - 1: "1024.0 GiB",
        2**40: "1.0 TiB",
        94 * 10**12: "85.5 TiB",
        2**50: "1.0 PiB",
        2**62: "4.0 EiB",
    }
    df = spark.createDataFrame([(x,) for x in want], "x long")
    assert {r.x: r.s for r in df.select("x", byte_text(F.col("x")).alias("s")).collect()} == want


def test_elapsed_text(spark):
    want = {
        0.0: "0.000 seconds",
        0.0015: "0.002 seconds",
        1.5: "1.500 seconds",
        59.9994: "59.999 seconds",
        59.9999: "60.000 seconds",
        60.0: "1 minutes 0 seconds",
        61.9: "1 minutes 1 seconds",
        3599.99: "59 minutes 59 seconds",
        3600.0: "1 hours 0 seconds",
        3659.5: "1 hours 59 seconds",
        3660.0: "1 hours 1 minutes 0 seconds",
        7322.7: "2 hours 2 minutes 2 seconds",
        86400.0: "24 hours 0 seconds",
        1e7: "2777 hours 46 minutes 40 seconds",
    }
    df = spark.createDataFrame([(x,) for x in want], "x double")
    assert {r.x: r.s for r in df.select("x", elapsed_text(F.col("x")).alias("s")).collect()} == want


def test_positions_span_partitions(spark):
    df = spark.range(50_000, numPartitions=7).select(F.xxhash64("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = with_position(df, "k").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.pos for r in sorted(rows, key=lambda r: r.k)] == list(range(1, 50_001))
    assert with_position(df.where("k is null"), "k").collect() == []


def test_positions_of_a_repeated_value_are_split(spark):
    df = spark.range(30_000, numPartitions=5).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = with_position(df, "k", unique=False).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.pos for r in rows) == list(range(1, 30_001))
    assert [r.k for r in sorted(rows, key=lambda r: r.pos)] == sorted(r.k for r in rows)
    assert len({r.part for r in rows if r.k == 7}) > 1


def _summary(spark, n=3000):
    df = spark.range(n).select(
        F.format_string("s%05d=/x", "id").alias("station"), (F.col("id") % 50 - 25).alias("t")
    )
    return report(finalize(aggregate_state(df)))


def test_report_file_in_order(spark, tmp_path):
    rep = _summary(spark)
    want = [r.report for r in rep.collect()]
    for coalesce in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        path = tmp_path / coalesce
        try:
            write_report(rep, str(path))
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        files = sorted(p for p in path.iterdir() if p.name.startswith("part-"))
        assert (len(files) == 1) == (coalesce == "true")
        assert "".join(p.read_text() for p in files).splitlines() == want
        assert sorted(r.report for r in read_report(spark, str(path)).collect()) == sorted(want)


def test_parse_report(spark):
    lines = ["a=1.0/2.0/3.0", "a=b=c/d=-0.0/0.0/1", "=1/2/3", "é=1/2/3", "no numbers", "x=1/2", "x=1/y/3", "x=1/2/3/4", "1/2/3"]
    df = spark.createDataFrame([(s,) for s in lines], "report string")
    got = [tuple(r)[1:] for r in parse_report(df).collect()]
    assert got[:4] == [
        ("a", True, 1.0, 2.0, 3.0),
        ("a=b=c/d", True, -0.0, 0.0, 1.0),
        ("", True, 1.0, 2.0, 3.0),
        ("é", True, 1.0, 2.0, 3.0),
    ]
    assert got[4:] == [(line, False, None, None, None) for line in lines[4:]]


def _reports(spark, *texts):
    return [spark.createDataFrame([(t,) for t in text], "report string") for text in texts]


def test_diff_by_station(spark):
    expected, actual = _reports(
        spark,
        ["a=0.0/1.0/2.0", "b=1.0/1.0/1.0", "c=1.0/1.0/1.0", "=odd=1.0/1.0/1.0", "junk", "twice=1/1/1", "gone != x=1/1/1"],
        ["a=-0.0/1.0/2.0", "b=1.0/1.1/1.0", "d=1.0/1.0/1.0", "=odd=1.0/1.0/1.0", "junk", "twice=1/1/1", "twice=1/1/1"],
    )
    got = {r.station: r.status for r in diff_by_station(expected, actual).collect()}
    assert got == {
        "a": "equal",
        "b": "changed",
        "c": "missing",
        "d": "extra",
        "=odd": "equal",
        "junk": "equal",
        "twice": "changed",
        "gone != x": "missing",
    }
    summary = {r.status: r.n for r in diff_summary(diff_by_station(expected, actual)).collect()}
    assert summary == {"equal": 3, "changed": 2, "missing": 2, "extra": 1}


def test_repeated_stations_are_matched(spark):
    one, two = _reports(spark, ["a=1/1/1", "a=2/2/2", "b=1/1/1", "b=1/1/1"], ["a=2/2/2", "a=1/1/1", "b=1/1/1", "b=2/2/2"])
    assert {r.station: r.status for r in diff_by_station(one, one).collect()} == {"a": "equal", "b": "equal"}
    assert {r.station: r.status for r in diff_by_station(one, two).collect()} == {"a": "equal", "b": "changed"}


def test_suffixes_are_no_numbers(spark):
    one, two = _reports(spark, ["a=1/1/1", "b=1/1/1", "c=nan/-inf/Infinity"], ["a=1.0d/1f/1.0", "b=1e0/+1/01.0", "c=NaN/-INF/infinity"])
    got = {r.station: r.status for r in diff_by_station(one, two).collect()}
    assert got == {"a": "missing", "a=1.0d/1f/1.0": "extra", "b": "equal", "c": "equal"}


def test_cut_report_is_noticed(spark):
    rep = _summary(spark, 200).select("report")
    cut = rep.orderBy("report").limit(150)
    assert {r.status: r.n for r in diff_summary(diff_by_station(rep, cut)).collect()} == {"equal": 150, "missing": 50}
    assert diff_by_position(rep, cut).count() == 50


def test_diff_by_position(spark):
    expected, actual = _reports(spark, ["a=1/1/1", "b=1/1/1", "c=1/1/1"], ["a=1/1/1", "c=1/1/1"])
    got = sorted(tuple(r) for r in diff_by_position(expected, actual).collect())
    assert got == [(2, "b=1/1/1", "c=1/1/1"), (3, "c=1/1/1", None)]
    assert diff_by_position(expected, expected).collect() == []


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_diff_by_position_of_repeated_lines(spark, coalesce, monkeypatch):
    monkeypatch.setattr(compare, "_STEP", 7)
    rng = random.Random(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        for sizes in ((0, 9), (40, 40), (300, 280), (2000, 2001)):
            sides = [[f"s{rng.choice([1, 1, 1, 2, 3, rng.randint(4, 30)]):02d}={rng.randint(1, 2)}/1/1" for _ in range(n)] for n in sizes]
            e, a = (sorted(s) for s in sides)
            want = [(i + 1, x, y) for i, (x, y) in enumerate(zip_longest(e, a)) if x != y]
            got = diff_by_position(*(spark.createDataFrame([(x,) for x in s], "report string") for s in sides))
            assert sorted(tuple(r) for r in got.collect()) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_long_run_costs_its_differences_only(spark):
    many = spark.range(3_000_000).select(F.lit("m=1/1/1").alias("report"))
    one = spark.createDataFrame([("a=1/1/1",)], "report string")
    got = sorted(tuple(r) for r in diff_by_position(many, many.union(one)).collect())
    assert got == [(1, "m=1/1/1", "a=1/1/1"), (3_000_001, None, "m=1/1/1")]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_upper_median(spark, coalesce):
    # Without coalescing the hot key lies in several partitions, and its middle in one of them.
    rng = random.Random(5)
    runs = {f"e{i}": [rng.choice([1.0, 2.5, rng.random()]) for _ in range(n)] for i, n in enumerate((1, 2, 3, 4, 5, 100, 101))}
    runs["hot"] = [rng.gauss(0, 1) for _ in range(20_000)]
    runs["ties"] = [7.0] * 5000 + [1e300, -1e300]
    df = spark.createDataFrame([(k, v) for k, vs in runs.items() for v in vs] + [("hot", None), (None, 2.0)], "entry string, seconds double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = {r.entry: r.median for r in upper_median(df, "entry", "seconds").collect()}
        assert upper_median(df.limit(0), "entry", "seconds").collect() == []
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {None: 2.0} | {k: sorted(v)[len(v) // 2] for k, v in runs.items()}


def test_leaderboard_leaves_failed_runs_out(spark):
    runs = [("a", 1, 3.0, True), ("a", 2, 1.0, True), ("a", 3, 2.0, True), ("b", 1, 2.0, True), ("c", 1, 0.1, False)]
    df = spark.createDataFrame(runs, "entry string, run int, seconds double, ok boolean")
    got = sorted(tuple(r) for r in leaderboard(df).collect())
    assert got == [(1, "a", 2.0), (2, "b", 2.0)]


def test_station_names(spark, tmp_path):
    texts = ["# head\nAa;1\nBb;2;x\nAa;9\n", "Cc\r\nDd;\x0bEe\u2028Ff\x85Gg\n\n;z", "", "no#pe\nHh", "\n"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    want = ["", "Aa", "Bb", "Cc", "Dd", "Ee", "Ff", "Gg", "Hh"]
    rows = [r.station for r in station_names(df).collect()]
    assert sorted(rows) == want
    (tmp_path / "list.csv").write_text("# c\nX;1\nY;2\nX;3\n")
    assert sorted(r.station for r in station_names(read_lines(spark, str(tmp_path / "list.csv"))).collect()) == ["X", "Y"]


def test_name_limits(spark):
    df = spark.createDataFrame([("a",), ("é" * 51,), ("b" * 100,), ("a",)], "station string")
    assert tuple(name_limits(df).first()) == (3, 102, 1, False)
    assert tuple(name_limits(df, max_bytes=102).first()) == (3, 102, 0, True)
    assert name_limits(df, max_stations=2, max_bytes=102).first().within_limits is False


def test_estimate_file_size(spark):
    df = spark.createDataFrame([("abc",), ("é",), ("abc",)], "station string")
    row = estimate_file_size(df, 1_000_000).first()
    size = 1_000_000 * (2.5 + 4.400200100050025 + 2)
    assert row.n_names == 2 and row.avg_bytes == 2.5 and math.isclose(row.est_bytes, size, rel_tol=1e-12)
    assert row.est_text == f"{size / 2**20:.1f} MiB"
    assert math.isclose(estimate_file_size(df).first().est_bytes, 3 * (2.5 + 4.400200100050025 + 2))


def test_generated_measurements(spark, tmp_path):
    names = spark.createDataFrame([(f"n{i}",) for i in range(50)], "station string")
    rows = generate_measurements(measurement_ids(spark, 40_000), names)
    out = str(tmp_path / "m")
    write_measurements(rows, out)
    lines = [r.value for r in read_lines(spark, out).collect()]
    assert len(lines) == 40_000  # not only whole batches
    parsed = [line.split(";") for line in lines]
    tenths = [round(float(number) * 10) for _, number in parsed]
    assert min(tenths) >= -999 and max(tenths) <= 999 and abs(sum(tenths) / len(tenths)) < 15
    assert len(set(tenths)) == 1999
    stations = Counter(station for station, _ in parsed)
    assert set(stations) <= {f"n{i}" for i in range(50)} and len(stations) == 50
    again = generate_measurements(measurement_ids(spark, 40_000, 3), names)
    assert sorted(r.line for r in again.collect()) == sorted(lines)
    assert len(summarize_lines(read_lines(spark, out)).collect()) == 50


def test_generator_takes_ids_of_any_size(spark):
    names = spark.createDataFrame([("x",), ("y",)], "station string")
    ids = spark.createDataFrame([(i,) for i in (0, 2**31, 2**40 + 5, 2**62, 2**63 - 1)], "id long")
    assert generate_measurements(ids, names).count() == 5
    assert city_integers(ids).count() == 5
    with pytest.raises(ValueError):
        generate_measurements(ids, names.where("false"))


def test_city_integers(spark):
    rows = city_integers(measurement_ids(spark, 50_000)).collect()
    assert Counter(r.city for r in rows).keys() == {f"City{c}" for c in "ABCDE"}
    assert {r.measurement for r in rows} == set(range(-1000, 1001))
    assert all(9000 < n < 11000 for n in Counter(r.city for r in rows).values())


def test_broadcast_only_below_the_limit(spark):
    big = spark.range(1000).select(F.col("id").alias("k"))
    small = spark.range(10).select(F.col("id").alias("k"), F.lit("x" * 50).alias("s"))

    def hinted(limit):
        return "broadcast" in big.join(broadcast_if_small(small, "s", limit), "k")._jdf.queryExecution().logical().toString()

    assert hinted(10_000) and not hinted(100)


def test_named_shared_folder_is_used(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
from gaugeline import with_position
from gaugeline.session import fresh_path
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", "{tmp_path}").getOrCreate())
print(fresh_path(spark, "x"))
assert with_position(spark.range(5), "id").count() == 5
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.strip().startswith(f"{tmp_path}/gaugeline-x-")
    assert list(tmp_path.glob("gaugeline-sorted-*"))


def test_pool_of_any_size(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(500)], "station string")
    assert generate_measurements(measurement_ids(spark, 5000), names, slots=20).select("station").distinct().count() <= 20


def test_intermediate_tables_can_be_dropped(spark, tmp_path):
    from gaugeline import drop_intermediate

    drop_intermediate(spark)
    path = fresh_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert drop_intermediate(spark) == 1 and drop_intermediate(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_folders_of_one_machine_are_refused_on_a_cluster():
    from types import SimpleNamespace

    from gaugeline.session import shared_dir

    def session(master, folder):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: folder, setCheckpointDir=lambda x: None)
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))

    for master, folder in (("yarn", None), ("local-cluster[2,1,512]", None), ("spark://x:7077", "file:/tmp/x")):
        with pytest.raises(ValueError):
            shared_dir(session(master, folder))
    assert shared_dir(session("yarn", "hdfs:///x")) == "hdfs:///x"
    assert shared_dir(session("local-cluster[2,1,512]", "file:///x")) == "file:///x"


def test_fresh_paths_differ(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
