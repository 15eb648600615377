"""Physical plans of all registered queries, and number parsing on random text."""

import os
import random
import re
from decimal import ROUND_HALF_UP, Context, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from gaugeline.functions.numbers import to_units
from gaugeline.plans import quality, summary, verify

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")
@pytest.mark.parametrize("name", sorted({**summary.QUERIES, **quality.QUERIES, **verify.QUERIES}))
def test_no_python_and_no_cross_join(spark, name):
    plan = contract.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        assert node not in plan


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")
@pytest.mark.parametrize(
    "name, columns",
    [
        ("station_frame_agg", {"event_type", "value"}),
        ("city_int_agg", {"l_quantity", "l_returnflag"}),
        ("size_report", {"source", "text"}),
        ("span_report", {"user_id", "ts"}),
        ("estimated_file_size", {"p_name"}),
        ("generate_city_integers", {"event_id"}),
        ("station_state_merge", {"event_type", "value", "ts"}),
    ],
)
def test_scans_read_only_what_they_need(spark, name, columns):
    plan = contract.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert read and all({c.split("#")[0] for c in r.split(",")} == columns for r in read)


def _units(text, scale):
    """What `to_units` promises, in plain Python."""
    if not re.fullmatch(r"[ \t\n\r\x0b\x0c]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\n\r\x0b\x0c]*", text):
        return None
    with localcontext(Context(prec=200, Emax=10**9, Emin=-(10**9))):
        value = Decimal(text.strip(" \t\n\r\x0b\x0c"))
        if not value or value.adjusted() < -25:
            return 0
        if value.adjusted() > 25:
            return None
        units = int((value * 10**scale).quantize(Decimal(1), rounding=ROUND_HALF_UP))
    return units if abs(units) < 10**18 else None


@pytest.mark.parametrize("scale", [0, 1, 2, 4])
def test_numbers_of_any_shape(spark, scale):
    rng = random.Random(scale)
    alphabet = ["0", "1", "5", "9", "4", ".", "-", "+"] * 4 + ["e", "E", " ", "\t", "x", "d", "_", "\x00", "\x1f", "\x7f", "٣", " "]
    texts = {"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9))) for _ in range(15_000)}
    texts |= {f"{rng.uniform(-10**k, 10**k):.{rng.randint(0, 5)}f}" for k in range(19) for _ in range(200)}
    texts |= {f"{k / 10:.1f}" for k in range(-999, 1000)} | {f"{k / 100:.2f}" for k in range(-2000, 2001)}
    texts |= {"1e-0002", "1e0003", "1e1000", "1e-1000", "1e-0000999", "9" * 40, "0." + "0" * 50 + "1", "99999999999.95", "0e94", "0.0e-99999", "1e99999", "1e-99999", "9" * 19, "99999999999999999.95", "99999999999999999.94"}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "v string")
    got = {r.v: r.t for r in df.select("v", to_units("v", scale).alias("t")).collect()}
    wrong = {t: (got[t], _units(t, scale)) for t in got if got[t] != _units(t, scale)}
    assert not wrong, dict(list(wrong.items())[:10])
