"""Frequent lines against a literal count, and the store of runs."""

import hashlib
import random
from collections import Counter

import pandas as pd
import pytest

from gaugeline.llm import line_runs, queries
from gaugeline.session import fresh_path

SF = "/root/testdata/sf0.01"
ASCII = {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(ASCII)


def plain(texts, least, shortest=1):
    """(n_lines, n_dropped, kept) of each text."""
    lines = [(t or "").split("\n") for t in texts]
    seen = Counter(k for own in lines for k in {key(x) for x in own})
    out = []
    for own in lines:
        kept = [x for x in own if len(key(x)) < shortest or seen[key(x)] < least]
        out.append((len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_on_a_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    want = sorted((i, n, d, sha(k)) for i, (n, d, k) in zip(docs.doc_id, plain(docs.text, 10)))
    got = queries.QUERIES["op11_line_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == want
    assert any(d for _, _, d, _ in want)


ODD = [None, "", "\n", "a", "A ", "\ta\r", "a\n\nA", "É\né", "é", "x" * 300_000, "y\n" * 20_000, "b\nb\nb", "b", " a", "a\x0b\nc", "\n\n\na"]


@pytest.mark.parametrize("few", (1 << 18, 0))
@pytest.mark.parametrize("least", (1, 2, 4))
def test_odd_texts(spark, least, few):
    rng = random.Random(5)
    texts = ODD + ["\n".join(rng.choice("aAbB cC\t") for _ in range(rng.randint(0, 9))) for _ in range(200)]
    rows = [(None if i % 3 == 0 else i % 20, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    store = line_runs.LineRuns(spark, fresh_path(spark, "runs"), least)
    for part in range(3):
        store.add(docs.where(f"n_lines % 3 = {part}"))
    got = store.without(docs, broadcast_keys=few)
    assert got.columns == ["doc_id", "text", "n_lines", "_n_lines", "n_dropped"]
    assert sorted((r.n_lines, r._n_lines, r.n_dropped, r.text) for r in got.collect()) == [(i, *w) for i, w in enumerate(plain(texts, least))]


def test_short_keys_stay(spark):
    texts = ["ab\nabc\né́", "ab\nabc\né́", "abc"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    store = line_runs.LineRuns(spark, fresh_path(spark, "runs"), 2, shortest=3)
    store.add(docs)
    assert sorted(r.text for r in store.without(docs).collect()) == sorted(k for _, _, k in plain(texts, 2, 3))


def test_runs_are_compacted_and_batches_merged(spark):
    path = fresh_path(spark, "runs")
    store = line_runs.LineRuns(spark, path, 2, buckets=3)
    texts = ["a\nb", "a\nc", "a\nd", "d", "a\ne", "e\nf"]
    for nr, text in enumerate(texts):
        store.add(spark.createDataFrame([(text,)], "text string"))
        assert store.runs()[-1][1] == nr
    # The first four became one run; a stood in it often enough, so later runs leave it out.
    assert store.runs() == [(0, 3), (4, 4), (5, 5)]
    assert [store.read(r).count() for r in store.runs()] == [4, 1, 2]
    again = line_runs.LineRuns(spark, path, 2, buckets=3)
    assert again.runs() == store.runs()
    assert again.frequent().count() == 3  # a, d, e
    for run in ((6, 6), (7, 7)):
        again.add(spark.createDataFrame([("z",)], "text string"))
        assert again.runs()[-1][1] == run[1]
    assert again.runs() == [(0, 3), (4, 7)]
    assert again.frequent().count() == 4


def test_runs_are_written_in_sorted_buckets_and_not_moved(spark):
    store = line_runs.LineRuns(spark, fresh_path(spark, "runs"), 2, buckets=4)
    store.add(spark.createDataFrame([(f"{i}\n{i % 7}",) for i in range(200)], "text string"))
    run = store.read((0, 0))
    batch = store._summed(line_runs.key_counts(spark.createDataFrame([("1",)], "text string")))
    plan = batch.join(run.where("docs >= 2").hint("merge"), ["d1", "d2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan


def test_a_half_written_run_is_ignored(spark):
    path = fresh_path(spark, "runs")
    store = line_runs.LineRuns(spark, path, 2)
    store.add(spark.createDataFrame([("a",)], "text string"))
    spark.createDataFrame([(1, 2, 99)], "d1 long, d2 long, docs long").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/run-1-1")
    assert store.runs() == [(0, 0)]
    store.add(spark.createDataFrame([("a",)], "text string"))
    assert store.runs() == [(0, 0), (1, 1)] and store.frequent().count() == 1


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_runs.dropped_in_batches(docs, fresh_path(spark, "runs"), 2).collect() == []
