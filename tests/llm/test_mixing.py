"""Mixing: targets by plain water filling, the sample's properties, and reruns."""

import re
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def plain_targets(sizes):
    """Share by weight, stop at three times the size, share the excess again until none is above."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def check(rows, texts):
    """rows (doc_id, source, size, source_size, target, taken)"""
    sizes = defaultdict(int)
    for i, s, size, *_ in rows:
        assert size == len(re.findall(r"[^\x20\x09-\x0D]+", texts[i] or ""))
        sizes[s] += size
    target, taken, largest = plain_targets(sizes), defaultdict(int), defaultdict(int)
    for i, s, size, source_size, t, k in rows:
        assert source_size == sizes[s] and t == pytest.approx(target[s], rel=1e-9)
        epochs = int(target[s] / sizes[s] + 1e-9) if sizes[s] else 0
        assert k in (epochs * size, (epochs + 1) * size) and k <= 3 * size
        taken[s] += k
        largest[s] = max(largest[s], size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


def test_query_on_a_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")
    got = queries.op7_mixing(spark, SF).collect()
    assert len(got) == len(docs)
    check([(r.doc_id, docs.source[r.doc_id], r.size, r.source_size, r.target, r.taken) for r in got], docs.text.to_dict())
    assert sorted(got) == sorted(queries.op7_mixing(spark, SF).collect())


def test_odd_rows(spark):
    texts = {0: None, 1: "", 2: " \t", 3: "a b c", 4: "word " * 30000, 5: "x", 6: "same text", 7: "same text"}
    texts |= {i: "w " * (i % 17 + 1) for i in range(8, 400)}
    source = {0: "b", 1: "ä", 2: "ä", 3: None, 4: "big", 5: "A", 6: "b", 7: "b"}
    rows = [(i, t, source.get(i, ("b", "c", None, "z")[i % 4]), "mine", 5) for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string, _key int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and {r._key for r in got} == {5}
    check([(r.doc_id, source.get(r.doc_id, ("b", "c", None, "z")[r.doc_id % 4]), r.size, r.source_size, r.target, r.taken) for r in got], texts)
    repeated = spark.createDataFrame([(1, "a b", "s")] * 50 + [(None, "c", "s"), (2, "d e f", "t")], "doc_id long, text string, source string")
    assert mixing.mix(repeated).count() == 52
    assert mixing.mix(df.limit(0)).collect() == []


def test_heavier_documents_come_first(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.when(F.col("id") < 4000, "a").otherwise("b").alias("source"))
    got = mixing.mix(df, quality=F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0))
    # a: 4000 documents, a third of the mix; half of it is taken.
    share = {r.even: r.n for r in got.where("source = 'a' AND taken > 0").groupBy((F.col("doc_id") % 2 == 0).alias("even")).agg(F.count("*").alias("n")).collect()}
    assert sum(share.values()) == 2000
    # Of the heavy half 1 - x^4 and of the light half 1 - x are taken, with x + x^4 = 1: x = 0.7245.
    assert share[True] == pytest.approx(2000 * (1 - 0.7245**4), abs=90)
