"""Edited texts exactly, samples against a plain reading, likeness against the true similarity."""

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gaugeline.llm import queries
from gaugeline.llm import weighted_sampling as cws

SF = "/root/testdata/sf0.01"


def edited(texts):
    """doc_id -> edited text, from (doc_id, text), ids distinct."""
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=True)
    out = {}
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        k = len(t) // 2
        out[i] = t[: len(t) - k] + n[:k]
    return out


def similarity(a, b):
    x, y = (Counter(t.lower().split()) for t in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_query_on_a_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    text = dict(zip(docs.doc_id, docs.text))
    rows = {r.doc_id: r for r in queries.op10_weighted_sampling(spark, SF).collect()}
    assert set(rows) == set(text)
    want = edited(list(text.items()))
    order = sorted(text, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    near, true = [], []
    for i, r in rows.items():
        assert r.n_chars == len(text[i]) and r.edited_sha256 == hashlib.sha256(want[i].encode()).hexdigest()
        same = [rows[i].fingerprint[k : k + 8] == rows[after[i]].fingerprint[k : k + 8] for k in range(0, 8 * cws.SAMPLES, 8)]
        assert r.near_next == sum(same) / cws.SAMPLES
        near.append(r.near_edited)
        true.append(similarity(text[i], want[i]))
    near, true = np.array(near), np.array(true)
    # 1000 documents, 32 samples each: the mean error is a small part of one sample's.
    assert abs((near - true).mean()) < 0.01
    z = (near - true) / np.sqrt(np.maximum(true * (1 - true), 0.01) / cws.SAMPLES)
    assert 0.85 < z.std() < 1.15
    prints = {}
    for i, t in text.items():
        assert prints.setdefault(t, rows[i].fingerprint) == rows[i].fingerprint


def test_draws_follow_their_distributions(spark):
    """With weight 1 a word's value is ln c - r (1 - b): mean and spread as for gamma(2) and a uniform."""
    frame = spark.range(100_000).select(*[cws.sample(F.xxhash64("id"), F.lit(0.0), k).alias(f"s{k}") for k in range(3)])
    got = frame.toPandas()
    rng = np.random.default_rng(0)
    ref = np.log(rng.gamma(2, 1, 10**6)) - rng.gamma(2, 1, 10**6) * (1 - rng.random(10**6))
    for k in range(3):
        assert np.abs(np.quantile(got[f"s{k}"], [0.01, 0.1, 0.5, 0.9, 0.99]) - np.quantile(ref, [0.01, 0.1, 0.5, 0.9, 0.99])).max() < 0.06
    assert np.abs(got.corr().to_numpy() - np.eye(3)).max() < 0.02


def test_weights_count(spark):
    """Samples of weighted pairs collide as often as the generalised Jaccard similarity."""
    rows = [(i, s, t.replace("  ", " ")) for i, s, t in [(i, s, f"{i}a " * a + f"{i}b " * b + f"{i}c " * c) for i in range(300) for s, a, b, c in ((0, 8, 2, 0), (1, 4, 4, 2))]]
    got = cws.samples(spark.createDataFrame(rows, "id long, side int, t string"), ["id", "side"], "t").toPandas()
    a, b = (np.stack(got[got.side == s].sort_values("id").samples) for s in (0, 1))
    assert abs((a == b).mean() - 6 / 14) < 0.02


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(cws, "BUCKET_ROWS", 4)
    texts = [(-(2**63), "least id"), (2**63 - 1, "largest id"), (7, None), (8, ""), (9, " \n"), (10, "a"), (11, "😀é日"), (12, "word " * 20000), (13, "Same same"), (14, "Same same"), (None, "no id at all")]
    texts += [(100 + i * i, f"text {i} " * (i % 5)) for i in range(40)]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in texts], "doc_id long, text string, bucket int, side string")
    out = {r.doc_id: r for r in cws.edited_fingerprints(df).collect()}
    want = edited(texts)
    assert len(out) == len(texts)
    for i, t in texts:
        assert out[i].edited_sha256 == hashlib.sha256(want[i].encode()).hexdigest(), i
    assert out[7].fingerprint == out[8].fingerprint == out[9].fingerprint == "0" * 8 * cws.SAMPLES
    assert out[9].near_next == 1.0 and out[10].near_next == 0.0 and out[14].near_next == 1.0
    one = cws.edited_fingerprints(df.where("doc_id = 12")).collect()[0]
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256((("word " * 20000)[:50000] * 2).encode()).hexdigest()
    assert cws.edited_fingerprints(df.limit(0)).collect() == []
    twice = cws.edited_fingerprints(df.where("doc_id = 13").union(df.where("doc_id = 13")).union(df.where("doc_id = 10"))).collect()
    assert len(twice) == 3


def test_no_python_in_the_plan(spark):
    plan = queries.op10_weighted_sampling(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
