"""Top-k against all inner products."""

import math

import numpy as np
import pandas as pd
import pytest

from gaugeline.llm import mtree, queries

SF = "/root/testdata/sf0.01"


def plain(rows, k, every):
    """rows (id, vector): {(query, rank): (id, score)}"""
    good = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) or abs(x * 256) >= 1 << 24 for x in v):
            continue
        good.append((i, [math.floor(256 * float(x)) for x in v]))
    out = {}
    for i, q in good:
        if i % every == 0:
            found = sorted({(-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i})[:k]
            out |= {(i, r + 1): (j, -s) for r, (s, j) in enumerate(found)}
    return out


def result(df):
    rows = df.collect()
    out = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_on_a_table(spark):
    data = pd.read_parquet(f"{SF}/embeddings.parquet")
    assert result(queries.op9_mtree(spark, SF)) == plain(list(zip(data.vec_id.tolist(), [list(map(float, v)) for v in data.embedding])), 5, 50)


@pytest.mark.parametrize("node, page, block", [(8192, 64, 16384), (40, 8, 3)])
def test_odd_vectors(spark, monkeypatch, node, page, block):
    monkeypatch.setattr(mtree, "NODE_ROWS", node)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", block)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 1, 8).tolist()) for i in range(1, 400)]
    rows += [(400 + i, [0.5] * 8) for i in range(150)]  # one vector many times
    rows += [(600, None), (610, [1.0, None] + [0.0] * 6), (620, [float("nan")] * 8), (630, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (640, []), (650, [2.0]), (660, [0.0] * 8), (670, [1e30] + [0.0] * 7), (680, [30000.0] * 8), (-10, [-1.0] * 8)]
    rows += [(700, [0.25] * 8), (700, [0.25] * 8)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, branch string")
    f32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert result(mtree.top_k(df, 5, 10)) == plain(f32, 5, 10)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "vec_id long, embedding array<float>")
    assert result(mtree.top_k(df, 5, 50)) == {(0, 1): (1, 256 * 256 * 11)}
    assert result(mtree.top_k(df.where("vec_id = 0"), 5, 50)) == {}
    assert result(mtree.top_k(df.where("vec_id = 1"), 5, 50)) == {}
    assert result(mtree.top_k(df.limit(0), 5, 50)) == {}


def test_bounds_save_work():
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 300, (20, 16))
    rows = (centres[rng.integers(0, 20, 4000)] + rng.normal(0, 5, (4000, 16))).astype(np.int64)
    node = mtree.Node(np.arange(4000), rows, int((rows**2).sum(axis=1).max()))
    asked = []
    plain_products = mtree._products
    mtree._products = lambda a, b: asked.append(len(a) * len(b)) or plain_products(a, b)
    try:
        node.search(np.array([-1]), rows[:1], np.array([-(1 << 60)]), 5)
    finally:
        mtree._products = plain_products
    assert sum(asked) < 2000


@pytest.mark.parametrize("page, pivots", [(64, 32), (4, 3)])
def test_repeated_rows(spark, monkeypatch, page, pivots):
    """The nearest candidate five times and more, a query's row twice, an id with several vectors."""
    monkeypatch.setattr(mtree, "PAGE", page)
    monkeypatch.setattr(mtree, "PIVOTS", pivots)
    rng = np.random.default_rng(5)
    rows = [(i, np.round(rng.normal(0, 1, 8), 3).tolist()) for i in range(1, 300)]
    rows += [(1000 + i, [0.0] * 7 + [i / 100]) for i in range(3)]
    best = [3.0 * x for x in rows[49][1]]
    rows += [(501, best)] * 5 + [(502, best)] * 7 + [rows[49]] * 3 + [rows[99]] * 2
    rows += [(503, best), (503, [*best, 0.0]), (503, [2.0 * x for x in best]), (151, [5.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(mtree.top_k(df, 5, 50)) == plain([(i, v + [0.0] * (9 - len(v))) for i, v in rows], 5, 50)


def whole(rows, k, every):
    """As `plain`, with every finite vector."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    out = {}
    for i, q in good:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)[:k]
            out |= {(i, r + 1): (j, -s) for r, (s, j) in enumerate(found)}
    return out


def test_large_components(spark, monkeypatch):
    """Components of 65,536 and more, products of more than 2^53, and partial sums beyond 2^63 that cancel."""
    monkeypatch.setattr(mtree, "PIVOTS", 3)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(0, 1, 8) * (70_000 if i % 3 else 1)).tolist()) for i in range(1, 200)]
    rows += [(200, [100_000.0] * 8), (201, [65_536.0] + [0.0] * 7)]
    schema = "vec_id long, embedding array<double>"
    assert result(mtree.top_k(spark.createDataFrame(rows, schema), 5, 20)) == whole(rows, 5, 20)
    big = [2.0**30, 2.0**30] + [1.0] * 6
    rows = [(0, big), (1, [2.0**25, -(2.0**25)] + [1.0] * 6), (2, [-(2.0**25), 2.0**25] + [3.0] * 6), (3, [-1.0] * 8), (4, [2.0] * 8), (5, [0.5] * 8)]
    assert result(mtree.top_k(spark.createDataFrame(rows, schema), 5, 50)) == whole(rows, 5, 50)
    with pytest.raises(Exception, match="doesn't fit a long"):
        mtree.top_k(spark.createDataFrame(rows + [(6, big)], schema), 5, 50).collect()


def test_clustered_queries_visit_few_leaves(spark, monkeypatch):
    """Leaves are regions: with clustered rows most are ruled out; hot leaves are read in shares, the result is exact."""
    monkeypatch.setattr(mtree, "NODE_ROWS", 60)
    monkeypatch.setattr(mtree, "PIVOTS", 8)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 7)
    monkeypatch.setattr(mtree, "DEAL_ROWS", 50)
    kept = {}
    plain_stored = mtree.stored
    monkeypatch.setattr(mtree, "stored", lambda df, label: kept.setdefault(label, []).append(plain_stored(df, label)) or kept[label][-1])
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (30, 12))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    rows = [(i, np.round(centres[i % 30] + rng.normal(0, 0.02, 12), 4).tolist()) for i in range(1, 1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(150)]  # equal vectors, more than a leaf holds
    got = result(mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 50))
    assert got == plain(rows, 5, 50)
    leaves = kept["mtree-pages"][0].select("leaf").distinct().count()
    queries = sum(i % 50 == 0 for i, _ in rows)
    visits = sum(v.count() for v in kept["mtree-visits"])
    assert leaves > 30 and queries <= visits < 0.4 * queries * leaves
    assert len(kept["mtree-level"]) >= 1


def test_stored_pages_are_the_node():
    rng = np.random.default_rng(3)
    rows, ids = rng.integers(-500, 500, (700, 6)), np.arange(700)
    most = float((rows**2).sum(axis=1).max())
    node = mtree.Node(ids, rows, most)
    read = mtree.Node.read(node.stored(), 6, most)
    assert sorted(read.ids.tolist()) == ids.tolist() and max(len(p) for p in read.pages) <= mtree.PAGE
    for page, head, radius, to_top, dists in zip(read.pages, read.heads, read.radii, read.to_top, read.dists):
        apart = mtree._apart(read.rows[page], head[None, :], most)[:, 0]
        assert np.allclose(apart, dists) and dists.max() == radius and np.isclose(mtree._apart(head[None, :], read.top, most)[0, 0], to_top)
    assert mtree._apart(read.rows, read.top, most).max() <= node.radius + 1e-6
    q = rng.integers(-500, 500, (20, 6))
    for one, two in zip(node.search(-np.arange(1, 21), q, np.full(20, mtree.NONE), 5), read.search(-np.arange(1, 21), q, np.full(20, mtree.NONE), 5)):
        assert (one == two).all()
