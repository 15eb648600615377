"""Near-duplicates against all pairs of full sets."""

import random
import re

import numpy as np
import pandas as pd

from gaugeline.llm import minhash, queries

SF = "/root/testdata/sf0.01"


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(docs, least=85):
    """doc_id -> (n, component) from all pairs; rows with an id only."""
    sets = [(i, plain_set(t)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * min(len(a), len(b)) >= least * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= least * (len(a) + len(b) - both):
                    r, s = sorted((find(i), find(j)))
                    root[s] = r
    return {i: (len(s), find(i)) for i, s in sets}


def agree(rows, docs):
    want = plain(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_shingles, r.component_id) == want[r.doc_id]
        assert r.kept == (r.doc_id == r.component_id)


def test_query_on_a_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows = queries.op8_minhash(spark, SF).collect()
    assert sum(not r.kept for r in rows) > 20
    agree(rows, list(zip(docs.doc_id, docs.text)))


def test_odd_texts_and_chains(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    texts = [None, "", " \n", "one", "ONE", "one two three four", "one two three  four\n", "a b c d e", "a b c d e f", "Á b c d e", "á b c d e", "x " * 9000, "x " * 50, "long" * 20000]
    chain = list(base)
    for k in range(30):  # each link alone is close enough, the ends are far apart
        texts.append(" ".join(chain))
        at = rng.randrange(300)
        chain[at] = f"n{k}"
    for _ in range(60):  # a family whose members differ from each other more than from their origin
        copy = list(base)
        for at in rng.sample(range(300), 4):
            copy[at] = f"r{rng.random()}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"p{i}" for i in range(100))] * 40
    docs = [(1000 - i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "n") for i, t in docs], "doc_id long, text string, node string")
    agree(minhash.deduplicated(df).collect(), docs)
    assert minhash.deduplicated(df.limit(0)).collect() == []


def test_rows_without_id_and_with_the_same_id(spark):
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (5, "a b c d e f g"), (5, "q r s t u v w x"), (7, "q r s t u v w x"), (7, "q r s t u v w x"), (9, "q q q q q q q q")]
    out = minhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out if r.doc_id) == [(5, 5, True), (5, 5, True), (7, 5, False), (7, 5, False), (9, 9, True)]
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)] * 2


A, B, U = "a b c d e f g", "q r s t u v w x", "k l m n o p"


def test_sets_of_one_id_are_linked(spark):
    rows = [(1, A), (2, A), (2, B), (3, B), (4, U), (4, None), (6, U + " z")]
    out = minhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4), (4, 4), (6, 6)]


def test_no_text_without_a_copy_is_lost(spark):
    rows = [(2, U, "x"), (1, A, "x"), (2, A, "x"), (2, B, "x"), (3, B, "x"), (None, B, "x"), (None, "own words of a text", "x"), (None, "", "x"), (5, None, "x"), (5, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    got = sorted(map(tuple, minhash.representatives(df).collect()), key=repr)
    assert got == sorted([rows[i] for i in (0, 1, 3, 6, 7, 8, 9)], key=repr)
    assert minhash.representatives(df.limit(0)).collect() == []


def test_rows_of_one_id_in_three(spark):
    """A third of all rows share an id; each text stays once."""
    rows = [(0 if i % 3 else i, f"text number {i % 200} of some words {i % 200}") for i in range(600)]
    got = minhash.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in got) == sorted({t for _, t in rows})


def test_sketches_leave_out_only_unlike_partners():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**64, 400, dtype=np.uint64))]
    for share in np.linspace(0.3, 1, 60):
        k = int(400 * share)
        sets.append(np.unique(np.concatenate([sets[0][:k], rng.integers(0, 2**64, 400 - k, dtype=np.uint64)])))
    rows = [(i, len(x), (minhash._mixed(minhash.signature(x)) & np.uint64(255)).astype(np.uint8).tobytes()) for i, x in enumerate(sets)]
    found = {i for i, second in minhash.alike(rows[:1], rows[1:], 80) if second}
    linked = {i for i, x in enumerate(sets[1:]) if minhash.linked(sets[0], x, 80)}
    assert linked and linked <= found and len(found) < 45
    # Partners of one component don't count.
    assert minhash.alike([(7, *rows[0][1:])] * 5, None, 80) == []


def test_hubs_are_split(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HUB_ROWS", 5)
    docs = [(i, " ".join([f"w{k}" for k in range(80)] + [f"tail{i}"])) for i in range(60)]
    agree(minhash.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        n, got = 2000, []
        for _ in range(20):
            x = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
            k = int(n * share)
            a, b = x[:n], np.concatenate([x[:k], x[n : 2 * n - k]])
            got.append((minhash.signature(a) == minhash.signature(b)).mean())
        assert abs(np.mean(got) - k / (2 * n - k)) < 0.03


def test_blocks_of_a_bucket(spark, monkeypatch):
    """Families whose members are close to the threshold, in blocks of three."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)
    monkeypatch.setattr(minhash, "TEXT_ROWS", 2)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(70):
        copy = list(base)
        for at in rng.sample(range(120), rng.randint(1, 3)):
            copy[at] = f"r{rng.random()}"
        docs.append((i, " ".join(copy)))
    agree(minhash.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


def test_overlaps_are_exact(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 6000)).astype(np.uint64)) for _ in range(24)]
    sets = [np.unique(minhash._mixed(x)) for x in sets]
    for held in (minhash._HELD_SHINGLES, 1000):
        monkeypatch.setattr(minhash, "_HELD_SHINGLES", held)
        got = minhash.overlaps(sets[:9], sets[9:])
        assert (got == [[len(np.intersect1d(a, b)) for b in sets[9:]] for a in sets[:9]]).all()
