"""Every pipeline stage against a plain version, on the rows that the stage before kept."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from gaugeline.llm import knn_quality, minhash

from .test_minhash import plain
from .test_mixing import check
from .test_pii import PATTERNS

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def test_stages_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "pii", "mix", "bpe"]
    assert all(list(s.columns) == COLUMNS for s in steps[:5])
    assert all(len(s) for s in steps)


def test_quality(steps):
    docs, kept = steps[0], steps[1]
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    train = labels[labels.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 != 0)].merge(docs, on="doc_id").sort_values("doc_id")
    model = knn_quality.train(np.stack([knn_quality.counts(t.encode()) for t in train.text]), train.quality.to_numpy(float))
    scores = {}
    for d in docs.itertuples():
        v = knn_quality.vectors(model, knn_quality.counts(d.text.encode())[None])[0]
        near = sorted(((float(v @ w), q) for w, q in zip(model.vectors, model.labels)), reverse=True)[: knn_quality.NEIGHBOURS]
        scores[d.doc_id] = np.average([q for _, q in near], weights=[max(s, 1e-3) ** knn_quality.SHARPNESS for s, _ in near])
    sure = {i for i, s in scores.items() if abs(s - knn_quality.THRESHOLD) > 0.03}
    assert len(sure) > 0.9 * len(docs)
    assert set(kept.doc_id) & sure == {i for i in sure if scores[i] >= knn_quality.THRESHOLD}
    # Clean documents stay.
    good = labels[labels.quality == 1].doc_id
    assert good.isin(kept.doc_id).mean() > 0.97


def test_near_duplicates(steps):
    want = {i for i, (_, c) in plain(list(zip(steps[1].doc_id, steps[1].text)), corpus_pipeline.SIMILAR).items() if i == c}
    assert sorted(steps[2].doc_id) == sorted(want) and len(want) < len(steps[1])


def test_private_data(steps):
    before, after = (s.set_index("doc_id") for s in steps[2:4])
    assert set(before.index) == set(after.index)
    for i, old in before.text.items():
        found = [x for p in PATTERNS.values() for x in p.findall(old)]
        assert (after.text[i] != old) == bool(found) and not any(x in after.text[i] for x in found)
        assert after.n_chars[i] == len(after.text[i])


def test_mix(steps):
    docs, mixed = steps[3], Counter(steps[4].doc_id)
    words = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text)) for d in docs.itertuples()}
    assert set(mixed) <= set(docs.doc_id) and max(mixed.values()) <= 3
    total = docs.assign(n=docs.doc_id.map(words)).groupby("source").n.sum().to_dict()
    from .test_mixing import plain_targets

    target = plain_targets(total)
    check([(d.doc_id, d.source, words[d.doc_id], total[d.source], target[d.source], mixed[d.doc_id] * words[d.doc_id]) for d in docs.itertuples()], dict(zip(docs.doc_id, docs.text)))


def test_encoding(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = dict(zip(steps[4].doc_id, steps[4].text))
    assert Counter(steps[4].doc_id) == Counter(steps[5].doc_id)
    for r in steps[5].itertuples():
        ids = np.array(library.encode(text[r.doc_id], add_special_tokens=False).ids, "<u4")
        assert (bytes(r.ids), r.n_tokens) == (ids.tobytes(), len(ids))
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages_in_turn(spark, steps):
    got = contract.queries()["pipeline"](spark, SF).toPandas()
    assert Counter(zip(got.doc_id, got.ids_sha256)) == Counter(zip(steps[5].doc_id, steps[5].ids_sha256))


def test_odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows, an extra column, an empty table."""
    texts = [None, "", " ", "one", "word " * 30_000, "twin text of this corpus here", "twin text of this corpus here", "mail a.b@c.de to us"]
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None, "x", 1) for i, t in enumerate(texts)] + [(None, "no id", None, None, None, None, None), (7, texts[7], "en", None, None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, _row int")
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs, empty = stage(spark, docs, SF), stage(spark, empty, SF)
        assert docs.count() > 0 and empty.count() == 0 and {"size", "_row"} <= set(docs.columns)


def test_near_duplicates_from_080_on(spark):
    """Pairs that differ in one word: n shingles each, similarity (n - 5) / (n + 5)."""
    rows = []
    for n in (*range(36, 45), *range(45, 62)):  # below 0.8, and from 0.8 to 0.85
        words = [f"w{n}x{k}" for k in range(n + 4)]
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join([*words[:20], "other", *words[21:]]))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()}
    assert kept == {i for i, _ in rows if i % 2 == 0 or i < 90}
    # The query's own threshold stays 0.85.
    assert all(r.kept for r in minhash.deduplicated(docs).collect())
