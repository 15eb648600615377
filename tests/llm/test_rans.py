"""Token files: round trip, order, checksums, and the ids against the tokenizers library."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeline.llm import bpe, queries, rans

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ODD = [
    "", " ", "\n\t ", "Hello, world!", "été DÉJÀ ÎLE", "été x́", "İstanbul ΣΑΣ ς", "日本語 a日b", "don't I'LL we've", "<|endoftext|> a<|startoftext|>b", "a b c　d", "x\x1cy \x85z", "\x00\x01 a\x01b \x7f", "² ³a1½ 12 ªº µ ŉ ĸ ſ", "!'s a's ''s 'S 'LL", "×÷ a×b",
    "word.) word., (x) a.b.c 12,5 3.14", "ﬁne Ǆ ŉ ß ẞ", "😀 a😀b", "|||| ... a|", "a" * 3000, "́́ ́", "ab " * 4000, "naïve.", "ªº.", "K Å",
]


def fuzz(n):
    rng = random.Random(11)
    pieces = [" ", "\n", "a", "Word", "é", "é", "'", "'s", ".", ",", "|", "9", "日", " ", "​", "İ", "ſ", "ß", "<|endoftext|>", "\x1c", "Σ", "-", "²", "×", "\x01", "ÿ", "Ā", "\xad", "\xa0"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    own = rans.WordBpe(bpe.read_spec(PATH))
    for text in [*ODD, *fuzz(3000), *pd.read_parquet(f"{SF}/documents.parquet").text.head(60)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode([text])[0].tolist() == ids, text[:80]


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 300_000, 600_001])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.02, n), 3000).astype(np.uint32)
    model = rans.Model.of(dict(zip(*(x.tolist() for x in np.unique(ids, return_counts=True)))) if n else {5: 1})
    assert int(model.freq.sum()) == 1 << rans.SCALE
    checkpoints, words = rans.encode_block(model, ids)
    assert (rans.decode_block(model, n, checkpoints, words) == ids).all()
    for start in range(0, n, rans.CHECKPOINT):
        assert (rans.decode_block(model, n, checkpoints, words, start) == ids[start:]).all()
    if n > 200_000:  # near the entropy
        p = np.unique(ids, return_counts=True)[1] / n
        marks = len(checkpoints) * 8
        assert len(words) * 4 < 1.02 * n * -(p * np.log2(p)).sum() / 8 + marks


def test_one_and_very_many_different_ids():
    for ids in (np.zeros(1000, np.uint32), np.arange(60_000, dtype=np.uint32)):
        model = rans.Model.of(dict.fromkeys(ids.tolist(), 1) if len(set(ids.tolist())) > 1 else {0: 1000})
        assert (rans.decode_block(model, len(ids), *rans.encode_block(model, ids)) == ids).all()


def test_query_on_a_table(spark, library):
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    got = {r.doc_id: r for r in queries.op5_rans(spark, SF).collect()}
    start = 0
    for d in docs.itertuples():
        ids = np.array([*library.encode(d.text or "", add_special_tokens=False).ids, 2], "<u4")
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_files_in_order_with_odd_rows(spark, tmp_path, library, monkeypatch):
    texts = [None, *ODD, "twin", "twin"]
    rows = [(i * 3 - 20, t, 7) for i, t in enumerate(texts)] + [(None, "no id", 8), (1000, "same id b", 1), (1000, "same id a", 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(3)
    path = str(tmp_path / "files")
    rans.write_tokens(df, path, bpe.read_spec(PATH), 2)
    out = sorted(rans.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert len(out) == len(rows)
    order = [(-(10**9) if r.doc_id is None else r.doc_id) for r in out]
    assert order == sorted(order)
    at = 0
    want = {}
    for i, t, _ in rows:
        want.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    for r in out:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and ids in want[r.doc_id]
        at += len(ids)
    rans.write_tokens(df.limit(0), str(tmp_path / "empty"), bpe.read_spec(PATH), 2)
    assert rans.read_tokens(spark, str(tmp_path / "empty")).collect() == []


def test_a_damaged_stream_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "some words to damage")], "doc_id long, text string")
    path = str(tmp_path / "files")
    rans.write_tokens(df, path, bpe.read_spec(PATH), 2)
    bad = spark.read.parquet(f"{path}/blocks").withColumn("ids_crc32", F.col("ids_crc32") + 1)
    bad.write.parquet(f"{path}2/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}2/table")
    with pytest.raises(Exception, match="checksum"):
        rans.read_tokens(spark, f"{path}2").collect()


def test_long_documents_are_cut_and_ranges_read(spark, tmp_path, monkeypatch):
    """Documents of several blocks, of exactly one, and short ones; then any range of the whole stream."""
    monkeypatch.setattr(rans, "BLOCK", 500)
    texts = ["short one", "ab " * 1600, "x", "cd " * 499, "ef " * 500, None, "gh ij " * 900]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, "ab " * 1600), (1, "kl " * 700)]
    path = str(tmp_path / "files")
    rans.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), path, bpe.read_spec(PATH), 2)
    blocks = spark.read.parquet(f"{path}/blocks").toPandas()
    assert blocks.n_tokens.max() < 1000 and (blocks.pieces > 1).sum() >= 4 + 4 + 4 + 2 and (blocks.piece < blocks.pieces).all()
    out = sorted(rans.read_tokens(spark, path).collect(), key=lambda r: r.start)
    own = rans.WordBpe(bpe.read_spec(PATH))
    want = sorted((i, [*own.encode([t or ""])[0].tolist(), 2]) for i, t in rows)
    got = [(r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in out]
    assert sorted(got) == want and [i for i, _ in got] == sorted(i for i, _ in rows)
    stream = [t for _, ids in got for t in ids]
    assert [r.start for r in out] == np.cumsum([0, *(len(ids) for _, ids in got)])[:-1].tolist()
    for first, last in ((0, len(stream)), (3, 4), (499, 2600), (len(stream) - 1, len(stream) + 9), (-5, 2), (9, 9), (len(stream), len(stream) + 1)):
        found = sorted(rans.read_range(spark, path, first, last).collect(), key=lambda r: r.start)
        assert [t for r in found for t in np.frombuffer(bytes(r.ids), "<u4").tolist()] == stream[max(first, 0) : last]
        assert all(r.n_tokens * 4 == len(r.ids) for r in found) and (not found or found[0].start == max(first, 0))


def test_a_range_starts_at_a_checkpoint(spark, tmp_path):
    """With one block of several checkpoints the ids before the last one before the range are not decoded."""
    path = str(tmp_path / "files")
    rans.write_tokens(spark.createDataFrame([(i, "a b c " * 60_000) for i in range(4)], "doc_id long, text string").coalesce(1), path, bpe.read_spec(PATH), 2)
    out = {r.start: np.frombuffer(bytes(r.ids), "<u4") for r in rans.read_tokens(spark, path).collect()}
    stream = np.concatenate([out[s] for s in sorted(out)])
    assert len(stream) > 2 * rans.CHECKPOINT
    first = rans.CHECKPOINT + 77
    found = sorted(rans.read_range(spark, path, first, first + 200_000).collect(), key=lambda r: r.start)
    assert (np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in found]) == stream[first : first + 200_000]).all()
    # One block holds the range; without its first states the range is read all the same.
    assert len(found) == 1
    states = 8 * (rans.LANES + 1)
    bad = spark.read.parquet(f"{path}/blocks").withColumn("checkpoints", F.concat(F.lit(bytes(states)), F.substring("checkpoints", states + 1, 1 << 30)))
    bad.write.parquet(f"{path}2/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}2/table")
    again = rans.read_range(spark, f"{path}2", first, first + 200_000).collect()
    assert bytes(again[0].ids) == bytes(found[0].ids)


def test_a_hot_id_is_spread(spark, tmp_path, monkeypatch):
    """Equal rows of one id lie in several parts, and positions still follow one another."""
    monkeypatch.setattr(rans, "BLOCK", 500)
    df = spark.createDataFrame([(7, "same words again")] * 3000 + [(i, f"text {i}") for i in range(20)], "doc_id long, text string").repartition(4)
    path = str(tmp_path / "files")
    # A table this small would be put into one part.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rans.write_tokens(df, path, bpe.read_spec(PATH), 2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.read.parquet(f"{path}/blocks").where("array_contains(doc_ids, 7L)").select("part").distinct().count()
    assert parts > 2
    out = sorted(rans.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert len(out) == 3020 and [r.doc_id for r in out] == sorted(r.doc_id for r in out)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(out, out[1:]))
