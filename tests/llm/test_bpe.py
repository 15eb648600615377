"""Forced-boundary encoding against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "/root/testdata/sf0.001/documents.parquet"
ODD = [
    "", " ", "  ", "\n\n  x", "a  b", "a   ", "don't", "DON'T we'll I'd", "!'s x's 'S", "x'", "''s", "a  b", "a   b", "  x",
    "a  b　c", "été déjà", "é x", "日本語 テスト", "😀😀 a😀", "<|endoftext|>", "a <|endoftext|>  b", "a  <|endoftext|>", "<|endoftext", "\x00\x01 \x01  \x01",
    "\x1c x\x1c y \x1d  z", "a1b2 33.5,6", "tab\t\tx \t y", "\r\n\r\nx", "word,word;(x) [y] {z}", "a" * 5000, "ab " * 3000, "\u0085 x  \u0085y", "naïve–dash — x", "ß ẞ ŉ's",
]


def fuzz(n, seed=1):
    rng = random.Random(seed)
    pieces = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "a", "word", " the", "9", "12", ".", "!", "é", " ", "　", "日", "😀", "\x1c", "\x85", "́", "<|endoftext|>", "ſ", "_", "٣"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_whole_texts_equal_the_library(library):
    own = bpe.ByteBpe(bpe.read_spec(PATH))
    for text in [*ODD, *fuzz(3000), *pd.read_parquet(DOCS).text.head(60)]:
        ids = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text.encode())
        assert np.frombuffer(got, "<u4").tolist() == ids, text[:80]
        assert own.decode(got) == library.decode(ids, skip_special_tokens=False) == text


def test_cuts_leave_no_token_apart():
    own = bpe.ByteBpe(bpe.read_spec(PATH))
    for token in list(own.token_bytes.values())[::37]:
        assert len(own.fragments(token)) <= 1
    assert own.fragments(b"the cat") == [b"the", b" cat"]


def test_full_memory_of_fragments_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "KEPT_FRAGMENTS", 3)
    own = bpe.ByteBpe(bpe.read_spec(PATH))
    text = "one two three four one two five six one"
    assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_round_trip_frame(spark, library):
    texts = [None, *ODD, "same", "same"]
    rows = [(i, t, f"n{i}", b"x") for i, t in enumerate(texts)] + [(None, "no id", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string, ids binary")
    out = {r.doc_id: r for r in bpe.round_trip(df, bpe.read_spec(PATH)).collect()}
    assert len(out) == len(rows)
    for i, t, note, _ in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4")
        assert (out[i].n_tokens, out[i].note) == (len(ids), note)
        assert out[i].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.round_trip(df.limit(0), bpe.read_spec(PATH)).collect() == []


def test_ids_outside_the_vocabulary_and_null_ids(spark):
    df = spark.createDataFrame([(bytes(np.array([50256, 99999999], "<u4")),), (None,)], "ids binary")
    assert [r.t for r in bpe.decode(df, "ids", "t", bpe.read_spec(PATH)).collect()] == ["<|endoftext|>", ""]
