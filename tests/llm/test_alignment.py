"""Token alignment against the two libraries and a literal reading of the contract."""

import hashlib
import random
from collections import Counter

import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gaugeline.llm import alignment, bpe, queries

SF = "/root/testdata/sf0.01"
SPEC, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Plain:
    """Whole texts through the libraries, all links compared with all."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(SPEC), sentencepiece.SentencePieceProcessor(model_file=MODEL)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.to_byte = {c: b for b, c in enumerate(bpe.byte_alphabet())}

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False)
        side_a = [(i, bytes(self.to_byte[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
        side_b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            side_b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (side_a, side_b) if text and all(b"".join(t for _, t in s) == whole for s in (side_a, side_b)) else ([], [])

    def document(self, text):
        """n_a, n_b, groups, links."""
        spans = []
        for side in self.tokens(text or ""):
            at, own = 0, []
            for i, token in side:
                own.append((at, at + len(token), i))
                at += len(token)
            spans.append(own)
        a, b = spans
        groups, first = [], 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            groups.append("|".join(",".join(str(i) for s, e, i in own if first <= s and e <= end) for own in spans))
            first = end
        links, j = [], 0
        for s, e, i in a:
            while j < len(b) and b[j][1] <= s:
                j += 1
            links += [(i, k) for s2, e2, k in b[j : j + e - s + 1] if s2 < e and s < e2]
        return len(a), len(b), groups, links

    def rows(self, texts):
        found = [self.document(t) for t in texts]
        held = Counter(pair for *_, links in found for pair in set(links))
        best = {}
        for (a, _), n in held.items():
            best[a] = max(best.get(a, 0), n)
        return [
            (n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
            for n_a, n_b, groups, links in found
        ]


@pytest.fixture(scope="module")
def plain():
    return Plain()


ODD = [
    None, "", " ", "  ", "a ", " a", "  a  b ", "\n", "\t\r\n x", "▁", "a▁b c", "<|endoftext|> <s></s> <unk>", "<0x41>", "\x00", "é é ﬁ", "日本語 テキスト", "👩‍👩‍👧 ok",
    "don't we'll 'S", "  x 　  y", "x　  y", "123 4567", "a" * 5000, "word " * 3000, " a \u0085 b", "ＡＢ ①", "http://x.y/z?a=b#c  {}", "﻿a", "a ​ b",
]


def fuzz(n):
    rng = random.Random(11)
    pieces = [" ", "  ", "\n", "the", "The", "ing", "é", "ß", "日", "　", "'s", "1", "99", "-", "...", "x", "▁" if rng.random() < 0.01 else "_", "\t", "über", "<s>"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(n)]


@pytest.mark.parametrize("broadcast", (1 << 21, 0))
def test_odd_texts(spark, plain, broadcast):
    texts = ODD + fuzz(600)
    docs = spark.createDataFrame([(None if i % 4 == 0 else i % 9, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_a int")
    got = alignment.with_counts(docs, bpe.read_spec(SPEC), alignment.read_model(MODEL), broadcast_pairs=broadcast)
    assert got.columns == ["doc_id", "text", "n_a", "_n_a", *NAMES[1:6], "groups", "groups_sha256"]
    found = sorted(got.collect(), key=lambda r: r.n_a)
    want = plain.rows(texts)
    for text, r, w in zip(texts, found, want):
        assert (r._n_a, *(r[c] for c in NAMES[1:])) == w, text
        assert r.text == text and hashlib.sha256(r.groups.encode()).hexdigest() == (w[-1] or hashlib.sha256(b"").hexdigest())


def test_query_on_a_table(spark, plain):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = queries.QUERIES["op12_alignment"](spark, SF)
    assert got.columns == ["doc_id", *NAMES]
    assert sorted(map(tuple, got.collect())) == sorted((i, *r) for i, r in zip(docs.doc_id, plain.rows(docs.text)))


def test_identity_map():
    assert alignment.identity_map([b"a", b"ab", b"x", b""], [b"<s>", b"x", b"a", b"ab", b"a", b"ab"]) == [4, 3, 1, -1]


def test_most_links_take_the_fast_path(spark):
    docs = spark.createDataFrame([("the house and the garden of the king",)], "text string")
    r = alignment.align(docs, bpe.read_spec(SPEC), alignment.read_model(MODEL)).select("_aligned.*").first()
    assert len(r.other) == 0 and len(r.same) // 4 == len(set("the house and the garden of the king".split()))


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.with_counts(docs, bpe.read_spec(SPEC), alignment.read_model(MODEL)).collect() == []
