"""Byte-pair encoding and decoding with forced-boundary splitting.

Two adjacent bytes that occur side by side inside no token of the vocabulary can never end up in one
token, so the text may be cut between them and the fragments encoded one by one. In natural text this
cuts at nearly every word, the fragments repeat, and a worker keeps the ids of those it has met.

`encode` equals the tokenizers library on the whole text; `decode` is its decode. Null and empty texts
give no ids. Nothing is shuffled: both are column expressions, whatever other columns the frame has.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import ship, whole_text

# Fragments whose ids a worker keeps; when full it starts over. Only speed depends on it.
KEPT_FRAGMENTS = 200_000

# The contractions of the pre-tokenizer, which one token may span.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
BLANK_BYTES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
# Separators that only some notions of white space include; never cut after them.
DOUBTFUL_BYTES = (0x1C, 0x1D, 0x1E, 0x1F)


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class ByteBpe:
    """A byte-level BPE vocabulary, ready to encode and decode; lives in the Python workers."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        rules = json.loads(spec)
        if rules["normalizer"] is not None or rules["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("forced boundaries are worked out for byte-level BPE without a normalizer")
        if rules["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a vocabulary that adds a space in front can't be encoded in fragments")
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.alphabet = byte_alphabet()
        to_byte = {c: b for b, c in enumerate(self.alphabet)}
        self.token_bytes: dict[int, bytes] = {}
        for token, i in rules["model"]["vocab"].items():
            known = all(c in to_byte for c in token)
            self.token_bytes[i] = bytes(to_byte[c] for c in token) if known else token.encode()
        for token in rules["added_tokens"]:
            self.token_bytes[token["id"]] = token["content"].encode()
        self.cuts = cut_table([*self.token_bytes.values(), *(c.encode() for c in CONTRACTIONS)])
        self.known: dict[bytes, bytes] = {}

    def fragments(self, data: bytes) -> list[bytes]:
        if not data:
            return []
        raw = np.frombuffer(data, np.uint8)
        pairs = (raw[:-1].astype(np.uint16) << 8) | raw[1:]
        at = (np.flatnonzero(self.cuts[pairs]) + 1).tolist()
        return [data[i:j] for i, j in zip([0, *at], [*at, len(data)])]

    def _fragment_ids(self, fragment: bytes) -> bytes:
        word = fragment[1:] if fragment[:1] == b" " else fragment
        if word.isalpha():  # bytes.isalpha: ASCII letters only, hence one piece for the merges
            ids = [t.id for t in self.tokenizer.model.tokenize("".join(self.alphabet[b] for b in fragment))]
        else:
            ids = self.tokenizer.encode(fragment.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, data: bytes) -> bytes:
        """Ids of a UTF-8 text, little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        for fragment in self.fragments(data):
            ids = known.get(fragment)
            if ids is None:
                if len(known) >= KEPT_FRAGMENTS:
                    known.clear()
                ids = self._fragment_ids(fragment)
                if len(fragment) <= 64:
                    known[fragment] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text; ids outside the vocabulary stand for nothing."""
        get = self.token_bytes.get
        return b"".join([get(i, b"") for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def cut_table(tokens: list[bytes]) -> np.ndarray:
    """For each pair of bytes (first * 256 + second), whether a cut between them is certain.

    Beside the vocabulary, the pre-tokenizer must see the same pieces on both sides of a cut. It looks
    back at nothing and ahead only past white space, so a cut in front of white space is safe, and
    one after anything else too, but for an apostrophe (a contraction would begin there) and the
    inner bytes of a character. After a byte of a longer character, which may be white space, only
    the former kind is used.
    """
    inside = np.zeros((256, 256), bool)
    for token in tokens:
        raw = np.frombuffer(token, np.uint8)
        inside[raw[:-1], raw[1:]] = True
    first, second = np.arange(256)[:, None], np.arange(256)[None, :]
    blank_next = np.isin(second, BLANK_BYTES)
    plain_before = (first < 0x80) & ~np.isin(first, BLANK_BYTES + DOUBTFUL_BYTES)
    starts = ((second < 0x80) | (second >= 0xC2)) & (second != ord("'"))
    return (~inside & (blank_next | (plain_before & starts))).ravel()


_loaded: dict[int, tuple[str, ByteBpe]] = {}


def loaded(spec: str) -> ByteBpe:
    """One instance per worker and vocabulary, so that known fragments last across tasks."""
    held = _loaded.get(hash(spec))
    if held is None or held[0] != spec:
        _loaded.clear()
        held = _loaded[hash(spec)] = (spec, ByteBpe(spec))
    return held[1]


def read_spec(path: str) -> str:
    """A tokenizer file; it is read by the driver and sent to the executors (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(df: DataFrame, text: str, out: str, spec: str) -> DataFrame:
    """`df` with column `out`: the ids of column `text` as little-endian unsigned 32-bit integers."""
    ship(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(spec)

    @F.arrow_udf("binary")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = loaded(held.value)
        for batch in batches:
            yield pa.array([bpe.encode(x.as_buffer().to_pybytes()) for x in batch], pa.binary())

    return df.withColumn(out, ids_of(whole_text(text).cast("binary")))


def decode(df: DataFrame, ids: str, out: str, spec: str) -> DataFrame:
    """`df` with column `out`: the text of the ids in column `ids`; null ids give an empty text."""
    ship(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(spec)

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = loaded(held.value)
        for batch in batches:
            yield pa.array([bpe.decode(x.as_buffer().to_pybytes()) for x in batch], pa.string())

    return df.withColumn(out, text_of(F.coalesce(F.col(ids), F.lit(b""))))


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("bigint")


def round_trip(df: DataFrame, spec: str, text: str = "text") -> DataFrame:
    """`df` with ids, n_tokens, ids_sha256 and decoded_sha256 instead of the text."""
    rest = [c for c in df.columns if c not in (text, "ids", "n_tokens", "ids_sha256", "decoded_sha256")]
    coded = decode(encode(df.select(*rest, text), text, "ids", spec).drop(text), "ids", "decoded", spec)
    return coded.select(
        *rest,
        "ids",
        n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
