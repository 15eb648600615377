r"""Alignment of the tokens of two tokenizers, with a fast path for identical tokens.

A is a byte-level BPE vocabulary, B a sentencepiece model that puts a space in front. The text's bytes behind one
space are cut where a token of A and one of B both end; what lies between two cuts is a group. Two tokens are
linked where their bytes overlap.

An array made once gives for each A id the B id with the same bytes. A group of that one pair (most groups of
ordinary text) is settled by this identity map: how many documents hold the pair is counted in one vector
of the vocabulary's length per task. Only the links of other groups are pairs that are shuffled, summed up
by task. An identical pair linked in an irregular group (at another place of both) counts in the vector, too.

Texts are tokenized in fragments, cut between bytes that stand side by side in no token of A or of B: the fragments
repeat, and a worker keeps their ids. The alignment itself is array arithmetic over many texts.

Texts that are null or empty, and those whose tokens don't give back their bytes (B can't tell the sign U+2581
from a space), have no tokens: all numbers are 0 and the groups empty. Rows are documents whatever their ids: null and
repeated ids and copies are rows of their own. An empty table gives no rows. Other columns are kept; result columns
get underscores in front where their names are taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.bpe import ByteBpe
from gaugeline.llm.common import fresh_name, ship, stored, whole_text

# Fragments whose ids a worker keeps, and as many older ones; only speed depends on it.
KEPT_FRAGMENTS = 200_000
# Bytes of texts that are aligned at a time.
BLOCK = 1 << 20
# Irregular pairs up to this number (16 bytes each) are broadcast with their counts; more are joined by shuffle.
BROADCAST_PAIRS = 1 << 21
# Pairs that a task holds before it sums them up.
_HELD_PAIRS = 1 << 20
SPACE = "▁"


class Aligned(NamedTuple):
    """The alignment of one text."""

    n_a: int = 0
    n_b: int = 0
    groups: str = ""
    n_groups: int = 0
    same: np.ndarray = np.zeros(0, np.int64)  # A ids of identical pairs, one for each link
    other: np.ndarray = np.zeros(0, np.int64)  # a * size of B + b of the other links


class Aligner:
    """Both tokenizers, ready to align; lives in the Python workers."""

    def __init__(self, spec_a: str, model_b: bytes):
        import sentencepiece

        self.a = ByteBpe(spec_a)
        self.a.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.n_a, self.n_b = max(self.a.token_bytes) + 1, self.b.get_piece_size()
        self.bytes_a = [self.a.token_bytes.get(i, b"") for i in range(self.n_a)]
        self.bytes_b = [self._bytes_of(i) for i in range(self.n_b)]
        self.length_a, self.length_b = (np.array([len(t) for t in side]) for side in (self.bytes_a, self.bytes_b))
        self.same = np.array(identity_map(self.bytes_a, self.bytes_b))
        # Texts of ids with what follows them in a group: A within, A last, B within, B last.
        shown = [[f"{i}{sign}" for i in range(n)] for n, sign in ((self.n_a, ","), (self.n_a, "|"), (self.n_b, ","), (self.n_b, ";"))]
        self.shown = np.array(sum(shown, []), object)
        self.blank = self.b.piece_to_id(SPACE)
        self.line = self.b.encode("\n")  # the space in front and the line break, which no longer piece holds
        inside = np.zeros((256, 256), bool)
        for token in self.bytes_b:
            raw = np.frombuffer(token, np.uint8)
            inside[raw[:-1], raw[1:]] = True
        if inside[0x0A].any() or inside[:, 0x0A].any() or len(self.line) != 2:
            raise ValueError("pieces with line breaks can't be encoded in fragments")
        self.cuts = self.a.cuts & ~inside.ravel()
        self.known: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.older: dict[bytes, tuple[bytes, bytes] | None] = {}

    def _bytes_of(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def fragments(self, data: bytes) -> list[bytes]:
        raw = np.frombuffer(data, np.uint8)
        pairs = (raw[:-1].astype(np.uint16) << 8) | raw[1:]
        at = (np.flatnonzero(self.cuts[pairs]) + 1).tolist()
        return [data[i:j] for i, j in zip([0, *at], [*at, len(data)])]

    def learn(self, fragments: list[bytes]) -> None:
        """Ids of both sides for new fragments; None where tokens don't give back the bytes."""
        if len(self.known) + len(fragments) > KEPT_FRAGMENTS:
            self.older, self.known = self.known, {}
        # B puts a space in front of a text. Where the fragment has none, a line break keeps it apart and is taken off.
        texts = [f[1:].decode() if f[:1] == b" " else "\n" + f.decode() for f in fragments]
        for f, text, ids_b in zip(fragments, texts, self.b.encode(texts, num_threads=1)):
            if f[:1] != b" ":
                ids_b = ids_b[2:] if ids_b[:2] == self.line else []
            elif not text:
                ids_b = [self.blank]
            ids_a = self.a._fragment_ids(f)
            whole = b"".join([self.bytes_a[i] for i in np.frombuffer(ids_a, "<u4").tolist()]) == f == b"".join([self.bytes_b[i] for i in ids_b])
            self.known[f] = (ids_a, np.array(ids_b, "<u4").tobytes()) if whole else None

    def _ids(self, text: bytes) -> list[tuple[bytes, bytes] | None]:
        """Ids of the fragments of a text behind its space."""
        fragments = self.fragments(b" " + text)
        known, older = self.known, self.older
        fresh = {f for f in fragments if f not in known}
        if fresh:
            for f in [f for f in fresh if f in older]:
                known[f] = older[f]
                fresh.discard(f)
            if fresh:
                self.learn(list(fresh))
                if self.known is not known:  # it was full: what this text needs may be in the older half now
                    known, older = self.known, self.older
                    return [known[f] if f in known else older[f] for f in fragments]
        return [known[f] for f in fragments]

    def align(self, texts: list[bytes]) -> list[Aligned]:
        """The alignment of each UTF-8 text."""
        out, held, size = [Aligned()] * len(texts), [], 0
        for nr, text in enumerate(texts):
            ids = self._ids(text) if text else [None]
            if None not in ids:
                held.append((nr, len(text) + 1, b"".join([a for a, _ in ids]), b"".join([b for _, b in ids])))
                size += len(text)
            if held and (size >= BLOCK or nr == len(texts) - 1):
                numbers, sizes, a, b = zip(*held)
                for own, found in zip(numbers, self._block(list(sizes), b"".join(a), b"".join(b))):
                    out[own] = found
                held, size = [], 0
        return out

    def _block(self, sizes: list[int], a: bytes, b: bytes) -> list[Aligned]:
        """Alignments of texts of `sizes` bytes that stand behind each other.

        The ends of all tokens cut the bytes into intervals. Each lies in one token of A and one of B, and each
        overlapping pair has one of them. Both sides end at a text's end, so no group or link leaves its text.
        """
        ids_a, ids_b = np.frombuffer(a, "<u4").astype(np.int64), np.frombuffer(b, "<u4").astype(np.int64)
        mark = np.zeros(sum(sizes) + 1, np.uint8)
        mark[np.cumsum(self.length_a[ids_a])] = 1
        mark[np.cumsum(self.length_b[ids_b])] += 2
        ends = np.flatnonzero(mark)
        signs = mark[ends]
        is_a, is_b, both = (signs & 1).astype(bool), signs >= 2, signs == 3
        upto_a, upto_b, upto = np.cumsum(is_a), np.cumsum(is_b), np.cumsum(both)
        link_a, link_b, group = ids_a[upto_a - is_a], ids_b[upto_b - is_b], upto - both
        same = self.same[link_a] == link_b
        other = link_a * self.n_b + link_b
        # A's tokens of a group come before B's: a token's place is its number and how many of the other side precede it.
        total_a, total_b = upto_a[both], np.concatenate([[0], upto_b[both]])
        shown = np.empty(len(ids_a) + len(ids_b), np.int64)
        shown[np.arange(len(ids_a)) + total_b[group[is_a]]] = ids_a + both[is_a] * self.n_a
        shown[np.arange(len(ids_b)) + total_a[group[is_b]]] = ids_b + both[is_b] * self.n_b + 2 * self.n_a
        words = self.shown[shown].tolist()
        out, i, n_a, n_b, n = [], 0, 0, 0, 0
        for j in (np.searchsorted(ends, np.cumsum(sizes)) + 1).tolist():
            to_a, to_b, to = int(upto_a[j - 1]), int(upto_b[j - 1]), int(upto[j - 1])
            mine = same[i:j]
            text = "".join(words[n_a + n_b : to_a + to_b])[:-1]
            out.append(Aligned(to_a - n_a, to_b - n_b, text, to - n, link_a[i:j][mine], other[i:j][~mine]))
            i, n_a, n_b, n = j, to_a, to_b, to
        return out


def identity_map(bytes_a: list[bytes], bytes_b: list[bytes]) -> list[int]:
    """For each A id the first B id, of ordinary pieces before single bytes, with the same bytes; -1 if there is none."""
    ids: dict[bytes, int] = {}
    # Single bytes stand first in such models; an ordinary piece of the same bytes comes later and takes their place.
    for i, token in enumerate(bytes_b):
        if token and (token not in ids or len(token) == 1):
            ids[token] = i
    return [ids.get(token, -1) for token in bytes_a]


_loaded: dict[tuple[int, int], Aligner] = {}


def _aligner(spec_a: str, model_b: bytes) -> Aligner:
    key = (hash(spec_a), hash(model_b))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Aligner(spec_a, model_b)
    return _loaded[key]


def read_model(path: str) -> bytes:
    """A model file; it is read by the driver and sent to the executors (under 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def packed(values: np.ndarray, kind: str) -> tuple[bytes, bytes]:
    """Distinct values and how often each occurs (uint32)."""
    found, times = np.unique(values, return_counts=True)
    return found.astype(kind).tobytes(), times.astype("<u4").tobytes()


_ALIGNED = "struct<n_a:long,n_b:long,n_groups:long,groups:string,groups_sha256:string,same:binary,same_times:binary,other:binary,other_times:binary>"


def align(docs: DataFrame, spec_a: str, model_b: bytes, text: str = "text", groups: bool = True) -> DataFrame:
    """`docs` with _aligned: numbers of tokens and groups, the groups' text and digest, distinct links and their times.

    groups=False leaves the groups' text out (null), as it is longer than the document.
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((spec_a, model_b))

    @F.arrow_udf(_ALIGNED)
    def aligned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _aligner(*held.value)
        for batch in batches:
            columns: list[list] = [[] for _ in range(9)]
            for at in range(0, len(batch), 256):
                for f in own.align([x.as_buffer().to_pybytes() for x in batch[at : at + 256]]):
                    row = (
                        f.n_a,
                        f.n_b,
                        f.n_groups,
                        f.groups if groups else None,
                        hashlib.sha256(f.groups.encode()).hexdigest() if f.n_a else "",
                        *packed(f.same, "<u4"),
                        *packed(f.other, "<u8"),
                    )
                    for column, value in zip(columns, row):
                        column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.binary()] * 4
            names = [f.split(":")[0] for f in _ALIGNED[7:-1].split(",")]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.withColumn(fresh_name(docs, "_aligned"), aligned(whole_text(text).cast("binary")))


def same_counts(links: DataFrame, size: int) -> np.ndarray:
    """By A id, how many documents hold its identical pair. One vector per task, `size` numbers in all."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = [np.frombuffer(x.as_buffer(), "<u4") for x in batch.column(0)]
            if ids:
                total += np.bincount(np.concatenate(ids), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["a", "docs"])

    out = np.zeros(size, np.int64)
    for r in links.select("same").mapInArrow(counted, "a long, docs long").groupBy("a").agg(F.sum("docs").alias("docs")).collect():
        out[r.a] = r.docs
    return out


def other_counts(links: DataFrame) -> DataFrame:
    """code, docs: how many documents hold each other pair; a task sums its pairs up before they are shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, docs = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def summed() -> tuple[np.ndarray, np.ndarray]:
            found, place = np.unique(np.concatenate([codes, *held]), return_inverse=True)
            return found, np.bincount(place, weights=np.concatenate([docs, np.ones(sum(map(len, held)), np.int64)]), minlength=len(found)).astype(np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(docs, pa.int64())], names=["code", "docs"])

        size = 0
        for batch in batches:
            for x in batch.column(0):
                held.append(np.frombuffer(x.as_buffer(), "<i8"))
                size += len(held[-1])
                if size >= _HELD_PAIRS:
                    codes, docs = summed()
                    held, size = [], 0
                    if len(codes) >= _HELD_PAIRS:
                        yield rows()
                        codes, docs = codes[:0], docs[:0]
        codes, docs = summed()
        yield rows()

    return links.select("other").mapInArrow(counted, "code long, docs long").groupBy("code").agg(F.sum("docs").alias("docs"))


def with_counts(docs: DataFrame, spec_a: str, model_b: bytes, text: str = "text", groups: bool = True, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """`docs` with n_a, n_b, n_groups, n_links, n_best, count_sum, groups, groups_sha256.

    count_sum adds up, over a document's links, how many documents hold the linked pair; n_best counts the links whose
    pair is the most common one of its A id, ties included.
    """
    spark = docs.sparkSession
    own, row = fresh_name(docs, "_aligned"), fresh_name(docs, "_row")
    # Written once: both tokenizers run over each text a single time.
    rows = stored(align(docs, spec_a, model_b, text, groups).withColumn(row, F.monotonically_increasing_id()), "aligned")
    links = rows.select(F.col(row).alias("row"), f"{own}.same", f"{own}.same_times", f"{own}.other", f"{own}.other_times")
    aligner = _aligner(spec_a, model_b)
    size_a, size_b = aligner.n_a, aligner.n_b
    regular = same_counts(links, size_a)
    pairs = stored(other_counts(links), "pairs")
    best = regular.copy()
    for r in pairs.groupBy(F.expr(f"code div {size_b}").alias("a")).agg(F.max("docs").alias("docs")).collect():
        best[r.a] = max(best[r.a], r.docs)
    few = pairs.count() <= broadcast_pairs
    table = np.zeros((2, 0), np.int64)
    if few:
        got = pairs.toArrow()
        table = np.stack([got.column(c).to_numpy() for c in ("code", "docs")]) if got.num_rows else table
        table = np.ascontiguousarray(table[:, np.argsort(table[0])])
    held = spark.sparkContext.broadcast((regular, best, table))
    sums = "struct<n_links:long,n_best:long,count_sum:long>"

    @F.arrow_udf(sums)
    def summed(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        regular, best, (codes, docs) = held.value
        for batch in batches:
            out = np.zeros((3, len(batch[0])), np.int64)
            sides = (0, 1, "<u4"), (2, 3, "<i8")
            for ids_at, times_at, kind in sides if few else sides[:1]:
                ids, times = ([np.frombuffer(x.as_buffer(), k) for x in batch[c]] for c, k in ((ids_at, kind), (times_at, "<u4")))
                if not ids:
                    continue
                doc = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
                ids, times = np.concatenate(ids).astype(np.int64), np.concatenate(times).astype(np.int64)
                a, n = (ids, regular[ids]) if ids_at == 0 else (ids // size_b, docs[np.searchsorted(codes, ids)])
                for k, part in enumerate((times, times * (n == best[a]), times * n)):
                    np.add.at(out[k], doc, part)
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in out], names=["n_links", "n_best", "count_sum"])

    total = fresh_name(docs, "_total")
    out = rows.withColumn(total, summed(*(F.col(own)[c] for c in ("same", "same_times", "other", "other_times"))))
    further = {c: F.lit(0).cast("bigint") for c in ("n_links", "n_best", "count_sum")}
    if not few:
        irregular = _joined(links, pairs, held, size_b)
        out = out.join(irregular.select(F.col("row").alias(row), F.struct("n_links", "n_best", "count_sum").alias(fresh_name(docs, "_further"))), row, "left")
        further = {c: F.coalesce(F.col(fresh_name(docs, "_further"))[c], n) for c, n in further.items()}
    sources = {c: F.col(own)[c] for c in ("n_a", "n_b", "n_groups", "groups", "groups_sha256")} | {c: F.col(total)[c] + n for c, n in further.items()}
    order = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", *(["groups"] if groups else []), "groups_sha256")
    return out.select(*docs.columns, *[sources[c].alias(fresh_name(docs, c)) for c in order])


def _joined(links: DataFrame, pairs: DataFrame, held, size_b: int) -> DataFrame:
    """row, n_links, n_best, count_sum over the other links, their counts joined by shuffle."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, times = (b"".join([x.as_buffer().to_pybytes() for x in batch.column(c)]) for c in (1, 2))
            row = np.repeat(batch.column(0).to_numpy(), [x.as_buffer().size // 8 for x in batch.column(1)])
            columns = (row, np.frombuffer(codes, "<i8"), np.frombuffer(times, "<u4").astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "code", "times"])

    @F.arrow_udf("boolean")
    def is_best(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        best = held.value[1]
        for codes, docs in batches:
            yield pa.array(best[codes.to_numpy() // size_b] == docs.to_numpy())

    marked = pairs.withColumn("is_best", is_best("code", "docs"))
    rows = links.select("row", "other", "other_times").mapInArrow(spread, "row long, code long, times long").join(marked, "code")
    return rows.groupBy("row").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
    )
