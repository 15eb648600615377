"""Token ids in a compact binary form: static range asymmetric numeral system (rANS).

One frequency table, counted over the whole corpus, serves all blocks. A block holds whole documents
in ascending doc_id order, is coded by `LANES` interleaved coders into one stream of 32-bit words, and
can be read alone. A document of more than `BLOCK` ids is cut over blocks of its own, so that no block holds
2 * BLOCK ids or more and several tasks decode such a document. Checkpoints (stream position and coder states)
allow to start inside a block, which `read_range` does; checksums cover the stream and the ids.

File format: a folder with Parquet tables `table` (token, freq) and `blocks`, one row a block:
part, block (their order is the order of the ids), n_tokens, piece and pieces (0 and 1, or which of a cut
document's blocks it is), doc_ids, doc_lens, checkpoints (uint64,
little-endian: word position and `LANES` states for every `CHECKPOINT` ids), words (uint32,
little-endian), words_crc32, ids_crc32.

Null and empty texts consist of the end id alone. Documents with a null id come first; rows that
share an id are in the order of a hash of their token stream, and may lie in several parts, so that a hot id is no
task of its own. An empty table gives a folder without blocks. More than 2^SCALE different ids are an error.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.llm.bpe import byte_alphabet
from gaugeline.llm.common import ship, stored, whole_text

# Coder: frequencies sum to 2^SCALE; states stay in 2^31 ... 2^63 and give off 32-bit words.
SCALE = 20
LOW = 1 << 31
LANES = 1024
BLOCK = 1 << 20  # ids after which a block closes at the next document, and the most a cut document's block holds
CHECKPOINT = 1 << 18  # a multiple of LANES

# Pieces whose ids a worker keeps, and as many older ones. Only speed depends on it.
KEPT_PIECES = 350_000

# Blocks up to this number have their positions broadcast (some 50 bytes each); more are joined by shuffle.
BROADCAST_BLOCKS = 200_000

# The vocabulary's pre-tokenizer for lower-case text up to U+017F; other texts go to the library in chunks.
_LETTERS, _DIGITS, _BLANKS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_PIECE = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_DIGITS}]|[^{_BLANKS}{_LETTERS}{_DIGITS}]+")
_CHUNK = re.compile(r"[^ \t\n\r]+")
# Marks of one sign that often follow a word; none begins a contraction.
_MARKS = frozenset(",.;:!?)")
# Beyond Latin; lower-casing U+0130 gives a mark of its own.
_FAR = re.compile("[^\0-\u017f]|\u0130")
# Fixed value: the pieces of the pre-tokenizer that `_PIECE` restates.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordBpe:
    """Ids of a text by a vocabulary whose pre-tokenizer drops white space; lives in the Python workers.

    The merges work inside pieces, and pieces met before are looked up. Latin text is lower-cased and cut here, many
    texts at a time, so that each distinct word of them (what stands between ASCII white space) is looked up
    once. Any other is cut at white space, which no token reaches across, and each chunk goes through the library.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        rules = json.loads(spec)
        kinds = [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])]
        split = rules["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["pattern"] != {"Regex": PIECES} or not split["invert"]:
            raise ValueError("pieces are worked out for one lower-casing pre-tokenizer")
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.alphabet = byte_alphabet()
        self.added = re.compile("|".join(re.escape(t["content"]) for t in rules["added_tokens"]) or "(?!)")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _keep(self, key: str, ids: list[int]) -> bytes:
        packed = array("I", ids).tobytes()
        if len(key) <= 64:
            if len(self.known) >= KEPT_PIECES:
                self.older, self.known = self.known, {}
            self.known[key] = packed
        return packed

    def _piece(self, piece: str) -> bytes:
        if old := self.older.get(piece):
            self.known[piece] = old
            return old
        seen = piece if piece.isascii() else "".join([self.alphabet[b] for b in piece.encode()])
        if not seen.isprintable():  # control characters have other signs in the vocabulary
            seen = "".join([self.alphabet[b] for b in piece.encode()])
        return self._keep(piece, [t.id for t in self.tokenizer.model.tokenize(seen)])

    def _word(self, word: str) -> bytes:
        known, piece = self.known, self._piece
        if word.isalpha():  # one piece, or one and a mark, as most words are
            return known.get(word) or piece(word)
        head, mark = word[:-1], word[-1:]
        parts = (head, mark) if mark in _MARKS and head.isalpha() else _PIECE.findall(word)
        return b"".join([known.get(p) or piece(p) for p in parts])

    def _chunk(self, chunk: str) -> bytes:
        key = f" {chunk}"  # no piece begins with a blank
        return self.known.get(key) or self._keep(key, self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def _latin(self, text: str) -> bool:
        near = text.isascii() or (not _FAR.search(text) and unicodedata.is_normalized("NFC", text))
        return near and not self.added.search(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers."""
        latin = [nr for nr, text in enumerate(texts) if self._latin(text)]
        out = [np.zeros(0, "<u4")] * len(texts)
        for nr, ids in zip(latin, self._by_word([texts[nr].lower() for nr in latin])):
            out[nr] = ids
        for nr in set(range(len(texts))).difference(latin):
            out[nr] = np.frombuffer(b"".join([self._chunk(c) for c in _CHUNK.findall(texts[nr])]), "=u4").astype("<u4")
        return out

    def _by_word(self, texts: list[str]) -> list[np.ndarray]:
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        ends, words = lists.offsets.to_numpy(), lists.values.dictionary_encode()
        ids = [self._word(w) for w in words.dictionary.to_pylist()]
        sizes, flat = np.array([len(i) // 4 for i in ids], np.int64), np.frombuffer(b"".join(ids), "=u4").astype("<u4")
        code = words.indices.to_numpy()
        size = sizes[code]
        upto = np.concatenate([[0], np.cumsum(size)])
        # Where each word's ids stand in `flat`, less where they go to.
        shift = (np.cumsum(sizes) - sizes)[code] - upto[:-1]
        found = flat[np.repeat(shift, size) + np.arange(upto[-1])]
        cuts = upto[ends]
        return [found[i:j] for i, j in zip(cuts[:-1], cuts[1:])]


_loaded: dict[str, WordBpe] = {}


def _word_bpe(spec: str) -> WordBpe:
    if spec not in _loaded:
        _loaded.clear()
        _loaded[spec] = WordBpe(spec)
    return _loaded[spec]


# One of each per worker: making one costs more than the texts are long.
_packer, _unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(ids: np.ndarray) -> bytes:
    """Ids for the way between two stages: byte planes, so that the rarely changing ones shrink."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return _packer.compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpacker.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def tokenized(df: DataFrame, spec: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, packed, nr: the ids of each text with `end_id` behind them, and a number of the row."""
    ship(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(spec)

    @F.arrow_udf("binary")
    def packed_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _word_bpe(held.value)
        tail = np.array([end_id], "<u4")
        for batch in batches:
            yield pa.array([pack(np.concatenate([ids, tail])) for ids in bpe.encode(batch.to_pylist())], pa.binary())

    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), packed_ids(whole_text(text)).alias("packed"), F.monotonically_increasing_id().alias("nr"))


def frequencies(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs in the corpus. One row per task and id is shuffled, one per id collected:
    the vocabulary bounds it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(0, np.int64), [], 0

        def added() -> np.ndarray:
            found = np.bincount(np.concatenate(held).astype(np.int64), minlength=len(total))
            found[: len(total)] += total
            return found

        for batch in batches:
            for packed in batch.column(0):
                held.append(unpack(packed.as_buffer()))
                size += len(held[-1])
                if size >= BLOCK:
                    total, held, size = added(), [], 0
        if held:
            total = added()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["token", "n"])

    rows = tokens.select("packed").mapInArrow(counted, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token: r.n for r in rows.collect()}


class Model:
    """Shared frequency table: freq and cum by token; they sum to 2^SCALE."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self._slots: np.ndarray | None = None

    @classmethod
    def of(cls, counts: dict[int, int]) -> Model:
        """Scaled counts, at least 1 for each id that occurs. What rounding leaves over goes to, or comes
        from, the frequent ids."""
        if not counts:
            return cls(np.zeros(0, np.int64))
        if len(counts) > 1 << SCALE:
            raise ValueError(f"more than {1 << SCALE} different ids")
        n = np.zeros(max(counts) + 1, np.float64)
        n[list(counts)] = list(counts.values())
        freq = np.where(n > 0, np.maximum(1, np.floor(n / n.sum() * (1 << SCALE))), 0).astype(np.int64)
        order = np.argsort(-freq, kind="stable")[: len(counts)]
        left = (1 << SCALE) - int(freq.sum())
        while left:
            change = np.sign(left)
            able = order[freq[order] > 1] if left < 0 else order
            able = able[: abs(left)]
            freq[able] += change
            left -= int(change) * len(able)
        return cls(freq)

    def slots(self) -> np.ndarray:
        """The token of each of the 2^SCALE slots."""
        if self._slots is None:
            kind = np.uint16 if len(self.freq) <= 1 << 16 else np.uint32
            self._slots = np.repeat(np.arange(len(self.freq), dtype=kind), self.freq.astype(np.int64))
        return self._slots


def encode_block(model: Model, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(checkpoints, words) of a block. Lane k codes ids k, k + LANES, ...; the coder goes backwards."""
    state = np.full(LANES, LOW, np.uint64)
    freq, cum = model.freq[ids], model.cum[ids]
    shift, step = np.uint64(63 - SCALE), np.uint64(SCALE)
    out: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    count = 0
    for at in range((len(ids) - 1) // LANES * LANES if len(ids) else -1, -1, -LANES):
        f, c = freq[at : at + LANES], cum[at : at + LANES]
        x = state[: len(f)]
        full = x >= (f << shift)
        if full.any():
            out.append(x[full].astype(np.uint32))
            count += len(out[-1])
            x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[: len(f)] = (q << step) + (x - q * f) + c
        if at % CHECKPOINT == 0:
            marks.append((count, state.copy()))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    rows = [np.concatenate([[np.uint64(count - n)], states]) for n, states in reversed(marks)]
    return (np.concatenate(rows) if rows else np.zeros(0, np.uint64)).astype("<u8"), words.astype("<u4")


def decode_block(model: Model, n: int, checkpoints: np.ndarray, words: np.ndarray, start: int = 0) -> np.ndarray:
    """Ids `start` ... n of a block, whole or its first n; `start` a multiple of CHECKPOINT."""
    ids = np.empty(n - start, np.uint32)
    if n == start:
        return ids
    mark = checkpoints.reshape(-1, LANES + 1)[start // CHECKPOINT]
    at, state = int(mark[0]), mark[1:].astype(np.uint64)
    slots, freq, cum = model.slots(), model.freq, model.cum
    mask, step, half = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    for row in range(0, n - start, LANES):
        x = state[: n - start - row]
        slot = x & mask
        token = slots[slot]
        ids[row : row + LANES] = token
        x = freq[token] * (x >> step) + slot - cum[token]
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = (x[low] << half) | words[at : at + len(low)]
            at += len(low)
        state[: len(x)] = x
    return ids


_BLOCK_SCHEMA = (
    "part int, block int, n_tokens long, piece int, pieces int, doc_ids array<long>, doc_lens array<long>, checkpoints binary, "
    "words binary, words_crc32 long, ids_crc32 long"
)


def write_tokens(df: DataFrame, path: str, spec: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all texts to the folder `path`.

    The ids are kept packed in a table between counting and coding, so that each text is tokenized
    once. They are put in order by a range partitioning, and one task codes one range of doc_id.
    """
    spark = df.sparkSession
    tokens = stored(tokenized(df, spec, end_id, doc_id, text), "tokens")
    counts = frequencies(tokens)
    model = Model.of(counts)
    at = np.flatnonzero(model.freq)
    table = [(int(i), int(model.freq[i])) for i in at]
    spark.createDataFrame(table, "token long, freq long").coalesce(1).write.parquet(f"{path}/table")
    held = spark.sparkContext.broadcast(model.freq)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, names = Model(held.value), TaskContext.get().partitionId(), [x.split()[0] for x in _BLOCK_SCHEMA.split(", ")]
        block, docs, lens, parts, size = 0, [], [], [], 0

        def closed(docs: list, lens: list, parts: list, piece: int = 0, pieces: int = 1) -> pa.RecordBatch:
            ids = np.concatenate(parts)
            checkpoints, words = encode_block(own, ids)
            row = (part, block, len(ids), piece, pieces, docs, lens, checkpoints.tobytes(), words.tobytes(), zlib.crc32(words.tobytes()), zlib.crc32(ids.astype("<u4").tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            for doc, packed in zip(batch.column(0), batch.column(1)):
                ids = unpack(packed.as_buffer())
                long = len(ids) > BLOCK
                if not long:
                    docs.append(doc.as_py())
                    lens.append(len(ids))
                    parts.append(ids)
                    size += len(ids)
                if docs and (long or size >= BLOCK):
                    yield closed(docs, lens, parts)
                    block, docs, lens, parts, size = block + 1, [], [], [], 0
                if long:
                    pieces = -(-len(ids) // BLOCK)
                    for piece in range(pieces):
                        cut = ids[piece * BLOCK : (piece + 1) * BLOCK]
                        yield closed([doc.as_py()], [len(cut)], [cut], piece, pieces)
                        block += 1
        if docs:
            yield closed(docs, lens, parts)

    # Rows of one id, even equal ones, can lie in several ranges.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("packed"), "nr"]
    ordered = tokens.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "packed")
    # Blocks are about as small as they can be: no codec on top.
    ordered.mapInArrow(coded, _BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _read_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, Broadcast]:
    """The table of blocks and the frequencies."""
    ship(spark)
    schema = spark.createDataFrame([], _BLOCK_SCHEMA).schema
    freq = {r.token: r.freq for r in spark.read.schema("token long, freq long").parquet(f"{path}/table").collect()}
    table = np.zeros(max(freq, default=-1) + 1, np.int64)
    table[list(freq)] = list(freq.values())
    return spark.read.schema(schema).parquet(f"{path}/blocks"), spark.sparkContext.broadcast(table)


def _block_starts(blocks: DataFrame) -> DataFrame:
    """part, block, block_start: prefix sums over blocks within a part, and over parts (one row for each written partition)."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "block", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("in_part")).join(parts, "part")
    starts = starts.select("part", "block", (F.col("part_start") + F.col("in_part")).alias("block_start"))
    return F.broadcast(starts) if blocks.select("part").count() <= BROADCAST_BLOCKS else starts


def _checked(part: int, block: int, words: bytes, words_crc: int) -> np.ndarray:
    if zlib.crc32(words) != words_crc:
        raise ValueError(f"block {part}/{block}: the stream fails its checksum")
    return np.frombuffer(words, "<u4")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids: the documents of the folder `path`, decoded in parallel by block.

    start: how many ids stand before the document's. The blocks of a cut document are dealt over tasks and its
    pieces put together again. A stream or ids that fail their checksum end the read with an error.
    """
    blocks, held = _read_blocks(spark, path)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(held.value)
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, n, piece, _, docs, lens, checkpoints, words, words_crc, ids_crc = (c[row].as_py() for c in batch.columns)
                ids = decode_block(model, n, np.frombuffer(checkpoints, "<u8"), _checked(part, block, words, words_crc)).astype("<u4")
                if zlib.crc32(ids.tobytes()) != ids_crc:
                    raise ValueError(f"block {part}/{block}: the ids fail their checksum")
                ends = np.cumsum(lens)
                pieces = [ids[e - k : e].tobytes() for e, k in zip(ends, lens)]
                k = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * k, pa.int32()), pa.array([block] * k, pa.int32()), pa.array([piece] * k, pa.int32()), pa.array(ends - lens, pa.int64()), pa.array(docs, pa.int64()), pa.array(pieces, pa.binary())],
                    names=["part", "block", "piece", "offset", "doc_id", "ids"],
                )

    schema = "part int, block int, piece int, offset long, doc_id long, ids binary"
    whole = blocks.where("pieces = 1").mapInArrow(decoded, schema).drop("piece")
    cut = blocks.where("pieces > 1").repartition("part", "block").mapInArrow(decoded, schema)
    # Grouped by the document's first block. Concatenation of binaries is binary.
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])
    joined = F.aggregate(in_order, F.lit(b""), lambda s, x: F.concat(s, x))
    cut = cut.groupBy("part", (F.col("block") - F.col("piece")).alias("block"), "doc_id").agg(joined.alias("ids"))
    cut = cut.select("part", "block", F.lit(0).cast("bigint").alias("offset"), "doc_id", "ids")
    rows = whole.unionByName(cut).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))
    return rows.join(_block_starts(blocks), ["part", "block"]).select("doc_id", (F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids")


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """start, n_tokens, ids: the ids `first` ... `last` (exclusive) of the stream of all documents, a row for each block they lie in.

    Only these blocks are read, each from the checkpoint before the range on. The stream's checksum is checked; that of the
    ids only where the whole block is read. Positions beyond either end give no rows.
    """
    blocks, held = _read_blocks(spark, path)
    starts = _block_starts(blocks).where((F.col("block_start") < last))
    wanted = blocks.join(starts, ["part", "block"]).where((F.col("block_start") + F.col("n_tokens") > first) & F.lit(first < last))
    wanted = wanted.select("part", "block", "n_tokens", "checkpoints", "words", "words_crc32", "ids_crc32", "block_start")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(held.value)
        for batch in batches:
            for row in range(batch.num_rows):
                part, block, n, checkpoints, words, words_crc, ids_crc, block_start = (c[row].as_py() for c in batch.columns)
                low, high = max(first - block_start, 0), min(last - block_start, n)
                mark = low // CHECKPOINT * CHECKPOINT
                ids = decode_block(model, high, np.frombuffer(checkpoints, "<u8"), _checked(part, block, words, words_crc), mark).astype("<u4")
                if high - mark == n and zlib.crc32(ids.tobytes()) != ids_crc:
                    raise ValueError(f"block {part}/{block}: the ids fail their checksum")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block_start + low], pa.int64()), pa.array([high - low], pa.int64()), pa.array([ids[low - mark :].tobytes()], pa.binary())], names=["start", "n_tokens", "ids"]
                )

    return wanted.mapInArrow(decoded, "start long, n_tokens long, ids binary")
