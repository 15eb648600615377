r"""Importance resampling of documents towards a target distribution, with deduplicated segments.

Features are runs of 1 to 3 words, hashed to `BUCKETS` buckets. A bucket's gain is the scaled logarithm of its share
in the target over its share in the documents; a document's weight is the sum of its features' gains, and
the highest weights plus Gumbel noise are drawn, which samples without replacement in proportion to the
importance exp(weight / 1000).

Line breaks cut texts into segments, of which many repeat. A segment is its words; segments that hold the same
words are one row (by a 128-bit hash), with the number of their occurrences. Their features are counted
once, and the counts multiplied by the occurrences. Runs of words that reach across line breaks
are taken from each text separately. A document's weight is then the sum of its segments' weights, each
worked out once and joined back, and of its crossing runs. A segment that a third of all texts hold has one
row per task before the shuffle, and the adaptive join splits its partition on the way back.

Null and empty texts and those without words have no features and weight 0. Rows are documents whatever
their ids: repeated ones each have their own row, the same score, and places in row order; a null id is
the empty string in the noise and comes first among equal scores. An empty target or an empty table gives gains from
the counts that are there. Every row is returned once, with its other columns; result columns get underscores in
front where their names are taken.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import fresh_name, ship, stored, whole_text
from gaugeline.operators.order import with_position

BUCKETS = 10_000
# Words of a lower-cased UTF-8 text: ASCII letters and digits, and everything beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

def words_by_line(data: bytes) -> list[list[bytes]]:
    """The words of each line that has any; A-Z lower-cased only."""
    found = (_WORD.findall(line) for line in data.lower().split(b"\n"))
    return [w for w in found if w]


def buckets(words: list[bytes]) -> np.ndarray:
    """Buckets of all runs of 1 to 3 words, as uint16: the checksum of a run continues that of the shorter one."""
    spaced = [b" " + w for w in words]
    one = list(map(crc32, words))
    two = list(map(crc32, spaced[1:], one))
    three = list(map(crc32, spaced[2:], two))
    return (np.array(one + two + three, np.int64) % BUCKETS).astype("<u2")


def crossing(lines: list[list[bytes]]) -> np.ndarray:
    """Buckets of the runs that begin in one line and end in another."""
    out: list[int] = []
    for nr in range(1, len(lines)):
        # Lines may hold a single word, so a run may begin two lines above.
        before = lines[nr - 1][-2:] if len(lines[nr - 1]) > 1 or nr == 1 else [lines[nr - 2][-1], *lines[nr - 1]]
        first, last = lines[nr][0], before[-1]
        out.append(crc32(last + b" " + first))
        if len(before) > 1:
            out.append(crc32(before[0] + b" " + last + b" " + first))
        if len(lines[nr]) > 1:
            out.append(crc32(last + b" " + first + b" " + lines[nr][1]))
    return (np.array(out, np.int64) % BUCKETS).astype("<u2")


def n_runs(words: int) -> int:
    return words + max(0, words - 1) + max(0, words - 2)


def digest(words: list[bytes]) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(b" ".join(words))


def _halves(digests: list[bytes]) -> list[pa.Array]:
    rows = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return [pa.array(rows[:, 0], pa.int64()), pa.array(rows[:, 1], pa.int64())]


def segments(docs: DataFrame, text: str = "text") -> DataFrame:
    """d1, d2, times, n_words, buckets: each distinct segment once, `times` its occurrences in all rows."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list] = {}
            for x in batch.column(0):
                for words in words_by_line(x.as_buffer().to_pybytes()):
                    joined = b" ".join(words)
                    held.setdefault(joined, [0])[0] += 1
            yield pa.RecordBatch.from_arrays(
                [*_halves([digest([k]) for k in held]), pa.array([n for (n,) in held.values()], pa.int64()), pa.array(held, pa.binary())], names=["d1", "d2", "times", "words"]
            )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [x.as_buffer().to_pybytes().split(b" ") for x in batch.column(3)]
            found = [buckets(w).tobytes() for w in words]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(w) for w in words], pa.int64()), pa.array(found, pa.binary())], names=["d1", "d2", "times", "n_words", "buckets"]
            )

    lines = docs.select(whole_text(text).cast("binary").alias("data")).mapInArrow(cut, "d1 long, d2 long, times long, words binary")
    distinct = lines.groupBy("d1", "d2").agg(F.sum("times").alias("times"), F.any_value("words").alias("words"))
    return distinct.mapInArrow(counted, "d1 long, d2 long, times long, n_words long, buckets binary")


def outlines(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with _own: n_words, segments (d1, d2, times) and the crossing runs' buckets of each text."""
    ship(docs.sparkSession)
    kind = pa.struct([("d1", pa.int64()), ("d2", pa.int64()), ("times", pa.int64())])

    @F.arrow_udf("struct<n_words:long,segments:array<struct<d1:long,d2:long,times:long>>,crossing:binary>")
    def outlined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes, across, digests, times, ends = [], [], [], [], [0]
            for x in batch:
                lines = words_by_line(x.as_buffer().to_pybytes())
                own: dict[bytes, int] = {}
                for words in lines:
                    key = digest(words)
                    own[key] = own.get(key, 0) + 1
                sizes.append(sum(map(len, lines)))
                across.append(crossing(lines).tobytes())
                digests.extend(own)
                times.extend(own.values())
                ends.append(len(digests))
            rows = pa.StructArray.from_arrays([*_halves(digests), pa.array(times, pa.int64())], fields=list(kind))
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows), pa.array(across, pa.binary())],
                names=["n_words", "segments", "crossing"],
            )

    return docs.withColumn(fresh_name(docs, "_own"), outlined(whole_text(text).cast("binary")))


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Features by bucket, from (times, buckets). One row per task and bucket is shuffled, BUCKETS are collected."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            times, found = batch.column(0).to_numpy(), [np.frombuffer(x.as_buffer(), "<u2") for x in batch.column(1)]
            # Equal occurrences together, so that counting is whole numbers all the way.
            order = np.argsort(times, kind="stable")
            for same in np.split(order, np.flatnonzero(np.diff(times[order])) + 1) if len(order) else []:
                total += times[same[0]] * np.bincount(np.concatenate([found[i] for i in same]), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    counts = np.zeros(BUCKETS, np.int64)
    for r in rows.select("times", "buckets").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln(share in the target / share in the source)), both counts one up."""
    total_s, total_t = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * total_s / ((s + 1.0) * total_t))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(key: str) -> int:
    """Gumbel noise in thousandths, a fixed function of the key."""
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = 20,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """`docs` with n_features, weight, score and rank: 1, 2, ... for the drawn, `percent` % of those with `least_words` words.

    keep: the columns of `docs` to return, all if not given.
    """
    spark = docs.sparkSession
    row, own = fresh_name(docs, "_row"), fresh_name(docs, "_own")
    rest = docs.columns if keep is None else keep
    # Rows are numbered in what was written, so that the numbers stay when a task is run again.
    marked = stored(outlines(docs, text).select(*dict.fromkeys([*rest, doc_id]), own, F.monotonically_increasing_id().alias(row)), "outlines")
    parts = stored(segments(docs, text), "segments")
    across = marked.select(F.lit(1).cast("bigint").alias("times"), F.col(own)["crossing"].alias("buckets"))
    source = bucket_counts(parts.select("times", "buckets").unionByName(across))
    aim = outlines(target, text).select(F.lit(1).cast("bigint").alias("times"), F.col(fresh_name(target, "_own"))["crossing"].alias("buckets"))
    held = spark.sparkContext.broadcast(gains(source, bucket_counts(segments(target, text).select("times", "buckets").unionByName(aim))))

    def weight_of(found: pa.Array) -> pa.Array:
        gain = held.value
        return pa.array([int(gain[np.frombuffer(x.as_buffer(), "<u2")].sum()) for x in found], pa.int64())

    @F.arrow_udf("long")
    def weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield weight_of(batch)

    @F.arrow_udf("long")
    def noise_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([noise(k) for k in batch.to_pylist()], pa.int64())

    weighed = parts.select("d1", "d2", weight("buckets").alias("weight"))
    uses = marked.select(F.col(row).alias("row"), F.explode(F.col(own)["segments"]).alias("s")).select("row", "s.*")
    sums = uses.join(weighed, ["d1", "d2"]).groupBy("row").agg(F.sum(F.col("weight") * F.col("times")).alias("weight"))
    n, size = F.col(own)["n_words"], fresh_name(docs, "_words")
    zero = F.lit(0).cast("bigint")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    names = [fresh_name(docs, c) for c in ("n_features", "weight", "score", "rank")]
    scored = marked.join(sums.withColumnRenamed("row", row).withColumnRenamed("weight", names[1]), row, "left")
    scored = scored.withColumn(names[1], F.coalesce(names[1], zero) + weight(F.col(own)["crossing"])).withColumn(names[2], F.col(names[1]) + noise_of(key))
    features = n + F.greatest(n - 1, zero) + F.greatest(n - 2, zero)
    scored = stored(scored.select(*dict.fromkeys([*rest, doc_id]), row, n.alias(size), features.alias(names[0]), names[1], names[2]), "scores")
    # Only the numbers that decide the order are sorted.
    able = scored.where(F.col(size) >= least_words).select((-F.col(names[2])).alias("low"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    drawn = able.count() * percent // 100
    places = with_position(able, "low", "id", "row", name="pos").where(F.col("pos") <= drawn).select(F.col("row").alias(row), F.col("pos").alias(names[3]))
    return scored.join(places, row, "left").select(*rest, *names)
