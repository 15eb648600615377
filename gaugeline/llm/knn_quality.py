"""Quality scores by nearest-neighbour voting in a latent semantic space.

A text is described by its byte trigrams, hashed to `TRIGRAMS` counts (logarithms of the counts times
inverse document frequencies, at unit length), and by a few shares of its style: words that repeat the
word before, lines that repeat, capitals, symbols, digits. A truncated singular value decomposition of labelled
texts gives the latent space. The model, a projection and the vectors and labels of at most `SAMPLE`
texts per class, is broadcast: some `FEATURES * DIMENSIONS + 2 * SAMPLE * DIMENSIONS` floats, whatever
the corpus. Every document is projected and its cosine with every labelled vector computed exactly,
in blocks; the `NEIGHBOURS` nearest vote with a power of their similarity as weight.

The labelled texts are a fixed sample of the training rows (in the order of a hash of the id). Rows
that repeat an id and its text, or an id and its label, count once; of an id with several texts the further ones
are taken where the ids leave room in the sample. Texts
without a word score 0. Rows with a null or other label than 0 and 1 aren't used. Without any
labelled text every other text scores 0.5; with labels of one class only, that label.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import ship, stored, whole_text

TRIGRAMS = 4096
STYLES = 8
FEATURES = TRIGRAMS + STYLES
STYLE_WEIGHT = 1.5  # of a share of 1, beside all trigrams at length 1
DIMENSIONS = 64
SAMPLE = 2000  # labelled texts per class, at most
NEIGHBOURS = 9
SHARPNESS = 4  # power of the cosine in a vote
BLOCK = 256  # documents whose vectors are held at a time
THRESHOLD = 0.3


class Model(NamedTuple):
    idf: np.ndarray  # FEATURES
    axes: np.ndarray  # FEATURES x dimensions
    vectors: np.ndarray  # labelled texts x dimensions, unit length
    labels: np.ndarray


def counts(data: bytes) -> np.ndarray:
    """Hashed byte trigrams of a UTF-8 text; the text counts as set between blanks."""
    raw = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    codes = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    found = np.bincount((codes * np.uint32(2654435761)) >> np.uint32(32 - 12), minlength=FEATURES).astype(np.float32)
    found[TRIGRAMS:] = style(data, np.bincount(raw, minlength=256))
    return found


def style(data: bytes, of_byte: np.ndarray) -> list[float]:
    """STYLES shares in 0 ... 1."""
    words, lines = data.split(), data.split(b"\n")
    n = max(len(words), 1)
    letters = max(of_byte[65:91].sum() + of_byte[97:123].sum(), 20)
    return [
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(words)) / n if len(words) >= 20 else 0.0,
        1 - len(set(lines)) / len(lines),
        min(1.0, max(0.0, of_byte[65:91].sum() / letters - 0.1)),
        min(1.0, of_byte[ord("|")] / n),
        min(1.0, of_byte[ord("!")] / n),
        min(1.0, of_byte[list(b"#$%&*~^@<>{}[]=_\\/")].sum() / n / 3),
        min(1.0, of_byte[48:58].sum() / n),
    ]


def weighed(rows: np.ndarray, idf: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Rows of counts as weights, in `out` (which may be `rows`); a block at a time, so that little is held beside it."""
    out = np.empty_like(rows) if out is None else out
    for at in range(0, len(rows), BLOCK):
        part = np.log1p(rows[at : at + BLOCK, :TRIGRAMS]) * idf[:TRIGRAMS]
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
        out[at : at + BLOCK, :TRIGRAMS] = part
        out[at : at + BLOCK, TRIGRAMS:] = rows[at : at + BLOCK, TRIGRAMS:] * STYLE_WEIGHT
    return out


def _unit(latent: np.ndarray) -> np.ndarray:
    return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)


def vectors(model: Model, rows: np.ndarray) -> np.ndarray:
    """Latent unit vectors of rows of counts."""
    return _unit(weighed(rows, model.idf) @ model.axes)


def votes(model: Model, latent: np.ndarray) -> np.ndarray:
    """Score of each row: the labels of its nearest neighbours, weighted by cosine."""
    if not len(model.labels):
        return np.full(len(latent), 0.5)
    near = latent @ model.vectors.T
    k = min(NEIGHBOURS, near.shape[1])
    at = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, at, axis=1), 1e-3).astype(np.float64) ** SHARPNESS
    # Texts that are the same text agree, however the blocks fall.
    return np.round((weight * model.labels[at]).sum(axis=1) / weight.sum(axis=1), 5)


def train(rows: np.ndarray, labels: np.ndarray, in_place: bool = False) -> Model:
    """Model from counts and labels: idf, then the leading right singular vectors by subspace iteration.

    in_place: the weights replace the counts in `rows`, so that the sample is held once.
    """
    n = len(rows)
    found = np.zeros(FEATURES, np.int64)
    for at in range(0, n, BLOCK):
        found += (rows[at : at + BLOCK] > 0).sum(axis=0)
    idf = (np.log((1 + n) / (1 + found)) + 1).astype(np.float32)
    if not n:
        return Model(idf, np.zeros((FEATURES, 0), np.float32), np.zeros((0, 0), np.float32), labels)
    table = weighed(rows, idf, rows if in_place else None)
    k = min(DIMENSIONS, n)
    basis = np.random.default_rng(0).standard_normal((FEATURES, min(k + 16, n, FEATURES))).astype(np.float32)
    for _ in range(5):
        basis = np.linalg.qr(table.T @ (table @ basis))[0]
    _, _, right = np.linalg.svd(table @ basis, full_matrices=False)
    axes = (basis @ right[:k].T).astype(np.float32)
    return Model(idf, axes, _unit(table @ axes).astype(np.float32), labels)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int | None = None) -> Model:
    """Model of a bounded sample of the labelled rows that aren't held out: at most `sample` (SAMPLE) texts a class.

    Two scans of `docs`: one for the digests of the labelled texts, which are stored, and one for the texts taken.
    """
    most = SAMPLE if sample is None else sample
    ship(docs.sparkSession)
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where(
        F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("label").isin(0, 1)
    ).distinct()
    order = [F.xxhash64("id"), "id", "label"]
    chosen = known.where("label = 0").orderBy(*order).limit(most).unionByName(known.where("label = 1").orderBy(*order).limit(most))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(x.as_buffer().to_pybytes()) for x in batch.column(2)]
            at = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()), pa.array([c[a].astype("<f4").tobytes() for c, a in zip(found, at)], pa.binary())],
                names=["id", "label", "at", "n"],
            )

    texts = docs.select(F.col(doc_id).alias("id"), whole_text(text).cast("binary").alias("data")).join(F.broadcast(chosen), "id")
    texts = texts.select("id", "label", "data", F.xxhash64("data").alias("digest"))
    # An id may have any number of rows: one text of each id comes first, then others up to the sample's size.
    distinct = stored(texts.select("id", "label", "digest").distinct(), "knn-labelled")
    firsts = distinct.groupBy("id", "label").agg(F.min("digest").alias("first"))
    ranked = distinct.join(F.broadcast(firsts), ["id", "label"]).withColumn("further", F.col("digest") != F.col("first"))
    order = ["further", F.xxhash64("id", "digest"), "id", "digest"]
    taken = ranked.where("label = 0").orderBy(*order).limit(most).unionByName(ranked.where("label = 1").orderBy(*order).limit(most))
    # At most 2 * `most` rows are broadcast, and the counts of as many texts collected; copies end in the tasks.
    texts = texts.join(F.broadcast(taken.select("id", "label", "digest")), ["id", "label", "digest"]).dropDuplicates(["id", "label", "digest"])
    rows = texts.select("id", "label", "data").mapInArrow(counted, "id long, label int, at binary, n binary").collect()
    rows = sorted(rows, key=lambda r: (r.id, r.label, bytes(r.at), bytes(r.n)))
    matrix = np.zeros((len(rows), FEATURES), np.float32)
    for i, r in enumerate(rows):
        matrix[i, np.frombuffer(bytes(r.at), "<u2")] = np.frombuffer(bytes(r.n), "<f4")
    marks = np.array([r.label for r in rows], np.float64)
    del rows
    return train(matrix, marks, in_place=True)


def scored(docs: DataFrame, model: Model, out: str = "score", text: str = "text") -> DataFrame:
    """`docs` with column `out`, 0 to 1, higher for texts more like those labelled 1."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("double")
    def score_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*held.value)
        for batch in batches:
            found = np.zeros(len(batch))
            for at in range(0, len(batch), BLOCK):
                texts = [x.as_buffer().to_pybytes() for x in batch[at : at + BLOCK]]
                block = votes(own, vectors(own, np.stack([counts(t) for t in texts])))
                found[at : at + BLOCK] = np.where([bool(t.strip()) for t in texts], block, 0.0)
            yield pa.array(found, pa.float64())

    return docs.withColumn(out, score_of(whole_text(text).cast("binary")))
