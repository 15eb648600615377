"""From raw documents to token ids: quality, near-duplicates, personal data, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is
written as Parquet and read again as the next one's docs. All but the last return the columns of
`documents`. Further columns of docs are carried along. A document is a row: rows that share a doc_id stay or go each
by its own text. The mix repeats a document once per epoch.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import bpe, knn_quality, minhash, mixing, pii
from gaugeline.llm.common import fresh_name, stored, table
from gaugeline.llm.queries import PII_KEY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, doesn't reject."""
    score = fresh_name(docs, "_score")
    model = knn_quality.fit(docs, table(spark, sf_dir, "labels"))
    return knn_quality.scored(docs, model, score).where(F.col(score) >= knn_quality.THRESHOLD).drop(score)


# Near-duplicates of the pipeline share 80 % of their shingles or more; op8's 85 % is that query's own.
SIMILAR = 80


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return minhash.representatives(docs, least=SIMILAR)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; n_chars follows the text. The setting `spark.gaugeline.pii.key` holds the secret key."""
    out = pii.replace(docs, spark.conf.get("spark.gaugeline.pii.key", PII_KEY))
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the sources' targets, each as often as the mix takes it."""
    mixed = mixing.mix(docs)
    copies = F.explode(F.sequence(F.lit(1), F.col("epochs").cast("int")))
    return mixed.where("epochs > 0").withColumn(fresh_name(mixed, "_copy"), copies).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The other columns of the documents with ids, n_tokens and the digests of ids and decoded text."""
    return bpe.round_trip(docs, bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_dedup),
    ("pii", private_data),
    ("mix", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# No SQL: the classifier's vectors, min-max hashes and merges have no counterpart there. tests/llm compares each
# stage with a plain version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
