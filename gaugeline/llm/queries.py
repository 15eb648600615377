"""The registered queries of this package and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import alignment, bpe, importance, knn_quality, line_runs, minhash, mixing, mtree, oracles, pii, rans, secrets, url_rules, weighted_sampling
from gaugeline.llm.common import table
from gaugeline.session import fresh_path

# Fixed values of the contract.
SITES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
END_ID = 2

# Surrogates are as secret as this key: pass one of your own outside of tests.
PII_KEY = "gaugeline test key"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), spec).drop("ids")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, texts replaced."""
    return pii.replace(table(spark, sf_dir, "documents"), PII_KEY)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scans with one ledger: the second finds every blob seen and joins the findings to all rows."""
    docs, ledger = table(spark, sf_dir, "documents").select("doc_id", "text"), fresh_path(spark, "ledger")
    secrets.scan(docs, ledger)
    return secrets.digest(secrets.scan(docs, ledger))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, SITES).select("page_id", "host", "path", "rule", "verdict")


def op5_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    spec = bpe.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    rans.write_tokens(table(spark, sf_dir, "documents"), path, spec, END_ID)
    return rans.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = knn_quality.fit(docs, table(spark, sf_dir, "labels"))
    scores = knn_quality.scored(docs, model).drop("text")
    return scores.select(
        "doc_id", knn_quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= knn_quality.THRESHOLD).cast("int").alias("predicted")
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), least=minhash.LEAST)


def op9_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.edited_fingerprints(table(spark, sf_dir, "documents"))


# Batches in which the query's table is taken in; the first four are compacted to one run.
LINE_BATCHES = 5


def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_runs.dropped_in_batches(docs, fresh_path(spark, "line-runs"), LINE_BATCHES, least=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = bpe.read_spec(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.with_counts(docs, spec, alignment.read_model(public_tokenizers.path("piece_bpe_32k.model")), groups=False)
    return aligned.drop("text")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark"), percent=5, least_words=20, seed=42, keep=["doc_id"])


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_pii": op2_pii,
    "op3_secrets": op3_secrets,
    "op4_url_rules": op4_url_rules,
    "op5_rans": op5_rans,
    "op6_knn_quality": op6_knn_quality,
    "op7_mixing": op7_mixing,
    "op8_minhash": op8_minhash,
    "op9_mtree": op9_mtree,
    "op10_weighted_sampling": op10_weighted_sampling,
    "op11_line_runs": op11_line_runs,
    "op12_alignment": op12_alignment,
    "op13_importance": op13_importance,
}

ORACLES = {
    "op3_secrets": oracles.SECRETS,
    "op4_url_rules": oracles.url_sql(SITES),
    "op7_mixing": oracles.MIX,
    "op8_minhash": oracles.NEAR_DUPLICATES,
    "op9_mtree": oracles.TOP_K,
    "op11_line_runs": oracles.FREQUENT_LINES,
}
