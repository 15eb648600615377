"""Document fingerprints by consistent weighted sampling.

A document is the bag of its words (lower-cased), each weighted by how often it occurs. For sample k
every word has a draw r, c of the gamma distribution with shape 2 and a uniform b, all fixed by word
and k; with weight s, t = floor(ln s / r + b), the word's value is ln c - r (t - b + 1), and the sample
is the smallest value of the document. Two documents have the same sample with a chance of their
generalised Jaccard similarity, sum of smaller weights over sum of larger weights; equal texts have
equal samples. A fingerprint shows 32 bits of each sample in hexadecimal.

Texts without words have the fingerprint of zeros; two such texts are alike, and unlike any other. Null
texts count as empty. Null ids come last in descending order; rows with the same id are ordered by
text. An empty table gives no rows. Everything is SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import BLANK, stored, whole_text

# The standard error of a likeness is at most 1 / (2 sqrt(SAMPLES)).
SAMPLES = 32

# Documents a bucket of neighbouring ids should hold, and how many quantiles of the ids are taken to
# form buckets; ids that are uneven inside a quantile make some buckets larger, not wrong.
BUCKET_ROWS = 256
QUANTILES = 1000


def _uniform(bits: Column, n: int) -> Column:
    """The lowest n bits as a number inside (0, 1)."""
    return (bits.bitwiseAND(F.lit((1 << n) - 1)) + 0.5) / float(1 << n)


def sample(word: Column, log_weight: Column, k: int) -> Column:
    """Value of a word (64-bit hash) for sample k."""
    one = F.xxhash64(word, F.lit(k))
    two = F.xxhash64(one)
    r = -F.log(_uniform(one, 21) * _uniform(F.shiftrightunsigned(one, 21), 21))
    b = _uniform(F.shiftrightunsigned(one, 42), 22)
    log_c = F.log(-F.log(_uniform(two, 32) * _uniform(F.shiftrightunsigned(two, 32), 32)))
    return log_c - r * (F.floor(log_weight / r + b) - b + 1)


def samples(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, samples: 32 bits of each sample of column `text`. Texts without words give no row.

    The words are counted and the samples taken by aggregations; a frame that is partitioned by one
    of the keys is not shuffled.
    """
    words = texts.select(*keys, F.explode(F.split(F.lower(text), BLANK)).alias("_word")).where("_word <> ''")
    weights = words.select(*keys, F.xxhash64("_word").alias("_word")).groupBy(*keys, "_word").agg(F.count(F.lit(1)).alias("_n"))
    logs = weights.select(*keys, "_word", F.log(F.col("_n").cast("double")).alias("_log"))
    least = logs.groupBy(*keys).agg(*[F.min(sample(F.col("_word"), F.col("_log"), k)).alias(f"_s{k}") for k in range(SAMPLES)])
    shown = [F.xxhash64(f"_s{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(SAMPLES)]
    return least.select(*keys, F.array(*shown).alias("samples"))


def _or_empty(found: Column) -> Column:
    return F.coalesce(found, F.array_repeat(F.lit(0).cast("bigint"), SAMPLES))


def hex_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples, 0 to 1."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x) / float(SAMPLES)


def _buckets(docs: DataFrame, doc_id: str) -> Column:
    """A number that rises with the id, some BUCKET_ROWS rows each; -1 for null ids."""
    ids = F.col(doc_id).cast("bigint")
    known = docs.select(ids.alias("id")).where("id IS NOT NULL")
    n = known.count()
    cuts = min(QUANTILES, -(-n // BUCKET_ROWS))
    marks = known.agg(F.percentile_approx("id", [i / max(cuts, 1) for i in range(cuts + 1)], 10 * QUANTILES).alias("q")).first().q if n else []
    marks = sorted(set(marks))
    if len(marks) < 2:
        return F.when(ids.isNull(), -1).otherwise(0).cast("bigint")
    parts = -(-n // (len(marks) * BUCKET_ROWS))
    held = F.array(*[F.lit(m) for m in marks])
    at = F.least(F.greatest(F.size(F.filter(held, lambda m: m <= ids)), F.lit(1)), F.lit(len(marks) - 1))
    low, high = (F.element_at(held, at + k).cast("double") for k in (0, 1))
    part = F.least(F.greatest(F.floor((ids.cast("double") - low) / (high - low) * parts), F.lit(0)), F.lit(parts - 1))
    return F.when(ids.isNull(), -1).otherwise(at.cast("bigint") * parts + part).cast("bigint")


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id, after the smallest the largest. Rows meet
    their neighbour inside a bucket of neighbouring ids; the first rows of a bucket also go, as
    guests, to the bucket before, so one shuffle of the texts is enough.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), whole_text(text).alias("text"), _buckets(docs, doc_id).alias("bucket"))
    # One row a bucket, about a 256th of the documents.
    firsts = stored(rows.select("bucket", "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("top")), "cws-firsts")
    order = Window.orderBy(F.col("bucket"))
    before = stored(
        firsts.select("bucket", "top", F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(Window.partitionBy())).alias("host")),
        "cws-hosts",
    )
    hosts = before.select(F.col("bucket").alias("own"), "top", "host")
    seated = rows.join(hosts, (rows.bucket == hosts.own) & rows.doc_id.eqNullSafe(hosts.top), "left")
    seats = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")), F.when(F.col("own").isNotNull(), F.struct(F.col("host").alias("bucket"), F.lit(True).alias("guest"))))
    seated = seated.select("doc_id", "text", F.explode(F.array_compact(seats)).alias("seat"))
    # Never null, so that the join below puts no filter on one of its sides: both then read one shuffle.
    bucket, guest = F.coalesce("seat.bucket", F.lit(-1)), F.coalesce("seat.guest", F.lit(False))
    seated = seated.select("doc_id", "text", bucket.cast("bigint").alias("bucket"), guest.alias("guest"))
    line = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    placed = (
        seated.withColumn("nr", F.row_number().over(line))
        .withColumn("next", F.coalesce(F.lead("text").over(line), F.lit("")))
        .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next"), F.lit(1), half)))
    )
    sides = placed.select("bucket", "nr", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))).alias("s"))
    found = samples(sides.select("bucket", "nr", "s.side", "s.t"), ["bucket", "nr", "side"], "t")
    pair = found.groupBy("bucket", "nr").agg(
        F.max(F.when(F.col("side") == 0, F.col("samples"))).alias("own_samples"), F.max(F.when(F.col("side") == 1, F.col("samples"))).alias("edited_samples")
    )
    facts = placed.select("bucket", "nr", "guest", "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    full = facts.join(pair, ["bucket", "nr"], "left").withColumn("own_samples", _or_empty(F.col("own_samples"))).withColumn("edited_samples", _or_empty(F.col("edited_samples")))
    after = F.lead("own_samples").over(Window.partitionBy("bucket").orderBy("nr"))
    return full.withColumn("next_samples", after).where(~F.col("guest")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hex_text(F.col("own_samples")).alias("fingerprint"),
        hex_text(F.col("edited_samples")).alias("edited_fingerprint"),
        likeness(F.col("own_samples"), F.col("edited_samples")).alias("near_edited"),
        likeness(F.col("own_samples"), F.col("next_samples")).alias("near_next"),
    )
