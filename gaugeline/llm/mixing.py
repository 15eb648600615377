"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target of words from its weight, at most `MOST_EPOCHS` times what it has. Its
documents are taken whole for as many complete epochs as fit. What remains of the target is filled
from one weighted sample without replacement: a document with quality weight w has the key E / w, E
exponential and fixed by its id, the documents are put in key order within their source, and those are
taken whose words, summed up in that order, have their middle inside the remaining budget. So a
source misses its target by half a document at most.

Null texts have size 0 and null sources form a source of their own, the last. Rows with the same id (or
none) have equal keys; they come in the order of a hash of their texts, equal rows one after the other. Sources
without words have target 0. An empty table gives no rows.

Scale: the order is needed only around the border between taken and left. Keys are binned by their
leading digits, bins are summed per source, and only the one bin in which a source's budget ends is
sorted. A source with a third of all rows costs no more than its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import WORD, fresh_name, stored, whole_text

# Fixed values of the contract: the weights of the sources, in turn, and the most epochs.
TURN = (1, 2, 3)
MOST_EPOCHS = 3

# Bins for each doubling of the key: no bin holds more than about a 3000th of a source.
BINS = 2048

# Sources up to this number are broadcast (some 100 bytes each); more are joined by shuffle.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def text_quality(text: Column) -> Column:
    """Weight in 0.05 ... 1 from the text alone: fewer runs of digits and symbols per word weigh more."""
    words = F.regexp_count(text, F.lit(WORD))
    odd = F.regexp_count(text, F.lit(r"[^\p{L}\x20\x09-\x0D.,]+"))
    return F.greatest(F.lit(0.05), 1 - F.coalesce(odd / F.when(words > 0, words), F.lit(1.0)))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target from one row per source (source, source_size).

    The weights share out the sum of all sizes; a target above MOST_EPOCHS times its source's size
    stops there and the excess is shared again by weight until none is above. In closed form: with the
    sources in order of size / weight, those that stop are a first part of them, and the others get
    weight x level. The windows run over one row per source, never over documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").cast("binary").asc_nulls_last()))
    turn = F.element_at(F.array(*[F.lit(w) for w in TURN]), ((rank - 1) % len(TURN) + 1).cast("int"))
    weighed = sizes.select("source", "source_size", turn.cast("double").alias("w"))
    order = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").cast("binary").asc_nulls_last())
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - MOST_EPOCHS * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    levels = weighed.withColumn("level", level)
    # The first source in this order that its level doesn't fill up sets the level of all after it.
    open_ = F.col("level") * F.col("w") <= MOST_EPOCHS * F.col("source_size")
    final = F.min(F.when(open_, F.struct(F.col("source_size") / F.col("w"), "level"))).over(every)["level"]
    most = (MOST_EPOCHS * F.col("source_size")).cast("double")
    return levels.select("source", "source_size", F.least(most, F.coalesce(final * F.col("w"), most)).alias("target"))


def _key(doc_id: Column, quality: Column, seed: int) -> Column:
    """Key E / w. E = -ln u with u in (0, 1) from 52 bits of a digest of the id."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return -F.log((bits + 0.5) / float(1 << 52)) / quality


def mix(docs: DataFrame, quality: Column | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (default: all) with size, source_size, target, epochs (how often the document is taken) and taken (words).

    Columns of these names in `docs` are replaced. `quality` gives each document's weight, greater
    than 0; by default that of its text.
    """
    made = [c for c in ("size", "source_size", "target", "epochs", "taken") if c not in (doc_id, text, source)]
    docs = docs.drop(*made)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    src, size, key, bin_, tie, rest, edge, from_, take = (
        fresh_name(docs, n) for n in ("_source", "_size", "_key", "_bin", "_tie", "_rest", "_edge", "_from", "_take")
    )
    weight = text_quality(whole_text(text)) if quality is None else quality
    sized = docs.withColumn(src, F.col(source).cast("string")).withColumn(size, word_count(whole_text(text)))
    sized = sized.withColumn(tie, F.struct(F.col(doc_id), F.xxhash64(whole_text(text))))
    keyed = sized.withColumn(key, _key(F.col(doc_id), weight, seed)).withColumn(
        bin_, F.floor(F.log2(F.col(key)) * BINS).cast("int")
    )
    keyed = stored(keyed.select(*keep, src, size, key, bin_, tie), "mix-keys")
    bins = keyed.groupBy(F.col(src).alias("source"), F.col(bin_).alias("bin")).agg(F.sum(size).alias("words"))
    plan = targets(bins.groupBy("source").agg(F.sum("words").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = plan.withColumn("epochs", epochs).withColumn("rest", F.col("target") - epochs * F.col("source_size"))
    # The bin of each source in which its budget ends, and the words before it. A running sum over
    # the bins of a source, some ten thousands.
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ends = bins.withColumn("upto", upto).join(plan.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
    ends = ends.where("upto >= rest AND upto - words <= rest").groupBy("source").agg(
        F.min("bin").alias("bin"), F.min_by(F.col("upto") - F.col("words"), "bin").alias("before")
    )
    plan = plan.join(ends.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias(src), "source_size", "target", "epochs", F.col("rest").alias(rest), F.col("bin").alias(edge), F.col("before").alias(from_)
    )
    held = fresh_name(docs, "_plan_source")
    plan = stored(plan.withColumnRenamed(src, held), "mix-plan")
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = keyed.join(plan, F.col(src).eqNullSafe(F.col(held))).drop(held)
    inside = rows.where(F.col(bin_) == F.col(edge))
    outside = rows.where(~F.col(bin_).eqNullSafe(F.col(edge))).withColumn(take, F.col(bin_) < F.coalesce(F.col(edge), F.lit(0)))
    running = F.sum(size).over(
        Window.partitionBy(src).orderBy(key, tie).rowsBetween(Window.unboundedPreceding, 0)
    )
    middle = F.col(from_) + running - F.col(size) / 2
    inside = inside.withColumn(take, (F.col(rest) > 0) & (middle <= F.col(rest)))
    out = outside.unionByName(inside)
    count = F.col("epochs") + F.col(take).cast("bigint")
    return (
        out.withColumn("taken", count * F.col(size))
        .withColumn("epochs", count)
        .withColumn("size", F.col(size))
        .drop(src, size, key, bin_, tie, rest, edge, from_, take)
    )
