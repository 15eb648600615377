"""Secret scans over an incremental ledger of blobs.

Every version of every text is addressed by the SHA-256 of its content. The ledger, a Parquet table,
holds for each blob which rule versions have been run on it and the spans they found; beside it stand the
blobs' texts, each once, and all paths and versions that ever held a blob. A scan reads the ledger, runs only
rule versions that a blob has not seen, once per distinct blob however many paths share it, appends to the
ledger and joins the findings back to all paths. `rescan` runs new rules over every blob ever seen,
and `history` reports every path, both without the texts being passed again.

A rule is (kind, version, regular expression, group, least): of the leftmost non-overlapping matches,
those whose group has at least `least` characters are findings. Spans count code points, the end is
exclusive. Everything is SQL expressions. Null texts count as empty; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import stored, whole_text


class Rule(NamedTuple):
    kind: str
    version: int
    regex: str
    group: int = 0
    least: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}/{self.version}"


# The base rules. Where a match is one run of a class, the least length may as well
# stand in the expression, which then skips short runs by itself.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE

_SPAN = "array<struct<start:bigint,nr:int,kind:string,end:bigint>>"
_LEDGER = "blob string, rules array<string>, spans array<struct<rule:string,start:bigint,end:bigint>>"


def _cut(text: Column, rule: Rule, unseen: Column) -> Column:
    """What stands before each match, the match, and whether it counts: an array per text."""
    groups = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    cut = F.arrays_zip(
        F.transform(F.split(text, rule.regex, -1), lambda x: F.length(x)).alias("before"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0)), lambda x: F.length(x)).alias("size"),
        F.transform(groups, lambda x: F.length(x) >= rule.least).alias("counts"),
    )
    found = F.when(F.array_contains(unseen, rule.id) & text.rlike(rule.regex), cut)
    return F.transform(
        F.filter(found, lambda x: x["size"].isNotNull()),
        lambda x, i: F.struct(F.lit(rule.id).alias("rule"), i.alias("i"), x["before"].alias("before"), x["size"].alias("size"), x["counts"].alias("counts")),
    )


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, rules, spans from blobs (blob, text, unseen). Matches become rows, so that a text with very many
    of them is summed up in one pass."""
    pieces = F.flatten(F.array(*[F.coalesce(_cut(F.col("text"), r, F.col("unseen")), F.array()) for r in rules]))
    rows = blobs.select("blob", "unseen", F.explode_outer(pieces).alias("m")).select("blob", "unseen", "m.*")
    upto = F.sum(F.col("before") + F.col("size")).over(
        Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    )
    spans = rows.withColumn("end", upto).withColumn("start", F.col("end") - F.col("size"))
    span = F.when(F.col("counts"), F.struct("rule", F.col("start").cast("bigint"), F.col("end").cast("bigint")))
    return spans.groupBy("blob").agg(F.any_value("unseen").alias("rules"), F.collect_list(span).alias("spans"))


def _exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _unseen(blobs: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, unseen (rules that the blob has not been scanned with), fresh (not in the ledger) of those with any."""
    wanted = F.array(*[F.lit(r.id) for r in rules])
    if not _exists(blobs.sparkSession, ledger):
        return blobs.select("blob", wanted.alias("unseen"), F.lit(True).alias("fresh"))
    seen = blobs.sparkSession.read.schema(_LEDGER).parquet(ledger).groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
    rows = blobs.join(seen, "blob", "left").withColumn("unseen", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
    return rows.where(F.size("unseen") > 0).select("blob", "unseen", F.col("seen").isNull().alias("fresh"))


def _append(scanned: DataFrame, ledger: str) -> None:
    rows = scanned.select("blob", "rules", F.col("spans").cast("array<struct<rule:string,start:bigint,end:bigint>>"))
    rows.write.mode("append").option("compression", "zstd").parquet(ledger)


def _scan_old(spark: SparkSession, unseen: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> None:
    """Run rules over blobs whose texts an earlier scan has kept."""
    texts = spark.read.schema("blob string, text string").option("recursiveFileLookup", "true").parquet(f"{ledger}-blobs")
    _append(scan_blobs(texts.join(unseen.select("blob", "unseen"), "blob").dropDuplicates(["blob"]), rules), ledger)


def _with_findings(paths: DataFrame, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """`paths` (blob, ...) with found."""
    number = {r.id: i for i, r in enumerate(rules)}
    nr = F.coalesce(*[F.when(F.col("s.rule") == k, v) for k, v in number.items()])
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("nr") + 1)
    spans = paths.sparkSession.read.schema(_LEDGER).parquet(ledger).where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s"))
    spans = spans.withColumn("nr", nr).where(F.col("nr").isNotNull()).select("blob", F.struct(F.col("s.start"), "nr", kind.alias("kind"), F.col("s.end")).alias("s"))
    found = spans.groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("found"))
    return paths.join(found, "blob", "left").select(*[c for c in paths.columns if c != "blob"], "blob", F.coalesce("found", F.array().cast(_SPAN)).alias("found"))


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`versions` without `text`, with blob and found: array of (start, nr, kind, end), by start, then rule order.

    `ledger` is a folder that all executors reach; it is made at the first scan and grows by one append per
    scan, as do `<ledger>-blobs` and `<ledger>-paths` beside it. A scan that ends half way is made good
    by the next: what the ledger lacks counts as unseen. Columns blob and found in `versions` are replaced.
    """
    spark = versions.sparkSession
    data = versions.drop("blob", "found").withColumn("blob", F.sha2(whole_text(text).cast("binary"), 256))
    paths = data.drop(text)
    unseen = stored(_unseen(paths.select("blob").distinct(), ledger, rules), "unseen-blobs")
    fresh = unseen.where("fresh").select("blob")
    if not fresh.isEmpty() or not _exists(spark, ledger):
        # The texts are kept first and scanned from there.
        batch = f"{ledger}-blobs/batch-{uuid.uuid4().hex}"
        texts = data.select("blob", whole_text(text).alias("text")).join(fresh, "blob").dropDuplicates(["blob"])
        texts.write.option("compression", "zstd").parquet(batch)
        texts = spark.read.schema("blob string, text string").parquet(batch)
        _append(scan_blobs(texts.withColumn("unseen", F.array(*[F.lit(r.id) for r in rules])), rules), ledger)
    old = unseen.where("NOT fresh")
    if not old.isEmpty():
        _scan_old(spark, old, ledger, rules)
    held = paths.distinct()
    if _exists(spark, f"{ledger}-paths"):
        held = held.subtract(spark.read.schema(paths.schema).parquet(f"{ledger}-paths"))
    held.write.mode("append").option("compression", "zstd").parquet(f"{ledger}-paths")
    return _with_findings(paths, ledger, rules)


def history(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every distinct path and version that any scan was given, with blob and what `rules` have found in it."""
    return _with_findings(spark.read.parquet(f"{ledger}-paths"), ledger, rules)


def rescan(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`history` after `rules` have been run on every blob ever seen that they are new to."""
    unseen = stored(_unseen(spark.read.schema(_LEDGER).parquet(ledger).select("blob").distinct(), ledger, rules), "unseen-blobs")
    if not unseen.isEmpty():
        _scan_old(spark, unseen, ledger, rules)
    return history(spark, ledger, rules)


def spans_text(found: Column) -> Column:
    """`kind:start:end` of all spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """`found` rows of `scan` with a count per base rule, the digest of the base spans, and all spans."""
    base = [r.kind for r in BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(k).alias(f"n_{k}") for k in base]
    kept = F.filter("found", lambda s: s["kind"].isin(*base))
    rest = [c for c in found.columns if c not in ("found", "blob")]
    return found.select(*rest, *counts, F.sha2(spans_text(kept), 256).alias("base_sha256"), spans_text(F.col("found")).alias("spans"))
