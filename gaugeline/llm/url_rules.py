"""URL filters: pattern rules indexed by their rarest literal token.

A rule is `host/path` (the host and all its subdomains, paths that begin so) or a pattern over the
whole url with `*` for any run of characters (it may begin and end anywhere: put `*` at the ends).
Of the tokens (runs of a-z and 0-9) that every matching url must hold as a whole, each rule is filed
under the one that the fewest urls hold, counted over all urls. A url fetches the rules filed under
its own tokens, and only their regular expressions are run on it. Rules without any such token are
run on every url. A short list of rules goes into the plan as a literal, and each url is judged where it stands. A longer
one, of any length, is a table joined with the urls' tokens, broadcast when its measured size is small; in the shuffle
join beyond, the rows of a token that many urls hold are salted.

A site rule that fits decides, the longest first; otherwise a pattern does (block goes before
allow); otherwise the verdict is allow. Null urls and urls without `://` have empty host and path;
patterns still see the url. No rule list makes every verdict allow.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import CAPITALS, SMALL, fresh_name, stored
from gaugeline.session import BROADCAST_BYTES, broadcast_if_small

# So many rules go into the plan as one literal; more are a table. The verdicts are the same.
LITERAL_RULES = 256
# A table of rules up to this size is broadcast.
RULE_BYTES = BROADCAST_BYTES
# Urls that hold a token, per salt of a shuffle join.
SALT_ROWS = 1_000_000

# Patterns of hosts and paths that are rarely worth reading.
PATTERNS = (
    ("block", "*://*spam-farm.*"),
    ("block", "*://*cheap-pills.*"),
    ("block", "*://*.casino-*"),
    ("block", "*/doorway/*"),
    ("block", "*/viagra-*"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, F.lit("://")) + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), CAPITALS, SMALL)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(text, CAPITALS, SMALL), F.lit("[a-z0-9]+"), F.lit(0)))


def _site(rule: str) -> tuple[str, list[str]]:
    """Regular expression over `host?path` (neither holds a question mark) and the certain tokens of a site rule."""
    host, _, path = rule.partition("/")
    path = "/" + path
    # The last run of the path may go on in the url.
    whole = re.sub(r"[a-z0-9]+$", "", path.lower())
    return rf"^(?:[^?]*\.)?{_quoted(host)}\?{_quoted(path)}", re.findall("[a-z0-9]+", f"{host} {whole}")


def _pattern(rule: str) -> tuple[str, list[str]]:
    """The same over the url for a pattern."""
    pieces = rule.split("*")
    tokens = []
    for k, piece in enumerate(pieces):
        piece = piece.lower()
        if k:  # a run next to a star may be part of a longer one
            piece = re.sub("^[a-z0-9]+", "", piece)
        if k < len(pieces) - 1:
            piece = re.sub("[a-z0-9]+$", "", piece)
        tokens += re.findall("[a-z0-9]+", piece)
    return "(?s)^" + ".*".join(map(_quoted, pieces)) + "$", tokens


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text) if text.isascii() else rf"\Q{text}\E"


def _rules(sites: list[tuple[str, str]], patterns: list[tuple[str, str]]) -> list[tuple]:
    """(kind, verdict, rule, regex, certain tokens) of each rule."""
    rules = [("site", verdict, rule, *_site(rule)) for verdict, rule in sites]
    return rules + [("pattern", verdict, rule, *_pattern(rule)) for verdict, rule in patterns]


def rule_index(urls: DataFrame, sites: list[tuple[str, str]], patterns: list[tuple[str, str]], url: str) -> dict[str, list[dict]]:
    """token -> the rules filed under it; '' holds those without a certain token."""
    rules = _rules(sites, patterns)
    wanted = sorted({t for *_, tokens in rules for t in tokens})
    counts: dict[str, int] = {}
    if wanted:
        held = F.array_intersect(_tokens(F.col(url)), F.array(*map(F.lit, wanted)))
        rows = urls.select(F.explode(held).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        counts = {r.token: r.n for r in rows.collect()}  # at most one row a token of the rules
    index: dict[str, list[dict]] = {}
    for kind, verdict, rule, regex, tokens in rules:
        at = min(set(tokens), key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(at, []).append({"kind": kind, "verdict": verdict, "rule": rule, "regex": regex})
    return index


_RULE = "array<struct<kind:string,verdict:string,rule:string,regex:string>>"


def rule_table(tokens: DataFrame, rules: list[tuple]) -> DataFrame:
    """token, salts, kind, verdict, rule, regex: each rule under the token that the fewest rows of `tokens` (row, token) hold.

    salts: over how many groups the rows of that token are dealt in a shuffle join.
    """
    spark = tokens.sparkSession
    given = [(i, kind, verdict, rule, regex, sorted(set(own))) for i, (kind, verdict, rule, regex, own) in enumerate(rules)]
    table = stored(spark.createDataFrame(given, "id long, kind string, verdict string, rule string, regex string, own array<string>"), "url-rules")
    wanted = broadcast_if_small(table.select(F.explode("own").alias("token")).distinct(), "token")
    counts = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # A rule without a certain token stands under '', which every url holds.
    own = table.withColumn("token", F.explode(F.when(F.size("own") > 0, F.col("own")).otherwise(F.array(F.lit("")))))
    every = F.lit(tokens.where("token = ''").count())
    own = own.join(counts, "token", "left").withColumn("n", F.when(F.col("token") == "", every).otherwise(F.coalesce("n", F.lit(0))))
    rarest = own.groupBy("id").agg(F.min(F.struct("n", "token")).alias("at")).select("id", "at.*")
    filed = table.drop("own").join(rarest, "id").select("token", (1 + F.col("n") / SALT_ROWS).cast("int").alias("salts"), "kind", "verdict", "rule", "regex")
    return stored(filed, "url-rules-filed")


def _judged_by_join(rows: DataFrame, rules: list[tuple], held: str, names: tuple[str, str, str]) -> DataFrame:
    """`rows` (written, with row numbers) with the deciding site rule and pattern of each, as structs."""
    row, site_hit, pattern_hit = names
    seen = F.coalesce(F.col(held), F.lit(""))
    spread = F.explode(F.concat(F.array(F.lit("")), F.coalesce(_tokens(F.col(held)), F.array()))).alias("token")
    tokens = rows.select(F.col(row).alias("row"), spread)
    filed = rule_table(tokens, rules)
    size = filed.agg(F.sum(F.octet_length("regex") * 2 + F.octet_length("token") + 96).alias("b")).first()["b"] or 0
    texts = rows.select(F.col(row).alias("row"), F.concat("host", F.lit("?"), "path").alias("site"), seen.alias("seen"))
    if size <= RULE_BYTES:
        found = texts.withColumn("token", F.explode(F.concat(F.array(F.lit("")), _tokens(F.col("seen"))))).join(F.broadcast(filed), "token")
    else:
        # The salted tokens are those that over SALT_ROWS rows hold, hence few beside the rows.
        salted = filed.where("salts > 1").select("token", "salts").distinct()
        dealt = tokens.join(salted, "token", "left").withColumn("salt", F.pmod(F.xxhash64("row"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        filed = filed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        found = dealt.join(filed, ["token", "salt"]).join(texts, "row")
    hits = found.where(F.rlike(F.when(F.col("kind") == "site", F.col("site")).otherwise(F.col("seen")), F.col("regex")))
    best = hits.groupBy("row").agg(
        F.max(F.when(F.col("kind") == "site", F.struct(F.length("rule").alias("n"), "rule", "verdict"))).alias(site_hit),
        F.max(F.when(F.col("kind") == "pattern", F.struct("verdict", "rule"))).alias(pattern_hit),
    )
    return rows.join(best.withColumnRenamed("row", row), row, "left")


def judge(urls: DataFrame, sites: list[tuple[str, str]], patterns: list[tuple[str, str]] = PATTERNS, url: str = "url") -> DataFrame:
    """`urls` with host, path, rule, verdict and pattern. Columns of these names in `urls` are replaced.

    sites and patterns: (allow or block, rule).
    """
    made = ("host", "path", "rule", "verdict", "pattern")
    held = fresh_name(urls, "_url")
    rows = urls.withColumn(held, F.col(url).cast("string")).drop(*made)
    site_hit, pattern_hit, row = (fresh_name(rows, n) for n in ("_site_hit", "_pattern_hit", "_row"))
    host, path = url_parts(F.col(held))
    rows = rows.withColumn("host", host).withColumn("path", path)
    if len(sites) + len(patterns) <= LITERAL_RULES:
        rows, extra = _judged_in_place(rows, rule_index(urls, sites, patterns, url), held, (site_hit, pattern_hit)), []
    else:
        rows = stored(rows.withColumn(row, F.monotonically_increasing_id()), "urls")
        rows, extra = _judged_by_join(rows, _rules(sites, patterns), held, (row, site_hit, pattern_hit)), [row]
    return (
        rows.withColumn("rule", F.col(site_hit)["rule"])
        .withColumn("pattern", F.when(F.col("rule").isNull(), F.col(pattern_hit)["rule"]))
        .withColumn("verdict", F.coalesce(F.col(site_hit)["verdict"], F.col(pattern_hit)["verdict"], F.lit("allow")))
        .drop(held, site_hit, pattern_hit, *extra)
    )


def _judged_in_place(rows: DataFrame, index: dict[str, list[dict]], held: str, names: tuple[str, str]) -> DataFrame:
    """The same by a literal: no shuffle, so neither a common host nor a common token gathers rows."""
    site, seen, hits = (fresh_name(rows, n) for n in ("_site", "_seen", "_hits"))
    filed = F.from_json(F.lit(json.dumps(index)), f"map<string,{_RULE}>")
    fetched = F.flatten(
        F.filter(
            F.transform(F.concat(F.array(F.lit("")), F.coalesce(_tokens(F.col(held)), F.array())), lambda t: F.element_at(filed, t)),
            lambda r: r.isNotNull(),
        )
    )
    rows = rows.withColumn(site, F.concat("host", F.lit("?"), "path")).withColumn(seen, F.coalesce(F.col(held), F.lit("")))
    rows = rows.withColumn(
        hits, F.filter(fetched, lambda r: F.rlike(F.when(r["kind"] == "site", F.col(site)).otherwise(F.col(seen)), r["regex"]))
    )
    sites_hit = F.filter(hits, lambda r: r["kind"] == "site")
    patterns_hit = F.filter(hits, lambda r: r["kind"] == "pattern")
    longest = F.array_max(F.transform(sites_hit, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    first = F.array_max(F.transform(patterns_hit, lambda r: F.struct(r["verdict"].alias("verdict"), r["rule"].alias("rule"))))
    return rows.withColumn(names[0], longest).withColumn(names[1], first).drop(site, seen, hits)
