"""Url verdicts against a plain reading of the rules."""

import random

import pandas as pd
import pytest

from gaugeline.llm import queries, url_rules

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain(url, sites, patterns):
    host, path = parts(url)
    best = None
    for verdict, rule in sites:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    if best:
        return host, path, *best
    hit = [v for v, rule in patterns if wild(rule, url or "")]
    return host, path, None, "block" if "block" in hit else "allow"


def wild(rule, text):
    import re

    return re.fullmatch(".*".join(map(re.escape, rule.split("*"))), text, re.S) is not None


URLS = [
    None, "", "nothing", "http://", "://org/", "http://ORG/x", "http://a.org", "http://a.org/", "http://aorg/", "http://x.example.org/es/1", "http://example.org/en/187", "http://example.org/en/2",
    "http://example.org/EN/1", "http://example.org/en/1#x://y", "ftp://fr.com/fr/?a=/de/", "http://b.com/de/x", "http://b.com/de", "http://b.com?/fr/", "http://b.com#/fr/", "https://www.spam-farm.example.net/en/1",
    "https://spam-farms.example.net/", "http://u:p@x.org:80/", "http://x.org:80/", "http://a.b c.org/es/", "http://é.org/", "http://x\n.org/\n", "http://t.net/doorway/1", "a://b://org/x", "http://x.net/" + "z" * 50000,
    "http://.org/", "http://org/", "http://org./", "http://example.org/es/?q", "HTTP://EXAMPLE.ORG/es/",
]


def test_query_on_a_table(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in queries.op4_url_rules(spark, SF).collect()}
    assert len(got) == len(pages)
    for p in pages.itertuples():
        r = got[p.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == plain(p.url, queries.SITES, url_rules.PATTERNS)


@pytest.mark.parametrize("way", ["literal", "broadcast", "shuffle"])
def test_odd_urls_and_columns(spark, monkeypatch, way):
    if way != "literal":
        monkeypatch.setattr(url_rules, "LITERAL_RULES", -1)
    if way == "shuffle":
        monkeypatch.setattr(url_rules, "RULE_BYTES", -1)
        monkeypatch.setattr(url_rules, "SALT_ROWS", 50)
    rng = random.Random(5)
    pieces = ["http://", "://", "/", "?", "#", ".", "org", "com", "example", "en", "es", "fr", "de", "1", "ORG", "spam-farm", "x"]
    urls = URLS + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(800)]
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, _url int")
    got = {r.page_id: r for r in url_rules.judge(df, queries.SITES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict) == plain(u, queries.SITES, url_rules.PATTERNS), repr(u)
        assert (r.url, r._url) == (u, 1)
    assert url_rules.judge(df.limit(0), queries.SITES).collect() == []
    assert {r.verdict for r in url_rules.judge(df, [], []).collect()} == {"allow"}


def test_rules_are_filed_under_their_rarest_certain_token(spark):
    df = spark.createDataFrame([("http://a.example.org/en/",)] * 3 + [("http://b.org/en/",)] * 2 + [("http://spam-farm.b.org/",)], "url string")
    index = url_rules.rule_index(df, [("block", "example.org/en/1"), ("allow", "org/")], [("block", "*spam-farm.*"), ("block", "*x*")], "url")
    assert {k: [r["rule"] for r in v] for k, v in index.items()} == {"example": ["example.org/en/1"], "org": ["org/"], "farm": ["*spam-farm.*"], "": ["*x*"]}


def test_a_hundred_thousand_rules(spark):
    """Far more rules than a plan holds, the common token `example` on most urls."""
    rng = random.Random(3)
    sites = [("block" if i % 2 else "allow", f"h{i}.example.net/{'a' * (i % 3)}") for i in range(100_000)] + [("allow", "example.net/")]
    urls = [f"http://x.h{rng.randrange(130_000)}.example.net/{'a' * rng.randint(0, 3)}" for _ in range(2000)] + ["http://other.org/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    by_host = {r.partition("/")[0]: (v, r) for v, r in sites}
    for r in url_rules.judge(df, sites, []).collect():
        host, path = parts(urls[r.page_id])
        fits = [by_host[h] for h in (host.partition(".")[2], "example.net") if h in by_host and host.endswith(h) and path.startswith("/" + by_host[h][1].partition("/")[2])]
        verdict, rule = max(fits, key=lambda f: len(f[1])) if fits else ("allow", None)
        assert (r.rule, r.verdict) == (rule, verdict)
