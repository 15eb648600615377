"""DuckDB SQL for the registered queries of this package that SQL can express."""

from __future__ import annotations

from gaugeline.llm import minhash, secrets, url_rules

CASES = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return text.replace("'", "''")


def _span_sql() -> str:
    """One row per finding: doc_id, kind, nr, s (start), e (end)."""
    parts = []
    for nr, rule in enumerate(secrets.RULES):
        regex = _quoted(rule.regex)
        parts.append(f"""
          SELECT doc_id, '{rule.kind}' AS kind, {nr} AS nr, e - length(m) AS s, e
          FROM (SELECT doc_id, m, g, sum(length(p) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e
                FROM (SELECT doc_id, unnest(regexp_extract_all(t, '{regex}', 0)) AS m,
                             unnest(regexp_extract_all(t, '{regex}', {rule.group})) AS g,
                             unnest(string_split_regex(t, '{regex}')[:-2]) AS p,
                             unnest(range(len(regexp_extract_all(t, '{regex}', 0)))) AS i
                      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))
          WHERE length(g) >= {rule.least}
        """)
    return " UNION ALL ".join(parts)


_BASE = len(secrets.BASE)

SECRETS = f"""
  WITH found AS ({_span_sql()}),
       texts AS (SELECT doc_id, string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, nr) AS spans,
                        string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, nr) FILTER (nr < {_BASE}) AS base,
                        {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)}
                 FROM found GROUP BY doc_id)
  SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)},
         sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
  FROM documents d LEFT JOIN texts USING (doc_id)
"""


def url_sql(sites: tuple[tuple[str, str], ...]) -> str:
    rules, verdicts = [], []
    for verdict, rule in sorted(sites, key=lambda r: -len(r[1])):
        host, _, path = rule.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"
        rules.append(f"WHEN {fits} THEN '{rule}'")
        verdicts.append(f"WHEN {fits} THEN '{verdict}'")
    blocked = " OR ".join(
        f"""regexp_matches(coalesce(url, ''), '{".*".join(p.replace(".", "[.]") for p in rule.split("*"))}', 's')"""
        for verdict, rule in url_rules.PATTERNS
    )
    return f"""
      SELECT page_id, host, path, CASE {" ".join(rules)} END AS rule,
             CASE {" ".join(verdicts)} WHEN {blocked} THEN 'block' ELSE 'allow' END AS verdict
      FROM (SELECT page_id, url, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {CASES}) AS host,
                   coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages)
    """


NEAR_DUPLICATES = f"""
  WITH RECURSIVE words AS (
         SELECT doc_id, {WORDS.format(text=f"translate(coalesce(text, ''), {CASES})")} AS w FROM documents),
       shingles AS (
         SELECT DISTINCT doc_id, s
         FROM (SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                          ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
               FROM words WHERE len(w) > 0)),
       sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
       shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
                  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
       links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                 WHERE 100 * c >= {minhash.LEAST} * (x.n + y.n - c)),
       reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
                 UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
       least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
  SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
  FROM documents d JOIN least ON a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

TOP_K = """
  WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
             FROM embeddings WHERE embedding IS NOT NULL),
       pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
                 FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
  SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
  WHERE r <= 5
"""

MIX = """
  WITH sized AS (
         SELECT doc_id, source, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS size,
                len(regexp_extract_all(t, '[^\\p{L}\\x20\\x09-\\x0D.,]+')) AS odd,
                CAST('0x' || substr(md5(doc_id || ':0'), 1, 13) AS BIGINT) AS bits
         FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)),
       keyed AS (
         SELECT doc_id, source, size,
                -ln((bits + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))
                / greatest(CAST(0.05 AS DOUBLE), 1 - CASE WHEN size > 0 THEN CAST(odd AS DOUBLE) / size ELSE 1.0 END) AS key
         FROM sized),
       sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
                   FROM keyed GROUP BY source),
       levels AS (SELECT *, CAST(sum(n) OVER () - 3 * coalesce(sum(n) OVER before, 0) AS DOUBLE)
                            / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
                  FROM sources WINDOW before AS (ORDER BY CAST(n AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
       last AS (SELECT level AS final FROM levels WHERE level * w <= 3 * n ORDER BY CAST(n AS DOUBLE) / w, source NULLS LAST LIMIT 1),
       targets AS (SELECT source, n, least(CAST(3 * n AS DOUBLE), coalesce(final * w, CAST(3 * n AS DOUBLE))) AS target
                   FROM levels LEFT JOIN last ON true),
       rests AS (SELECT *, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS epochs FROM targets)
  SELECT doc_id, size, n AS source_size, target,
         size * (epochs + CASE WHEN target - epochs * n > 0
                                AND sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size / 2.0
                                    <= target - epochs * n THEN 1 ELSE 0 END) AS taken
  FROM keyed k JOIN rests r ON k.source IS NOT DISTINCT FROM r.source
"""

FREQUENT_LINES = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
keyed AS (
  SELECT r, place, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM placed),
frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10),
marked AS (SELECT keyed.*, frequent.k IS NOT NULL AS gone FROM keyed LEFT JOIN frequent ON keyed.k = frequent.k),
joined AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM docs JOIN joined USING (r)
"""
