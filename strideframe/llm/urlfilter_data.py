"""Captures and dated lists that are derived from ``pages``, as DataFrames and as DuckDB SQL.

``pages`` has neither fetch times nor lists.  A page's fetch time is drawn from
one year by the hash of its id.  Of the hosts, their last two labels and their
first path segments, some are listed by hash; each gets up to four dated
entries over a year and a half that begins half a year earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions.hashing import hash32
from strideframe.llm import urlfilter

YEAR = 365 * 86_400
BEGIN = 1_704_067_200
#: share of the patterns that are listed, in 1/10000
LISTED = {"domain": 2000, "host": 2500, "prefix": 1500}


def captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", (F.lit(BEGIN) + hash32("page_id", "fetch") % YEAR).alias("fetched_at"))


def entries(pages: DataFrame) -> DataFrame:
    url = F.col("url")
    host = urlfilter.host_of(url)
    hosts = pages.select(host.alias("host"), F.regexp_extract(urlfilter.path_of(url), "^/([^/]+)", 1).alias("segment")).distinct()
    two = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    patterns = (
        hosts.select(F.lit("domain").alias("rule"), two.alias("pattern"))
        .unionByName(hosts.select(F.lit("host").alias("rule"), F.col("host").alias("pattern")))
        .unionByName(hosts.filter("segment <> ''").select(F.lit("prefix").alias("rule"), F.concat("host", F.lit("/"), "segment").alias("pattern")))
        .filter("pattern <> ''")
        .distinct()
    )
    share = F.create_map(*[F.lit(x) for kv in LISTED.items() for x in kv])
    name = F.concat("rule", F.lit("|"), "pattern")
    listed = patterns.filter(hash32(name, "listed") % 10_000 < share[F.col("rule")])
    dated = listed.select("rule", "pattern", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    name = F.concat("rule", F.lit("|"), "pattern", F.lit("|"), F.col("k").cast("string"))
    pick = hash32(name, "action") % 4
    return dated.filter(hash32(name, "has") % 10_000 < 7000).select(
        "rule",
        "pattern",
        F.when(pick < 2, "block").when(pick == 2, "allow").otherwise("remove").alias("action"),
        (F.lit(BEGIN - YEAR // 2) + hash32(name, "when") % (YEAR + YEAR // 2)).alias("listed_at"),
    )


def _hash(expr: str, seed: str) -> str:
    return f"(('0x' || substr(md5({expr} || ':{seed}'), 1, 8))::UBIGINT)::BIGINT"


def oracle_sql() -> str:
    """The whole query in DuckDB, as a plain interval join."""
    host = rf"nullif(regexp_replace(lower(regexp_extract(url, '{urlfilter.HOST}', 1)), '\.$', ''), '')"
    path = rf"regexp_replace(regexp_extract(url, '{urlfilter.PATH}', 1), '/+$', '')"
    share = " ".join(f"WHEN '{k}' THEN {v}" for k, v in LISTED.items())
    return rf"""
WITH p AS (SELECT page_id, url, {BEGIN} + {_hash("CAST(page_id AS VARCHAR)", "fetch")} % {YEAR} AS fetched_at, {host} AS host, {path} AS path FROM pages),
h AS (SELECT DISTINCT host, regexp_extract(path, '^/([^/]+)', 1) AS segment FROM p),
pat AS (
  SELECT 'domain' AS rule, regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS pattern FROM h
  UNION SELECT 'host', host FROM h
  UNION SELECT 'prefix', host || '/' || segment FROM h WHERE segment <> ''
),
listed AS (SELECT rule, pattern FROM pat WHERE pattern <> '' AND {_hash("rule || '|' || pattern", "listed")} % 10000 < CASE rule {share} END),
k AS (SELECT rule, pattern, rule || '|' || pattern || '|' || k AS name FROM listed, (SELECT unnest(range(4)) AS k)),
e AS (
  SELECT rule, pattern, CASE WHEN {_hash("name", "action")} % 4 < 2 THEN 'block' WHEN {_hash("name", "action")} % 4 = 2 THEN 'allow' ELSE 'remove' END AS action,
    {BEGIN - YEAR // 2} + {_hash("name", "when")} % {YEAR + YEAR // 2} AS listed_at
  FROM k WHERE {_hash("name", "has")} % 10000 < 7000
),
d AS (SELECT rule, pattern, listed_at, max(action) AS action FROM e GROUP BY ALL),
i AS (SELECT rule, pattern, action, listed_at AS valid_from, lead(listed_at) OVER (PARTITION BY rule, pattern ORDER BY listed_at) AS valid_to FROM d),
keys AS (
  SELECT page_id, url, fetched_at, 2 AS weight, 'host' AS rule, host AS pattern FROM p WHERE host IS NOT NULL
  UNION ALL
  SELECT page_id, url, fetched_at, 1, 'domain', array_to_string(labels[n:], '.') FROM (
    SELECT page_id, url, fetched_at, labels, unnest(range(1, len(labels) + 1)) AS n FROM (SELECT *, string_split(host, '.') AS labels FROM p WHERE host IS NOT NULL))
  UNION ALL
  SELECT page_id, url, fetched_at, 3, 'prefix', host || '/' || array_to_string(parts[1:n], '/') FROM (
    SELECT page_id, url, fetched_at, host, parts, unnest(range(1, len(parts) + 1)) AS n FROM (SELECT *, string_split(substr(path, 2), '/') AS parts FROM p WHERE host IS NOT NULL AND length(path) > 1))
),
m AS (
  SELECT c.*, i.action, i.valid_from, row_number() OVER (PARTITION BY c.page_id ORDER BY weight DESC, length(c.pattern) DESC) AS rank, count(*) OVER (PARTITION BY c.page_id) AS n_active
  FROM keys c JOIN i ON c.rule = i.rule AND c.pattern = i.pattern AND i.action <> 'remove' AND c.fetched_at >= i.valid_from AND (i.valid_to IS NULL OR c.fetched_at < i.valid_to)
)
SELECT p.page_id, p.url, p.fetched_at, m.rule, m.pattern, m.action AS verdict, m.valid_from, coalesce(m.n_active, 0) AS n_active, coalesce(m.action = 'block', false) AS blocked
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.rank = 1
"""
