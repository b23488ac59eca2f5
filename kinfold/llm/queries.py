"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import (
    byte_bpe,
    centroids,
    embed_dedup,
    packing,
    pii,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    token_count,
    topk,
    toxicity,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digest_documents(_table(spark, sf_dir, "documents"), path)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), path)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(_table(spark, sf_dir, "documents"), path)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.fingerprints(_table(spark, sf_dir, "documents"))
    return simhash.near_duplicates(marked).select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op9_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_url_filter": op2_url_filter,
    "op3_token_counts": op3_token_counts,
    "op4_pii": op4_pii,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_secret_scan": op8_secret_scan,
    "op9_embed_dedup": op9_embed_dedup,
    "op10_topk": op10_topk,
    "op11_centroids": op11_centroids,
    "op12_toxicity": op12_toxicity,
    "op13_prefix_trie": op13_prefix_trie,
}

# Aliases by a recursive walk over the links in the html, in the dialect of DuckDB.
OP2_SQL = r"""
WITH RECURSIVE
parts AS (
  SELECT page_id, url, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(rule_host, rule_path, said) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
tags AS (
  SELECT url, regexp_extract(unnest(regexp_extract_all(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')), '(?i)\bhref\s*=\s*["'']?([^"''\s>]*)', 1) AS target FROM pages WHERE url LIKE '%://%'
  UNION ALL
  SELECT url, regexp_extract(unnest(regexp_extract_all(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')), '(?i)\burl\s*=\s*["'']?([^"''\s>]*)', 1) FROM pages WHERE url LIKE '%://%'),
full_targets AS (
  SELECT url, CASE
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN t LIKE '//%' THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
    WHEN t LIKE '/%' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t
    WHEN t LIKE '?%' THEN regexp_extract(url, '(?s)^(.*?://[^?#]*)', 1) || t
    WHEN t LIKE '#%' THEN url
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || coalesce(nullif(regexp_extract(url, '(?s)^.*?://[^/?#]*((?:/[^?#]*/|/)?)', 1), ''), '/') || t END AS target
  FROM (SELECT url, replace(target, '&amp;', '&') AS t FROM tags WHERE target <> '')),
bare AS (
  SELECT regexp_extract(url, '(?s)^\s*([^#]*)', 1) AS a, regexp_extract(target, '(?s)^\s*([^#]*)', 1) AS b FROM full_targets WHERE target LIKE '%://%'),
links AS (
  SELECT lower(regexp_extract(a, '(?s)^(.*?://[^/?]*)', 1)) || substr(a, length(regexp_extract(a, '(?s)^(.*?://[^/?]*)', 1)) + 1) AS a,
         lower(regexp_extract(b, '(?s)^(.*?://[^/?]*)', 1)) || substr(b, length(regexp_extract(b, '(?s)^(.*?://[^/?]*)', 1)) + 1) AS b
  FROM bare),
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, a FROM ends UNION SELECT reach.a, ends.b FROM reach JOIN ends ON ends.a = reach.b),
ruled AS (
  SELECT node, arg_max(said, length(rule_host) + length(rule_path)) AS said
  FROM (SELECT DISTINCT a AS node, lower(regexp_extract(a, '(?s)^.*?://([^/?#]*)', 1)) AS host, regexp_extract(a, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM ends), rules
  WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY node),
aliased AS (
  SELECT reach.a AS node FROM reach JOIN ruled ON ruled.node = reach.b GROUP BY 1 HAVING bool_or(said = 'block') AND NOT bool_or(said = 'allow')),
own AS (
  SELECT page_id, url, host, path, arg_max(rule_host || rule_path, length(rule_host) + length(rule_path)) AS rule, arg_max(said, length(rule_host) + length(rule_path)) AS said
  FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, url, host, path),
keyed AS (SELECT *, regexp_extract(url, '(?s)^\s*([^#]*)', 1) AS plain FROM own)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN aliased.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed LEFT JOIN aliased ON aliased.node = lower(regexp_extract(plain, '(?s)^(.*?://[^/?]*)', 1)) || substr(plain, length(regexp_extract(plain, '(?s)^(.*?://[^/?]*)', 1)) + 1)
"""

_USABLE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP9_SQL = f"""
WITH RECURSIVE
usable AS (
  SELECT row_number() OVER () AS n, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND {_USABLE}),
vectors AS (SELECT *, sqrt(list_inner_product(e, e)) AS length FROM usable WHERE list_inner_product(e, e) > 0),
links AS (
  SELECT a.n AS a, b.n AS b, a.vec_id AS id, b.vec_id AS other FROM vectors a JOIN vectors b ON a.label = b.label AND a.n <> b.n AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.length * b.length) >= 0.98),
reach(a, b) AS (SELECT a, a FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
counted AS (SELECT id, count(*) AS n_links FROM links GROUP BY id),
least AS (SELECT s.vec_id AS id, min(t.vec_id) AS component FROM reach JOIN vectors s ON s.n = reach.a JOIN vectors t ON t.n = reach.b GROUP BY 1)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component, e.vec_id) AS component_id, coalesce(component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted ON counted.id = e.vec_id LEFT JOIN least ON least.id = e.vec_id
"""

OP10_SQL = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM scores)
SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM ranked WHERE nth <= 10
"""

_OP8_KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", "secret"),
    "access": ("AKIA[A-Z0-9]+", "identifier"),
    "hex": ("[0-9a-f]{32,}", "secret"),
    "identifier": (r"""(?i:client|access|account|user)[_-]?(?i:key[_-]?)?(?i:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{4,}""", "identifier"),
    "key": ("[A-Za-z0-9+/=_-]+", "secret"),  # whole runs; the length and the characters are tested below
    "endpoint": (r"(?i:https?|s3|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:@%/?#=&+-]+", "endpoint"),
}
_OP8_HITS = " UNION ALL ".join(
    f"SELECT n, {place} AS place, '{kind}' AS kind, '{role}' AS role, regexp_extract_all(t, '{quoted}') AS hits, string_split_regex(t, '{quoted}') AS gaps FROM d"
    for place, (kind, (pattern, role)) in enumerate(_OP8_KINDS.items(), 1)
    for quoted in [pattern.replace("'", "''")]
)
OP8_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_OP8_HITS}),
each_hit AS (SELECT n, place, kind, role, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, unnest(range(1, len(hits) + 1)) AS nth FROM found),
placed AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY n, kind ORDER BY nth) AS e FROM each_hit),
parts AS (
  SELECT n, place, kind, role, CAST(e - length(hit) AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed
  WHERE CASE kind WHEN 'assign' THEN length(regexp_extract(hit, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1)) >= 8
                  WHEN 'access' THEN length(hit) >= 16
                  WHEN 'key' THEN regexp_full_match(hit, '[A-Za-z0-9+/]{{40}}') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[a-z]')
                  ELSE TRUE END),
kept AS (
  SELECT *, place <= 3 AS base FROM parts
  WHERE place <= 3 OR EXISTS (SELECT 1 FROM parts o WHERE o.n = parts.n AND o.role <> parts.role
                              AND ('secret' IN (o.role, parts.role) OR o.place <= 3)
                              AND o.s <= parts.e + 256 AND o.e >= parts.s - 256)),
listed AS (
  SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         count(*) FILTER (NOT base) AS n_linked,
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (base), '') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans
  FROM kept GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM d LEFT JOIN listed USING (n)
"""

_NEAREST = "list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
_ROUNDS = centroids.ROUNDS
_OP11_ROUNDS = "".join(
    f""",
a{t} AS MATERIALIZED (SELECT n, min(CAST({_NEAREST} AS BIGINT) * 8 + k) AS best FROM v, c{t} c GROUP BY n),
s{t} AS (SELECT best % 8 AS k, place, sum(x) AS total, count(*) AS m
  FROM (SELECT best, unnest(e) AS x, unnest(range(64)) AS place FROM a{t} JOIN v USING (n)) GROUP BY 1, 2),
m{t} AS (SELECT k, list(CAST((total - ((total % m) + m) % m) // m AS BIGINT) ORDER BY place) AS e FROM s{t} GROUP BY k),
c{t + 1} AS MATERIALIZED (SELECT c{t}.k, coalesce(m{t}.e, c{t}.e) AS e FROM c{t} LEFT JOIN m{t} USING (k))"""
    for t in range(_ROUNDS)
)
# Every distance of every round; the cluster rides in the last digit (base 8) of the smallest distance.
OP11_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE {_USABLE} AND len(embedding) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), e) - 1 AS k, e FROM v WHERE vec_id IS NOT NULL
  ORDER BY sha256('3:' || vec_id), e LIMIT 8){_OP11_ROUNDS},
last AS MATERIALIZED (SELECT n, min(CAST({_NEAREST} AS BIGINT) * 8 + k) AS best FROM v, c{_ROUNDS} c GROUP BY n),
found AS (SELECT n, best % 8 AS k, best // 8 AS distance FROM last),
named AS (SELECT k, sha256(array_to_string(e, ',')) AS digest FROM c{_ROUNDS})
SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM found JOIN v USING (n) JOIN named USING (k)
"""

# crc32 bit by bit; subtree sums over all nodes below each node of the conversation that names them.
OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, max(i) AS n,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, e: xor(xor(a, e) >> 1, 3988292384::BIGINT * (xor(a, e) & 1))), 4294967295::BIGINT) % 4 AS h
  FROM t GROUP BY conv_id),
l AS (SELECT c.*, c.conv_id - c.conv_id % 20 AS base_id, least(c.h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20),
r AS (
  SELECT l.conv_id, t.i AS d, mark, text FROM l JOIN t ON t.conv_id = base_id AND t.i <= taken
  UNION ALL SELECT l.conv_id, taken + t.i - h, mark, text FROM l JOIN t ON t.conv_id = l.conv_id AND t.i > h),
p AS (
  SELECT conv_id, d, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, sha256(array_to_string(list(mark) OVER (PARTITION BY conv_id ORDER BY d), ',')) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM l),
m AS (SELECT *, min(conv_id) OVER (PARTITION BY d, key) AS node FROM p),
lengths AS (SELECT conv_id, max(d) AS length FROM p GROUP BY conv_id),
nodes AS (
  SELECT node AS conv_id, d, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
    coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (d = length), '') AS ended
  FROM m JOIN lengths USING (conv_id) GROUP BY node, d),
linked AS (SELECT nodes.*, m.node AS parent FROM nodes LEFT JOIN m ON m.conv_id = nodes.conv_id AND m.d = nodes.d - 1),
children AS (SELECT parent AS conv_id, d - 1 AS d, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN children USING (conv_id, d)),
sums AS (
  SELECT m.node AS conv_id, m.d, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(u.saved) AS saved_tokens
  FROM m JOIN full_nodes u ON u.conv_id = m.conv_id AND u.d >= m.d GROUP BY 1, 2)
SELECT conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ended) AS ends_sha256
FROM full_nodes JOIN sums USING (conv_id, d)
"""

ORACLES: dict[str, str] = {"op13_prefix_trie": OP13_SQL, "op11_centroids": OP11_SQL, "op2_url_filter": OP2_SQL, "op8_secret_scan": OP8_SQL, "op9_embed_dedup": OP9_SQL, "op10_topk": OP10_SQL}
