"""Registered queries of the subpackage and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import audit, chat, decontaminate, langid, mixing, neardup, neighbours, pii, quality, secrets, shards, spherical, whitening

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_SQL["op4_decontaminate"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, p, p + least(10, len(w)) - 1) AS g
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT rid, n, p, list_slice(w, p, p + n - 1) AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p)),
hit AS (SELECT rid, p, n, item_id FROM pos JOIN win USING (n, g)),
marked AS (SELECT rid, count(DISTINCT q) AS n_hit
  FROM (SELECT DISTINCT rid, p, n FROM hit) AS h, unnest(range(p, p + n)) AS u(q) GROUP BY rid),
listed AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hit) AS i GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (rid) LEFT JOIN listed USING (rid)
"""


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


_SQL["op1_chat"] = """
WITH t AS (SELECT *, length(text) - length(replace(text, ' ', '')) + 1 AS words,
    row_number() OVER (PARTITION BY conv_id ORDER BY CAST('0x' || substr(md5(conv_id || ':' || turn), 1, 7) AS BIGINT)) AS event,
    lag(role) OVER p AS r1, lag(role, 2) OVER p AS r2, lag(turn) OVER p AS t1, lag(turn, 2) OVER p AS t2
  FROM conversations WINDOW p AS (PARTITION BY conv_id ORDER BY turn)),
k AS (SELECT *, coalesce((role = 'assistant' AND r1 = 'user' AND t1 = turn - 1)
    OR (role = 'user' AND r1 = 'assistant' AND t1 = turn - 1 AND r2 = 'user' AND t2 = turn - 2), false) AS follows,
    lag(event) OVER (PARTITION BY conv_id ORDER BY turn) AS e1 FROM t),
c AS (SELECT *, sum(CASE WHEN follows THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS chain,
    bool_or(follows AND e1 >= event) OVER (PARTITION BY conv_id) AS upset FROM k),
v AS (SELECT *, row_number() OVER (PARTITION BY conv_id, chain ORDER BY turn) AS depth, count(*) OVER (PARTITION BY conv_id, chain) AS links FROM c),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id
    ORDER BY CASE WHEN upset THEN CASE WHEN links > 1 THEN depth ELSE 0 END END, event) - 1 AS position FROM v),
a AS (SELECT o.*, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
    CASE role WHEN 'user' THEN 't' || turn WHEN 'assistant' THEN 't' || (turn - 1) END AS call_id,
    CASE WHEN words > 40 THEN 'long_reply' ELSE 'short_reply' END AS tool FROM o),
j AS (SELECT a.*, CAST(to_json(text) AS VARCHAR) AS quoted, p.conv_id IS NOT NULL AS answered, c.conv_id IS NOT NULL AS asked FROM a
  LEFT JOIN (SELECT conv_id, turn FROM conversations WHERE role = 'assistant') p ON a.conv_id = p.conv_id AND p.turn = a.turn + 1
  LEFT JOIN (SELECT conv_id, turn FROM conversations WHERE role = 'user') c ON a.conv_id = c.conv_id AND c.turn = a.turn - 1)
SELECT conv_id, turn, position, kind, call_id,
  CASE WHEN kind = 'call' AND NOT answered THEN 'open' WHEN kind = 'result' AND NOT asked THEN 'orphan' ELSE 'ok' END AS status,
  CASE WHEN kind = 'call' AND tool = 'short_reply' THEN 'unknown:n_words' ELSE '' END AS problems, false AS cyclic,
  CASE kind WHEN 'call' THEN '{"arguments":{"final":' || CAST(turn >= 4 AS VARCHAR) || ',"n_words":' || words || ',"prompt":' || quoted
      || '},"id":"' || call_id || '","role":"user","tool":"' || tool || '"}'
    WHEN 'result' THEN '{"content":' || quoted || ',"role":"assistant","tool_call_id":"' || call_id || '"}'
    ELSE '{"content":' || quoted || ',"role":"' || role || '"}' END AS json
FROM j
"""


@query
def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.materialise(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


_SQL["op7_mixing"] = r"""
WITH d AS (SELECT doc_id, coalesce('s' || source, 'z') AS src,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    left(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 16) AS k FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY src),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY src) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
    source_size * 2.0::DOUBLE AS cap FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY cap / w, src) AS pos FROM w),
l AS (SELECT pos, cap / w AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM r),
g AS (SELECT lev FROM l WHERE ratio >= lev ORDER BY pos LIMIT 1),
t AS (SELECT src, source_size, least(cap, (SELECT lev FROM g) * w) AS target FROM r),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
u AS (SELECT src, k, sum(size) AS words FROM d GROUP BY src, k),
c AS (SELECT src, k, words, coalesce(sum(words) OVER (PARTITION BY src ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u),
x AS (SELECT c.src, c.k FROM c JOIN e USING (src)
    WHERE before < target - whole * source_size AND before + words / 2 <= target - whole * source_size)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN x.k IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN e USING (src) LEFT JOIN x ON x.src = d.src AND x.k = d.k
"""


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query
def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


@query
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


_SQL["op10_neighbours"] = """
WITH d AS (SELECT q.vec_id AS query_id, v.vec_id,
    sqrt(list_reduce(list_transform(range(1, len(q.embedding) + 1),
      lambda i: (CAST(v.embedding[i] AS DOUBLE) - CAST(q.embedding[i] AS DOUBLE)) * (CAST(v.embedding[i] AS DOUBLE) - CAST(q.embedding[i] AS DOUBLE))),
      lambda a, b: a + b)) AS score
  FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


@query
def op12_spherical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spherical.groups(table(spark, sf_dir, "embeddings"))


_SQL["op12_spherical"] = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
ok AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS len FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0),
link AS (SELECT a.rid AS x, b.rid AS y FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.rid <> b.rid
  WHERE list_dot_product(a.e, b.e) / (a.len * b.len) >= 0.93),
reach AS (SELECT rid, rid AS there FROM v UNION SELECT r.rid, l.y FROM reach r JOIN link l ON l.x = r.there),
comp AS (SELECT r.rid, min(v.vec_id) AS component_id FROM reach r JOIN v ON v.rid = r.there GROUP BY r.rid),
deg AS (SELECT x AS rid, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN comp USING (rid) LEFT JOIN deg USING (rid)
"""


@query
def op13_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_SQL["op13_interactions"] = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, MAP {
    'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
    'C': 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > first, false)} AS fails
  FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS fs FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT array_to_string(fs, '') AS filter_order, step, fs[step] AS own, fs[1:step - 1] AS earlier FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
x AS (SELECT c.*, s.*, fails[own] AS failed, len(list_filter(earlier, lambda k: fails[k])) > 0 AS gone,
    len(list_filter(map_keys(fails), lambda k: fails[k])) = 1 AS single FROM c, s),
g AS (SELECT part, filter_order, step, any_value(own) AS own, sum(CASE WHEN NOT gone AND NOT failed THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN NOT gone AND failed THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone AND failed THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed AND single THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN NOT gone AND failed THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN NOT gone AND failed THEN toxic ELSE 0 END) AS toxic_lost FROM x GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
