"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import (
    ann_forest, bpe, conversations, hard_negatives, licenses, mixing, packing, quality, sharding, simhash, suffix_dedup,
    url_filter, vafile,
)
from tidemark.llm.common import table

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


@query()
def op7_sharding(spark, sf):
    weights = [(s, 1.0) for s in range(16)]
    return sharding.shard_documents(table(spark, sf, "documents"), weights, added=(16, 1.0))


@query("""
WITH rules(rhost, rpath, rverdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (
  SELECT page_id, row_number() OVER () AS n,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
raw AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS host0 FROM rest),
cut AS (
  SELECT page_id, n, translate(host0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(host0) + 1), '^[^?#]*') AS path
  FROM raw),
fit AS (
  SELECT n, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC, length(rhost) DESC,
                            rverdict DESC) AS place
  FROM cut JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM cut LEFT JOIN (SELECT * FROM fit WHERE place = 1) USING (n)
""")
def op8_url_filter(spark, sf):
    rules = url_filter.rule_table(spark, url_filter.RULES)
    return url_filter.url_filter(table(spark, sf, "pages"), rules)


@query()
def op4_nearest(spark, sf):
    return ann_forest.nearest(table(spark, sf, "embeddings"), every=100, k=10)


@query("""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.n <> q.n AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
""")
def op10_top_products(spark, sf):
    return vafile.top_products(table(spark, sf, "embeddings"), every=50, k=5)


@query()
def op3_byte_bpe(spark, sf):
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode_documents(table(spark, sf, "documents"), path, pattern, keep=False)


@query()
def op9_packing(spark, sf):
    import public_tokenizers

    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op2_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query()
def op1_suffix_dedup(spark, sf):
    return suffix_dedup.dedup(table(spark, sf, "documents"), keep=False)


@query()
def op5_quality(spark, sf):
    return quality.classify(table(spark, sf, "documents"))


@query()
def op6_licenses(spark, sf):
    return licenses.scan(table(spark, sf, "documents"), licenses.TEMPLATES)


@query("""
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT a.n, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.n <> c.n AND len(a.v) = len(c.v)),
pos AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS place FROM p WHERE same),
neg AS (
  SELECT pos.n, pos.place, pos.anchor_id, pos.vec_id AS positive_id, p.vec_id AS negative_id, pos.score AS positive_score,
         p.score AS negative_score, row_number() OVER (PARTITION BY pos.n, place ORDER BY p.score DESC, p.vec_id) AS rank
  FROM pos JOIN p ON pos.n = p.n AND NOT p.same AND place <= 5
   AND 50 * pos.score::HUGEINT <= 100 * p.score::HUGEINT AND 100 * p.score::HUGEINT <= 95 * pos.score::HUGEINT)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 3
""")
def op11_hard_negatives(spark, sf):
    rows = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


@query(r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS HUGEINT) AS w
  FROM d GROUP BY source),
r AS (  -- sources in the order in which they fill up; the first that does not sets the share
  SELECT s, w, s * 10 // w AS fill, 3 * sum(s) OVER () - 4 * (sum(s) OVER o - s) AS num,
         2 * (sum(w) OVER () - sum(w) OVER o + w) AS den, row_number() OVER o AS n
  FROM s WINDOW o AS (ORDER BY s * 10 // w, w, source ROWS UNBOUNDED PRECEDING)),
share AS (SELECT CAST(num AS HUGEINT) AS num, CAST(den AS HUGEINT) AS den FROM r WHERE 2 * s * den >= w * num ORDER BY n LIMIT 1),
t AS (
  SELECT source, s, CASE WHEN 2 * s * den < w * num THEN 2.0::DOUBLE * s ELSE w * (num::DOUBLE / den) END AS target, den,
         CASE WHEN 2 * s * den < w * num THEN 2 WHEN s = 0 THEN 0 ELSE w * num // (s * den) END AS times,
         CASE WHEN 2 * s * den < w * num OR s = 0 THEN 0 ELSE w * num - (w * num // (s * den)) * s * den END AS owed
  FROM s, share),
c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h) AS cum, sum(size) OVER (PARTITION BY source, h) AS here
  FROM d)
SELECT doc_id, c.source, size, CAST(s AS BIGINT) AS source_size, target,
       CAST(size * (times + CASE WHEN owed > 0 AND (2 * cum - here) * den <= 2 * owed THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
""")
def op12_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@query()
def op13_repair(spark, sf):
    whole = table(spark, sf, "conversations")
    return conversations.reports(conversations.damage(whole), whole)
