"""The queries of this package: one per operator and the pipeline, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontaminate, hardneg, linefreq, packing, pii, quality, repeats, simhash, stripes, toxicity, urls
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.maximal(table(spark, sf_dir, "conversations"))


ORACLE["op1_chat"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
         count(*) OVER (PARTITION BY conv_id) AS turns FROM conversations
), p AS (
  SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS segment,
         md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, ';') OVER (PARTITION BY conv_id ORDER BY place)) AS prefix FROM t
), firsts AS (
  SELECT prefix, min(conv_id) AS conv_id FROM p WHERE place = turns GROUP BY prefix
), kept AS (
  SELECT conv_id FROM firsts WHERE prefix NOT IN (SELECT prefix FROM p WHERE place < turns)
)
SELECT conv_id, place - 1 AS turn_no, role, segment,
       CAST(sum(length(segment)) OVER (PARTITION BY conv_id ORDER BY place) - length(segment) AS BIGINT) AS "offset"
FROM p WHERE conv_id IN (SELECT conv_id FROM kept)
"""


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents"))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


# fixed values: the rules of the query, host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS t(host, path, verdict)")
    return urls.judge(table(spark, sf_dir, "pages"), rules)


ORACLE["op10_urls"] = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), cut AS (
  SELECT page_id, split_part(split_part(r, '#', 1), '?', 1) AS r FROM rest
), parts AS (
  SELECT page_id, translate(split_part(r, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         substr(r, length(split_part(r, '/', 1)) + 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


@query
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, noisy)


ORACLE["op11_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query
def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefreq.judge(table(spark, sf_dir, "documents"))


ORACLE["op12_lines"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, list_filter(regexp_split_to_array(text, '[ 	-]+'), lambda x: x <> '') AS words FROM d
), u AS (
  SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM w
), g AS (
  SELECT r, i, w, lead(w) OVER t AS w2, lead(w, 2) OVER t AS w3 FROM u WINDOW t AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) > 1 AND w3 IS NOT NULL AS twice FROM g
), rep AS (
  SELECT r, count(*) FILTER (twice OR coalesce(before, false) OR coalesce(before2, false)) AS n_repeat_words
  FROM (SELECT *, lag(twice) OVER t AS before, lag(twice, 2) OVER t AS before2 FROM again WINDOW t AS (PARTITION BY r ORDER BY i)) GROUP BY r
), l AS (
  SELECT r, host, line, list_filter(regexp_split_to_array(line, '[ 	-]+'), lambda x: x <> '') AS words
  FROM (SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM d)
), k AS (
  SELECT r, host, line, len(words) AS words,
         regexp_replace(translate(array_to_string(words, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g') AS norm
  FROM l WHERE len(words) > 0
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM k GROUP BY r
), hosts AS (
  SELECT host, count(DISTINCT (doc_id, text)) AS host_docs FROM d GROUP BY host
), freq AS (
  SELECT k.host, norm FROM k JOIN d USING (r) JOIN hosts ON hosts.host IS NOT DISTINCT FROM k.host
  GROUP BY k.host, norm, host_docs
  HAVING count(DISTINCT (doc_id, text)) > {linefreq.MIN_DOCS} AND count(DISTINCT (doc_id, text)) > {linefreq.MAX_SHARE}::DOUBLE * host_docs
), gone AS (
  SELECT r, CAST(sum(words) AS BIGINT) AS n_removed_words, count(*) AS n_removed_lines
  FROM k JOIN freq ON freq.host IS NOT DISTINCT FROM k.host AND freq.norm = k.norm GROUP BY r
), counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_removed_words, 0) AS n_removed_words, coalesce(n_removed_lines, 0) AS n_removed_lines
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND n_words - n_removed_words >= {linefreq.LEAST_LEFT}::DOUBLE * n_words AS kept
FROM counts
"""


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stripes.collocations(table(spark, sf_dir, "documents"))


ORACLE["op13_phrases"] = r"""
WITH p AS (
  SELECT row_number() OVER () AS p, lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS piece FROM documents)
), u AS (
  SELECT p, lang, unnest(words) AS w, unnest(range(len(words))) AS i FROM p
), g AS (
  SELECT lang, w, lead(w) OVER t AS w2, lead(w, 2) OVER t AS w3 FROM u WINDOW t AS (PARTITION BY p ORDER BY i)
), f1 AS (
  SELECT lang, w, count(*) AS f FROM g GROUP BY ALL
), f2 AS (
  SELECT lang, w, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (
  SELECT lang, w, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), n AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang
), above AS (
  SELECT lang, w, w2, max(f) AS above FROM (SELECT lang, w, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.w || ' ' || c.w2 AS phrase, 1 AS k, c.f AS a, x.f AS l, y.f AS r
  FROM f2 c LEFT JOIN above USING (lang, w, w2) JOIN f1 x ON x.lang = c.lang AND x.w = c.w JOIN f1 y ON y.lang = c.lang AND y.w = c.w2
  WHERE c.f >= 10 AND (above IS NULL OR 100 * above < 50 * c.f)
  UNION ALL
  SELECT c.lang, c.w || ' ' || c.w2 || ' ' || c.w3, 1, c.f, x.f, y.f
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w = c.w JOIN f2 y ON y.lang = c.lang AND y.w = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w || ' ' || c.w2 || ' ' || c.w3, 2, c.f, x.f, y.f
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w = c.w AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.w = c.w3
), scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored JOIN n USING (lang) QUALIFY rank <= 2000
"""
