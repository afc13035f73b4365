"""Search queries."""

import math
import uuid

from pyspark.sql import functions as F

from ..operators import render, search, terms, vectors
from ..plans.derived import RAW_CTE
from ..session import shared_folder
from .registry import query, table
from .scalar import document_rows, document_sql

# the searching user's text and vector
WORDS = "the reading of ionen"
DIM = 64
Q = [round(math.cos(0.37 * i) * 0.5 + ((i * 29) % 17 - 8) / 40, 4) for i in range(DIM)]
Q_SQL = "[" + ", ".join(str(e) for e in Q) + "]::DOUBLE[]"
TERMS = search.query_terms(WORDS)


def bm25_sql(src, key, content):
    tf = ", ".join(f"len(list_filter(t, lambda w: w = '{w}')) AS tf{i}" for i, w in enumerate(TERMS))
    df = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(TERMS)))
    parts = " + ".join(
        f"CASE WHEN tf{i} > 0 THEN ln(1 + (n - df{i} + 0.5::DOUBLE) / (df{i} + 0.5::DOUBLE)) * tf{i} * 2.2::DOUBLE "
        f"/ (tf{i} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl)) ELSE 0 END" for i in range(len(TERMS)))
    return (
        rf"tok AS (SELECT {key} AS k, list_filter(string_split_regex(lower({content}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS t FROM {src}), "
        f"cnt AS (SELECT k, len(t) AS dl, {tf} FROM tok), st AS (SELECT count(*) AS n, avg(dl) AS avgdl, {df} FROM cnt), "
        f"bm AS (SELECT k, {parts} AS score FROM cnt, st)"
    )


COS = f"list_cosine_similarity(embedding::DOUBLE[], {Q_SQL})"


@query("v01_build_documents", RAW_CTE + f""", house AS ({document_sql("full")})
SELECT id, NULL::VARCHAR AS parent_id, document AS content, 'search_document: ' || document AS to_embed FROM house
UNION ALL SELECT id || '-desc', id, description, 'search_document: ' || description FROM raw WHERE price IS NOT NULL AND length(description) > 10""")
def _(spark, d):
    return search.build_documents(document_rows(spark, d).select("id", render.render_document("full").alias("content"), "description"))


@query("v02_pool_normalize", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS a, list_reverse(embedding::DOUBLE[]) AS b, label % 2 AS m FROM embeddings),
p AS (SELECT vec_id, list_transform(range(1, len(a) + 1), lambda i: (a[i] + b[i] * m) / (1 + m)) AS v FROM e)
SELECT vec_id, unnest(range(len(v))) AS pos, round(unnest(v), 6) AS pooled,
round(unnest(v) / greatest(sqrt(list_sum(list_transform(v, lambda x: x * x))), 1e-12::DOUBLE), 6) AS unit FROM p""")
def _(spark, d):
    e = table(spark, d, "embeddings").select(
        "vec_id", F.array("embedding", F.reverse("embedding")).cast("array<array<double>>").alias("t"),
        F.array(F.lit(1.0), (F.col("label") % 2).cast("double")).alias("m"))
    p = e.select("vec_id", search.mean_pool("t", "m").alias("v")).withColumn("u", search.l2_normalize("v"))
    each = p.select("vec_id", F.posexplode(F.arrays_zip("v", "u")).alias("pos", "e"))
    return each.select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("e.v", 6).alias("pooled"), F.round("e.u", 6).alias("unit"))


@query("v02b_group_mean", """
SELECT label, pos, round(avg(e), 6) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS e, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY ALL""")
def _(spark, d):
    means = search.group_mean_vectors(table(spark, d, "embeddings"), ["label"], "embedding")
    out = means.select("label", F.posexplode("embedding").alias("pos", "m"))
    return out.select("label", F.col("pos").cast("long").alias("pos"), F.round("m", 6).alias("m"))


# every element of every vector that is not zero; a word's hash is a polynomial over its bytes
@query("v03_embed", r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents),
b AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM w)),
h AS (SELECT word, list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length(x) // 2 + 1), lambda i: CAST('0x' || substr(x, 2 * i - 1, 2) AS BIGINT))),
  lambda p, q: (p * 31 + q) % 1000003) AS h FROM b),
c AS (SELECT doc_id, h % 64 AS pos, CAST(sum(CASE WHEN (h // 64) % 2 = 0 THEN 1 ELSE -1 END) AS DOUBLE) AS n FROM w JOIN h USING (word) GROUP BY ALL)
SELECT doc_id, pos, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 6) AS element FROM c QUALIFY n <> 0""")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    each = search.embed(docs, "text").select("doc_id", F.posexplode("embedding").alias("pos", "e")).filter("e <> 0")
    return each.select("doc_id", F.col("pos").cast("long").alias("pos"), F.round("e", 6).alias("element"))


_TERM_TABLES: dict[tuple[str, str], str] = {}


def term_table(spark, d):
    """Folder with the term table of the documents, built once per session and input."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _TERM_TABLES:
        path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        terms.build_terms(table(spark, d, "documents"), path, "doc_id", "text")
        _TERM_TABLES[key] = path
    return _TERM_TABLES[key]


@query("v04a_term_table", r"""
SELECT term, id, count(*) AS tf, len FROM (SELECT doc_id AS id, len(t) AS len, unnest(t) AS term FROM (
SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS t FROM documents)) GROUP BY ALL""")
def _(spark, d):
    return spark.read.parquet(f"{term_table(spark, d)}/postings").select("term", "id", "tf", "len")


@query("v04_bm25", f"WITH {bm25_sql('documents', 'doc_id', 'text')} SELECT k AS id, round(score, 6) AS score FROM bm ORDER BY bm.score DESC, k LIMIT 3")
def _(spark, d):
    return terms.bm25_terms(spark, term_table(spark, d), WORDS).select("id", F.round("score", 6).alias("score"))


@query("v04b_bm25_all_scores", f"WITH {bm25_sql('documents', 'doc_id', 'text')} SELECT k AS id, round(score, 6) AS score FROM bm WHERE bm.score > 0")
def _(spark, d):
    return terms.bm25_terms(spark, term_table(spark, d), WORDS, k=None).select("id", F.round("score", 6).alias("score"))


@query("v04c_bm25_without_table", f"WITH {bm25_sql('documents', 'doc_id', 'text')} SELECT k AS id, round(score, 6) AS score FROM bm ORDER BY bm.score DESC, k LIMIT 3")
def _(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    return search.bm25(docs, WORDS).select("id", F.round("score", 6).alias("score"))


# every third document replaced by the text of another, every fifth taken out, after the table was built
@query("v04d_updated_terms", r"""
WITH now AS (SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN left(text, 40) || ' the new text' ELSE text END AS text FROM documents WHERE doc_id % 5 <> 0)
SELECT term, id, count(*) AS tf, len FROM (SELECT id, len(t) AS len, unnest(t) AS term FROM (
SELECT id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS t FROM now)) GROUP BY ALL""")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    terms.build_terms(docs, path, "doc_id", "text")
    k = F.col("doc_id")
    now = docs.withColumn("text", F.when(k % 3 == 0, F.concat(F.left("text", F.lit(40)), F.lit(" the new text"))).otherwise(F.col("text")))
    terms.update_terms(now.filter(k % 5 != 0), path, docs.filter(k % 5 == 0).select("doc_id"), "doc_id", "text")
    return spark.read.parquet(f"{path}/postings").select("term", "id", "tf", "len")


@query("v05_knn", f"SELECT vec_id AS id, round({COS}, 6) AS score FROM embeddings ORDER BY {COS} DESC, vec_id LIMIT 3")
def _(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return search.knn(e, Q).select("id", F.round("score", 6).alias("score"))


def indexed(spark, d):
    """All documents, those that have one with a vector; every odd one hangs below the even one before it."""
    docs = table(spark, d, "documents").select("doc_id", F.col("text").alias("content"))
    vecs = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    k = F.col("doc_id")
    return docs.join(vecs, "doc_id", "left").select(
        F.concat(F.lit("hos"), k).alias("id"), F.when(k % 2 == 1, F.concat(F.lit("hos"), k - 1)).alias("parent_id"),
        "content", "embedding", "label")


INDEX = """doc AS (SELECT 'hos' || doc_id AS id, CASE WHEN doc_id % 2 = 1 THEN 'hos' || (doc_id - 1) END AS parent_id, text AS content, embedding, label
FROM documents LEFT JOIN embeddings ON doc_id = vec_id)"""
HITS = f"""hit AS (SELECT * FROM (SELECT doc.id, doc.parent_id, 'bm25' AS source, score FROM bm JOIN doc ON k = doc.id WHERE score > 0 ORDER BY score DESC, k LIMIT 3)
UNION SELECT * FROM (SELECT id, parent_id, 'embedding' AS source, {COS} AS score FROM doc_in WHERE embedding IS NOT NULL ORDER BY score DESC, id LIMIT 3))"""


def keywords(spark, d):
    """Keyword search over the stored term table, under the ids of `indexed`."""
    path = term_table(spark, d)
    return lambda text, k, within: terms.bm25_terms(spark, path, text, k, within, F.concat(F.lit("hos"), "id"))


@query("v06_hybrid_search", f"WITH {INDEX}, doc_in AS (FROM doc), {bm25_sql('doc_in', 'id', 'content')}, {HITS} SELECT id, parent_id, source, round(score, 6) AS score FROM hit")
def _(spark, d):
    return search.hybrid_search(indexed(spark, d), WORDS, Q, keywords=keywords(spark, d)).withColumn("score", F.round("score", 6))


@query("v06b_hybrid_with_image", f"""WITH {INDEX}, doc_in AS (SELECT * FROM doc WHERE id IN (SELECT 'hos' || doc_id FROM labels WHERE quality = 1)),
{bm25_sql('doc_in', 'id', 'content')}, {HITS} SELECT id, parent_id, source, round(score, 6) AS score FROM hit""")
def _(spark, d):
    images = table(spark, d, "labels").filter("quality = 1").select(F.concat(F.lit("hos"), "doc_id").alias("parent_id"))
    return search.hybrid_search(indexed(spark, d), WORDS, Q, images=images, keywords=keywords(spark, d)).withColumn("score", F.round("score", 6))


@query("v07_image_search", f"""
WITH h AS (SELECT vec_id AS id, 'hos' || label AS parent_id, {COS} AS score FROM embeddings ORDER BY score DESC, id LIMIT 12)
SELECT id, parent_id, 'embedding' AS source, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY score DESC, id) AS r FROM h) WHERE r = 1""")
def _(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.concat(F.lit("hos"), "label").alias("parent_id"), "embedding")
    return search.image_search(e, Q, 12).withColumn("score", F.round("score", 6))


@query("v08_search_documents", f"""WITH RECURSIVE {INDEX}, doc_in AS (FROM doc), {bm25_sql('doc_in', 'id', 'content')}, {HITS},
ids AS (SELECT id FROM (SELECT replace(unnest([id, parent_id]), '-desc', '') AS id, score FROM hit) WHERE id IS NOT NULL GROUP BY id ORDER BY max(score) DESC, id LIMIT 5),
rel AS (SELECT id FROM doc WHERE id IN (SELECT id FROM ids) UNION SELECT doc.id FROM doc JOIN rel ON rel.id = doc.parent_id)
SELECT id, md5(content) AS digest FROM doc WHERE id IN (SELECT id FROM rel) AND length(content) > 50""")
def _(spark, d):
    return search.search_documents(indexed(spark, d), WORDS, Q, keywords=keywords(spark, d)).select("id", F.md5("content").alias("digest"))


@query("v09_house_images", """
SELECT 'hos' || l_orderkey || '/' || l_linenumber || '-' || l_partkey || '.jpg' AS file_path FROM lineitem WHERE l_orderkey = 77""")
def _(spark, d):
    li = table(spark, d, "lineitem")
    house = F.concat(F.lit("hos"), "l_orderkey")
    images = li.select(
        house.alias("parent_id"), F.concat(house, F.lit("/"), "l_linenumber", F.lit("-"), "l_partkey", F.lit(".jpg")).alias("file_path"))
    return search.house_images(images, "hos77-desc")


_VECTOR_TABLES: dict[tuple[str, str], str] = {}


def vector_table(spark, d):
    """Folder with the vector partitions of the embeddings, built once per session and input."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _VECTOR_TABLES:
        path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        vectors.build_vectors(table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label"), path)
        _VECTOR_TABLES[key] = path
    return _VECTOR_TABLES[key]


# seeded, so approximate hits are the same every time; here they are the exact ones
EXACT = f"SELECT vec_id AS id, round({COS}, 6) AS score FROM embeddings ORDER BY {COS} DESC, vec_id LIMIT 3"


@query("v10_ann", EXACT)
def _(spark, d):
    return vectors.nearest(spark, vector_table(spark, d), Q).select("id", F.round("score", 6).alias("score"))


@query("v10a_vector_table", "SELECT vec_id AS id, label, round(list_sum(embedding::DOUBLE[]), 6) AS total, len(embedding) AS dim FROM embeddings")
def _(spark, d):
    rows = spark.read.parquet(f"{vector_table(spark, d)}/vectors")
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda s, e: s + e)
    return rows.select("id", "label", F.round(total, 6).alias("total"), F.size("embedding").cast("long").alias("dim"))


@query("v10b_projections", EXACT)
def _(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return search.ann(e, Q).select("id", F.round("score", 6).alias("score"))


# the index of all documents after a second run in which every fourth has a new text and every seventh is gone
@query("v11_refreshed_index", r"""
SELECT doc_id AS id, md5(text) AS digest, CAST(list_unique(t) AS BIGINT) AS terms, len(t) AS len FROM (SELECT doc_id, text,
list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS t FROM (
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'baru: ' || coalesce(text, '') ELSE coalesce(text, '') END AS text FROM documents WHERE doc_id % 7 <> 0))""")
def _(spark, d):
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("content"))
    ready = lambda df: df.withColumn("to_embed", F.concat(F.lit(search.PREFIX), "content"))
    vectors.refresh_index(ready(docs), path)
    text = F.when(F.col("id") % 4 == 0, F.concat(F.lit("baru: "), "content")).otherwise(F.col("content"))
    vectors.refresh_index(ready(docs.filter("id % 7 <> 0").withColumn("content", text)), path, whole=True)
    found = spark.read.parquet(f"{path}/terms/postings").groupBy("id").agg(F.count(F.lit(1)).alias("terms"))
    rows = spark.read.parquet(f"{path}/vectors/vectors").select("id", F.md5("content").alias("digest"))
    size = spark.read.parquet(f"{path}/terms/documents").select("id", "len")
    return rows.join(size, "id").join(found, "id", "left").select("id", "digest", F.coalesce("terms", F.lit(0)).alias("terms"), "len")
