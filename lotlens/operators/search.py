"""Document index and retrieval: keyword, vector, hybrid, image, approximate."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import col
from ..session import written
from .aggregates import distinct_on
from .joins import related, with_any

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Suffix of description rows, prefix of embedded texts, term saturation and length weight.
CHILD = "-desc"
PREFIX = "search_document: "
K1, B = 1.2, 0.75


# -- index -------------------------------------------------------------------

def build_documents(listings: DataFrame, min_description: int = 10) -> DataFrame:
    """Rows (id, parent_id, content, to_embed): each listing, and its description when long enough.

    Input columns: id, content, description.
    """
    none = F.lit(None).cast("string")
    own = F.struct(F.col("id"), none.alias("parent_id"), F.col("content"))
    child = F.struct(
        F.concat("id", F.lit(CHILD)).alias("id"), F.col("id").alias("parent_id"), F.col("description").alias("content")
    )
    rows = F.when(F.length("description") > min_description, F.array(own, child)).otherwise(F.array(own))
    return listings.select(F.inline(rows)).withColumn("to_embed", F.concat(F.lit(PREFIX), "content"))


def mean_pool(tokens: Column | str, mask: Column | str) -> Column:
    """Mean of the token vectors whose mask is set (count clamped at 1e-9)."""
    kept = F.zip_with(col(tokens), col(mask), lambda t, m: F.transform(t, lambda e: e * m))
    zero = F.transform(F.get(col(tokens), F.lit(0)), lambda e: F.lit(0.0))
    total = F.aggregate(kept, zero, lambda a, t: F.zip_with(a, t, lambda p, q: p + q))
    n = F.greatest(F.aggregate(col(mask), F.lit(0.0), lambda a, m: a + m), F.lit(1e-9))
    return F.transform(total, lambda e: e / n)


def norm(vec: Column | str) -> Column:
    return F.sqrt(F.aggregate(col(vec), F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double")))


def l2_normalize(vec: Column | str) -> Column:
    vec = col(vec)
    return F.transform(F.arrays_zip(vec.alias("e"), F.array_repeat(F.greatest(norm(vec), F.lit(1e-12)), F.size(vec)).alias("n")),
                       lambda p: p["e"].cast("double") / p["n"])


def group_mean_vectors(df: DataFrame, keys: list[str], vec: str) -> DataFrame:
    """Mean vector per key; positions are averaged with map-side combine, so a hot key does not collect."""
    long = df.select(*keys, F.posexplode(vec).alias("pos", "e"))
    means = long.groupBy(*keys, "pos").agg(F.avg(F.col("e").cast("double")).alias("m"))
    packed = means.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("p"))
    return packed.select(*keys, F.transform("p", lambda p: p["m"]).alias(vec))


def hashed_vectors(texts: list[str], dim: int = 64) -> np.ndarray:
    """Default embedding for tests: signed hashed word counts; a word is hashed once per batch."""
    out = np.zeros((len(texts), dim))
    places: dict[str, tuple[int, float]] = {}
    for i, t in enumerate(texts):
        for w, n in Counter(re.findall(r"\w+", (t or "").lower())).items():
            if w not in places:
                h = 0
                for b in w.encode():
                    h = (h * 31 + b) % 1_000_003
                places[w] = h % dim, 1.0 if (h // dim) % 2 == 0 else -1.0
            at, sign = places[w]
            out[i, at] += sign * n
    return out


def embed(
    df: DataFrame, text: str, fn: Callable[[list[str]], np.ndarray] = hashed_vectors, out: str = "embedding"
) -> DataFrame:
    """Add unit vectors of `text` from a batch model `fn`, in Arrow batches that hold the texts only."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def vector(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            m = np.asarray(fn(texts.tolist()), dtype="float64").reshape(len(texts), -1)
            yield pd.Series(list(m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)), dtype=object)

    # else a filter on the vector would be moved below it and run the model a second time
    return df.withColumn(out, vector.asNondeterministic()(F.col(text)))


# -- keyword -----------------------------------------------------------------

def spaced_words(c: Column | str) -> Column:
    """Lower-cased words, each with a blank of its own on both sides."""
    words = F.trim(F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}]+", "  "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def times(spaced: Column, part: str) -> Column:
    """How often `part` occurs, by the length that removing it takes away."""
    return (F.length(spaced) - F.length(F.replace(spaced, F.lit(part), F.lit("")))) / len(part)


def query_terms(text: str) -> list[str]:
    return sorted(set(re.findall(r"[^\W_]+", text.lower())))


def bm25(docs: DataFrame, query: str, k: int | None = 3, content: str = "content", doc_id: str = "id") -> DataFrame:
    """Documents holding a query word: the k best in order (ties by id), or all when k is None.

    Term counts are taken inside each row and the collection statistics are one
    small aggregate used as a scalar, so nothing but the k best rows moves.
    """
    terms = query_terms(query)
    words = F.col("_t")
    counted = docs.withColumn("_t", spaced_words(content)).withColumns({
        "_len": F.when(F.length(words) > 2, times(words, "  ") + 1).otherwise(0.0),
        "_tf": F.array(*[times(words, f" {t} ") for t in terms]),
    }).drop("_t")
    tf = lambda i: F.col("_tf")[i]
    stats = counted.select(F.struct(
        F.count(F.lit(1)).alias("n"), F.avg("_len").alias("avg"),
        F.array(*[F.sum((tf(i) > 0).cast("long")) for i in range(len(terms))]).alias("df"),
    )).scalar()
    part = lambda i: (
        F.log(1 + (F.col("_s.n") - F.col("_s.df")[i] + 0.5) / (F.col("_s.df")[i] + 0.5))
        * tf(i) * (K1 + 1) / (tf(i) + K1 * (1 - B + B * F.col("_len") / F.col("_s.avg")))
    )
    score = F.lit(0.0)
    for i in range(len(terms)):
        score = score + F.when(tf(i) > 0, part(i)).otherwise(0.0)
    found = counted.withColumn("_s", stats).withColumn("score", score).drop("_s", "_tf", "_len")
    if k is not None:
        # the test comes after the cut: pushed to the scan it would score every text once more
        return found.orderBy(F.desc("score"), doc_id).limit(k).filter("score > 0")
    hit = F.explode(F.filter(F.array("score"), lambda s: s > 0)).alias("score")
    return found.select(*[c for c in found.columns if c != "score"], hit)


# -- vectors -----------------------------------------------------------------

def dot(vec: Column | str, q: Column) -> Column:
    return F.aggregate(F.zip_with(col(vec), q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, e: s + e)


def cosine(vec: Column | str, q: list[float]) -> Column:
    size = float(np.linalg.norm(np.asarray(q, dtype="float64")))
    lit = F.lit([float(e) for e in q])
    return dot(vec, lit) / (norm(vec) * F.lit(size))


def knn(vecs: DataFrame, q: list[float], k: int = 3, vec: str = "embedding", vec_id: str = "id") -> DataFrame:
    """The k most similar rows by cosine, ties by id: one scan, k rows per task kept."""
    return vecs.withColumn("score", cosine(vec, q)).orderBy(F.desc("score"), vec_id).limit(k)


def ann(
    vecs: DataFrame, q: list[float], k: int = 3, vec: str = "embedding", vec_id: str = "id",
    bucket: float = 1.0, tables: int = 8, over: int = 20, seed: int = 7,
) -> DataFrame:
    """Approximate neighbours by random projections of unit vectors, `over`*k candidates re-ranked exactly."""
    unit = Normalizer(inputCol="_v", outputCol="_u", p=2.0).transform(vecs.withColumn("_v", array_to_vector(col(vec).cast("array<double>"))))
    lsh = BucketedRandomProjectionLSH(inputCol="_u", outputCol="_h", bucketLength=bucket, numHashTables=tables, seed=seed).fit(unit)
    qv = np.asarray(q, dtype="float64")
    near = lsh.approxNearestNeighbors(unit, Vectors.dense(qv / np.linalg.norm(qv)), k * over)
    return knn(near.select(*vecs.columns), q, k, vec, vec_id)


# -- combined ----------------------------------------------------------------

def hybrid_search(
    docs: DataFrame, query: str, q: list[float], k: int = 3, images: DataFrame | None = None, per_image: bool = False,
    keywords: Callable[[str, int, DataFrame | None], DataFrame] | None = None,
) -> DataFrame:
    """Distinct union of keyword and vector hits (id, parent_id, source, score) over documents, whose `embedding` may be NULL.

    With `images` only documents having an image take part, once, or once per
    image when `per_image` is set. `keywords` (query, k, ids that count or None for
    all) gives (id, score) from a stored term table; without it the texts are read.
    """
    hit = lambda df, source: df.select("id", "parent_id", F.lit(source).alias("source"), "score")
    named = docs.select("id", "parent_id")
    # vectors become scores where they are, so that none moves to the join with the images
    scored = docs.filter("embedding IS NOT NULL").select("id", "parent_id", cosine("embedding", q).alias("score"))
    if images is not None:
        having = lambda df: with_any(df, "id", images, "parent_id", keep_duplicates=per_image)
        # the keyword statistics, postings and hits all read the ids that count
        docs, scored, named = having(docs), having(scored), written(having(named))
    if keywords is None:
        words = bm25(docs.select("id", "parent_id", "content"), query, k)
    else:
        words = keywords(query, k, None if images is None else named).join(named, "id")
    near = scored.orderBy(F.desc("score"), "id").limit(k)
    return hit(words, "bm25").union(hit(near, "embedding")).distinct()


def image_search(images: DataFrame, q: list[float], k: int = 3) -> DataFrame:
    """The k best images, then the best one of each parent."""
    hits = knn(images, q, k).select("parent_id", "score", "id").withColumn("_o", -F.col("score"))
    return distinct_on(hits, ["parent_id"], ["_o", "id"]).select("id", "parent_id", F.lit("embedding").alias("source"), "score")


def house_ids(hits: DataFrame, limit: int = 5) -> DataFrame:
    """Listing ids of hits and their parents, best first, at most `limit`."""
    both = hits.select(F.explode(F.array("id", "parent_id")).alias("id"), "score").filter("id IS NOT NULL")
    plain = both.withColumn("id", F.replace("id", F.lit(CHILD), F.lit("")))
    return plain.groupBy("id").agg(F.max("score").alias("s")).orderBy(F.desc("s"), "id").limit(limit).select("id")


def search_documents(
    docs: DataFrame, query: str, q: list[float], images: DataFrame | None = None, min_length: int = 50,
    keywords: Callable[[str, int, DataFrame | None], DataFrame] | None = None,
) -> DataFrame:
    """Keyword and vector search, then every document related to the hits (id, content)."""
    ids = house_ids(hybrid_search(docs, query, q, images=images, keywords=keywords))
    found = related(docs.select("id", "parent_id", "content"), ids)
    return found.filter(F.length("content") > min_length).select("id", "content")


def house_images(images: DataFrame, house_id: str) -> DataFrame:
    if not house_id.startswith("hos"):
        raise ValueError(f"not the id of a house: {house_id!r}")
    return images.filter(F.col("parent_id") == house_id.replace(CHILD, "")).select("file_path")


def pick_image(images: DataFrame, house_id: str, seed: int = 0) -> DataFrame:
    """One image of the house, the same for a seed."""
    return house_images(images, house_id).orderBy(F.xxhash64("file_path", F.lit(seed)), "file_path").limit(1)
