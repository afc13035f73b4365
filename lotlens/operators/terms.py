"""Stored term table for keyword search: postings by term, updated by partition.

Layout under a folder all executors share:

* `postings/part=<p>`: (term, id, tf, len), p the term's hash; a query reads the partitions of its words only, and in
  them the row groups of its terms, as rows are written in order of part, term and id. The postings of a frequent term
  are spread over files by id.
* `documents/slot=<s>`: (id, len, digest, parts) of each document, s the hash of its id; parts are the postings
  partitions that hold its terms, digest tells whether its text has changed.

An update reads the slots of the ids it brings and rewrites these and the postings partitions that old or new texts
touch; everything else stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col
from ..session import scratch, written
from .search import B, K1, query_terms

#: Partitions of a new table. Terms and documents are dealt over as many.
PARTS = 64
#: An update rewrites the partitions it touches in so many steps.
SHARES = 4


def words(content: Column | str) -> Column:
    """Lower-cased words of a text in order."""
    return F.array_remove(F.split(F.lower(F.coalesce(col(content), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def part_of(term: Column | str, parts: int) -> Column:
    return (F.crc32(col(term).cast("binary")) % parts).cast("int")


def _analysed(docs: DataFrame, doc_id: str, content: str, parts: int) -> tuple[DataFrame, DataFrame]:
    """Postings and documents of texts. Texts are dealt by id first: however few files hold them, all tasks analyse some, and
    the words of an id are counted where they are, so no posting moves before it is stored."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(F.col(doc_id).alias("id"), F.col(content).alias("text")).repartition(tasks, "id")
    rows = dealt.select("id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), words("text").alias("w"))
    tokens = rows.select("id", F.size("w").cast("long").alias("len"), F.explode("w").alias("term"))
    postings = tokens.groupBy("term", "id", "len").agg(F.count(F.lit(1)).alias("tf")).select(part_of("term", parts).alias("part"), "term", "id", "tf", "len")
    found = F.sort_array(F.array_distinct(F.transform(F.array_distinct("w"), lambda w: part_of(w, parts))))
    documents = rows.select(part_of(F.col("id").cast("string"), parts).alias("slot"), "id", F.size("w").cast("long").alias("len"), "digest", found.alias("parts"))
    return postings, documents


def store_parts(df: DataFrame, path: str, by: str, order: list[str], mode: str) -> None:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(tasks, by, *order).sortWithinPartitions(by, *order)
    ordered.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def store_postings(df: DataFrame, path: str, parts: int, mode: str) -> None:
    """Postings in one shuffle: each partition is dealt by id over as many tasks as keep all of them busy, none read twice for ranges."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-2 * tasks // parts))))
    ordered = df.repartition(tasks, "part", share).sortWithinPartitions("part", "term", "id")
    ordered.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def build_terms(docs: DataFrame, path: str, doc_id: str = "id", content: str = "content", parts: int = PARTS) -> None:
    """Write the term table of docs (one row per id) to a new folder."""
    postings, documents = _analysed(docs, doc_id, content, parts)
    store_postings(postings, f"{path}/postings", parts, "error")
    with scratch() as held:
        store_parts(held(documents), f"{path}/documents", "slot", ["id"], "error")
    _describe(docs.sparkSession, path, parts)


def _describe(spark: SparkSession, path: str, parts: int) -> None:
    """One row: how many documents, their words, and the partitions."""
    documents = spark.read.parquet(f"{path}/documents")
    stats = written(documents.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("len"), F.lit(0)).alias("words"), F.lit(parts).alias("parts")))
    stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")


def described(spark: SparkSession, path: str) -> tuple[int, int, int]:
    r = spark.read.parquet(f"{path}/stats").first()
    return r["n"], r["words"], r["parts"]


def stale(docs: DataFrame, path: str, doc_id: str = "id", content: str = "content") -> DataFrame:
    """The rows of docs that the table lacks or holds with another text; reads the slots of their ids only."""
    spark = docs.sparkSession
    parts = described(spark, path)[2]
    slot = part_of(F.col(doc_id).cast("string"), parts)
    slots = [r["s"] for r in docs.select(slot.alias("s")).distinct().collect()]  # at most `parts` numbers
    held = spark.read.parquet(f"{path}/documents").filter(F.col("slot").isin(slots)).select(F.col("id").alias(doc_id), F.col("digest").alias("_digest"))
    same = F.md5(F.coalesce(F.col(content), F.lit(""))) == F.col("_digest")
    return docs.join(held, doc_id, "left").filter(~F.coalesce(same, F.lit(False))).drop("_digest")


def update_terms(docs: DataFrame, path: str, gone: DataFrame | None = None, doc_id: str = "id", content: str = "content") -> int:
    """Bring new and changed texts in and take the ids of `gone` out; gives the number of postings partitions rewritten.

    New postings are written aside first and deleted at the end; a failed update is run again with the same rows: partitions
    already rewritten come out the same.
    """
    spark = docs.sparkSession
    parts = described(spark, path)[2]
    with scratch() as keep:
        new = keep(stale(docs, path, doc_id, content).select(F.col(doc_id).alias("id"), F.col(content).alias("content")))
        ids = new.select("id") if gone is None else new.select("id").union(gone.select(F.col(doc_id).alias("id"))).distinct()
        ids = keep(ids.withColumn("slot", part_of(F.col("id").cast("string"), parts)))
        postings, documents = (keep(x) for x in _analysed(new, "id", "content", parts))
        slots = [r["slot"] for r in ids.select("slot").distinct().collect()]  # at most `parts` numbers, as below
        held = spark.read.parquet(f"{path}/documents").filter(F.col("slot").isin(slots))
        old = held.join(ids.select("id"), "id", "left_semi")
        touched = old.select(F.explode("parts").alias("p")).union(documents.select(F.explode("parts").alias("p"))).distinct()
        touched = [r["p"] for r in touched.collect()]
        spent = ids.select("id")
        columns = ["part", "term", "id", "tf", "len"]
        stay = spark.read.parquet(f"{path}/postings").filter(F.col("part").isin(touched)).select(*columns).join(spent, "id", "left_anti")
        replace_parts(stay.select(*columns).union(postings.select(*columns)), f"{path}/postings", "part", touched, lambda rows, to: store_postings(rows, to, parts, "overwrite"))
        columns = ["slot", "id", "len", "digest", "parts"]
        stay = held.select(*columns).join(spent, "id", "left_anti")
        replace_parts(stay.select(*columns).union(documents.select(*columns)), f"{path}/documents", "slot", slots, lambda rows, to: store_parts(rows, to, "slot", ["id"], "overwrite"))
    _describe(spark, path, parts)
    return len(touched)


def replace_parts(df: DataFrame, path: str, by: str, values: list[int], store: Callable[[DataFrame, str], None]) -> None:
    """Overwrite the partitions named; one that is left without rows goes.

    df may read these partitions: new files replace the old ones of a partition when all are written. A share of the partitions
    is rewritten at a time, so that old and new files and the shuffle between them lie side by side for a share only.
    """
    spark = df.sparkSession
    left = {r[by] for r in df.select(by).distinct().collect()}
    kept, share = sorted(left & set(values)), max(1, -(-len(values) // SHARES))
    for at in range(0, len(kept), share):
        store(df.filter(F.col(by).isin(kept[at:at + share])), path)
    for v in set(values) - left:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{by}={v}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def postings_of(spark: SparkSession, path: str, terms: list[str], parts: int) -> DataFrame:
    """Postings of the terms, from their partitions."""
    asked = spark.range(1).select(F.explode(F.lit(terms)).alias("t")).select(part_of("t", parts).alias("p")).distinct()
    at = sorted(r["p"] for r in asked.collect())  # one per term at most
    return spark.read.parquet(f"{path}/postings").filter(F.col("part").isin(at) & F.col("term").isin(terms))


def bm25_terms(spark: SparkSession, path: str, query: str, k: int | None = 3, within: DataFrame | None = None, name: Column | None = None) -> DataFrame:
    """(id, score) of documents holding a query word: the k best in order (ties by id), or all when k is None.

    With `within` (ids in `id`) only these documents count, in the statistics too. `name` renames ids before they rank.
    """
    terms = query_terms(query)
    n, total, parts = described(spark, path)
    found = postings_of(spark, path, terms, parts) if terms else spark.read.parquet(f"{path}/postings").limit(0)
    found = found.withColumn("id", F.col("id") if name is None else name)
    if within is not None:
        ids = within.select("id").distinct()
        lengths = spark.read.parquet(f"{path}/documents").select("id", "len").withColumn("id", F.col("id") if name is None else name)
        r = lengths.join(ids, "id", "left_semi").agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("words")).first()
        n, total = r["n"], r["words"] or 0
        found = found.join(ids, "id", "left_semi")
    df = {r["term"]: r["df"] for r in found.groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}  # one row per query term
    weights = F.create_map(*[F.lit(x) for t in terms for x in (t, df.get(t, 0))]) if terms else F.create_map(F.lit(""), F.lit(0))
    have = F.element_at(weights, F.col("term"))
    idf = F.log(1 + (n - have + 0.5) / (have + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / (total / n if n and total else 1.0)))
    scored = found.groupBy("id").agg(F.sum(part).alias("score"))
    return scored if k is None else scored.orderBy(F.desc("score"), "id").limit(k)
