"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame) -> DataFrame:
    """doc_id and whole text of every row, a null text as an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 4; rows of remainder 2 are held out. Null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def labelled(docs: DataFrame, labels: DataFrame, column: str, rows: int) -> DataFrame:
    """doc_id, text, y of at most `rows` labelled ids outside the held-out fold, those of the smallest id hashes.

    Labels other than 0 and 1 are ignored; of several labels of an id the largest counts.
    """
    y = F.col(column).cast("int")
    known = labels.filter(y.isin(0, 1) & (fold_of(F.col("doc_id")) != 2)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(y).alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return text_rows(docs).join(F.broadcast(known), "doc_id")  # `rows` rows of two numbers


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """One frame in, one frame out, per Arrow batch; whole numbers stay exact where some are null."""
    made = T._parse_datatype_string(schema)

    def frame(batch: pa.RecordBatch) -> pd.DataFrame:
        def column(c: pa.Array) -> pd.Series:
            if pa.types.is_integer(c.type) and c.null_count:
                return c.to_pandas(types_mapper=lambda _: pd.Int64Dtype())
            return c.to_pandas()

        return pd.DataFrame({n: column(c) for n, c in zip(batch.schema.names, batch.columns)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(made)
        for batch in batches:
            if batch.num_rows:
                yield from pa.Table.from_pandas(fn(frame(batch)), schema=arrow, preserve_index=False).to_batches()

    return df.mapInArrow(run, made)


def filter_rows(df: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows for which keep is true, all columns untouched."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):  # few texts at a time as Python strings
                part = batch.slice(at, 1000)
                yield part.filter(pa.array(keep(part), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def star_roots(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (node, root) per node, root the smallest node.

    Rounds of hooking (a root takes the smallest root next to its members) and
    pointer jumping. Every round is two aggregates that combine before the
    shuffle and joins that adaptive execution may split, and ends in a written
    table. Nothing but one count reaches the driver; the rounds grow with the
    logarithm of the longest path.
    """
    kind = edges.schema["a"].dataType
    pairs = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    roots = written(nodes.select("node", F.col("node").alias("root")))
    while True:
        la = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        lb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        # edges between roots; what has become one component leaves the edge list
        pairs = written(
            pairs.join(la, "a").join(lb, "b").filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
        if pairs.isEmpty():
            return roots.select("node", F.col("root").cast(kind).alias("root"))
        hook = pairs.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("up"))
        # chains of hooks shrink by doubling until no hook points to a hooked root
        hook = written(hook)
        while True:
            above = hook.select(F.col("root").alias("up"), F.col("up").alias("top"))
            hook = written(hook.join(above, "up", "left").select("root", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")))
            if hook.filter("moved").isEmpty():
                break
            hook = hook.drop("moved")
        roots = written(
            roots.join(hook.select("root", "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        )
