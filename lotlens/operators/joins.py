"""Joins with a named meaning.

No broadcast hints: Spark broadcasts a side when its size is below the session
threshold (also at run time), and splits skewed partitions otherwise.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from .aggregates import distinct_on


def lookup(df: DataFrame, table: DataFrame, key: str, source: str, target: str, name: str) -> DataFrame:
    """Replace `key` by its target in a lookup table, else keep it; duplicate sources multiply rows."""
    t = table.select(F.col(source).alias("_src"), F.col(target).alias("_tgt"))
    joined = df.join(t, df[key] == t["_src"], "left")
    return joined.withColumn(name, F.coalesce("_tgt", key)).drop("_src", "_tgt")


def with_any(df: DataFrame, key: str, other: DataFrame, other_key: str, keep_duplicates: bool = False) -> DataFrame:
    """Rows having a partner; optionally once per partner."""
    o = other.select(F.col(other_key).alias("_o"))
    return df.join(o, df[key] == o["_o"], "inner").drop("_o") if keep_duplicates else df.join(o, df[key] == o["_o"], "left_semi")


def new_rows(df: DataFrame, target: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows an insert-if-absent would add: one per key, none already in the target; a NULL key is a key like others."""
    have = target.select(*[F.col(k).alias(f"_h_{k}") for k in keys])
    fresh = distinct_on(df, keys, order)
    on = reduce(lambda a, b: a & b, [fresh[k].eqNullSafe(have[f"_h_{k}"]) for k in keys])
    return fresh.join(have, on, "left_anti")


def related(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents reachable from `ids` over parent_id (columns id, parent_id), each once.

    Every round is written to the shared folder and only ids not seen before go
    on, so cycles end, plans stay short and a lost executor replays one round.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    links = docs.select("id", "parent_id").filter("parent_id IS NOT NULL")
    fresh = docs.select("id").join(ids.select("id").distinct(), "id", "left_semi").distinct()
    level = 0
    while True:
        fresh.write.parquet(f"{path}/level={level}")
        fresh = spark.read.schema("id string").parquet(f"{path}/level={level}")
        seen = spark.read.schema("id string, level int").parquet(path).select("id")
        if fresh.isEmpty():
            return docs.join(seen, "id", "left_semi")
        children = links.join(fresh.withColumnRenamed("id", "parent_id"), "parent_id", "left_semi")
        fresh = children.select("id").distinct().join(seen, "id", "left_anti")
        level += 1
