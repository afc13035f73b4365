"""Stored vector partitions for nearest-neighbour search, and the index job that keeps words and vectors up to date.

Layout under a folder all executors share: `cells` (cell, centre, probes), a bounded table; `vectors/cell=<c>`, the rows
by their nearest centre; `ids/slot=<s>` (id, cell), so that an update finds the partitions of the rows it replaces.
Centres are fitted on a bounded sample over all rows, every row is stored, and a query ranks exactly the rows of the
partitions it reads. How many it reads is measured on the sample when the table is built: as few as give the recall
asked for. A crowded cell is spread over files by id.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch
from .search import embed, hashed_vectors, knn
from .terms import PARTS, build_terms, part_of, replace_parts, stale, store_parts, update_terms

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Centres are fitted on at most so many rows, those of the smallest id hashes, and probes measured with so many of them.
FIT_ROWS, PROBE_ROWS = 5_000, 200
RECALL, AT = 0.95, 10


def unit(m: np.ndarray) -> np.ndarray:
    m = np.asarray(m, dtype=np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)


def fit_cells(vecs: DataFrame, cells: int, vec: str = "embedding", vec_id: str = "id", recall: float = RECALL, seed: int = 7) -> tuple[np.ndarray, int]:
    """Centres of a bounded sample, and how many nearest cells hold `recall` of a sample row's AT nearest."""
    fine = vecs.filter(F.col(vec).isNotNull())
    with scratch() as held:
        return _cells_of(held(fine.orderBy(F.xxhash64(vec_id), vec_id).limit(FIT_ROWS).select(F.col(vec).cast("array<double>").alias("v"))), cells, recall, seed)


def _cells_of(sample: DataFrame, cells: int, recall: float, seed: int) -> tuple[np.ndarray, int]:
    rows = unit(np.array([r["v"] for r in sample.collect()]))  # FIT_ROWS vectors
    if not len(rows):
        return np.zeros((1, 0)), 1
    if len(rows) > cells:
        length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e))
        scaled = sample.withColumn("n", F.greatest(length, F.lit(1e-12))).select(array_to_vector(F.transform("v", lambda e: e / F.col("n"))).alias("features"))
        centres = unit(np.array(KMeans(k=cells, seed=seed, maxIter=15).fit(scaled).clusterCenters()))
    else:
        centres = rows
    cell = (rows @ centres.T).argmax(axis=1)
    asked = rows[:: max(1, len(rows) // PROBE_ROWS)]
    near = np.argsort(-(asked @ rows.T), axis=1)[:, :AT]
    place = np.empty((len(asked), len(centres)), dtype=int)
    np.put_along_axis(place, np.argsort(-(asked @ centres.T), axis=1), np.arange(len(centres))[None, :], axis=1)
    turn = np.sort(np.take_along_axis(place, cell[near], axis=1).ravel())  # when the cell of a neighbour is read
    return centres, int(turn[min(len(turn) - 1, int(np.ceil(recall * len(turn))) - 1)]) + 1


def assigned(vecs: DataFrame, centres: np.ndarray, vec: str = "embedding") -> DataFrame:
    """The rows that have a vector, each with its nearest cell. Only the vectors go to Python, other columns stay where they are."""
    @F.pandas_udf(T.IntegerType())
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in batches:
            yield pd.Series((unit(np.stack(v.to_numpy())) @ centres.T).argmax(axis=1).astype("int32") if len(v) else [], dtype="int32")

    return vecs.filter(F.col(vec).isNotNull()).withColumn("cell", cell(F.col(vec)))


def build_vectors(vecs: DataFrame, path: str, cells: int = 32, vec: str = "embedding", vec_id: str = "id", recall: float = RECALL) -> None:
    """Write the vector partitions of vecs (one row per id, further columns kept) to a new folder. Stored rows are best: they are read
    more than once, and not copied."""
    spark = vecs.sparkSession
    centres, probes = fit_cells(vecs, cells, vec, vec_id, recall)
    table = [(i, c.tolist(), probes) for i, c in enumerate(centres)]
    spark.createDataFrame(table, "cell int, centre array<double>, probes int").coalesce(1).write.parquet(f"{path}/cells")
    store_parts(assigned(vecs, centres, vec), f"{path}/vectors", "cell", [vec_id], "error")
    store_parts(_places(spark.read.parquet(f"{path}/vectors"), vec_id), f"{path}/ids", "slot", ["id"], "error")


def _places(rows: DataFrame, vec_id: str) -> DataFrame:
    return rows.select(part_of(F.col(vec_id).cast("string"), PARTS).alias("slot"), F.col(vec_id).alias("id"), "cell")


def centres_of(spark: SparkSession, path: str) -> tuple[np.ndarray, int]:
    rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # one per cell
    return np.array([r["centre"] for r in rows]), rows[0]["probes"]


def update_vectors(rows: DataFrame, path: str, gone: DataFrame | None = None, vec: str = "embedding", vec_id: str = "id") -> int:
    """Put rows in place of those of the same ids and take the ids of `gone` out; gives the number of cells rewritten. Rows are read
    more than once and not copied; only their ids and cells are written aside."""
    spark = rows.sparkSession
    with scratch() as keep:
        new = assigned(rows, centres_of(spark, path)[0], vec)
        cells = keep(new.select(vec_id, "cell"))
        ids = rows.select(F.col(vec_id).alias("id"))
        ids = keep((ids if gone is None else ids.union(gone.select(vec_id))).distinct().withColumn("slot", part_of(F.col("id").cast("string"), PARTS)))
        slots = [r["slot"] for r in ids.select("slot").distinct().collect()]  # PARTS at most
        held = spark.read.parquet(f"{path}/ids").filter(F.col("slot").isin(slots)).select("slot", "id", "cell")
        old = held.join(ids.select("id"), "id", "left_semi")
        touched = [r["cell"] for r in old.select("cell").union(cells.select("cell")).distinct().collect()]  # a number per cell
        spent = ids.select(F.col("id").alias(vec_id))
        stay = spark.read.parquet(f"{path}/vectors").filter(F.col("cell").isin(touched)).select(*new.columns).join(spent, vec_id, "left_anti")
        replace_parts(stay.select(*new.columns).union(new), f"{path}/vectors", "cell", touched, lambda rows, to: store_parts(rows, to, "cell", [vec_id], "overwrite"))
        placed = held.join(ids.select("id"), "id", "left_anti").select("slot", "id", "cell").union(_places(cells, vec_id))
        replace_parts(placed, f"{path}/ids", "slot", slots, lambda rows, to: store_parts(rows, to, "slot", ["id"], "overwrite"))
    return len(touched)


def near_cells(spark: SparkSession, path: str, q: list[float], probes: int | None = None) -> DataFrame:
    """The stored rows of the cells nearest to q."""
    centres, measured = centres_of(spark, path)
    order = np.argsort(-(centres @ unit(np.array([q]))[0]), kind="stable")[: probes or measured]
    return spark.read.parquet(f"{path}/vectors").filter(F.col("cell").isin([int(c) for c in order]))


def nearest(spark: SparkSession, path: str, q: list[float], k: int = 3, vec: str = "embedding", vec_id: str = "id", probes: int | None = None) -> DataFrame:
    """The k most similar rows by cosine, ties by id, among the nearest cells."""
    return knn(near_cells(spark, path, q, probes), q, k, vec, vec_id).drop("cell")


# -- the index job -----------------------------------------------------------

def refresh_index(
    docs: DataFrame, path: str, fn: Callable[[list[str]], np.ndarray] = hashed_vectors, cells: int = 32, whole: bool = False,
    doc_id: str = "id", content: str = "content", to_embed: str = "to_embed",
) -> int:
    """Bring words and vectors of docs (id, content, to_embed, further columns) up to date; gives the number of texts embedded.

    The first run builds the index. Later ones compare content digests and embed new and changed texts only; with
    `whole` docs are all documents, and others leave the index. Digests are stored last, so a run that failed is simply
    run again. Texts of changed documents alone are read by the model.
    """
    spark = docs.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/terms/stats/_SUCCESS")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        with scratch() as held:
            rows = held(embed(docs, to_embed, fn))
            build_vectors(rows, f"{path}/vectors", cells, vec_id=doc_id)
            number = rows.count()
        build_terms(docs, f"{path}/terms", doc_id, content)
        return number
    with scratch() as held:
        changed = held(stale(docs, f"{path}/terms", doc_id, content))
        known = spark.read.parquet(f"{path}/terms/documents").select(F.col("id").alias(doc_id))
        gone = held(known.join(docs.select(doc_id), doc_id, "left_anti")) if whole else None
        number = changed.count()
        if number or whole and not gone.isEmpty():
            with scratch() as apart:
                update_vectors(apart(embed(changed, to_embed, fn)), f"{path}/vectors", gone, vec_id=doc_id)
            update_terms(changed, f"{path}/terms", gone, doc_id, content)
    return number
