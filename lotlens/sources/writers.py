"""Sinks: parquet, GeoJSON lines, published tables, insert-if-absent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import geo
from ..operators.joins import new_rows
from ..session import written


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _pair(p: Column) -> Column:
    return F.array(p["x"], p["y"])


def geojson_lines(df: DataFrame, geom: str = "geom") -> DataFrame:
    """One GeoJSON Feature per row, with bbox, properties and geometry, as column `value`."""
    g = F.col(geom)
    rings = F.transform(g["polygons"], lambda poly: F.transform(poly, lambda r: F.transform(r, _pair)))
    many = F.size(rings) > 1
    shape = (
        F.when(g["polygons"].isNull(), F.to_json(F.struct(F.lit("Point").alias("type"), _pair(g["point"]).alias("coordinates"))))
        .when(many, F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), rings.alias("coordinates"))))
        .otherwise(F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(rings, F.lit(0)).alias("coordinates"))))
    )
    b = geo.bbox(g["polygons"])
    box = F.when(g["polygons"].isNull(), F.to_json(F.concat(_pair(g["point"]), _pair(g["point"])))).otherwise(
        F.to_json(F.array(b["x0"], b["y0"], b["x1"], b["y1"]))
    )
    props = F.to_json(F.struct(*[c for c in df.columns if c != geom]), {"ignoreNullFields": "false"})
    return df.select(
        F.concat(F.lit('{"type":"Feature","bbox":'), box, F.lit(',"properties":'), props, F.lit(',"geometry":'), shape, F.lit("}"))
        .alias("value")
    )


def export_geojson(df: DataFrame, path: str, geom: str = "geom") -> None:
    """Newline-delimited features: every task writes its own lines."""
    geojson_lines(df, geom).write.mode("overwrite").text(path)


def published_names(names: list[str]) -> list[str]:
    return sorted(n for n in names if n.startswith("marts") and "downstream" not in n)


def publish(spark: SparkSession, database: str, jdbc_url: str | None = None, properties: dict | None = None) -> list[str]:
    """Recreate every mart view or table (except downstream ones) in `database`, or over JDBC."""
    names = published_names([t.name for t in spark.catalog.listTables()])
    for n in names:
        df = spark.table(n)
        if jdbc_url is not None:
            df.write.mode("overwrite").jdbc(jdbc_url, n, properties=properties or {})
        else:
            df.write.mode("overwrite").saveAsTable(f"{database}.{n}")
    return names


#: Key hashes of a target of insert_new.
SLOTS = 64


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, target: str) -> dict[str, int]:
    """The ledger of a target: the last batch each writer has committed."""
    fs, _ = _files(spark, target)
    entries = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_ledger/*/*")) or []
    last: dict[str, int] = {}
    for e in entries:
        writer, batch = e.getPath().getParent().getName(), int(e.getPath().getName())
        last[writer] = max(last.get(writer, -1), batch)
    return last


def _commit(spark: SparkSession, target: str, writer: str, batch: int, before: int) -> None:
    fs, entry = _files(spark, f"{target}/_ledger/{writer}/{batch}")
    fs.create(entry, True).close()
    if before >= 0:
        fs.delete(_files(spark, f"{target}/_ledger/{writer}/{before}")[1], False)


def read_inserted(spark: SparkSession, target: str, schema: T.StructType, slots: list[int] | None = None) -> DataFrame:
    """Rows of the committed batches of a target of insert_new, of some key hashes only when `slots` names them."""
    last = committed(spark, target)
    if not last:
        return spark.createDataFrame([], schema)
    layout = T.StructType([*schema.fields, T.StructField("_slot", T.IntegerType()), T.StructField("_writer", T.StringType()), T.StructField("_batch", T.LongType())])
    done = reduce(lambda x, y: x | y, [(F.col("_writer") == w) & (F.col("_batch") <= b) for w, b in last.items()])
    rows = spark.read.schema(layout).parquet(f"{target}/rows").filter(done)
    return (rows if slots is None else rows.filter(F.col("_slot").isin(slots))).select(*schema.names)


def insert_new(
    df: DataFrame, target: str, keys: list[str], order: list[str] | None = None, writer: str = "direct", batch: int | None = None
) -> int:
    """Append rows whose key is not in `target` yet; gives the number of the batch.

    The target is partitioned by key hash, writer and batch: only the hashes of the batch's keys are read. A batch
    counts once its number is in the ledger, which is the last thing written: what a failed attempt left behind is
    never read and is removed by the next, and a batch that is in the ledger already adds nothing. Numbers of a writer
    only rise; without one the batch takes the next. A writer's batches come one after another, as those of a stream do.
    """
    spark = df.sparkSession
    before = committed(spark, target).get(writer, -1)
    batch = before + 1 if batch is None else batch
    if batch <= before:
        return batch
    fs, left = _files(spark, f"{target}/rows/_slot=*/_writer={writer}/_batch={batch}")
    for half in fs.globStatus(left) or []:
        fs.delete(half.getPath(), True)
    slot = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(SLOTS)).cast("int")
    own = written(df)  # the batch is read twice: for its slots and for its rows
    slots = [r["s"] for r in own.select(slot.alias("s")).distinct().collect()]  # SLOTS at most
    fresh = new_rows(own, read_inserted(spark, target, df.schema, slots), keys, order)
    rows = fresh.withColumns({"_slot": slot, "_writer": F.lit(writer), "_batch": F.lit(batch).cast("long")})
    rows.repartition("_slot").write.mode("append").partitionBy("_slot", "_writer", "_batch").parquet(f"{target}/rows")
    _commit(spark, target, writer, batch, before)
    return batch


def build_layer(spark: SparkSession, tables: dict[str, DataFrame], as_table: bool = False) -> None:
    """Views for cheap layers, stored tables for results read by several others."""
    for n, df in tables.items():
        if as_table:
            df.write.mode("overwrite").saveAsTable(n)
        else:
            df.createOrReplaceTempView(n)
