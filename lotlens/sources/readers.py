"""Scans: listings, lookup maps, GeoJSON features, areas, parquet, image files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geo

LISTING_SCHEMA = (
    "id string, price double, installment double, address string, description string, tags array<string>, "
    "specs map<string,string>, facilities array<string>, "
    "agent struct<name:string,url:string,phone:string,company:struct<name:string,url:string>>, "
    "images array<string>, url string, last_modified string, scraped_at string"
)
CORRUPT = "_corrupt_record"


def read_listings(spark: SparkSession, path: str | list[str], keep_corrupt: bool = False) -> DataFrame:
    """JSON-lines listings with a fixed schema; unreadable lines go to `_corrupt_record`."""
    df = spark.read.schema(f"{LISTING_SCHEMA}, {CORRUPT} string").json(path)
    return df if keep_corrupt else df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_district_map(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Corrections {source, target} as one JSON list, or one object per line (duplicates kept)."""
    return spark.read.schema("source string, target string").option("multiLine", not lines).json(path)


def _xy(c: Column) -> Column:
    return F.struct(c[0].alias("x"), c[1].alias("y"))


def geometry(kind: Column, coordinates: Column) -> Column:
    """Geometry struct from GeoJSON type and raw coordinates text."""
    ring = lambda r: F.transform(r, _xy)
    poly = F.transform(F.from_json(coordinates, "array<array<array<double>>>"), ring)
    multi = F.transform(F.from_json(coordinates, "array<array<array<array<double>>>>"), lambda p: F.transform(p, ring))
    pt = F.from_json(coordinates, "array<double>")
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "Point", _xy(pt)).alias("point"),
        F.when(kind == "Polygon", F.array(poly)).when(kind == "MultiPolygon", multi).alias("polygons"),
    ).cast(geo.GEOMETRY)


HEAD_BYTES = 65_536
_OPENING = re.compile(r'"features"\s*:\s*\[\s*(\{\s*"type"\s*:\s*"Feature"\s*,)')


def _openings(spark: SparkSession, path: str) -> dict[str | None, list[str]]:
    """Files of a path by the text with which they open a feature, as their first kilobytes show; None if not by its type."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str | None, list[str]] = {}
    for match in fs.globStatus(at) or []:
        for f in fs.listStatus(match.getPath()) if match.isDirectory() else [match]:
            if f.getPath().getName()[0] in "._" or f.getLen() == 0:
                continue
            stream = fs.open(f.getPath())
            try:
                head = bytes(stream.readNBytes(HEAD_BYTES)).decode("utf-8", "replace")
            finally:
                stream.close()
            opening = _OPENING.search(head)
            found.setdefault(opening and opening[1], []).append(f.getPath().toString())
    return found


def _collections(spark: SparkSession, path: str, feature: str) -> DataFrame:
    """Features of FeatureCollection documents as column f.

    A writer opens all features of a document with the same text, `{"type":"Feature",` with its own blanks. Quotes inside
    JSON strings are escaped, so this text stands nowhere else; files are split at it over tasks like lines, and
    each piece holds one feature and the punctuation behind it. A feature opened in another way than the first of its file is an error, not a loss.
    Documents whose features do not open with their type, compressed ones too, are parsed whole, one task each.
    """
    out = None
    for opening, files in _openings(spark, path).items():
        if opening is None:
            one = spark.read.option("multiLine", True).schema(f"features array<{feature}>").json(files).select(F.explode("features").alias("f"))
        else:
            pieces = spark.read.option("lineSep", opening).text(files).filter(F.col("value").rlike(r'^\s*"'))
            missed = F.col("value").rlike(r'"type"\s*:\s*"Feature"\s*[,}]')
            whole = F.when(missed, F.raise_error(F.lit("features of one file open differently"))).otherwise(F.concat(F.lit(opening), "value"))
            one = pieces.select(F.from_json(whole, feature).alias("f"))
        out = one if out is None else out.unionAll(one)
    return spark.createDataFrame([], f"f {feature}") if out is None else out


def _features(spark: SparkSession, path: str, properties: str, lines: bool) -> DataFrame:
    feature = f"struct<id:string,properties:struct<{properties}>,geometry:struct<type:string,coordinates:string>>"
    if lines:
        one = spark.read.text(path).select(F.from_json("value", feature).alias("f")).filter("f.geometry IS NOT NULL")
    else:
        one = _collections(spark, path, feature)
    return one.select("f.properties.*", geometry(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("geom"))


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Amenity features (element, id, amenity, name, geom).

    `lines=True` reads one feature per line; a FeatureCollection document is split
    at the text that opens its features.
    """
    return _features(spark, path, "element:string,id:bigint,amenity:string,name:string", lines)


def read_areas(spark: SparkSession, *paths: str, lines: bool = False) -> list[DataFrame]:
    """Administrative areas, one frame per region file."""
    props = "NAMOBJ:string,WADMKC:string,WADMKK:string,WADMPR:string"
    return [_features(spark, p, props, lines) for p in paths]


def read_amenity_regions(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw map features of several regions, with the helper columns still present."""
    props = "element:string,id:bigint,amenity:string,landuse:string,name:string,`name:en`:string"
    return reduce(DataFrame.unionByName, [_features(spark, p, props, False) for p in paths])


def list_files(spark: SparkSession, root: str, pattern: str = "*.jpg") -> DataFrame:
    """Every matching file below `root`: id = sha256 of '<folder>/<file>', parent = folder. Contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        .load(root).select("path")
    )
    parts = F.split("path", "/")
    named = files.select(F.url_decode(F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1))).alias("file_path"))
    return named.select(
        F.sha2("file_path", 256).alias("id"), F.split("file_path", "/")[0].alias("parent_id"), "file_path"
    )


def list_images(spark: SparkSession, root: str) -> DataFrame:
    return list_files(spark, root, "*.jpg")
