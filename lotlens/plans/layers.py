"""The tables of the warehouse with what each is made of, built once and only when something changed.

`LAYERS` names every table after the tables it reads. A stored table lives under
`target/<name>/<version>`; its version follows from its rule and the versions of
what it reads, those of the sources from their files. A table whose version is
complete is read, all others are built from the stored ones before them, so raw
records are parsed once however many marts there are. Half-written tables carry
no success mark and are built again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import listings as plan

#: Raised when a rule changes its result, so that stored tables of the old rule are not used.
RULES = 1


@dataclass(frozen=True)
class Layer:
    needs: tuple[str, ...]
    rule: Callable[..., DataFrame]
    stored: bool = False


def _items(column: str, name: str) -> Layer:
    return Layer(("stg_listings",), lambda s: plan.staged_items(s, column, name))


def _houses(stage: DataFrame) -> DataFrame:
    return stage.select("id", "price", "installment", "description", "subdistrict", "city", "url", "last_modified", "scraped_at")


def _agents(stage: DataFrame) -> DataFrame:
    return stage.select(
        F.col("agent_name").alias("name"), F.col("agent_phone").alias("phone"), "agent_hash", F.col("id").alias("reference_id"))


SOURCES = ("listings", "districts", "areas", "amenities")
LAYERS: dict[str, Layer] = {
    "stg_listings": Layer(("listings",), plan.staged, True),
    "stg_areas": Layer(("areas",), lambda a: a, True),
    "stg_houses": Layer(("stg_listings",), _houses),
    "stg_specs": Layer(("stg_listings",), plan.staged_specs),
    "stg_agents": Layer(("stg_listings",), _agents),
    "stg_agent_companies": Layer(("stg_listings",), plan.staged_companies),
    "stg_facilities": _items("facilities", "facility"),
    "stg_tags": _items("tags", "tag"),
    "stg_images": _items("images", "image_url"),
    "int_specs": Layer(("stg_specs",), plan.int_specs),
    "int_houses": Layer(("stg_houses", "districts"), plan.int_houses),
    "int_floor_materials": Layer(("stg_specs",), lambda s: plan.int_materials(s, "material_lantai", "floor_material")),
    "int_house_materials": Layer(("stg_specs",), lambda s: plan.int_materials(s, "material_bangunan", "house_material")),
    "int_amenities": Layer(("amenities",), plan.int_amenities, True),
    "int_placed_amenities": Layer(("int_amenities", "stg_areas"), plan.placed_amenities, True),
    "int_area_counts": Layer(("int_placed_amenities",), plan.area_counts_of, True),
    "marts_fact_houses": Layer(("stg_listings", "districts", "stg_areas"), plan.fact_houses, True),
    "marts_fact_amenities": Layer(("int_placed_amenities",), plan.fact_amenities_of, True),
    "marts_dim_area": Layer(("stg_areas",), plan.dim_area, True),
    "marts_dim_facilities": Layer(("stg_facilities",), lambda i: plan.dim_items(i, "facility"), True),
    "marts_dim_tags": Layer(("stg_tags",), lambda i: plan.dim_items(i, "tag"), True),
    "marts_dim_floor_materials": Layer(("stg_specs",), lambda s: plan.dim_materials(s, "material_lantai", "floor_material"), True),
    "marts_dim_house_materials": Layer(("stg_specs",), lambda s: plan.dim_materials(s, "material_bangunan", "house_material"), True),
    "marts_dim_agent_companies": Layer(("stg_listings",), plan.dim_companies, True),
    "marts_dim_amenities": Layer(("int_amenities",), plan.dim_amenities, True),
    "marts_bridge_house_facilities": Layer(("stg_facilities",), lambda i: plan.bridge_of(i, "facility"), True),
    "marts_bridge_house_tags": Layer(("stg_tags",), lambda i: plan.bridge_of(i, "tag"), True),
    "marts_bridge_house_floor_materials": Layer(("int_floor_materials",), lambda i: plan.bridge_of(i, "floor_material"), True),
    "marts_bridge_house_house_materials": Layer(("int_house_materials",), lambda i: plan.bridge_of(i, "house_material"), True),
    "marts_downstream_houses": Layer(("stg_listings", "districts", "int_area_counts"), plan.wide_listings, True),
    "marts_downstream_area_geometry": Layer(("stg_areas",), plan.area_geometry, True),
}


def files_version(spark: SparkSession, *paths: str) -> str:
    """Version of a source: names, lengths and times of its files."""
    found = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def build(
    spark: SparkSession, sources: dict[str, tuple[DataFrame, str]], target: str, names: list[str] | None = None,
    layers: dict[str, Layer] = LAYERS,
) -> tuple[dict[str, DataFrame], list[str]]:
    """The named tables (all, if none are named) and the names of the stored ones that had to be built.

    sources: each with its version. Tables that no named one reads are left alone. Former versions of a table are
    deleted once all tables are complete; one build of a target runs at a time.
    """
    wanted = set(layers) if names is None else set(names)
    for name in reversed(layers):
        if name in wanted:
            wanted |= {n for n in layers[name].needs if n in layers}
    fs = spark._jvm.org.apache.hadoop.fs.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    folder = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join((target, *parts)))
    tables = {n: df for n, (df, _) in sources.items()}
    versions = {n: v for n, (_, v) in sources.items()}
    made = []
    for name, layer in layers.items():
        if name not in wanted:
            continue
        versions[name] = hashlib.sha256(repr((RULES, name, [versions[n] for n in layer.needs])).encode()).hexdigest()[:24]
        complete = layer.stored and fs.exists(folder(name, versions[name], "_SUCCESS"))
        path = f"{target}/{name}/{versions[name]}"
        if not complete:
            df = layer.rule(*[tables[n] for n in layer.needs])
            if layer.stored:
                df.write.mode("overwrite").parquet(path)
                made.append(name)
        tables[name] = spark.read.parquet(path) if layer.stored else df
    for name in wanted:
        for old in (fs.listStatus(folder(name)) if layers[name].stored else []):
            if old.getPath().getName() != versions[name]:
                fs.delete(old.getPath(), True)
    return {n: tables[n] for n in layers if n in (layers if names is None else names)}, made
