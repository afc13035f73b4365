"""From raw listings to star schema and wide table.

Input is the nested listing schema (`sources.readers.LISTING_SCHEMA`).  All
fields of a listing sit in one record, so specs, lists and agent of a listing
are projections of that record; nothing is exploded and collected again, and
joins only meet lookup tables.  Keys `id` are expected to be unique (the
quality checks say so); `unique_listings` makes them so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as x
from ..functions import vocab as v
from ..operators import aggregates as agg
from ..operators import geo
from ..operators.joins import lookup
from ..session import written


def unique_listings(stage: DataFrame) -> DataFrame:
    """One staged record per id, the latest change first; ties by the scalar fields, then by a hash of the rest."""
    ties = ["scraped_at", "url", "price", "installment", "subdistrict", "city", "description", "record_hash"]
    first = Window.partitionBy("id").orderBy(F.desc_nulls_last("last_modified"), *ties)
    # only records whose id is repeated are compared; the others stay where they are
    again = written(stage.groupBy("id").count().filter("count > 1").select(F.col("id").alias("_again")))
    repeated = F.col("id").eqNullSafe(F.col("_again"))
    several = stage.join(again, repeated, "left_semi").withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")
    return stage.join(again, repeated, "left_anti").unionByName(several)


# -- staging -----------------------------------------------------------------

def staged(raw: DataFrame) -> DataFrame:
    """One row per record with every field cleaned once; all later tables of listings are projections of it."""
    snake = F.transform_keys("specs", lambda k, _: F.replace(F.lower(k), F.lit(" "), F.lit("_")))
    sub, city = x.split_address("address")
    flat = raw.select(
        "id", "price", "installment", "description", sub.alias("subdistrict"), city.alias("city"), "url",
        x.to_timestamp("last_modified").alias("last_modified"), x.to_timestamp("scraped_at").alias("scraped_at"),
        x.mask_name("agent.name").alias("agent_name"), x.mask_phone("agent.phone").alias("agent_phone"),
        x.agent_hash("agent.name", "agent.phone").alias("agent_hash"), x.clean_company("agent.company.name").alias("company"),
        F.col("agent.company.url").alias("company_url"), tags_of("tags").alias("tags"),
        facilities_of("facilities").alias("facilities"), "images", F.xxhash64("tags", "facilities", "images", F.to_json("specs"), F.to_json("agent")).alias("record_hash"), snake.alias("_s"),
    )
    base = [c for c in flat.columns if c != "_s"]
    return flat.select(*base, *[F.try_element_at("_s", F.lit(k)).alias(k) for k in spec_keys()])


def staged_items(stage: DataFrame, column: str, name: str) -> DataFrame:
    """The items of a list column, one per row."""
    return stage.select(F.col("id").alias("reference_id"), F.explode(column).alias(name))


def staged_specs(stage: DataFrame) -> DataFrame:
    return stage.select(F.col("id").alias("reference_id"), *spec_keys())


def staged_companies(stage: DataFrame) -> DataFrame:
    return stage.select(F.col("id").alias("reference_id"), F.col("company").alias("name"), F.col("company_url").alias("url"))


def stg_houses(raw: DataFrame) -> DataFrame:
    sub, city = x.split_address("address")
    return raw.select(
        "id", "price", "installment", "description", sub.alias("subdistrict"), city.alias("city"), "url",
        x.to_timestamp("last_modified").alias("last_modified"), x.to_timestamp("scraped_at").alias("scraped_at"),
    )


def stg_specs(raw: DataFrame) -> DataFrame:
    """Specs as columns; page labels in any case, blanks or underscores between words."""
    snake = F.transform_keys("specs", lambda k, _: F.replace(F.lower(k), F.lit(" "), F.lit("_")))
    return raw.select(F.col("id").alias("reference_id"), snake.alias("_s")).select(
        "reference_id", *[F.try_element_at("_s", F.lit(k)).alias(k) for k in spec_keys()]
    )


def spec_keys() -> list[str]:
    return [
        *v.SPEC_AREA_KEYS, "daya_listrik", *v.SPEC_INT_KEYS, *v.SPEC_TEXT_KEYS,
        "sertifikat", "kondisi_properti", "kondisi_perabotan", *v.SPEC_FLAG_KEYS,
    ]


def stg_agents(raw: DataFrame) -> DataFrame:
    return raw.select(
        x.mask_name("agent.name").alias("name"), x.mask_phone("agent.phone").alias("phone"),
        x.agent_hash("agent.name", "agent.phone").alias("agent_hash"), F.col("id").alias("reference_id"),
    )


def stg_agent_companies(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("reference_id"), x.clean_company("agent.company.name").alias("name"),
        F.col("agent.company.url").alias("url"),
    )


def facilities_of(c: Column | str) -> Column:
    return F.filter(F.transform(x.col(c), x.clean_facility), lambda f: f.isNotNull())


def tags_of(c: Column | str) -> Column:
    """Cleaned tags; one written as a/b counts as two, NULL entries give none."""
    known = F.filter(x.col(c), lambda t: t.isNotNull())
    return F.flatten(F.transform(known, lambda t: F.split(x.clean_tag(t), "/")))


def materials_of(c: Column | str) -> Column:
    return F.transform(F.split(F.lower(x.col(c)), ","), x.clean_material)


def stg_facilities(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("reference_id"), F.explode(facilities_of("facilities")).alias("facility"))


def stg_tags(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("reference_id"), F.explode(tags_of("tags")).alias("tag"))


def stg_images(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("id").alias("reference_id"), F.explode("images").alias("image_url"))


def stg_areas(*regions: DataFrame) -> DataFrame:
    """All regions' areas (NAMOBJ, WADMKC, WADMKK, WADMPR, geom) with their centroid."""
    out = None
    for r in regions:
        one = r.select(
            F.col("NAMOBJ").alias("subdistrict"), F.col("WADMKC").alias("district"), F.col("WADMKK").alias("city"),
            F.col("WADMPR").alias("province"), geo.centroid("geom").alias("center"), "geom",
        )
        out = one if out is None else out.unionByName(one)
    return out


# -- intermediate ------------------------------------------------------------

def int_specs(specs: DataFrame) -> DataFrame:
    """Parsed, normalised and imputed specs."""
    areas = {k: x.num_suffix(k, chars) for k, chars in v.SPEC_AREA_KEYS.items()}
    ints = {k: x.try_int(k) for k in v.SPEC_INT_KEYS}
    parsed = specs.select(
        "reference_id", *[c.alias(k) for k, c in (areas | ints).items()], x.parse_watt("daya_listrik").alias("daya_listrik"),
        *v.SPEC_TEXT_KEYS, x.normalize_certificate("sertifikat").alias("sertifikat"),
        *[x.normalize_condition(k).alias(k) for k in ("kondisi_properti", "kondisi_perabotan")],
        *[x.flag_or(x.is_yes(k), v.FLAG_DEFAULTS[k]).alias(k) for k in v.SPEC_FLAG_KEYS],
    )
    return parsed.fillna(v.SPEC_DEFAULTS)


def int_houses(houses: DataFrame, districts: DataFrame) -> DataFrame:
    """Priced houses with corrected subdistrict; a district listed twice doubles the row."""
    priced = houses.filter("price IS NOT NULL").withColumn("description", F.coalesce("description", F.lit("")))
    fixed = lookup(priced, districts, "subdistrict", "source", "target", "subdistrict")
    return fixed.select(
        "id", "price", "installment", "description", "subdistrict", "city", "url", "last_modified", "scraped_at"
    )


def int_materials(specs: DataFrame, column: str, name: str) -> DataFrame:
    return specs.select("reference_id", F.explode(materials_of(column)).alias(name))


def int_amenities(amenities: DataFrame) -> DataFrame:
    return amenities.select(
        "id", "element", "amenity", "name", geo.centroid("geom").alias("center"), "geom",
        x.amenity_category("amenity").alias("category"),
    )


def amenities_in_areas(amenities: DataFrame, areas: DataFrame) -> DataFrame:
    return geo.spatial_join(amenities, areas, "center", "geom")


def placed_amenities(amenities: DataFrame, areas: DataFrame) -> DataFrame:
    """Amenities with the names of the area around them: the spatial join both amenity tables are made of."""
    return amenities_in_areas(amenities.select("amenity", "name", "category", "center"), areas.select(*AREA_NAMES, "geom")).drop("geom")


def area_counts_of(placed: DataFrame, categories: list[str] = v.CATEGORY_NAMES) -> DataFrame:
    """Amenities per subdistrict name and category, packed in one struct."""
    wide = agg.pivot_counts(placed, "subdistrict", "category", categories)
    return wide.select("subdistrict", F.struct(*categories).alias("amenities"))


def amenity_area_counts(amenities: DataFrame, areas: DataFrame, categories: list[str] = v.CATEGORY_NAMES) -> DataFrame:
    return area_counts_of(placed_amenities(amenities, areas), categories)


# -- marts -------------------------------------------------------------------

AREA_NAMES = ["subdistrict", "district", "city", "province"]
SPEC_OUT = [
    "kamar_tidur", "kamar_mandi", "kamar_pembantu", "kamar_mandi_pembantu", "dapur", "luas_tanah", "luas_bangunan",
    "jumlah_lantai", "garasi", "carport", "lebar_jalan", "tahun_dibangun", "tahun_di_renovasi", "daya_listrik",
    "hadap", "sertifikat", "sumber_air", "pemandangan", "tipe_properti", "konsep_dan_gaya_rumah",
    "kondisi_properti", "kondisi_perabotan", "hook", "ruang_tamu", "ruang_makan", "terjangkau_internet",
]


def _record(stage: DataFrame, districts: DataFrame, extra: dict[str, Column]) -> DataFrame:
    """House, specs and further expressions of each priced listing, from its one staged record.

    Only the lookup of corrected subdistricts is a join.
    """
    wide = stage.filter("price IS NOT NULL").select(
        F.col("id").alias("reference_id"), "price", "installment", F.coalesce("description", F.lit("")).alias("description"),
        "subdistrict", F.col("city").alias("city_name"), "url", "last_modified", *spec_keys(), *[c.alias(n) for n, c in extra.items()],
    )
    areas = {k: x.num_suffix(k, chars) for k, chars in v.SPEC_AREA_KEYS.items()}
    parsed = wide.withColumns(
        areas | {k: x.try_int(k) for k in v.SPEC_INT_KEYS} | {"daya_listrik": x.parse_watt("daya_listrik")}
        | {"sertifikat": x.normalize_certificate("sertifikat")}
        | {k: x.normalize_condition(k) for k in ("kondisi_properti", "kondisi_perabotan")}
        | {k: x.flag_or(x.is_yes(k), v.FLAG_DEFAULTS[k]) for k in v.SPEC_FLAG_KEYS}
    ).fillna(v.SPEC_DEFAULTS)
    return lookup(parsed, districts, "subdistrict", "source", "target", "subdistrict")


def fact_houses(stage: DataFrame, districts: DataFrame, areas: DataFrame) -> DataFrame:
    """House facts with area, company and image keys.

    Area names are not unique and every image is a row, so a house appears once
    per matching area and distinct image; `wide_listings` is the one-row form.
    """
    rec = _record(stage, districts, {"company": F.col("company"), "image_urls": F.array_distinct("images")})
    a = written(areas.select(*[F.col(c).alias(f"_a_{c}") for c in AREA_NAMES]))
    j = rec.join(a, rec["subdistrict"] == a["_a_subdistrict"], "left")
    j = j.select("*", F.explode_outer("image_urls").alias("image_url"))
    return j.select(
        F.col("reference_id").alias("house_id"), x.surrogate_key(*[f"_a_{c}" for c in AREA_NAMES]).alias("area_sk"),
        x.surrogate_key("company").alias("agent_company_sk"), x.to_idr("price").alias("price"),
        x.to_idr("installment").alias("installment"), *SPEC_OUT, "description", "last_modified", "url", "image_url",
    )


def wide_listings(stage: DataFrame, districts: DataFrame, area_counts: DataFrame) -> DataFrame:
    """One row per listing with specs, lists and the amenity counts of its subdistrict.

    The two lookup tables are written first: with their true size known, Spark
    broadcasts them when small and the listings stay where they are.
    """
    nonempty = lambda c: x.let(c, lambda a: F.when(F.size(a) > 0, a))
    one_per_source = written(agg.distinct_on(districts.select("source", "target"), ["source"]))
    rec = _record(unique_listings(stage.filter("price IS NOT NULL")), one_per_source, {
        "tags": nonempty(F.col("tags")), "facilities": nonempty(F.col("facilities")),
        "image_urls": nonempty(F.col("images")),
    })
    area = written(agg.distinct_on(area_counts.filter("subdistrict IS NOT NULL"), ["subdistrict"]))
    j = rec.join(area.withColumnRenamed("subdistrict", "_a"), F.col("subdistrict") == F.col("_a"), "left")
    return j.select(
        F.col("reference_id").alias("id"), x.to_idr("price").alias("price"), x.to_idr("installment").alias("installment"),
        "subdistrict", F.col("city_name").alias("city"), "description", "url", *SPEC_OUT, "tags", "facilities",
        materials_of("material_bangunan").alias("house_materials"),
        materials_of("material_lantai").alias("floor_materials"), "image_urls", "amenities",
    )


def dim_area(areas: DataFrame) -> DataFrame:
    keyed = areas.select(
        x.surrogate_key(*AREA_NAMES).alias("area_sk"), *AREA_NAMES,
        F.col("center.y").alias("latitude"), F.col("center.x").alias("longitude"),
    )
    return agg.distinct_on(keyed, ["area_sk"])


def area_geometry(areas: DataFrame) -> DataFrame:
    return areas.select(
        x.surrogate_key(*AREA_NAMES).alias("area_sk"), *AREA_NAMES,
        F.col("center.y").alias("latitude"), F.col("center.x").alias("longitude"), "geom",
    )


def fact_amenities_of(placed: DataFrame) -> DataFrame:
    return placed.select(
        x.surrogate_key("amenity").alias("amenity_sk"), x.surrogate_key(*AREA_NAMES).alias("area_sk"), "name",
        F.col("center.y").alias("latitude"), F.col("center.x").alias("longitude"),
    )


def fact_amenities(amenities: DataFrame, areas: DataFrame) -> DataFrame:
    return fact_amenities_of(placed_amenities(amenities, areas))


def dim_materials(specs: DataFrame, column: str, name: str) -> DataFrame:
    return agg.build_dim(int_materials(specs, column, name), name, f"{name}_sk", {name: x.label(name)})


def dim_items(items: DataFrame, key: str) -> DataFrame:
    return agg.build_dim(items, key, f"{key}_sk", {f"{key}_name": x.label(key)})


def dim_companies(stage: DataFrame) -> DataFrame:
    return agg.build_dim(staged_companies(stage), "name", "agent_company_sk", {"company_name": F.coalesce("name", F.lit(v.INDEPENDENT_LABEL))})


def dim_amenities(amenities: DataFrame) -> DataFrame:
    return agg.build_dim(amenities, "amenity", "amenity_sk", {"category_name": x.label("category"), "amenity_name": x.label("amenity")})


def dimensions(stage: DataFrame, amenities: DataFrame | None = None) -> dict[str, DataFrame]:
    """The label dimensions of the star schema, by table name."""
    specs = staged_specs(stage)
    dims = {
        "marts_dim_facilities": dim_items(staged_items(stage, "facilities", "facility"), "facility"),
        "marts_dim_tags": dim_items(staged_items(stage, "tags", "tag"), "tag"),
        "marts_dim_floor_materials": dim_materials(specs, "material_lantai", "floor_material"),
        "marts_dim_house_materials": dim_materials(specs, "material_bangunan", "house_material"),
        "marts_dim_agent_companies": dim_companies(stage),
    }
    return dims if amenities is None else dims | {"marts_dim_amenities": dim_amenities(amenities)}


def bridge_of(items: DataFrame, key: str) -> DataFrame:
    return agg.build_bridge(items, "reference_id", key, f"{key}_sk")


def bridges(stage: DataFrame) -> dict[str, DataFrame]:
    specs = staged_specs(stage)
    return {
        "marts_bridge_house_facilities": bridge_of(staged_items(stage, "facilities", "facility"), "facility"),
        "marts_bridge_house_tags": bridge_of(staged_items(stage, "tags", "tag"), "tag"),
        "marts_bridge_house_floor_materials": bridge_of(int_materials(specs, "material_lantai", "floor_material"), "floor_material"),
        "marts_bridge_house_house_materials": bridge_of(int_materials(specs, "material_bangunan", "house_material"), "house_material"),
    }


def star_schema(raw: DataFrame, districts: DataFrame, areas: DataFrame, amenities: DataFrame) -> dict[str, DataFrame]:
    """Every mart by table name, nothing stored; `layers.build` stores what several of them read."""
    stage, named = staged(raw), int_amenities(amenities)
    return {
        "marts_fact_houses": fact_houses(stage, districts, areas),
        "marts_fact_amenities": fact_amenities(named, areas),
        "marts_dim_area": dim_area(areas),
        **dimensions(stage, named), **bridges(stage),
        "marts_downstream_houses": wide_listings(stage, districts, amenity_area_counts(named, areas)),
        "marts_downstream_area_geometry": area_geometry(areas),
    }
