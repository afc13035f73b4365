"""Star schema, wide table, geometry, sources, sinks and the feed."""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..functions import sqlnames, text as x, vocab as v
from ..operators import aggregates as agg
from ..operators import geo, quality
from ..plans import checks, layers
from ..plans import listings as plan
from ..plans.derived import RAW_CTE, raw_listings
from ..session import shared_folder
from ..sources import readers, writers
from ..streaming.feed import ingest_stream
from .registry import query, table
from .scalar import AMENITIES, AMENITY_SQL, STRIP, TITLE, _condition_sql, _sk

# -- inputs derived from the given tables ------------------------------------

# outer ring (with a notch) and hole of an area, relative to its origin
OUTER = [(0, 0), (12, 0), (12, 9), (6, 4.5), (0, 9)]
HOLE = [(2, 1), (3, 1), (3, 2), (2, 2)]
OX, OY = "(n_nationkey % 5) * 10.0D", "floor(n_nationkey / 5) * 10.0D"


def areas(spark, d, named=False):
    """One area per nation; every fourth name is used twice."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    ring = lambda pts: F.array(*[
        F.struct(F.expr(f"{OX} + {a}D").alias("x"), F.expr(f"{OY} + {b}D").alias("y")) for a, b in pts])
    shapes = n.select(
        F.col("n_name").alias("NAMOBJ"), F.concat(F.lit("Kec "), F.col("n_nationkey")).alias("WADMKC"),
        F.lit("Bogor").alias("WADMKK"), F.col("r_name").alias("WADMPR"), geo.polygon(ring(OUTER), ring(HOLE)).alias("geom"),
        (F.col("n_nationkey") % 4 == 0).alias("twice"))
    first = shapes.drop("twice")
    second = shapes.filter("twice").withColumn("WADMKC", F.concat("WADMKC", F.lit(" B"))).drop("twice")
    return plan.stg_areas(first, second)


def _ring_values(pts, ring):
    return ", ".join(f"({ring}, {a}, {b}, {p}, {q})" for (a, b), (p, q) in zip(pts, pts[1:] + pts[:1]))


AREA_CTE = f"""base AS (SELECT n_nationkey AS k, n_name AS subdistrict, 'Kec ' || n_nationkey AS district, 'Bogor' AS city, r_name AS province,
  (n_nationkey % 5) * 10.0::DOUBLE AS ox, floor(n_nationkey / 5) * 10.0::DOUBLE AS oy FROM nation JOIN region ON n_regionkey = r_regionkey),
area AS (SELECT * FROM base UNION ALL SELECT k, subdistrict, district || ' B', city, province, ox, oy FROM base WHERE k % 4 = 0),
edge AS (SELECT k, ring, ox + ax::DOUBLE AS ax, oy + ay::DOUBLE AS ay, ox + bx::DOUBLE AS bx, oy + by_::DOUBLE AS by_ FROM base,
  (VALUES {_ring_values(OUTER, 0)}, {_ring_values(HOLE, 1)}) e(ring, ax, ay, bx, by_))"""
CENTER_CTE = """moment AS (SELECT k, ring, sum(ax * by_ - bx * ay) / 2 AS a, sum((ax + bx) * (ax * by_ - bx * ay)) / 6 AS mx,
  sum((ay + by_) * (ax * by_ - bx * ay)) / 6 AS my FROM edge GROUP BY k, ring),
center AS (SELECT k, sum(w * mx) / sum(w * a) AS x, sum(w * my) / sum(w * a) AS y FROM
  (SELECT k, sign(a) * CASE WHEN ring = 0 THEN 1 ELSE -1 END AS w, a, mx, my FROM moment) GROUP BY k)"""

PX, PY = "((c_custkey * 37) % 6300) / 100.0", "((c_custkey * 53) % 5900) / 100.0"
AMENITY = "CASE (c_custkey % 12) " + " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(AMENITIES)) + " END"


def amenity_features(spark, d):
    """One amenity point per customer."""
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("id"), F.lit("node").alias("element"), F.expr(AMENITY).alias("amenity"),
        F.col("c_name").alias("name"),
        geo.point(F.expr(PX.replace("100.0", "100.0D")), F.expr(PY.replace("100.0", "100.0D"))).alias("geom"))


def amenities(spark, d):
    return plan.int_amenities(amenity_features(spark, d))


POINT_CTE = f"""pt AS (SELECT c_custkey AS id, c_name AS name, {AMENITY} AS amenity, CAST({PX} AS DOUBLE) AS px, CAST({PY} AS DOUBLE) AS py FROM customer),
hit AS (SELECT id, k FROM (SELECT id, k,
  count(*) FILTER ((ay > py) <> (by_ > py) AND px < ax + (py - ay) * (bx - ax) / nullif(by_ - ay, 0)) AS crossings,
  bool_or((bx - ax) * (py - ay) - (by_ - ay) * (px - ax) = 0 AND px BETWEEN least(ax, bx) AND greatest(ax, bx) AND py BETWEEN least(ay, by_) AND greatest(ay, by_)) AS edge_hit
  FROM pt, edge GROUP BY id, k) WHERE crossings % 2 = 1 AND NOT edge_hit),
placed AS (SELECT pt.*, area.subdistrict, area.district, area.city, area.province FROM pt LEFT JOIN hit USING (id) LEFT JOIN area ON hit.k = area.k)"""


def districts(spark, d):
    """Corrections for some names; one source is listed twice."""
    n = table(spark, d, "nation")
    fix = n.filter("n_nationkey % 3 = 1").select(
        F.col("n_name").alias("source"), F.concat(F.lit("NATION_"), (F.col("n_nationkey") + 1) % 25).alias("target"))
    return fix.unionByName(n.filter("n_nationkey = 4").select(F.col("n_name").alias("source"), F.lit("NATION_Z").alias("target")))


DISTRICT_CTE = """district AS (SELECT n_name AS source, 'NATION_' || (n_nationkey + 1) % 25 AS target FROM nation WHERE n_nationkey % 3 = 1
  UNION ALL SELECT n_name, 'NATION_Z' FROM nation WHERE n_nationkey = 4)"""
def _spec_sql(name: str) -> str:
    """Checking SQL of one spec column, defaults included."""
    if name in v.SPEC_AREA_KEYS:
        e = f"CAST(TRY_CAST(rtrim({name}, '{v.SPEC_AREA_KEYS[name]}') AS FLOAT) AS DOUBLE)"
    elif name in v.SPEC_INT_KEYS:
        e = f"TRY_CAST({name} AS INT)"
    elif name == "daya_listrik":
        e = "CAST(TRY_CAST(replace(rtrim(lower(daya_listrik), 'watt'), 'lainnya', '0') AS FLOAT) AS DOUBLE)"
    elif name == "sertifikat":
        e = "CASE WHEN sertifikat ILIKE '%ppjb%' OR sertifikat ILIKE '%lainnya%' THEN 'Lainnya' ELSE sertifikat END"
    elif name in ("kondisi_properti", "kondisi_perabotan"):
        e = _condition_sql(name)
    elif name in v.SPEC_FLAG_KEYS:
        return f"coalesce(CAST({name} = 'Ya' AS INT), {v.FLAG_DEFAULTS[name]})"
    else:
        e = name
    return f"coalesce({e}, {v.SPEC_DEFAULTS[name]})" if name in v.SPEC_DEFAULTS else e


SPEC_SQL = "spec AS (SELECT id, " + ", ".join(f"{_spec_sql(n)} AS {n}" for n in plan.SPEC_OUT) + " FROM raw)"
SPEC_COLUMNS = ", ".join(f"spec.{n}" for n in plan.SPEC_OUT)
HOUSE_SQL = """house AS (SELECT id, price, installment, coalesce(description, '') AS description, coalesce(target, sub) AS subdistrict, city, url,
  strftime(TRY_CAST(last_modified AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS last_modified
  FROM (SELECT *, string_split(address, ', ')[1] AS sub, string_split(address, ', ')[2] AS city FROM raw WHERE price IS NOT NULL) h
  LEFT JOIN {0} district ON sub = source)"""
FIRST_DISTRICT = "(SELECT source, min(target) AS target FROM district GROUP BY source)"
COMPANY_SQL = f"""c AS (SELECT id, company_name AS company FROM raw), cn AS (SELECT *, upper({STRIP.format('company')}) AS name FROM c),
cp AS (SELECT *, replace(name, 'PROPERTY', 'PROPERTI') AS folded FROM cn),
cb AS (SELECT *, trim(regexp_replace({sqlnames.bare_company('folded')}, ' +', ' ', 'g')) AS bare FROM cp),
company AS (SELECT id, {sqlnames.company_case('name', 'folded', 'bare')} AS agency FROM cb)"""
FACILITY_SQL = f"""fu AS (SELECT id, unnest(facilities) AS f, unnest(range(len(facilities))) AS pos FROM raw),
fn AS (SELECT id, pos, upper({STRIP.format('f')}) AS name FROM fu),
facility AS (SELECT * FROM (SELECT id, pos, {sqlnames.facility_case('name')} AS facility FROM fn) WHERE facility IS NOT NULL)"""
TAG_SQL = """tu AS (SELECT id, unnest(tags) AS t, unnest(range(len(tags))) AS pos FROM raw),
tag AS (SELECT id, pos, unnest(string_split(replace(lower(t), ' ', '_'), '/')) AS tag, unnest(range(len(string_split(t, '/')))) AS sub FROM tu)"""


def _materials(column, name):
    return f"""{name} AS (SELECT id, replace(trim(m), ' ', '_') AS {name}, pos FROM (SELECT id, unnest(string_split(lower({column}), ',')) AS m,
  unnest(range(len(string_split({column}, ',')))) AS pos FROM raw))"""


# -- J3, J4, dimensions, bridges ---------------------------------------------

@query("j03_fact_houses", RAW_CTE + f""", {DISTRICT_CTE}, {AREA_CTE}, {SPEC_SQL}, {HOUSE_SQL.format('')}, {COMPANY_SQL},
img AS (SELECT DISTINCT id, image_url FROM (SELECT id, unnest(images) AS image_url FROM raw))
SELECT house.id AS house_id, {_sk('area.subdistrict', 'area.district', 'area.city', 'area.province')} AS area_sk,
{_sk('agency')} AS agent_company_sk, round(price * 1000000, 2) AS price, round(installment * 1000000, 2) AS installment,
{SPEC_COLUMNS}, description, last_modified, url, image_url
FROM house JOIN spec ON spec.id = house.id LEFT JOIN img ON img.id = house.id LEFT JOIN area ON house.subdistrict = area.subdistrict
LEFT JOIN company ON company.id = house.id""")
def _(spark, d):
    f = plan.fact_houses(plan.staged(raw_listings(spark, d)), districts(spark, d), areas(spark, d))
    return _plain(f)


def _plain(df):
    """Sums rounded, parsed single-precision numbers as doubles, times as text, lists joined."""
    def one(name, kind):
        if name in ("price", "installment"):
            return F.round(name, 2).alias(name)
        if kind == "float":
            return F.col(name).cast("double").alias(name)
        if kind == "timestamp":
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        return F.array_join(name, "|").alias(name) if kind.startswith("array") else F.col(name)

    return df.select(*[one(n, k) for n, k in df.dtypes])


COUNT_SQL = "counts AS (SELECT subdistrict, " + ", ".join(
    f"CAST(sum(CASE WHEN category = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in v.CATEGORY_NAMES
) + f" FROM (SELECT subdistrict, {AMENITY_SQL} AS category FROM placed) GROUP BY subdistrict)"


@query("j04_wide_listings", RAW_CTE + f""", {DISTRICT_CTE}, {AREA_CTE}, {POINT_CTE}, {COUNT_SQL}, {SPEC_SQL},
{HOUSE_SQL.format(FIRST_DISTRICT)}, {FACILITY_SQL}, {TAG_SQL}, {_materials('material_bangunan', 'wall')}, {_materials('material_lantai', 'floor')}
SELECT house.id, round(price * 1000000, 2) AS price, round(installment * 1000000, 2) AS installment, house.subdistrict, house.city, description, url,
{SPEC_COLUMNS}, t.tags, f.facilities, w.house_materials, l.floor_materials, array_to_string(images, '|') AS image_urls,
{", ".join(f"counts.{c} AS amenities_{c}" for c in v.CATEGORY_NAMES)} FROM house JOIN spec ON spec.id = house.id JOIN (SELECT id, images FROM raw) ri ON ri.id = house.id
LEFT JOIN (SELECT id, string_agg(tag, '|' ORDER BY pos, sub) AS tags FROM tag WHERE tag IS NOT NULL GROUP BY id) t ON t.id = house.id
LEFT JOIN (SELECT id, string_agg(facility, '|' ORDER BY pos) AS facilities FROM facility GROUP BY id) f ON f.id = house.id
LEFT JOIN (SELECT id, string_agg(wall, '|' ORDER BY pos) AS house_materials FROM wall GROUP BY id) w ON w.id = house.id
LEFT JOIN (SELECT id, string_agg(floor, '|' ORDER BY pos) AS floor_materials FROM floor GROUP BY id) l ON l.id = house.id
LEFT JOIN counts ON house.subdistrict = counts.subdistrict""")
def _(spark, d):
    counts = plan.amenity_area_counts(amenities(spark, d), areas(spark, d), v.CATEGORY_NAMES)
    w = plan.wide_listings(plan.staged(raw_listings(spark, d)), districts(spark, d), counts)
    return _plain(w.select("*", *[F.col(f"amenities.{c}").alias(f"amenities_{c}") for c in v.CATEGORY_NAMES]).drop("amenities"))


@query("a02b_dimensions", RAW_CTE + f""", {FACILITY_SQL}, {TAG_SQL}, {_materials('material_bangunan', 'wall')}, {_materials('material_lantai', 'floor')}, {COMPANY_SQL},
named AS (SELECT DISTINCT 'marts_dim_facilities' AS dim, facility AS k FROM facility UNION SELECT 'marts_dim_tags', tag FROM tag WHERE tag IS NOT NULL
UNION SELECT 'marts_dim_house_materials', wall FROM wall UNION SELECT 'marts_dim_floor_materials', floor FROM floor)
SELECT dim, md5(k) AS sk, {TITLE.format("replace(k, '_', ' ')")} AS label FROM named
UNION ALL SELECT DISTINCT 'marts_dim_agent_companies', {_sk('agency')}, coalesce(agency, 'Independen') FROM company""")
def _(spark, d):
    out = None
    for name, df in plan.dimensions(plan.staged(raw_listings(spark, d))).items():
        sk, label = df.columns
        one = df.select(F.lit(name).alias("dim"), F.col(sk).alias("sk"), F.col(label).alias("label"))
        out = one if out is None else out.unionByName(one)
    return out


@query("a03b_bridges", RAW_CTE + f""", {FACILITY_SQL}, {TAG_SQL}, {_materials('material_bangunan', 'wall')}, {_materials('material_lantai', 'floor')}
SELECT 'marts_bridge_house_facilities' AS bridge, id AS house_id, md5(facility) AS sk FROM facility
UNION ALL SELECT 'marts_bridge_house_tags', id, md5(tag) FROM tag WHERE tag IS NOT NULL
UNION ALL SELECT 'marts_bridge_house_house_materials', id, md5(wall) FROM wall
UNION ALL SELECT 'marts_bridge_house_floor_materials', id, md5(floor) FROM floor""")
def _(spark, d):
    out = None
    for name, df in plan.bridges(plan.staged(raw_listings(spark, d))).items():
        one = df.select(F.lit(name).alias("bridge"), "house_id", F.col(df.columns[1]).alias("sk"))
        out = one if out is None else out.unionByName(one)
    return out


TAGS = ["bisa_nego", "cash_bertahap", "hook", "kpr", "promo", "siap_huni", "strategis"]


def _flags_sql(cte: str, source: str, column: str, values: list[str], prefix: str) -> str:
    return RAW_CTE + f", {cte} SELECT id AS reference_id, " + ", ".join(
        f"max(CASE WHEN {column} = '{t}' THEN 1 ELSE 0 END) AS {prefix}{t}" for t in values) + f" FROM {source} WHERE {column} IS NOT NULL GROUP BY id"


@query("a04b_tags_by_house", _flags_sql(TAG_SQL, "tag", "tag", TAGS, "tag_"))
def _(spark, d):
    return agg.pivot_flags(plan.stg_tags(raw_listings(spark, d)), "reference_id", "tag", TAGS, "tag_")


FACILITIES = ["ac", "akses_parkir", "keamanan", "kolam_renang", "masjid", "taman"]


@query("a04c_facilities_by_house", _flags_sql(FACILITY_SQL, "facility", "facility", FACILITIES, "facility_"))
def _(spark, d):
    return agg.pivot_flags(plan.stg_facilities(raw_listings(spark, d)), "reference_id", "facility", FACILITIES, "facility_")


WALLS, FLOORS = ["bata_hebel", "bata_merah", "batako", "beton"], ["granit", "kayu", "keramik", "marmer", "ubin", "vinyl"]


@query("a04d_floor_materials_by_house", _flags_sql(_materials("material_lantai", "floor"), "floor", "floor", FLOORS, "floor_"))
def _(spark, d):
    return agg.pivot_flags(plan.int_materials(plan.stg_specs(raw_listings(spark, d)), "material_lantai", "floor"), "reference_id", "floor", FLOORS, "floor_")


@query("a04e_house_materials_by_house", _flags_sql(_materials("material_bangunan", "wall"), "wall", "wall", WALLS, "wall_"))
def _(spark, d):
    return agg.pivot_flags(plan.int_materials(plan.stg_specs(raw_listings(spark, d)), "material_bangunan", "wall"), "reference_id", "wall", WALLS, "wall_")


@query("p25b_agents", RAW_CTE + f"""
SELECT id AS reference_id, sha256(concat(agent_name, agent_phone)) AS agent_hash,
array_to_string(list_transform(string_split(agent_name, ' '), lambda w: w[1] || repeat('x', length(w) - 1)), ' ') AS name,
CASE WHEN length(agent_phone) >= 3 THEN repeat('x', length(agent_phone) - 3) || right(agent_phone, 3) END AS phone FROM raw""")
def _(spark, d):
    return plan.stg_agents(raw_listings(spark, d))


@query("p03b_specs_from_map", RAW_CTE + " SELECT id AS reference_id, luas_tanah, konsep_dan_gaya_rumah, hook FROM raw")
def _(spark, d):
    return plan.stg_specs(raw_listings(spark, d)).select("reference_id", "luas_tanah", "konsep_dan_gaya_rumah", "hook")


# -- geometry ----------------------------------------------------------------

@query("x01_centroid", f"""WITH {AREA_CTE}, {CENTER_CTE} SELECT subdistrict, district, round(x, 6) AS x, round(y, 6) AS y FROM area JOIN center USING (k)""")
def _(spark, d):
    return areas(spark, d).select(
        "subdistrict", "district", F.round("center.x", 6).alias("x"), F.round("center.y", 6).alias("y"))


@query("x02_point_coordinates", f"SELECT c_custkey AS id, CAST({PY} AS DOUBLE) AS latitude, CAST({PX} AS DOUBLE) AS longitude FROM customer")
def _(spark, d):
    return amenities(spark, d).select("id", F.col("center.y").alias("latitude"), F.col("center.x").alias("longitude"))


@query("x03_contains", f"WITH {AREA_CTE}, {POINT_CTE} SELECT hit.id, k AS n_nationkey FROM hit")
def _(spark, d):
    a = areas(spark, d).filter("district NOT LIKE '% B'").select(
        F.split("district", " ")[1].cast("int").alias("n_nationkey"), "geom")
    j = geo.spatial_join(amenities(spark, d).select("id", "center"), a, "center", "geom")
    return j.filter("n_nationkey IS NOT NULL").select("id", "n_nationkey")


@query("x04_area_geometry", f"""WITH {AREA_CTE}, {CENTER_CTE} SELECT {_sk('subdistrict', 'district', 'city', 'province')} AS area_sk, subdistrict, district,
round(y, 6) AS latitude, round(x, 6) AS longitude, CAST({len(OUTER) + len(HOLE)} AS INT) AS vertices FROM area JOIN center USING (k)""")
def _(spark, d):
    g = plan.area_geometry(areas(spark, d))
    n = F.aggregate(F.flatten("geom.polygons"), F.lit(0), lambda a, ring: a + F.size(ring))
    return g.select(
        "area_sk", "subdistrict", "district", F.round("latitude", 6).alias("latitude"),
        F.round("longitude", 6).alias("longitude"), n.alias("vertices"))


@query("d01b_dim_area", f"""WITH {AREA_CTE}, {CENTER_CTE} SELECT DISTINCT {_sk('subdistrict', 'district', 'city', 'province')} AS area_sk, subdistrict, district, city, province,
round(y, 6) AS latitude, round(x, 6) AS longitude FROM area JOIN center USING (k)""")
def _(spark, d):
    a = areas(spark, d)
    dim = plan.dim_area(a.unionByName(a))
    return dim.withColumns({c: F.round(c, 6) for c in ("latitude", "longitude")})


@query("j05_spatial_join", f"WITH {AREA_CTE}, {POINT_CTE} SELECT id, amenity, subdistrict, district FROM placed")
def _(spark, d):
    j = plan.amenities_in_areas(amenities(spark, d), areas(spark, d).select("subdistrict", "district", "geom"))
    return j.select("id", "amenity", "subdistrict", "district")


@query("j05b_area_counts", f"WITH {AREA_CTE}, {POINT_CTE}, {COUNT_SQL} SELECT * FROM counts")
def _(spark, d):
    c = plan.amenity_area_counts(amenities(spark, d), areas(spark, d))
    return c.select("subdistrict", "amenities.*")


@query("j05c_fact_amenities", f"""WITH {AREA_CTE}, {POINT_CTE} SELECT md5(amenity) AS amenity_sk, {_sk('subdistrict', 'district', 'city', 'province')} AS area_sk,
name, py AS latitude, px AS longitude FROM placed""")
def _(spark, d):
    return plan.fact_amenities(amenities(spark, d), areas(spark, d))


# -- sources and sinks -------------------------------------------------------

def fresh_path(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


@query("s01_read_listings", RAW_CTE + " SELECT id, price, address, luas_tanah, company_name, len(facilities) AS n FROM raw")
def _(spark, d):
    path = fresh_path(spark)
    raw_listings(spark, d).write.json(path)
    got = readers.read_listings(spark, path)
    return got.select(
        "id", "price", "address", F.col("specs")["Luas Tanah"].alias("luas_tanah"),
        F.col("agent.company.name").alias("company_name"), F.when(F.col("facilities").isNotNull(), F.size("facilities")).cast("long").alias("n"))


@query("s02_read_district_map", f"WITH {DISTRICT_CTE} SELECT * FROM district")
def _(spark, d):
    path = fresh_path(spark)
    districts(spark, d).write.json(path)
    return readers.read_district_map(spark, path, lines=True)


def _feature(spark, df, props):
    """Write features one per line, as the GeoJSON export does."""
    path = fresh_path(spark)
    writers.export_geojson(df.select(*props, "geom"), path)
    return path


@query("s03_read_geojson", f"SELECT c_custkey AS id, 'node' AS element, {AMENITY} AS amenity, CAST({PX} AS DOUBLE) AS px FROM customer")
def _(spark, d):
    path = _feature(spark, amenities(spark, d), ["element", "id", "amenity", "name"])
    got = readers.read_geojson(spark, path, lines=True)
    return got.select("id", "element", "amenity", F.col("geom.point.x").alias("px"))


@query("s03b_feature_collections", f"SELECT c_custkey AS id, 'node' AS element, {AMENITY} AS amenity, CAST({PX} AS DOUBLE) AS px, CAST({PY} AS DOUBLE) AS py FROM customer")
def _(spark, d):
    """The same features as FeatureCollection documents of 500, split at their features when read."""
    path = fresh_path(spark)
    lines = writers.geojson_lines(amenities(spark, d).select("element", "id", "amenity", "name", "geom"))
    some = lines.groupBy(F.pmod(F.xxhash64("value"), F.ceil(lines.agg(F.count(F.lit(1)) / 500).scalar())).alias("doc"))
    doc = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("value"), ","), F.lit("]}"))
    some.agg(doc.alias("value")).select("value").write.text(path)
    got = readers.read_geojson(spark, path)
    return got.select("id", "element", "amenity", F.col("geom.point.x").alias("px"), F.col("geom.point.y").alias("py"))


@query("s04_read_areas", f"WITH {AREA_CTE}, {CENTER_CTE} SELECT subdistrict, district, province, round(x, 6) AS x FROM area JOIN center USING (k)")
def _(spark, d):
    a = areas(spark, d).withColumnsRenamed({"subdistrict": "NAMOBJ", "district": "WADMKC", "city": "WADMKK", "province": "WADMPR"})
    names = ["NAMOBJ", "WADMKC", "WADMKK", "WADMPR"]
    east, west = (_feature(spark, a.filter(c), names) for c in ("center.x > 25", "center.x <= 25"))
    got = plan.stg_areas(*readers.read_areas(spark, east, west, lines=True))
    return got.select("subdistrict", "district", "province", F.round("center.x", 6).alias("x"))


@query("s06_export_parquet", RAW_CTE + " SELECT id, price, hook FROM raw")
def _(spark, d):
    path = fresh_path(spark)
    writers.export_parquet(raw_listings(spark, d).select("id", "price", F.col("specs")["Hook"].alias("hook")), path)
    return spark.read.parquet(path)


def _ring_text(pts) -> str:
    return "'[' || " + " || ',' || ".join(
        f"'[' || CAST(ox + {a} AS VARCHAR) || ',' || CAST(oy + {b} AS VARCHAR) || ']'" for a, b in pts) + " || ']'"


@query("s07_export_geojson", f"""WITH {AREA_CTE} SELECT '{{"type":"Feature","bbox":[' || CAST(ox AS VARCHAR) || ',' || CAST(oy AS VARCHAR) || ',' || CAST(ox + 12 AS VARCHAR) || ','
|| CAST(oy + 9 AS VARCHAR) || '],"properties":{{"subdistrict":"' || subdistrict || '","district":"' || district || '"}},"geometry":{{"type":"Polygon","coordinates":['
|| {_ring_text(OUTER)} || ',' || {_ring_text(HOLE)} || ']}}}}' AS value FROM area""")
def _(spark, d):
    path = _feature(spark, areas(spark, d), ["subdistrict", "district"])
    return spark.read.text(path)


@query("s08_publish", "SELECT 'marts_dim_segment' AS name, count(DISTINCT c_mktsegment) AS n FROM customer UNION ALL SELECT 'marts_fact_customers', count(*) FROM customer")
def _(spark, d):
    db = f"published_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{fresh_path(spark)}'")
    c = table(spark, d, "customer")
    views = {
        "marts_fact_customers": c, "marts_dim_segment": c.select("c_mktsegment").distinct(),
        "marts_downstream_customers": c, "stg_customers": c,
    }
    writers.build_layer(spark, views)
    names = writers.publish(spark, db)
    for n in views:
        spark.catalog.dropTempView(n)
    out = None
    for n in names:
        one = spark.table(f"{db}.{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("s10_list_files", "SELECT 'house=' || p_size AS parent_id, 1 AS files, true AS named FROM part GROUP BY p_size")
def _(spark, d):
    """Files written from a table, one in the folder of each parent, listed again."""
    root = fresh_path(spark)
    table(spark, d, "part").select(F.col("p_size").alias("house"), "p_name").repartition("house").write.partitionBy("house").text(root)
    files = readers.list_files(spark, root, "*.txt")
    named = F.col("id") == F.sha2("file_path", 256)
    return files.groupBy("parent_id").agg(F.count(F.lit(1)).cast("int").alias("files"), F.bool_and(named).alias("named"))


# three batches, the second sent twice: customers in part, all under other names, a few more
@query("s09b_insert_batches", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'Again ' || c_name END AS c_name FROM customer
UNION ALL SELECT -n_nationkey - 1, n_name FROM nation""")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    more = table(spark, d, "nation").select((-F.col("n_nationkey") - 1).cast("bigint").alias("c_custkey"), F.col("n_name").alias("c_name"))
    again = c.withColumn("c_name", F.concat(F.lit("Again "), "c_name"))
    target = fresh_path(spark)
    for number, batch in ((0, c.filter("c_custkey % 3 = 0")), (1, again), (1, again), (2, more.union(c))):
        writers.insert_new(batch, target, ["c_custkey"], writer="customers", batch=number)
    return writers.read_inserted(spark, target, c.schema)


@query("s11_build_layer", RAW_CTE + " SELECT string_split(address, ', ')[2] AS city, count(*) AS n, count(price) AS priced FROM raw GROUP BY 1")
def _(spark, d):
    writers.build_layer(spark, {"lotlens_stg_houses": plan.stg_houses(raw_listings(spark, d))})
    return spark.sql("SELECT city, count(*) AS n, count(price) AS priced FROM lotlens_stg_houses GROUP BY city")


# -- layers built once, declared checks ---------------------------------------

def layer_sources(spark, d):
    """The four sources with the versions of the files they come from."""
    of = lambda *names: layers.files_version(spark, *[f"{d}/{n}.parquet" for n in names])
    return {
        "listings": (raw_listings(spark, d), of("orders")), "districts": (districts(spark, d), of("nation")),
        "areas": (areas(spark, d), of("nation", "region")), "amenities": (amenity_features(spark, d), of("customer")),
    }


LAYER_CTE = RAW_CTE + f""", {DISTRICT_CTE}, {AREA_CTE}, {POINT_CTE}, {SPEC_SQL}, {HOUSE_SQL.format('')}, {COMPANY_SQL},
one_house AS (SELECT h.*, coalesce(f.target, sub) AS named FROM (SELECT *, string_split(address, ', ')[1] AS sub, string_split(address, ', ')[2] AS town
  FROM raw WHERE price IS NOT NULL) h LEFT JOIN {FIRST_DISTRICT} f ON sub = f.source),
{FACILITY_SQL}, {TAG_SQL}, {_materials('material_bangunan', 'wall')}, {_materials('material_lantai', 'floor')},
img AS (SELECT DISTINCT id, image_url FROM (SELECT id, unnest(images) AS image_url FROM raw))"""
MART_COUNTS = {
    "bridge_house_facilities": "facility", "bridge_house_floor_materials": "floor", "bridge_house_house_materials": "wall",
    "bridge_house_tags": "tag WHERE tag IS NOT NULL", "dim_agent_companies": "(SELECT DISTINCT agency FROM company)",
    "dim_amenities": "(SELECT DISTINCT amenity FROM pt)", "dim_area": "(SELECT DISTINCT subdistrict, district, city, province FROM area)",
    "dim_facilities": "(SELECT DISTINCT facility FROM facility)", "dim_floor_materials": "(SELECT DISTINCT floor FROM floor)",
    "dim_house_materials": "(SELECT DISTINCT wall FROM wall)", "dim_tags": "(SELECT DISTINCT tag FROM tag WHERE tag IS NOT NULL)",
    "fact_amenities": "placed",
    "fact_houses": "house LEFT JOIN img ON img.id = house.id LEFT JOIN area ON house.subdistrict = area.subdistrict",
}


@query("s11b_build_marts", LAYER_CTE + " " + " UNION ALL ".join(
    f"SELECT 'marts_{n}' AS name, count(*) AS n, true AS kept FROM {t}" for n, t in MART_COUNTS.items()))
def _(spark, d):
    """All marts built from staging stored once and published; a second build of the same sources makes nothing."""
    target, db = fresh_path(spark), f"published_{uuid.uuid4().hex[:12]}"
    sources = layer_sources(spark, d)
    tables, _ = layers.build(spark, sources, target)
    _, again = layers.build(spark, sources, target)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{fresh_path(spark)}'")
    writers.build_layer(spark, {n: t for n, t in tables.items() if n.startswith("marts")})
    names = writers.publish(spark, db)
    for n in tables:
        spark.catalog.dropTempView(n)
    counts = [spark.table(f"{db}.{n}").agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n"), F.lit(n not in again).alias("kept")) for n in names]
    return reduce(lambda a, b: a.unionAll(b), counts)


CHECKED = {
    "stg_houses": "SELECT id, TRY_CAST(scraped_at AS TIMESTAMP) AS scraped_at FROM raw",
    "stg_agents": "SELECT id AS reference_id, sha256(concat(agent_name, agent_phone)) AS agent_hash FROM raw",
    "stg_agent_companies": "SELECT id AS reference_id FROM raw", "stg_specs": "SELECT id AS reference_id FROM raw",
    "stg_facilities": "SELECT id AS reference_id, facility FROM facility",
    "stg_tags": "SELECT id AS reference_id, tag FROM tag WHERE tag IS NOT NULL", "stg_images": "SELECT id AS reference_id, unnest(images) AS image_url FROM raw",
    "stg_areas": "SELECT 1 AS center, 1 AS geom FROM area", "int_specs": "SELECT id AS reference_id, * EXCLUDE (id) FROM spec",
    "int_floor_materials": "SELECT id AS reference_id, floor AS floor_material FROM floor",
    "int_house_materials": "SELECT id AS reference_id, wall AS house_material FROM wall",
    "marts_downstream_houses": """SELECT one_house.id, one_house.price, one_house.installment, one_house.named AS subdistrict, one_house.town AS city,
  one_house.url, spec.* EXCLUDE (id) FROM one_house JOIN spec ON spec.id = one_house.id""",
}


def _check_sql(c) -> str:
    head = f"SELECT '{c.table}' AS table_name, '{c.kind}' AS check_name, '{c.column}' AS column_name, "
    text = f"{head}CAST({c.column} AS VARCHAR) AS value, count(*) AS violations FROM t_{c.table} WHERE {c.column} IS NOT NULL"
    if c.kind == "not_null":
        return f"{head}CAST(NULL AS VARCHAR) AS value, count(*) AS violations FROM t_{c.table} WHERE {c.column} IS NULL HAVING count(*) > 0"
    if c.kind == "unique":
        return f"{text} GROUP BY {c.column} HAVING count(*) > 1"
    if c.kind == "relationships":
        return f"{text} AND {c.column} NOT IN (SELECT {c.parent[1]} FROM t_{c.parent[0]} WHERE {c.parent[1]} IS NOT NULL) GROUP BY {c.column}"
    return f"{text} AND {c.column} NOT IN ({', '.join(repr(a) for a in c.accepted)}) GROUP BY {c.column}"


@query("q05_declared_checks", LAYER_CTE + ", " + ", ".join(f"t_{n} AS ({t})" for n, t in CHECKED.items()) + " " + " UNION ALL ".join(
    _check_sql(c) for c in checks.CHECKS))
def _(spark, d):
    tables, _ = layers.build(spark, layer_sources(spark, d), fresh_path(spark), sorted({c.table for c in checks.CHECKS}))
    return quality.run_checks(tables, checks.CHECKS)


@query("r01_ingest_stream", """
SELECT 'ev' || event_id AS id, user_id, event_type, round(value, 4) AS value FROM events""")
def _(spark, d):
    e = table(spark, d, "events").select(
        F.concat(F.lit("ev"), F.col("event_id")).alias("id"), "user_id", "event_type", "value",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"))
    feed, target = fresh_path(spark), fresh_path(spark)
    schema = "id string, user_id bigint, event_type string, value double, scraped_at string"
    clean = lambda df: df.filter("value IS NOT NULL")
    bad = e.filter("user_id % 2 = 0").withColumn("value", F.lit(None).cast("double"))
    # two arrivals: half of the ids in a copy that is rejected (and repeats), then good copies of all
    for part in (bad.unionByName(e.filter("user_id % 10 = 1")).unionByName(e.filter("user_id % 5 = 1")), e):
        part.write.mode("append").json(feed)
        ingest_stream(spark, feed, target, f"{target}_state", schema, clean=clean)
    got = writers.read_inserted(spark, target, spark.createDataFrame([], schema).schema)
    return got.select("id", "user_id", "event_type", F.round("value", 4).alias("value"))
