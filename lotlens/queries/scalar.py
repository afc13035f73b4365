"""Scalar functions over whole tables."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sqlnames, text as x, vocab as v
from ..operators import render
from ..plans.derived import RAW_CTE, flat_listings
from ..plans.listings import materials_of
from .registry import query, table


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NUM = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"
TITLE = (
    r"array_to_string(list_transform(regexp_extract_all({0}, '[\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+'), "
    "lambda w: CASE w[1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(w[2:])), '')"
)


def _sk(*cols: str) -> str:
    return "md5(" + " || '-' || ".join(f"coalesce(CAST({c} AS VARCHAR), '{v.NULL_KEY_MARK}')" for c in cols) + ")"


@query("p01_split_address", RAW_CTE + """
SELECT id, string_split(address, ', ')[1] AS subdistrict, string_split(address, ', ')[2] AS city FROM raw""")
def _(spark, d):
    sub, city = x.split_address("address")
    return flat_listings(spark, d).select("id", sub.alias("subdistrict"), city.alias("city"))


@query("p02_timestamp_date", """
SELECT event_id, strftime(CAST(ts_text AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts_out,
       strftime(CAST(CAST(ts_text AS TIMESTAMP) AS DATE), '%Y-%m-%d') AS d
FROM (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts_text FROM events)""")
def _(spark, d):
    e = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts_text"))
    ts = x.to_timestamp("ts_text")
    return e.select(
        "event_id", F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("ts_out"),
        F.date_format(F.to_date(ts), "yyyy-MM-dd").alias("d"),
    )


@query("p03_struct_expand", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(spark, d):
    schema = T.StructType([T.StructField("k", T.LongType())])
    e = table(spark, d, "events").select("event_id", F.from_json("props", schema).alias("p"))
    return e.select("event_id", "p.*")


@query("p04_snake_columns", RAW_CTE + " SELECT id AS listing_id, luas_tanah AS luas_tanah, hadap AS hadap_rumah FROM raw")
def _(spark, d):
    named = flat_listings(spark, d).select(
        F.col("id").alias("Listing ID"), F.col("luas_tanah").alias("Luas Tanah"), F.col("hadap").alias("Hadap Rumah")
    )
    return render.snake_columns(named)


def _num(e: str, kind: str) -> str:
    return f"CASE WHEN regexp_matches({e}, {NUM}) THEN TRY_CAST({e} AS {kind}) END"


@query("p05_num_suffix", RAW_CTE + f"""
SELECT id, CAST({_num("rtrim(luas_tanah, ' m²')", 'FLOAT')} AS DOUBLE) AS land,
       CAST({_num("rtrim(luas_bangunan, ' m²')", 'FLOAT')} AS DOUBLE) AS building,
       CAST({_num("rtrim(lebar_jalan, ' Mobil')", 'FLOAT')} AS DOUBLE) AS road FROM raw""")
def _(spark, d):
    return flat_listings(spark, d).select(
        "id",
        x.num_suffix("luas_tanah", " m²").cast("double").alias("land"),
        x.num_suffix("luas_bangunan", " m²").cast("double").alias("building"),
        x.num_suffix("lebar_jalan", " Mobil").cast("double").alias("road"),
    )


@query("p06_parse_watt", RAW_CTE + """
SELECT id, CAST(TRY_CAST(replace(rtrim(lower(daya_listrik), 'watt'), 'lainnya', '0') AS FLOAT) AS DOUBLE) AS watt FROM raw""")
def _(spark, d):
    return flat_listings(spark, d).select("id", x.parse_watt("daya_listrik").cast("double").alias("watt"))


@query("p07_try_int", RAW_CTE + " SELECT id, " + ", ".join(
    f"TRY_CAST({c} AS INT) AS {c}" for c in v.SPEC_INT_KEYS) + " FROM raw")
def _(spark, d):
    return flat_listings(spark, d).select("id", *[x.try_int(c).alias(c) for c in v.SPEC_INT_KEYS])


@query("p08_is_yes", RAW_CTE + " SELECT id, hook = 'Ya' AS hook, ruang_tamu = 'Ya' AS ruang_tamu FROM raw")
def _(spark, d):
    return flat_listings(spark, d).select("id", *[x.is_yes(c).alias(c) for c in ("hook", "ruang_tamu")])


@query("p09_impute_defaults", RAW_CTE + " SELECT id, " + ", ".join(
    f"coalesce(TRY_CAST({c} AS INT), {v.SPEC_DEFAULTS[c]}) AS {c}" for c in v.SPEC_INT_KEYS) + " FROM raw")
def _(spark, d):
    ints = flat_listings(spark, d).select("id", *[x.try_int(c).alias(c) for c in v.SPEC_INT_KEYS])
    return ints.fillna({c: v.SPEC_DEFAULTS[c] for c in v.SPEC_INT_KEYS})


@query("p10_flag_defaults", RAW_CTE + " SELECT id, " + ", ".join(
    f"coalesce(CAST({c} = 'Ya' AS INT), {n}) AS {c}" for c, n in v.FLAG_DEFAULTS.items()) + " FROM raw")
def _(spark, d):
    return flat_listings(spark, d).select(
        "id", *[x.flag_or(x.is_yes(c), n).alias(c) for c, n in v.FLAG_DEFAULTS.items()]
    )


@query("p11_bool_to_int", """
SELECT event_id, CASE WHEN value > 10 THEN 1 ELSE 0 END AS is_big,
       CASE WHEN nullif(event_type, 'view') = 'click' THEN 1 ELSE 0 END AS is_click FROM events""")
def _(spark, d):
    return table(spark, d, "events").select(
        "event_id", x.bool_to_int(F.col("value") > 10).alias("is_big"),
        x.bool_to_int(F.nullif("event_type", F.lit("view")) == "click").alias("is_click"),
    )


def _condition_sql(c: str) -> str:
    arms = " ".join(f"WHEN {c} ILIKE '%{w}%' THEN '{o}'" for w, o in v.CONDITION_WORDS.items())
    return f"CASE {arms} ELSE lower({c}) END"


@query("p12_normalize_condition", RAW_CTE + f"""
SELECT id, {_condition_sql('kondisi_properti')} AS property_state,
       {_condition_sql('kondisi_perabotan')} AS furniture_state FROM raw""")
def _(spark, d):
    return flat_listings(spark, d).select(
        "id", x.normalize_condition("kondisi_properti").alias("property_state"),
        x.normalize_condition("kondisi_perabotan").alias("furniture_state"),
    )


@query("p13_normalize_certificate", RAW_CTE + """
SELECT id, CASE WHEN sertifikat ILIKE '%ppjb%' THEN 'Lainnya' WHEN sertifikat ILIKE '%lainnya%' THEN 'Lainnya'
           ELSE sertifikat END AS certificate FROM raw""")
def _(spark, d):
    return flat_listings(spark, d).select("id", x.normalize_certificate("sertifikat").alias("certificate"))


AMENITIES = ["cafe", "school", "fuel", "atm", "clinic", "cinema", "police", "bench", "recycling", "retail", "zoo", "parking"]
AMENITY_SQL = "CASE " + " ".join(
    f"WHEN amenity IN ({', '.join(map(_q, names))}) THEN '{cat}'" for cat, names in v.AMENITY_CATEGORIES.items()
) + " ELSE 'other' END"
AMENITY_PICK = "CASE (p_partkey % 12) " + " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(AMENITIES)) + " END"


@query("p14_amenity_category", f"""
SELECT p_partkey, amenity, {AMENITY_SQL} AS category FROM (SELECT p_partkey, {AMENITY_PICK} AS amenity FROM part)""")
def _(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey", f"{AMENITY_PICK} AS amenity")
    return p.withColumn("category", x.amenity_category("amenity"))


@query("p15_null_text", RAW_CTE + " SELECT id, coalesce(description, '') AS description FROM raw")
def _(spark, d):
    return flat_listings(spark, d).select("id", F.coalesce("description", F.lit("")).alias("description"))


@query("p17_not_null_filter", RAW_CTE + " SELECT id, price, installment FROM raw WHERE price IS NOT NULL AND installment IS NOT NULL")
def _(spark, d):
    f = flat_listings(spark, d)
    return f.filter(f.price.isNotNull() & f.installment.isNotNull()).select("id", "price", "installment")


@query("p18_to_idr", RAW_CTE + " SELECT id, round(price * 1000000, 2) AS price_idr FROM raw")
def _(spark, d):
    return flat_listings(spark, d).select("id", F.round(x.to_idr("price"), 2).alias("price_idr"))


@query("p19_surrogate_key", f"""
SELECT n_nationkey, {_sk('n_name', 'r_name')} AS area_sk, {_sk("nullif(n_name, 'NATION_3')")} AS name_sk
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select(
        "n_nationkey", x.surrogate_key("n_name", "r_name").alias("area_sk"),
        x.surrogate_key(F.nullif("n_name", F.lit("NATION_3"))).alias("name_sk"),
    )


@query("p20_title_case", f"""
SELECT doc_id, {TITLE.format('text')} AS title, {TITLE.format("source || '-x/' || lang || ' 2nd'")} AS tag FROM documents""")
def _(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text", "source", "lang")
    return t.select(
        "doc_id", x.title_case("text").alias("title"),
        x.title_case(F.concat("source", F.lit("-x/"), "lang", F.lit(" 2nd"))).alias("tag"),
    )


MASK = (
    "CASE WHEN length({0}) >= 1 THEN array_to_string(list_transform(list_filter("
    r"string_split_regex({0}, '\s+'), lambda w: w <> ''), lambda w: w[1] || repeat('x', length(w) - 1)), ' ') END"
)


@query("p21_mask_name", RAW_CTE + f"""
SELECT id, {MASK.format('agent_name')} AS agent, {MASK.format('full_name')} AS customer
FROM (SELECT raw.*, '  ' || replace(c_name, '#', '  No ') || ' ' AS full_name FROM raw JOIN customer ON o_custkey = c_custkey)""")
def _(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit("  No ")), F.lit(" ")).alias("full_name")
    )
    f = flat_listings(spark, d).select("id", "o_custkey", "agent_name").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return f.select("id", x.mask_name("agent_name").alias("agent"), x.mask_name("full_name").alias("customer"))


@query("p22_mask_phone", RAW_CTE + """
SELECT id, CASE WHEN length(p) >= 3 THEN repeat('x', length(p) - 3) || right(p, 3) END AS phone,
       CASE WHEN length(k) >= 3 THEN repeat('x', length(k) - 3) || right(k, 3) END AS cust
FROM (SELECT id, agent_phone AS p, CAST(o_custkey AS VARCHAR) AS k FROM raw)""")
def _(spark, d):
    return flat_listings(spark, d).select(
        "id", x.mask_phone("agent_phone").alias("phone"), x.mask_phone(F.col("o_custkey").cast("string")).alias("cust")
    )


STRIP = r"regexp_replace({0}, '^[ \t\n\r\v\f]+|[ \t\n\r\v\f]+$', '', 'g')"


@query("p23_clean_facility", RAW_CTE + f""", f AS (SELECT id, unnest(facilities) AS facility_name FROM raw),
n AS (SELECT id, facility_name, upper({STRIP.format('facility_name')}) AS name FROM f)
SELECT id, facility_name, {sqlnames.facility_case('name')} AS facility FROM n""")
def _(spark, d):
    f = flat_listings(spark, d).select("id", F.explode("facilities").alias("facility_name"))
    return f.withColumn("facility", x.clean_facility("facility_name"))


COMPANY_STEPS = f"""n AS (SELECT *, upper({STRIP.format('company')}) AS name FROM c),
p AS (SELECT *, replace(name, 'PROPERTY', 'PROPERTI') AS folded FROM n),
b AS (SELECT *, trim(regexp_replace({sqlnames.bare_company('folded')}, ' +', ' ', 'g')) AS bare FROM p)"""


@query("p24_clean_company", RAW_CTE + f""", c AS (SELECT id, company_name AS company FROM raw), {COMPANY_STEPS}
SELECT id, {sqlnames.company_case('name', 'folded', 'bare')} AS company FROM b""")
def _(spark, d):
    return flat_listings(spark, d).select("id", x.clean_company("company_name").alias("company"))


@query("p25_agent_hash", RAW_CTE + " SELECT id, sha256(concat(agent_name, agent_phone)) AS agent_hash FROM raw")
def _(spark, d):
    return flat_listings(spark, d).select("id", x.agent_hash("agent_name", "agent_phone").alias("agent_hash"))


@query("p26_clean_tag", "SELECT p_partkey, replace(lower(p_type || ' ' || p_name), ' ', '_') AS tag FROM part")
def _(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", x.clean_tag(F.concat_ws(" ", "p_type", "p_name")).alias("tag"))


@query("p27_clean_material", RAW_CTE + """
SELECT id, replace(trim(m), ' ', '_') AS material FROM (SELECT id, ' ' || material_bangunan || '  ' AS m FROM raw)""")
def _(spark, d):
    m = F.concat(F.lit(" "), "material_bangunan", F.lit("  "))
    return flat_listings(spark, d).select("id", x.clean_material(m).alias("material"))


@query("p28_label", f"""
SELECT p_partkey, {TITLE.format("replace(m, '_', ' ')")} AS label
FROM (SELECT p_partkey, replace(p_name, ' ', '_') || '_' || lower(p_type) AS m FROM part)""")
def _(spark, d):
    m = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.lower("p_type"))
    return table(spark, d, "part").select("p_partkey", x.label(m).alias("label"))


@query("p29_default_label", RAW_CTE + " SELECT id, coalesce(company_name, 'Independen') AS company FROM raw")
def _(spark, d):
    return flat_listings(spark, d).select("id", F.coalesce("company_name", F.lit(v.INDEPENDENT_LABEL)).alias("company"))


@query("p30_osm_fallbacks", """
SELECT p_partkey AS id, coalesce(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END, p_brand) AS name,
       coalesce(CASE WHEN p_size % 4 = 0 THEN NULL ELSE lower(p_type) END, CASE WHEN p_size % 8 = 0 THEN 'retail' END) AS amenity
FROM part""")
def _(spark, d):
    p = table(spark, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") % 3 != 0, F.col("p_name")).alias("name"),
        F.col("p_brand").alias("name:en"),
        F.when(F.col("p_size") % 4 != 0, F.lower("p_type")).alias("amenity"),
        F.when(F.col("p_size") % 8 == 0, F.lit("retail")).alias("landuse"),
    )
    return render.amenity_fallbacks(p)


def _map_sql(c: str, m: dict[str, str]) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {_q(k)} THEN {_q(o)}" for k, o in m.items()) + f" ELSE {c} END"


@query("p31_translate_values", RAW_CTE + f"""
SELECT id, {_map_sql('hadap', v.COMPASS)} AS facing, {_map_sql('pemandangan', v.VIEWS)} AS scenery,
       {_map_sql('sumber_air', v.WATER_SOURCES)} AS water,
       replace(konsep_dan_gaya_rumah, 'Minimalis', 'Minimalist') AS style FROM raw""")
def _(spark, d):
    return flat_listings(spark, d).select(
        "id", x.translate_values("hadap", v.COMPASS).alias("facing"),
        x.translate_values("pemandangan", v.VIEWS).alias("scenery"),
        x.translate_values("sumber_air", v.WATER_SOURCES).alias("water"),
        render.style_en("konsep_dan_gaya_rumah").alias("style"),
    )


NORM_TEXT_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace({0}, '[^\\x00-\\x7F]', '', 'g'), chr(10), '. '), "
    "'[\\t-\\r\\x1c-\\x20]+', ' ', 'g'), '[ ]([?.!:\"](?:[ ]|$))', '\\1', 'g'), '([?.!\"])[?.!\"]+', '\\1', 'g')"
)


@query("p32_norm_text", "SELECT doc_id, " + NORM_TEXT_SQL.format("text") + " AS text_norm FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", "text").select("doc_id", x.norm_text("text").alias("text_norm"))


@query("p33_norm_scalar", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'tidak disebutkan' ELSE CAST(p_size % 5 AS VARCHAR) || ' m^2' END AS area,
       greatest(p_size % 4, 1) AS floors FROM part""")
def _(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", x.norm_scalar(F.col("p_size") % 5, " m^2").alias("area"),
        x.num_max(F.col("p_size") % 4, 1).alias("floors"),
    )


@query("p35_price_formats", """
SELECT o_orderkey, round((o_totalprice - prev) / nullif(prev, 0), 6) AS change, 'Rp ' || replace(format('{:,.0f}', o_totalprice * 100), ',', '.') AS long_form
FROM (SELECT o_orderkey, o_totalprice, CAST(o_orderkey % 7 AS DOUBLE) * 997 AS prev FROM orders)""")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("prev", (F.col("o_orderkey") % 7).cast("double") * 997)
    return o.select(
        "o_orderkey", F.round(x.pct_change("o_totalprice", "prev"), 6).alias("change"),
        F.concat(F.lit("Rp "), x.rupiah(F.col("o_totalprice") * 100)).alias("long_form"),
    )


# amounts from single rupiah to thousands of billions
AMOUNT = "o_totalprice / 1000 * pow(10::DOUBLE, o_orderkey % 11)"
UNITS = "".join(f"WHEN abs(c) >= {s}::DOUBLE THEN 'Rp ' || format('{{:,.0f}}', c / {s}::DOUBLE) || ' {u}' " for s, u in (("1e12", "T"), ("1e9", "M"), ("1e6", "jt"), ("1e3", "rb")))


@query("p35b_price_texts", f"""
SELECT o_orderkey, CASE {UNITS} ELSE 'Rp ' || format('{{:,.0f}}', round(c)) END AS price_short,
       'Rp ' || translate(format('{{:,.2f}}', c), ',.', '.,') AS price_long
FROM (SELECT o_orderkey, {AMOUNT} AS c FROM orders)""")
def _(spark, d):
    c = F.col("o_totalprice") / 1000 * F.pow(F.lit(10.0), F.col("o_orderkey") % 11)
    return table(spark, d, "orders").select("o_orderkey", c.alias("c")).select(
        "o_orderkey", x.price_short("c").alias("price_short"), x.price_long("c").alias("price_long"))


@query("p36_first_digit", """
SELECT o_orderkey, CAST(substr(CAST(CAST(trunc(o_totalprice * 1000000) AS HUGEINT) AS VARCHAR), 1, 1) AS INT) AS digit FROM orders""")
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", x.first_digit(F.col("o_totalprice") * 1_000_000).alias("digit"))


@query("p37_flatten_messages", """
WITH p AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines FROM conversations),
e AS (SELECT conv_id, turn, role, unnest(lines) AS line, unnest(range(len(lines))) AS part FROM p)
SELECT conv_id, turn, part, role,
       CASE WHEN part % 3 = 1 THEN 'FUNCTION CALL' WHEN part % 3 = 2 THEN 'FUNCTION RESPONSE' ELSE line END AS text,
       CASE WHEN part % 3 = 1 THEN 'find' WHEN part % 3 = 2 THEN 'find' END AS function_name,
       CASE WHEN part % 3 = 1 THEN line END AS function_args,
       CASE WHEN part % 3 = 2 THEN line END AS function_response FROM e""")
def _(spark, d):
    c = table(spark, d, "conversations")
    lines = F.split("text", "\n")
    call = lambda i, n: F.when(i % 3 == n, F.lit("find"))
    parts = F.transform(
        lines,
        lambda line, i: F.struct(
            F.when(i % 3 == 0, line).alias("text"),
            F.struct(call(i, 1).alias("name"), line.alias("args")).alias("function_call"),
            F.struct(call(i, 2).alias("name"), line.alias("response")).alias("function_response"),
        ),
    )
    return render.flatten_messages(c.select("conv_id", "turn", "role", parts.alias("parts")), ["conv_id", "turn"])


@query("p38_too_long", "SELECT conv_id, turn, length(text) AS n FROM conversations WHERE length(text) > 500")
def _(spark, d):
    c = table(spark, d, "conversations")
    return c.filter(x.too_long("text", 500)).select("conv_id", "turn", F.length("text").cast("long").alias("n"))


@query("f01_sql_functions", RAW_CTE + f""", f AS (SELECT id, agent_name, agent_phone, company_name AS company, facilities[1] AS fac FROM raw),
c AS (SELECT *, upper({STRIP.format('fac')}) AS fname FROM f), {COMPANY_STEPS}
SELECT id, {TITLE.format('agent_name')} AS title, {MASK.format('agent_name')} AS agent,
       CASE WHEN length(agent_phone) >= 3 THEN repeat('x', length(agent_phone) - 3) || right(agent_phone, 3) END AS phone,
       {sqlnames.facility_case('fname')} AS facility,
       {sqlnames.company_case('name', 'folded', 'bare')} AS agency FROM b""")
def _(spark, d):
    sqlnames.register(spark)
    return flat_listings(spark, d).selectExpr(
        "id", "TITLE_CASE(agent_name) AS title", "MASK_NAME(agent_name) AS agent", "MASK_PHONE(agent_phone) AS phone",
        "CLEAN_FACILITY(get(facilities, 0)) AS facility", "CLEAN_AGENCY_COMPANY(company_name) AS agency",
    )


@query("f01b_clean_facilities", RAW_CTE + f""", f AS (SELECT id, unnest(range(len(facilities))) AS pos, unnest(facilities) AS fac FROM raw)
SELECT id, pos, {sqlnames.facility_case('fname')} AS facility FROM (SELECT *, upper({STRIP.format('fac')}) AS fname FROM f)""")
def _(spark, d):
    sqlnames.register(spark)
    each = flat_listings(spark, d).selectExpr("id", "posexplode(facilities) AS (pos, fac)")
    return each.selectExpr("id", "CAST(pos AS BIGINT) AS pos", "CLEAN_FACILITY(fac) AS facility")


DOC_CTE = RAW_CTE + f""", doc AS (SELECT id, price * 1000000 AS price, installment * 1000000 AS installment,
  string_split(address, ', ')[1] AS subdistrict, string_split(address, ', ')[2] AS city, coalesce(description, '') AS description,
  TRY_CAST(rtrim(luas_tanah, ' m²') AS INT) AS luas_tanah, TRY_CAST(rtrim(luas_bangunan, ' m²') AS INT) AS luas_bangunan,
  coalesce(TRY_CAST(rtrim(lebar_jalan, ' Mobil') AS INT), 0) AS lebar_jalan,
  TRY_CAST(replace(rtrim(lower(daya_listrik), 'watt'), 'lainnya', '0') AS INT) AS daya_listrik,
  {", ".join(f"coalesce(TRY_CAST({c} AS INT), {v.SPEC_DEFAULTS[c]}) AS {c}" for c in v.SPEC_INT_KEYS)},
  {", ".join(f"coalesce(CAST({c} = 'Ya' AS INT), {n}) AS {c}" for c, n in v.FLAG_DEFAULTS.items())},
  {_condition_sql("kondisi_properti")} AS kondisi_properti, {_condition_sql("kondisi_perabotan")} AS kondisi_perabotan,
  hadap, pemandangan, konsep_dan_gaya_rumah, sumber_air,
  CASE WHEN sertifikat ILIKE '%ppjb%' OR sertifikat ILIKE '%lainnya%' THEN 'Lainnya' ELSE sertifikat END AS sertifikat,
  list_transform(string_split(lower(material_bangunan), ','), lambda m: replace(trim(m), ' ', '_')) AS house_materials,
  list_transform(string_split(lower(material_lantai), ','), lambda m: replace(trim(m), ' ', '_')) AS floor_materials,
  CASE WHEN len(list_filter(tags, lambda t: t IS NOT NULL)) > 0 THEN list_filter(tags, lambda t: t IS NOT NULL) END AS tags,
  facilities FROM raw WHERE price IS NOT NULL)"""


def document_sql(name: str) -> str:
    """The document as SQL: every piece with its fields in place."""
    money = lambda c: f"replace(format('{{:,.0f}}', {c}), ',', '.')"
    said = {c: f"CAST({c} AS VARCHAR)" for c in render.INTS} | {c: f"CAST({c} AS VARCHAR) || '.0'" for c in render.AREAS}
    fields = said | {
        f"n_{c}": f"CASE WHEN {c} = 0 THEN 'tidak disebutkan' ELSE {e} || '{v.SCALAR_UNITS.get(c, '')}' END" for c, e in said.items()
    } | {c: f"array_to_string({c}, ', ')" for c in render.LISTS} | {
        "price": money("price"), "installment": money("installment"), "lantai": "CAST(greatest(jumlah_lantai, 1) AS VARCHAR)",
        "facing": _map_sql("hadap", v.COMPASS), "scenery": _map_sql("pemandangan", v.VIEWS),
        "water": _map_sql("sumber_air", v.WATER_SOURCES), "style": "replace(konsep_dan_gaya_rumah, 'Minimalis', 'Minimalist')",
        "plain_description": NORM_TEXT_SQL.format("description"),
    }
    pieces = []
    for cond, text in v.DOCUMENTS[name]:
        parts = re.split(r"\{(\w+)\}", text)
        one = "concat(" + ", ".join(
            f"coalesce({fields.get(p, p)}, 'None')" if i % 2 else _q(p) for i, p in enumerate(parts) if p) + ")"
        pieces.append(one if cond is None else f"CASE WHEN {cond} THEN {one} ELSE '' END")
    return DOC_CTE + " SELECT id, concat(" + ", ".join(pieces) + ") AS document FROM doc"


def document_rows(spark, d):
    """Rows with the columns of the wide listing; tags and facilities as written."""
    sub, city = x.split_address("address")
    known = F.filter("tags", lambda t: t.isNotNull())
    return flat_listings(spark, d).filter("price IS NOT NULL").select(
        "id", x.to_idr("price").alias("price"), x.to_idr("installment").alias("installment"), sub.alias("subdistrict"),
        city.alias("city"), F.coalesce("description", F.lit("")).alias("description"),
        *[x.num_suffix(c, s).alias(c) for c, s in v.SPEC_AREA_KEYS.items()], x.parse_watt("daya_listrik").alias("daya_listrik"),
        *[x.try_int(c).alias(c) for c in v.SPEC_INT_KEYS], *[x.flag_or(x.is_yes(c), n).alias(c) for c, n in v.FLAG_DEFAULTS.items()],
        *[x.normalize_condition(c).alias(c) for c in ("kondisi_properti", "kondisi_perabotan")],
        "hadap", "pemandangan", "konsep_dan_gaya_rumah", "sumber_air", x.normalize_certificate("sertifikat").alias("sertifikat"),
        materials_of("material_bangunan").alias("house_materials"), materials_of("material_lantai").alias("floor_materials"),
        F.when(F.size(known) > 0, known).alias("tags"), "facilities",
    ).fillna(v.SPEC_DEFAULTS)


def _document_query(name: str):
    @query(f"p34_render_{name}", document_sql(name))
    def _(spark, d):
        return document_rows(spark, d).select("id", render.render_document(name).alias("document"))


for _name in v.DOCUMENTS:
    _document_query(_name)
