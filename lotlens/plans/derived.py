"""Listings derived from the order tables.

The given tables hold no listings, so every order plays one: the statement
below turns `orders` into raw listing fields, row by row and without a
shuffle.  The same text runs on Spark and on the checking engine, which gives
both sides equal raw input; all cleaning after that is separate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab as v

K = "o_orderkey"


def pick(key: str, values: list[str | None], shift: int = 0) -> str:
    """CASE that cycles through `values` (None stands for NULL)."""
    arms = " ".join(
        f"WHEN {i} THEN " + ("CAST(NULL AS STRING)" if x is None else "'" + x.replace("'", "''") + "'")
        for i, x in enumerate(values)
    )
    return f"CASE ({key} + {shift}) % {len(values)} {arms} END"


FACILITY_TEXTS = [
    "Jogging Track", "CCTV", "Wi-Fi", " Lapangan Bermain ", "Masjid", " ", "Swimming Pool", "One Gate Security",
    "Taman", "Tempat Gym", "Water Heater", "Kulkas", "Akses Parkir", "Jalur Telepon", "Kolam Ikan", "PAM",
    "Tempat Laundry", "Ruang Tamu", "Carport", "TV", "Playground", "Mushola", "Wifi",
]
TAG_TEXTS = ["KPR", "Bisa Nego", "Cash Bertahap/KPR", "Promo", "Hook/Strategis", "Siap Huni", None]
COMPANY_TEXTS = [
    "Ray White Depok", "Century 21 Prima", "Depok Property", "Era Sky Bogor", "Agung  Property Bandung",
    "Independent Property Agent", " Brighton Kelapa Gading ", "Rumah Kita & Agency", None, "Re/Max Air", "Jakarta",
]
FLOOR_TEXTS = ["Keramik", "Granit, Marmer", "Kayu,Keramik , Ubin", None, "Vinyl"]
WALL_TEXTS = ["Bata Merah", "Bata Hebel, Beton", None, "Batako"]

SPEC_TEXTS: dict[str, str] = {
    "luas_tanah": f"CASE WHEN {K} % 29 = 0 THEN '-' ELSE CAST(40 + ({K} * 7) % 460 AS STRING) || ' m²' END",
    "luas_bangunan": f"CASE WHEN {K} % 31 = 0 THEN NULL ELSE CAST(30 + ({K} * 11) % 300 AS STRING) || ' m²' END",
    "lebar_jalan": f"CASE WHEN {K} % 3 = 0 THEN NULL ELSE CAST({K} % 4 AS STRING) || ' Mobil' END",
    "daya_listrik": pick(K, ["1300 Watt", "2200 watt", "lainnya", "Lainnya Watt", "900 Watt", None, "x"]),
    "kamar_tidur": pick(K, ["3", "2", "2.7", "4", None, ">10", "5", "1"]),
    "kamar_mandi": pick(K, ["1", "2", None, "3", "2"], 1),
    "kamar_pembantu": pick(K, [None, "1", "0"], 2),
    "kamar_mandi_pembantu": pick(K, [None, "1", None, "2"], 1),
    "dapur": pick(K, ["1", None, "2"]),
    "jumlah_lantai": pick(K, ["1", "2", "2", None, "3"], 3),
    "garasi": pick(K, [None, "1", "2"], 1),
    "carport": pick(K, ["1", "2", None, "0"], 2),
    "tahun_dibangun": f"CASE WHEN {K} % 4 = 0 THEN NULL ELSE CAST(1990 + {K} % 34 AS STRING) END",
    "tahun_di_renovasi": f"CASE WHEN {K} % 6 <> 1 THEN NULL ELSE CAST(2015 + {K} % 9 AS STRING) END",
    "hadap": pick(K, ["Utara", "Barat Daya", "Timur", None, "Tenggara", "Selatan", "Depan"]),
    "sumber_air": pick(K, ["PAM atau PDAM", "Sumur Bor", "Sumur Pompa", None, "Sumur Galian"]),
    "pemandangan": pick(K, ["Pemukiman Warga", "Pegunungan", None, "Taman Kota"]),
    "tipe_properti": pick(K, ["Rumah"]),
    "konsep_dan_gaya_rumah": pick(K, ["Minimalis Modern", "Modern", None, "Minimalis", "Scandinavian"]),
    "material_lantai": pick(K, FLOOR_TEXTS),
    "material_bangunan": pick(K, WALL_TEXTS),
    "sertifikat": pick(K, ["SHM - Sertifikat Hak Milik", "HGB - Hak Guna Bangunan", "PPJB", "Lainnya (PPJB,Girik)", None]),
    "kondisi_properti": pick(K, ["Bagus Sekali", "Butuh Renovasi", "Baru", "Semi Furnished", None, "Sudah Renovasi"]),
    "kondisi_perabotan": pick(K, ["Furnished", "Unfurnished", "Semi Furnished", None]),
    "hook": pick(K, ["Ya", "Tidak", None], 1),
    "ruang_makan": pick(K, ["Ya", "Tidak", None]),
    "ruang_tamu": pick(K, ["Tidak", "Ya", None, "Ya"]),
    "terjangkau_internet": pick(K, [None, "Ya"]),
}
BASE_TEXTS: dict[str, str] = {
    "id": f"'hos' || CAST({K} AS STRING)",
    "price": f"CASE WHEN {K} % 37 = 0 THEN NULL ELSE o_totalprice / 100 END",
    "installment": f"CASE WHEN {K} % 5 = 0 THEN NULL ELSE o_totalprice / 20000 END",
    "address": (
        f"CASE WHEN {K} % 41 = 0 THEN NULL WHEN {K} % 13 = 0 THEN 'NATION_' || CAST(o_custkey % 25 AS STRING) "
        "ELSE 'NATION_' || CAST(o_custkey % 25 AS STRING) || ', ' || "
        + pick("o_custkey", ["Kota Bogor", "Kab Bogor"]) + " END"
    ),
    "description": (
        f"CASE WHEN {K} % 9 = 0 THEN NULL WHEN {K} % 7 = 0 THEN 'Murah' ELSE 'Rumah  dijual é cepat ' || "
        f"o_orderpriority || ' !!\nHubungi ' || CAST(o_custkey AS STRING) || ' ..' END"
    ),
    "agent_name": f"CASE WHEN {K} % 17 = 0 THEN NULL ELSE 'Agen ' || CAST(o_custkey % 997 AS STRING) || ' Bogor' END",
    "agent_phone": f"CASE WHEN {K} % 19 = 0 THEN NULL ELSE '62812' || CAST(100000 + o_custkey AS STRING) END",
    "company_name": pick(K, COMPANY_TEXTS),
    "url": f"'https://listings.example.com/properti/bogor/hos' || CAST({K} AS STRING) || '/'",
    "last_modified": "CAST(o_orderdate AS STRING)",
    "scraped_at": "'2024-05-01 10:00:00'",
}


def _lists(arr: str) -> dict[str, str]:
    fac, tag = lambda s: pick(K, FACILITY_TEXTS, s), lambda s: pick(K, TAG_TEXTS, s)
    img = lambda s: f"'https://img.example.com/customer/' || CAST({K} AS STRING) || '/{s}.jpg'"
    empty = {"array": "CAST(array() AS ARRAY<STRING>)", "list_value": "CAST([] AS VARCHAR[])"}[arr]
    return {
        "tags": f"CASE WHEN {K} % 10 = 0 THEN NULL WHEN {K} % 10 = 1 THEN {empty} ELSE {arr}({tag(0)}, {tag(2)}) END",
        "facilities": f"CASE WHEN {K} % 12 = 0 THEN NULL ELSE {arr}({fac(0)}, {fac(5)}, {fac(11)}, {fac(16)}) END",
        "images": f"CASE WHEN {K} % 8 = 0 THEN NULL ELSE {arr}({img(1)}, {img(2)}, {img(1)}) END",
    }


def listings_sql(arr: str = "list_value") -> str:
    """SELECT giving the flat raw listings; `arr` is the dialect's array constructor."""
    cols = {**BASE_TEXTS, **SPEC_TEXTS, **_lists(arr)}
    return "SELECT o_orderkey, o_custkey, " + ", ".join(f"{e} AS {n}" for n, e in cols.items()) + " FROM orders"


# CTE used by checking SQL
RAW_CTE = f"WITH raw AS ({listings_sql()})"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt by the key that everything after groups by, while rows are still narrow
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(*used).repartition(parts, "o_orderkey")


def flat_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat raw listings, one per order."""
    orders = _orders(spark, sf_dir)
    cols = {**BASE_TEXTS, **SPEC_TEXTS, **_lists("array")}
    return orders.selectExpr("o_orderkey", "o_custkey", *[f"{e} AS {n}" for n, e in cols.items()])


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the nested listing schema (specs map, agent struct)."""
    flat = flat_listings(spark, sf_dir)
    labels = F.array(*[F.initcap(F.replace(F.lit(n), F.lit("_"), F.lit(" "))) for n in SPEC_TEXTS])
    specs = F.map_filter(F.map_from_arrays(labels, F.array(*SPEC_TEXTS)), lambda _, value: value.isNotNull())
    company = F.struct(
        F.col("company_name").alias("name"), F.lit(None).cast("string").alias("url")
    )
    agent = F.struct(
        F.col("agent_name").alias("name"), F.lit(None).cast("string").alias("url"),
        F.col("agent_phone").alias("phone"), company.alias("company"),
    )
    return flat.select(
        "id", "price", "installment", "address", "description", "tags", specs.alias("specs"), "facilities",
        agent.alias("agent"), "images", "url", "last_modified", "scraped_at",
    )


# -- listing pages -----------------------------------------------------------

def _s(e: str) -> str:
    return f"CAST({e} AS STRING)"


PAGE_FIELDS: dict[str, str] = {
    "url": f"'https://www.example.com/properti/bogor/hos' || {_s(K)} || '/'",
    "price_text": (
        f"CASE {K} % 4 WHEN 0 THEN 'Rp ' || {_s(f'100 + {K} % 900')} || ' Juta' WHEN 1 THEN 'Rp ' || {_s(f'1 + {K} % 9')} || ',' || "
        f"{_s(f'{K} % 10')} || ' Miliar' WHEN 2 THEN 'Rp 5' ELSE 'Rp ' || {_s(f'2 + {K} % 30')} || ' Miliar' END"
    ),
    "installment_text": f"CASE WHEN {K} % 3 = 0 THEN NULL ELSE 'Cicilan Rp ' || {_s(f'1 + {K} % 40')} || ',5 Jutaan' END",
    "address": f"CASE WHEN {K} % 11 = 0 THEN NULL ELSE 'Area ' || {_s('o_custkey % 25')} || ', Bogor' END",
    "date_text": f"'Diperbarui ' || {_s(f'1 + {K} % 31')} || ' ' || " + pick(K, [*v.MONTH_NAMES, "Foo"]) + f" || ' ' || {_s(f'2020 + {K} % 4')} || ' oleh Agen'",
    "description": f"CASE WHEN {K} % 8 = 0 THEN NULL ELSE 'Rumah nomor ' || {_s('o_custkey')} || ' café – cepat & <b> baru' END",
    "tag_a": pick(K, ["KPR", "Bisa Nego", "Promo"]),
    "tag_b": pick(K, ["SHM", "Siap Huni"]),
    "land": f"{_s(f'40 + {K} % 300')} || ' m²'",
    "beds": f"{_s(f'1 + {K} % 6')}",
    "facility": pick(K, ["CCTV", "Taman", "Kolam Renang", "Gym"]),
    "agent_name": f"CASE WHEN {K} % 13 = 0 THEN NULL ELSE 'Agen ' || {_s('o_custkey')} END",
    "company_name": f"CASE WHEN {K} % 13 = 0 OR {K} % 4 = 0 THEN NULL ELSE " + pick(K, ["Ray White", "Century 21"]) + " END",
    "phone": f"CASE WHEN {K} % 13 = 0 OR {K} % 6 = 0 THEN NULL ELSE '62812' || {_s('o_custkey')} END",
    "image": f"'https://img.example.com/customer/a ' || {_s(K)} || '/front.jpg'",
}
PAGE_CTE = "WITH page AS (SELECT o_orderkey, " + ", ".join(f"{e} AS {n}" for n, e in PAGE_FIELDS.items()) + " FROM orders)"


def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr("o_orderkey", *[f"{e} AS {n}" for n, e in PAGE_FIELDS.items()])


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched listing pages (url, html) rendered from the derived fields."""
    def opt(name: str, before: str, after: str):
        return F.coalesce(F.concat(F.lit(before), F.col(name), F.lit(after)), F.lit(""))

    quoted = F.replace(F.replace("image", F.lit(" "), F.lit("%20")), F.lit("/"), F.lit("%2F"))
    spec = lambda name, c: F.concat(F.lit(f'<div class="row mb-4"><div class="icon"><img src="/i.svg"></div><p>{name}</p><p class="v">'), F.col(c), F.lit("</p></div>"))
    # divisions inside every block, and promotions that look like a listing before, after and beside it
    before = '<div class="promo"><span>Promo Rp 99 Juta</span><p>Cicilan Rp 9 Jutaan</p><div class="mb-4"><p>Promo</p><p>99</p></div></div>'
    promo = (
        '<div class="promo"><span>Rp 9 Juta</span><p>Cicilan Rp 9 Jutaan</p><ul><li>PROMO</li></ul><p>Deskripsi</p><p>Promo</p>'
        '<p>Spesifikasi</p><div class="mb-4"><p>Promo</p><p>99</p></div><div class="flex-grow"><a title="Iklan" href="/iklan">i</a></div></div>')
    html = F.concat(
        F.lit('<!DOCTYPE html>\n<html><head><script>if (1 < 2) { document.write("<div class=\'ui-container\'>") }</script></head><body>'
              '<nav><a href="/properti/bogor/hos1/">x</a><a title="Beranda" href="/">Home</a>'
              '<a href="../../../properti/depok/hos2/?a=../b">y</a><p>Menu</p><ul><li>Home</li><li>KPR</li></ul></nav>\n' + before +
              '<!-- <div class="ui-container"> --><div class="ui-container">\n<div class="main"><div><div><span>'),
        F.col("price_text"), F.lit("</span></div></div>\n"), opt("installment_text", "<div><p class='c'>", "</p></div>"),
        F.lit("<div><h1>Dijual\nRumah</h1><div><br></div>"), opt("address", "<p>", "</p>"), F.when(F.col("address").isNull(), F.lit("<p></p>")).otherwise(F.lit("")),
        F.lit("<p>"), F.col("date_text"), F.lit("</p><div><ul><li>no tag</ul></div><ul><li> "), F.col("tag_a"), F.lit(" <div>x</div></li><li>"), F.col("tag_b"),
        F.lit("</ul></div>\n"), opt("_text", "<div><p>Deskripsi</p><div><p>no text</p></div><p class='d'>", "</p></div>\n"),
        F.lit("<div><p>Spesifikasi</p><div>"), spec("Luas Tanah", "land"), spec("Kamar Tidur", "beds"), spec("Kamar Tidur", "beds"),
        F.lit('<div class="mb-4"><p>Hanya satu</p></div></div></div>\n<div id="property-facility"><div><p><span> '), F.col("facility"),
        F.lit("</span></p></div><div><div><p><span>Wi-Fi &amp; TV</span></p></div></div></div></div>\n<div class='side'>"),
        opt("agent_name", '<div><div class="flex-grow"><div><a title="inside">n</a></div><a class="n" title="', ' " href="/agen/1">a</a></div></div>'),
        opt("company_name", '<div class="flex-grow"><div></div><a title="', '" href="https://firm.example.com/x">b</a></div>'),
        opt("phone", '<button name="phone" title="0811">x</button><button name="phone" title="', '">Call</button>'),
        F.lit('<img alt="front" srcset="/_next/image?url='), quoted, F.lit('%26w%3D1&amp;w=640 1x, /_next/image?url='), quoted, F.lit('&amp;w=1080 2x">'),
        F.lit('<img alt="map" srcset="/i?url=https%3A%2F%2Fm%2Fcustomer%2Fz 1x, y 2x"></div></div>' + promo +
              '<footer><p>Spesifikasi situs</p><div class="mb-4"><p>Kontak</p><p>Kami</p></div><ul><li>Tentang</li></ul>'
              '<div class="flex-grow"><a title="Situs" href="/s">s</a></div></footer></body></html>'),
    )
    escaped = F.col("description")
    for ch, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;"), ("é", "&eacute;"), ("–", "&#x2013;")):
        escaped = F.replace(escaped, F.lit(ch), F.lit(entity))
    return page_fields(spark, sf_dir).withColumn("_text", escaped).select("url", html.alias("html"))
