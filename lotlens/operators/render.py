"""Row rendering: listing documents, column names, chat history rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as x
from ..functions import vocab as v


def snake_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name, blanks become underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def amenity_fallbacks(df: DataFrame) -> DataFrame:
    """Fill name from its English form and amenity from land use; drop the helpers."""
    return df.withColumns(
        {
            "name": F.coalesce(F.col("name"), F.col("`name:en`")),
            "amenity": F.coalesce(F.col("amenity"), F.col("landuse")),
        }
    ).drop("landuse", "name:en")


def style_en(c: Column | str) -> Column:
    c = x.col(c)
    for word, out in v.STYLE_WORDS.items():
        c = F.replace(c, F.lit(word), F.lit(out))
    return c


INTS = ["carport", "dapur", "daya_listrik", "jumlah_lantai", "kamar_mandi", "kamar_tidur", "kamar_pembantu", "lebar_jalan",
        "tahun_dibangun", "tahun_di_renovasi"]
AREAS = ["luas_tanah", "luas_bangunan"]
LISTS = ["house_materials", "floor_materials", "facilities", "tags"]


def document_fields() -> dict[str, Column]:
    """Text of every field a document can mention, from the columns of the wide listing row (prices in rupiah)."""
    c = F.col
    whole = lambda n: c(n).cast("bigint").cast("string")
    # areas always show a decimal
    area = lambda n: F.when(c(n) == F.floor(n), F.concat(whole(n), F.lit(".0"))).otherwise(c(n).cast("string"))
    said = {n: area(n) for n in AREAS} | {n: whole(n) for n in INTS}
    scalar = lambda n: F.when(c(n) == 0, F.lit(v.UNKNOWN_SCALAR)).otherwise(F.concat(said[n], F.lit(v.SCALAR_UNITS.get(n, ""))))
    plain = ["id", "subdistrict", "city", "description", "kondisi_properti", "kondisi_perabotan", "hadap", "pemandangan",
             "konsep_dan_gaya_rumah", "sumber_air", "sertifikat"]
    return (
        said | {f"n_{n}": scalar(n) for n in said} | {n: c(n) for n in plain} | {n: F.array_join(c(n), ", ") for n in LISTS}
        | {
            "price": x.rupiah("price"), "installment": x.rupiah("installment"),
            "lantai": x.num_max("jumlah_lantai", 1).cast("bigint").cast("string"),
            "facing": x.translate_values("hadap", v.COMPASS), "scenery": x.translate_values("pemandangan", v.VIEWS),
            "water": x.translate_values("sumber_air", v.WATER_SOURCES), "style": style_en("konsep_dan_gaya_rumah"),
            "plain_description": x.norm_text("description"),
        }
    )


def render_document(name: str = "full") -> Column:
    """Document of a listing row in one of the forms of `vocab.DOCUMENTS`."""
    fields = document_fields()

    def text(t: str) -> Column:
        parts = re.split(r"\{(\w+)\}", t)
        return F.concat(*[
            F.coalesce(fields[p], F.lit(v.MISSING_TEXT)) if i % 2 else F.lit(p) for i, p in enumerate(parts) if p
        ])

    return F.concat(*[
        text(t) if cond is None else F.when(F.expr(cond), text(t)).otherwise(F.lit("")) for cond, t in v.DOCUMENTS[name]
    ])


def flatten_messages(history: DataFrame, keys: list[str]) -> DataFrame:
    """One row per message part; calls and responses get a fixed text and their payload.

    `parts` is an array of structs with text, function_call(name, args) and
    function_response(name, response); a part is a call or a response when the
    name is set.
    """
    p = history.select(*keys, "role", F.posexplode("parts").alias("part", "p"))
    call, resp = F.col("p.function_call"), F.col("p.function_response")
    is_call, is_resp = call["name"].isNotNull(), resp["name"].isNotNull()
    return p.select(
        *keys, F.col("part").cast("long").alias("part"), "role",
        F.when(is_call, F.lit("FUNCTION CALL")).when(is_resp, F.lit("FUNCTION RESPONSE")).otherwise(F.col("p.text")).alias("text"),
        F.when(is_call, call["name"]).when(is_resp, resp["name"]).alias("function_name"),
        F.when(is_call, call["args"]).alias("function_args"),
        F.when(~is_call & is_resp, resp["response"]).alias("function_response"),
    )
