"""The checks declared for the tables of `layers`."""

from __future__ import annotations

from ..functions import vocab as v
from ..operators.quality import Check

# Columns checked in the specs and in the wide table.
SPEC_NOT_NULL = [
    "kamar_tidur", "kamar_mandi", "kamar_pembantu", "kamar_mandi_pembantu", "dapur", "luas_tanah", "luas_bangunan",
    "jumlah_lantai", "carport", "daya_listrik", "lebar_jalan", "tahun_dibangun", "tahun_di_renovasi", "tipe_properti",
    "sertifikat", "kondisi_properti", "hadap", "konsep_dan_gaya_rumah", "pemandangan", "sumber_air", "garasi",
    "ruang_makan", "ruang_tamu", "terjangkau_internet", "hook",
]
SPEC_FLAGS = ["ruang_makan", "ruang_tamu", "terjangkau_internet", "hook"]
OF_A_HOUSE = [
    "stg_agent_companies", "stg_agents", "stg_facilities", "stg_images", "stg_specs", "stg_tags",
    "int_floor_materials", "int_house_materials", "int_specs",
]
NOT_NULL = {
    "stg_houses": ["id", "scraped_at"], "stg_agents": ["agent_hash"], "stg_facilities": ["facility"], "stg_tags": ["tag"],
    "stg_areas": ["center", "geom"], "int_floor_materials": ["floor_material"], "int_specs": SPEC_NOT_NULL,
    "marts_downstream_houses": ["id", "price", "installment", "subdistrict", "city", "url", *SPEC_NOT_NULL],
}

CHECKS: list[Check] = [
    *[Check(t, c, "not_null") for t, columns in NOT_NULL.items() for c in columns],
    *[Check(t, "id", "unique") for t in ("stg_houses", "marts_downstream_houses")],
    *[Check(t, "reference_id", "not_null") for t in OF_A_HOUSE],
    *[Check(t, "reference_id", "relationships", parent=("stg_houses", "id")) for t in OF_A_HOUSE],
    *[Check(t, c, "accepted_values", accepted=tuple(values)) for t in ("int_specs", "marts_downstream_houses")
      for c, values in [*v.ACCEPTED_VALUES.items(), *[(f, (0, 1)) for f in SPEC_FLAGS]]],
]
