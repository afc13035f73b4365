"""Fixed values.

Everything in this module is data that decides results (word lists, lookup
tables, formats).  The values are given; only their use is ours.
"""

# A facility name holding one of these fragments is discarded.
FACILITY_STOP_FRAGMENTS = [
    "-", "SAMPING & BELAKANG", "LISTRIK", "ATAP BAJA", "ROW JALAN",
    "BUILT IN ROBES", "R.TAMU", "STUDY", "BATH", "R. MAKAN", "SERTIFIKAT",
    "HADAP", "DEKAT", "CLOSE TO", "PROMO", "CAFE", "PET F", "BONUS", "SOFA",
    "DLL", "KURSI", "VIEW", "PINTU TOL", "STRATEGIS", "NEGO", "PAVILLION",
    "TV", "MASIH ADA", "TOKEN", "POLISHED", "KAWASAN", "LENGKAP", "ASRI",
    "HYPERMART", "POSISI", "SMOKING", "RUANG", "CLUB", "SEPARATE", "CEILING",
    "GROUND FLOOR", "SPRING BED", "MEJA",
]

# Fragment -> canonical facility; the first fragment found wins.
FACILITY_RULES = {
    "JET PUMP": "AIR TANAH",
    "PAM": "AIR PAM",
    "PARKIR": "PARKIR",
    "PARKING": "PARKIR",
    "GARASI": "GARASI",
    "CARPORT": "CARPORT",
    "CARPOT": "CARPORT",
    "AC": "AC",
    "AIR COND": "AC",
    "AIRCON": "AC",
    "HEATING": "HEATING",
    "AULA": "AULA",
    "LOUNGE": "AULA",
    "SECURITY": "KEAMANAN",
    "KEAMANAN": "KEAMANAN",
    "SMART DOOR": "KEAMANAN",
    "ALARM SYSTEM": "KEAMANAN",
    "SPA": "HALAMAN",
    "BBQ": "HALAMAN",
    "DECK": "HALAMAN",
    "COURTYARDS": "HALAMAN",
    "HALAMAN": "HALAMAN",
    "TERAS": "HALAMAN",
    "KEBUN": "HALAMAN",
    "TAMAN": "TAMAN",
    "GARDEN": "TAMAN",
    "BERMAIN": "TAMAN",
    "ENTERTAINING": "TAMAN",
    "KIDS PARK": "TAMAN",
    "PLAYGR": "PLAYGROUND",
    "PLAY GROUND": "PLAYGROUND",
    "LAPANGAN BERMAIN": "PLAYGROUND",
    "KOI": "KOLAM IKAN",
    "KOLAM PANCING": "KOLAM IKAN",
    "GYM": "GYM",
    "SWIMMING POOL": "KOLAM RENANG",
    "POOL INGROUND": "KOLAM RENANG",
    "JOGGING TRACK": "TRACK LARI",
    "LAPANGAN": "LAPANGAN",
    "FUTSAL": "LAPANGAN",
    "KITCHEN": "DAPUR",
    "KOMPOR": "DAPUR",
    "KULKAS": "DAPUR",
    "JEMURAN": "LAUNDRY",
    "LAUNDRY": "LAUNDRY",
    "CUCI": "LAUNDRY",
    "PEMANAS AIR": "WATER HEATER",
    "HOT WATER": "WATER HEATER",
    "WATER HEATER": "WATER HEATER",
    "GAS": "GAS",
    "INTERNET": "INTERNET",
    "WIFI": "INTERNET",
    "WI-FI": "INTERNET",
    "BROADBAND": "INTERNET",
    "MASJID": "MASJID",
    "MUSHOLA": "MUSHOLLA",
}

# Agency names recognised by containment, first match wins.
KNOWN_AGENCIES = [
    "BRIGHTON", "RAY WHITE", "LJ HOOKER", "XAVIER MARKS", "MR REALTY",
    "ERA FIESTA", "ASIA ONE", "RE/MAX", "ERA PROJECT", "ERA VICTORIA",
    "MPRO", "9 PRO", "58 PRO", "ATLANTIS", "BEE", "BEYOND PROPERTI",
    "BINTANG PROPERTI", "BUANA REALTY", "VISION PROPERTI", "SUNRISE",
    "KUNCI REALTY", "HARCOURTS", "GADING PRO", "EXIST", "ERA STAR",
    "ERA SKY", "DISCOVERY", "DREAM HOME", "EAGLE TREE", "ERA", "INDOHOUSE",
    "JPI", "MITRA PROPERTI", "MYPRO", "ONE REALTY", "PJ PRO",
    "PROFESIONAL BROKER", "PROMEX", "PROPNEX", "SUCCESS PROPERTI",
    "TUNGGADEWI LAND",
]

# Words removed from an agency name, in this order.
AGENCY_STOP_WORDS = [
    "DEPOK", "TANGGERANG", "BANDUNG", "JAKARTA", "GARDEN CITY",
    "GADING SERPONG", "KELAPA GADING", "CILEUNGSI", "CENGKARENG", "BINTARO",
    "MALANG", "TANGERANG", "CIBUBUR", "PALEMBANG", "TANJUNG DUREN", "SENTUL",
    "JATIASIH", "BRANCH", "AGENCY", "INTERIOR DESIGN", "&",
]

# Spellings that mean "no agency".
INDEPENDENT_SPELLINGS = [
    "NOT IDENTIFIED", "INDEPDENDENT", "INDEPEDENT", "INDEPENDENT",
]

# Indonesian month names, January first.
MONTH_NAMES = [
    "Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli",
    "Agustus", "September", "Oktober", "November", "Desember",
]

# Amenity -> category lists; anything else is "other".
AMENITY_CATEGORIES = {
    "sustenance": [
        "bar", "biergarten", "cafe", "fast_food", "food_court", "ice_cream",
        "pub", "restaurant",
    ],
    "education": [
        "college", "dancing_school", "driving_school", "first_aid_school",
        "kindergarten", "language_school", "library", "surf_school",
        "toy_library", "research_institute", "training", "music_school",
        "school", "traffic_park", "university", "prep_school",
    ],
    "transportation": [
        "bicycle_parking", "bicycle_repair_station", "bicycle_rental",
        "bicycle_wash", "boat_rental", "boat_sharing", "bus_station",
        "car_rental", "car_sharing", "car_wash", "compressed_air",
        "vehicle_inspection", "charging_station", "driver_training",
        "ferry_terminal", "fuel", "grit_bin", "motorcycle_parking",
        "parking", "parking_entrance", "parking_space", "taxi",
        "weighbridge", "motorcycle_taxi",
    ],
    "financial": ["atm", "payment_terminal", "bank", "bureau_de_change"],
    "healthcare": [
        "baby_hatch", "clinic", "dentist", "doctors", "hospital",
        "nursing_home", "pharmacy", "social_facility", "veterinary",
        "animal_boarding", "animal_shelter", "animal_breeding", "childcare",
        "public_bath",
    ],
    "entertainment": [
        "arts_centre", "brothel", "casino", "cinema", "community_centre",
        "conference_centre", "events_venue", "exhibition_centre", "fountain",
        "gambling", "love_hotel", "music_venue", "nightclub", "planetarium",
        "public_bookcase", "social_centre", "stripclub", "studio",
        "swingerclub", "theatre", "hunting_stand", "karaoke_box", "karaoke",
    ],
    "public_service": [
        "courthouse", "fire_station", "police", "post_box", "post_depot",
        "post_office", "prison", "ranger_station", "townhall",
        "public_building", "grave_yard",
    ],
    "facilities": [
        "place_of_worship", "bbq", "bench", "dog_toilet", "dressing_room",
        "drinking_water", "give_box", "mailroom", "parcel_locker", "shelter",
        "shower", "telephone", "toilets", "water_point", "watering_place",
        "letter_box", "security_booth",
    ],
    "waste_management": [
        "sanitary_dump_station", "recycling", "waste_basket",
        "waste_disposal", "waste_transfer_station",
    ],
    "commercial": [
        "commercial", "retail", "marketplace", "beauty", "internet_cafe",
        "industrial", "coworking_space", "office",
    ],
}
OTHER_CATEGORY = "other"
CATEGORY_NAMES = [*AMENITY_CATEGORIES, OTHER_CATEGORY]

# Condition words -> condition, first match wins.
CONDITION_WORDS = {
    "baru": "furnished",
    "bagus": "furnished",
    "sudah": "furnished",
    "butuh": "unfurnished",
}

# Certificate words that fold into one label.
CERTIFICATE_OTHER_WORDS = ["ppjb", "lainnya"]
CERTIFICATE_OTHER = "Lainnya"

# NULL marker inside surrogate keys, default company label.
NULL_KEY_MARK = "_dbt_utils_surrogate_key_null_"
INDEPENDENT_LABEL = "Independen"

# Indonesian -> English terms (intercardinals corrected).
COMPASS = {
    "Utara": "North", "Selatan": "South", "Barat": "West", "Timur": "East",
    "Barat Daya": "Southwest", "Barat Laut": "Northwest",
    "Timur Laut": "Northeast", "Tenggara": "Southeast",
}
VIEWS = {
    "Pemukiman Warga": "neighborhood", "Pedesaan": "village",
    "Perkotaan": "cities", "Pegunungan": "mountains", "Taman Kota": "park",
}
WATER_SOURCES = {
    "Sumur Bor": "wells", "PAM atau PDAM": "municipal water",
    "Sumur Resapan": "wells", "Sumur Pompa": "wells",
}
STYLE_WORDS = {"Minimalis": "Minimalist"}
UNKNOWN_SCALAR = "tidak disebutkan"

# Spec keys (page label in snake case) used downstream.
SPEC_AREA_KEYS = {"luas_tanah": " m²", "luas_bangunan": " m²", "lebar_jalan": " Mobil"}
SPEC_INT_KEYS = [
    "kamar_tidur", "kamar_mandi", "kamar_pembantu", "kamar_mandi_pembantu",
    "dapur", "jumlah_lantai", "garasi", "carport", "tahun_dibangun",
    "tahun_di_renovasi",
]
SPEC_TEXT_KEYS = [
    "hadap", "sumber_air", "pemandangan", "tipe_properti",
    "konsep_dan_gaya_rumah", "material_lantai", "material_bangunan",
]
SPEC_FLAG_KEYS = ["hook", "ruang_makan", "ruang_tamu", "terjangkau_internet"]

# Defaults for missing specs.
SPEC_DEFAULTS = {
    "kamar_tidur": 1, "kamar_mandi": 1, "kamar_pembantu": 0,
    "kamar_mandi_pembantu": 0, "dapur": 1, "jumlah_lantai": 1, "garasi": 0,
    "carport": 0, "lebar_jalan": 0, "tahun_dibangun": 0,
    "tahun_di_renovasi": 0,
}
FLAG_DEFAULTS = {"hook": 0, "ruang_tamu": 1, "ruang_makan": 0, "terjangkau_internet": 0}

# Accepted values of the categorical columns.
ACCEPTED_VALUES = {
    "sertifikat": ["SHM - Sertifikat Hak Milik", "HGB - Hak Guna Bangunan", "HP - Hak Pakai", "Lainnya"],
    "kondisi_properti": ["furnished", "unfurnished", "semi furnished"],
    "kondisi_perabotan": ["furnished", "unfurnished", "semi furnished"],
    "hadap": ["Utara", "Timur Laut", "Timur", "Tenggara", "Selatan", "Barat Daya", "Barat", "Barat Laut"],
    "konsep_dan_gaya_rumah": [
        "Minimalis Modern", "Modern", "Minimalis", "Scandinavian", "American Classic",
        "Modern Glass House", "Kontemporer", "Town House", "Paviliun", "Industrial",
    ],
    "pemandangan": ["Pemukiman Warga", "Pegunungan", "Perkotaan", "Pedesaan", "Taman Kota", "Pantai"],
    "sumber_air": ["PAM atau PDAM", "Sumur Bor", "Sumur Pompa", "Sumur Resapan", "Sumur Galian"],
}

# Model feature columns, target first.
MODEL_COLUMNS = [
    "price", "subdistrict", "kamar_mandi", "kamar_pembantu", "luas_tanah",
    "luas_bangunan", "jumlah_lantai", "tahun_dibangun", "daya_listrik",
    "sumber_air", "land_building_ratio", "total_beds", "total_baths",
    "building_area_floor_ratio", "vehicle_accessibility",
]

# Listing documents as pieces (condition or None, text); {name} is a field, a missing one is MISSING_TEXT.
MISSING_TEXT = "None"
_ANY_MATERIAL = "house_materials IS NOT NULL OR floor_materials IS NOT NULL"
DOCUMENTS = {
    "full": [
        (None, "Dijual rumah dengan harga Rp{price} dan cicilan Rp{installment} beralamat di {subdistrict}, {city}, Indonesia.\n"),
        (None, "Luas tanah {luas_tanah} meter persegi dengan luas bangunan {luas_bangunan} meter persegi"),
        ("tahun_dibangun > 0", " dan dibangun pada tahun {tahun_dibangun}"),
        ("tahun_di_renovasi > 0", " dan terakhir direnovasi pada tahun {tahun_di_renovasi}"),
        (None, ".\nRumah "),
        ("kondisi_properti IS NOT NULL", "{kondisi_properti}"),
        (None, " "),
        ("hadap IS NOT NULL", "menghadap {hadap}"),
        (None, " "),
        ("konsep_dan_gaya_rumah IS NOT NULL", " dengan gaya {konsep_dan_gaya_rumah}"),
        (None, " "),
        ("pemandangan IS NOT NULL", "dan pemandangan {pemandangan} "),
        (None, " ini terdiri atas {lantai} lantai dengan {kamar_tidur} kamar tidur, {kamar_mandi} kamar mandi"),
        ("kamar_pembantu > 0", ", dan {kamar_pembantu} kamar pembantu"),
        (None, ".\nSpesifikasi rumah terdapat "),
        ("carport > 0", "{carport} carport, "),
        ("lebar_jalan > 0", "jalan muat {lebar_jalan} mobil,"),
        ("dapur > 0", " {dapur} dapur,"),
        ("daya_listrik > 0", " listrik {daya_listrik} VA"),
        (None, ", sumber air {sumber_air}, "),
        ("sertifikat IS NOT NULL", "bersertifikat {sertifikat}"),
        (None, ", "),
        ("ruang_tamu > 0", "ruang tamu"),
        ("ruang_makan > 0", ", ruang makan"),
        ("kondisi_perabotan IS NOT NULL", ", dan kondisi perabotan {kondisi_perabotan}"),
        (None, ".\n"),
        (_ANY_MATERIAL, "Rumah ini memiliki "),
        ("house_materials IS NOT NULL", "material bangunan {house_materials}"),
        (_ANY_MATERIAL, " "),
        ("house_materials IS NOT NULL AND floor_materials IS NOT NULL", "dan"),
        ("floor_materials IS NOT NULL", " material lantai {floor_materials}"),
        (None, ".\nFasilitas lain yang ditawarkan rumah ini adalah "),
        ("facilities IS NOT NULL", "{facilities},"),
        ("tags IS NOT NULL", "{tags}"),
        ("hook > 0", ", hook"),
        ("terjangkau_internet > 0", ", terjangkau internet"),
        (None, "."),
    ],
    "long": [
        (None, "Kode rumah: {id}\nDijual rumah dengan harga Rp{price} yang beralamat di {subdistrict}, {city}, Indonesia.\n"),
        (None, "Luas tanah {luas_tanah} meter persegi dengan luas bangunan {luas_bangunan} meter persegi"),
        ("tahun_dibangun > 0", " dan dibangun pada tahun {tahun_dibangun}"),
        (None, ".\nRumah terdiri atas {lantai} lantai dengan {kamar_tidur} kamar tidur, {kamar_mandi} kamar mandi"),
        ("kamar_pembantu > 0", ", dan {kamar_pembantu} kamar pembantu"),
        (None, ".\nFasilitas yang tersedia adalah "),
        ("carport > 0", "{carport} carport, "),
        ("lebar_jalan > 0", "jalan muat {lebar_jalan} mobil,"),
        ("dapur > 0", " {dapur} dapur,"),
        ("daya_listrik > 0", " listrik {daya_listrik} VA"),
        (None, ".\n\nBahan bangunan: {house_materials}\nFasilitas: {facilities}\nTag: {tags}\n\n"),
        ("length(description) > 10", "\nDeskripsi tambahan:\n{description}\n"),
        (None, "\n-----"),
    ],
    "lines": [
        (None, "Harga: Rp{price}\nAlamat: {subdistrict}, {city}, Indonesia\nCarport: {n_carport}\nDapur: {n_dapur}\n"),
        (None, "Daya listrik: {n_daya_listrik}\nJumlah lantai: {n_jumlah_lantai}\nKamar mandi: {n_kamar_mandi}\n"),
        (None, "Kamar tidur: {n_kamar_tidur}\nKamar pembantu: {n_kamar_pembantu}\nLebar jalan: {n_lebar_jalan}\n"),
        (None, "Luas tanah: {n_luas_tanah}\nLuas bangunan: {n_luas_bangunan}\nTahun dibangun: {n_tahun_dibangun}\n"),
        (None, "Fasilitas: {facilities}\nBahan bangunan: {house_materials}\nTag: {tags}\nDeskripsi: {plain_description}"),
    ],
    "short": [
        (None, "House for sale for Rp{price} located at {subdistrict}, {city}, Indonesia. "),
        (None, "A house with {luas_tanah} m sq land and {luas_bangunan} m sq building,"),
        ("tahun_dibangun > 0", " built at {tahun_dibangun}"),
        ("tahun_di_renovasi > 0", " and last rennovated at {tahun_di_renovasi}"),
        (None, ". The house is {kondisi_properti}, facing {facing} with {style} style and has {scenery} view. "),
        (None, "This house includes {lantai} floors with {kamar_tidur} bedrooms, {kamar_mandi} bathrooms"),
        ("kamar_pembantu > 0", ", and {kamar_pembantu} maid bedrooms"),
        (None, ", "),
        ("carport > 0", "{carport} carport, "),
        ("lebar_jalan > 0", "fit for {lebar_jalan} cars,"),
        ("dapur > 0", " {dapur} kitchen,"),
        ("daya_listrik > 0", " grid electricity of {daya_listrik} VA"),
        ("ruang_tamu > 0", ", water source from {water}, living room"),
        ("ruang_makan > 0", ", dining room"),
        (None, ", dan {kondisi_perabotan} furniture"),
    ],
}
# Units after the scalars of the "lines" document.
SCALAR_UNITS = {"daya_listrik": " watt", "lebar_jalan": " cars", "luas_tanah": " m^2", "luas_bangunan": " m^2"}
