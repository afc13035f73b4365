from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotlens.functions import sqlnames
from lotlens.functions import text as x
from lotlens.functions import vocab as v

S = "c string"


def one(rows, fn, *values):
    return [r[0] for r in rows([(s,) for s in values], S, fn("c"))]


def test_split_address(rows):
    got = rows([("A, B",), ("A",), (None,)], S, *x.split_address("c"))
    assert got == [("A", "B"), ("A", None), (None, None)]


def test_numbers(rows):
    assert one(rows, lambda c: x.num_suffix(c, " m²"), "100 m²", "x", None, "12d", "-5 m²") == [100.0, None, None, None, -5.0]
    assert one(rows, lambda c: x.num_suffix(c, " Mobil"), "3 Mobil") == [3.0]
    assert one(rows, x.parse_watt, "2200 watt", "2200 Watt", "lainnya", "lainnya watt", "x") == [2200.0, 2200.0, None, 0.0, None]
    assert one(rows, x.try_int, "3", "2.7", ">10", "2.5", "-2.5", "99999999999", None) == [3, 3, None, 3, -3, None, None]


def test_flags(rows):
    got = rows([("Ya",), ("Tidak",), (None,)], S, x.flag_or(x.is_yes("c"), 1), x.bool_to_int(x.is_yes("c")))
    assert got == [(1, 1), (0, 0), (1, 0)]


def test_normalise(rows):
    assert one(rows, x.normalize_condition, "Bagus Sekali", "Butuh Renovasi", "BARU", "Semi Furnished", None) == [
        "furnished", "unfurnished", "furnished", "semi furnished", None]
    assert one(rows, x.normalize_certificate, "PPJB", "Lainnya (Girik)", "SHM", None) == ["Lainnya", "Lainnya", "SHM", None]
    assert one(rows, x.amenity_category, "cafe", "zoo", None) == ["sustenance", "other", "other"]


TITLES = ["re/max AIR", "o'neil 2nd-hand", "ßtraße école", "", "a1b_c d", None, "ÉCOLE ǆ"]


def test_title_case(rows):
    assert one(rows, x.title_case, *TITLES[:6]) == [None if t is None else t.title() for t in TITLES[:6]]


def test_masks(rows):
    assert one(rows, x.mask_name, "Budi Santoso", "", None, "  a  bc ", " ") == ["Bxxx Sxxxxxx", None, None, "a bx", ""]
    assert one(rows, x.mask_phone, "0812345", "12", "", "123", None) == ["xxxx345", None, None, "123", None]


FACILITIES = {
    "Jogging Track": "ac", "CCTV": None, "Wi-Fi": None, "Lapangan Bermain": "taman", "Masjid": "masjid", " ": None,
    "kolam ikan": "kolam_ikan", "Wifi": "internet", None: None,
}
COMPANIES = {
    "Century 21 X": "CENTURY21", "Ray White Depok": "RAY WHITE", "Depok Property": "INDEPENDENT", None: None, "": "INDEPENDENT",
    "Independent Agent": "INDEPENDENT", "Rumah  Kita & Agency": "RUMAH KITA", "Bintang Property": "BINTANG PROPERTI",
}


def test_facility_and_company(rows):
    assert one(rows, x.clean_facility, *FACILITIES) == list(FACILITIES.values())
    assert one(rows, x.clean_company, *COMPANIES) == list(COMPANIES.values())


def test_sql_functions_equal_columns(spark):
    sqlnames.register(spark)
    values = [*FACILITIES, *COMPANIES, *TITLES, "0812345", "x y  z"]
    df = spark.createDataFrame([(s,) for s in values], S)
    pairs = {
        "TITLE_CASE": x.title_case, "MASK_NAME": x.mask_name, "MASK_PHONE": x.mask_phone,
        "CLEAN_FACILITY": x.clean_facility, "CLEAN_AGENCY_COMPANY": x.clean_company,
    }
    for name, fn in pairs.items():
        got = df.select(F.expr(f"{name}(c)"), fn("c")).collect()
        assert [r[0] for r in got] == [r[1] for r in got], name


def test_keys(rows):
    a, b, c = (r[0] for r in rows([("", "x"), (None, "x"), ("y", None)], "a string, b string", x.surrogate_key("a", "b")))
    assert len({a, b, c}) == 3
    h = rows([("n", None), ("n", ""), (None, "n")], "a string, b string", x.agent_hash("a", "b"))
    assert len(set(h)) == 1


def test_norm_text(rows):
    assert one(rows, x.norm_text, "Halo  dunia ! é\nBaru.. sekali ?!") == ["Halo dunia! . Baru. sekali ?"]


def test_formats(rows):
    got = rows([(1234567.0,), (0.0,)], "c double", x.rupiah("c"), x.price_long("c"), x.price_short("c"), x.norm_scalar("c", " m"))
    assert got == [("1.234.567", "Rp 1.234.567,00", "Rp 1 jt", "1234567.0 m"), ("0", "Rp 0,00", "Rp 0", "tidak disebutkan")]
    assert rows([(1e9,), (250.5,)], "c double", x.first_digit("c")) == [(1,), (2,)]
    assert rows([(3.0, 2.0), (1.0, 0.0)], "a double, b double", x.pct_change("a", "b")) == [(0.5,), (None,)]


def test_vocabulary_sizes():
    assert (len(v.FACILITY_STOP_FRAGMENTS), len(v.KNOWN_AGENCIES), len(v.AGENCY_STOP_WORDS)) == (43, 41, 21)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ 0-'/.é", max_size=12), min_size=1, max_size=20))
def test_title_case_like_python(spark, values):
    got = spark.createDataFrame([(s,) for s in values], S).select(x.title_case("c")).collect()
    assert [r[0] for r in got] == [s.title() for s in values]
