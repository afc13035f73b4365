"""Text cleaning as native Column expressions (no Python workers)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as v

BLANKS = " \t\n\r\x0b\x0c"
NUMBER = r"^[ \t\r\n]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """`use` applied to a value that is computed once however often `use` mentions it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def strip(c: Column | str) -> Column:
    return F.trim(col(c), F.lit(BLANKS))


# -- parsing -----------------------------------------------------------------

def split_address(c: Column | str) -> tuple[Column, Column]:
    """Subdistrict and city of 'subdistrict, city'; NULL where a part is missing."""
    parts = F.split(col(c), ", ")
    return F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))


def to_number(c: Column | str, kind: str = "float") -> Column:
    """Number of a text or NULL; only plain decimal notation counts as a number."""
    c = col(c)
    return F.when(c.rlike(NUMBER), c.try_cast(kind))


def num_suffix(c: Column | str, chars: str) -> Column:
    """Strip any trailing run of `chars` (a set of characters), then parse."""
    return to_number(F.rtrim(col(c), F.lit(chars)))


def parse_watt(c: Column | str) -> Column:
    return to_number(F.replace(F.rtrim(F.lower(col(c)), F.lit("watt")), F.lit("lainnya"), F.lit("0")))


def try_int(c: Column | str) -> Column:
    """Text to int, halves rounded away from zero, NULL when not a number."""
    return F.round(to_number(c, "double")).try_cast("int")


def is_yes(c: Column | str) -> Column:
    return col(c) == F.lit("Ya")


def flag_or(c: Column | str, default: int) -> Column:
    return F.coalesce(col(c).cast("int"), F.lit(default))


def bool_to_int(c: Column | str) -> Column:
    return F.when(col(c), 1).otherwise(0)


def to_timestamp(c: Column | str) -> Column:
    return F.try_to_timestamp(col(c))


# -- normalising -------------------------------------------------------------

def normalize_condition(c: Column | str) -> Column:
    c = col(c)
    whens = [F.when(c.ilike(f"%{word}%"), F.lit(out)) for word, out in v.CONDITION_WORDS.items()]
    return F.coalesce(*whens, F.lower(c))


def normalize_certificate(c: Column | str) -> Column:
    c = col(c)
    hit = reduce(lambda a, b: a | b, [c.ilike(f"%{w}%") for w in v.CERTIFICATE_OTHER_WORDS])
    return F.when(hit, F.lit(v.CERTIFICATE_OTHER)).otherwise(c)


def amenity_category(c: Column | str, categories: dict[str, list[str]] | None = None) -> Column:
    categories = v.AMENITY_CATEGORIES if categories is None else categories
    c = col(c)
    return F.coalesce(
        *[F.when(c.isin(names), F.lit(cat)) for cat, names in categories.items()],
        F.lit(v.OTHER_CATEGORY),
    )


def clean_tag(c: Column | str) -> Column:
    return F.replace(F.lower(col(c)), F.lit(" "), F.lit("_"))


def clean_material(c: Column | str) -> Column:
    return F.replace(F.trim(col(c)), F.lit(" "), F.lit("_"))


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, lower case elsewhere."""
    runs = F.regexp_extract_all(col(c), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1))

    def capital(w: Column) -> Column:
        # a letter may grow when upper-cased (sharp s): only its first part stays a capital
        big = F.upper(F.substring(w, 1, 1))
        return F.concat(F.substring(big, 1, 1), F.lower(F.concat(F.substr(big, F.lit(2)), F.substr(w, F.lit(2)))))

    return F.array_join(F.transform(runs, capital), "")


def label(c: Column | str) -> Column:
    return title_case(F.replace(col(c), F.lit("_"), F.lit(" ")))


def clean_facility(c: Column | str) -> Column:
    """Canonical facility name in snake case; NULL for blanks and stop fragments."""
    def canonical(name: Column) -> Column:
        stop = reduce(lambda a, b: a | b, [name.contains(w) for w in v.FACILITY_STOP_FRAGMENTS])
        ruled = F.coalesce(*[F.when(name.contains(k), F.lit(out)) for k, out in v.FACILITY_RULES.items()], name)
        return F.when((F.length(name) > 0) & ~stop, F.lower(F.replace(ruled, F.lit(" "), F.lit("_"))))

    return let(F.upper(strip(c)), canonical)


def clean_company(c: Column | str) -> Column:
    """Canonical agency name; unknown and empty names become INDEPENDENT."""
    def own_name(folded: Column) -> Column:
        bare = reduce(lambda a, w: F.replace(a, F.lit(w), F.lit("")), v.AGENCY_STOP_WORDS, folded)
        return let(F.trim(F.regexp_replace(bare, " +", " ")), lambda b: F.when(nobody(b), F.lit("INDEPENDENT")).otherwise(b))

    def nobody(bare: Column) -> Column:
        odd = [bare.contains(w) for w in v.INDEPENDENT_SPELLINGS]
        return reduce(lambda a, b: a | b, odd, bare.isin("", "PROPERTI"))

    def known(folded: Column) -> Column:
        return F.coalesce(*[F.when(folded.contains(w), F.lit(w)) for w in v.KNOWN_AGENCIES], own_name(folded))

    def canonical(name: Column) -> Column:
        franchise = name.contains("CENTURY 21") | name.contains("CENTURY21")
        return F.when(franchise, F.lit("CENTURY21")).otherwise(
            let(F.replace(name, F.lit("PROPERTY"), F.lit("PROPERTI")), known)
        )

    return let(F.upper(strip(c)), canonical)


def translate_values(c: Column | str, mapping: dict[str, str]) -> Column:
    c = col(c)
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(table, c), c)


def norm_text(c: Column | str) -> Column:
    """ASCII only, newlines as full stops, single blanks, single punctuation."""
    s = F.regexp_replace(col(c), r"[^\x00-\x7F]", "")
    s = F.replace(s, F.lit("\n"), F.lit(". "))
    s = F.regexp_replace(s, r"[\t-\r\x1c-\x20]+", " ")
    s = F.regexp_replace(s, r'[ ]([?.!:"](?:[ ]|$))', "$1")
    return F.regexp_replace(s, r'([?.!"])[?.!"]+', "$1")


# -- masking and keys --------------------------------------------------------

def mask_name(c: Column | str) -> Column:
    c = col(c)
    words = F.filter(F.split(c, r"\s+"), lambda w: w != F.lit(""))
    masked = F.transform(
        words, lambda w: F.concat(F.substring(w, 1, 1), F.repeat(F.lit("x"), F.length(w) - 1))
    )
    return F.when(F.length(c) >= 1, F.array_join(masked, " "))


def mask_phone(c: Column | str) -> Column:
    c = col(c)
    return F.when(
        F.length(c) >= 3,
        F.concat(F.repeat(F.lit("x"), F.length(c) - 3), F.right(c, F.lit(3))),
    )


def agent_hash(name: Column | str, phone: Column | str) -> Column:
    """Hash of name and phone; a missing part counts as empty."""
    return F.sha2(F.concat_ws("", col(name), col(phone)), 256)


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(col(c).cast("string"), F.lit(v.NULL_KEY_MARK)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# -- numbers and formats -----------------------------------------------------

def to_idr(c: Column | str) -> Column:
    """Millions of rupiah to rupiah."""
    return col(c) * 1_000_000


def first_digit(c: Column | str) -> Column:
    return F.substring(F.abs(col(c)).cast("decimal(38,0)").cast("string"), 1, 1).try_cast("int")


def pct_change(x: Column | str, y: Column | str) -> Column:
    return F.try_divide(col(x) - col(y), col(y))


def rupiah(c: Column | str) -> Column:
    """Whole amount with dots between thousands."""
    return F.translate(F.format_number(col(c), 0), ",", ".")


def price_short(c: Column | str) -> Column:
    """Compact rupiah amount with Indonesian unit (rb, jt, M, T)."""
    c = col(c)
    out = F.concat(F.lit("Rp "), F.format_number(F.round(c), 0))
    for scale, unit in ((1e3, "rb"), (1e6, "jt"), (1e9, "M"), (1e12, "T")):
        out = F.when(F.abs(c) >= scale, F.concat(F.lit("Rp "), F.format_number(c / scale, 0), F.lit(f" {unit}"))).otherwise(out)
    return out


def price_long(c: Column | str) -> Column:
    """Rupiah amount, dots between thousands, comma before two decimals."""
    return F.concat(F.lit("Rp "), F.translate(F.format_number(col(c), 2), ",.", ".,"))


def norm_scalar(c: Column | str, suffix: str = "", default: str = v.UNKNOWN_SCALAR) -> Column:
    c = col(c)
    return F.when(c == 0, F.lit(default)).otherwise(F.concat(c.cast("string"), F.lit(suffix)))


def num_max(x: Column | str, y: Column | str | int | float) -> Column:
    return F.greatest(col(x), F.lit(y) if isinstance(y, int | float) else col(y))


def too_long(c: Column | str, n: int = 500) -> Column:
    return F.length(col(c)) > n
