"""Listing fields from fetched pages.

Pages of listings are read by their nesting (`page_fields`: one pass over Arrow batches of pages, blocks end at
their own closing tags); numbers, dates, links and image addresses are then plain columns. Links, and the parts of flat
pages, are regular expressions over the page. Every name and pattern is in `Rules`, so other page layouts need other
values, not other code.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Container, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import vocab as v
from ..functions.text import BLANKS, col, let, strip
from . import pagebatch, pagetree

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(pagetree)
cloudpickle.register_pickle_by_value(pagebatch)

NUMBER = r"[0-9]*[.,]?[0-9]+"
DATE = r"([0-9]{1,2}) (\w+) ([0-9]{4})"


@dataclass(frozen=True)
class Rules:
    """Patterns, names and marker words of one page layout.

    The defaults are fixed values: addresses, class names and words of the listing site.
    """

    detail_has: str = "/properti/"
    detail_not: str = "/perumahan-baru"
    # nested pages: the class of the divisions that hold the listing, and the words and classes of their parts
    container_class: str = "ui-container"
    price_mark: str = "Rp "
    installment_word: str = "Cicilan"
    modified_word: str = "Diperbarui"
    description_word: str = "ripsi"
    spec_word: str = "pesifikasi"
    spec_class: str = "mb-4"
    facility_id: str = "facility"
    # which division of the container holds the agent
    agent_part: int = 2
    agent_class: str = "flex-grow"
    phone_button: str = "phone"
    phone_has: str = "62"
    image_set: str = "1x"
    image_alt_not: str = "map"
    # flat pages: patterns whose group 1 is the wanted text
    link: str = r"""<a\s[^>]*?href=["']([^"']*)["']"""
    paragraph: str = r"(?s)<p(?:\s[^>]*)?>(.*?)(?=</p>|<p[\s>])"
    address: str = r"(?s)<h1(?:\s[^>]*)?>.*?</h1>.*?<p(?:\s[^>]*)?>([^<]*)"
    item: str = r"<li(?:\s[^>]*)?>([^<]+)<"
    # image addresses
    image_url: str = r"url=(.+) [0-9]x,"
    image_has: str = "/customer/"

    def but(self, **kw: str) -> Rules:
        return replace(self, **kw)


SITE = Rules()


# -- helpers -----------------------------------------------------------------

# fixed values: character entities and their characters
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "copy": "©", "reg": "®", "deg": "°", "plusmn": "±", "middot": "·", "times": "×",
    "sup2": "²", "sup3": "³", "frac12": "½", "laquo": "«", "raquo": "»", "iexcl": "¡", "iquest": "¿", "euro": "€", "pound": "£", "yen": "¥",
    "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "hellip": "…", "bull": "•", "trade": "™",
    "agrave": "à", "aacute": "á", "acirc": "â", "atilde": "ã", "auml": "ä", "aring": "å", "aelig": "æ", "ccedil": "ç", "egrave": "è", "eacute": "é",
    "ecirc": "ê", "euml": "ë", "igrave": "ì", "iacute": "í", "icirc": "î", "iuml": "ï", "ntilde": "ñ", "ograve": "ò", "oacute": "ó", "ocirc": "ô",
    "otilde": "õ", "ouml": "ö", "oslash": "ø", "ugrave": "ù", "uacute": "ú", "ucirc": "û", "uuml": "ü", "szlig": "ß",
    "Eacute": "É", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü", "Ntilde": "Ñ", "Ccedil": "Ç",
}


def _decoded(entity: Column) -> Column:
    """Character of an entity like &eacute; &#233; &#xE9;, itself when unknown."""
    number = F.coalesce(
        F.conv(F.nullif(F.regexp_extract(entity, "^&#[xX]([0-9A-Fa-f]{1,6});$", 1), F.lit("")), 16, 16),
        F.conv(F.nullif(F.regexp_extract(entity, "^&#([0-9]{1,7});$", 1), F.lit("")), 10, 16),
    )
    named = F.create_map(*[F.lit(x) for name, ch in ENTITIES.items() for x in (f"&{name};", ch)])
    return F.coalesce(F.try_element_at(named, entity), F.decode(F.unhex(F.lpad(number, 8, "0")), "UTF-32"), entity)


def unescape(c: Column | str) -> Column:
    """Character entities as characters, in one pass (the ampersand's own entity last)."""
    c = col(c)
    found = F.array_distinct(F.regexp_extract_all(c, F.lit("(&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);)"), F.lit(1)))
    plain = F.aggregate(F.filter(found, lambda e: ~e.isin("&amp;", "&#38;", "&#x26;")), c, lambda acc, e: F.replace(acc, e, _decoded(e)))
    last = plain
    for e in ("&#38;", "&#x26;", "&amp;"):
        last = F.replace(last, F.lit(e), F.lit("&"))
    return F.when(c.contains("&"), last).otherwise(c)


def unquote(c: Column | str) -> Column:
    """Percent decoding that leaves '+' alone; malformed input stays as it is."""
    c = col(c)
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def _first(html: Column | str, pattern: str) -> Column:
    """First match as text, NULL when absent or empty."""
    return unescape(F.nullif(F.regexp_extract(col(html), pattern, 1), F.lit("")))


def _all(html: Column | str, pattern: str) -> Column:
    return F.regexp_extract_all(col(html), F.lit(pattern), F.lit(1))


def site_of(url: Column | str) -> Column:
    return F.regexp_extract(col(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def resolve(base: Column | str, href: Column | str) -> Column:
    """Absolute URL of a link found on page `base`, without dot segments."""
    return let(F.struct(col(base).alias("b"), col(href).alias("h")), lambda s: let(_resolve(s["b"], s["h"]), _without_dots))


def _without_dots(url: Column) -> Column:
    site = site_of(url)
    path = F.regexp_extract(F.substring(url, F.length(site) + 1, F.length(url)), "^([^?#]*)", 1)
    tail = F.substring(url, F.length(site) + F.length(path) + 1, F.length(url))
    parts = F.split(path, "/")
    walked = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(p == ".", acc).otherwise(F.array_append(acc, p)),
    )
    open_end = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(walked) > 0), "/").otherwise("")
    clean = F.concat(site, F.lit("/"), F.array_join(walked, "/"), open_end, tail)
    return F.when((site != "") & F.regexp_like(path, F.lit(r"/\.\.?(/|$)")), clean).otherwise(url)


def _resolve(base: Column, href: Column) -> Column:
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.when(page == site_of(base), F.concat(page, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    return (
        F.when(F.regexp_like(href, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(href.startswith("/"), F.concat(site_of(base), href))
        .when(href.startswith("?"), F.concat(page, href))
        .when((href == "") | href.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), href))
        .otherwise(F.concat(folder, href))
    )


# -- fields ------------------------------------------------------------------

def is_detail(url: Column | str, rules: Rules = SITE) -> Column:
    return col(url).contains(rules.detail_has) & ~col(url).contains(rules.detail_not)


def url_id(url: Column | str) -> Column:
    return F.regexp_extract(col(url), "([^/]+)/*$", 1)


def parse_price(c: Column | str) -> Column:
    """First number of a text, comma as decimal point; NULL when there is none."""
    return F.replace(F.nullif(F.regexp_extract(col(c), NUMBER, 0), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def price_in_millions(text: Column | str) -> Column:
    scaled = lambda t: F.when(t.contains("miliar"), parse_price(t) * 1000).when(t.contains("juta"), parse_price(t))
    return let(F.lower(col(text)), scaled)


def parse_id_date(c: Column | str) -> Column:
    """First 'd Month yyyy' with an Indonesian month name; NULL when absent or no such day."""
    c = col(c)
    part = lambda i: F.regexp_extract(c, DATE, i)
    months = F.create_map(*[F.lit(x) for i, m in enumerate(v.MONTH_NAMES, 1) for x in (m, i)])
    iso = F.concat_ws(
        "-", part(3), F.lpad(F.try_element_at(months, part(2)).cast("string"), 2, "0"), F.lpad(part(1), 2, "0")
    )
    return F.when(F.try_element_at(months, part(2)).isNotNull(), iso.try_cast("date"))


def flat_paragraphs(html: Column | str, rules: Rules = SITE) -> Column:
    """Contents of all paragraphs of a flat page, tags inside kept."""
    return _all(html, rules.paragraph)


def flat_address(html: Column | str, rules: Rules = SITE) -> Column:
    return _first(html, rules.address)


def flat_items(html: Column | str, rules: Rules = SITE) -> Column:
    """Texts of all list items, trimmed."""
    return F.transform(_all(html, rules.item), lambda e: strip(unescape(e)))


def flat_description(parts: Column | str, rules: Rules = SITE) -> Column:
    """First text of the paragraph after the one that announces it."""
    parts = col(parts)
    marked = F.array_position(F.transform(parts, lambda p: p.contains(rules.description_word)), F.lit(True))
    after = F.when(marked > 0, F.get(parts, marked.cast("int")))
    return unescape(F.nullif(F.regexp_extract(after, "^([^<]*)", 1), F.lit("")))


# -- nested pages ------------------------------------------------------------

FIELDS = (
    "price_text string, installment_text string, address string, modified_text string, description string, tags array<string>,"
    " specs map<string,string>, facilities array<string>, agent_name string, agent_href string, phone string, company_name string,"
    " company_href string, image_sets array<string>"
)
FIELD_NAMES = (
    "price_text", "installment_text", "address", "modified_text", "description", "tags", "specs", "facilities", "agent_name", "agent_href", "phone",
    "company_name", "company_href", "image_sets",
)
AGENT_NAMES = FIELD_NAMES[8:13]


def read_page(html: str | None, rules: Rules = SITE, wanted: Container[str] = FIELD_NAMES) -> tuple:
    """The raw fields of one page, in the order of FIELDS; those not wanted are None and their parts of the page are not visited."""
    page = pagetree.Page(html or "")
    boxes = [i for i in page.within([0], "div") if page.has(i, "class", rules.container_class)]
    paragraphs = page.within(boxes, "p")
    holding = lambda found, word: (i for i in found if word in page.text(i))
    texts = lambda found: (t for i in found for t in page.own_texts(i))
    unique = lambda found: sorted(set(found))
    party = lambda a: (None, None) if a is None else ((page.attribute(a, "title") or "").strip(BLANKS), (page.attribute(a, "href") or "").strip(BLANKS))

    def price() -> str | None:
        spans, done = page.within(boxes, "span"), 0
        for d in page.within(boxes, "div"):
            k, stop = bisect_left(spans, d + 1), page.end[d]
            if k < len(spans) and spans[k] < stop and stop > done and rules.price_mark in page.text(spans[k]):
                for s in spans[k:bisect_left(spans, stop)]:
                    if s >= done and (found := page.own_texts(s)):
                        return found[0]
                done = stop
        return None

    def installment() -> str | None:
        i = next(holding(paragraphs, rules.installment_word), None)
        return None if i is None else page.text(i)

    def address() -> str | None:
        inner = set(page.within(boxes, "div"))
        titles = [h for h in page.within(boxes, "h1") if page.parent[h] in inner]
        return next(texts(unique(p for h in titles for p in page.after(h, "p")[:1])), None)

    def modified() -> str | None:
        i = next(holding(page.within([0], "p"), rules.modified_word), None)
        return None if i is None else page.text(i)

    def description() -> str | None:
        return next(texts(unique(q for p in holding(paragraphs, rules.description_word) for q in page.after(p, "p"))), None)

    def tags() -> list[str]:
        lists = unique(u for p in paragraphs for u in page.after(p, "ul"))
        return [t.strip(BLANKS) for t in texts(i for u in lists for i in page.children(u, "li"))]

    def specs() -> dict[str, str]:
        parts = unique(d for p in holding(paragraphs, rules.spec_word) for d in page.after(p, "div"))
        rows = ([*texts(page.children(d, "p"))] for d in page.within(parts, "div") if page.has(d, "class", rules.spec_class))
        return {r[0]: r[1] for r in rows if len(r) == 2}

    def facilities() -> list[str]:
        places = [d for d in page.within([0], "div") if page.has(d, "id", rules.facility_id)]
        return [t.strip(BLANKS) for t in texts(unique(s for p in page.within(places, "p") for s in page.children(p, "span")))]

    def agents() -> tuple:
        sides = [d[rules.agent_part - 1] for b in boxes if len(d := page.children(b, "div")) >= rules.agent_part]
        blocks = (d for d in page.within(sides, "div") if page.has(d, "class", rules.agent_class))
        who, firm = [*unique(a for d in blocks for a in page.children(d, "a") if page.attribute(a, "title") is not None), None, None][:2]
        phones = (t for b in page.within([0], "button") if page.attribute(b, "name") == rules.phone_button and rules.phone_has in (t := page.attribute(b, "title") or ""))
        return *party(who), None if who is None else next(phones, None), *party(firm)

    def images() -> list[str]:
        found = (i for i in page.within([0], "img") if page.has(i, "srcset", rules.image_set) and not page.has(i, "alt", rules.image_alt_not))
        return [page.attribute(i, "srcset") for i in found]

    one = lambda name, of: of() if name in wanted else None
    return (
        one("price_text", price), one("installment_text", installment), one("address", address), one("modified_text", modified),
        one("description", description), one("tags", tags), one("specs", specs), one("facilities", facilities),
        *(agents() if any(n in wanted for n in AGENT_NAMES) else [None] * len(AGENT_NAMES)), one("image_sets", images),
    )


def read_pages(data: bytes, bounds: np.ndarray, rules: Rules = SITE, wanted: Container[str] = FIELD_NAMES) -> list[tuple]:
    """What `read_page` gives for each of the pages data[bounds[i]:bounds[i + 1]], read many at a time."""
    pages = pagebatch.Pages(data, bounds)
    divs = pages.all("div")
    boxes = pages.has(divs, "class", rules.container_class)
    columns: dict[str, list] = {}

    def store(name: str, found: Iterable[tuple]) -> None:
        column = columns[name] = [None] * len(pages.odd)
        for page, value in found:
            column[page] = value

    def gathered(name: str, found: Iterable[tuple], empty: type = list) -> None:
        column = columns[name] = [empty() for _ in pages.odd]
        for page, value in found:
            if empty is dict:
                column[page].update([value])
            else:
                column[page].append(value)

    page_of = lambda found: zip(pages.page[found].tolist(), found.tolist())
    first_text = lambda found: ((page, t) for page, _, t in pages.own_texts(found, first=True))
    first_whole = lambda found: ((page, pages.text(i)) for page, i in page_of(pages.firsts(found)))
    trimmed = lambda found: ((page, t.strip(BLANKS)) for page, _, t in pages.own_texts(found))
    paragraphs = pages.within(boxes, "p")

    if "price_text" in wanted:
        inner, spans = pages.within(boxes, "div"), pages.within(boxes, "span")
        k = np.searchsorted(spans, inner)
        some = k < len(spans)
        inner, heads = inner[some], spans[k[some]]
        inside = heads < pages.end[inner]
        marked = pages.holding(np.unique(heads[inside]), rules.price_mark)
        store("price_text", first_text(pages.within(inner[inside & np.isin(heads, marked)], "span")))
    if "installment_text" in wanted:
        store("installment_text", first_whole(pages.holding(paragraphs, rules.installment_word)))
    if "address" in wanted:
        titles = pages.within(boxes, "h1")
        titles = titles[np.isin(pages.parent[titles], pages.within(boxes, "div"))]
        store("address", first_text(pages.next_after(titles, "p")))
    if "modified_text" in wanted:
        store("modified_text", first_whole(pages.holding(pages.all("p"), rules.modified_word)))
    if "description" in wanted:
        store("description", first_text(pages.after(pages.holding(paragraphs, rules.description_word), "p")))
    if "tags" in wanted:
        gathered("tags", trimmed(pages.children(pages.after(paragraphs, "ul"), "li")))
    if "specs" in wanted:
        rows = pages.has(pages.within(pages.after(pages.holding(paragraphs, rules.spec_word), "div"), "div"), "class", rules.spec_class)
        words: dict[int, list[str]] = {}
        for _, i, t in pages.own_texts(pages.children(rows, "p")):
            words.setdefault(int(pages.parent[i]), []).append(t)
        gathered("specs", ((page, words[i]) for page, i in page_of(rows) if len(words.get(i, ())) == 2), dict)
    if "facilities" in wanted:
        places = pages.has(divs, "id", rules.facility_id)
        gathered("facilities", trimmed(pages.children(pages.within(places, "p"), "span")))
    if any(n in wanted for n in AGENT_NAMES):
        sides = pages.children(boxes, "div")
        sides = np.unique(sides[np.arange(len(sides)) - np.searchsorted(pages.parent[sides], pages.parent[sides]) == rules.agent_part - 1])
        links = np.sort(pages.children(pages.has(pages.within(sides, "div"), "class", rules.agent_class), "a"))
        parties: dict[int, list[tuple]] = {}
        for page, i in page_of(links):
            if len(known := parties.setdefault(page, [])) < 2 and (title := pages.attribute(i, "title")) is not None:
                known.append((title.strip(BLANKS), (pages.attribute(i, "href") or "").strip(BLANKS)))
        phones: dict[int, str] = {}
        for page, i in page_of(pages.all("button")):
            if page not in phones and parties.get(page) and pages.attribute(i, "name") == rules.phone_button and rules.phone_has in (t := pages.attribute(i, "title") or ""):
                phones[page] = t
        for at, name in enumerate(AGENT_NAMES):
            take = (lambda p, who: phones.get(p)) if at == 2 else (lambda p, who, k=at // 3, j=at % 3: who[k][j] if len(who) > k else None)
            store(name, ((p, take(p, who)) for p, who in parties.items()))
    if "image_sets" in wanted:
        images = pages.has(pages.all("img"), "srcset", rules.image_set)
        images = images[~np.isin(images, pages.has(images, "alt", rules.image_alt_not))]
        gathered("image_sets", ((page, pages.attribute(i, "srcset")) for page, i in page_of(images)))

    nothing = [None] * len(pages.odd)
    rows = [*zip(*(columns.get(n, nothing) for n in FIELD_NAMES))]
    for i in np.flatnonzero(pages.odd).tolist():
        rows[i] = read_page(data[bounds[i]:bounds[i + 1]].decode(), rules, wanted)
    return rows


#: Bytes of pages that are read at a time, about.
READ_BYTES = 4 << 20


def page_fields(pages: DataFrame, rules: Rules = SITE, only: Sequence[str] = FIELD_NAMES) -> DataFrame:
    """url and the raw fields (or `only` some of them) of every page (url, html), read by the nesting of its elements."""
    whole = T._parse_datatype_string(f"url string, {FIELDS}")
    schema = T.StructType([f for f in whole if f.name == "url" or f.name in only])
    taken = [i for i, n in enumerate(FIELD_NAMES) if n in only]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("html")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            turn = np.cumsum(sizes) // READ_BYTES
            cuts = [0, *(np.flatnonzero(turn[1:] != turn[:-1]) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for i, stop in zip(cuts, cuts[1:]):
                part = batch.slice(i, stop - i)
                html = pc.fill_null(part.column("html").cast(pa.large_binary()), b"")
                places = np.frombuffer(html.buffers()[1], dtype=np.int64)[html.offset:html.offset + len(html) + 1]
                data = html.buffers()[2][places[0]:places[-1]].to_pybytes() if places[-1] else b""
                found = [*zip(*read_pages(data, places - places[0], rules, only))]
                columns = [pa.array([[*m.items()] for m in found[k]] if pa.types.is_map(f.type) else found[k], f.type) for k, f in zip(taken, [*arrow][1:])]
                yield pa.RecordBatch.from_arrays([part.column("url").cast(arrow[0].type), *columns], schema=arrow)

    return pages.select("url", "html").mapInArrow(run, schema)


def agent(url: Column | str = "url") -> Column:
    """Agent of the raw fields: the first titled link, its company the second; links are resolved against the site."""
    site = site_of(url)
    full = lambda c: F.when(F.col(c).isNotNull(), resolve(site, c))
    company = F.struct(F.col("company_name").alias("name"), full("company_href").alias("url"))
    return F.struct(
        F.col("agent_name").alias("name"), full("agent_href").alias("url"), F.col("phone"),
        F.when(F.col("company_name").isNotNull(), company).alias("company"))


def uploaded_images(sets: Column | str = "image_sets", rules: Rules = SITE) -> Column:
    """Uploaded images: the first source of each image set, without resizing parameters."""
    found = F.transform(col(sets), lambda t: unquote(F.regexp_extract(t, rules.image_url, 1)))
    return F.transform(F.filter(found, lambda u: u.contains(rules.image_has)), lambda u: F.substring_index(u, "&", 1))


def image_path(item_id: Column | str, url: Column | str) -> Column:
    """'<item id>/<file name of the url>'."""
    path = F.regexp_extract(col(url), r"^([^?#]*)", 1)
    return F.concat_ws("/", col(item_id), unquote(F.regexp_extract(path, "([^/]*)/*$", 1)))


# -- whole pages -------------------------------------------------------------

def extract_links(pages: DataFrame, rules: Rules = SITE) -> DataFrame:
    """Links (page_url, href, url) to detail pages found on each page."""
    found = pages.select(F.col("url").alias("page_url"), F.explode(F.transform(_all("html", rules.link), unescape)).alias("href"))
    return found.filter(is_detail("href", rules)).select("page_url", "href", resolve("page_url", "href").alias("url"))


def frontier(links: DataFrame, seen: DataFrame) -> DataFrame:
    """Linked pages not fetched yet, each once (fragments ignored)."""
    plain = lambda c: F.regexp_extract(c, "^([^#]*)", 1)
    todo = links.select(plain("url").alias("url")).distinct()
    return todo.join(seen.select(plain("url").alias("url")).distinct(), "url", "left_anti")


def pages_to_listings(pages: DataFrame, rules: Rules = SITE, scraped_at: Column | None = None) -> DataFrame:
    """Listing records of all detail pages; every page is read once."""
    raw = page_fields(pages.filter(is_detail("url", rules)), rules)
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return raw.select(
        url_id("url").alias("id"), price_in_millions("price_text").alias("price"), parse_price("installment_text").alias("installment"),
        "address", "description", "tags", "specs", "facilities", agent().alias("agent"), uploaded_images(rules=rules).alias("images"), "url",
        stamp(parse_id_date("modified_text")).alias("last_modified"),
        stamp(F.current_timestamp() if scraped_at is None else scraped_at).alias("scraped_at"),
    )
