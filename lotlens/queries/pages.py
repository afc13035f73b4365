"""Page extraction, on the given pages and on listing pages derived from orders."""

from pyspark.sql import functions as F

from ..functions import vocab as v
from ..operators import extract
from ..plans.derived import PAGE_CTE, listing_pages, page_fields
from .registry import query, table

# layout of the given pages
GIVEN = extract.SITE.but(
    detail_has="/en", detail_not=",", description_word="<b>",
    address=r"(?s)<h1(?:\s[^>]*)?>.*?</h1>.*?<p(?:\s[^>]*)?>(?:<[a-oq-z][^>]*>)*([^<]*)",
    item=r"<li(?:\s[^>]*)?>(?:<[a-km-z][^>]*>)*([^<]+)<",
)
PRICE = "CAST(replace(nullif(regexp_extract({0}, '[0-9]*[.,]?[0-9]+'), ''), ',', '.') AS DOUBLE)"
PRICE_SQL = (
    f"CASE WHEN price_text LIKE '%Miliar%' THEN {PRICE.format('price_text')} * 1000 WHEN price_text LIKE '%Juta%' THEN {PRICE.format('price_text')} END"
)
DATE_SQL = f"""strftime(TRY_CAST(regexp_extract(date_text, '[0-9]{{4}}') || '-' || CAST(nullif(list_position(
{v.MONTH_NAMES},
regexp_extract(date_text, '[0-9]{{1,2}} (\\w+) [0-9]{{4}}', 1)), 0) AS VARCHAR) || '-' || regexp_extract(date_text, '([0-9]{{1,2}}) ', 1) AS DATE), '%Y-%m-%d')"""


@query("h01_is_detail", "SELECT page_id FROM pages WHERE contains(url, '/en/') AND NOT contains(url, 'utm_source')")
def _(spark, d):
    rules = extract.SITE.but(detail_has="/en/", detail_not="utm_source")
    return table(spark, d, "pages").filter(extract.is_detail("url", rules)).select("page_id")


LINKS = r"""link AS (SELECT url AS page_url, unnest(regexp_extract_all(html, '<a\s[^>]*?href=["'']([^"'']*)["'']', 1)) AS href FROM pages),
detail AS (SELECT page_url, href, regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) || href AS url FROM link WHERE contains(href, '/en') AND NOT contains(href, ','))"""


@query("h02_extract_links", f"WITH {LINKS} SELECT page_url, href, url FROM detail")
def _(spark, d):
    return extract.extract_links(table(spark, d, "pages").select("url", "html"), GIVEN)


@query("h02b_frontier", f"WITH {LINKS} SELECT DISTINCT url FROM detail WHERE url NOT IN (SELECT regexp_replace(url, '#.*', '') FROM pages)")
def _(spark, d):
    pages = table(spark, d, "pages")
    return extract.frontier(extract.extract_links(pages, GIVEN), pages)


@query("h02c_links_with_dots", PAGE_CTE + """
SELECT url AS page_url, unnest(['/properti/bogor/hos1/', '../../../properti/depok/hos2/?a=../b']) AS href,
unnest(['https://www.example.com/properti/bogor/hos1/', 'https://www.example.com/properti/depok/hos2/?a=../b']) AS url FROM page""")
def _(spark, d):
    return extract.extract_links(listing_pages(spark, d))


@query("h03_url_id", "SELECT page_id, regexp_extract(url, '([^/]+)/*$', 1) AS id FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", extract.url_id("url").alias("id"))


@query("h04_parse_price", PAGE_CTE + f" SELECT url, {PRICE.format('price_text')} AS price, {PRICE.format('address')} AS area_no FROM page")
def _(spark, d):
    return page_fields(spark, d).select(
        "url", extract.parse_price("price_text").alias("price"), extract.parse_price("address").alias("area_no"))


@query("h05_extract_price", PAGE_CTE + f" SELECT url, {PRICE_SQL} AS price FROM page")
def _(spark, d):
    return extract.page_fields(listing_pages(spark, d), only=["price_text"]).select("url", extract.price_in_millions("price_text").alias("price"))


@query("h06_extract_installment", PAGE_CTE + f" SELECT url, {PRICE.format('installment_text')} AS installment FROM page")
def _(spark, d):
    return extract.page_fields(listing_pages(spark, d), only=["installment_text"]).select("url", extract.parse_price("installment_text").alias("installment"))


UNESC = "replace(replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"


@query("h07_extract_address", "SELECT page_id, " + UNESC.format(
    r"regexp_extract(html, '(?s)<h1(?:\s[^>]*)?>.*?</h1>.*?<p(?:\s[^>]*)?>(?:<[a-oq-z][^>]*>)*([^<]*)', 1)").join(["nullif(", ", '')"]) + " AS address FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", "html").select("page_id", extract.flat_address("html", GIVEN).alias("address"))


@query("h07b_nested_address", PAGE_CTE + " SELECT url, address FROM page")
def _(spark, d):
    return extract.page_fields(listing_pages(spark, d), only=["address"]).select("url", "address")


@query("h08_parse_date", PAGE_CTE + f" SELECT url, {DATE_SQL} AS modified FROM page")
def _(spark, d):
    return extract.page_fields(listing_pages(spark, d), only=["modified_text"]).select("url", F.date_format(extract.parse_id_date("modified_text"), "yyyy-MM-dd").alias("modified"))


@query("h09_extract_list", r"""
WITH i AS (SELECT page_id, regexp_extract_all(html, '<li(?:\s[^>]*)?>(?:<[a-km-z][^>]*>)*([^<]+)<', 1) AS t FROM pages)
SELECT page_id, unnest(range(len(t))) AS pos, trim(unnest(t), chr(32) || chr(9) || chr(10) || chr(13)) AS item FROM i""")
def _(spark, d):
    items = table(spark, d, "pages").select("page_id", "html").select("page_id", F.posexplode(extract.flat_items("html", GIVEN)).alias("pos", "item"))
    return items.select("page_id", F.col("pos").cast("long").alias("pos"), "item")


@query("h09b_nested_lists", PAGE_CTE + """
SELECT url, 'tag' AS list, unnest([0, 1]) AS pos, unnest([tag_a, tag_b]) AS item FROM page
UNION ALL SELECT url, 'facility', unnest([0, 1]), unnest([facility, 'Wi-Fi & TV']) FROM page""")
def _(spark, d):
    raw = extract.page_fields(listing_pages(spark, d), only=["tags", "facilities"])
    both = F.explode(F.map_from_arrays(F.array(F.lit("tag"), F.lit("facility")), F.array("tags", "facilities"))).alias("list", "items")
    return raw.select("url", both).select("url", "list", F.posexplode("items").alias("pos", "item"))


@query("h10_extract_description", """
WITH p AS (SELECT page_id, list_transform(regexp_extract_all(replace(html, '<p>', '</p><p>'), '(?s)<p>(.*?)</p>', 1), lambda x: x) AS parts FROM pages)
SELECT page_id, """ + UNESC.format("nullif(regexp_extract(parts[list_position(list_transform(parts, lambda x: contains(x, '<b>')), true) + 1], '^([^<]*)', 1), '')")
+ """ AS description FROM p""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", "html").select("page_id", extract.flat_description(extract.flat_paragraphs("html"), GIVEN).alias("description"))


@query("h10b_nested_description", PAGE_CTE + " SELECT url, description FROM page")
def _(spark, d):
    return extract.page_fields(listing_pages(spark, d), only=["description"]).select("url", "description")


@query("h11_extract_specs", PAGE_CTE + " SELECT url, land, beds, 2 AS n FROM page")
def _(spark, d):
    s = extract.page_fields(listing_pages(spark, d), only=["specs"]).select("url", F.col("specs").alias("s"))
    return s.select("url", F.col("s")["Luas Tanah"].alias("land"), F.col("s")["Kamar Tidur"].alias("beds"), F.size("s").alias("n"))


@query("h12_extract_agent", PAGE_CTE + """
SELECT url, agent_name, CASE WHEN agent_name IS NOT NULL THEN 'https://www.example.com/agen/1' END AS agent_url, phone, company_name,
CASE WHEN company_name IS NOT NULL THEN 'https://firm.example.com/x' END AS company_url FROM page""")
def _(spark, d):
    a = extract.page_fields(listing_pages(spark, d), only=extract.AGENT_NAMES).select("url", extract.agent().alias("a"))
    return a.select(
        "url", F.col("a.name").alias("agent_name"), F.col("a.url").alias("agent_url"), "a.phone",
        F.col("a.company.name").alias("company_name"), F.col("a.company.url").alias("company_url"))


@query("h13_extract_images", PAGE_CTE + " SELECT url, image, 1 AS n FROM page")
def _(spark, d):
    i = extract.page_fields(listing_pages(spark, d), only=["image_sets"]).select("url", extract.uploaded_images().alias("i"))
    return i.select("url", F.get("i", F.lit(0)).alias("image"), F.size("i").alias("n"))


@query("h14_pages_to_listings", PAGE_CTE + f"""
SELECT 'hos' || o_orderkey AS id, {PRICE_SQL} AS price, {PRICE.format('installment_text')} AS installment, address, description,
tag_a || '|' || tag_b AS tags, land, beds, facility || '|Wi-Fi & TV' AS facilities, agent_name, company_name, phone, image, url,
{DATE_SQL} || 'T00:00:00' AS last_modified FROM page""")
def _(spark, d):
    got = extract.pages_to_listings(listing_pages(spark, d))
    return got.select(
        "id", "price", "installment", "address", "description", F.array_join("tags", "|").alias("tags"),
        F.col("specs")["Luas Tanah"].alias("land"), F.col("specs")["Kamar Tidur"].alias("beds"),
        F.array_join("facilities", "|").alias("facilities"), F.col("agent.name").alias("agent_name"),
        F.col("agent.company.name").alias("company_name"), "agent.phone", F.array_join("images", "|").alias("image"), "url", "last_modified")


@query("h15_image_path", PAGE_CTE + " SELECT url, 'hos' || o_orderkey || '/front ' || o_orderkey || '.jpg' AS path FROM page")
def _(spark, d):
    img = F.concat(F.lit("https://img.example.com/customer/x/front%20"), F.col("o_orderkey"), F.lit(".jpg?w=640#a"))
    return page_fields(spark, d).select(
        "url", extract.image_path(F.concat(F.lit("hos"), F.col("o_orderkey")), img).alias("path"))
