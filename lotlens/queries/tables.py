"""Aggregates, joins, lists, windows and quality checks on the given tables."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import aggregates as agg
from ..operators import joins, quality
from .registry import query, table


# -- A: aggregation ----------------------------------------------------------

@query("a01_top_locations", """
SELECT n_name AS subdistrict, r_name AS city, count(*) AS listing_count, round(avg(o_totalprice), 4) AS average_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL ORDER BY listing_count DESC, subdistrict, city LIMIT 15""")
def _(spark, d):
    areas = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("area_sk"), F.col("n_name").alias("subdistrict"), F.col("r_name").alias("city"))
    # orders per customer first: a customer's orders cross the shuffle as one row
    per = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("listings"), F.sum("o_totalprice").alias("price_sum"), F.count("o_totalprice").alias("priced"))
    facts = per.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("c_nationkey", "area_sk")
    top = agg.top_locations(areas, facts, ["subdistrict", "city"])
    return top.withColumn("average_price", F.round("average_price", 4))


@query("a02_build_dim", """
SELECT DISTINCT md5(p_type) AS type_sk, upper(p_type[1]) || lower(p_type[2:]) AS type_name FROM part""")
def _(spark, d):
    return agg.build_dim(table(spark, d, "part"), "p_type", "type_sk", {"type_name": x.label("p_type")})


@query("a03_build_bridge", "SELECT l_orderkey AS house_id, md5(l_shipflag) AS flag_sk FROM (SELECT l_orderkey, l_returnflag || l_linestatus AS l_shipflag FROM lineitem)")
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("flag"))
    return agg.build_bridge(li, "l_orderkey", "flag", "flag_sk")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _event_pivot(fn: str, prefix: str) -> str:
    return "SELECT user_id, " + ", ".join(
        f"CAST({fn}(CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END) AS {'INT' if fn == 'max' else 'BIGINT'}) AS {prefix}{k}"
        for k in EVENT_TYPES
    ) + " FROM events GROUP BY user_id"


@query("a04_pivot_flags", _event_pivot("max", "type_"))
def _(spark, d):
    return agg.pivot_flags(table(spark, d, "events"), "user_id", "event_type", EVENT_TYPES, "type_")


@query("a05_pivot_counts", _event_pivot("sum", "type_"))
def _(spark, d):
    return agg.pivot_counts(table(spark, d, "events"), "user_id", "event_type", EVENT_TYPES, "type_")


@query("a06_crosstab_join", f"""
SELECT c_custkey, c_mktsegment, coalesce(ev_click, 0) AS ev_click, coalesce(ev_error, 0) AS ev_error,
coalesce(ev_purchase, 0) AS ev_purchase, coalesce(ev_signup, 0) AS ev_signup, coalesce(ev_view, 0) AS ev_view
FROM customer LEFT JOIN ({_event_pivot("sum", "ev_")}) ON c_custkey = user_id""")
def _(spark, d):
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return agg.crosstab_join(base, "c_custkey", table(spark, d, "events"), "user_id", "event_type", EVENT_TYPES, "ev_")


@query("a07_pivot_stats", """
SELECT l_returnflag, """ + ", ".join(
    f"round(coalesce(avg(l_extendedprice) FILTER (l_linestatus = '{s}'), 0), 4) AS mean_{s.lower()}, "
    f"round(coalesce(quantile_cont(l_extendedprice, 0.5) FILTER (l_linestatus = '{s}'), 0), 4) AS median_{s.lower()}, "
    f"count(l_extendedprice) FILTER (l_linestatus = '{s}') AS count_{s.lower()}" for s in "FO") + """
FROM lineitem GROUP BY l_returnflag""")
def _(spark, d):
    out = agg.pivot_stats(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice"), "l_returnflag", "l_linestatus", "l_extendedprice", ["F", "O"])
    return out.select(*[F.round(c, 4).alias(c) if c.startswith("me") else c for c in out.columns])


STATS_SQL = """round(avg(o_totalprice), 4) AS mean, round(quantile_cont(o_totalprice, 0.5), 4) AS median,
round(stddev_samp(o_totalprice), 4) AS std, count(o_totalprice) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max"""


def _rounded(df, names):
    return df.select(*[F.round(c, 4).alias(c) if c in names else c for c in df.columns])


@query("a08_group_stats", f"SELECT o_orderpriority, {STATS_SQL} FROM orders GROUP BY 1")
def _(spark, d):
    return _rounded(agg.group_stats(table(spark, d, "orders").select("o_orderpriority", "o_totalprice"), ["o_orderpriority"], "o_totalprice"), ["mean", "median", "std"])


@query("a08b_group_stats_two_keys", f"SELECT o_orderpriority, o_orderstatus, {STATS_SQL} FROM orders GROUP BY 1, 2")
def _(spark, d):
    out = agg.group_stats(table(spark, d, "orders").select("o_orderpriority", "o_orderstatus", "o_totalprice"), ["o_orderpriority", "o_orderstatus"], "o_totalprice")
    return _rounded(out, ["mean", "median", "std"])


@query("a09_value_counts", """
SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey ORDER BY count DESC, o_custkey LIMIT 10""")
def _(spark, d):
    return agg.value_counts(table(spark, d, "orders"), "o_custkey", 10)


@query("a10_flag_totals", """
SELECT 'is_click' AS flag, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS total FROM events
UNION ALL SELECT 'is_view', sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT FROM events
UNION ALL SELECT 'is_big', sum(CASE WHEN value > 10 THEN 1 ELSE 0 END)::BIGINT FROM events""")
def _(spark, d):
    e = table(spark, d, "events").select(
        x.bool_to_int(F.col("event_type") == "click").alias("is_click"),
        x.bool_to_int(F.col("event_type") == "view").alias("is_view"), x.bool_to_int(F.col("value") > 10).alias("is_big"))
    return agg.flag_totals(e, e.columns)


@query("a11_monthly_counts", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS total FROM orders
WHERE year(o_orderdate) = 1997 GROUP BY 1""")
def _(spark, d):
    out = agg.monthly_counts(table(spark, d, "orders"), "o_orderdate", 1997)
    return out.select(F.date_format("month", "yyyy-MM-dd").alias("month"), "total")


@query("a12_resample_month", """
SELECT strftime(m, '%Y-%m-%d') AS month, total, CAST(sum(total) OVER (ORDER BY m) AS BIGINT) AS cumulative FROM (
SELECT date_trunc('month', l_shipdate) AS m, count(*) AS total FROM lineitem GROUP BY 1) WHERE total > 1""")
def _(spark, d):
    out = agg.running_total(agg.resample_month(table(spark, d, "lineitem"), "l_shipdate"), "month", "total")
    return out.select(F.date_format("month", "yyyy-MM-dd").alias("month"), "total", "cumulative")


@query("a13_null_ratio", "WITH j AS (SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 6) AS missing FROM j"
    for c in ("doc_id", "lang", "n_chars", "quality", "toxic")))
def _(spark, d):
    j = table(spark, d, "documents").select("doc_id", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    out = agg.null_ratio(j)
    return out.select("column_name", F.round("missing", 6).alias("missing"))


@query("a14_five_numbers", """
SELECT o_orderstatus, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS q1,
round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.75), 4) AS q3, max(o_totalprice) AS max
FROM orders GROUP BY 1""")
def _(spark, d):
    return _rounded(agg.five_numbers(table(spark, d, "orders").select("o_orderstatus", "o_totalprice"), ["o_orderstatus"], "o_totalprice"), ["q1", "median", "q3"])


@query("a15_histogram", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
h AS (SELECT least(CAST(floor(50 * (o_totalprice - lo) / (hi - lo)) AS BIGINT), 49) AS bin, count(*) AS n FROM orders, b GROUP BY 1)
SELECT range AS bin, coalesce(n, 0) AS n FROM range(50) LEFT JOIN h ON range = bin""")
def _(spark, d):
    return agg.histogram(table(spark, d, "orders"), "o_totalprice", 50)


# -- D, U, O, W --------------------------------------------------------------

@query("d01_distinct_on_area", """
SELECT area, n_nationkey, n_name FROM (SELECT md5(CAST(n_regionkey AS VARCHAR)) AS area, n_nationkey, n_name,
row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey, n_name) AS r FROM nation) WHERE r = 1""")
def _(spark, d):
    n = table(spark, d, "nation").select(x.surrogate_key("n_regionkey").alias("area"), "n_nationkey", "n_name")
    return agg.distinct_on(n, ["area"])


@query("d02_distinct_on_all", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (
PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS r FROM lineitem) WHERE r = 1""")
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return agg.distinct_on(li, ["l_orderkey"], ["l_linenumber"])


@query("d03_distinct_pairs", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query("d04_available_values", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL")
def _(spark, d):
    return agg.available_values(table(spark, d, "part"), "p_brand")


@query("u01_union_all", """
SELECT s_name AS name, s_nationkey AS nationkey FROM supplier UNION ALL SELECT c_name, c_nationkey FROM customer""")
def _(spark, d):
    parts = [
        table(spark, d, t).select(F.col(f"{p}_name").alias("name"), F.col(f"{p}_nationkey").alias("nationkey"))
        for t, p in (("supplier", "s"), ("customer", "c"))
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("u02_union_distinct", """
(SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 3) UNION
(SELECT doc_id, n_chars FROM documents WHERE lang = 'en' ORDER BY n_chars DESC, doc_id LIMIT 3)""")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "lang")
    top = lambda df: df.orderBy(F.desc("n_chars"), "doc_id").limit(3).select("doc_id", "n_chars")
    return top(docs).union(top(docs.filter("lang = 'en'"))).distinct()


@query("o01_order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(15)


@query("w01_running_total", """
SELECT strftime(m, '%Y-%m-%d') AS month, total, CAST(sum(total) OVER (ORDER BY m) AS BIGINT) AS cumulative
FROM (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS total FROM orders GROUP BY 1)""")
def _(spark, d):
    out = agg.running_total(agg.monthly_counts(table(spark, d, "orders"), "o_orderdate"), "month", "total")
    return out.select(F.date_format("month", "yyyy-MM-dd").alias("month"), "total", "cumulative")


@query("w02_first_row_per_key", """
SELECT o_custkey, o_orderdate_text, o_orderkey, o_totalprice FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate_text,
o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1""")
def _(spark, d):
    o = table(spark, d, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate_text"), "o_orderkey", "o_totalprice")
    return agg.distinct_on(o, ["o_custkey"], ["o_orderdate_text", "o_orderkey"])


@query("w03_share_of_total", """
SELECT o_orderpriority, count, round(count / sum(count) OVER (), 6) AS share
FROM (SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1)""")
def _(spark, d):
    out = agg.share_of_total(agg.value_counts(table(spark, d, "orders"), "o_orderpriority"), "count", "share")
    return out.select("o_orderpriority", "count", F.round("share", 6).alias("share"))


# -- G: lists and generators -------------------------------------------------

@query("g01_unnest", "SELECT vec_id, round(CAST(unnest(embedding) AS DOUBLE), 6) AS v FROM embeddings")
def _(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.explode("embedding").alias("v"))
    return e.select("vec_id", F.round(F.col("v").cast("double"), 6).alias("v"))


@query("g02_unnest_split", """
SELECT p_partkey, unnest(string_split(replace(lower(t), ' ', '_'), '/')) AS tag
FROM (SELECT p_partkey, unnest([p_name || '/' || p_type, p_brand]) AS t FROM part)""")
def _(spark, d):
    t = F.array(F.concat("p_name", F.lit("/"), "p_type"), "p_brand")
    long = table(spark, d, "part").select("p_partkey", F.explode(t).alias("t"))
    return long.select("p_partkey", F.explode(F.split(x.clean_tag("t"), "/")).alias("tag"))


@query("g03_split_explode", """
SELECT doc_id, replace(trim(m), ' ', '_') AS piece FROM (SELECT doc_id, unnest(string_split(lower(text), ',')) AS m FROM documents)""")
def _(spark, d):
    m = table(spark, d, "documents").select("doc_id", F.explode(F.split(F.lower("text"), ",")).alias("m"))
    return m.select("doc_id", x.clean_material("m").alias("piece"))


@query("g04_lists_per_key", """
WITH p AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS s,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS r FROM orders)
SELECT o_custkey, r // 8 AS page, count(*) AS n, array_to_string(list(coalesce(s, '-') ORDER BY o_orderkey), '|') AS items
FROM p GROUP BY 1, 2""")
def _(spark, d):
    o = table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    out = agg.lists_per_key(o, "o_custkey", "s", ["o_orderkey"], page_rows=8)
    return out.select("o_custkey", "page", F.size("items").cast("long").alias("n"), F.array_join("items", "|", "-").alias("items"))


@query("g05_struct_pack", """
SELECT o_orderstatus, '{"high":' || sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) || ',"low":'
  || sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) || '}' AS packed FROM orders GROUP BY 1""")
def _(spark, d):
    wide = agg.pivot_counts(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority", ["2-HIGH", "5-LOW"])
    packed = F.struct(F.col("2-high").alias("high"), F.col("5-low").alias("low"))
    return wide.select("o_orderstatus", F.to_json(packed).alias("packed"))


# -- J: joins ----------------------------------------------------------------

@query("p16_corrected_name", """
SELECT c_custkey, coalesce(t.target, 'NATION_' || c_nationkey) AS place FROM customer
LEFT JOIN (SELECT n_name AS source, 'N' || n_nationkey AS target FROM nation WHERE n_regionkey <> 1) t ON 'NATION_' || c_nationkey = t.source""")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey")).alias("place"))
    n = table(spark, d, "nation").filter("n_regionkey <> 1").select("n_name", F.concat(F.lit("N"), F.col("n_nationkey")).alias("t"))
    return joins.lookup(c, n, "place", "n_name", "t", "place")


@query("j01_left_lookup_fanout", """
SELECT c_custkey, t.target FROM customer LEFT JOIN (SELECT n_nationkey AS source, n_name AS target FROM nation
UNION ALL SELECT n_nationkey, upper(n_name) || '_2' FROM nation WHERE n_regionkey = 2) t ON c_nationkey = t.source""")
def _(spark, d):
    n = table(spark, d, "nation")
    t = n.select("n_nationkey", F.col("n_name").alias("target")).unionByName(
        n.filter("n_regionkey = 2").select("n_nationkey", F.concat(F.upper("n_name"), F.lit("_2")).alias("target")))
    c = table(spark, d, "customer")
    return c.join(t, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "target")


@query("j02_inner_join", """
SELECT l_orderkey, l_linenumber, l_quantity, o_totalprice FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query("j06_semi_join", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 10)""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    top = agg.value_counts(o, "o_custkey", 10).select("o_custkey")
    return o.join(top, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("j07_with_partner", """
SELECT doc_id, lang, 'all' AS form FROM documents JOIN (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)
UNION ALL SELECT doc_id, lang, 'once' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def _(spark, d):
    docs, lab = table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels")
    images = lab.select("doc_id").unionAll(lab.filter("toxic = 1").select("doc_id"))
    every = joins.with_any(docs, "doc_id", images, "doc_id", keep_duplicates=True).withColumn("form", F.lit("all"))
    return every.unionByName(joins.with_any(docs, "doc_id", images, "doc_id").withColumn("form", F.lit("once")))


TREE_SQL = """t AS (SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN o_orderkey % 50 = 7 THEN CAST(o_orderkey + 20 AS VARCHAR) WHEN o_orderkey % 10 = 0 THEN NULL
       ELSE CAST(o_orderkey // 10 AS VARCHAR) END AS parent_id,
  repeat('x', CAST(o_orderkey % 97 AS INT)) AS content FROM orders)"""


@query("j08_related_documents", f"""
WITH RECURSIVE {TREE_SQL}, r AS (SELECT id FROM t WHERE id IN ('1', '27', '40', '47')
UNION SELECT t.id FROM t JOIN r ON r.id = t.parent_id)
SELECT id, length(content) AS n FROM t WHERE id IN (SELECT id FROM r) AND length(content) > 50""")
def _(spark, d):
    k = F.col("o_orderkey")
    t = table(spark, d, "orders").select(
        k.cast("string").alias("id"),
        F.when(k % 50 == 7, (k + 20).cast("string")).when(k % 10 == 0, F.lit(None)).otherwise(
            F.floor(k / 10).cast("string")).alias("parent_id"),
        F.repeat(F.lit("x"), (k % 97).cast("int")).alias("content"))
    ids = t.filter(F.col("id").isin("1", "27", "40", "47")).select("id")
    out = joins.related(t, ids).filter(F.length("content") > 50)
    return out.select("id", F.length("content").cast("long").alias("n"))


@query("j09_anti_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return o.join(li, "o_orderkey", "left_anti")


@query("j10_attribute_join", """
SELECT l_orderkey, l_linenumber, l_returnflag, o_orderstatus, o_totalprice FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'""")
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    o = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("o_orderkey")


@query("s05_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def _(spark, d):
    return table(spark, d, "orders").filter("o_totalprice > 400000").select("o_orderkey", "o_totalprice")


@query("s09_insert_if_absent", """
SELECT c_custkey, c_name FROM (SELECT c_custkey, c_name, row_number() OVER (PARTITION BY c_custkey ORDER BY c_name) AS r FROM
(SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, 'Again ' || c_name FROM customer WHERE c_custkey % 3 = 0)) b
WHERE r = 1 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def _(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    batch = c.unionByName(c.filter("c_custkey % 3 = 0").withColumn("c_name", F.concat(F.lit("Again "), "c_name")))
    have = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.new_rows(batch, have, ["c_custkey"])


# -- Q: quality --------------------------------------------------------------

NULLS = "CAST(NULL AS VARCHAR)"


@query("q01_not_null", f"""
SELECT * FROM (SELECT 'not_null' AS check_name, 'quality' AS column_name, {NULLS} AS value, count(*) FILTER (quality IS NULL) AS violations
FROM documents LEFT JOIN labels USING (doc_id) UNION ALL
SELECT 'not_null', 'lang', NULL, count(*) FILTER (lang IS NULL) FROM documents) WHERE violations > 0""")
def _(spark, d):
    j = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return quality.check_not_null(j, ["lang", "quality"])


@query("q02_unique", """
SELECT 'unique' AS check_name, 'o_custkey' AS column_name, CAST(o_custkey AS VARCHAR) AS value, count(*) AS violations
FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def _(spark, d):
    return quality.check_unique(table(spark, d, "orders"), "o_custkey")


@query("q03_relationships", """
SELECT 'relationships' AS check_name, 'l_orderkey' AS column_name, CAST(l_orderkey AS VARCHAR) AS value, count(*) AS violations
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""")
def _(spark, d):
    parents = table(spark, d, "orders").filter("o_orderstatus <> 'P'")
    return quality.check_fk(table(spark, d, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query("q04_accepted_values", """
SELECT 'accepted_values' AS check_name, 'o_orderpriority' AS column_name, o_orderpriority AS value, count(*) AS violations
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority""")
def _(spark, d):
    return quality.check_values(table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
