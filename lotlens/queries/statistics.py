"""Statistics and model rows."""

from statistics import NormalDist

from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import features, stats
from ..plans.derived import RAW_CTE, raw_listings
from ..plans import listings
from .registry import query, table


def r(df, digits, *keep):
    return df.select(*[
        F.round(c, digits).alias(c) if t in ("double", "float") and c not in keep else F.col(c) for c, t in df.dtypes
    ])


QUART = "SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem"
FLAG = "l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1)"


@query("t01_iqr_outliers", f"""
WITH q AS ({QUART}) SELECT count(*) AS total, count(*) FILTER ({FLAG}) AS outliers,
round(avg(CASE WHEN {FLAG} THEN 1 ELSE 0 END), 6) AS share FROM lineitem, q""")
def _(spark, d):
    return r(stats.outlier_share(stats.iqr_outliers(table(spark, d, "lineitem").select("l_extendedprice"), "l_extendedprice")), 6)


@query("t01b_outliers_removed", f"""
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q WHERE NOT (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))""")
def _(spark, d):
    return stats.without_outliers(table(spark, d, "events").select("event_id", "value"), "value")


@query("t02_cutoffs", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 40 AND l_extendedprice < 20000")
def _(spark, d):
    out = stats.cutoffs(table(spark, d, "lineitem"), {"l_quantity": 40, "l_extendedprice": 20000})
    return out.select("l_orderkey", "l_linenumber", "l_quantity")


@query("t03_impute", """
WITH j AS (SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN NULL ELSE lang END AS lang,
  CASE WHEN n_chars % 5 = 0 THEN NULL ELSE n_chars END AS n_chars, CASE WHEN n_chars % 4 = 0 THEN NULL ELSE CAST(n_chars AS DOUBLE) END AS size,
  quality FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, coalesce(lang, (SELECT lang FROM j WHERE lang IS NOT NULL GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)) AS lang,
round(coalesce(n_chars, (SELECT avg(n_chars) FROM j)), 4) AS n_chars, round(coalesce(size, (SELECT quantile_cont(size, 0.5) FROM j)), 4) AS size,
coalesce(quality, 0) AS quality FROM j""")
def _(spark, d):
    docs = table(spark, d, "documents")
    n = F.col("n_chars")
    j = docs.join(table(spark, d, "labels"), "doc_id", "left").select(
        "doc_id", F.when(n % 3 != 0, F.col("lang")).alias("lang"), F.when(n % 5 != 0, n).alias("n_chars"),
        F.when(n % 4 != 0, n.cast("double")).alias("size"), "quality", "toxic")
    rules = [
        {"col": "lang", "method": "mode"}, {"col": "n_chars", "method": "mean"}, {"col": "size", "method": "median"},
        {"col": "quality", "method": "constant", "value": 0},
    ]
    return r(stats.impute(j, rules, drop=["toxic"]), 4)


NUMERIC = ["l_quantity", "l_discount", "l_tax"]


@query("t04_pearson", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, 'pearson' AS method, round(corr({c}, l_extendedprice), 6) AS r, count(*) AS n FROM lineitem" for c in NUMERIC))
def _(spark, d):
    return r(stats.correlation_table(table(spark, d, "lineitem"), "l_extendedprice", NUMERIC), 6)


def _pvalue_sql(inner: str) -> str:
    """Adds the two-sided p-value: the density of Student's t, summed over a fine grid and normalised by its own sum."""
    part = lambda lo: f"(SELECT sum(CASE WHEN i IN (0, 20000) THEN 0.5 ELSE 1 END * (1 + pow({lo} + i * (12 - {lo}) / 20000, 2) / dof) ** (-(dof + 1) / 2)) * (12 - {lo}) / 20000 FROM range(20001) g(i))"
    return f"""WITH c AS ({inner}), s AS (SELECT *, least(12, abs(r) * sqrt((n - 2) / (1 - r * r)))::DOUBLE AS t, (n - 2)::DOUBLE AS dof FROM c)
SELECT * EXCLUDE (t, dof, r), round(r, 6) AS r, round({part('t')} / {part('0')}, 6) AS pvalue FROM s"""


def _corr_sql(columns: dict[str, str], method: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS variable, '{method}' AS method, count(*) AS n, corr({e}, l_extendedprice) AS r FROM lineitem" for n, e in columns.items())


@query("t04b_pearson_pvalue", _pvalue_sql(_corr_sql({c: c for c in NUMERIC}, "pearson")))
def _(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("price"), *NUMERIC)
    return r(stats.pearson_table(li), 6)


FLAGS = {"flag_returned": "l_returnflag = 'R'", "flag_open": "l_linestatus = 'O'"}


def _flags(spark, d):
    cols = [x.bool_to_int(F.expr(e)).alias(n) for n, e in FLAGS.items()]
    return table(spark, d, "lineitem").select(F.col("l_extendedprice").alias("price"), *cols)


@query("t05_pointbiserial", " UNION ALL ".join(
    f"SELECT '{n}' AS variable, 'pointbiser' AS method, round(corr(CASE WHEN {e} THEN 1.0 ELSE 0.0 END, l_extendedprice), 6) AS r, "
    "count(*) AS n FROM lineitem" for n, e in FLAGS.items()))
def _(spark, d):
    return r(stats.correlation_table(_flags(spark, d), "price", list(FLAGS), "pointbiser"), 6)


@query("t05b_pointbiserial_pvalue", _pvalue_sql(_corr_sql({n: f"CAST({e} AS INT)" for n, e in FLAGS.items()}, "pointbiser")))
def _(spark, d):
    return r(stats.pointbiserial_table(_flags(spark, d), "flag"), 6)


MATRIX = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("t06_corr_matrix", " UNION ALL ".join(
    f"SELECT '{b}' AS a, '{a}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(MATRIX) for b in MATRIX[i + 1:]))
def _(spark, d):
    return r(stats.corr_matrix(table(spark, d, "lineitem"), MATRIX), 6)


def _describe(c: str) -> str:
    q = ", ".join(f"round(quantile_cont(v, {p}), 4) AS {n}" for n, p in stats.DESCRIBED.items())
    return f"""SELECT '{c}' AS column_name, count(v) AS nobs, count(*) - count(v) AS missing, round(avg(v), 4) AS mean,
round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max,
round(avg((v - m) ** 3) / (avg((v - m) ** 2) ** 1.5), 4) AS skew, round(avg((v - m) ** 4) / (avg((v - m) ** 2) ** 2), 4) AS kurtosis,
{q}, (SELECT {c} FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode,
(SELECT count(*) FROM lineitem GROUP BY {c} ORDER BY 1 DESC LIMIT 1) AS mode_count,
round(stddev_samp(v) / sqrt(count(v)), 4) AS std_err,
round(avg(v) - 1.959963984540054 * stddev_samp(v) / sqrt(count(v)), 4) AS lower_ci,
round(avg(v) + 1.959963984540054 * stddev_samp(v) / sqrt(count(v)), 4) AS upper_ci,
round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 4) AS iqr, round(max(v) - min(v), 4) AS range
FROM (SELECT {c} AS v, avg({c}) OVER () AS m FROM lineitem)"""


@query("t07_describe", " UNION ALL ".join(_describe(c) for c in ("l_quantity", "l_extendedprice")))
def _(spark, d):
    out = stats.describe_table(table(spark, d, "lineitem").select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    return r(out, 4, "min", "max", "mode")


DIGITS = """SELECT CAST(substr(CAST(CAST(trunc(o_totalprice) AS HUGEINT) AS VARCHAR), 1, 1) AS INT) AS first_digit, count(*) AS count FROM orders GROUP BY 1"""


@query("t08_benford", f"""
SELECT first_digit, count, round(count / sum(count) OVER (), 6) AS real_proportion,
round(log10(1 + 1.0::DOUBLE / first_digit), 6) AS benford_proportion FROM ({DIGITS})""")
def _(spark, d):
    return r(stats.benford(table(spark, d, "orders").withColumn("p", F.floor("o_totalprice")), "p"), 6)


@query("t09_chisq_gof", f"""
WITH b AS (SELECT count, count / sum(count) OVER () AS o, log10(1 + 1.0::DOUBLE / first_digit) AS e, sum(count) OVER () AS n FROM ({DIGITS}))
SELECT form, round(statistic, digits) AS statistic, dof, round(exp(-x) * (1 + x + x ** 2 / 2 + x ** 3 / 6), 9) AS pvalue FROM (
  SELECT *, statistic / 2 AS x FROM (
    SELECT 'shares' AS form, 6 AS digits, sum((o - e) ** 2 / e) AS statistic, count(*) - 1 AS dof FROM b
    UNION ALL SELECT 'counts', 3, sum((count - e * n) ** 2 / (e * n)), count(*) - 1 FROM b))""")
def _(spark, d):
    b = stats.benford(table(spark, d, "orders").withColumn("p", F.floor("o_totalprice")), "p")
    n = b.select(F.sum("count").cast("double")).scalar()
    by_share = stats.chisq_gof(b, "real_proportion", "benford_proportion")
    by_count = stats.chisq_gof(b.withColumn("e", F.col("benford_proportion") * n), "count", "e")
    form = lambda df, name, digits: df.select(F.lit(name).alias("form"), F.round("statistic", digits).alias("statistic"), "dof", F.round("pvalue", 9).alias("pvalue"))
    return form(by_share, "shares", 6).unionByName(form(by_count, "counts", 3))


@query("t10_normality", """
WITH m AS (SELECT count(*)::DOUBLE AS n, avg((v - a) ** 3) / avg((v - a) ** 2) ** 1.5 AS g1, avg((v - a) ** 4) / avg((v - a) ** 2) ** 2 AS b2
  FROM (SELECT l_extendedprice AS v, avg(l_extendedprice) OVER () AS a FROM lineitem)),
s AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
  3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta2,
  (b2 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM m),
w AS (SELECT *, sqrt(2 * (beta2 - 1)) - 1 AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS a FROM s),
z AS (SELECT asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(w2) / 2) AS zs,
  (1 - 2 / (9 * a) - sign(1 + x * sqrt(2 / (a - 4))) * cbrt((1 - 2 / a) / abs(1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) AS zk FROM w)
SELECT round(zs * zs + zk * zk, 4) AS statistic, round(exp(-(zs * zs + zk * zk) / 2), 4) AS pvalue, exp(-(zs * zs + zk * zk) / 2) > 0.05 AS is_normal FROM z""")
def _(spark, d):
    return r(stats.normality_test(table(spark, d, "lineitem"), "l_extendedprice"), 4)


QQ = [i / 10 for i in range(1, 10)]


@query("t11_qq_points", " UNION ALL ".join(
    f"SELECT {p}::DOUBLE AS p, round({z}, 4) AS normal, round(quantile_cont(l_extendedprice, {p}), 4) AS observed, "
    f"round(avg(l_extendedprice) + {z} * stddev_samp(l_extendedprice), 4) AS fitted FROM lineitem"
    for p in QQ for z in [f"{NormalDist().inv_cdf(p)}::DOUBLE"]))
def _(spark, d):
    return r(stats.qq_points(table(spark, d, "lineitem").select("l_extendedprice"), "l_extendedprice", 9), 4, "p")


# -- M: model rows -----------------------------------------------------------

FEATURE_CTE = RAW_CTE + """, n AS (SELECT id, price * 1000000 AS price, string_split(address, ', ')[1] AS subdistrict, sumber_air,
  CAST(TRY_CAST(rtrim(luas_tanah, ' m²') AS FLOAT) AS DOUBLE) AS luas_tanah, CAST(TRY_CAST(rtrim(luas_bangunan, ' m²') AS FLOAT) AS DOUBLE) AS luas_bangunan,
  coalesce(CAST(TRY_CAST(rtrim(lebar_jalan, ' Mobil') AS FLOAT) AS DOUBLE), 0) AS lebar_jalan,
  CAST(TRY_CAST(replace(rtrim(lower(daya_listrik), 'watt'), 'lainnya', '0') AS FLOAT) AS DOUBLE) AS daya_listrik,
  coalesce(TRY_CAST(kamar_tidur AS INT), 1) AS kt, coalesce(TRY_CAST(kamar_mandi AS INT), 1) AS km, coalesce(TRY_CAST(kamar_pembantu AS INT), 0) AS kp,
  coalesce(TRY_CAST(kamar_mandi_pembantu AS INT), 0) AS kmp, coalesce(TRY_CAST(jumlah_lantai AS INT), 1) AS jl,
  coalesce(TRY_CAST(garasi AS INT), 0) AS g, coalesce(TRY_CAST(carport AS INT), 0) AS c, coalesce(TRY_CAST(tahun_dibangun AS INT), 0) AS tb,
  coalesce(TRY_CAST(tahun_di_renovasi AS INT), 0) AS tr FROM raw WHERE price IS NOT NULL)"""


def model_rows(spark, d):
    raw = raw_listings(spark, d)
    none = spark.createDataFrame([], "source string, target string")
    counts = spark.createDataFrame([], "subdistrict string, amenities struct<other:bigint>")
    return listings.wide_listings(listings.staged(raw), none, counts)


@query("m01_log_price", RAW_CTE + " SELECT id, round(ln(price), 6) AS log_price, round(exp(ln(price)), 4) AS price FROM raw WHERE price IS NOT NULL")
def _(spark, d):
    p = raw_listings(spark, d).filter("price IS NOT NULL").select("id", F.log("price").alias("log_price"))
    return p.select("id", F.round("log_price", 6).alias("log_price"), F.round(F.exp("log_price"), 4).alias("price"))


@query("m02_derive_features", FEATURE_CTE + """
SELECT id, round(ln(price), 6) AS price, kt + kp AS total_beds, km + kmp AS total_baths, round(luas_tanah / nullif(luas_bangunan, 0), 6) AS land_building_ratio,
round(kt / nullif(km, 0), 6) AS bed_bath_ratio, round((kt + kp) / nullif(km + kmp, 0), 6) AS total_bed_bath_ratio, tr - tb AS rennovated_built_diff,
round(luas_bangunan / nullif(jl, 0), 6) AS building_area_floor_ratio, round((g + c) / nullif(lebar_jalan, 0), 6) AS vehicle_accessibility FROM n""")
def _(spark, d):
    f = features.derive_features(model_rows(spark, d))
    return r(f.select(
        "id", "price", "total_beds", "total_baths", "land_building_ratio", "bed_bath_ratio", "total_bed_bath_ratio",
        "rennovated_built_diff", "building_area_floor_ratio", "vehicle_accessibility"), 6)


@query("m03_select_features", FEATURE_CTE + """
SELECT id, round(ln(price), 6) AS price, coalesce(subdistrict, '') AS subdistrict, km AS kamar_mandi, kp AS kamar_pembantu, luas_tanah, luas_bangunan,
jl AS jumlah_lantai, tb AS tahun_dibangun, daya_listrik, coalesce(sumber_air, '') AS sumber_air, round(luas_tanah / nullif(luas_bangunan, 0), 6) AS land_building_ratio,
kt + kp AS total_beds, km + kmp AS total_baths, round(luas_bangunan / nullif(jl, 0), 6) AS building_area_floor_ratio,
round((g + c) / nullif(lebar_jalan, 0), 6) AS vehicle_accessibility FROM n""")
def _(spark, d):
    out = features.select_features(features.derive_features(model_rows(spark, d)), keep=["id"])
    floats = ["luas_tanah", "luas_bangunan", "daya_listrik"]
    return r(out.withColumns({c: F.col(c).cast("double") for c in floats}), 6, *floats)


@query("m04_split", """
WITH s AS (SELECT o_orderkey, ('0x' || substr(md5('22-' || o_orderkey), 1, 8))::BIGINT % 1000 < 330 AS t FROM orders)
SELECT 'train' AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM s WHERE NOT t UNION ALL
SELECT 'test', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM s WHERE t""")
def _(spark, d):
    train, test = features.split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    size = lambda df, n: df.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit(n).alias("part"), "n", "keys")
    return size(train, "train").unionByName(size(test, "test"))


@query("m08_metrics", """
WITH p AS (SELECT l_extendedprice AS y, 1500 * l_quantity + 100 AS p FROM lineitem)
SELECT round(avg(p), 4) AS mean, round(stddev_pop(p), 4) AS std, round(var_pop(p), 0) AS var, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2,
round(avg((y - p) ** 2), 2) AS mse, round(avg(abs(y - p)), 4) AS mae, round(avg(abs(y - p) / abs(y)), 6) AS mape,
round(avg(abs(y - p) / ((abs(y) + abs(p)) / 2)), 6) AS smape FROM p""")
def _(spark, d):
    p = table(spark, d, "lineitem").select(
        F.col("l_extendedprice").alias("price"), (F.col("l_quantity") * 1500 + 100).alias("prediction"))
    m = features.regression_metrics(p)
    digits = {"mean": 4, "std": 4, "var": 0, "r2": 6, "mse": 2, "mae": 4, "mape": 6, "smape": 6}
    return m.select(*[F.round(c, n).alias(c) for c, n in digits.items()])
