"""Price model queries: trained on the derived listings of the whole order table."""

from pyspark.sql import functions as F

from ..operators import features, pricing
from .marts import fresh_path
from .registry import query, table
from .statistics import FEATURE_CTE, model_rows

def prepared(spark, d):
    """Model rows with their id; the price follows the areas, so there is something to learn."""
    f = features.derive_features(model_rows(spark, d).withColumn(
        "price", F.coalesce(F.col("luas_tanah") * 3e6 + F.col("luas_bangunan") * 4e6, F.lit(5e8)) + F.col("price") / 1e6))
    return features.select_features(f, keep=["id"])


def stored(spark, d):
    """The same, written once because training reads it many times."""
    path = fresh_path(spark)
    prepared(spark, d).write.parquet(path)
    return spark.read.parquet(path)


# what SQL can know of the model rows: ids, logged prices, test part and folds
PRICED = FEATURE_CTE + """, priced AS (SELECT id, subdistrict, ln(coalesce(luas_tanah * 3e6 + luas_bangunan * 4e6, 5e8) + price / 1e6) AS y,
  ('0x' || substr(md5('22-' || id), 1, 8))::BIGINT % 1000 < 330 AS test, ('0x' || substr(md5('21-' || id), 1, 8))::BIGINT % 5 AS fold FROM n)"""


@query("m05_fit_price_model", PRICED + " SELECT id, true AS priced FROM priced WHERE test")
def _(spark, d):
    train, test = features.split(stored(spark, d), "id")
    model = pricing.fit_price_model(train, skip=("id",))
    return pricing.predictions(model, test).select("id", F.exp("prediction").between(1e6, 1e11).alias("priced"))


@query("m06_cross_validate", PRICED + " SELECT fold::INT AS fold, count(*) AS n, true AS learned FROM priced WHERE y IS NOT NULL GROUP BY fold")
def _(spark, d):
    rows = stored(spark, d)
    sizes = rows.filter("price IS NOT NULL").groupBy(features.bucket_of("id", 21, 5).cast("int").alias("fold")).agg(F.count(F.lit(1)).alias("n"))
    return pricing.cross_validate(rows, "id").select("fold", (F.col("r2") > 0.5).alias("learned")).join(sizes, "fold")


@query("m07_search", PRICED + """
SELECT trial, count(*) AS n, round(sum(y), 3) AS actual, true AS scored FROM priced, (VALUES (0), (1)) t(trial) WHERE test AND y IS NOT NULL GROUP BY trial""")
def _(spark, d):
    train, test = features.split(stored(spark, d), "id")
    path = fresh_path(spark)
    pricing.search(train, "id", pricing.sample_params(2), table=path, holdout=test)
    runs = spark.read.parquet(path).select(F.col("trial").cast("int").alias("trial"), ((F.col("val_mse") > 0) & (F.col("test_mse") > 0)).alias("scored"))
    actual = test.filter("price IS NOT NULL").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 3).alias("actual"))
    return runs.join(actual)


@query("m07b_halving")
def _(spark, d):
    train, test = features.split(stored(spark, d), "id")
    return pricing.halving(train, "id", pricing.sample_params(20), fresh_path(spark), keep=4, holdout=test, parallelism=8)


@query("m09_evaluate", PRICED + " SELECT count(*) AS n, round(sum(y), 3) AS actual, true AS consistent, true AS learned FROM priced WHERE test AND y IS NOT NULL")
def _(spark, d):
    train, test = features.split(stored(spark, d), "id")
    metrics, residuals = pricing.evaluate(pricing.fit_price_model(train, skip=("id",)), test)
    gap = F.abs(F.col("residual") - (F.col("actual") - F.col("predicted")))
    sums = residuals.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("actual"), 3).alias("actual"), (F.max(gap) < 1e-9).alias("consistent"))
    return sums.join(metrics.select((F.col("r2") > 0.5).alias("learned")))


@query("m10_importances", FEATURE_CTE + " SELECT 14 AS n, 1.0::DOUBLE AS total, true AS none_negative, count(*) > 0 AS rows_used FROM n")
def _(spark, d):
    rows = stored(spark, d)
    found = pricing.importances(pricing.fit_price_model(rows, skip=("id",)))
    return found.agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.round(F.sum("importance"), 6).alias("total"), (F.min("importance") >= 0).alias("none_negative"),
        F.lit(rows.count() > 0).alias("rows_used"))


_SHADOWS: dict[tuple[str, str], str] = {}


def shadow_run(spark, d):
    """One run of the shadow features with default settings, stored for the session's two queries."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _SHADOWS:
        path = fresh_path(spark)
        rows = prepared(spark, d).withColumn("noise", F.conv(F.substring(F.md5("id"), 1, 6), 16, 10).cast("double"))
        rows.write.parquet(f"{path}/rows")
        pricing.boruta(spark.read.parquet(f"{path}/rows"), "id", parallelism=8).write.parquet(f"{path}/result")
        _SHADOWS[at] = path
    return spark.read.parquet(f"{_SHADOWS[at]}/result")


@query("m11_boruta", "SELECT unnest(['luas_tanah', 'luas_bangunan', 'noise']) AS feature, unnest([true, true, false]) AS accepted FROM (SELECT count(*) FROM orders)")
def _(spark, d):
    """The three features whose answer is known."""
    got = shadow_run(spark, d)
    return got.filter(F.col("feature").isin("luas_tanah", "luas_bangunan", "noise")).select("feature", (F.col("status") == "accept").alias("accepted"))


@query("m11b_boruta_all")
def _(spark, d):
    """Every feature with hits, trials and status."""
    return shadow_run(spark, d)


@query("m12_predict_prices", PRICED + """
SELECT l_orderkey, l_linenumber, 'NATION_' || l_partkey % 30 AS subdistrict, 'NATION_' || l_partkey % 30 IN (SELECT coalesce(subdistrict, '') FROM priced) AS accepted FROM lineitem""")
def _(spark, d):
    rows = stored(spark, d)
    model = pricing.fit_price_model(rows.select("id", "price", *pricing.SCORE_FEATURES), skip=("id",))
    path = fresh_path(spark)
    model.write().save(path)
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    requests = li.select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("NATION_"), F.col("l_partkey") % 30).alias("subdistrict"),
        (F.col("l_quantity") * 10).alias("land_area"), (F.col("l_extendedprice") / 500).alias("building_area"),
        F.lit(3).alias("num_bedrooms"), F.lit(2).alias("num_bathrooms"), (F.col("l_linenumber") % 3).alias("num_floors"),
        F.lit(0).alias("year_built"), F.lit(1300.0).alias("electricity_rate"))
    scored, rejected = pricing.predict_prices(pricing.PipelineModel.load(path), requests, rows)
    keys = [F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber"), "subdistrict"]
    return scored.select(*keys, (F.col("price_idr") > 0).alias("accepted")).unionByName(rejected.select(*keys, F.lit(False).alias("accepted")))
