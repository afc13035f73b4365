"""Boosted trees on bins: Spark's trees, whether the rows are in one task or in many."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from lotlens.operators import boosting, pricing


def rows_of(n, areas, seed=9):
    rng = np.random.default_rng(seed)
    for i in range(n):
        land, noise = float(rng.uniform(50, 500)), float(rng.normal())
        yield f"hos{i}", float(np.log(1e6 * land * (1 + i % areas % 7)) + 0.1 * noise), f"area{i % areas}", land, None if i % 10 == 0 else noise


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(rows_of(600, 7)), "id string, price double, subdistrict string, luas_tanah double, noise double").repartition(3).cache()


def predicted(model, ready):
    return np.array([r[0] for r in model.transform(ready).orderBy("id").select("prediction").collect()])


@pytest.mark.parametrize("apart, room", [(False, 0), (True, 64 << 20), (True, 1 << 13)])
def test_trees_are_those_of_spark(spark, rows, apart, room, monkeypatch, tmp_path):
    ready, stages = pricing.encoded(rows, "price", ("id",))
    params = {"maxIter": 3, "maxDepth": 4, "minInstancesPerNode": 15, "stepSize": 0.3, "seed": 22, "maxBins": 64}
    if apart:
        monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
        monkeypatch.setattr(boosting, "BLOCK_ROWS", 50)
        monkeypatch.setattr(boosting, "SUM_BYTES", room)  # sums added up by the driver, or in several tasks before
    got = pricing.regressor(stages, "price", **params).fit(ready)
    want = GBTRegressor(featuresCol="features", labelCol="price", **params).fit(ready)
    assert np.allclose(predicted(got, ready), predicted(want, ready), rtol=0, atol=1e-9)
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-9)
    assert [t.numNodes for t in got.trees] == [t.numNodes for t in want.trees] and got.treeWeights == want.treeWeights
    PipelineModel([*stages.stages, got]).write().save(str(tmp_path / "m"))
    assert np.array_equal(predicted(PipelineModel.load(str(tmp_path / "m")).stages[-1], ready), predicted(got, ready))


def test_more_bins_than_a_byte(spark):
    many = spark.createDataFrame(list(rows_of(900, 300)), "id string, price double, subdistrict string, luas_tanah double, noise double")
    ready, stages = pricing.encoded(many.repartition(2), "price", ("id",))
    params = {"maxIter": 2, "maxDepth": 3, "minInstancesPerNode": 10, "seed": 22, "maxBins": 400}
    est = pricing.regressor(stages, "price", **params)
    assert est.bins(ready, 900).kind == "uint16"
    want = predicted(GBTRegressor(featuresCol="features", labelCol="price", **params).fit(ready), ready)
    assert np.allclose(predicted(est.fit(ready), ready), want, atol=1e-9)
    with pytest.raises(ValueError, match="maxBins"):
        pricing.regressor(stages, "price", **params | {"maxBins": 100}).fit(ready)


def test_a_share_of_the_rows(spark, rows):
    ready, stages = pricing.encoded(rows, "price", ("id",))
    params = {"maxIter": 3, "maxDepth": 3, "minInstancesPerNode": 10, "stepSize": 0.3, "seed": 22, "maxBins": 64, "subsamplingRate": 0.5}
    got = pricing.regressor(stages, "price", **params).fit(ready)
    want = GBTRegressor(featuresCol="features", labelCol="price", **params).fit(ready)
    a, b = predicted(got, ready), predicted(want, ready)
    y = np.array([r[0] for r in ready.orderBy("id").select("price").collect()])
    assert abs(np.mean((a - y) ** 2) / np.mean((b - y) ** 2) - 1) < 0.25
    # about half of the rows, others for each tree
    roots = [t._call_java("rootNode").impurityStats().count() for t in got.trees]
    assert all(240 < n < 360 for n in roots) and len(set(roots)) > 1


def test_equal_targets_and_no_rows(spark, rows):
    ready, stages = pricing.encoded(rows.withColumn("price", F.lit(21.7)), "price", ("id",))
    model = pricing.regressor(stages, "price", maxIter=2).fit(ready)
    assert set(np.round(predicted(model, ready), 9)) == {21.7} and model.trees[0].numNodes == 1
    with pytest.raises(ValueError, match="no rows"):
        pricing.regressor(stages, "price").fit(ready.limit(0))


def test_a_shadow_trial_is_one_task_and_not_spark_training(spark, rows, monkeypatch):
    real, done = boosting.grown, []
    monkeypatch.setattr(boosting, "grown", lambda *a: done.append(a[-1]) or real(*a))
    monkeypatch.setattr(GBTRegressor, "_fit", lambda *a: pytest.fail("trained by Spark"))
    known = rows.withColumn("price", F.when(F.col("id") != "hos3", F.col("price")))
    got = {r.feature: r for r in pricing.boruta(known, "id", trials=3, maxIter=2, maxDepth=3, parallelism=3).collect()}
    assert done == [600] * 3 and got["luas_tanah"].hits == 3
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
    apart = {r.feature: r for r in pricing.boruta(known, "id", trials=3, maxIter=2, maxDepth=3, parallelism=3).collect()}
    assert apart == got


def test_other_losses_are_trained_by_spark(spark, rows):
    ready, stages = pricing.encoded(rows, "price", ("id",))
    est = pricing.regressor(stages, "price", maxIter=2, maxDepth=2, lossType="absolute")
    assert est.settings() is None and len(predicted(est.fit(ready), ready)) == 600
    got = pricing.boruta(rows, "id", trials=1, maxIter=1, maxDepth=2, lossType="absolute")
    assert got.count() == 3
