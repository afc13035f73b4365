"""Price model on Spark ML: training, validation, search, feature selection, scoring."""

from __future__ import annotations

import math
import random
import sys
from collections.abc import Callable
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from . import boosting
from .aggregates import positions
from .features import bucket_of, regression_metrics

cloudpickle.register_pickle_by_value(sys.modules[__name__])

METRICS = ["mean", "std", "var", "r2", "mse", "mae", "mape", "smape"]
TEXT = ("string",)
MISSING = -1.0e9
#: Rows that one task of a shadow-feature trial trains on, about.
TASK_ROWS = 200_000

# inputs of the scoring request and the features made of them
REQUEST_COLUMNS = [
    "subdistrict", "land_area", "building_area", "num_bedrooms", "num_bathrooms", "num_floors", "year_built", "electricity_rate",
]
SCORE_FEATURES = [
    "subdistrict", "luas_tanah", "luas_bangunan", "jumlah_lantai", "tahun_dibangun", "daya_listrik",
    "land_building_ratio", "total_beds", "total_baths", "building_area_floor_ratio",
]


def columns_of(df: DataFrame, target: str = "price", skip: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """Categorical and numeric feature columns of a frame of model rows."""
    names = [f for f in df.schema if f.name != target and f.name not in skip]
    cats = [f.name for f in names if f.dataType.typeName() in TEXT]
    return cats, [f.name for f in names if f.name not in cats]


def feature_stages(df: DataFrame, target: str = "price", skip: tuple[str, ...] = ()) -> list:
    """Indexed categories and numbers in one vector."""
    cats, nums = columns_of(df, target, skip)
    return [
        StringIndexer(inputCols=cats, outputCols=[f"{c}_ix" for c in cats], handleInvalid="keep", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=[*[f"{c}_ix" for c in cats], *nums], outputCol="features", handleInvalid="keep"),
    ]


def regressor(stages: PipelineModel, target: str = "price", **params) -> boosting.BinnedGBTRegressor:
    """Gradient-boosted trees over the vectors of fitted stages."""
    # trees need a bin per category, plus one for unknown ones
    most = max([len(labels) for labels in stages.stages[0].labelsArray], default=0)
    params = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "seed": 22, "maxBins": max(256, most + 2)} | params
    return boosting.BinnedGBTRegressor(featuresCol="features", labelCol=target, **params)


def _numbers(df: DataFrame, target: str) -> DataFrame:
    """Numbers as doubles; a missing one sorts below all others, so trees can split it off."""
    kinds = ("integer", "long", "short", "float", "double", "decimal")
    names = [f.name for f in df.schema if f.dataType.typeName() in kinds and f.name != target]
    return df.withColumns({n: F.coalesce(F.nanvl(F.col(n).cast("double"), F.lit(MISSING)), F.lit(MISSING)) for n in names})


def encoded(df: DataFrame, target: str = "price", skip: tuple[str, ...] = ()) -> tuple[DataFrame, PipelineModel]:
    """The rows with their vector (`features`), and the stages that make it."""
    rows = _numbers(df, target)
    stages = Pipeline(stages=feature_stages(rows, target, skip)).fit(rows)
    return stages.transform(rows), stages


def search_rows(
    df: DataFrame, key: str, k: int = 5, seed: int = 21, target: str = "price", shares: tuple[int, ...] = (1,)
) -> tuple[DataFrame, PipelineModel]:
    """Target, vector and fold of the rows that have a target, stored for all fits of a search, and the stages that made them.

    Categories are indexed over all these rows; one that a fit does not meet is an empty bin to its trees. `shares` are divisors, the
    last 1, each dividing the one before: `share` is the place of the first that holds the row and a folder, so a fit on a share
    (`share` up to its place) reads no other rows.
    """
    ready, stages = encoded(df.filter(F.col(target).isNotNull()), target, (key,))
    first = F.coalesce(*[F.when(bucket_of(key, 5, p) == 0, i) for i, p in enumerate(shares[:-1])], F.lit(len(shares) - 1))
    rows = ready.select(target, "features", bucket_of(key, seed, k).cast("int").alias("fold"), first.alias("share"))
    return written(rows, "share"), stages


def fit_price_model(
    train: DataFrame, target: str = "price", skip: tuple[str, ...] = (), stages: PipelineModel | None = None, **params
) -> PipelineModel:
    """Model of the rows; with `stages` these are rows of `search_rows`, encoded already."""
    rows = train
    if stages is None:
        rows, stages = encoded(train.filter(F.col(target).isNotNull()), target, skip)
    return PipelineModel([*stages.stages, regressor(stages, target, **params).fit(rows.select(target, "features"))])


def predictions(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with their prediction; those of `search_rows` need the trees only."""
    if "features" in df.columns:
        return model.stages[-1].transform(df)
    return model.transform(_numbers(df, model.stages[-1].getLabelCol()))


def evaluate(model: PipelineModel, test: DataFrame, target: str = "price") -> tuple[DataFrame, DataFrame]:
    """Metrics row, and rows (actual, predicted, residual)."""
    p = predictions(model, test).filter(F.col(target).isNotNull())
    residuals = p.select(
        F.col(target).alias("actual"), F.col("prediction").alias("predicted"), (F.col(target) - F.col("prediction")).alias("residual")
    )
    return regression_metrics(p, target), residuals


def cross_validate(
    df: DataFrame, key: str, k: int = 5, seed: int = 21, target: str = "price", parallelism: int = 2,
    stages: PipelineModel | None = None, **params
) -> DataFrame:
    """Metrics of each fold (column fold); a row's fold follows from its key. With `stages` df are rows of `search_rows`."""
    rows = df
    if stages is None:
        rows, stages = search_rows(df, key, k, seed, target)

    def one(i: int) -> DataFrame:
        model = fit_price_model(rows.filter(F.col("fold") != i), target, stages=stages, **params)
        return evaluate(model, rows.filter(F.col("fold") == i), target)[0].withColumn("fold", F.lit(i))

    with ThreadPool(parallelism) as pool:
        return reduce(DataFrame.unionByName, pool.map(one, range(k)))


def mean_metrics(folds: DataFrame) -> DataFrame:
    return folds.agg(*[F.avg(m).alias(m) for m in METRICS])


def sample_params(n: int, seed: int = 22) -> list[dict]:
    """Random settings inside the ranges that are searched."""
    rng = np.random.default_rng(seed)
    return [
        {
            "maxDepth": int(rng.integers(3, 7)), "stepSize": round(float(np.exp(rng.uniform(np.log(0.01), np.log(0.3)))), 4),
            "maxIter": int(rng.integers(5, 21)), "minInstancesPerNode": int(rng.integers(10, 51)),
            "subsamplingRate": round(float(rng.uniform(0.5, 1)), 3),
        }
        for _ in range(n)
    ]


def search(
    df: DataFrame, key: str, trials: list[dict], k: int = 5, target: str = "price", table: str | None = None,
    holdout: DataFrame | None = None, parallelism: int = 2,
) -> DataFrame:
    """Settings with their mean validation metrics (and metrics on `holdout`), best first; appended to `table` when given.

    Rows are encoded once for all fits; `parallelism` settings run at a time, their folds one after another.
    """
    spark = df.sparkSession
    ready, stages = search_rows(df, key, k, target=target)

    def run(i: int) -> dict:
        params = trials[i]
        val = mean_metrics(cross_validate(ready, key, k, target=target, parallelism=1, stages=stages, **params)).first().asDict()
        row = {"trial": i, "params": str(params)} | {f"val_{m}": val[m] for m in METRICS}
        if holdout is not None:
            model = fit_price_model(ready, target, stages=stages, **params)
            row |= {f"test_{m}": x for m, x in evaluate(model, holdout, target)[0].first().asDict().items()}
        return row

    with ThreadPool(parallelism) as pool:
        rows = pool.map(run, range(len(trials)), 1)
    out = spark.createDataFrame(pd.DataFrame(rows)).orderBy("val_mse", "trial")
    if table is not None:
        out.write.mode("append").parquet(table)
    return out


RUN = "rung int, trial int, params string, share double, " + ", ".join(f"val_{m} double" for m in METRICS)


def halving(
    df: DataFrame, key: str, trials: list[dict], table: str, rungs: int = 3, keep: int = 3, k: int = 5, target: str = "price",
    holdout: DataFrame | None = None, parallelism: int = 4,
) -> DataFrame:
    """Successive halving: all settings on a share of the rows, the best of each rung on `keep` times as many, the last on all.

    Early rungs validate on one fold, the last cross-validates. Shares follow from the key, so a rung's rows hold those
    of the rung before. Rows are encoded once, and a rung reads its own only. Every finished run is a row under `table`, in a folder of its own; a search that stopped goes on from there. Gives the run
    table in order (rung descending, then error), with `place` and `winner`, and the winner's metrics on `holdout`.
    """
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/runs")
    there = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)
    stored = spark.read.schema(RUN).parquet(f"{table}/runs").drop("run").collect() if there else []  # a row per run
    done = {(r["rung"], r["trial"]): r.asDict() for r in stored}
    alive = list(range(len(trials)))
    shares = tuple(keep ** (rungs - 1 - rung) for rung in range(rungs))
    ready, stages = search_rows(df, key, k, target=target, shares=shares)
    for rung, parts in enumerate(shares):
        rows = ready.filter(F.col("share") <= rung)

        def run(trial: int) -> None:
            params = trials[trial]
            if parts == 1:
                val = mean_metrics(cross_validate(rows, key, k, target=target, parallelism=1, stages=stages, **params)).first().asDict()
            else:
                model = fit_price_model(rows.filter("fold <> 0"), target, stages=stages, **params)
                val = evaluate(model, rows.filter("fold = 0"), target)[0].first().asDict()
            row = {"rung": rung, "trial": trial, "params": str(params), "share": 1 / parts} | {f"val_{m}": float(val[m]) for m in METRICS}
            spark.createDataFrame([row], RUN).coalesce(1).write.mode("overwrite").parquet(f"{table}/runs/run={rung}-{trial}")
            done[rung, trial] = row

        with ThreadPool(parallelism) as pool:
            pool.map(run, [t for t in alive if (rung, t) not in done])
        alive = sorted(alive, key=lambda t: (done[rung, t]["val_mse"], t))[: max(1, len(alive) // keep)]
    out = pd.DataFrame(sorted(done.values(), key=lambda r: (-r["rung"], r["val_mse"], r["trial"])))
    out["place"], out["winner"] = range(1, len(out) + 1), [i == 0 for i in range(len(out))]
    columns = f"{RUN}, place int, winner boolean"
    if holdout is not None:
        model = fit_price_model(ready, target, stages=stages, **trials[int(out["trial"][0])])
        test = evaluate(model, holdout, target)[0].first().asDict()
        for m in METRICS:
            out[f"test_{m}"] = [float(test[m])] + [None] * (len(out) - 1)
            columns += f", test_{m} double"
    return spark.createDataFrame([tuple(None if x != x else x for x in r) for r in out.astype(object).itertuples(index=False)], columns)


def importances(model: PipelineModel) -> DataFrame:
    """Feature importances, largest first."""
    names = model.stages[-2].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    rows = [(n.removesuffix("_ix"), float(x)) for n, x in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# -- shadow features ---------------------------------------------------------

def placed_rows(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows with their position in an order of hashes of the key, stored: what all permutations of a search start from."""
    mixed = df.withColumn("_mix", F.xxhash64(F.lit(seed), F.col(key).cast("string")))
    return written(positions(mixed, [], ["_mix", key])).drop("_mix")


def permuted(placed: DataFrame, rows: int, columns: list[str], seed: int) -> DataFrame:
    """Add shadow_<c> of each column: the values of the row that another order puts at a row's position.

    The other order steps through the first by a stride without common factor with the number of rows, from a start of
    its own, so it is a permutation of the whole table and costs one join on the position. The first order follows
    hashes, so which row lends its values has nothing to do with any value; shadows of one row come from one row.
    """
    rng = random.Random(seed)
    stride = next(s for s in iter(lambda: rng.randrange(1, 1 << 20), None) if math.gcd(s, rows) == 1) if rows else 1
    start = rng.randrange(rows) if rows else 0
    lent = placed.select(
        F.pmod((F.col("position") - 1) * stride + start, F.lit(max(rows, 1))).alias("_at"), *[F.col(c).alias(f"shadow_{c}") for c in columns])
    return placed.join(lent, F.col("position") - 1 == F.col("_at")).drop("_at", "position")


def shuffled_copies(df: DataFrame, columns: list[str], key: str, seed: int) -> DataFrame:
    placed = placed_rows(df, key, seed)
    return permuted(placed, placed.count(), columns, seed)


def binom_tails(hits: int, n: int) -> tuple[float, float]:
    """P(X >= hits) and P(X <= hits) of n fair coin throws."""
    p = [math.comb(n, i) / 2**n for i in range(n + 1)]
    return sum(p[hits:]), sum(p[: hits + 1])


def boruta(
    df: DataFrame, key: str, target: str = "price", trials: int = 50, alpha: float = 0.05, seed: int = 1,
    on_trial: Callable[[int, dict[str, int]], None] | None = None, parallelism: int = 4, **params,
) -> DataFrame:
    """Accept or reject features by how often they beat the best of their shuffled copies.

    Each trial trains once on features and shadows; counts are tested against a
    fair coin with Bonferroni correction and the loop ends once all are decided.
    `parallelism` trials run at a time; they are counted in their order, and those behind the end are not.
    A shadow column has the values of its feature, so features are indexed, assembled and put in bins once, and a trial joins the
    stored bins with themselves.
    """
    cats, nums = columns_of(df, target, (key,))
    features = [*cats, *nums]
    hits = dict.fromkeys(features, 0)
    level = alpha / len(features)
    status: dict[str, str] = {}
    ready, stages = encoded(df, target, (key,))
    placed = placed_rows(ready.select(key, target, "features"), key, seed)
    rows = placed.count()
    trainer = lambda n: regressor(stages, target, **({"seed": seed + n} | params))
    counted = trainer(0).settings() is not None and rows > 0
    if counted:
        kinds = trainer(0).bins(placed, rows)
        placed = written(boosting.with_bins(placed.drop(key), "features", kinds))
    both = VectorAssembler(inputCols=["features", "shadow_features"], outputCol="_all")

    def winners(n: int) -> list[str]:
        lent = permuted(placed, rows, ["bins" if counted else "features"], seed + n).filter(F.col(target).isNotNull())
        if counted:
            trees = boosting.grown(lent, target, ["bins", "shadow_bins"], kinds.twice(), trainer(n).settings(), rows)
            gain = boosting.importances(trees, 2 * len(features))
        else:  # settings that Spark's own training takes
            train = both.transform(lent).select(target, F.col("_all").alias("features")).coalesce(max(1, math.ceil(rows / TASK_ROWS)))
            gain = trainer(n).fit(train).featureImportances.toArray()
        best = max(gain[len(features):])
        return [c for c, g in zip(features, gain) if g > best]

    n = 0
    with ThreadPool(parallelism) as pool:
        while n < trials and (n == 0 or "tentative" in status.values()):
            for won in pool.map(winners, range(n + 1, min(n + parallelism, trials) + 1), 1):
                n += 1
                for c in won:
                    hits[c] += 1
                for c in features:
                    over, under = binom_tails(hits[c], n)
                    status[c] = "accept" if over <= level else "reject" if under <= level else "tentative"
                if on_trial is not None:
                    on_trial(n, dict(hits))
                if "tentative" not in status.values():
                    break
    found = [(c, hits[c], n, status[c]) for c in features]
    return df.sparkSession.createDataFrame(found, "feature string, hits int, trials int, status string")


# -- scoring -----------------------------------------------------------------

def request_features(requests: DataFrame) -> DataFrame:
    """Model features of scoring requests; a divisor below 1 counts as 1."""
    c = F.col
    given = [n for n in requests.columns if n not in REQUEST_COLUMNS]
    return requests.select(
        *given, "subdistrict", c("land_area").cast("double").alias("luas_tanah"), c("building_area").cast("double").alias("luas_bangunan"),
        c("num_floors").cast("double").alias("jumlah_lantai"), c("year_built").cast("double").alias("tahun_dibangun"),
        c("electricity_rate").cast("double").alias("daya_listrik"),
        (c("land_area") / F.greatest("building_area", F.lit(1))).alias("land_building_ratio"),
        c("num_bedrooms").cast("double").alias("total_beds"), c("num_bathrooms").cast("double").alias("total_baths"),
        (c("building_area") / F.greatest("num_floors", F.lit(1))).alias("building_area_floor_ratio"),
    )


def predict_prices(model: PipelineModel, requests: DataFrame, subdistricts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Predicted rupiah prices, and the requests rejected for an unknown subdistrict."""
    known = subdistricts.select("subdistrict").distinct()
    rejected = requests.join(known, "subdistrict", "left_anti")
    accepted = requests.join(known, "subdistrict", "left_semi")
    scored = predictions(model, request_features(accepted))
    given = [c for c in requests.columns if c not in REQUEST_COLUMNS]
    return scored.select(*given, "subdistrict", F.exp("prediction").alias("price_idr")), rejected
