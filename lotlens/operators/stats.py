"""Descriptive statistics, outliers, imputation, correlation and tests."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as x
from ..functions.tails import chi_square_pvalue, t_pvalue
from .aggregates import share_of_total, value_counts
from .quantiles import group_quantiles


# -- outliers ----------------------------------------------------------------

def iqr_outliers(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """Add `is_outlier`: outside the quartiles by more than k interquartile ranges."""
    q = group_quantiles(df, [], F.col(column), {"q1": 0.25, "q3": 0.75}).select(F.struct("q1", "q3")).scalar()
    c, spread = F.col(column), (F.col("_q.q3") - F.col("_q.q1")) * k
    flag = (c < F.col("_q.q1") - spread) | (c > F.col("_q.q3") + spread)
    return df.withColumn("_q", q).withColumn("is_outlier", F.coalesce(flag, F.lit(False))).drop("_q")


def outlier_share(flagged: DataFrame) -> DataFrame:
    hits = F.sum(F.col("is_outlier").cast("long"))
    return flagged.agg(
        F.count(F.lit(1)).alias("total"), hits.alias("outliers"), F.avg(F.col("is_outlier").cast("int")).alias("share")
    )


def without_outliers(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    return iqr_outliers(df, column, k).filter(~F.col("is_outlier")).drop("is_outlier")


def cutoffs(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Rows below every limit (a missing value fails its limit)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) < n for c, n in limits.items()]))


# -- imputation --------------------------------------------------------------

def impute(df: DataFrame, rules: list[dict], drop: list[str] | None = None) -> DataFrame:
    """Fill missing values by rules {"col", "method": constant|mode|mean|median, "value"}; drop sparse columns.

    Statistics are scalar subqueries.  A mode comes from counts per value (the
    smallest of equally frequent ones), so no task holds all values of a column.
    """
    df = df.drop(*(drop or []))
    fills: dict[str, Column] = {}
    for r in rules:
        c, how = r["col"], r["method"]
        if how == "constant":
            fill = F.lit(r["value"])
        elif how == "mean":
            fill = df.select(F.avg(c)).scalar()
        elif how == "median":
            fill = group_quantiles(df, [], F.col(c), {"m": 0.5}).scalar()
        elif how == "mode":
            fill = value_counts(df, c, 1).select(c).scalar()
        else:
            raise ValueError(f"unknown method {how}")
        fills[c] = F.coalesce(F.col(c), fill)
    return df.withColumns(fills)


# -- correlation -------------------------------------------------------------

def correlation_table(df: DataFrame, target: str, columns: list[str], method: str = "pearson") -> DataFrame:
    """r of each column with the target, and the number of complete pairs, in one pass."""
    both = lambda c: F.col(c).isNotNull() & F.col(target).isNotNull()
    row = df.agg(F.array(*[
        F.struct(
            F.lit(c).alias("variable"), F.lit(method).alias("method"),
            F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias("r"),
            F.count(F.when(both(c), F.lit(1))).alias("n"),
        ) for c in columns
    ]).alias("t"))
    return row.select(F.inline("t"))


def with_pvalue(table: DataFrame) -> DataFrame:
    return table.withColumn("pvalue", t_pvalue("r", F.col("n").cast("double")))


def pearson_table(df: DataFrame, target: str = "price") -> DataFrame:
    numeric = [f.name for f in df.schema if f.dataType.typeName() in ("integer", "long", "double", "float", "short") and f.name != target]
    return with_pvalue(correlation_table(df, target, numeric))


def pointbiserial_table(df: DataFrame, name_part: str, target: str = "price") -> DataFrame:
    """Correlation of every 0/1 column whose name holds `name_part`."""
    flags = [c for c in df.columns if name_part in c and c != target]
    return with_pvalue(correlation_table(df, target, flags, "pointbiser"))


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b, r) of the lower triangle, in one pass."""
    row = df.agg(F.array(*[
        F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
        for a, b in combinations(columns, 2)
    ]).alias("t"))
    return row.select(F.inline("t"))


# -- description -------------------------------------------------------------

DESCRIBED = {"p1": 0.01, "p5": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95, "p99": 0.99}


def describe_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per numeric column: size, moments (population skew and kurtosis), mode, quantiles, confidence of the mean."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "v")
    v = F.col("v")
    aggs = {
        "nobs": F.count("v"), "missing": F.count(F.lit(1)) - F.count("v"), "mean": F.avg(v), "std": F.stddev_samp(v),
        "min": F.min(v), "max": F.max(v), "skew": F.skewness(v), "kurtosis": F.kurtosis(v) + 3,
    }
    base = group_quantiles(long, ["column_name"], v, DESCRIBED, aggs)
    per_value = long.filter("v IS NOT NULL").groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c"))
    mode = per_value.groupBy("column_name").agg(F.max(F.struct(F.col("c").alias("c"), (-v).alias("v"))).alias("m"))
    mode = mode.select(F.col("column_name").alias("_c"), (-F.col("m.v")).alias("mode"), F.col("m.c").alias("mode_count"))
    z = NormalDist().inv_cdf(0.975)
    se = F.col("std") / F.sqrt("nobs")
    return base.join(mode, F.col("column_name") == F.col("_c"), "left").drop("_c").withColumns({
        "std_err": se, "lower_ci": F.col("mean") - z * se, "upper_ci": F.col("mean") + z * se,
        "iqr": F.col("q3") - F.col("q1"), "range": F.col("max") - F.col("min"),
    })


# -- tests -------------------------------------------------------------------

def benford(df: DataFrame, column: str) -> DataFrame:
    """Share of each first digit against the law of leading digits."""
    digits = df.select(x.first_digit(column).alias("first_digit")).filter("first_digit > 0")
    counts = digits.groupBy("first_digit").agg(F.count(F.lit(1)).alias("count"))
    return share_of_total(counts, "count", "real_proportion").withColumn(
        "benford_proportion", F.log10(1 + 1 / F.col("first_digit"))
    )


def chisq_statistic(df: DataFrame, observed: str, expected: str) -> DataFrame:
    o, e = F.col(observed), F.col(expected)
    return df.agg(F.sum((o - e) * (o - e) / e).alias("statistic"), (F.count(F.lit(1)) - 1).alias("dof"))


def chisq_gof(df: DataFrame, observed: str, expected: str) -> DataFrame:
    """Statistic, degrees of freedom and p-value over any number of categories; only the sums meet the tail function."""
    row = chisq_statistic(df, observed, expected)
    return row.withColumn("pvalue", chi_square_pvalue("statistic", F.col("dof").cast("double")))


def normality_test(df: DataFrame, column: str) -> DataFrame:
    """K-squared of skewness and kurtosis, from one pass over the data."""
    v = F.col(column).cast("double")
    m = df.agg(F.count(v).cast("double").alias("n"), F.skewness(v).alias("g1"), (F.kurtosis(v) + 3).alias("b2"))
    n = F.col("n")
    sd = F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (beta - 1)) - 1
    u = F.col("g1") * sd / F.sqrt(2 / (w2 - 1))
    z_skew = F.log(u + F.sqrt(u * u + 1)) / F.sqrt(0.5 * F.log(w2))
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    dev = (F.col("b2") - 3 * (n - 1) / (n + 1)) / F.sqrt(var)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    den = 1 + dev * F.sqrt(2 / (a - 4))
    z_kurt = (1 - 2 / (9 * a) - F.signum(den) * F.cbrt((1 - 2 / a) / F.abs(den))) / F.sqrt(2 / (9 * a))
    k2 = z_skew * z_skew + z_kurt * z_kurt
    return m.select(k2.alias("statistic"), F.exp(-k2 / 2).alias("pvalue"), (F.exp(-k2 / 2) > 0.05).alias("is_normal"))


def qq_points(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """Observed quantiles against those of the normal distribution, standardised by mean and deviation."""
    ps = {f"q{i}": i / (points + 1) for i in range(1, points + 1)}
    c = F.col(column)
    row = group_quantiles(df, [], c, ps, {"_m": F.avg(c), "_s": F.stddev_samp(c)})
    items = F.array(*[
        F.struct(F.lit(p).alias("p"), F.lit(NormalDist().inv_cdf(p)).alias("normal"), F.col(q).alias("observed")) for q, p in ps.items()
    ])
    out = row.select("_m", "_s", F.explode(items).alias("e"))
    return out.select("e.p", "e.normal", "e.observed", (F.col("_m") + F.col("_s") * F.col("e.normal")).alias("fitted"))
