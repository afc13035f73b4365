"""Aggregation, pivots, distinct forms, rankings and running totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as x
from ..session import written
from .quantiles import group_quantiles


# -- summaries ---------------------------------------------------------------

def top_locations(areas: DataFrame, facts: DataFrame, names: list[str], key: str = "area_sk", n: int = 15) -> DataFrame:
    """Areas with most listings; ties broken by the area names.

    Facts (`key`, `price`, or already summed `listings`, `price_sum`, `priced`)
    are added up per area before the join, so one row per area meets the
    dimension however many listings an area has.
    """
    if "listings" not in facts.columns:
        facts = facts.select(
            key, F.lit(1).alias("listings"), F.col("price").alias("price_sum"), F.col("price").isNotNull().cast("int").alias("priced"))
    sums = lambda: [F.sum(c).alias(c) for c in ("listings", "price_sum", "priced")]
    out = areas.join(facts.groupBy(key).agg(*sums()), key).groupBy(*names).agg(*sums())
    return out.select(
        *names, F.col("listings").alias("listing_count"), F.try_divide("price_sum", "priced").alias("average_price")
    ).orderBy(F.desc("listing_count"), *names).limit(n)


def group_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    c = F.col(value)
    aggs = {
        "count": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c),
    }
    return group_quantiles(df, keys, c, {"median": 0.5}, aggs)


def five_numbers(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Box plot data: minimum, quartiles, maximum."""
    c = F.col(value)
    return group_quantiles(
        df, keys, c, {"q1": 0.25, "median": 0.5, "q3": 0.75}, {"min": F.min(c), "max": F.max(c)}
    )


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    out = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    out = out.orderBy(F.desc("count"), column)
    return out if k is None else out.limit(k)


def available_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def null_ratio(df: DataFrame) -> DataFrame:
    """Share of missing values per column, largest first, in one pass."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])
    return unpivot(row, df.columns, "column_name", "missing").orderBy(F.desc("missing"), "column_name")


def flag_totals(df: DataFrame, flags: list[str]) -> DataFrame:
    row = df.agg(*[F.sum(c).alias(c) for c in flags])
    return unpivot(row, flags, "flag", "total").orderBy(F.desc("total"), "flag")


def unpivot(df: DataFrame, columns: list[str], name: str, value: str, ids: list[str] | None = None) -> DataFrame:
    return df.unpivot(ids or [], columns, name, value)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over the whole range, empty bins included."""
    c = F.col(column).cast("double")
    lo = df.select(F.min(c)).scalar()
    hi = df.select(F.max(c)).scalar()
    raw = F.floor(F.lit(bins) * (c - lo) / F.nullif(hi - lo, F.lit(0.0)))
    bin_no = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("long")
    hits = df.filter(c.isNotNull()).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(hits, "bin", "left").fillna(0, ["n"])


# -- months ------------------------------------------------------------------

def monthly_counts(df: DataFrame, ts: str, year: int | None = None) -> DataFrame:
    out = df.filter(F.col(ts).isNotNull())
    if year is not None:
        out = out.filter(F.year(ts) == year)
    return out.groupBy(F.to_date(F.date_trunc("month", ts)).alias("month")).agg(F.count(F.lit(1)).alias("total"))


def running_total(df: DataFrame, order: str, value: str, name: str = "cumulative") -> DataFrame:
    """Running sum over an aggregated series (one row per period, so one ordered window is enough)."""
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def resample_month(df: DataFrame, ts: str, above: int = 1) -> DataFrame:
    """Every month between first and last with its count, kept where the count exceeds `above`."""
    counts = monthly_counts(df, ts)
    span = df.agg(
        F.to_date(F.date_trunc("month", F.min(ts))).alias("a"), F.to_date(F.date_trunc("month", F.max(ts))).alias("b")
    )
    calendar = span.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month"))
    return calendar.join(counts, "month", "left").fillna(0, ["total"]).filter(F.col("total") > above)


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Share of the sum; the total is a scalar subquery, so rows stay where they are."""
    return df.withColumn(name, F.col(value) / df.select(F.sum(value).cast("double")).scalar())


# -- pivots ------------------------------------------------------------------

def pivot_long(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, column, count): the pivot of any number of values, one row per value that a key has."""
    return df.filter(F.col(column).isNotNull()).groupBy(key, column).agg(F.count(F.lit(1)).alias("count"))


def _name(prefix: str, value: object) -> str:
    return prefix + str(value).lower().replace(" ", "_")


def pivot_flags(df: DataFrame, key: str, column: str, values: list, prefix: str = "") -> DataFrame:
    """One row per key, one 0/1 column per named value."""
    return df.groupBy(key).agg(
        *[F.max(F.when(F.col(column) == F.lit(val), 1).otherwise(0)).alias(_name(prefix, val)) for val in values]
    )


def pivot_counts(df: DataFrame, key: str, column: str, values: list, prefix: str = "") -> DataFrame:
    """One row per key, one count per named value."""
    return df.groupBy(key).agg(
        *[F.sum(F.when(F.col(column) == F.lit(val), 1).otherwise(0)).alias(_name(prefix, val)) for val in values]
    )


def crosstab_join(base: DataFrame, base_key: str, long: DataFrame, long_key: str, column: str, values: list, prefix: str = "") -> DataFrame:
    """Counts per value joined to the base rows, missing combinations 0."""
    wide = pivot_counts(long.withColumnRenamed(long_key, "_key"), "_key", column, values, prefix)
    flags = [c for c in wide.columns if c != "_key"]
    return base.join(wide, F.col(base_key) == F.col("_key"), "left").drop("_key").fillna(0, flags)


def pivot_stats(df: DataFrame, index: str, flag: str, value: str, values: list) -> DataFrame:
    """Mean, median and count per index and named flag value, one column each, 0 where absent."""
    long = group_stats(df, [index, flag], value)
    cols = [
        F.max(F.when(F.col(flag) == F.lit(val), F.col(stat))).alias(_name(f"{stat}_", val))
        for val in values for stat in ("mean", "median", "count")
    ]
    return long.groupBy(index).agg(*cols).fillna(0)


# -- distinct and lists ------------------------------------------------------

def distinct_on(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the first in `order` (then by all orderable columns, NULL first).

    Spark limits the groups before the shuffle, so a key with very many copies
    leaves each task as one row.
    """
    orderable = [f.name for f in df.schema if f.name not in keys and "map<" not in f.dataType.simpleString()]
    by = [*(order or []), *[c for c in orderable if c not in (order or [])]]
    if not by:
        return df.dropDuplicates(keys)
    first = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def build_dim(df: DataFrame, key: str, sk: str, labels: dict[str, Column]) -> DataFrame:
    """Dimension: surrogate key and labels of the distinct values of `key`."""
    return df.select(x.surrogate_key(key).alias(sk), *[c.alias(n) for n, c in labels.items()]).distinct()


def build_bridge(df: DataFrame, ref: str, key: str, sk: str) -> DataFrame:
    return df.select(F.col(ref).alias("house_id"), x.surrogate_key(key).alias(sk))


def positions(df: DataFrame, keys: list[str], order: list[str], tasks: int | None = None) -> DataFrame:
    """Exact 1-based position of every row inside its group, with hot groups spread over tasks.

    Rows are range-partitioned by key and order, so one group may span many
    partitions; a row's position is its rank inside the partition plus the
    count of its group in the partitions before.  The cut is written out, which
    keeps partition numbers fixed when tasks are retried.
    """
    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = written(df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_c"))
    starts = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_p"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    ranked = cut.withColumn("_r", F.row_number().over(inside))
    on = reduce(
        lambda a, b: a & b, [ranked[k].eqNullSafe(starts[f"_k_{k}"]) for k in keys], ranked["_part"] == starts["_p"]
    )
    return ranked.join(starts, on).select(*df.columns, (F.col("_start") + F.col("_r")).cast("long").alias("position"))


def lists_per_key(df: DataFrame, key: str, item: str, order: list[str], page_rows: int) -> DataFrame:
    """Items per key as lists, NULL items kept, in order.

    `page_rows` is the number of items of a row: a longer list
    continues on further pages, so no cell grows with the data and none is cut.
    """
    placed = positions(df.select(key, item, *[c for c in order if c not in (key, item)]), [key], order)
    page = F.floor((F.col("position") - 1) / page_rows).cast("long")
    listed = placed.groupBy(key, page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("position", F.struct(F.col(item).alias("v")).alias("v")))).alias("_l")
    )
    return listed.select(key, "page", F.transform("_l", lambda e: e["v"]["v"]).alias("items"))
