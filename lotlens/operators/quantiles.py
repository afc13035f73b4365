"""Exact group quantiles that survive a group holding most of the rows.

`percentile` keeps every distinct value of a group in one task.  Here a first
aggregate brackets each wanted quantile with a bounded sketch; a second counts the
values below each bracket and finds the nearest on either side, and only values
inside the brackets are counted one by one and ordered.
The result equals the exact interpolated quantile.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

ACCURACY = 100_000          # sketch rank error is 1 / ACCURACY
MARGIN = 10 / ACCURACY      # half width of a bracket, well above that error
TASK_VALUES = 200_000       # distinct values of a bracket that one task orders; more are narrowed first
SLICES = 1024


def group_quantiles(
    df: DataFrame, keys: list[str], value: Column, probs: dict[str, float], aggs: dict[str, Column] | None = None
) -> DataFrame:
    """Per `keys`: one column per named quantile of `value`, plus `aggs` computed in the first pass."""
    aggs = aggs or {}
    probs = dict(sorted(probs.items(), key=lambda kv: kv[1]))
    ps = list(probs.values())
    edges = [e for p in ps for e in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))]
    rows = df.withColumn("_x", value.cast("double"))
    first = written(
        rows.groupBy(*keys).agg(
            F.count("_x").alias("_n"), F.percentile_approx("_x", edges, ACCURACY).alias("_edge"), *[a.alias(n) for n, a in aggs.items()],
        )
    )
    renamed = [F.col(k).alias(f"_k_{k}") for k in keys]
    brackets = first.filter("_n > 0").select(*renamed, "_edge")
    need = rows.filter(F.col("_x").isNotNull()).select(*keys, "_x")
    joined = need.join(brackets, _same(need, brackets, keys)) if keys else need.withColumn("_edge", brackets.select("_edge").scalar())
    v = F.col("_x")
    lo, hi = (lambda i: F.col("_edge")[2 * i]), (lambda i: F.col("_edge")[2 * i + 1])
    # one row per group: how many values lie below each bracket, and the nearest on either side
    around = joined.groupBy(*keys).agg(*[
        c for i in range(len(ps)) for c in (
            F.count_if(v < lo(i)).alias(f"_c{i}"), F.max(F.when(v < lo(i), v)).alias(f"_a{i}"), F.min(F.when(v > hi(i), v)).alias(f"_z{i}"))
    ])
    held = F.array_compact(F.array(*[F.when((lo(i) <= v) & (v <= hi(i)), F.lit(i)) for i in range(len(ps))]))
    counted = written(joined.select(*keys, F.explode(held).alias("i"), v.alias("v")).groupBy(*keys, "i", "v").agg(F.count(F.lit(1)).alias("c")))
    base = around.select(*renamed, *[c for c in around.columns if c not in keys])
    sized = first.filter("_n > 0")
    sized = sized.join(base, _same(sized, base, keys)) if keys else sized.crossJoin(base)  # one row each
    wanted = written(sized.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), ((F.col("_n") - 1) * p).alias("h"), F.col(f"_c{i}").alias("below"), F.col(f"_a{i}").alias("before"), F.col(f"_z{i}").alias("behind"))
        for i, p in enumerate(ps)
    ])).alias("w")).select(*keys, "w.*"))
    found = _pick(counted, wanted, keys)
    found = found.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(*[F.max(F.when(F.col("i") == i, F.col("q"))).alias(n) for i, n in enumerate(probs)])
    kept = first.drop("_n", "_edge")
    if not keys:
        if not aggs:
            return found
        one = found.select(F.struct(*probs).alias("q")).scalar()
        return kept.withColumn("_q", one).select(*kept.columns, "_q.*")
    return kept.join(found, _same(kept, found, keys), "left").select(*kept.columns, *probs)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def _pick(counted: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Interpolated value q of each bracket i from its counted values.

    wanted: position h from 0, how many values lie below the bracket, nearest value on either side. A
    bracket of more values than a task orders is cut into equal slices of its range, and only those that hold
    the two positions stay.
    """
    both = [*keys, "i"]
    state = wanted.select(*[F.col(k).alias(f"_k_{k}") for k in both], "h", "below", "before", "behind")
    while True:
        largest = counted.groupBy(*both).agg(F.count(F.lit(1)).alias("n"), (F.min("v") < F.max("v")).alias("wide")).agg(F.max(F.when(F.col("wide"), F.col("n")))).first()[0]
        if (largest or 0) <= TASK_VALUES:
            break
        span = counted.groupBy(*[F.col(k).alias(f"_k_{k}") for k in both]).agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
        step = (F.col("v") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
        sliced = counted.join(span, _same(counted, span, both)).withColumn("s", F.coalesce(F.least(F.floor(step * SLICES), F.lit(SLICES - 1)), F.lit(0)))
        sliced = written(sliced.select(*both, "v", "c", "s"))
        per = sliced.groupBy(*both, "s").agg(F.sum("c").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        per = per.withColumn("cum", F.sum("c").over(Window.partitionBy(*both).orderBy("s")))
        at = per.join(state, _same(per, state, both)).withColumn("start", F.col("below") + F.col("cum") - F.col("c"))
        keep = (F.col("start") <= F.ceil("h")) & (F.col("below") + F.col("cum") > F.floor("h"))
        at = at.withColumn("keep", keep)
        passed, ahead = F.col("below") + F.col("cum") <= F.floor("h"), F.col("start") > F.ceil("h")
        state = written(at.groupBy(*[F.col(k).alias(f"_k_{k}") for k in both], "h", "below").agg(
            F.sum(F.when(passed, F.col("c")).otherwise(0)).alias("more"),
            F.coalesce(F.max(F.when(passed, F.col("most"))), F.max("before")).alias("before"),
            F.coalesce(F.min(F.when(ahead, F.col("least"))), F.min("behind")).alias("behind"),
        ).withColumn("below", F.col("below") + F.col("more")).drop("more"))
        stay = written(at.filter("keep").select(*[F.col(k).alias(f"_k_{k}") for k in both], F.col("s").alias("_s")))
        counted = written(sliced.join(stay, _same(sliced, stay, both) & (F.col("s") == F.col("_s")), "left_semi").select(*both, "v", "c"))
    upto = Window.partitionBy(*both).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("cum", F.sum("c").over(upto))
    ranked = state.join(ranked, _same(ranked, state, both), "left")
    reached = lambda k: F.min(F.when(F.col("below") + F.col("cum") > k, F.struct("cum", "v")))["v"]
    low, high = F.floor("h"), F.ceil("h")
    names = [F.col(f"_k_{k}").alias(k) for k in both]
    out = ranked.groupBy(*names, "h", "below", "before", "behind").agg(reached(low).alias("a"), reached(high).alias("b"))
    value = lambda k, c: F.when(k < F.col("below"), F.col("before")).otherwise(F.coalesce(c, F.col("behind")))
    a, b = value(low, F.col("a")), value(high, F.col("b"))
    return out.select(*both, (a + (b - a) * (F.col("h") - low)).alias("q"))
