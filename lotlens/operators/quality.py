"""Data-quality checks; each gives rows (check_name, column_name, value, violations)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ["check_name", "column_name", "value", "violations"]


def _shape(df: DataFrame, check: str, column: str, value: str | None) -> DataFrame:
    v = F.lit(None).cast("string") if value is None else F.col(value).cast("string")
    return df.select(
        F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), v.alias("value"), "violations"
    )


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs of all columns in one pass."""
    row = df.agg(*[F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)).alias(c) for c in columns])
    long = row.unpivot([], columns, "column_name", "violations").filter("violations > 0")
    return long.select(F.lit("not_null").alias("check_name"), "column_name", F.lit(None).cast("string").alias("value"), "violations")


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once, with their count."""
    dup = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("violations"))
    return _shape(dup.filter("violations > 1"), "unique", column, column)


def check_fk(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent; counted per value first, so copies of one value do not travel."""
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("violations"))
    keys = parent.select(F.col(parent_column).alias("_pk")).distinct()
    orphans = per_value.join(keys, per_value[column] == keys["_pk"], "left_anti")
    return _shape(orphans, "relationships", column, column)


def check_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    odd = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(accepted))
    return _shape(odd.groupBy(column).agg(F.count(F.lit(1)).alias("violations")), "accepted_values", column, column)


@dataclass(frozen=True)
class Check:
    """A declared check; kind is not_null, unique, accepted_values or relationships (then with a parent table and column)."""

    table: str
    column: str
    kind: str
    accepted: tuple = ()
    parent: tuple[str, str] | None = None


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """All violations of the declared checks: (table_name, check_name, column_name, value, violations).

    Each table is read once. A row gives one item for every check it fails and one for the value of every key column
    (checked for uniqueness, or on either side of a relationship); items are counted by value, before and after one
    shuffle. The keys of all tables meet there: a value has one row with its count in each key column, off which repeated keys
    and keys without parent are read, so nothing is stored or joined. Values are compared as text; NULL fails not_null
    only, also where the parent has a NULL.
    """
    keys = {(c.table, c.column) for c in checks if c.kind in ("unique", "relationships")} | {c.parent for c in checks if c.parent}
    place = {k: i for i, k in enumerate(sorted(keys))}
    text = lambda c: F.col(c).cast("string")
    # an item names its check, a key its column by number: short to shuffle
    item = lambda check, key, value: F.struct(F.lit(check).alias("check"), F.lit(key).alias("key"), value.alias("value"))
    items = []
    for name in sorted({c.table for c in checks} | {t for t, _ in keys}):
        found = [F.when(F.col(c).isNotNull(), item(-1, place[t, c], text(c))) for t, c in sorted(keys) if t == name]
        for i, c in enumerate(checks):
            if c.table != name:
                continue
            if c.kind == "not_null":
                found.append(F.when(F.col(c.column).isNull(), item(i, -1, F.lit(None).cast("string"))))
            elif c.kind == "accepted_values":
                found.append(F.when(~F.col(c.column).isin(list(c.accepted)), item(i, -1, text(c.column))))
            elif c.kind not in ("unique", "relationships"):
                raise ValueError(f"unknown check {c.kind}")
        items.append(tables[name].select(F.explode(F.array(*found)).alias("i")).filter("i IS NOT NULL").select("i.*"))
    counts = reduce(DataFrame.unionAll, items).groupBy("check", "value").agg(
        F.count(F.lit(1)).alias("items"), *[F.count(F.when(F.col("key") == i, 1)).alias(f"key_{i}") for i in place.values()])
    count_of = lambda table, column: F.col(f"key_{place[table, column]}")
    broken = []
    for i, c in enumerate(checks):
        if c.kind == "unique":
            broken.append((c, (F.col("check") == -1) & (count_of(c.table, c.column) > 1), count_of(c.table, c.column)))
        elif c.kind == "relationships":
            orphan = (F.col("check") == -1) & (count_of(c.table, c.column) > 0) & (count_of(*c.parent) == 0)
            broken.append((c, orphan, count_of(c.table, c.column)))
        else:
            broken.append((c, F.col("check") == i, F.col("items")))
    row = lambda c, n: F.struct(
        F.lit(c.table).alias("table_name"), F.lit(c.kind).alias("check_name"), F.lit(c.column).alias("column_name"), "value", n.alias("violations"))
    failed = counts.filter(reduce(lambda a, b: a | b, [F.col("check") >= 0, *[b for c, b, _ in broken if c.kind in ("unique", "relationships")]]))
    return failed.select(F.explode(F.array(*[F.when(b, row(c, n)) for c, b, n in broken])).alias("r")).filter("r IS NOT NULL").select("r.*")
