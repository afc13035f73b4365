"""Every query against its SQL on DuckDB; queries without SQL must run and give rows."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    yield con
    con.close()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cur = duck.execute(ORACLE[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == table_of(columns, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["subdistrict", "city", "listing_count", "average_price"]


def test_oracle_names_are_queries():
    assert set(ORACLE) <= set(QUERIES)
