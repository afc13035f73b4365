"""Tables built once from stored staging, and the declared checks."""

import os
import shutil

from pyspark.sql import functions as F

from lotlens.operators.quality import Check, run_checks
from lotlens.plans import checks, derived, layers
from lotlens.plans.listings import amenity_area_counts, int_amenities, staged, star_schema, unique_listings, wide_listings
from lotlens.queries.marts import layer_sources


def counted(df, rows):
    """The same rows, every one that is read added to an accumulator."""
    def count(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema)


def test_layers_read_raw_records_once(spark, sf_dir, tmp_path):
    sources, target = layer_sources(spark, sf_dir), str(tmp_path / "layers")
    n = sources["listings"][0].count()
    read = spark.sparkContext.accumulator(0)
    watched = sources | {"listings": (counted(sources["listings"][0], read), "first")}
    tables, made = layers.build(spark, watched, target)
    stored = [name for name, layer in layers.LAYERS.items() if layer.stored]
    assert made == stored and read.value == n
    houses = tables["marts_downstream_houses"].count()

    _, made = layers.build(spark, watched, target)
    assert made == [] and read.value == n

    # other corrections of districts: only what reads them, from stored staging
    districts = spark.createDataFrame([("NATION_1", "Elsewhere")], "source string, target string")
    tables, made = layers.build(spark, watched | {"districts": (districts, "second")}, target)
    assert made == ["marts_fact_houses", "marts_downstream_houses"] and read.value == n
    assert tables["marts_downstream_houses"].count() == houses
    assert len(os.listdir(f"{target}/marts_fact_houses")) == 1

    # a table half written (no success mark) is built again, one never asked for is not
    folder = f"{target}/marts_dim_tags/{os.listdir(f'{target}/marts_dim_tags')[0]}"
    tags = tables["marts_dim_tags"].count()
    os.remove(f"{folder}/_SUCCESS")
    shutil.rmtree(f"{target}/marts_dim_facilities")
    tables, made = layers.build(spark, watched | {"districts": (districts, "second")}, target, ["marts_dim_tags"])
    assert made == ["marts_dim_tags"] and list(tables) == ["marts_dim_tags"] and tables["marts_dim_tags"].count() == tags

    # new records: all that is made of them
    _, made = layers.build(spark, watched | {"listings": (watched["listings"][0].limit(50), "third")}, target)
    assert "marts_fact_amenities" not in made and {"stg_listings", "marts_bridge_house_tags", "marts_dim_facilities"} <= set(made)


def test_marts_equal_those_built_directly(spark, sf_dir, tmp_path):
    sources = layer_sources(spark, sf_dir)
    tables, _ = layers.build(spark, sources, str(tmp_path))
    raw, districts, areas, amenities = (sources[n][0] for n in layers.SOURCES)
    direct = star_schema(raw, districts, areas, amenities)
    assert {n for n in tables if n.startswith("marts")} == set(direct)
    for name in ("marts_dim_tags", "marts_bridge_house_floor_materials", "marts_dim_amenities"):
        rows = lambda df: sorted(map(tuple, df.collect()), key=str)
        assert rows(tables[name]) == rows(direct[name])
    # equal records in other partitions: the same one is kept, also where copies differ in their lists only
    twice = staged(raw).unionByName(staged(raw.selectExpr("* EXCEPT (tags)", "array('x') AS tags")))
    counts = amenity_area_counts(int_amenities(amenities), areas)
    kept = [sorted((r.id, str(r.tags)) for r in wide_listings(t, districts, counts).select("id", "tags").collect())
            for t in (twice.repartition(1), twice.repartition(7, "url"))]
    assert kept[0] == kept[1]


def test_declared_checks_by_hand(spark):
    child = spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, None), ("q", 2, "y"), (None, 3, "y"), ("q", None, "x")], "ref string, n int, kind string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "id string")
    declared = [
        Check("child", "ref", "not_null"), Check("child", "kind", "not_null"), Check("child", "kind", "accepted_values", accepted=("x",)),
        Check("child", "n", "accepted_values", accepted=(1, 3)), Check("child", "ref", "relationships", parent=("parent", "id")),
        Check("parent", "id", "unique"), Check("child", "n", "unique"),
    ]
    reads = spark.sparkContext.accumulator(0)
    got = run_checks({"child": counted(child, reads), "parent": counted(parent, reads)}, declared)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("child", "not_null", "ref", None, 1), ("child", "not_null", "kind", None, 1), ("child", "accepted_values", "kind", "y", 2),
        ("child", "accepted_values", "n", "2", 1), ("child", "relationships", "ref", "q", 2), ("parent", "unique", "id", "b", 2),
        ("child", "unique", "n", "1", 2),
    ], key=str)
    assert reads.value == 10  # every row once
    none = run_checks({"child": child.limit(0), "parent": parent.limit(0)}, declared)
    assert none.count() == 0


def test_keys_of_all_tables_are_counted_in_one_shuffle(spark):
    """Repeated keys and keys without parent come off one grouping by value: no join, no table written on the way."""
    from lotlens import session
    child, other = spark.range(6).selectExpr("id % 4 AS ref"), spark.range(3).selectExpr("CAST(id AS INT) AS ref")
    parent = spark.createDataFrame([("0",), ("1",), ("1",), ("7",)], "id string")
    declared = [Check("parent", "id", "unique"), *[Check(t, "ref", "relationships", parent=("parent", "id")) for t in ("child", "other")]]
    before = len(session._TABLES)
    got = run_checks({"child": child, "other": other, "parent": parent}, declared)
    assert sorted(map(tuple, got.collect())) == [
        ("child", "relationships", "ref", "2", 1), ("child", "relationships", "ref", "3", 1), ("other", "relationships", "ref", "2", 1), ("parent", "unique", "id", "1", 2)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(session._TABLES) == before and "Join" not in plan and plan.count("Aggregate") == 1


def test_checks_name_columns_of_layers(spark, sf_dir, tmp_path):
    tables, _ = layers.build(spark, layer_sources(spark, sf_dir), str(tmp_path), sorted({c.table for c in checks.CHECKS}))
    for c in checks.CHECKS:
        assert c.column in tables[c.table].columns


def test_only_repeated_ids_are_compared(spark):
    """One record per id, a null id like others; the window sees the records of repeated ids alone."""
    columns = "id string, last_modified string, scraped_at string, url string, price double, installment double, subdistrict string, city string, description string, record_hash long"
    rows = [(k, m, "s", u, 1.0, 1.0, "a", "b", "c", 1) for k, m, u in (("x", "1", "u"), ("x", "2", "v"), ("x", "2", "w"), ("y", None, "z"), (None, "1", "p"), (None, "3", "q"))]
    out = unique_listings(spark.createDataFrame(rows, columns))
    assert sorted((str(r.id), r.url) for r in out.collect()) == [("None", "q"), ("x", "v"), ("y", "z")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Window") and "LeftSemi" in plan


def test_specs_of_derived_listings_are_one_map_without_a_record_per_entry(spark, sf_dir):
    flat = {f"hos{r.o_orderkey}": r.asDict() for r in derived.flat_listings(spark, sf_dir).limit(50).collect()}
    raw = derived.raw_listings(spark, sf_dir)
    for r in raw.filter(F.col("id").isin(list(flat))).select("id", "specs").collect():
        assert r.specs == {n.replace("_", " ").title(): flat[r.id][n] for n in derived.SPEC_TEXTS if flat[r.id][n] is not None}
    assert "map_from_entries" not in raw._jdf.queryExecution().optimizedPlan().toString()
