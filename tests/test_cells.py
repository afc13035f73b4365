"""Spatial join over cells against the exact test of every pair."""

import math
import random

from pyspark.sql import functions as F

from lotlens.operators import geo


def polygons(spark, shapes):
    rows = [(n, ("Polygon", None, [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]])) for n, rings in shapes]
    return spark.createDataFrame(rows, f"name string, geom {geo.GEOMETRY}")


def square(x, y, w):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]


def star(n, r):
    return [(50 + r * (0.6 + 0.4 * math.sin(9 * t)) * math.cos(t), 50 + r * (0.6 + 0.4 * math.sin(9 * t)) * math.sin(t))
            for t in (2 * math.pi * i / n for i in range(n))]


def test_areas_of_very_different_sizes(spark):
    rng = random.Random(3)
    shapes = [("star", [star(2000, 48)]), ("ring", [square(0, 0, 100), square(30, 30, 10)])]
    shapes += [(f"s{i}-{k}", [square(i * 3.125, k * 3.125, 3)]) for i in range(32) for k in range(32)]
    areas = polygons(spark, shapes).repartition(4)
    at = [(rng.uniform(-5, 105), rng.uniform(-5, 105)) for _ in range(300)]
    at += [(rng.gauss(50, 0.3), rng.gauss(50, 0.3)) for _ in range(300)]  # half of all in one cell
    at += [(3.125 * rng.randrange(33), 3.125 * rng.randrange(33)) for _ in range(60)]  # corners and borders
    at += [(30.0, 35.0), (35.0, 35.0), (0.0, 0.0), (100.0, 100.0), (100.0, 50.0), (50.0, 0.0)]
    points = spark.createDataFrame([(i, (x, y)) for i, (x, y) in enumerate(at)] + [(-1, None)], f"id int, at {geo.XY}")
    got = geo.spatial_join(points, areas, "at", "geom").select("id", "name").collect()
    edges = areas.withColumn("e", geo.edges_of("geom"))
    every = points.join(edges, geo.inside("e", "at"), "left").select("id", "name").collect()
    key = lambda rows: sorted((r.id, r.name or "") for r in rows)
    assert key(got) == key(every) and len(got) > len(at)

    cells = geo.area_cells(areas, "geom")
    assert cells.count() <= 9 * len(shapes) + 9
    of = {r.name: r for r in cells.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_edges").isNull()).alias("whole"), F.sum(F.coalesce(F.size("_edges"), F.lit(0))).alias("edges"),
    ).filter("name IN ('star', 'ring')").collect()}
    assert of["ring"].whole > of["ring"].n / 2 and of["star"].whole > 0
    assert of["star"].edges < 2000 * of["star"].n / 4  # not all edges in every cell


def test_degenerate_extents(spark):
    p = spark.createDataFrame([(1, (0.5, 0.5)), (2, (2.0, 0.5))], f"id int, at {geo.XY}")
    one = geo.spatial_join(p, polygons(spark, [("a", [square(0, 0, 1)])]), "at", "geom")
    assert sorted((r.id, r.name) for r in one.collect()) == [(1, "a"), (2, None)]
    flat = geo.spatial_join(p, polygons(spark, [("line", [[(0, 0.5), (3, 0.5)]])]), "at", "geom")
    assert [r.name for r in flat.collect()] == [None, None]
    none = geo.spatial_join(p, polygons(spark, []), "at", "geom")
    assert [r.name for r in none.collect()] == [None, None]
