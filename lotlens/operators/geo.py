"""Geometry on coordinate arrays, and a point-in-polygon join.

A point is struct<x, y>, a ring an array of points, a polygon an array of rings
(first the outer one, then holes).  A geometry column is a struct of kind,
point and polygons; one of the last two is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, let

XY = "struct<x:double,y:double>"
POLYGONS = f"array<array<array<{XY}>>>"
GEOMETRY = f"struct<kind:string,point:{XY},polygons:{POLYGONS}>"


def _edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a ring, the last joined to the first."""
    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _fold(items: Column, start: list[Column], step) -> Column:
    names = [f"s{i}" for i in range(len(start))]
    zero = F.struct(*[c.alias(n) for c, n in zip(start, names)])
    return F.aggregate(
        items, zero, lambda acc, e: F.struct(*[c.alias(n) for c, n in zip(step([acc[n] for n in names], e), names)])
    )


def _ring_moments(ring: Column) -> Column:
    """Area and first moments of a ring, positive whatever its direction."""
    o = F.get(ring, F.lit(0))  # coordinates relative to one vertex keep the products small

    def step(acc, e):
        ax, ay, bx, by = e["a"]["x"] - o["x"], e["a"]["y"] - o["y"], e["b"]["x"] - o["x"], e["b"]["y"] - o["y"]
        cross = ax * by - bx * ay
        return [acc[0] + cross, acc[1] + (ax + bx) * cross, acc[2] + (ay + by) * cross]

    m = _fold(_edges(ring), [F.lit(0.0)] * 3, step)
    s = F.when(m["s0"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    a = m["s0"] * s / 2
    return F.struct(a.alias("a"), (m["s1"] * s / 6 + o["x"] * a).alias("mx"), (m["s2"] * s / 6 + o["y"] * a).alias("my"))


def polygons_centroid(polygons: Column) -> Column:
    """Area centroid; the first ring of a polygon adds, its holes subtract."""
    sign = lambda i: F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    parts = F.flatten(
        F.transform(polygons, lambda poly: F.transform(
            poly, lambda r, i: F.struct(sign(i).alias("w"), _ring_moments(r).alias("m"))))
    )
    t = _fold(parts, [F.lit(0.0)] * 3, lambda acc, p: [acc[k] + p["w"] * p["m"][n] for k, n in enumerate(("a", "mx", "my"))])
    return F.struct(F.try_divide(t["s1"], t["s0"]).alias("x"), F.try_divide(t["s2"], t["s0"]).alias("y"))


def centroid(geom: Column | str) -> Column:
    """Centroid of a polygon, a point itself."""
    g = col(geom)
    return F.when(g["polygons"].isNull(), g["point"]).otherwise(polygons_centroid(g["polygons"]))


def polygon(*rings: Column) -> Column:
    """Geometry of one polygon: outer ring, then holes."""
    return F.struct(
        F.lit("Polygon").alias("kind"), F.lit(None).cast(XY).alias("point"),
        F.array(F.array(*rings)).cast(POLYGONS).alias("polygons"),
    )


def point(x: Column, y: Column) -> Column:
    p = F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.struct(F.lit("Point").alias("kind"), p.alias("point"), F.lit(None).cast(POLYGONS).alias("polygons"))


def bbox(polygons: Column) -> Column:
    outer = F.flatten(F.transform(polygons, lambda poly: F.get(poly, F.lit(0))))
    xs, ys = F.transform(outer, lambda p: p["x"]), F.transform(outer, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")
    )


def edges_of(geom: Column | str) -> Column:
    """All edges of all rings of a polygon geometry."""
    return F.flatten(F.transform(F.flatten(col(geom)["polygons"]), _edges))


def inside(edges: Column | str, p: Column | str) -> Column:
    """Point strictly inside (even-odd over all rings, so holes count); the boundary is outside."""
    p = col(p)
    px, py = p["x"], p["y"]

    def step(acc, e):
        a, b = e["a"], e["b"]
        spans = (a["y"] > py) != (b["y"] > py)
        cut = a["x"] + (py - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        cross = (b["x"] - a["x"]) * (py - a["y"]) - (b["y"] - a["y"]) * (px - a["x"])
        on_edge = (
            (cross == 0) & (px >= F.least(a["x"], b["x"])) & (px <= F.greatest(a["x"], b["x"]))
            & (py >= F.least(a["y"], b["y"])) & (py <= F.greatest(a["y"], b["y"]))
        )
        return [acc[0] != (spans & F.coalesce(px < cut, F.lit(False))), acc[1] | on_edge]

    return let(_fold(col(edges), [F.lit(False), F.lit(False)], step), lambda s: s["s0"] & ~s["s1"])


def contains(geom: Column | str, p: Column | str) -> Column:
    return inside(edges_of(geom), p)


def _cell(value: Column, grid: Column, axis: str) -> Column:
    lo, hi = grid[f"{axis}0"], grid[f"{axis}1"]
    return F.coalesce(F.floor((value - lo) / F.nullif(hi - lo, F.lit(0.0)) * grid[f"n{axis}"]), F.lit(0))


def cell_grid(areas: DataFrame, geom: str) -> Column:
    """Extent of the areas and its number of cells per axis: cells as large as the areas' root mean square width and height."""
    boxed = areas.select(bbox(F.col(f"{geom}.polygons")).alias("_box"))
    size = lambda a, b: F.col(f"_box.{b}") - F.col(f"_box.{a}")
    steps = lambda a, b: F.coalesce(F.greatest(F.lit(1), F.ceil(
        (F.max(f"_box.{b}") - F.min(f"_box.{a}")) / F.nullif(F.sqrt(F.avg(size(a, b) * size(a, b))), F.lit(0.0)))), F.lit(1))
    return boxed.select(F.struct(
        F.min("_box.x0").alias("x0"), F.min("_box.y0").alias("y0"), F.max("_box.x1").alias("x1"), F.max("_box.y1").alias("y1"),
        steps("x0", "x1").alias("nx"), steps("y0", "y1").alias("ny"),
    )).scalar()


def area_cells(areas: DataFrame, geom: str, grid: Column | None = None) -> DataFrame:
    """Each area once per cell it meets: `_cx`, `_cy`, and `_edges`, NULL where the cell lies wholly inside.

    A cell that an edge may meet carries the edges of its row of cells: only those can decide a horizontal ray, so the
    test over them gives what the test over all edges gives. In a cell that no edge meets all points lie alike; its centre
    tells whether the cell is inside and goes without edges, or outside and is left out. Edges and points get their cell
    from the same monotone function, so rounding cannot part a point from an edge beside it.
    """
    g, e = F.col("_g"), F.col(f"{geom}.polygons")
    across = lambda axis, q: F.struct(
        _cell(F.least(q["a"][axis], q["b"][axis]), g, axis).alias("lo"), _cell(F.greatest(q["a"][axis], q["b"][axis]), g, axis).alias("hi"))
    rows = areas.withColumns({"_g": cell_grid(areas, geom) if grid is None else grid, "_box": bbox(e)}).withColumn("_all", F.transform(
        edges_of(geom), lambda q: F.struct(q["a"].alias("a"), q["b"].alias("b"), across("x", q).alias("x"), across("y", q).alias("y"))))
    touched = lambda axis: F.sequence(_cell(F.col(f"_box.{axis}0"), g, axis), _cell(F.col(f"_box.{axis}1"), g, axis))
    bands = rows.select("*", F.explode(touched("y")).alias("_cy")).withColumn(
        "_band", F.filter("_all", lambda q: (q["y"]["lo"] <= F.col("_cy")) & (q["y"]["hi"] >= F.col("_cy")))).drop("_all")
    middle = lambda axis, c: g[f"{axis}0"] + (c + 0.5) / g[f"n{axis}"] * (g[f"{axis}1"] - g[f"{axis}0"])
    centre = lambda cx: F.struct(middle("x", cx).alias("x"), middle("y", F.col("_cy")).alias("y"))
    seen = F.transform(touched("x"), lambda cx: F.struct(
        cx.alias("_cx"), F.exists("_band", lambda q: (q["x"]["lo"] <= cx) & (q["x"]["hi"] >= cx)).alias("met"), inside("_band", centre(cx)).alias("whole")))
    cells = bands.withColumn("_edge_pairs", F.transform("_band", lambda q: F.struct(q["a"].alias("a"), q["b"].alias("b"))))
    cells = cells.withColumn("_c", F.explode(F.filter(seen, lambda c: c["met"] | c["whole"])))
    return cells.select(*areas.columns, "_box", "_cy", "_c._cx", F.when(F.col("_c.met"), F.col("_edge_pairs")).alias("_edges"))


def spatial_join(points: DataFrame, areas: DataFrame, at: str, geom: str) -> DataFrame:
    """Left join of points to the areas containing them; a point in two areas appears twice.

    Cells are as large as the areas' root mean square width and height: the areas together touch at most nine times as
    many cells as there are areas, however unequal they are.  A point has one cell, an area one row per
    cell it meets (`area_cells`): the join is an equi join on the cell (broadcast when the
    areas are small, split by skew handling when a cell is crowded), and the exact test reads the edges of the cell's
    row, or none in a cell inside the area. The geometry itself travels only where the caller keeps it.
    """
    grid = cell_grid(areas, geom)
    a = area_cells(areas, geom, grid).withColumnsRenamed({c: f"_a_{c}" for c in areas.columns if c in points.columns})
    x, y, g = F.col(f"{at}.x"), F.col(f"{at}.y"), F.col("_g")
    p = points.withColumn("_g", grid).withColumns({
        "_px": F.when(x.isNotNull(), _cell(x, g, "x")), "_py": F.when(y.isNotNull(), _cell(y, g, "y")),
    }).drop("_g")
    in_box = (x >= F.col("_box.x0")) & (x <= F.col("_box.x1")) & (y >= F.col("_box.y0")) & (y <= F.col("_box.y1"))
    exact = F.col("_edges").isNull() | inside("_edges", at)
    on = (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")) & in_box & exact
    return p.join(a, on, "left").drop("_px", "_py", "_cx", "_cy", "_box", "_edges")
