"""Nearest area of a point, with polygons as rings of vertices and equi-joins only.

Every boundary edge is filed under the grid cells its bounding box touches, on a pyramid of grids
whose cells double in size. A point looks for the finest level at which a *vertex* lies in the
3 x 3 cells around it: the boundary is then at most 2 * sqrt(2) cells away, so the nearest edge
is filed within three cells of the point at that level. The level is found once per occupied cell,
not per point.

Of these edges a cell keeps those that can be nearest to one of its points: the distance from a cell
to an edge is largest at a corner, so the least such distance bounds that of every point, and an edge
whose box is farther from the cell is dropped. A cell that still has many edges is split in four, its
edges are bounded anew for each part that holds points, and so on; where edges are dense the cells
get small, and a point measures few edges however many there are.

Whether a point lies inside is decided separately, by counting the edges a ray to the east crosses,
among the edges of the point's latitude band.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailsight.functions import fixed
from trailsight.functions.scopes import array_of
from trailsight.sources.tables import materialise

CELL = 0.1  # degrees at the finest level
LEVELS = 13  # 0.1 * 2**12 covers the globe
DIGITS = 9  # distances are equal below a billionth of a degree
SLACK = 1e-8  # by which a bound may be missed: more than what rounding makes equal
CROWD = 64  # edges of a cell above which it is split
DEPTH = 16  # times a cell is split at most; many edges through one spot stay together


def polygon_edges(areas: DataFrame) -> DataFrame:
    """(name, shape: parts of rings of points) to one row per edge; rings may be open or closed."""
    rings = areas.select("name", F.explode("shape").alias("part")).select(
        "name", F.explode("part").alias("ring")
    )
    n = F.size("ring")
    return (
        rings.select(
            "name",
            F.explode(
                F.transform(
                    "ring",
                    lambda p, i: F.struct(
                        p["x"].alias("x1"),
                        p["y"].alias("y1"),
                        F.get("ring", (i + 1) % n)["x"].alias("x2"),
                        F.get("ring", (i + 1) % n)["y"].alias("y2"),
                    ),
                )
            ).alias("e"),
        )
        .select("name", "e.*")
        .filter((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))
    )


def _cell(value: str, depth: int = 0) -> str:
    """SQL of the grid index of a coordinate: of the finest grid, or of one split so many times."""
    return f"CAST(floor(({value}) / {CELL / 2**depth!r}D) AS BIGINT)"


def _parent(cell: str, level: str) -> str:
    """SQL of the index, on a coarser level, of a finest-level index."""
    return f"CAST(floor(({cell}) / pow(2.0D, {level})) AS BIGINT)"


def _steps(low: int, high: int) -> Column:
    return F.explode(array_of(range(low, high + 1)))


def _block(cells: DataFrame, reach: int) -> DataFrame:
    """Every cell with the cells around it on its level, as gx and gy."""
    return (
        cells.withColumn("dx", _steps(-reach, reach))
        .withColumn("dy", _steps(-reach, reach))
        .selectExpr(
            "rule",
            "cx",
            "cy",
            "level",
            f"{_parent('cx', 'level')} + dx AS gx",
            f"{_parent('cy', 'level')} + dy AS gy",
        )
    )


_EDGE = ("name", "x1", "y1", "x2", "y2")
_CELL = ("rule", "cx", "cy")


def nearest_area(points: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, name, distance) for points (id, rule, x, y) and edges (rule, name, x1, y1, x2, y2).

    Points match areas of their own ``rule`` only. A point inside an area has distance 0; equal
    distances go to the smaller name. Distances are planar degrees.
    """
    # Coarse cells are derived from fine ones, for points and edges alike, so that both agree.
    placed = points.selectExpr("*", f"{_cell('x')} AS cx", f"{_cell('y')} AS cy")
    found = _inside(placed, edges)
    for at, near in candidates(placed, edges):
        measured = at.join(near, list(_CELL)).select("id", "name", F.round(_distance(), DIGITS).alias("distance"))
        found = found.unionByName(measured)
    return (
        found.groupBy("id")
        .agg(F.min(F.struct("distance", "name")).alias("best"))
        .select("id", "best.name", "best.distance")
    )


def candidates(placed: DataFrame, edges: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Points by cell and the edges that each cell has to measure, once per size of cells."""
    cells = placed.select(*_CELL).distinct()
    near = materialise(_bounded(_near_edges(cells, edges), 0), "near-edges")
    at, out = placed.select("id", "rule", "x", "y", "cx", "cy"), []
    for depth in range(1, DEPTH + 1):
        dense = near.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CROWD).select(*_CELL)
        if dense.isEmpty():
            break
        dense = materialise(dense, "dense-cells")
        out.append((at.join(dense, list(_CELL), "left_anti"), near))
        parts = at.join(dense, list(_CELL), "left_semi").selectExpr(
            "id", "rule", "x", "y", "cx AS px", "cy AS py", f"{_cell('x', depth)} AS cx", f"{_cell('y', depth)} AS cy"
        )
        at = materialise(parts, "split-cells")
        split = at.select("px", "py", *_CELL).distinct()
        parent = near.withColumnsRenamed({"cx": "px", "cy": "py"})
        near = materialise(_bounded(split.join(parent, ["rule", "px", "py"]).drop("px", "py"), depth), "near-edges")
        at = at.drop("px", "py")
    return [*out, (at, near)]


def _near_edges(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Each cell with the edges filed around it, on the finest level that has a vertex near by."""
    levels = _steps(0, LEVELS - 1)
    vertices = (
        edges.selectExpr("rule", f"{_cell('x1')} AS vx", f"{_cell('y1')} AS vy")
        .distinct()
        .withColumn("level", levels)
        .selectExpr(
            "rule", "level", f"{_parent('vx', 'level')} AS gx", f"{_parent('vy', 'level')} AS gy"
        )
        .distinct()
    )
    levelled = (
        _block(cells.withColumn("level", levels), 1)
        .join(vertices, ["rule", "level", "gx", "gy"], "left_semi")
        .groupBy("rule", "cx", "cy")
        .agg(F.min("level").alias("level"))
    )

    def span(axis: str) -> Column:
        low = _parent(_cell(f"least({axis}1, {axis}2)"), "level")
        high = _parent(_cell(f"greatest({axis}1, {axis}2)"), "level")
        return F.expr(f"explode(sequence({low}, {high}))")

    filed = (
        edges.withColumn("level", levels).withColumn("gx", span("x")).withColumn("gy", span("y"))
    )
    return (
        _block(levelled, 3)
        .join(filed, ["rule", "level", "gx", "gy"])
        .select(*_CELL, *_EDGE)
        .distinct()
    )


def _bounded(pairs: DataFrame, depth: int) -> DataFrame:
    """The pairs of a cell and an edge in which the edge may be the nearest of a point of the cell."""
    size = f"{CELL / 2**depth!r}D"
    sides = {"bx1": f"cx * {size}", "bx2": f"(cx + 1) * {size}", "by1": f"cy * {size}", "by2": f"(cy + 1) * {size}"}
    corners = ", ".join(_distance_sql(sides[x], sides[y]) for x in ("bx1", "bx2") for y in ("by1", "by2"))
    apart = lambda a: f"greatest(0.0D, least({a}1, {a}2) - {sides[f'b{a}2']}, {sides[f'b{a}1']} - greatest({a}1, {a}2))"
    bounds = pairs.selectExpr("*", f"greatest({corners}) AS _far", f"{apart('x')} AS _dx", f"{apart('y')} AS _dy")
    least = bounds.groupBy(*_CELL).agg(F.min("_far").alias("_far"))
    kept = bounds.drop("_far").join(least, list(_CELL)).filter(f"sqrt(_dx * _dx + _dy * _dy) <= _far + {SLACK!r}D")
    return kept.select(*_CELL, *_EDGE)


def _distance_sql(x: str, y: str) -> str:
    """Point to segment: the foot of the perpendicular, clamped to the segment."""
    along = f"(({x} - x1) * (x2 - x1) + ({y} - y1) * (y2 - y1))"
    length = "((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
    t = f"greatest(0.0D, least(1.0D, {along} / {length}))"
    dx, dy = f"({x} - (x1 + {t} * (x2 - x1)))", f"({y} - (y1 + {t} * (y2 - y1)))"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def _distance() -> Column:
    return F.expr(_distance_sql("x", "y"))


def _inside(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """Points inside an area: an odd number of its edges crosses the ray to the east."""
    boxes = edges.groupBy("rule", "name").agg(
        F.expr("min(least(x1, x2)) AS bx1"),
        F.expr("max(greatest(x1, x2)) AS bx2"),
        F.expr("min(least(y1, y2)) AS by1"),
        F.expr("max(greatest(y1, y2)) AS by2"),
    )

    def coarse(value: str) -> str:
        # Areas are filed under 0.8 degree cells, edges under the fine latitude bands.
        return _parent(_cell(value), "3")

    covers = boxes.withColumn(
        "gx", F.expr(f"explode(sequence({coarse('bx1')}, {coarse('bx2')}))")
    ).withColumn("gy", F.expr(f"explode(sequence({coarse('by1')}, {coarse('by2')}))"))
    candidates = (
        placed.selectExpr("*", f"{_parent('cx', '3')} AS gx", f"{_parent('cy', '3')} AS gy")
        .join(covers, ["rule", "gx", "gy"])
        .filter("x BETWEEN bx1 AND bx2 AND y BETWEEN by1 AND by2")
        .selectExpr("id", "rule", "name", "x", "y", "cy AS band")
    )
    banded = edges.withColumn(
        "band",
        F.expr(f"explode(sequence({_cell('least(y1, y2)')}, {_cell('greatest(y1, y2)')}))"),
    )
    return (
        candidates.join(banded, ["rule", "name", "band"])
        .filter("(y1 > y) != (y2 > y) AND x < x1 + (y - y1) / (y2 - y1) * (x2 - x1)")
        .groupBy("id", "name")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n % 2 = 1")
        .select("id", "name", F.lit(0.0).alias("distance"))
    )


def in_boxes(points: DataFrame, boxes: DataFrame, key: str = "code") -> DataFrame:
    """The points (key, latitude, longitude) inside at least one box (max_lat, min_lon, min_lat, max_lon), borders
    included; any number of boxes may overlap.

    A box is filed on the grid whose cells are as large as the box, in four cells at most. A point
    looks up its cell on the grids that occur, and a semi join stops at the first box that holds it.
    """
    size = "greatest(max_lat - min_lat, max_lon - min_lon)"
    level = f"CAST(least({LEVELS - 1}, greatest(0, ceil(log2(greatest({size}, {CELL}D) / {CELL}D)))) AS INT)"
    span = lambda low, high: f"explode(sequence({_parent(_cell(low), 'level')}, {_parent(_cell(high), 'level')}))"
    filed = (
        boxes.filter("max_lat >= min_lat AND max_lon >= min_lon")
        .selectExpr("max_lat", "min_lon", "min_lat", "max_lon", f"{level} AS level")
        .withColumn("gx", F.expr(span("min_lon", "max_lon")))
        .withColumn("gy", F.expr(span("min_lat", "max_lat")))
    )
    used = sorted(r[0] for r in filed.select("level").distinct().collect())  # LEVELS numbers at most
    if not used:
        return points.limit(0)
    placed = (
        points.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
        .select(F.col(key).alias("_key"), F.col("latitude").cast("double").alias("_lat"), F.col("longitude").cast("double").alias("_lon"))
        .withColumn("level", F.explode(array_of(used)))
        .withColumn("gx", F.expr(_parent(_cell("_lon"), "level")))
        .withColumn("gy", F.expr(_parent(_cell("_lat"), "level")))
    )
    same = (placed["level"] == filed["level"]) & (placed["gx"] == filed["gx"]) & (placed["gy"] == filed["gy"])
    inside = F.expr("_lat BETWEEN min_lat AND max_lat AND _lon BETWEEN min_lon AND max_lon")
    hit = placed.join(filed, same & inside, "left_semi").select("_key").distinct()
    return points.join(hit, points[key] == hit["_key"], "left_semi")


def assign_cities(
    items: DataFrame,
    edges: DataFrame,
    constants: Mapping[str, str] = fixed.CONSTANT_CITIES,
    special_country: str = "Taiwan",
    special_areas: Sequence[str] = fixed.TAIWAN_COUNTIES,
) -> DataFrame:
    """Items with ``city`` filled in.

    Only items with a position are touched: those without a city, and all of the special country.
    Two countries have one constant city. The special country matches its own areas only and
    nobody else does. A touched item without any matching area ends up without a city.
    """
    is_special = F.col("country").eqNullSafe(special_country)
    blank = F.coalesce(F.trim("city"), F.lit("")) == ""
    placed = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    touched = placed & (blank | is_special)
    constant = None
    for country, city in constants.items():
        cond = F.col("country") == country
        constant = F.when(cond, F.lit(city)) if constant is None else constant.when(cond, F.lit(city))
    constant = F.lit(None).cast("string") if constant is None else constant
    points = items.filter(touched & constant.isNull()).select(
        F.col("code").alias("id"),
        F.when(is_special, F.lit("special")).otherwise(F.lit("rest")).alias("rule"),
        F.col("longitude").cast("double").alias("x"),
        F.col("latitude").cast("double").alias("y"),
    )
    ruled = edges.withColumn(
        "rule", F.when(F.col("name").isin(*special_areas), F.lit("special")).otherwise(F.lit("rest"))
    )
    found = nearest_area(points, ruled).select(F.col("id").alias("code"), F.col("name").alias("_city"))
    new_city = F.when(touched, F.coalesce(constant, F.col("_city"))).otherwise(F.col("city"))
    return items.join(found, "code", "left").select(
        *[new_city.alias("city") if c == "city" else F.col(c) for c in items.columns]
    )
