"""Nearest area against brute force over random polygons."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trailsight.operators import spatial

SHAPE = "name string, shape array<array<array<struct<x:double,y:double>>>>"


def blob(rng, cx, cy, r, n):
    """A star-shaped ring with a wobbling radius."""
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(cx + r * rng.uniform(0.4, 1) * math.cos(t), cy + r * rng.uniform(0.4, 1) * math.sin(t)) for t in turns]


def to_segment(px, py, ax, ay, bx, by):
    ex, ey = bx - ax, by - ay
    t = max(0.0, min(1.0, ((px - ax) * ex + (py - ay) * ey) / (ex * ex + ey * ey)))
    return math.hypot(px - ax - t * ex, py - ay - t * ey)


def distance(shape, px, py):
    inside, best = False, math.inf
    for part in shape:
        for ring in part:
            for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
                best = min(best, to_segment(px, py, ax, ay, bx, by))
                if (ay > py) != (by > py) and px < ax + (py - ay) / (by - ay) * (bx - ax):
                    inside = not inside
    return 0.0 if inside else best


def areas(rng, count, spread):
    out = {}
    for i in range(count):
        cx, cy = rng.uniform(-spread, spread), rng.uniform(-spread, spread)
        shape = [[blob(rng, cx, cy, rng.uniform(0.05, spread / 4), rng.randint(3, 12))]]
        if i % 3 == 0:  # a second part
            shape.append([blob(rng, cx + spread / 3, cy, spread / 20, 5)])
        if i % 4 == 0:  # a square with a hole
            shape = [[[(cx, cy), (cx + 2, cy), (cx + 2, cy + 2), (cx, cy + 2)], [(cx + 0.5, cy + 0.5), (cx + 1.5, cy + 0.5), (cx + 1.5, cy + 1.5), (cx + 0.5, cy + 1.5)]]]
        out[f"a{i:02d}"] = shape
    return out


@pytest.mark.parametrize("seed, spread", [(1, 1.0), (2, 10.0), (3, 80.0)])
def test_nearest_equals_brute_force(spark, seed, spread):
    rng = random.Random(seed)
    shapes = areas(rng, 14, spread)
    points = [(i, rng.uniform(-2 * spread, 2 * spread), rng.uniform(-spread, spread)) for i in range(250)]
    rows = [(n, [[[{"x": x, "y": y} for x, y in r] for r in p] for p in s]) for n, s in shapes.items()]
    edges = spatial.polygon_edges(spark.createDataFrame(rows, SHAPE)).withColumn("rule", F.lit("r"))
    frame = spark.createDataFrame(points, "id int, x double, y double").withColumn("rule", F.lit("r"))
    got = {r.id: (r.name, r.distance) for r in spatial.nearest_area(frame, edges).collect()}
    assert len(got) == len(points)
    for i, x, y in points:
        want = min((round(distance(s, x, y), 9), n) for n, s in shapes.items())
        assert (got[i][1], got[i][0]) == pytest.approx(want[0], abs=2e-9) or abs(got[i][1] - want[0]) < 2e-9
        assert got[i][0] == want[1] or abs(distance(shapes[got[i][0]], x, y) - want[0]) < 2e-9


def test_city_rules(spark):
    square = lambda x: [[[{"x": x, "y": 0.0}, {"x": x + 1.0, "y": 0.0}, {"x": x + 1.0, "y": 1.0}, {"x": x, "y": 1.0}]]]
    edges = spatial.polygon_edges(spark.createDataFrame([("plain", square(0.0)), ("臺北市", square(5.0))], SHAPE))
    schema = "code string, country string, city string, latitude double, longitude double"
    items = spark.createDataFrame(
        [
            ("hk", "Hong Kong", "", 0.5, 0.5), ("tw", "Taiwan", "old", 0.5, 0.5), ("cn", "China", None, 0.5, 5.5),
            ("kept", "China", "kept", 0.5, 0.5), ("nowhere", "China", " ", None, None), ("null", None, None, 0.5, 5.5),
        ],
        schema,
    )
    got = {r.code: r.city for r in spatial.assign_cities(items, edges).collect()}
    assert got == {"hk": "香港", "tw": "臺北市", "cn": "plain", "kept": "kept", "nowhere": " ", "null": "plain"}


def pairs_and_points(spark, rows, points):
    edges = spatial.polygon_edges(spark.createDataFrame(rows, SHAPE)).withColumn("rule", F.lit("r"))
    frame = spark.createDataFrame(points, "id int, x double, y double").withColumn("rule", F.lit("r"))
    placed = frame.selectExpr("*", f"{spatial._cell('x')} AS cx", f"{spatial._cell('y')} AS cy")
    return frame, edges, sum(at.join(near, ["rule", "cx", "cy"]).count() for at, near in spatial.candidates(placed, edges))


def test_a_dense_boundary_is_measured_in_small_part(spark):
    """10,000 edges within one cell: a point measures under 1 % of them."""
    rng, n = random.Random(7), 10_000
    turn = lambda k: (0.55 + (0.03 + 0.003 * math.sin(40 * k)) * math.cos(k), 0.55 + (0.03 + 0.003 * math.sin(40 * k)) * math.sin(k))
    ring = [turn(2 * math.pi * k / n) for k in range(n)]
    assert all(0.5 < x < 0.6 and 0.5 < y < 0.6 for x, y in ring)
    points = [(i, rng.uniform(0.5, 0.6), rng.uniform(0.5, 0.6)) for i in range(300)]
    rows = [("a", [[[{"x": x, "y": y} for x, y in ring]]])]
    frame, edges, pairs = pairs_and_points(spark, rows, points)
    assert pairs < len(points) * n / 100
    got = {r.id: r.distance for r in spatial.nearest_area(frame, edges).collect()}
    for i, x, y in points[:60]:
        assert abs(got[i] - distance([[ring]], x, y)) < 2e-9


def test_many_edges_through_one_spot(spark):
    """Edges that no split parts from each other, and names that tie there."""
    fan = [(f"f{k:03d}", [[[{"x": 0.05, "y": 0.05}, {"x": 0.05 + math.cos(k / 30), "y": 0.05 + math.sin(k / 30)}, {"x": 0.05 + math.cos(k / 30 + 0.001), "y": 0.05 + math.sin(k / 30 + 0.001)}]]]) for k in range(90)]
    frame, edges, _ = pairs_and_points(spark, fan, [(1, 0.05, 0.05), (2, 0.04999, 0.05), (3, -3.0, 0.05)])
    got = {r.id: r for r in spatial.nearest_area(frame, edges).collect()}
    assert got[1].name == "f000" and got[1].distance == 0
    for i, x, y in ((2, 0.04999, 0.05), (3, -3.0, 0.05)):
        want = min((round(distance([[[(p["x"], p["y"]) for p in r] for r in s[0]]], x, y), 9), n) for n, s in fan)
        assert (got[i].distance, got[i].name) == want
