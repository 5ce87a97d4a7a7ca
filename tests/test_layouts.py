"""Stored layouts that queries make use of, boxes as a table, and landed pages that drift."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from trailsight.operators import ingest, scores, spatial, summary
from trailsight.plans import catalog, views
from trailsight.sources import tables


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def spoil(root, keep):
    for d in os.listdir(root):
        if d.startswith("_range=") and d not in keep:
            for f in os.listdir(f"{root}/{d}"):
                with open(f"{root}/{d}/{f}", "wb") as out:
                    out.write(b"spoiled")


@pytest.mark.parametrize(("offset", "size"), [(0, 1), (0, 7), (95, 10), (99, 1), (1000, 10), (1990, 50), (1999, 1), (2000, 5), (9999, 3)])
def test_any_page_opens_its_folders_only(spark, tmp_path, offset, size):
    rng = random.Random(3)
    codes = [f"GC{i:05d}" for i in range(2000)]
    rng.shuffle(codes)
    root = str(tmp_path / "t")
    tables.write_pages(spark.createDataFrame([(c, len(c)) for c in codes], "code string, n int"), root, ["code"], 100)
    counts = {r["_range"]: r["n"] for r in spark.read.parquet(f"{root}/counts").collect()}
    assert sum(counts.values()) == 2000 and len(counts) > 10
    near, before = set(), 0
    for k in sorted(counts):
        if before < offset + size and before + counts[k] > offset:
            near.add(f"_range={k}")
        before += counts[k]
    assert size > 20 or len(near) <= 2
    if near:
        spoil(f"{root}/rows", near)
    got = [r["code"] for r in tables.read_page(spark, root, ["code"], offset, size).collect()]
    assert got == sorted(codes)[offset : offset + size]


def test_bucketed_tables_join_without_a_shuffle(spark):
    d = catalog.co_located(spark, SF, 4)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for frame in (
            scores.item_scores(d.visits, d.items, views.AS_OF),
            scores.collapse_visits(d.visits, ["gc_code", "user_name"], ["visits"], ("all",), catalog.Clock(views.AS_OF)).join(scores.slim_items(d.items), "gc_code"),
        ):
            plan = final_plan(frame)
            assert "Join" in plan and "Exchange" not in plan
        metrics = final_plan(summary.scope_metrics(d.visits, d.items, d.regions))
        below = [x for x in metrics.splitlines() if "Join [gc_code" in x]
        at = metrics.index(below[0])
        indent = len(below[0]) - len(below[0].lstrip(" :+-"))
        under = []
        for line in metrics[at:].splitlines()[1:]:
            if len(line) - len(line.lstrip(" :+-")) <= indent:
                break
            under.append(line)
        assert len(under) > 5 and not any("Exchange" in x for x in under)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_many_overlapping_boxes(spark):
    rng = random.Random(5)
    boxes = []
    for _ in range(10_000):
        x, y, w, h = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([0, 0.001, 0.05, 0.2]), rng.choice([0, 0.001, 0.05, 0.2])
        boxes.append((y + h, x, y, x + w))
    boxes += [(90.0, -180.0, 60.0, 180.0), (1.0, 5.0, 2.0, 6.0), (None, 1.0, 2.0, 3.0), (10.0, 20.0, 10.0, 20.0)] + [(-60.0, -170.0, -61.0, -169.0)] * 500
    points = [(f"p{i}", rng.uniform(-60, 65), rng.uniform(-60, 60)) for i in range(1500)]
    points += [("corner", boxes[0][0], boxes[0][1]), ("dot", 10.0, 20.0), ("none", None, 1.0), ("many", -60.5, -169.5), ("flipped", 1.5, 5.5)]
    frame = spark.createDataFrame(points, "code string, latitude double, longitude double").withColumn("level", F.lit(1))
    table = spark.createDataFrame(boxes, "max_lat double, min_lon double, min_lat double, max_lon double")
    rows = spatial.in_boxes(frame, table)
    got = [r["code"] for r in rows.collect()]
    want = {c for c, y, x in points if y is not None and any(b[0] is not None and b[2] <= y <= b[0] and b[1] <= x <= b[3] for b in boxes)}
    assert len(got) == len(set(got)) and set(got) == want and {"corner", "dot", "many"} <= want and len(want) > 50
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert spatial.in_boxes(frame, table.limit(0)).count() == 0


def pages_with(spark, items):
    import json

    bodies = [(json.dumps({"pageProps": {"searchResults": {"total": len(items), "results": items}}}),), ("{no page",), (None,), ("[]",)]
    return spark.createDataFrame(bodies, "body string")


def test_unknown_fields_are_reported_and_kept(spark):
    pages = pages_with(spark, [
        {"code": "a", "name": "A", "rank": 1, "tags": ["x"]}, {"code": "b", "rank": "high"}, {"code": "c", "size": 1}, {"code": "d", "size": 2.5, "deep": {"k": [1, None]}},
        {"code": "", "rank": 9}, {"code": "e", "rank": None},
    ])
    found = {r["field"]: (r["type"], r["items"]) for r in ingest.unknown_fields(pages).collect()}
    assert {k: v[1] for k, v in found.items()} == {"rank": 4, "tags": 1, "size": 2, "deep": 1}
    assert found["size"][0].startswith("DECIMAL") and found["rank"][0] == "VARIANT" and found["tags"][0] == "ARRAY<STRING>"
    extra = {r["code"]: r["extra"] for r in ingest.flatten_extra(pages).collect()}
    assert extra == {"a": '{"rank":1,"tags":["x"]}', "b": '{"rank":"high"}', "c": '{"size":1}', "d": '{"deep":{"k":[1,null]},"size":2.5}', "e": '{"rank":null}'}
    items = ingest.flatten_items(pages, None, None).select("code")
    both = ingest.with_extra(items, ingest.flatten_extra(pages), {"rank": ("rank", "int", 0), "first_tag": ("tags", "array<string>", None), "size": ("size", "double", None)})
    got = {r["code"]: (r["rank"], r["first_tag"], r["size"]) for r in both.collect()}
    assert got == {"a": (1, ["x"], None), "b": (0, None, None), "c": (0, None, 1.0), "d": (0, None, 2.5), "e": (0, None, None)}


def test_a_large_table_gets_larger_folders(spark, tmp_path, monkeypatch):
    """Each folder is a task and a report to the driver: their number must not grow without end."""
    monkeypatch.setattr(tables, "MOST_RANGES", 6)
    rows = spark.range(500).selectExpr("concat('GC', lpad(id, 4, '0')) AS code", "id AS n")
    root = str(tmp_path / "t")
    tables.write_pages(rows, root, ["code"], 10)
    counts = [r["n"] for r in spark.read.parquet(f"{root}/counts").collect()]
    assert len(counts) <= 6 and sum(counts) == 500
    for offset, size in ((0, 3), (77, 30), (498, 10)):
        got = [r["n"] for r in tables.read_page(spark, root, ["code"], offset, size).collect()]
        assert got == list(range(500))[offset : offset + size]


def test_buckets_grow_with_the_larger_table(spark, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 500)
    d = catalog.co_located(spark, SF, 4)
    wanted = -(-max(d.visits.count(), d.items.count()) // 500)
    assert wanted > 4 and tables.bucket_count(4, d.visits, d.items) == wanted and tables.bucket_count(10**6, d.items) == 10**6
    for frame in (d.visits, d.items):
        assert 0.9 * wanted < len(frame.inputFiles()) <= wanted  # a file a bucket, if any row falls in it
    plain = catalog.inputs(spark, SF)
    assert summary.scope_metrics(d.visits, d.items, d.regions).exceptAll(summary.scope_metrics(plain.visits, plain.items, plain.regions)).count() == 0
