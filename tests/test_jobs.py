"""Sources, sinks, the stream, the published documents and the shape of plans."""

import json
import os
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from tests.conftest import SF
from trailsight.functions import fixed
from trailsight.operators import ingest, ranking, scores
from trailsight.plans import catalog, reports, views
from trailsight.sources import tables
from trailsight.streaming import visits as incremental

ORDER = views.REPEATED_ORDER


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_stream_equals_batch_and_replays_change_nothing(spark, tmp_path):
    rows = views.view(spark, SF, "repeated").withColumn("part", F.col("s1") % 5)
    root = str(tmp_path / "t")
    rows.repartition("part").write.partitionBy("part").parquet(f"{root}/landed")
    schema = rows.drop("part").schema
    incremental.run_available(spark, f"{root}/landed", schema, root, ORDER, files_per_batch=2).awaitTermination()
    whole = rows_of(ingest.dedup_visits(rows.drop("part"), ORDER))
    assert len(os.listdir(f"{root}/log")) >= 3
    assert rows_of(incremental.read_visits(spark, root, ORDER)) == whole
    # the same batch once more, and one under a new number
    batch = rows.drop("part").filter("s1 % 5 = 2")
    incremental.append_batch(batch, 0, root, ORDER)
    incremental.append_batch(rows.drop("part"), 900, root, ORDER)
    assert rows_of(incremental.read_visits(spark, root, ORDER)) == whole
    incremental.compact(spark, root, ORDER)
    assert rows_of(incremental.read_visits(spark, root, ORDER)) == whole
    newer = rows.drop("part").limit(10).withColumn("visited", F.lit(date(2030, 1, 1)))
    incremental.append_batch(newer, 901, root, ORDER)
    again = incremental.read_visits(spark, root, ORDER)
    assert again.filter(F.year("visited") == 2030).count() > 0
    assert again.count() == len(whole)


def test_taken_in_items_are_marked(spark, tmp_path):
    rows = views.view(spark, SF, "repeated")
    incremental.append_batch(rows.filter("s1 = 1"), 0, str(tmp_path), ORDER)
    items = views.view(spark, SF, "crawled")
    marked = incremental.mark_crawled(spark, str(tmp_path), items, date(2030, 1, 1))
    taken = {r.gc_code for r in rows.filter("s1 = 1").select("gc_code").distinct().collect()}
    assert {r.code for r in marked.filter("logs_crawled_at = DATE '2030-01-01'").collect()} == taken
    assert marked.count() == items.count()


def test_versions_and_rejects(spark, tmp_path):
    root = str(tmp_path / "v")
    assert tables.current_version(spark, root) is None
    for n in (1, 2):
        target = tables.next_version(spark, root)
        assert target.endswith(f"v{n:08d}")
        tables.write_partitioned(spark.range(n), target)
    os.makedirs(f"{root}/v00000003")  # an unfinished write
    assert tables.current_version(spark, root).endswith("v00000002")
    assert tables.next_version(spark, root).endswith("v00000004")
    for _ in range(2):
        tables.append_rejects(spark.range(3), f"{root}/rejects")
    assert spark.read.json(f"{root}/rejects").count() == 6


def test_older_files_without_new_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t" / "g=1"))
    spark.range(2).withColumn("log_type", F.lit("x")).write.parquet(str(tmp_path / "t" / "g=2"))
    got = tables.read_table(spark, str(tmp_path / "t"), merge_schema=True)
    assert got.filter("log_type IS NULL").count() == 2


def test_geojson_provinces(spark, tmp_path):
    def feature(i, name, kind, coordinates):
        return {"type": "Feature", "id": i, "properties": {"name": name}, "geometry": {"type": kind, "coordinates": coordinates}}

    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [
        feature("420100", "武汉市", "Polygon", [ring]), feature("990000", "nowhere", "MultiPolygon", [[ring], [ring]]),
        feature("130100", "北京", "Polygon", [ring]),
    ]}
    path = tmp_path / "b.json"
    path.write_text(json.dumps(doc, indent=1, ensure_ascii=False), encoding="utf-8")
    features = tables.read_geojson_features(spark, str(path))
    assert {r.name: len(r["shape"]) for r in features.collect()} == {"武汉市": 1, "nowhere": 2, "北京": 1}
    provinces = tables.city_provinces(features, fixed.PROVINCES, fixed.DIRECT_ADMIN_CITIES)
    got = {r.city: r.province for r in provinces.collect()}
    assert got["武汉市"] == "湖北省" and got["北京"] == "北京市" and "nowhere" not in got


def test_published_documents(spark, tmp_path):
    d = catalog.inputs(spark, SF)
    reports.publish(d, str(tmp_path), datetime(2001, 6, 15, 7, 8, 9, 120000, tzinfo=timezone.utc))

    def lines(section):
        folder = tmp_path / section
        return [json.loads(x) for f in sorted(folder.glob("*.json")) for x in f.read_text(encoding="utf-8").splitlines()]

    boards = {r["region"]: r["rankings"] for r in lines("player-rankings/rankings")}
    assert set(boards) == {"all", *views.REGIONS}
    assert set(boards["all"]) == set(scores.PLAYER_TYPES)
    first = boards["all"]["finds"]["all"]
    assert [e["rank"] for e in first] == sorted(e["rank"] for e in first) and 50 <= len(first) <= 100
    assert set(first[0]) == {"rank", "name", "score", "trend", "trendDelta", "avatarUrl"}
    flat = reports.player_board(d, ("finds",), ("all",)).filter("region = 'all'").collect()
    assert {(e["name"], e["rank"]) for e in first} == {(r["name"], r["rank"]) for r in flat}
    items = {r["region"]: r["rankings"] for r in lines("cache-rankings/rankings")}
    assert {"all", "tradition"} <= set(items["all"])
    stats = {r["region"]: r["stats"] for r in lines("cache-rankings/ranking-stats")}
    assert set(stats["all"]) == {"all", *fixed.TYPE_KEYS}
    details = lines("city-rankings/city-details")
    assert all(len(c["dtMatrix"]) == 81 and set(c) == {"city", "averageGrowthPct", "monthly", "yearly", "dtMatrix"} and len(c["monthly"]) == 10 and len(c["yearly"]) == 10 for c in details)
    assert {r["region"]: len(r["dtMatrix"]) for r in lines("overview/dt-matrix")}["all"] == 81
    assert lines("generated-at/stamp") == [{"generatedAt": "2001-06-15T07:08:09.120Z", "version": "1.0.0"}]


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_board_reads_the_visits_once(spark):
    d = catalog.inputs(spark, SF)
    board = reports.player_board(d)
    plan = final_plan(board)
    assert plan.count("l_quantity") and plan.count("FileScan parquet [l_orderkey") == 1
    assert "WindowGroupLimit" in plan


def test_periods_and_columns_reach_the_scan(spark, tmp_path):
    visits = views.view(spark, SF, "visits")
    visits.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    items = views.view(spark, SF, "items")
    rows = scores.player_scores(stored, items, views.AS_OF, ("finds",), ("30d",), views.REGIONS)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(x for x in plan.splitlines() if str(tmp_path) in x)
    assert "GreaterThanOrEqual(visited,2001-04-16)" in scan
    assert "Not(EqualTo(log_type,deleted))" in scan
    assert "favorite_point_used" not in scan and "user_guid" not in scan


def test_results_do_not_depend_on_partitioning(spark):
    d = catalog.inputs(spark, SF)
    once = scores.player_scores(d.visits, d.items, views.AS_OF, ("finds", "logs"), ("ytd",), views.REGIONS)
    other = scores.player_scores(d.visits.repartition(13), d.items.repartition(5), views.AS_OF, ("finds", "logs"), ("ytd",), views.REGIONS)
    groups = ["region", "type", "range"]
    assert rows_of(ranking.leaderboard(once, groups)) == rows_of(ranking.leaderboard(other, groups))


def test_a_dominant_item_and_person(spark):
    """A third of all visits on one item, and many by one person, change nothing but the work."""
    visits = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("GC"), F.col("id") % 500)).alias("gc_code"),
        F.when(F.col("id") % 4 == 0, F.lit("busy")).otherwise(F.concat(F.lit("u"), F.col("id") % 7000)).alias("user_name"),
        F.lit(None).cast("string").alias("user_guid"), F.lit(views.AS_OF).alias("visited"),
        F.lit(True).alias("favorite_point_used"), F.lit(False).alias("is_ftf"), F.lit("Found it").alias("log_type"),
    )
    items = visits.select(F.col("gc_code").alias("code")).distinct().selectExpr(
        "code", "code AS name", "'owner' AS owner_username", "'China' AS country", "'' AS city", "0 AS cache_status",
        "2 AS geocache_type", "DATE '2001-01-02' AS placed_date",
    )
    got = scores.player_scores(visits, items, views.AS_OF, ("finds", "logs", "favorites"), ("all",), {})
    found = {(r.type, r.name): r.score for r in got.filter("score > 300").collect()}
    assert found[("logs", "owner")] == found[("favorites", "owner")] == 30000
    expected = visits.filter("user_name = 'busy'").select("gc_code").distinct().count()
    busy = got.filter("name = 'busy' AND type = 'finds'").first().score
    assert busy == expected
