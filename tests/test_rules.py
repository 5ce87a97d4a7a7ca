"""Rules that are easy to get wrong, on small frames with answers worked out by hand."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from trailsight.functions import fixed, pages, scopes, text
from trailsight.functions.periods import Clock, compound_growth_pct, growth_pct, months_before
from trailsight.operators import grid, ingest, merge, ranking, scores, summary, trends, users
from trailsight.sources import tables

DAY = date(2024, 6, 15)
ITEM = """code string, name string, owner_username string, owner_guid string, city string, country string,
 cache_status int, geocache_type int, difficulty double, terrain double, favorite_points int,
 latitude double, longitude double, premium_only boolean, placed_date date"""
VISIT = """gc_code string, user_name string, user_guid string, visited date, favorite_point_used boolean,
 is_ftf boolean, log_type string"""
BASE = dict(
    code="GC1", name="n", owner_username="Olga", owner_guid="o", city="Town", country="China",
    cache_status=0, geocache_type=2, difficulty=1.0, terrain=1.0, favorite_points=1,
    latitude=1.0, longitude=1.0, premium_only=False, placed_date=date(2020, 1, 1),
)
VISITED = dict(
    gc_code="GC1", user_name="Uma", user_guid="u", visited=DAY, favorite_point_used=False,
    is_ftf=False, log_type="Found it",
)


def items(spark, *rows):
    return spark.createDataFrame([{**BASE, **r} for r in rows], ITEM)


def visits(spark, *rows):
    return spark.createDataFrame([{**VISITED, **r} for r in rows], VISIT)


def as_set(frame, *columns):
    return {tuple(r) for r in frame.select(*columns).collect()}


def test_null_status_counts_in_scope_but_not_in_trend(spark):
    i = items(spark, dict(cache_status=None), dict(code="GC2", cache_status=2), dict(code="GC3"))
    assert i.filter(scopes.ranked()).count() == 3
    assert i.filter(scopes.active()).count() == 2
    year = {r.year: r for r in trends.yearly_trend(i, DAY, {}).collect()}["2020"]
    assert (year.total, year.archived, year.ytd_cache) == (1, 1, 3)


def test_null_type_and_null_visit_type_drop_out(spark):
    i = items(spark, dict(geocache_type=None), dict(code="GC2", geocache_type=6))
    assert i.filter(scopes.ranked()).count() == 0
    assert i.filter(scopes.event()).count() == 1
    v = visits(spark, dict(log_type=None), dict(log_type="deleted"), dict())
    assert v.filter(scopes.visit_valid()).count() == 1


def test_periods():
    clock = Clock(DAY)
    assert clock.bounds("30d") == (date(2024, 5, 16), None)
    assert clock.bounds("30d", True) == (date(2024, 4, 16), date(2024, 5, 16))
    assert clock.bounds("ytd", True) == (date(2023, 1, 1), date(2024, 1, 1))
    assert clock.bounds("active", True) == (None, date(2024, 1, 1))
    assert months_before(date(2024, 2, 29), 12) == date(2023, 2, 28)
    assert months_before(date(2024, 3, 31), 1) == date(2024, 2, 29)
    with pytest.raises(ValueError):
        clock.bounds("week")


def test_future_visits_count_in_rankings_but_not_in_the_yearly_heatmap(spark):
    i, v = items(spark, {}), visits(spark, dict(visited=date(2024, 12, 1)))
    got = scores.player_scores(v, i, DAY, ("finds",), ("30d",), {})
    assert as_set(got, "name", "score") == {("Uma", 1)}
    assert grid.heatmap(v, i, DAY, "ytd", {}).count() == 0
    assert grid.heatmap(v, i, DAY, "30d", {}).count() == 1


def test_leap_year_moves_the_same_day_mark(spark):
    # 2024-06-15 is day 166 after 1 January; in 2023 that is 2023-06-16.
    i = items(spark, dict(placed_date=date(2023, 6, 16)), dict(code="GC2", placed_date=date(2023, 6, 17)))
    year = {r.year: r for r in trends.yearly_trend(i, DAY, {}).collect()}["2023"]
    assert (year.total, year.ytd_cache) == (2, 1)


def test_early_years_show_as_zero_for_every_region(spark):
    i = items(spark, dict(placed_date=date(2022, 1, 1), country="Taiwan"), dict(code="GC2", placed_date=date(2023, 5, 5)))
    got = trends.yearly_trend(i, DAY, {"china": "China"})
    china = {r.year: r.total for r in got.filter("region = 'china'").collect()}
    assert china == {"2022": 0, "2023": 1, "2024": 0}


def loop_ranking(rows, limit):
    """Ties share a rank; keep up to limit rows plus ties, out of the first 2 x limit."""
    rows = sorted((r for r in rows if r[1] > 0), key=lambda r: (-r[1], r[0]))[: 2 * limit]
    out = []
    for n, (name, score) in enumerate(rows):
        rank = next((o[2] for o in out if o[1] == score), n + 1)
        if len(out) < limit or out[-1][1] == score:
            out.append((name, score, rank))
    return set(out)


@pytest.mark.parametrize("seed", range(4))
def test_tied_top_lists_equal_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    data = {g: [(f"n{i}", rng.randint(0, 6)) for i in range(rng.randint(1, 60))] for g in "abcde"}
    frame = spark.createDataFrame([(g, n, s) for g, rows in data.items() for n, s in rows], "g string, name string, score int")
    for limit in (1, 3, 10):
        got = ranking.top_with_ties(frame, ["g"], ["name"], limit)
        expected = {(g, *row) for g, rows in data.items() for row in loop_ranking(rows, limit)}
        assert as_set(got, "g", "name", "score", "rank") == expected


def test_movement_is_against_the_full_previous_list(spark):
    rows = [("g", f"n{i:02d}", 100 - i, i + 1) for i in range(20)]  # order reversed before
    rows += [("g", "fresh", 200, 0)]
    frame = spark.createDataFrame(rows, "g string, name string, score int, prev_score int")
    got = {r.name: (r.rank, r.trend, r.trend_delta) for r in ranking.leaderboard(frame, ["g"], limit=3).collect()}
    assert got == {"fresh": (1, "up", None), "n00": (2, "up", 18), "n01": (3, "up", 16)}


def test_histogram_ranks_equal_rank(spark):
    rng = random.Random(1)
    rows = [(g, f"n{i}", rng.randint(0, 9), rng.randint(0, 9)) for g in "ab" for i in range(100)]
    frame = spark.createDataFrame(rows, "g string, name string, score int, prev_score int")
    for r in ranking.score_histogram(frame, ["g"]).collect():
        column = 2 if r.side == "cur" else 3
        assert r["rank"] == 1 + sum(x[0] == r.g and x[column] > r.score for x in rows)
        assert r.n == sum(x[0] == r.g and x[column] == r.score for x in rows)


def test_a_city_in_two_countries_takes_its_worst_previous_rank(spark):
    i = items(
        spark,
        dict(placed_date=date(2020, 1, 1)), dict(code="GC2"), dict(code="GC3"),
        dict(code="GC4", country="Taiwan"), dict(code="GC5", city="Other"), dict(code="GC6", city="Other"),
    )
    rows = scores.city_scores(visits(spark), i, DAY, ("hides",), ("all",))
    board = ranking.leaderboard(rows, ["type", "range"], extra=["country"], tie_order=["country"], key_repeats=True)
    got = as_set(board, "name", "country", "rank", "trend", "trend_delta")
    # before: Town/China 3, Other 2, Town/Taiwan 1 -> ranks 1, 2, 3; "Town" counts as 3.
    assert got == {("Town", "China", 1, "up", 2), ("Other", "China", 2, "flat", 0), ("Town", "Taiwan", 3, "flat", 0)}


def test_all_is_the_sum_of_countries_and_holds_unknown_ones(spark):
    i = items(spark, {}, dict(code="GC2", country="Taiwan"), dict(code="GC3", country=None))
    v = visits(spark, {}, dict(gc_code="GC2"), dict(gc_code="GC3"), dict(gc_code="GC3"))
    got = scores.player_scores(v, i, DAY, ("finds",), ("all",), {"china": "China", "taiwan": "Taiwan"})
    assert as_set(got, "region", "score") == {("all", 3), ("china", 1), ("taiwan", 1)}


def test_what_each_score_counts(spark):
    i = items(spark, {}, dict(code="GC2", owner_username="[DELETED_USER]"))
    v = visits(
        spark,
        dict(is_ftf=True, favorite_point_used=True), {},
        dict(user_name="OLGA", favorite_point_used=True), dict(user_name="", user_guid=None),
        dict(user_name=None, favorite_point_used=True), dict(gc_code="GC2"), dict(log_type="deleted"),
    )
    got = scores.player_scores(v, i, DAY, ranges=("all",), regions={})
    assert as_set(got, "type", "name", "score") == {
        ("finds", "Uma", 2), ("finds", "OLGA", 1), ("ftf", "Uma", 1),
        ("hides", "Olga", 1), ("logs", "Olga", 3), ("favorites", "Olga", 3),
    }
    cities = scores.city_scores(v, i, DAY, ranges=("all",))
    assert as_set(cities, "type", "score") == {("hides", 2), ("finds", 6), ("logs", 6), ("favorites", 3)}
    with pytest.raises(ValueError):
        scores.city_scores(v, i, DAY, ("ftf",))


def test_the_subset_of_types_does_not_change_a_score(spark):
    i = items(spark, {}, dict(code="GC2", cache_status=2, geocache_type=3))
    v = visits(spark, dict(is_ftf=True), dict(gc_code="GC2", favorite_point_used=True), dict(user_name="Bo", visited=date(2023, 3, 3)))
    whole = scores.player_scores(v, i, DAY, regions={})
    for kind in scores.PLAYER_TYPES:
        for rng in fixed.RANGES:
            part = scores.player_scores(v, i, DAY, (kind,), (rng,), {})
            same = whole.filter((F.col("type") == kind) & (F.col("range") == rng))
            assert as_set(part, *whole.columns) == as_set(same, *whole.columns), (kind, rng)


def test_two_spellings_of_a_new_user_do_not_double_the_score(spark):
    i = items(spark, {}, dict(code="GC2"))
    u = spark.createDataFrame(
        [("OLGA", date(2024, 1, 1)), ("olga", date(2024, 2, 1)), ("old", date(2023, 1, 1))],
        "user_name string, registration_date date",
    )
    got = scores.newbie_scores(visits(spark), i, u, DAY, ("hides",), {})
    assert as_set(got, "name", "score", "prev_score") == {("Olga", 2, 0)}


def test_event_previous_is_everything_before_this_year(spark):
    i = items(spark, dict(geocache_type=6, placed_date=date(2019, 1, 1)), dict(code="GC2", geocache_type=13, placed_date=date(2023, 1, 1)), dict(code="GC3", geocache_type=6, placed_date=DAY))
    v = visits(spark, dict(log_type="Attended"), dict(log_type="Attended", visited=date(2021, 1, 1)), dict(gc_code="GC2"))
    got = scores.event_scores(v, i, DAY, regions={})
    assert as_set(got, "type", "name", "score", "prev_score") == {("hosts", "Olga", 3, 2), ("participants", "Uma", 1, 1)}
    window = scores.event_scores(v, i, DAY, ("hosts",), {}, previous_window=True)
    assert as_set(window, "score", "prev_score") == {(3, 1)}


def test_growth_without_a_previous_population(spark):
    one = spark.range(1)
    row = one.select(
        growth_pct(F.lit(5), F.lit(0), 0.0).alias("a"), growth_pct(F.lit(5), F.lit(0), None).alias("b"),
        growth_pct(F.lit(2401), F.lit(2400), None).alias("c"), growth_pct(F.lit(1003), F.lit(2000), None).alias("d"),
        compound_growth_pct(F.lit(0), F.lit(4), 9).alias("e"), compound_growth_pct(F.lit(1), F.lit(512), 9).alias("f"),
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e, row.f) == (0.0, None, 0.0, round((1003 - 2000) / 2000 * 100, 1), 0.0, 100.0)


def test_rounding_equals_python(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 4000), rng.randint(1, 4000)) for _ in range(20000)]
    # Denominators that divide 2000 give values that print as ties.
    pairs += [(rng.randint(0, 5000), rng.choice([400, 1000, 2000, 4000])) for _ in range(20000)]
    got = spark.createDataFrame(pairs, "n int, b int").select("n", "b", growth_pct(F.col("n"), F.col("b"), None).alias("g"))
    assert all(r.g == round((r.n - r.b) / r.b * 100, 1) for r in got.collect())


def test_stats_show_empty_groups(spark):
    rows = spark.createDataFrame([("all", "x", "n", 1, 2), ("all", "x", "m", 0, 2)], "region string, type string, name string, score int, prev_score int")
    got = ranking.population_stats(rows, {"region": ["all", "china"], "type": ["x"]}, None)
    assert as_set(got, "region", "player_count", "player_count_growth_pct") == {("all", 1, -50.0), ("china", 0, None)}


def test_community_counts_empty_names_but_scope_metrics_do_not(spark):
    i = items(spark, {}, dict(code="GC2"))
    v = visits(spark, {}, dict(user_name="", user_guid=None), dict(user_name=None))
    community = summary.community_stats(v, i, DAY).first()
    assert (community.active_players, community.found_cache_coverage_pct) == (2, 50.0)
    metrics = summary.scope_metrics(v, i, {}).first()
    assert (metrics.total_finders, metrics.total_logs, metrics.total_caches, metrics.total_owners) == (1, 3, 2, 1)


def test_region_share_is_over_active_items(spark):
    i = items(spark, {}, dict(code="GC2", country="Taiwan"), dict(code="GC3", country="Taiwan", cache_status=2), dict(code="GC4", country="Elsewhere"))
    got = summary.region_shares(i, {"china": "China", "taiwan": "Taiwan"})
    assert as_set(got, "region", "total_caches", "percentage") == {("china", 1, 50.0), ("taiwan", 1, 50.0)}


def test_matrix_is_dense_and_lists_the_best_items(spark):
    i = items(
        spark,
        *[dict(code=f"GC{n}", favorite_points=n, owner_username=None if n == 7 else "Olga") for n in range(8)],
        dict(code="GCX", terrain=5.5), dict(code="GCY", difficulty=2.0, cache_status=2),
    )
    cells = grid.attach_top(grid.dt_matrix(i, {}), grid.dt_top(i, regions={}), "region").collect()
    assert len(cells) == 81
    full = [c for c in cells if c["count"]]
    assert [(c.row, c.col, c["count"]) for c in full] == [(0, 0, 8)]
    assert [t.code for t in full[0].top_caches] == ["GC7", "GC6", "GC5", "GC4", "GC3"]
    assert full[0].top_caches[0].owner == ""
    assert all(c.top_caches is None for c in cells if not c["count"])


def test_heatmap_rounds_half_away_from_zero(spark):
    i = items(spark, dict(latitude=1.005, longitude=-1.005))
    got = grid.heatmap(visits(spark, {}), i, DAY, "30d", {}).first()
    assert (got.latitude, got.longitude) == (1.01, -1.01)


DUP = VISIT + ", seq int"


def dedup(spark, *rows):
    full = [{**VISITED, "seq": n, **r} for n, r in enumerate(rows)]
    return ingest.dedup_visits(spark.createDataFrame(full, DUP), ["seq"])


def test_newest_visit_wins_and_equal_days_merge(spark):
    got = dedup(
        spark,
        dict(visited=date(2024, 1, 1), is_ftf=True, user_name="old name"),
        dict(visited=date(2024, 2, 2), favorite_point_used=True, log_type="", user_name="first"),
        dict(visited=date(2024, 2, 2), log_type="Attended", user_name="second"),
        dict(user_guid="", user_name="ann"), dict(user_guid=None, user_name="ann", is_ftf=True),
        dict(user_guid=None, user_name=None), dict(gc_code=""),
    )
    assert as_set(got, "user_name", "visited", "favorite_point_used", "is_ftf", "log_type") == {
        ("first", date(2024, 2, 2), True, False, "Attended"), ("ann", DAY, False, True, "Found it"),
    }


def test_dedup_twice_changes_nothing_and_order_does_not_matter(spark):
    rng = random.Random(5)
    rows = [
        {**VISITED, "seq": n, "gc_code": f"GC{rng.randint(1, 5)}", "user_guid": rng.choice(["a", "b", None]),
         "visited": date(2024, 1, rng.randint(1, 4)), "is_ftf": rng.random() < 0.3, "favorite_point_used": rng.random() < 0.3}
        for n in range(300)
    ]
    frame = spark.createDataFrame(rows, DUP)
    once = ingest.dedup_visits(frame, ["seq"])
    twice = ingest.dedup_visits(once, ["seq"])
    rng.shuffle(rows)
    other = ingest.dedup_visits(spark.createDataFrame(rows, DUP).repartition(7), ["seq"])
    assert as_set(once, *once.columns) == as_set(twice, *once.columns) == as_set(other, *once.columns)
    halves = ingest.dedup_visits(frame.filter("seq < 150"), ["seq"]).unionByName(ingest.dedup_visits(frame.filter("seq >= 150"), ["seq"]))
    assert as_set(ingest.dedup_visits(halves, ["seq"]), *once.columns) == as_set(once, *once.columns)


def test_text_dates_are_settled_too_and_bad_ones_come_first(spark):
    schema = DUP.replace("visited date", "visited string")
    rows = [{**VISITED, "seq": n, "visited": v, "user_name": v} for n, v in enumerate(["soon", "2024-13-45", "2020-02-02", None])]
    got = ingest.dedup_visits(spark.createDataFrame(rows, schema), ["seq"])
    assert as_set(got, "user_name", "visited") == {("2020-02-02", "2020-02-02")}


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    frame = spark.createDataFrame([("2024-01-05T10:00:00Z",), ("2024-01-05T10:00:00",)], "raw string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        got = [r[0] for r in frame.select(text.normal_timestamp("raw")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2024-01-05 10:00:00"] * 2


STORED = "code string, name string, premium_only boolean, latitude double, longitude double, owner_guid string, favorite_points int"


def test_item_changes_ignore_missing_fields_and_premium_positions(spark):
    old = spark.createDataFrame([("A", "a", False, 1.0, 1.0, "g", 1), ("B", "b", True, 2.0, 2.0, None, 1), ("C", "c", False, 3.0, 3.0, None, 1), ("D", "d", False, 4.0, 4.0, None, 1)], STORED)
    new = spark.createDataFrame([("A", None, False, 1.0000004, 1.0, None, 1), ("B", "b2", True, None, None, None, 1), ("C", "c", False, 3.000001, 3.0, None, 1), ("E", "e", True, None, None, None, 0)], STORED)
    assert as_set(ingest.diff_items(new, old), "code", "change") == {("A", "unchanged"), ("B", "updated"), ("C", "updated"), ("E", "new")}
    merged = {r.code: r for r in ingest.merge_items(new, old).collect()}
    assert (merged["A"].name, merged["A"].owner_guid) == ("a", "g")
    assert (merged["B"].name, merged["B"].latitude) == ("b2", 2.0)
    assert merged["C"].latitude == 3.000001 and merged["D"].name == "d" and merged["E"].latitude is None
    again = ingest.merge_items(new, ingest.merge_items(new, old))
    assert as_set(again, *old.columns) == {tuple(r) for r in merged.values()}
    counts = ingest.diff_counts(ingest.diff_items(new, old)).first()
    assert (counts.new_items, counts.updated_items) == (1, 2)


def test_visits_without_an_account_always_go_to_insert(spark):
    old = visits(spark, {}, dict(user_guid="deleted"), dict(user_guid=None))
    new = visits(spark, dict(user_name="Renamed"), dict(user_guid="deleted"), dict(user_guid=None), dict(gc_code="GC9"))
    assert as_set(ingest.diff_visits(new, old), "gc_code", "user_guid", "change") == {
        ("GC1", "u", "update"), ("GC1", "deleted", "insert"), ("GC1", None, "insert"), ("GC9", "u", "insert"),
    }
    merged = ingest.merge_visits(new, old)
    assert merged.count() == 6
    assert as_set(merged.filter("user_guid = 'u' AND gc_code = 'GC1'"), "user_name") == {("Renamed",)}
    assert ingest.insert_absent(new, old).count() == 6


def test_vanished_items_and_the_guard(spark):
    known = items(
        spark, {}, dict(code="GC2", cache_status=None, latitude=None), dict(code="GC3", cache_status=2),
        dict(code="GC4", latitude=50.0), dict(code="GC5"),
    )
    crawled = known.filter("code = 'GC5'")
    gone = ingest.vanished_items(known, crawled, [(2.0, 0.0, 0.0, 2.0)])
    assert as_set(gone, "code") == {("GC1",), ("GC2",)}
    assert as_set(ingest.vanished_to_check(gone, known, 0.5), "code", "suspicious") == {("GC1", False), ("GC2", False)}
    assert as_set(ingest.vanished_to_check(gone, known, 0.3), "code", "suspicious") == {("GC1", True), ("GC2", True)}
    everywhere = ingest.vanished_items(known, crawled, [])
    assert as_set(everywhere, "code") == {("GC1",), ("GC2",), ("GC4",)}


def test_merges_settle_doubled_rows(spark):
    old = items(spark, {}, dict(code="GC2"))
    batch = items(spark, dict(name="first"), dict(name="last"), dict(code="GC3", name="a"), dict(code="GC3", name="b"))
    batch = batch.withColumn("seq", F.when(F.col("name").isin("last", "b"), 2).otherwise(1))
    merged = ingest.merge_items(batch, old, ["seq"])
    assert as_set(merged, "code", "name") == {("GC1", "last"), ("GC2", old.filter("code = 'GC2'").first()["name"]), ("GC3", "b")}
    assert merged.count() == 3
    assert ingest.diff_items(batch, old, ["seq"]).count() == 2
    again = ingest.merge_items(batch, merged, ["seq"])
    assert sorted(again.collect(), key=str) == sorted(merged.collect(), key=str)


def test_visit_merges_settle_both_sides_and_take_unreadable_dates(spark):
    stored = visits(spark, dict(visited=date(2020, 1, 1)), dict(visited=date(2020, 2, 1)))
    new = visits(spark, dict(user_guid="x"), dict(user_guid="x", visited=date(2025, 1, 1)))
    merged = ingest.merge_visits(new, stored)
    assert as_set(merged, "user_guid", "visited") == {("u", date(2020, 2, 1)), ("x", date(2025, 1, 1))} and merged.count() == 2
    assert sorted(ingest.merge_visits(new, merged).collect(), key=str) == sorted(merged.collect(), key=str)
    assert ingest.insert_absent(new, stored).filter("user_guid = 'x'").count() == 1
    text_dates = new.withColumn("visited", F.lit("no date"))
    assert ingest.merge_visits(text_dates, stored).filter("user_guid = 'x' AND visited IS NULL").count() == 1
    assert ingest.diff_visits(text_dates, stored).count() == 1


def test_landed_pages_to_merged_visits(spark, tmp_path):
    """Landed JSON lines -> flatten -> rejects -> dedup by (page, seq) -> merge; several pages, bad dates, quiet items."""
    def entry(user, day, **more):
        return {"LogType": "Found it", "LogText": "", "UserName": user, "Visited": day, "FavoritePointUsed": False, "AccountGuid": user} | more

    landed = [
        {"gc_code": "GC1", "geocache_type": 2, "page": 2, "body": json.dumps({"data": [entry("ann", "2024-05-01", UserName="late"), entry("bob", "not a day")]})},
        {"gc_code": "GC1", "geocache_type": 2, "page": 1, "body": json.dumps({"data": [entry("cid", "2024-05-02"), entry("ann", "2024-05-01")]})},
        {"gc_code": "GC2", "geocache_type": 2, "page": 1, "body": json.dumps({"data": []})},
    ]
    (tmp_path / "landed.json").write_text("\n".join(map(json.dumps, landed)))
    rows = ingest.flatten_visits(tables.read_landed_json(spark, str(tmp_path / "landed.json"), "gc_code string, geocache_type int, page int"))
    good, bad = ingest.split_rejects(rows, {"no_day": F.col("visited").try_cast("date").isNotNull()})
    assert as_set(bad, "user_guid", "error") == {("bob", "no_day")}
    clean = ingest.dedup_visits(good, ["page", "seq"]).drop("page", "seq")
    assert as_set(clean, "user_guid", "user_name") == {("ann", "ann"), ("cid", "cid")}
    stored = visits(spark, dict(user_guid="ann", user_name="ann", visited=date(2024, 4, 1)))
    merged = ingest.merge_visits(clean, stored)
    assert as_set(merged, "user_guid", "visited") == {("ann", date(2024, 5, 1)), ("cid", date(2024, 5, 2))}


def test_ties_are_kept_up_to_the_cap_or_all(spark):
    frame = spark.createDataFrame([("g", f"n{i:02}", 5) for i in range(30)], "g string, name string, score int")
    assert ranking.top_with_ties(frame, ["g"], ["name"], 5).count() == 10
    assert ranking.top_with_ties(frame, ["g"], ["name"], 5, tie_cap=4).count() == 20
    assert ranking.top_with_ties(frame, ["g"], ["name"], 5, tie_cap=None).count() == 30


def test_change_details_use_the_account_then_the_name(spark):
    old = visits(spark, {}, dict(user_guid=None, user_name="ann"), dict(user_guid=None, user_name="ann", visited=date(2020, 1, 1)))
    new = visits(spark, dict(user_name="Uma II", is_ftf=True), dict(user_guid=None, user_name="ann"), dict(user_guid="x", user_name="new"))
    got = ingest.change_summary(ingest.change_details(new, old)).first()
    assert (got.code, got.raw, got.inserted, got.updated) == ("GC1", 3, 1, 2)
    assert got.report.split("\n") == ["Uma II update is_ftf: false -> true", "ann update duplicate_count=2", "new insert missing"]


def test_change_report_keeps_five_details(spark):
    new = visits(spark, *[dict(user_guid=f"u{n}", user_name=f"n{n}") for n in range(9)])
    got = ingest.change_summary(ingest.change_details(new, visits(spark).limit(0))).first()
    assert got.inserted == 9 and len(got.report.split("\n")) == 5


def test_candidates_need_more_than_ten_visits_and_conflicts_use_up_quota(spark):
    rows = [dict(user_guid="ten", user_name="Ten")] * 10 + [dict(user_guid="eleven", user_name="Eleven")] * 11
    rows += [dict(user_guid="two", user_name=n) for n in ["A"] * 10 + ["B"] * 10]
    v = visits(spark, *rows)
    i = items(spark, dict(owner_guid="own"), dict(code="GC2", owner_guid="no guid"), dict(code="GC3", owner_guid="x", owner_username="[DELETED_USER]"))
    u = spark.createDataFrame([], "guid string, fetch_status string")
    assert as_set(users.candidates_to_fetch(v, i, u), "guid", "log_count") == {("eleven", 11), ("own", 0)}
    assert as_set(users.candidates_to_fetch(v, i, u, limit=2), "guid") == {("eleven",)}
    assert as_set(users.name_conflicts(v, i), "guid", "user_name", "name_count") == {("two", "A", 2), ("two", "B", 2)}
    known = spark.createDataFrame([("eleven", "ok"), ("own", "not_found")], "guid string, fetch_status string")
    assert as_set(users.candidates_to_fetch(v, i, known), "guid") == {("own",)}
    assert users.candidates_to_fetch(v, i, known, retry_failed=False).count() == 0
    assert users.candidate_count(v, i).first().candidates == 3


def test_conflicts_of_a_shared_id(spark):
    v = visits(spark, *[dict(user_guid="shared", user_name=f"n{k}") for k in range(200)], *[dict(user_guid=f"g{k}", user_name="one") for k in range(200)])
    got = users.name_conflicts(v, items(spark).limit(0)).collect()
    assert len(got) == 200 and {(r.guid, r.name_count) for r in got} == {("shared", 200)}


def test_user_merge_rules(spark):
    schema = "user_name string, guid string, registration_date date, fetch_status string, reg_place string"
    old = spark.createDataFrame([("a", "g", date(2020, 1, 1), "ok", "X")], schema)
    new = spark.createDataFrame([("a", "h", None, "http_500", "Y"), ("b", "k", None, "ok", None)], schema)
    assert as_set(merge.merge_users(new, old), *old.columns) == {("a", "g", date(2020, 1, 1), "http_500", "Y"), ("b", "k", None, "ok", None)}


def test_evolve_adds_missing_columns_only(spark):
    got = merge.evolve(spark.range(1), {"id": ("string", "x"), "log_type": ("string", "Found it"), "n": ("int", None)})
    assert got.dtypes == [("id", "bigint"), ("log_type", "string"), ("n", "int")]
    assert tuple(got.first()) == (0, "Found it", None)


def test_completeness_states(spark):
    declared = spark.createDataFrame([("a", 2), ("b", 3), ("c", 20000), ("d", 1)], "box string, declared long")
    received = spark.createDataFrame([("a",)] * 2 + [("b",)] * 2 + [("c",)], "box string")
    got = as_set(summary.completeness_check(received, declared), "box", "status")
    assert got == {("a", "complete"), ("b", "mismatch"), ("c", "mismatch"), ("d", "empty")}
    more = as_set(summary.completeness_check(received, declared), "box", "received", "missing", "over_cap")
    assert more == {("a", 2, 0, False), ("b", 2, 1, False), ("c", 1, 19999, True), ("d", 0, 1, False)}


def test_box_filter_wants_both_coordinates_unless_premium(spark):
    rows = [("in", 1.0, 1.0, False), ("zero", 0.0, 1.0, False), ("out", 9.0, 1.0, False), ("premium", None, None, True), ("none", None, 1.0, None)]
    frame = spark.createDataFrame(rows, "code string, lat double, lon double, premium boolean")
    assert as_set(frame.filter(scopes.passes_box("lat", "lon", "premium", [(2.0, 0.0, -2.0, 2.0)])), "code") == {("in",), ("premium",)}


def test_refresh_rules(spark):
    rows = [
        ("never", None, None, None), ("news", date(2024, 1, 1), date(2024, 1, 1), date(2020, 1, 1)),
        ("quiet", date(2024, 1, 2), date(2024, 1, 1), date(2020, 1, 1)),
        ("odd", date(2024, 1, 2), date(2020, 1, 1), date(2020, 1, 1)),
        ("placeholder", date(2024, 1, 2), date(1, 1, 1), date(2020, 1, 1)), ("no date", date(2024, 1, 2), None, None),
    ]
    frame = spark.createDataFrame(rows, "code string, logs_crawled_at date, last_found_date date, placed_date date")
    assert as_set(frame.filter(scopes.needs_refresh()), "code") == {("never",), ("news",), ("odd",)}


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2024-01-05", "2024-01-05"), ("1/5/2024", "2024-01-05"), ("25/12/2023", "2023-12-25"), ("Jan 5, 2024", "2024-01-05"),
        ("2024-01-05T23:59:59+09:00", "2024-01-05"), ("01/05/2024 10:30:00", "2024-01-05"), ("soon", "soon"), ("", ""), (None, None),
    ],
)
def test_dates(spark, raw, want):
    frame = spark.createDataFrame([(raw,)], "raw string")
    assert frame.select(text.normal_date("raw")).first()[0] == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2024-01-05T10:00:00Z", "2024-01-05 10:00:00"), ("2024-01-05T10:00:00.123+08:00", "2024-01-05 02:00:00"),
        ("2024-01-05 10:00", "2024-01-05 10:00:00"), ("2024-01-05", "2024-01-05 00:00:00"), ("2024-01-05T10:00:00+0800", "2024-01-05 02:00:00"),
        ("2024-01-05T10Z", "2024-01-05 10:00:00"), ("2024-13-05", "2024-13-05"), ("None", None), (" ", None), ("later", "later"), (None, None),
    ],
)
def test_timestamps(spark, raw, want):
    frame = spark.createDataFrame([(raw,)], "raw string")
    assert frame.select(text.normal_timestamp("raw")).first()[0] == want


def test_first_to_find_marks(spark):
    yes = ["[FTF]", "great {*ftf*} day", "( * FTF * )", "（ftf）", "[　ftf]"]
    no = ["ftf", "[ft f]", "[ftf", "<ftf>", None, ""]
    frame = spark.createDataFrame([(t,) for t in yes + no], "t string")
    assert [r[0] for r in frame.select(text.has_first_marker("t")).collect()] == [True] * len(yes) + [False] * len(no)


def test_canonical_attributes_ignore_order(spark):
    kind = "a array<struct<id:int,name:string>>"
    frame = spark.createDataFrame([([(2, "b"), (1, "a")],), ([(1, "a"), (2, "b")],), (None,), ([],)], kind)
    got = [r[0] for r in frame.select(text.canonical_attributes("a")).collect()]
    assert got[0] == got[1] and got[2] == got[3] == "[]"


def page(spark, html, url="https://x/geocache/GC1"):
    return spark.createDataFrame([(html, url, 200)], "html string, url string, http int")


SPAN = '<span class="x" id="ctl00_ProfileHead_ProfileHeader_lblMemberSinceDate">Joined {}</span>'


@pytest.mark.parametrize(
    "shown, want",
    [
        ("03/04/2015", date(2015, 3, 4)), ("25/04/2015", date(2015, 4, 25)), ("2015-3-4", date(2015, 3, 4)),
        ("Mar 4,2015", date(2015, 3, 4)), ("March 4,  2015", date(2015, 3, 4)), ("4 Mar 2015", date(2015, 3, 4)),
        ("4 March 2015", date(2015, 3, 4)), ("3.4.2015", date(2015, 3, 4)), ("25.4.2015", date(2015, 4, 25)),
        ("2015. 3. 4.", date(2015, 3, 4)), ("2015.3.4.", date(2015, 3, 4)), ("2015. 3. 4", date(2015, 3, 4)),
        ("2015.3.4", date(2015, 3, 4)), ("last spring", None),
    ],
)
def test_registration_dates(spark, shown, want):
    assert page(spark, SPAN.format(shown)).select(pages.joined_date("html")).first()[0] == want


def test_find_count_and_profile_status(spark):
    got = page(spark, 'x profile-stats <b>12,345 Finds</b>').select(pages.find_count("html"), pages.profile_status("url", "html")).first()
    assert tuple(got) == (12345, "not_found")
    assert page(spark, "nothing").select(pages.find_count("html")).first()[0] == 0
    states = {SPAN.format("1/1/2020"): "ok", SPAN.format("once"): "parse_failed", "UserProfile": "parse_failed", "<title>Log in": "login_required"}
    for html, want in states.items():
        assert page(spark, html).select(pages.profile_status("url", "html")).first()[0] == want


@pytest.mark.parametrize(
    "html, want",
    [
        ('<span class="small">by <b>A</b> | GC12X | Bern, Switzerland</span>', "Switzerland"),
        ('<span class="small">x</span><span class="small">by A | GC1 | Texas</span>', "United States"),
        ('<span class="small">by A | XX1 | Texas</span>', "private"), ("This content is Private", "private"),
        ("user does not exist", None), ("<p></p>", "private"), ('<span class="small">by A | GC1 | </span>', None),
    ],
)
def test_first_country(spark, html, want):
    assert page(spark, html).select(pages.first_country("html")).first()[0] == want


@pytest.mark.parametrize(
    "html, want",
    [
        ('<script type="application/ld+json">{"location": {"latitude": 1.5, "longitude": "2.5"}}</script>', (1.5, 2.5)),
        ('<script type="application/ld+json">{"x": 1}</script> var lat=3.5, lng=4.5', (3.5, 4.5)),
        ("<script> var lat = 3.5 , lng = 4.5;</script>", (3.5, 4.5)),
        ('<script type="application/ld+json">{broken</script> var lat=3.5, lng=4.5', None), ("none", None),
    ],
)
def test_page_position(spark, html, want):
    at = page(spark, html).select(pages.location("html").alias("at")).first().at
    assert (tuple(at) if at else None) == want


def test_owner_id_and_avatar(spark):
    html = '<a href="/p/?guid=AB-12f">x</a> <div class="profile-image-wrapper" style="url(https://img.geocaching.com/user/square250/a.png)">'
    got = page(spark, html).select(pages.owner_guid("html"), pages.avatar("html")).first()
    assert tuple(got) == ("AB-12f", "https://img.geocaching.com/user/square250/a.png")
    assert page(spark, "").select(pages.avatar("html")).first()[0] == fixed.DEFAULT_AVATAR
    urls = spark.createDataFrame([("https://img.geocaching.com/user/square250/a.JPG?x=1",), ("http://x/a.jpg",), (None,)], "u string")
    assert [r[0] for r in urls.select(pages.avatar_valid("u")).collect()] == [True, False, False]


def test_build_numbers(spark):
    for html, want in {
        '/_next/data/release-2024.1/en/play/map.json "buildId":"other"': "2024.1", '"buildId":"release-7"': "7",
        '"buildId":"plain"': "plain", "sentry-release=release-1.2": "1.2", "none": None,
    }.items():
        assert page(spark, html).select(pages.build_id("html")).first()[0] == want


def test_city_captions(spark):
    rows = [("Tainan", "Taiwan", None), ("Wuhan", "China", "湖北省"), ("X", "China", None), ("Y", "Japan", None), ("Z", None, "浙江省"), ("Q", "None", None)]
    frame = spark.createDataFrame(rows, "city string, country string, p string")
    got = [r[0] for r in frame.select(scopes.city_subtitle("city", "country", F.col("p"))).collect()]
    assert got == ["台湾", "湖北省", "中国", "Japan", "浙江省", ""]


def test_rejected_rows_carry_the_first_broken_rule(spark):
    good, bad = ingest.split_rejects(
        spark.createDataFrame([(1, None), (2, 5), (None, 7)], "a int, b int"),
        {"a": F.col("a").isNotNull(), "b": F.col("b") < 6},
    )
    assert as_set(good, "a", "b") == {(2, 5)}
    assert as_set(bad, "a", "b", "error") == {(1, None, "b"), (None, 7, "a")}


def test_a_field_of_a_merge_is_compared_once(spark):
    """Every column of the merged row depends on the comparison; each side of a date is parsed once all the same."""
    old = spark.createDataFrame([("a", "A", "2001-01-01", 1)], "code string, name string, placed_date string, favorite_points int")
    new = spark.createDataFrame([("a", "A", "2001-01-01T00:00:00Z", 2)], "code string, name string, placed_date string, favorite_points int")
    tagged = ingest.tag_items(new, old)
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_utc_timestamp(") == 2
    assert [(r["action"], r["changes"]) for r in tagged.collect()] == [("update", "favorite_points: 1 -> 2")]


@pytest.mark.parametrize("layouts", [text.VISIT_DATE_FORMATS, fixed.JOINED_FORMATS])
def test_date_shapes_let_every_fitting_text_pass(spark, layouts):
    days = ["2001-01-02", "1999-12-31", "2000-02-29", "0099-03-04"]
    rows = [(d, f) for d in days for f in (*layouts, "MM/dd/yyyy", "yyyy-MM-dd", "dd MMM yyyy", "MMM dd, yyyy")]
    wanted = spark.createDataFrame(rows, "day string, layout string")
    texts = wanted.select(F.expr("CASE layout " + " ".join(f"WHEN '{f}' THEN date_format(CAST(day AS DATE), '{f}')" for f in {r[1] for r in rows}) + " END").alias("t"))
    more = spark.createDataFrame([(t,) for t in ("", "x", "some day", None, "13/1/2001", "1/13/2001", "Jan 5, 2001", "JAN 5, 2001", "5 january 2001", "-5/1/2001")], "t string")
    held = spark.conf.get("spark.sql.legacy.timeParserPolicy")
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "CORRECTED")
    try:
        plain = F.coalesce(*[F.try_to_date(F.col("t"), f) for f in layouts])
        got = texts.unionByName(more).select("t", plain.alias("want"), text.parse_date(F.col("t"), layouts).alias("got")).collect()
    finally:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", held)
    assert all(r["want"] == r["got"] for r in got) and sum(r["got"] is not None for r in got) > len(days) * len(layouts)


@pytest.mark.parametrize("margins", ["region", "type", "cube"])
def test_board_margins_equal_lists_over_repeated_rows(spark, margins):
    """Lists made from the first rows of each cell, against rows repeated for every list they count in."""
    rng = random.Random(11)
    kinds, places = [*fixed.TYPE_KEYS.values(), 999, None], ["Aland", "Bland", "Nowhere", None]
    rows = [(f"c{i:04d}", "n", "o", rng.choice(kinds), rng.choice(places), rng.choice(["logs", "favorites"]), "all", rng.choice([0, 1, 1, 2, 9]), rng.choice([0, 1, 3])) for i in range(900)]
    frame = spark.createDataFrame(rows, "code string, name string, owner string, geocache_type int, country string, type string, range string, score bigint, prev_score bigint")
    regions = {"a": "Aland", "b": "Bland"}
    extra = ["name", "owner", "geocache_type"]
    groups = ["region", "type_key", "type", "range"]
    keep = {"region": F.col("type_key") == "all", "type": F.col("region") == "all", "cube": F.lit(True)}[margins]
    cells = scores.item_score_cells(frame, regions, margins != "type", margins != "region")
    got = ranking.leaderboard(cells, groups, key="code", limit=4, extra=extra, margins=["region", "type_key"])
    want = ranking.leaderboard(scores.item_score_cube(frame, regions).filter(keep), groups, key="code", limit=4, extra=extra)
    assert got.columns == want.columns and got.count() == want.count() > 10
    assert got.exceptAll(want).count() == 0
    # rows meet the first window once each, as they came
    assert ranking.first_rows(cells, groups, ["code"], 10**6).count() == frame.filter("score > 0").count()
