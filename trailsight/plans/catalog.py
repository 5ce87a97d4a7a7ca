"""Every query by name, over the test tables seen through the views."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailsight.functions import fixed, pages, scopes, text
from trailsight.functions.periods import Clock, growth_pct
from trailsight.operators import daily, grid, ingest, merge, ranking, scores, spatial, summary, trends, upsert, users
from trailsight.operators import pages as page_ops
from trailsight.plans import reports
from trailsight.sources.tables import LEAN, bucket_count, bucketed, new_folder, read_page, settings, write_pages
from trailsight.streaming import newest, retry
from trailsight.streaming import visits as incremental
from trailsight.plans.views import (
    AS_OF,
    BOXES,
    CONSTANTS,
    REGIONS,
    REPEATED_ORDER,
    SPECIAL,
    table,
    view,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SUBTITLES = {"EUROPE": "Europa", "ASIA": "Asia", "AFRICA": "Africa", "AMERICA": "America"}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


class ViewInputs:
    """The report inputs over the views; each view is made when it is first asked for."""

    as_of = AS_OF
    regions = REGIONS
    region_list = ["all", *REGIONS]
    subtitles = SUBTITLES
    home_country = "EUROPE"

    def __init__(self, spark: SparkSession, sf: str, provinces: DataFrame | None = None) -> None:
        self._spark, self._sf, self.provinces = spark, sf, provinces

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ("visits", "items", "users", "avatars"):
            raise AttributeError(name)
        frame = view(self._spark, self._sf, name)
        setattr(self, name, frame)
        return frame


def inputs(spark: SparkSession, sf: str) -> ViewInputs:
    return ViewInputs(spark, sf)


# --- boards, one per type and range -----------------------------------------------------------

def _each(kinds, prefix: str, build) -> None:
    for kind in kinds:
        for rng in fixed.RANGES:
            QUERIES[f"{prefix}_{kind}_{rng}"] = (
                lambda spark, sf, k=kind, r=rng: build(inputs(spark, sf), (k,), (r,))
            )


_each(scores.PLAYER_TYPES, "player", reports.player_board)
_each(scores.CITY_TYPES, "city", reports.city_board)
_each(scores.ITEM_TYPES, "item_rank", lambda d, t, r: reports.item_board(d, t, r, "region"))

_SIMPLE = {
    "player_board": lambda d: reports.player_board(d),
    "player_stats": lambda d: reports.player_stats(d),
    "newbie_board": lambda d: reports.newbie_board(d),
    "newbie_finds": lambda d: reports.newbie_board(d, ("finds",)),
    "newbie_hides": lambda d: reports.newbie_board(d, ("hides",)),
    "newbie_stats": lambda d: reports.newbie_stats(d),
    "event_board": lambda d: reports.event_board(d),
    "event_hosts": lambda d: reports.event_board(d, ("hosts",)),
    "event_participants": lambda d: reports.event_board(d, ("participants",)),
    "event_stats": lambda d: reports.event_stats(d),
    "event_prev_year_window": lambda d: reports.event_board(d, previous_window=True),
    "item_board": lambda d: reports.item_board(d, margins="region"),
    "item_board_type": lambda d: reports.item_board(d, margins="type"),
    "item_board_cube": lambda d: reports.item_board(d, margins="cube"),
    "item_rank_by_type": lambda d: reports.item_board(d, ("logs",), ("ytd",), "type"),
    "item_stats": lambda d: reports.item_stats(d),
    "city_board": lambda d: reports.city_board(d),
    "rank_with_avatar": lambda d: reports.player_board(d, ("finds",), ("ytd",)),
    "scope_counts": lambda d: summary.scope_metrics(d.visits, d.items, d.regions),
    "active_count": lambda d: summary.active_counts(d.items, d.regions),
    "region_share": lambda d: summary.region_shares(d.items, d.regions),
    "community_stats": lambda d: summary.community_stats(d.visits, d.items, d.as_of),
    "yearly_trend": lambda d: trends.yearly_trend(d.items, d.as_of, d.regions),
    "monthly_trend": lambda d: trends.monthly_trend(d.items, d.as_of),
    "yearly10_trend": lambda d: trends.yearly10_trend(d.items, d.as_of),
    "city_trend_one": lambda d: trends.yearly10_trend(d.items, d.as_of, "NATION_3"),
    "city_monthly": lambda d: trends.city_monthly(d.items, d.as_of),
    "city_yearly": lambda d: trends.city_yearly(d.items, d.as_of),
    "city_cagr": lambda d: trends.city_growth(d.items, d.as_of),
    "heatmap_30d": lambda d: grid.heatmap(d.visits, d.items, d.as_of, "30d", d.regions),
    "heatmap_ytd": lambda d: grid.heatmap(d.visits, d.items, d.as_of, "ytd", d.regions),
    "dt_matrix": lambda d: grid.dt_matrix(d.items, d.regions),
    "dt_top": lambda d: grid.dt_top(d.items, "region", regions=d.regions),
    "city_dt": lambda d: grid.dt_counts(d.items, "city"),
    "city_dt_top": lambda d: grid.dt_top(d.items, "city"),
    "overview": reports.overview,
    "unassigned_diag": lambda d: summary.unassigned_diagnostic(d.items),
    "missing_coords": lambda d: summary.missing_positions(d.items, list(REGIONS.values())),
    "user_candidates": lambda d: users.candidates_to_fetch(d.visits, d.items, d.users),
    "user_candidates_500": lambda d: users.candidates_to_fetch(d.visits, d.items, d.users, 500),
    "candidate_count": lambda d: users.candidate_count(d.visits, d.items),
    "page_scan": lambda d: merge.page_scan(d.items, 200, 2000).select("code", "name", "country"),
    "archived_keyset": lambda d: merge.archived_after(d.items, "gc3", 100),
}
for _name, _fn in _SIMPLE.items():
    QUERIES[_name] = lambda spark, sf, fn=_fn: fn(inputs(spark, sf))


@query("community_incremental")
def _(spark, sf):
    """Distinct people from daily states: all older days at once, two days one by one, then the rest."""
    d, root = inputs(spark, sf), new_folder(spark, "people")
    first = AS_OF - timedelta(2)
    daily.refresh(spark, root, d.visits.filter(F.col("visited").isNull() | (F.col("visited") < F.lit(first))), d.items, regions=d.regions)
    for low, high in ((first, first + timedelta(1)), (first + timedelta(1), AS_OF), (AS_OF, None)):
        daily.refresh(spark, root, d.visits, d.items, low, high, d.regions)
    return daily.community(daily.states(spark, root), d.as_of, d.regions)


def co_located(spark: SparkSession, sf: str, buckets: int = 8) -> reports.Inputs:
    """Visits and items as tables in buckets of the item code: ``buckets`` of them, or as many as the
    larger table needs."""
    d = inputs(spark, sf)
    buckets = bucket_count(buckets, d.visits, d.items)
    d.visits = bucketed(d.visits, "gc_code", buckets, "visits")
    d.items = bucketed(d.items, "code", buckets, "items")
    return d


@query("scope_counts_bucketed")
def _(spark, sf):
    d = co_located(spark, sf)
    return summary.scope_metrics(d.visits, d.items, d.regions)


@query("item_board_bucketed")
def _(spark, sf):
    return reports.item_board(co_located(spark, sf), margins="region")


@query("page_of_layout")
def _(spark, sf):
    """A page deep in the items, from a layout that knows how many rows each of its folders has."""
    root = new_folder(spark, "pages")
    write_pages(view(spark, sf, "items").select("code", "name", "country"), root, ["code"], 500)
    return read_page(spark, root, ["code"], 1000, 300)


@query("leaderboard_limit")
def _(spark, sf):
    d = inputs(spark, sf)
    rows = scores.player_scores(d.visits, d.items, d.as_of, ("finds",), ("active",), d.regions)
    return ranking.plain_limit(rows.filter(F.col("region") == "all"), 30)


@query("ranked_names")
def _(spark, sf):
    d = inputs(spark, sf)
    return ranking.ranked_names(
        [
            reports.player_board(d, ("finds",), ("30d",)),
            reports.newbie_board(d, ("hides",)),
            reports.event_board(d, ("participants",)),
        ]
    )


@query("city_details")
def _(spark, sf):
    """Details of every ranked city, one row per point of a series and per matrix cell."""
    d = inputs(spark, sf)
    details = reports.city_details(d, reports.city_board(d))

    def points(part: str):
        return F.transform(
            part,
            lambda x: F.struct(
                F.lit(part).alias("part"), x["label"].alias("key"), x["count"].alias("count"),
                x["archived"].alias("archived"), F.lit("").alias("top"),
            ),
        )

    cells = F.transform(
        "dt_matrix",
        lambda x: F.struct(
            F.lit("cell").alias("part"),
            F.concat(x["row"].cast("string"), F.lit(","), x["col"].cast("string")).alias("key"),
            x["count"].alias("count"),
            F.lit(0).cast("bigint").alias("archived"),
            F.coalesce(F.array_join(F.transform(x["top_caches"], lambda t: t["code"]), ","), F.lit("")).alias("top"),
        ),
    )
    return details.select(
        "city", "average_growth_pct", F.explode(F.concat(points("monthly"), points("yearly"), cells)).alias("p")
    ).select("city", "average_growth_pct", "p.*")


@query("time_range_matrix")
def _(spark, sf):
    clock = Clock(AS_OF)
    return view(spark, sf, "visits").groupBy("log_type").agg(
        *[
            F.count_if(clock.within("visited", r, p)).alias(f"{r}_{'prev' if p else 'cur'}")
            for r in fixed.RANGES
            for p in (False, True)
        ]
    )


@query("type_labels")
def _(spark, sf):
    shifted = F.when(F.col("favorite_points") % 7 == 0, F.lit(None)).otherwise(
        F.col("geocache_type") + F.col("favorite_points") % 5
    )
    return (
        view(spark, sf, "items")
        .withColumn("geocache_type", shifted.cast("int"))
        .groupBy(scopes.type_label().alias("label"))
        .agg(F.count(F.lit(1)).alias("items"))
    )


@query("city_subtitle")
def _(spark, sf):
    nations = table(spark, sf, "nation").filter(F.col("n_nationkey") % 3 == 0)
    provinces = nations.select(
        F.col("n_name").alias("city"), F.concat(F.lit("Province "), "n_regionkey").alias("province")
    )
    d = ViewInputs(spark, sf, provinces)
    rows = (
        d.items.select(
            scopes.effective_city().alias("name"),
            F.when(F.substring("code", -1, 1) == "9", F.lit(None)).otherwise(F.col("country")).alias("country"),
        )
        .groupBy("name", "country")
        .agg(F.count(F.lit(1)).alias("items"))
    )
    return reports.city_captions(d, rows).groupBy("name", "subtitle").agg(F.sum("items").alias("items"))


@query("growth_round")
def _(spark, sf):
    """Growth of every owner's items placed this year against last year."""
    clock = Clock(AS_OF)
    n, b = F.col("n"), F.col("b")
    return (
        view(spark, sf, "items")
        .groupBy("owner_username")
        .agg(
            F.count_if(clock.within("placed_date", "all")).alias("n"),
            F.count_if(clock.within("placed_date", "all", True)).alias("b"),
        )
        .select("owner_username", growth_pct(n, b, None).alias("growth_pct"), growth_pct(b, n, 0.0).alias("back_pct"))
    )


# --- ingest -----------------------------------------------------------------------------------

def item_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed map pages as JSON text, with the nesting of the source and 100 items at most."""
    i = view(spark, sf, "items")
    k = F.substring("code", 3, 20).cast("bigint")
    attribute = lambda n, applies: F.struct(
        F.lit(n).alias("id"), F.lit(f"attr {n}").alias("name"), applies.alias("isApplicable")
    )
    return _pages_of(
        i.select(
            "country",
            F.floor(k / 100).alias("page"),
            F.struct(
                k.alias("id"),
                "name",
                F.when(k % 31 == 0, F.lit("")).otherwise(F.col("code")).alias("code"),
                F.when(F.col("premium_only"), F.lit("TRUE")).otherwise(F.lit("false")).alias("premiumOnly"),
                F.col("favorite_points").alias("favoritePoints"),
                F.col("geocache_type").alias("geocacheType"),
                "difficulty",
                "terrain",
                F.col("cache_status").alias("cacheStatus"),
                F.when(
                    ~F.col("premium_only"),
                    F.struct(
                        F.when(k % 29 == 0, F.lit(0.0)).otherwise(F.col("latitude")).alias("latitude"),
                        "longitude",
                    ),
                ).alias("postedCoordinates"),
                F.date_format("placed_date", "yyyy-MM-dd").alias("placedDate"),
                (k % 6).cast("int").alias("containerType"),
                F.concat(F.lit("/geocache/"), "code").alias("detailsUrl"),
                F.when(k % 5 != 0, F.date_format(F.date_add("placed_date", 30), "yyyy-MM-dd")).alias("lastFoundDate"),
                (k % 4).cast("int").alias("trackableCount"),
                F.concat(F.lit("Part "), (k % 3).cast("string")).alias("region"),
                F.struct(F.col("owner_username").alias("username")).alias("owner"),
                "country",
                F.array(attribute(1, k % 2 == 0), attribute(2, k % 3 == 0)).alias("attributes"),
            ).alias("item"),
        )
    )


def _pages_of(rows: DataFrame) -> DataFrame:
    listed = rows.groupBy("country", "page").agg(
        F.collect_list("item").alias("results"), F.count(F.lit(1)).alias("n")
    )
    totals = rows.groupBy("country").agg(F.count(F.lit(1)).alias("total"))
    results = F.struct("total", "results").alias("searchResults")
    return listed.join(totals, "country").select(
        F.col("country").alias("box"),
        F.to_json(F.struct(F.struct(results).alias("pageProps"))).alias("body"),
        "page",
    )


@query("item_flatten")
def _(spark, sf):
    flat = ingest.flatten_items(item_pages(spark, sf), BOXES, ("EUROPE", "ASIA", "AFRICA"))
    return flat.select(
        "id", "code", "name", "premium_only", "favorite_points", "geocache_type", "cache_status",
        "latitude", "longitude", "placed_date", "owner_username", "country", "container_type", "difficulty", "terrain",
        "details_url", "owner_guid", "last_found_date", "trackable_count", "region",
        F.array_join(F.transform("attributes", lambda a: a["name"]), ",").alias("attributes"),
    )


def drifted_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed pages, one item each, some with fields that the source began to send."""
    k = F.substring("code", 3, 20).cast("bigint")
    item = F.to_json(F.struct("code", "name", F.col("favorite_points").alias("favoritePoints"), "country"))
    more = (
        F.when(k % 5 == 0, F.concat(F.lit(',"newFlag":'), (k % 2 == 0).cast("string"), F.lit(',"rank":'), k.cast("string")))
        .when(k % 5 == 1, F.concat(F.lit(',"rank":"r'), k.cast("string"), F.lit('"')))
        .when(k % 5 == 2, F.lit(',"place":{"zip":"x","no":7}'))
        .otherwise(F.lit(""))
    )
    body = F.concat(
        F.lit('{"pageProps":{"searchResults":{"total":1,"results":['), F.regexp_replace(item, r"\}$", ""),
        more, F.lit("}]}}}"),
    )
    return view(spark, sf, "items").select("code", F.when(k % 11 == 0, F.lit("{broken")).otherwise(body).alias("body"))


@query("unknown_fields")
def _(spark, sf):
    """Fields of landed items that the tables have no column for."""
    return ingest.unknown_fields(drifted_pages(spark, sf))


@query("extra_fields")
def _(spark, sf):
    """Items with two of the unknown fields as columns, by name, type and default."""
    landed = drifted_pages(spark, sf)
    items = view(spark, sf, "items").select("code")
    additions = {"new_flag": ("newFlag", "boolean", False), "rank": ("rank", "bigint", -1)}
    return ingest.with_extra(items, ingest.flatten_extra(landed), additions)


@query("box_filter")
def _(spark, sf):
    i = view(spark, sf, "items")
    return (
        i.filter(scopes.passes_box("latitude", "longitude", "premium_only", BOXES))
        .filter(F.col("country").isin("EUROPE", "ASIA", "AFRICA"))
        .select("code", "premium_only")
    )


def visit_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Landed visit pages: one JSON document per line item."""
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    event = F.substring("o_orderpriority", 1, 1) == "5"
    attended = (F.col("l_linenumber") % 2 == 0) == event
    mark = F.when(F.col("l_quantity") < 5, F.lit("nice one [* FTF *] thanks")).otherwise(F.lit("ftf maybe"))
    entry = F.struct(
        F.when(attended, F.lit("Attended")).otherwise(F.lit("Found it")).alias("LogType"),
        mark.alias("LogText"),
        F.concat(F.lit("user "), F.col("l_suppkey").cast("string")).alias("UserName"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("Visited"),
        (F.col("l_returnflag") == "R").alias("FavoritePointUsed"),
        F.concat(F.lit("A"), F.col("l_suppkey").cast("string")).alias("AccountGuid"),
    )
    return rows.select(
        F.concat(F.lit("GC"), F.col("l_orderkey").cast("string")).alias("gc_code"),
        F.when(event, F.lit(6)).otherwise(F.lit(2)).alias("geocache_type"),
        F.to_json(F.struct(F.array(entry).alias("data"))).alias("body"),
    )


@query("visit_flatten")
def _(spark, sf):
    return ingest.flatten_visits(visit_pages(spark, sf)).drop("page", "seq")


@query("accepted_types")
def _(spark, sf):
    i = view(spark, sf, "items").select(F.col("code").alias("gc_code"), "geocache_type")
    v = view(spark, sf, "visits").groupBy("gc_code", "log_type").agg(F.count(F.lit(1)).alias("n"))
    return (
        v.join(i, "gc_code")
        .filter(scopes.accepted_visit_type())
        .groupBy("geocache_type", "log_type")
        .agg(F.sum("n").alias("visits"))
    )


@query("visit_dedup")
def _(spark, sf):
    rows = ingest.dedup_visits(view(spark, sf, "repeated"), REPEATED_ORDER)
    return rows.drop(*REPEATED_ORDER)


@query("visit_keep_latest")
def _(spark, sf):
    rows = view(spark, sf, "repeated").filter(F.col("user_name").isNotNull())
    latest = ingest.keep_latest(rows, ["gc_code", "user_name"], REPEATED_ORDER)
    return latest.select("gc_code", "user_name", "visited", "favorite_point_used")


@query("visit_diff")
def _(spark, sf):
    rows = ingest.diff_visits(view(spark, sf, "incoming_visits"), view(spark, sf, "stored_visits"))
    return rows.select("gc_code", "user_name", "user_guid", "change")


@query("visit_merge")
def _(spark, sf):
    return ingest.merge_visits(view(spark, sf, "incoming_visits"), view(spark, sf, "stored_visits"))


@query("visit_insert_absent")
def _(spark, sf):
    return ingest.insert_absent(view(spark, sf, "incoming_visits"), view(spark, sf, "stored_visits"))


@query("change_summary")
def _(spark, sf):
    details = ingest.change_details(
        view(spark, sf, "incoming_visits"), view(spark, sf, "repeated_stored")
    )
    return ingest.change_summary(details)


@query("change_details")
def _(spark, sf):
    """Every change, without the cut of the summary's text."""
    return ingest.change_details(view(spark, sf, "incoming_visits"), view(spark, sf, "repeated_stored"))


def crawled_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The incoming items with an older record of every third one, which the later replaces."""
    last = view(spark, sf, "incoming_items").withColumn("crawl_seq", F.lit(2))
    k = F.substring("code", 3, 20).cast("bigint")
    first = last.filter(k % 3 == 0).withColumn("crawl_seq", F.lit(1)).withColumn("name", F.lit("stale"))
    return last.unionByName(first)


@query("item_diff")
def _(spark, sf):
    return ingest.diff_items(crawled_twice(spark, sf), view(spark, sf, "stored_items"), ["crawl_seq"])


@query("item_merge")
def _(spark, sf):
    return ingest.merge_items(crawled_twice(spark, sf), view(spark, sf, "stored_items"), ["crawl_seq"])


def merged_by_parts(spark: SparkSession, sf: str, kind: upsert.Kind, what: str) -> str:
    """A stored table laid out by key, with one batch merged into the folders it touches."""
    root = new_folder(spark, what)
    upsert.create(view(spark, sf, f"stored_{what}"), root, kind, parts=16)
    batch = crawled_twice(spark, sf) if what == "items" else view(spark, sf, f"incoming_{what}")
    upsert.apply_batch(batch, root, kind, 1, ["crawl_seq"] if what == "items" else (), parts=16)
    return root


@query("item_merge_parts")
def _(spark, sf):
    return upsert.stored(spark, merged_by_parts(spark, sf, upsert.ITEMS, "items"))


@query("visit_merge_parts")
def _(spark, sf):
    return upsert.stored(spark, merged_by_parts(spark, sf, upsert.VISITS, "visits"))


@query("item_change_log")
def _(spark, sf):
    """What the merge of a batch really changed, from the merge itself."""
    done = upsert.log(spark, merged_by_parts(spark, sf, upsert.ITEMS, "items"))
    return done.select("after.code", "action", "changes", F.col("before.favorite_points").alias("points_before"), F.col("after.favorite_points").alias("points_after"))


@query("visit_change_log")
def _(spark, sf):
    done = upsert.log(spark, merged_by_parts(spark, sf, upsert.VISITS, "visits"))
    return done.select("after.gc_code", "after.user_name", "action", "changes", F.col("before.visited").alias("visited_before"), F.col("after.visited").alias("visited_after"))


@query("canonical_item")
def _(spark, sf):
    return ingest.canonical_items(view(spark, sf, "incoming_items")).select(
        "code", "name", "premium_only", "latitude", "longitude", "difficulty", "placed_date",
        "container_type", "details_url", "last_found_date", "trackable_count",
    )


@query("vanished_items")
def _(spark, sf):
    known = view(spark, sf, "items")
    crawled = known.filter(F.substring("code", 3, 20).cast("bigint") % 97 != 0)
    gone = ingest.vanished_items(known, crawled, BOXES)
    return gone


@query("vanished_boxes")
def _(spark, sf):
    """Vanished items of a crawl of many overlapping boxes, which are a table."""
    known = view(spark, sf, "items")
    crawled = known.filter(F.substring("code", 3, 20).cast("bigint") % 97 != 0)
    return ingest.vanished_items(known, crawled, view(spark, sf, "crawl_boxes"))


@query("vanished_checked")
def _(spark, sf):
    """Few vanished items, and so many that the crawl is suspicious; all are listed."""
    known = view(spark, sf, "items")
    k = F.substring("code", 3, 20).cast("bigint")
    few = ingest.vanished_items(known, known.filter(k % 7919 != 0), BOXES)
    many = ingest.vanished_items(known, known.filter(k % 2 != 0), BOXES)
    return ingest.vanished_to_check(few, known).withColumn("crawl", F.lit("good")).unionByName(
        ingest.vanished_to_check(many, known).withColumn("crawl", F.lit("broken"))
    )


@query("refresh_candidates")
def _(spark, sf):
    return merge.refresh_candidates(view(spark, sf, "crawled"))


@query("work_split")
def _(spark, sf):
    i = view(spark, sf, "items").select("code", "premium_only")
    done = i.filter(F.substring("code", 3, 20).cast("bigint") % 3 == 0)
    return merge.split_work(i, done)


@query("status_lookup")
def _(spark, sf):
    wanted = view(spark, sf, "visits").filter(F.col("favorite_point_used")).select(F.col("gc_code").alias("code"))
    return merge.status_lookup(view(spark, sf, "items"), wanted)


@query("keyed_update")
def _(spark, sf):
    crawled = view(spark, sf, "visits").filter(F.col("is_ftf")).select(F.col("gc_code").alias("code"))
    return merge.keyed_update(
        view(spark, sf, "crawled"), crawled, "code", {"logs_crawled_at": F.lit(AS_OF)}
    ).select("code", "logs_crawled_at")


@query("backfill_fields")
def _(spark, sf):
    d = view(spark, sf, "items")
    k = F.substring("code", 3, 20).cast("bigint")
    found = d.filter(F.col("latitude").isNull() & (k % 2 == 0)).select(
        "code",
        (F.lit(20) + (k % 1000) / 2000000).alias("latitude"),
        (F.lit(80) + (k % 1000) / 7000).alias("longitude"),
        F.when(k % 3 == 0, F.concat(F.lit("X"), k.cast("string"))).alias("owner_guid"),
    )
    return merge.backfill_fields(d, found).select("code", "latitude", "longitude", "owner_guid")


@query("rejects")
def _(spark, sf):
    rows = view(spark, sf, "visits")
    _, rejected = ingest.split_rejects(
        rows,
        {
            "no_user": F.col("user_name").isNotNull(),
            "no_type": F.col("log_type").isNotNull(),
            "future": F.col("visited") <= F.lit(AS_OF),
        },
    )
    return rejected.groupBy("error", F.col("gc_code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("schema_evolve")
def _(spark, sf):
    rows = view(spark, sf, "visits")
    old = rows.filter(F.year("visited") < 1998).drop("log_type", "user_guid")
    new = rows.filter(F.year("visited") >= 1998)
    both = merge.union_evolved(old, new, {"log_type": fixed.FOUND})
    return both.groupBy("log_type", F.col("user_guid").isNull().alias("no_guid")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("completeness_check")
def _(spark, sf):
    """Landed pages, one box per country; the pages of one box and some of another got lost."""
    landed = item_pages(spark, sf)
    declared = ingest.declared_totals(landed)
    lost = (F.col("box") == "EUROPE") | ((F.col("box") == "ASIA") & (F.col("page") % 2 == 0))
    kept = landed.withColumn("body", F.when(lost, F.lit("{}")).otherwise(F.col("body")))
    flat = ingest.flatten_items(kept, None, None)
    received = flat.select(F.col("country").alias("box"))
    return summary.completeness_check(received, declared)


@query("request_digest")
def _(spark, sf):
    return summary.request_digest(view(spark, sf, "requests"), view(spark, sf, "request_items"))


# --- people to enrich -------------------------------------------------------------------------

@query("guid_conflicts")
def _(spark, sf):
    """People renamed on a fifth of their visits."""
    v = view(spark, sf, "visits").withColumn(
        "user_name",
        F.when(F.col("is_ftf") & F.col("user_name").endswith("7"), F.concat("user_name", F.lit(" II"))).otherwise(
            F.col("user_name")
        ),
    )
    return users.name_conflicts(v, view(spark, sf, "items"))


@query("user_merge")
def _(spark, sf):
    return merge.merge_users(view(spark, sf, "user_batch"), view(spark, sf, "stored_users"), ["seq"])


@query("user_last_wins")
def _(spark, sf):
    return merge.last_per_key(view(spark, sf, "user_batch"), "user_name", ["seq"])


@query("avatar_merge")
def _(spark, sf):
    """A batch in which an older record, an explicit default, comes before each picture that is taken."""
    stored = view(spark, sf, "avatars").withColumn("checked_at", F.lit("2001-01-01"))
    last = view(spark, sf, "avatar_batch").withColumn("seq", F.lit(2))
    taken = (F.col("avatar_status") == "real") & F.col("avatar_url").startswith("https://img.geocaching.com/")
    older = last.filter(taken).withColumn("avatar_status", F.lit("default")).withColumn("seq", F.lit(1))
    return merge.merge_avatars(last.unionByName(older), stored, F.lit("2001-06-15"), ["seq"])


@query("avatar_resolve")
def _(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_name").alias("user_name"))
    return merge.resolve_avatars(names, view(spark, sf, "avatars"))


@query("avatar_tally")
def _(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_name").alias("user_name"))
    return merge.avatar_tally(merge.resolve_avatars(names, view(spark, sf, "avatars")))


# --- pages and text ---------------------------------------------------------------------------

@query("page_fields")
def _(spark, sf):
    calls = r"track\((\d+)\)"
    return table(spark, sf, "pages").select(
        "page_id",
        pages.title("html").alias("title"),
        pages.extract("html", r'lang="([^"]*)"').alias("lang"),
        pages.extract("html", r'href="([^"]*)"').alias("first_link"),
        pages.extract("html", calls).cast("bigint").alias("tracked"),
    )


@query("page_summary")
def _(spark, sf):
    return page_ops.page_summary(table(spark, sf, "pages")).select(
        "page_id", "title", "profile_name", "joined_context", "markers", "looks_like_profile"
    )


@query("page_class")
def _(spark, sf):
    """The landed pages, a third of them made to carry one of the marks."""
    p = table(spark, sf, "pages")
    extra = (
        F.when(F.col("page_id") % 9 == 0, F.lit('<b id="ctl00_ContentBody_archivedMessage">x</b>'))
        .when(F.col("page_id") % 9 == 1, F.lit('{"isAuthenticated" : false}'))
        .when(F.col("page_id") % 9 == 2, F.lit('"pageInfo": {"idx":1, "size":5, "totalRows":37}'))
        .when(F.col("page_id") % 9 == 3, F.lit("<p>Create your FREE account</p>"))
        .when(F.col("page_id") % 9 == 4, F.lit('"pageInfo": {"idx":1, "size":50, "totalRows":370}'))
        .otherwise(F.lit(""))
    )
    url = F.when(F.col("page_id") % 7 == 0, F.concat("url", F.lit("?ReturnUrl=/x"))).otherwise(F.col("url"))
    marked = p.select("page_id", url.alias("url"), F.concat("html", extra).alias("html"))
    return page_ops.page_classes(marked).select("page_id", "login_page", "public_page", "archived_page")


@query("first_pattern")
def _(spark, sf):
    patterns = (r"track\((release-\d+)\)", r"track\((\d*7)\)", r'lang="([^"]+)"')
    return table(spark, sf, "pages").select("page_id", pages.build_id("html", patterns).alias("found"))


@query("build_id")
def _(spark, sf):
    """Pages with the marks that a build number is read from, one kind each; some have none."""
    n = F.col("page_id").cast("string")
    marks = (
        F.concat(F.lit("/_next/data/release-20240101.1."), n, F.lit("/en/play/map.json")),
        F.concat(F.lit('"buildId":"release-20240102.2.'), n, F.lit('"')),
        F.concat(F.lit('"buildId":"dev'), n, F.lit('"')),
        F.concat(F.lit("sentry-release=release-3.4."), n),
        F.concat(F.lit("<!-- release-20240105.5."), n, F.lit(" -->")),
        F.lit(""),
    )
    mark = F.element_at(F.array(*marks), (F.col("page_id") % 6 + 1).cast("int"))
    landed = table(spark, sf, "pages").select("page_id", F.concat("html", mark).alias("html"))
    return landed.select("page_id", pages.build_id("html").alias("found"))


@query("item_page_fields")
def _(spark, sf):
    """Detail pages of the items: a third with a JSON-LD block, a third with a script, the rest with neither."""
    k = F.substring("code", 3, 20).cast("bigint")
    lat, lon = F.concat((k % 90).cast("string"), F.lit(".25")), F.concat((k % 180).cast("string"), F.lit(".5"))
    block = F.concat(
        F.lit('<script type="application/ld+json">{"location": {"latitude": "'), lat,
        F.lit('", "longitude": "'), lon, F.lit('"}}</script>'),
    )
    script = F.concat(F.lit("<script>var lat = "), lat, F.lit(", lng = "), lon, F.lit(";</script>"))
    place = F.when(k % 3 == 0, block).when(k % 3 == 1, script).otherwise(F.lit("<p>no place</p>"))
    owner = F.when(k % 2 == 0, F.concat(F.lit('<a href="/p/?guid='), k.cast("string"), F.lit('">'))).otherwise(F.lit(""))
    landed = view(spark, sf, "items").select("code", F.concat(place, owner).alias("html"))
    return page_ops.item_page_fields(landed)


@query("ftf_marker")
def _(spark, sf):
    """Documents, some with a mark put in front or behind."""
    marks = ("[FTF]", "( *ftf* )", "{ftf", "（ＦＴＦ）", "（* Ftf ）", "ftf")
    text_col = F.col("text")
    marked = F.concat(text_col, F.lit(" "), F.element_at(F.array(*[F.lit(m) for m in marks]), (F.col("doc_id") % 6 + 1).cast("int")))
    return table(spark, sf, "documents").select("doc_id", text.has_first_marker(marked).alias("is_ftf"))


_TEXT_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "yyyy/MM/dd", "MMM d, yyyy", "d MMMM yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'")


@query("date_normalise")
def _(spark, sf):
    day = F.to_date("o_orderdate")
    shown = F.lit("no date").cast("string")
    for n, fmt in enumerate(_TEXT_FORMATS):
        shown = F.when(F.col("o_orderkey") % 7 == n, F.date_format(day, fmt)).otherwise(shown)
    return (
        table(spark, sf, "orders")
        .withColumn("raw", shown)
        .select("o_orderkey", text.normal_date("raw").alias("day"))
    )


@query("ts_normalise")
def _(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    n = F.col("event_id") % 7
    shown = (
        F.when(n == 0, F.concat(stamp, F.lit("Z")))
        .when(n == 1, F.concat(stamp, F.lit("+08:00")))
        .when(n == 2, F.date_format("ts", "yyyy-MM-dd"))
        .when(n == 3, F.lit(" NaN "))
        .when(n == 4, F.lit("soon"))
        .when(n == 5, F.concat(stamp, F.lit(".250")))
    )
    return (
        table(spark, sf, "events")
        .withColumn("raw", shown)
        .select("event_id", text.normal_timestamp("raw").alias("stamp"))
    )


def profile_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Profile pages of the known users, their date written in one of the usual layouts.

    The users are dealt out while they are rows of a few bytes: their table may lie in one piece, and
    reading a page costs far more than a row of it.
    """
    dealt = view(spark, sf, "users").repartition(4 * spark.sparkContext.defaultParallelism, "user_name", "guid")
    u = dealt.withColumn("k", F.substring("guid", 2, 20).cast("bigint"))
    formats = (
        "MM/dd/yyyy", "yyyy-MM-dd", "MMM d, yyyy", "MMMM d,yyyy", "d MMM yyyy", "d MMMM yyyy",
        "MM.dd.yyyy", "yyyy. MM. dd.", "yyyy.MM.dd",
    )
    shown = F.lit("some day")
    for n, fmt in enumerate(formats):
        shown = F.when(F.col("k") % 10 == n, F.date_format("registration_date", fmt)).otherwise(shown)
    span = F.concat(
        F.lit("<span class='a' id=\"ctl00_ProfileHead_ProfileHeader_lblMemberSinceDate\" x>\n Joined  "),
        F.coalesce(shown, F.lit("")),
        F.lit(" </span>"),
    )
    finds = F.concat(F.lit('<ul class="profile-stats"><li>'), F.format_number(F.col("k") * 3, 0), F.lit(" Finds</li></ul>"))
    picture = F.when(
        F.col("k") % 3 == 0,
        F.concat(F.lit("<div class=\"profile-image-wrapper\" style=\"background: url('https://img.geocaching.com/user/square250/"), F.col("k").cast("string"), F.lit(".jpg')\">")),
    ).when(
        F.col("k") % 3 == 1,
        F.concat(F.lit("<img src=\"https://img.geocaching.com/user/square250/s"), F.col("k").cast("string"), F.lit(".png?v=2\">")),
    ).otherwise(F.lit(""))
    return u.select(
        "user_name",
        F.lit("https://example.org/p").alias("url"),
        F.concat(F.lit("<html><title> Profile </title>"), picture, span, F.when(F.col("k") % 4 != 0, finds).otherwise(F.lit(""))).alias("html"),
    )


@query("parse_joined_date")
def _(spark, sf):
    return page_ops.profile_fields(profile_pages(spark, sf)).select(
        "user_name", "registration_date", "find_count", "fetch_status"
    )


@query("avatar_extract")
def _(spark, sf):
    return profile_pages(spark, sf).select("user_name", pages.avatar("html").alias("avatar_url")).withColumn(
        "is_real", pages.avatar_valid("avatar_url")
    )


@query("first_country")
def _(spark, sf):
    c = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    k = F.col("c_custkey")
    place = F.when(k % 5 == 0, F.lit("Austin, Texas")).otherwise(F.concat(F.lit("Town, "), "n_name"))
    row = F.concat(
        F.lit('<span class="small">by nobody</span> <span  class="small">by <b>'), "c_name",
        F.lit("</b> | GC"), k.cast("string"), F.lit("X |\n "), place, F.lit(" </span>"),
    )
    html = (
        F.when(k % 11 == 0, F.lit("The user does NOT exist"))
        .when(k % 11 == 1, F.lit("<p>This content is private</p>"))
        .when(k % 11 == 2, F.lit("<p>nothing here</p>"))
        .otherwise(row)
    )
    return c.select("c_custkey", html.alias("html")).select(
        "c_custkey", pages.first_country("html").alias("country")
    )


@query("status_resolve")
def _(spark, sf):
    """Readings of every item: two readers, some pages missing, restricted, archived or login."""
    i = view(spark, sf, "items").withColumn("k", F.substring("code", 3, 20).cast("bigint"))
    n = F.col("k") % 8
    reading = F.explode(
        F.array(
            F.struct(
                F.lit("nonpremium").alias("reader"), F.lit(1).alias("attempt"),
                F.when(n == 0, 404).otherwise(200).alias("http_status"),
                F.when(n == 1, F.lit("<title>GC Premium Member Only Cache</title>"))
                .when(n == 2, F.lit("This cache has been LOCKED, but"))
                .when(n == 3, F.lit("<title>Sign In</title>"))
                .otherwise(F.lit("<title>x</title>")).alias("html"),
            ),
            F.struct(
                F.lit("premium").alias("reader"), F.lit(2).alias("attempt"),
                F.when((n == 4) | (n == 0) & (F.col("k") % 16 == 0), 404).when(n == 3, 500).otherwise(200).alias("http_status"),
                F.when(n == 5, F.lit("This cache has been archived")).otherwise(F.lit("<title>x</title>")).alias("html"),
            ),
        )
    )
    landed = i.select("code", reading.alias("r")).select(
        "code", "r.*", F.concat(F.lit("https://example.org/geocache/"), "code").alias("url")
    )
    resolved = page_ops.resolve_status(landed)
    return page_ops.status_changes(i, resolved)


# --- places -----------------------------------------------------------------------------------

def area_edges(spark: SparkSession, sf: str) -> DataFrame:
    a = view(spark, sf, "areas")
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).cast("double").alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))
    shapes = a.select("name", "country", F.array(F.array(ring)).alias("shape"))
    return spatial.polygon_edges(shapes.select("name", "shape"))


SPECIAL_AREAS = ("NATION_2", "NATION_7", "NATION_12", "NATION_17", "NATION_22")


@query("nearest_area")
def _(spark, sf):
    """Cities of all items, a third of which lost theirs."""
    k = F.substring("code", 3, 20).cast("bigint")
    items = view(spark, sf, "items").withColumn(
        "city", F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("city"))
    )
    edges = area_edges(spark, sf)
    return spatial.assign_cities(items, edges, CONSTANTS, SPECIAL, SPECIAL_AREAS).select("code", "city")


# --- incremental ------------------------------------------------------------------------------

def _land(rows: DataFrame, folder: str) -> None:
    """Visits as landed files below a folder for each month: the rows of a month lie together, in as many
    files as their size asks for, however many tasks held some of them."""
    dealt = rows.withColumn("month", F.date_format("visited", "yyyy-MM")).hint("rebalance", "month")
    with settings(rows.sparkSession, LEAN):
        dealt.write.mode("append").partitionBy("month").parquet(folder)


@query("stream_visit_merge")
def _(spark, sf):
    """All visits taken in by a stream, a few files at a time; equals one batch over all."""
    rows = view(spark, sf, "repeated")
    root = new_folder(spark, "stream")
    _land(rows, f"{root}/landed")
    incremental.run_available(
        spark, f"{root}/landed", rows.schema, root, REPEATED_ORDER, files_per_batch=24
    ).awaitTermination()
    return incremental.read_visits(spark, root, REPEATED_ORDER).drop(*REPEATED_ORDER)


@query("stream_resume")
def _(spark, sf):
    """A stream stopped half way, compacted, continued, and started once more without news."""
    rows = view(spark, sf, "repeated")
    root = new_folder(spark, "resume")
    late = F.year("visited") >= 1998

    def run() -> None:
        incremental.run_available(
            spark, f"{root}/landed", rows.schema, root, REPEATED_ORDER, files_per_batch=24
        ).awaitTermination()

    _land(rows.filter(~late), f"{root}/landed")
    run()
    incremental.compact(spark, root, REPEATED_ORDER)
    _land(rows.filter(late), f"{root}/landed")
    run()
    run()
    done = incremental.progress(spark, root).select("code")
    counts = (
        incremental.read_visits(spark, root, REPEATED_ORDER)
        .groupBy(F.col("gc_code").alias("code"))
        .agg(F.count(F.lit(1)).alias("visits"), F.max("visited").alias("newest"))
    )
    return done.join(counts, "code")


@query("stream_newest")
def _(spark, sf):
    """All visits through a stateful stream, the older half of them landing last."""
    rows = view(spark, sf, "repeated")
    root = new_folder(spark, "newest")
    late = F.year("visited") < 1998
    for part in (rows.filter(~late), rows.filter(late)):
        _land(part, f"{root}/landed")
        newest.run_available(
            spark, f"{root}/landed", rows.schema, root, REPEATED_ORDER, files_per_batch=24, parts=8
        ).awaitTermination()
    newest.compact(spark, root, parts=8)
    return newest.read_newest(spark, root).drop(*REPEATED_ORDER)


def landed_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results of fetching items, with the round in which they land."""
    r = view(spark, sf, "results")
    visit = F.struct(
        "user_name", F.lit(None).cast("string").alias("user_guid"), "visited", F.lit(False).alias("favorite_point_used"),
        F.lit(False).alias("is_ftf"), F.lit(fixed.FOUND).alias("log_type"), F.col("attempt").alias("seq"),
    )
    found = F.when(F.col("user_name").isNull(), F.expr("array()")).otherwise(F.array(visit))
    return r.select("round", "code", "attempt", "error", found.alias("visits"))


@query("stream_retry")
def _(spark, sf):
    """Three rounds of fetching, the ledger compacted after the first: what became of each item."""
    rows, root = landed_results(spark, sf), new_folder(spark, "retry")
    for n, cond in enumerate(("round <= 2", "round BETWEEN 3 AND 4", "round >= 5")):
        rows.filter(cond).drop("round").write.parquet(f"{root}/landed/{n}")
        retry.run_available(spark, f"{root}/landed", root).awaitTermination()
        if n == 0:
            retry.compact(spark, root)
    visits = incremental.read_visits(spark, root, retry.VISIT_ORDER).groupBy(F.col("gc_code").alias("code")).agg(
        F.count(F.lit(1)).alias("visits")
    )
    return (
        retry.ledger(spark, root)
        .join(visits, "code", "left")
        .select("code", "attempts", "failures", "state", F.col("last_error.error").alias("last_error"), F.coalesce("visits", F.lit(0)).alias("visits"))
    )
