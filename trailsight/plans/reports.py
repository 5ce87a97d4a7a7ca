"""Published reports: long result frames, and the nested sections written from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailsight.functions import fixed, scopes, text
from trailsight.operators import grid, merge, ranking, scores, summary, trends
from trailsight.operators.frames import spine
from trailsight.sources import documents
from trailsight.sources.tables import materialise


@dataclass(frozen=True)
class Inputs:
    """The stored tables a publication is made from, its day and its regions."""

    visits: DataFrame
    items: DataFrame
    users: DataFrame
    avatars: DataFrame
    as_of: date
    regions: Mapping[str, str] = field(default_factory=lambda: dict(fixed.REGIONS))
    subtitles: Mapping[str, str] = field(default_factory=lambda: dict(fixed.COUNTRY_SUBTITLES))
    home_country: str = "China"
    provinces: DataFrame | None = None  # (city, province)

    @property
    def region_list(self) -> list[str]:
        return ["all", *self.regions]


RANKED = ["region", "type", "range"]


# --- people -----------------------------------------------------------------------------------

def player_board(
    d: Inputs,
    types=scores.PLAYER_TYPES,
    ranges=fixed.RANGES,
    limit: int = fixed.PLAYER_LIMIT,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Tied top lists of people with their pictures; ``rows`` are their scores, where they are at hand
    already."""
    if rows is None:
        rows = scores.player_scores(d.visits, d.items, d.as_of, types, ranges, d.regions)
    return with_avatars(d, ranking.leaderboard(rows, RANKED, limit=limit))


def player_stats(
    d: Inputs, types=scores.PLAYER_TYPES, ranges=fixed.RANGES, rows: DataFrame | None = None
) -> DataFrame:
    if rows is None:
        rows = scores.player_scores(d.visits, d.items, d.as_of, types, ranges, d.regions)
    domains = {"region": d.region_list, "type": list(types), "range": list(ranges)}
    return ranking.population_stats(rows, domains, empty_growth=0.0)


def newbie_board(
    d: Inputs,
    types=("finds", "hides"),
    limit: int = fixed.PLAYER_LIMIT,
    rows: DataFrame | None = None,
) -> DataFrame:
    if rows is None:
        rows = scores.newbie_scores(d.visits, d.items, d.users, d.as_of, types, d.regions)
    return with_avatars(d, ranking.flat_leaderboard(rows, ["region", "type"], limit=limit))


def newbie_stats(d: Inputs, rows: DataFrame | None = None) -> DataFrame:
    types = ["finds", "hides"]
    if rows is None:
        rows = scores.newbie_scores(d.visits, d.items, d.users, d.as_of, types, d.regions)
    return ranking.population_stats(rows, {"region": d.region_list, "type": types}, None)


def event_board(
    d: Inputs,
    types=("hosts", "participants"),
    limit: int = fixed.PLAYER_LIMIT,
    previous_window: bool = False,
    rows: DataFrame | None = None,
) -> DataFrame:
    if rows is None:
        rows = scores.event_scores(d.visits, d.items, d.as_of, types, d.regions, previous_window)
    return with_avatars(d, ranking.leaderboard(rows, ["region", "type"], limit=limit))


def event_stats(d: Inputs, rows: DataFrame | None = None) -> DataFrame:
    types = ["hosts", "participants"]
    if rows is None:
        rows = scores.event_scores(d.visits, d.items, d.as_of, types, d.regions)
    return ranking.population_stats(rows, {"region": d.region_list, "type": types}, None)


def with_avatars(d: Inputs, board: DataFrame) -> DataFrame:
    return ranking.with_avatars(board, merge.pictures(d.avatars))


# --- items ------------------------------------------------------------------------------------

ITEM_GROUPS = ["region", "type_key", "type", "range"]


def _item_cube(d: Inputs, types, ranges, rows: DataFrame | None = None) -> DataFrame:
    if rows is None:
        rows = scores.item_scores(d.visits, d.items, d.as_of, types, ranges)
    return scores.item_score_cube(rows, d.regions)


def item_board(
    d: Inputs,
    types=scores.ITEM_TYPES,
    ranges=fixed.RANGES,
    margins: str = "cube",
    limit: int = fixed.ITEM_LIMIT,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Top items by ``region``, by item ``type``, or by both (``cube``, margins included)."""
    by_region, by_type = {"region": (True, False), "type": (False, True), "cube": (True, True)}[margins]
    if rows is None:
        rows = scores.item_scores(d.visits, d.items, d.as_of, types, ranges)
    board = ranking.leaderboard(
        scores.item_score_cells(rows, d.regions, by_region, by_type),
        ITEM_GROUPS,
        key="code",
        limit=limit,
        extra=["name", "owner", "geocache_type"],
        margins=["region", "type_key"],
    )
    return board.withColumn("type_label", scopes.type_label())


def item_stats(
    d: Inputs, types=scores.ITEM_TYPES, ranges=fixed.RANGES, rows: DataFrame | None = None
) -> DataFrame:
    domains = {
        "region": d.region_list,
        "type_key": ["all", *fixed.TYPE_KEYS],
        "type": list(types),
        "range": list(ranges),
    }
    return ranking.population_stats(_item_cube(d, types, ranges, rows), domains, empty_growth=None)


# --- cities -----------------------------------------------------------------------------------

def city_board(
    d: Inputs,
    types=("hides", "finds", "favorites"),
    ranges=fixed.RANGES,
    limit: int = fixed.CITY_LIMIT,
) -> DataFrame:
    rows = scores.city_scores(d.visits, d.items, d.as_of, types, ranges)
    board = ranking.leaderboard(
        rows,
        ["type", "range"],
        limit=limit,
        extra=["country"],
        tie_order=["country"],
        key_repeats=True,
    )
    return city_captions(d, board)


def city_captions(d: Inputs, board: DataFrame) -> DataFrame:
    """Province or region name under each city."""
    if d.provinces is not None:
        named = d.provinces.select(F.col("city").alias("name"), F.col("province").alias("_province"))
        board = board.join(named, "name", "left")
    else:
        board = board.withColumn("_province", F.lit(None).cast("string"))
    caption = scopes.city_subtitle(
        "name", "country", F.col("_province"), d.subtitles, d.home_country
    )
    return board.withColumn("subtitle", caption).drop("_province", "country")


def city_details(d: Inputs, board: DataFrame) -> DataFrame:
    """One row per ranked city: growth, ten months, ten years and the 81-cell matrix.

    Only items of ranked cities are looked at; the list of those cities is written once and is as
    short as the board. All lists are bounded per city.
    """
    ranked = materialise(board.select(F.col("name").alias("city")).distinct(), "ranked-cities")
    named = ranked.select(F.col("city").alias("_city"))
    items = d.items.join(named, scopes.effective_city() == F.col("_city"), "left_semi")
    point = F.struct("label", "count", "archived")
    first, last = (trends.year_total(d.as_of, end) for end in (0, -1))
    monthly = (
        trends.city_monthly(items, d.as_of)
        .groupBy("city")
        .agg(F.array_sort(F.collect_list(point)).alias("monthly"))
    )
    yearly = (
        trends.city_yearly(items, d.as_of)
        .groupBy("city")
        .agg(
            F.array_sort(F.collect_list(point)).alias("yearly"),
            trends.growth_between(first, last).alias("average_growth_pct"),
        )
    )
    matrix = grid.attach_top(
        grid.dense_matrix(grid.dt_counts(items, "city"), trends.cities(items), "city"),
        grid.dt_top(items, "city"),
        "city",
    )
    cell = F.struct("row", "col", "difficulty", "terrain", "count", "top_caches")
    cells = matrix.groupBy("city").agg(F.array_sort(F.collect_list(cell)).alias("dt_matrix"))
    return (
        monthly.join(yearly, "city")
        .join(cells, "city")
        .join(ranked, "city", "right")
        .withColumn("average_growth_pct", F.coalesce("average_growth_pct", F.lit(0.0)))
    )


# --- overview ---------------------------------------------------------------------------------

def overview(d: Inputs) -> DataFrame:
    """Everything of the overview as (region, section, key, value) rows."""

    def measures(frame: DataFrame, section: str, label, names) -> DataFrame:
        cells = F.explode(
            F.array(*[F.struct(F.lit(n).alias("n"), F.col(n).cast("bigint").alias("v")) for n in names])
        )
        return frame.select("region", F.lit(section).alias("section"), label.alias("_l"), cells.alias("_c")).select(
            "region",
            "section",
            F.concat_ws(" ", "_l", "_c.n").alias("key"),
            F.col("_c.v").alias("value"),
        )

    none = F.lit(None).cast("string")
    cell = F.concat_ws(",", F.col("row").cast("string"), F.col("col").cast("string"))
    spot = F.concat_ws(
        ",",
        F.col("latitude").cast("decimal(8,2)").cast("string"),
        F.col("longitude").cast("decimal(8,2)").cast("string"),
    )
    parts = [
        measures(
            summary.scope_metrics(d.visits, d.items, d.regions), "metrics", none,
            ["total_caches", "total_owners", "total_finders", "total_logs"],
        ),
        measures(summary.active_counts(d.items, d.regions), "active", none, ["active_items"]),
        measures(
            trends.yearly_trend(d.items, d.as_of, d.regions), "trend", F.col("year"),
            ["total", "ytd_cache", "archived"],
        ),
        measures(grid.dt_matrix(d.items, d.regions), "matrix", cell, ["count"]),
    ]
    for time_range in ("30d", "ytd"):
        heat = grid.heat_counts(d.visits, d.items, d.as_of, time_range, d.regions)
        parts.append(measures(heat, f"heatmap_{time_range}", spot, ["count"]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- documents --------------------------------------------------------------------------------

def generation_stamp(d: Inputs, made: datetime) -> DataFrame:
    return spine(d.items.sparkSession, version=[fixed.REPORT_VERSION]).select(
        text.iso_millis(F.lit(made)).alias("generatedAt"), "version"
    )


def overview_sections(d: Inputs) -> dict[str, DataFrame]:
    named = F.create_map(*[F.lit(x) for kv in fixed.REGION_NAMES.items() for x in kv])
    shares = summary.region_shares(d.items, d.regions)
    out = {
        "metrics": documents.camel_rows(summary.scope_metrics(d.visits, d.items, d.regions)),
        "yearly-trend": documents.nest_lists(
            trends.yearly_trend(d.items, d.as_of, d.regions), ["region"], ["year"], "yearlyTrend"
        ),
        "dt-matrix": documents.nest_lists(
            grid.dt_matrix(d.items, d.regions), ["region"], ["row", "col"], "dtMatrix"
        ),
        "regions": shares.select(
            F.col("region").alias("key"),
            F.coalesce(named[F.col("region")], F.col("region")).alias("name"),
            F.col("total_caches").alias("totalCaches"),
            "percentage",
        ),
    }
    for time_range in ("30d", "ytd"):
        # One line per point: a heatmap has no bound that would let it be one array.
        out[f"heatmap-{time_range}"] = grid.heatmap(
            d.visits, d.items, d.as_of, time_range, d.regions
        )
    return out


def _nested_board(board: DataFrame, path: list[str], order: str) -> DataFrame:
    lists = documents.nest_lists(board, path, ["rank", order], "rankings")
    return documents.nest_maps(lists, path, "rankings")


def _nested_stats(stats: DataFrame, path: list[str]) -> DataFrame:
    entry = documents.camel_struct(["player_count", "player_count_growth_pct"])
    return documents.nest_maps(stats.select(*path, entry.alias("stats")), path, "stats")


def player_sections(d: Inputs) -> dict[str, DataFrame]:
    """Scores feed a board and its stats, so each family is computed once and written."""
    single = ["region", "type"]
    players = materialise(
        scores.player_scores(d.visits, d.items, d.as_of, regions=d.regions), "player-scores"
    )
    newbies = materialise(
        scores.newbie_scores(d.visits, d.items, d.users, d.as_of, regions=d.regions, whole=players),
        "newbie-scores",
    )
    events = materialise(
        scores.event_scores(d.visits, d.items, d.as_of, regions=d.regions), "event-scores"
    )
    boards = {
        "rankings": (player_board(d, rows=players), RANKED),
        "newbie-rankings": (newbie_board(d, rows=newbies), single),
        "event-rankings": (event_board(d, rows=events), single),
    }
    out = {
        name: _nested_board(board, path, "name")
        for name, (board, path) in boards.items()
    }
    return out | {
        "ranking-stats": _nested_stats(player_stats(d, rows=players), RANKED),
        "newbie-stats": _nested_stats(newbie_stats(d, rows=newbies), single),
        "event-stats": _nested_stats(event_stats(d, rows=events), single),
        "community": documents.camel_rows(summary.community_stats(d.visits, d.items, d.as_of)),
    }


def item_sections(d: Inputs) -> dict[str, DataFrame]:
    """All margins at once: region "all" and type key "all" are the unfiltered lists."""
    rows = materialise(scores.item_scores(d.visits, d.items, d.as_of), "item-scores")
    return {
        "rankings": _nested_board(item_board(d, rows=rows), ITEM_GROUPS, "code"),
        "ranking-stats": _nested_stats(item_stats(d, rows=rows), ITEM_GROUPS),
    }


def city_sections(d: Inputs) -> dict[str, DataFrame]:
    board = materialise(city_board(d), "city-board")
    yearly = trends.yearly10_trend(d.items, d.as_of)
    matrix = grid.attach_top(
        grid.dt_matrix(d.items, {}), grid.dt_top(d.items, "region", regions={}), "region"
    )
    return {
        "rankings": _nested_board(board, ["type", "range"], "name"),
        "trend-monthly": documents.camel_rows(trends.monthly_trend(d.items, d.as_of)),
        "trend-yearly": documents.camel_rows(yearly),
        "trend-growth": documents.camel_rows(trends.average_growth(yearly, d.as_of)),
        "dt-matrix": documents.nest_lists(matrix, ["region"], ["row", "col"], "dtMatrix"),
        "city-details": documents.camel_rows(city_details(d, board)),
    }


def publish(d: Inputs, path: str, made: datetime) -> None:
    """Write every report below ``path``; any failure fails the whole publication."""
    documents.write_sections(overview_sections(d), f"{path}/overview")
    documents.write_sections(player_sections(d), f"{path}/player-rankings")
    documents.write_sections(item_sections(d), f"{path}/cache-rankings")
    documents.write_sections(city_sections(d), f"{path}/city-rankings")
    documents.write_sections({"stamp": generation_stamp(d, made)}, f"{path}/generated-at")
