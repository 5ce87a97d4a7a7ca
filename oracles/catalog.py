"""SQL statement by query name."""

from __future__ import annotations

from oracles import boards as b
from oracles import ingest as i

PLAYERS = ("finds", "ftf", "hides", "logs", "favorites")
PLACES = ("hides", "finds", "favorites", "logs")
ENTRIES = ("logs", "favorites")
R = b.RANGES


def _overview() -> str:
    def rows(sql: str, section: str, label: str, names) -> str:
        return b.union(
            f"SELECT region, '{section}' AS section, {label}'{n}' AS key, CAST(\"{n}\" AS BIGINT) AS value FROM ({sql})"
            for n in names
        )

    spot = "CAST(CAST(latitude AS DECIMAL(8,2)) AS VARCHAR) || ',' || CAST(CAST(longitude AS DECIMAL(8,2)) AS VARCHAR) || ' ' || "
    return b.union(
        [
            rows(b.scope_counts(), "metrics", "", ("total_caches", "total_owners", "total_finders", "total_logs")),
            rows(b.active_count(), "active", "", ("active_items",)),
            rows(b.yearly_trend(), "trend", "year || ' ' || ", ("total", "ytd_cache", "archived")),
            rows(b.dt_matrix(), "matrix", "row || ',' || col || ' ' || ", ("count",)),
            rows(b.heatmap("30d"), "heatmap_30d", spot, ("count",)),
            rows(b.heatmap("ytd"), "heatmap_ytd", spot, ("count",)),
        ]
    )


def _city_details() -> str:
    board = b.city_board(("hides", "finds", "favorites"), R)
    points = b.union(
        f"SELECT city, '{part}' AS part, label AS key, \"count\", archived, '' AS top FROM ({b.city_trend(part == 'monthly')})"
        for part in ("monthly", "yearly")
    )
    full = (
        "SELECT city, a.i AS r, c.i AS k, 1 + a.i * 0.5 AS difficulty, 1 + c.i * 0.5 AS terrain FROM cities, "
        "(SELECT unnest(generate_series(0, 8)) AS i) a, (SELECT unnest(generate_series(0, 8)) AS i) c"
    )
    top = f"SELECT city, difficulty, terrain, string_agg(code, ',' ORDER BY place) AS top FROM ({b.dt_top('city')}) GROUP BY 1, 2, 3"
    cells = (
        "SELECT city, 'cell' AS part, r || ',' || k AS key, coalesce(\"count\", 0) AS \"count\", 0 AS archived, coalesce(top, '') AS top "
        f"FROM ({full}) LEFT JOIN ({b.city_dt()}) USING (city, difficulty, terrain) LEFT JOIN ({top}) USING (city, difficulty, terrain)"
    )
    return (
        f"WITH cities AS (SELECT DISTINCT name AS city FROM ({board})), pts AS ({points} UNION ALL {cells}), "
        f"g AS ({b.city_cagr()}) SELECT city, average_growth_pct, part, key, \"count\", archived, top "
        "FROM cities JOIN pts USING (city) JOIN g USING (city)"
    )


def statements() -> dict[str, str]:
    out = {}
    for r in R:
        for k in PLAYERS:
            out[f"player_{k}_{r}"] = b.player_board((k,), (r,))
        for k in PLACES:
            out[f"city_{k}_{r}"] = b.city_board((k,), (r,))
        for k in ENTRIES:
            out[f"item_rank_{k}_{r}"] = b.item_board((k,), (r,))
    summary = "SELECT page_id, title, profile_name, joined_context, markers, looks_like_profile FROM"
    out |= {
        "player_board": b.player_board(PLAYERS, R),
        "player_stats": b.player_stats(PLAYERS, R),
        "newbie_board": b.newbie_board(("finds", "hides")),
        "newbie_finds": b.newbie_board(("finds",)),
        "newbie_hides": b.newbie_board(("hides",)),
        "newbie_stats": b.newbie_stats(),
        "event_board": b.event_board(("hosts", "participants")),
        "event_hosts": b.event_board(("hosts",)),
        "event_participants": b.event_board(("participants",)),
        "event_stats": b.event_stats(),
        "event_prev_year_window": b.event_board(("hosts", "participants"), True),
        "item_board": b.item_board(ENTRIES, R),
        "item_board_type": b.item_board(ENTRIES, R, "type"),
        "item_board_cube": b.item_board(ENTRIES, R, "cube"),
        "item_rank_by_type": b.item_board(("logs",), ("ytd",), "type"),
        "item_stats": b.item_stats(ENTRIES, R),
        "city_board": b.city_board(("hides", "finds", "favorites"), R),
        "city_details": _city_details(),
        "rank_with_avatar": b.player_board(("finds",), ("ytd",)),
        "leaderboard_limit": b.limited("finds", "active", 30),
        "ranked_names": b.ranked_names(),
        "scope_counts": b.scope_counts(),
        "active_count": b.active_count(),
        "region_share": b.region_share(),
        "community_stats": b.community(),
        "community_incremental": b.community_regions(),
        "yearly_trend": b.yearly_trend(),
        "monthly_trend": b.trend(True),
        "yearly10_trend": b.trend(False),
        "city_trend_one": b.trend(False, "NATION_3"),
        "city_monthly": b.city_trend(True),
        "city_yearly": b.city_trend(False),
        "city_cagr": b.city_cagr(),
        "heatmap_30d": b.heatmap("30d"),
        "heatmap_ytd": b.heatmap("ytd"),
        "dt_matrix": b.dt_matrix(),
        "dt_top": b.dt_top("region"),
        "city_dt": b.city_dt(),
        "city_dt_top": b.dt_top("city"),
        "overview": _overview(),
        "time_range_matrix": b.time_range_matrix(),
        "unassigned_diag": i.UNASSIGNED,
        "missing_coords": i.MISSING,
        "user_candidates": i.CANDIDATES,
        "user_candidates_500": i.CANDIDATES_500,
        "candidate_count": i.CANDIDATE_COUNT,
        "guid_conflicts": i.CONFLICTS,
        "page_scan": i.PAGE_SCAN,
        "archived_keyset": i.ARCHIVED,
        "type_labels": i.TYPE_LABELS,
        "city_subtitle": i.SUBTITLES,
        "growth_round": i.GROWTH,
        "item_flatten": i.item_flatten(),
        "box_filter": i.box_filter(),
        "visit_flatten": i.VISIT_FLATTEN,
        "accepted_types": i.ACCEPTED,
        "visit_dedup": i.dedup(),
        "visit_keep_latest": i.keep_latest(),
        "visit_diff": i.visit_diff(),
        "visit_merge": i.visit_merge(),
        "visit_insert_absent": i.insert_absent(),
        "change_summary": i.change_summary(),
        "change_details": i.change_details(),
        "item_diff": i.item_diff(),
        "item_merge": i.item_merge(),
        "item_merge_parts": i.item_merge(),
        "visit_merge_parts": i.visit_merge(),
        "item_change_log": i.item_change_log(),
        "visit_change_log": i.visit_change_log(),
        "canonical_item": i.canonical_item(),
        "vanished_items": b.with_views(i.vanished(f"{i.NUM} % 97 <> 0"), "items"),
        "vanished_boxes": i.vanished_boxes(),
        "vanished_checked": i.vanished_checked(),
        "unknown_fields": i.UNKNOWN_FIELDS,
        "extra_fields": i.EXTRA_FIELDS,
        "page_of_layout": i.PAGE_OF_LAYOUT,
        "scope_counts_bucketed": b.scope_counts(),
        "item_board_bucketed": b.item_board(ENTRIES, R),
        "refresh_candidates": i.REFRESH,
        "work_split": i.WORK,
        "status_lookup": i.STATUS,
        "keyed_update": i.KEYED,
        "backfill_fields": i.BACKFILL,
        "rejects": i.REJECTS,
        "schema_evolve": i.EVOLVE,
        "completeness_check": i.COMPLETE,
        "request_digest": i.DIGEST,
        "user_merge": i.USER_MERGE,
        "user_last_wins": i.LAST_WINS,
        "avatar_merge": i.AVATAR_MERGE,
        "avatar_resolve": i.AVATAR_RESOLVE,
        "avatar_tally": i.AVATAR_TALLY,
        "page_fields": i.PAGE_FIELDS,
        "page_summary": f"{summary} ({i.PAGE_SUMMARY})",
        "page_class": i.PAGE_CLASS,
        "first_pattern": i.FIRST_PATTERN,
        "build_id": i.BUILD_ID,
        "item_page_fields": i.ITEM_PAGE_FIELDS,
        "ftf_marker": i.FTF,
        "date_normalise": i.DATES,
        "ts_normalise": i.STAMPS,
        "parse_joined_date": i.JOINED,
        "avatar_extract": i.AVATAR_EXTRACT,
        "first_country": i.COUNTRY,
        "status_resolve": i.RESOLVE,
        "nearest_area": i.nearest_area(),
        "stream_visit_merge": i.dedup(),
        "stream_resume": i.resume(),
        "stream_newest": i.dedup(),
        "stream_retry": i.retry(),
    }
    return out
