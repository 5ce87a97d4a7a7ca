"""Score families: who or what scored how much, per region, type and time range.

Each family reads the visit table once for every requested type, range and period together.
Visits are collapsed *before* they meet the items: to one row per (item, visitor) where the
score needs the visitor, to one row per item otherwise. The collapse is a partial aggregate, so
an item that holds a large part of all visits shrinks on the map side, and what is left for the
join on the item code is AQE's to broadcast or to split. Distinct item counts become sums of
0/1 flags over those pairs, without ``count(distinct)``.

The result is long: one row per key with ``score`` and ``prev_score``, both periods side by
side, so rank movement needs no second pass over the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailsight.functions import fixed, scopes
from trailsight.functions.periods import Clock, between_days_sql

PLAYER_TYPES = ("finds", "ftf", "hides", "logs", "favorites")
CITY_TYPES = ("hides", "finds", "favorites", "logs")
ITEM_TYPES = ("logs", "favorites")
SIDES = (("cur", False), ("prev", True))

_METRIC = {  # which visit counter feeds which score
    "finds": "visits",
    "logs": "visits",
    "ftf": "firsts",
    "favorites": "points",
}
_METRIC_FLAG = {"firsts": "is_ftf", "points": "favorite_point_used"}


def _window(time_range: str) -> str:
    # "active" and "all" look at the same days; only their item scope differs.
    return "any" if time_range in ("active", "all") else time_range


def _periods(ranges: Sequence[str]) -> list[tuple[str, str, bool]]:
    """(window, a range it stands for, previous) of the distinct periods; its index is its bit."""
    seen = {}
    for time_range in ranges:
        for _, previous in SIDES:
            seen.setdefault((_window(time_range), previous), time_range)
    return [(w, r, p) for (w, p), r in seen.items()]


def _bit(ranges: Sequence[str], time_range: str, side: str) -> int:
    wanted = (_window(time_range), side == "prev")
    return [(w, p) for w, _, p in _periods(ranges)].index(wanted)


def _counter(metric: str, time_range: str, side: str) -> str:
    return f"{metric}_{_window(time_range)}_{side}"


def _cell(kind: str, time_range: str, side: str) -> str:
    return f"{kind}_{time_range}_{side}"


def collapse_visits(
    visits: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    ranges: Sequence[str],
    clock: Clock,
    presence: bool = False,
) -> DataFrame:
    """Valid visits per key: a counter per metric and period, and with ``presence`` a bit mask
    of the periods that have any visit.

    The periods of a visit are worked out once per row, as bits of one integer.
    """
    periods = _periods(ranges)
    mask = " + ".join(
        f"CASE WHEN {clock.within_sql('visited', time_range, previous)} THEN {1 << bit} ELSE 0 END"
        for bit, (_, time_range, previous) in enumerate(periods)
    )
    bounds = [clock.bounds(r, p) for _, r, p in periods]
    lows, highs = [low for low, _ in bounds], [high for _, high in bounds]
    # The hull of all periods is pushed to the scan: a 30-day board reads 60 days.
    hull = between_days_sql(
        "visited",
        None if None in lows else min(lows),
        None if None in highs else max(highs),
    )
    rows = visits.filter(scopes.visit_valid() & F.expr(hull)).selectExpr(
        *keys, f"{mask} AS _visits", *[f"{c} AS _{m}" for m, c in _METRIC_FLAG.items() if m in metrics]
    )
    counters = [
        F.expr(
            f"sum(getbit({f'IF(_{m}, _visits, 0)' if m in _METRIC_FLAG else '_visits'}, {bit})) "
            f"AS {m}_{w}_{'prev' if p else 'cur'}"
        )
        for m in metrics
        for bit, (w, _, p) in enumerate(periods)
    ]
    if presence:
        counters.append(F.expr("bit_or(_visits) AS present"))
    return rows.groupBy(*keys).agg(*counters)


def slim_items(items: DataFrame, *extra: str) -> DataFrame:
    """The item columns scores need, with both range scopes evaluated once."""
    return items.filter(scopes.ranked()).select(
        F.col("code").alias("gc_code"),
        "country",
        scopes.active().alias("_active"),
        *extra,
    )


def _cell_names(types: Sequence[str], ranges: Sequence[str]) -> list[tuple[str, str, str, bool]]:
    return [(k, r, s, p) for k in types for r in ranges for s, p in SIDES]


def _scoped(time_range: str, value: str, name: str) -> str:
    """SQL of a score that only items in the scope of the range contribute to."""
    scope = "true" if time_range == "all" else "_active"
    return f"CAST(CASE WHEN {scope} THEN {value} ELSE 0 END AS BIGINT) AS {name}"


def _placed(clock: Clock, time_range: str, previous: bool) -> str:
    return f"coalesce(CAST({clock.within_sql('placed_date', time_range, previous)} AS INT), 0)"


def _long(wide: DataFrame, keys: Sequence[str], cells: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """One row per cell (type, range, score, prev_score) that scored in either period."""
    packed = ", ".join(
        f"struct({t} AS type, '{r}' AS range, {s} AS score, {p} AS prev_score)" for t, r, s, p in cells
    )
    return (
        wide.selectExpr(*keys, f"explode(array({packed})) AS _c")
        .select(*keys, "_c.type", "_c.range", "_c.score", "_c.prev_score")
        .filter("score > 0 OR prev_score > 0")
    )


def _cells(types: Sequence[str], ranges: Sequence[str]) -> list[tuple[str, str, str, str]]:
    return [
        (f"'{k}'", r, _cell(k, r, "cur"), _cell(k, r, "prev")) for k in types for r in ranges
    ]


def with_total(rows: DataFrame, measures: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Sums of measures per ``region`` and keys, and over all regions as region ``all``.

    Rows are summed by their own region first; the totals are rolled up from those partial sums, so
    facts are never repeated for the regions they count in. A NULL region counts in ``all`` only.
    """
    own = rows.groupBy("region", *keys).agg(*_sums(measures))
    level = ["region", *keys]
    both = own.groupingSets([level, list(keys)], *level).agg(*_sums(measures), F.grouping("region").alias("_total"))
    named = F.when(F.col("_total") == 1, F.lit("all")).otherwise(F.col("region"))
    return both.select(named.alias("region"), *keys, *measures).filter("region IS NOT NULL")


def _sums(names: Sequence[str]) -> list[Column]:
    return [F.expr(f"sum({n}) AS {n}") for n in names]


# What each role scores: a first and a second measure, summed in the same two sets of columns.
_ROLES = {"visitor": ("finds", "ftf"), "owner": ("logs", "favorites"), "placer": ("hides", None)}


def player_scores(
    visits: DataFrame,
    items: DataFrame,
    as_of: date,
    types: Sequence[str] = PLAYER_TYPES,
    ranges: Sequence[str] = fixed.RANGES,
    regions: Mapping[str, str] = fixed.REGIONS,
) -> DataFrame:
    """(region, type, range, name, score, prev_score) for people.

    Visitors score finds (distinct items) and firsts; owners score visits by others and
    favourite points on their items, and the items they placed.
    """
    clock = Clock(as_of)
    roles = [r for r, pair in _ROLES.items() if any(t in pair for t in types)]
    measures = [i for i in (0, 1) if any(_ROLES[r][i] in types for r in roles)]

    def columns(credit) -> list[str]:
        """One summable column per measure, range and period, from SQL by ``credit``."""
        return [
            _scoped(r, credit(i, r, side), f"m{i}_{r}_{side}")
            for i in measures
            for r in ranges
            for side, _ in SIDES
        ]

    parts = []
    by_visit = [r for r in roles if r != "placer"]
    if by_visit:
        if "favorites" not in types:
            named = "user_name IS NOT NULL" + ("" if "logs" in types else " AND user_name != ''")
            visits = visits.filter(named)
        keys = ["gc_code"] if set(types) <= {"favorites", "hides"} else ["gc_code", "user_name"]
        metrics = sorted({_METRIC[t] for t in types if t not in ("finds", "hides")})
        pairs = collapse_visits(visits, keys, metrics, ranges, clock, presence="finds" in types)
        joined = pairs.join(slim_items(items, "owner_username"), "gc_code")
        names = {"visitor": "user_name", "owner": "owner_username"}
        who = ", ".join(f"struct('{r}' AS role, {names[r]} AS name)" for r in by_visit)
        others = "lower(user_name) != lower(owner_username) AS _others"
        people = (
            joined.selectExpr("*", f"explode(array({who})) AS _who", *([others] if "logs" in types else []))
            .selectExpr("*", "_who.role AS role", "_who.name AS name")
            .filter(scopes.filled("name") & ((F.col("role") == "visitor") | scopes.owner_valid("name")))
        )

        def credit(i: int, r: str, side: str) -> str:
            arms = ""
            for role in by_visit:
                kind = _ROLES[role][i]
                if kind not in types:
                    continue
                if kind == "finds":
                    got = f"getbit(present, {_bit(ranges, r, side)})"
                else:
                    got = _counter(_METRIC[kind], r, side)
                only = " AND _others" if kind == "logs" else ""
                arms += f" WHEN role = '{role}'{only} THEN {got}"
            return f"CASE{arms} ELSE 0 END" if arms else "0"

        parts.append(
            people.select(
                scopes.own_region("country", regions).alias("region"), "role", "name",
                *[F.expr(c) for c in columns(credit)],
            )
        )
    if "placer" in roles:
        previous = dict(SIDES)
        parts.append(
            slim_items(items, "owner_username", "placed_date")
            .filter(scopes.owner_valid())
            .select(
                scopes.own_region("country", regions).alias("region"),
                F.lit("placer").alias("role"),
                F.col("owner_username").alias("name"),
                *[
                    F.expr(c)
                    for c in columns(
                        lambda i, r, side: _placed(clock, r, previous[side]) if i == 0 else "0"
                    )
                ],
            )
        )
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    wide = with_total(both, [f"m{i}_{r}_{side}" for i in measures for r in ranges for side, _ in SIDES], ["role", "name"])

    def kind_of(i: int) -> str:
        arms = [(role, _ROLES[role][i]) for role in roles if _ROLES[role][i] in types]
        return "CASE role " + " ".join(f"WHEN '{role}' THEN '{kind}'" for role, kind in arms) + " END"

    cells = [(kind_of(i), r, f"m{i}_{r}_cur", f"m{i}_{r}_prev") for i in measures for r in ranges]
    return _long(wide, ["region", "name"], cells).filter("type IS NOT NULL").select(
        "region", "type", "range", "name", "score", "prev_score"
    )


def city_scores(
    visits: DataFrame,
    items: DataFrame,
    as_of: date,
    types: Sequence[str] = CITY_TYPES,
    ranges: Sequence[str] = fixed.RANGES,
) -> DataFrame:
    """(name, country, type, range, score, prev_score) per city and country; plain counts."""
    if "ftf" in types:
        raise ValueError("first-to-find scores exist for players only")
    clock = Clock(as_of)
    grid = _cell_names(types, ranges)
    city = scopes.effective_city().alias("name")
    parts = []
    by_visit = [t for t in types if t != "hides"]
    if by_visit:
        metrics = sorted({_METRIC[t] for t in by_visit})
        counted = collapse_visits(visits, ["gc_code"], metrics, ranges, clock)
        cells = [
            _scoped(r, "0" if k == "hides" else _counter(_METRIC[k], r, s), _cell(k, r, s))
            for k, r, s, _ in grid
        ]
        joined = counted.join(slim_items(items, "city"), "gc_code")
        parts.append(joined.select(city, "country", *[F.expr(c) for c in cells]))
    if "hides" in types:
        cells = [
            _scoped(r, _placed(clock, r, p) if k == "hides" else "0", _cell(k, r, s))
            for k, r, s, p in grid
        ]
        placed = slim_items(items, "city", "placed_date")
        parts.append(placed.select(city, "country", *[F.expr(c) for c in cells]))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    wide = (
        both.filter("name IS NOT NULL")
        .groupBy("name", "country")
        .agg(*_sums([_cell(k, r, s) for k, r, s, _ in grid]))
    )
    return _long(wide, ["name", "country"], _cells(types, ranges))


def item_scores(
    visits: DataFrame,
    items: DataFrame,
    as_of: date,
    types: Sequence[str] = ITEM_TYPES,
    ranges: Sequence[str] = fixed.RANGES,
) -> DataFrame:
    """(code, name, owner, geocache_type, country, type, range, score, prev_score) per item."""
    clock = Clock(as_of)
    metrics = sorted({_METRIC[t] for t in types})
    counted = collapse_visits(visits, ["gc_code"], metrics, ranges, clock)
    entries = slim_items(
        items.filter(scopes.item_entry_valid()),
        "name",
        F.col("owner_username").alias("owner"),
        "geocache_type",
    )
    keys = ["code", "name", "owner", "geocache_type", "country"]
    wide = counted.join(entries, "gc_code").selectExpr(
        "gc_code AS code",
        *keys[1:],
        *[
            _scoped(r, _counter(_METRIC[k], r, s), _cell(k, r, s))
            for k, r, s, _ in _cell_names(types, ranges)
        ],
    )
    return _long(wide, keys, _cells(types, ranges))


def item_score_cube(scores: DataFrame, regions: Mapping[str, str] = fixed.REGIONS) -> DataFrame:
    """Repeat item scores for every (region, type filter) margin they belong to."""
    return scores.withColumn("region", F.explode(scopes.region_keys("country", regions))).withColumn(
        "type_key", F.explode(scopes.type_keys())
    )


def item_score_cells(scores: DataFrame, regions: Mapping[str, str] = fixed.REGIONS, by_region: bool = True, by_type: bool = True) -> DataFrame:
    """Item scores with the region and the type filter that they belong to, NULL for none, or for a
    margin that is not wanted."""
    none = F.lit(None).cast("string")
    return scores.withColumn("region", scopes.own_region("country", regions) if by_region else none).withColumn(
        "type_key", scopes.own_type() if by_type else none
    )


def newbie_scores(
    visits: DataFrame,
    items: DataFrame,
    users: DataFrame,
    as_of: date,
    types: Sequence[str] = ("finds", "hides"),
    regions: Mapping[str, str] = fixed.REGIONS,
    whole: DataFrame | None = None,
) -> DataFrame:
    """Finds and hides of people by registration cohort: this year's is the score, last year's
    the previous score. People are matched on the lower-case name, once per spelling, and after
    scoring: the join sees one row per name and region instead of one per visit. ``whole`` are the
    scores of all people, where they are at hand already.
    """
    clock = Clock(as_of)
    if whole is None:
        whole = player_scores(visits, items, as_of, types, ("all",), regions)
    whole = whole.filter((F.col("range") == "all") & F.col("type").isin(*types))
    cohorts = (
        users.filter(
            clock.cohort("registration_date") | clock.cohort("registration_date", previous=True)
        )
        .groupBy(F.lower("user_name").alias("_key"))
        .agg(
            F.bool_or(clock.cohort("registration_date")).alias("_new"),
            F.bool_or(clock.cohort("registration_date", previous=True)).alias("_old"),
        )
    )
    return (
        whole.filter(F.col("score") > 0)
        .withColumn("_key", F.lower(F.trim("name")))
        .join(cohorts, "_key")
        .select(
            "region",
            "type",
            "name",
            F.when(F.col("_new"), F.col("score")).otherwise(F.lit(0)).alias("score"),
            F.when(F.col("_old"), F.col("score")).otherwise(F.lit(0)).alias("prev_score"),
        )
    )


def event_scores(
    visits: DataFrame,
    items: DataFrame,
    as_of: date,
    types: Sequence[str] = ("hosts", "participants"),
    regions: Mapping[str, str] = fixed.REGIONS,
    previous_window: bool = False,
) -> DataFrame:
    """Distinct events hosted and attended. The previous score is everything before this year,
    or only last calendar year with ``previous_window``.
    """
    clock = Clock(as_of)
    previous_range = "ytd" if previous_window else "all"
    events = items.filter(scopes.event())
    parts = []
    if "hosts" in types:
        parts.append(
            events.filter(scopes.owner_valid()).select(
                F.lit("hosts").alias("type"),
                F.col("owner_username").alias("name"),
                "country",
                F.lit(True).alias("now"),
                clock.within("placed_date", previous_range, True).alias("before"),
            )
        )
    if "participants" in types:
        pairs = (
            visits.filter((F.col("log_type") == fixed.ATTENDED) & scopes.filled("user_name"))
            .groupBy("gc_code", "user_name")
            .agg(F.bool_or(clock.within("visited", previous_range, True)).alias("before"))
        )
        parts.append(
            pairs.join(events.select(F.col("code").alias("gc_code"), "country"), "gc_code").select(
                F.lit("participants").alias("type"),
                F.col("user_name").alias("name"),
                "country",
                F.lit(True).alias("now"),
                "before",
            )
        )
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return (
        both.withColumn("region", F.explode(scopes.region_keys("country", regions)))
        .groupBy("region", "type", "name")
        .agg(F.count_if("now").alias("score"), F.count_if("before").alias("prev_score"))
    )
