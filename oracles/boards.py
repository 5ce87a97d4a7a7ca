"""SQL statements of the boards, populations and summary figures, for an independent engine."""

from __future__ import annotations

from trailsight.plans.views import REGIONS, with_views

TODAY = "DATE '2001-06-15'"
D30, D60 = "DATE '2001-05-16'", "DATE '2001-04-16'"
JAN1, JAN1_BEFORE = "DATE '2001-01-01'", "DATE '2000-01-01'"
YEAR_AGO, TWO_AGO = "DATE '2000-06-15'", "DATE '1999-06-15'"
RANGES = ("30d", "ytd", "active", "all")
EVENTS = "(6, 13, 3653)"


def period(column: str, rng: str, prev: bool) -> str:
    now = {"30d": f"{column} >= {D30}", "ytd": f"{column} >= {JAN1}"}.get(rng, "TRUE")
    before = {
        "30d": f"{column} >= {D60} AND {column} < {D30}",
        "ytd": f"{column} >= {JAN1_BEFORE} AND {column} < {JAN1}",
    }.get(rng, f"{column} < {JAN1}")
    return f"({before if prev else now})"


REGION_ROWS = "VALUES " + ", ".join(f"('{k}', '{c}')" for k, c in REGIONS.items())
BASE = f"""
 it AS (SELECT *, coalesce(cache_status, 0) <> 404 AND geocache_type NOT IN {EVENTS} AS rnk,
   coalesce(cache_status, 0) NOT IN (2, 404) AND geocache_type NOT IN {EVENTS} AS act,
   coalesce(cache_status, 0) <> 404 AND geocache_type IN {EVENTS} AS evt,
   owner_username IS NOT NULL AND owner_username NOT IN ('', '[DELETED_USER]') AS own,
   coalesce(nullif(trim(city), ''), country) AS place FROM items),
 jv AS (SELECT v.gc_code, v.user_name, v.visited, v.favorite_point_used, v.is_ftf, v.log_type, it.*
   FROM visits v JOIN it ON it.code = v.gc_code WHERE v.log_type <> 'deleted'),
 reg(rkey, rcountry) AS ({REGION_ROWS})"""


def base(*more: str) -> str:
    """The WITH clause up to the common views, ready for further ones."""
    return with_views("", "items", "visits", *more).rstrip() + "," + BASE


def _scope(rng: str) -> str:
    return "rnk" if rng == "all" else "act"


def _people(kind: str, rng: str) -> str:
    cur, prev = (period("placed_date" if kind == "hides" else "visited", rng, p) for p in (False, True))
    count = "DISTINCT code" if kind == "finds" else "*"
    who, src, cond = {
        "finds": ("user_name", "jv", "user_name <> ''"),
        "ftf": ("user_name", "jv", "user_name <> '' AND is_ftf"),
        "hides": ("owner_username", "it", "own"),
        "logs": ("owner_username", "jv", "own AND lower(user_name) <> lower(owner_username)"),
        "favorites": ("owner_username", "jv", "own AND favorite_point_used"),
    }[kind]
    return (
        f"SELECT '{kind}' AS type, '{rng}' AS \"range\", {who} AS name, country, "
        f"count({count}) FILTER (WHERE {cur}) AS s, count({count}) FILTER (WHERE {prev}) AS p "
        f"FROM {src} WHERE {_scope(rng)} AND {cond} GROUP BY {who}, country"
    )


def _places(kind: str, rng: str) -> str:
    cur, prev = (period("placed_date" if kind == "hides" else "visited", rng, p) for p in (False, True))
    src = "it" if kind == "hides" else "jv"
    cond = "AND favorite_point_used" if kind == "favorites" else ""
    return (
        f"SELECT '{kind}' AS type, '{rng}' AS \"range\", place AS name, country, "
        f"count(*) FILTER (WHERE {cur}) AS s, count(*) FILTER (WHERE {prev}) AS p "
        f"FROM {src} WHERE {_scope(rng)} AND place IS NOT NULL {cond} GROUP BY place, country"
    )


def _entries(kind: str, rng: str) -> str:
    cur, prev = (period("visited", rng, p) for p in (False, True))
    cond = "AND favorite_point_used" if kind == "favorites" else ""
    return (
        f"SELECT '{kind}' AS type, '{rng}' AS \"range\", code, name, owner_username AS owner, geocache_type, country, "
        f"count(*) FILTER (WHERE {cur}) AS s, count(*) FILTER (WHERE {prev}) AS p "
        f"FROM jv WHERE {_scope(rng)} AND code <> '' AND name <> '' AND owner_username <> '' {cond} "
        "GROUP BY code, name, owner_username, geocache_type, country"
    )


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def regional(source: str, keys: str) -> str:
    """Totals over everything, and per published region."""
    return (
        f"SELECT 'all' AS region, {keys}, CAST(sum(s) AS BIGINT) AS s, CAST(sum(p) AS BIGINT) AS p FROM {source} GROUP BY {keys} "
        f"UNION ALL SELECT rkey, {keys}, CAST(sum(s) AS BIGINT), CAST(sum(p) AS BIGINT) FROM {source} JOIN reg ON country = rcountry GROUP BY rkey, {keys}"
    )


def ranked(source: str, part: str, key: str, limit: int, columns: str, tie: str = "") -> str:
    """Tied top lists of (part, key, s, p) rows with the movement against the previous list."""
    return f"""
 cur AS (SELECT *, rank() OVER (PARTITION BY {part} ORDER BY s DESC) AS rk,
   row_number() OVER (PARTITION BY {part} ORDER BY s DESC, {key}{tie}) AS rn FROM {source} WHERE s > 0),
 prv AS (SELECT {part}, {key}, rank() OVER (PARTITION BY {part} ORDER BY p DESC) AS pk FROM {source} WHERE p > 0),
 last AS (SELECT {part}, {key}, max(pk) AS pk FROM prv GROUP BY {part}, {key})
 SELECT {columns}, CAST(rk AS INT) AS rank, s AS score,
   CASE WHEN pk IS NULL OR pk > rk THEN 'up' WHEN pk < rk THEN 'down' ELSE 'flat' END AS trend,
   CAST(abs(pk - rk) AS INT) AS trend_delta
 FROM cur LEFT JOIN last USING ({part}, {key}) WHERE rk <= {limit} AND rn <= {2 * limit}"""


def player_board(types, ranges) -> str:
    scores = union(_people(k, r) for k in types for r in ranges)
    return with_avatar(
        f"{base()}, sc AS ({scores}), rs AS ({regional('sc', 'type, \"range\", name')}),"
        + ranked("rs", 'region, type, "range"', "name", 50, 'region, type, "range", name')
    )


SUBTITLE = (
    "CASE country WHEN 'EUROPE' THEN 'Europa' WHEN 'ASIA' THEN 'Asia' WHEN 'AFRICA' THEN 'Africa' "
    "WHEN 'AMERICA' THEN 'America' ELSE country END"
)


def city_board(types, ranges, limit: int = 30) -> str:
    scores = union(_places(k, r) for k in types for r in ranges)
    return f"{base()}, sc AS ({scores})," + ranked(
        "sc", 'type, "range"', "name", limit,
        f'type, "range", name, {SUBTITLE} AS subtitle', ", country",
    )


def item_board(types, ranges, margins: str = "region") -> str:
    scores = union(_entries(k, r) for k in types for r in ranges)
    cols = 'type, "range", code, name, owner, geocache_type, s, p'
    keyed = (
        "SELECT *, CASE geocache_type WHEN 2 THEN 'tradition' WHEN 3 THEN 'multi' WHEN 8 THEN 'mystery' "
        "WHEN 137 THEN 'earthcache' END AS tk FROM sc"
    )
    reg = f"SELECT 'all' AS region, * FROM keyed UNION ALL SELECT rkey, keyed.* FROM keyed JOIN reg ON country = rcountry"
    both = f"SELECT region, 'all' AS type_key, {cols} FROM kr UNION ALL SELECT region, tk, {cols} FROM kr WHERE tk IS NOT NULL"
    cond = {
        "region": "type_key = 'all'",
        "type": "region = 'all'",
        "cube": "TRUE",
    }[margins]
    label = (
        "CASE geocache_type WHEN 2 THEN 'Tradition' WHEN 3 THEN 'Multi' WHEN 8 THEN 'Mystery' WHEN 137 THEN 'Earthcache' END"
    )
    return (
        f"{base()}, sc AS ({scores}), keyed AS ({keyed}), kr AS ({reg}), marg AS ({both}), bs AS (SELECT * FROM marg WHERE {cond}),"
        + ranked(
            "bs", 'region, type_key, type, "range"', "code", 50,
            f'region, type_key, type, "range", code, name, owner, {label} AS type_label, geocache_type',
        )
    )


def item_stats(types, ranges) -> str:
    scores = union(_entries(k, r) for k in types for r in ranges)
    keyed = (
        "SELECT *, CASE geocache_type WHEN 2 THEN 'tradition' WHEN 3 THEN 'multi' WHEN 8 THEN 'mystery' "
        "WHEN 137 THEN 'earthcache' END AS tk FROM sc"
    )
    reg = "SELECT 'all' AS region, * FROM keyed UNION ALL SELECT rkey, keyed.* FROM keyed JOIN reg ON country = rcountry"
    both = 'SELECT region, \'all\' AS type_key, type, "range", s, p FROM kr UNION ALL SELECT region, tk, type, "range", s, p FROM kr WHERE tk IS NOT NULL'
    keys = ("all", "tradition", "multi", "virtual", "letterbox", "mystery", "webcam", "locationless", "earthcache", "wherigo")
    full = (
        f"SELECT * FROM ({values(('all', *REGIONS))}) a(region), ({values(keys)}) b(type_key), "
        f"({values(types)}) c(type), ({values(ranges)}) d(\"range\")"
    )
    return (
        f"{base()}, sc AS ({scores}), keyed AS ({keyed}), kr AS ({reg}), bs AS ({both}), sp AS ({full}), "
        f"{counted('bs', 'region, type_key, type, \"range\"', 'NULL')}"
    )


def values(items) -> str:
    return "VALUES " + ", ".join(f"('{i}')" for i in items)


def tenths(value: str) -> str:
    """Rounding to one place by the exact binary value, ties to even."""
    low = "floor(a * 10)"
    over = f"((a * 16 - ({low} * 2 + 1)) + a * 4)"
    size = f"(SELECT ({low} + CASE WHEN {over} > 0 OR ({over} = 0 AND {low} % 2 = 1) THEN 1 ELSE 0 END) / 10 FROM (SELECT abs(v) AS a))"
    return (
        f"(SELECT CASE WHEN v < 0 AND {size} <> 0 THEN -{size} ELSE {size} END FROM (SELECT CAST({value} AS DOUBLE) AS v))"
    )


def growth(now: str, before: str, empty: str) -> str:
    return (
        f"CASE WHEN {before} > 0 THEN {tenths(f'CAST({now} - {before} AS DOUBLE) / {before} * 100')} "
        f"ELSE CAST({empty} AS DOUBLE) END"
    )


def counted(source: str, keys: str, empty: str) -> str:
    """Populations of a spine ``sp`` from (keys, s, p) rows."""
    return f"""
 ct AS (SELECT {keys}, count(*) FILTER (WHERE s > 0) AS n, count(*) FILTER (WHERE p > 0) AS b FROM {source} GROUP BY {keys}),
 fl AS (SELECT {keys}, coalesce(n, 0) AS n, coalesce(b, 0) AS b FROM sp LEFT JOIN ct USING ({keys}))
 SELECT {keys}, n AS player_count, {growth('n', 'b', empty)} AS player_count_growth_pct FROM fl"""


def player_stats(types, ranges) -> str:
    scores = union(_people(k, r) for k in types for r in ranges)
    full = f"SELECT * FROM ({values(('all', *REGIONS))}) a(region), ({values(types)}) c(type), ({values(ranges)}) d(\"range\")"
    keys = 'region, type, "range"'
    return (
        f"{base()}, sc AS ({scores}), rs AS ({regional('sc', 'type, \"range\", name')}), sp AS ({full}), "
        + counted("rs", keys, "0")
    )


def _newbies(types) -> str:
    cohort = (
        "us AS (SELECT lower(user_name) AS k, "
        f"bool_or(registration_date >= {YEAR_AGO} AND registration_date <= {TODAY}) AS fresh, "
        f"bool_or(registration_date >= {TWO_AGO} AND registration_date < {YEAR_AGO}) AS older "
        "FROM users GROUP BY 1)"
    )
    parts = {
        "finds": "SELECT 'finds' AS type, user_name AS name, country, count(DISTINCT code) AS n FROM jv WHERE rnk AND user_name <> '' GROUP BY 2, 3",
        "hides": "SELECT 'hides' AS type, owner_username AS name, country, count(*) AS n FROM it WHERE rnk AND own GROUP BY 2, 3",
    }
    return (
        f"{base('users')}, {cohort}, raw AS ({union(parts[t] for t in types)}), "
        "sc AS (SELECT type, name, country, CASE WHEN fresh THEN n ELSE 0 END AS s, CASE WHEN older THEN n ELSE 0 END AS p "
        "FROM raw JOIN us ON k = lower(trim(name))), "
        f"rs AS ({regional('sc', 'type, name')})"
    )


def newbie_board(types) -> str:
    return with_avatar(_newbies(types) + """,
 cur AS (SELECT *, rank() OVER (PARTITION BY region, type ORDER BY s DESC) AS rk,
   row_number() OVER (PARTITION BY region, type ORDER BY s DESC, name) AS rn FROM rs WHERE s > 0)
 SELECT region, type, CAST(rk AS INT) AS rank, name, s AS score, 'flat' AS trend, CAST(0 AS INT) AS trend_delta
 FROM cur WHERE rk <= 50 AND rn <= 100""")


def newbie_stats() -> str:
    types = ("finds", "hides")
    full = f"SELECT * FROM ({values(('all', *REGIONS))}) a(region), ({values(types)}) c(type)"
    return f"{_newbies(types)}, sp AS ({full}), {counted('rs', 'region, type', 'NULL')}"


def _events(types, window: bool) -> str:
    rng = "ytd" if window else "all"
    parts = {
        "hosts": f"SELECT 'hosts' AS type, owner_username AS name, country, count(DISTINCT code) AS s, count(DISTINCT code) FILTER (WHERE {period('placed_date', rng, True)}) AS p FROM it WHERE evt AND own GROUP BY 2, 3",
        "participants": f"SELECT 'participants' AS type, user_name AS name, country, count(DISTINCT code) AS s, count(DISTINCT code) FILTER (WHERE {period('visited', rng, True)}) AS p FROM jv WHERE evt AND user_name <> '' AND log_type = 'Attended' GROUP BY 2, 3",
    }
    return f"{base()}, sc AS ({union(parts[t] for t in types)}), rs AS ({regional('sc', 'type, name')})"


def event_board(types, window: bool = False) -> str:
    return with_avatar(_events(types, window) + "," + ranked("rs", "region, type", "name", 50, "region, type, name"))


def event_stats() -> str:
    types = ("hosts", "participants")
    full = f"SELECT * FROM ({values(('all', *REGIONS))}) a(region), ({values(types)}) c(type)"
    return f"{_events(types, False)}, sp AS ({full}), {counted('rs', 'region, type', 'NULL')}"


def with_avatar(board: str) -> str:
    """A board with the resolved picture of each person."""
    return (
        "SELECT b.*, CASE WHEN coalesce(avatar_status, 'real') = 'real' AND avatar_url LIKE 'https://img.geocaching.com/%' "
        "THEN avatar_url ELSE 'https://www.geocaching.com/images/default_avatar.png' END AS avatar_url "
        f"FROM ({board}) b LEFT JOIN ({with_views('SELECT * FROM avatars', 'avatars')}) a ON a.user_name = b.name"
    )


def limited(kind: str, rng: str, n: int) -> str:
    return (
        f"{base()}, sc AS ({_people(kind, rng)}) SELECT name, CAST(sum(s) AS BIGINT) AS score FROM sc "
        f"GROUP BY name HAVING sum(s) > 0 ORDER BY score DESC, name LIMIT {n}"
    )


def ranked_names() -> str:
    boards = union(
        f"SELECT name FROM ({b})"
        for b in (player_board(("finds",), ("30d",)), newbie_board(("hides",)), event_board(("participants",)))
    )
    return f"SELECT DISTINCT name FROM ({boards}) ORDER BY name"


def regional_rows(select: str, source: str, group: str) -> str:
    return (
        f"SELECT 'all' AS region, {select} FROM {source} {group} UNION ALL "
        f"SELECT rkey AS region, {select} FROM {source} JOIN reg ON country = rcountry {group + ', rkey' if group else 'GROUP BY rkey'}"
    )


def scope_counts() -> str:
    a = regional_rows(
        "count(*) AS total_caches, count(DISTINCT nullif(owner_username, '')) AS total_owners",
        "(SELECT * FROM it WHERE rnk) q", "",
    )
    b = regional_rows(
        "count(DISTINCT nullif(user_name, '')) AS total_finders, count(*) AS total_logs",
        "(SELECT * FROM jv WHERE rnk) q", "",
    )
    return f"{base()}, a AS ({a}), b AS ({b}) SELECT region, total_caches, total_owners, total_finders, total_logs FROM a JOIN b USING (region)"


def active_count() -> str:
    return f"{base()} {regional_rows('count(*) AS active_items', '(SELECT * FROM it WHERE act) q', '')}"


def region_share() -> str:
    return (
        f"{base()}, n AS (SELECT rkey AS region, count(*) AS total_caches FROM it JOIN reg ON country = rcountry WHERE act GROUP BY rkey) "
        f"SELECT region, total_caches, {tenths('total_caches / t * 100')} AS percentage FROM n, (SELECT sum(total_caches) AS t FROM n)"
    )


def yearly_trend() -> str:
    counts = regional_rows(
        "year(placed_date) AS y, count(*) FILTER (WHERE cache_status <> 2) AS total, "
        f"count(*) FILTER (WHERE placed_date <= make_date(year(placed_date), 1, 1) + CAST({TODAY} - {JAN1} AS INT)) AS ytd_cache, "
        "count(*) FILTER (WHERE cache_status = 2) AS archived",
        "(SELECT * FROM it WHERE rnk AND placed_date IS NOT NULL) q", "GROUP BY year(placed_date)",
    )
    return (
        f"{base()}, c AS ({counts}), sp AS (SELECT * FROM ({values(('all', *REGIONS))}) a(region), "
        "(SELECT unnest(generate_series((SELECT min(year(placed_date)) FROM it WHERE rnk), 2001)) AS y)) "
        "SELECT region, CAST(y AS VARCHAR) AS year, coalesce(total, 0) AS total, coalesce(ytd_cache, 0) AS ytd_cache, "
        "coalesce(archived, 0) AS archived FROM sp LEFT JOIN c USING (region, y)"
    )


_STATUS = "count(*) FILTER (WHERE cache_status <> 2) AS n, count(*) FILTER (WHERE cache_status = 2) AS a"
_MONTHS = "(SELECT strftime(m, '%Y-%m') AS label FROM (SELECT unnest(generate_series(DATE '2000-09-01', DATE '2001-06-01', INTERVAL 1 MONTH)) AS m))"
_YEARS = "(SELECT CAST(y AS VARCHAR) AS label FROM (SELECT unnest(generate_series(1992, 2001)) AS y))"


def _labels(monthly: bool) -> tuple[str, str]:
    return (
        ("strftime(placed_date, '%Y-%m')", _MONTHS) if monthly else ("CAST(year(placed_date) AS VARCHAR)", _YEARS)
    )


def trend(monthly: bool, city: str | None = None) -> str:
    label, full = _labels(monthly)
    where = "rnk" if city is None else f"rnk AND place = '{city}'"
    return (
        f"{base()}, c AS (SELECT {label} AS label, {_STATUS} FROM it WHERE {where} GROUP BY 1) "
        f'SELECT label, coalesce(n, 0) AS "count", coalesce(a, 0) AS archived FROM {full} LEFT JOIN c USING (label)'
    )


def city_trend(monthly: bool) -> str:
    label, full = _labels(monthly)
    return (
        f"{base()}, c AS (SELECT place AS city, {label} AS label, {_STATUS} FROM it WHERE rnk GROUP BY 1, 2), "
        f"sp AS (SELECT * FROM (SELECT DISTINCT place AS city FROM it WHERE rnk AND place IS NOT NULL), {full}) "
        'SELECT city, label, coalesce(n, 0) AS "count", coalesce(a, 0) AS archived FROM sp LEFT JOIN c USING (city, label)'
    )


def city_cagr() -> str:
    return (
        f"{base()}, c AS (SELECT place AS city, count(*) FILTER (WHERE year(placed_date) = 1992 AND cache_status IS NOT NULL) AS f, "
        "count(*) FILTER (WHERE year(placed_date) = 2001 AND cache_status IS NOT NULL) AS l FROM it WHERE rnk AND place IS NOT NULL GROUP BY 1) "
        f"SELECT city, CASE WHEN f > 0 THEN {tenths('(pow(l / f, 1.0 / 9) - 1) * 100')} ELSE CAST(0 AS DOUBLE) END AS average_growth_pct FROM c"
    )


def heatmap(rng: str) -> str:
    when = f"visited >= {D30}" if rng == "30d" else f"visited >= {JAN1} AND visited <= {TODAY}"
    point = (
        "(SELECT i.country, CAST(round(CAST(latitude AS DECIMAL(12,6)), 2) AS DOUBLE) AS latitude, "
        "CAST(round(CAST(longitude AS DECIMAL(12,6)), 2) AS DOUBLE) AS longitude FROM visits v JOIN it i ON code = gc_code "
        f"WHERE rnk AND latitude IS NOT NULL AND longitude IS NOT NULL AND {when}) q"
    )
    rows = regional_rows('latitude, longitude, count(*) AS "count"', point, "GROUP BY latitude, longitude")
    return f"{base()} {rows}"


_DT = "difficulty IN (1,1.5,2,2.5,3,3.5,4,4.5,5) AND terrain IN (1,1.5,2,2.5,3,3.5,4,4.5,5)"


def dt_matrix() -> str:
    counts = regional_rows("difficulty, terrain, count(*) AS n", f"(SELECT * FROM it WHERE act AND {_DT}) q", "GROUP BY difficulty, terrain")
    return (
        f"{base()}, c AS ({counts}), v AS (SELECT i, 1 + i * 0.5::DOUBLE AS x FROM (SELECT unnest(generate_series(0, 8)) AS i)), "
        f"sp AS (SELECT region, a.i AS r, b.i AS k, a.x AS difficulty, b.x AS terrain FROM ({values(('all', *REGIONS))}) g(region), v a, v b) "
        'SELECT region, CAST(r AS INT) AS row, CAST(k AS INT) AS col, difficulty, terrain, coalesce(n, 0) AS "count" '
        "FROM sp LEFT JOIN c USING (region, difficulty, terrain)"
    )


def dt_top(by: str) -> str:
    src = (
        f"(SELECT *, place AS city2 FROM it WHERE act AND {_DT})"
        if by == "city"
        else f"(SELECT 'all' AS region, it.* FROM it WHERE act AND {_DT} UNION ALL SELECT rkey, it.* FROM it JOIN reg ON country = rcountry WHERE act AND {_DT})"
    )
    key = "city2" if by == "city" else "region"
    return (
        f"{base()}, r AS (SELECT *, row_number() OVER (PARTITION BY {key}, difficulty, terrain ORDER BY coalesce(favorite_points, 0) DESC, code) AS rn FROM {src} q) "
        f"SELECT {key} AS {by}, difficulty, terrain, code, name, coalesce(owner_username, '') AS owner, "
        "CAST(coalesce(favorite_points, 0) AS INT) AS favorite_points, CAST(rn AS INT) AS place FROM r WHERE rn <= 5"
    )


def city_dt() -> str:
    return f'{base()} SELECT place AS city, difficulty, terrain, count(*) AS "count" FROM it WHERE act AND {_DT} GROUP BY 1, 2, 3'


def community() -> str:
    return (
        f"{base()}, a AS (SELECT count(DISTINCT user_name) FILTER (WHERE visited >= {D30}) AS n, "
        f"count(DISTINCT user_name) FILTER (WHERE visited >= {D60} AND visited < {D30}) AS b, count(DISTINCT code) AS f FROM jv WHERE rnk), "
        "t AS (SELECT count(*) AS t FROM it WHERE rnk) "
        f"SELECT n AS active_players, {growth('n', 'b', '0')} AS active_players_growth_pct, t AS total_caches, "
        f"{tenths('f / t * 100')} AS found_cache_coverage_pct FROM a, t"
    )


def community_regions() -> str:
    """Distinct people per region, counted over all visits."""
    counts = regional_rows(
        f"count(DISTINCT user_name) FILTER (WHERE visited >= {D30}) AS n, "
        f"count(DISTINCT user_name) FILTER (WHERE visited >= {D60} AND visited < {D30}) AS b, "
        "count(DISTINCT nullif(user_name, '')) AS total_finders, count(*) AS total_logs",
        "(SELECT * FROM jv WHERE rnk) q", "",
    )
    return (
        f"{base()}, c AS ({counts}) SELECT region, n AS active_players, b AS active_before, "
        f"{growth('n', 'b', '0')} AS active_players_growth_pct, total_finders, total_logs FROM c"
    )


def time_range_matrix() -> str:
    cols = ", ".join(
        f"count(*) FILTER (WHERE {period('visited', r, p)}) AS \"{r}_{'prev' if p else 'cur'}\""
        for r in RANGES
        for p in (False, True)
    )
    return with_views(f"SELECT log_type, {cols} FROM visits GROUP BY log_type", "visits")
