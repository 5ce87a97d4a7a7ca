"""SQL statements of the ingest, people, page and place queries, for an independent engine."""

from __future__ import annotations

from trailsight.plans.views import BOXES, with_views

from oracles.boards import EVENTS, TODAY, base, tenths


def in_boxes(lat: str = "latitude", lon: str = "longitude") -> str:
    return "(" + " OR ".join(
        f"({lat} BETWEEN {s} AND {n} AND {lon} BETWEEN {w} AND {e})" for n, w, s, e in BOXES
    ) + ")"


NUM = "CAST(substring(code, 3) AS BIGINT)"
ACCOUNT = "(user_guid IS NOT NULL AND user_guid NOT IN ('', 'deleted'))"


def dedup() -> str:
    """Newest day per item and account, flags merged over that day."""
    return with_views(
        """, k AS (SELECT *, CASE WHEN user_guid <> '' THEN 'g' || user_guid WHEN user_name <> '' THEN 'n' || user_name END AS key FROM repeated),
 m AS (SELECT *, max(visited) OVER (PARTITION BY gc_code, key) AS newest FROM k WHERE key IS NOT NULL),
 n AS (SELECT *, row_number() OVER (PARTITION BY gc_code, key ORDER BY s1, s2, s3, s4) AS rn,
   row_number() OVER (PARTITION BY gc_code, key ORDER BY CASE WHEN log_type <> '' THEN 0 ELSE 1 END, s1, s2, s3, s4) AS tn,
   bool_or(favorite_point_used) OVER (PARTITION BY gc_code, key) AS fav, bool_or(is_ftf) OVER (PARTITION BY gc_code, key) AS ftf
   FROM m WHERE visited = newest)
 SELECT a.gc_code, a.user_name, a.user_guid, a.visited, a.fav AS favorite_point_used, a.ftf AS is_ftf,
   CASE WHEN b.log_type <> '' THEN b.log_type ELSE 'Found it' END AS log_type
 FROM n a JOIN n b ON a.gc_code = b.gc_code AND a.key = b.key WHERE a.rn = 1 AND b.tn = 1""".lstrip(),
        "repeated",
    ).replace(") , k AS", "), k AS")


def resume() -> str:
    return f"SELECT gc_code AS code, count(*) AS visits, max(visited) AS newest FROM ({dedup()}) GROUP BY gc_code"


def retry() -> str:
    """Three rounds in turn; an item that is done or has failed three times takes no part in the next."""
    return with_views(
        """, r AS (SELECT *, CASE WHEN round <= 2 THEN 1 WHEN round <= 4 THEN 2 ELSE 3 END AS turn FROM results),
 t AS (SELECT code, turn, count(*) FILTER (WHERE error IS NULL) AS ok, count(*) FILTER (WHERE error IS NOT NULL) AS bad FROM r GROUP BY code, turn),
 u AS (SELECT code, turn, coalesce(sum(ok) OVER w, 0) AS ok_before, coalesce(sum(bad) OVER w, 0) AS bad_before
   FROM t WINDOW w AS (PARTITION BY code ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 c AS (SELECT r.* FROM r JOIN u ON r.code = u.code AND r.turn = u.turn WHERE ok_before = 0 AND bad_before < 3),
 v AS (SELECT code, count(DISTINCT user_name) AS visits FROM c WHERE error IS NULL AND user_name IS NOT NULL GROUP BY code),
 e AS (SELECT code, error, row_number() OVER (PARTITION BY code ORDER BY attempt DESC, error DESC) AS n FROM c WHERE error IS NOT NULL),
 a AS (SELECT code, count(*) AS attempts, count(error) AS failures, bool_or(error IS NULL) AS done FROM c GROUP BY code)
 SELECT a.code, attempts, failures, CASE WHEN done THEN 'done' WHEN failures >= 3 THEN 'dead' ELSE 'failing' END AS state,
   e.error AS last_error, coalesce(visits, 0) AS visits FROM a LEFT JOIN v ON a.code = v.code LEFT JOIN e ON a.code = e.code AND e.n = 1""".lstrip(),
        "results",
    ).replace(") , r AS", "), r AS")


def keep_latest() -> str:
    return with_views(
        "SELECT gc_code, user_name, visited, favorite_point_used FROM (SELECT *, row_number() OVER "
        "(PARTITION BY gc_code, user_name ORDER BY visited DESC, s1, s2, s3, s4) AS rn FROM repeated WHERE user_name IS NOT NULL) WHERE rn = 1",
        "repeated",
    )


_CHANGED = (
    "(n.visited IS DISTINCT FROM o.visited OR coalesce(n.favorite_point_used, false) <> coalesce(o.favorite_point_used, false) "
    "OR coalesce(n.is_ftf, false) <> coalesce(o.is_ftf, false) OR coalesce(n.log_type, 'Found it') <> coalesce(o.log_type, 'Found it') "
    "OR n.user_name IS DISTINCT FROM o.user_name)"
)
_MATCH = (
    "n.gc_code = o.gc_code AND n.user_guid = o.user_guid AND n.user_guid NOT IN ('', 'deleted')"
)


def visit_diff() -> str:
    return with_views(
        "SELECT n.gc_code, n.user_name, n.user_guid, CASE WHEN o.gc_code IS NULL THEN 'insert' "
        f"WHEN {_CHANGED} THEN 'update' ELSE 'unchanged' END AS change "
        f"FROM incoming_visits n LEFT JOIN stored_visits o ON {_MATCH}",
        "incoming_visits", "stored_visits",
    )


_V = "gc_code, user_name, user_guid, visited, favorite_point_used, is_ftf, log_type"


def visit_merge() -> str:
    full = "n.gc_code, n.user_name, n.user_guid, n.visited, coalesce(n.favorite_point_used, false), coalesce(n.is_ftf, false), coalesce(n.log_type, 'Found it')"
    return with_views(
        f"SELECT o.gc_code, o.user_name, o.user_guid, o.visited, o.favorite_point_used, o.is_ftf, o.log_type FROM stored_visits o "
        f"LEFT JOIN incoming_visits n ON {_MATCH} WHERE n.gc_code IS NULL OR NOT {_CHANGED} "
        f"UNION ALL SELECT {full} FROM stored_visits o JOIN incoming_visits n ON {_MATCH} WHERE {_CHANGED} "
        f"UNION ALL SELECT {full} FROM incoming_visits n WHERE {ACCOUNT} AND NOT EXISTS (SELECT 1 FROM stored_visits o WHERE {_MATCH}) "
        f"UNION ALL SELECT {_V} FROM incoming_visits WHERE NOT {ACCOUNT}",
        "incoming_visits", "stored_visits",
    )


def insert_absent() -> str:
    return with_views(
        f"SELECT {_V} FROM stored_visits UNION ALL SELECT {_V} FROM incoming_visits n "
        f"WHERE NOT EXISTS (SELECT 1 FROM stored_visits o WHERE {_MATCH})",
        "incoming_visits", "stored_visits",
    )


def change_details() -> str:
    """The rows behind the summary, all of them."""
    rows = change_summary()
    head = rows[: rows.rindex(" r AS (")].rstrip().rstrip(",")
    return head + " SELECT gc_code, who AS user_name, action, changes FROM t WHERE changes <> ''"


def change_summary() -> str:
    key = f"CASE WHEN {ACCOUNT} THEN 'g' || user_guid ELSE 'n' || coalesce(user_name, '') END AS key"
    txt = lambda f: f"CAST(coalesce({f}, false) AS VARCHAR)"
    return with_views(
        f""", o AS (SELECT *, count(*) OVER (PARTITION BY gc_code, key) AS copies, row_number() OVER (PARTITION BY gc_code, key ORDER BY visited DESC) AS rn
   FROM (SELECT *, {key} FROM repeated_stored)),
 n AS (SELECT *, {key} FROM incoming_visits),
 j AS (SELECT n.gc_code, coalesce(n.user_name, '') AS who, copies,
   CASE WHEN n.visited IS DISTINCT FROM o.visited THEN 'visited: ' || o.visited || ' -> ' || n.visited END AS a,
   CASE WHEN coalesce(n.favorite_point_used, false) <> coalesce(o.favorite_point_used, false) THEN 'favorite_point_used: ' || {txt('o.favorite_point_used')} || ' -> ' || {txt('n.favorite_point_used')} END AS b,
   CASE WHEN coalesce(n.is_ftf, false) <> coalesce(o.is_ftf, false) THEN 'is_ftf: ' || {txt('o.is_ftf')} || ' -> ' || {txt('n.is_ftf')} END AS c,
   CASE WHEN coalesce(n.log_type, 'Found it') <> coalesce(o.log_type, 'Found it') THEN 'log_type: ' || coalesce(o.log_type, 'Found it') || ' -> ' || coalesce(n.log_type, 'Found it') END AS d,
   CASE WHEN copies > 1 THEN 'duplicate_count=' || copies END AS e
   FROM n LEFT JOIN o ON n.gc_code = o.gc_code AND n.key = o.key AND o.rn = 1),
 t AS (SELECT gc_code, who, CASE WHEN copies IS NULL THEN 'insert' ELSE 'update' END AS action,
   CASE WHEN copies IS NULL THEN 'missing' ELSE concat_ws('; ', a, b, c, d, e) END AS changes FROM j),
 r AS (SELECT *, row_number() OVER (PARTITION BY gc_code ORDER BY who, action, changes) AS rn FROM t WHERE changes <> '')
 SELECT gc_code AS code, count(*) AS raw, count(*) FILTER (WHERE action = 'insert') AS inserted, count(*) FILTER (WHERE action = 'update') AS updated,
   string_agg(who || ' ' || action || ' ' || changes, chr(10) ORDER BY rn) FILTER (WHERE rn <= 5) AS report
 FROM r GROUP BY gc_code""",
        "incoming_visits", "repeated_stored",
    ).replace(") , o AS", "), o AS")


_ITEM_CHECKS = {
    "id": "n.id <> o.id",
    "name": "trim(n.name) <> trim(o.name)",
    "premium_only": "n.premium_only <> o.premium_only",
    "favorite_points": "n.favorite_points <> o.favorite_points",
    "geocache_type": "n.geocache_type <> o.geocache_type",
    "container_type": "n.container_type <> o.container_type",
    "difficulty": "round(n.difficulty, 1) <> round(o.difficulty, 1)",
    "terrain": "round(n.terrain, 1) <> round(o.terrain, 1)",
    "cache_status": "n.cache_status <> o.cache_status",
    "details_url": "trim(n.details_url) <> trim(o.details_url)",
    "placed_date": "substring(n.placed_date, 1, 10) <> o.placed_date",
    "owner_username": "trim(n.owner_username) <> trim(o.owner_username)",
    "last_found_date": "substring(n.last_found_date, 1, 10) <> o.last_found_date",
    "trackable_count": "n.trackable_count <> o.trackable_count",
    "country": "n.country <> o.country",
    "owner_guid": "n.owner_guid <> o.owner_guid",
    "latitude": "NOT n.premium_only AND abs(n.latitude - o.latitude) > 0.000001",
    "longitude": "NOT n.premium_only AND abs(n.longitude - o.longitude) > 0.000001",
}


def _item_changed() -> str:
    return "(" + " OR ".join(f"coalesce({c}, false)" for c in _ITEM_CHECKS.values()) + ")"


def item_diff() -> str:
    notes = ", ".join(
        f"CASE WHEN {c} THEN '{f}: ' || coalesce(CAST(o.{f} AS VARCHAR), 'None') || ' -> ' || CAST(n.{f} AS VARCHAR) END"
        for f, c in _ITEM_CHECKS.items()
    )
    return with_views(
        f"SELECT n.code, CASE WHEN o.code IS NULL THEN 'new' WHEN {_item_changed()} THEN 'updated' ELSE 'unchanged' END AS change, "
        f"CASE WHEN o.code IS NULL THEN '' ELSE concat_ws(' | ', {notes}) END AS fields "
        "FROM incoming_items n LEFT JOIN stored_items o ON n.code = o.code",
        "incoming_items", "stored_items",
    )


def item_merge() -> str:
    plain = ("id", "code", "name", "premium_only", "favorite_points", "geocache_type", "difficulty", "terrain", "cache_status", "container_type", "details_url", "last_found_date", "trackable_count")
    take = f"(n.code IS NOT NULL AND (o.code IS NULL OR {_item_changed()}))"
    pick = lambda f: f"CASE WHEN {take} THEN n.{f} ELSE o.{f} END AS {f}"
    at = lambda f: f"CASE WHEN {take} AND NOT (n.premium_only AND o.code IS NOT NULL) THEN n.{f} ELSE o.{f} END AS {f}"
    cols = [pick(f) for f in plain] + [at("latitude"), at("longitude")]
    cols += [pick("placed_date"), pick("owner_username"), pick("country"), "o.owner_guid AS owner_guid"]
    return with_views(
        f"SELECT {', '.join(cols)} FROM incoming_items n FULL OUTER JOIN stored_items o ON n.code = o.code",
        "incoming_items", "stored_items",
    )


def item_change_log() -> str:
    """The rows of the difference that are no mere repetition."""
    notes = ", ".join(
        f"CASE WHEN {c} THEN '{f}: ' || coalesce(CAST(o.{f} AS VARCHAR), 'None') || ' -> ' || CAST(n.{f} AS VARCHAR) END"
        for f, c in _ITEM_CHECKS.items()
    )
    return with_views(
        "SELECT n.code, CASE WHEN o.code IS NULL THEN 'insert' ELSE 'update' END AS action, "
        f"CASE WHEN o.code IS NULL THEN '' ELSE concat_ws(' | ', {notes}) END AS changes, "
        "o.favorite_points AS points_before, n.favorite_points AS points_after "
        f"FROM incoming_items n LEFT JOIN stored_items o ON n.code = o.code WHERE o.code IS NULL OR {_item_changed()}",
        "incoming_items", "stored_items",
    )


def visit_change_log() -> str:
    shown = {
        "visited": ("n.visited IS DISTINCT FROM o.visited", "CAST({p}visited AS VARCHAR)"),
        "favorite_point_used": ("coalesce(n.favorite_point_used, false) <> coalesce(o.favorite_point_used, false)", "CAST(coalesce({p}favorite_point_used, false) AS VARCHAR)"),
        "is_ftf": ("coalesce(n.is_ftf, false) <> coalesce(o.is_ftf, false)", "CAST(coalesce({p}is_ftf, false) AS VARCHAR)"),
        "log_type": ("coalesce(n.log_type, 'Found it') <> coalesce(o.log_type, 'Found it')", "coalesce({p}log_type, 'Found it')"),
    }
    notes = ", ".join(
        f"CASE WHEN {cond} THEN '{f}: ' || coalesce({t.format(p='o.')}, '') || ' -> ' || coalesce({t.format(p='n.')}, '') END"
        for f, (cond, t) in shown.items()
    )
    return with_views(
        "SELECT n.gc_code, n.user_name, CASE WHEN o.gc_code IS NULL THEN 'insert' ELSE 'update' END AS action, "
        f"CASE WHEN o.gc_code IS NULL THEN '' ELSE concat_ws('; ', {notes}) END AS changes, o.visited AS visited_before, n.visited AS visited_after "
        f"FROM incoming_visits n LEFT JOIN stored_visits o ON {_MATCH} WHERE o.gc_code IS NULL OR {_CHANGED}",
        "incoming_visits", "stored_visits",
    )


def canonical_item() -> str:
    return with_views(
        "SELECT code, trim(name) AS name, premium_only, CAST(round(CAST(latitude AS DECIMAL(20,10)), 6) AS DOUBLE) AS latitude, "
        "CAST(round(CAST(longitude AS DECIMAL(20,10)), 6) AS DOUBLE) AS longitude, CAST(round(CAST(difficulty AS DECIMAL(20,10)), 1) AS DOUBLE) AS difficulty, "
        "substring(placed_date, 1, 10) || ' 00:00:00' AS placed_date, container_type, trim(details_url) AS details_url, "
        "substring(last_found_date, 1, 10) || ' 00:00:00' AS last_found_date, trackable_count FROM incoming_items",
        "incoming_items",
    )


def item_flatten() -> str:
    return with_views(
        f""", x AS (SELECT *, {NUM} AS k FROM items),
 y AS (SELECT k AS id, code, name, premium_only, favorite_points, geocache_type, cache_status,
   CASE WHEN premium_only THEN NULL WHEN k % 29 = 0 THEN 0 ELSE latitude END AS latitude,
   CASE WHEN premium_only THEN NULL ELSE longitude END AS longitude,
   CAST(placed_date AS VARCHAR) AS placed_date, owner_username, country, CAST(k % 6 AS INT) AS container_type, difficulty, terrain,
   '/geocache/' || code AS details_url, CAST(NULL AS VARCHAR) AS owner_guid, CASE WHEN k % 5 <> 0 THEN CAST(CAST(placed_date + 30 AS DATE) AS VARCHAR) END AS last_found_date,
   CAST(k % 4 AS INT) AS trackable_count, 'Part ' || (k % 3) AS region,
   concat_ws(',', CASE WHEN k % 2 = 0 THEN 'attr 1' END, CASE WHEN k % 3 = 0 THEN 'attr 2' END) AS attributes
   FROM x WHERE k % 31 <> 0)
 SELECT * FROM y WHERE (premium_only OR (latitude <> 0 AND {in_boxes()})) AND country IN ('EUROPE', 'ASIA', 'AFRICA')""",
        "items",
    ).replace(") , x AS", "), x AS")


def box_filter() -> str:
    return with_views(
        f"SELECT code, premium_only FROM items WHERE (premium_only OR {in_boxes()}) AND country IN ('EUROPE', 'ASIA', 'AFRICA')",
        "items",
    )


VISIT_FLATTEN = """
 SELECT 'GC' || l_orderkey AS gc_code, 'user ' || l_suppkey AS user_name, strftime(l_shipdate, '%Y-%m-%d') AS visited,
  l_returnflag = 'R' AS favorite_point_used, l_quantity < 5 AS is_ftf,
  CASE WHEN substring(o_orderpriority, 1, 1) = '5' THEN 'Attended' ELSE 'Found it' END AS log_type, 'A' || l_suppkey AS user_guid
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber % 2 = 0"""

ACCEPTED = with_views(
    f"SELECT geocache_type, log_type, count(*) AS visits FROM visits JOIN items ON code = gc_code "
    f"WHERE log_type = CASE WHEN geocache_type IN {EVENTS} THEN 'Attended' ELSE 'Found it' END GROUP BY 1, 2",
    "items", "visits",
)


def vanished(cond: str, extra: str = "") -> str:
    return (
        f"SELECT code, cache_status, latitude IS NULL OR longitude IS NULL AS unplaced{extra} FROM items "
        f"WHERE cache_status IS DISTINCT FROM 2 AND NOT ({cond}) AND (latitude IS NULL OR longitude IS NULL OR {in_boxes()})"
    )


def vanished_boxes() -> str:
    return with_views(
        "SELECT code, cache_status, latitude IS NULL OR longitude IS NULL AS unplaced FROM items i "
        f"WHERE cache_status IS DISTINCT FROM 2 AND NOT ({NUM} % 97 <> 0) AND (latitude IS NULL OR longitude IS NULL OR EXISTS "
        "(SELECT 1 FROM crawl_boxes b WHERE latitude BETWEEN min_lat AND max_lat AND longitude BETWEEN min_lon AND max_lon))",
        "items", "crawl_boxes",
    )


_DRIFT = f"d AS (SELECT *, {NUM} AS k FROM items), e AS (SELECT * FROM d WHERE k % 11 <> 0)"
UNKNOWN_FIELDS = (
    with_views("", "items").rstrip() + f", {_DRIFT} "
    "SELECT 'newFlag' AS field, 'BOOLEAN' AS type, count(*) AS items FROM e WHERE k % 5 = 0 UNION ALL "
    "SELECT 'rank', 'VARIANT', count(*) FROM e WHERE k % 5 IN (0, 1) UNION ALL "
    "SELECT 'place', 'OBJECT<no: BIGINT, zip: STRING>', count(*) FROM e WHERE k % 5 = 2"
)
EXTRA_FIELDS = (
    with_views("", "items").rstrip() + f", {_DRIFT} "
    "SELECT code, k % 11 <> 0 AND k % 5 = 0 AND k % 2 = 0 AS new_flag, CASE WHEN k % 11 <> 0 AND k % 5 = 0 THEN k ELSE -1 END AS rank FROM d"
)


def vanished_checked() -> str:
    few = vanished(f"{NUM} % 7919 <> 0", ", 'good' AS crawl")
    many = vanished(f"{NUM} % 2 <> 0", ", 'broken' AS crawl")
    return with_views(
        f"SELECT *, (SELECT count(*) FROM ({few})) > 0.01 * (SELECT count(*) FROM items) AS suspicious FROM ({few}) UNION ALL "
        f"SELECT *, (SELECT count(*) FROM ({many})) > 0.01 * (SELECT count(*) FROM items) AS suspicious FROM ({many})",
        "items",
    )


REFRESH = with_views(
    "SELECT code, latitude, longitude, coalesce(premium_only, false) AS premium_only, geocache_type FROM crawled "
    "WHERE coalesce(cache_status, 0) NOT IN (2, 404) AND (logs_crawled_at IS NULL OR last_found_date >= logs_crawled_at "
    "OR (last_found_date <= placed_date AND year(last_found_date) > 1))",
    "crawled",
)
ARCHIVED = with_views(
    "SELECT code, latitude, longitude, premium_only FROM items WHERE cache_status = 2 AND code > 'GC3' ORDER BY code LIMIT 100",
    "items",
)
PAGE_SCAN = with_views("SELECT code, name, country FROM items ORDER BY code LIMIT 2000 OFFSET 200", "items")
PAGE_OF_LAYOUT = with_views("SELECT code, name, country FROM items ORDER BY code LIMIT 300 OFFSET 1000", "items")
WORK = with_views(
    f"SELECT code, premium_only, CASE WHEN premium_only THEN 'premium' ELSE 'nonpremium' END AS work_group FROM items WHERE {NUM} % 3 <> 0",
    "items",
)
STATUS = with_views(
    "SELECT code, cache_status FROM items WHERE code IN (SELECT gc_code FROM visits WHERE favorite_point_used)", "items", "visits"
)
KEYED = with_views(
    f"SELECT code, CASE WHEN code IN (SELECT gc_code FROM visits WHERE is_ftf) THEN {TODAY} ELSE logs_crawled_at END AS logs_crawled_at FROM crawled",
    "crawled", "visits",
)
BACKFILL = with_views(
    f""", x AS (SELECT *, {NUM} AS k, latitude IS NULL AND {NUM} % 2 = 0 AS hit FROM items)
 SELECT code, CASE WHEN hit THEN CAST(round(CAST(20 + (k % 1000) / 2000000::DOUBLE AS DECIMAL(20,10)), 6) AS DOUBLE) ELSE latitude END AS latitude,
  CASE WHEN hit THEN CAST(round(CAST(80 + (k % 1000) / 7000::DOUBLE AS DECIMAL(20,10)), 6) AS DOUBLE) ELSE longitude END AS longitude,
  CASE WHEN hit AND k % 3 = 0 THEN 'X' || k ELSE owner_guid END AS owner_guid FROM x""",
    "items",
).replace(") , x AS", "), x AS")
REJECTS = with_views(
    f"SELECT error, gc_code AS code, count(*) AS n FROM (SELECT *, CASE WHEN user_name IS NULL THEN 'no_user' WHEN log_type IS NULL THEN 'no_type' "
    f"WHEN NOT coalesce(visited <= {TODAY}, false) THEN 'future' END AS error FROM visits) WHERE error IS NOT NULL GROUP BY 1, 2",
    "visits",
)
EVOLVE = with_views(
    "SELECT log_type, no_guid, count(*) AS n FROM (SELECT CASE WHEN year(visited) < 1998 THEN 'Found it' ELSE coalesce(log_type, 'Found it') END AS log_type, "
    "CASE WHEN year(visited) < 1998 THEN true ELSE user_guid IS NULL END AS no_guid FROM visits) GROUP BY 1, 2",
    "visits",
)
COMPLETE = with_views(
    f"SELECT box, received, declared, declared - received AS missing, declared > 10000 AS over_cap, "
    "CASE WHEN received = declared THEN 'complete' WHEN received = 0 THEN 'empty' ELSE 'mismatch' END AS status FROM ("
    f"SELECT country AS box, count(*) AS declared, count(*) FILTER (WHERE country <> 'EUROPE' AND {NUM} % 31 <> 0 "
    f"AND NOT (country = 'ASIA' AND {NUM} // 100 % 2 = 0)) AS received FROM items GROUP BY country)",
    "items",
)
DIGEST = with_views(
    """SELECT id, status, actor, n AS item_count, concat_ws(chr(10), '--- 请求 #' || id || ' ---', '  提交者: ' || actor, '  状态:   ' || status,
  '  目标:   ' || target_series || ' (' || target_city || ')',
  CASE WHEN proposed_series <> '' THEN '  提议:   ' || proposed_series || ' (' || proposed_city || ')' END,
  CASE WHEN note <> '' THEN '  备注:   ' || note END, '  涉及:   ' || n || ' 个缓存') AS body
 FROM (SELECT r.*, count(item_id) AS n FROM requests r LEFT JOIN request_items i ON i.request_id = r.id WHERE NOT notified GROUP BY ALL)""",
    "requests", "request_items",
)
UNASSIGNED = with_views(
    "SELECT country, count(*) AS total, count(*) FILTER (WHERE latitude IS NULL OR longitude IS NULL) AS missing_coords, "
    "count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS has_coords FROM items WHERE city IS NULL OR trim(city) = '' GROUP BY country",
    "items",
)
MISSING = with_views(
    "SELECT code FROM items WHERE (latitude IS NULL OR longitude IS NULL) AND country IN ('EUROPE', 'ASIA', 'AFRICA', 'AMERICA')", "items"
)

_POOL = """lu AS (SELECT user_guid AS guid, max(trim(user_name)) AS user_name, count(*) AS log_count FROM visits
   WHERE user_guid IS NOT NULL AND trim(user_name) <> '' GROUP BY 1 HAVING count(*) > 10),
 ow AS (SELECT owner_guid AS guid, max(trim(owner_username)) AS user_name, 0 AS log_count FROM items
   WHERE owner_guid <> 'no guid' AND owner_username <> '[DELETED_USER]' AND trim(owner_username) <> '' AND coalesce(cache_status, 0) <> 404 GROUP BY 1),
 pool AS (SELECT * FROM lu UNION ALL SELECT * FROM ow WHERE guid NOT IN (SELECT guid FROM lu))"""


def _conflicts(visitor: str) -> str:
    return (
        f"nm AS (SELECT DISTINCT user_guid AS guid, trim({visitor}) AS user_name FROM visits WHERE user_guid IS NOT NULL AND trim(user_name) <> '' "
        "UNION SELECT owner_guid, trim(owner_username) FROM items WHERE owner_guid IS NOT NULL AND trim(owner_username) <> ''), "
        "cf AS (SELECT guid, user_name, count(*) OVER (PARTITION BY guid) AS name_count FROM nm)"
    )


CONFLICTS = with_views("", "items", "visits").rstrip() + ", " + _conflicts(
    "CASE WHEN is_ftf AND user_name LIKE '%7' THEN user_name || ' II' ELSE user_name END"
) + " SELECT * FROM cf WHERE name_count > 1"
CANDIDATES_500 = (
    with_views("", "items", "visits", "users").rstrip() + f", {_POOL}, {_conflicts('user_name')}, "
    "lim AS (SELECT p.guid, p.user_name, p.log_count FROM pool p LEFT JOIN users u ON u.guid = p.guid WHERE u.guid IS NULL OR coalesce(u.fetch_status, '') <> 'ok' "
    "ORDER BY log_count DESC, p.user_name, p.guid LIMIT 500) "
    "SELECT guid, user_name, CAST(log_count AS BIGINT) AS log_count FROM lim WHERE guid NOT IN (SELECT guid FROM cf WHERE name_count > 1)"
)
CANDIDATES = CANDIDATES_500.replace("LIMIT 500) ", ") ")
CANDIDATE_COUNT = with_views("", "items", "visits").rstrip() + f", {_POOL} SELECT count(*) AS candidates FROM pool"
LAST_WINS = with_views(
    "SELECT user_name, guid, seq, registration_date, fetch_status, reg_place FROM user_batch QUALIFY row_number() OVER (PARTITION BY user_name ORDER BY seq DESC) = 1",
    "user_batch",
)
USER_MERGE = with_views(
    """, n AS (SELECT * FROM user_batch QUALIFY row_number() OVER (PARTITION BY user_name ORDER BY seq DESC) = 1)
 SELECT user_name, coalesce(o.guid, n.guid) AS guid, coalesce(n.registration_date, o.registration_date) AS registration_date,
  coalesce(n.fetch_status, o.fetch_status) AS fetch_status, coalesce(n.reg_place, o.reg_place) AS reg_place
 FROM n FULL OUTER JOIN stored_users o USING (user_name)""",
    "user_batch", "stored_users",
).replace(") , n AS", "), n AS")
DEFAULT_AVATAR = "'https://www.geocaching.com/images/default_avatar.png'"
_REAL = "avatar_url LIKE 'https://img.geocaching.com/user/square250/%'"
AVATAR_MERGE = with_views(
    f""", n AS (SELECT user_name, CASE WHEN avatar_status = 'real' THEN avatar_url ELSE {DEFAULT_AVATAR} END AS avatar_url, avatar_status
   FROM avatar_batch WHERE avatar_status = 'default' OR (avatar_status = 'real' AND {_REAL}))
 SELECT user_name, coalesce(n.avatar_url, o.avatar_url) AS avatar_url, CASE WHEN n.user_name IS NULL THEN o.avatar_status ELSE n.avatar_status END AS avatar_status,
  CASE WHEN n.avatar_url IS NULL THEN '2001-01-01' ELSE '2001-06-15' END AS checked_at FROM n FULL OUTER JOIN avatars o USING (user_name)""",
    "avatar_batch", "avatars",
).replace(") , n AS", "), n AS").replace("n.user_name IS NULL", "n.avatar_url IS NULL")
_STATE = (
    f"CASE WHEN coalesce(avatar_status, 'real') = 'real' AND {_REAL} THEN 'real' WHEN avatar_status = 'default' THEN 'default' ELSE 'uncached' END"
)
_RESOLVED = f"SELECT c_name AS user_name, {_STATE} AS state, CASE WHEN {_STATE} = 'real' THEN avatar_url ELSE {DEFAULT_AVATAR} END AS avatar_url FROM customer LEFT JOIN avatars ON c_name = user_name"
AVATAR_RESOLVE = with_views(_RESOLVED, "avatars")
AVATAR_TALLY = with_views(
    "SELECT count(*) FILTER (WHERE state = 'real') AS real_cached, count(*) FILTER (WHERE state = 'default') AS default_cached, "
    f"count(*) FILTER (WHERE state = 'uncached') AS uncached, count(*) AS total FROM ({_RESOLVED})",
    "avatars",
)

PAGE_FIELDS = """
 SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title,
  nullif(regexp_extract(html, 'lang="([^"]*)"', 1), '') AS lang, nullif(regexp_extract(html, 'href="([^"]*)"', 1), '') AS first_link,
  TRY_CAST(nullif(regexp_extract(html, 'track\\((\\d+)\\)', 1), '') AS BIGINT) AS tracked FROM pages"""
_MARKERS = (
    "lblMemberSinceDate", "ctl00_ProfileHead_ProfileHeader_lblMemberName", "Joined", "dateJoined", "UserProfile",
    "This user''s profile is private", "Sorry, the requested user profile was not found", "Page Not Found",
)
_CONTEXT = "(?is)(.{0,120}(?:lblMemberSinceDate|Joined|Member Since|memberSince|dateJoined).{0,180})"
PAGE_SUMMARY = (
    "SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title, '' AS profile_name, "
    f"trim(regexp_replace(regexp_extract(html, '{_CONTEXT}', 1), '\\s+', ' ', 'g')) AS joined_context, "
    f"concat_ws(',', {', '.join(f'''CASE WHEN contains(html, '{m}') THEN '{m}' END''' for m in _MARKERS)}) AS markers, "
    "contains(html, 'UserProfile') AS looks_like_profile, url FROM pages"
)
PAGE_CLASS = """
 WITH m AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN url || '?ReturnUrl=/x' ELSE url END AS url, page_id % 9 AS n, lower(html) AS low FROM pages)
 SELECT page_id, n = 3 OR contains(lower(url), 'returnurl=') OR contains(lower(url), '/login') OR contains(low, '<title>log in') OR contains(low, '<title>sign in')
   OR contains(low, 'next-auth') AS login_page, n = 1 OR n = 2 AS public_page, n = 0 AS archived_page FROM m"""
BUILD_ID = """SELECT page_id, CASE page_id % 6 WHEN 0 THEN '20240101.1.' || page_id WHEN 1 THEN '20240102.2.' || page_id
  WHEN 2 THEN 'dev' || page_id WHEN 3 THEN '3.4.' || page_id WHEN 4 THEN '20240105.5.' || page_id END AS found FROM pages"""
ITEM_PAGE_FIELDS = with_views(
    f"SELECT code, CAST({NUM} % 90 + 0.25 AS DOUBLE) AS latitude, CAST({NUM} % 180 + 0.5 AS DOUBLE) AS longitude, "
    f"CASE WHEN {NUM} % 2 = 0 THEN CAST({NUM} AS VARCHAR) END AS owner_guid FROM items WHERE {NUM} % 3 < 2",
    "items",
)
FIRST_PATTERN = """
 SELECT page_id, coalesce(nullif(regexp_extract(html, 'track\\((\\d*7)\\)', 1), ''), nullif(regexp_extract(html, 'lang="([^"]+)"', 1), '')) AS found FROM pages"""
FTF = """
 SELECT doc_id, doc_id % 6 IN (0, 1, 4) OR regexp_matches(text, '(?i)[{\\[(（]\\s*\\*?\\s*ftf\\s*\\*?\\s*[}\\])）]') AS is_ftf FROM documents"""
DATES = """
 SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN 'no date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders"""
STAMPS = """
 SELECT event_id, CASE event_id % 7 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')
  WHEN 2 THEN strftime(ts, '%Y-%m-%d') || ' 00:00:00' WHEN 4 THEN 'soon' WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp FROM events"""
JOINED = with_views(
    """, k AS (SELECT *, CAST(substring(guid, 2) AS BIGINT) AS k FROM users)
 SELECT user_name, CASE WHEN k % 10 = 9 THEN NULL ELSE registration_date END AS registration_date,
  CAST(CASE WHEN k % 4 <> 0 THEN k * 3 ELSE 0 END AS BIGINT) AS find_count,
  CASE WHEN k % 10 <> 9 AND registration_date IS NOT NULL THEN 'ok' ELSE 'parse_failed' END AS fetch_status FROM k""",
    "users",
).replace(") , k AS", "), k AS")
AVATAR_EXTRACT = with_views(
    f""", k AS (SELECT *, CAST(substring(guid, 2) AS BIGINT) AS k FROM users)
 SELECT user_name, CASE k % 3 WHEN 0 THEN 'https://img.geocaching.com/user/square250/' || k || '.jpg'
  WHEN 1 THEN 'https://img.geocaching.com/user/square250/s' || k || '.png?v=2' ELSE {DEFAULT_AVATAR} END AS avatar_url, k % 3 <> 2 AS is_real FROM k""",
    "users",
).replace(") , k AS", "), k AS")
COUNTRY = """
 SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 IN (1, 2) THEN 'private'
  WHEN c_custkey % 5 = 0 THEN 'United States' ELSE n_name END AS country FROM customer JOIN nation ON c_nationkey = n_nationkey"""
RESOLVE = with_views(
    f""", r AS (SELECT code, cache_status AS old, CASE WHEN n IN (2, 5) THEN 2 WHEN n = 3 THEN NULL WHEN n = 4 OR k % 16 = 0 THEN 404 ELSE 0 END AS status
   FROM (SELECT *, {NUM} AS k, {NUM} % 8 AS n FROM items))
 SELECT code, CAST(status AS INT) AS status FROM r WHERE status IS NOT NULL AND old IS DISTINCT FROM 404
  AND ((status IN (2, 404) AND status IS DISTINCT FROM old) OR (status = 0 AND old = 2))""",
    "items",
).replace(") , r AS", "), r AS")


def nearest_area() -> str:
    dx = "greatest(x0 - longitude, 0, longitude - x1)"
    dy = "greatest(y0 - latitude, 0, latitude - y1)"
    return (
        with_views("", "items", "areas").rstrip()
        + f""", i AS (SELECT *, CASE WHEN {NUM} % 3 = 0 THEN NULL ELSE city END AS c0 FROM items),
 t AS (SELECT *, latitude IS NOT NULL AND longitude IS NOT NULL AND (c0 IS NULL OR trim(c0) = '' OR country = 'ASIA') AS touched FROM i),
 d AS (SELECT code, a.name AS area, round(sqrt({dx} * {dx} + {dy} * {dy}), 9) AS dist FROM t JOIN areas a
   ON (t.country = 'ASIA') = (a.country = 'ASIA') WHERE touched AND t.country NOT IN ('AFRICA', 'AMERICA')),
 b AS (SELECT code, area FROM d QUALIFY row_number() OVER (PARTITION BY code ORDER BY dist, area) = 1)
 SELECT t.code, CASE WHEN NOT touched THEN c0 WHEN country = 'AFRICA' THEN 'City of Africa' WHEN country = 'AMERICA' THEN 'City of America' ELSE area END AS city
 FROM t LEFT JOIN b USING (code)"""
    )


TYPE_LABELS = with_views(
    """, x AS (SELECT CASE WHEN favorite_points % 7 = 0 THEN NULL ELSE geocache_type + favorite_points % 5 END AS t FROM items)
 SELECT CASE t WHEN 2 THEN 'Tradition' WHEN 3 THEN 'Multi' WHEN 4 THEN 'Virtual' WHEN 5 THEN 'Letterbox' WHEN 6 THEN 'Event' WHEN 8 THEN 'Mystery'
  WHEN 11 THEN 'Webcam' WHEN 12 THEN 'Locationless' WHEN 137 THEN 'Earthcache' ELSE CASE WHEN t IS NULL THEN 'Unknown' ELSE 'Type ' || t END END AS label,
  count(*) AS items FROM x GROUP BY 1""",
    "items",
).replace(") , x AS", "), x AS")
SUBTITLES = (
    base()
    + """, x AS (SELECT place AS name, CASE WHEN code LIKE '%9' THEN NULL ELSE country END AS country, count(*) AS n FROM it GROUP BY 1, 2),
 p AS (SELECT n_name AS city, 'Province ' || n_regionkey AS province FROM nation WHERE n_nationkey % 3 = 0)
 SELECT name, CASE country WHEN 'EUROPE' THEN coalesce(province, 'Europa') WHEN 'ASIA' THEN 'Asia' WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'America'
   ELSE coalesce(country, province, '') END AS subtitle, CAST(sum(n) AS BIGINT) AS items
 FROM x LEFT JOIN p ON p.city = x.name GROUP BY 1, 2"""
)
GROWTH = with_views(
    f""", c AS (SELECT owner_username, count(*) AS n, count(*) FILTER (WHERE placed_date < DATE '2001-01-01') AS b FROM items GROUP BY 1)
 SELECT owner_username, CASE WHEN b > 0 THEN {tenths('(n - b) / b * 100')} END AS growth_pct,
  CASE WHEN n > 0 THEN {tenths('(b - n) / n * 100')} ELSE 0 END AS back_pct FROM c""",
    "items",
).replace(") , c AS", "), c AS")
