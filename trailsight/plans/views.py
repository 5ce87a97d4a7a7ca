"""Views that give the test tables the shape of the stored tables.

The text of each view runs unchanged on Spark SQL and on DuckDB; ``{orders}`` and the like stand
for the physical tables.
"""

from __future__ import annotations

import zlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession

AS_OF = date(2001, 6, 15)
REGIONS = {"europe": "EUROPE", "asia": "ASIA", "africa": "AFRICA", "america": "AMERICA"}
SPECIAL = "ASIA"
CONSTANTS = {"AFRICA": "City of Africa", "AMERICA": "City of America"}
BOXES = ((19.2, 73.0, 18.0, 74.0), (20.0, 74.2, 19.0, 75.0))

ITEMS = """
 SELECT 'GC' || CAST(o_orderkey AS STRING) AS code, 'Item ' || CAST(o_orderkey AS STRING) AS name,
  cu.c_name AS owner_username, 'G' || CAST(cu.c_custkey AS STRING) AS owner_guid,
  CASE WHEN n.n_nationkey % 5 = 0 THEN '  ' ELSE n.n_name END AS city, r.r_name AS country,
  CASE WHEN o_orderkey % 50 = 0 THEN 404 WHEN o_orderkey % 20 = 7 THEN NULL WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END AS cache_status,
  CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 2 WHEN '2' THEN 3 WHEN '3' THEN 8 WHEN '4' THEN 137 ELSE 6 END AS geocache_type,
  1 + (o_orderkey % 9) * CAST(0.5 AS DOUBLE) AS difficulty, 1 + (o_custkey % 10) * CAST(0.5 AS DOUBLE) AS terrain,
  CAST(floor(o_totalprice / 10000) AS INT) AS favorite_points,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 18 + (o_orderkey % 500) / CAST(250 AS DOUBLE) END AS latitude,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 73 + (o_custkey % 400) / CAST(200 AS DOUBLE) END AS longitude,
  o_orderkey % 7 = 0 AS premium_only, CAST(o_orderdate AS DATE) AS placed_date
 FROM {orders} JOIN {customer} cu ON o_custkey = cu.c_custkey
 JOIN {nation} n ON cu.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""
VISITS = """
 SELECT 'GC' || CAST(l_orderkey AS STRING) AS gc_code, u.c_name AS user_name,
  CASE WHEN u.c_custkey % 11 = 0 THEN NULL ELSE 'G' || CAST(u.c_custkey AS STRING) END AS user_guid,
  CAST(l_shipdate AS DATE) AS visited, l_returnflag = 'R' AS favorite_point_used, l_linenumber = 1 AS is_ftf,
  CASE WHEN l_quantity >= 48 THEN 'deleted' WHEN l_quantity = 1 THEN NULL WHEN l_linestatus = 'F' THEN 'Attended' ELSE 'Found it' END AS log_type
 FROM {lineitem} LEFT JOIN {customer} u ON l_partkey = u.c_custkey
"""
USERS = """
 SELECT upper(c_name) AS user_name, 'G' || CAST(c_custkey AS STRING) AS guid,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(DATE '1999-06-01' + CAST(c_custkey % 750 AS INT) AS DATE) END AS registration_date,
  CASE WHEN c_custkey % 13 = 0 THEN 'not_found' ELSE 'ok' END AS fetch_status
 FROM {customer} WHERE c_custkey % 4 <> 3
"""
AREAS = """
 SELECT n_name AS name, r_name AS country,
  73 + (n_nationkey % 5) * CAST(0.4 AS DOUBLE) AS x0, 73 + (n_nationkey % 5) * CAST(0.4 AS DOUBLE) + CAST(0.3 AS DOUBLE) AS x1,
  18 + floor(n_nationkey / 5) * CAST(0.4 AS DOUBLE) AS y0, 18 + floor(n_nationkey / 5) * CAST(0.4 AS DOUBLE) + CAST(0.3 AS DOUBLE) AS y1
 FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""
# Visits with repeats: several rows per item and account, some on the same day.
REPEATED = """
 SELECT 'GC' || CAST(l_orderkey AS STRING) AS gc_code,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE 'user ' || CAST(l_linenumber AS STRING) END AS user_name,
  CASE WHEN l_linenumber = 2 THEN NULL WHEN l_linenumber = 4 THEN '' ELSE 'A' || CAST(l_linenumber AS STRING) END AS user_guid,
  CAST(l_shipdate AS DATE) AS visited, l_returnflag = 'R' AS favorite_point_used, l_linestatus = 'F' AS is_ftf,
  CASE WHEN l_quantity < 10 THEN '' WHEN l_linestatus = 'F' THEN 'Attended' ELSE 'Found it' END AS log_type,
  l_partkey AS s1, l_suppkey AS s2, l_quantity AS s3, l_extendedprice AS s4
 FROM {lineitem}
"""
REPEATED_ORDER = ("s1", "s2", "s3", "s4")
# Avatars kept for two thirds of the people, some of them invalid.
AVATARS = """
 SELECT c_name AS user_name,
  CASE WHEN c_custkey % 9 = 0 THEN 'https://example.org/none.gif'
       ELSE 'https://img.geocaching.com/user/square250/' || CAST(c_custkey AS STRING) || '.jpg' END AS avatar_url,
  CASE WHEN c_custkey % 5 = 0 THEN 'default' WHEN c_custkey % 7 = 0 THEN NULL ELSE 'real' END AS avatar_status
 FROM {customer} WHERE c_custkey % 3 <> 0
"""
# Items with the dates that decide on a refresh.
CRAWLED = """
 SELECT 'GC' || CAST(o_orderkey AS STRING) AS code, 18 + o_orderkey % 5 AS latitude, 73 + o_orderkey % 7 AS longitude,
  o_orderkey % 7 = 0 AS premium_only, CAST(o_orderkey % 4 AS INT) AS geocache_type,
  CASE WHEN o_orderkey % 50 = 0 THEN 404 WHEN o_orderkey % 20 = 7 THEN NULL WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END AS cache_status,
  CAST(o_orderdate AS DATE) AS placed_date,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN DATE '0001-01-01'
       ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_custkey % 40 - 3 AS INT) AS DATE) END AS last_found_date,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + 20 AS DATE) END AS logs_crawled_at
 FROM {orders}
"""
REQUESTS = """
 SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'approved' ELSE 'pending' END AS status,
  'actor ' || CAST(o_custkey AS STRING) AS actor, o_orderpriority AS target_series, o_orderstatus AS target_city,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Series ' || CAST(o_custkey % 10 AS STRING) ELSE NULL END AS proposed_series,
  'Town ' || CAST(o_custkey % 7 AS STRING) AS proposed_city,
  CASE WHEN o_orderkey % 5 = 0 THEN 'a note' WHEN o_orderkey % 5 = 1 THEN '' ELSE NULL END AS note,
  o_orderdate < DATE '2001-01-01' AS notified
 FROM {orders}
"""
REQUEST_ITEMS = """
 SELECT l_orderkey AS request_id, l_partkey AS item_id FROM {lineitem} WHERE l_returnflag = 'A'
"""

# Stored items, and what the next crawl brings: renamed owners, new points, missing fields,
# noise below the compared precision, and items not stored yet.
STORED_ITEMS = """
 SELECT CAST(substring(code, 3) AS BIGINT) AS id, code, name, premium_only, favorite_points, geocache_type, difficulty, terrain,
  cache_status, latitude, longitude, CAST(placed_date AS STRING) AS placed_date, owner_username, country, owner_guid,
  CAST(CAST(substring(code, 3) AS BIGINT) % 6 AS INT) AS container_type, '/geocache/' || code AS details_url,
  CAST(CAST(placed_date + 30 AS DATE) AS STRING) AS last_found_date, CAST(CAST(substring(code, 3) AS BIGINT) % 4 AS INT) AS trackable_count
 FROM {items} i WHERE CAST(substring(code, 3) AS BIGINT) % 10 <> 4
"""
INCOMING_ITEMS = """
 SELECT id, code, CASE WHEN id % 10 = 1 THEN name || ' ' ELSE name END AS name, premium_only,
  CASE WHEN id % 10 = 3 THEN favorite_points + 1 ELSE favorite_points END AS favorite_points, geocache_type,
  CASE WHEN id % 10 = 9 THEN difficulty + 0.5 ELSE difficulty END AS difficulty, terrain, cache_status,
  CASE WHEN premium_only THEN NULL WHEN id % 10 = 2 THEN latitude + 0.00000001 ELSE latitude END AS latitude,
  CASE WHEN premium_only THEN NULL ELSE longitude END AS longitude,
  CASE WHEN id % 2 = 0 THEN placed_date || 'T00:00:00Z' ELSE placed_date END AS placed_date,
  CASE WHEN id % 10 = 5 THEN owner_username || ' II' ELSE owner_username END AS owner_username,
  CASE WHEN id % 10 = 6 THEN NULL ELSE country END AS country, CAST(NULL AS STRING) AS owner_guid,
  CAST(CASE WHEN id % 30 = 7 THEN id % 6 + 1 ELSE id % 6 END AS INT) AS container_type,
  CASE WHEN id % 10 = 1 THEN ' /geocache/' || code WHEN id % 40 = 8 THEN '/moved/' || code ELSE '/geocache/' || code END AS details_url,
  CASE WHEN id % 10 = 2 THEN CAST(CAST(found + 1 AS DATE) AS STRING) WHEN id % 2 = 0 THEN CAST(found AS STRING) || ' 00:00:00' ELSE CAST(found AS STRING) END AS last_found_date,
  CAST(CASE WHEN id % 10 = 5 THEN NULL WHEN id % 13 = 0 THEN id % 4 + 2 ELSE id % 4 END AS INT) AS trackable_count
 FROM (SELECT CAST(substring(code, 3) AS BIGINT) AS id, code, name, premium_only, favorite_points, geocache_type, difficulty, terrain,
  cache_status, latitude, longitude, CAST(placed_date AS STRING) AS placed_date, owner_username, country, CAST(placed_date + 30 AS DATE) AS found FROM {items} i) x
 WHERE id % 97 <> 0
"""
# One visit per item and person, as stored and as landed next.
CLEAN_VISITS = """
 SELECT CAST(substring(gc_code, 3) AS BIGINT) AS k, gc_code, user_name, user_guid, max(visited) AS visited,
  bool_or(favorite_point_used) AS favorite_point_used, bool_or(is_ftf) AS is_ftf, max(log_type) AS log_type
 FROM {visits} v WHERE user_name IS NOT NULL GROUP BY gc_code, user_name, user_guid
"""
STORED_VISITS = """
 SELECT gc_code, user_name, user_guid, visited, favorite_point_used, is_ftf, log_type
 FROM {clean_visits} c WHERE k % 10 <> 4
"""
INCOMING_VISITS = """
 SELECT gc_code, CASE WHEN k % 10 = 5 THEN user_name || ' II' ELSE user_name END AS user_name,
  CASE WHEN k % 10 = 6 THEN 'deleted' ELSE user_guid END AS user_guid,
  CASE WHEN k % 10 = 3 THEN CAST(visited + 1 AS DATE) ELSE visited END AS visited,
  CASE WHEN k % 10 = 8 THEN NOT favorite_point_used ELSE favorite_point_used END AS favorite_point_used,
  is_ftf, CASE WHEN k % 10 = 7 THEN NULL ELSE log_type END AS log_type
 FROM {clean_visits} c WHERE k % 3 <> 0
"""
# Stored visits in which some people without an account id appear twice for one item.
REPEATED_STORED = """
 SELECT * FROM {stored_visits} s UNION ALL
 SELECT gc_code, user_name, user_guid, CAST(visited - 3 AS DATE) AS visited, favorite_point_used, is_ftf, log_type
 FROM {clean_visits} c WHERE k % 10 = 2 AND user_guid IS NULL
"""
# What came of fetching items: some failed, some were fetched and have no visits.
RESULTS = """
 SELECT 'GC' || CAST(l_orderkey AS STRING) AS code, CAST(l_linenumber AS BIGINT) AS attempt, CAST(l_linenumber AS INT) AS round,
  CASE WHEN CAST(l_quantity AS INT) % 4 = 0 THEN NULL WHEN CAST(l_quantity AS INT) % 4 = 1 THEN 'timeout' ELSE 'status 500' END AS error,
  CASE WHEN CAST(l_quantity AS INT) % 8 = 0 THEN NULL ELSE 'user ' || CAST(l_suppkey AS STRING) END AS user_name, CAST(l_shipdate AS DATE) AS visited
 FROM {lineitem}
"""
# Crawled boxes of all sizes, many of them overlapping.
CRAWL_BOXES = """
 SELECT 18.0 + (c_custkey % 97) / CAST(60 AS DOUBLE) + CASE WHEN c_custkey % 50 = 0 THEN CAST(0.7 AS DOUBLE) ELSE CAST(0.01 AS DOUBLE) END AS max_lat,
  73.0 + (c_custkey % 89) / CAST(50 AS DOUBLE) AS min_lon, 18.0 + (c_custkey % 97) / CAST(60 AS DOUBLE) AS min_lat,
  73.0 + (c_custkey % 89) / CAST(50 AS DOUBLE) + CASE WHEN c_custkey % 50 = 0 THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.015 AS DOUBLE) END AS max_lon
 FROM {customer} WHERE c_custkey % 3 <> 0
"""
STORED_USERS = """
 SELECT user_name, CASE WHEN k % 6 = 0 THEN NULL ELSE guid END AS guid, registration_date, fetch_status,
  CASE WHEN k % 5 = 0 THEN NULL ELSE 'Place ' || CAST(k % 7 AS STRING) END AS reg_place
 FROM (SELECT *, CAST(substring(guid, 2) AS BIGINT) AS k FROM {users} u) x WHERE k % 10 <> 4
"""
# A batch of enrichment results in which some people occur twice.
USER_BATCH = """
 SELECT upper(c_name) AS user_name, 'N' || CAST(c_custkey AS STRING) AS guid, s AS seq,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(DATE '2000-01-01' + CAST(c_custkey % 300 + s AS INT) AS DATE) END AS registration_date,
  CASE WHEN c_custkey % 3 = 0 THEN 'parse_failed' ELSE 'ok' END AS fetch_status,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'Land ' || CAST(s AS STRING) END AS reg_place
 FROM (SELECT c_name, c_custkey, 0 AS s FROM {customer} UNION ALL SELECT c_name, c_custkey, 1 AS s FROM {customer} WHERE c_custkey % 2 = 0) d
"""
AVATAR_BATCH = """
 SELECT c_name AS user_name,
  CASE WHEN c_custkey % 4 = 0 THEN 'https://img.geocaching.com/user/square250/n' || CAST(c_custkey AS STRING) || '.png?x=1'
       ELSE 'http://elsewhere/' || CAST(c_custkey AS STRING) END AS avatar_url,
  CASE WHEN c_custkey % 6 = 1 THEN 'default' WHEN c_custkey % 6 = 5 THEN 'failed' ELSE 'real' END AS avatar_status
 FROM {customer} WHERE c_custkey % 2 = 0 OR c_custkey % 6 = 1 OR c_custkey % 6 = 5
"""

VIEWS = {
    "items": ITEMS,
    "visits": VISITS,
    "users": USERS,
    "areas": AREAS,
    "repeated": REPEATED,
    "avatars": AVATARS,
    "crawled": CRAWLED,
    "requests": REQUESTS,
    "request_items": REQUEST_ITEMS,
    "stored_items": STORED_ITEMS,
    "incoming_items": INCOMING_ITEMS,
    "clean_visits": CLEAN_VISITS,
    "stored_visits": STORED_VISITS,
    "incoming_visits": INCOMING_VISITS,
    "repeated_stored": REPEATED_STORED,
    "results": RESULTS,
    "crawl_boxes": CRAWL_BOXES,
    "stored_users": STORED_USERS,
    "user_batch": USER_BATCH,
    "avatar_batch": AVATAR_BATCH,
}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class _Names(dict):
    """Resolves a placeholder to a table or to another view's text."""

    def __missing__(self, name: str) -> str:
        return f"({VIEWS[name].format_map(self)})"


_registered: set[tuple] = set()


class _Tables(_Names):
    """Also registers a physical table as a temporary view the first time it is asked for, so that
    its files are looked up once per session."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self._spark, self._dir = spark, sf_dir

    def __missing__(self, name: str) -> str:
        if name not in TABLES:
            return super().__missing__(name)
        view_name = f"t{zlib.crc32(self._dir.encode()):08x}_{name}"
        seen = (self._spark._jsparkSession.sessionUUID(), view_name)
        if seen not in _registered:
            self._spark.read.parquet(f"{self._dir}/{name}.parquet").createOrReplaceTempView(view_name)
            _registered.add(seen)
        return view_name


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(VIEWS[name].format_map(_Tables(spark, sf_dir)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.table(_Tables(spark, sf_dir)[name])


def with_views(sql: str, *names: str) -> str:
    """The query with the named views in front, for an engine that knows the tables by name."""
    tables = _Names({t: t for t in TABLES})
    parts = [f"{n} AS ({VIEWS[n].format_map(tables)})" for n in names]
    return f"WITH {', '.join(parts)} {sql}"
