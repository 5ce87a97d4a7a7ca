"""From landed pages to clean records: flatten, deduplicate, compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from trailsight.functions import fixed, scopes, text
from trailsight.operators.merge import last_per_key
from trailsight.operators.spatial import in_boxes

ITEM_SCHEMA = """
    id bigint, name string, code string, premiumOnly string, favoritePoints int,
    geocacheType int, containerType int, difficulty double, terrain double, cacheStatus int,
    postedCoordinates struct<latitude: double, longitude: double>, detailsUrl string,
    placedDate string, owner struct<username: string>, lastFoundDate string,
    trackableCount int, region string, country string,
    attributes array<struct<id: int, name: string, isApplicable: boolean>>
"""
ITEM_PAGE_SCHEMA = (
    f"pageProps struct<searchResults: struct<total: bigint, results: array<struct<{ITEM_SCHEMA}>>>>"
)
VISIT_PAGE_SCHEMA = """
    data array<struct<LogType: string, LogText: string, UserName: string, Visited: string,
                      FavoritePointUsed: boolean, AccountGuid: string>>
"""


def flatten_items(
    pages: DataFrame,
    boxes: Sequence[Sequence[float]] | None = fixed.CRAWL_BOXES,
    countries: Sequence[str] | None = fixed.ALLOWED_COUNTRIES,
    column: str = "body",
) -> DataFrame:
    """Landed map pages, as JSON text, to flat item rows that pass the box and country filters.

    A page is parsed once: the filters stay above the explode.
    """
    results = F.from_json(column, ITEM_PAGE_SCHEMA)["pageProps"]["searchResults"]["results"]
    doc = pages.select(F.explode(results).alias("d"))
    attributes = F.transform(
        F.filter("d.attributes", lambda a: a["isApplicable"]),
        lambda a: F.struct(a["id"].alias("id"), a["name"].alias("name")),
    )
    flat = doc.select(
        F.col("d.id").alias("id"),
        F.col("d.name").alias("name"),
        F.col("d.code").alias("code"),
        text.flag("d.premiumOnly").alias("premium_only"),
        F.col("d.favoritePoints").alias("favorite_points"),
        F.col("d.geocacheType").alias("geocache_type"),
        F.col("d.containerType").alias("container_type"),
        F.col("d.difficulty").alias("difficulty"),
        F.col("d.terrain").alias("terrain"),
        F.col("d.cacheStatus").alias("cache_status"),
        F.col("d.postedCoordinates.latitude").alias("latitude"),
        F.col("d.postedCoordinates.longitude").alias("longitude"),
        F.col("d.detailsUrl").alias("details_url"),
        F.col("d.placedDate").alias("placed_date"),
        F.col("d.owner.username").alias("owner_username"),
        F.lit(None).cast("string").alias("owner_guid"),
        F.col("d.lastFoundDate").alias("last_found_date"),
        F.col("d.trackableCount").alias("trackable_count"),
        F.col("d.region").alias("region"),
        F.col("d.country").alias("country"),
        attributes.alias("attributes"),
    ).filter(scopes.filled("code"))
    if boxes is not None:
        flat = flat.filter(scopes.passes_box("latitude", "longitude", "premium_only", boxes))
    if countries is not None:
        flat = flat.filter(F.col("country").isin(*countries))
    return flat


_RESULTS_PATH = "$.pageProps.searchResults.results"


def _is_known(field: Column, rows: DataFrame) -> Column:
    return field.isin(*rows.sparkSession.createDataFrame([], ITEM_SCHEMA).columns)


def item_variants(pages: DataFrame, column: str = "body") -> DataFrame:
    """The items of landed pages with whatever fields they have, one VARIANT each; unreadable pages have none."""
    results = F.try_variant_get(F.try_parse_json(column), _RESULTS_PATH, "array<variant>")
    return pages.select(F.explode(results).alias("item")).filter("item IS NOT NULL")


def unknown_fields(pages: DataFrame, column: str = "body") -> DataFrame:
    """(field, type, items): fields of landed items that no column is made of, with the type over all
    items that have them and their number. Types that differ come as one that holds both."""
    fields = F.explode(F.try_variant_get("item", "$", "map<string,variant>"))
    each = item_variants(pages, column).select(fields.alias("field", "value"))
    return (
        each.filter(~_is_known(F.col("field"), pages))
        .groupBy("field")
        .agg(F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("items"))
    )


def flatten_extra(pages: DataFrame, column: str = "body") -> DataFrame:
    """(code, extra): the unknown fields of each landed item that has some, as JSON, so that none is lost."""
    fields = F.try_variant_get("item", "$", "map<string,variant>")
    extra = F.map_filter(fields, lambda k, _: ~_is_known(k, pages))
    rows = item_variants(pages, column).select(F.try_variant_get("item", "$.code", "string").alias("code"), extra.alias("extra"))
    return rows.filter(scopes.filled("code") & (F.size("extra") > 0)).select("code", F.to_json("extra").alias("extra"))


def with_extra(items: DataFrame, extra: DataFrame, additions: Mapping[str, tuple[str, str, object]]) -> DataFrame:
    """Items with columns taken from the unknown fields, by name: (field, type, default). A value of
    another type, and a missing one, is the default."""
    values = extra.groupBy("code").agg(F.max("extra").alias("_extra"))
    joined = items.join(values, "code", "left")
    value = F.try_parse_json(F.col("_extra"))
    added = {
        name: F.coalesce(F.try_variant_get(value, f"$['{field}']", kind), F.lit(default).cast(kind))
        for name, (field, kind, default) in additions.items()
    }
    return joined.select(*[F.col(c) for c in items.columns], *[v.alias(n) for n, v in added.items()])


def declared_totals(pages: DataFrame, box: str = "box", column: str = "body") -> DataFrame:
    """(box, declared): the number of items the source says a box holds; 0 is no statement."""
    total = F.from_json(
        column, "pageProps struct<searchResults: struct<total: bigint>>"
    )["pageProps"]["searchResults"]["total"]
    return pages.groupBy(F.col(box).alias("box")).agg(F.max(F.nullif(total, F.lit(0))).alias("declared"))


def flatten_visits(pages: DataFrame, column: str = "body") -> DataFrame:
    """Visit pages (gc_code, geocache_type, JSON body, maybe page) to visit rows of the accepted type.

    ``page`` (0 where pages are not numbered) and ``seq``, the place on the page, carry "first
    seen" over the shuffle; order by both.
    """
    page = F.col("page").cast("bigint") if "page" in pages.columns else F.lit(0).cast("bigint")
    entries = pages.select(
        "gc_code", "geocache_type", page.alias("page"), F.posexplode(F.from_json(column, VISIT_PAGE_SCHEMA)["data"])
    ).select("gc_code", "geocache_type", "page", F.col("pos").alias("seq"), "col.*")
    kept = entries.filter(scopes.accepted_visit_type("geocache_type", "LogType"))
    return kept.select(
        "gc_code",
        F.col("UserName").alias("user_name"),
        text.normal_date("Visited").alias("visited"),
        F.coalesce("FavoritePointUsed", F.lit(False)).alias("favorite_point_used"),
        text.has_first_marker("LogText").alias("is_ftf"),
        F.col("LogType").alias("log_type"),
        F.col("AccountGuid").alias("user_guid"),
        "page",
        "seq",
    )


def visit_key() -> Column:
    """Account id when there is one, else the name; the two never collide."""
    return F.when(scopes.filled("user_guid"), F.concat(F.lit("g:"), "user_guid")).when(
        scopes.filled("user_name"), F.concat(F.lit("n:"), "user_name")
    )


def dedup_visits(visits: DataFrame, order: Sequence[str]) -> DataFrame:
    """Newest row per (item, account); rows of the same newest day are merged.

    Merging ORs both flags over the newest day and keeps the first row otherwise, with the first
    non-empty visit type. ``order`` tells which row came first. One aggregation without a window:
    every part of the answer is a minimum or maximum that starts with the day, so a key of any
    size is reduced on the map side.
    """
    day = F.col("visited")
    if not isinstance(visits.schema["visited"].dataType, DateType):
        day = text.date_sort_key(day.cast("string")).try_cast("date")
    # Days descending under min(): missing and unparsable dates come last.
    start = F.lit(text.NO_DATE).cast("date")
    recency = F.coalesce(F.datediff(start, day), F.lit(0))
    seq = [F.col(c) for c in order]
    kept = [c for c in visits.columns if c not in ("gc_code", *_MERGED)]
    typed = F.nullif("log_type", F.lit(""))

    def any_newest(name: str) -> Column:
        # Newest day first, and on it a row with the flag first: even means the flag is set.
        packed = F.col("_d") * 2 + F.when(F.col(name), F.lit(0)).otherwise(F.lit(1))
        return (F.min(packed) % 2 == 0).alias(name)

    return (
        visits.filter(scopes.filled("gc_code"))
        .withColumns({"_key": visit_key(), "_d": recency})
        .filter(F.col("_key").isNotNull())
        .groupBy("gc_code", "_key")
        .agg(
            F.min(F.struct("_d", *seq, F.struct(*kept).alias("row"))).alias("_first"),
            F.min(F.struct("_d", typed.isNull().alias("_t"), *seq, typed.alias("log_type"))).alias("_typed"),
            any_newest("favorite_point_used"),
            any_newest("is_ftf"),
        )
        .select(
            "gc_code",
            *[F.col(f"_first.row.{c}").alias(c) for c in kept],
            "favorite_point_used",
            "is_ftf",
            F.coalesce("_typed.log_type", F.lit(fixed.FOUND)).alias("log_type"),
        )
        .select(*visits.columns)
    )


_MERGED = ("favorite_point_used", "is_ftf", "log_type")


def keep_latest(visits: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Only the row of the newest day per key; ``order`` settles equal days."""
    rest = [c for c in visits.columns if c not in keys]
    day = F.coalesce(F.datediff(F.lit("0001-01-01").cast("date"), F.col("visited")), F.lit(1))
    best = F.min(F.struct(day.alias("_d"), *order, F.struct(*rest).alias("row")))
    return (
        visits.groupBy(*keys)
        .agg(best.alias("_b"))
        .select(*keys, *[F.col(f"_b.row.{c}").alias(c) for c in rest])
        .select(*visits.columns)
    )


# --- comparing incoming with stored records -------------------------------------------------

ITEM_FIELDS = (
    "id", "name", "premium_only", "favorite_points", "geocache_type", "container_type",
    "difficulty", "terrain", "cache_status", "details_url", "placed_date", "owner_username",
    "last_found_date", "trackable_count", "region", "country", "attributes", "owner_guid",
)
POSITION_FIELDS = ("latitude", "longitude")


def canonical_field(name: str, prefix: str = "") -> Column:
    """The form in which a field is compared, by kind of field."""
    full = prefix + name
    if name in POSITION_FIELDS:
        return text.rounded(full, 6)
    if name in ("difficulty", "terrain"):
        return text.rounded(full, 1)
    if name == "attributes":
        return text.canonical_attributes(full)
    if name == "premium_only":
        return text.flag(full)
    if name in ("placed_date", "last_found_date"):
        return text.normal_timestamp(full)
    if name in ("name", "details_url", "owner_username", "region", "country", "owner_guid"):
        return F.trim(F.col(full))
    return F.col(full).cast("bigint")


def canonical_items(items: DataFrame) -> DataFrame:
    fields = [f for f in (*ITEM_FIELDS, *POSITION_FIELDS) if f in items.columns]
    return items.select("code", *[canonical_field(f).alias(f) for f in fields])


def field_changed(name: str, new: str = "new.", old: str = "old.") -> Column:
    """Changed, unless the incoming record lacks the field; positions of premium items never."""
    differs = ~canonical_field(name, new).eqNullSafe(canonical_field(name, old))
    changed = F.col(new + name).isNotNull() & differs
    if name in POSITION_FIELDS:
        changed = changed & ~F.coalesce(F.col(new + "premium_only"), F.lit(False))
    return changed


def _item_pairs(incoming: DataFrame, stored: DataFrame, how: str) -> DataFrame:
    """Both sides of a code with ``_changed_<field>`` for each compared field: comparing costs far more
    than the rest of a merge, and every column that comes of it asks for these."""
    new, old = incoming.alias("new"), stored.alias("old")
    flags = {f"_changed_{f}": field_changed(f) for f in _comparable(incoming, stored)}
    return new.join(old, F.col("new.code") == F.col("old.code"), how).withColumns(flags)


def _comparable(incoming: DataFrame, stored: DataFrame) -> list[str]:
    both = set(incoming.columns) & set(stored.columns)
    return [f for f in (*ITEM_FIELDS, *POSITION_FIELDS) if f in both]


def _item_change(fields: Sequence[str]) -> Column:
    changed = F.lit(False)
    for f in fields:
        changed = changed | F.col(f"_changed_{f}")
    return (
        F.when(F.col("old.code").isNull(), F.lit("new"))
        .when(changed, F.lit("updated"))
        .otherwise(F.lit("unchanged"))
    )


def settled_items(incoming: DataFrame, order: Sequence[str]) -> DataFrame:
    """The last record of every code by ``order``; records without a code are left out.

    Boxes share edges and pages shift while they are read, so one crawl may hold a code twice.
    """
    rows = incoming.filter(F.col("code").isNotNull())
    return last_per_key(rows, "code", order) if order else rows


def _item_notes(fields: Sequence[str]) -> Column:
    """'field: before -> after' of every changed field; empty for new records."""

    def shown(name: str) -> Column:
        col = F.to_json(name) if name.endswith(".attributes") else F.col(name).cast("string")
        return F.coalesce(col, F.lit("None"))

    notes = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col("old.code").isNotNull() & F.col(f"_changed_{f}"),
                    F.concat(F.lit(f"{f}: "), shown(f"old.{f}"), F.lit(" -> "), shown(f"new.{f}")),
                )
                for f in fields
            ]
        )
    )
    return F.array_join(notes, " | ")


def diff_items(incoming: DataFrame, stored: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """(code, change, fields): new, updated or unchanged, with 'field: before -> after' texts.

    ``order`` says which record of a code is the last; without it codes have to be unique.
    """
    incoming = settled_items(incoming, order)
    fields = _comparable(incoming, stored)
    return _item_pairs(incoming, stored, "left").select(
        F.col("new.code").alias("code"),
        _item_change(fields).alias("change"),
        _item_notes(fields).alias("fields"),
    )


def diff_counts(diffs: DataFrame, *keys: str) -> DataFrame:
    """New and updated counters per box and run."""
    return diffs.groupBy(*keys).agg(
        F.count_if(F.col("change") == "new").alias("new_items"),
        F.count_if(F.col("change") == "updated").alias("updated_items"),
    )


def _taken_items(incoming: DataFrame, stored: DataFrame) -> tuple[Column, list[Column]]:
    """Whether a pair takes the incoming record, and the columns of ``stored`` after it did or not; these
    read the first as ``_take``."""
    take = F.col("old.code").isNull() | (_item_change(_comparable(incoming, stored)) == "updated")
    take = F.col("new.code").isNotNull() & take
    premium_known = F.col("old.code").isNotNull() & F.coalesce(
        F.col("new.premium_only"), F.lit(False)
    )
    out = []
    for c in stored.columns:
        kind = stored.schema[c].dataType
        if c not in incoming.columns:
            out.append(F.col(f"old.{c}").alias(c))
            continue
        new, old = F.col(f"new.{c}").cast(kind), F.col(f"old.{c}")
        if c in POSITION_FIELDS:
            new = F.when(premium_known, old).otherwise(new)
        elif c == "owner_guid":
            new = F.coalesce(new, old)
        out.append(F.when(F.col("_take"), new).otherwise(old).alias(c))
    return take, out


def merge_items(incoming: DataFrame, stored: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Stored items after applying new and changed incoming rows; columns of ``stored``.

    ``order`` says which record of a code is the last; without it codes have to be unique.

    A changed row takes every incoming value, except that premium items keep their stored
    position and a known owner id is never erased by a missing one.
    """
    incoming = settled_items(incoming, order)
    take, out = _taken_items(incoming, stored)
    return _item_pairs(incoming, stored, "full_outer").withColumn("_take", take).select(*out)


def _tagged(take: Column, is_new: Column, notes: Column, before: Column, after: Sequence[Column]) -> list[Column]:
    action = F.when(take & is_new, F.lit("insert")).when(take, F.lit("update")).otherwise(F.lit("keep"))
    return [
        action.alias("action"),
        F.when(take & ~is_new, notes).otherwise(F.lit("")).alias("changes"),
        F.when(take & ~is_new, before).alias("before"),
        F.struct(*after).alias("after"),
    ]


def tag_items(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """What a merge does to each row, incoming codes and stored codes being unique: action (insert,
    update or keep), changes as text, the row before an update, and the row after."""
    take, out = _taken_items(incoming, stored)
    before = F.struct(*[F.col(f"old.{c}").alias(c) for c in stored.columns])
    notes = _item_notes(_comparable(incoming, stored))
    tags = _tagged(F.col("_take"), F.col("old.code").isNull(), notes, before, out)
    return _item_pairs(incoming, stored, "full_outer").withColumn("_take", take).select(*tags)


def vanished_items(
    known: DataFrame,
    crawled: DataFrame,
    boxes: Sequence[Sequence[float]] | DataFrame = fixed.CRAWL_BOXES,
) -> DataFrame:
    """Known, not archived items this crawl did not return, where it should have: inside a
    crawled box or without a position. Boxes are a short list, or a table of any size.
    """
    unplaced = F.col("latitude").isNull() | F.col("longitude").isNull()
    live = known.filter(~F.col("cache_status").eqNullSafe(fixed.STATUS_ARCHIVED))
    if isinstance(boxes, DataFrame):
        expected = in_boxes(live, boxes).unionByName(live.filter(unplaced))
    else:
        expected = live.filter(unplaced | scopes.in_any_box("latitude", "longitude", boxes))
    return (
        expected
        .join(crawled.select("code"), "code", "left_anti")
        .select("code", "cache_status", unplaced.alias("unplaced"))
    )


def vanished_to_check(
    vanished: DataFrame, known: DataFrame, share: float = fixed.SUSPICIOUS_SHARE
) -> DataFrame:
    """All vanished items, with ``suspicious`` set when they are more than a share of the known
    ones: then the crawl is rather broken than the items gone, and the caller decides.
    """
    gone = vanished.agg(F.count(F.lit(1)).alias("n")).scalar()
    all_known = known.agg(F.count(F.lit(1)).alias("n")).scalar()
    return vanished.withColumn("suspicious", gone > all_known * share)


def visit_change(new: str = "new.", old: str = "old.") -> dict[str, Column]:
    """Which visit fields differ, with the defaults both sides are read with."""

    def b(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(False))

    def kind(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(fixed.FOUND))

    return {
        "visited": ~F.col(new + "visited").eqNullSafe(F.col(old + "visited")),
        "favorite_point_used": b(new + "favorite_point_used") != b(old + "favorite_point_used"),
        "is_ftf": b(new + "is_ftf") != b(old + "is_ftf"),
        "log_type": kind(new + "log_type") != kind(old + "log_type"),
        "user_name": ~F.col(new + "user_name").eqNullSafe(F.col(old + "user_name")),
    }


def has_account(prefix: str = "") -> Column:
    guid = F.col(prefix + "user_guid")
    return F.coalesce((guid != "") & (guid != fixed.DELETED_GUID), F.lit(False))


def _visit_match() -> Column:
    # A visit without a usable account id never matches a stored row.
    return (
        (F.col("new.gc_code") == F.col("old.gc_code"))
        & (F.col("new.user_guid") == F.col("old.user_guid"))
    )


def dated(incoming: DataFrame) -> DataFrame:
    """Visits with ``visited`` as a date; a text that is none becomes NULL instead of ending the job.

    Put ``split_rejects`` with a rule on the date before a merge to keep such rows out of the table.
    """
    if isinstance(incoming.schema["visited"].dataType, DateType):
        return incoming
    return incoming.withColumn("visited", F.col("visited").cast("string").try_cast("date"))


def settled_visits(rows: DataFrame) -> DataFrame:
    """One row for each (item, account): the newest, of equal days the largest by its values.

    Rows without an account pass; they have no key to be settled by.
    """
    rest = [c for c in rows.columns if c not in ("gc_code", "user_guid")]
    newest = F.max_by(F.struct(*rest), F.struct("visited", *[F.col(c).cast("string") for c in rest]))
    one = rows.filter(has_account()).groupBy("gc_code", "user_guid").agg(newest.alias("_r"))
    one = one.select("gc_code", "user_guid", *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*rows.columns)
    return one.unionByName(rows.filter(~has_account()))


def diff_visits(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming visits, settled, with ``change``: insert, update or unchanged."""
    incoming, stored = settled_visits(dated(incoming)), settled_visits(stored)
    old = stored.filter(has_account()).alias("old")
    changes = visit_change()
    changed = F.lit(False)
    for cond in changes.values():
        changed = changed | cond
    # Rows without an account keep out of the join: they would all share one join key.
    named = incoming.filter(has_account()).alias("new").join(old, _visit_match(), "left").select(
        "new.*",
        F.when(F.col("old.gc_code").isNull(), F.lit("insert"))
        .when(changed, F.lit("update"))
        .otherwise(F.lit("unchanged"))
        .alias("change"),
    )
    nameless = incoming.filter(~has_account()).withColumn("change", F.lit("insert"))
    return named.unionByName(nameless)


def insert_absent(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored visits plus the incoming ones, settled, whose (item, account) is not there yet."""
    incoming = settled_visits(dated(incoming))
    keys = stored.filter(has_account()).select("gc_code", "user_guid")
    fresh = incoming.filter(has_account()).join(keys, ["gc_code", "user_guid"], "left_anti")
    nameless = incoming.filter(~has_account())
    return stored.unionByName(fresh.select(*stored.columns)).unionByName(
        nameless.select(*stored.columns)
    )


def _taken_visits(stored: DataFrame) -> tuple[Column, list[Column]]:
    """Whether a pair takes the incoming visit, and the columns of ``stored`` after it did or not; these
    read the first as ``_take``."""
    defaults = {
        "favorite_point_used": F.lit(False),
        "is_ftf": F.lit(False),
        "log_type": F.lit(fixed.FOUND),
    }

    def value(c: str) -> Column:
        col = F.col(f"new.{c}").cast(stored.schema[c].dataType)
        return F.coalesce(col, defaults[c]) if c in defaults else col

    changed = F.lit(False)
    for cond in visit_change().values():
        changed = changed | cond
    take = F.col("new.gc_code").isNotNull() & (F.col("old.gc_code").isNull() | changed)
    return take, [F.when(F.col("_take"), value(c)).otherwise(F.col(f"old.{c}")).alias(c) for c in stored.columns]


def merge_visits(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored visits after inserting new and rewriting changed incoming ones.

    Both sides are settled first, so doubled rows of an account leave one.
    """
    columns = stored.columns
    incoming, stored = settled_visits(dated(incoming)), settled_visits(stored)
    old = stored.filter(has_account()).alias("old")
    new = incoming.filter(has_account()).alias("new")
    take, out = _taken_visits(stored)
    merged = new.join(old, _visit_match(), "full_outer").withColumn("_take", take).select(*out)
    rest = stored.filter(~has_account()).select(*columns)
    nameless = incoming.filter(~has_account()).select(*columns)
    return merged.unionByName(rest).unionByName(nameless)


def tag_visits(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """What a merge does to each row, incoming and stored accounts of an item being unique; see
    ``tag_items``. Incoming visits without an account are inserted, stored ones kept."""
    columns = stored.columns
    old, new = stored.filter(has_account()).alias("old"), incoming.filter(has_account()).alias("new")
    take, out = _taken_visits(stored)
    before = F.struct(*[F.col(f"old.{c}").alias(c) for c in columns])
    tags = _tagged(F.col("_take"), F.col("old.gc_code").isNull(), F.concat_ws("; ", *_visit_reasons()), before, out)
    merged = new.join(old, _visit_match(), "full_outer").withColumn("_take", take).select(*tags)
    shape = lambda action: [
        F.lit(action).alias("action"), F.lit("").alias("changes"),
        F.lit(None).cast(merged.schema["before"].dataType).alias("before"),
        F.struct(*[F.col(c).cast(stored.schema[c].dataType).alias(c) for c in columns]).alias("after"),
    ]
    rest = stored.filter(~has_account()).select(*shape("keep"))
    nameless = incoming.filter(~has_account()).select(*shape("insert"))
    return merged.unionByName(rest).unionByName(nameless)


def _visit_reasons() -> list[Column]:
    """'field: before -> after' of each field of a visit, null where it is unchanged."""
    shown = {
        "visited": lambda p: F.date_format(p + "visited", "yyyy-MM-dd"),
        "favorite_point_used": lambda p: F.coalesce(F.col(p + "favorite_point_used"), F.lit(False)).cast("string"),
        "is_ftf": lambda p: F.coalesce(F.col(p + "is_ftf"), F.lit(False)).cast("string"),
        "log_type": lambda p: F.coalesce(F.col(p + "log_type"), F.lit(fixed.FOUND)),
    }
    changes = visit_change()
    return [
        F.when(
            changes[f],
            F.concat(
                F.lit(f"{f}: "), F.coalesce(show("old."), F.lit("")), F.lit(" -> "),
                F.coalesce(show("new."), F.lit("")),
            ),
        )
        for f, show in shown.items()
    ]


def change_details(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """One row per visit that a merge would insert or rewrite, with its reasons as text.

    Visits with an account are matched by it, others by name. A stored key that occurs more than
    once is itself a reason.
    """

    def keyed(frame: DataFrame) -> DataFrame:
        return frame.withColumn(
            "_key",
            F.when(has_account(), F.concat(F.lit("g:"), "user_guid")).otherwise(
                F.concat(F.lit("n:"), F.coalesce("user_name", F.lit("")))
            ),
        )

    latest = F.max_by(
        F.struct("user_name", "visited", "favorite_point_used", "is_ftf", "log_type"),
        F.struct("visited", "user_name", "log_type", "favorite_point_used", "is_ftf"),
    )
    old = (
        keyed(stored)
        .groupBy("gc_code", "_key")
        .agg(latest.alias("old"), F.count(F.lit(1)).alias("_copies"))
    )
    new = keyed(incoming).select(
        "gc_code",
        "_key",
        F.struct("user_name", "visited", "favorite_point_used", "is_ftf", "log_type").alias("new"),
    )
    paired = new.join(old, ["gc_code", "_key"], "left")
    reasons = _visit_reasons()
    copies = F.when(
        F.col("_copies") > 1, F.concat(F.lit("duplicate_count="), F.col("_copies").cast("string"))
    )
    text_of = F.when(F.col("_copies").isNull(), F.lit("missing")).otherwise(
        F.concat_ws("; ", *reasons, copies)
    )
    return (
        paired.select(
            "gc_code",
            F.coalesce("new.user_name", F.lit("")).alias("user_name"),
            F.when(F.col("_copies").isNull(), F.lit("insert")).otherwise(F.lit("update")).alias("action"),
            text_of.alias("changes"),
        )
        .filter(F.col("changes") != "")
    )


def change_summary(details: DataFrame, per_item: int = fixed.DETAILS_PER_ITEM) -> DataFrame:
    """Counts per item and its first few details as one text.

    The details are cut to ``per_item`` rows per item before they are collected, so the list of
    an item with very many changes is never built. Summaries of several batches add up by
    feeding the union of their details.
    """
    order = Window.partitionBy("gc_code").orderBy("user_name", "action", "changes")
    line = F.concat("user_name", F.lit(" "), "action", F.lit(" "), "changes")
    report = (
        details.withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= per_item)
        .groupBy("gc_code")
        .agg(F.array_sort(F.collect_list(F.struct("_n", line.alias("line")))).alias("_l"))
        .select("gc_code", F.array_join(F.transform("_l", lambda x: x["line"]), "\n").alias("report"))
    )
    counts = details.groupBy("gc_code").agg(
        F.count_if(F.col("action") == "insert").alias("inserted"),
        F.count_if(F.col("action") == "update").alias("updated"),
    )
    return counts.join(report, "gc_code").select(
        F.col("gc_code").alias("code"),
        (F.col("inserted") + F.col("updated")).alias("raw"),
        "inserted",
        "updated",
        "report",
    )


def split_rejects(rows: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a row is rejected with the name of the first rule it breaks."""
    error = None
    for name, ok in rules.items():
        broken = ~F.coalesce(ok, F.lit(False))
        error = F.when(broken, F.lit(name)) if error is None else error.when(broken, F.lit(name))
    marked = rows.withColumn("error", error)
    return (
        marked.filter(F.col("error").isNull()).drop("error"),
        marked.filter(F.col("error").isNotNull()),
    )
