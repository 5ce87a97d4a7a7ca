"""Row predicates over the item and visit tables, as Columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailsight.functions import fixed


def quoted(value: str) -> str:
    """A string literal for an SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values: Iterable) -> str:
    """Comma-separated literals for an SQL expression."""
    return ", ".join(quoted(v) if isinstance(v, str) else repr(v) for v in values)


def array_of(values: Iterable) -> Column:
    """Array literal; doubles stay doubles."""
    parts = [quoted(v) if isinstance(v, str) else f"{v!r}D" if isinstance(v, float) else repr(v) for v in values]
    return F.expr(f"array({', '.join(parts)})")


_EVENTS = listed(fixed.EVENT_TYPES)


def not_deleted(status: str = "cache_status") -> Column:
    """A NULL status counts as live."""
    return F.expr(f"coalesce({status}, {fixed.STATUS_LIVE}) != {fixed.STATUS_DELETED}")


def ranked(status: str = "cache_status", kind: str = "geocache_type") -> Column:
    """Everything that counts in statistics, archived items included.

    A NULL type is neither an event nor a non-event, so it drops out.
    """
    return F.expr(
        f"coalesce({status}, {fixed.STATUS_LIVE}) != {fixed.STATUS_DELETED} AND {kind} NOT IN ({_EVENTS})"
    )


def active(status: str = "cache_status", kind: str = "geocache_type") -> Column:
    gone = listed((fixed.STATUS_ARCHIVED, fixed.STATUS_DELETED))
    return F.expr(
        f"coalesce({status}, {fixed.STATUS_LIVE}) NOT IN ({gone}) AND {kind} NOT IN ({_EVENTS})"
    )


def event(status: str = "cache_status", kind: str = "geocache_type") -> Column:
    return F.expr(
        f"coalesce({status}, {fixed.STATUS_LIVE}) != {fixed.STATUS_DELETED} AND {kind} IN ({_EVENTS})"
    )


def filled(name: str) -> Column:
    return F.expr(f"{name} IS NOT NULL AND {name} != ''")


def owner_valid(name: str = "owner_username") -> Column:
    return F.expr(f"{name} IS NOT NULL AND {name} NOT IN ('', {quoted(fixed.DELETED_OWNER)})")


def item_entry_valid() -> Column:
    return filled("code") & filled("name") & filled("owner_username") & not_deleted()


def visit_valid(kind: str = "log_type") -> Column:
    """NULL types drop out as well: the comparison is not true for them."""
    return F.expr(f"{kind} != {quoted(fixed.DELETED_VISIT)}")


def effective_city(city: str = "city", country: str = "country") -> Column:
    return F.expr(f"coalesce(nullif(trim({city}), ''), {country})")


def trend_live(status: str = "cache_status") -> Column:
    """Trend counters use the bare status: NULL is neither live nor archived."""
    return F.col(status) != fixed.STATUS_ARCHIVED


def trend_archived(status: str = "cache_status") -> Column:
    return F.col(status) == fixed.STATUS_ARCHIVED


def dt_domain() -> Column:
    values = ", ".join(f"{v!r}D" for v in fixed.DT_VALUES)
    return F.expr(f"difficulty IN ({values}) AND terrain IN ({values})")


def region_keys(country: str, regions: Mapping[str, str]) -> Column:
    """Array of the regions a row counts in: always ``all``, plus its own if published."""
    if not regions:
        return F.expr("array('all')")
    arms = " ".join(
        f"WHEN {quoted(name)} THEN array('all', {quoted(key)})" for key, name in regions.items()
    )
    return F.expr(f"CASE {country} {arms} ELSE array('all') END")


def own_region(country: str, regions: Mapping[str, str]) -> Column:
    """The published region of a row, NULL if it has none."""
    if not regions:
        return F.lit(None).cast("string")
    arms = " ".join(f"WHEN {quoted(name)} THEN {quoted(key)}" for key, name in regions.items())
    return F.expr(f"CASE {country} {arms} END")


def type_keys(kind: str = "geocache_type") -> Column:
    """Array of the item-type filters a row passes: ``all`` plus its own filter, if any."""
    arms = " ".join(f"WHEN {v} THEN array('all', {quoted(k)})" for k, v in fixed.TYPE_KEYS.items())
    return F.expr(f"CASE {kind} {arms} ELSE array('all') END")


def own_type(kind: str = "geocache_type") -> Column:
    """The item-type filter a row passes, NULL if none."""
    arms = " ".join(f"WHEN {v} THEN {quoted(k)}" for k, v in fixed.TYPE_KEYS.items())
    return F.expr(f"CASE {kind} {arms} END")


def type_label(kind: str = "geocache_type") -> Column:
    arms = " ".join(f"WHEN {v} THEN {quoted(label)}" for v, label in fixed.TYPE_LABELS.items())
    return F.expr(
        f"CASE WHEN {kind} IS NULL THEN 'Unknown' ELSE CASE {kind} {arms} "
        f"ELSE concat('Type ', CAST({kind} AS STRING)) END END"
    )


def city_subtitle(
    city: str,
    country: str,
    province: Column,
    subtitles: Mapping[str, str] = fixed.COUNTRY_SUBTITLES,
    home: str = "China",
) -> Column:
    """Caption of a city row; ``province`` is the joined province of the city, or NULL."""
    col = F.col(country)
    out = F.when(col == home, F.coalesce(province, F.lit(subtitles[home])))
    for name, caption in subtitles.items():
        if name != home:
            out = out.when(col.isin(name, caption), F.lit(caption))
    out = out.when(col.isNotNull() & ~col.isin("", "None"), col)
    return out.otherwise(F.coalesce(province, F.lit("")))


def in_any_box(lat: str, lon: str, boxes: Sequence[Sequence[float]]) -> Column:
    """Inside one of the (max_lat, min_lon, min_lat, max_lon) boxes; without boxes everywhere."""
    hit = F.lit(not boxes)
    for max_lat, min_lon, min_lat, max_lon in boxes:
        hit = hit | (F.col(lat).between(min_lat, max_lat) & F.col(lon).between(min_lon, max_lon))
    return hit


def passes_box(
    lat: str, lon: str, premium: str, boxes: Sequence[Sequence[float]]
) -> Column:
    """Box filter for incoming items: premium rows carry no position and pass untested."""
    placed = (F.coalesce(F.col(lat), F.lit(0.0)) != 0) & (F.coalesce(F.col(lon), F.lit(0.0)) != 0)
    return F.coalesce(F.col(premium), F.lit(False)) | (placed & in_any_box(lat, lon, boxes))


def accepted_visit_type(kind: str = "geocache_type", log_type: str = "log_type") -> Column:
    """Events collect 'Attended', everything else 'Found it'."""
    wanted = F.when(F.col(kind).isin(*fixed.EVENT_TYPES), F.lit(fixed.ATTENDED)).otherwise(
        F.lit(fixed.FOUND)
    )
    return F.col(log_type) == wanted


def needs_refresh(
    crawled: str = "logs_crawled_at", found: str = "last_found_date", placed: str = "placed_date"
) -> Column:
    """Never crawled, found since, or found no later than placed with a real date."""
    found_day, placed_day, crawled_day = (F.to_date(F.col(c)) for c in (found, placed, crawled))
    odd = (found_day <= placed_day) & (F.year(found_day) > 1)
    return F.coalesce(
        crawled_day.isNull() | (found_day >= crawled_day) | odd, F.lit(False)
    )
