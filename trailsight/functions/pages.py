"""Field extraction from landed HTML pages with built-in expressions only."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailsight.functions import fixed
from trailsight.functions.text import parse_date


def _col(page: str | Column) -> Column:
    return F.col(page) if isinstance(page, str) else page


def extract(page: str | Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, or NULL."""
    return F.nullif(F.regexp_extract(_col(page), pattern, group), F.lit(""))


def first_match(page: str | Column, patterns: Iterable[str]) -> Column:
    """First pattern of an ordered list that matches; later ones run only when needed."""
    return F.coalesce(*[extract(page, p) for p in patterns])


def one_line(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"(?U)\s+", " "))


def contains_any(page: str | Column, markers: Sequence[str]) -> Column:
    low = F.lower(_col(page))
    hit = F.lit(False)
    for m in markers:
        hit = hit | low.contains(m)
    return F.coalesce(hit, F.lit(False))


def title(page: str) -> Column:
    return F.coalesce(one_line(extract(page, fixed.TITLE_PATTERN)), F.lit(""))


def joined_text(page: str) -> Column:
    return F.nullif(one_line(first_match(page, fixed.JOINED_PATTERNS)), F.lit(""))


def joined_layout(raw: Column) -> Column:
    """The text of a registration date with its commas spaced as the layouts have them."""
    return one_line(F.replace(raw, F.lit(","), F.lit(", ")))


def joined_date(page: str) -> Column:
    """Registration date: the first date layout that fits, month before day."""
    return parse_date(joined_layout(joined_text(page)), fixed.JOINED_FORMATS)


def find_count(page: str) -> Column:
    digits = F.replace(extract(page, fixed.FIND_COUNT_PATTERN), F.lit(","), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0))


def profile_status(url: str, page: str, raw: Column | None = None, day: Column | None = None) -> Column:
    """ok, parse_failed, not_found or login_required, as stored with the user. ``raw`` and ``day`` are
    the text and the date of the registration, where they are at hand already."""
    profile_like = looks_like_profile(page) | F.col(page).contains(fixed.PROFILE_MARKERS[0])
    raw, day = joined_text(page) if raw is None else raw, joined_date(page) if day is None else day
    return (
        F.when(is_login_page(url, page), F.lit("login_required"))
        .when(day.isNotNull(), F.lit("ok"))
        .when(raw.isNotNull(), F.lit("parse_failed"))
        .when(profile_like, F.lit("parse_failed"))
        .otherwise(F.lit("not_found"))
    )


def first_country(page: str) -> Column:
    """Country of the first listed item; 'private' when nothing is listed."""
    html = F.col(page)
    rows = F.transform(
        F.regexp_extract_all(html, F.lit(fixed.ITEM_SPAN_PATTERN), F.lit(1)),
        lambda s: F.transform(
            F.split(F.regexp_replace(s, "<[^>]+>", ""), r"\|"), lambda p: one_line(p)
        ),
    )
    listed = F.filter(
        rows, lambda r: (F.size(r) >= 3) & F.get(r, F.lit(1)).rlike(fixed.ITEM_CODE_PATTERN)
    )
    place = F.get(F.get(listed, F.lit(0)), F.lit(2))
    country = F.trim(F.element_at(F.split(place, ","), -1))
    country = F.when(country.isin(*fixed.US_STATES), F.lit("United States")).otherwise(
        F.nullif(country, F.lit(""))
    )
    low = F.lower(html)
    return (
        F.when(low.contains("does not exist"), F.lit(None).cast("string"))
        .when(low.contains("this content is private"), F.lit("private"))
        .when(F.size(listed) > 0, country)
        .otherwise(F.lit("private"))
    )


def looks_like_profile(page: str) -> Column:
    return F.col(page).rlike(fixed.MEMBER_PATTERN) | F.col(page).contains("UserProfile")


def profile_name(page: str) -> Column:
    return F.coalesce(one_line(extract(page, fixed.MEMBER_PATTERN)), F.lit(""))


def joined_context(page: str) -> Column:
    """Text around the registration date. The windowed patterns back-track over the whole page,
    so they run only where one of their words occurs at all."""
    around = F.when(F.col(page).rlike(fixed.CONTEXT_WORDS), first_match(page, fixed.CONTEXT_PATTERNS))
    return F.coalesce(one_line(around), F.lit(""))


def marker_list(page: str, markers: Sequence[str] = fixed.PROFILE_MARKERS) -> Column:
    found = [F.when(F.col(page).contains(m), F.lit(m)) for m in markers]
    return F.concat_ws(",", *found)


def is_login_url(url: str) -> Column:
    return contains_any(url, fixed.LOGIN_URL_MARKERS)


def is_login_page(url: str, page: str) -> Column:
    return is_login_url(url) | contains_any(page, fixed.LOGIN_PAGE_MARKERS)


def is_public_page(page: str) -> Column:
    """Served without a session: two marks, or a shortened first page of a longer list."""
    html = F.col(page)
    size = extract(page, fixed.PAGE_INFO_PATTERN, 1).try_cast("bigint")
    total = extract(page, fixed.PAGE_INFO_PATTERN, 2).try_cast("bigint")
    compact = F.regexp_replace(html, r"\s+", "")
    return F.coalesce(
        compact.contains('"isAuthenticated":false')
        | html.rlike(fixed.PUBLIC_USER_PATTERN)
        | F.coalesce((size <= 5) & (total > size), F.lit(False)),
        F.lit(False),
    )


def is_archived_page(page: str) -> Column:
    hit = F.lit(False)
    for p in fixed.ARCHIVED_PATTERNS:
        hit = hit | F.col(page).rlike(p)
    return F.coalesce(hit, F.lit(False))


def page_status(http: str, url: str, page: str) -> Column:
    """Item status one landed page proves, or NULL when it proves nothing."""
    readable = (F.col(http) == 200) & F.col(url).contains("geocache") & ~is_login_page(url, page)
    restricted = F.col(page).rlike(fixed.PREMIUM_ONLY_PATTERN)
    return (
        F.when(F.col(http) == 404, F.lit(fixed.STATUS_DELETED))
        .when(readable & ~restricted & is_archived_page(page), F.lit(fixed.STATUS_ARCHIVED))
        .when(readable & ~restricted, F.lit(fixed.STATUS_LIVE))
    )


def owner_guid(page: str) -> Column:
    return extract(page, fixed.OWNER_GUID_PATTERN)


def location(page: str) -> Column:
    """struct(latitude, longitude) from the JSON-LD block, else from script variables.

    A JSON-LD block that is not JSON makes the page unreadable; one without a location does not.
    """
    block = extract(page, fixed.JSON_LD_PATTERN)
    place = F.get_json_object(block, "$.location")
    from_json = F.when(
        place.startswith("{"),
        F.struct(
            F.get_json_object(place, "$.latitude").try_cast("double").alias("latitude"),
            F.get_json_object(place, "$.longitude").try_cast("double").alias("longitude"),
        ),
    )
    lat = extract(page, fixed.JS_POSITION_PATTERN, 1).try_cast("double")
    lon = extract(page, fixed.JS_POSITION_PATTERN, 2).try_cast("double")
    from_script = F.when(
        lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("latitude"), lon.alias("longitude"))
    )
    broken = block.isNotNull() & F.get_json_object(block, "$").isNull()
    return F.when(~broken, F.coalesce(from_json, from_script))


def avatar(page: str) -> Column:
    return F.coalesce(first_match(page, fixed.AVATAR_PATTERNS), F.lit(fixed.DEFAULT_AVATAR))


def avatar_valid(url: str) -> Column:
    return F.coalesce(F.col(url).rlike(fixed.AVATAR_VALID), F.lit(False))


def build_id(page: str, patterns: Sequence[str] = fixed.BUILD_PATTERNS) -> Column:
    """First matching build number without its prefix and quotes."""
    found = F.regexp_replace(F.trim(first_match(page, patterns)), "^[\"']+|[\"']+$", "")
    return F.nullif(F.regexp_replace(found, "^release-", ""), F.lit(""))
