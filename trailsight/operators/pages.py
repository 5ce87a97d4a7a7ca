"""Landed pages to rows: page classes, profile fields and item status by evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailsight.functions import fixed, pages
from trailsight.functions.text import parse_date


def page_classes(landed: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    return landed.withColumns(
        {
            "login_page": pages.is_login_page(url, page),
            "public_page": pages.is_public_page(page),
            "archived_page": pages.is_archived_page(page),
        }
    )


def page_summary(landed: DataFrame, page: str = "html") -> DataFrame:
    return landed.withColumns(
        {
            "title": pages.title(page),
            "profile_name": pages.profile_name(page),
            "joined_context": pages.joined_context(page),
            "markers": pages.marker_list(page),
            "looks_like_profile": pages.looks_like_profile(page),
        }
    ).drop(page)


def profile_fields(landed: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Registration date, its raw text, find count, picture and fetch status per profile page.

    The text, its cleaned form and the date are columns of steps of their own, each worked out once.
    """
    raw, day = F.col("_raw"), F.col("_day")
    read = (
        landed.withColumn("_raw", pages.joined_text(page))
        .withColumn("_clean", pages.joined_layout(raw))
        .withColumn("_day", parse_date(F.col("_clean"), fixed.JOINED_FORMATS))
    )
    return read.withColumns(
        {
            "registration_date": day,
            "raw_date": raw,
            "find_count": pages.find_count(page),
            "avatar_url": pages.avatar(page),
            "fetch_status": pages.profile_status(url, page, raw, day),
        }
    ).drop(page, "_raw", "_clean", "_day")


def item_page_fields(landed: DataFrame, page: str = "html") -> DataFrame:
    """Position and owner id of item detail pages; rows without a position are left out."""
    found = F.filter(
        F.array(pages.location(page)),
        lambda at: at["latitude"].isNotNull() & at["longitude"].isNotNull(),
    )
    rest = [c for c in landed.columns if c != page]
    return landed.select(*rest, F.inline(found), pages.owner_guid(page).alias("owner_guid"))


def resolve_status(
    landed: DataFrame, http: str = "http_status", url: str = "url", page: str = "html"
) -> DataFrame:
    """(code, status) from all landed pages of an item, each read as ``reader`` premium or not.

    Any archived page settles it; otherwise the last premium reading counts, then the last other
    one. NULL when no page proved anything. ``attempt`` orders the readings.
    """
    seen = landed.select("code", "reader", "attempt", pages.page_status(http, url, page).alias("s"))
    proven = F.col("s").isNotNull()

    def last_of(reader: str):
        return F.max_by("s", F.when(proven & (F.col("reader") == reader), F.col("attempt")))

    return seen.groupBy("code").agg(
        F.coalesce(
            F.max(F.when(F.col("s") == fixed.STATUS_ARCHIVED, F.col("s"))),
            last_of("premium"),
            last_of("nonpremium"),
        ).alias("status")
    )


def status_changes(items: DataFrame, resolved: DataFrame) -> DataFrame:
    """Codes whose proven status differs from the stored one; deleted items are not reopened.

    A live page only corrects a wrong archived or deleted mark.
    """
    old, new = F.col("cache_status"), F.col("status")
    known_deleted = F.coalesce(old == fixed.STATUS_DELETED, F.lit(False))
    gone = new.isin(fixed.STATUS_ARCHIVED, fixed.STATUS_DELETED) & ~new.eqNullSafe(old)
    back = (new == fixed.STATUS_LIVE) & F.coalesce(
        old.isin(fixed.STATUS_ARCHIVED, fixed.STATUS_DELETED), F.lit(False)
    )
    return (
        items.select("code", "cache_status")
        .join(resolved.filter(F.col("status").isNotNull()), "code")
        .filter(~known_deleted & (gone | back))
        .select("code", "status")
    )
