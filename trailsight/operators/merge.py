"""Keyed merges of small change sets into stored tables, and schema evolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailsight.functions import fixed, scopes, text
from trailsight.functions.pages import avatar_valid


def last_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last record of every key within a batch."""
    rest = [c for c in rows.columns if c != key]
    return (
        rows.groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
        .select(*rows.columns)
    )


def merge_users(incoming: DataFrame, stored: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Users by name: a stored guid stays, a new date or place wins, the status is replaced.

    ``order`` says which record of a name is the last; without it names have to be unique.
    """
    if order:
        incoming = last_per_key(incoming, "user_name", order)
    new, old = incoming.alias("new"), stored.alias("old")
    return new.join(old, F.col("new.user_name") == F.col("old.user_name"), "full_outer").select(
        F.coalesce("new.user_name", "old.user_name").alias("user_name"),
        F.coalesce("old.guid", "new.guid").alias("guid"),
        F.coalesce("new.registration_date", "old.registration_date").alias("registration_date"),
        F.when(F.col("new.user_name").isNotNull(), F.col("new.fetch_status"))
        .otherwise(F.col("old.fetch_status"))
        .alias("fetch_status"),
        F.coalesce("new.reg_place", "old.reg_place").alias("reg_place"),
    )


def merge_avatars(
    incoming: DataFrame, stored: DataFrame, checked_at: Column, order: Sequence[str] = ()
) -> DataFrame:
    """Avatars by name: only valid real pictures and explicit defaults are taken, and stamped.

    ``order`` says which record of a name is the last; without it names have to be unique.
    """
    real = (F.col("avatar_status") == "real") & avatar_valid("avatar_url")
    default = F.col("avatar_status") == "default"
    taken = incoming.filter(real | default)
    if order:
        taken = last_per_key(taken, "user_name", order)
    taken = taken.select(
        "user_name",
        F.when(real, F.col("avatar_url")).otherwise(F.lit(fixed.DEFAULT_AVATAR)).alias("avatar_url"),
        "avatar_status",
    )
    new, old = taken.alias("new"), stored.alias("old")
    here = F.col("new.user_name").isNotNull()
    return new.join(old, F.col("new.user_name") == F.col("old.user_name"), "full_outer").select(
        F.coalesce("new.user_name", "old.user_name").alias("user_name"),
        F.when(here, F.col("new.avatar_url")).otherwise(F.col("old.avatar_url")).alias("avatar_url"),
        F.when(here, F.col("new.avatar_status")).otherwise(F.col("old.avatar_status")).alias("avatar_status"),
        F.when(here, checked_at).otherwise(F.col("old.checked_at")).alias("checked_at"),
    )


def resolve_avatars(names: DataFrame, avatars: DataFrame) -> DataFrame:
    """State and picture of each wanted name: real, default or uncached."""
    joined = names.select("user_name").distinct().join(avatars, "user_name", "left")
    status = F.coalesce("avatar_status", F.lit("real"))
    state = (
        F.when((status == "real") & avatar_valid("avatar_url"), F.lit("real"))
        .when(status == "default", F.lit("default"))
        .otherwise(F.lit("uncached"))
    )
    return joined.select("user_name", state.alias("state"), "avatar_url").select(
        "user_name",
        "state",
        F.when(F.col("state") == "real", F.col("avatar_url"))
        .otherwise(F.lit(fixed.DEFAULT_AVATAR))
        .alias("avatar_url"),
    )


def pictures(avatars: DataFrame) -> DataFrame:
    """(user_name, avatar_url) of everyone with a valid real picture."""
    real = (F.coalesce("avatar_status", F.lit("real")) == "real") & avatar_valid("avatar_url")
    return avatars.filter(real).select("user_name", "avatar_url")


def avatar_tally(resolved: DataFrame) -> DataFrame:
    return resolved.agg(
        F.count_if(F.col("state") == "real").alias("real_cached"),
        F.count_if(F.col("state") == "default").alias("default_cached"),
        F.count_if(F.col("state") == "uncached").alias("uncached"),
        F.count(F.lit(1)).alias("total"),
    )


def keyed_update(table: DataFrame, keys: DataFrame, key: str, values: Mapping[str, Column]) -> DataFrame:
    """Set columns to fixed values on the rows whose key is listed."""
    marks = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = table.join(marks, key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    return joined.select(
        *[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in table.columns]
    )


def backfill_fields(
    items: DataFrame, found: DataFrame, guid_only_when_null: bool = False, order: Sequence[str] = ()
) -> DataFrame:
    """Positions read from landed pages, to six places, and owner ids where one was found.

    ``order`` says which record of a code is the last; without it codes have to be unique.
    """
    if order:
        found = last_per_key(found, "code", order)
    facts = found.select(
        "code",
        text.rounded("latitude", 6).alias("_lat"),
        text.rounded("longitude", 6).alias("_lon"),
        F.nullif("owner_guid", F.lit("")).alias("_guid"),
    )
    guid = (
        F.coalesce("owner_guid", "_guid") if guid_only_when_null else F.coalesce("_guid", "owner_guid")
    )
    replaced = {
        "latitude": F.coalesce("_lat", "latitude"),
        "longitude": F.coalesce("_lon", "longitude"),
        "owner_guid": guid,
    }
    return items.join(facts, "code", "left").select(
        *[replaced[c].alias(c) if c in replaced else F.col(c) for c in items.columns]
    )


def evolve(table: DataFrame, additions: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add the columns a table lacks, with a type and a default; existing ones stay."""
    for name, (kind, default) in additions.items():
        if name not in table.columns:
            table = table.withColumn(name, F.lit(default).cast(kind))
    return table


def union_evolved(old: DataFrame, new: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Rows of two generations of a table; columns one lacks take the default or NULL."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.fillna({k: v for k, v in defaults.items() if v is not None})


def page_scan(items: DataFrame, offset: int, size: int) -> DataFrame:
    """One page of the items in code order."""
    return items.orderBy("code").offset(offset).limit(size)


def refresh_candidates(items: DataFrame) -> DataFrame:
    """Live items whose visits are worth reading again."""
    live = ~F.coalesce("cache_status", F.lit(0)).isin(fixed.STATUS_ARCHIVED, fixed.STATUS_DELETED)
    return items.filter(live & scopes.needs_refresh()).select(
        "code",
        "latitude",
        "longitude",
        F.coalesce("premium_only", F.lit(False)).alias("premium_only"),
        "geocache_type",
    )


def archived_after(
    items: DataFrame,
    start_after: str | None = None,
    limit: int | None = None,
    only_uncrawled: bool = False,
) -> DataFrame:
    """Archived items in code order behind a given code (keyset continuation)."""
    rows = items.filter(F.col("cache_status") == fixed.STATUS_ARCHIVED)
    if only_uncrawled:
        rows = rows.filter(F.col("logs_crawled_at").isNull())
    if start_after:
        rows = rows.filter(F.col("code") > start_after.upper())
    rows = rows.orderBy("code")
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(
        "code", "latitude", "longitude", F.coalesce("premium_only", F.lit(False)).alias("premium_only")
    )


def split_work(items: DataFrame, completed: DataFrame | None, only: str = "all") -> DataFrame:
    """Work not yet done, labelled premium or nonpremium."""
    if only not in ("all", "premium", "nonpremium"):
        raise ValueError(f"unknown group: {only}")
    left = items if completed is None else items.join(completed.select("code"), "code", "left_anti")
    group = F.when(F.coalesce("premium_only", F.lit(False)), F.lit("premium")).otherwise(
        F.lit("nonpremium")
    )
    work = left.withColumn("work_group", group)
    return work if only == "all" else work.filter(F.col("work_group") == only)


def status_lookup(items: DataFrame, codes: DataFrame) -> DataFrame:
    # Distinct first: a code listed very often must not pile up on one side of the join.
    wanted = codes.select("code").distinct()
    return items.join(wanted, "code", "left_semi").select("code", "cache_status")
