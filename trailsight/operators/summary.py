"""Scope metrics, counts per region, community figures and small tallies."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailsight.functions import fixed, scopes
from trailsight.functions.periods import Clock, growth_pct, share_pct
from trailsight.operators.frames import spine


def _region_spine(frame: DataFrame, regions: Mapping[str, str]) -> DataFrame:
    return spine(frame.sparkSession, region=["all", *regions])


def scope_metrics(
    visits: DataFrame, items: DataFrame, regions: Mapping[str, str] = fixed.REGIONS
) -> DataFrame:
    """Items, distinct owners, distinct finders and visits per region, in one row each.

    Distinct people are counted by grouping on (region, name) first, so a region is never one
    reducer's ``count(distinct)``.
    """
    keys = scopes.region_keys("country", regions)
    scoped = items.filter(scopes.ranked())
    owners = (
        scoped.select(F.explode(keys).alias("region"), "owner_username")
        .groupBy("region", "owner_username")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("region")
        .agg(
            F.sum("n").alias("total_caches"),
            F.count_if(scopes.filled("owner_username")).alias("total_owners"),
        )
    )
    finders = (
        visits.filter(scopes.visit_valid())
        .groupBy("gc_code", "user_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(scoped.select(F.col("code").alias("gc_code"), "country"), "gc_code")
        .select(F.explode(keys).alias("region"), "user_name", "n")
        .groupBy("region", "user_name")
        .agg(F.sum("n").alias("n"))
        .groupBy("region")
        .agg(
            F.count_if(scopes.filled("user_name")).alias("total_finders"),
            F.sum("n").alias("total_logs"),
        )
    )
    columns = ("total_caches", "total_owners", "total_finders", "total_logs")
    return (
        _region_spine(items, regions)
        .join(owners, "region", "left")
        .join(finders, "region", "left")
        .select("region", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in columns])
    )


def active_counts(items: DataFrame, regions: Mapping[str, str] = fixed.REGIONS) -> DataFrame:
    counted = (
        items.filter(scopes.active())
        .select(F.explode(scopes.region_keys("country", regions)).alias("region"))
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        _region_spine(items, regions)
        .join(counted, "region", "left")
        .select("region", F.coalesce("n", F.lit(0)).cast("bigint").alias("active_items"))
    )


def region_shares(items: DataFrame, regions: Mapping[str, str] = fixed.REGIONS) -> DataFrame:
    """Active items per published region and their share of all published regions together."""
    counts = active_counts(items, regions).filter(F.col("region") != "all")
    total = counts.agg(F.sum("active_items").alias("_total"))
    return counts.withColumn("_total", total.scalar()).select(
        "region",
        F.col("active_items").alias("total_caches"),
        share_pct(F.col("active_items"), F.col("_total")).alias("percentage"),
    )


def community_stats(visits: DataFrame, items: DataFrame, as_of: date) -> DataFrame:
    """Active people of the last 30 days and their growth, items, and share of items found.

    The activity part scans 60 days of visits only; the coverage part needs the item code alone.
    """
    clock = Clock(as_of)
    scoped = items.filter(scopes.ranked()).select(F.col("code").alias("gc_code"))
    valid = visits.filter(scopes.visit_valid())
    recent = clock.days_back(60)
    active = (
        valid.filter(F.col("visited") >= F.lit(recent))
        .groupBy("gc_code", "user_name")
        .agg(
            F.bool_or(clock.within("visited", "30d")).alias("now"),
            F.bool_or(clock.within("visited", "30d", True)).alias("before"),
        )
        .join(scoped, "gc_code", "left_semi")
        .filter(F.col("user_name").isNotNull())
        .groupBy("user_name")
        .agg(F.bool_or("now").alias("now"), F.bool_or("before").alias("before"))
        .agg(F.count_if("now").alias("now"), F.count_if("before").alias("before"))
    )
    found = (
        scoped.join(valid.select("gc_code").distinct(), "gc_code", "left_semi")
        .agg(F.count(F.lit(1)).alias("found"))
    )
    total = scoped.agg(F.count(F.lit(1)).alias("total"))
    return active.select(
        F.col("now").alias("active_players"),
        growth_pct(F.col("now"), F.col("before"), 0.0).alias("active_players_growth_pct"),
        total.scalar().alias("total_caches"),
        share_pct(found.scalar(), total.scalar()).alias("found_cache_coverage_pct"),
    )


def unassigned_diagnostic(items: DataFrame) -> DataFrame:
    """Items without a city per country, split by whether they have a position."""
    no_position = F.col("longitude").isNull() | F.col("latitude").isNull()
    blank = F.coalesce(F.trim("city"), F.lit("")) == ""
    return (
        items.filter(blank)
        .groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(no_position).alias("missing_coords"),
            F.count_if(~no_position).alias("has_coords"),
        )
        .orderBy(F.desc("total"), "country")
    )


def missing_positions(items: DataFrame, countries=fixed.ALLOWED_COUNTRIES) -> DataFrame:
    """Codes of items in the given countries that lack a coordinate."""
    return items.filter(
        (F.col("latitude").isNull() | F.col("longitude").isNull())
        & F.col("country").isin(*countries)
    ).select("code")


def completeness_check(received: DataFrame, declared: DataFrame, cap: int = fixed.PAGE_CAP) -> DataFrame:
    """Rows received per box against the total the source declared for it.

    The comparison is always made. ``over_cap`` says that the box holds more than the source pages
    out, so that rows must be missing until the box is split.
    """
    counted = received.groupBy("box").agg(F.count(F.lit(1)).alias("received"))
    joined = declared.join(counted, "box", "left").select(
        "box",
        F.coalesce("received", F.lit(0)).cast("bigint").alias("received"),
        F.col("declared").cast("bigint").alias("declared"),
    )
    status = (
        F.when(F.col("received") == F.col("declared"), F.lit("complete"))
        .when(F.col("received") == 0, F.lit("empty"))
        .otherwise(F.lit("mismatch"))
    )
    return joined.select(
        "*",
        (F.col("declared") - F.col("received")).alias("missing"),
        (F.col("declared") > cap).alias("over_cap"),
        status.alias("status"),
    )


def request_digest(requests: DataFrame, request_items: DataFrame) -> DataFrame:
    """Requests not yet announced, the number of items each covers, and their text block."""
    counts = request_items.groupBy(F.col("request_id").alias("id")).agg(
        F.count("item_id").alias("item_count")
    )
    proposed = F.when(
        scopes.filled("proposed_series"),
        F.concat(
            F.lit("  提议:   "), "proposed_series", F.lit(" ("),
            F.coalesce("proposed_city", F.lit("None")), F.lit(")"),
        ),
    )
    note = F.when(scopes.filled("note"), F.concat(F.lit("  备注:   "), "note"))
    body = F.concat_ws(
        "\n",
        F.concat(F.lit("--- 请求 #"), F.col("id").cast("string"), F.lit(" ---")),
        F.concat(F.lit("  提交者: "), "actor"),
        F.concat(F.lit("  状态:   "), "status"),
        F.concat(F.lit("  目标:   "), "target_series", F.lit(" ("), "target_city", F.lit(")")),
        proposed,
        note,
        F.concat(F.lit("  涉及:   "), F.col("item_count").cast("string"), F.lit(" 个缓存")),
    )
    return (
        requests.filter(~F.col("notified"))
        .join(counts, "id", "left")
        .withColumn("item_count", F.coalesce("item_count", F.lit(0)).cast("bigint"))
        .withColumn("body", body)
        .select("id", "status", "actor", "item_count", "body")
        .orderBy("id")
    )
