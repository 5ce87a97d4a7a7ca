"""Grids: visit heatmaps and the difficulty/terrain matrix with its top items."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailsight.functions import fixed, scopes
from trailsight.functions.periods import Clock
from trailsight.operators.frames import add_spine, densify, spine


def grid_degree(name: str) -> Column:
    """Round to 0.01 degree as a decimal, half away from zero."""
    return F.round(F.col(name).cast("decimal(12,6)"), 2).cast("double")


def heatmap(
    visits: DataFrame,
    items: DataFrame,
    as_of: date,
    time_range: str,
    regions: Mapping[str, str] = fixed.REGIONS,
) -> DataFrame:
    """Visits per 0.01 degree cell and region, busiest cells first."""
    counts = heat_counts(visits, items, as_of, time_range, regions)
    return counts.orderBy("region", F.desc("count"), "latitude", "longitude")


def heat_counts(
    visits: DataFrame,
    items: DataFrame,
    as_of: date,
    time_range: str,
    regions: Mapping[str, str] = fixed.REGIONS,
) -> DataFrame:
    """The rows of the heatmap in no order.

    Visits are counted per item before they meet the items. No visit type is excluded here.
    """
    when = Clock(as_of).heat("visited", time_range)
    per_item = visits.filter(when).groupBy("gc_code").agg(F.count(F.lit(1)).alias("n"))
    placed = items.filter(
        scopes.ranked() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    ).select(
        F.col("code").alias("gc_code"),
        "country",
        grid_degree("latitude").alias("latitude"),
        grid_degree("longitude").alias("longitude"),
    )
    return (
        per_item.join(placed, "gc_code")
        .withColumn("region", F.explode(scopes.region_keys("country", regions)))
        .groupBy("region", "latitude", "longitude")
        .agg(F.sum("n").alias("count"))
    )


def _rated(items: DataFrame) -> DataFrame:
    return items.filter(scopes.active() & scopes.dt_domain())


def _keyed(items: DataFrame, by: str, regions: Mapping[str, str]) -> DataFrame:
    """Items with the grouping column of a matrix: region, or city name across countries."""
    if by == "region":
        return items.withColumn("region", F.explode(scopes.region_keys("country", regions)))
    return items.withColumn("city", scopes.effective_city())


def dt_counts(
    items: DataFrame, by: str = "region", regions: Mapping[str, str] = fixed.REGIONS
) -> DataFrame:
    """Active items per matrix cell, without empty cells."""
    return (
        _keyed(_rated(items), by, regions)
        .groupBy(by, "difficulty", "terrain")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def dt_top(
    items: DataFrame,
    by: str = "region",
    n: int = fixed.TOP_PER_CELL,
    regions: Mapping[str, str] = fixed.REGIONS,
) -> DataFrame:
    """The n items with most favourite points of every cell."""
    points = F.coalesce("favorite_points", F.lit(0))
    order = Window.partitionBy(by, "difficulty", "terrain").orderBy(
        F.desc("favorite_points"), F.asc("code")
    )
    return (
        _keyed(_rated(items), by, regions)
        .select(
            by,
            "difficulty",
            "terrain",
            "code",
            "name",
            F.coalesce("owner_username", F.lit("")).alias("owner"),
            points.cast("int").alias("favorite_points"),
        )
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= n)
    )


def _index(name: str) -> Column:
    """Position of a rating in the domain, from 0."""
    return (F.array_position(scopes.array_of(fixed.DT_VALUES), F.col(name)) - 1).cast("int")


def dense_matrix(counts: DataFrame, groups: DataFrame, by: str) -> DataFrame:
    """All 81 cells for every group, with their row and column index."""
    full = add_spine(
        add_spine(groups.select(by), "difficulty", fixed.DT_VALUES), "terrain", fixed.DT_VALUES
    )
    return densify(counts, full, [by, "difficulty", "terrain"], ["count"]).select(
        by,
        _index("difficulty").alias("row"),
        _index("terrain").alias("col"),
        "difficulty",
        "terrain",
        "count",
    )


def dt_matrix(items: DataFrame, regions: Mapping[str, str] = fixed.REGIONS) -> DataFrame:
    """Dense matrix for everything and for every published region."""
    groups = spine(items.sparkSession, region=["all", *regions])
    return dense_matrix(dt_counts(items, "region", regions), groups, "region")


def attach_top(matrix: DataFrame, top: DataFrame, by: str) -> DataFrame:
    """Put the (at most n) top items of each cell into one array; NULL for an empty cell."""
    entry = F.struct("place", "code", "name", "owner", "favorite_points")
    lists = top.groupBy(by, "difficulty", "terrain").agg(
        F.array_sort(F.collect_list(entry)).alias("_top")
    )
    without_place = F.transform(
        "_top",
        lambda t: F.struct(
            t["code"].alias("code"),
            t["name"].alias("name"),
            t["owner"].alias("owner"),
            t["favorite_points"].alias("favorite_points"),
        ),
    )
    return matrix.join(lists, [by, "difficulty", "terrain"], "left").select(
        *matrix.columns, without_place.alias("top_caches")
    )


