"""Gap-filled counts by year and month, for regions, cities and everything."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailsight.functions import fixed, scopes
from trailsight.functions.periods import Clock, compound_growth_pct
from trailsight.operators.frames import add_spine, densify, spine

_COUNTS = ("count", "archived")


def _status_counts() -> list[Column]:
    return [
        F.count_if(scopes.trend_live()).alias("count"),
        F.count_if(scopes.trend_archived()).alias("archived"),
    ]


def yearly_trend(
    items: DataFrame, as_of: date, regions: Mapping[str, str] = fixed.REGIONS
) -> DataFrame:
    """Items placed per year: live, placed by this day of that year, and archived.

    Every region starts in the first year found anywhere. The same-day mark counts days from
    1 January, so it moves by one in leap years.
    """
    offset = (as_of - Clock(as_of).year_start).days
    dated = items.filter(scopes.ranked() & F.col("placed_date").isNotNull()).withColumn(
        "year", F.year("placed_date")
    )
    by_mark = F.date_add(F.trunc("placed_date", "year"), offset)
    counts = (
        dated.withColumn("region", F.explode(scopes.region_keys("country", regions)))
        .groupBy("region", "year")
        .agg(
            F.count_if(scopes.trend_live()).alias("total"),
            F.count_if(F.col("placed_date") <= by_mark).alias("ytd_cache"),
            F.count_if(scopes.trend_archived()).alias("archived"),
        )
    )
    this_year = F.lit(as_of.year)
    years = dated.agg(F.coalesce(F.min("year"), this_year).alias("first")).select(
        F.explode(
            # An ascending sequence only: a first year in the future leaves no rows.
            F.when(F.col("first") <= this_year, F.sequence("first", this_year)).otherwise(
                F.array().cast("array<int>")
            )
        ).alias("year")
    )
    full = add_spine(years, "region", ["all", *regions]).select("region", "year")
    return densify(counts, full, ["region", "year"], ["total", "ytd_cache", "archived"]).select(
        "region", F.col("year").cast("string").alias("year"), "total", "ytd_cache", "archived"
    )


def _scoped(items: DataFrame, city: str | None) -> DataFrame:
    scoped = items.filter(scopes.ranked())
    return scoped if city is None else scoped.filter(scopes.effective_city() == city)


def monthly_trend(items: DataFrame, as_of: date, city: str | None = None) -> DataFrame:
    """The last ten months including this one; optionally of a single city."""
    clock = Clock(as_of)
    counts = (
        _scoped(items, city)
        .filter(F.col("placed_date") >= F.lit(clock.month_floor()))
        .groupBy(F.date_format("placed_date", "yyyy-MM").alias("label"))
        .agg(*_status_counts())
    )
    full = spine(items.sparkSession, label=clock.month_labels())
    return densify(counts, full, ["label"], _COUNTS)


def yearly10_trend(items: DataFrame, as_of: date, city: str | None = None) -> DataFrame:
    """The last ten years including this one; optionally of a single city."""
    clock = Clock(as_of)
    years = clock.years()
    counts = (
        _scoped(items, city)
        .filter(F.col("placed_date") >= F.lit(date(years[0], 1, 1)))
        .groupBy(F.year("placed_date").cast("string").alias("label"))
        .agg(*_status_counts())
    )
    full = spine(items.sparkSession, label=[str(y) for y in years])
    return densify(counts, full, ["label"], _COUNTS)


def year_total(as_of: date, end: int) -> Column:
    """Aggregate: live and archived items of the first (0) or last (-1) of the ten years."""
    year = Clock(as_of).years()[end]
    return F.expr(f"coalesce(sum(CASE WHEN label = '{year}' THEN `count` + archived END), 0)")


def growth_between(first: Column, last: Column) -> Column:
    return compound_growth_pct(first, last, 9)


def average_growth(yearly: DataFrame, as_of: date, keys: tuple[str, ...] = ()) -> DataFrame:
    """Compound growth between the first and the last of the ten years."""
    growth = growth_between(year_total(as_of, 0), year_total(as_of, -1))
    return yearly.groupBy(*keys).agg(growth.alias("average_growth_pct"))


def cities(items: DataFrame) -> DataFrame:
    """All city names in scope."""
    return (
        items.filter(scopes.ranked())
        .select(scopes.effective_city().alias("city"))
        .filter("city IS NOT NULL")
        .distinct()
    )


def city_monthly(items: DataFrame, as_of: date) -> DataFrame:
    """Ten months for every city in scope, months without items included."""
    clock = Clock(as_of)
    counts = (
        items.filter(scopes.ranked() & (F.col("placed_date") >= F.lit(clock.month_floor())))
        .groupBy(
            scopes.effective_city().alias("city"),
            F.date_format("placed_date", "yyyy-MM").alias("label"),
        )
        .agg(*_status_counts())
    )
    full = add_spine(cities(items), "label", clock.month_labels())
    return densify(counts, full, ["city", "label"], _COUNTS)


def city_yearly(items: DataFrame, as_of: date) -> DataFrame:
    """Ten years for every city in scope, years without items included."""
    years = Clock(as_of).years()
    counts = (
        items.filter(scopes.ranked() & (F.col("placed_date") >= F.lit(date(years[0], 1, 1))))
        .groupBy(
            scopes.effective_city().alias("city"),
            F.year("placed_date").cast("string").alias("label"),
        )
        .agg(*_status_counts())
    )
    full = add_spine(cities(items), "label", [str(y) for y in years])
    return densify(counts, full, ["city", "label"], _COUNTS)


def city_growth(items: DataFrame, as_of: date) -> DataFrame:
    return average_growth(city_yearly(items, as_of), as_of, ("city",))
