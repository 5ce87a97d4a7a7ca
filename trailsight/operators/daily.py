"""Distinct people kept up to date day by day, as mergeable bitmaps.

A person has a dense number, given once. The state of a day holds, for each region, bitmaps of the
people who were there and the number of visits. States of any days merge with OR, so the distinct
people of any span of days come from the states alone, and a new day reads only its own visits.

States lie in folders by month. ``refresh`` makes the days it is given anew from their visits, and
rewrites their months with the other days' states as they are; doing it again changes nothing. A day has to be refreshed when visits to it arrive late, or when an item visited on
it changes its country or leaves the statistics (``days_of_items``).

A bitmap covers 32,768 numbers, and rows exist only for the stretches of numbers that occur, so no
row grows with the number of people.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailsight.functions import fixed, scopes
from trailsight.functions.periods import Clock, growth_pct
from trailsight.operators.frames import spine
from trailsight.sources.tables import exists, materialise

#: Folders that names are numbered in; each is sorted by itself.
PARTS = 64
PEOPLE = "name string, person_id bigint"
STATES = "visited date, region string, bucket bigint, people binary, visits bigint, unnamed boolean, month int"


def _folder(root: str, name: str) -> str:
    return f"{root}/{name}"


def people(spark: SparkSession, root: str) -> DataFrame:
    """(name, person_id) of everyone numbered so far."""
    path = _folder(root, "people")
    return spark.read.schema(PEOPLE).parquet(path) if exists(spark, path) else spark.createDataFrame([], PEOPLE)


def states(spark: SparkSession, root: str) -> DataFrame:
    """(visited, region, bucket, people, visits, unnamed, month) of every day taken in so far."""
    path = _folder(root, "months")
    return spark.read.schema(STATES).parquet(path) if exists(spark, path) else spark.createDataFrame([], STATES)


def numbered(names: DataFrame, known: DataFrame) -> DataFrame:
    """(name, person_id) of the names that are not known yet, numbered on from the known ones.

    Names are dealt into PARTS by hash and numbered within each part, behind the parts before it, so
    the numbers are dense, from 1 as bitmaps count, and no task sorts all names.
    """
    fresh = (
        names.filter(scopes.filled("name"))
        .select("name")
        .distinct()
        .join(known.select("name"), "name", "left_anti")
        .withColumn("_part", F.pmod(F.xxhash64("name"), F.lit(PARTS)))
    )
    sizes = fresh.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.selectExpr(
        "_part", "sum(_size) OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - _size AS _before"
    )
    first = known.agg(F.coalesce(F.max("person_id") + 1, F.lit(1)).alias("_first"))
    return (
        fresh.selectExpr("name", "_part", "row_number() OVER (PARTITION BY _part ORDER BY name) - 1 AS _n")
        .join(before, "_part")
        .select("name", (F.col("_before") + F.col("_n") + first.scalar()).cast("bigint").alias("person_id"))
    )


def day_states(
    visits: DataFrame, items: DataFrame, numbers: DataFrame, regions: Mapping[str, str] = fixed.REGIONS
) -> DataFrame:
    """The states of the days of the given visits.

    People are made into bitmaps by day and country first; only those few rows are repeated for the
    regions that a country counts in.
    """
    scoped = items.filter(scopes.ranked()).select(F.col("code").alias("gc_code"), "country")
    met = (
        visits.filter(scopes.visit_valid())
        .groupBy("visited", "gc_code", "user_name")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(scoped, "gc_code")
        .groupBy("visited", "country", F.col("user_name").alias("name"))
        .agg(F.sum("n").alias("n"))
        .join(numbers, "name", "left")
    )
    known = F.col("person_id").isNotNull()
    by_country = met.groupBy(
        "visited", "country", F.when(known, F.expr("bitmap_bucket_number(person_id)")).otherwise(F.lit(0)).alias("bucket")
    ).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(person_id)) FILTER (WHERE person_id IS NOT NULL)").alias("people"),
        F.sum("n").alias("visits"),
        F.coalesce(F.bool_or(F.col("name") == ""), F.lit(False)).alias("unnamed"),
    )
    return (
        by_country.withColumn("region", F.explode(scopes.region_keys("country", regions)))
        .groupBy("visited", "region", "bucket")
        .agg(F.expr("bitmap_or_agg(people)").alias("people"), F.sum("visits").alias("visits"), F.bool_or("unnamed").alias("unnamed"))
        .select("visited", "region", "bucket", "people", "visits", "unnamed", _month().alias("month"))
    )


def _month() -> Column:
    return F.year("visited") * 100 + F.month("visited")


def _in_days(first: date | None, end: date | None) -> Column:
    if first is None and end is None:
        return F.lit(True)
    days = F.col("visited")
    low = F.lit(True) if first is None else days >= F.lit(first)
    return low if end is None else low & (days < F.lit(end))


def refresh(
    spark: SparkSession,
    root: str,
    visits: DataFrame,
    items: DataFrame,
    first: date | None = None,
    end: date | None = None,
    regions: Mapping[str, str] = fixed.REGIONS,
) -> None:
    """Make the states of the days from ``first`` to before ``end`` anew; without bounds of all days.

    Visits without a day are taken in only when there are no bounds.
    """
    rows = visits.filter(_in_days(first, end))
    numbers = people(spark, root)
    fresh = numbered(rows.filter(scopes.visit_valid()).select(F.col("user_name").alias("name")), numbers)
    fresh.write.mode("append").parquet(_folder(root, "people"))
    made = day_states(rows, items, people(spark, root), regions)
    every = first is None and end is None
    if not every:
        made = materialise(_with_rest(made, states(spark, root), first, end), "months")
    writer = made.repartition("month", "region").write.mode("overwrite").partitionBy("month")
    writer.option("partitionOverwriteMode", "static" if every else "dynamic").parquet(_folder(root, "months"))


def _with_rest(made: DataFrame, held: DataFrame, first: date | None, end: date | None) -> DataFrame:
    """The made states with those of the other days of their months, and of months that days are taken from.

    A month that has nothing left keeps a row without people, so that it is overwritten.
    """
    low, high = (None if d is None else d.year * 100 + d.month for d in (first, end))
    near = F.lit(True) if low is None else F.col("month") >= low
    near = near if high is None else near & (F.col("month") <= high)
    old = held.filter(near)
    months = old.select("month").distinct()
    empty = months.selectExpr(
        "CAST(NULL AS DATE) AS visited", "'all' AS region", "0L AS bucket", "CAST(NULL AS BINARY) AS people",
        "0L AS visits", "false AS unnamed", "month",
    )
    kept = old.filter(~_in_days(first, end) & F.col("visited").isNotNull())
    return made.unionByName(kept).unionByName(empty)


def days_of_items(visits: DataFrame, changed: DataFrame) -> DataFrame:
    """The days on which items that changed were visited; their states have to be made anew."""
    return visits.join(changed.select(F.col("code").alias("gc_code")).distinct(), "gc_code", "left_semi").select("visited").distinct()


def people_in(held: DataFrame, periods: Mapping[str, Column]) -> DataFrame:
    """(region, one count of distinct people per period, visits): people are counted by OR of the states.

    A period is a condition on ``visited``. The empty name is a person of its own here.
    """
    flags = {name: F.coalesce(cond, F.lit(False)) for name, cond in periods.items()}
    stretches = held.groupBy("region", "bucket").agg(
        *[F.expr("bitmap_or_agg(people)").alias("_all")],
        *[F.bitmap_or_agg(F.when(flag, F.col("people"))).alias(f"_{n}") for n, flag in flags.items()],
        *[F.bool_or(F.col("unnamed") & flag).alias(f"_u_{n}") for n, flag in flags.items()],
        F.sum("visits").alias("visits"),
    )
    return stretches.groupBy("region").agg(
        F.sum(F.bitmap_count("_all")).alias("people"),
        *[
            (F.sum(F.bitmap_count(f"_{n}")) + F.bool_or(f"_u_{n}").cast("bigint")).cast("bigint").alias(n)
            for n in flags
        ],
        F.sum("visits").alias("visits"),
    )


def community(held: DataFrame, as_of: date, regions: Mapping[str, str] = fixed.REGIONS) -> DataFrame:
    """Per region: active people of the last 30 days, of the 30 before, their growth, and the
    finders and visits of all time, from the states alone."""
    clock = Clock(as_of)
    counted = people_in(
        held, {"active_players": clock.within("visited", "30d"), "active_before": clock.within("visited", "30d", True)}
    )
    now, before = F.coalesce("active_players", F.lit(0)), F.coalesce("active_before", F.lit(0))
    return (
        spine(held.sparkSession, region=["all", *regions])
        .join(counted, "region", "left")
        .select(
            "region",
            now.alias("active_players"),
            before.alias("active_before"),
            growth_pct(now, before, 0.0).alias("active_players_growth_pct"),
            F.coalesce("people", F.lit(0)).cast("bigint").alias("total_finders"),
            F.coalesce("visits", F.lit(0)).cast("bigint").alias("total_logs"),
        )
    )
