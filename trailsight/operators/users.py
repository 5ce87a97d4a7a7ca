"""People to enrich: candidates by account id, and ids that carry several names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailsight.functions import fixed, scopes


def _named(name: str) -> Column:
    return F.coalesce(F.trim(name), F.lit("")) != ""


def account_names(visits: DataFrame, items: DataFrame) -> DataFrame:
    """(guid, user_name, visits, owns): the names an account was seen under, one row each.

    One scan of either table. ``visits`` counts the visits under the name; ``owns`` says that the
    name owns a live item under a real account. The facts are only counted, by hashing; all that
    looks at names works on this much shorter frame.
    """
    from_visits = (
        visits.filter(F.col("user_guid").isNotNull() & _named("user_name"))
        .groupBy(F.col("user_guid").alias("guid"), F.trim("user_name").alias("user_name"))
        .agg(F.count(F.lit(1)).alias("visits"))
        .withColumn("owns", F.lit(0))
    )
    real = (
        (F.col("owner_guid") != fixed.MISSING_GUID)
        & (F.col("owner_username") != fixed.DELETED_OWNER)
        & scopes.not_deleted()
    )
    from_items = (
        items.filter(F.col("owner_guid").isNotNull() & _named("owner_username"))
        .groupBy(F.col("owner_guid").alias("guid"), F.trim("owner_username").alias("user_name"))
        .agg(F.lit(0).cast("bigint").alias("visits"), F.max(F.coalesce(real, F.lit(False)).cast("int")).alias("owns"))
    )
    return (
        from_visits.unionByName(from_items)
        .groupBy("guid", "user_name")
        .agg(F.sum("visits").alias("visits"), F.max("owns").alias("owns"))
    )


def _accounts(visits: DataFrame, items: DataFrame, more_than: int) -> DataFrame:
    """Candidates with ``name_count``, the number of names they were seen under."""
    seen = (
        account_names(visits, items)
        .groupBy("guid")
        .agg(
            F.sum("visits").alias("seen"),
            F.max(F.when(F.col("visits") > 0, F.col("user_name"))).alias("visitor"),
            F.max(F.when(F.col("owns") > 0, F.col("user_name"))).alias("owner"),
            F.count(F.lit(1)).alias("name_count"),
        )
    )
    often = F.col("seen") > more_than
    return seen.filter(often | F.col("owner").isNotNull()).select(
        "guid",
        F.when(often, F.col("visitor")).otherwise(F.col("owner")).alias("user_name"),
        F.when(often, F.col("seen")).otherwise(F.lit(0)).cast("bigint").alias("log_count"),
        "name_count",
    )


def candidate_pool(
    visits: DataFrame, items: DataFrame, more_than: int = fixed.MIN_VISITS_FOR_CANDIDATE
) -> DataFrame:
    """Accounts with more than the given number of visits, and owners that are not among them."""
    return _accounts(visits, items, more_than).drop("name_count")


def candidates_to_fetch(
    visits: DataFrame,
    items: DataFrame,
    users: DataFrame,
    limit: int | None = None,
    more_than: int = fixed.MIN_VISITS_FOR_CANDIDATE,
    retry_failed: bool = True,
) -> DataFrame:
    """Candidates that are unknown or (with ``retry_failed``) not yet fetched well.

    Accounts with conflicting names are taken out after the limit, so they use up quota.
    """
    pool = _accounts(visits, items, more_than)
    known = users.select("guid", F.lit(True).alias("_known"), "fetch_status")
    wanted = F.col("_known").isNull()
    if retry_failed:
        wanted = wanted | (F.coalesce("fetch_status", F.lit("")) != "ok")
    todo = (
        pool.join(known, "guid", "left")
        .filter(wanted)
        .select("guid", "user_name", "log_count", "name_count")
    )
    if limit is not None:
        todo = todo.orderBy(F.desc("log_count"), "user_name", "guid").limit(limit)
    return todo.filter(F.col("name_count") == 1).drop("name_count")


def name_conflicts(visits: DataFrame, items: DataFrame, salts: int = 16) -> DataFrame:
    """(guid, user_name, name_count) for accounts seen under more than one name.

    One row per name instead of an array per account: a shared id, such as that of removed
    accounts, may carry any number of names. Such an id's names are spread over ``salts`` tasks,
    and its count is sent to each.
    """
    names = account_names(visits, items).select("guid", "user_name")
    many = (
        names.groupBy("guid")
        .agg(F.count(F.lit(1)).alias("name_count"))
        .filter(F.col("name_count") > 1)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = names.withColumn("_salt", F.pmod(F.xxhash64("user_name"), F.lit(salts)).cast("int"))
    return salted.join(many, ["guid", "_salt"]).select("guid", "user_name", "name_count")


def candidate_count(
    visits: DataFrame, items: DataFrame, more_than: int = fixed.MIN_VISITS_FOR_CANDIDATE
) -> DataFrame:
    return candidate_pool(visits, items, more_than).agg(F.count(F.lit(1)).alias("candidates"))
