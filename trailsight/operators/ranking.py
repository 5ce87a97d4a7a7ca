"""Tied leaderboards with rank movement, and the populations behind them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailsight.functions import fixed
from trailsight.functions.periods import growth_pct
from trailsight.operators.frames import spine


#: A list with ties at its edge holds up to so many times its limit.
TIE_CAP = 2


def top_with_ties(
    scores: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    limit: int,
    score: str = "score",
    tie_cap: int | None = TIE_CAP,
) -> DataFrame:
    """Rows ranked 1..limit with competition ranks, ties at the edge kept up to ``tie_cap`` x limit
    rows of a list, or all of them with ``tie_cap=None``.

    The filter on the place (or rank) plans a WindowGroupLimit: every task passes on only rows
    that may be in the list, so no group is ever gathered whole. What survives is a prefix of
    the sorted group, on which rank() is the same as on the whole group.
    """
    place = Window.partitionBy(*groups).orderBy(F.desc(score), *[F.asc(c) for c in order])
    tied = Window.partitionBy(*groups).orderBy(F.desc(score))
    if tie_cap is None:
        return scores.filter(F.col(score) > 0).withColumn("rank", F.rank().over(tied)).filter(F.col("rank") <= limit)
    return (
        scores.filter(F.col(score) > 0)
        .withColumn("_place", F.row_number().over(place))
        .filter(F.col("_place") <= tie_cap * limit)
        .withColumn("rank", F.rank().over(tied))
        .filter(F.col("rank") <= limit)
        .drop("_place")
    )


def spread(rows: DataFrame, margins: Sequence[str]) -> DataFrame:
    """Rows of the own values of some columns, NULL for none, once for each value and once for ``all``."""
    for m in margins:
        own = F.col(m)
        rows = rows.withColumn(m, F.explode(F.when(own.isNull(), F.array(F.lit("all"))).otherwise(F.array(F.lit("all"), own))))
    return rows


def first_rows(scores: DataFrame, groups: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n scorers of each group. A row that is among the first n of a margin is among the first
    n of its own cell, so lists of margins can be made from these."""
    place = Window.partitionBy(*groups).orderBy(F.desc("score"), *[F.asc(c) for c in order])
    return scores.filter(F.col("score") > 0).withColumn("_place", F.row_number().over(place)).filter(F.col("_place") <= n).drop("_place")


def score_histogram(scores: DataFrame, groups: Sequence[str], margins: Sequence[str] = ()) -> DataFrame:
    """(groups, side, score, n, rank): how many rows share a score, and the rank they share.

    rank() over a whole population would sort it in one task per group. Counting rows per
    distinct score first leaves a short list whose running total gives the same ranks. Columns in
    ``margins`` hold own values: their totals (``all``) are summed from the short list.
    """
    sides = F.array(
        F.struct(F.lit("cur").alias("side"), F.col("score").alias("score")),
        F.struct(F.lit("prev").alias("side"), F.col("prev_score").alias("score")),
    )
    counted = (
        scores.select(*groups, F.explode(sides).alias("_s"))
        .select(*groups, "_s.side", "_s.score")
        .filter(F.col("score") > 0)
        .groupBy(*groups, "side", "score")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if margins:
        counted = spread(counted, margins).groupBy(*groups, "side", "score").agg(F.sum("n").alias("n"))
    above = (
        Window.partitionBy(*groups, "side")
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counted.withColumn(
        "rank", (F.coalesce(F.sum("n").over(above), F.lit(0)) + 1).cast("int")
    )


def trend_of(rank: Column, previous: Column) -> tuple[Column, Column]:
    """Direction and size of a rank change; a newcomer goes up by an unknown amount."""
    delta = previous - rank
    direction = (
        F.when(previous.isNull() | (delta > 0), F.lit("up"))
        .when(delta < 0, F.lit("down"))
        .otherwise(F.lit("flat"))
    )
    return direction, F.abs(delta).cast("int")


def leaderboard(
    scores: DataFrame,
    groups: Sequence[str],
    key: str = "name",
    limit: int = fixed.PLAYER_LIMIT,
    extra: Sequence[str] = (),
    tie_order: Sequence[str] = (),
    key_repeats: bool = False,
    margins: Sequence[str] = (),
) -> DataFrame:
    """Top list per group with the movement against the *full* previous list.

    Groups in ``margins`` are columns with the own value of a row, or NULL: a row counts in the list of
    that value and in that of ``all``. It is sorted once in its own cell, not once in every list.

    ``key_repeats`` says one key may hold several rows of a group (a city in two countries): the
    worst of its previous ranks then counts for all of them.
    """
    if margins and key_repeats:
        raise ValueError("lists with margins need keys that don't repeat")
    order = [key, *tie_order]
    near = spread(first_rows(scores, groups, order, TIE_CAP * limit), margins) if margins else scores
    top = top_with_ties(near, groups, order, limit)
    if key_repeats:
        worst = (
            scores.filter(F.col("prev_score") > 0)
            .groupBy(*groups, key)
            .agg(F.min("prev_score").alias("_prev"))
        )
        top = top.join(worst, [*groups, key], "left")
    else:
        top = top.withColumn("_prev", F.col("prev_score"))
    ranks = (
        score_histogram(scores, groups, margins)
        .filter(F.col("side") == "prev")
        .select(*groups, F.col("score").alias("_prev"), F.col("rank").alias("_prev_rank"))
    )
    direction, delta = trend_of(F.col("rank"), F.col("_prev_rank"))
    return top.join(ranks, [*groups, "_prev"], "left").select(
        *groups,
        "rank",
        key,
        *extra,
        "score",
        direction.alias("trend"),
        delta.alias("trend_delta"),
    )


def flat_leaderboard(
    scores: DataFrame,
    groups: Sequence[str],
    key: str = "name",
    limit: int = fixed.PLAYER_LIMIT,
) -> DataFrame:
    """Top list where no previous period is meaningful: everybody stays put."""
    return top_with_ties(scores, groups, [key], limit).select(
        *groups,
        "rank",
        key,
        "score",
        F.lit("flat").alias("trend"),
        F.lit(0).alias("trend_delta"),
    )


def plain_limit(scores: DataFrame, n: int, key: str = "name") -> DataFrame:
    """The first n by score, ties cut off at n."""
    return (
        scores.filter(F.col("score") > 0)
        .orderBy(F.desc("score"), F.asc(key))
        .limit(n)
        .select(key, "score")
    )


def population_stats(
    scores: DataFrame, domains: dict[str, Sequence], empty_growth: float | None
) -> DataFrame:
    """How many scored in each group now, and the growth against the previous period.

    ``domains`` lists the groups to report, so that empty ones show as 0.
    """
    groups = list(domains)
    counted = scores.groupBy(*groups).agg(
        F.count_if(F.col("score") > 0).alias("_now"),
        F.count_if(F.col("prev_score") > 0).alias("_before"),
    )
    now, before = (F.coalesce(F.col(c), F.lit(0)) for c in ("_now", "_before"))
    return spine(scores.sparkSession, **domains).join(counted, groups, "left").select(
        *groups,
        now.cast("bigint").alias("player_count"),
        growth_pct(now, before, empty_growth).alias("player_count_growth_pct"),
    )


def with_avatars(
    board: DataFrame, avatars: DataFrame, key: str = "name", default: str = fixed.DEFAULT_AVATAR
) -> DataFrame:
    """Attach the resolved picture of each listed person, or the default one."""
    return board.join(
        avatars.select(F.col("user_name").alias(key), F.col("avatar_url").alias("_url")), key, "left"
    ).select(*board.columns, F.coalesce("_url", F.lit(default)).alias("avatar_url"))


def ranked_names(boards: Sequence[DataFrame], key: str = "name") -> DataFrame:
    """Sorted distinct names over several boards."""
    names = boards[0].select(key)
    for board in boards[1:]:
        names = names.unionByName(board.select(key))
    return names.filter(F.col(key).isNotNull() & (F.col(key) != "")).distinct().orderBy(key)
