"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target number of words. As often as its whole size fits, all its documents are
taken (complete epochs); the rest is filled in the order of exponential keys -ln(u) / weight, with u
from a hash of the id, up to the document that brings the sum nearest to the target. The prefix sums
are taken over buckets of the key first, so that only one bucket of each source is ever sorted; one of
more than EDGE_ROWS rows is split by key until the part that holds the end is smaller.

Cases: a null or empty text has size 0 and is never taken; a null source is a source of its own, the
last in order; a null id hashes as an empty one. Ties of the key go to the smaller id, then the
smaller size; repeated rows are rows of their own. No documents or no words give no targets above 0.
Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailsight.llm.common import n_words, small, written

WEIGHTS = (5, 2, 1)
SHARE, MOST_EPOCHS = 1.5, 2
SEED = "mix-1"
BUCKETS = 1024
#: Rows of a source that are sorted at most, unless their keys are equal.
EDGE_ROWS = 200_000
#: Bytes of a row of the plan when it is sent to executors.
PLAN_BYTES = 256


def quality_weight(text: Column) -> Column:
    """Weight of a document, 0.1 to 1: less the more of its characters are marks."""
    marks = F.length(F.regexp_replace(text, "[^#*$%&|<>!]+", ""))
    share = marks / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.1), 1 - 8 * share), F.lit(1.0))


def keyed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """With _mix_size, _mix_key (exponential, by quality weight) and _mix_bucket; the other columns stay."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    rows = docs.withColumn("_mix_size", n_words(F.col("text"))).withColumn("_mix_key", -F.log(u) / quality_weight(F.col("text")))
    return rows.withColumn("_mix_bucket", F.least(F.lit(BUCKETS - 1), F.floor((1 - F.exp(-F.col("_mix_key"))) * BUCKETS)).cast("int"))


def narrow(rows: DataFrame) -> DataFrame:
    """What a plan is made from: keyed rows without their texts, written once."""
    return written(rows.select("doc_id", "source", "_mix_size", "_mix_key", "_mix_bucket"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size and target from (source, source_size); one row a source.

    Water level: sources in order of the level at which they are full. A source is full if the level
    that the fuller ones leave reaches it.
    """
    ranked = sizes.withColumn("_n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.col("_n") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight).withColumn("_cap", (most * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), "_n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    heavy = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("_left", left).withColumn("_heavy", heavy)
    ranked = ranked.withColumn("_full", F.col("_cap") * F.col("_heavy") <= F.col("_w") * F.col("_left"))
    # The first source that is not full sets the level of all that follow.
    ranked = ranked.withColumn("_n2", F.row_number().over(order))
    level = F.min(F.when(~F.col("_full"), F.struct("_n2", "_left", "_heavy"))).over(Window.partitionBy())
    ranked = ranked.withColumn("_at", level)
    filled = F.col("_w") * (F.col("_at._left") / F.col("_at._heavy"))
    target = F.when(F.col("_at").isNull() | (F.col("_n2") < F.col("_at._n2")), F.col("_cap")).otherwise(filled)
    return ranked.select("source", "source_size", target.alias("target"))


def narrowed(near: DataFrame) -> DataFrame:
    """The rows of each source's edge bucket (source, key, doc_id, size, before, rest) cut to the part in which
    the fraction ends, with `before` as the words ahead of it and `passed`, the last row ahead of it if any."""
    near = near.withColumn("passed", F.struct("key", "doc_id", "size"))
    near = near.withColumn("passed", F.when(F.lit(False), F.col("passed")))
    while True:
        sizes = near.groupBy("source").agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        if sizes.where((F.col("n") > EDGE_ROWS) & (F.col("lo") < F.col("hi"))).isEmpty():
            return near
        n, s = near.alias("n"), small(written(sizes), PLAN_BYTES).alias("s")
        part = F.least(F.lit(BUCKETS - 1), F.floor((F.col("key") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS))
        split = n.join(s, F.col("n.source").eqNullSafe(F.col("s.source")))
        split = split.select("n.*", F.when(F.col("s.n") > EDGE_ROWS, F.coalesce(part, F.lit(0))).otherwise(F.lit(0)).alias("part"))
        words = split.groupBy("source", "part").agg(F.sum("size").alias("words"), F.max(F.struct("key", "doc_id", "size")).alias("top"), F.first("before").alias("start"), F.first("rest").alias("rest"))
        by = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        ends = written(words).withColumn("ahead", F.col("start") + F.coalesce(F.sum("words").over(by), F.lit(0))).withColumn("last_top", F.max("top").over(by))
        ends = ends.where("ahead <= rest and rest < ahead + words").select("source", "part", "ahead", "last_top")
        e = small(written(ends), PLAN_BYTES).alias("e")
        split = split.alias("n")
        kept = split.join(e, F.col("n.source").eqNullSafe(F.col("e.source")) & (F.col("n.part") == F.col("e.part")))
        near = written(kept.select("n.source", "key", "doc_id", "size", F.col("ahead").alias("before"), "rest", F.coalesce("last_top", "passed").alias("passed")))


def plan(rows: DataFrame, **how) -> DataFrame:
    """For each source of the narrow rows: source_size, target, epochs, and where its fraction ends.

    The fraction takes all of the buckets before `edge`, and of that one the rows up to `last` (key, id, size).
    """
    rows = rows.select("doc_id", "source", *(F.col(f"_mix_{c}").alias(c) for c in ("size", "key", "bucket")))
    filled = written(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    goal = targets(filled.groupBy("source").agg(F.sum("words").alias("source_size")), **how)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = written(goal.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    f, g = filled.alias("f"), goal.alias("g")
    by = Window.partitionBy("f.source").orderBy("f.bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = f.join(g, F.col("f.source").eqNullSafe(F.col("g.source"))).withColumn("before", F.coalesce(F.sum("words").over(by), F.lit(0)))
    edge = edge.where("before <= rest and rest < before + words").select(F.col("f.source").alias("source"), F.col("f.bucket").alias("bucket"), "before", "rest")
    edge = small(written(edge), PLAN_BYTES).alias("e")
    r = rows.alias("r")
    near = r.join(edge, F.col("r.source").eqNullSafe(F.col("e.source")) & (F.col("r.bucket") == F.col("e.bucket")))
    near = narrowed(near.select("r.source", "key", "doc_id", "size", "before", "rest"))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    taken = F.when(F.expr("2 * upto + size <= 2 * rest"), F.struct("key", "doc_id", "size"))
    near = near.withColumn("upto", F.col("before") + F.sum("size").over(order) - F.col("size"))
    last = near.groupBy("source").agg(F.coalesce(F.max(taken), F.max("passed")).alias("last")).alias("l")
    cut = edge.join(last, F.col("e.source").eqNullSafe(F.col("l.source")), "left").select(F.col("e.source").alias("source"), "bucket", "last").alias("c")
    out = g.join(cut, F.col("g.source").eqNullSafe(F.col("c.source")), "left")
    return written(out.select("g.source", "source_size", "target", "epochs", F.col("c.bucket").alias("edge"), "last"))


def mixed(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Keyed rows with _mix_source_size, _mix_target and _mix_taken (words the mix takes, repeats counted)."""
    p = small(planned, PLAN_BYTES).select(*(F.col(c).alias(f"_mix_{c}") for c in planned.columns))
    rows = rows.join(p, F.col("source").eqNullSafe(F.col("_mix_source")))
    before = F.col("_mix_bucket") < F.col("_mix_edge")
    within = F.struct("_mix_key", "doc_id", "_mix_size") <= F.col("_mix_last")
    more = F.when(F.col("_mix_bucket") != F.col("_mix_edge"), before).otherwise(within)
    times = F.col("_mix_epochs") + F.coalesce(more, F.lit(False)).cast("long")
    return rows.withColumn("_mix_taken", times * F.col("_mix_size"))


def copies(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each row of documents as often as it is taken; columns as before."""
    rows = keyed(docs)
    taken = mixed(rows, plan(narrow(rows), **how)).where("_mix_taken > 0")
    return taken.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.expr("_mix_taken div _mix_size")))).select(*docs.columns)


#: The same mix over the table documents, for a second engine.
SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  coalesce(greatest(0.1::DOUBLE, 1 - 8 * (length(regexp_replace(text, '[^#*$%&|<>!]+', '', 'g')) / greatest(length(text), 1)::DOUBLE)), 1) AS w,
  (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / {1 << 52}::DOUBLE AS u FROM documents),
k AS (SELECT *, -ln(u) / w AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS sw, {MOST_EPOCHS} * source_size::DOUBLE AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / sw, source NULLS LAST) AS i FROM n),
q AS (SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE * {SHARE} - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(sw) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy FROM o),
e AS (SELECT min(i) AS first_open, arg_min(rest / heavy, i) AS level FROM q WHERE NOT cap * heavy <= sw * rest),
t AS (SELECT source, source_size, CASE WHEN first_open IS NULL OR i < first_open THEN cap ELSE sw * level END AS target FROM q, e),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
c AS (SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
  sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, ((epochs + CASE WHEN 2 * before + size <= 2 * rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM c
"""
