"""A resumable run over items: results land as a stream, a ledger knows what is done, failing or given up.

A landed result says of an item whether it could be fetched, and which visits were found; none is a
result as well. In one micro-batch the visits are taken in and the ledger is written, both in folders
of the batch that are overwritten when it is replayed, so marks and visits never part. Results of
items that earlier batches have closed are left out by an anti join.

An item is done once a result came without an error, dead after LIMIT failures, else failing.
``compact`` folds the ledger of finished batches into a new base; older folders may go then.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trailsight.operators.merge import keyed_update
from trailsight.sources.tables import append_rejects, current_version, next_version, read_batches
from trailsight.streaming.visits import append_batch

LIMIT = 3
VISIT = (
    "user_name string, user_guid string, visited date, favorite_point_used boolean, is_ftf boolean, log_type string, seq bigint"
)
#: ``attempt`` orders the results of an item; ``error`` is null when it could be fetched.
RESULT = f"code string, attempt bigint, error string, visits array<struct<{', '.join(': '.join(c.split()) for c in VISIT.split(', '))}>>"
LEDGER = "code string, attempts bigint, failures bigint, done boolean, last_error struct<attempt: bigint, error: string>"
VISIT_ORDER = ("seq",)


def _log(root: str) -> str:
    return f"{root}/ledger/log"


def _base(root: str) -> str:
    return f"{root}/ledger/base"


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("code").agg(
        F.sum("attempts").alias("attempts"),
        F.sum("failures").alias("failures"),
        F.bool_or("done").alias("done"),
        F.max("last_error").alias("last_error"),
    )


def entries(results: DataFrame) -> DataFrame:
    """What results add to the ledger, one row a code."""
    failed = F.col("error").isNotNull()
    return _summed(
        results.filter(F.col("code").isNotNull()).select(
            "code",
            F.lit(1).cast("bigint").alias("attempts"),
            failed.cast("bigint").alias("failures"),
            (~failed).alias("done"),
            F.when(failed, F.struct("attempt", "error")).alias("last_error"),
        )
    )


def state(limit: int = LIMIT) -> Column:
    return (
        F.when(F.col("done"), F.lit("done"))
        .when(F.col("failures") >= limit, F.lit("dead"))
        .otherwise(F.lit("failing"))
    )


def ledger(spark: SparkSession, root: str, limit: int = LIMIT, before: int | None = None) -> DataFrame:
    """(code, attempts, failures, done, last_error, state) of every item with a result, of all batches
    or of those before one."""
    parts, upto = [], None
    base = current_version(spark, _base(root))
    if base is not None:
        stored = spark.read.parquet(base)
        upto = stored.agg(F.max("_upto")).scalar()
        parts.append(stored.drop("_upto"))
    log = read_batches(spark, _log(root), f"{LEDGER}, batch_id bigint")
    if log is not None:
        if upto is not None:
            log = log.filter(F.col("batch_id") > F.coalesce(upto, F.lit(-1)))
        if before is not None:
            log = log.filter(F.col("batch_id") < before)
        parts.append(log.drop("batch_id"))
    if not parts:
        parts.append(spark.createDataFrame([], LEDGER))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _summed(rows).withColumn("state", state(limit))


def closed(known: DataFrame) -> DataFrame:
    return known.filter(F.col("state") != "failing").select("code")


def take_batch(results: DataFrame, batch_id: int, root: str, limit: int = LIMIT) -> None:
    """Visits and ledger of one batch of results; safe to repeat."""
    spark = results.sparkSession
    fresh = results.join(closed(ledger(spark, root, limit, before=batch_id)), "code", "left_anti")
    fetched = fresh.filter(F.col("error").isNull()).select(F.col("code").alias("gc_code"), F.explode("visits").alias("v"))
    append_batch(fetched.select("gc_code", "v.*"), batch_id, root, VISIT_ORDER)
    entries(fresh).write.mode("overwrite").parquet(f"{_log(root)}/batch_id={batch_id}")


def run_available(
    spark: SparkSession, source: str, root: str, limit: int = LIMIT, files_per_batch: int = 1000, source_format: str = "parquet"
) -> StreamingQuery:
    """Take in every landed result and stop; a later run continues where this one ended."""
    landed = (
        spark.readStream.format(source_format)
        .schema(RESULT)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .load(source)
    )
    return (
        landed.writeStream.foreachBatch(lambda df, n: take_batch(df, n, root, limit))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def compact(spark: SparkSession, root: str) -> str:
    """Fold the ledger into a new base version, by the batches that are in its log now."""
    target = next_version(spark, _base(root))
    log = read_batches(spark, _log(root), f"{LEDGER}, batch_id bigint")
    upto = F.lit(None).cast("bigint") if log is None else log.agg(F.max("batch_id")).scalar()
    folded = ledger(spark, root).drop("state")
    folded.withColumn("_upto", upto).write.mode("overwrite").parquet(target)
    return target


def to_fetch(items: DataFrame, known: DataFrame) -> DataFrame:
    """Items that are neither done nor dead, those that failed least first in ``failures``."""
    left = items.join(closed(known), "code", "left_anti")
    tried = known.select("code", "failures")
    return left.join(tried, "code", "left").withColumn("failures", F.coalesce("failures", F.lit(0)))


def mark_done(items: DataFrame, known: DataFrame, day: date) -> DataFrame:
    """Items with ``logs_crawled_at`` set for all that were fetched, quiet ones as well."""
    return keyed_update(items, known.filter("done"), "code", {"logs_crawled_at": F.lit(day)})


def dead_letters(known: DataFrame) -> DataFrame:
    """(code, attempts, error) of the items that are given up."""
    return known.filter(F.col("state") == "dead").select("code", "attempts", F.col("last_error.error").alias("error"))


def write_dead_letters(known: DataFrame, path: str) -> None:
    append_rejects(dead_letters(known), path)

