"""Incremental ingest of visits: append clean batches, settle duplicates on read, compact.

Every micro-batch is deduplicated and written to its own folder ``batch_id=N``. The folder is
overwritten when a batch is replayed, so a repeated batch changes nothing. The newest row of a
visit is settled when the table is read, by the same order-free rule that cleans a batch, and
``compact`` folds what has piled up into a new base. A batch therefore costs as much as its own
rows, not as much as the table, and no state is kept besides the streaming checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from trailsight.operators.ingest import dedup_visits
from trailsight.operators.merge import keyed_update
from trailsight.sources.tables import current_version, next_version, read_batches


def _log(root: str) -> str:
    return f"{root}/log"


def _base(root: str) -> str:
    return f"{root}/base"


def _progress(root: str) -> str:
    return f"{root}/progress"


def append_batch(batch: DataFrame, batch_id: int, root: str, order: Sequence[str]) -> None:
    """Write one cleaned batch; safe to repeat."""
    dedup_visits(batch, order).write.mode("overwrite").parquet(f"{_log(root)}/batch_id={batch_id}")


def run_available(
    spark: SparkSession,
    source: str,
    schema: StructType,
    root: str,
    order: Sequence[str],
    files_per_batch: int = 1000,
    source_format: str = "parquet",
) -> StreamingQuery:
    """Process every file that has arrived and stop; a later run continues where this one ended."""
    reader = (
        spark.readStream.format(source_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
    )
    return (
        reader.load(source)
        .writeStream.foreachBatch(lambda df, n: append_batch(df, n, root, order))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def read_visits(
    spark: SparkSession, root: str, order: Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """The visit table as of the last complete batch.

    A batch that is being written, or broke off, is not read. While there is no batch at all the
    table is empty, with the columns of ``schema``.
    """
    log = read_batches(spark, _log(root))
    base = current_version(spark, _base(root))
    if base is not None:
        stored = spark.read.parquet(base)
        rows = stored.drop("_upto")
        if log is not None:
            upto = stored.agg(F.max("_upto")).scalar()
            log = log.filter(F.col("batch_id") > F.coalesce(upto, F.lit(-1)))
            rows = rows.unionByName(log.drop("batch_id"))
    elif log is not None:
        rows = log.drop("batch_id")
    elif schema is not None:
        rows = spark.createDataFrame([], schema)
    else:
        raise ValueError("no batch was written yet; name a schema to read an empty table")
    return dedup_visits(rows, order)


def compact(spark: SparkSession, root: str, order: Sequence[str]) -> str:
    """Fold base and log into a new base version, and the progress with them; older folders may be
    dropped afterwards."""
    log = read_batches(spark, _log(root))
    upto = F.lit(None).cast("int") if log is None else log.agg(F.max("batch_id")).scalar()
    known = next_version(spark, _progress(root))
    progress(spark, root).withColumn("_upto", upto).write.mode("overwrite").parquet(known)
    target = next_version(spark, _base(root))
    read_visits(spark, root, order).withColumn("_upto", upto).write.mode("overwrite").parquet(target)
    return target


def mark_crawled(
    spark: SparkSession, root: str, items: DataFrame, day: date, since_batch: int = 0
) -> DataFrame:
    """Items with ``logs_crawled_at`` set for those whose visits came in since a batch."""
    done = progress(spark, root).filter(F.col("last_batch") >= since_batch)
    return keyed_update(items, done, "code", {"logs_crawled_at": F.lit(day)})


def progress(spark: SparkSession, root: str) -> DataFrame:
    """(code, batches, rows, last_batch): the items whose visits have been taken in so far, those of
    batches that were compacted as well."""
    log, base = read_batches(spark, _log(root)), current_version(spark, _progress(root))
    parts = []
    if base is not None:
        stored = spark.read.parquet(base)
        parts.append(stored.drop("_upto"))
        if log is not None:
            upto = stored.agg(F.max("_upto")).scalar()
            log = log.filter(F.col("batch_id") > F.coalesce(upto, F.lit(-1)))
    if log is not None:
        parts.append(
            log.groupBy(F.col("gc_code").alias("code")).agg(
                F.count_distinct("batch_id").alias("batches"),
                F.count(F.lit(1)).alias("rows"),
                F.max("batch_id").cast("bigint").alias("last_batch"),
            )
        )
    if not parts:
        return spark.createDataFrame([], "code string, batches bigint, rows bigint, last_batch bigint")
    if len(parts) == 1:
        return parts[0]
    return (
        parts[0]
        .unionByName(parts[1])
        .groupBy("code")
        .agg(F.sum("batches").alias("batches"), F.sum("rows").alias("rows"), F.max("last_batch").alias("last_batch"))
    )
