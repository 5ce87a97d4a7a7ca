"""The newest visit of every key, kept by a stateful stream.

The stream groups visits by item and account in update mode: its state is the newest row of each key,
held in RocksDB on the executors' disks, with its changes in the checkpoint. A micro-batch therefore
gives out only the keys it changed, with their rows settled against all that came before, however
late its records are. Those rows are a change set of the batch. Change sets are folded into the stored table,
in the folders that their keys belong to, once they hold as many rows as it does: a row is then
rewritten a few times in all, where a rewrite with every batch would cost the whole table each time.
A read takes the table, and the last row of each key that has changed since; ``compact`` folds those too.

A batch that is replayed gives out the same rows, and folding them again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from trailsight.operators.ingest import dedup_visits, visit_key
from trailsight.operators.upsert import PARTS, last_put, put, put_folders
from trailsight.sources.tables import LEAN, complete_batches, current_version, next_version, settings

#: The store of the state, on disk; the checkpoint takes its changes, not whole copies, and keeps those of the
#: last batches only, which are all that a run can begin from.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "64",
    # Else each partition's store has 4 MB set aside for its manifest, however little it holds.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def _keys() -> tuple[Column | str, ...]:
    return "gc_code", visit_key()


def _table(root: str) -> str:
    return f"{root}/newest"


def put_batch(settled: DataFrame, batch_id: int, root: str, parts: int = PARTS) -> None:
    """Settled rows, one a key, as changes of the batch; folded into the table when its turn has come."""
    spark = settled.sparkSession
    settled.write.mode("overwrite").parquet(f"{root}/changes/batch_id={batch_id}")
    done = _folded(spark, root)
    waiting = _waiting(spark, root, done)
    if waiting is None or done is not None and waiting.count() < _stored(spark, root, waiting.schema).count():
        return
    _fold(waiting, batch_id, root, parts)


def compact(spark: SparkSession, root: str, parts: int = PARTS) -> None:
    """Fold what is waiting, however little it is: a read is a plain scan then, where it would settle the table and
    the changes in one shuffle. ``parts`` has to be that of the stream."""
    waiting = _waiting(spark, root, _folded(spark, root))
    if waiting is not None:
        with settings(spark, LEAN):
            _fold(waiting, int(complete_batches(spark, f"{root}/changes")[-1].rsplit("=", 1)[1]), root, parts)


def _fold(waiting: DataFrame, upto: int, root: str, parts: int) -> None:
    # A fold that broke off is done again: the same rows take the same places.
    put(waiting, _table(root), _keys(), "batch_id", parts)
    spark = waiting.sparkSession
    mark = spark.range(1).select(F.lit(upto).cast("bigint").alias("upto"))
    mark.write.mode("overwrite").parquet(next_version(spark, f"{root}/folded"))


def _folded(spark: SparkSession, root: str) -> int | None:
    """The last batch whose changes the table holds; None while there is no table."""
    mark = current_version(spark, f"{root}/folded")
    return None if mark is None else spark.read.parquet(mark).first()["upto"]


def _waiting(spark: SparkSession, root: str, done: int | None) -> DataFrame | None:
    """The changes of complete batches that the table does not hold yet; None when there are none."""
    top = f"{root}/changes"
    paths = [p for p in complete_batches(spark, top) if done is None or int(p.rsplit("=", 1)[1]) > done]
    return spark.read.option("basePath", top).parquet(*paths).drop("_key") if paths else None


def _stored(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*(f for _, f in put_folders(spark, _table(root))))


def run_available(
    spark: SparkSession,
    source: str,
    schema: StructType,
    root: str,
    order: Sequence[str],
    files_per_batch: int = 1000,
    source_format: str = "parquet",
    parts: int = PARTS,
) -> StreamingQuery:
    """Process every file that has arrived and stop; a later run continues where this one ended."""
    landed = (
        spark.readStream.format(source_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .load(source)
    )
    with settings(spark, STATE | LEAN):  # a stream keeps those that it was started with
        return (
            dedup_visits(landed, order)
            .writeStream.outputMode("update")
            .foreachBatch(lambda df, n: put_batch(df, n, root, parts))
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )


def read_newest(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of every visit."""
    waiting = _waiting(spark, root, done := _folded(spark, root))
    if waiting is None:
        rows = _stored(spark, root)
    elif done is None:
        rows = last_put(waiting, _keys(), "batch_id")
    else:
        rows = last_put(_stored(spark, root, waiting.schema).unionByName(waiting), _keys(), "batch_id")
    return rows.drop("_key", "batch_id")


def changes(spark: SparkSession, root: str) -> DataFrame:
    """What each batch gave out: the keys it changed, as they were after it."""
    return spark.read.option("basePath", f"{root}/changes").parquet(f"{root}/changes/batch_id=*").drop("_key")
