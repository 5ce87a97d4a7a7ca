"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Rows up to this many bytes in all may be sent to every executor; beyond it a side is shuffled.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors see.

    Without that setting a local session gets a temporary folder; a cluster is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="trailsight-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/trailsight-{uuid.uuid4().hex}"


def written(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """A written table, marked for broadcast if its rows are known to fit; else left to a shuffle join."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= BROADCAST_BYTES else df


def small_sized(df: DataFrame, row_bytes: Column) -> DataFrame:
    """As `small`, for a written table whose rows differ in size."""
    total = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def free() -> None:
    """Gives the memory that this process no longer needs back to the system: Arrow's, and numpy's where the
    C library can."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def freeing(task):
    """A task over Arrow batches that frees memory when it ends, as its worker process goes on living."""

    @wraps(task)
    def run(batches):
        yield from task(batches)
        free()

    return run


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bounded_sample(rows: DataFrame, key: str, most: int, per: str | None = None) -> DataFrame:
    """At most `most` rows (for each value of `per`), those of the smallest hash of the key.

    Only the key and `per` are ranked. Groups are counted first; of a large one only the keys under a
    hash that lets few more than `most` through are ranked, so no task holds a group. The chosen keys are
    few, so the rows themselves stay where they are.
    """
    group = F.col(per) if per else F.lit(0)
    h = F.xxhash64(key, F.lit(11))
    keys = written(rows.select(group.alias("_per"), F.col(key).alias("_key"), h.alias("_h")).distinct())
    sizes = small(written(keys.groupBy("_per").agg(F.count("*").alias("_size"))), 64)
    sizes = sizes.withColumnRenamed("_per", "_of")
    share = F.col("_h") / float(1 << 64) + 0.5
    near = keys.join(sizes, F.col("_per").eqNullSafe(F.col("_of"))).where(share * F.col("_size") <= most + 8 * most**0.5 + 64)
    by = Window.partitionBy("_per").orderBy("_h", "_key")
    ranked = near.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= most).select(F.col("_key").alias(key))
    return rows.join(small(written(ranked.distinct()), 16), key, "left_semi")


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, text, y) of the documents with a label: the largest if an id has several; nulls have none."""
    y = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    return docs.select("doc_id", "text").join(y, "doc_id").select("doc_id", "text", "y")


def scored(docs: DataFrame, keep: tuple[str, ...], score, threshold: float) -> DataFrame:
    """The `keep` columns, score and predicted for each row; `score` takes a list of texts (or None)."""
    kept = docs.select(*keep).schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", score double, predicted int"

    def rows(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            s = np.asarray(score(b.column(b.num_columns - 1).to_pylist()), dtype=np.float64)
            columns = [*(b.column(i) for i in range(len(keep))), pa.array(s), pa.array((s >= threshold).astype(np.int32))]
            yield pa.record_batch(columns, names=[*keep, "score", "predicted"])

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(rows, schema)


def let(value: Column, then) -> Column:
    """`then(value)` with the value evaluated once, however often `then` uses it."""
    return F.transform(F.array(value), then)[0]


def squeezed(line: Column) -> Column:
    """A line as it is compared: lower case, runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))
