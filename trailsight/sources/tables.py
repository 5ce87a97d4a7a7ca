"""Reading and writing the stored tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Rows that one task sorts and groups in a bucket, about.
BUCKET_ROWS = 500_000
#: Folders of a layout by ranges. Each is a task, a folder to list, and a report to the driver.
MOST_RANGES = 1000
#: For jobs that write much, each frame once: shuffle files go when their job has ended, not when the driver
#: happens to collect its garbage, and tables take about two thirds of the room.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A stored table; files of older generations may lack columns when schemas are merged."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table, read in parallel slices of a numeric column when one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_partitioned(
    table: DataFrame, path: str, partition_by: Sequence[str] = (), files: int | None = None
) -> None:
    """Write a merged table to a *new* place; readers switch over once it is complete."""
    if files is not None:
        table = table.repartition(files, *partition_by)
    writer = table.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def next_version(spark: SparkSession, root: str) -> str:
    """Path of the next version folder below ``root`` (v00000001, v00000002, ...)."""
    return f"{root}/v{max([0, *_versions(spark, root)]) + 1:08d}"


def current_version(spark: SparkSession, root: str) -> str | None:
    """Newest version that was written completely."""
    done = _versions(spark, root, complete_only=True)
    return f"{root}/v{max(done):08d}" if done else None


def _versions(spark: SparkSession, root: str, complete_only: bool = False) -> list[int]:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if re.fullmatch(r"v\d{8}", name):
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if not complete_only or fs.exists(marker):
                found.append(int(name[1:]))
    return found


def versions(spark: SparkSession, root: str) -> list[str]:
    """Paths of the versions that were written completely, in order."""
    return [f"{root}/v{n:08d}" for n in sorted(_versions(spark, root, complete_only=True))]


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing while there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for a while; afterwards they are as they were."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def complete_batches(spark: SparkSession, root: str) -> list[str]:
    """Folders ``batch_id=N`` below ``root`` that were written completely, in order of N."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if re.fullmatch(r"batch_id=\d+", name) and fs.exists(done):
            found.append((int(name[9:]), f"{root}/{name}"))
    return [path for _, path in sorted(found)]


def read_batches(spark: SparkSession, root: str, schema: str | StructType | None = None) -> DataFrame | None:
    """The complete batches below ``root`` with their ``batch_id``; None while there is none."""
    paths = complete_batches(spark, root)
    if not paths:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("basePath", root).parquet(*paths)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, below the cluster's checkpoint folder.

    Only a session on one machine, as in tests, may do without that setting; a cluster is refused,
    since files that executors wrote to their own disks can't be read back.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="trailsight-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame that several jobs need and read it back: lineage ends at the files, so a
    lost executor costs a re-read, and the work behind the frame is done once."""
    path = new_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def append_rejects(rejects: DataFrame, path: str) -> None:
    """Add rejected rows to a dead-letter folder, as JSON lines."""
    rejects.write.mode("append").json(path)


def read_landed_json(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """Landed JSON lines with the given key columns and the raw document in ``body``."""
    return spark.read.schema(f"{keys}, body string").json(path)


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: id, name and polygon shape (parts of rings of points).

    A Polygon becomes a MultiPolygon of one part.
    """
    schema = """features array<struct<id: string, properties: struct<id: string, name: string>,
                geometry: struct<type: string, coordinates: string>>>"""
    features = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .json(path)
        .select(F.explode("features").alias("f"))
        .select(
            F.coalesce("f.id", "f.properties.id").alias("id"),
            F.col("f.properties.name").alias("name"),
            F.col("f.geometry.type").alias("type"),
            F.col("f.geometry.coordinates").alias("coordinates"),
        )
    )
    multi = F.when(
        F.col("type") == "Polygon", F.concat(F.lit("["), "coordinates", F.lit("]"))
    ).otherwise(F.col("coordinates"))
    parsed = F.from_json(multi, "array<array<array<array<double>>>>")
    shape = F.transform(
        parsed,
        lambda part: F.transform(
            part,
            lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))),
        ),
    )
    return features.select("id", "name", shape.alias("shape"))


def city_provinces(features: DataFrame, provinces: Mapping[str, str], direct: Mapping[str, str]) -> DataFrame:
    """(city, province) from the first two digits of the feature id; direct cities override."""
    spark = features.sparkSession
    prefix = F.create_map(*[F.lit(x) for kv in provinces.items() for x in kv])
    named = (
        features.select(
            F.col("name").alias("city"), prefix[F.substring("id", 1, 2)].alias("province")
        )
        .filter((F.col("city") != "") & F.col("province").isNotNull())
        .groupBy("city")
        .agg(F.max("province").alias("province"))
    )
    pairs = F.explode(F.create_map(*[F.lit(x) for kv in direct.items() for x in kv]))
    fixed_rows = spark.range(1).select(pairs.alias("city", "province"))
    return named.join(fixed_rows, "city", "left_anti").unionByName(fixed_rows)


def bucket_count(least: int, *frames: DataFrame) -> int:
    """How many buckets tables need that lie together: one for each BUCKET_ROWS of the largest, since a
    bucket is written, joined and grouped by one task."""
    return max(least, -(-max(f.count() for f in frames) // BUCKET_ROWS))


def bucketed(frame: DataFrame, column: str, buckets: int, label: str) -> DataFrame:
    """The rows as a stored table in buckets of a column, sorted in each: tables with the same number of
    buckets join and group on it without a shuffle."""
    spark = frame.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    writer = frame.repartition(buckets, column).write.bucketBy(buckets, column).sortBy(column)
    writer.option("path", new_folder(spark, label)).saveAsTable(name)
    return spark.table(name)


def write_pages(rows: DataFrame, root: str, order: Sequence[str], rows_per_range: int) -> None:
    """Lay rows out in order, in folders of about so many, with the number of rows of each.

    A table that would need more than MOST_RANGES folders gets that many, with more rows in each.
    """
    ranges = min(max(1, -(-rows.count() // rows_per_range)), MOST_RANGES)
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    dealt.write.mode("errorifexists").partitionBy("_range").parquet(f"{root}/rows")
    counts = rows.sparkSession.read.parquet(f"{root}/rows").groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    counts.coalesce(1).write.mode("errorifexists").parquet(f"{root}/counts")


def read_page(spark: SparkSession, root: str, order: Sequence[str], offset: int, size: int) -> DataFrame:
    """Rows ``offset`` to ``offset + size`` in order. Only the folders that hold some are opened; the
    counts, one row a folder, say which."""
    before = "sum(n) OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n"
    counts = spark.read.parquet(f"{root}/counts").selectExpr("_range", "n", f"{before} AS before")
    hit = counts.filter((F.col("before") < offset + size) & (F.col("before") + F.col("n") > offset)).orderBy("_range").collect()
    if not hit:
        return spark.read.parquet(f"{root}/rows").drop("_range").limit(0)
    paths = [f"{root}/rows/_range={r['_range']}" for r in hit]
    rows = spark.read.option("basePath", f"{root}/rows").parquet(*paths).drop("_range")
    return rows.orderBy(*order).offset(offset - hit[0]["before"]).limit(size)
