"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailsight.functions.scopes import array_of


def spine(spark: SparkSession, **domains: Sequence) -> DataFrame:
    """Every combination of fixed domains, as a one-partition frame of literals."""
    frame = spark.range(1, numPartitions=1)
    for name, values in domains.items():
        frame = frame.withColumn(name, F.explode(array_of(values)))
    return frame.drop("id")


def add_spine(frame: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Repeat every row once per value of a fixed, short domain."""
    return frame.withColumn(name, F.explode(array_of(values)))


def densify(sparse: DataFrame, full: DataFrame, keys: Sequence[str], fill: Iterable[str]) -> DataFrame:
    """Left join a counted frame onto its spine and show missing counts as 0."""
    counts = [F.expr(f"CAST(coalesce(`{c}`, 0) AS BIGINT) AS `{c}`") for c in fill]
    return full.join(sparse, list(keys), "left").select(*full.columns, *counts)


