"""Writing reports as nested JSON.

A report is written as one folder per section. Sections with a proven bound per row (a top list
of at most 2 x limit entries, an 81-cell matrix, ten months of one city) are nested into arrays;
sections without one (heatmaps) stay one JSON line per point.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def camel_struct(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(camel(c)) for c in columns])


def camel_rows(rows: DataFrame) -> DataFrame:
    """The rows with every name in camel case, those of nested lists as well."""

    def renamed(kind: DataType) -> DataType:
        if isinstance(kind, ArrayType):
            return ArrayType(renamed(kind.elementType), kind.containsNull)
        if isinstance(kind, StructType):
            return StructType([StructField(camel(f.name), renamed(f.dataType), f.nullable) for f in kind.fields])
        return kind

    return rows.select(*[F.col(f.name).cast(renamed(f.dataType)).alias(camel(f.name)) for f in rows.schema.fields])


def nest_lists(rows: DataFrame, path: Sequence[str], order: Sequence[str], field: str) -> DataFrame:
    """Collect bounded lists of entries under their group columns, in the given order."""
    entry = [c for c in rows.columns if c not in path]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], camel_struct(entry).alias("e"))
    listed = rows.groupBy(*path).agg(F.array_sort(F.collect_list(packed)).alias("_l"))
    return listed.select(*path, F.transform("_l", lambda x: x["e"]).alias(field))


def nest_maps(rows: DataFrame, path: Sequence[str], field: str) -> DataFrame:
    """Fold the group columns from the last to the second into maps, one row per first column.

    The keys are fixed short domains (type, range), so every map is small.
    """
    for depth in range(len(path) - 1, 0, -1):
        entries = F.collect_list(F.struct(F.col(path[depth]).alias("k"), F.col(field).alias("v")))
        # Maps cannot be ordered, so the entries are sorted by key alone.
        by_key = F.array_sort(
            entries, lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)
        )
        rows = rows.groupBy(*path[:depth]).agg(F.map_from_entries(by_key).alias(field))
    return rows


def write_sections(sections: Mapping[str, DataFrame], path: str) -> None:
    """One folder of JSON lines per section; the first failure ends the job."""
    for name, frame in sections.items():
        frame.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")
