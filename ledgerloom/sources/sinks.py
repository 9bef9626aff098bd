"""Table sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources.tables import load_vendor_map, map_changes

#: Changes after which a save stores the whole map again.
COMPACT = 8


def save_vendor_map(vendor_map: DataFrame, path: str) -> None:
    """Store a new version of the map: the vendors that changed or went, sorted by vendor; then point to it.

    The first version, and one after ``COMPACT`` changes, is the whole map. Versions are never overwritten: a run that dies leaves the
    version before it in place, and the map may be computed from the one it follows. The pointer is one appended row, which stores
    without an atomic rename can do as well.
    """
    spark, name, root = vendor_map.sparkSession, uuid.uuid4().hex, path.rstrip("/")
    versions = map_changes(spark, path)
    whole = not versions or len(versions) > COMPACT
    rows = vendor_map.withColumn("gone", F.lit(False)) if whole else _changed(vendor_map, load_vendor_map(spark, path))
    rows.orderBy("vendor").write.parquet(f"{root}/versions/{name}")
    number = versions[-1][0] + 1 if versions else 0
    spark.createDataFrame([(number, name, whole)], "number LONG, name STRING, whole BOOLEAN").coalesce(1).write.mode("append").parquet(f"{root}/pointer")


def _changed(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks or has with other values, and rows of ``old`` that are no longer there, as gone."""
    values = [c for c in old.columns if c != "vendor"]
    side = lambda df, name: df.select("vendor", F.struct(*values).alias(name))
    both = side(new, "new").join(side(old, "old"), "vendor", "full").filter(~F.col("new").eqNullSafe(F.col("old")))
    return both.select("vendor", F.coalesce("new", "old").alias("v"), F.col("new").isNull().alias("gone")).select("vendor", "v.*", "gone").select(*old.columns, "gone")


def write_stage(df: DataFrame, path: str) -> None:
    """A stage table; a repeated run replaces it."""
    df.write.mode("overwrite").parquet(path)


def write_review(df: DataFrame, path: str, *, order: list[str]) -> None:
    """A review table in display order."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def write_detail(df: DataFrame, path: str) -> None:
    """Audit rows, one folder per property; only the properties in ``df`` are replaced."""
    df.repartition("property", "date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("property").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_report(lines: DataFrame, path: str) -> None:
    """Markdown report as text lines in order."""
    lines.orderBy("section", "sheet", "row_no").select("line").write.mode("overwrite").text(path)
