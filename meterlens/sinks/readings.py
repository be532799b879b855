"""A typed table of cleaned readings, laid out for the lookups that reports make.

Times are typed once, when readings are stored.  Rows are dealt out by ranges of
(date, household, time) and sorted within a file by household and time: a range
of dates touches few files, and in each of them one household lies in one or
two row groups, which the reader finds by their minima, maxima and Bloom
filters.  A household or a day with a third of all rows is cut into ranges like any
other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.schema import HOUSEHOLD, TIME

#: Row groups small enough that a household is a small part of a file.
ROW_GROUP_BYTES = 8 << 20


def layout(cleaned: DataFrame, files: int | None = None) -> DataFrame:
    """Cleaned readings in the order of the typed table (one range shuffle)."""
    keys = ["date", HOUSEHOLD, TIME]
    ranged = cleaned.repartitionByRange(files, *keys) if files else cleaned.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(HOUSEHOLD, TIME)


def layout_options(row_group_bytes: int = ROW_GROUP_BYTES) -> dict[str, str]:
    return {
        f"parquet.bloom.filter.enabled#{HOUSEHOLD}": "true",
        "parquet.block.size": str(row_group_bytes),
    }


def store_readings(
    cleaned: DataFrame,
    path: str,
    files: int | None = None,
    mode: str = "overwrite",
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Write the typed table."""
    options = layout_options(row_group_bytes)
    layout(cleaned, files).write.mode(mode).options(**options).parquet(path)


def between_days(first, last) -> Column:
    """Readings of the days from ``first`` to ``last`` (a filter that reaches the reader)."""
    return F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The typed table; its schema is in its files."""
    return spark.read.parquet(path)
