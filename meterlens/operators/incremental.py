"""Rollups and anomaly bounds from what each landed batch left, without its readings.

A batch of readings leaves two small batch-keyed tables
(:mod:`meterlens.sinks.batches`):

* cells: count, sum, extremes and squared deviations by (date, hour) and by
  household; cells merge into the six rollups of
  :func:`~meterlens.operators.rollups.calendar_rollups`, standard deviations
  included.
* sketches: a mergeable quantile sketch by day; all of them, or those of any days,
  merge into approximate anomaly bounds.

New batches are read once, when they land; what was landed before is never
read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.operators.anomalies import Q1_LEVEL, Q3_LEVEL, bounds_from_quartiles
from meterlens.operators.rollups import calendar_cells, merge_cells, rollups_from_cells
from meterlens.schema import ENERGY, HOUSEHOLD
from meterlens.sinks.batches import read_batches

CELL_COUNT, DAY_COUNT = "cells", "days"
CELL_KEYS = ("date", "hour", HOUSEHOLD, "is_cell")
CELLS = (
    f"date date, hour int, {HOUSEHOLD} string, total_energy_kwh double, n long, lo double, "
    "hi double, squares double, is_cell boolean"
)
#: Size of a stored sketch: its normalised rank error is about 2.3 / SKETCH_K ** 0.9.
SKETCH_K = 4096
SKETCHES = "date date, n long, sketch binary"


def reading_cells(cleaned: DataFrame) -> DataFrame:
    """Cells of one batch of cleaned readings (households as text)."""
    cells = calendar_cells(cleaned.withColumn(HOUSEHOLD, F.col(HOUSEHOLD).cast("string")), HOUSEHOLD)
    return cells.select(*(f.name for f in T.StructType.fromDDL(CELLS)))


def stored_cells(spark: SparkSession, target: str) -> DataFrame:
    """The cells of all stored batches, one for each key."""
    return merge_cells(read_batches(spark, target, CELLS), *CELL_KEYS)


def stored_rollups(spark: SparkSession, target: str) -> DataFrame:
    """``calendar_rollups`` of all readings landed so far, from their cells."""
    return rollups_from_cells(stored_cells(spark, target))


def day_sketches(cleaned: DataFrame) -> DataFrame:
    """``date, n, sketch``: one quantile sketch for each day of a batch."""
    return cleaned.groupBy("date").agg(
        F.count(ENERGY).alias("n"), F.kll_sketch_agg_double(ENERGY, SKETCH_K).alias("sketch")
    )


def stored_bounds(spark: SparkSession, target: str, days=None) -> DataFrame:
    """``iqr_bounds`` (approximate) from stored sketches; ``days`` is a filter on ``date``."""
    sketches = read_batches(spark, target, SKETCHES)
    if days is not None:
        sketches = sketches.filter(days)
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("s"), F.sum("n").alias("n"))

    def quartile(level: float):
        return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(level)))

    return bounds_from_quartiles(
        merged.select(quartile(Q1_LEVEL).alias("q1_kwh"), quartile(Q3_LEVEL).alias("q3_kwh"))
    )
