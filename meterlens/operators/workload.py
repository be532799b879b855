"""The benchmark workload: hourly, household and overall sums.

Each query is forced to completion with the ``noop`` sink, which computes every
output column (a bare ``count()`` lets column pruning delete the sums).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.functions import parse_reading_time
from meterlens.operators.rollups import TOTAL
from meterlens.schema import ENERGY, HOUSEHOLD, TIME


def _with_hour(prepared: DataFrame) -> DataFrame:
    t = F.col(TIME)
    if isinstance(prepared.schema[TIME].dataType, T.StringType):
        t = parse_reading_time(t)
    return prepared.withColumn("hour", F.hour(t))


def workload_hourly(prepared: DataFrame) -> DataFrame:
    return _with_hour(prepared).groupBy("hour").agg(F.sum(ENERGY).alias(TOTAL))


def workload_household(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy(HOUSEHOLD).agg(F.sum(ENERGY).alias(TOTAL))


def workload_overall(prepared: DataFrame) -> DataFrame:
    return prepared.agg(F.sum(ENERGY).alias(TOTAL))


WORKLOAD = {
    "workload_hourly": workload_hourly,
    "workload_household": workload_household,
    "workload_overall": workload_overall,
}


def force(df: DataFrame) -> None:
    """Run a plan to completion, computing every column, writing nothing."""
    df.write.format("noop").mode("overwrite").save()


def workload_combined(prepared: DataFrame) -> DataFrame:
    """All three workload sums from ONE scan and one shuffle (``GROUPING SETS``).

    Rows with ``level = 'hour'`` carry the hourly sums, ``'household'`` the
    per-household sums and ``'overall'`` the grand total.
    """
    hourly = _with_hour(prepared)
    gid = F.grouping_id(F.col("hour"), F.col(HOUSEHOLD))
    level = (
        F.when(gid == F.lit(0b01), F.lit("hour"))
        .when(gid == F.lit(0b10), F.lit("household"))
        .otherwise(F.lit("overall"))
    )
    return hourly.groupingSets(
        [[F.col("hour")], [F.col(HOUSEHOLD)], []], "hour", HOUSEHOLD
    ).agg(F.sum(ENERGY).alias(TOTAL), level.alias("level"))


def workload_run(prepared: DataFrame, combined: bool = False) -> dict[str, float]:
    """Run the workload; return wall seconds per executed query.

    ``combined=True`` computes the three results in one job
    (:func:`workload_combined`) instead of three.
    """
    if combined:
        start = time.perf_counter()
        force(workload_combined(prepared))
        return {"workload_combined": time.perf_counter() - start}
    timings = {}
    for name, query in WORKLOAD.items():
        start = time.perf_counter()
        force(query(prepared))
        timings[name] = time.perf_counter() - start
    return timings
