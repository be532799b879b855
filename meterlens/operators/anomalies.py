"""IQR anomaly detection.

The quartiles are a global aggregate.  Instead of collecting them to the driver
and re-injecting literals, the bounds stay a one-row DataFrame that feeds the
flagging expression as an (uncorrelated) scalar subquery: Spark runs it once,
broadcasts the single value, and the whole detection remains one lazy plan.

Quartile methods:

* ``"approx"`` (default): ``percentile_approx`` — a mergeable sketch with
  bounded memory per task (rank error ``1/accuracy``; 1000 gives the 0.001
  error of the original job).  Fully lazy, one scan.
* ``"exact"``: the discrete quartiles (smallest value whose cumulative share
  reaches p) by distributed histogram refinement
  (:func:`meterlens.operators.quantiles.exact_quantiles`): a few small jobs run
  when the bounds are built, each one scan of the energy column; no task ever
  holds more than one bin histogram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.operators.quantiles import exact_quantiles
from meterlens.schema import ENERGY, HOUSEHOLD, TIME

# Quartile levels, the IQR multiplier and the anomaly labels.
Q1_LEVEL = 0.25
Q3_LEVEL = 0.75
IQR_FACTOR = 1.5
HIGH = "High Consumption"
LOW = "Low Consumption"
NORMAL = "Normal"

BOUND_COLUMNS = ["q1_kwh", "q3_kwh", "iqr_kwh", "lower_bound_kwh", "upper_bound_kwh"]


def iqr_bounds(cleaned: DataFrame, method: str = "approx", accuracy: int = 1000) -> DataFrame:
    """One row: ``q1_kwh, q3_kwh, iqr_kwh, lower_bound_kwh, upper_bound_kwh``.

    Null bounds when there are no readings (so nothing is flagged).  With
    ``method="exact"`` the quartiles are computed when this is called.
    """
    if method == "exact":
        q1, q3 = exact_quantiles(cleaned, ENERGY, [Q1_LEVEL, Q3_LEVEL])
        quart = cleaned.sparkSession.createDataFrame([(q1, q3)], "q1_kwh double, q3_kwh double")
    elif method == "approx":
        qs = F.percentile_approx(ENERGY, [Q1_LEVEL, Q3_LEVEL], accuracy)
        quart = cleaned.agg(
            qs[0].cast("double").alias("q1_kwh"), qs[1].cast("double").alias("q3_kwh")
        )
    else:
        raise ValueError("method must be 'approx' or 'exact'")
    return bounds_from_quartiles(quart)


def bounds_from_quartiles(quart: DataFrame) -> DataFrame:
    """The bounds' row from one of ``q1_kwh, q3_kwh``."""
    iqr = F.col("q3_kwh") - F.col("q1_kwh")
    return quart.select(
        "q1_kwh",
        "q3_kwh",
        iqr.alias("iqr_kwh"),
        (F.col("q1_kwh") - F.lit(IQR_FACTOR) * iqr).alias("lower_bound_kwh"),
        (F.col("q3_kwh") + F.lit(IQR_FACTOR) * iqr).alias("upper_bound_kwh"),
    )


def _bound_value(bounds: DataFrame) -> Column:
    """The bounds row as one struct-valued scalar subquery."""
    return bounds.select(F.struct(*BOUND_COLUMNS).alias("b")).scalar()


def flag_anomalies(
    cleaned: DataFrame,
    bounds: DataFrame | None = None,
    method: str = "approx",
    accuracy: int = 1000,
) -> DataFrame:
    """Append ``anomaly`` (strictly outside the bounds) and ``anomaly_type``.

    A value exactly on a bound is ``Normal``; "high" is tested first.
    """
    if bounds is None:
        bounds = iqr_bounds(cleaned, method, accuracy)
    b = _bound_value(bounds)
    e = F.col(ENERGY)
    high = e > b["upper_bound_kwh"]
    low = e < b["lower_bound_kwh"]
    return cleaned.select(
        "*",
        F.coalesce(high | low, F.lit(False)).alias("anomaly"),
        F.when(high, F.lit(HIGH)).when(low, F.lit(LOW)).otherwise(F.lit(NORMAL)).alias(
            "anomaly_type"
        ),
    )


def anomaly_records(flagged: DataFrame, ordered: bool = True) -> DataFrame:
    """Flagged rows only, largest energy first (time, household break ties).

    The sort is a range shuffle.  Exact duplicate rows share one sort key and a
    range partitioner cannot split equal keys, so a per-row sequence number is
    the last tie-break: a hot group of identical copies is spread over many
    range partitions instead of landing in one task.  ``ordered=False`` skips
    the sort when the consumer does not need the order.
    """
    rows = flagged.filter(F.col("anomaly"))
    if ordered:
        seq = "_row_seq"
        rows = (
            rows.withColumn(seq, F.monotonically_increasing_id())
            .orderBy(F.desc(ENERGY), F.asc(TIME), F.asc(HOUSEHOLD), F.asc(seq))
            .drop(seq)
        )
    return rows


def anomaly_summary(
    cleaned: DataFrame,
    bounds: DataFrame | None = None,
    method: str = "approx",
    accuracy: int = 1000,
) -> DataFrame:
    """One row (always, also for empty input) describing the detection.

    ``total_records, q1_kwh, q3_kwh, iqr_kwh, lower_bound_kwh, upper_bound_kwh,
    anomaly_count, high_consumption_anomalies, low_consumption_anomalies,
    anomaly_percentage`` — counts come from one global aggregate, the bounds
    from the same scalar subquery the flags use.
    """
    if bounds is None:
        bounds = iqr_bounds(cleaned, method, accuracy)
    b = _bound_value(bounds)
    e = F.col(ENERGY)
    counts = cleaned.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(e > b["upper_bound_kwh"]).alias("high_consumption_anomalies"),
        F.count_if(e < b["lower_bound_kwh"]).alias("low_consumption_anomalies"),
    )
    return _summary(counts, b)


def summary_from_parts(
    bounds: DataFrame, total_records: DataFrame, records: DataFrame
) -> DataFrame:
    """:func:`anomaly_summary` from results that exist already, without another scan.

    ``bounds`` is one row, ``total_records`` one row and column, ``records`` the
    (stored) anomaly records.
    """
    b = _bound_value(bounds)
    counts = records.agg(
        F.count_if(F.col("anomaly_type") == HIGH).alias("high_consumption_anomalies"),
        F.count_if(F.col("anomaly_type") == LOW).alias("low_consumption_anomalies"),
    )
    return _summary(counts.select("*", total_records.scalar().alias("total_records")), b)


def _summary(counts: DataFrame, b: Column) -> DataFrame:
    n_anom = F.col("high_consumption_anomalies") + F.col("low_consumption_anomalies")
    total = F.col("total_records")
    return counts.select(
        total,
        *[b[c].alias(c) for c in BOUND_COLUMNS],
        n_anom.alias("anomaly_count"),
        "high_consumption_anomalies",
        "low_consumption_anomalies",
        F.when(total > 0, F.lit(100.0) * n_anom / total)
        .otherwise(F.lit(0.0))
        .alias("anomaly_percentage"),
    )


def detect_anomalies(
    cleaned: DataFrame, method: str = "approx", accuracy: int = 1000, ordered: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(anomaly_records, anomaly_summary)`` sharing one bounds plan."""
    bounds = iqr_bounds(cleaned, method, accuracy)
    records = anomaly_records(flag_anomalies(cleaned, bounds), ordered=ordered)
    return records, anomaly_summary(cleaned, bounds)


TOP_ANOMALY_COLUMNS = [TIME, HOUSEHOLD, ENERGY, "hour", "day_of_week", "anomaly_type"]


def top_anomalies(flagged: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest anomalies with their time, household and calendar."""
    return (
        flagged.filter(F.col("anomaly"))
        .orderBy(F.desc(ENERGY), F.asc(TIME), F.asc(HOUSEHOLD))
        .limit(n)
        .select(*TOP_ANOMALY_COLUMNS)
    )


def household_anomalies(flagged: DataFrame) -> DataFrame:
    """Anomalies per household: count, summed and maximum energy; most first."""
    return (
        flagged.filter(F.col("anomaly") & F.col(HOUSEHOLD).isNotNull())
        .groupBy(HOUSEHOLD)
        .agg(
            F.count(F.lit(1)).alias("anomaly_count"),
            F.sum(ENERGY).alias("anomalous_energy_kwh"),
            F.max(ENERGY).alias("maximum_anomalous_kwh"),
        )
        .orderBy(F.desc("anomaly_count"), F.asc(HOUSEHOLD))
    )


def top_anomalous_households(flagged: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` households with most anomalies (id breaks ties)."""
    return (
        household_anomalies(flagged)
        .select(HOUSEHOLD, "anomaly_count")
        .orderBy(F.desc("anomaly_count"), F.asc(HOUSEHOLD))
        .limit(n)
    )
