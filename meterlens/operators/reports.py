"""Small report tables built on the rollups (labels, formatted values, overview).

All are DataFrame -> DataFrame; the overview is one scan and one aggregate by
date and hour (no driver round trips, no joins of one-row frames).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions import format_measure as _format_measure
from meterlens.functions import hour_label as _hour_label
from meterlens.functions import period_label as _period_label
from meterlens.operators.rollups import TOTAL, calendar_cells
from meterlens.schema import ENERGY


def add_period_label(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """Append ``period`` = ``YYYY-MM``."""
    return df.withColumn("period", _period_label(year, month))


def add_hour_label(df: DataFrame, hour: str = "hour") -> DataFrame:
    """Append ``hour_label`` = ``HH:00``."""
    return df.withColumn("hour_label", _hour_label(hour))


def add_formatted(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Append ``<column>_text``: thousands separators, 2 decimals, ``0.00`` if bad."""
    return df.withColumn(name or f"{column}_text", _format_measure(column))


def first_or_default(
    df: DataFrame, column: str, default, order_by: list[str] | None = None
) -> DataFrame:
    """One row, one column: the first row's value (by ``order_by``), else ``default``.

    Always exactly one row — also for an empty frame, a null first value or a
    frame without that column — computed as a global ``min_by`` aggregate, not
    a driver-side ``first()``.
    """
    if column not in df.columns:
        return df.sparkSession.range(1).select(F.lit(default).alias(column))
    c = F.col(column)
    if order_by:
        key = F.struct(*[F.col(k) for k in order_by])
        picked = F.min_by(c, key)
    else:
        picked = F.first(c, ignorenulls=False)
    return df.agg(F.coalesce(picked, F.lit(default)).alias(column))


def overview_report(cleaned: DataFrame) -> DataFrame:
    """One row: total / average / min / max energy plus peak hour, day and month.

    One aggregate by (date, hour) over the readings; everything else comes from
    that table of at most 24 rows a day.
    """
    date = F.col("date")
    month_number = F.year(date) * F.lit(12) + F.month(date)
    levels = (
        (0, F.lit(0)),
        (1, F.col("hour")),
        (2, F.unix_date(date)),
        (3, month_number),
    )
    keys = F.explode(
        F.array(*(F.struct(F.lit(i).alias("level"), k.cast("int").alias("key")) for i, k in levels))
    )
    per = (
        calendar_cells(cleaned)
        .select(TOTAL, "n", "lo", "hi", keys.alias("k"))
        .groupBy("k.level", "k.key")
        .agg(
            F.sum(TOTAL).alias(TOTAL),
            F.sum("n").alias("n"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
    )
    total, key = F.col(TOTAL), F.col("key")

    def peak(level: int, name: str):
        """The key with the largest total; the smallest key wins a tie."""
        here = F.col("level") == level
        found = F.max_by(
            F.when(here, F.struct("key", TOTAL)), F.when(here, F.struct(total, -key))
        )
        return found.alias(name)

    overall = F.first(F.when(F.col("level") == 0, F.struct(TOTAL, "n", "lo", "hi")), ignorenulls=True)
    agg = per.agg(overall.alias("o"), peak(1, "ph"), peak(2, "pd"), peak(3, "pm"))
    # months count from 1, so December of a year is 12 * year + 12
    peak_year = F.floor((F.col("pm")["key"] - 1) / 12).cast("int")
    return agg.select(
        F.col("o")[TOTAL].alias("total_energy_kwh"),
        (F.col("o")[TOTAL] / F.col("o")["n"]).alias("average_half_hour_kwh"),
        F.col("o")["lo"].alias("minimum_half_hour_kwh"),
        F.col("o")["hi"].alias("maximum_half_hour_kwh"),
        F.col("ph")["key"].alias("peak_hour"),
        F.col("ph")[TOTAL].alias("peak_hour_energy_kwh"),
        F.date_from_unix_date(F.col("pd")["key"]).alias("peak_date"),
        F.col("pd")[TOTAL].alias("peak_day_energy_kwh"),
        peak_year.alias("peak_year"),
        (F.col("pm")["key"] - peak_year * 12).cast("int").alias("peak_month"),
        F.col("pm")[TOTAL].alias("peak_month_energy_kwh"),
    )


# The results whose availability is reported, in display order.
STATUS_RESULTS = (
    "overall_statistics",
    "hourly_consumption",
    "daily_consumption",
    "monthly_consumption",
    "household_consumption",
    "anomaly_summary",
    "scalability_experiment",
)


def result_status(
    spark: SparkSession,
    results_dir: str,
    names: tuple[str, ...] | list[str] = STATUS_RESULTS,
    fmt: str = "csv",
) -> DataFrame:
    """``(result, status)``: ``Available`` when a result exists in ``fmt`` and has rows.

    One cheap existence/emptiness probe per named result (a handful of names);
    the data itself never reaches the driver.
    """
    from meterlens.sources import read_result

    rows = []
    for name in names:
        df = read_result(spark, f"{results_dir.rstrip('/')}/{name}", fmt=fmt)
        ok = df is not None and not df.isEmpty()
        rows.append((name, "Available" if ok else "Not found"))
    return spark.createDataFrame(rows, "result string, status string")
