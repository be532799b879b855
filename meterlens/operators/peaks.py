"""Peaks, samples and other "first k by an order" operators.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: each task keeps
its own top k and only k rows per task reach the final merge, so these never
sort the whole input.  Every order carries a tie-break so results are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.operators.rollups import (
    TOTAL,
    daily_consumption,
    hourly_consumption,
    monthly_consumption,
)
from meterlens.schema import ENERGY, HOUSEHOLD, TIME


def result_peak(result: DataFrame, period: list[str], measure: str = TOTAL) -> DataFrame:
    """Row with the largest ``measure``; ties go to the earliest period."""
    order = [F.desc(measure)] + [F.asc(c) for c in period]
    return result.filter(F.col(measure).isNotNull()).orderBy(*order).limit(1)


def peak_hour(cleaned: DataFrame) -> DataFrame:
    return result_peak(hourly_consumption(cleaned), ["hour"])


def peak_day(cleaned: DataFrame) -> DataFrame:
    return result_peak(daily_consumption(cleaned), ["date"])


def peak_month(cleaned: DataFrame) -> DataFrame:
    return result_peak(monthly_consumption(cleaned), ["year", "month"])


def cleaned_sample(cleaned: DataFrame, n: int = 1000) -> DataFrame:
    """The first ``n`` cleaned readings by time (household, energy break ties)."""
    return cleaned.orderBy(F.asc(TIME), F.asc(HOUSEHOLD), F.asc(ENERGY)).limit(n)
