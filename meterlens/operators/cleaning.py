"""Projection, typing and cleaning of readings (all lazy, all native).

Pipeline shape::

    raw feed text --normalize_feed--> records --clean_readings--> cleaned
                                         \\--project_readings + zero_fill_energy--> prepared
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.functions import day_name, parse_energy, parse_reading_time, strip_text
from meterlens.operators.common import evaluate_once
from meterlens.schema import ENERGY, HOUSEHOLD, RAW_ENERGY, TARIFF, TIME, household_is


def normalize_feed(raw: DataFrame, energy_column: str = RAW_ENERGY) -> DataFrame:
    """Raw feed text -> reading records.

    Ids, tariff and time text are stripped like Python ``str.strip``; the energy
    text becomes a nullable double named ``energy_kwh``.  Exactly four columns.
    """
    return raw.select(
        strip_text(HOUSEHOLD).alias(HOUSEHOLD),
        strip_text(TARIFF).alias(TARIFF),
        strip_text(TIME).alias(TIME),
        parse_energy(F.col(f"`{energy_column}`")).alias(ENERGY),
    )


def add_calendar(df: DataFrame) -> DataFrame:
    """Append ``date, year, month, day, hour, day_of_week`` derived from the time.

    ``day_of_week`` is the full English day name.
    """
    t = F.col(TIME)
    return df.select(
        "*",
        F.to_date(t).alias("date"),
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"),
        F.hour(t).alias("hour"),
        day_name(t).alias("day_of_week"),
    )


def type_readings(records: DataFrame) -> DataFrame:
    """Drop the store's ``_id`` and type the time; every row is kept.

    Typed sources (time already a timestamp) pass through untouched.  Text
    sources are parsed exactly once per row
    (:func:`~meterlens.operators.common.evaluate_once`), so a later filter on the
    parsed time does not re-run the parse.  The other columns pass by the
    generator, so column pruning and ``IS NOT NULL`` filters on them still reach
    the reader.
    """
    records = records.drop("_id")
    if not isinstance(records.schema[TIME].dataType, T.StringType):
        return records
    return evaluate_once(records, TIME, parse_reading_time(TIME))


def valid_reading() -> Column:
    """A typed reading is usable: it has an energy value and a time."""
    return F.col(ENERGY).isNotNull() & F.col(TIME).isNotNull()


def clean_readings(records: DataFrame) -> DataFrame:
    """Type the time, drop rows without energy or with an unusable time, add calendar."""
    return add_calendar(type_readings(records).filter(valid_reading()))


def typed_quality_measures() -> list[Column]:
    """Data-quality counts over typed readings (usable in agg or observe)."""
    return [
        F.count(F.lit(1)).alias("raw_records"),
        F.count_if(F.col(ENERGY).isNull()).alias("missing_energy_records"),
        F.count_if(valid_reading()).alias("valid_records"),
    ]


def project_readings(records: DataFrame) -> DataFrame:
    """Keep household, time, energy and tariff; energy as double."""
    return records.select(
        F.col(HOUSEHOLD),
        F.col(TIME),
        F.col(ENERGY).cast("double").alias(ENERGY),
        F.col(TARIFF),
    )


def zero_fill_energy(records: DataFrame) -> DataFrame:
    """Missing energy becomes 0.0; every row is kept (the workload's policy)."""
    return records.withColumn(ENERGY, F.coalesce(F.col(ENERGY), F.lit(0.0)))


def prepare_workload_input(records: DataFrame) -> DataFrame:
    """``project_readings`` then ``zero_fill_energy``: the benchmark input."""
    return zero_fill_energy(project_readings(records))


def data_quality_counts(records: DataFrame) -> DataFrame:
    """One row: raw rows, rows missing energy, rows surviving cleaning (one pass)."""
    return type_readings(records).agg(*typed_quality_measures())


def coerce_result(
    result: DataFrame,
    numeric: list[str] = (),
    dates: list[str] = (),
    integers: list[str] = (),
    required: list[str] = (),
) -> DataFrame:
    """Type a text result table: bad numbers/dates become null; then drop rows
    that are null in any ``required`` column."""
    cols = []
    for field in result.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name in numeric:
            c = c.try_cast("double")
        elif field.name in integers:
            c = c.try_cast("bigint")
        elif field.name in dates:
            c = F.to_date(c.try_cast("timestamp_ntz"))
        cols.append(c.alias(field.name))
    typed = result.select(*cols)
    return typed.dropna(subset=list(required)) if required else typed


def select_household(df: DataFrame, household: str) -> DataFrame:
    """Rows of one household, compared as text."""
    return df.filter(household_is(df, household))
