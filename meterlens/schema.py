"""Fixed schemas and the column-role mapping.

Every source is read with an explicit ``StructType``; operators work on the
canonical reading columns below, so any readings-shaped table (an entity, a
time, a measured value) can be mapped onto them with :func:`as_readings`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical column names of a reading and of the raw feed.
HOUSEHOLD = "LCLid"
TARIFF = "stdorToU"
TIME = "DateTime"
ENERGY = "energy_kwh"
RAW_ENERGY = "KWH/hh (per half hour) "  # the trailing space is part of the name

RAW_FEED_SCHEMA = T.StructType(
    [
        T.StructField(HOUSEHOLD, T.StringType()),
        T.StructField(TARIFF, T.StringType()),
        T.StructField(TIME, T.StringType()),
        T.StructField(RAW_ENERGY, T.StringType()),
    ]
)

# A normalised message / stored document.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField(HOUSEHOLD, T.StringType()),
        T.StructField(TARIFF, T.StringType()),
        T.StructField(TIME, T.StringType()),
        T.StructField(ENERGY, T.DoubleType()),
    ]
)

CALENDAR_COLUMNS = ["date", "year", "month", "day", "hour", "day_of_week"]

CLEANED_SCHEMA = T.StructType(
    [
        T.StructField(HOUSEHOLD, T.StringType()),
        T.StructField(TARIFF, T.StringType()),
        T.StructField(TIME, T.TimestampNTZType()),
        T.StructField(ENERGY, T.DoubleType()),
        T.StructField("date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Roles:
    """Which source columns play household, tariff, time and energy."""

    household: str
    time: str
    energy: str
    tariff: str | None = None


# Role mappings for the tables this library is exercised on.
EVENTS_ROLES = Roles(household="user_id", time="ts", energy="value", tariff="event_type")
ORDERS_ROLES = Roles(household="o_custkey", time="o_orderdate", energy="o_totalprice")
LINEITEM_ROLES = Roles(household="l_suppkey", time="l_shipdate", energy="l_extendedprice")


def household_is(df: DataFrame, household) -> Column:
    """``household`` equals the row's household, compared as text.

    For an integral household column and a canonical integer text (``"42"``,
    not ``"042"``) the same test is written as a numeric equality, which the
    Parquet reader can push down and use to skip row groups; otherwise the
    column is compared in its text form.
    """
    text = str(household)
    dtype = df.schema[HOUSEHOLD].dataType
    if isinstance(dtype, T.IntegralType):
        try:
            number = int(text)
        except ValueError:
            number = None
        if number is not None and str(number) == text:
            return F.col(HOUSEHOLD) == F.lit(number).cast(dtype)
    return F.col(HOUSEHOLD).cast("string") == F.lit(text)


def _role(df: DataFrame, name: str | None) -> Column:
    return F.col(name) if name else F.lit(None).cast("string")


def as_readings(df: DataFrame, roles: Roles, keep: list[str] | None = None) -> DataFrame:
    """Project a table onto the canonical reading columns (a pure rename).

    The household keeps its source type (a long key stays a long: cheaper to
    hash and shuffle than its text form); energy is cast to double.  ``keep``
    carries extra source columns through, e.g. a row id used as a tie-break.
    """
    cols = [
        _role(df, roles.household).alias(HOUSEHOLD),
        _role(df, roles.tariff).alias(TARIFF),
        F.col(roles.time).alias(TIME),
        F.col(roles.energy).cast("double").alias(ENERGY),
    ]
    cols += [F.col(c) for c in (keep or [])]
    return df.select(*cols)
