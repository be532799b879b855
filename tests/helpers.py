"""Small fixture builders shared by the tests."""

from __future__ import annotations

import datetime as dt

from meterlens.operators.cleaning import add_calendar
from meterlens.schema import RAW_ENERGY

READING_DDL = "LCLid string, stdorToU string, DateTime timestamp_ntz, energy_kwh double"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def readings(spark, rows):
    """Cleaned readings from (household, time text, energy) triples."""
    data = [(h, "Std", ts(t), e) for h, t, e in rows]
    return add_calendar(spark.createDataFrame(data, READING_DDL))


def raw_feed(spark, rows):
    """Raw feed (all text) from (id, tariff, time, energy) tuples."""
    ddl = f"LCLid string, stdorToU string, DateTime string, `{RAW_ENERGY}` string"
    return spark.createDataFrame(rows, ddl)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
