"""Calendar and household rollups of cleaned readings.

Every rollup is a hash aggregate with a map-side partial step, so a household
holding a third of all rows still ships one partial row per task, never its
rows.  :func:`calendar_rollups` answers all six rollups from one scan for pipelines that
need them all: each row is expanded twice (by date and hour, by household), and
the calendar rollups follow from the small date-and-hour table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.functions import day_name
from meterlens.schema import ENERGY, HOUSEHOLD, household_is

TOTAL = "total_energy_kwh"
PROFILE_COLUMNS = (
    TOTAL,
    "average_half_hour_kwh",
    "minimum_half_hour_kwh",
    "maximum_half_hour_kwh",
    "stddev_half_hour_kwh",
)


def _total() -> Column:
    return F.sum(ENERGY).alias(TOTAL)


def _profile(count_name: str) -> list[Column]:
    """The six descriptive measures of a group of half-hour readings."""
    e = F.col(ENERGY)
    return [
        F.sum(e).alias(TOTAL),
        F.avg(e).alias("average_half_hour_kwh"),
        F.min(e).alias("minimum_half_hour_kwh"),
        F.max(e).alias("maximum_half_hour_kwh"),
        F.stddev_samp(e).alias("stddev_half_hour_kwh"),
        F.count(e).alias(count_name),
    ]


def hourly_consumption(cleaned: DataFrame) -> DataFrame:
    """``hour -> total_energy_kwh``, ordered by hour."""
    return cleaned.groupBy("hour").agg(_total()).orderBy("hour")


def daily_consumption(cleaned: DataFrame) -> DataFrame:
    """``date -> total_energy_kwh``, ordered by date."""
    return cleaned.groupBy("date").agg(_total()).orderBy("date")


def monthly_consumption(cleaned: DataFrame) -> DataFrame:
    """``year, month -> total_energy_kwh``, ordered by year, month."""
    return cleaned.groupBy("year", "month").agg(_total()).orderBy("year", "month")


def household_consumption(cleaned: DataFrame) -> DataFrame:
    """Per-household profile, ordered by total descending (id breaks ties)."""
    return (
        cleaned.groupBy(HOUSEHOLD)
        .agg(*_profile("readings"))
        .orderBy(F.desc(TOTAL), F.asc(HOUSEHOLD))
    )


def weekday_consumption(cleaned: DataFrame) -> DataFrame:
    """``day_of_week -> total, average, readings``, ordered alphabetically by name."""
    return (
        cleaned.groupBy("day_of_week")
        .agg(
            _total(),
            F.avg(ENERGY).alias("average_energy_kwh"),
            F.count(ENERGY).alias("readings"),
        )
        .orderBy("day_of_week")
    )


def overall_statistics(cleaned: DataFrame) -> DataFrame:
    """One row: the household profile over all readings (``valid_readings``)."""
    return cleaned.agg(*_profile("valid_readings"))


def household_total(results: DataFrame, household: str, measure: str = TOTAL) -> DataFrame:
    """One row: total of ``measure`` over one household's rows; 0.0 when none.

    The measure is coerced to a number first (text that is not a number counts
    as missing), so this also runs on results read back as text.
    """
    rows = results.filter(household_is(results, household))
    value = F.col(measure).try_cast("double")
    return rows.agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(measure))


def household_list(df: DataFrame) -> DataFrame:
    """Distinct non-null household ids as text, ascending."""
    ids = df.select(F.col(HOUSEHOLD).cast("string").alias(HOUSEHOLD))
    return ids.na.drop().distinct().orderBy(HOUSEHOLD)


# Grouping-set names of calendar_rollups, in set order.
ROLLUP_SETS = {
    "hourly": ["hour"],
    "daily": ["date"],
    "monthly": ["year", "month"],
    "household": [HOUSEHOLD],
    "weekday": ["day_of_week"],
    "overall": [],
}
_KEYS = {
    "hour": "int", "date": "date", "year": "int", "month": "int", HOUSEHOLD: None, "day_of_week": "string",
}


def calendar_cells(cleaned: DataFrame, *more: str) -> DataFrame:
    """Sums per (date, hour): n, total, lo, hi, squares — 24 rows a day at most.

    ``squares`` is the sum of squared deviations from the cell's mean.  With
    ``more`` columns, rows per value of them come from the same scan
    (date and hour null there, ``is_cell`` false).
    """
    e = F.col(ENERGY)
    measures = [
        F.sum(e).alias(TOTAL),
        F.count(e).alias("n"),
        F.min(e).alias("lo"),
        F.max(e).alias("hi"),
        (F.var_pop(e) * F.count(e)).alias("squares"),
    ]
    if not more:
        return cleaned.groupBy("date", "hour").agg(*measures)
    keys = ["date", "hour", *more]
    gid = F.grouping_id(*[F.col(k) for k in keys])
    return cleaned.groupingSets(
        [[F.col("date"), F.col("hour")], [F.col(c) for c in more]], *keys
    ).agg(*measures, (gid < F.lit(1 << len(more))).alias("is_cell"))


CELL_COLUMNS = (TOTAL, "n", "lo", "hi", "squares")


def merge_cells(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells with the same keys as one: their sums, extremes and squared deviations.

    Deviations are taken around the merged mean, not as a difference of large
    squares, so a mean that is large against the spread costs no digits.
    """
    group = Window.partitionBy(*keys)
    n = F.nullif(F.col("n"), F.lit(0))
    mean = F.sum(TOTAL).over(group) / F.nullif(F.sum("n").over(group), F.lit(0))
    off = F.col(TOTAL) / n - F.col("_mean")
    return cells.withColumn("_mean", mean).groupBy(*keys).agg(
        F.sum(TOTAL).alias(TOTAL),
        F.sum("n").alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        (F.sum("squares") + F.coalesce(F.sum(n * off * off), F.lit(0.0))).alias("squares"),
    )


def _cell_profile(count_name: str) -> list[Column]:
    """:func:`_profile` measures of a merged cell."""
    n = F.col("n")
    return [
        F.col(TOTAL),
        (F.col(TOTAL) / F.nullif(n, F.lit(0))).alias("average_half_hour_kwh"),
        F.col("lo").alias("minimum_half_hour_kwh"),
        F.col("hi").alias("maximum_half_hour_kwh"),
        F.when(n > 1, F.sqrt(F.col("squares") / (n - 1))).alias("stddev_half_hour_kwh"),
        n.alias(count_name),
    ]


def calendar_rollups(cleaned: DataFrame) -> DataFrame:
    """All six rollups from one scan.

    Output: the six key columns (null where not grouped), ``rollup`` naming the
    set, and every measure any rollup needs.  The result is small (bounded by
    households + days + 24 + 7 + months + 1 rows), so callers persist or write
    it once and split it with :func:`split_rollup`.
    """
    return rollups_from_cells(calendar_cells(cleaned, HOUSEHOLD))


def rollups_from_cells(cells: DataFrame) -> DataFrame:
    """:func:`calendar_rollups` from the cells of ``calendar_cells(cleaned, HOUSEHOLD)``."""
    date = F.col("date")
    types = {**_KEYS, HOUSEHOLD: cells.schema[HOUSEHOLD].dataType}
    values = {
        "hour": F.col("hour"),
        "date": date,
        "year": F.year(date),
        "month": F.month(date),
        HOUSEHOLD: F.col(HOUSEHOLD),
        "day_of_week": day_name(date),
    }

    def row(name: str):
        kept = ROLLUP_SETS[name]
        keys = (
            (values[k] if k in kept else F.lit(None)).cast(t).alias(k) for k, t in types.items()
        )
        return F.struct(F.lit(name).alias("rollup"), *keys)

    calendar = [row(name) for name in ROLLUP_SETS if name != "household"]
    sets = F.when(F.col("is_cell"), F.array(*calendar)).otherwise(F.array(row("household")))
    rows = cells.select(*CELL_COLUMNS, F.explode(sets).alias("s"))
    keys = (*_KEYS, "rollup")
    rows = rows.select(*(F.col(f"s.{k}").alias(k) for k in keys), *CELL_COLUMNS)
    return merge_cells(rows, *keys).select(*_KEYS, *_cell_profile("readings"), "rollup")


def split_rollup(rollups: DataFrame, name: str) -> DataFrame:
    """One rollup, in its documented shape and order, from ``calendar_rollups``."""
    part = rollups.filter(F.col("rollup") == F.lit(name))
    if name == "hourly":
        return part.select("hour", TOTAL).orderBy("hour")
    if name == "daily":
        return part.select("date", TOTAL).orderBy("date")
    if name == "monthly":
        return part.select("year", "month", TOTAL).orderBy("year", "month")
    if name == "household":
        return part.select(
            HOUSEHOLD, TOTAL, "average_half_hour_kwh", "minimum_half_hour_kwh",
            "maximum_half_hour_kwh", "stddev_half_hour_kwh", "readings",
        ).orderBy(F.desc(TOTAL), F.asc(HOUSEHOLD))
    if name == "weekday":
        return part.select(
            "day_of_week", TOTAL,
            F.col("average_half_hour_kwh").alias("average_energy_kwh"), "readings",
        ).orderBy("day_of_week")
    if name == "overall":
        # a global aggregate over the (at most one) row: always exactly one row,
        # like overall_statistics, also when the input was empty
        return part.agg(
            *[F.max(c).alias(c) for c in (
                TOTAL, "average_half_hour_kwh", "minimum_half_hour_kwh",
                "maximum_half_hour_kwh", "stddev_half_hour_kwh",
            )],
            F.coalesce(F.max("readings"), F.lit(0)).alias("valid_readings"),
        )
    raise ValueError(f"unknown rollup {name!r}; expected one of {list(ROLLUP_SETS)}")
