import math

import pytest
from pyspark.sql import functions as F

from meterlens.operators import rollups as ru

from helpers import readings

ROWS = [
    ("MAC1", "2012-02-06 00:00:00", 1.0),
    ("MAC1", "2012-02-06 00:30:00", 2.0),
    ("MAC1", "2012-02-07 13:00:00", 3.0),
    ("MAC2", "2012-02-07 13:00:00", 4.0),
    ("MAC2", "2012-03-01 23:30:00", 5.5),
    ("MAC3", "2013-01-05 08:00:00", 0.25),
]


@pytest.fixture
def cleaned(spark):
    return readings(spark, ROWS)


def total(df):
    return sum(r.total_energy_kwh for r in df.collect())


def test_sums_agree_everywhere(cleaned):
    expected = sum(e for _, _, e in ROWS)
    for fn in (
        ru.hourly_consumption,
        ru.daily_consumption,
        ru.monthly_consumption,
        ru.household_consumption,
        ru.weekday_consumption,
        ru.overall_statistics,
    ):
        assert math.isclose(total(fn(cleaned)), expected)


def test_shapes_and_orders(cleaned):
    hourly = ru.hourly_consumption(cleaned).collect()
    assert [r.hour for r in hourly] == [0, 8, 13, 23]
    monthly = ru.monthly_consumption(cleaned).collect()
    assert [(r.year, r.month) for r in monthly] == [(2012, 2), (2012, 3), (2013, 1)]
    weekday = ru.weekday_consumption(cleaned).collect()
    names = [r.day_of_week for r in weekday]
    assert names == sorted(names)
    assert ru.weekday_consumption(cleaned).columns == [
        "day_of_week", "total_energy_kwh", "average_energy_kwh", "readings",
    ]


def test_household_profile(cleaned):
    rows = ru.household_consumption(cleaned).collect()
    assert [r.LCLid for r in rows] == ["MAC2", "MAC1", "MAC3"]
    mac1 = rows[1]
    assert (mac1.readings, mac1.minimum_half_hour_kwh, mac1.maximum_half_hour_kwh) == (3, 1.0, 3.0)
    assert math.isclose(mac1.average_half_hour_kwh, 2.0)
    assert math.isclose(mac1.stddev_half_hour_kwh, 1.0)
    assert rows[2].stddev_half_hour_kwh is None  # single reading -> sample stddev null


def test_overall_statistics(cleaned):
    row = ru.overall_statistics(cleaned).first()
    assert row.valid_readings == 6
    assert row.minimum_half_hour_kwh == 0.25 and row.maximum_half_hour_kwh == 5.5


def test_calendar_rollups_match_individual(cleaned):
    rollups = ru.calendar_rollups(cleaned).cache()
    for name, fn in [
        ("hourly", ru.hourly_consumption),
        ("daily", ru.daily_consumption),
        ("monthly", ru.monthly_consumption),
        ("household", ru.household_consumption),
        ("weekday", ru.weekday_consumption),
        ("overall", ru.overall_statistics),
    ]:
        split = ru.split_rollup(rollups, name)
        direct = fn(cleaned)
        assert split.columns == direct.columns, name
        got, want = split.collect(), direct.collect()
        assert len(got) == len(want), name
        for a, b in zip(got, want):
            for x, y in zip(a, b):
                if isinstance(y, float):
                    assert math.isclose(x, y, rel_tol=1e-12), (name, a, b)
                else:
                    assert x == y, (name, a, b)


def test_household_total_and_list(spark, cleaned):
    assert math.isclose(ru.household_total(cleaned.withColumnRenamed("energy_kwh", "x"), "MAC1", "x").first().x, 6.0)
    assert ru.household_total(
        cleaned.withColumnRenamed("energy_kwh", "total_energy_kwh"), "NOPE"
    ).first().total_energy_kwh == 0.0
    with_null = cleaned.union(cleaned.limit(1).withColumn("LCLid", F.lit(None).cast("string")))
    assert [r.LCLid for r in ru.household_list(with_null).collect()] == ["MAC1", "MAC2", "MAC3"]


def test_skewed_household_partial_aggregation(spark):
    # one household holds most rows: the plan aggregates map-side before the shuffle
    hot = readings(spark, [("HOT", f"2012-02-06 {h:02d}:00:00", 1.0) for h in range(24)] * 50)
    plan = ru.household_consumption(hot)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_overall_split_on_empty_input_is_one_row(cleaned):
    empty = cleaned.limit(0)
    direct = ru.overall_statistics(empty).collect()
    split = ru.split_rollup(ru.calendar_rollups(empty), "overall").collect()
    assert len(direct) == len(split) == 1
    assert split[0].valid_readings == direct[0].valid_readings == 0
    assert split[0].total_energy_kwh is None


def test_calendar_rollups_is_one_scan_one_shuffle(spark):
    import __spark_entry__ as E

    df = ru.calendar_rollups(E.events_cleaned(spark, "/root/testdata/sf0.001"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan parquet") == 1  # every rollup from one scan ...
    assert plan.count("Expand") == 1  # ... one expansion ...
    # ... of two sets, one shuffle of them and one of the small date-and-hour table
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Generate") == 1


def test_household_total_on_text_results(spark):
    text = spark.createDataFrame(
        [("MAC1", "1.5"), ("MAC1", "oops"), ("MAC1", "2"), ("MAC2", "9")],
        "LCLid string, total_energy_kwh string",
    )
    assert ru.household_total(text, "MAC1").first().total_energy_kwh == 3.5
