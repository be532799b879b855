"""The typed table: results, skipped row groups, pushed filters."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from meterlens.operators import rollups as ru
from meterlens.operators.cleaning import clean_readings, select_household
from meterlens.schema import CLEANED_SCHEMA, RECORD_SCHEMA
from meterlens.sinks import between_days, ingest_totals, read_batches, read_store, store_readings
from meterlens.streaming import stream_land_batches
from meterlens.streaming.batches import STORE_COUNTS

from helpers import plan_of

DAYS, HOUSEHOLDS = 30, 40


@pytest.fixture(scope="module")
def records(spark):
    """A third of all rows belong to one household; times are text."""
    row = F.col("id")
    household = F.when(row % 3 == 0, 0).otherwise(row % HOUSEHOLDS)
    minute = F.timestamp_add("MINUTE", (row * 7919) % (DAYS * 1440), F.lit("2012-02-01 00:00:00").cast("timestamp_ntz"))
    return spark.range(60_000).select(
        F.concat(F.lit("MAC"), F.lpad(household.cast("string"), 6, "0")).alias("LCLid"),
        F.lit("Std").alias("stdorToU"),
        minute.cast("string").alias("DateTime"),
        (row % 100 / 8).alias("energy_kwh"),
    )


@pytest.fixture(scope="module")
def stored(spark, records, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    # row groups of a few hundred rows, so that this small table has many
    store_readings(clean_readings(records), path, files=6, row_group_bytes=1 << 14)
    return path


def rows_read(df):
    """Rows that the scan gave out, after whole row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_store_equals_cleaned(spark, records, stored):
    store = read_store(spark, stored)
    assert store.schema == CLEANED_SCHEMA
    assert store.exceptAll(clean_readings(records)).count() == 0
    assert store.count() == 60_000


def test_household_lookup_skips_row_groups(spark, records, stored):
    one = select_household(read_store(spark, stored), "MAC000007")
    assert one.count() == select_household(clean_readings(records), "MAC000007").count() > 0
    assert "PushedFilters: [IsNotNull(LCLid), EqualTo(LCLid,MAC000007)]" in plan_of(one)
    assert rows_read(one) < 60_000 / 4
    # between the smallest and the largest id of a row group: the Bloom filter tells
    assert rows_read(select_household(read_store(spark, stored), "MAC000007x")) < 60_000 / 4


def test_day_range_skips_files(spark, stored):
    days = read_store(spark, stored).filter(between_days(dt.date(2012, 2, 3), "2012-02-04"))
    assert days.select("date").distinct().count() == 2
    assert "GreaterThanOrEqual(date,2012-02-03)" in plan_of(days)
    assert rows_read(days) < 60_000 / 3


def test_hot_household_is_cut_into_ranges(spark, stored):
    store = read_store(spark, stored)
    hot = store.filter("LCLid = 'MAC000000'").groupBy(F.input_file_name()).count().collect()
    assert len(hot) >= 5 and max(r["count"] for r in hot) < 20_000 / 3


def test_rollups_of_the_store_need_no_parsing(spark, records, stored):
    hourly = ru.hourly_consumption(read_store(spark, stored))
    plan = plan_of(hourly)
    assert "ReadSchema: struct<energy_kwh:double,hour:int>" in plan and "Generate" not in plan
    assert hourly.collect() == ru.hourly_consumption(clean_readings(records)).collect()


def test_store_is_kept_by_the_landing_stream(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for n in range(3):
        with open(f"{scratch}/in/{n}.json", "w") as f:
            for t in ("bad", f"2012-01-0{n + 1} 00:00:00"):
                f.write(json.dumps({"LCLid": f"M{n}", "stdorToU": "S", "DateTime": t, "energy_kwh": 1.0}) + "\n")
        stream_land_batches(
            spark, f"{scratch}/in", f"{scratch}/landed", f"{scratch}/rejected", store=f"{scratch}/store"
        ).awaitTermination()
    kept = read_batches(spark, f"{scratch}/store", CLEANED_SCHEMA)
    assert sorted(r.LCLid for r in kept.collect()) == ["M0", "M1", "M2"]
    assert read_batches(spark, f"{scratch}/landed", RECORD_SCHEMA).count() == 6
    assert ingest_totals(spark, f"{scratch}/store", STORE_COUNTS).collect() == [(3,)]
