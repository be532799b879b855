import math

import pytest

from meterlens.operators.sampling import hash_sample
from meterlens.operators.workload import (
    workload_combined,
    workload_household,
    workload_hourly,
    workload_overall,
    workload_run,
)

from helpers import readings


def _df(spark, n=3000):
    rows = [(f"MAC{i % 37}", f"2012-01-{1 + i % 28:02d} {i % 24:02d}:{(i * 7) % 60:02d}:00", float(i % 10)) for i in range(n)]
    return readings(spark, rows).select("LCLid", "DateTime", "energy_kwh", "stdorToU")


def _keys(df):
    return {(r.LCLid, r.DateTime) for r in df.select("LCLid", "DateTime").collect()}


def test_samples_nested_and_sized(spark):
    df = _df(spark)
    s25, s50, s100 = (hash_sample(df, p) for p in (25, 50, 100))
    k25, k50, k100 = _keys(s25), _keys(s50), _keys(s100)
    assert k25 <= k50 <= k100
    assert len(k100) == 3000
    assert 0.18 < len(k25) / 3000 < 0.32


def test_sample_repartition_invariant(spark):
    df = _df(spark)
    assert _keys(hash_sample(df, 40)) == _keys(hash_sample(df.repartition(7), 40))


def test_workload_combined_equals_separate(spark):
    df = _df(spark)
    combined = {(r.level, r.hour, r.LCLid): r.total_energy_kwh for r in workload_combined(df).collect()}
    hourly = {r.hour: r.total_energy_kwh for r in workload_hourly(df).collect()}
    house = {r.LCLid: r.total_energy_kwh for r in workload_household(df).collect()}
    overall = workload_overall(df).first().total_energy_kwh
    assert {h: v for (lvl, h, _), v in combined.items() if lvl == "hour"} == hourly
    assert {k: v for (lvl, _, k), v in combined.items() if lvl == "household"} == house
    assert math.isclose(combined[("overall", None, None)], overall)


def test_workload_run_returns_timings(spark):
    df = _df(spark, 200)
    assert set(workload_run(df)) == {"workload_hourly", "workload_household", "workload_overall"}
    assert set(workload_run(df, combined=True)) == {"workload_combined"}


def test_workload_hour_from_text_time(spark):
    df = spark.createDataFrame(
        [("A", "2012-01-01 05:30:00", 1.0), ("A", "bad", 2.0)],
        "LCLid string, DateTime string, energy_kwh double",
    )
    got = {r.hour: r.total_energy_kwh for r in workload_hourly(df).collect()}
    assert got == {5: 1.0, None: 2.0}


def test_sample_bucket_equals_an_independent_hash(spark):
    """XXH64 with Spark's seed 42 over ``household || '||' || time text``, computed outside Spark."""
    xxhash = pytest.importorskip("xxhash")
    rows = [(f"MAC{i:06d}", f"2012-01-{i % 28 + 1:02d} {i % 24:02d}:30:00", 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "LCLid string, DateTime string, energy_kwh double")
    kept = {(r.LCLid, r.DateTime) for r in hash_sample(df, 25).collect()}
    assert 0 < len(kept) < 200
    for household, time, _ in rows:
        h = xxhash.xxh64_intdigest(f"{household}||{time}".encode(), 42)
        signed = h - (1 << 64) if h >> 63 else h
        assert (abs(signed) % 100 < 25) == ((household, time) in kept)
