import pytest
from pyspark.sql import functions as F

from meterlens.operators import anomalies as an

from helpers import READING_DDL, plan_of, readings


def _values(spark, values, household="H"):
    rows = [(household, f"2012-01-01 {i % 24:02d}:{i % 60:02d}:00", v) for i, v in enumerate(values)]
    return readings(spark, rows)


@pytest.mark.parametrize("method", ["approx", "exact"])
def test_empty_input_gives_one_row(spark, method):
    empty = spark.createDataFrame([], READING_DDL)
    from meterlens.operators.cleaning import add_calendar

    s = an.anomaly_summary(add_calendar(empty), method=method).collect()
    assert len(s) == 1
    row = s[0]
    assert row.total_records == 0 and row.anomaly_count == 0
    assert row.anomaly_percentage == 0.0
    assert row.lower_bound_kwh is None and row.upper_bound_kwh is None


def test_single_row(spark):
    row = an.anomaly_summary(_values(spark, [1.0]), method="exact").first()
    assert (row.total_records, row.q1_kwh, row.q3_kwh, row.iqr_kwh, row.anomaly_count) == (
        1, 1.0, 1.0, 0.0, 0,
    )


def test_all_equal_flags_nothing(spark):
    flagged = an.flag_anomalies(_values(spark, [0.3] * 20), method="exact")
    assert flagged.filter("anomaly").count() == 0
    assert {r.anomaly_type for r in flagged.collect()} == {"Normal"}


def test_high_only_and_bounds(spark):
    vals = [1.0] * 10 + [2.0] * 10 + [3.0] * 10 + [4.0] * 10 + [100.0]
    s = an.anomaly_summary(_values(spark, vals), method="exact").first()
    # discrete quartiles: smallest value whose cumulative share reaches p
    assert (s.q1_kwh, s.q3_kwh) == (2.0, 4.0)
    assert (s.lower_bound_kwh, s.upper_bound_kwh) == (-1.0, 7.0)
    assert (s.anomaly_count, s.high_consumption_anomalies, s.low_consumption_anomalies) == (1, 1, 0)
    assert s.anomaly_percentage == pytest.approx(100.0 / 41)


def test_high_and_low_with_negative_values(spark):
    vals = [0.0] * 10 + [1.0] * 20 + [2.0] * 10 + [-50.0, 60.0, 70.0]
    flagged = an.flag_anomalies(_values(spark, vals), method="exact")
    types = [r.anomaly_type for r in an.anomaly_records(flagged).collect()]
    assert types == ["High Consumption", "High Consumption", "Low Consumption"]
    s = an.anomaly_summary(_values(spark, vals), method="exact").first()
    assert (s.high_consumption_anomalies, s.low_consumption_anomalies) == (2, 1)


def test_value_on_bound_is_normal(spark):
    bounds = spark.createDataFrame(
        [(1.0, 3.0, 2.0, -2.0, 6.0)],
        "q1_kwh double, q3_kwh double, iqr_kwh double, lower_bound_kwh double, upper_bound_kwh double",
    )
    flagged = an.flag_anomalies(_values(spark, [-2.0, 6.0, -2.01, 6.01]), bounds)
    got = {r.energy_kwh: (r.anomaly, r.anomaly_type) for r in flagged.collect()}
    assert got == {
        -2.0: (False, "Normal"),
        6.0: (False, "Normal"),
        -2.01: (True, "Low Consumption"),
        6.01: (True, "High Consumption"),
    }


def test_approx_within_rank_error(spark):
    vals = [float(i % 997) for i in range(20000)]
    cleaned = _values(spark, vals)
    approx = an.iqr_bounds(cleaned, "approx", 1000).first()
    exact = an.iqr_bounds(cleaned, "exact").first()
    ordered = sorted(vals)
    n = len(ordered)

    def rank(v):
        return sum(1 for x in ordered if x <= v) / n

    assert abs(rank(approx.q1_kwh) - rank(exact.q1_kwh)) <= 0.002
    assert abs(rank(approx.q3_kwh) - rank(exact.q3_kwh)) <= 0.002


def test_household_anomalies_and_top(spark):
    rows = (
        [("A", f"2012-01-01 00:{i:02d}:00", 1.0) for i in range(30)]
        + [("B", "2012-01-02 00:00:00", 50.0), ("B", "2012-01-02 00:30:00", 60.0)]
        + [("C", "2012-01-03 00:00:00", 70.0), (None, "2012-01-03 00:00:00", 80.0)]
    )
    flagged = an.flag_anomalies(readings(spark, rows), method="exact")
    per = an.household_anomalies(flagged).collect()
    assert [(r.LCLid, r.anomaly_count, r.anomalous_energy_kwh, r.maximum_anomalous_kwh) for r in per] == [
        ("B", 2, 110.0, 60.0),
        ("C", 1, 70.0, 70.0),
    ]
    top = an.top_anomalous_households(flagged, 1).collect()
    assert [(r.LCLid, r.anomaly_count) for r in top] == [("B", 2)]
    t = an.top_anomalies(flagged, 2).collect()
    assert [r.energy_kwh for r in t] == [80.0, 70.0]
    assert list(t[0].asDict()) == an.TOP_ANOMALY_COLUMNS


def test_bounds_stay_in_plan_no_driver_roundtrip(spark):
    flagged = an.flag_anomalies(_values(spark, [1.0, 2.0, 3.0]))
    flagged.collect()
    assert "Subquery" in plan_of(flagged)


def test_detect_anomalies_pair(spark):
    records, summary = an.detect_anomalies(_values(spark, [1.0] * 10 + [2.0] * 10 + [99.0]), method="exact")
    assert records.count() == summary.first().anomaly_count == 1


def test_duplicate_hot_anomalies_spread_over_partitions(spark):
    from pyspark.sql import functions as F

    base = [("N", f"2012-01-01 00:{i % 60:02d}:00", 1.0 + (i % 3)) for i in range(600)]
    hot = [("HOT", "2012-01-02 00:00:00", 500.0)] * 100
    flagged = an.flag_anomalies(readings(spark, base + hot), method="exact")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        records = an.anomaly_records(flagged)
        sizes = records.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 100
    assert max(r["count"] for r in sizes) < 100  # the identical copies were split
    assert [r.energy_kwh for r in an.anomaly_records(flagged).collect()] == [500.0] * 100
