from meterlens.operators import peaks as pk
from meterlens.operators.rollups import daily_consumption

from helpers import readings


def test_peaks_tie_to_earliest(spark):
    cleaned = readings(
        spark,
        [
            ("A", "2012-01-02 05:00:00", 2.0),
            ("A", "2012-01-01 07:00:00", 2.0),
            ("B", "2012-02-01 01:00:00", 1.0),
            ("B", "2012-02-01 02:00:00", 1.0),
        ],
    )
    assert pk.peak_hour(cleaned).first().hour == 5  # hours 5 and 7 tie at 2.0
    assert str(pk.peak_day(cleaned).first().date) == "2012-01-01"
    m = pk.peak_month(cleaned).first()
    assert (m.year, m.month) == (2012, 1)
    assert pk.result_peak(daily_consumption(cleaned), ["date"]).count() == 1


def test_peak_plan_is_top_k(spark):
    cleaned = readings(spark, [("A", "2012-01-01 05:00:00", 1.0)])
    plan = pk.peak_day(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_cleaned_sample_first_by_time(spark):
    rows = [("H%d" % (i % 3), f"2012-01-01 {i % 24:02d}:{(i * 7) % 60:02d}:00", float(i)) for i in range(200)]
    cleaned = readings(spark, rows)
    sample = pk.cleaned_sample(cleaned, 10).collect()
    assert len(sample) == 10
    keys = [(r.DateTime, r.LCLid) for r in sample]
    assert keys == sorted(keys)
    everything = sorted((r.DateTime, r.LCLid) for r in cleaned.collect())
    assert keys == everything[:10]
