import math
import os

import pytest

from meterlens.operators import reports as rp
from meterlens.operators import rollups as ru
from meterlens.operators.peaks import peak_day, peak_hour, peak_month
from meterlens.plans.experiment import scalability_experiment
from meterlens.plans.pipeline import run_pipeline
from meterlens.sources import RESULT_SCHEMAS, read_result

from helpers import raw_feed, readings

ROWS = [
    ("A", "2012-01-02 05:00:00", 2.0),
    ("A", "2012-01-01 07:00:00", 2.0),
    ("B", "2012-02-01 01:00:00", 1.5),
    ("B", "2012-02-01 02:00:00", 1.0),
    ("C", "2013-03-04 23:30:00", 0.5),
]


def test_labels_and_format(spark):
    cleaned = readings(spark, ROWS)
    monthly = rp.add_period_label(ru.monthly_consumption(cleaned)).collect()
    assert [r.period for r in monthly] == ["2012-01", "2012-02", "2013-03"]
    hourly = rp.add_hour_label(ru.hourly_consumption(cleaned)).collect()
    assert hourly[0].hour_label == "01:00"
    f = rp.add_formatted(cleaned, "energy_kwh").select("energy_kwh_text").collect()
    assert {r.energy_kwh_text for r in f} == {"2.00", "1.50", "1.00", "0.50"}


def test_first_or_default(spark):
    cleaned = readings(spark, ROWS)
    first = rp.first_or_default(cleaned, "energy_kwh", 0.0, order_by=["DateTime", "LCLid"]).collect()
    assert [r.energy_kwh for r in first] == [2.0]
    empty = rp.first_or_default(cleaned.limit(0), "energy_kwh", -1.0, order_by=["DateTime"]).collect()
    assert [r.energy_kwh for r in empty] == [-1.0]


def test_overview_matches_parts(spark):
    cleaned = readings(spark, ROWS)
    o = rp.overview_report(cleaned).first()
    s = ru.overall_statistics(cleaned).first()
    assert math.isclose(o.total_energy_kwh, s.total_energy_kwh)
    assert math.isclose(o.average_half_hour_kwh, s.average_half_hour_kwh)
    assert o.peak_hour == peak_hour(cleaned).first().hour
    assert o.peak_date == peak_day(cleaned).first().date
    pm = peak_month(cleaned).first()
    assert (o.peak_year, o.peak_month) == (pm.year, pm.month)


def test_overview_empty_is_one_null_row(spark):
    rows = rp.overview_report(readings(spark, ROWS).limit(0)).collect()
    assert len(rows) == 1 and rows[0].total_energy_kwh is None


FEED = [
    (f" H{i % 6} ", "Std", f"2012-0{1 + i % 3}-{1 + i % 27:02d} {i % 24:02d}:{(i % 2) * 30:02d}:00",
     "Null" if i % 17 == 0 else str((i % 11) / 4 + (30 if i % 53 == 0 else 0)))
    for i in range(400)
] + [("H1", "Std", "bad", "1.0")]


def test_run_pipeline_writes_all_results(spark, scratch):
    from meterlens.operators.cleaning import normalize_feed

    out = os.path.join(scratch, "results")
    counts = run_pipeline(spark, normalize_feed(raw_feed(spark, FEED)), out,
                          stage_dir=os.path.join(scratch, "stage"), method="exact")
    assert counts["raw_records"] == 401
    assert counts["missing_energy_records"] == 24
    assert counts["valid_records"] == counts["total_records"] == 376
    names = set(os.listdir(out))
    assert names == {
        "hourly_consumption", "daily_consumption", "monthly_consumption",
        "household_consumption", "weekday_consumption", "overall_statistics",
        "peak_hour", "peak_day", "peak_month", "anomaly_detection", "anomaly_summary",
        "cleaned_sample",
    }
    totals = []
    for name in ["hourly_consumption", "daily_consumption", "monthly_consumption",
                 "household_consumption", "weekday_consumption", "overall_statistics"]:
        df = read_result(spark, f"{out}/{name}")
        totals.append(sum(r.total_energy_kwh for r in df.collect()))
    assert all(math.isclose(t, totals[0]) for t in totals)
    summary = read_result(spark, f"{out}/anomaly_summary").first()
    detected = read_result(spark, f"{out}/anomaly_detection")
    assert detected.count() == summary.anomaly_count > 0
    hh = read_result(spark, f"{out}/household_consumption").collect()
    assert sum(r.readings for r in hh) == summary.total_records
    assert read_result(spark, f"{out}/cleaned_sample").count() == 376


def test_scalability_experiment_shape(spark):
    prepared = readings(spark, [(f"H{i % 9}", f"2012-01-01 {i % 24:02d}:00:00", 1.0) for i in range(500)])
    res = scalability_experiment(spark, prepared.select("LCLid", "DateTime", "energy_kwh", "stdorToU"), runs=1)
    assert res.schema.simpleString() == "struct<" + ",".join(
        f"{c.split()[0]}:{c.split()[1].replace('long', 'bigint')}"
        for c in RESULT_SCHEMAS["scalability_results"].split(", ")
    ) + ">"
    rows = res.collect()
    assert [r.data_percentage for r in rows] == [25, 50, 100]
    assert rows[-1].records == 500
    assert rows[0].records <= rows[1].records <= rows[2].records


@pytest.mark.parametrize("name", sorted(RESULT_SCHEMAS))
def test_result_schemas_parse(spark, name):
    assert spark.createDataFrame([], RESULT_SCHEMAS[name]).columns


def test_cli_pipeline_and_experiment(spark, scratch):
    from meterlens.__main__ import _parser

    args = _parser().parse_args(["pipeline", "in", "out", "--quartiles", "exact"])
    assert (args.command, args.quartiles, args.result_format) == ("pipeline", "exact", "csv")
    args = _parser().parse_args(["experiment", "in", "out", "--sizes", "10,100", "--combined"])
    assert (args.sizes, args.combined) == ("10,100", True)


def test_first_or_default_missing_column(spark):
    cleaned = readings(spark, ROWS)
    assert [r.nope for r in rp.first_or_default(cleaned, "nope", 7.5).collect()] == [7.5]


def test_cli_end_to_end(spark, scratch):
    import subprocess
    import sys

    import __spark_entry__ as E
    from meterlens.plans.ingest import write_feed_files

    write_feed_files(E.events_text_feed(spark, "/root/testdata/sf0.001"), f"{scratch}/feed")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo)

    def cli(*args):
        subprocess.run([sys.executable, "-m", "meterlens", "--master", "local[2]", *args],
                       check=True, cwd=repo, env=env, timeout=600,
                       stdout=subprocess.PIPE, stderr=subprocess.DEVNULL)

    cli("feed", f"{scratch}/feed", f"{scratch}/records")
    cli("land", f"{scratch}/records", f"{scratch}/readings")
    cli("pipeline", f"{scratch}/readings", f"{scratch}/results", "--quartiles", "exact")
    landed = spark.read.parquet(f"{scratch}/readings")
    assert landed.count() == 1000
    summary = read_result(spark, f"{scratch}/results/anomaly_summary").first()
    direct = E.queries()["clean_readings"](spark, "/root/testdata/sf0.001").count()
    assert summary.total_records == direct


def test_pipeline_quality_counts_on_typed_input(spark, scratch):
    from helpers import ts

    rows = [("H1", "Std", ts("2012-01-01T00:00:00"), 1.0),
            ("H1", "Std", ts("2012-01-01T00:30:00"), None),
            ("H2", "Std", None, 2.0),
            ("H2", "Std", ts("2012-01-01T01:00:00"), 3.0)]
    typed = spark.createDataFrame(rows, "LCLid string, stdorToU string, DateTime timestamp_ntz, energy_kwh double")
    counts = run_pipeline(spark, typed, os.path.join(scratch, "out"), stage_dir=os.path.join(scratch, "st"))
    assert (counts["raw_records"], counts["missing_energy_records"], counts["valid_records"]) == (4, 1, 2)
    assert counts["total_records"] == 2


def test_run_pipeline_parquet_results(spark, scratch):
    from meterlens.operators.cleaning import normalize_feed

    out = os.path.join(scratch, "pq")
    counts = run_pipeline(spark, normalize_feed(raw_feed(spark, FEED)), out, fmt="parquet",
                          stage_dir=os.path.join(scratch, "stage_pq"), sort_anomalies=False)
    assert counts["total_records"] == 376
    overall = spark.read.parquet(f"{out}/overall_statistics").first()
    assert overall.valid_readings == 376
    detected = spark.read.parquet(f"{out}/anomaly_detection").count()
    assert detected == counts["anomaly_count"]
    assert set(counts["phase_seconds"]) == {
        "clean_stage", "rollups_bounds_sample", "results_and_anomalies", "summary",
    }


def test_cli_passes_source_and_sink_options():
    from meterlens.__main__ import _parser

    args = _parser().parse_args(["land", "-", "out", "--source-format", "kafka", "--rejects", "bad",
                                 "--option", "subscribe=t", "--option", "kafka.bootstrap.servers=h:9=x"])
    assert dict(args.option) == {"subscribe": "t", "kafka.bootstrap.servers": "h:9=x"}
    assert (args.records_dir, args.rejects) == ("-", "bad")
    args = _parser().parse_args(["feed", "in", "--sink-format", "kafka", "--checkpoint", "ck"])
    assert args.records_dir is None and args.option == []
    with pytest.raises(SystemExit):
        _parser().parse_args(["pipeline", "a", "b", "--option", "novalue"])
