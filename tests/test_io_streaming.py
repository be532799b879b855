import os

import pytest

from meterlens.operators.cleaning import normalize_feed
from meterlens.operators.reports import result_status
from meterlens.plans.ingest import feed_round_trip, write_feed_files
from meterlens.schema import RAW_ENERGY
from meterlens.sinks import publish_readings, write_result
from meterlens.sources import read_raw_feed, read_readings, read_result
from meterlens.streaming import stream_feed_to_records, stream_land_readings

from helpers import raw_feed


def test_read_raw_feed_bom_and_trailing_space(spark, scratch):
    folder = os.path.join(scratch, "feed")
    os.makedirs(folder)
    header = f"LCLid,stdorToU,DateTime,{RAW_ENERGY}\n"
    with open(os.path.join(folder, "a.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write(header + " MAC1 ,Std,2012-02-08 13:30:00.0000000,0.5\n")
    with open(os.path.join(folder, "b.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write(header + "MAC2,ToU,2012-02-08 14:00:00,Null\n")
    with open(os.path.join(folder, "ignored.txt"), "w") as fh:
        fh.write("not a feed\n")
    raw = read_raw_feed(spark, folder)
    assert raw.columns[-1] == RAW_ENERGY
    recs = {r.LCLid: r.energy_kwh for r in normalize_feed(raw).collect()}
    assert recs == {"MAC1": 0.5, "MAC2": None}


def test_write_and_read_result_roundtrip(spark, scratch):
    df = spark.createDataFrame([(0, 1.5), (1, 2.5)], "hour int, total_energy_kwh double")
    path = os.path.join(scratch, "hourly_consumption")
    write_result(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    back = read_result(spark, path)
    assert back.schema == df.schema
    assert sorted(back.collect()) == sorted(df.collect())
    assert read_result(spark, os.path.join(scratch, "missing")) is None


def test_result_status(spark, scratch):
    df = spark.createDataFrame([(0, 1.5)], "hour int, total_energy_kwh double")
    write_result(df, os.path.join(scratch, "hourly_consumption"), single_file=True)
    write_result(df.limit(0), os.path.join(scratch, "peak_hour"), single_file=True)
    got = {r.result: r.status for r in result_status(
        spark, scratch, ["hourly_consumption", "peak_hour", "daily_consumption"]
    ).collect()}
    assert got == {
        "hourly_consumption": "Available",
        "peak_hour": "Not found",
        "daily_consumption": "Not found",
    }


def test_publish_and_read_records(spark, scratch):
    recs = normalize_feed(raw_feed(spark, [("M1", "Std", "2012-01-01 00:00:00", "1.0"),
                                          ("M2", "Std", "2012-01-01 00:30:00", "Null")]))
    path = os.path.join(scratch, "records")
    publish_readings(recs, path)
    back = read_readings(spark, path, fmt="json")
    assert sorted(back.collect()) == sorted(recs.collect())


def test_stream_round_trip_equals_batch_and_is_idempotent(spark, scratch):
    rows = [(f" M{i % 5}\t", "Std", f"2012-01-01 {i % 24:02d}:00:00", "Null" if i % 4 == 0 else str(i / 10))
            for i in range(60)]
    feed = raw_feed(spark, rows)
    landed = feed_round_trip(spark, feed, base=os.path.join(scratch, "ingest"))
    expected = sorted(normalize_feed(feed).collect())
    assert sorted(landed.collect()) == expected
    # re-running both finished availableNow queries adds nothing
    base = os.path.join(scratch, "ingest")
    stream_feed_to_records(spark, f"{base}/feed", f"{base}/records",
                           checkpoint=f"{base}/_ck_records").awaitTermination()
    stream_land_readings(spark, f"{base}/records", f"{base}/landed",
                         checkpoint=f"{base}/_ck_landed").awaitTermination()
    assert spark.read.parquet(f"{base}/landed").count() == 60


def test_stream_picks_up_new_files_only(spark, scratch):
    base = os.path.join(scratch, "inc")
    feed1 = raw_feed(spark, [("A", "Std", "2012-01-01 00:00:00", "1.0")])
    write_feed_files(feed1, f"{base}/feed")
    stream_feed_to_records(spark, f"{base}/feed", f"{base}/records", checkpoint=f"{base}/ck").awaitTermination()
    extra = raw_feed(spark, [("B", "Std", "2012-01-01 00:30:00", "2.0")])
    extra.write.option("header", True).mode("append").csv(f"{base}/feed")
    q = stream_feed_to_records(spark, f"{base}/feed", f"{base}/records", checkpoint=f"{base}/ck")
    q.awaitTermination()
    got = sorted(r.LCLid for r in read_readings(spark, f"{base}/records", fmt="json").collect())
    assert got == ["A", "B"]


def test_stream_ingest_counts_are_observed(spark, scratch):
    from meterlens.streaming import INGEST_METRICS

    base = os.path.join(scratch, "obs")
    feed = raw_feed(spark, [("A", "Std", "2012-01-01 00:00:00", "1.0"),
                            ("B", "Std", "2012-01-01 00:30:00", "Null"),
                            ("C", "Std", "2012-01-01 01:00:00", "none")])
    write_feed_files(feed, f"{base}/feed")
    q = stream_feed_to_records(spark, f"{base}/feed", f"{base}/records", checkpoint=f"{base}/ck")
    q.awaitTermination()
    sent = missing = 0
    for progress in q.recentProgress:
        metrics = progress.observedMetrics.get(INGEST_METRICS)
        if metrics is not None:
            sent += metrics["records_sent"]
            missing += metrics["missing_energy_records"]
    assert (sent, missing) == (3, 2)


def test_read_raw_feed_fails_without_csv(spark, scratch):
    import pytest
    from pyspark.errors import AnalysisException

    folder = os.path.join(scratch, "empty")
    os.makedirs(folder)
    with pytest.raises(AnalysisException):
        read_raw_feed(spark, folder).count()


def test_land_in_bounded_micro_batches(spark, scratch):
    base = os.path.join(scratch, "batches")
    for i in range(3):
        recs = normalize_feed(raw_feed(spark, [(f"M{i}", "Std", "2012-01-01 00:00:00", "1.0")]))
        publish_readings(recs, f"{base}/records")
    q = stream_land_readings(spark, f"{base}/records", f"{base}/landed",
                             checkpoint=f"{base}/ck", max_files_per_trigger=1)
    q.awaitTermination()
    batches = [p for p in q.recentProgress if p.numInputRows > 0]
    assert len(batches) == 3 and all(p.numInputRows == 1 for p in batches)
    from meterlens.streaming import LANDING_METRICS

    stored = sum(p.observedMetrics[LANDING_METRICS]["records_stored"]
                 for p in q.recentProgress if LANDING_METRICS in p.observedMetrics)
    assert stored == 3
    assert spark.read.parquet(f"{base}/landed").count() == 3


def test_feed_stream_archives_processed_files(spark, scratch):
    base = os.path.join(scratch, "arch")
    write_feed_files(raw_feed(spark, [("A", "Std", "2012-01-01 00:00:00", "1.0")]), f"{base}/feed")
    written = [f for f in os.listdir(f"{base}/feed") if f.endswith(".csv")]

    def run():
        stream_feed_to_records(spark, f"{base}/feed", f"{base}/records", checkpoint=f"{base}/ck",
                               clean_source="archive", archive_dir=f"{base}/archive").awaitTermination()

    run()
    extra = raw_feed(spark, [("B", "Std", "2012-01-01 00:30:00", "2.0")])
    extra.coalesce(1).write.option("header", True).mode("append").csv(f"{base}/feed")
    run()
    assert sorted(r.LCLid for r in read_readings(spark, f"{base}/records", fmt="json").collect()) == ["A", "B"]
    archived = [f for _, _, fs in os.walk(f"{base}/archive") for f in fs if f.endswith(".csv")]
    # files of a committed batch are moved out of the listed folder
    assert set(written) <= set(archived)


def test_result_status_default_names(spark, scratch):
    df = spark.createDataFrame([(0, 1.5)], "hour int, total_energy_kwh double")
    write_result(df, os.path.join(scratch, "hourly_consumption"), single_file=True)
    exp = spark.createDataFrame([(100, 10, 0.5, 20.0)], "data_percentage int, records long, "
                                "execution_time_seconds double, throughput_records_per_second double")
    write_result(exp, os.path.join(scratch, "scalability_experiment"), single_file=True)
    got = {r.result: r.status for r in result_status(spark, scratch).collect()}
    assert len(got) == 7
    assert got["hourly_consumption"] == got["scalability_experiment"] == "Available"
    assert got["overall_statistics"] == "Not found"
    back = read_result(spark, os.path.join(scratch, "scalability_experiment"))
    assert back.schema == exp.schema


def test_kafka_source_without_connector_explains(spark):
    import pytest

    from meterlens.streaming import read_record_stream

    try:
        read_record_stream(spark, None, fmt="kafka",
                           options={"kafka.bootstrap.servers": "localhost:9", "subscribe": "t"})
    except RuntimeError as exc:  # connector absent (this image)
        assert "spark-sql-kafka" in str(exc)
    else:  # connector present: the stream is defined lazily, nothing is started
        pytest.skip("Kafka connector available")


def test_kafka_publish_without_connector_explains(spark):
    import pytest

    recs = normalize_feed(raw_feed(spark, [("A", "Std", "2012-01-01 00:00:00", "1.0")]))
    try:
        publish_readings(recs, fmt="kafka", options={"kafka.bootstrap.servers": "localhost:9", "topic": "t"})
    except RuntimeError as exc:
        assert "spark-sql-kafka" in str(exc)
    else:
        pytest.skip("Kafka connector available")


def test_missing_store_connector_explains(spark):
    import pytest

    try:
        read_readings(spark, None, fmt="mongodb", options={"connection.uri": "mongodb://localhost:9"})
    except RuntimeError as exc:
        assert "connector" in str(exc)
    else:
        pytest.skip("document-store connector available")


# header binding, default checkpoints, rejected messages, result formats


def _csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("\n".join([header, *rows]) + "\n")


def test_feed_columns_are_bound_by_header(spark, scratch):
    _csv(f"{scratch}/a.csv", "LCLid,stdorToU,DateTime,KWH/hh (per half hour) ", ["A,Std,2012-01-01 00:00:00,0.5"])
    _csv(f"{scratch}/b.csv", "more,KWH/hh (per half hour) ,DateTime,LCLid,stdorToU",
         ["x,0.25,2012-01-01 00:30:00,B,ToU"])
    rows = sorted(tuple(r) for r in read_raw_feed(spark, scratch).collect())
    assert rows == [("A", "Std", "2012-01-01 00:00:00", "0.5"), ("B", "ToU", "2012-01-01 00:30:00", "0.25")]
    _csv(f"{scratch}/c.csv", "LCLid,DateTime", ["C,2012-01-01 00:00:00"])
    with pytest.raises(ValueError, match="lacks"):
        read_raw_feed(spark, scratch)


def test_feed_stream_fails_on_another_header(spark, scratch):
    _csv(f"{scratch}/feed/a.csv", "DateTime,LCLid,stdorToU,KWH/hh (per half hour) ", ["2012-01-01 00:00:00,A,Std,1"])
    stream_feed_to_records(spark, f"{scratch}/feed", f"{scratch}/records").awaitTermination()
    got = read_readings(spark, f"{scratch}/records", fmt="json").collect()
    assert [(r.LCLid, r.energy_kwh) for r in got] == [("A", 1.0)]
    _csv(f"{scratch}/feed/b.csv", "LCLid,stdorToU,DateTime,KWH/hh (per half hour) ", ["B,Std,2012-01-01 00:00:00,1"])
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        stream_feed_to_records(spark, f"{scratch}/feed", f"{scratch}/records").awaitTermination()


def test_second_run_with_default_arguments_adds_the_new_files(spark, scratch):
    for n, household in enumerate("AB"):
        _csv(f"{scratch}/feed/{n}.csv", "LCLid,stdorToU,DateTime,KWH/hh (per half hour) ",
             [f"{household},Std,2012-01-01 00:00:00,1"])
        stream_feed_to_records(spark, f"{scratch}/feed", f"{scratch}/records").awaitTermination()
        stream_land_readings(spark, f"{scratch}/records", f"{scratch}/landed").awaitTermination()
    stored = spark.read.parquet(f"{scratch}/landed")
    assert sorted(r.LCLid for r in stored.collect()) == ["A", "B"]
    with pytest.raises(ValueError, match="checkpoint"):
        stream_feed_to_records(spark, f"{scratch}/feed", None, sink_format="kafka")


def test_messages_that_are_no_record_are_kept_aside(spark, scratch):
    from meterlens.streaming import stream_rejected_messages

    good = '{"LCLid": "A", "stdorToU": "Std", "DateTime": "2012-01-01 00:00:00", "energy_kwh": 1.5}'
    bad = ["not json", "{}", '{"LCLid": "B", "energy_kwh": "x"}', "[1]"]
    os.makedirs(f"{scratch}/records")
    with open(f"{scratch}/records/part.json", "w") as f:
        f.write("\n".join([good, *bad, '{"LCLid": "C"}']) + "\n")
    land = stream_land_readings(spark, f"{scratch}/records", f"{scratch}/landed")
    land.awaitTermination()
    assert sorted(r.LCLid for r in spark.read.parquet(f"{scratch}/landed").collect()) == ["A", "C"]
    counts = land.recentProgress[0]["observedMetrics"]["landing_counts"]
    assert (counts["records_stored"], counts["records_rejected"]) == (2, 4)
    stream_rejected_messages(spark, f"{scratch}/records", f"{scratch}/rejected").awaitTermination()
    assert sorted(r.value for r in spark.read.text(f"{scratch}/rejected").collect()) == sorted(bad)


def test_results_are_read_in_their_own_format(spark, scratch):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "hour int, total_energy_kwh double")
    write_result(df, f"{scratch}/p/hourly_consumption", fmt="parquet")
    assert read_result(spark, f"{scratch}/p/hourly_consumption", fmt="parquet").count() == 2
    status = {r.result: r.status for r in result_status(spark, f"{scratch}/p", fmt="parquet").collect()}
    assert status["hourly_consumption"] == "Available" and status["anomaly_summary"] == "Not found"
    # a result with other columns is an error, not a wrong table
    write_result(df.select("total_energy_kwh", "hour"), f"{scratch}/c/hourly_consumption")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        read_result(spark, f"{scratch}/c/hourly_consumption").collect()


def test_csv_results_keep_microseconds(spark, scratch):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00.123456' as t")
    write_result(df, f"{scratch}/times")
    assert read_result(spark, f"{scratch}/times", "t timestamp_ntz").collect() == df.collect()


def test_publish_returns_the_batch_counters(spark, scratch):
    rows = [("A", "Std", "2012-01-01 00:00:00", 1.0), ("B", "Std", "2012-01-01 00:00:00", None)]
    recs = spark.createDataFrame(rows, "LCLid string, stdorToU string, DateTime string, energy_kwh double")
    counts = publish_readings(recs, f"{scratch}/out", fmt="text")
    assert counts == {"records_sent": 2, "missing_energy_records": 1}
    publish_readings(recs, f"{scratch}/out", mode="overwrite")
    assert spark.read.json(f"{scratch}/out").count() == 2


# headers by file


def test_many_small_files_take_two_scans(spark, scratch):
    """No read per file: the jobs and scans are those of two files."""
    names = ["LCLid", "stdorToU", "DateTime", RAW_ENERGY]
    feed = f"{scratch}/feed"
    os.makedirs(feed)
    for n in range(10_000):
        turned = [*names[n % 3:], *names[:n % 3]]
        values = dict(zip(names, [f"M{n}", "Std", "2012-01-01 00:00:00", str(n)], strict=True))
        with open(f"{feed}/{n}.csv", "w", encoding="utf-8-sig" if n % 2 else "utf-8") as f:
            f.write(",".join(turned) + "\n" + ",".join(values[t] for t in turned) + "\n\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "many files")
    rows = read_raw_feed(spark, feed).collect()
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("", "")
    assert sorted((r.LCLid, r.stdorToU, r.DateTime, r[RAW_ENERGY]) for r in rows) == sorted(
        (f"M{n}", "Std", "2012-01-01 00:00:00", str(n)) for n in range(10_000)
    )
    assert jobs < 12
    plan = read_raw_feed(spark, feed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 2  # the lines, and the headers that are joined to them


def test_one_header_needs_no_join(spark, scratch):
    for n in range(3):
        _csv(f"{scratch}/{n}.csv", "DateTime,LCLid,stdorToU,KWH/hh (per half hour) ", [f"2012-01-01 00:00:00,M{n},Std,1"])
    raw = read_raw_feed(spark, scratch)
    assert "Join" not in raw._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.LCLid for r in raw.collect()) == ["M0", "M1", "M2"]


def test_odd_lines_of_a_feed(spark, scratch):
    header = 'stdorToU,"KWH/hh (per half hour) ",LCLid,DateTime'
    with open(f"{scratch}/a.csv", "w", newline="") as f:
        f.write(f'{header}\r\n"S,td",0.5,"A ""x""",t1\r\n  \r\nStd,1\r\n{header}\r\nStd,,B,t2,more\r\n')
    with open(f"{scratch}/empty.csv", "w"):
        pass
    rows = [tuple(r) for r in read_raw_feed(spark, scratch).orderBy("DateTime", "LCLid").collect()]
    assert rows == [(None, "Std", None, "1"), ('A "x"', "S,td", "t1", "0.5"), ("B", "Std", "t2", None)]


def test_split_files_keep_their_header(spark, scratch):
    """Blocks of a file that do not hold its first line are bound by it too."""
    names = ["LCLid", "stdorToU", "DateTime", RAW_ENERGY]
    for n, turned in enumerate((names, names[::-1])):
        with open(f"{scratch}/{n}.csv", "w") as f:
            f.write(",".join(turned) + "\n")
            for i in range(20_000):
                values = dict(zip(names, [f"M{n}", "Std", f"t{i}", str(i)], strict=True))
                f.write(",".join(values[t] for t in turned) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        raw = read_raw_feed(spark, scratch)
        assert raw.rdd.getNumPartitions() > 4
        got = {tuple(r) for r in raw.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == {(f"M{n}", "Std", f"t{i}", str(i)) for n in (0, 1) for i in range(20_000)}
