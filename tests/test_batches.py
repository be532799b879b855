"""Batch-keyed tables and the streams that write them: replays, restarts, exact counters."""

import os

import pytest
from pyspark.sql import functions as F

from meterlens.operators.cleaning import normalize_feed
from meterlens.schema import RAW_ENERGY, RECORD_SCHEMA
from meterlens.session import path_exists, remove_path
from meterlens.sinks import batch_counts, ingest_totals, read_batches, write_batch
from meterlens.sinks import batches as sink
from meterlens.sources import read_raw_feed
from meterlens.streaming import (
    FEED_COUNTS,
    LANDING_COUNTS,
    REJECT_COUNTS,
    publish_batch,
    stream_feed_batches,
    stream_land_batches,
)

from helpers import raw_feed

NAMES = ["LCLid", "stdorToU", "DateTime", RAW_ENERGY]
GOOD = '{"LCLid": "%s", "stdorToU": "Std", "DateTime": "2012-01-01 00:00:00", "energy_kwh": %s}'


def feed_file(folder, name, rows, turn=0, extra=False):
    os.makedirs(folder, exist_ok=True)
    order = [*NAMES[turn:], *NAMES[:turn]]
    with open(f"{folder}/{name}.csv", "w", encoding="utf-8-sig") as f:
        f.write(",".join([*order, "more"] if extra else order) + "\n")
        for row in rows:
            values = dict(zip(NAMES, row, strict=True))
            f.write(",".join([values[c] for c in order] + (["x"] if extra else [])) + "\n")


def message_file(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


def records(spark, target, fmt="json"):
    return sorted(map(tuple, read_batches(spark, target, RECORD_SCHEMA, fmt).collect()), key=str)


class Stopped(RuntimeError):
    pass


def stop_at(monkeypatch, call, name="move_path"):
    """Make the ``call``-th use of a step of the sink fail once."""
    real, seen = getattr(sink, name), []

    def step(*args):
        seen.append(args)
        if len(seen) == call:
            raise Stopped(name)
        return real(*args)

    monkeypatch.setattr(sink, name, step)


def one(*values):
    return {"n": F.count(F.lit(1))}


def test_a_batch_is_stored_once(spark, scratch):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert write_batch(df, scratch, 3, one()) == {"n": 2}
    assert write_batch(df.unionAll(df), scratch, 3, one()) == {"n": 2}  # there already
    assert write_batch(df.filter("x > 1"), scratch, 4, one()) == {"n": 1}
    assert write_batch(df.filter("false"), scratch, 5, one()) == {"n": 0}
    assert sorted(r.x for r in read_batches(spark, scratch, "x int").collect()) == [1, 2, 2]
    counts = {(r.batch_id, r.n) for r in batch_counts(spark, scratch, ["n"]).collect()}
    assert counts == {(3, 2), (4, 1), (5, 0)}
    assert ingest_totals(spark, scratch, ["n"]).collect()[0].n == 3
    assert not path_exists(spark, f"{scratch}/_staging/batch_id=3")


def test_nothing_stored_yet(spark, scratch):
    assert read_batches(spark, f"{scratch}/none", "x int").count() == 0
    assert ingest_totals(spark, f"{scratch}/none", ["n"]).collect()[0].n == 0


@pytest.mark.parametrize("call", [1, 2])
def test_stopped_while_moving(spark, scratch, monkeypatch, call):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    with monkeypatch.context() as m:
        stop_at(m, call)
        with pytest.raises(Stopped):
            write_batch(df, scratch, 0, one())
    assert read_batches(spark, scratch, "x int").count() == 0  # rows without counters do not count
    moved = set(os.listdir(f"{scratch}/batch_id=0")) if call == 2 else None
    assert write_batch(df, scratch, 0, one()) == {"n": 2}
    assert sorted(r.x for r in read_batches(spark, scratch, "x int").collect()) == [1, 2]
    # a stream that follows the table may have read moved rows: they are not written anew
    assert moved is None or moved == set(os.listdir(f"{scratch}/batch_id=0"))


def test_publishing_again_adds_nothing(spark, scratch):
    recs = normalize_feed(raw_feed(spark, [("A", "Std", "t1", "1.0"), ("B", "Std", "t2", "Null")]))
    for _ in range(2):
        assert publish_batch(recs, scratch, 7) == {"records_sent": 2, "missing_energy_records": 1}
    publish_batch(recs.limit(1), scratch, 8)
    assert len(records(spark, scratch)) == 3


def test_topic_batches_are_sent_once(spark, scratch, monkeypatch):
    from meterlens.streaming import batches

    sent = []
    monkeypatch.setattr(
        batches, "publish_readings", lambda r, path, fmt, options: sent.append(fmt) or {"records_sent": r.count()}
    )
    recs = normalize_feed(raw_feed(spark, [("A", "Std", "t1", "1.0")]))
    for _ in range(2):
        assert publish_batch(recs, scratch, 0, "kafka", {"topic": "t"}) == {"records_sent": 1}
    assert sent == ["kafka"]


def test_feed_stream_binds_each_file(spark, scratch):
    feed, target = f"{scratch}/feed", f"{scratch}/records"
    for n in range(4):
        feed_file(feed, n, [(f" M{n}\t", "Std", "2012-01-01 00:00:00", "Null" if n == 2 else str(n))], n, n % 2 == 1)
    stream_feed_batches(spark, feed, target).awaitTermination()
    feed_file(feed, "late", [("L", "ToU", "t", "9")], 2, True)
    stream_feed_batches(spark, feed, target).awaitTermination()
    stream_feed_batches(spark, feed, target).awaitTermination()  # nothing new
    assert records(spark, target) == sorted(map(tuple, normalize_feed(read_raw_feed(spark, feed)).collect()), key=str)
    assert ingest_totals(spark, target, FEED_COUNTS).collect() == [(5, 1)]


def test_feed_stream_names_a_bad_header(spark, scratch):
    feed, target = f"{scratch}/feed", f"{scratch}/records"
    feed_file(feed, "a", [("A", "Std", "t", "1")])
    with open(f"{feed}/b.csv", "w") as f:
        f.write("LCLid,DateTime\nB,t\n")
    with pytest.raises(Exception, match="lacks"):
        stream_feed_batches(spark, feed, target).awaitTermination()
    assert records(spark, target) == []
    os.remove(f"{feed}/b.csv")


def test_counters_of_many_batches_and_a_restart(spark, scratch):
    """More batches than a query's progress reports keep."""
    feed, target = f"{scratch}/feed", f"{scratch}/records"
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10")
    try:
        for start, stop in ((0, 18), (18, 30)):
            for n in range(start, stop):
                feed_file(feed, n, [(f"M{n}", "Std", "t", "Null" if n % 10 == 0 else "1")] * (1 + n % 3), n % 4)
            query = stream_feed_batches(spark, feed, target, max_files_per_trigger=1)
            query.awaitTermination()
            assert len(query.recentProgress) < stop - start
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    sent = sum(1 + n % 3 for n in range(30))
    missing = sum(1 + n % 3 for n in range(0, 30, 10))
    assert batch_counts(spark, target, FEED_COUNTS).count() == 30
    assert ingest_totals(spark, target, FEED_COUNTS).collect() == [(sent, missing)]


def land(spark, scratch, **options):
    stream_land_batches(
        spark, f"{scratch}/messages", f"{scratch}/landed", f"{scratch}/rejected", **options
    ).awaitTermination()


def landed(spark, scratch):
    good = sorted(r[0] for r in read_batches(spark, f"{scratch}/landed", RECORD_SCHEMA).collect())
    return good, sorted(r.value for r in read_batches(spark, f"{scratch}/rejected", "value string", "text").collect())


@pytest.mark.parametrize("call", [1, 2, 3, 4])  # moves of the readings and their counters, then of the rejects
def test_stopped_between_the_two_tables(spark, scratch, monkeypatch, call):
    message_file(f"{scratch}/messages", "a", [GOOD % ("A", 1.5), "no", GOOD % ("B", "null"), "{}"])
    archive = {"clean_source": "archive", "archive_dir": f"{scratch}/archive"}
    with monkeypatch.context() as m:
        stop_at(m, call)
        with pytest.raises(Exception, match="move_path"):
            land(spark, scratch, **archive)
    assert os.path.exists(f"{scratch}/messages/a.json")  # not done, so not archived
    message_file(f"{scratch}/messages", "b", [GOOD % ("C", 2), "[1]"])
    land(spark, scratch, **archive)
    land(spark, scratch, **archive)
    assert landed(spark, scratch) == (["A", "B", "C"], ["[1]", "no", "{}"])
    assert ingest_totals(spark, f"{scratch}/landed", LANDING_COUNTS).collect() == [(3, 1)]
    assert ingest_totals(spark, f"{scratch}/rejected", REJECT_COUNTS).collect() == [(3,)]


def test_lost_checkpoint_does_not_store_twice(spark, scratch):
    """The batch numbers decide: a stream that starts anew over the same files changes nothing."""
    message_file(f"{scratch}/messages", "a", [GOOD % ("A", 1), "no"])
    land(spark, scratch)
    remove_path(spark, f"{scratch}/landed/_checkpoint")
    land(spark, scratch)
    assert landed(spark, scratch) == (["A"], ["no"])


def test_feed_to_landing_end_to_end(spark, scratch):
    """The landing stream follows the record batches of the feed stream."""
    for n in range(3):
        feed_file(f"{scratch}/feed", n, [(f"M{n}", "Std", "2012-01-01 00:00:00", "1")], n)
        stream_feed_batches(spark, f"{scratch}/feed", f"{scratch}/messages").awaitTermination()
        land(spark, scratch)
    assert landed(spark, scratch) == (["M0", "M1", "M2"], [])
    assert spark.read.parquet(f"{scratch}/landed").count() == 3  # a plain reader sees whole batches
