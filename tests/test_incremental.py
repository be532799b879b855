"""Rollups and bounds kept batch by batch against one full run."""

import json
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from meterlens.operators import incremental as inc
from meterlens.operators import rollups as ru
from meterlens.operators.anomalies import iqr_bounds
from meterlens.operators.cleaning import clean_readings
from meterlens.sinks import batches as sink
from meterlens.sinks import read_batches
from meterlens.schema import RECORD_SCHEMA
from meterlens.streaming import stream_land_batches

from helpers import plan_of, readings


def message_files(folder, start, stop, rng):
    os.makedirs(folder, exist_ok=True)
    for n in range(start, stop):
        with open(f"{folder}/{n}.json", "w") as f:
            for i in range(rng.randrange(1, 200)):
                row = {
                    "LCLid": f"M{rng.choice([1, 1, 1, n, i % 7])}",
                    "stdorToU": "Std",
                    "DateTime": rng.choice(["bad", f"2012-0{1 + i % 3}-{1 + n:02d} {i % 24:02d}:30:00"]),
                    "energy_kwh": rng.choice([None, 1e8 + rng.random(), rng.random(), i / 4]),
                }
                f.write(json.dumps(row) + "\n")
            f.write("no record\n")


def land(spark, base, **options):
    stream_land_batches(
        spark, f"{base}/in", f"{base}/landed", f"{base}/rejected", max_files_per_trigger=1,
        cells=f"{base}/cells", sketches=f"{base}/sketches", **options,
    ).awaitTermination()


def as_rows(df):
    return sorted(([None if v is None else str(v) if not isinstance(v, float) else v for v in r] for r in df.collect()), key=str)


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        for u, v in zip(x, y, strict=True):
            assert u == v or math.isclose(u, v, rel_tol=1e-9), (x, y)


def test_ten_batches_equal_one_run(spark, scratch, monkeypatch):
    rng = random.Random(8)
    message_files(f"{scratch}/in", 0, 6, rng)
    land(spark, scratch)
    before = {f for f in os.listdir(f"{scratch}/cells")}
    message_files(f"{scratch}/in", 6, 10, rng)
    real, seen = sink.move_path, []

    def stop(*args):  # the run is stopped between two of the four tables
        seen.append(args)
        if len(seen) == 6:
            raise RuntimeError("stopped")
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(sink, "move_path", stop)
        with pytest.raises(Exception, match="stopped"):
            land(spark, scratch)
    land(spark, scratch)
    assert before < set(os.listdir(f"{scratch}/cells"))
    cleaned = clean_readings(read_batches(spark, f"{scratch}/landed", RECORD_SCHEMA))
    full, kept = ru.calendar_rollups(cleaned), inc.stored_rollups(spark, f"{scratch}/cells")
    assert full.columns == kept.columns
    for name in ru.ROLLUP_SETS:
        same(as_rows(ru.split_rollup(kept, name)), as_rows(ru.split_rollup(full, name)))
    # the readings are no part of it
    assert "landed" not in plan_of(kept)

    bounds = inc.stored_bounds(spark, f"{scratch}/sketches").collect()[0]
    values = sorted(r[0] for r in cleaned.select("energy_kwh").collect())
    error = 2.3 / inc.SKETCH_K**0.9
    for level, value in ((0.25, bounds.q1_kwh), (0.75, bounds.q3_kwh)):
        low = sum(v < value for v in values) / len(values)
        high = sum(v <= value for v in values) / len(values)
        assert low - error <= level <= high + error
    day = F.col("date") == F.lit("2012-01-03").cast("date")
    some = inc.stored_bounds(spark, f"{scratch}/sketches", day).collect()[0]
    exact = iqr_bounds(cleaned.filter(day), method="exact").collect()[0]
    assert (some.q1_kwh, some.q3_kwh) == (exact.q1_kwh, exact.q3_kwh)  # few values: the sketch holds all


def test_nothing_landed(spark, scratch):
    assert inc.stored_rollups(spark, f"{scratch}/cells").count() == 0
    assert inc.stored_bounds(spark, f"{scratch}/sketches").collect()[0].q1_kwh is None


def test_large_means_keep_their_deviations(spark):
    rows = [(f"M{i % 3}", f"2012-02-{1 + i % 20:02d} {i % 24:02d}:00:00", 1e8 + (i % 7) / 8) for i in range(500)]
    cleaned = readings(spark, rows)
    direct = ru.overall_statistics(cleaned).collect()[0]
    merged = ru.split_rollup(ru.calendar_rollups(cleaned), "overall").collect()[0]
    assert direct.stddev_half_hour_kwh == pytest.approx(0.25, abs=0.01)
    assert merged.stddev_half_hour_kwh == pytest.approx(direct.stddev_half_hour_kwh, rel=1e-6)
