"""The full analytics job: clean once, then every result from the clean stage.

Scans of data, in order:
  1. records -> cleaned stage (Parquet under shared storage); the data-quality
     counts are observed on the typed rows during this same pass (each row's
     time text is parsed once).
  2. stage -> all six rollups at once (two grouping sets, one shuffle); the small
     result is written once and split into hourly/daily/monthly/household/
     weekday/overall plus the three peaks.
  3. stage -> IQR bounds (one row, written once, then a scalar subquery).
  4. stage -> anomaly records; the summary follows from the overall rollup and
     the written records, without a scan of the stage.
  5. stage -> the first 1,000 readings by time (top-k, no full sort).
Independent passes run as concurrent jobs (see :func:`write_concurrently`).

The stage is deleted at the end unless the caller named its folder.  It is a written table, so losing an executor later costs a re-read of
the stage, not a re-run of the cleaning; nothing row-level passes through the
driver and only bounded results are coalesced to a single file.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession

from meterlens.operators import anomalies as an
from meterlens.operators import cleaning as cl
from meterlens.operators import peaks as pk
from meterlens.operators import rollups as ru
from meterlens.schema import CLEANED_SCHEMA
from meterlens.session import remove_path, scratch_path
from meterlens.sinks import write_result
from meterlens.sources import read_result

# Results whose size grows with the data (one row per household): written with
# the parallelism of their range-partitioned sort (ordered part files), never
# funnelled through one task.  All other results are bounded by the calendar or
# are single rows and are written as one file.
UNBOUNDED_RESULTS = {"household_consumption"}

ROLLUP_RESULTS = {
    "hourly": "hourly_consumption",
    "daily": "daily_consumption",
    "monthly": "monthly_consumption",
    "household": "household_consumption",
    "weekday": "weekday_consumption",
    "overall": "overall_statistics",
}


def write_concurrently(jobs: dict[str, tuple[DataFrame, dict]], max_workers: int = 8) -> None:
    """Run independent result writes as concurrent Spark jobs.

    Small outputs are dominated by per-job latency; submitting them from a few
    driver threads lets the scheduler overlap them.  Each job is still an
    ordinary, individually retried Spark write.
    """
    if not jobs:
        return
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = [pool.submit(write_result, df, path, **kw) for path, (df, kw) in jobs.items()]
        for future in futures:
            future.result()


def run_pipeline(
    spark: SparkSession,
    records: DataFrame,
    out_dir: str,
    fmt: str = "csv",
    method: str = "approx",
    accuracy: int = 1000,
    sort_anomalies: bool = True,
    sample_size: int = 1000,
    stage_dir: str | None = None,
) -> dict:
    """Run the job; write the twelve results under ``out_dir``.

    Returns the data-quality counts, the anomaly totals and ``phase_seconds``
    (wall time of each phase).
    """
    out = out_dir.rstrip("/")
    own_stage = stage_dir is None
    stage_dir = (stage_dir or scratch_path(spark, "pipeline")).rstrip("/")
    bounded = {"fmt": fmt, "single_file": True}
    phases: dict[str, float] = {}
    clock = time.perf_counter()

    def lap(name: str) -> None:
        nonlocal clock
        now = time.perf_counter()
        phases[name] = round(now - clock, 3)
        clock = now

    # 1. clean once; quality counts observed on this shuffle-free pass (a result
    #    stage: only successful task attempts contribute, so retries cannot
    #    double-count)
    quality = Observation("data_quality")
    typed = cl.type_readings(records).observe(quality, *cl.typed_quality_measures())
    cleaned = cl.add_calendar(typed.filter(cl.valid_reading()))
    cleaned.write.mode("overwrite").parquet(f"{stage_dir}/cleaned")
    stage = spark.read.parquet(f"{stage_dir}/cleaned").select(*CLEANED_SCHEMA.fieldNames())
    counts = dict(quality.get)
    lap("clean_stage")

    # 2. three independent passes over the stage: all rollups (one grouping-sets
    #    aggregate), the one-row IQR bounds, the first readings by time
    rollups_dir, bounds_dir = f"{stage_dir}/rollups", f"{stage_dir}/bounds"
    write_concurrently(
        {
            rollups_dir: (ru.calendar_rollups(stage), {"fmt": "parquet"}),
            bounds_dir: (an.iqr_bounds(stage, method, accuracy), {"fmt": "parquet"}),
            f"{out}/cleaned_sample": (pk.cleaned_sample(stage, sample_size), bounded),
        }
    )
    rollups = spark.read.parquet(rollups_dir)
    bounds = spark.read.parquet(bounds_dir)
    lap("rollups_bounds_sample")

    # 3. split the small rollup table into its results and peaks; flag
    #    anomalies against the stored bounds; summarise them — all concurrently
    results = {result: ru.split_rollup(rollups, name) for name, result in ROLLUP_RESULTS.items()}
    results["peak_hour"] = pk.result_peak(results["hourly_consumption"], ["hour"])
    results["peak_day"] = pk.result_peak(results["daily_consumption"], ["date"])
    results["peak_month"] = pk.result_peak(results["monthly_consumption"], ["year", "month"])
    jobs = {
        f"{out}/{name}": (df, {"fmt": fmt} if name in UNBOUNDED_RESULTS else bounded)
        for name, df in results.items()
    }
    flagged = an.flag_anomalies(stage, bounds)
    jobs[f"{out}/anomaly_detection"] = (
        an.anomaly_records(flagged, ordered=sort_anomalies),
        {"fmt": fmt},
    )
    write_concurrently(jobs)
    lap("results_and_anomalies")

    # 4. the summary from what is written already
    found = read_result(spark, f"{out}/anomaly_detection", fmt=fmt)
    totals = results["overall_statistics"].select("valid_readings")
    write_result(
        an.summary_from_parts(bounds, totals, found), f"{out}/anomaly_summary", **bounded
    )
    row = read_result(spark, f"{out}/anomaly_summary", fmt=fmt).first()
    counts.update({"total_records": row["total_records"], "anomaly_count": row["anomaly_count"]})
    if own_stage:
        remove_path(spark, stage_dir)
    lap("summary")
    counts["phase_seconds"] = phases
    return counts
