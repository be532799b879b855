"""

``entry(spark)`` runs the flagship query on sf0.001; ``queries()`` maps every
implemented operator to a (spark, sf_dir) -> DataFrame callable over the given
tables; ``oracle_sql()`` gives the independent DuckDB SQL for each.

Conventions shared by both sides:

* Readings come from driver tables through a role mapping: ``events`` (user_id,
  event_type, ts, value), ``orders`` (o_custkey, o_orderdate, o_totalprice) for
  multi-month rollups, ``lineitem`` (l_suppkey, l_shipdate, l_extendedprice)
  for a large daily rollup.
* The raw text feed is derived from ``events`` by one rule on both engines:
  time text has a 7-digit fraction when ``event_id % 2 = 0`` and none
  otherwise, and is ``bad`` when ``event_id % 11 = 0``; energy text is ``Null``
  when ``event_id % 13 = 0``; the id is padded with a space and a tab when
  ``event_id % 7 = 0``.
* Double sums depend on summation order, so double measures are rounded to 6
  decimals on both sides before comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.operators import anomalies as an
from meterlens.operators import cleaning as cl
from meterlens.operators import peaks as pk
from meterlens.operators import reports as rp
from meterlens.operators import rollups as ru
from meterlens.operators import sampling as sm
from meterlens.operators import workload as wl
from meterlens.schema import (
    ENERGY,
    EVENTS_ROLES,
    HOUSEHOLD,
    LINEITEM_ROLES,
    ORDERS_ROLES,
    RAW_ENERGY,
    TARIFF,
    TIME,
    as_readings,
)

SMOKE_DIR = "/root/testdata/sf0.001"
DIGITS = 6


# --------------------------------------------------------------------------
# inputs
# --------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def events_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(_table(spark, sf_dir, "events"), EVENTS_ROLES)


def orders_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(_table(spark, sf_dir, "orders"), ORDERS_ROLES)


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(_table(spark, sf_dir, "lineitem"), LINEITEM_ROLES)


def events_text_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw CSV-shaped feed (all text) derived from ``events``."""
    ev = _table(spark, sf_dir, "events")
    eid = F.col("event_id")
    uid = F.col("user_id").cast("string")
    # built from zone-free parts (date_format would route the wall-clock
    # timestamp through the session time zone)
    seconds = F.lpad(F.extract(F.lit("SECOND"), "ts").cast("decimal(8,6)").cast("string"), 9, "0")
    clock = F.format_string(
        "%s %02d:%02d:%s", F.to_date("ts").cast("string"), F.hour("ts"), F.minute("ts"), seconds
    )
    with_fraction = F.concat(clock, F.lit("0"))
    no_fraction = F.substring(clock, 1, 19)
    return ev.select(
        F.when(eid % 7 == 0, F.concat(F.lit(" "), uid, F.lit("\t"))).otherwise(uid).alias(HOUSEHOLD),
        F.col("event_type").alias(TARIFF),
        F.when(eid % 11 == 0, F.lit("bad"))
        .when(eid % 2 == 0, with_fraction)
        .otherwise(no_fraction)
        .alias(TIME),
        F.when(eid % 13 == 0, F.lit("Null"))
        .otherwise(F.col("value").cast("string"))
        .alias(RAW_ENERGY),
    )


def events_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.clean_readings(events_readings(spark, sf_dir))


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.normalize_feed(events_text_feed(spark, sf_dir))


def _rounded(df: DataFrame) -> DataFrame:
    """Round every double column (order-dependent sums) for comparison."""
    cols = [
        F.round(F.col(f"`{f.name}`"), DIGITS).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


# --------------------------------------------------------------------------
# queries
# --------------------------------------------------------------------------


def q_hourly_consumption(spark, d):
    return _rounded(ru.hourly_consumption(events_cleaned(spark, d)))


def q_daily_consumption(spark, d):
    return _rounded(ru.daily_consumption(cl.clean_readings(lineitem_readings(spark, d))))


def q_monthly_consumption(spark, d):
    return _rounded(ru.monthly_consumption(cl.clean_readings(orders_readings(spark, d))))


def q_household_consumption(spark, d):
    return _rounded(ru.household_consumption(events_cleaned(spark, d)))


def q_weekday_consumption(spark, d):
    return _rounded(ru.weekday_consumption(events_cleaned(spark, d)))


def q_overall_statistics(spark, d):
    return _rounded(ru.overall_statistics(events_cleaned(spark, d)))


def q_calendar_rollups(spark, d):
    return _rounded(ru.calendar_rollups(events_cleaned(spark, d)))


def q_peak_hour(spark, d):
    return _rounded(pk.peak_hour(events_cleaned(spark, d)))


def q_peak_day(spark, d):
    return _rounded(pk.peak_day(events_cleaned(spark, d)))


def q_peak_month(spark, d):
    return _rounded(pk.peak_month(cl.clean_readings(orders_readings(spark, d))))


def q_result_peak(spark, d):
    monthly = ru.monthly_consumption(cl.clean_readings(orders_readings(spark, d)))
    return _rounded(pk.result_peak(rp.add_period_label(monthly), ["year", "month"]))


def q_cleaned_sample(spark, d):
    return _rounded(pk.cleaned_sample(events_cleaned(spark, d)))


def q_normalize_feed(spark, d):
    return feed_records(spark, d)


def q_clean_readings(spark, d):
    return cl.clean_readings(feed_records(spark, d))


def q_add_calendar(spark, d):
    return cl.add_calendar(events_readings(spark, d))


def q_data_quality_counts(spark, d):
    return cl.data_quality_counts(feed_records(spark, d))


def q_project_readings(spark, d):
    return cl.project_readings(feed_records(spark, d))


def q_zero_fill_energy(spark, d):
    return cl.prepare_workload_input(feed_records(spark, d))


def q_coerce_result(spark, d):
    feed = events_text_feed(spark, d).select(
        F.col(TIME).alias("date"), F.col(f"`{RAW_ENERGY}`").alias("total_energy_kwh")
    )
    return cl.coerce_result(
        feed, numeric=["total_energy_kwh"], dates=["date"], required=["date", "total_energy_kwh"]
    )


def q_select_household(spark, d):
    return cl.select_household(events_cleaned(spark, d), "42")


def q_household_total(spark, d):
    daily = events_cleaned(spark, d).groupBy(HOUSEHOLD, "date").agg(
        F.sum(ENERGY).alias(ru.TOTAL)
    )
    return _rounded(ru.household_total(daily, "42"))


def q_household_list(spark, d):
    return ru.household_list(events_readings(spark, d))


def q_iqr_bounds(spark, d):
    return _rounded(an.iqr_bounds(events_cleaned(spark, d), method="exact"))


def q_anomaly_summary(spark, d):
    return _rounded(an.anomaly_summary(events_cleaned(spark, d), method="exact"))


def _flagged(spark, d):
    return an.flag_anomalies(events_cleaned(spark, d), method="exact")


def q_flag_anomalies(spark, d):
    return _flagged(spark, d)


def q_anomaly_records(spark, d):
    return an.anomaly_records(_flagged(spark, d))


def q_top_anomalies(spark, d):
    return an.top_anomalies(_flagged(spark, d))


def q_household_anomalies(spark, d):
    return _rounded(an.household_anomalies(_flagged(spark, d)))


def q_top_anomalous_households(spark, d):
    return an.top_anomalous_households(_flagged(spark, d))


def _prepared(spark, d):
    return cl.prepare_workload_input(feed_records(spark, d))


def q_workload_hourly(spark, d):
    return _rounded(wl.workload_hourly(_prepared(spark, d)))


def q_workload_household(spark, d):
    return _rounded(wl.workload_household(_prepared(spark, d)))


def q_workload_overall(spark, d):
    return _rounded(wl.workload_overall(_prepared(spark, d)))


def q_hash_sample(spark, d):
    return sm.hash_sample(events_readings(spark, d), 25)


def q_period_label(spark, d):
    monthly = ru.monthly_consumption(cl.clean_readings(orders_readings(spark, d)))
    return _rounded(rp.add_period_label(monthly))


def q_hour_label(spark, d):
    return _rounded(rp.add_hour_label(ru.hourly_consumption(events_cleaned(spark, d))))


def q_format_measure(spark, d):
    ev = events_cleaned(spark, d).select(
        HOUSEHOLD, TIME, (F.col(ENERGY) * F.lit(1000)).alias(ENERGY)
    )
    return rp.add_formatted(ev, ENERGY).drop(ENERGY)


def q_first_or_default(spark, d):
    return rp.first_or_default(events_cleaned(spark, d), ENERGY, 0.0, order_by=[TIME, HOUSEHOLD])


def q_overview_report(spark, d):
    return _rounded(rp.overview_report(events_cleaned(spark, d)))


def q_stream_land_readings(spark, d):
    from meterlens.plans.ingest import feed_round_trip

    return feed_round_trip(spark, events_text_feed(spark, d))


def q_run_pipeline(spark, d):
    """The full job over the events feed; returns its written anomaly summary."""
    from meterlens.plans.pipeline import run_pipeline
    from meterlens.session import scratch_path
    from meterlens.sources import read_result

    out = scratch_path(spark, "pipeline-results")
    run_pipeline(spark, feed_records(spark, d), out, method="exact")
    return _rounded(read_result(spark, f"{out}/anomaly_summary"))


def q_scalability_experiment(spark, d):
    from meterlens.plans.experiment import scalability_experiment

    return scalability_experiment(spark, _prepared(spark, d), runs=1)


def _scratch(spark, name):
    from meterlens.session import scratch_path

    return scratch_path(spark, name)


def q_read_raw_feed(spark, d):
    """Feed files in two column orders, one with an extra column, bound by header."""
    from meterlens.plans.ingest import write_feed_files
    from meterlens.sources import read_raw_feed

    base = _scratch(spark, "raw-feed")
    feed = events_text_feed(spark, d)
    half = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in feed.columns)), F.lit(2))
    shuffled = feed.select(F.lit("x").alias("extra"), *(F.col(f"`{c}`") for c in reversed(feed.columns)))
    write_feed_files(feed.filter(half == 0), f"{base}/a")
    write_feed_files(shuffled.filter(half == 1), f"{base}/b")
    return cl.normalize_feed(read_raw_feed(spark, f"{base}/*"))


def _published(spark, d, fmt="text"):
    from meterlens.sinks import publish_readings

    path = _scratch(spark, "published")
    return path, publish_readings(feed_records(spark, d), path, fmt=fmt)


def q_publish_readings(spark, d):
    from meterlens.sources import read_readings

    return read_readings(spark, _published(spark, d)[0], fmt="json")


def q_publish_counts(spark, d):
    counts = _published(spark, d, "json")[1]
    return spark.createDataFrame(
        [(counts["records_sent"], counts["missing_energy_records"])],
        "records_sent long, missing_energy_records long",
    )


def q_read_readings(spark, d):
    from meterlens.sinks import write_result
    from meterlens.sources import read_readings

    path = _scratch(spark, "readings")
    write_result(feed_records(spark, d), path, fmt="parquet")
    return read_readings(spark, path)


def q_readings_count(spark, d):
    return q_read_readings(spark, d).agg(F.count(F.lit(1)).alias("records"))


def q_drop_store_id(spark, d):
    with_id = feed_records(spark, d).withColumn("_id", F.monotonically_increasing_id().cast("string"))
    return cl.clean_readings(with_id)


def q_iqr_bounds_approx(spark, d):
    return _rounded(an.iqr_bounds(events_cleaned(spark, d), accuracy=FINE))


def q_anomaly_summary_approx(spark, d):
    return _rounded(an.anomaly_summary(events_cleaned(spark, d), accuracy=FINE))


#: percentile_approx accuracy whose rank error is below one row on these tables.
FINE = 10_000_000


def q_detect_anomalies(spark, d):
    return an.detect_anomalies(events_cleaned(spark, d), accuracy=FINE)[0]


def q_detect_anomalies_summary(spark, d):
    return _rounded(an.detect_anomalies(events_cleaned(spark, d), accuracy=FINE)[1])


def q_stream_land_incremental(spark, d):
    """Two runs of both ingest streams with default arguments, new files before each."""
    from meterlens.plans.ingest import write_feed_files
    from meterlens.streaming import stream_feed_to_records, stream_land_readings

    base = _scratch(spark, "incremental")
    feed = events_text_feed(spark, d)
    half = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in feed.columns)), F.lit(2))
    for n in (0, 1):
        write_feed_files(feed.filter(half == n), f"{base}/feed/part{n}")
        stream_feed_to_records(spark, f"{base}/feed/*", f"{base}/records").awaitTermination()
        stream_land_readings(spark, f"{base}/records", f"{base}/landed").awaitTermination()
    return spark.read.parquet(f"{base}/landed")


def _messages(spark, d):
    """JSON messages of the events; every 17th is no record."""
    ev = _table(spark, d, "events")
    eid = F.col("event_id")
    good = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias(HOUSEHOLD),
            F.col("event_type").alias(TARIFF),
            F.col("value").alias("energy_kwh"),
        )
    )
    bad = F.when(eid % 2 == 0, F.concat(F.lit("not json "), eid.cast("string"))).otherwise(
        F.concat(F.lit('{"other": '), eid.cast("string"), F.lit("}"))
    )
    path = _scratch(spark, "messages")
    ev.select(F.when(eid % 17 == 0, bad).otherwise(good)).write.text(path)
    return path


def q_stream_land_good_messages(spark, d):
    from meterlens.streaming import stream_land_readings

    target = _scratch(spark, "good-messages")
    stream_land_readings(spark, _messages(spark, d), target).awaitTermination()
    return spark.read.parquet(target)


def q_stream_rejected_messages(spark, d):
    from meterlens.streaming import stream_rejected_messages

    target = _scratch(spark, "rejected-messages")
    stream_rejected_messages(spark, _messages(spark, d), target).awaitTermination()
    return spark.read.text(target).withColumnRenamed("value", "message")


def _observed(query, name, fields):
    """Sums of an observed metric over a finished stream's batches."""
    rows = [p["observedMetrics"][name] for p in query.recentProgress if name in p["observedMetrics"]]
    return [sum(r[f] for r in rows) for f in fields]


def q_ingest_counts(spark, d):
    """Counters of both streams over a feed."""
    from meterlens.plans.ingest import write_feed_files
    from meterlens.streaming import stream_feed_to_records, stream_land_readings
    from meterlens.streaming.ingest import INGEST_METRICS, LANDING_METRICS

    base = _scratch(spark, "ingest-counts")
    write_feed_files(events_text_feed(spark, d), f"{base}/feed")
    feed = stream_feed_to_records(spark, f"{base}/feed", f"{base}/records")
    feed.awaitTermination()
    land = stream_land_readings(spark, f"{base}/records", f"{base}/landed")
    land.awaitTermination()
    sent = _observed(feed, INGEST_METRICS, ("records_sent", "missing_energy_records"))
    stored = _observed(land, LANDING_METRICS, ("records_stored", "records_rejected"))
    return spark.createDataFrame(
        [(*sent, *stored)],
        "records_sent long, missing_energy_records long, records_stored long, records_rejected long",
    )


def _mixed_feed(spark, d, base, parts=2):
    """The feed as files whose columns come in other orders, some with one more column."""
    from meterlens.plans.ingest import write_feed_files

    feed = events_text_feed(spark, d)
    names = [F.col(f"`{c}`") for c in feed.columns]
    part = F.pmod(F.xxhash64(*names), F.lit(parts))
    for n in range(parts):
        turned = [*names[n % 4:], *([F.lit("x").alias("extra")] if n % 2 else []), *names[:n % 4]]
        write_feed_files(feed.filter(part == n).select(*turned), f"{base}/feed/part{n}")
        yield f"{base}/feed/*"


def q_stream_feed_mixed_headers(spark, d):
    """Feed files of three headers, arriving in three runs of the batch stream."""
    from meterlens.schema import RECORD_SCHEMA
    from meterlens.sinks import read_batches
    from meterlens.streaming import stream_feed_batches

    base = _scratch(spark, "mixed-feed")
    for folder in _mixed_feed(spark, d, base, 3):
        stream_feed_batches(spark, folder, f"{base}/records").awaitTermination()
    return read_batches(spark, f"{base}/records", RECORD_SCHEMA, "json")


def q_ingest_totals(spark, d):
    """Stored counters of both batch streams, over small batches and a restart between them."""
    from meterlens.sinks import ingest_totals
    from meterlens.streaming import FEED_COUNTS, LANDING_COUNTS, REJECT_COUNTS, stream_feed_batches, stream_land_batches

    base = _scratch(spark, "ingest-totals")
    for folder in _mixed_feed(spark, d, base):
        stream_feed_batches(spark, folder, f"{base}/records", max_files_per_trigger=1).awaitTermination()
        stream_land_batches(spark, f"{base}/records", f"{base}/landed", f"{base}/rejected").awaitTermination()
    sent = ingest_totals(spark, f"{base}/records", FEED_COUNTS)
    landed = ingest_totals(spark, f"{base}/landed", LANDING_COUNTS).select("records_stored")
    rejected = ingest_totals(spark, f"{base}/rejected", REJECT_COUNTS)
    return sent.select(
        "*",
        landed.scalar().alias("records_stored"),
        rejected.scalar().alias("records_rejected"),
    )


def _replayed_landing(spark, d):
    """Messages landed in one pass; the rejects and the checkpoint are lost, and it runs again."""
    from meterlens.session import remove_path
    from meterlens.streaming import stream_land_batches

    base, source = _scratch(spark, "replay"), _messages(spark, d)
    stream_land_batches(spark, source, f"{base}/landed", f"{base}/rejected").awaitTermination()
    remove_path(spark, f"{base}/rejected")
    remove_path(spark, f"{base}/landed/_checkpoint")
    stream_land_batches(spark, source, f"{base}/landed", f"{base}/rejected").awaitTermination()
    return base


def q_land_batches_replayed(spark, d):
    from meterlens.schema import RECORD_SCHEMA
    from meterlens.sinks import read_batches

    return read_batches(spark, f"{_replayed_landing(spark, d)}/landed", RECORD_SCHEMA)


def q_land_batches_rejected(spark, d):
    from meterlens.sinks import read_batches

    rows = read_batches(spark, f"{_replayed_landing(spark, d)}/rejected", "value string", "text")
    return rows.withColumnRenamed("value", "message")


def _landed_in_batches(spark, d, n=5):
    """The feed's records landed in ``n`` batches, with rollup cells and day sketches."""
    from meterlens.streaming import stream_land_batches

    base = _scratch(spark, "incremental-rollups")
    feed_records(spark, d).select(F.to_json(F.struct("*"))).repartition(n).write.text(f"{base}/in")
    stream_land_batches(
        spark, f"{base}/in", f"{base}/landed", f"{base}/rejected", max_files_per_trigger=1,
        cells=f"{base}/cells", sketches=f"{base}/sketches",
    ).awaitTermination()
    return base


def q_incremental_rollups(spark, d):
    """All six rollups, from the cells of the landed batches."""
    from meterlens.operators.incremental import stored_rollups

    return _rounded(stored_rollups(spark, f"{_landed_in_batches(spark, d)}/cells"))


def q_sketch_bounds_checks(spark, d):
    """One row: readings in the stored sketches, and whether their quartiles' ranks are within the error."""
    from meterlens.operators.incremental import SKETCH_K, SKETCHES, stored_bounds
    from meterlens.sinks import read_batches

    base = _landed_in_batches(spark, d)
    bounds = stored_bounds(spark, f"{base}/sketches").select(F.struct("q1_kwh", "q3_kwh").alias("b")).scalar()
    held = read_batches(spark, f"{base}/sketches", SKETCHES).agg(F.sum("n").alias("n")).scalar()
    e, n, error = F.col(ENERGY), F.count(F.lit(1)), 2.3 / SKETCH_K**0.9

    def close(q, level):
        return (F.count_if(e < q) / n - error <= level) & (F.count_if(e <= q) / n + error >= level)

    # the feed gives the readings anew, as they have not been read for the bounds
    return cl.clean_readings(feed_records(spark, d)).agg(
        n.alias("valid_records"),
        close(bounds["q1_kwh"], 0.25).alias("q1_close"),
        close(bounds["q3_kwh"], 0.75).alias("q3_close"),
    ).select("valid_records", held.alias("sketched_records"), "q1_close", "q3_close")


def _store(spark, d):
    """The feed's cleaned readings as a typed table."""
    from meterlens.sinks import read_store, store_readings

    path = _scratch(spark, "store")
    store_readings(cl.clean_readings(feed_records(spark, d)), path, files=8)
    return read_store(spark, path)


def q_store_household(spark, d):
    return cl.select_household(_store(spark, d), "42")


def q_store_hourly(spark, d):
    """Hourly consumption of ten days, from the typed table."""
    from meterlens.sinks import between_days

    days = _store(spark, d).filter(between_days("2024-01-05", "2024-01-14"))
    return _rounded(ru.hourly_consumption(days))


def q_publish_batch_twice(spark, d):
    from meterlens.schema import RECORD_SCHEMA
    from meterlens.sinks import read_batches
    from meterlens.streaming import publish_batch

    target = _scratch(spark, "published-batch")
    for _ in range(2):
        publish_batch(feed_records(spark, d), target, 0)
    return read_batches(spark, target, RECORD_SCHEMA, "json")


def q_result_status(spark, d):
    """Availability of results written as CSV and as Parquet, one of them empty, others missing."""
    from meterlens.sinks import write_result

    cleaned = events_cleaned(spark, d)
    found = []
    for fmt in ("csv", "parquet"):
        base = _scratch(spark, f"status-{fmt}")
        write_result(ru.hourly_consumption(cleaned), f"{base}/hourly_consumption", fmt=fmt)
        write_result(ru.overall_statistics(cleaned), f"{base}/overall_statistics", fmt=fmt)
        empty = ru.daily_consumption(cleaned.filter("false"))
        write_result(empty, f"{base}/daily_consumption", fmt=fmt)
        found.append(rp.result_status(spark, base, fmt=fmt).withColumn("format", F.lit(fmt)))
    return found[0].unionByName(found[1])


def q_hash_sample_checks(spark, d):
    """One row: rows, rows outside the bucket range, nesting violations, differences after a repartition."""
    from meterlens.functions import sample_bucket

    readings = events_readings(spark, d)
    bucket = sample_bucket(F.col(HOUSEHOLD), F.col(TIME).cast("string"))
    row = F.xxhash64(*readings.columns)
    again = readings.repartition(7, TIME)

    def digest(df, pct):
        return sm.hash_sample(df, pct).agg(F.bit_xor(row).alias("x"), F.count("*").alias("n"))

    small, large = sm.hash_sample(readings, 25), sm.hash_sample(readings, 50)
    nested = small.exceptAll(large).agg(F.count("*").alias("nesting_violations"))
    a, b = digest(readings, 25), digest(again, 25)
    same = a.select(F.struct("x", "n").alias("s")).scalar() == b.select(F.struct("x", "n").alias("s")).scalar()
    return readings.agg(
        F.count("*").alias("total_records"),
        F.count_if((bucket < 0) | (bucket > 99)).alias("outside_range"),
    ).select(
        "total_records",
        "outside_range",
        nested.scalar().alias("nesting_violations"),
        F.when(same, F.lit(0)).otherwise(F.lit(1)).alias("repartition_differences"),
    )


def q_workload_run(spark, d):
    timings = wl.workload_run(_prepared(spark, d))
    return spark.createDataFrame([(k, v > 0) for k, v in timings.items()], "query string, timed boolean")


def q_scalability_written(spark, d):
    """The experiment's written result: sizes, rows at 100 percent, and that all was timed."""
    from meterlens.plans.experiment import scalability_experiment
    from meterlens.sinks import write_result
    from meterlens.sources import read_result

    path = f"{_scratch(spark, 'experiment')}/scalability_results"
    write_result(scalability_experiment(spark, _prepared(spark, d), runs=1), path, single_file=True)
    size = F.col("data_percentage")
    return read_result(spark, path).select(
        size,
        F.when(size == 100, F.col("records")).alias("full_records"),
        (F.col("execution_time_seconds") > 0).alias("timed"),
        (F.col("throughput_records_per_second") > 0).alias("has_throughput"),
    )


def _pipeline_result(name):
    """One dataset of the full job, which runs anew, read from the files that it wrote."""

    def query(spark, d):
        from meterlens.plans.pipeline import run_pipeline
        from meterlens.sources import read_result

        out = _scratch(spark, "pipeline-results")
        run_pipeline(spark, feed_records(spark, d), out, method="exact")
        return _rounded(read_result(spark, f"{out}/{name}"))

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_consumption": q_hourly_consumption,
    "daily_consumption": q_daily_consumption,
    "monthly_consumption": q_monthly_consumption,
    "household_consumption": q_household_consumption,
    "weekday_consumption": q_weekday_consumption,
    "overall_statistics": q_overall_statistics,
    "calendar_rollups": q_calendar_rollups,
    "peak_hour": q_peak_hour,
    "peak_day": q_peak_day,
    "peak_month": q_peak_month,
    "result_peak": q_result_peak,
    "cleaned_sample": q_cleaned_sample,
    "normalize_feed": q_normalize_feed,
    "clean_readings": q_clean_readings,
    "add_calendar": q_add_calendar,
    "data_quality_counts": q_data_quality_counts,
    "project_readings": q_project_readings,
    "zero_fill_energy": q_zero_fill_energy,
    "coerce_result": q_coerce_result,
    "select_household": q_select_household,
    "household_total": q_household_total,
    "household_list": q_household_list,
    "iqr_bounds": q_iqr_bounds,
    "anomaly_summary": q_anomaly_summary,
    "flag_anomalies": q_flag_anomalies,
    "anomaly_records": q_anomaly_records,
    "top_anomalies": q_top_anomalies,
    "household_anomalies": q_household_anomalies,
    "top_anomalous_households": q_top_anomalous_households,
    "workload_hourly": q_workload_hourly,
    "workload_household": q_workload_household,
    "workload_overall": q_workload_overall,
    "hash_sample": q_hash_sample,
    "period_label": q_period_label,
    "hour_label": q_hour_label,
    "format_measure": q_format_measure,
    "first_or_default": q_first_or_default,
    "overview_report": q_overview_report,
    "stream_land_readings": q_stream_land_readings,
    "run_pipeline": q_run_pipeline,
    "scalability_experiment": q_scalability_experiment,
    "read_raw_feed": q_read_raw_feed,
    "publish_readings": q_publish_readings,
    "publish_counts": q_publish_counts,
    "read_readings": q_read_readings,
    "readings_count": q_readings_count,
    "drop_store_id": q_drop_store_id,
    "iqr_bounds_approx": q_iqr_bounds_approx,
    "anomaly_summary_approx": q_anomaly_summary_approx,
    "detect_anomalies": q_detect_anomalies,
    "detect_anomalies_summary": q_detect_anomalies_summary,
    "stream_land_incremental": q_stream_land_incremental,
    "stream_land_good_messages": q_stream_land_good_messages,
    "stream_rejected_messages": q_stream_rejected_messages,
    "ingest_counts": q_ingest_counts,
    "stream_feed_mixed_headers": q_stream_feed_mixed_headers,
    "ingest_totals": q_ingest_totals,
    "land_batches_replayed": q_land_batches_replayed,
    "land_batches_rejected": q_land_batches_rejected,
    "publish_batch_twice": q_publish_batch_twice,
    "store_household": q_store_household,
    "store_hourly": q_store_hourly,
    "incremental_rollups": q_incremental_rollups,
    "sketch_bounds_checks": q_sketch_bounds_checks,
    "result_status": q_result_status,
    "hash_sample_checks": q_hash_sample_checks,
    "workload_run": q_workload_run,
    "scalability_written": q_scalability_written,
}
PIPELINE_RESULTS = (
    "hourly_consumption", "daily_consumption", "monthly_consumption", "household_consumption",
    "weekday_consumption", "overall_statistics", "peak_hour", "peak_day", "peak_month",
    "anomaly_summary", "anomaly_detection", "cleaned_sample",
)
QUERIES.update({f"pipeline_{name}": _pipeline_result(name) for name in PIPELINE_RESULTS})


# The training-data operators and their pipeline are an optional part.
ORACLE_LLM: dict[str, str] = {}
try:
    from meterlens.llm.queries import ORACLE as _llm_oracle
    from meterlens.llm.queries import QUERIES as _llm_queries

    QUERIES.update(_llm_queries)
    ORACLE_LLM.update(_llm_oracle)
except ModuleNotFoundError:
    pass
try:
    import corpus_pipeline

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        ORACLE_LLM["pipeline"] = corpus_pipeline.ORACLE_SQL
except ModuleNotFoundError:
    pass


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: per-household consumption profile of the sf0.001 readings."""
    return q_household_consumption(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


# --------------------------------------------------------------------------
# oracle SQL (DuckDB)
# --------------------------------------------------------------------------

_FEED = """
feed AS (
  SELECT
    CASE WHEN event_id % 7 = 0 THEN ' ' || CAST(user_id AS VARCHAR) || chr(9)
         ELSE CAST(user_id AS VARCHAR) END AS LCLid,
    event_type AS stdorToU,
    CASE WHEN event_id % 11 = 0 THEN 'bad'
         WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '0'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS DateTime,
    CASE WHEN event_id % 13 = 0 THEN 'Null' ELSE CAST(value AS VARCHAR) END AS energy_text
  FROM events
),
records AS (
  SELECT
    trim(LCLid, ' ' || chr(9)) AS LCLid,
    trim(stdorToU, ' ' || chr(9)) AS stdorToU,
    trim(DateTime, ' ' || chr(9)) AS DateTime,
    CASE WHEN lower(trim(energy_text)) IN ('null', 'none', '') THEN NULL
         WHEN isfinite(try_cast(trim(energy_text) AS DOUBLE))
         THEN try_cast(trim(energy_text) AS DOUBLE) END AS energy_kwh
  FROM feed
)"""

_CAL = """
    CAST(DateTime AS DATE) AS date,
    CAST(year(DateTime) AS INTEGER) AS year,
    CAST(month(DateTime) AS INTEGER) AS month,
    CAST(day(DateTime) AS INTEGER) AS day,
    CAST(hour(DateTime) AS INTEGER) AS hour,
    dayname(DateTime) AS day_of_week"""

_EV = f"""
ev AS (
  SELECT user_id AS LCLid, event_type AS stdorToU, ts AS DateTime, value AS energy_kwh
  FROM events
),
cleaned AS (
  SELECT *, {_CAL}
  FROM ev WHERE energy_kwh IS NOT NULL AND DateTime IS NOT NULL
)"""

_ORD = f"""
cleaned AS (
  SELECT o_custkey AS LCLid, o_orderdate AS DateTime, o_totalprice AS energy_kwh, {_CAL}
  FROM (SELECT *, o_orderdate AS DateTime FROM orders) o
  WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL
)"""

_BOUNDS = """
q AS (
  SELECT quantile_disc(energy_kwh, 0.25) AS q1_kwh, quantile_disc(energy_kwh, 0.75) AS q3_kwh
  FROM cleaned
),
bounds AS (
  SELECT q1_kwh, q3_kwh, q3_kwh - q1_kwh AS iqr_kwh,
         q1_kwh - 1.5 * (q3_kwh - q1_kwh) AS lower_bound_kwh,
         q3_kwh + 1.5 * (q3_kwh - q1_kwh) AS upper_bound_kwh
  FROM q
),
flagged AS (
  SELECT c.*,
         coalesce(c.energy_kwh > b.upper_bound_kwh OR c.energy_kwh < b.lower_bound_kwh, false)
           AS anomaly,
         CASE WHEN c.energy_kwh > b.upper_bound_kwh THEN 'High Consumption'
              WHEN c.energy_kwh < b.lower_bound_kwh THEN 'Low Consumption'
              ELSE 'Normal' END AS anomaly_type
  FROM cleaned c, bounds b
)"""

_PROFILE = """
    round(sum(energy_kwh), 6) AS total_energy_kwh,
    round(avg(energy_kwh), 6) AS average_half_hour_kwh,
    round(min(energy_kwh), 6) AS minimum_half_hour_kwh,
    round(max(energy_kwh), 6) AS maximum_half_hour_kwh,
    round(stddev_samp(energy_kwh), 6) AS stddev_half_hour_kwh"""

_FEED_PREPARED = """
prepared AS (
  SELECT LCLid, DateTime, coalesce(energy_kwh, 0.0) AS energy_kwh, stdorToU FROM records
)"""

_FEED_CLEANED = f"""
typed AS (
  SELECT LCLid, stdorToU, try_cast(DateTime AS TIMESTAMP) AS DateTime, energy_kwh FROM records
),
cleaned AS (
  SELECT *, {_CAL} FROM typed WHERE energy_kwh IS NOT NULL AND DateTime IS NOT NULL
)"""

ORACLE: dict[str, str] = {
    "hourly_consumption": f"""
WITH {_EV}
SELECT hour, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned GROUP BY hour""",
    "daily_consumption": """
SELECT CAST(l_shipdate AS DATE) AS date, round(sum(l_extendedprice), 6) AS total_energy_kwh
FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_shipdate IS NOT NULL
GROUP BY CAST(l_shipdate AS DATE)""",
    "monthly_consumption": f"""
WITH {_ORD}
SELECT year, month, round(sum(energy_kwh), 6) AS total_energy_kwh
FROM cleaned GROUP BY year, month""",
    "household_consumption": f"""
WITH {_EV}
SELECT LCLid, {_PROFILE}, count(energy_kwh) AS readings FROM cleaned GROUP BY LCLid""",
    "weekday_consumption": f"""
WITH {_EV}
SELECT day_of_week, round(sum(energy_kwh), 6) AS total_energy_kwh,
       round(avg(energy_kwh), 6) AS average_energy_kwh, count(energy_kwh) AS readings
FROM cleaned GROUP BY day_of_week""",
    "overall_statistics": f"""
WITH {_EV}
SELECT {_PROFILE}, count(energy_kwh) AS valid_readings FROM cleaned""",
    "calendar_rollups": f"""
WITH {_EV},
sets AS (
  SELECT 'hourly' AS rollup, hour, NULL::DATE AS date, NULL::INTEGER AS year,
         NULL::INTEGER AS month, NULL::BIGINT AS LCLid, NULL::VARCHAR AS day_of_week, energy_kwh
  FROM cleaned
  UNION ALL SELECT 'daily', NULL, date, NULL, NULL, NULL, NULL, energy_kwh FROM cleaned
  UNION ALL SELECT 'monthly', NULL, NULL, year, month, NULL, NULL, energy_kwh FROM cleaned
  UNION ALL SELECT 'household', NULL, NULL, NULL, NULL, LCLid, NULL, energy_kwh FROM cleaned
  UNION ALL SELECT 'weekday', NULL, NULL, NULL, NULL, NULL, day_of_week, energy_kwh FROM cleaned
  UNION ALL SELECT 'overall', NULL, NULL, NULL, NULL, NULL, NULL, energy_kwh FROM cleaned
)
SELECT hour, date, year, month, LCLid, day_of_week, {_PROFILE},
       count(energy_kwh) AS readings, rollup
FROM sets GROUP BY rollup, hour, date, year, month, LCLid, day_of_week""",
    "peak_hour": f"""
WITH {_EV}
SELECT hour, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned GROUP BY hour
ORDER BY sum(energy_kwh) DESC, hour LIMIT 1""",
    "peak_day": f"""
WITH {_EV}
SELECT date, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned GROUP BY date
ORDER BY sum(energy_kwh) DESC, date LIMIT 1""",
    "peak_month": f"""
WITH {_ORD}
SELECT year, month, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned
GROUP BY year, month ORDER BY sum(energy_kwh) DESC, year, month LIMIT 1""",
    "result_peak": f"""
WITH {_ORD}
SELECT year, month, round(sum(energy_kwh), 6) AS total_energy_kwh,
       CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period
FROM cleaned GROUP BY year, month ORDER BY sum(energy_kwh) DESC, year, month LIMIT 1""",
    "cleaned_sample": f"""
WITH {_EV}
SELECT * FROM cleaned ORDER BY DateTime, LCLid, energy_kwh LIMIT 1000""",
    "normalize_feed": f"""
WITH {_FEED}
SELECT * FROM records""",
    "clean_readings": f"""
WITH {_FEED}, {_FEED_CLEANED}
SELECT * FROM cleaned""",
    "add_calendar": f"""
WITH {_EV}
SELECT *, {_CAL} FROM ev""",
    "data_quality_counts": f"""
WITH {_FEED}
SELECT count(*) AS raw_records,
       CAST(sum(CASE WHEN energy_kwh IS NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS missing_energy_records,
       CAST(sum(CASE WHEN energy_kwh IS NOT NULL
                      AND try_cast(DateTime AS TIMESTAMP) IS NOT NULL THEN 1 ELSE 0 END)
            AS BIGINT) AS valid_records
FROM records""",
    "project_readings": f"""
WITH {_FEED}
SELECT LCLid, DateTime, energy_kwh, stdorToU FROM records""",
    "zero_fill_energy": f"""
WITH {_FEED}, {_FEED_PREPARED}
SELECT * FROM prepared""",
    "coerce_result": f"""
WITH {_FEED}
SELECT CAST(try_cast(DateTime AS TIMESTAMP) AS DATE) AS date,
       try_cast(energy_text AS DOUBLE) AS total_energy_kwh
FROM feed
WHERE try_cast(DateTime AS TIMESTAMP) IS NOT NULL
  AND try_cast(energy_text AS DOUBLE) IS NOT NULL""",
    "select_household": f"""
WITH {_EV}
SELECT * FROM cleaned WHERE CAST(LCLid AS VARCHAR) = '42'""",
    "household_total": f"""
WITH {_EV}
SELECT round(coalesce(sum(energy_kwh), 0.0), 6) AS total_energy_kwh
FROM cleaned WHERE CAST(LCLid AS VARCHAR) = '42'""",
    "household_list": """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS LCLid FROM events WHERE user_id IS NOT NULL""",
    "iqr_bounds": f"""
WITH {_EV}, {_BOUNDS}
SELECT round(q1_kwh, 6) AS q1_kwh, round(q3_kwh, 6) AS q3_kwh, round(iqr_kwh, 6) AS iqr_kwh,
       round(lower_bound_kwh, 6) AS lower_bound_kwh,
       round(upper_bound_kwh, 6) AS upper_bound_kwh
FROM bounds""",
    "anomaly_summary": f"""
WITH {_EV}, {_BOUNDS},
counts AS (
  SELECT count(*) AS total_records,
         count(*) FILTER (WHERE anomaly_type = 'High Consumption') AS high_consumption_anomalies,
         count(*) FILTER (WHERE anomaly_type = 'Low Consumption') AS low_consumption_anomalies
  FROM flagged
)
SELECT total_records, round(q1_kwh, 6) AS q1_kwh, round(q3_kwh, 6) AS q3_kwh,
       round(iqr_kwh, 6) AS iqr_kwh, round(lower_bound_kwh, 6) AS lower_bound_kwh,
       round(upper_bound_kwh, 6) AS upper_bound_kwh,
       high_consumption_anomalies + low_consumption_anomalies AS anomaly_count,
       high_consumption_anomalies, low_consumption_anomalies,
       round(CASE WHEN total_records > 0
                  THEN 100.0 * (high_consumption_anomalies + low_consumption_anomalies)
                       / total_records
                  ELSE 0.0 END, 6) AS anomaly_percentage
FROM counts, bounds""",
    "flag_anomalies": f"""
WITH {_EV}, {_BOUNDS}
SELECT * FROM flagged""",
    "anomaly_records": f"""
WITH {_EV}, {_BOUNDS}
SELECT * FROM flagged WHERE anomaly""",
    "top_anomalies": f"""
WITH {_EV}, {_BOUNDS}
SELECT DateTime, LCLid, energy_kwh, hour, day_of_week, anomaly_type
FROM flagged WHERE anomaly ORDER BY energy_kwh DESC, DateTime, LCLid LIMIT 10""",
    "household_anomalies": f"""
WITH {_EV}, {_BOUNDS}
SELECT LCLid, count(*) AS anomaly_count, round(sum(energy_kwh), 6) AS anomalous_energy_kwh,
       round(max(energy_kwh), 6) AS maximum_anomalous_kwh
FROM flagged WHERE anomaly AND LCLid IS NOT NULL GROUP BY LCLid""",
    "top_anomalous_households": f"""
WITH {_EV}, {_BOUNDS}
SELECT LCLid, count(*) AS anomaly_count
FROM flagged WHERE anomaly AND LCLid IS NOT NULL GROUP BY LCLid
ORDER BY count(*) DESC, LCLid LIMIT 10""",
    "workload_hourly": f"""
WITH {_FEED}, {_FEED_PREPARED}
SELECT CAST(hour(try_cast(DateTime AS TIMESTAMP)) AS INTEGER) AS hour,
       round(sum(energy_kwh), 6) AS total_energy_kwh
FROM prepared GROUP BY 1""",
    "workload_household": f"""
WITH {_FEED}, {_FEED_PREPARED}
SELECT LCLid, round(sum(energy_kwh), 6) AS total_energy_kwh FROM prepared GROUP BY LCLid""",
    "workload_overall": f"""
WITH {_FEED}, {_FEED_PREPARED}
SELECT round(sum(energy_kwh), 6) AS total_energy_kwh FROM prepared""",
    "period_label": f"""
WITH {_ORD}
SELECT year, month, round(sum(energy_kwh), 6) AS total_energy_kwh,
       CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period
FROM cleaned GROUP BY year, month""",
    "hour_label": f"""
WITH {_EV}
SELECT hour, round(sum(energy_kwh), 6) AS total_energy_kwh,
       printf('%02d:00', hour) AS hour_label
FROM cleaned GROUP BY hour""",
    "format_measure": f"""
WITH {_EV}
SELECT LCLid, DateTime, format('{{:,.2f}}', energy_kwh * 1000) AS energy_kwh_text
FROM cleaned""",
    "first_or_default": f"""
WITH {_EV}
SELECT coalesce((SELECT energy_kwh FROM cleaned ORDER BY DateTime, LCLid LIMIT 1), 0.0)
  AS energy_kwh""",
    "overview_report": f"""
WITH {_EV},
ph AS (SELECT hour, sum(energy_kwh) AS t FROM cleaned GROUP BY hour
       ORDER BY t DESC, hour LIMIT 1),
pd AS (SELECT date, sum(energy_kwh) AS t FROM cleaned GROUP BY date
       ORDER BY t DESC, date LIMIT 1),
pm AS (SELECT year, month, sum(energy_kwh) AS t FROM cleaned GROUP BY year, month
       ORDER BY t DESC, year, month LIMIT 1),
o AS (SELECT sum(energy_kwh) AS t, avg(energy_kwh) AS a, min(energy_kwh) AS lo,
             max(energy_kwh) AS hi FROM cleaned)
SELECT round(o.t, 6) AS total_energy_kwh, round(o.a, 6) AS average_half_hour_kwh,
       round(o.lo, 6) AS minimum_half_hour_kwh, round(o.hi, 6) AS maximum_half_hour_kwh,
       ph.hour AS peak_hour, round(ph.t, 6) AS peak_hour_energy_kwh,
       pd.date AS peak_date, round(pd.t, 6) AS peak_day_energy_kwh,
       pm.year AS peak_year, pm.month AS peak_month, round(pm.t, 6) AS peak_month_energy_kwh
FROM o, ph, pd, pm""",
    "stream_land_readings": f"""
WITH {_FEED}
SELECT * FROM records""",
    "run_pipeline": f"""
WITH {_FEED}, {_FEED_CLEANED}, {_BOUNDS},
counts AS (
  SELECT count(*) AS total_records,
         count(*) FILTER (WHERE anomaly_type = 'High Consumption') AS high_consumption_anomalies,
         count(*) FILTER (WHERE anomaly_type = 'Low Consumption') AS low_consumption_anomalies
  FROM flagged
)
SELECT total_records, round(q1_kwh, 6) AS q1_kwh, round(q3_kwh, 6) AS q3_kwh,
       round(iqr_kwh, 6) AS iqr_kwh, round(lower_bound_kwh, 6) AS lower_bound_kwh,
       round(upper_bound_kwh, 6) AS upper_bound_kwh,
       high_consumption_anomalies + low_consumption_anomalies AS anomaly_count,
       high_consumption_anomalies, low_consumption_anomalies,
       round(CASE WHEN total_records > 0
                  THEN 100.0 * (high_consumption_anomalies + low_consumption_anomalies)
                       / total_records
                  ELSE 0.0 END, 6) AS anomaly_percentage
FROM counts, bounds""",
}


_CLEANED_FEED = f"WITH {_FEED}, {_FEED_CLEANED}"
_MISSING = "CAST(count(*) FILTER (WHERE energy_kwh IS NULL) AS BIGINT)"
ORACLE.update(
    {
        "read_raw_feed": ORACLE["normalize_feed"],
        "publish_readings": ORACLE["normalize_feed"],
        "read_readings": ORACLE["normalize_feed"],
        "stream_land_incremental": ORACLE["normalize_feed"],
        "readings_count": "SELECT count(*) AS records FROM events",
        "publish_counts": f"""
WITH {_FEED}
SELECT count(*) AS records_sent, {_MISSING} AS missing_energy_records FROM records""",
        "ingest_counts": f"""
WITH {_FEED}
SELECT count(*) AS records_sent, {_MISSING} AS missing_energy_records,
       count(*) AS records_stored, CAST(0 AS BIGINT) AS records_rejected FROM records""",
        "stream_feed_mixed_headers": ORACLE["normalize_feed"],
        "store_household": f"""
WITH {_FEED},{_FEED_CLEANED}
SELECT * FROM cleaned WHERE LCLid = '42'""",
        "store_hourly": f"""
WITH {_FEED},{_FEED_CLEANED}
SELECT hour, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-14' GROUP BY hour""",
        "incremental_rollups": ORACLE["calendar_rollups"]
        .replace(_EV, f"{_FEED},{_FEED_CLEANED}")
        .replace("NULL::BIGINT AS LCLid", "NULL::VARCHAR AS LCLid"),
        "sketch_bounds_checks": f"""
WITH {_FEED},{_FEED_CLEANED}
SELECT count(*) AS valid_records, count(*) AS sketched_records, true AS q1_close, true AS q3_close
FROM cleaned""",
        "publish_batch_twice": ORACLE["normalize_feed"],
        "land_batches_replayed": """
SELECT CAST(user_id AS VARCHAR) AS LCLid, event_type AS stdorToU,
       CAST(NULL AS VARCHAR) AS DateTime, value AS energy_kwh
FROM events WHERE event_id % 17 <> 0""",
        "land_batches_rejected": """
SELECT CASE WHEN event_id % 2 = 0 THEN 'not json ' || event_id
            ELSE '{"other": ' || event_id || '}' END AS message
FROM events WHERE event_id % 17 = 0""",
        "ingest_totals": f"""
WITH {_FEED}
SELECT count(*) AS records_sent, {_MISSING} AS missing_energy_records,
       count(*) AS records_stored, CAST(0 AS BIGINT) AS records_rejected FROM records""",
        "drop_store_id": ORACLE["clean_readings"],
        "iqr_bounds_approx": ORACLE["iqr_bounds"],
        "anomaly_summary_approx": ORACLE["anomaly_summary"],
        "detect_anomalies": ORACLE["anomaly_records"],
        "detect_anomalies_summary": ORACLE["anomaly_summary"],
        "stream_land_good_messages": """
SELECT CAST(user_id AS VARCHAR) AS LCLid, event_type AS stdorToU,
       CAST(NULL AS VARCHAR) AS DateTime, value AS energy_kwh
FROM events WHERE event_id % 17 <> 0""",
        "stream_rejected_messages": """
SELECT CASE WHEN event_id % 2 = 0 THEN 'not json ' || event_id
            ELSE '{"other": ' || event_id || '}' END AS message
FROM events WHERE event_id % 17 = 0""",
        "result_status": """
SELECT result, CASE WHEN result IN ('hourly_consumption', 'overall_statistics')
                    THEN 'Available' ELSE 'Not found' END AS status, format
FROM unnest(['overall_statistics', 'hourly_consumption', 'daily_consumption',
             'monthly_consumption', 'household_consumption', 'anomaly_summary',
             'scalability_experiment']) AS r(result),
     unnest(['csv', 'parquet']) AS f(format)""",
        "hash_sample_checks": """
SELECT count(*) AS total_records, CAST(0 AS BIGINT) AS outside_range,
       CAST(0 AS BIGINT) AS nesting_violations, 0 AS repartition_differences FROM events""",
        "workload_run": """
SELECT unnest(['workload_hourly', 'workload_household', 'workload_overall']) AS query,
       true AS timed""",
        "scalability_written": """
SELECT p AS data_percentage, CASE WHEN p = 100 THEN (SELECT count(*) FROM events) END
         AS full_records, true AS timed, true AS has_throughput
FROM unnest([25, 50, 100]) AS t(p)""",
        "pipeline_hourly_consumption": f"""{_CLEANED_FEED}
SELECT hour, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned GROUP BY hour""",
        "pipeline_daily_consumption": f"""{_CLEANED_FEED}
SELECT date, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned GROUP BY date""",
        "pipeline_monthly_consumption": f"""{_CLEANED_FEED}
SELECT year, month, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned
GROUP BY year, month""",
        "pipeline_household_consumption": f"""{_CLEANED_FEED}
SELECT LCLid, {_PROFILE}, count(energy_kwh) AS readings FROM cleaned GROUP BY LCLid""",
        "pipeline_weekday_consumption": f"""{_CLEANED_FEED}
SELECT day_of_week, round(sum(energy_kwh), 6) AS total_energy_kwh,
       round(avg(energy_kwh), 6) AS average_energy_kwh, count(energy_kwh) AS readings
FROM cleaned GROUP BY day_of_week""",
        "pipeline_overall_statistics": f"""{_CLEANED_FEED}
SELECT {_PROFILE}, count(energy_kwh) AS valid_readings FROM cleaned""",
        "pipeline_peak_hour": f"""{_CLEANED_FEED}
SELECT hour, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned GROUP BY hour
ORDER BY sum(energy_kwh) DESC, hour LIMIT 1""",
        "pipeline_peak_day": f"""{_CLEANED_FEED}
SELECT date, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned GROUP BY date
ORDER BY sum(energy_kwh) DESC, date LIMIT 1""",
        "pipeline_peak_month": f"""{_CLEANED_FEED}
SELECT year, month, round(sum(energy_kwh), 6) AS total_energy_kwh FROM cleaned
GROUP BY year, month ORDER BY sum(energy_kwh) DESC, year, month LIMIT 1""",
        "pipeline_anomaly_summary": ORACLE["run_pipeline"],
        "pipeline_anomaly_detection": f"""{_CLEANED_FEED}, {_BOUNDS}
SELECT * REPLACE (round(energy_kwh, 6) AS energy_kwh) FROM flagged WHERE anomaly""",
        "pipeline_cleaned_sample": f"""{_CLEANED_FEED}
SELECT * REPLACE (round(energy_kwh, 6) AS energy_kwh) FROM cleaned
ORDER BY DateTime, LCLid, energy_kwh LIMIT 1000""",
    }
)


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **ORACLE_LLM}
