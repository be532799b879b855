"""Ingest in replayable batches: each input row ends up in one stored batch.

Every micro-batch is one batch of the tables that it writes
(:mod:`meterlens.sinks.batches`): stopped at any point and started again, the
stream gives Spark's same batch number to the same input, what is stored is left
as it is, and what is missing is written.  Counters are stored with the batches,
so their totals do not depend on what one run's progress reports keep.

* :func:`stream_feed_batches` — raw CSV files, each bound by its own header.
* :func:`stream_land_batches` — records and rejected messages, from one pass.
* :func:`publish_batch` — one batch of records to a folder or a topic, once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlens.operators.cleaning import clean_readings, normalize_feed
from meterlens.operators.incremental import CELL_COUNT, DAY_COUNT, day_sketches, reading_cells
from meterlens.sinks.batches import BATCH, COUNTS, store_counts, stored_counts, write_batch
from meterlens.sinks.files import publish_readings
from meterlens.sinks.readings import layout, layout_options
from meterlens.sources.files import bind_feed_lines, feed_lines, line_headers
from meterlens.streaming.ingest import (
    MESSAGE,
    _source_cleanup,
    _start,
    ingest_measures,
    read_messages,
    sink_checkpoint,
    split_messages,
)

FEED_COUNTS = ["records_sent", "missing_energy_records"]
LANDING_COUNTS = ["records_stored", "missing_energy_records"]
REJECT_COUNTS = ["records_rejected"]
STORE_COUNTS = ["valid_records"]


def _feed_measures() -> dict[str, Column]:
    return dict(zip(FEED_COUNTS, ingest_measures(), strict=True))


def _stream(messages: DataFrame, each: Callable, checkpoint: str, available_now: bool) -> StreamingQuery:
    return _start(messages.writeStream.foreachBatch(each), checkpoint, available_now).start()


def stream_feed_batches(
    spark: SparkSession,
    feed_dir: str,
    target: str,
    checkpoint: str | None = None,
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    clean_source: str = "off",
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Raw CSV files appearing in ``feed_dir`` -> batches of normalised records.

    Columns are bound by each file's own header, whatever the other files have.
    Counters ``records_sent`` and ``missing_energy_records`` are stored per batch.
    A file source gives whole files, so a batch holds every line's header.
    """
    reader = spark.readStream.options(**_source_cleanup({}, clean_source, archive_dir))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = feed_lines(reader, f"{feed_dir.rstrip('/')}/*.csv")

    def store(batch: DataFrame, batch_id: int) -> None:
        if stored_counts(batch.sparkSession, target, batch_id) is not None:
            return
        records = normalize_feed(bind_feed_lines(batch, line_headers(batch)))
        write_batch(records, target, batch_id, _feed_measures(), fmt)

    return _stream(lines, store, sink_checkpoint(target, checkpoint), available_now)


def stream_land_batches(
    spark: SparkSession,
    source: str | None,
    target: str,
    rejects: str,
    checkpoint: str | None = None,
    source_format: str = "json",
    source_options: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    clean_source: str = "off",
    archive_dir: str | None = None,
    store: str | None = None,
    cells: str | None = None,
    sketches: str | None = None,
) -> StreamingQuery:
    """Messages -> batches of readings (Parquet) and of rejected messages (text), from one pass.

    The messages of a micro-batch are read and parsed once; all tables are
    written from what was kept of that.  A replay writes the tables that are missing, so
    none holds a message twice; only then the batch is done, so the source may
    archive or delete its files.

    ``store``, ``cells`` and ``sketches`` are folders of three more tables: the batch's
    cleaned readings, typed and laid out for lookups
    (:mod:`meterlens.sinks.readings`), its rollup cells and its quantile sketches by day
    (:func:`~meterlens.operators.incremental.stored_rollups`,
    :func:`~meterlens.operators.incremental.stored_bounds`), from which rollups and
    anomaly bounds follow without reading the readings again.
    """
    options = dict(source_options or {})
    if source_format != "kafka":
        options = _source_cleanup(options, clean_source, archive_dir)
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    messages = read_messages(spark, source, source_format, options)

    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        tables = [t for t in (target, rejects, store, cells, sketches) if t]
        if all(stored_counts(session, t, batch_id) is not None for t in tables):
            return
        # kept for the second table; what a lost executor held is read again
        tagged = split_messages(batch)[0].persist(StorageLevel.MEMORY_AND_DISK)
        try:
            records = tagged.filter("not bad").select("r.*").drop(MESSAGE)
            sent, missing = ingest_measures()
            write_batch(records, target, batch_id, dict(zip(LANDING_COUNTS, (sent, missing), strict=True)))
            refused = tagged.filter("bad").select("value")
            counter = {REJECT_COUNTS[0]: F.count(F.lit(1))}
            write_batch(refused, rejects, batch_id, counter, fmt="text")
            cleaned = clean_readings(records)
            if store:
                measure = {STORE_COUNTS[0]: F.count(F.lit(1))}
                write_batch(layout(cleaned), store, batch_id, measure, options=layout_options())
            if cells:
                write_batch(reading_cells(cleaned), cells, batch_id, {CELL_COUNT: F.count(F.lit(1))})
            if sketches:
                write_batch(day_sketches(cleaned), sketches, batch_id, {DAY_COUNT: F.count(F.lit(1))})
        finally:
            tagged.unpersist()

    return _stream(messages, land, sink_checkpoint(target, checkpoint), available_now)


def publish_batch(
    records: DataFrame,
    target: str,
    batch_id: int,
    fmt: str = "json",
    options: dict[str, str] | None = None,
) -> dict[str, int]:
    """Publish ``records`` as batch ``batch_id``; a batch that is published already is left alone.

    Returns the batch's counters either way.  ``target`` is the table's folder; for
    ``fmt="kafka"`` it holds the counters alone, which are stored once all
    messages are sent: a run that was stopped while sending sends again, one
    that was completed does not.
    """
    if fmt != "kafka":
        return write_batch(records, target, batch_id, _feed_measures(), fmt, options)
    spark = records.sparkSession
    done = stored_counts(spark, target, batch_id)
    if done is None:
        done = publish_readings(records, None, fmt, options)
        store_counts(spark, f"{target.rstrip('/')}/{COUNTS}/{BATCH}={int(batch_id)}", batch_id, done)
    return done
