"""Checkpointed streaming ingest.

Two stateless streaming queries replace a producer loop and a consumer loop:

* :func:`stream_feed_to_records` — new raw CSV files -> normalised JSON records
  (file directory or a Kafka topic), counting rows sent and rows missing energy.
* :func:`stream_land_readings` — records (JSON directory or Kafka topic) ->
  Parquet landing table; messages that are no record are counted and left out.
* :func:`stream_rejected_messages` — those messages, as text, to a side folder.

Progress is kept in a checkpoint that belongs to the sink, by default inside it
(``_checkpoint``, which readers skip): a restarted or re-run query resumes where
it stopped, new input of a later run is added, and with the file sink's commit
log every input row is stored once.  A sink that is no folder needs an explicit
checkpoint.  Batch size is ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterlens.operators.cleaning import normalize_feed
from meterlens.schema import ENERGY, HOUSEHOLD, RAW_FEED_SCHEMA, RECORD_SCHEMA, TIME
from meterlens.sources.files import feed_headers, read_feed

INGEST_METRICS = "ingest_counts"
LANDING_METRICS = "landing_counts"


@contextmanager
def kafka_connector_hint():
    """Turn "data source kafka not found" into an actionable message."""
    try:
        yield
    except Exception as exc:  # a JVM-side lookup error may arrive wrapped
        text = str(exc)
        missing = "DATA_SOURCE_NOT_FOUND" in text or "failed to find data source" in text.lower()
        if missing and "kafka" in text.lower():
            raise RuntimeError(
                "Kafka needs the spark-sql-kafka connector on the classpath (e.g. "
                "spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version>)"
            ) from exc
        raise


def ingest_measures() -> list:
    """Counters of records sent and of those without energy (for agg or observe)."""
    return [
        F.count(F.lit(1)).alias("records_sent"),
        F.count_if(F.col(ENERGY).isNull()).alias("missing_energy_records"),
    ]


def _ingest_counts(records: DataFrame) -> DataFrame:
    """Attach per-batch counters (rows sent, rows with missing energy)."""
    return records.observe(INGEST_METRICS, *ingest_measures())


def sink_checkpoint(sink: str | None, checkpoint: str | None) -> str:
    """The checkpoint of a sink: as given, else a hidden folder of the sink itself."""
    if checkpoint:
        return checkpoint
    if not sink:
        raise ValueError("a sink that is no folder needs an explicit checkpoint")
    return f"{sink.rstrip('/')}/_checkpoint"


MESSAGE = "_message"  # the text of a message that is no record


def split_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejected): text messages in column ``value`` parsed as records.

    A message is rejected when it is no JSON object, when a field has the wrong
    type, or when it has neither a household nor a time.
    """
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField(MESSAGE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MESSAGE}
    text = F.col("value").cast("string")
    parsed = messages.select(text.alias("value"), F.from_json(text, schema, options).alias("r"))
    bad = (
        F.col("r").isNull()
        | F.col(f"r.{MESSAGE}").isNotNull()
        | (F.col(f"r.{HOUSEHOLD}").isNull() & F.col(f"r.{TIME}").isNull())
    )
    tagged = parsed.select("value", "r", bad.alias("bad"))
    return tagged, tagged.filter("bad").select(F.col("value").alias("message"))


def read_messages(
    spark: SparkSession,
    source: str | None,
    fmt: str = "json",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream of text messages (column ``value``) from a folder of JSON lines or a Kafka topic."""
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        with kafka_connector_hint():
            return spark.readStream.format("kafka").options(**opts).load().select("value")
    if fmt not in ("json", "text"):
        raise ValueError("messages come as 'json' or 'text' lines or from 'kafka'")
    return spark.readStream.options(**opts).text(source)


def read_record_stream(
    spark: SparkSession,
    source: str | None,
    fmt: str = "json",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream of reading records; messages that are no record are left out."""
    tagged, _ = split_messages(read_messages(spark, source, fmt, options))
    return tagged.filter("not bad").select("r.*").drop(MESSAGE)


def _source_cleanup(options: dict, clean_source: str, archive_dir: str | None) -> dict:
    """File-source options that archive or delete files once processed.

    A file stream lists its whole input folder every micro-batch; on a busy
    landing path that listing grows without bound unless processed files are
    moved out (``archive``) or removed (``delete``).
    """
    if clean_source not in ("off", "archive", "delete"):
        raise ValueError("clean_source must be 'off', 'archive' or 'delete'")
    if clean_source != "off":
        options["cleanSource"] = clean_source
        if clean_source == "archive":
            if not archive_dir:
                raise ValueError("clean_source='archive' needs archive_dir")
            options["sourceArchiveDir"] = archive_dir
    return options


def _start(writer, checkpoint: str, available_now: bool):
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer


def stream_feed_to_records(
    spark: SparkSession,
    feed_dir: str,
    sink: str | None,
    checkpoint: str | None = None,
    sink_format: str = "json",
    sink_options: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    clean_source: str = "off",
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Raw CSV files appearing in ``feed_dir`` -> normalised records at ``sink``.

    Columns are bound by header: the files of a stream share one header, that of
    the files there at the start (else the fixed order), and a file with another
    one fails the query.  ``clean_source`` (``off``/``archive``/``delete``) moves
    processed feed files out of the listed folder (``archive_dir`` for
    ``archive``).
    """
    options = _source_cleanup({}, clean_source, archive_dir)
    pattern = f"{feed_dir.rstrip('/')}/*.csv"
    names = list(min(feed_headers(spark, pattern), default=RAW_FEED_SCHEMA.fieldNames()))
    reader = spark.readStream.options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    records = _ingest_counts(normalize_feed(read_feed(reader, names, pattern)))
    checkpoint = sink_checkpoint(sink, checkpoint)
    if sink_format == "kafka":
        out = records.select(F.to_json(F.struct("*")).alias("value"))
        writer = out.writeStream.format("kafka").options(**(sink_options or {}))
        with kafka_connector_hint():
            return _start(writer, checkpoint, available_now).start()
    writer = records.writeStream.format(sink_format).options(**(sink_options or {}))
    return _start(writer, checkpoint, available_now).start(sink)


def stream_land_readings(
    spark: SparkSession,
    source: str | None,
    target: str,
    checkpoint: str | None = None,
    source_format: str = "json",
    source_options: dict[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    clean_source: str = "off",
    archive_dir: str | None = None,
) -> StreamingQuery:
    """Reading records -> Parquet landing table (append, exactly-once file sink).

    Messages that are no record are counted as ``records_rejected`` and not
    stored; :func:`stream_rejected_messages` keeps them.
    ``max_files_per_trigger`` bounds each micro-batch for a file source (for
    Kafka pass ``maxOffsetsPerTrigger`` in ``source_options``); ``clean_source``
    archives or deletes processed record files.
    """
    options = dict(source_options or {})
    if source_format != "kafka":
        options = _source_cleanup(options, clean_source, archive_dir)
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    tagged, _ = split_messages(read_messages(spark, source, source_format, options))
    counted = tagged.observe(
        LANDING_METRICS,
        F.count_if(~F.col("bad")).alias("records_stored"),
        F.count_if(F.col("bad")).alias("records_rejected"),
    )
    records = counted.filter("not bad").select("r.*").drop(MESSAGE)
    writer = records.writeStream.format("parquet").outputMode("append")
    return _start(writer, sink_checkpoint(target, checkpoint), available_now).start(target)


def stream_rejected_messages(
    spark: SparkSession,
    source: str | None,
    target: str,
    checkpoint: str | None = None,
    source_format: str = "json",
    source_options: dict[str, str] | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Messages that are no record -> text files, beside :func:`stream_land_readings`.

    Reads the same source on its own; when the landing query archives or deletes
    processed files, run this one first.
    """
    _, rejected = split_messages(read_messages(spark, source, source_format, source_options))
    writer = rejected.writeStream.format("text").outputMode("append")
    return _start(writer, sink_checkpoint(target, checkpoint), available_now).start(target)
