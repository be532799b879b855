"""Batch writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: Full-precision time text of CSV results.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def write_result(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    single_file: bool = False,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Overwrite a result directory (CSV with header by default).

    ``single_file=True`` coalesces to one part file — only for results whose
    size is bounded (rollups, peaks, summaries), never for row-level outputs.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        # Spark's CSV default stops at milliseconds
        writer = writer.option("header", True).options(**CSV_TIMES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def publish_readings(
    records: DataFrame,
    path: str | None = None,
    fmt: str = "json",
    options: dict[str, str] | None = None,
    mode: str = "append",
) -> dict[str, int]:
    """Publish records as one JSON document each; returns the batch's counters.

    ``records_sent`` and ``missing_energy_records`` are observed while writing.
    A re-run of the same batch appends its records again; for a folder that holds
    one batch, ``mode="overwrite"`` makes the re-run replace it.
    ``fmt="kafka"`` writes ``value = to_json(struct(*))`` to a topic (broker and
    topic in ``options``); ``json``/``text`` write a directory of JSON lines.
    """
    from meterlens.streaming.ingest import ingest_measures, kafka_connector_hint

    counts = Observation("publish")
    observed = records.observe(counts, *ingest_measures())
    payload = F.to_json(F.struct(*(F.col(f"`{c}`") for c in records.columns))).alias("value")
    if fmt == "kafka":
        with kafka_connector_hint():
            observed.select(payload).write.format("kafka").options(**(options or {})).save()
    elif fmt == "text":
        observed.select(payload).write.mode(mode).options(**(options or {})).text(path)
    else:
        observed.write.mode(mode).options(**(options or {})).format(fmt).save(path)
    return dict(counts.get)
