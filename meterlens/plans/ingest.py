"""End-to-end ingest: raw CSV feed -> records stream -> landed Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlens.session import scratch_path
from meterlens.streaming import stream_feed_to_records, stream_land_readings


def write_feed_files(feed: DataFrame, folder: str) -> None:
    """Write a text feed as header CSV files, keeping surrounding whitespace."""
    (
        feed.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


def feed_round_trip(spark: SparkSession, feed: DataFrame, base: str | None = None) -> DataFrame:
    """Land a raw feed through both streaming stages; return the landed table.

    feed -> CSV files -> (stream) normalised JSON records -> (stream) Parquet.
    Everything lives under ``base`` (default: a fresh folder under the shared
    checkpoint root); both streams are checkpointed and run ``availableNow``.
    """
    base = (base or scratch_path(spark, "ingest")).rstrip("/")
    write_feed_files(feed, f"{base}/feed")
    first = stream_feed_to_records(
        spark, f"{base}/feed", f"{base}/records", checkpoint=f"{base}/_ck_records"
    )
    first.awaitTermination()
    second = stream_land_readings(
        spark, f"{base}/records", f"{base}/landed", checkpoint=f"{base}/_ck_landed"
    )
    second.awaitTermination()
    return spark.read.parquet(f"{base}/landed")
