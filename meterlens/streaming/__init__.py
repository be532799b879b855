"""Structured Streaming ingest: raw feed -> records -> landed readings."""

from meterlens.streaming.batches import (
    FEED_COUNTS,
    LANDING_COUNTS,
    REJECT_COUNTS,
    publish_batch,
    stream_feed_batches,
    stream_land_batches,
)
from meterlens.streaming.ingest import (
    INGEST_METRICS,
    LANDING_METRICS,
    read_record_stream,
    stream_feed_to_records,
    stream_land_readings,
    stream_rejected_messages,
)

__all__ = [
    "FEED_COUNTS",
    "INGEST_METRICS",
    "LANDING_COUNTS",
    "LANDING_METRICS",
    "REJECT_COUNTS",
    "publish_batch",
    "read_record_stream",
    "stream_feed_batches",
    "stream_land_batches",
    "stream_feed_to_records",
    "stream_land_readings",
    "stream_rejected_messages",
]
