"""Batch sinks: result tables, published records, batch-keyed tables."""

from meterlens.sinks.batches import batch_counts, ingest_totals, read_batches, write_batch
from meterlens.sinks.files import publish_readings, write_result
from meterlens.sinks.readings import between_days, read_store, store_readings

__all__ = [
    "batch_counts",
    "between_days",
    "ingest_totals",
    "publish_readings",
    "read_batches",
    "read_store",
    "store_readings",
    "write_batch",
    "write_result",
]
