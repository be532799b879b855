"""Batch sources: raw feed CSV, stored readings, written results."""

from meterlens.sources.files import (
    RESULT_SCHEMAS,
    read_raw_feed,
    read_readings,
    read_result,
    read_table,
)

__all__ = ["RESULT_SCHEMAS", "read_raw_feed", "read_readings", "read_result", "read_table"]
