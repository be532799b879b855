"""Column expressions (``Column -> Column``), all native Spark functions."""

from meterlens.functions.columns import (
    PY_WHITESPACE,
    DAY_NAMES,
    day_name,
    format_measure,
    hour_label,
    is_finite,
    parse_energy,
    parse_reading_time,
    period_label,
    sample_bucket,
    strip_text,
)

__all__ = [
    "PY_WHITESPACE",
    "DAY_NAMES",
    "day_name",
    "format_measure",
    "hour_label",
    "is_finite",
    "parse_energy",
    "parse_reading_time",
    "period_label",
    "sample_bucket",
    "strip_text",
]
