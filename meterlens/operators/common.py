"""Plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Replace ``column`` by ``value`` so that a later filter is not pushed below.

    Catalyst pushes a filter below a projection by substituting the projected
    expressions into it, so a filter on parsed values would run the parsing
    twice per row — in the filter and again in the projection (subexpression
    elimination does not cross operators).  A one-element generator is opaque
    to that rewrite: ``value`` is computed exactly once per row.  All other
    columns stay plain attributes, open to pruning and filter pushdown.
    """
    return df.select(
        *(
            F.explode(F.array(value)).alias(column) if c == column else F.col(f"`{c}`")
            for c in df.columns
        )
    )
