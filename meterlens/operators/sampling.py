"""Deterministic hash sampling.

A row is kept when its bucket ``abs(xxhash64(household || '||' || time text) % 100)``
is below the percentage.  The bucket depends only on the row's own values, so a
sample is identical under any partitioning, re-run or executor loss, and the
samples are nested (every row of the 25 % sample is in the 50 % sample).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import sample_bucket
from meterlens.schema import HOUSEHOLD, TIME


def hash_sample(
    df: DataFrame, percentage: int, id_column: str = HOUSEHOLD, time_column: str = TIME
) -> DataFrame:
    """Rows whose hash bucket is below ``percentage``; 100 (or more) keeps all rows."""
    if percentage >= 100:
        return df
    bucket = sample_bucket(F.col(id_column), F.col(time_column).cast("string"))
    return df.filter(bucket < F.lit(int(percentage)))
