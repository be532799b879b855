"""Exact discrete quantiles without gathering values in one task.

``percentile_disc`` keeps a value->count map that is merged in a single task,
so its memory grows with the number of distinct values.  This module finds the
same answer — the value at 1-based rank ``max(1, ceil(n * p))`` of the sorted
non-null values (the smallest value whose cumulative share reaches p; NaN sorts
last) — by histogram refinement, where every level is one scan feeding a
distributed hash aggregate (map-side partial counts, so a hot value collapses
per task) into a bounded histogram:

1. level one bins the whole number line on a log scale (``octave_bins`` bins
   per power of two, signed, with zero, the infinities and NaN in bins of
   their own), so it needs no range and also yields ``n``;
2. later levels bin the rows still in play into at most ``buckets`` equal-width
   bins of the chosen bin's ``[min, max]``;
3. a chosen bin holding one distinct value is the answer.

Every bin assignment is monotone in the value (``log`` is semi-monotonic in the
JVM, the linear position is computed divide-first), so a bin's ``[min, max]``
selects exactly that bin's rows at the next level; the lowest and highest value
of a range always land in different linear bins, so each level makes progress.
Typical data needs two levels.  Only one small control row per quantile per
level reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# log-scale level: the span of double exponents (2**-1075 .. 2**1025)
_EXPONENTS = 2100


def _log_bin(octave_bins: int) -> Column:
    """Monotone signed log-scale bin of ``v`` over the whole double line."""
    v = F.col("v")
    offset = 1075 * octave_bins
    top = 1 + _EXPONENTS * octave_bins
    magnitude = F.floor(F.log2(F.abs(v)) * F.lit(float(octave_bins))) + F.lit(offset + 1)
    return (
        F.when(F.isnan(v), F.lit(top + 2))
        .when(v == F.lit(float("inf")), F.lit(top + 1))
        .when(v == F.lit(float("-inf")), F.lit(-top - 1))
        .when(v > 0, magnitude)
        .when(v < 0, -magnitude)
        .otherwise(F.lit(0))
    )


def _linear_bin(a: float, b: float, buckets: int) -> Column:
    """Monotone bin 1..buckets of v within [a, b] (b itself goes to the last bin).

    ``floor((v - a) / (b - a) * buckets) + 1``: dividing first keeps every
    intermediate within [0, buckets] (``width_bucket`` multiplies first and
    overflows on wide ranges).  Each step is a monotone IEEE operation.
    """
    v, lo, width = F.col("v"), F.lit(a), F.lit(b - a)
    if math.isinf(b - a):  # the width overflows: halve everything (monotone)
        v, lo, width = v * F.lit(0.5), F.lit(a * 0.5), F.lit(b * 0.5 - a * 0.5)
    position = F.floor((v - lo) / width * F.lit(float(buckets))) + F.lit(1)
    return F.least(position, F.lit(buckets))


def _histogram(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy(F.col("t.g").alias("g"), F.col("t.bin").alias("bin")).agg(
        F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )


def _pick(hist: DataFrame, targets: list[tuple[int, int, Column]]) -> list:
    """Rows of ``hist`` (g, bin, c, lo, hi) holding each target's rank.

    ``targets`` are (quantile index, group, rank expression).  The cumulative
    count runs over the histogram only (bounded by the number of bins).
    """
    w = Window.partitionBy("g").orderBy("bin")
    hist = hist.withColumn(
        "cum", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("n", F.sum("c").over(Window.partitionBy("g")))
    hits = []
    for q, g, rank in targets:
        hit = (F.col("g") == F.lit(g)) & (F.col("cum") - F.col("c") < rank) & (rank <= F.col("cum"))
        hits.append(F.when(hit, F.struct(F.lit(q).alias("q"), rank.alias("r"))))
    return (
        hist.select(F.explode(F.array(*hits)).alias("t"), "c", "cum", "lo", "hi")
        .filter(F.col("t").isNotNull())
        .select("t.q", "t.r", "c", "cum", "lo", "hi")
        .collect()
    )


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: list[float],
    buckets: int = 1 << 16,
    octave_bins: int = 256,
) -> list[float | None]:
    """Exact ``percentile_disc`` values of ``column`` for each probability.

    Ends because every level narrows: the lowest and the highest value of a
    range never share a bin, so the chosen bin holds fewer distinct values than
    its range did.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    answers: dict[int, float] = {}
    # state per unresolved quantile: (range lo, range hi, residual rank)
    state: dict[int, tuple[float, float, int]] = {}

    def settle(rows) -> None:
        for row in rows:
            q, residual = row["q"], row["r"] - (row["cum"] - row["c"])
            lo, hi = row["lo"], row["hi"]
            if lo == hi or math.isnan(lo):
                answers[q] = lo
                state.pop(q, None)
            else:
                state[q] = (lo, hi, residual)

    # level one: the whole line on a log scale; ranks from the histogram total
    level_one = values.select(
        F.struct(F.lit(0).alias("g"), _log_bin(octave_bins).alias("bin")).alias("t"), "v"
    )
    targets = [
        (i, 0, F.greatest(F.lit(1), F.ceil(F.col("n") * F.lit(float(p)))).cast("long"))
        for i, p in enumerate(probabilities)
    ]
    settle(_pick(_histogram(level_one), targets))

    while state:
        # quantiles whose ranges coincide share one histogram
        groups: dict[tuple[float, float], list[int]] = {}
        for i, (a, b, _) in state.items():
            groups.setdefault((a, b), []).append(i)
        ranges = list(groups)
        tags = [
            F.when(
                (F.col("v") >= F.lit(a)) & (F.col("v") <= F.lit(b)),
                F.struct(F.lit(g).alias("g"), _linear_bin(a, b, buckets).alias("bin")),
            )
            for g, (a, b) in enumerate(ranges)
        ]
        tagged = values.select(F.explode(F.array(*tags)).alias("t"), "v").filter(
            F.col("t").isNotNull()
        )
        targets = [
            (i, g, F.lit(state[i][2]).cast("long"))
            for g, rng in enumerate(ranges)
            for i in groups[rng]
        ]
        settle(_pick(_histogram(tagged), targets))
    return [answers.get(i) for i in range(len(probabilities))]
