"""Quality rules: robust multivariate outliers per language and source.

Every document gets a vector of transformed statistics.  Location and scatter
of each group are minimum-covariance-determinant estimates, found by
concentration steps over all rows: keep the share ``SUPPORT`` of the group with
the smallest distances, estimate again, until the estimates stand still.  Steps
go out from two starts (medians, and all rows), and of all the estimates met the
one with the least determinant counts.  A document is rejected when its squared
Mahalanobis distance exceeds the chi-square cutoff.

All of it is Spark aggregation.  A concentration step is one map-side combined
``groupBy`` over a narrow table (a histogram of the distances gives the support
cut, then sums and products of the rows below it), so a source that holds a
third of the rows is never gathered anywhere.  Statistics are fixed-point
integers and sums are exact, hence the estimates don't depend on partitioning.

Groups are estimated on three levels (language and source, language, all); a
group with fewer than ``MIN_GROUP`` documents uses the next level.  A statistic
may not have a smaller scale than its entry in ``FEATURES``: most documents
have no symbols and no repeats at all, so the plain determinant would be zero and
one repeated line would reject a document.  The entries let each statistic
reject alone within the base rules (in a group without any scatter: 52 % repeated
lines, 42 % repeated words, 90 times the words).

Defined results: a null or empty text has no words and fails the base rules;
null languages and sources are groups of their own; repeated rows are separate
rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import slices, staged

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = re.compile(r"[#*$%&|<>]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Transformed statistics: SQL over the base counts, least scale, side that is bad
#: ("both" or "high": values below the centre count as the centre).
FEATURES = {
    "log_words": ("ln(greatest(n_words, 1))", 0.8, "high"),
    "word_length": ("word_chars / greatest(n_words, 1)", 0.3, "both"),
    "symbols": ("sqrt(n_symbols / greatest(n_words, 1))", 0.04, "high"),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", 0.09, "high"),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.075, "high"),
}
UNIT = 10_000  # fixed-point steps per unit of a statistic
SUPPORT = 0.75
#: A group's steps end when its estimate stands still; one-sided statistics let a few groups
#: turn in a circle, whose least determinant these steps have met.
MAX_STEPS = 8
MIN_GROUP = 50
#: Chi-square quantile at 1 - 1e-5 with one degree of freedom per statistic (five).
CUTOFF = 30.86
#: Distances are counted in bins of a sixteenth of a doubling.
BINS_PER_OCTAVE = 16

STATS_SCHEMA = (
    "doc_id long, row_key long, lang string, source string, n_words long, word_chars long, n_symbols long, "
    "n_lines long, n_dup_lines long, n_repeat_words long"
)


def repeat_words(words: list[str]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    number = {w: i for i, w in enumerate(set(words))}
    v = len(number)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    if v < 1 << 21:
        keys = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:
        pairs = np.unique(ids[:-2] * v + ids[1:-1], return_inverse=True)[1]
        keys = pairs * v + ids[2:]
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    starts = np.zeros(n - 2, bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= starts
    covered[1:-1] |= starts
    covered[2:] |= starts
    return int(covered.sum())


def text_statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) of one text."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    # bytes.split() cuts at exactly the six ASCII white-space characters
    words = text.encode("utf-8", "surrogatepass").split()
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        len(text) - spaces,
        symbols,
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def row_key(docs: DataFrame):
    """Tells rows that repeat a document id apart."""
    return F.xxhash64(docs["text"], docs["lang"], docs["source"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """One row of base counts per document, from a map over the texts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows = [text_statistics(t) for t in batch.column("text").to_pylist()]
                counts = np.array(rows, np.int64).reshape(len(rows), 6)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("row_key"),
                        batch.column("lang").cast(pa.string()),
                        batch.column("source").cast(pa.string()),
                        *(pa.array(counts[:, j]) for j in range(6)),
                    ],
                    names=[f.split()[0] for f in STATS_SCHEMA.split(", ")],
                )

    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        row_key(docs).alias("row_key"),
        docs["lang"].cast("string").alias("lang"),
        docs["source"].cast("string").alias("source"),
        docs["text"].alias("text"),
    ).mapInArrow(measure, STATS_SCHEMA)


def _levels(stats: DataFrame) -> DataFrame:
    """Rows that pass the base rules, once per level, as fixed-point vectors."""
    vector = F.array(
        *(F.round(F.expr(sql) * UNIT).cast("long") for sql, _, _ in FEATURES.values())
    )
    level = F.explode(F.array(F.lit(2), F.lit(1), F.lit(0)))
    rows = stats.filter(~F.col("base_failed")).select(
        "lang", "source", vector.alias("x"), level.alias("level")
    )
    return rows.select(
        "level",
        F.when(F.col("level") >= 1, F.col("lang")).alias("lang"),
        F.when(F.col("level") == 2, F.col("source")).alias("source"),
        "x",
    )


KEYS = ("level", "lang", "source")
RUNS = (*KEYS, "start")
START_BINS = 50  # steps per unit of a statistic for the starting median
START_CLIP = 64  # largest value that the starting median tells apart


def _join_fit(rows: DataFrame, fit: DataFrame) -> DataFrame:
    """Rows with their group's estimates, one per start; null languages and sources match each other.

    The estimate side has a row per group and start.  No hint is given: it is broadcast
    only under the session's size threshold, and else joined by key with the
    run-time split of hot groups.
    """
    f = fit.select(*(F.col(k).alias(f"f_{k}") for k in KEYS), "start", "center", "precision", "n")
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"f_{k}")) for k in KEYS))
    return rows.join(f, on).drop(*(f"f_{k}" for k in KEYS))


def _distance(x, center, precision):
    """Squared Mahalanobis distance as a column expression."""
    p = len(FEATURES)
    diff = []
    for i, (_, _, side) in enumerate(FEATURES.values()):
        d = x[i] / F.lit(float(UNIT)) - center[i]
        diff.append(F.greatest(d, F.lit(0.0)) if side == "high" else d)
    terms = [diff[i] * diff[j] * precision[i * p + j] for i in range(p) for j in range(p)]
    return F.greatest(reduce(lambda a, b: a + b, terms), F.lit(0.0))


def _invert(pdf_iter: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre and inverse covariance from a group's sums; one small row per group."""
    p = len(FEATURES)
    least = np.array([s for _, s, _ in FEATURES.values()])
    for pdf in pdf_iter:
        centers, precisions, sizes = [], [], []
        for n, sums, products in zip(pdf["m"], pdf["sums"], pdf["products"], strict=True):
            mean = np.array([int(v) for v in sums], float) / n / UNIT
            cov = np.empty((p, p))
            for i in range(p):
                for j in range(p):
                    # exact integers until the last division
                    num = int(products[i * p + j]) * int(n) - int(sums[i]) * int(sums[j])
                    cov[i, j] = num / (int(n) * int(n)) / UNIT**2
            cov *= CONSISTENCY
            variance = np.maximum(np.diag(cov), least**2)
            cov *= 1 - SHRINK
            cov[np.diag_indices(p)] = variance
            precisions.append(np.linalg.inv(cov).ravel().tolist())
            sizes.append(float(np.linalg.slogdet(cov)[1]))
            centers.append(mean.tolist())
        yield pd.DataFrame(
            {
                "level": pdf["level"],
                "lang": pdf["lang"],
                "source": pdf["source"],
                "start": pdf["start"],
                "n": pdf["n"],
                "center": centers,
                "precision": precisions,
                "log_det": sizes,
            }
        )


#: Correlations are shrunk by this share, so that few or collinear rows can be inverted.
SHRINK = 0.01
#: Makes the covariance of the closest 75 % consistent for five normal statistics.
CONSISTENCY = 1.37
FIT_SCHEMA = (
    "level int, lang string, source string, start int, n long, center array<double>, "
    "precision array<double>, log_det double"
)


def mcd_estimates(levels: DataFrame, support: float = SUPPORT, max_steps: int = MAX_STEPS) -> DataFrame:
    """Centre and precision of every group by concentration steps over all its rows."""
    keys = list(KEYS)
    p = len(FEATURES)
    # first start: coordinate-wise medians and the least scales.  The median's state holds
    # one count per distinct value, so values are coarse and clipped for this step.
    coarse = UNIT // START_BINS
    start = levels.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.array(
            *(
                F.median(F.least(F.floor(F.col("x")[i] / coarse), F.lit(START_CLIP * START_BINS)))
                / START_BINS
                for i in range(p)
            )
        ).alias("center"),
    )
    least = [s for _, s, _ in FEATURES.values()]
    eye = [0.0 if i != j else 1.0 / least[i] ** 2 for i in range(p) for j in range(p)]
    medians = staged(
        start.select(*keys, F.lit(0).alias("start"), "n", "center", F.array(*map(F.lit, eye)).alias("precision")),
        "mcd-start",
    )
    # second start: mean and covariance of all rows
    whole = _join_fit(levels, medians).select(*keys, F.lit(1).alias("start"), "n", "x", F.lit(0).alias("bin"))
    means = _within_support(_bin_sums(whole), 1.0).mapInPandas(_invert, FIT_SCHEMA)
    fit = staged(medians.unionByName(means.select(*medians.columns)), "mcd-starts")
    met = []
    for step in range(max_steps):
        near = _join_fit(levels, fit).select(
            *RUNS,
            "n",
            "x",
            F.floor(
                F.log2(_distance(F.col("x"), F.col("center"), F.col("precision")) + 1e-6)
                * BINS_PER_OCTAVE
            )
            .cast("int")
            .alias("bin"),
        )
        # sums per distance bin, then the bins up to the support share of the group
        sums = _within_support(_bin_sums(near), support)
        found = staged(sums.mapInPandas(_invert, FIT_SCHEMA), f"mcd-step{step}")
        met.append(found.withColumn("step", F.lit(step)))
        # only the groups whose estimate changed go on
        still = reduce(
            lambda a, b: a & b, (found[c].eqNullSafe(fit[c]) for c in (*RUNS, "center", "precision"))
        )
        fit = staged(found.join(fit, still, "left_anti"), f"mcd-moving{step}")
        if fit.isEmpty():
            break
    best = F.min_by(F.struct("n", "center", "precision"), F.struct(F.round("log_det", 9), "step", "start"))
    return staged(reduce(DataFrame.unionByName, met).groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*"), "mcd-best")


def _bin_sums(near: DataFrame) -> DataFrame:
    p = len(FEATURES)
    x = F.col("x")
    big = [x[i].cast("decimal(20,0)") for i in range(p)]
    return near.groupBy(*RUNS, "n", "bin").agg(
        F.count("*").alias("m"),
        *(F.sum(x[i]).alias(f"s{i}") for i in range(p)),
        *(
            F.sum((big[i] * big[j]).cast("decimal(38,0)")).alias(f"p{i}_{j}")
            for i in range(p)
            for j in range(i, p)
        ),
    )


def _within_support(bins: DataFrame, support: float) -> DataFrame:
    """Sum the closest bins that together hold the support share (bins per group are bounded)."""
    p = len(FEATURES)
    names = [f"s{i}" for i in range(p)] + [f"p{i}_{j}" for i in range(p) for j in range(i, p)]
    before = Window.partitionBy(*RUNS).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    kept = bins.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))).filter(
        F.col("before") < F.col("n") * support
    )
    out = kept.groupBy(*RUNS, "n").agg(
        F.sum("m").alias("m"), *(F.sum(c).cast("string").alias(c) for c in names)
    )
    text = [F.col(f"p{min(i, j)}_{max(i, j)}") for i in range(p) for j in range(p)]
    return out.select(
        *RUNS,
        "n",
        "m",
        F.array(*(F.col(f"s{i}") for i in range(p))).alias("sums"),
        F.array(*text).alias("products"),
    )


def quality_verdicts(docs: DataFrame, support: float = SUPPORT, cutoff: float = CUTOFF) -> DataFrame:
    """Base counts, base verdict, distance and final verdict for every document.

    ``docs`` needs doc_id, text, lang and source; the result has one row per row.
    """
    stats = document_statistics(docs).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
    )
    stats = staged(stats, "quality-stats")
    levels = staged(_levels(stats), "quality-vectors")
    fit = mcd_estimates(levels, support)
    vector = F.array(
        *(F.round(F.expr(sql) * UNIT).cast("long") for sql, _, _ in FEATURES.values())
    )
    # each document takes the finest level whose group is large enough
    names = ["center", "precision", "n"]

    def named(level: int, on: list[str]) -> DataFrame:
        keep = (F.col("level") == level) & ((F.col("n") >= MIN_GROUP) | F.lit(level == 0))
        return fit.filter(keep).select(
            *(F.col(k).alias(f"k{level}_{k}") for k in on),
            F.struct(*names).alias(f"fit{level}"),
        )

    out = stats.withColumn("x", vector)
    for level, on in ((2, ["lang", "source"]), (1, ["lang"])):
        cond = reduce(
            lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"k{level}_{k}")) for k in on)
        )
        out = out.join(named(level, on), cond, "left").drop(*(f"k{level}_{k}" for k in on))
    out = out.join(F.broadcast(named(0, [])), F.lit(True), "left")  # a single row
    chosen = F.coalesce("fit2", "fit1", "fit0")
    d2 = _distance(F.col("x"), chosen["center"], chosen["precision"])
    return out.select(
        "doc_id",
        "row_key",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(d2 <= cutoff, F.lit(True))).alias("kept"),
        F.when(~F.col("base_failed"), d2).alias("distance2"),
    )


def keep_passing(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The documents that pass; rows without an id are matched like any other."""
    gone = verdicts.filter(~F.col("kept")).select(
        F.col("doc_id").alias("__gone_id"), F.col("row_key").alias("__gone_key")
    )
    same = docs["doc_id"].cast("long").eqNullSafe(gone["__gone_id"]) & (
        row_key(docs) == gone["__gone_key"]
    )
    return docs.join(gone, same, "left_anti")
