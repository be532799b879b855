"""Periodic runs of words: branching tandem repeats from an enhanced suffix array.

A run is a maximal stretch of words with smallest period q.  Its last square
(2q words) is followed by a word that breaks the period, so the two suffixes q
apart at its start share exactly q words: they lie in different children of the
LCP interval of depth q.  For every LCP interval, the suffixes of all children
but the largest look at the suffixes ``depth`` words behind and before them;
``ISA`` tells whether these are in the interval.  Branching squares found so are
rotated to the left as far as the period holds, and squares of one run fall
together.  Each suffix is in the smaller child at most log n times.

The suffix array of a whole slice of texts is sorted at once by prefix doubling.
Words are numbered per text, so texts do not mix; only suffixes that still share
their prefix are sorted again.  A run of ``least`` words and exponent e repeats
``least * (1 - 1/e)`` words at its period, so a text in which all prefixes of
that length differ has no run and is left after four rounds.

A text is one row and is handled by one task, also a very long one: time grows
with n log n, whatever the text repeats.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; every row is handled on its own, so repeated rows, ties and rows
without an id keep one result each; an empty table gives an empty one; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterlens.llm.common import slices

RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{RUN}>, collapsed string"
#: Pairs of (suffix, interval) looked at together.
PAIRS = 1 << 18
#: Bytes of text whose suffixes are sorted at once: a word takes some hundred bytes
#: meanwhile, and smaller arrays stay in the processor's caches.
SORTED_BYTES = 1 << 18


def suffix_arrays(codes: np.ndarray, bounds: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array of all texts, texts in which some ``shared`` words stand twice).

    ``codes`` number the words so that texts share none and come in order: the
    places ``bounds[t]`` to ``bounds[t + 1]`` of the array are text t's suffixes.
    Texts without such repeats are not sorted to the end.
    """
    n = len(codes)
    suffix = np.argsort(codes, kind="stable")
    rank = np.full(n + 1, -1, np.int64)  # behind the last word: nothing
    open_, key, prefix = np.arange(n), codes[suffix], 1
    repeats = np.zeros(len(bounds) - 1, bool)
    checked = False
    while True:
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[first, len(key)])
        rank[suffix[open_]] = np.repeat(open_[first], size)
        open_ = open_[np.repeat(size > 1, size)]
        if not checked and 2 * prefix > shared:
            repeats[np.searchsorted(bounds, open_, "right") - 1] = True
            checked = True
        if not len(open_):
            return suffix, np.flatnonzero(repeats)
        at = suffix[open_]
        key = rank[at] * (n + 1) + rank[np.minimum(at + prefix, n)] + 1
        order = np.argsort(key, kind="stable")
        suffix[open_], key = at[order], key[order]
        prefix *= 2


def common_prefixes(words: list[int], suffix: list[int], place: list[int]) -> list[int]:
    """Words that each suffix shares with the one before it in the array."""
    n = len(words)
    lcp = [0] * n
    h = 0
    for i in range(n):
        x = place[i]
        if not x:
            h = 0
            continue
        j = suffix[x - 1]
        end = n - (i if i > j else j)
        while h < end and words[i + h] == words[j + h]:
            h += 1
        lcp[x] = h
        if h:
            h -= 1
    return lcp


def lcp_intervals(lcp: list[int], deepest: int) -> Iterator[tuple[int, list[int]]]:
    """(depth, child bounds) of every LCP interval of depth 1 to ``deepest``."""
    stack: list[tuple[int, list[int]]] = []
    for x, depth in enumerate(lcp[1:] + [0], 1):
        left = x - 1
        while stack and stack[-1][0] > depth:
            inner, cuts = stack.pop()
            left = cuts[0]
            if inner <= deepest:
                cuts.append(x)
                yield inner, cuts
        if depth:
            if stack and stack[-1][0] == depth:
                stack[-1][1].append(x)
            else:
                stack.append((depth, [left, x]))


def branching_squares(
    words: np.ndarray, suffix: np.ndarray, place: np.ndarray, lcp: list[int], deepest: int
) -> np.ndarray:
    """Rows (period, end) of the squares that the next word does not continue."""
    n = len(words)
    found = [np.zeros((0, 2), np.int64)]
    held: list[tuple[int, int, int, int, int]] = []  # child from, to; interval from, to; depth
    pairs = 0

    def look() -> None:
        low, high, left, right, depth = np.array(held, np.int64).T
        size = high - low
        index = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        at = suffix[index]
        left, right, depth = (np.repeat(c, size) for c in (left, right, depth))
        for start, other in ((at, at + depth), (at - depth, at - depth)):
            ok = (other >= 0) & (other < n)
            spot = place[np.where(ok, other, 0)]
            ok &= (left <= spot) & (spot < right)
            s, d = start[ok], depth[ok]
            end = s + 2 * d
            # both suffixes hold depth words; the square branches where the next ones differ
            branch = (end == n) | (words[s + d] != words[np.minimum(end, n - 1)])
            found.append(np.stack([d[branch], end[branch]], axis=1))

    for depth, cuts in lcp_intervals(lcp, deepest):
        widest = max(range(len(cuts) - 1), key=lambda c: cuts[c + 1] - cuts[c])
        for c in range(len(cuts) - 1):
            if c != widest:
                held.append((cuts[c], cuts[c + 1], cuts[0], cuts[-1], depth))
                pairs += cuts[c + 1] - cuts[c]
        if pairs >= PAIRS:
            look()
            held.clear()
            pairs = 0
    if held:
        look()
    return np.unique(np.concatenate(found), axis=0)


def rotate(words: np.ndarray, start: int, period: int) -> int:
    """The first word from which the period holds up to ``start`` and on."""
    step = 64
    while start:
        low = max(0, start - step)
        differ = np.flatnonzero(words[low:start] != words[low + period : start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, step = low, 2 * step
    return 0


def runs_of(
    words: np.ndarray, suffix: np.ndarray, least: int, exponent: int
) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of the runs of one text, by start, then period."""
    n = len(words)
    place = np.empty(n, np.int64)
    place[suffix] = np.arange(n)
    lcp = common_prefixes(words.tolist(), suffix.tolist(), place.tolist())
    by_end: dict[int, list[tuple[int, int]]] = {}
    runs = []
    # periods ascending: a square whose period is a multiple lies in a run that is known
    for period, end in branching_squares(words, suffix, place, lcp, n // exponent).tolist():
        known = by_end.setdefault(end, [])
        if any(period % q == 0 and start <= end - 2 * period for q, start in known):
            continue
        start = rotate(words, end - 2 * period, period)
        known.append((period, start))
        if end - start >= max(least, exponent * period):
            runs.append((start, end - start, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that stand in no run behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def split_words(text: str | None) -> list[bytes]:
    """Words of a text: what is between blanks and the controls 09 to 0D."""
    return text.encode().split() if text else []  # of bytes, these alone are white space


def find_runs(texts: list[str | None], least: int, exponent: int):
    """For each text: its number of words, its runs, its collapsed text."""
    split = [split_words(t) for t in texts]
    number: dict[bytes, int] = {}
    length = np.array([len(ws) for ws in split], np.int64)
    bounds = np.r_[0, np.cumsum(length)]
    flat = np.fromiter((number.setdefault(w, len(number)) for ws in split for w in ws), np.int64, bounds[-1])
    runs: dict[int, list[tuple[int, int, int]]] = {}
    if len(flat):
        codes = np.repeat(np.arange(len(texts)), length) * len(number) + flat
        suffix, repeats = suffix_arrays(codes, bounds, least - least // exponent)
        for t in repeats.tolist():
            a, b = bounds[t], bounds[t + 1]
            found = runs_of(flat[a:b], suffix[a:b] - a, least, exponent)
            if found:
                runs[t] = found
    for t, ws in enumerate(split):
        found = runs.get(t, [])
        if found:
            keep = kept_words(len(ws), found).tolist()
            ws = [w for w, k in zip(ws, keep, strict=True) if k]
        yield int(length[t]), found, b" ".join(ws).decode()


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 24,
    exponent: int = 3,
) -> DataFrame:
    """Per document: ``doc_id, n_words, runs`` (by start, then period) and ``collapsed``.

    A run has ``least`` words or more and repeats its period ``exponent`` times or
    more.  ``collapsed`` is the text without the words that repeat a run's first
    period, joined by one blank.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, limit=SORTED_BYTES):
                rows = list(find_runs(batch.column("text").to_pylist(), least, exponent))
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in row[1]] for row in rows]
                kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([row[0] for row in rows], pa.int64()),
                        pa.array(runs, kind),
                        pa.array([row[2] for row in rows], pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    if least < 1 or exponent < 2:
        raise ValueError("a run needs a length of 1 word and an exponent of 2 at least")
    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return picked.mapInArrow(find, SCHEMA)
