"""Secret scan: known shapes plus sliding-window entropy.

Base kinds are three fixed patterns.  The method then looks at candidate
strings (long runs of token characters) and slides a window over the runs of
each character class, keeping the window's character counts and the sum of
c*log2(c) up to date as one character enters and one leaves.  Windows at or
above the class's entropy threshold are merged into spans.  Candidates on the
allow list, and spans that lie inside a base span, are not reported.

Defined results: a null text counts as empty; an empty text gives zero counts
and empty strings; every input row gives one output row, repeated rows
included; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import namedtuple
from collections.abc import Iterator
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame

from meterlens.llm.common import slices

# Fixed patterns of the base kinds, in their listed order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
BASE_KINDS = ("assign", "access", "hex")

CANDIDATE_MIN = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % CANDIDATE_MIN)
ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (ACCESS_MIN - 4))
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_MIN)

#: name, characters of the class, window length, least entropy in bits.
EntropyClass = namedtuple("EntropyClass", "name pattern window bits")
CLASSES = (
    EntropyClass("entropy_hex", r"[0-9A-Fa-f]+", 20, 3.0),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/]+", 20, 3.7),
    EntropyClass("entropy_token", r"[A-Za-z0-9_-]+", 20, 3.7),
)
#: Candidates that look random but aren't secret; matched against the whole run of a class.
ALLOW_LIST = (
    r"[0-9]+",  # plain numbers
    r"[A-Za-z]?[a-z]+|[A-Z]+",  # long words
    r"[A-Za-z]+(?:[-_/+][A-Za-z]+)+",  # hyphenated words, identifiers and paths
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",  # UUIDs
    r"(?i:.*(?:example|placeholder|changeme).*)",  # documentation values
)

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "spans string, n_entropy long"
)


def entropy_windows(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged spans of ``run`` covered by windows whose entropy is at least ``bits``."""
    n = len(run)
    if n < window:
        return []
    term = [0.0] + [c * log2(c) for c in range(1, window + 1)]
    # H = log2(w) - sum(c log2 c) / w
    most = (log2(window) - bits) * window + 1e-9
    counts: dict[str, int] = {}
    total = 0.0
    found: list[tuple[int, int]] = []
    for i, ch in enumerate(run):
        if i >= window:
            old = run[i - window]
            c = counts[old]
            total += term[c - 1] - term[c]
            counts[old] = c - 1
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
        if i >= window - 1 and total <= most:
            start = i + 1 - window
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


class Cover:
    """Spans in order of their starts; tells by one bisection whether one of them holds a span."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts = [s for s, _ in spans]
        self.reach = list(accumulate((e for _, e in spans), max))

    def holds(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, start)
        return i > 0 and self.reach[i - 1] >= end


class Scanner:
    """Compiled parameters; ``scan`` gives (base spans, entropy spans) of one text."""

    def __init__(self, classes=CLASSES, allow_list=ALLOW_LIST):
        self.classes = [(c, re.compile(c.pattern)) for c in classes]
        self.allow = re.compile("|".join(f"(?:{p})" for p in allow_list) or r"(?!)")

    def scan(self, text: str) -> tuple[list, list]:
        base = [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_MIN
        ]
        runs = list(CANDIDATE.finditer(text))
        for run in runs:
            # long enough access and hex matches lie whole inside one candidate
            base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, *run.span())]
            base += [(m.start(), 2, m.end()) for m in HEX.finditer(text, *run.span())]
        base.sort()
        cover = Cover([(s, e) for s, _, e in base])
        added = []
        for run in runs:
            if self.allow.fullmatch(run[0]):
                continue
            seen: list[Cover] = []  # the spans of each class before, in order
            for order, (kind, pattern) in enumerate(self.classes):
                found: list[tuple[int, int]] = []
                for m in pattern.finditer(run[0]):
                    if self.allow.fullmatch(m[0]):
                        continue
                    for a, b in entropy_windows(m[0], kind.window, kind.bits):
                        a, b = run.start() + m.start() + a, run.start() + m.start() + b
                        # spans of one class don't touch, so only other classes can hold them
                        if cover.holds(a, b) or any(c.holds(a, b) for c in seen):
                            continue
                        found.append((a, b))
                        added.append((a, len(BASE_KINDS) + order, b))
                seen.append(Cover(found))
        return base, added

    def kind(self, order: int) -> str:
        n = len(BASE_KINDS)
        return BASE_KINDS[order] if order < n else self.classes[order - n][0].name

    def joined(self, spans) -> str:
        return ",".join(f"{self.kind(k)}:{s}:{e}" for s, k, e in spans)


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes=CLASSES,
    allow_list=ALLOW_LIST,
) -> DataFrame:
    """One row per document: counts per base kind, digest of the base spans, all spans.

    A map over the rows: no shuffle, memory bounded by one slice of a batch.
    Spans are ``kind:start:end`` in code points, end exclusive, ordered by start.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(classes, allow_list)
        for whole in batches:
            for batch in slices(whole):
                cols: list[list] = [[] for _ in range(6)]
                for text in batch.column("text").to_pylist():
                    base, added = scanner.scan(text or "")
                    kinds = [k for _, k, _ in base]
                    row = (
                        kinds.count(0),
                        kinds.count(1),
                        kinds.count(2),
                        hashlib.sha256(scanner.joined(base).encode()).hexdigest(),
                        scanner.joined(sorted(base + added)),
                        len(added),
                    )
                    for col, value in zip(cols, row, strict=True):
                        col.append(value)
                names = [f.split()[0] for f in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()),
                        *(
                            pa.array(c, pa.string() if n in ("base_sha256", "spans") else pa.int64())
                            for n, c in zip(names[1:], cols, strict=True)
                        ),
                    ],
                    names=names,
                )

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return picked.mapInArrow(scan, SCHEMA)
