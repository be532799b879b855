"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are tokenised where they are read; each gets an end token, and only
one longer than a sequence is cut, into whole sequences with the remainder in
front.  Lengths are whole numbers up to the sequence length, so best-fit
decreasing needs no more than how many pieces there are of each length: pieces of
one length are interchangeable, and so are bins with one remaining capacity.  A
segment tree over the remaining capacities gives the tightest one that is open
in logarithmic time; one step then places as many pieces of a length as its bins
hold (best fit goes on with the same bin while the next piece fits).  The
histogram, one row per length, is all that reaches the driver, and the steps
are the exact result of best-fit decreasing over all pieces of the corpus.

Every piece has a rank among the pieces of its length: its place within the task
that made it, behind the pieces of the tasks before.  Rank and steps give its
sequence and offset, so a length that a third of all pieces share is placed in
parallel, like any other.

Defined results: a null or empty text is one piece of one end token; repeated
rows and rows without an id are packed like any other (each row by itself); an
empty table packs nothing; other columns are ignored.  The packing depends on
the lengths alone; which of the pieces of one length goes where depends on how
Spark splits the input.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import slices, staged

SEQUENCE = 2048
END_ID = 0

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task int, place long"
)
STEP = ("length", "first", "n", "sequence_id", "per_bin", "offset")


# --------------------------------------------------------------------------
# best-fit decreasing on a histogram of lengths
# --------------------------------------------------------------------------


class CapacityTree:
    """Segment tree over remaining capacities 0 to ``most``; a leaf is set if such a bin is open."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        node = capacity + self.leaves
        self.any[node] = is_open
        while node > 1:
            node //= 2
            is_open = self.any[2 * node] or self.any[2 * node + 1]
            if self.any[node] == is_open:
                return
            self.any[node] = is_open

    def tightest(self, least: int) -> int | None:
        """The smallest open capacity of ``least`` or more."""
        node = least + self.leaves
        if self.any[node]:
            return least
        while node > 1:  # up to the first open subtree on the right
            if not node & 1 and self.any[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_steps(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, ...]]:
    """Best-fit decreasing over so many pieces of each length, as steps.

    A step (length, first, n, sequence, per bin, offset) places the pieces of a
    length from rank ``first`` on: ``per bin`` of them side by side, from
    ``offset`` on, in each of the sequences from ``sequence`` on.  Full bins
    are never looked at again.
    """
    tree = CapacityTree(size)
    bins: dict[int, list[tuple[int, int]]] = {}  # by remaining capacity: (first sequence, number)
    steps = []
    opened = 0

    def leave(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            bins.setdefault(capacity, []).append((first, n))
            tree.set(capacity, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, sequence = size, opened
                held = -(-left // (size // length))
                opened += held
            else:
                sequence, held = bins[capacity].pop()
                if not bins[capacity]:
                    tree.set(capacity, False)
            each = capacity // length
            n = min(left, held * each)
            full, rest = divmod(n, each)
            steps.append((length, rank, n, sequence, each, size - capacity))
            leave(capacity - each * length, sequence, full)
            if rest:
                leave(capacity - rest * length, sequence + full, 1)
            used = full + (rest > 0)
            leave(capacity, sequence + used, held - used)
            rank += n
            left -= n
    return steps


# --------------------------------------------------------------------------
# tokens
# --------------------------------------------------------------------------


def byte_names() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1
    letters stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


class ByteTokenizer:
    """A byte-level vocabulary file (``spec``: its content), encoded with its ranks.

    The file's merges must come in the order of the ids, so that merging by rank
    gives the same ids as the file's own library.
    """

    def __init__(self, spec: str):
        import public_tokenizers
        import tiktoken

        file = json.loads(spec)
        names = byte_names()
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        words = {w: i for w, i in file["model"]["vocab"].items() if w not in special}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in file["model"]["merges"]]
        if [words[m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("the merges of the vocabulary are not in the order of its ids")
        ranks = {bytes(map(names.__getitem__, w)): i for w, i in words.items()}
        self.lib = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def encode(self, text: str | None) -> np.ndarray:
        return self.lib.encode_to_numpy(text or "", allowed_special="all")


_TOKENIZERS: dict[str, ByteTokenizer] = {}


def worker_tokenizer(spec: str) -> ByteTokenizer:
    """The Python worker's tokenizer, kept from task to task."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[name] = ByteTokenizer(spec)
    return _TOKENIZERS[name]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: whole ones behind the remainder."""
    first = n - (n - 1) // size * size
    return [(0, first)] + [(at, size) for at in range(first, n, size)]


def token_pieces(
    docs: DataFrame,
    spec: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece, with ``task`` and ``place``: its rank among the pieces of
    its length in that task.  ``with_ids`` adds the ids themselves.

    To be written before use: a second run may deal the input out otherwise.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(spec)
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        end = np.array([end_id], "<u4")
        for whole in batches:
            for batch in slices(whole):
                rows, ids = [], []
                texts = batch.column("text").to_pylist()
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                    tokens = np.concatenate([tokenizer.encode(text).astype("<u4"), end])
                    for n, (start, length) in enumerate(cut(len(tokens), size)):
                        mine = tokens[start : start + length]
                        crc = zlib.crc32(mine.tobytes())
                        rows.append((doc_id, n, start, length, crc, task, seen[length]))
                        seen[length] += 1
                        if with_ids:
                            ids.append(mine.astype(np.int32))
                names = [f.split()[0] for f in PIECES.split(", ")]
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names = [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return picked.mapInArrow(pieces, schema)


# --------------------------------------------------------------------------
# placing
# --------------------------------------------------------------------------


def place_pieces(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (columns ``length, task, place``)."""
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = staged(counts, "piece-counts")  # at most the lengths for each task
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # size rows at most
    steps = np.array(best_fit_steps({r["length"]: r["n"] for r in histogram}, size), np.int64)
    steps = steps.reshape(-1, len(STEP))
    # by length, then rank: a piece's step is the last one that begins at its rank or before
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("place"))
    kept = [c for c in pieces.columns if c not in ("task", "place")]
    schema = ", ".join(f"{c} {t}" for c, t in ranked.select(*kept).dtypes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = np.searchsorted(steps[:, 0], np.arange(size + 2))
        # one sorted key over all steps: lengths far apart, ranks within them
        most = int((steps[:, 1] + steps[:, 2]).max()) + 1 if len(steps) else 1
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            if most < (1 << 62) // (size + 1):
                at = np.searchsorted(steps[:, 0] * most + steps[:, 1], length * most + rank, "right") - 1
            else:
                at = np.empty(len(length), np.int64)
                for value in np.unique(length).tolist():
                    mine = length == value
                    low, high = starts[value], starts[value + 1]
                    at[mine] = low + np.searchsorted(steps[low:high, 1], rank[mine], "right") - 1
            _, first, _, sequence, each, offset = steps[at].T
            n = rank - first
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(sequence + n // each), pa.array(offset + n % each * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    return ranked.select(*kept, "rank").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, spec: str, size: int = SEQUENCE, **options) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece
    (and ``ids`` with ``with_ids=True``).  Other options: those of :func:`token_pieces`."""
    pieces = staged(token_pieces(docs, spec, size=size, **options), "pieces")
    return place_pieces(pieces, size)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, doc_ids, lengths)`` of every sequence, from pieces with their ids.

    A group holds no more than a sequence's tokens.
    """
    piece = F.struct("offset", "doc_id", "length", "ids")
    pieces = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return pieces.select(
        "sequence_id",
        F.flatten("p.ids").alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.length").alias("lengths"),
    )
