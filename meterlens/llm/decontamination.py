"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` turns the documents into index segments, stored as a table: one
row per segment of a few megabytes of text, with its documents and, for every
test term, the positions of the term in the segment (delta-coded, compressed).
``search_index`` sends the test windows to every segment and intersects
offset-adjusted posting lists, beginning with the term that is rarest in that
segment; one pass finds near matches (every term within ``slop`` words of its
place) and the exact phrases among them.  The index is partitioned by document,
so nothing is shuffled and a term that occurs everywhere is no hot key.

Test items go to the tasks in blocks of at most ``BLOCK_CHARS`` characters
(measured first); a larger test set takes more passes over the documents.

Defined results: null and empty texts have no words, no hits and no items; an
item without words or without an id is left out; an item shorter than the
window is one window; repeated rows get equal results; empty documents or test
tables give no rows, or rows without hits; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import slices, staged

WINDOW = 10
SLOP = 2
BLOCK_CHARS = 8 << 20
CANDIDATES = 1 << 21  # candidate positions examined at a time

# Word bytes: digits, letters, everything outside ASCII; A-Z become a-z, the rest blanks.
FOLD = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() and b < 128 else b if b >= 128 else 32
    for b in range(256)
)

INDEX_SCHEMA = (
    "doc_ids array<long>, doc_keys array<long>, n_words array<int>, "
    "terms binary, counts binary, postings binary"
)
SPANS = "array<struct<start:int,end:int>>"
MATCH_SCHEMA = (
    f"doc_id long, doc_key long, n_words long, hits {SPANS}, "
    "item_ids array<string>, near_item_ids array<string>"
)


def fold_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


@dataclass
class PhraseBlock:
    """Windows of a block of test items, over a vocabulary of its own."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray  # (n, WINDOW) term numbers, -1 beyond a short window
    lengths: np.ndarray
    item_names: list[str]
    window_items: np.ndarray  # items by window, concatenated
    window_starts: np.ndarray


def make_block(items: list[tuple[str, str]], window: int = WINDOW) -> PhraseBlock:
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple, set[int]] = {}
    names: dict[str, int] = {}
    for item_id, text in items:
        words = fold_words(text)
        if not words:
            continue
        ids = tuple(vocabulary.setdefault(w, len(vocabulary)) for w in words)
        item = names.setdefault(item_id, len(names))
        for at in range(max(1, len(ids) - window + 1)):
            owners.setdefault(ids[at : at + window], set()).add(item)
    matrix = np.full((len(owners), window), -1, np.int64)
    for row, ids in enumerate(owners):
        matrix[row, : len(ids)] = ids
    counts = [len(o) for o in owners.values()]
    return PhraseBlock(
        vocabulary,
        matrix,
        (matrix >= 0).sum(axis=1),
        list(names),
        np.array([i for o in owners.values() for i in sorted(o)], np.int64),
        np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
    )


def document_bases(n_words: np.ndarray, gap: int) -> np.ndarray:
    """First position of each document; documents lie further apart than a match reaches."""
    return gap + np.concatenate([[0], np.cumsum(n_words + gap)[:-1]]).astype(np.int64)


def build_index(
    docs: DataFrame, block: PhraseBlock, id_col="doc_id", text_col="text", gap: int = WINDOW + SLOP + 1
) -> DataFrame:
    """Index segments of all documents for the terms of a test block."""
    vocabulary = block.vocabulary

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, missing = vocabulary.get, -1
        for whole in batches:
            for batch in slices(whole):
                found = []
                for text in batch.column("text").to_pylist():
                    words = fold_words(text)
                    found.append(
                        np.fromiter((number(w, missing) for w in words), np.int32, len(words))
                    )
                n_words = np.array([len(f) for f in found], np.int64)
                base = document_bases(n_words, gap)
                place = np.arange(n_words.sum()) + np.repeat(
                    base - np.concatenate([[0], np.cumsum(n_words)[:-1]]), n_words
                )
                term = np.concatenate(found)
                known = term >= 0
                term, place = term[known], place[known]
                order = np.argsort(term, kind="stable")
                term, place = term[order], place[order]
                first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]][: len(term)])
                delta = np.diff(place, prepend=0)
                delta[first] = place[first]
                counts = np.diff(np.r_[first, len(term)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([batch.column("doc_key").to_pylist()], pa.list_(pa.int64())),
                        pa.array([n_words.tolist()], pa.list_(pa.int32())),
                        pa.array([zlib.compress(term[first].astype("<i4").tobytes(), 1)]),
                        pa.array([zlib.compress(counts.astype("<i4").tobytes(), 1)]),
                        pa.array([zlib.compress(delta.astype("<i4").tobytes(), 1)]),
                    ],
                    names=[f.split()[0] for f in INDEX_SCHEMA.split(", ")],
                )

    picked = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.xxhash64(docs[text_col]).alias("doc_key"),
        docs[text_col].alias("text"),
    )
    return picked.mapInArrow(index, INDEX_SCHEMA)


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges starts[i] .. starts[i] + counts[i]."""
    total = int(counts.sum())
    before = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.arange(total) + np.repeat(starts - before, counts)


def match_windows(block: PhraseBlock, keys, span: int, starts, counts, slop: int):
    """Yield (windows, places, exact) of the near matches in one segment.

    ``keys`` are term * span + place, sorted; ``starts`` and ``counts`` locate
    each term's list in it.
    """
    per_window = np.where(block.windows >= 0, counts[block.windows], np.iinfo(np.int64).max)
    alive = np.flatnonzero((per_window > 0).all(axis=1))
    order = np.argsort(per_window[alive], axis=1, kind="stable")
    rarest = per_window[alive, order[:, 0]] * (2 * slop + 1)
    part = np.cumsum(rarest) // CANDIDATES
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True][: len(part) + 1])
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        win, by = alive[lo:hi], order[lo:hi]
        term = block.windows[win, by[:, 0]]
        n = counts[term]
        places = keys[_runs(starts[term], n)] - np.repeat(term * span + by[:, 0], n)
        which = np.repeat(np.arange(len(win)), n)
        # any phrase start for which the rarest term is within the slop of its place
        shift = np.arange(-slop, slop + 1)
        places = (places[:, None] + shift).ravel()
        which = np.repeat(which, len(shift))
        pairs = np.unique(which * span + places)  # two occurrences may give the same start
        which, places = pairs // span, pairs % span
        for j in range(1, block.windows.shape[1]):
            off = by[which, j]
            term = block.windows[win[which], off]
            target = term * span + places + off
            at = np.searchsorted(keys, target - slop)
            hit = (term < 0) | (keys[np.minimum(at, len(keys) - 1)] <= target + slop) & (
                at < len(keys)
            )
            which, places = which[hit], places[hit]
            if not len(which):
                break
        exact = np.ones(len(which), bool)
        for off in range(block.windows.shape[1]):
            term = block.windows[win[which], off]
            target = term * span + places + off
            at = np.minimum(np.searchsorted(keys, target), len(keys) - 1)
            exact &= (term < 0) | (keys[at] == target)
        yield win[which], places, exact


def _names_by_document(block: PhraseBlock, windows, documents, n_docs: int) -> list[list[str]]:
    n = np.diff(block.window_starts)[windows]
    items = block.window_items[_runs(block.window_starts[windows], n)]
    pairs = np.unique(np.repeat(documents, n) * len(block.item_names) + items)
    out: list[list[str]] = [[] for _ in range(n_docs)]
    for d, i in zip(
        (pairs // len(block.item_names)).tolist(), (pairs % len(block.item_names)).tolist(), strict=True
    ):
        out[d].append(block.item_names[i])
    return out


def search_segment(block: PhraseBlock, n_words, terms, term_counts, delta, gap: int, slop: int):
    """Per document of the segment: hit spans, exact items, near items."""
    n_docs = len(n_words)
    base = document_bases(n_words, gap)
    span = int(base[-1] + n_words[-1] + gap)
    nothing = [[[] for _ in range(n_docs)] for _ in range(3)]
    if not len(delta):
        return nothing
    first = np.cumsum(term_counts) - term_counts
    total = np.cumsum(delta)
    place = total - np.repeat(total[first] - delta[first], term_counts)
    keys = np.repeat(terms, term_counts) * span + place
    counts = np.zeros(len(block.vocabulary), np.int64)
    starts = np.zeros(len(block.vocabulary), np.int64)
    counts[terms], starts[terms] = term_counts, first
    found = list(match_windows(block, keys, span, starts, counts, slop))
    if not found:
        return nothing
    windows, places, exact = (np.concatenate(x) for x in zip(*found, strict=True))
    # the start of a near match may lie before its document's first word
    documents = np.clip(np.searchsorted(base - gap // 2, places, "right") - 1, 0, n_docs - 1)
    near = _names_by_document(block, windows, documents, n_docs)
    windows, places, documents = windows[exact], places[exact], documents[exact]
    items = _names_by_document(block, windows, documents, n_docs)
    steps = np.zeros(span + 1, np.int32)
    np.add.at(steps, places, 1)
    np.add.at(steps, places + block.lengths[windows], -1)
    covered = np.cumsum(steps) > 0
    edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
    spans: list[list] = [[] for _ in range(n_docs)]
    for a, b in edges.reshape(-1, 2).tolist():
        d = int(np.searchsorted(base, a, "right")) - 1
        spans[d].append({"start": a - int(base[d]), "end": b - int(base[d])})
    return spans, items, near


def search_index(
    index: DataFrame, block: PhraseBlock, slop: int = SLOP, gap: int = WINDOW + SLOP + 1
) -> DataFrame:
    """One row per indexed document with its matches in the test block."""
    number = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def raw(blob: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(blob), "<i4").astype(np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n_words = np.array(row["n_words"], np.int64)
                found = search_segment(
                    block, n_words, *(raw(row[c]) for c in ("terms", "counts", "postings")), gap, slop
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["doc_keys"], pa.int64()),
                        pa.array(n_words),
                        pa.array(found[0], number),
                        pa.array(found[1], pa.list_(pa.string())),
                        pa.array(found[2], pa.list_(pa.string())),
                    ],
                    names=["doc_id", "doc_key", "n_words", "hits", "item_ids", "near_item_ids"],
                )

    return index.mapInArrow(search, MATCH_SCHEMA)


def item_blocks(items: DataFrame, id_col="item_id", text_col="text", window: int = WINDOW) -> list[PhraseBlock]:
    """Blocks of items, each collected under the size bound."""
    items = items.select(
        items[id_col].cast("string").alias("item_id"), items[text_col].cast("string").alias("text")
    ).filter("item_id is not null and text is not null").distinct()
    chars = items.agg(F.sum(F.length("text") + F.length("item_id"))).first()[0] or 0
    n = -(-int(chars) // BLOCK_CHARS) or 1
    slot = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [
        make_block([tuple(r) for r in items.filter(slot == k).collect()], window) for k in range(n)
    ]


def _merge(left: DataFrame, right: DataFrame) -> DataFrame:
    """Add another block's matches of the same documents."""
    on = ["doc_id", "doc_key"]
    more = right.dropDuplicates(on).select(
        *(F.col(c).alias(f"m_{c}") for c in (*on, "hits", "item_ids", "near_item_ids"))
    )
    joined = left.join(more, F.col("doc_id").eqNullSafe(F.col("m_doc_id")) & (F.col("doc_key") == F.col("m_doc_key")))
    empty = F.lit(None).cast(SPANS)
    ordered = F.array_sort(F.concat("hits", "m_hits"))

    def add(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        widened = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        return F.when(
            joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(widened))
        ).otherwise(F.concat(done, F.array(span)))

    start = F.coalesce(empty, F.array().cast(SPANS))
    return joined.select(
        *on,
        "n_words",
        F.aggregate(ordered, start, add).alias("hits"),
        F.array_union("item_ids", "m_item_ids").alias("item_ids"),
        F.array_union("near_item_ids", "m_near_item_ids").alias("near_item_ids"),
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
) -> DataFrame:
    """Per document: words, spans of words inside exact phrases, exact and near items."""
    out = None
    for block in item_blocks(items, window=window):
        gap = window + slop + 1
        index = staged(build_index(docs, block, id_col, text_col, gap), "test-term-index")
        part = search_index(index, block, slop, gap)
        out = part if out is None else _merge(out, part)
    return out
