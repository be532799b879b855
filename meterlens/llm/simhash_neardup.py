"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are 64-bit majority votes over XXH64 hashes of word shingles.
Equal fingerprints are one row from there on.  Two fingerprints within the
radius agree on at least ``BLOCKS - radius`` of the blocks of bits (pigeonhole),
so every pair meets in a bucket keyed by that many whole blocks.

Inside a bucket the fingerprints are stored vertically: plane b holds bit b of
64 fingerprints per word.  A query fingerprint XORs each plane with its own bit
and adds the 64 difference bits to carry-save counters (one word per counter
bit); a block of 64 is abandoned as soon as all its counters exceed the radius.
A bucket yields only the links of a spanning forest, never all pairs.  A bucket
above ``CHUNK`` fingerprints is dealt out as pairs of chunks, so no task holds
more than two chunks and no pair is lost.

Defined results: null and empty texts have fingerprint zero and link like any
other; a text of fewer words than a shingle is hashed whole; repeated rows get
equal results; an empty table gives no rows; other columns are ignored; a
fingerprint whose documents all lack an id has no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import slices, staged
from meterlens.llm.components import connected_components

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BLOCKS = 6
CHUNK = 8192
ABANDON_EVERY = 8  # planes between two checks for blocks to abandon
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> bytes:
    """Eight bytes, most significant first."""
    words = (text or "").encode().lower().split()  # ASCII white space and letters only
    n = len(words)
    if not n:
        return bytes(8)
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_digest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)])
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 19):  # bounded even for a very long text
        part = np.frombuffer(hashes[at : at + (1 << 19)], np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(votes * 2 > len(starts)).tobytes()


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """``(doc_id, fp)``, fp a signed long with the fingerprint's bits."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                raw = b"".join([fingerprint(t, shingle) for t in batch.column("text").to_pylist()])
                fp = np.frombuffer(raw, ">i8").astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"]
                )

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return picked.mapInArrow(measure, "doc_id long, fp long")


# --------------------------------------------------------------------------
# bit-sliced comparison of the rows of one or many buckets
# --------------------------------------------------------------------------


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """(64, ceil(n / 64)) words: bit i of plane b, word w is bit b of fp[64 w + i]."""
    n = len(fp)
    padded = np.zeros(-(-n // 64) * 64, np.uint64)
    padded[:n] = fp
    bits = np.unpackbits(padded.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    by_word = np.ascontiguousarray(bits.T).reshape(64, -1, 64)
    return np.packbits(by_word, axis=2, bitorder="little").view("<u8").reshape(64, -1)


def _exceed(counters: list, over, radius: int):
    """Lanes whose counter is above the radius."""
    above, equal = over, ~over
    for level in reversed(range(len(counters))):
        if radius >> level & 1:
            equal = equal & counters[level]
        else:
            above = above | (equal & counters[level])
            equal = equal & ~counters[level]
    return above


def close_lanes(planes, query, words, lanes, radius: int):
    """Of the 64 fingerprints in ``words[i]`` (those in ``lanes[i]``), the ones close to ``query[i]``.

    Returns the rows still open at the end and their lanes.
    """
    open_rows = np.arange(len(query))
    depth = radius.bit_length()
    counters = [np.zeros(len(query), np.uint64) for _ in range(depth)]
    over = np.zeros(len(query), np.uint64)
    for plane in range(0, 64, 2):
        x, y = (
            planes[b][words] ^ (ONES * ((query >> np.uint64(63 - b)) & np.uint64(1)))
            for b in (plane, plane + 1)
        )
        # carry-save: the lowest counter takes both planes in one full adder
        half = counters[0] ^ x
        carry = (counters[0] & x) | (half & y)
        counters[0] = half ^ y
        for level in range(1, depth):
            up = counters[level] & carry
            counters[level] = counters[level] ^ carry
            carry = up
        over = over | carry
        if plane % ABANDON_EVERY == ABANDON_EVERY - 2:
            near = lanes & ~_exceed(counters, over, radius)
            still = near != 0
            if not still.all():
                open_rows, query, words, lanes, over = (
                    a[still] for a in (open_rows, query, words, lanes, over)
                )
                counters = [c[still] for c in counters]
                if not len(open_rows):
                    break
    return open_rows, lanes & ~_exceed(counters, over, radius)


class Forest:
    """Union-find over row numbers; the root of a tree is its smallest row."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.roots()
        a, b = root[a], root[b]
        new = a != b
        if not new.any():
            return
        pairs = np.unique(np.sort(np.stack([a[new], b[new]], axis=1), axis=1), axis=0)
        for i, j in pairs.tolist():
            i, j = self.find(i), self.find(j)
            if i != j:
                self.parent[max(i, j)] = min(i, j)


def bucket_links(fp: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (row, root row) of the graph "same bucket and within radius".

    Rows of a bucket are contiguous.  Every row is compared with the rows of its
    bucket, 64 at a time.
    """
    n = len(fp)
    if n < 2:
        return np.empty(0, int), np.empty(0, int)
    edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    size = np.diff(edge)
    end = np.repeat(edge[1:], size)
    planes, forest, rows = bit_planes(fp), Forest(n), np.arange(n)
    # a pair is found from its first row, which looks at the rows after it
    active = rows[rows + 1 < end]
    step = 0
    while len(active):
        word = (active + 1) // 64 + step
        low = np.maximum(active + 1 - word * 64, 0)
        high = np.minimum(end[active] - word * 64, 64)
        inside = high > 0
        active, word, low, high = active[inside], word[inside], low[inside], high[inside]
        if not len(active):
            break
        lanes = (ONES << low.astype(np.uint64)) & (ONES >> (64 - high).astype(np.uint64))
        opened, near = close_lanes(planes, fp[active], word, lanes, radius)
        if len(opened):
            bits = np.unpackbits(near.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r, lane = np.nonzero(bits)
            forest.join(active[opened][r], word[opened][r] * 64 + lane)
        step += 1
    root = forest.roots()
    linked = np.flatnonzero(root != rows)
    return linked, root[linked]


def _compare(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive ordered by bucket; a bucket cut by a batch border is carried over."""

        def links(fp, node, bucket):
            a, b = bucket_links(fp, bucket, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(node[a]), pa.array(node[b])], names=["a", "b"]
            )

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "node", "bucket")]
            cols[0] = cols[0].view(np.uint64)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            cut = np.searchsorted(cols[2], cols[2][-1])
            held = [c[cut:] for c in cols]
            if cut:
                yield links(*(c[:cut] for c in cols))
        if held is not None:
            yield links(*held)

    return compare


def band_keys(fp, blocks: int, agree: int) -> list:
    """Bucket keys of a fingerprint: one per choice of ``agree`` whole blocks.

    A key hashes the choice with its blocks; should two buckets ever share a
    key, their rows are compared once more than needed.
    """
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = [
        F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        for lo, hi in zip(cuts, cuts[1:], strict=False)
    ]
    return [
        F.xxhash64(F.lit(t), *(part[i] for i in chosen))
        for t, chosen in enumerate(combinations(range(blocks), agree))
    ]


def fingerprint_links(
    distinct_fp: DataFrame, radius: int = RADIUS, chunk: int = CHUNK, blocks: int = BLOCKS
) -> DataFrame:
    """Links ``(a, b)`` between nodes whose fingerprints differ in at most ``radius`` bits.

    ``distinct_fp`` has one row ``(fp, node)`` per fingerprint.  The links join
    exactly the pairs' connected components (a forest per bucket).
    """
    if not 0 < radius < blocks:
        raise ValueError("0 < radius < blocks is needed for whole-block agreement")
    bands = distinct_fp.select(
        "fp", "node", F.explode(F.array(*band_keys(F.col("fp"), blocks, blocks - radius))).alias("key")
    )
    # buckets above the chunk size: rows go to every pair of chunks that has theirs
    hot = (
        bands.groupBy("key")
        .agg(F.count("*").alias("size"))
        .filter(F.col("size") > chunk)
        .select("key", F.ceil(F.col("size") / chunk).cast("int").alias("chunks"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = (
        bands.join(hot, "key", "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .select("fp", "node", "key", "chunks", own.alias("own"), other.alias("other"))
        .select(
            "fp",
            "node",
            F.when(F.col("chunks") == 1, F.col("key"))
            .otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
            .alias("bucket"),
        )
    )
    return (
        dealt.repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_compare(radius), "a long, b long")
    )


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per document."""
    prints = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fp")
    distinct_fp = staged(
        prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-distinct"
    )
    links = fingerprint_links(distinct_fp.filter("node is not null"), radius, chunk)
    parts = connected_components(links)
    labels = distinct_fp.join(parts, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
