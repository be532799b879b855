"""Token-id files: Simple-8b word-aligned coding with per-block offsets.

A file (Parquet, so that Spark's writers, commits and readers work anywhere)
has one row per run of documents in ascending id order: ids and token counts of
the documents, the payload as 64-bit words, and the word offset of every block
of ``BLOCK`` ids.  The top four bits of a word select how many ids of which
width share the other 60; selector 0 is the escape for a value of 60 bits or
more, which follows as a whole word.  Blocks are coded on their own, all blocks
of a run at the same time, and a run is decoded with one gather per selector.

Documents are range-partitioned by id before they are tokenised, so files and
rows are in order and no shard holds more than its range.  Positions in the
whole corpus come from sums: per row within a shard, and over the shards (as
many rows as there are write tasks).

Defined results: a null or empty text has only the end id; rows without an id
come first; repeated ids keep one row each, ordered by text hash; an empty
table writes no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlens.llm.common import RecentIds, slices
from meterlens.session import scratch_path

END_ID = 2
BLOCK = 1024
#: Fixed values of the format: ids per word and bits per id, by selector (0: escape).
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

FILE_SCHEMA = (
    "shard int, seq int, doc_ids array<long>, n_tokens array<int>, "
    "block_offsets array<int>, words binary"
)


# --------------------------------------------------------------------------
# Simple-8b
# --------------------------------------------------------------------------


SMALL_WIDTHS = np.frexp(np.arange(1 << 16).astype(float))[1].astype(np.int8)


def bit_widths(values: np.ndarray) -> np.ndarray:
    """Bits needed by each unsigned value; 0 for zero."""
    if not len(values) or values.max() < len(SMALL_WIDTHS):
        return SMALL_WIDTHS[values.astype(np.int64)]
    high = values >> np.uint64(32)
    low = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(float))[1]  # exact below 2^53
    if not high.any():
        return low.astype(np.int8)
    return np.where(high != 0, 32 + np.frexp(high.astype(float))[1], low).astype(np.int8)


def _two(widest: np.ndarray, apart: int) -> np.ndarray:
    out = widest.copy()
    np.maximum(widest[:-apart], widest[apart:], out=out[:-apart])
    return out


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the word offset of every block of ``block`` values."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blocks = -(-n // block)
    reach = int(COUNTS[1:].max())
    # every block gets zeros behind it: the last word of a block may be part empty
    grid = np.zeros((blocks, block + reach), np.uint64)
    flat = np.zeros(blocks * block, np.uint64)
    flat[:n] = values
    grid[:, :block] = flat.reshape(blocks, block)
    width = np.concatenate([bit_widths(grid.ravel()), np.zeros(reach, np.int8)])
    choice = np.zeros(grid.size, np.int8)  # 0: escape
    widest = {1: width}  # by count: the largest width among so many values from each place on
    for selector in range(15, 0, -1):
        count = int(COUNTS[selector])
        if count not in widest:
            half = max(c for c in widest if c < count)
            if 2 * half < count:  # not reached in one doubling
                widest[2 * half] = _two(widest[half], half)
                half *= 2
            widest[count] = _two(widest[half], count - half)
        fits = widest[count][: grid.size] <= WIDTHS[selector]
        np.copyto(choice, selector, where=fits)
        if selector < 15 and np.count_nonzero(fits) < grid.size // 50 + blocks * reach:
            break  # longer runs of smaller values are rarer still (blocks end in zeros)
    choice = choice.reshape(grid.shape)
    length = np.minimum(block, n - np.arange(blocks) * block)
    at = np.zeros(blocks, np.int64)
    open_ = np.arange(blocks)
    rows, places, steps = [], [], []
    step = 0
    while len(open_):
        selector = choice[open_, at[open_]]
        rows.append(open_)
        places.append(at[open_])
        steps.append(np.full(len(open_), step))
        at[open_] += COUNTS[selector]
        open_ = open_[at[open_] < length[open_]]
        step += 1
    row, place = np.concatenate(rows), np.concatenate(places)
    across = grid.shape[1]
    at_word = np.sort(row * across + place)  # places in the flat grid, a block behind the other
    flat = grid.ravel()
    selector = choice.ravel()[at_word].astype(np.int64)
    size = 1 + (selector == 0)
    offset = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in range(1, 16):
        mine = np.flatnonzero(selector == s)
        if not len(mine):
            continue
        word = np.full(len(mine), s << 60, np.uint64)
        if WIDTHS[s]:
            first = at_word[mine]
            for k in range(COUNTS[s]):
                word |= flat[first + k] << np.uint64(k * WIDTHS[s])
        words[offset[mine]] = word
    escaped = np.flatnonzero(selector == 0)
    words[offset[escaped] + 1] = flat[at_word[escaped]]
    first = np.searchsorted(at_word, np.arange(blocks) * across)
    return words, offset[first]


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values of a packed run."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    # a word behind an escape is a value, whatever its top bits are; the words
    # of a run of zero selectors alternate between escape and value
    zero = selector == 0
    run_start = np.flatnonzero(zero & ~np.r_[False, zero[:-1]])
    head = np.ones(len(words), bool)
    if len(run_start):
        head = _heads(selector)
    place = np.flatnonzero(head)
    selector = selector[place]
    count = COUNTS[selector]
    # where each word's values go: running counts restart at every block
    word_block = np.searchsorted(offsets, place, "right") - 1
    total = np.cumsum(count) - count
    first = np.searchsorted(place, offsets)
    target = word_block * block + total - total[first][word_block]
    blocks = len(offsets)
    out = np.zeros(blocks * block + int(COUNTS.max()), np.uint64)
    limit = np.minimum((word_block + 1) * block, n)
    for s in range(2, 16):
        mine = np.flatnonzero(selector == s)
        if not len(mine):
            continue
        shift = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
        value = (words[place[mine]][:, None] >> shift) & np.uint64((1 << int(WIDTHS[s])) - 1)
        to = target[mine][:, None] + np.arange(COUNTS[s])
        inside = to < limit[mine][:, None]
        out[to[inside]] = value[inside]
    escaped = np.flatnonzero(selector == 0)
    out[target[escaped]] = words[place[escaped] + 1]
    return out[:n]


def _heads(selector: np.ndarray) -> np.ndarray:
    """Words that are not the value of an escape; escapes are rare, so a walk over them."""
    head = np.ones(len(selector), bool)
    skip = -1
    for i in np.flatnonzero(selector == 0).tolist():
        if i == skip:
            continue  # this one is a value
        head[i + 1] = False
        skip = i + 1
    return head


# --------------------------------------------------------------------------
# tokenising
# --------------------------------------------------------------------------

WORD_SUFFIX = "</w>"
#: Text in which every letter run, digit and punctuation run is a token of the
#: vocabulary's own first split, whatever stands around it.
PLAIN = r"\x21-\x26\x28-\x7EÀ-ÖØ-öø-ÿ"
NOT_PLAIN = re.compile(rf"[^\t\n\r\x20{PLAIN}]|<\|")
PLAIN_BYTES = re.sub(rf"[^\t\n\r\x20{PLAIN}]", "", bytes(range(256)).decode("latin-1")).encode("latin-1")
PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
ASCII_PARTS = re.compile(r"[a-z]+|[0-9]|[^\t-\r\x20a-z0-9]+")
#: Kinds of plain characters (0: white space, 1: letter, 2: digit, 3: punctuation), and which
#: neighbours belong to two parts.  White space parts words by itself.
KINDS = bytes(0 if c.isspace() else 1 if c.isalpha() else 2 if c.isdigit() else 3 for c in map(chr, range(256)))
APART = np.array([[0, 0, 0, 0], [0, 0, 1, 1], [0, 1, 1, 1], [0, 1, 1, 0]], bool).ravel()
LONG_TEXT = 256
MEMORY = 600_000  # parts remembered before a worker starts anew


def is_plain(text: str) -> bool:
    """Whether ``NOT_PLAIN`` finds nothing; all plain characters are Latin-1 ones."""
    try:
        left = text.encode("latin-1").translate(None, PLAIN_BYTES)
    except UnicodeEncodeError:
        return False
    return not left and "<|" not in text


def plain_parts(text: str) -> list[str]:
    """The parts of a plain text; those of a long one are told by where the kind of character changes."""
    if len(text) < LONG_TEXT:
        return (ASCII_PARTS if text.isascii() else PARTS).findall(text.lower())
    raw = text.encode("latin-1")
    kind = np.frombuffer(raw.translate(KINDS), np.uint8)
    at = np.flatnonzero(APART[kind[:-1] * 4 + kind[1:]]) + 1
    return np.insert(np.frombuffer(raw, np.uint8), at, 32).tobytes().decode("latin-1").lower().split()


class PartTokenizer:
    """Encodes the distinct parts of a slice with the library, and remembers recent ones.

    Parts are what the vocabulary's first split makes of plain Latin text; any
    other word goes to the library whole.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(spec)
        vocabulary = self.lib.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_SUFFIX)]] = True
        self.memory = RecentIds(self.code, MEMORY)

    def split(self, text: str) -> list[str]:
        if is_plain(text):
            return plain_parts(text)
        out = []
        for word in text.split(" "):
            if is_plain(word):
                out += plain_parts(word)
            elif word:
                out.append(f" {word}")  # a blank marks a word that goes whole
        return out

    def code(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts, their starts and numbers; plain ones are encoded as one text and cut at word ends."""
        goes_whole = np.fromiter((p[0] == " " for p in parts), bool, len(parts))
        length = np.zeros(len(parts), np.int64)
        coded = []
        simple = parts if not goes_whole.any() else [p for p in parts if p[0] != " "]
        if simple:
            # the fast form gives the same ids without their places in the text
            joined = self.lib.encode_batch_fast([" ".join(simple)], add_special_tokens=False)[0]
            ids = np.array(joined.ids, np.uint32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(simple):
                raise ValueError("the vocabulary does not end every part with its suffix")
            length[~goes_whole] = np.diff(cut, prepend=0)
            coded.append(ids)
        whole = [p[1:] for p in parts if p[0] == " "] if goes_whole.any() else []
        if whole:
            found = [e.ids for e in self.lib.encode_batch_fast(whole, add_special_tokens=False)]
            length[goes_whole] = list(map(len, found))
            coded += [np.array(ids, np.uint32) for ids in found]
        # the plain parts' ids lie before those of the others
        order = np.argsort(goes_whole, kind="stable")
        start = np.empty(len(parts), np.int64)
        start[order] = np.cumsum(length[order]) - length[order]
        return np.concatenate(coded), start, length

    def encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end id, and the number of ids per text."""
        parts = (self.split(t) if t else [] for t in texts)
        ids, bounds = self.memory.encode(parts, np.array([end_id], "<u4").tobytes())
        return ids, np.diff(bounds)


_TOKENIZERS: dict[str, PartTokenizer] = {}


def worker_tokenizer(spec: str) -> PartTokenizer:
    """The Python worker's tokenizer, kept from task to task."""
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[name] = PartTokenizer(spec)
    return _TOKENIZERS[name]


# --------------------------------------------------------------------------
# files
# --------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    path: str,
    spec: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> None:
    """Tokenise ``docs`` and write the files in ascending id order.

    ``spec`` is the content of a tokenizer file; tasks need no access to it.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_tokenizer(spec)
        shard, seq = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole):
                ids, counts = tokenizer.encode(batch.column("text").to_pylist(), end_id)
                words, offsets = pack(ids.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([seq], pa.int32()),
                        pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([counts.tolist()], pa.list_(pa.int32())),
                        pa.array([offsets.tolist()], pa.list_(pa.int32())),
                        pa.array([words.astype("<u8").tobytes()]),
                    ],
                    names=[f.split()[0] for f in FILE_SCHEMA.split(", ")],
                )
                seq += 1

    picked = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    ordered = picked.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(code, FILE_SCHEMA).write.parquet(path)


def file_starts(files: DataFrame) -> DataFrame:
    """``(shard, seq, row_start)``: ids of the whole corpus before each row of the files."""
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = files.select("shard", "seq", size.alias("n"))
    within = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = rows.groupBy("shard").agg(F.sum("n").alias("n"))  # one row per write task
    shards = shards.select("shard", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    return rows.join(shards, "shard").select(
        "shard", "seq", (F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("row_start")
    )


def decode_rows(batch: pa.RecordBatch):
    """(row dict, ids of the row) for every row of the files."""
    for row in batch.to_pylist():
        words = np.frombuffer(row["words"], "<u8").astype(np.uint64)
        offsets = np.array(row["block_offsets"], np.int64)
        yield row, unpack(words, offsets, sum(row["n_tokens"]))


def read_token_ids(files: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of every document in the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, ids in decode_rows(batch):
                bounds = np.r_[0, np.cumsum(row["n_tokens"])].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), lists], names=["doc_id", "ids"]
                )

    return files.mapInArrow(read, "doc_id long, ids array<long>")


def token_index(files: DataFrame) -> DataFrame:
    """Per document, from the files: start in the corpus, number of ids, their CRC-32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, ids in decode_rows(batch):
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(np.array(row["n_tokens"], np.int64))
                starts = ends - np.array(row["n_tokens"], np.int64)
                crc = [
                    zlib.crc32(raw[4 * a : 4 * b])
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                ]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array([row["seq"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts),
                        pa.array(ends - starts),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["shard", "seq", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    found = files.mapInArrow(
        read, "shard int, seq int, doc_id long, offset long, n_tokens long, ids_crc32 long"
    )
    return found.join(file_starts(files), ["shard", "seq"]).select(
        "doc_id", (F.col("row_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(spark: SparkSession, docs: DataFrame, spec: str, **columns) -> DataFrame:
    """Write the files under the shared folder and open them."""
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, spec, **columns)
    return spark.read.schema(FILE_SCHEMA).parquet(path)
