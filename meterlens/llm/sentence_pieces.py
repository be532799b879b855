"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

A slice of texts is cut into chunks at white space, which no piece crosses, and
its distinct chunks are concatenated.  A suffix array over that text is sorted
as deep as the longest piece; a binary search of every piece gives its range of
occurrences.  The occurrences are the edges of a lattice over the text.  Sorted
by position they are relaxed from left to right: the byte-pair encoding of a
prefix ends in exactly one piece, namely the one whose edge starts where a
prefix ends in a piece that it can follow.  Two pieces can follow each other
when the merges of their joined text never cross the border between them; the
answer is kept per pair of pieces.

Characters that are in no piece become byte pieces.  Decoding concatenates the
pieces' bytes.

Defined results: null and empty texts have no ids and decode to an empty text; U+2581
decodes as a space, as in the model; null id lists decode to an empty text;
repeated rows get equal results; an empty table gives no rows; the encoder
passes other columns through, except ones named like its results, which it
replaces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import RecentIds, slices

SPACE = "▁"
SEPARATOR = 0xFF  # not in any UTF-8 text
#: Cached answers of "can piece b follow piece a", per Python worker.
PAIR_SLOTS = 1 << 21
#: Distinct chunk text indexed at a time, and chunks remembered before a worker starts anew.
GROUP_CHARS = 1 << 18
MEMORY = 300_000


@dataclass
class PieceModel:
    """A byte-fallback BPE vocabulary."""

    name: str  # digest of the file
    pieces: list[str]  # as text, by id; byte pieces are empty here
    rank: dict[str, int]  # merge order of the pieces with more than one character
    usable: np.ndarray  # pieces that the merges can build from their own characters
    byte_ids: np.ndarray  # (256,) ids of the byte pieces
    raw: list[bytes]  # decoded bytes of every id

    @property
    def size(self) -> int:
        return len(self.pieces)


def merge(symbols: list[str], rank: dict[str, int], border: int = -1) -> list[str] | None:
    """Byte-pair merges, best rank first and leftmost among equals.

    With ``border`` (a number of characters) the answer is None as soon as a
    merge crosses it.
    """
    symbols = list(symbols)
    while len(symbols) > 1:
        best, at = min(
            (rank.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))
        )
        if best == 1 << 30:
            break
        if border >= 0:
            start = sum(map(len, symbols[:at]))
            if start < border < start + len(symbols[at]) + len(symbols[at + 1]):
                if start + len(symbols[at]) == border:
                    return None
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


def load_model(path: str) -> PieceModel:
    """Read a vocabulary file; runs on the driver, the model travels with the task."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces, raw, byte_ids = [""] * n, [b""] * n, np.zeros(256, np.int64)
    normal = []
    for i in range(n):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte = int(name[3:5], 16)
            byte_ids[byte], raw[i] = i, bytes([byte])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[i], raw[i] = name, name.replace(SPACE, " ").encode()
            normal.append(i)
    if any(SPACE in pieces[i].lstrip(SPACE) for i in normal):
        raise ValueError("pieces that cross white space are not supported")
    ordered = sorted(normal, key=lambda i: (-sp.get_score(i), i))
    rank = {pieces[i]: r for r, i in enumerate(ordered) if len(pieces[i]) > 1}
    usable = np.zeros(n, bool)
    for i in normal:
        usable[i] = merge(list(pieces[i]), rank) == [pieces[i]]
    name = hashlib.sha256(Path(path).read_bytes()).hexdigest()
    return PieceModel(name, pieces, rank, usable, byte_ids, raw)


# --------------------------------------------------------------------------
# suffix array, occurrence ranges
# --------------------------------------------------------------------------


def eight_bytes(text: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Big-endian value of the 8 bytes from each position, zero beyond ``room`` bytes."""
    key = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        key = (key[: len(key) - width] << np.uint64(8 * width)) | key[width:]
    key = key[: len(text)]
    cut = np.uint64(8) * (np.uint64(8) - np.minimum(room, 8).astype(np.uint64))
    low = np.where(cut >= 64, np.uint64(0), cut)
    return np.where(cut >= 64, np.uint64(0), (key >> low) << low)


def suffix_array(keys: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """Positions with text in order of their next ``depth`` bytes (up to the separator)."""
    order = np.flatnonzero(room > 0)
    order = order[np.argsort(keys[order], kind="stable")]
    # positions that still tie are sorted again inside their group by the next 8 bytes
    tied = np.arange(len(order))
    group = _groups(keys[order])
    for at in range(8, depth, 8):
        size = np.bincount(group, minlength=0)
        open_ = (size[group] > 1) & (room[order[tied]] > at)
        # a whole group stays together if any of its members goes on
        keep = np.zeros(len(size), bool)
        keep[group[open_]] = True
        mask = keep[group]
        tied, group = tied[mask], group[mask]
        if not len(tied):
            break
        place = order[tied]
        goes_on = room[place] > at
        following = np.where(goes_on, keys[np.minimum(place + at, len(keys) - 1)], np.uint64(0))
        by = np.lexsort((following, group))
        order[tied] = place[by]
        group, following = group[by], following[by]
        group = np.cumsum(
            np.r_[0, (group[1:] != group[:-1]) | (following[1:] != following[:-1])].astype(np.int64)
        )
    return order


def _groups(ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]].astype(np.int64))


class Wanted:
    """Strings to search for, as 8-byte words with masks."""

    def __init__(self, strings: list[bytes]):
        self.depth = -(-max(map(len, strings)) // 8)
        wide = 8 * self.depth
        joined = b"".join([w.ljust(wide, b"\0") for w in strings])
        self.word = np.frombuffer(joined, ">u8").reshape(-1, self.depth).astype(np.uint64)
        joined = b"".join([(b"\xff" * len(w)).ljust(wide, b"\0") for w in strings])
        self.mask = np.frombuffer(joined, ">u8").reshape(-1, self.depth).astype(np.uint64)


def occurrence_ranges(order, keys, room, wanted: Wanted) -> tuple[np.ndarray, np.ndarray]:
    """[low, high) in the suffix array for each wanted string.

    The first 8 bytes are looked up in the ordered keys; a vectorised binary search in what is
    left finds the strings that are longer.
    """
    first = keys[order]
    low = np.searchsorted(first, wanted.word[:, 0], "left")
    high = np.searchsorted(first, wanted.word[:, 0] | ~wanted.mask[:, 0], "right")
    longer = np.flatnonzero(wanted.mask[:, 1:].any(axis=1) & (low < high))

    def bound(upper: bool) -> np.ndarray:
        lo, hi, total = low[longer], high[longer], len(longer)
        while (lo < hi).any():
            mid = (lo + hi) // 2
            place = order[np.minimum(mid, len(order) - 1)]
            less, equal = np.zeros(total, bool), np.ones(total, bool)
            for d in range(1, wanted.depth):
                here = room[place] > 8 * d
                k = np.where(here, keys[np.minimum(place + 8 * d, len(keys) - 1)], np.uint64(0))
                k &= wanted.mask[longer, d]
                less |= equal & (k < wanted.word[longer, d])
                equal &= k == wanted.word[longer, d]
                if not equal.any():
                    break
            right = (less | equal if upper else less) & (lo < hi)
            lo, hi = np.where(right, mid + 1, lo), np.where(right | (lo >= hi), hi, mid)
        return lo

    low[longer], high[longer] = bound(False), bound(True)
    return low, high


# --------------------------------------------------------------------------
# relaxation
# --------------------------------------------------------------------------


class Encoder:
    def __init__(self, model: PieceModel):
        self.model = model
        ids = [i for i in range(model.size) if model.usable[i]]
        self.ids = np.array(ids, np.int32)
        coded = [model.pieces[i].encode() for i in ids]
        self.wanted = Wanted(coded)
        self.lengths = np.array([len(b) for b in coded], np.int32)
        self.single = np.array([len(model.pieces[i]) == 1 for i in ids])
        self.depth = int(self.lengths.max())
        self.cache = np.full(PAIR_SLOTS, -1, np.int64)  # pair * 2 + answer
        self.memory = RecentIds(self.code, MEMORY)
        # a line feed that no piece holds is a chunk of its own
        alone = not any("\n" in model.pieces[i] and len(model.pieces[i]) > 1 for i in ids)
        self.chunk = re.compile(
            rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if alone else rf"{SPACE}*[^{SPACE}]+|{SPACE}+"
        )

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece b can stand directly behind piece a."""
        pair = a.astype(np.int64) * self.model.size + b
        slot = (pair * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)
        known = self.cache[slot]
        miss = known >> 1 != pair
        if miss.any():
            pieces, rank = self.model.pieces, self.model.rank
            asked, back = np.unique(pair[miss], return_inverse=True)
            answer = np.empty(len(asked), np.int64)
            for n, p in enumerate(asked.tolist()):
                left, right = pieces[p // self.model.size], pieces[p % self.model.size]
                whole = merge(list(left + right), rank, len(left))
                answer[n] = whole == [left, right]
            self.cache[(asked * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)] = asked * 2 + answer
            known[miss] = answer[back]
        return (known & 1).astype(bool)

    def edges(self, text: np.ndarray, room: np.ndarray):
        """(start, length, piece) of every occurrence of a piece; size = a raw character."""
        keys = eight_bytes(text, room)
        order = suffix_array(keys, room, self.depth)
        low, high = occurrence_ranges(order, keys, room, self.wanted)
        n = high - low
        before = np.cumsum(n) - n
        start = order[np.arange(n.sum()) + np.repeat(low - before, n)].astype(np.int32)
        which = np.repeat(np.arange(len(n), dtype=np.int32), n)
        covered = np.zeros(len(text), bool)
        covered[start[self.single[which]]] = True
        lead = (room > 0) & (text & 0xC0 != 0x80) & ~covered
        raw = np.flatnonzero(lead).astype(np.int32)
        size = 1 + (text[raw] >= 0xC0).astype(np.int64) + (text[raw] >= 0xE0) + (text[raw] >= 0xF0)
        return (
            np.concatenate([start, raw]),
            np.concatenate([self.lengths[which], size.astype(np.int32)]),
            np.concatenate([self.ids[which], np.full(len(raw), self.model.size, np.int32)]),
        )

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, concatenated, and where each chunk's ids start."""
        if not chunks:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        coded = [c.encode() for c in chunks]
        text = np.frombuffer(b"\xff".join(coded) + b"\xff", np.uint8)
        ends = np.cumsum([len(c) + 1 for c in coded]) - 1
        begins = np.r_[0, ends[:-1] + 1]
        owner_begin = np.repeat(begins.astype(np.int32), ends + 1 - begins)
        room = np.repeat(ends.astype(np.int32), ends + 1 - begins) - np.arange(len(text), dtype=np.int32)
        start, length, piece = self.edges(text, room)
        end = start + length
        # every chunk is relaxed at the same time, one end position after the other
        depth = end - owner_begin[start]
        by = np.argsort(depth, kind="stable")
        start, end, piece, depth = start[by], end[by], piece[by], depth[by]
        step = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1], True])
        size = self.model.size
        last = np.full(len(text) + 1, -1, np.int32)  # piece that ends here
        back = np.zeros(len(text) + 1, np.int32)  # where it starts
        first = start == owner_begin[start]
        for lo, hi in zip(step, step[1:], strict=False):
            s, e, p = start[lo:hi], end[lo:hi], piece[lo:hi]
            a = last[s]  # of a chunk's first piece: not looked at
            ok = first[lo:hi] | (p == size) | (a == size)
            ask = np.flatnonzero(~ok & (a >= 0))
            ok[ask] = self.follows(a[ask], p[ask])
            last[e[ok]], back[e[ok]] = p[ok], s[ok]
        used = np.zeros(len(text) + 1, bool)
        at, begin = ends.copy(), begins
        while len(at):
            used[at] = True
            at = back[at]
            going = at > begin
            at, begin = at[going], begin[going]
        place = np.flatnonzero(used)
        ids, n_chunk = last[place], np.searchsorted(ends, place)
        # raw characters become their bytes
        width = np.where(ids == size, place - back[place], 1)
        out = np.repeat(ids, width)
        if (ids == size).any():
            offset = np.arange(len(out)) - np.repeat(np.cumsum(width) - width, width)
            source = np.repeat(back[place], width) + offset
            out = np.where(out == size, self.model.byte_ids[text[np.minimum(source, len(text) - 1)]], out)
        count = np.bincount(n_chunk, weights=width, minlength=len(chunks)).astype(np.int64)
        return out, np.r_[0, np.cumsum(count)]

    def code(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks, their starts and numbers; a bounded length of chunk text at a time."""
        coded, counts = [], []
        size = np.cumsum([len(c) + 1 for c in chunks]) // GROUP_CHARS
        cuts = np.flatnonzero(np.r_[True, size[1:] != size[:-1], True][: len(chunks) + 1])
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            ids, starts = self.encode_chunks(chunks[lo:hi])
            coded.append(ids.astype(np.uint32))
            counts.append(np.diff(starts))
        length = np.concatenate(counts)
        return np.concatenate(coded), np.cumsum(length) - length, length

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and where each text's ids start."""
        findall = self.chunk.findall
        return self.memory.encode(
            findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts
        )


_ENCODERS: dict[str, Encoder] = {}


def worker_encoder(model: PieceModel) -> Encoder:
    """The Python worker's encoder, kept from task to task."""
    if model.name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model.name] = Encoder(model)
    return _ENCODERS[model.name]


def decoder(model: PieceModel):
    """A function from lists of ids to their texts."""
    joined = np.frombuffer(b"".join(model.raw), np.uint8)
    length = np.array([len(r) for r in model.raw], np.int64)
    first = np.cumsum(length) - length

    def texts(lists: pa.ListArray) -> pa.Array:
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        n = length[ids]
        stop = np.r_[0, np.cumsum(n)]
        raw = joined[np.arange(stop[-1]) + np.repeat(first[ids] - stop[:-1], n)].tobytes()
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        bounds = stop[np.r_[0, np.cumsum(counts)].astype(np.int64)].tolist()
        out = []
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            # the encoder puts one space before the text
            lo += raw[lo : lo + 1] == b" " and lo < hi
            out.append(raw[lo:hi].decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return texts


def encode_pieces(
    docs: DataFrame,
    model: PieceModel,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = None,
) -> DataFrame:
    """``docs`` plus ``ids`` (array of int); a map over the rows.

    With ``decoded_col`` also the text that the ids decode to, from the same pass.
    """
    others = [c for c in docs.columns if c not in (ids_col, decoded_col)]
    source = docs.select(*(docs[f"`{c}`"] for c in others))
    schema = source.withColumn(ids_col, F.array().cast("array<int>")).schema
    names = [*others, ids_col]
    if decoded_col:
        schema, names = schema.add(decoded_col, "string"), [*names, decoded_col]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, texts = worker_encoder(model), decoder(model)
        for whole in batches:
            for batch in slices(whole, text_col):
                ids, starts = encoder.encode(batch.column(text_col).to_pylist())
                lists = pa.ListArray.from_arrays(
                    pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32))
                )
                more = [texts(lists)] if decoded_col else []
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, *more], names=names)
        # the worker lives on: what the batches took goes back
        whole = batch = lists = more = None
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(encode, schema)


def decode_pieces(
    coded: DataFrame, model: PieceModel, ids_col: str = "ids", text_col: str = "decoded"
) -> DataFrame:
    """``coded`` plus the text of its ids."""
    others = [c for c in coded.columns if c != text_col]
    source = coded.select(*(coded[f"`{c}`"] for c in others))
    schema = source.withColumn(text_col, F.lit("")).schema

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = decoder(model)
        for whole in batches:
            for batch in slices(whole, ids_col):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, texts(batch.column(ids_col))], names=[*others, text_col]
                )

    return source.mapInArrow(decode, schema)
