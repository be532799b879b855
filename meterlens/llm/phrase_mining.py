"""Phrase collocations by dynamic itemset counting.

Texts are stored once as numbered words, dealt out to ``SHARDS`` shards.  The
shards are scanned in a cycle, one job each, and all lengths are counted in the
same scan: a phrase is active from the first stop on at which both its
subphrases (without its last word, without its first one) have reached the
threshold in what was counted so far, and is counted for one full cycle, that
is once in every shard, so its count is exact.  Single words are active from the
start.  The scan ends when no phrase is active any more: after one cycle and the
few stops by which longer phrases start later, if none starts late.

What a scan needs to know about the phrases that reached the threshold is the
stop at which each did, in a table of a fixed number of slots (``SLOTS``)
addressed by a hash of the phrase.  Two phrases in one slot only make their
extensions active early: these are counted in vain, and exactly.  The table
comes to the driver as its used slots, so its size is bounded by SLOTS, not by
the data.  Counts are summed per phrase, as text, in each task and by Spark; no
phrase is recognised by its hash alone.

Defined results: a null or empty text has no words, a null language is ``und``;
every row counts, also repeated ones and those without an id; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import SLICE_BYTES, slices, staged
from meterlens.session import remove_path, scratch_path, short_shuffles

LONGEST = 5
SHARDS = 4
#: Slots of the table of phrases that reached the threshold (bytes in each task).
SLOTS = 1 << 24
NEVER = 255
#: Phrases of a language ranked together, and parts that are ranked together next.
RANKED, MERGED = 100_000, 32
NO_LANGUAGE = "und"
#: Of the stored words and counts: two tables of counts are on disk at a time.
CODEC = "zstd"

TOKENS = (
    "shard int, lang string, n_words long, vocabulary array<string>, hashes array<long>, words array<int>"
)
#: A key is the language, a tab and the phrase (which holds none): one string to compare.
COUNTED = "key string, active int, n long"
#: Text of one language numbered together.
RUN_BYTES = 2 * SLICE_BYTES
#: Characters that end a piece, and blanks besides 20.
ENDS, TAB = b".,;:!?\n\x0b\x0c\r", b"\t"
_ONE_END = bytes.maketrans(ENDS + TAB, b"." * len(ENDS) + b" ")


# --------------------------------------------------------------------------
# texts as numbered words
# --------------------------------------------------------------------------


def word_hash(lang: str, words: Iterable[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def split_pieces(texts: list[str]) -> list[bytes]:
    """Words of all texts in lower case (A-Z), with ``.`` between pieces and texts."""
    joined = "\n".join(texts).encode().lower().translate(_ONE_END)
    return joined.replace(b".", b" . ").split()  # white space of bytes: only blanks are left


def token_rows(docs: DataFrame, text_col: str, lang_col: str, shards: int) -> DataFrame:
    """Runs of texts of one language: their distinct words, and the words as places there.

    Place -1 ends a piece.  Rows are dealt to the shards in turn.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}
        made = 0

        def row(lang: str) -> pa.RecordBatch:
            nonlocal made
            words = split_pieces(held.pop(lang))
            size.pop(lang)
            place = dict.fromkeys(words)
            place.pop(b".", None)
            place = {w: i for i, w in enumerate(place)}
            vocabulary = pa.array([w.decode() for w in place], pa.string())
            hashes = word_hash(lang, place)
            place[b"."] = -1
            ids = np.fromiter(map(place.__getitem__, words), np.int32, len(words))
            made += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task + made) % shards], pa.int32()),
                    pa.array([lang]),
                    pa.array([int(np.count_nonzero(ids >= 0))], pa.int64()),
                    pa.ListArray.from_arrays([0, len(vocabulary)], vocabulary),
                    pa.ListArray.from_arrays([0, len(vocabulary)], pa.array(hashes.view(np.int64))),
                    pa.ListArray.from_arrays([0, len(ids)], pa.array(ids)),
                ],
                names=[f.split()[0] for f in TOKENS.split(", ")],
            )

        for whole in batches:
            for batch in slices(whole):
                for lang, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "text")), strict=True):
                    if text:
                        held.setdefault(lang, []).append(text)
                        size[lang] = size.get(lang, 0) + len(text)
                for lang in [name for name, n in size.items() if n >= RUN_BYTES]:
                    yield row(lang)
        for lang in list(held):
            yield row(lang)

    lang = F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    return docs.select(lang, docs[text_col].alias("text")).mapInArrow(number, TOKENS)


# --------------------------------------------------------------------------
# a scan
# --------------------------------------------------------------------------


def mix(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word."""
    h = (h ^ (word + np.uint64(0x9E3779B97F4A7C15) + (h << np.uint64(6)) + (h >> np.uint64(2))))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def groups(ids: np.ndarray, at: np.ndarray, size: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct phrase of ``size`` words that begins at ``at``, its number).

    Phrases are told apart by their words; their hashes bring equal ones together.
    """
    order = np.argsort(h)
    at, h = at[order], h[order]
    starts = np.r_[True, h[1:] != h[:-1]]
    inner = ~starts[1:]  # the same hash as the one before
    words = (ids[at + k] for k in range(size))
    if all((w[1:] == w[:-1])[inner].all() for w in words):
        first = np.flatnonzero(starts)
        return at[first], np.diff(np.r_[first, len(at)])
    rows = np.stack([ids[at + k] for k in range(size)], axis=1)
    _, first, counts = np.unique(rows, axis=0, return_index=True, return_counts=True)
    return at[first], counts


def scan_row(lang: str, vocabulary: pa.Array, words: np.ndarray, ids: np.ndarray, reached: np.ndarray, stop: int, cycle: int):
    """(keys, active since, counts) of what this stop counts in one row, for each length.

    ``words`` are the hashes of the vocabulary.
    """
    mask = np.uint64(len(reached) - 1)
    at = np.flatnonzero(ids >= 0)  # beginnings of phrases
    h = words[ids[at]]
    active = np.zeros(len(at), np.uint8)  # the stop since which each place's phrase is active
    for size in range(1, LONGEST + 1):
        counted = np.flatnonzero((active < stop) & (stop <= active.astype(np.int64) + cycle))
        if len(counted):
            rep, n = groups(ids, at[counted], size, h[counted])
            parts = [vocabulary.take(pa.array(ids[rep + k])) for k in range(size)]
            phrase = pc.binary_join_element_wise(*parts, " ")
            yield pc.binary_join_element_wise(lang, phrase, "\t"), active[np.searchsorted(at, rep)], n
        if size == LONGEST or not len(at):
            return
        # a longer phrase begins where this one reached and the next place's one did too
        # (its slot may be set earlier, by another phrase, than it is active itself)
        if size == 1:
            since = reached[(words & mask).astype(np.int64)][ids[at]]
        else:
            since = np.maximum(reached[(h & mask).astype(np.int64)], active)
        both = (at[1:] == at[:-1] + 1) & (since[:-1] != NEVER) & (since[1:] != NEVER)
        follows = np.flatnonzero(both)
        active = np.maximum(since[follows], since[follows + 1])
        at, h = at[follows], mix(h[follows], words[ids[at[follows] + size]])


def scan(tokens: DataFrame, used: np.ndarray, stops: np.ndarray, stop: int, cycle: int, slots: int) -> DataFrame:
    """Counts of the phrases that are active at this stop, in the rows of one shard."""
    table = tokens.sparkSession.sparkContext.broadcast((used, stops))  # at most ``slots`` of them

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached = np.full(slots, NEVER, np.uint8)
        reached[table.value[0]] = table.value[1]
        for batch in batches:
            for i in range(batch.num_rows):
                lang = batch.column("lang")[i].as_py()
                vocabulary = batch.column("vocabulary")[i].values
                words = batch.column("hashes")[i].values.to_numpy().view(np.uint64)
                ids = batch.column("words")[i].values.to_numpy()
                for key, active, n in scan_row(lang, vocabulary, words, ids, reached, stop, cycle):
                    columns = [key, pa.array(active.astype(np.int32)), pa.array(n.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "active", "n"])

    return tokens.select("lang", "vocabulary", "hashes", "words").mapInArrow(count, COUNTED)


def slots_of(frequent: DataFrame, slots: int) -> DataFrame:
    """The slots of phrases that a longer one can be made of (column ``key``)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[np.ndarray]] = {}
            for key in batch.column("key").to_pylist():
                lang, phrase = key.rsplit("\t", 1)
                words = word_hash(lang, phrase.encode().split(b" "))
                by_size.setdefault(len(words), []).append(words)
            for size, rows in by_size.items():
                if size < LONGEST:
                    h = reduce(mix, np.stack(rows, axis=1))
                    at = (h & np.uint64(slots - 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(at)], names=["slot"])

    return frequent.select("key").mapInArrow(find, "slot int").distinct()


# --------------------------------------------------------------------------
# dynamic itemset counting
# --------------------------------------------------------------------------


def frequent_phrases(
    docs: DataFrame,
    least: int = 100,
    text_col: str = "text",
    lang_col: str = "lang",
    shards: int = SHARDS,
    slots: int = SLOTS,
) -> tuple[DataFrame, DataFrame]:
    """(``lang, size, phrase, n`` of all phrases of 1 to 5 words found ``least`` times
    or more, ``lang, n_words``)."""
    if slots & (slots - 1) or not 0 < LONGEST * shards < NEVER:
        raise ValueError("the slots are a power of two, and the stops must fit a byte")
    spark = docs.sparkSession
    path = scratch_path(spark, "phrase-words")
    with short_shuffles(spark):  # else those of all stops are on disk together
        token_rows(docs, text_col, lang_col, shards).write.partitionBy("shard").parquet(path, compression=CODEC)
        tokens = spark.read.schema(TOKENS).parquet(path)
        sizes = staged(tokens.groupBy("lang").agg(F.sum("n_words").alias("n_words")), "phrase-languages")
        used, stops = np.zeros(0, np.int64), np.zeros(0, np.uint8)
        totals, stored = None, None
        last = stop = 0  # the last stop at which something new was reached
        while stop < last + shards:
            stop += 1
            found = scan(tokens.filter(F.col("shard") == stop % shards), used, stops, stop, shards, slots)
            if totals is not None:
                found = found.unionByName(totals)
            found = found.groupBy("key", "active").agg(F.sum("n").alias("n"))
            # a phrase that completed its cycle below the threshold is done with
            enough = F.col("n") >= least
            found = found.filter(enough | (F.col("active") + shards > stop))
            before, stored = stored, scratch_path(spark, "phrase-counts")
            found.write.parquet(stored, compression=CODEC)
            totals = spark.read.schema(COUNTED).parquet(stored)
            if before:
                remove_path(spark, before)
            new = slots_of(totals.filter(enough), slots).toArrow().column("slot").to_numpy()
            new = np.setdiff1d(new, used)
            if len(new):
                used = np.concatenate([used, new])
                stops = np.concatenate([stops, np.full(len(new), stop, np.uint8)])
                last = stop
    remove_path(spark, path)
    phrase = F.substring_index("key", "\t", -1)
    frequent = totals.filter(F.col("n") >= least).select("key", phrase.alias("phrase"), "n")
    return frequent.select(
        F.expr("left(key, length(key) - length(phrase) - 1)").alias("lang"),
        F.size(F.split("phrase", " ")).alias("size"),
        "phrase",
        "n",
    ), sizes


def exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) of longs, with products of up to 38 digits."""

    def wide(*factors):
        return reduce(lambda x, y: (x * y).cast("decimal(38,0)"), (f.cast("decimal(19,0)") for f in factors))

    return F.call_function("div", wide(a, n, F.lit(1000)), wide(left, right))


def collocations(
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    contained_percent: int = 100,
    **options,
) -> DataFrame:
    """Each language's ``top`` phrases by score: ``lang, rank, phrase, a, l, r, n, score``.

    The score of a phrase of count a is that of its worst cut into two parts of
    counts l and r: floor(1000 a n / (l r)), n being the words of the language.  A
    phrase within a longer one that is found ``contained_percent`` as often or
    more is left out.
    """
    frequent, sizes = frequent_phrases(docs, least, **options)
    words = F.split("phrase", " ")
    candidates = frequent.filter("size >= 2").withColumnRenamed("n", "a").withColumn("w", words)

    def part(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    cuts = candidates.select("lang", "phrase", "size", "a", "w", cut)
    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        part(F.lit(1), F.col("cut")).alias("first"),
        part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest"),
    )
    one = frequent.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    two = frequent.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(one, ["lang", "first"]).join(two, ["lang", "rest"]).join(sizes, "lang")
    score = exact_score(F.col("a"), F.col("n_words"), F.col("l"), F.col("r"))
    cuts = cuts.select("lang", "phrase", "a", "cut", "l", "r", F.col("n_words").alias("n"), score.alias("score"))
    worst = F.min(F.struct("score", "cut", "l", "r")).alias("m")
    scored = cuts.groupBy("lang", "phrase").agg(worst, F.first("a").alias("a"), F.first("n").alias("n"))

    # every phrase inside a longer one, with the longer one's count
    span = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.col("size") - 1),
                lambda k: F.transform(
                    F.sequence(F.lit(1), F.col("size") - k + 1), lambda s: F.struct(s.alias("s"), k.alias("k"))
                ),
            )
        )
    ).alias("at")
    inner = candidates.filter("size > 2").select("lang", "w", "a", span)
    inner = inner.select("lang", part(F.col("at.s"), F.col("at.k")).alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < contained_percent * F.col("a"))
    )
    kept = kept.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts, rows = 1, frequent.count()
    while parts * RANKED < rows:
        parts *= MERGED
    while parts:  # the best of each part, then of the parts that fall together, at last of all
        part_of = F.pmod(F.xxhash64("phrase"), F.lit(parts))
        rank = F.row_number().over(Window.partitionBy("lang", part_of).orderBy(*order))
        kept = kept.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
        parts //= MERGED
    return kept.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
