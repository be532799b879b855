"""Line deduplication with DataFrame functions only.

Lines become (hash, document, position) rows, range-partitioned on the hash
with document and position as secondary sort, so that a line found in a third
of all documents spreads over many ranges instead of meeting in one task.  Each
range streams its first occurrence per document, and one small row per hash and
range goes on to the totals.  Lines to drop come back as sparse bitmaps per
document: 64-line words of keep bits, only for words that lose a line.  Texts
move once, to meet their bitmap.

Hashes are 128 bits (two XXH64 values with different seeds).

Defined results: a null or empty text is one empty line; lines whose key is
shorter than ``MIN_CHARS`` always stay; rows that repeat a document id count as
one document, and each is returned; a row without an id keeps its lines and
counts for no line; an empty table gives no rows; other columns are ignored by
the bitmaps and passed through by ``apply_bitmaps``.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import staged

MIN_CHARS = 20
MIN_DOCS = 3
WHITE = " \t\n\v\f\r"  # [\x20\x09-\x0D]
WORD_LINES = 64


def line_key(line):
    """White space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)


def text_lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_key(doc_id, text):
    """Tells rows that repeat a document id with another text apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(doc_id, row_key, pos, h1, h2)`` for every line with a long enough key."""
    rows = docs.filter(docs[id_col].isNotNull()).select(
        docs[id_col].cast("long").alias("doc_id"),
        _row_key(docs[id_col], docs[text_col]).alias("row_key"),
        F.posexplode(text_lines(docs[text_col])).alias("pos", "line"),
    )
    keyed = rows.select("doc_id", "row_key", "pos", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.char_length("key") >= min_chars).select(
        "doc_id",
        "row_key",
        "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
    )


def repeated_lines(occurrences: DataFrame, min_docs: int) -> DataFrame:
    """``(h1, h2, keep_doc)`` of the hashes found in at least ``min_docs`` documents."""
    ranged = occurrences.select("h1", "h2", "doc_id", "pos").repartitionByRange("h1", "h2", "doc_id")
    ordered = ranged.sortWithinPartitions("h1", "h2", "doc_id", "pos")
    # the range keeps a hash's document together and the sort serves the window: first
    # occurrences stream by, with neither an exchange nor a sort of their own
    in_line = Window.partitionBy("h1", "h2", "doc_id").orderBy("pos")
    first = ordered.withColumn("before", F.lag("pos").over(in_line)).filter("before is null")
    totals = first.groupBy("h1", "h2").agg(
        F.count("*").alias("docs"), F.max("doc_id").alias("keep_doc")
    )
    return totals.filter(F.col("docs") >= min_docs).select("h1", "h2", "keep_doc")


def line_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``(doc_id, row_key, keep, n_dropped)`` for the documents that lose a line.

    ``keep`` maps a word number to 64 keep bits (bit i: line 64 * word + i); words
    that are absent keep all their lines.
    """
    lines = staged(line_occurrences(docs, id_col, text_col, min_chars), "line-hashes")
    # written once: as a table of its own the join can split a hash that is in many documents
    repeated = staged(repeated_lines(lines, min_docs), "repeated-lines")
    dropped = lines.join(repeated, ["h1", "h2"]).filter("doc_id <> keep_doc")
    bit = F.expr(f"shiftleft(1L, pos % {WORD_LINES})")
    words = (
        dropped.select("doc_id", "row_key", F.expr(f"pos div {WORD_LINES}").cast("int").alias("word"), bit.alias("bit"))
        .repartition("doc_id", "row_key")  # serves both aggregations below
        .groupBy("doc_id", "row_key", "word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    return words.groupBy("doc_id", "row_key").agg(
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits")))).alias("keep"),
        F.sum(F.bit_count("bits")).alias("n_dropped"),
    )


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with its text cut to the kept lines, plus ``n_lines`` and ``n_dropped``."""
    marks = bitmaps.select(
        F.col("doc_id").alias("__mark_id"),
        F.col("row_key").alias("__mark_key"),
        F.col("keep").alias("__keep"),
        F.col("n_dropped").alias("__dropped"),
    )
    joined = docs.join(
        marks,
        (docs[id_col].cast("long") == F.col("__mark_id"))
        & (_row_key(docs[id_col], docs[text_col]) == F.col("__mark_key")),
        "left",
    )
    lines = text_lines(docs[text_col])

    def kept(_, i):
        word = F.element_at(F.col("__keep"), F.floor(i / WORD_LINES).cast("int"))
        return word.isNull() | (F.getbit(word, i % WORD_LINES) == 1)

    text = F.when(F.col("__keep").isNull(), F.coalesce(docs[text_col], F.lit(""))).otherwise(
        F.array_join(F.filter(lines, kept), "\n")
    )
    others = [docs[f"`{c}`"] for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    return joined.select(
        *others,
        text.alias(text_col),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("__dropped", F.lit(0)).cast("long").alias("n_dropped"),
    ).select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """The documents without their repeated lines."""
    return apply_bitmaps(docs, line_bitmaps(docs, id_col, text_col, **rules), id_col, text_col)
