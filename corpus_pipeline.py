"""Corpus pipeline: five training-data operators, one after the other.

Each stage takes (spark, docs, sf_dir) and gets what its predecessor kept,
written as Parquet and read again.  All but the last return the columns of
``documents``; the last adds ``n_tokens`` and ``ids``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from meterlens.llm.common import staged, table
from meterlens.llm.decontamination import contamination
from meterlens.llm.line_dedup import line_dedup
from meterlens.llm.quality_rules import keep_passing, quality_verdicts
from meterlens.llm.sentence_pieces import encode_pieces, load_model
from meterlens.llm.simhash_neardup import simhash_components

PIECE_MODEL = "piece_bpe_32k.model"


def quality(spark, docs, sf_dir):
    """Rejected documents go; a null or empty text is rejected, repeated rows share their verdict."""
    return keep_passing(docs, quality_verdicts(docs))


def lines(spark, docs, sf_dir):
    """Repeated lines go; every row stays, with its remaining lines (a null text becomes empty).

    Rows that repeat an id count as one document; rows without an id keep their lines.
    """
    return (
        line_dedup(docs)
        .withColumn("n_chars", F.char_length("text").cast("long"))
        .select(*docs.columns)
    )


def near_duplicates(spark, docs, sf_dir):
    """Of each component exactly one row stays.

    It is the one with the smallest id (null behind all others) and text key; of rows
    equal in both any one.  Texts are compared under their own hash, as ids may
    repeat; null and empty texts are one component.
    """
    text_key = F.xxhash64(docs["text"])
    keys = docs.select(docs["doc_id"].cast("long").alias("id"), text_key.alias("key"))
    parts = simhash_components(docs.select(text_key.alias("doc_id"), docs["text"]))
    # written once, so that the joins can split a text of many documents and a large component
    parts = staged(parts.select(F.col("doc_id").alias("key"), "component_id").distinct(), "neardup-parts")
    rows = keys.groupBy("id", "key").agg(F.count("*").alias("rows"))
    first = rows.join(parts, "key").groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "rows")).alias("first")
    )
    first = staged(first.select(*(F.col(f"first.{c}").alias(f"__{c}") for c in ("id", "key", "rows"))), "neardup-first")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (text_key == F.col("__key"))
    single = docs.join(first.filter("__rows = 1"), same, "left_semi")
    # equal rows combine before they meet
    several = docs.join(first.filter("__rows > 1"), same).dropDuplicates(["__id", "__key"])
    return single.unionByName(several.select(*(docs[f"`{c}`"] for c in docs.columns)))


def decontamination(spark, docs, sf_dir):
    """Documents with a benchmark phrase go, repeated rows and rows without an id alike; null texts stay."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = found.filter(F.size("hits") > 0).select(
        F.col("doc_id").alias("__gone_id"), F.col("doc_key").alias("__gone_key")
    )
    same = docs["doc_id"].cast("long").eqNullSafe(gone["__gone_id"]) & (
        F.xxhash64(docs["text"]) == gone["__gone_key"]
    )
    return docs.join(gone, same, "left_anti")


def sentence_pieces(spark, docs, sf_dir):
    """Adds the ids of the piece vocabulary to every row; a null or empty text has none."""
    model = load_model(public_tokenizers.path(PIECE_MODEL))
    return encode_pieces(docs, model).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", sentence_pieces),
]

#: Robust covariance, bit votes and piece merges are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
