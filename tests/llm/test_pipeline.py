"""The corpus pipeline against plain versions of its stages."""

import brute
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterlens.llm import common

SMOKE_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_pipeline(rows, items):
    verdicts = brute.quality([(i, t, lang, source) for i, t, lang, source, _ in rows])
    rows = [r for r in rows if verdicts[r[0]][2]]
    kept = brute.line_dedup([(r[0], r[1]) for r in rows])
    rows = [(i, kept[n][2], lang, source, len(kept[n][2])) for n, (i, _, lang, source, _) in enumerate(rows)]
    parts = brute.simhash_components([(r[0], r[1]) for r in rows])[1]
    rows = [r for r in rows if parts[r[0]] == r[0]]
    return [r for r in rows if not brute.contamination(r[1], items)[1]]


def test_pipeline_equals_plain_stages(spark):
    from sentencepiece import SentencePieceProcessor

    rows = [tuple(r) for r in common.table(spark, SMOKE_DIR, "documents").select(*COLUMNS).collect()]
    items = [tuple(r) for r in common.table(spark, SMOKE_DIR, "benchmark").select("item_id", "text").collect()]
    want = plain_pipeline(rows, items)
    got = corpus_pipeline.run(spark, SMOKE_DIR).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got) == sorted(want)
    assert 0 < len(got) < len(rows)
    lib = SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.PIECE_MODEL))
    for r in got:
        assert r.ids == lib.encode(r.text) and r.n_tokens == len(r.ids)


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "SentencePiece encoding",
    ]


@pytest.mark.parametrize("n", range(5))
def test_stage_edges(spark, n):
    long = " ".join(f"v{i}" for i in range(400))
    rows = [
        (1, None, "en", "s", 0), (2, "", None, None, None), (3, long, "en", "s", 1), (3, long, "en", "s", 1),
        (None, long + " tail", "en", "s", 1), (4, long + "\nline", None, "s", 1), (5, "x " * 30_000, "en", None, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("fp", F.lit("clash")).withColumn("hits", F.lit(1)).withColumn("kept", F.lit(True))
    stage = corpus_pipeline.STAGES[n][1]
    out = stage(spark, docs, SMOKE_DIR)
    rows = out.collect()
    if n < 4:
        assert out.columns == docs.columns
    else:
        assert out.columns == [*docs.columns, "ids", "n_tokens"]
    if n == 0:  # empty texts and repeated words go, repeated rows stay
        assert sorted(str(r.doc_id) for r in rows) == ["3", "3", "4", "None"]
    if n in (1, 3, 4):
        assert len(rows) == 7
    if n == 2:  # one of the empty texts and one row of the alike ones stay
        assert sorted(str(r.doc_id) for r in rows if r.text != "x " * 30_000) == ["1", "3"]
    assert stage(spark, docs.filter("false"), SMOKE_DIR).collect() == []


def test_near_duplicates_with_repeated_ids(spark):
    alike, other = (" ".join(f"{c}{i}" for i in range(400)) for c in "vw")
    rows = [(3, alike), (7, alike + "\n"), (7, other), (3, alike.upper()), (8, other + " "), (9, None), (9, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SMOKE_DIR).collect()]
    assert (7, other) in kept and (8, other + " ") not in kept and (7, alike + "\n") not in kept
    assert len([i for i, t in kept if t and t.lower().strip() == alike]) == 1
    assert (9, None) in kept and (9, "alone here") in kept and len(kept) == 4


def test_near_duplicates_keep_one_row_of_each_component(spark):
    alike, other = (" ".join(f"{c}{i}" for i in range(400)) for c in "vw")
    rows = [(None, alike), (None, alike), (None, alike + " x"), (5, other), (5, other), (5, other), (None, other), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("extra", F.create_map(F.lit("a"), F.lit(1)))
    out = corpus_pipeline.near_duplicates(spark, docs, SMOKE_DIR)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text or "") for r in out.collect()]
    assert len(kept) == 3 and (5, other) in kept
    assert len([t for i, t in kept if i is None and t.startswith(alike)]) == 1 and (None, "") in kept
