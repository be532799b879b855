"""Best-fit packing against a plain best-fit decreasing, piece by piece."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlens.llm import best_fit_packing as bp
from meterlens.llm import common
from meterlens.llm.queries import BYTE_MODEL, QUERIES

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def spec():
    return Path(public_tokenizers.path(BYTE_MODEL)).read_text(encoding="utf-8")


@pytest.fixture(scope="module")
def library(spec):
    return Tokenizer.from_str(spec)


def plain_best_fit(lengths, size):
    """Sorted fills of the bins of best-fit decreasing, one piece at a time.

    Bins with one remaining capacity are alike, so what they hold may be exchanged.
    """
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [b for b in bins if size - sum(b) >= length]
        if fits:
            max(fits, key=sum).append(length)
        else:
            bins.append([length])
    return sorted(map(sum, bins))


def bins_of(steps):
    bins = defaultdict(list)
    for length, _, n, sequence, each, offset in steps:
        for k in range(n):
            bins[sequence + k // each].append((offset + k % each * length, length))
    return bins


def check_gapless(bins, size):
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda size: st.tuples(st.just(size), st.lists(st.integers(1, size), max_size=80))))
def test_steps_equal_plain_best_fit(case):
    size, lengths = case
    steps = bp.best_fit_steps(Counter(lengths), size)
    bins = bins_of(steps)
    check_gapless(bins, size)
    assert sorted(bins) == list(range(len(bins)))
    assert sorted(sum(x for _, x in b) for b in bins.values()) == plain_best_fit(lengths, size)
    ranks = defaultdict(list)
    for length, first, n, *_ in steps:
        ranks[length] += range(first, first + n)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(lengths).items()}


def test_steps_follow_lengths_not_pieces():
    rng = np.random.default_rng(5)
    histogram = Counter(rng.integers(1, 2049, 5000).tolist())
    many = {length: n * 10**9 for length, n in histogram.items()}
    steps = bp.best_fit_steps(many)
    assert len(steps) < 50_000
    total = sum(length * n for length, n in many.items())
    assert max(s[3] + -(-s[2] // s[4]) for s in steps) <= 1.01 * total / 2048


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.booleans()), max_size=60), st.integers(0, 50))
def test_capacity_tree(changes, least):
    tree, held = bp.CapacityTree(50), set()
    for capacity, is_open in changes:
        tree.set(capacity, is_open)
        (held.add if is_open else held.discard)(capacity)
    assert tree.tightest(least) == min((c for c in held if c >= least), default=None)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_pieces(rows, texts, library, size):
    """Every document whole, ids those of the library; sequences gapless. Returns the bins."""
    by_doc, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc_id, mine in by_doc.items():
        ids = library.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0]
        mine.sort(key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert [r.start for r in mine] == np.cumsum([0] + [r.length for r in mine])[:-1].tolist()
        assert sum(r.length for r in mine) == len(ids) and all(r.length == size for r in mine[1:])
        assert [r.ids_crc32 for r in mine] == [crc(ids[r.start : r.start + r.length]) for r in mine]
    check_gapless(bins, size)
    assert sorted(sum(x for _, x in b) for b in bins.values()) == plain_best_fit([r.length for r in rows], size)
    return bins


def test_query_equals_plain_best_fit(spark, library):
    texts = dict(map(tuple, common.table(spark, SMOKE_DIR, "documents").select("doc_id", "text").collect()))
    packed = QUERIES["op13_best_fit_packing"](spark, SMOKE_DIR)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = packed.collect()
    bins = check_pieces(rows, texts, library, 2048)
    least = -(-sum(r.length for r in rows) // 2048)
    assert least <= len(bins) <= least + 1


ODD = [
    None, "", " ", "\n\n \t x", "a<|endoftext|>b", "don't 'S 12 ½ ², x_y", "日本語 ▁ it's 😀 é́ ﬁ İſ\x00\x1c\x85\xa0z", "w" * 5000,
    " ".join(f"word{i * 7919 % 4001}" for i in range(9000)),
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(" \t\n'st1aé-", max_size=40), min_size=1, max_size=5))
def test_ids_equal_the_library(spec, library, texts):
    tokenizer = bp.worker_tokenizer(spec)
    for text in [*texts, *ODD[1:]]:
        assert tokenizer.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_edges_and_sequences(spark, spec, library):
    docs = spark.createDataFrame(list(enumerate(ODD * 3)), "doc_id long, text string").repartition(5)
    for c in ("piece", "start", "length", "ids", "task", "place", "rank", "sequence_id"):
        docs = docs.withColumn(c, F.lit("clash"))
    packed = bp.pack_documents(docs, spec, size=64, with_ids=True)
    rows = packed.collect()
    check_pieces(rows, dict(enumerate(ODD * 3)), library, 64)
    sequences = {r.sequence_id: r for r in bp.packed_sequences(packed).collect()}
    for r in rows:
        whole = sequences[r.sequence_id]
        assert whole.ids[r.offset : r.offset + r.length] == r.ids
    assert all(len(s.ids) == sum(s.lengths) <= 64 for s in sequences.values())
    assert bp.pack_documents(docs.filter("false"), spec).count() == 0
    same = spark.createDataFrame([(7, "one two")] * 5 + [(None, "three")] * 2, "doc_id long, text string")
    got = bp.pack_documents(same, spec, size=8).collect()
    assert sorted(Counter(r.doc_id is None for r in got).items()) == [(False, 5), (True, 2)]
    check_gapless({s: [(r.offset, r.length) for r in got if r.sequence_id == s] for s in {r.sequence_id for r in got}}, 8)
