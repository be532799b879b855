"""Periodic runs against a plain search of every period, and their defined edge cases."""

import random
import time
import tracemalloc
import zlib
from fractions import Fraction

import brute
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterlens.llm import common
from meterlens.llm.periodic_runs import find_runs, periodic_runs
from meterlens.llm.queries import QUERIES

SMOKE_DIR = "/root/testdata/sf0.001"


def plain_runs(words, least, exponent):
    """Maximal stretches of every period, smallest period of each stretch."""
    found = {}
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    """The query's row, planted as its contract says."""
    words = brute.WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 24, 3)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        brute.sha("".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))),
        brute.sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_equals_plain_search(spark):
    docs = common.table(spark, SMOKE_DIR, "documents").select("doc_id", "text").collect()
    rows = QUERIES["op11_periodic_runs"](spark, SMOKE_DIR)
    assert rows.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert sorted(map(tuple, rows.collect())) == sorted(plain_row(*d) for d in docs)
    assert rows.filter("n_runs > 0").count() > 5


def check(texts, least, exponent):
    for text, (n, runs, collapsed) in zip(texts, find_runs(texts, least, exponent), strict=True):
        words = brute.WORD.findall(text or "")
        assert n == len(words)
        assert sorted(runs) == plain_runs(words, least, exponent)
        assert runs == sorted(runs, key=lambda r: (r[0], r[2]))
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        assert collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)


LETTERS = st.text("ab", max_size=60) | st.text("abc", max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(LETTERS | st.tuples(st.text("ab", max_size=9), st.integers(0, 9)).map(lambda x: x[0] * x[1]), max_size=5),
       st.integers(1, 12), st.integers(2, 4))
def test_random_words(texts, least, exponent):
    check([" ".join(t) for t in texts], least, exponent)


def test_nested_and_fibonacci():
    a, b = "a", "a b"
    for _ in range(9):
        a, b = b, f"{b} {a}"
    nested = " ".join((["x"] * 9 + ["y"]) * 12 + ["z"] + (["x"] * 9 + ["y"]) * 5)
    for least, exponent in ((2, 2), (24, 3), (5, 2), (4, 4)):
        check([b, nested, None, "", " \t\n", "one", "k " * 100], least, exponent)


def test_very_long_repeats_take_linear_time():
    started = time.process_time()
    n = 200_000
    rng = random.Random(3)
    block = [f"w{rng.randrange(50)}" for _ in range(n // 4)]
    texts = ["same " * n, "a b " * (n // 2), " ".join(block * 4), " ".join(f"w{i}" for i in range(n))]
    rows = list(find_runs(texts, 24, 3))
    assert [r[1] for r in rows] == [[(0, n, 1)], [(0, n, 2)], [(0, n, n // 4)], []]
    assert rows[0][2] == "same" and rows[1][2] == "a b"
    assert time.process_time() - started < 60


def test_edges(spark):
    wave = "un deux trois " * 10
    rows = [(1, None), (2, ""), (3, wave), (3, wave), (None, wave), (None, None), (4, "  a b \x1c " * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("runs", "n_words", "collapsed", "start"):
        docs = docs.withColumn(c, F.lit("clash"))
    got = sorted(map(str, periodic_runs(docs).collect()))
    empty = "n_words=0, runs=[], collapsed=''"
    run = "n_words=30, runs=[Row(start=0, length=30, period=3)], collapsed='un deux trois'"
    last = "n_words=36, runs=[Row(start=0, length=36, period=3)], collapsed='\\xa0 a\\xa0b \\x1c'"
    assert got == sorted(
        [f"Row(doc_id={i}, {empty})" for i in (1, 2, None)]
        + [f"Row(doc_id={i}, {run})" for i in (3, 3, None)]
        + [f"Row(doc_id=4, {last})"]
    )
    assert periodic_runs(docs.filter("false")).count() == 0


def test_memory_does_not_follow_the_batch(spark, monkeypatch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, find, schema: find)
    find = periodic_runs(docs)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(4000)]  # 7 MB in one Arrow batch
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": texts})
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in find(iter([batch]))) == len(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 25e6
