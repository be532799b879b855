"""Phrase mining against plain counts of all phrases, and its defined edge cases."""

import glob
import random
import re
import tempfile
import time
from collections import Counter, defaultdict

import brute
import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterlens.llm import phrase_mining as pm
from meterlens.llm.queries import ORACLE, QUERIES
from meterlens.session import SHUFFLE_CLEANUP

SMOKE_DIR = "/root/testdata/sf0.001"


def plain_counts(docs):
    """(counts by (lang, phrase), words by lang)."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", brute.lower(text)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, " ".join(words[i : i + k])] += 1
    return f, n


def plain_collocations(docs, least, top, percent=100):
    f, n = plain_counts(docs)
    candidates = {p: a for p, a in f.items() if a >= least and " " in p[1]}
    covered = defaultdict(int)
    for (lang, phrase), a in candidates.items():
        words = phrase.split(" ")
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = lang, " ".join(words[i : i + k])
                covered[inner] = max(covered[inner], a)
    rows = defaultdict(list)
    for (lang, phrase), a in candidates.items():
        if 100 * covered[lang, phrase] >= percent * a:
            continue
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows[lang].append((-score, -a, phrase.encode(), (phrase, a, left, right, n[lang], score)))
    return sorted(
        (lang, rank, *row[-1]) for lang, mine in rows.items() for rank, row in enumerate(sorted(mine)[:top], 1)
    )


def random_docs(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cc", "Ää", "\x1cx", "日本", "don't", "e", "f\xa0g"]
    docs = []
    for _ in range(n):
        words = rng.choices(vocabulary, range(len(vocabulary), 0, -1), k=rng.randrange(60))
        docs.append((rng.choice(["en", "d\te", None, "und", ""]),
                     "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",;", "\x0b"]) for w in words)))
    return docs + [("en", None), (None, ""), ("en", "one two three four five six seven " * 30)] + docs[:9]


@pytest.mark.parametrize("seed, least, shards, slots, top", [
    (1, 3, 3, 64, 50),  # many phrases share a slot
    (2, 10, 4, 1 << 24, 2000),
    (3, 1, 2, 1 << 10, 7),
    (4, 10**6, 4, 1 << 24, 5),
])
def test_equals_plain_counts(spark, monkeypatch, seed, least, shards, slots, top):
    monkeypatch.setattr(pm, "RANKED", 40)  # several rounds of ranking
    monkeypatch.setattr(pm, "MERGED", 4)
    docs = random_docs(seed)
    table = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(docs)], "doc_id long, text string, lang string")
    for c in ("shard", "words", "phrase", "n", "rank", "score"):
        table = table.withColumn(c, F.lit("clash"))
    found = pm.collocations(table.repartition(5), least, top, shards=shards, slots=slots)
    assert sorted(map(tuple, found.collect())) == plain_collocations(docs, least, top)


def test_counts_are_exact_and_complete(spark):
    docs = random_docs(7)
    table = spark.createDataFrame(docs, "lang string, text string")
    frequent, sizes = pm.frequent_phrases(table, 4, shards=3)
    f, n = plain_counts(docs)
    got = {(r.lang, r.phrase): r.n for r in frequent.collect()}
    assert got == {p: a for p, a in f.items() if a >= 4}
    assert {r.lang: r.n_words for r in sizes.collect() if r.n_words} == {lang: k for lang, k in n.items() if k}


def test_shuffle_files_of_a_stop_go_before_the_next(spark, monkeypatch):
    """And the setting by which they go is as before afterwards, also after a failure."""

    def held():
        return set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*.data"))

    before, setting, left, scan = held(), spark.conf.get(SHUFFLE_CLEANUP, None), [], pm.scan

    def seen(*args):
        for _ in range(100):  # they are deleted by a thread
            if held() <= before:
                break
            time.sleep(0.05)
        left.append(held() - before)
        return scan(*args)

    monkeypatch.setattr(pm, "scan", seen)
    table = spark.createDataFrame(random_docs(8), "lang string, text string").repartition(3)
    pm.frequent_phrases(table, 4, shards=3)
    assert len(left) >= 3 and not any(left)
    monkeypatch.setattr(pm, "scan", None)
    with pytest.raises(TypeError):
        pm.frequent_phrases(table, 4, shards=3)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_stored_words_and_counts_are_packed(spark, monkeypatch):
    stored, remove = [], pm.remove_path

    def seen(session, path):
        stored.extend(glob.glob(f"{path.removeprefix('file:')}/**/*.parquet", recursive=True))
        remove(session, path)

    monkeypatch.setattr(pm, "remove_path", seen)
    table = spark.createDataFrame(random_docs(9), "lang string, text string").repartition(3)
    pm.frequent_phrases(table, 4, shards=3)
    assert {x.split("/")[-1].split(".")[-2] for x in stored} == {"zstd"}
    assert {re.sub("-[0-9a-f]{12}/.*", "", x.split("phrase-")[1]) for x in stored} == {"counts", "words"}


def test_long_repeated_text(spark):
    docs = [("en", "x " * 300_000), ("en", "y, " * 1000)]
    table = spark.createDataFrame(docs, "lang string, text string")
    rows = pm.collocations(table).collect()
    assert sorted(map(tuple, rows)) == plain_collocations(docs, 100, 2000)


def test_score_passes_64_bits(spark):
    big = [(10**13, 9 * 10**13, 10**13 + 7, 3 * 10**13), (100, 10**14, 10**14, 10**14), (7, 9, 2, 3), (10**14, 10**14, 1, 1)]
    df = spark.createDataFrame(big, "a long, n long, l long, r long")
    score = pm.exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    expected = [1000 * a * n // (x * y) for a, n, x, y in big[:3]]
    assert [r[0] for r in df.limit(3).select(score).collect()] == expected


def test_phrases_of_one_hash_are_told_apart():
    import numpy as np

    ids = np.array([0, 1, 0, 2, 0, 1, -1], np.int32)
    at = np.array([0, 2, 4])
    rep, n = pm.groups(ids, at, 2, np.zeros(3, np.uint64))
    assert sorted(zip(ids[rep + 1].tolist(), n.tolist(), strict=True)) == [(1, 2), (2, 1)]
    rows = list(pm.scan_row("en", pa.array(["a", "b", "c"]), pm.word_hash("en", [b"a", b"b", b"c"]), ids, np.full(64, pm.NEVER, np.uint8), 1, 4))
    assert [dict(zip(keys.to_pylist(), n.tolist(), strict=True)) for keys, _, n in rows] == [
        {"en\ta": 3, "en\tb": 2, "en\tc": 1}
    ]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert pm.collocations(none).count() == 0
    assert pm.collocations(spark.createDataFrame([(1, None, "en")], none.schema)).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SMOKE_DIR}/documents.parquet'")
    sql = con.execute(ORACLE["op12_phrase_mining"])
    names = [c[0] for c in sql.description]
    found = QUERIES["op12_phrase_mining"](spark, SMOKE_DIR)
    assert found.columns == names
    assert sorted(map(tuple, found.collect())) == sorted(sql.fetchall())
