"""The full-text index against plain loops."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from vellumry.operators import fulltext as X

WORDS = ["a", "b", "c", "dé", "e1", "f", "g", "h", "rare", "x"]
SCHEMA = "doc_id long, text string, word string, block long, n long"


def _rows():
    r = random.Random(3)
    rows = [(k, " ".join(r.choices(WORDS, weights=[40, 20, 10, 5, 5, 4, 3, 2, 1, 1], k=r.randint(1, 12)))) for k in range(-20, 200)]
    rows += [(300, None), (301, ""), (302, "!?"), (303, "b a, B!a b"), (None, "rare rare"), (10**12, "rare h " + "a b " * 5000), (11, None)]
    return rows + [rows[5]]


def _words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fulltext"))
    X.build(spark.createDataFrame([(*x, "other", 7, 7) for x in _rows()], SCHEMA), path, width=16)
    docs = {}
    for k, t in _rows():
        if k is not None and (k not in docs or len(_words(t)) > len(docs[k])):
            docs[k] = _words(t)
    return path, docs


def _best(docs, text, k):
    n, mean, out = len(docs), sum(map(len, docs.values())) / len(docs), {}
    for w in set(_words(text)):
        df = sum(w in d for d in docs.values())
        for i, d in docs.items():
            if c := d.count(w):
                part = math.log(1 + (n - df + 0.5) / (df + 0.5)) * (c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(d) / mean)))
                out[i] = out.get(i, 0) + math.floor(part * 1_000_000 + 0.5)
    return [(r + 1, i, s) for r, (i, s) in enumerate(sorted(out.items(), key=lambda x: (-x[1], x[0]))[:k])]


ASKED = [(1, "a"), (2, "Rare h"), (3, "a b c dé e1 f g h rare x"), (4, "absent"), (5, None), (6, ""), (7, "dé absent DÉ"), (8, "x rare"), (None, "a"), (1, "a")]


@pytest.mark.parametrize("k", [1, 3, 10, 1000])
def test_search_equals_loop(spark, index, k):
    path, docs = index
    got = X.search(spark, path, spark.createDataFrame(ASKED, "query_id long, text string"), k)
    assert got.columns == ["query_id", "rank", "doc_id", "score"]
    want = [(q, *x) for q, t in dict(ASKED).items() if q is not None for x in _best(docs, t, k)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_search_skips_blocks(spark, index):
    path, _ = index
    asked = X._weighted(spark, path, spark.createDataFrame([(2, "rare h a")], "query_id long, text string"), X._facts(spark, path), "query_id", "text")
    blocks = spark.read.parquet(f"{path}/blocks")
    assert 0 < X.blocks_to_open(asked, blocks, 1).count() < asked.join(blocks, "word").select("block").distinct().count()


def test_phrases_equal_loop(spark, index):
    path, docs = index
    asked = [(1, "a b a"), (2, "a"), (3, "b, A"), (4, "rare h a"), (5, "a a"), (6, None), (7, ""), (8, "absent a"), (None, "a")]
    want = []
    for q, t in asked:
        p = _words(t)
        if q is not None and p:
            n = {i: sum(d[j : j + len(p)] == p for j in range(len(d))) for i, d in docs.items()}
            want += [(q, i, c) for i, c in n.items() if c]
    got = X.phrases(spark, path, spark.createDataFrame(asked, "query_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_common_word_on_many_partitions(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        X.build(spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("the").alias("text")), str(tmp_path), width=50)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    b = spark.read.parquet(f"{tmp_path}/blocks").select(F.input_file_name().alias("file"), "n")
    of = [r[1] for r in b.groupBy("file").agg(F.sum("n")).collect()]
    assert len(of) == 4 and sum(of) == 2000 and max(of) < 800


@pytest.mark.parametrize("name, bound", [("SMALL", 0), ("PUSHED", 1)])
def test_many_words_asked(spark, index, monkeypatch, name, bound):
    """Beyond each bound the join is another one, the result the same."""
    path, docs = index
    monkeypatch.setattr(X, name, bound)
    asked = spark.createDataFrame(ASKED, "query_id long, text string")
    want = [(q, *x) for q, t in dict(ASKED).items() if q is not None for x in _best(docs, t, 3)]
    assert sorted(map(tuple, X.search(spark, path, asked, 3).collect())) == sorted(want)


def test_words_are_pushed_into_the_scan(spark, index):
    path, _ = index
    plan = X.search(spark, path, spark.createDataFrame([(1, "rare h")], "query_id long, text string"))._jdf.queryExecution().toString()
    assert "In(word, [h,rare])" in plan and "BroadcastHashJoin" in plan


def test_empty_tables(spark, tmp_path, index):
    path, docs = index
    none = spark.createDataFrame([], "doc_id long, text string")
    X.build(none, str(tmp_path))
    asked = none.select(F.col("doc_id").alias("query_id"), "text")
    some = spark.createDataFrame([(1, "a b")], "query_id long, text string")
    for p, q in ((str(tmp_path), some), (path, asked), (str(tmp_path), asked)):
        assert X.search(spark, p, q).count() == 0 and X.phrases(spark, p, q).count() == 0
