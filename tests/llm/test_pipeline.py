"""Stages of the corpus pipeline on odd rows: what each keeps, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bin long, component_id string, score double"


@pytest.fixture(scope="module")
def stages():
    import corpus_pipeline as P

    return dict(P.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    """Null ids and texts, empties, repeats, one very long text, copies, and columns named as the operators' own."""
    r = random.Random(5)
    words = ["".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(3000)]
    base = " ".join(words[:150])
    texts = [(1, base), (2, base), (3, base.replace(words[75], "other", 1)), (4, " ".join(words[400:520])), (5, None), (6, ""), (7, "two words"), (8, "two words")]
    texts += [(None, base), (None, None), (9, " ".join(r.choices(words, k=40_000))), (4, " ".join(words[400:520]))]
    rows = [(k, t, "en", "s", None if t is None else len(t), 1, "c", 0.5) for k, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _shingles(t):
    w = t.split() if t else []
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_duplicates_keep_one_of_each_group(spark, stages, docs):
    got = stages["near_duplicates"](spark, docs, DIR)
    assert got.columns == docs.columns
    rows, first = docs.collect(), {}
    for r in rows:
        if r.doc_id is not None:
            first.setdefault(r.doc_id, _shingles(r.text))
    # Links of this table are between its first three ids, and between 7 and 8: no chains, so the smallest like id decides.
    near = lambda a, b: a and b and 10 * len(a & b) >= 8 * len(a | b)
    gone = {k for k in first for j in first if j < k and near(first[j], first[k])}
    assert gone == {2, 3, 8}
    assert _rows(got) == sorted((tuple(r) for r in rows if r.doc_id not in gone), key=repr)


def test_repeats_cut_what_earlier_texts_hold(spark, stages, docs):
    """Byte by byte: what a 100-byte string that also starts earlier covers goes."""
    some = docs.where("doc_id IS NULL OR doc_id NOT IN (4, 9)")
    got = {(r.doc_id, r.text) for r in stages["repeats"](spark, some, DIR).where("doc_id IS NOT NULL").select("doc_id", "text").collect()}
    seen, want = set(), set()
    for r in some.where("doc_id IS NOT NULL").orderBy("doc_id").collect():
        b = (r.text or "").encode()
        covered = set()
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                covered.update(range(i, i + 100))
            seen.add(b[i : i + 100])
        want.add((r.doc_id, None if r.text is None else bytes(c for i, c in enumerate(b) if i not in covered).decode()))
    assert {(k, t or "") for k, t in got} == {(k, t or "") for k, t in want}
    out = stages["repeats"](spark, some, DIR)
    assert out.columns == docs.columns and out.where("doc_id IS NULL").count() == 2
    assert out.where("text IS NOT NULL AND doc_id IS NOT NULL AND n_chars <> length(text)").count() == 0


def test_quality_and_language_keep_columns_and_rows(spark, stages, docs):
    good = spark.read.parquet(f"{DIR}/documents.parquet")
    odd = docs.select(*good.columns, "bin", "component_id", "score")
    wide = good.select(*good.columns, F.lit(1).cast("long").alias("bin"), F.lit("c").alias("component_id"), F.lit(0.5).alias("score"))
    both = wide.unionByName(odd.withColumn("doc_id", F.col("doc_id") + 1_000_000))
    for name in ("quality", "language"):
        got = stages[name](spark, both, DIR)
        assert got.columns == both.columns and got.exceptAll(both).count() == 0, name
        assert got.where("doc_id < 1000000").count() > 0.6 * good.count(), name
    # A text without a letter is in no language.
    assert got.where("doc_id IN (1000005, 1000006)").count() == 0


@pytest.mark.parametrize("name", ["quality", "language", "near_duplicates", "repeats", "packing"])
def test_empty_tables(spark, stages, docs, name):
    got = stages[name](spark, docs.limit(0), DIR)
    assert got.count() == 0 and (name == "packing" or got.columns == docs.columns)


def test_packing_holds_every_row_once(spark, stages, docs):
    got = stages["packing"](spark, docs, DIR).collect()
    # The pieces of each row are whole: a row is its end id, or more.
    total = sum(r.length for r in got)
    ends = [r for r in got if r.start + r.length == r.doc_tokens]
    assert len(ends) == docs.count() and total == sum(r.doc_tokens for r in ends)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048
