"""Periodic runs against trying every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from vellumry.llm import queries, runs

DIR = "/root/testdata/sf0.001"


def brute(x, least=24, copies=3):
    """(start, length, period) of all maximal runs; each stretch with its smallest period."""
    found = {}
    for q in range(1, len(x) // copies + 1):
        i = 0
        while i < len(x) - q:
            s = i
            while i < len(x) - q and x[i] == x[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, copies * q):
                found.setdefault((s, i + q - s), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(r, n, letters):
    x = [r.randrange(letters) for _ in range(n)]
    for _ in range(r.randrange(5)):
        if n:
            p, s = r.randrange(1, 40), r.randrange(n)
            for i in range(s + p, min(n, s + r.randrange(1, 250))):
                x[i] = x[i - p]
    return x


@pytest.mark.parametrize("least, copies", [(24, 3), (1, 3), (6, 3), (10, 4), (40, 5)])
def test_runs_brute(least, copies):
    r = random.Random(least)
    for _ in range(400):
        x = repetitive(r, r.randrange(300), r.choice([1, 2, 3, 60]))
        assert [tuple(map(int, z)) for z in runs.find_runs(np.array(x, np.int64), least, copies)] == brute(x, least, copies)


def test_runs_in_small_blocks(monkeypatch):
    monkeypatch.setattr(runs, "GRID", 7)
    r = random.Random(1)
    for _ in range(100):
        x = repetitive(r, 200, 3)
        assert [tuple(map(int, z)) for z in runs.find_runs(np.array(x, np.int64))] == brute(x)
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(5, np.int64), copies=2)


def test_names_and_agreement():
    r = random.Random(3)
    for _ in range(200):
        x = np.array(repetitive(r, r.randrange(2, 120), 2), np.int64)
        levels = runs.name_levels(x)
        for k, names in enumerate(levels):
            windows = [tuple(x[i : i + (1 << k)]) for i in range(len(names))]
            assert all((names[i] == names[j] > 0) == (windows[i] == windows[j]) for i in range(len(names)) for j in range(i))
        i, j = sorted(r.sample(range(len(x)), 2))
        ahead = next((d for d in range(len(x)) if j + d >= len(x) or x[i + d] != x[j + d]), len(x))
        behind = next((d for d in range(len(x)) if i - d - 1 < 0 or x[i - d - 1] != x[j - d - 1]), len(x))
        assert [int(runs.agree(levels, np.array([i]), np.array([j]), s)[0]) for s in (1, -1)] == [ahead, behind]


def test_a_million_words_with_every_period():
    assert runs.find_runs(np.zeros(1_000_000, np.int64)).tolist() == [[0, 1_000_000, 1]]
    assert runs.find_runs(np.arange(300_000) % 1000).tolist() == [[0, 300_000, 1000]]


def digest(doc_id, words):
    """What op12 gives for the words."""
    found = brute(words)
    best = None
    for s, n, q in found:
        if best is None or n * best[2] > best[1] * q:
            best = (s, n, q)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *shown, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def changed(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_odd_documents(spark, tmp_path):
    r = random.Random(5)
    part = " ".join(f"w{r.randrange(50)}" for _ in range(11))
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "x " * 23, "x " * 24, "x y " * 30, f"{part} " * 5, f"a {part} {part} {part} b", "日本 🎉 " * 40, "x\ty\n" * 5000, " ".join(f"w{r.randrange(5)}" for _ in range(3000))]
    rows = [(k, t) for k, t in enumerate(texts)] + [(7, texts[7]), (None, texts[7]), (None, None)]
    tens = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows += [(k, " ".join(f"w{r.randrange(900)}" for _ in range(r.choice([1, 2, 30, 500])))) for k in tens]
    df = spark.createDataFrame([(*x, 1, "c") for x in rows], "doc_id long, text string, runs int, collapsed string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_runs(spark, str(tmp_path)).collect()
    assert sorted(map(str, got)) == sorted(map(str, [tuple_row(got[0], digest(k, changed(k, t))) for k, t in rows]))
    assert sum(x.n_runs > 0 for x in got) > len(tens) // 2
    assert runs.periodic_runs(df.limit(0)).count() == 0
    kept = {x.doc_id: x.collapsed for x in runs.periodic_runs(df.where("doc_id = 8")).collect()}
    assert kept[8] == f"a {part} b"


def tuple_row(like, values):
    from pyspark.sql import Row

    return Row(*like.__fields__)(*values)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()]
    short = {k: t for k, t in docs if len(t or "") < 6000}
    got = {r.doc_id: tuple(r) for r in queries.op12_runs(spark, DIR).collect()}
    assert len(got) == len(docs)
    assert all(got[k] == digest(k, changed(k, t)) for k, t in short.items())
