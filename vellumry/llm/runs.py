"""Periodic runs of words: stretches that repeat with a period, found by power-of-two naming.

The words of a text get numbers; Karp, Miller and Rosenberg's names then stand for windows of 1, 2, 4, 8 ... words, each
level's names made of pairs of the level below by one sort. A window that occurs once has the name 0, which equals nothing,
and naming ends with the first level without two equal windows: a text without long repeats has few levels. How far the
words from two places agree, forwards or backwards, is read off the names from the highest level down.

A run of period q and at least ``copies`` (3 or more) periods holds a multiple i of q among its first q words. From i on, at
least w = max(least, copies * q) - 2q + 1 > q words agree with those q later, so two windows of one level that together cover w
words have equal names at i and i + q. Each period is tried at its multiples only (n / q places), all periods of one level
at once. Of neighbouring multiples that pass only the first is extended, as the others lie in the same run. A stretch
that multiples of its period find as well is kept with the smallest, which is its smallest period.

Defined results: a null or empty text has no words and no runs. Rows are judged each for itself, so repeated rows and null
ids are rows like others; other columns are ignored whatever their names. An empty table gives no rows. A text is one
row's work: n words take n log n steps for each level, memory for one number a word and level.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.llm.bpe import release

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Places of the grid that are compared at once, at most, but for one period's.
GRID = 1 << 18
#: Bytes of text that are given back at once, at most, but for one row's.
OUT_BYTES = 1 << 20


def numbers(words: list[str]) -> np.ndarray:
    """Equal words, equal numbers."""
    seen: dict[str, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def name_levels(ids: np.ndarray) -> list[np.ndarray]:
    """levels[k][i] names the words [i, i + 2**k): equal where the words are, 0 where no other place has them."""
    levels: list[np.ndarray] = []
    at, key = np.arange(len(ids)), ids
    while len(at):
        _, name, times = np.unique(key, return_inverse=True, return_counts=True)
        twice = times[name] > 1
        if not twice.any():
            break
        half = 1 << len(levels)
        names = np.zeros(len(ids) - half + 1, np.int32)
        names[at[twice]] = np.cumsum(times > 1)[name[twice]]
        levels.append(names)
        left, right = names[: max(0, len(names) - half)], names[half:]
        at = np.flatnonzero((left > 0) & (right > 0))
        key = left[at].astype(np.int64) * (int(names.max()) + 1) + right[at]
    return levels


def agree(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
    """How many words from i on equal those from j on (step 1), or before i those before j (step -1); i < j."""
    out = np.zeros(len(i), np.int64)
    for k in reversed(range(len(levels))):
        names, size = levels[k], 1 << k
        a, b = (i + out, j + out) if step == 1 else (i - out - size, j - out - size)
        ok = (a >= 0) & (b < len(names))
        x = names[a[ok]]
        ok[ok] = (x > 0) & (x == names[b[ok]])
        out[ok] += size
    return out


def find_runs(ids: np.ndarray, least: int = 24, copies: int = 3) -> np.ndarray:
    """Rows (start, length, period) of all maximal runs, by start, then period."""
    if copies < 3:
        raise ValueError("runs of fewer than three periods aren't found by the grid")
    n, found = len(ids), [np.zeros((0, 3), np.int64)]
    levels = name_levels(ids)
    period = np.arange(1, n // copies + 1)
    window = np.maximum(least, copies * period) - 2 * period + 1
    places = np.maximum(0, (n - period - window) // period + 1)
    level = np.frexp(window)[1] - 1  # the greatest k with 2**k <= window
    for k, names in enumerate(levels):
        own = np.flatnonzero((level == k) & (places > 0))
        ends = np.cumsum(places[own])
        lo = 0
        while lo < len(own):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + GRID, "right")))
            some = own[lo:hi]
            lo = hi
            q, first = np.repeat(period[some], places[some]), np.cumsum(places[some]) - places[some]
            i = q * (np.arange(len(q)) - np.repeat(first, places[some]))
            rest = np.repeat(window[some] - (1 << k), places[some])
            x, y = names[i], names[i + rest]
            ok = np.flatnonzero((x > 0) & (x == names[i + q]) & (y > 0) & (y == names[i + q + rest]))
            q, i = q[ok], i[ok]
            begins = np.ones(len(q), bool)
            begins[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1] + q[1:])
            q, i = q[begins], i[begins]
            start = i - agree(levels, i, i + q, -1)
            length = i + q + agree(levels, i, i + q, 1) - start
            long = length >= np.maximum(least, copies * q)
            found.append(np.stack((start, length, q), axis=1)[long])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each word stays: it goes if a run holds it after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth)[:n] == 0


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _batch(ids: pa.Array, n_words: list[int], runs: list[np.ndarray], texts: list[str]) -> pa.RecordBatch:
    all_runs = np.concatenate(runs)
    fields = pa.StructArray.from_arrays([pa.array(all_runs[:, c]) for c in range(3)], names=["start", "length", "period"])
    ends = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), fields).cast(_RUNS), pa.array(texts, pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame, least: int = 24, copies: int = 3) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, n_words, runs array<struct<start, length, period>>, collapsed), one row per row.

    Words are what ASCII white space separates, numbered from 0. collapsed has the words that no run holds after its first
    period, joined by one space. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            first, held, n_words, runs, texts = 0, 0, [], [], []
            for at, text in enumerate(b.column(1)):
                words = _WORD.findall(text.as_py() or "")
                got = find_runs(numbers(words), least, copies)
                if len(got):
                    stay = kept_words(len(words), got)
                    collapsed = " ".join([words[i] for i in np.flatnonzero(stay)])
                else:
                    collapsed = " ".join(words)
                n_words.append(len(words)), runs.append(got), texts.append(collapsed)
                held += len(collapsed)
                if held > OUT_BYTES or at == b.num_rows - 1:
                    yield _batch(b.column(0).slice(first, at + 1 - first), n_words, runs, texts)
                    first, held, n_words, runs, texts = at + 1, 0, [], [], []

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def greatest_exponent(runs: F.Column) -> F.Column:
    """Of runs by start, then period, the first whose length / period is greatest, compared exactly; null if there are none."""
    better = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda a, r: F.when(better(a, r), r).otherwise(a))
