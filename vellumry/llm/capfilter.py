"""Embedding near-duplicates by spherical-cap filters with structured product codes.

A randomly turned vector is split into two halves; each half has its own code of
``m`` random directions, and a filter is a pair of codewords, so ``m * m`` filters
cost ``2 m`` products. A vector belongs to every filter whose direction it exceeds
the threshold on, listed from the two sorted halves without trying all pairs. The
threshold is the quantile of a random direction that puts ``lists`` filters on a
vector whatever the data; ``m`` grows with the number of vectors, so that filters
hold about ``per_filter`` unclustered ones. A longer code misses more pairs, so the
chance that one code misses a pair at the threshold is measured on random pairs for
the ``m`` in use, and so many independent codes are taken that all of them miss it
with a chance below ``miss`` at every size: in 64 dimensions at 0.95 two codes at 50
thousand vectors, three at 5 million, four at 117 million. Turned at random, a code's
chance depends on the pair's cosine alone, and closer pairs are missed less.

Equal vectors are one class before any filter. Members of a filter go to the blocks
that it is cut into, once for each block that they are to meet; sorted by block, they
stream through a task that holds one block of at most about 2 * ``BLOCK`` vectors at a
time. Of each block pair only link counts and component labels of its members leave,
never pairs. A pair counts in its first common filter alone: earlier common filters
are found by a product of membership matrices.

Defined results: vectors that are null, zero or hold null or non-finite components,
and rows without vec_id, have no links and are their own component (null where the
id is null; such rows are kept). Vectors link within their length, each length with
its own codes; one of at most ``BLOCK`` vectors has a single filter. Equal vectors
link. Every row is a vector, also where its vec_id is repeated: two vectors of one
vec_id link as others do. No rows: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.llm.components import connected_components
from vellumry.llm.rpforest import usable
from vellumry.llm.storage import materialize

BLOCK = 1024
#: Rows that are scored at once.
ROWS = 1024
#: Random pairs that a code is tried on, and codes that are tried.
TRIED_PAIRS, TRIED_CODES = 4000, 2
#: Bytes of vectors in a task of the block step, and most tasks of it.
TASK_BYTES, MOST_TASKS = 16 << 20, 1 << 15
#: Steps of a filter score.
GRID = 1e9


class ProductCode:
    def __init__(self, dim: int, m: int, lists: float, seed: int):
        r = np.random.default_rng(seed)
        self.turn = np.linalg.qr(r.normal(size=(dim, dim)))[0]
        self.half = max(1, dim // 2)
        self.m = m
        self.least = min(m, max(1, int(lists)))

        def code(d: int) -> np.ndarray:
            c = r.normal(size=(m, d))
            return c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(2)

        self.first = code(self.half)
        self.second = code(dim - self.half) if dim > self.half else np.zeros((m, 0))
        share = min(0.5, lists / (m * m))
        self.threshold = NormalDist().inv_cdf(1 - share) / np.sqrt(dim) if share < 0.5 else 0.0

    def filters(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted filters of each unit vector: all pairs of codewords that it exceeds the threshold on."""
        return [x for at in range(0, len(unit), ROWS) for x in self._some(unit[at : at + ROWS])]

    def _some(self, unit: np.ndarray) -> list[np.ndarray]:
        # integers from sums in a fixed order: alike wherever and with whatever rows a vector is listed again
        x = np.einsum("ij,jk->ik", unit, self.turn)
        a = np.rint(np.einsum("ij,kj->ik", x[:, : self.half], self.first) * GRID).astype(np.int64)
        b = np.rint(np.einsum("ij,kj->ik", x[:, self.half :], self.second) * GRID).astype(np.int64)
        out = []
        for p, q in zip(a, b):
            best = (np.sort(p)[-self.least :, None] + np.sort(q)[-self.least :]).ravel()
            t = min(int(self.threshold * GRID), np.partition(best, -self.least)[-self.least])
            i = np.flatnonzero(p + q.max() >= t)
            order = np.argsort(-q)
            n = np.searchsorted(-q[order], p[i] - t, "right")
            row = np.repeat(i, n)
            col = order[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)]
            out.append(np.sort(row * self.m + col))
        return out


class OneFilter:
    """A code of one filter, which every vector belongs to."""

    m = 1

    def filters(self, unit: np.ndarray) -> list[np.ndarray]:
        return [np.zeros(1, np.int64)] * len(unit)


#: Length of a vector -> number of its first filter, codes.
Codes = dict[int, tuple[int, list[ProductCode | OneFilter]]]


def _pairs(n: int, dim: int, cosine: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """n pairs of unit vectors at the cosine, in random directions."""
    r = np.random.default_rng(seed)
    a, b = r.normal(size=(2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine * cosine) * b


def missed(codes: list[ProductCode], a: np.ndarray, b: np.ndarray) -> int:
    """Pairs of rows of a and b without a common filter."""
    return sum(not len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(_lists(codes, a), _lists(codes, b)))


def enough_codes(dim: int, m: int, lists: float, threshold: float, miss: float, seed: int = 17) -> list[ProductCode]:
    """So many codes that all of them miss a pair at the threshold with a chance below miss.

    One code's chance is taken two standard deviations, and three pairs more, above what is measured.
    """
    if dim < 2:  # the only directions are equal or opposite ones
        return [ProductCode(dim, m, lists, seed)]
    a, b = _pairs(TRIED_PAIRS, dim, min(1.0, max(-1.0, threshold)), seed)
    found = sum(missed([ProductCode(dim, m, lists, seed + k)], a, b) for k in range(TRIED_CODES))
    chance = min(0.99, (found + 2 * np.sqrt(found) + 3) / (TRIED_PAIRS * TRIED_CODES))
    return [ProductCode(dim, m, lists, seed + k) for k in range(max(1, int(np.ceil(np.log(miss) / np.log(chance)))))]


def _units(col: pa.Array, dim: int) -> np.ndarray:
    x = np.asarray(col.flatten(), np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _lists(codes: list[ProductCode | OneFilter], unit: np.ndarray, base: int = 0) -> list[np.ndarray]:
    """Sorted filters of each unit vector over all codes, from number base on."""
    each = [[x + base + k * c.m * c.m for x in c.filters(unit)] for k, c in enumerate(codes)]
    return [np.concatenate(x) for x in zip(*each)]


def _into_filters(codes: Codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = np.asarray(pc.list_value_length(b.column(1)))
            for dim in np.unique(size).tolist():
                if dim in codes:
                    at = np.flatnonzero(size == dim)
                    base, code = codes[dim]
                    lists = _lists(code, _units(b.column(1).take(pa.array(at)), dim), base)
                    row = pa.array(np.repeat(at, [len(x) for x in lists]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists)), b.column(0).take(row)], names=["bin", "key"])

    return run


def _member(lists: list[np.ndarray], among: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lists), len(among)), np.float32)
    for k, x in enumerate(lists):
        at = np.searchsorted(among, x)
        at = at[(at < len(among))]
        hit = at[np.isin(among[at], x, assume_unique=True)] if len(at) else at
        out[k, hit] = 1
    return out


def _met(near: np.ndarray, weights: list[np.ndarray], keys: list[np.ndarray], sides: tuple[int, ...]) -> pa.RecordBatch:
    """(key, links, label) of the members of one block pair that have a link in it."""
    top = np.iinfo(np.int64).max
    label = [keys[0].copy(), keys[1].copy()]
    while True:
        a = np.minimum(label[0], np.where(near, label[1], top).min(axis=1))
        c = np.minimum(label[1], np.where(near, a[:, None], top).min(axis=0))
        done = (a == label[0]).all() and (c == label[1]).all()
        label = [a, c]
        if done:
            break
    links = [near @ weights[1], weights[0] @ near]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([z[s] for s in sides]).astype(np.int64)) for z in (keys, links, label)], names=["key", "links", "label"])


def _link(codes: Codes, threshold: float):
    """Rows (bin, i, j, side, key, n, v), sorted by the first four, to what _met gives for each block pair (bin, i, j)."""

    def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(parts).combine_chunks()
        if rows.num_rows < 2:
            return None
        bin_, i, j = (rows.column(k)[0].as_py() for k in range(3))
        cut = int(np.searchsorted(rows.column(3).to_numpy(), 1))
        v = rows.column(6).chunk(0)
        dim = int(pc.list_value_length(v)[0].as_py())
        base, code = codes[dim]
        unit = _units(v, dim)
        sides = (slice(0, cut), slice(0, cut)) if i == j else (slice(0, cut), slice(cut, None))
        unit = [unit[x] for x in sides]
        keys = [rows.column(4).to_numpy()[x] for x in sides]
        n = [rows.column(5).to_numpy()[x] for x in sides]
        near = unit[0] @ unit[1].T >= threshold
        if i == j:
            np.fill_diagonal(near, False)
        if not near.any():
            return None
        keep = [np.flatnonzero(near.any(axis=1 - s)) for s in (0, 1)]
        near = near[np.ix_(*keep)]
        keys, n = [a[k] for a, k in zip(keys, keep)], [a[k] for a, k in zip(n, keep)]
        own = [_lists(code, u[k], base) for u, k in zip(unit, keep)]
        early = [[o[: np.searchsorted(o, bin_)] for o in side] for side in own]
        among = np.intersect1d(*(np.unique(np.concatenate(e)) for e in early))
        if len(among):
            near &= _member(early[0], among) @ _member(early[1], among).T < 0.5
        return _met(near, n, keys, (0,) if i == j else (0, 1)) if near.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(k).to_numpy() for k in range(3)]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            edges = [0, *new.tolist(), b.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                own = tuple(int(c[lo]) for c in cols)
                if own != last and held:
                    if (found := block(held)) is not None:
                        yield found
                    held = []
                held.append(b.slice(lo, hi - lo))
                last = own
        if held and (found := block(held)) is not None:
            yield found

    return run


def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = 0.95, lists: float = 16, per_filter: int = 256, miss: float = 1e-6) -> DataFrame:
    """vectors (vec_id long, embedding array<float or double>) -> (vec_id, n_links, component_id, kept), one row per row."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    good = rows.where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    classes = good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
    # written once, so that every class has one key of its own from here on
    classes = materialize(spark, classes.withColumn("key", F.monotonically_increasing_id()), "cap-classes")
    sizes = classes.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()
    kept = lambda component: F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")
    if not sizes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), kept(F.col("vec_id")))
    codes: Codes = {}
    base = 0
    for dim, n in sorted((r.dim, r.n) for r in sizes if r.n > 1):
        m = max(16, int(np.ceil(np.sqrt(n * lists / per_filter))))
        codes[dim] = base, [OneFilter()] if n <= BLOCK else enough_codes(dim, m, lists, threshold, miss)
        base += sum(c.m * c.m for c in codes[dim][1])
    width = sum(r.dim * r.n for r in sizes) // sum(r.n for r in sizes)
    listed = classes.select("key", "v").mapInArrow(_into_filters(codes), "bin long, key long")
    listed = materialize(spark, listed, "cap-filters")
    size = listed.groupBy("bin").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    size = size.select("bin", F.ceil(F.col("members") / BLOCK).cast("int").alias("parts"))
    # a member of block i meets every block of its filter: it is on side 0 of the pairs (i, j >= i), on side 1 of (j < i, i)
    own = listed.join(size, "bin").withColumn("own", F.pmod(F.xxhash64("key"), "parts").cast("int"))
    dealt = own.select("bin", "key", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select("bin", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "key")
    dealt = materialize(spark, dealt, "cap-dealt")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, dealt.count() * 4 * width // TASK_BYTES))
    blocks = dealt.join(classes.select("key", "n", "v"), "key").select("bin", "i", "j", "side", "key", "n", "v")
    met = blocks.repartition(tasks, "bin", "i", "j").sortWithinPartitions("bin", "i", "j", "side").mapInArrow(_link(codes, threshold), "key long, links long, label long")
    met = materialize(spark, met, "cap-links")
    count = met.groupBy("key").agg(F.sum("links").alias("links"))
    parts = connected_components(spark, met.select(F.col("key").alias("a"), F.col("label").alias("b")).distinct())
    known = classes.join(count, "key", "left").join(parts.select(F.col("id").alias("key"), F.col("component_id").alias("root")), "key", "left")
    known = known.select("v", "id", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "key").alias("root"))
    least = known.groupBy("root").agg(F.min("id").alias("component_id"))
    known = known.join(least, "root").select("v", "n", "links", "component_id")
    out = rows.join(known, "v", "left")
    component = F.when(usable(F.col("v")) & F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")).otherwise(F.col("vec_id"))
    links = F.when(F.col("vec_id").isNotNull(), F.col("links") + F.col("n") - 1)
    return out.select("vec_id", F.coalesce(links, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept(component))
