"""Approximate nearest neighbours by a forest of random-projection trees.

Every tree has one random direction for each level and halves space again and again:
on the upper levels each node at the median of its own rows of a bounded sample, on
the levels below (down to about ``leaf`` points a leaf, whatever the number of rows)
each upper leaf at the median of its sample along the level's direction. So what is
sent to the workers is bounded by the sample, and leaves by ``leaf``: a group too small
to be seen in the sample may stay together, and streams past the queries that it meets.

A query walks all trees through one priority queue, ordered by the sum of squared
margins on the way, and visits the ``visits`` leaves that come out first. Its answer is
exact among all points of these leaves: each of them is either compared (distance in
double precision on the original vectors) or ruled out by proof. For the proof a point
has a code, one byte a component with the length of what the code leaves out, so the
distance to the code gives a lower and an upper bound of the distance to the point. A
point is ruled out only if its lower bound is above the ``k``-th smallest upper bound of
the query: first in each part of the leaves, then over all parts (there only for queries
with more than ``elect`` points left; fewer are all compared). No number of candidates is
a limit.

Leaves are dealt by a hash over parts of about equal numbers of visits. A part gets each
query and each code once, with all their leaves in it; codes stream by. Vectors
themselves travel only to queries that they are compared with. Of equal vectors only the
``k + 1`` smallest ids, each at most ``k`` times, can be among anybody's k nearest, so
only these are indexed (ranked before the shuffle, so a vector that a third of all rows
share is no hot key). The forest is fitted on at most ``sample`` rows; every row is indexed.

Defined results: vectors that are null, zero, of another length than most of the
sample, or hold null or non-finite components take no part as query or point, nor do
rows without vec_id. Ties go to the smaller vec_id. Repeated ids: each row is a point,
and a query with results, of its own; a query never returns its own id. No rows: no
rows. Other columns are ignored; components may be floats or doubles.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumry.llm.storage import materialize

#: Rows that are projected at once; sample rows that a node needs to be halved at its own median.
ROWS, NODE_ROWS = 1024, 32
#: Pairs of query and point whose bounds are computed at once and that meet at once; queries whose exact distances one task computes.
BLOCK_PAIRS, MEET_PAIRS, GROUP_QUERIES = 8192, 1 << 19, 256
#: Parts of the leaves at least; components of queries in a part, if each of its visits were another query's.
LEAST_PARTS, PART_COMPONENTS = 16, 1 << 23
_PART = "part int, side int, key long, id long, scale double, rest double, code binary, bins array<long>"
_LEFT = "query long, keys array<long>, low array<double>, high array<double>"


def usable(v: Column) -> Column:
    """Whether a vector has components, all finite, not all zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)


class Forest:
    """Leaves of a tree are numbered by their path: one bit for each level, from the root."""

    def __init__(self, rows: np.ndarray, points: int, trees: int, leaf: int, seed: int = 11):
        r = np.random.default_rng(seed)
        n, self.dim = rows.shape
        self.trees = trees
        self.depth = max(0, math.ceil(math.log2(max(1, points / leaf))))
        self.upper = min(self.depth, max(0, int(math.log2(max(1, n / NODE_ROWS)))))
        # directions of one tree are at right angles as far as there are dimensions
        turns = -(-max(1, self.depth) // self.dim)
        made = [np.concatenate([np.linalg.qr(r.normal(size=(self.dim, self.dim)))[0] for _ in range(turns)])[: self.depth] for _ in range(trees)]
        self.direction = np.concatenate(made).astype(np.float32) if self.depth else np.zeros((0, self.dim), np.float32)
        self.cut = np.zeros((trees, max(1, (1 << self.upper) - 1)), np.float32)
        self.tail = np.zeros((trees, 1 << self.upper, self.depth - self.upper), np.float32)
        side = self._project(rows)
        for t in range(trees):
            level = [np.arange(n)]
            for k in range(self.upper):
                below = []
                for i, g in enumerate(level):
                    s = side[g, t, k]
                    cut = self.cut[t, (1 << k) - 1 + i] = np.median(s) if len(g) else 0.0
                    below += [g[s <= cut], g[s > cut]]
                level = below
            for i, g in enumerate(level):
                if len(g):
                    self.tail[t, i] = np.median(side[g, t, self.upper :], axis=0)

    def _project(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees, levels)"""
        return (x.astype(np.float32) @ self.direction.T).reshape(len(x), self.trees, self.depth)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): the leaf of each row in each tree."""
        side, tree = self._project(x), np.arange(self.trees)
        at = np.zeros((len(x), self.trees), np.int64)
        for k in range(self.upper):
            at = 2 * at + (side[:, :, k] > self.cut[tree, (1 << k) - 1 + at])
        top = at
        for k in range(self.upper, self.depth):
            at = 2 * at + (side[:, :, k] > self.tail[tree, top, k - self.upper])
        return at

    def search(self, x: np.ndarray, visits: int, cuts: tuple[list, list] | None = None) -> list[tuple[int, int]]:
        """The first visits leaves (tree, leaf) that the shared priority queue gives for one row; cuts are cut and tail as lists."""
        side = self._project(x[None])[0].tolist()
        upper, depth = self.upper, self.depth
        cut, tail = cuts or (self.cut.tolist(), self.tail.tolist())
        queue = [(0.0, t, 0, 0) for t in range(self.trees)]
        out: list[tuple[int, int]] = []
        while queue and len(out) < visits:
            far, t, k, at = heapq.heappop(queue)
            own = side[t]
            while k < depth:
                m = own[k] - (cut[t][(1 << k) - 1 + at] if k < upper else tail[t][at >> (k - upper)][k - upper])
                k += 1
                at = 2 * at + (m > 0)
                heapq.heappush(queue, (far + m * m, t, k, at ^ 1))
            out.append((t, at))
        return out


def fit(points: DataFrame, trees: int, leaf: int, sample: int) -> Forest | None:
    """A forest on the rows of smallest hashes, at most sample of them."""
    n = points.count()
    spot = F.pmod(F.xxhash64("v"), F.lit(1 << 40))
    near = points.select("v", spot.alias("k")).where(F.col("k") < int(min(1.0, 1.5 * sample / max(1, n)) * (1 << 40)))
    rows = sorted(near.limit(3 * sample).collect(), key=lambda r: r.k)[:sample]
    if not rows:
        return None
    dim = Counter(len(r.v) for r in rows).most_common(1)[0][0]
    return Forest(np.array([r.v for r in rows if len(r.v) == dim], np.float64), n, trees, leaf)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(-1, dim)


def _dealt(
    side: int, key: np.ndarray, ids: np.ndarray, scale: np.ndarray, rest: np.ndarray, code: list[bytes], row: np.ndarray, bins: np.ndarray, parts: int
) -> pa.RecordBatch:
    """One row for each part and row number, with the bins of that row that lie in the part."""
    part = ((bins.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)
    order = np.lexsort((part, row))
    row, part, bins = row[order], part[order].astype(np.int32), bins[order]
    at = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (part[1:] != part[:-1])))) if len(row) else np.zeros(0, np.int64)
    r = row[at]
    cols = [part[at], np.full(len(at), side, np.int32), key[r], ids[r], scale[r], rest[r]]
    lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(row)), pa.int32()), pa.array(bins))
    cols = [*map(pa.array, cols), pa.array([code[i] for i in r.tolist()], pa.binary()), lists]
    return pa.RecordBatch.from_arrays(cols, names=["part", "side", "key", "id", "scale", "rest", "code", "bins"])


def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One byte for each component, the scale of each row, and the length of what code times scale leaves out."""
    scale = np.abs(x).max(axis=1) / 127
    code = np.rint(x / np.where(scale > 0, scale, 1)[:, None]).clip(-127, 127).astype(np.int8)
    with np.errstate(over="ignore"):
        return code, scale, np.sqrt(((x - code * scale[:, None]) ** 2).sum(axis=1))


def bounds(x: np.ndarray, code: np.ndarray, scale: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between rows of x and the rows that were coded, rounding included."""
    dim = x.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        x = x.astype(np.float32, copy=False)
        y = code * scale.astype(np.float32)[:, None]
        size = np.sqrt(np.einsum("ij,ij->i", x, x)).astype(np.float64) + np.sqrt(np.einsum("ij,ij->i", y, y))
        y -= x
        far = np.sqrt(np.einsum("ij,ij->i", y, y)).astype(np.float64)
        # errors in proportion to the lengths, and what single precision loses near zero
        off = rest * (1 + 1e-9) + size * ((dim + 4) * 2.4e-7) + 1e-18 * dim
        fine = np.isfinite(far) & np.isfinite(off)
        return np.where(fine, np.maximum(0, far - off), 0.0), np.where(fine, far + off, np.inf)


def _index(forest: Forest, parts: int):
    """Rows (key, id, v) to the parts that hold their leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                part = b.slice(i, ROWS)
                x = _matrix(part.column(2), forest.dim)
                bins = forest.leaves(x) | np.arange(forest.trees, dtype=np.int64) << 40
                code, scale, rest = coded(x)
                row = np.repeat(np.arange(len(x)), forest.trees)
                yield _dealt(1, part.column(0).to_numpy(), part.column(1).to_numpy(), scale, rest, [c.tobytes() for c in code], row, bins.ravel(), parts)

    return run


def _probes(forest: Forest, visits: int, parts: int):
    """Rows (key, id, v) of queries to the parts that hold leaves that they visit; their code is the vector itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, none = (forest.cut.tolist(), forest.tail.tolist()), np.zeros(1)
        for b in batches:
            for key, own, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _matrix(b.column(2), forest.dim)):
                tree, leaf = np.array(forest.search(x, visits, cuts), np.int64).T
                yield _dealt(0, np.array([key]), np.array([own]), none, none, [x.tobytes()], np.zeros(len(tree), np.int64), tree << 40 | leaf, parts)

    return run


class _Part:
    """The queries of one part, and for each the points of its leaves that may be among its k nearest."""

    def __init__(self, k: int, queries: list[pa.RecordBatch], dim: int):
        self.k = k
        self.key, self.ids = (np.concatenate([z.column(c).to_numpy() for z in queries]) for c in (2, 3))
        with np.errstate(over="ignore"):
            self.x = np.concatenate([np.frombuffer(v, np.float64) for z in queries for v in z.column(6).to_pylist()]).reshape(-1, dim).astype(np.float32)
        bins = np.concatenate([z.column(7).flatten().to_numpy() for z in queries])
        row = np.repeat(np.arange(len(self.key)), np.concatenate([np.asarray(z.column(7).value_lengths()) for z in queries]))
        order = np.argsort(bins, kind="stable")
        self.bins, self.row = bins[order], row[order]
        self.least = np.full(len(self.key), np.inf)  # the k-th smallest upper bound so far
        self.found: list[tuple[np.ndarray, ...]] = []
        self.held = self.kept = 0

    def meet(self, points: pa.RecordBatch) -> None:
        bins, size = points.column(7).flatten().to_numpy(), np.asarray(points.column(7).value_lengths())
        lo, hi = (np.searchsorted(self.bins, bins, s) for s in ("left", "right"))
        point, ends = np.repeat(np.arange(len(size)), size), np.cumsum(hi - lo)
        key, ids, scale, rest = (points.column(c).to_numpy() for c in (2, 3, 4, 5))
        code = np.frombuffer(b"".join(points.column(6).to_pylist()), np.int8).reshape(len(size), -1)
        last = np.cumsum(size)  # a point's bins stay together, so that no pair is met twice
        start = 0
        while start < len(size):
            first = last[start - 1] if start else 0
            done = ends[first - 1] if first else 0
            stop = max(start + 1, int(np.searchsorted(ends[last - 1], done + MEET_PAIRS, "right")))
            n = (hi - lo)[first : last[stop - 1]]
            at = np.repeat(lo[first : last[stop - 1]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pair = np.unique(self.row[at] * len(size) + np.repeat(point[first : last[stop - 1]], n))
            q, p = pair // len(size), pair % len(size)
            other = self.ids[q] != ids[p]
            q, p = q[other], p[other]
            for i in range(0, len(q), BLOCK_PAIRS):
                a, b = q[i : i + BLOCK_PAIRS], p[i : i + BLOCK_PAIRS]
                low, high = bounds(self.x[a], code[b], scale[b], rest[b])
                near = low <= self.least[a]
                self.found.append((a[near], key[b[near]], low[near], high[near]))
                self.held += int(near.sum())
            if self.held > 2 * self.kept + BLOCK_PAIRS:
                self.rule_out()
            start = stop

    def rule_out(self) -> None:
        q, key, low, high = (np.concatenate(x) for x in zip(*self.found))
        order = np.lexsort((high, q))
        q, key, low, high = q[order], key[order], low[order], high[order]
        kth = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q, "left") == self.k - 1)
        self.least[q[kth]] = high[kth]
        near = low <= self.least[q]
        self.found = [(q[near], key[near], low[near], high[near])]
        self.held = self.kept = int(near.sum())

    def left(self) -> Iterator[pa.RecordBatch]:
        """(query, keys, bounds) of the points that are left, a row for each query."""
        if not self.held:
            return
        self.rule_out()
        q, *cols = self.found[0]
        at = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        ends = np.append(at, len(q))
        for i in range(0, len(at), ROWS):
            e = ends[i : i + ROWS + 1]
            lists = [pa.ListArray.from_arrays(pa.array(e - e[0], pa.int32()), pa.array(c[e[0] : e[-1]])) for c in cols]
            yield pa.RecordBatch.from_arrays([pa.array(self.key[q[e[:-1]]]), *lists], names=["query", "keys", "low", "high"])


def _meet(k: int, dim: int):
    """Rows of parts, sorted by part, queries (side 0) first, to what is left of the points that each query meets there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, queries, part = None, [], None
        for b in batches:
            own, side = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (side[1:] != side[:-1])))).tolist() if len(own) else []
            for lo, hi in zip(edges, [*edges[1:], len(own)]):
                if own[lo] != last:
                    if part is not None:
                        yield from part.left()
                    last, queries, part = own[lo], [], None
                rows = b.slice(lo, hi - lo)
                if side[lo] == 0:
                    queries.append(rows)
                elif queries:
                    part = part or _Part(k, queries, dim)
                    part.meet(rows)
        if part is not None:
            yield from part.left()

    return run


def _elect(k: int, elect: int):
    """Rows (query, keys, bounds), sorted by query, to (query, key) of all points that may be among its k nearest."""

    def elected(query: int, left: list[list[np.ndarray]]) -> pa.RecordBatch:
        key, low, high = (np.concatenate(x) for x in zip(*left))
        key, at = np.unique(key, return_index=True)  # a point that several parts have left
        if len(key) > max(k, elect):
            key = key[low[at] <= np.partition(high[at], k - 1)[k - 1]]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), query)), pa.array(key)], names=["query", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[list[np.ndarray]] = []
        last = None
        for b in batches:
            for i, query in enumerate(b.column(0).to_pylist()):
                if query != last and left:
                    yield elected(last, left)
                    left = []
                last = query
                left.append([b.column(c).slice(i, 1).flatten().to_numpy() for c in (1, 2, 3)])
        if left:
            yield elected(last, left)

    return run


def _rerank(k: int, dim: int):
    """Rows (group, side, key, id, v, asking), sorted: queries (side 0), then points with the keys of queries that elected them."""

    def best(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        q, d, i = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((i, d, q))
        q, d, i = q[order], d[order], i[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        return q[rank < k], d[rank < k], i[rank < k]

    def answer(ids: np.ndarray, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        q, d, i = best(found)
        rank = (np.arange(len(q)) - np.searchsorted(q, q, "left") + 1).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(rank), pa.array(i), pa.array(d)], names=["query_id", "rank", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found, queries, held = None, [], [], 0
        key = ids = x = None
        for b in batches:
            group, side = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (side[1:] != side[:-1])))).tolist() if len(group) else []
            for lo, hi in zip(edges, [*edges[1:], len(group)]):
                if group[lo] != last:
                    if found:
                        yield answer(ids, found)
                    last, found, queries, held, key = group[lo], [], [], 0, None
                part = b.slice(lo, hi - lo)
                if side[lo] == 0:
                    queries.append(part)
                    continue
                if key is None:
                    key, ids = (np.concatenate([z.column(c).to_numpy() for z in queries]) for c in (2, 3))
                    x = np.concatenate([_matrix(z.column(4), dim) for z in queries])
                    order = np.argsort(key)
                    key, ids, x = key[order], ids[order], x[order]
                asking = part.column(5)
                row = np.repeat(np.arange(part.num_rows), np.asarray(asking.value_lengths()))
                q = np.searchsorted(key, asking.flatten().to_numpy())
                i = part.column(3).to_numpy()[row]
                other = ids[q] != i
                q, row, i = q[other], row[other], i[other]
                p = _matrix(part.column(4), dim)
                for at in range(0, len(q), 8 * ROWS):
                    a = slice(at, at + 8 * ROWS)
                    found.append((q[a], np.sqrt(((x[q[a]] - p[row[a]]) ** 2).sum(axis=1)), i[a]))
                held += len(q)
                if held > 64 * GROUP_QUERIES * k:
                    found, held = [best(found)], 0
        if found:
            yield answer(ids, found)

    return run


def elected_pairs(spark: SparkSession, points: DataFrame, asked: DataFrame, forest: Forest, k: int, visits: int, elect: int) -> DataFrame:
    """(query, key): the points (key, v, id if it isn't the key) whose distances to the queries (likewise) are to be computed."""
    parts = max(LEAST_PARTS, -(-asked.count() * visits * forest.dim // PART_COMPONENTS))
    rows = [x.select("key", F.col("id" if "id" in x.columns else "key").alias("id"), "v") for x in (asked, points)]
    both = rows[0].mapInArrow(_probes(forest, visits, parts), _PART).unionByName(rows[1].mapInArrow(_index(forest, parts), _PART))
    left = both.repartition(parts, "part").sortWithinPartitions("part", "side").mapInArrow(_meet(k, forest.dim), _LEFT)
    return left.repartition("query").sortWithinPartitions("query").mapInArrow(_elect(k, elect), "query long, key long")


def nearest(
    spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10, trees: int = 64, leaf: int = 24, visits: int = 4000, sample: int = 16384, elect: int = 2500
) -> DataFrame:
    """vectors and queries (vec_id long, embedding array) -> (query_id, rank, vec_id, score), rank from 1."""

    def clean(x: DataFrame) -> DataFrame:
        return x.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("v")).where(usable(F.col("v")) & F.col("id").isNotNull())

    first = Window.partitionBy("v").orderBy("id")
    points = clean(vectors).groupBy("v", "id").agg(F.count(F.lit(1)).alias("n"))
    points = points.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
    points = points.select("id", "v", F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int"))).alias("copy")).drop("copy")
    # written once, so that every row has one key of its own from here on
    points = materialize(spark, points.withColumn("key", F.monotonically_increasing_id()), "ann-points")
    forest = fit(points, trees, leaf, sample)
    if forest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = points.where(F.size("v") == forest.dim)
    asked = clean(queries).where(F.size("v") == forest.dim).withColumn("v", F.col("v").cast(points.schema["v"].dataType))
    asked = materialize(spark, asked.withColumn("key", F.monotonically_increasing_id()), "ann-queries")
    groups = max(1, -(-asked.count() // GROUP_QUERIES))
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups)).cast("int").alias("grp")
    pairs = elected_pairs(spark, points, asked, forest, k, visits, elect)
    wanted = pairs.groupBy(group("query"), "key").agg(F.collect_list("query").alias("asking")).join(points, "key")
    wanted = wanted.select("grp", F.lit(1).alias("side"), "key", "id", "v", "asking")
    own = asked.select(group("key"), F.lit(0).alias("side"), "key", "id", "v", F.array().cast("array<long>").alias("asking"))
    rows = own.unionByName(wanted).repartition("grp").sortWithinPartitions("grp", "side")
    return rows.mapInArrow(_rerank(k, forest.dim), "query_id long, rank int, vec_id long, score double")
