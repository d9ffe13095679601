"""Quality classifier: a convolutional network over bytes, in numpy.

FILTERS learned filters of WIDTH bytes slide over the whole text; their rectified
responses are averaged in overlapping chunks of two CELLs; a small learned layer
scores every chunk; the largest score of each unit over all chunks of the document
(max-pooling) are combined into one probability.

A model is fitted on the driver from at most ``max_docs`` labelled documents of
at most ``max_bytes`` in all (documented bounds; the smallest hashes of doc_id
come first, whole texts of any size as long as they fit), then scores every whole
text of the corpus. Sizes are fetched first, so no more text than that is ever sent.

Defined results: null and empty texts are one zero byte. Without both labels in
the training rows every score is the share of label 1 (0.5 without rows). A doc_id
with both labels counts as 1; repeated rows of a doc_id are trained on and scored
each for itself; rows without doc_id are scored. Very long texts are read in spans
of bounded size. An empty table gives no rows. ``keep`` passes other columns through
whatever their names, ``score`` ignores them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.llm.bpe import release
from vellumry.llm.bytehash import chunks
from vellumry.llm.storage import small_table

FILTERS, WIDTH, CELL, UNITS = 12, 6, 64, 16
#: Bytes whose responses are held at once.
SPAN = 1 << 16


def padded(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, text starts, text sizes): texts with WIDTH - 1 zeros behind each, at least one byte each."""
    n = np.diff(off)
    size = np.maximum(n, 1)
    start = np.cumsum(size + WIDTH - 1) - (size + WIDTH - 1)
    out = np.zeros(int((size + WIDTH - 1).sum()), np.uint8)
    out[np.arange(len(buf)) + np.repeat(start - off[:-1], n)] = buf
    return out, start, size


class ByteCNN:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.w = (r.normal(size=(WIDTH, 256, FILTERS)) * 0.15).astype(np.float32)
        self.b = np.full(FILTERS, 0.1, np.float32)
        self.u = (r.normal(size=(FILTERS, UNITS)) * 0.8).astype(np.float32)
        self.c = np.zeros(UNITS, np.float32)
        self.v = (r.normal(size=UNITS) * 0.3).astype(np.float32)
        self.d = np.zeros(1, np.float32)
        self.constant: float | None = None

    def _respond(self, x: np.ndarray, i: int, j: int) -> np.ndarray:
        z = np.take(self.w[0], x[i:j], axis=0)
        for k in range(1, WIDTH):
            z += np.take(self.w[k], x[i + k : j + k], axis=0)
        z += self.b
        return np.maximum(z, 0, out=z)

    def cells(self, x: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sum of responses in each cell, bytes in each cell, cells before each text, first byte of each cell)."""
        n = -(-size // CELL)
        before = np.concatenate(([0], np.cumsum(n)))
        text = np.repeat(np.arange(len(n)), n)
        k = np.arange(before[-1]) - before[text]
        at = start[text] + k * CELL
        width = np.minimum(CELL, size[text] - k * CELL)
        sums = np.empty((len(at), FILTERS), np.float32)
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SPAN)))
            i, j = int(at[lo]), int(at[hi - 1] + width[hi - 1])
            z = self._respond(x, i, j)
            edges = np.stack((at[lo:hi], at[lo:hi] + width[lo:hi]), 1).ravel() - i
            sums[lo:hi] = np.add.reduceat(z, edges[:-1], axis=0)[::2]
            lo = hi
        return sums, width, before, at

    @staticmethod
    def chunk_means(sums: np.ndarray, width: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Overlapping chunks of a cell and the next of its text: means, sizes, whether there is a next."""
        joint, size = sums.copy(), width.astype(np.float32)
        more = np.ones(len(width), bool)
        more[before[1:] - 1] = False
        k = np.flatnonzero(more)
        joint[k] += sums[k + 1]
        size[k] += width[k + 1]
        return joint / size[:, None], size, more

    def forward(self, x: np.ndarray, start: np.ndarray, size: np.ndarray) -> dict:
        sums, width, before, at = self.cells(x, start, size)
        mean, csize, more = self.chunk_means(sums, width, before)
        h = np.maximum(mean @ self.u + self.c, 0)
        top = np.maximum.reduceat(h, before[:-1], axis=0)
        p = 1 / (1 + np.exp(-np.clip(top @ self.v + self.d, -30, 30)))
        return dict(width=width, before=before, at=at, mean=mean, csize=csize, more=more, h=h, top=top, n=np.diff(before), p=p)

    def scores(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(off) - 1, self.constant)
        return self.forward(*padded(buf, off))["p"].astype(np.float64)

    def gradients(self, x: np.ndarray, start: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        s = self.forward(x, start, size)
        dz = ((s["p"] - y) * weight).astype(np.float32)
        df = dz[:, None] * self.v
        text = np.repeat(np.arange(len(y)), s["n"])
        best = s["h"] == s["top"][text]
        ties = np.add.reduceat(best.astype(np.float32), s["before"][:-1], axis=0)
        dh = best * (df / ties)[text]
        dh *= s["h"] > 0
        dmean = (dh @ self.u.T) / s["csize"][:, None]
        k = np.flatnonzero(s["more"])
        dcell = dmean.copy()
        dcell[k + 1] += dmean[k]
        gw, gb = np.zeros_like(self.w), np.zeros_like(self.b)
        at, width = s["at"], s["width"]
        lo = 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SPAN)))
            pos = np.repeat(at[lo:hi] - (np.cumsum(width[lo:hi]) - width[lo:hi]), width[lo:hi]) + np.arange(width[lo:hi].sum())
            i, j = int(at[lo]), int(at[hi - 1] + width[hi - 1])
            live = self._respond(x, i, j)[pos - i] > 0
            g = np.repeat(dcell[lo:hi], width[lo:hi], axis=0) * live
            gb += g.sum(0)
            for m in range(WIDTH):
                for f in range(FILTERS):
                    gw[m, :, f] += np.bincount(x[pos + m], g[:, f], 256).astype(np.float32)
            lo = hi
        return [gw, gb, s["mean"].T @ dh, dh.sum(0), s["top"].T @ dz, dz.sum(keepdims=True)]

    def fit(self, texts: list[bytes], labels: np.ndarray, rate: float = 0.01, batch: int = 32, seed: int = 3, least_steps: int = 225) -> "ByteCNN":
        y = np.asarray(labels, np.float32)
        if len(y) == 0 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        epochs = max(3, -(-least_steps * batch // len(y)))
        r = np.random.default_rng(seed)
        params = [self.w, self.b, self.u, self.c, self.v, self.d]
        m, q = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        each = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        step, steps = 0, epochs * -(-len(y) // batch)
        for _ in range(epochs):
            order = r.permutation(len(y))
            for i in range(0, len(y), batch):
                at = order[i : i + batch]
                part = [texts[k] for k in at]
                off = np.concatenate(([0], np.cumsum([len(t) for t in part]))).astype(np.int64)
                buf = np.frombuffer(b"".join(part), np.uint8)
                step += 1
                lr = rate * (1 - (step - 1) / steps)
                for p, g, a, b in zip(params, self.gradients(*padded(buf, off), y[at], each[at] / len(at)), m, q):
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    p -= lr * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        return self


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 2400, max_bytes: int = 10_000_000) -> ByteCNN:
    """Fit on labelled rows: docs (doc_id, text), labels (doc_id, quality in 0/1).

    Labels are sampled first, by a hash threshold that gives at most about 1.5
    max_docs of them; only these few rows are sent to the documents' scan.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    n = known.count()
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    share = min(1.0, 1.5 * max_docs / max(1, n))
    rows = known.where(spot < int(share * (1 << 40))).limit(3 * max_docs).collect()
    label = {r.doc_id: r.quality for r in sorted(rows, key=lambda r: r.quality)}
    spark = docs.sparkSession
    texts_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = small_table(spark, [(k,) for k in label], {"doc_id": pa.int64()})
    sizes = texts_of.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.sum(F.octet_length("text")).cast("long").alias("n"), F.count(F.lit(1)).alias("rows")).withColumn("k", spot)
    chosen, held, rows_held = [], 0, 0
    for r in sorted(sizes.collect(), key=lambda r: (r.k, r.doc_id)):
        if held + r.n <= max_bytes and rows_held + r.rows <= max_docs:
            chosen.append((r.doc_id,))
            held, rows_held = held + r.n, rows_held + r.rows
    found = texts_of.join(F.broadcast(small_table(spark, chosen, {"doc_id": pa.int64()})), "doc_id").withColumn("k", spot).collect()
    texts, ys = [], []
    for r in sorted(found, key=lambda r: (r.k, r.doc_id, r.text)):
        texts.append(r.text.encode()), ys.append(label[r.doc_id])
    return ByteCNN().fit(texts, np.array(ys))


def keep(docs: DataFrame, model: ByteCNN, least: float) -> DataFrame:
    """The rows of docs whose text scores at least ``least``, all columns; nothing is shuffled."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            p = [model.scores(buf, off) for _, _, buf, off in chunks(b.column(at))]
            yield b.filter(pa.array(np.concatenate(p) >= least)) if p else b

    return docs.mapInArrow(run, docs.schema)


def _score(model: ByteCNN):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            for i, j, buf, off in chunks(b.column(1)):
                p = model.scores(buf, off)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(p)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: ByteCNN) -> DataFrame:
    """docs (doc_id, text, ...) -> (doc_id, score), one row per row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(model), "doc_id long, score double")
