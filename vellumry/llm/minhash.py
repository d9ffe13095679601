"""MinHash near-duplicates by fast similarity sketching.

Sketch (Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching", 2017): in
rounds 0..t-1 every shingle is hashed to a bin and a value, in rounds t..2t-1
to the bin that the round names; a bin keeps the value of the first round that
reached it, the smallest there. So all t coordinates fill, and the estimate is
concentrated as that of t independent minima, for O(n + t log t) hashes.

Candidates come from bands of the sketch; links are confirmed on full sets.

1. One pass over the texts gives a fingerprint of the set, the band keys and one
   byte of each coordinate. Equal sets collapse to their smallest id.
2. Per band key, every member is compared with the smallest id (linear in the
   bucket). Sketches that agree far below the threshold are dropped first.
3. Confirmed links give components. Buckets that still hold two components are
   cut into blocks, and blocks are compared as matrices of sketches: a pair of
   different components leaves its block pair only if its sketches are near, and
   only in the first band that it shares. So no link is lost to the star, and a
   group of copies, which is one component by then, is never expanded.

Defined results: null, empty or word-less texts have no shingles and no links,
component_id = doc_id. Equal texts link. Rows of a repeated doc_id are the same
vertex. Rows without doc_id are linked with nothing: component_id null, kept true. Very
long texts are read whole. Other columns of docs are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumry.llm.bpe import release
from vellumry.llm.bytehash import U64, chunks, mix64
from vellumry.llm.components import connected_components
from vellumry.llm.shingles import shingle_sets
from vellumry.llm.storage import materialize, only

ROWS, BANDS = 6, 26
BINS = ROWS * BANDS
_SEEDS = mix64(np.arange(1, 2 * BINS + 1, dtype=U64) * U64(0x2545F4914F6CDD1D))
_UNSET = U64(0xFFFFFFFFFFFFFFFF)
_LOW = U64(0xFFFFFFFF)
#: Sketches whose agreement lies further below the threshold are not compared in full: 4 standard deviations at 0.85.
SKETCH_MARGIN = 0.13
#: Shingles of the members of a mixed bucket that are compared as one block (one longer text is a block of its own).
BLOCK_SHINGLES = 100_000

SIG_SCHEMA = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sketch binary"


def sketch(items: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The fast similarity sketch of a set of at least one 64-bit hash."""
    out = np.full(bins, _UNSET, U64)
    for r in range(2 * bins):
        h = mix64(items ^ _SEEDS[r])
        tag = U64(r << 32)
        if r < bins:
            at = ((h >> U64(32)) * U64(bins)) >> U64(32)
            np.minimum.at(out, at.astype(np.int64), (h & _LOW) | tag)
        else:
            out[r - bins] = min(out[r - bins], (h & _LOW).min() | tag)
        if out.max() != _UNSET:
            break
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    v = mix64(values).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=U64)
    for k in range(ROWS):
        key = mix64(key * U64(0x9E3779B97F4A7C15) ^ v[:, k])
    return key.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        ids = batch.column(0)
        for i, j, buf, off in chunks(batch.column(1)):
            n, f1, f2, bands, sketches = [], [], [], [], []
            for s in shingle_sets(buf, off):
                n.append(len(s))
                if len(s) == 0:
                    f1.append(None), f2.append(None), bands.append(None), sketches.append(None)
                    continue
                f1.append(int(mix64(s).sum().view(np.int64)))
                f2.append(int(mix64(s ^ U64(0xD6E8FEB86659FD93)).sum().view(np.int64)))
                values = sketch(s)
                bands.append(band_keys(values))
                sketches.append(mix64(values).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(i, j - i),
                    pa.array(n, pa.int64()),
                    pa.array(f1, pa.int64()),
                    pa.array(f2, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "f1", "f2", "bands", "sketch"],
            )


def _agree(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, BINS) for k in (2, 3))
            keep = (x == y).mean(axis=1) >= threshold - SKETCH_MARGIN
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def _short_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sorted low 32 bits of each text's shingle hashes."""
    for b in batches:
        for i, j, buf, off in chunks(b.column(1)):
            sets = [np.sort(s.astype(np.uint32)).tobytes() for s in shingle_sets(buf, off)]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(sets, pa.binary())], names=["doc_id", "short"])


def _cross(threshold: float):
    """Pairs of two blocks of one bucket: of different components, sketches near, no earlier band in common, short sets near."""

    def near(x: np.ndarray, y: np.ndarray) -> bool:
        z = np.concatenate((x, y))
        z.sort()
        both = np.count_nonzero(z[1:] == z[:-1]) + 1
        return both >= threshold * (len(z) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                x, y = row["x"], row["y"]
                ids = [np.array([r["doc_id"] for r in z]) for z in (x, y)]
                comp = [np.array([r["c"] for r in z]) for z in (x, y)]
                bands = [np.array([r["bands"] for r in z]) for z in (x, y)]
                sk = [np.frombuffer(b"".join(r["sketch"] for r in z), np.uint8).reshape(-1, BINS) for z in (x, y)]
                short = [[np.frombuffer(r["short"], np.uint32) for r in z] for z in (x, y)]
                out_a, out_b = [], []
                for k in range(len(x)):
                    ok = (sk[0][k] == sk[1]).mean(axis=1) >= threshold - SKETCH_MARGIN
                    ok &= comp[0][k] != comp[1]
                    if row["i"] == row["j"]:
                        ok[: k + 1] = False
                    at = np.flatnonzero(ok)
                    if len(at):
                        at = at[(bands[0][k] == bands[1][at]).argmax(axis=1) == row["band"]]
                        at = np.array([m for m in at.tolist() if near(short[0][k], short[1][m])], np.int64)
                        out_a.append(np.minimum(ids[0][k], ids[1][at]))
                        out_b.append(np.maximum(ids[0][k], ids[1][at]))
                if out_a:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"]
                    )

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last = None, None
        for b in batches:
            left = b.column(0).to_pylist()
            lt = b.column(2)
            keep = np.zeros(b.num_rows, bool)
            for i, j, buf, off in chunks(b.column(3)):
                for k, y in zip(range(i, j), shingle_sets(buf, off)):
                    if left[k] != last_id:
                        t = (lt[k].as_py() or "").encode()
                        last_id, last = left[k], shingle_sets(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
                    both = len(np.intersect1d(last, y, assume_unique=True))
                    keep[k] = 100 * both >= percent * (len(last) + len(y) - both) and both > 0
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 85) -> DataFrame:
    """docs (doc_id long, text string, ...) -> (doc_id, n_shingles, component_id, kept), one row per row of docs.

    Two documents link if 100 * |A and B| >= percent * |A or B| on their sets of
    five-word shingles; component_id is the smallest doc_id reachable.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = materialize(spark, docs.mapInArrow(_signatures, SIG_SCHEMA), "minhash-signatures")
    sets = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = sets.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = materialize(spark, classes, "minhash-classes")
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    unique = sets.join(reps, "doc_id", "left_semi")
    sketches = unique.select("doc_id", "sketch")

    banded = unique.select(F.posexplode("bands").alias("band", "key"), "doc_id")
    leads = banded.groupBy("key").agg(F.min("doc_id").alias("lead"), F.max("doc_id").alias("most")).where("lead < most")
    members = materialize(spark, banded.join(leads.select("key", "lead"), "key"), "minhash-buckets")

    def nearby(pairs: DataFrame) -> DataFrame:
        x = pairs.join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("x")), "a")
        x = x.join(sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("y")), "b")
        return x.select("a", "b", "x", "y").mapInArrow(_agree(percent / 100), "a long, b long")

    def confirmed(near: DataFrame, name: str) -> DataFrame:
        near = materialize(spark, near, name)
        ids = near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))).distinct()
        texts = only(docs, materialize(spark, ids, name + "-ids"))
        t = near.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        t = t.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        links = t.select("a", "b", "ta", "tb").mapInArrow(_confirm(percent), "a long, b long")
        return materialize(spark, links, name + "-links")

    star = members.where("doc_id > lead").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = confirmed(nearby(star), "minhash-star")
    label = connected_components(spark, links)

    named = members.join(label, members.doc_id == label.id, "left").select(
        "key", "band", "doc_id", F.coalesce("component_id", "doc_id").alias("c")
    )
    mixed = named.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    rest = materialize(spark, named.join(mixed, "key", "left_semi"), "minhash-mixed")
    ids = materialize(spark, rest.select("doc_id").distinct(), "minhash-mixed-ids")
    short = only(docs, ids).mapInArrow(_short_sets, "doc_id long, short binary")
    rest = rest.join(unique.select("doc_id", "n_shingles", "bands", "sketch"), "doc_id").join(short, "doc_id")
    in_key = Window.partitionBy("key").orderBy("c", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.withColumn("i", F.floor(F.coalesce(F.sum("n_shingles").over(in_key), F.lit(0)) / BLOCK_SHINGLES).cast("long"))
    blocks = rest.groupBy("key", "band", "i").agg(F.collect_list(F.struct("doc_id", "c", "bands", "sketch", "short")).alias("x"))
    blocks = materialize(spark, blocks, "minhash-blocks")
    other = blocks.select("key", F.col("i").alias("j"), F.col("x").alias("y"))
    cross = blocks.join(other, "key").where("i <= j").select("band", "i", "j", "x", "y").mapInArrow(_cross(percent / 100), "a long, b long")
    more = confirmed(cross, "minhash-cross")
    if not more.isEmpty():
        label = connected_components(spark, links.unionByName(more))

    named = classes.join(label, classes.rep == label.id, "left").select(
        "f1", "f2", "n_shingles", F.coalesce("component_id", "rep").alias("component_id")
    )
    out = sig.select("doc_id", "n_shingles", "f1", "f2").join(named, ["f1", "f2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
