"""Packing of tokenised documents into sequences of bounded length.

1. Each document is encoded once; its ids and a last end id are cut at every
   ``capacity`` ids. A piece carries its place and its rank among the pieces of
   equal length of its own partition, both written with it.
2. Only the histogram of piece lengths (at most ``capacity`` rows) comes to the
   driver. Shortest-pack-first over it gives patterns with counts.
3. A pattern's slots of one length are an interval of ranks. Ranks over the whole
   corpus are the partition's offset in its length (a running sum over partition
   and length) plus the rank in the partition, so no sort or window runs over the
   pieces, and no length is a hot key.

Counts by partition and length are broadcast only where at most MOST_COUNTS were counted, else shuffled.

Defined results: a null or empty text is the end id alone. Rows of a repeated
doc_id, and rows without one, are documents of their own. Other columns are ignored. No rows: no rows. Which of the pieces of one
length share a sequence depends on the partitioning of the input; the number of
sequences and the padding do not.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumry.llm.bpe import CACHE_RUNS, CACHE_WORDS, encoder, tokenizer_path
from vellumry.llm.histpack import shortest_pack_first
from vellumry.llm.storage import materialize

#: Rows of counts that are sent to all tasks at most: about 60 MB.
MOST_COUNTS = 1_000_000

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, local_rank long"
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pieces(capacity: int, end_id: int, path: str | None, tables: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path or tokenizer_path(), tables)
        end = np.array([end_id], "<u4").tobytes()
        part, seen, step = TaskContext.get().partitionId(), defaultdict(int), 4 * capacity
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = e.encode(text.as_py()) + end
                for i in range(0, len(ids), step):
                    piece = ids[i : i + step]
                    n = len(piece) // 4
                    rows.append((doc, i // 4, n, zlib.crc32(piece), len(ids) // 4, part, seen[n]))
                    seen[n] += 1
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "local_rank"]
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows) if rows else [()] * 7, kinds)], names=names)

    return run


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length << 44 | first rank, first sequence, offset) of each slot of each pattern, sorted."""
    out, base, rank = [], 0, defaultdict(int)
    for lengths, n in patterns:
        at = 0
        for length in lengths:
            out.append((length << 44 | rank[length], base, at))
            rank[length] += n
            at += length
        base += n
    out.sort()
    key, first, offset = (np.array(x, np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
    return key, first, offset


def _assign(key: np.ndarray, first: np.ndarray, offset: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in (2, 5))
            own = (length << 44) | rank
            at = np.searchsorted(key, own, "right") - 1
            cols = [*(b.column(k) for k in range(5)), pa.array(first[at] + own - key[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(spark: SparkSession, docs: DataFrame, capacity: int = 2048, end_id: int = 1, path: str | None = None, tables: tuple[int, int] = (CACHE_RUNS, CACHE_WORDS)) -> DataFrame:
    """docs (doc_id, text, ...) -> one row for each piece: where it lies in its document and in its sequence.

    tables: runs and words that a worker keeps encoded; larger is faster and takes
    about 150 bytes each.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = materialize(spark, texts.mapInArrow(_pieces(capacity, end_id, path, tables), _PIECE), "pack-pieces")
    each = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    each = materialize(spark, each, "pack-counts")
    histogram = {r.length: r.n for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(shortest_pack_first(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    each = F.broadcast(each) if each.count() <= MOST_COUNTS else each.hint("merge")
    ranked = pieces.join(each, ["part", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("local_rank")).alias("rank")
    )
    return ranked.mapInArrow(_assign(*table), _PACKED)
