"""Removal of repeated substrings by prefix doubling over starts that anchors leave open.

Every start p of a ``length``-byte string is a suffix whose first ``length`` bytes are to be
compared. Doubling over all starts of a corpus would sort a rank for every byte in each round, so
two sorts of larger units come first and leave few starts open:

1. Starts are joined to runs: of the ``length - GRAM + 1`` grams of GRAM bytes in a string, the smallest
   hash is its anchor. Equal strings have equal anchors at equal offsets, so a string whose
   anchor gram is unique is unique. Neighbouring starts with one anchor form a run of about 35 starts,
   sorted as one row by (name of anchor, name of the run's whole stretch): starts of a
   stretch that came earlier are all repeats; of equal stretches only the first
   goes on, and only if its anchor occurs in another stretch too.
2. Open runs are cut into slices of SLICE starts at fixed distances from the anchor; what all strings of a slice
   share is named, then the slice's whole stretch, as before.

Prefix doubling decides the starts that are still open (``_doubled``): each has a first rank, the hash of its GRAM bytes.
Spark sorts the pairs (rank at p, rank at p + size) and numbers them anew, which gives ranks of twice the size;
starts whose rank is unique by then are out. Sizes double while they fit, and the last pair is at the offset that makes
``length``: the equal pairs of that sort, in order of document and place, are repeats of the first of them.

Names of runs and first ranks are hashes (64 bits a name, pairs of them for a stretch); all further ranks are
places in sorted order. Repeats within an Arrow batch are found before the first sort (a combiner), so
a passage that a third of all documents hold sends one row a batch. Neighbours in
sorted order (lag) decide; all rows of one name are sorted in one task, which spills.

Defined results: null and empty texts have 0 bytes and no spans; texts shorter
than ``length`` lose nothing; earlier means smaller doc_id, then smaller start.
Rows of a repeated doc_id count as one document; rows without doc_id are left as they are, and
nothing is a repeat of them. Other columns pass through unchanged, whatever their names (but for ``text`` and columns
named as the new ones, which these replace). No rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumry.llm.bpe import release
from vellumry.llm.bytehash import BYTE_VALUE, U64, RangeHash, chunks, mix64
from vellumry.llm.storage import materialize, only

GRAM = 32
_GRAM_STEPS = [mix64(np.array([k + 77], U64))[0] | U64(1) for k in range(5)]
#: Runs gathered before repeats within them are looked for.
COMBINE = 1 << 17

#: Starts of a slice of a run.
SLICE = 8

#: name: what all strings of the run share; body: its whole stretch; place: first start, starts - 1, anchor - first start, seen.
RUN_SCHEMA = "name long, body long, doc_id long, place long"


def _place(lo: np.ndarray, hi: np.ndarray, at: np.ndarray, seen: np.ndarray | int) -> np.ndarray:
    return (((lo << 10) | (hi - lo)) << 10 | at) << 1 | seen



def _gram_hashes(v: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place, by doubling; the last GRAM - 1 places hold nothing of use."""
    h, k = v.copy(), 1
    for step in _GRAM_STEPS:
        n = len(h) - k
        if n > 0:
            h[:n] = h[:n] * step + h[k:]
        k *= 2
    return h


def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    m, k = key, 1
    while 2 * k <= width:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    rest = width - k
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def text_runs(buf: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(gram, body, row, lo, hi, anchor - lo): runs of starts that share an anchor; lo and hi are within the row's text."""
    none = (np.zeros(0, U64), np.zeros(0, U64), *(np.zeros(0, np.int64),) * 4)
    if len(buf) < length:
        return none
    v = BYTE_VALUE[buf]
    grams = mix64(_gram_hashes(v))
    key = (grams & U64(0xFFFFFFFF00000000)) | np.arange(len(buf), dtype=U64)
    anchor = (_sliding_min(key, length - GRAM + 1) & U64(0xFFFFFFFF)).astype(np.int64)[: len(buf) - length + 1]
    # starts whose string lies within one text
    size = np.diff(off)
    ok = np.zeros(len(buf) + 1, np.int32)
    rows = np.flatnonzero(size >= length)
    ok[off[rows]] += 1
    ok[off[rows + 1] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(ok[: len(anchor)]))
    if len(starts) == 0:
        return none
    a = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    lo = starts[begin]
    hi = starts[np.append(begin[1:], len(starts)) - 1]
    a = a[begin]
    body = RangeHash(v).of(lo, hi + length) ^ mix64((a - lo).astype(U64))
    row = np.searchsorted(off, lo, "right") - 1
    return grams[a], body, row, lo - off[row], hi - off[row], a - lo


def _run_batch(name: np.ndarray, body: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    cols = [name.view(np.int64), body.view(np.int64), doc, place]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["name", "body", "doc_id", "place"])


def _combined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The runs of parts; of equal ones only the first keeps its name. The others are known as repeats and go anywhere."""
    name, body, doc, lo, hi, at = (np.concatenate(x) for x in zip(*parts))
    step = np.diff(doc)
    ordered = not ((step < 0) | ((step == 0) & (np.diff(lo) < 0))).any()
    order = np.arange(len(doc)) if ordered else np.lexsort((lo, doc))
    order = order[np.argsort((name ^ (body * U64(0x9E3779B97F4A7C15)))[order], kind="stable")]
    name, body, doc, lo, hi, at = (x[order] for x in (name, body, doc, lo, hi, at))
    seen = np.zeros(len(doc), bool)
    seen[1:] = (name[1:] == name[:-1]) & (body[1:] == body[:-1]) & ((doc[1:] != doc[:-1]) | (lo[1:] != lo[:-1]))
    place = _place(lo, hi, at, seen)
    name = np.where(seen, mix64(doc.view(U64) ^ mix64(place.view(U64))), name)
    return _run_batch(name, body, doc, place)


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, buf, off in chunks(batch.column(1)):
                name, body, row, lo, hi, at = text_runs(buf, off, length)
                if len(row):
                    parts.append((name, body, ids[i:j][row].astype(np.int64), lo, hi, at))
                    held += len(row)
                if held >= COMBINE:
                    yield _combined(parts)
                    parts, held = [], 0
        if parts:
            yield _combined(parts)

    return run


def _open_starts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids of rows, row, lo, hi, anchor, bytes, offsets) of the open places of a batch (doc_id, text, places), a chunk at a time."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for i, j, buf, off in chunks(batch.column(1)):
        spans = batch.column(2).slice(i, j - i)
        place = np.asarray(spans.flatten())
        row = np.repeat(np.arange(j - i), np.asarray(spans.value_lengths()))
        lo = (place >> 21) + off[row]
        yield ids[i:j].astype(np.int64), row, lo, lo + ((place >> 11) & 1023), lo + ((place >> 1) & 1023), buf, off


def _slices(length: int):
    """Open runs cut into slices of up to SLICE starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            for ids, row, lo, hi, a, buf, off in _open_starts(batch):
                # slice k has the starts p with k * SLICE <= a - p < (k + 1) * SLICE
                first, last = (a - hi) // SLICE, (a - lo) // SLICE
                n = last - first + 1
                of = np.repeat(np.arange(len(n)), n)
                k = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                a, row = a[of], row[of]
                lo, hi = np.maximum(lo[of], a - (k + 1) * SLICE + 1), np.minimum(hi[of], a - k * SLICE)
                h = RangeHash(BYTE_VALUE[buf])
                core = a - k * SLICE
                name = h.of(core, core - SLICE + 1 + length) ^ mix64(k.astype(U64))
                body = h.of(lo, hi + length) ^ mix64((a - lo).astype(U64))
                parts.append((name, body, ids[row], lo - off[row], hi - off[row], a - lo))
                held += len(row)
                if held >= COMBINE:
                    yield _combined(parts)
                    parts, held = [], 0
        if parts:
            yield _combined(parts)

    return run


def doubling(length: int) -> list[tuple[int, list[int]]]:
    """(size, offsets of the starts whose ranks of that size are needed), from GRAM up to length.

    A rank of 2 * size at o is the pair of ranks of size at o and o + size; the last pair's offset is what is left to length.
    """
    sizes = [GRAM]
    while 2 * sizes[-1] <= length:
        sizes.append(2 * sizes[-1])
    need = [0] if sizes[-1] == length else [0, length - sizes[-1]]
    out = [(sizes[-1], need)]
    for size in reversed(sizes[:-1]):
        need = sorted({x for o in need for x in (o, o + size)})
        out.append((size, need))
    return out[::-1]


_STARTS = "doc_id long, start long, seen boolean, ranks array<long>"


def _first_ranks(length: int):
    """Each open start with its first ranks at the offsets that doubling needs; a start whose string is in the same batch before is seen."""
    offsets = np.array(doubling(length)[0][1])

    def combined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, start, ranks = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((start, doc))
        doc, start, ranks = doc[order], start[order], ranks[order]
        once = np.ones(len(doc), bool)  # rows of a repeated doc_id give their starts again
        once[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])
        doc, start, ranks = doc[once], start[once], ranks[once]
        _, first, of = np.unique(ranks, axis=0, return_index=True, return_inverse=True)
        seen = first[of.ravel()] != np.arange(len(doc))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(doc) + 1) * ranks.shape[1], pa.int32()), pa.array(ranks.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(seen), lists], names=["doc_id", "start", "seen", "ranks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            for ids, row, lo, hi, _, buf, off in _open_starts(batch):
                n = hi - lo + 1
                p = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                row = np.repeat(row, n)
                if len(p):
                    at = p[:, None] + offsets
                    h = RangeHash(BYTE_VALUE[buf]).of(at.ravel(), at.ravel() + GRAM)
                    parts.append((ids[row], p - off[row], h.view(np.int64).reshape(at.shape)))
                    held += len(p)
                if held >= COMBINE:
                    yield combined(parts)
                    parts, held = [], 0
        if parts:
            yield combined(parts)

    return run


def _renumbered(spark: SparkSession, pairs: DataFrame, name: str) -> DataFrame:
    """pairs (doc_id, start, j, a, b) with rank, the place of the first equal pair in the order of (a, b), and how many are equal.

    The sort deals ranges of pairs to tasks, so equal pairs lie together and places rise over all tasks.
    """
    pairs = materialize(spark, pairs, name)
    placed = pairs.repartitionByRange("a", "b").sortWithinPartitions("a", "b").withColumn("at", F.monotonically_increasing_id())
    w = Window.partitionBy("a", "b")
    return placed.withColumn("rank", F.min("at").over(w)).withColumn("equal", F.count(F.lit(1)).over(w)).select("doc_id", "start", "j", "rank", "equal")


def _doubled(spark: SparkSession, starts: DataFrame, length: int) -> DataFrame:
    """starts (doc_id, start, ranks: of GRAM bytes, at doubling's offsets) -> (doc_id, start) of those whose string starts earlier too."""
    levels = doubling(length)
    for (size, have), (_, need) in zip(levels, levels[1:]):
        pair = [F.struct(F.lit(j).alias("j"), F.get("ranks", F.lit(have.index(o))).alias("a"), F.get("ranks", F.lit(have.index(o + size))).alias("b")) for j, o in enumerate(need)]
        pairs = starts.select("doc_id", "start", F.explode(F.array(*pair)).alias("x")).select("doc_id", "start", "x.*")
        ranked = _renumbered(spark, pairs, f"suffix-pairs-{2 * size}")
        # a start that is alone with one of its ranks is alone with its string
        back = ranked.groupBy("doc_id", "start").agg(F.min("equal").alias("equal"), F.array_sort(F.collect_set(F.struct("j", "rank"))).alias("r")).where("equal > 1")
        starts = back.select("doc_id", "start", F.transform("r", lambda x: x["rank"]).alias("ranks"))
    last = starts.select("doc_id", "start", F.get("ranks", F.lit(0)).alias("a"), F.get("ranks", F.lit(len(levels[-1][1]) - 1)).alias("b"))
    w = Window.partitionBy("a", "b").orderBy("doc_id", "start")
    return last.withColumn("again", F.lag("start").over(w).isNotNull()).where("again").select("doc_id", "start")


def _ranked(spark: SparkSession, runs: DataFrame, name: str) -> DataFrame:
    """(doc_id, place, again): repeats, and (again false) firsts whose name has another body; the rest is unique and gone."""
    w = Window.partitionBy("name").orderBy("body", "doc_id", "place")
    whole = Window.partitionBy("name")
    other = (F.col("doc_id") != F.lag("doc_id").over(w)) | (F.shiftright("place", 1) != F.shiftright(F.lag("place").over(w), 1))
    ranked = runs.withColumn("again", F.coalesce((F.col("body") == F.lag("body").over(w)) & other, F.lit(False)))
    ranked = ranked.withColumn("again", F.col("again") | (F.col("place").bitwiseAND(1) == 1))
    ranked = ranked.withColumn("alone", F.min("body").over(whole) == F.max("body").over(whole))
    return materialize(spark, ranked.where("again OR NOT alone").select("doc_id", "place", "again"), name)


def repeated_starts(spark: SparkSession, docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, lo, hi): ranges of starts whose length-byte string starts earlier too. Ranges may touch or overlap."""
    if not 2 * GRAM <= length < 1024:
        raise ValueError(f"length must be from {2 * GRAM} to 1023")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL AND doc_id IS NOT NULL")

    def open_(ranked: DataFrame) -> DataFrame:
        spans = ranked.where("NOT again").groupBy("doc_id").agg(F.collect_list("place").alias("places"))
        ids = materialize(spark, ranked.where("NOT again").select("doc_id").distinct(), "suffix-open")
        return only(docs, ids).join(spans, "doc_id").select("doc_id", "text", "places")

    runs = _ranked(spark, docs.mapInArrow(_runs(length), RUN_SCHEMA), "suffix-runs")
    slices = _ranked(spark, open_(runs).mapInArrow(_slices(length), RUN_SCHEMA), "suffix-slices")
    starts = materialize(spark, open_(slices).mapInArrow(_first_ranks(length), _STARTS), "suffix-starts")
    single = starts.where("seen").select("doc_id", "start").unionByName(_doubled(spark, starts.where("NOT seen"), length))
    again = runs.where("again").unionByName(slices.where("again"))
    lo = F.shiftright("place", 21)
    again = again.select("doc_id", lo.cast("int").alias("lo"), (lo + F.shiftright("place", 11).bitwiseAND(1023)).cast("int").alias("hi"))
    return again.unionByName(single.select("doc_id", F.col("start").cast("int").alias("lo"), F.col("start").cast("int").alias("hi")))


def _cut(length: int, mode: str, n: int):
    """n columns that pass through, then text and spans."""
    text_at, spans_at = n, n + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, spans = b.column(text_at).to_pylist(), b.column(spans_at)
            starts, n_bytes, n_removed, n_spans, kept = [], [], [], [], []
            for t, s in zip(texts, spans):
                raw = (t or "").encode()
                n_bytes.append(len(raw))
                lohi = s.values.flatten() if s.is_valid else None
                if lohi is None or not len(s.values):
                    n_removed.append(0), n_spans.append(0), kept.append(raw)
                    continue
                lo, hi = (np.asarray(x) for x in lohi)
                cover = np.zeros(len(raw) + 1, np.int32)
                np.add.at(cover, lo, 1)
                np.add.at(cover, hi + length, -1)
                gone = np.cumsum(cover[:-1]) > 0
                if mode == "text":  # a character stays if any byte of it stays
                    data = np.frombuffer(raw, np.uint8)
                    char = np.cumsum((data & 0xC0) != 0x80) - 1
                    stays = np.zeros(char[-1] + 1, bool)
                    stays[char[~gone]] = True
                    gone = ~stays[char]
                n_removed.append(int(gone.sum()))
                n_spans.append(int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])))
                kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
            cols = [b.column(k) for k in range(n)]
            more = [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
            last = pa.array([x.decode() for x in kept], pa.string()) if mode == "text" else pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
            yield pa.RecordBatch.from_arrays([*cols, *more, last], names=[str(k) for k in range(len(cols) + 4)])

    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 100, mode: str = "text") -> DataFrame:
    """docs without the bytes that a repeated length-byte string covers.

    mode "text": every column of docs, text being what stays (whole characters
    only), and n_bytes, n_removed, n_spans. mode "digest": kept_sha256, of the
    remaining bytes, in place of text.
    """
    new = ["n_bytes", "n_removed", "n_spans", "text" if mode == "text" else "kept_sha256"]
    kept = [(k, f) for k, f in enumerate(docs.schema.fields) if f.name != "text" and f.name not in new]
    # columns go by number until the end, so that no name of theirs can clash
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    at = lambda name: f"c{docs.columns.index(name)}"
    starts = repeated_starts(spark, plain.select(F.col(at("doc_id")).alias("doc_id"), F.col(at("text")).alias("text")), length)
    spans = starts.groupBy(F.col("doc_id").alias("key")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = plain.join(spans, F.col(at("doc_id")).cast("long") == F.col("key"), "left").select(*[f"c{k}" for k, _ in kept], at("text"), "spans")
    schema = T.StructType([*[f for _, f in kept], *[T.StructField(x, T.LongType()) for x in new[:3]], T.StructField(new[3], T.StringType())])
    return joined.mapInArrow(_cut(length, mode, len(kept)), schema)
