"""Listed values searched in texts: by an automaton over blocks of values, or for very many values by joins on rare pieces of them.

find_values: an automaton over all values of a block reads each text once. Values come to the driver a block at a time (BLOCK of them, a
documented bound), never all; every value is searched, in as many passes as there are blocks.

find_many_values: each value is stood for by the rarest 8 bytes in it. Texts are read once for every SIGNS such pieces (four million) and tell
which they hold; the pieces join texts and values, and what meets is looked up in the text. Values never come to the driver, only
their pieces do, as sorted numbers. Values of fewer than 8 bytes are find_values'.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.functions.redact import LEAST_SECRET, slug_form
from vellumry.session import set_checkpoint_dir

#: Values of one pass.
BLOCK = 50_000
#: How a value is met: anywhere, in any case; that or as its slug; as a word, in its own case.
ANYWHERE, SLUG, WORD = "anywhere", "slug", "word"


def _search(rows: list[tuple[str, str, str]]):
    """rows (id, kind, value) -> a function of batches (key, text) to (key, id) of the values that a text holds."""
    exact, folded = ahocorasick.Automaton(), ahocorasick.Automaton()
    by: dict[tuple[bool, str], list[str]] = {}
    for k, kind, value in rows:
        by.setdefault((kind == WORD, value), []).append(k)
    for (word, value), ids in by.items():
        (exact if word else folded).add_word(value, (len(value), ids))
    for a in (exact, folded):
        if len(a):
            a.make_automaton()

    def alnum(c: str) -> bool:
        return c.isascii() and c.isalnum()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, found = [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                if not text:
                    continue
                own: set[str] = set()
                if len(folded):
                    for _, (_, ids) in folded.iter(text.lower()):
                        own.update(ids)
                if len(exact):
                    for end, (n, ids) in exact.iter(text):
                        before = text[end - n] if end >= n else ""
                        if not alnum(before) and not alnum(text[end + 1 : end + 2]):
                            own.update(ids)
                at += [k] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.string())], names=["key", "id"])

    return run


def _forms(values: DataFrame) -> DataFrame:
    """(id, kind, value) of what is looked for: values, in lower case but for words, and slugs; once each."""
    v = values.where("id IS NOT NULL AND value IS NOT NULL AND value <> ''").select("id", "kind", "value")
    low = F.when(F.col("kind") == WORD, F.col("value")).otherwise(F.lower("value"))
    slug = F.when((F.col("kind") == SLUG) & (F.length(slug_form(F.col("value"))) >= LEAST_SECRET), slug_form(F.col("value")))
    return v.select("id", "kind", F.explode(F.array_compact(F.array(low, slug))).alias("value")).distinct()


#: Bytes of a piece, pieces that a pass over the texts looks for, and texts that tell how rare pieces are (of smallest hashes).
PIECE, SIGNS, SAMPLE = 8, 4_000_000, 2_000


def _pieces(raw: bytes) -> np.ndarray:
    """The 8 bytes from each place as numbers."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(b) - PIECE + 1), np.uint64)
    for k in range(PIECE if len(out) else 0):
        out |= b[k : k + len(out)] << np.uint64(8 * k)
    return out


def _held_by(signs: np.ndarray):
    """Rows (key, lower text) -> (key, piece) of the sorted signs that a text holds, once each."""
    few = np.zeros(1 << 24, bool)  # most places of a text are none of them, seen by 24 bits of a product
    spot = lambda x: (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    few[spot(signs)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, found = [], []
            for k, text in enumerate(b.column(1)):
                here = _pieces((text.as_py() or "").encode())
                here = np.unique(here[few[spot(here)]])
                at = np.minimum(np.searchsorted(signs, here), len(signs) - 1)
                here = here[signs[at] == here] if len(signs) else here[:0]
                keys += [k] * len(here)
                found.append(here)
            pieces = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keys, pa.int64())), pa.array(pieces)], names=["key", "piece"])

    return run


def _sign_of(common: dict[int, int]):
    """Rows (id, kind, value, own) with the piece of value that the fewest of the sampled texts hold; of equal ones the one of smallest product."""
    names = np.array(sorted(common), np.uint64)
    times = np.array([common[x] for x in names.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for value in b.column(2):
                p = _pieces(value.as_py().encode())
                n = np.zeros(len(p), np.int64)
                if len(names):
                    at = np.minimum(np.searchsorted(names, p), len(names) - 1)
                    n = np.where(names[at] == p, times[at], 0)
                out.append(p[np.lexsort((p * np.uint64(0x9E3779B97F4A7C15), n))[0]])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.array(out, np.uint64).view(np.int64))], names=["id", "kind", "value", "own", "piece"])

    return run


def find_many_values(texts: DataFrame, key: str, text: str, values: DataFrame) -> DataFrame:
    """As find_values, for any number of values: (key, id), once each; texts without a key are left out.

    Which piece stands for a value is chosen by a sample of the texts, so that pieces which many texts hold are avoided; the result doesn't depend on it.
    """
    spark = texts.sparkSession
    v = _forms(values).withColumn("low", F.lower("value"))
    long = F.octet_length("low") >= PIECE
    t = texts.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).where("key IS NOT NULL")
    n = t.count()
    near = t.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(min(1.0, 2 * SAMPLE / max(1, n)) * (1 << 30))).select(F.lower("text").alias("t")).limit(SAMPLE)
    common: dict[int, int] = {}
    for r in near.toLocalIterator():
        for p in np.unique(_pieces((r.t or "")[:100_000].encode())).tolist():
            common[p] = common.get(p, 0) + 1
    common = {p: k for p, k in common.items() if k > 1}
    signed = v.where(long).select("id", "kind", F.col("low").alias("value"), F.col("value").alias("own")).mapInArrow(_sign_of(common), "id string, kind string, value string, own string, piece long")
    set_checkpoint_dir(spark)
    signed = signed.checkpoint()
    signs = signed.select("piece").distinct()
    passes = -(-signs.count() // SIGNS)
    folded = t.select("key", F.lower("text").alias("low"))
    held = []
    for k in range(passes):
        own = signs.where(F.pmod(F.xxhash64("piece"), F.lit(passes)) == k).toArrow().column("piece").to_numpy()
        held.append(folded.mapInArrow(_held_by(np.sort(own.view(np.uint64))), "key string, piece long"))
    short = find_values(texts.where(F.col(key).isNotNull()), key, text, v.where(~long).select("id", "kind", "value"))
    if not held:
        return short.distinct()
    near = reduce(DataFrame.unionByName, held).join(signed, "piece").select("key", "id", "kind", "value", "own").distinct()
    quoted = F.concat(F.lit("(?<![A-Za-z0-9])\\Q"), F.replace("own", F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E(?![A-Za-z0-9])"))
    there = F.when(F.col("kind") == WORD, F.regexp_count("text", quoted) > 0).otherwise(F.lower("text").contains(F.col("value")))
    met = near.join(t, "key").where(there).select("key", "id")
    return met.unionByName(short).distinct()


def find_values(texts: DataFrame, key: str, text: str, values: DataFrame) -> DataFrame:
    """texts (key, text), values (id string, kind, value) -> (key string, id): which texts hold which values, once each.

    kind: ANYWHERE, SLUG or WORD. Null and empty values are in no text; null texts hold none; repeated values are found under each id.
    """
    v = _forms(values)
    blocks = -(-v.count() // BLOCK)
    t = texts.select(F.col(key).cast("string").alias("key"), text)
    out = []
    for k in range(blocks):
        part = v.where(F.pmod(F.xxhash64("value"), F.lit(blocks)) == k)
        out.append(t.mapInArrow(_search([tuple(r) for r in part.collect()]), "key string, id string"))
    empty = t.select("key", F.lit("").alias("id")).limit(0)
    return reduce(DataFrame.unionByName, out, empty).distinct() if blocks > 1 else reduce(DataFrame.unionByName, out, empty)
