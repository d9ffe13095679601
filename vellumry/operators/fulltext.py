"""Full-text index: postings with positions in blocks of documents, ranked search that skips blocks, phrases.

The index is a folder of three Parquet tables:

* `blocks`: word, block (doc_id div WIDTH, rounded down), n (documents), peak (the largest weight in the block), and arrays of one
  entry a document, by id: doc_ids, counts, sizes (words of the document), and places (its positions, ascending).
  Sorted by word and block over the whole table, so a search reads the row groups of its words alone. Integers are
  delta-coded by Parquet itself.
* `words`: word, df (documents that hold it).
* `facts`: one row: documents, words of all documents.

Blocks are cut by id, so a word that every document holds has blocks on many partitions, and the blocks of different
words cover the same documents: the sum of their peaks bounds the score of every document in them.

Rows without id are left out. Null and empty texts are documents without words: they count for the mean size and are
never found. Rows of one id are one document: its positions are the union of theirs, its size the largest one's, so
repeated rows change nothing. Columns other than the two named aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumry.functions.text import tokens
from vellumry.sources.sinks import _fs

#: Ids that one block spans.
WIDTH = 1024
#: The usual parameters of BM25.
K1, B = 1.2, 0.75
#: Scores are sums of whole millionths, so that they don't depend on the order of summing.
UNIT = 1_000_000

#: Up to this many different words asked are pushed into the scan, so only their row groups are read.
PUSHED = 500
#: Up to this many rows of (query, word) are broadcast, so the index isn't shuffled; beyond, Spark chooses the join.
SMALL = 500_000

#: Documents whose words are sorted at once.
SLICE = 512
_POSTING = "doc long, size long, word string, places array<int>"
_NAMES = [c.split()[0] for c in _POSTING.split(", ")]

_DELTA = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#doc_ids.list.element": "false", "parquet.enable.dictionary#places.list.element.list.element": "false"}


def build(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> None:
    """Write the index of all documents. One shuffle, by ranges of (word, block); no word is gathered in one task."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc"), tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("w")).where("doc IS NOT NULL")
    # The texts are cut once; what follows reads (document, word) rows. A row without word stands for the document itself.
    d.mapInArrow(_postings, _POSTING).write.mode("overwrite").parquet(f"{path}/rows")
    rows = spark.read.schema(_POSTING).parquet(f"{path}/rows")
    sizes = rows.where("word IS NULL").groupBy("doc").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    sizes.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("size"), F.lit(0)).alias("words")).write.mode("overwrite").parquet(f"{path}/facts")
    mean = _mean(_facts(spark, path))

    places = rows.where("word IS NOT NULL").select("word", F.floor(F.col("doc") / F.lit(width)).alias("block"), "doc", "size", "places")
    # Partitions by (word, block) serve the groupings below and the sort.
    posting = places.repartitionByRange(F.col("word"), F.col("block"))
    if not sizes.where("n > 1").isEmpty():
        posting = posting.groupBy("word", "block", "doc").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"), F.max("size").alias("size"))
    entry = F.struct("doc", F.size("places").cast("long").alias("count"), "size", "places")
    weight = _weight(F.size("places"), F.col("size"), mean)
    block = posting.groupBy("word", "block").agg(F.sort_array(F.collect_list(entry)).alias("e"), F.max(weight).alias("peak"))
    out = block.select("word", "block", F.size("e").cast("long").alias("n"), "peak", *[F.col(f"e.{x}").alias(y) for x, y in (("doc", "doc_ids"), ("count", "counts"), ("size", "sizes"), ("places", "places"))])
    w = out.sortWithinPartitions("word", "block").write.mode("overwrite")
    for k, v in _DELTA.items():
        w = w.option(k, v)
    w.parquet(f"{path}/blocks")
    spark.read.parquet(f"{path}/blocks").groupBy("word").agg(F.sum("n").alias("df")).write.mode("overwrite").parquet(f"{path}/words")
    fs, at = _fs(spark, f"{path}/rows")
    fs.delete(at, True)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, w) -> a row for each document and word with its places, ascending, and one without word for each document."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            b = batch.slice(at, SLICE)
            docs, sizes = b.column("doc"), np.asarray(pc.list_value_length(b.column("w")), np.int64)
            words = b.column("w").flatten().dictionary_encode()
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            key = row * max(1, len(words.dictionary)) + np.asarray(words.indices, np.int64)
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array(place[order], pa.int32()))
            of, which = row[order[first]], words.indices.take(pa.array(order[first]))
            yield pa.RecordBatch.from_arrays([docs.take(pa.array(of)), pa.array(sizes[of]), words.dictionary.take(which), lists], names=_NAMES)
            yield pa.RecordBatch.from_arrays([docs, pa.array(sizes), pa.nulls(len(docs), pa.string()), pa.nulls(len(docs), lists.type)], names=_NAMES)


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """The k best documents of each query by BM25: query_id, rank (from 1), doc_id, score (millionths).

    A query is the set of its words; those that no document holds add nothing. Ties go to the smaller doc_id; documents with none of the words
    aren't found. Exact: a block is skipped only where the peaks of all its words add up to less than k other blocks
    are sure to hold, a document in each. Queries without id or words find nothing; rows of one id are one query.
    """
    facts = _facts(spark, path)
    asked, blocks = _narrowed(spark, path, _weighted(spark, path, queries, facts, id_col, text_col))
    left = blocks_to_open(asked, blocks, k)
    hits = asked.join(blocks.select("word", "block", "doc_ids", "counts", "sizes"), "word").join(left, ["query_id", "block"])
    each = hits.select("query_id", "idf", F.explode(F.arrays_zip("doc_ids", "counts", "sizes")).alias("e"))
    part = _millionths(F.col("idf") * _weight(F.col("e.counts"), F.col("e.sizes"), _mean(facts)))
    scores = each.groupBy("query_id", F.col("e.doc_ids").alias("doc_id")).agg(F.sum(part).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return scores.select("query_id", rank.alias("rank"), "doc_id", "score").where(F.col("rank") <= k)


def blocks_to_open(asked: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """query_id, block: what can hold one of the k best documents. Reads words, blocks and peaks alone.

    In each block the query's largest peak is a real document's part, so the kth largest over the blocks is a score that k documents reach.
    """
    heads = asked.join(blocks.select("word", "block", "peak"), "word").select("query_id", "block", _millionths(F.col("idf") * F.col("peak")).alias("top"))
    bound = heads.groupBy("query_id", "block").agg(F.max("top").alias("sure"), F.sum("top").alias("most"))
    w = Window.partitionBy("query_id").orderBy(F.desc("sure"), "block")
    kth = bound.select("query_id", "sure", F.row_number().over(w).alias("r")).where(F.col("r") <= k).groupBy("query_id").agg(F.count(F.lit(1)).alias("c"), F.min("sure").alias("s"))
    least = kth.select("query_id", F.when(F.col("c") >= k, F.col("s")).otherwise(F.lit(0)).alias("least"))
    return bound.join(least, "query_id").where("most >= least").select("query_id", "block")


def phrases(spark: SparkSession, path: str, queries: DataFrame, id_col: str = "query_id", text_col: str = "text") -> DataFrame:
    """Where the words of a query stand one after another: query_id, doc_id, n (places where the phrase starts).

    Only blocks, and in them documents, that hold all words of the phrase are opened. A query without words finds nothing; rows of one id
    must be one text, else the greatest is taken.
    """
    q = queries.select(F.col(id_col).alias("query_id"), F.col(text_col).alias("t")).where("query_id IS NOT NULL").groupBy("query_id").agg(F.max("t").alias("t"))
    at = q.select("query_id", F.posexplode(tokens(F.col("t"))).alias("i", "word"))
    need = at.groupBy("query_id").agg(F.count(F.lit(1)).alias("length"), F.countDistinct("word").alias("different"))
    words, blocks = _narrowed(spark, path, at.groupBy("query_id", "word").agg(F.collect_list("i").alias("at")))
    full = words.join(blocks.select("word", "block"), "word").groupBy("query_id", "block").agg(F.count(F.lit(1)).alias("c"))
    full = full.join(need, "query_id").where("c = different").select("query_id", "block", "length", "different")
    hits = words.join(blocks.select("word", "block", "doc_ids", "places"), "word").join(full, ["query_id", "block"])
    each = hits.select("query_id", "at", "length", "different", F.explode(F.arrays_zip("doc_ids", "places")).alias("e"))
    each = each.select("query_id", "at", "length", "different", F.col("e.doc_ids").alias("doc_id"), F.col("e.places").alias("places"))
    whole = each.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("c"), F.first("different").alias("d")).where("c = d").select("query_id", "doc_id")
    places = each.join(whole, ["query_id", "doc_id"]).select("query_id", "doc_id", "length", "at", F.explode("places").alias("p"))
    starts = places.select("query_id", "doc_id", "length", "p", F.explode("at").alias("i"))
    found = starts.groupBy("query_id", "doc_id", (F.col("p") - F.col("i")).alias("start")).agg(F.count(F.lit(1)).alias("c"), F.first("length").alias("length")).where("c = length")
    return found.groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def _facts(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/facts").first()


def _mean(facts) -> float:
    return facts.words / facts.docs if facts.docs and facts.words else 1.0


def _weight(count: Column, size: Column, mean: float) -> Column:
    """What a word adds to a document's score, but for the word's rarity."""
    return count * F.lit(K1 + 1) / (count + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * size / F.lit(mean)))


def _millionths(c: Column) -> Column:
    return F.floor(c * F.lit(UNIT) + F.lit(0.5)).cast("long")


def _narrowed(spark: SparkSession, path: str, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words asked, broadcast where they are counted to be few, and the blocks, read for these words alone where they are very few."""
    blocks = spark.read.parquet(f"{path}/blocks")
    n = asked.count()
    if n > SMALL:
        return asked, blocks
    words = sorted(r.word for r in asked.select("word").distinct().limit(PUSHED + 1).collect())
    if len(words) <= PUSHED:
        # Lists of at most ten values reach Parquet's statistics value by value, longer ones by their least and greatest alone.
        lists = [F.col("word").isin(words[i : i + 10]) for i in range(0, len(words), 10)]
        blocks = blocks.where(reduce(Column.__or__, lists, F.lit(False)))
    return F.broadcast(asked), blocks


def _weighted(spark: SparkSession, path: str, queries: DataFrame, facts, id_col: str, text_col: str) -> DataFrame:
    """The different words of each query with their rarity: query_id, word, idf."""
    q = queries.select(F.col(id_col).alias("query_id"), F.explode(tokens(F.col(text_col))).alias("word")).where("query_id IS NOT NULL").distinct()
    rarity = F.log(F.lit(1.0) + (F.lit(float(facts.docs)) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    return q.join(spark.read.parquet(f"{path}/words"), "word").select("query_id", "word", rarity.alias("idf"))
