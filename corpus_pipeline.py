"""A corpus pipeline of five stages over documents.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written and read back as the next one's docs. All but
the last return the columns of documents, extra ones too, whatever their names.

Every stage takes null ids, null and empty texts, repeated rows, very long texts and empty tables; what each does with them
is said below and follows its operator. Ties: of equal documents that of the smallest id stays. A stage sets the
size of the session's Arrow batches (storage.small_batches), as its executors hold the memory of all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.llm import bytecnn, langid, minhash, packing, suffix
from vellumry.llm.storage import materialize, small_batches

#: Documents that score lower are rejected.
QUALITY = 0.3
#: Runs and words that the last stage keeps encoded in each worker: few, as its workers also serve the other stages.
TABLES = (100_000, 100_000)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network, fitted on all labels, doesn't reject. Null and empty texts are scored as one zero byte; without labels none is rejected."""
    small_batches(spark)
    model = bytecnn.train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    return bytecnn.keep(docs, model, QUALITY)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows with enough confidence. Texts without a letter go; without any known language in the table, all do."""
    small_batches(spark)
    return langid.keep(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of smallest id, of each group of near duplicates (80 % of five-word shingles). Rows of one id stay together; rows without id or words stay."""
    small_batches(spark)
    gone = minhash.near_duplicates(spark, docs, percent=80).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what earlier texts or places hold too (100 bytes and more). Rows without id stay as they are; a text may become empty."""
    small_batches(spark)
    cut = suffix.remove_repeats(spark, docs, length=100, mode="text")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids; a null or empty text is its end id alone, repeated rows are documents of their own."""
    small_batches(spark)
    return packing.pack(spark, docs, capacity=2048, end_id=1, tables=TABLES)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("packing", pack),
]

#: The stages that train models or tokenise have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
