"""The registered queries of the operators here, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.llm import bpe, bytecnn, capfilter, chat, hardneg, htmlcut, langid, minhash, packing, rpforest, runs, suffix, urlfilter


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_rpforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return rpforest.nearest(spark, vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op2_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists that each page's URL is on at its fetch time."""
    fetched = F.timestamp_seconds(F.lit(1704067200) + (F.col("page_id") * 7919 % 365) * 86400)
    captures = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", fetched.alias("fetched"))
    found = urlfilter.on_lists(captures, urlfilter.demo_entries(captures))
    return found.select(F.col("id").alias("page_id"), "url", F.date_format("fetched", "yyyy-MM-dd").alias("fetched"), "n_lists", "lists")


def op3_htmlcut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmlcut.main_text(_table(spark, sf_dir, "pages"))


def _fold(n: int, doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % n


def op4_bytecnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four fifths of the labels."""
    docs = _table(spark, sf_dir, "documents")
    model = bytecnn.train(docs, _table(spark, sf_dir, "labels").where(_fold(5) != 0))
    scores = bytecnn.score(docs, model)
    return scores.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 ids."""
    return packing.pack(spark, _table(spark, sf_dir, "documents"), capacity=2048, end_id=1)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents: 85 % of five-word shingles."""
    return minhash.near_duplicates(spark, _table(spark, sf_dir, "documents"), percent=85)


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings of documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(spark, docs, length=100, mode="digest")


def op9_capfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 and more between all vectors."""
    return capfilter.near_duplicates(spark, _table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = _table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.train(docs.where(_fold(3) != 1)))
    return found.select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    said = r"\### Assistant: </turn> ok"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text")
    )
    return chat.digests(chat.format_conversations(turns.unionByName(odd)))


def _with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): about every tenth text repeats its words from one place on with one period."""
    words = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"), F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"))
    words = words.withColumn("g", F.expr("h div 10")).withColumn("n", F.size("words")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    words = words.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = "slice(flatten(array_repeat(slice(words, int(a) + 1, int(p)), int((n - a) div p) + 1)), 1, int(n - a))"
    text = F.expr(f"if(h % 10 = 0 and n > 0, array_join(concat(slice(words, 1, int(a)), {again}), ' '), text)")
    return words.select("doc_id", text.alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and what is left without the repeats."""
    found = runs.periodic_runs(_with_periods(_table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = runs.greatest_exponent(F.col("runs"))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), "runs", "collapsed")
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every fiftieth vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    vectors = vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hardneg.mine(spark, hardneg.quantized(vectors), F.col("vec_id") % 50 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """corpus_pipeline.run: the five stages over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_rpforest, op2_urlfilter, op3_htmlcut, op4_bytecnn, op5_bpe, op6_packing,
        op7_minhash, op8_suffix, op9_capfilter, op10_langid, op11_chat, op12_runs, op13_hardneg, pipeline,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_urlfilter": urlfilter.ORACLE, "op13_hardneg": hardneg.ORACLE}
