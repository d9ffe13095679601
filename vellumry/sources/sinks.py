"""Sinks: staged folder swap, text and JSON files with read-back, guards of folders, copies, reports."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.functions.urls import sitemap_loc


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _digest(df: DataFrame, column: str):
    """Rows, and an order-free digest of them: sums of two hashes of each line."""
    h = [F.sum(F.xxhash64(F.col(column), F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
    return tuple(df.agg(F.count(F.lit(1)), *h).first())


def write_text(spark: SparkSession, df: DataFrame, column: str, path: str) -> None:
    """Lines to a folder through a staged write that is read back before it takes its place; what is written is what the stage holds, the rows are made once."""
    stage, kept = path.rstrip("/") + ".part", path.rstrip("/") + ".rows"
    df.select(F.col(column).alias("value")).write.mode("overwrite").parquet(kept)
    rows = spark.read.parquet(kept)
    rows.write.mode("overwrite").text(stage)
    if _digest(spark.read.text(stage), "value") != _digest(rows, "value"):
        raise OSError(f"{stage}: other lines than written (is there a line end in a line?)")
    swap_in(spark, stage, path)
    fs, p = _fs(spark, kept)
    fs.delete(p, True)


def write_json(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Rows as JSON lines, staged and moved into place, so that a reader sees the old folder or the new one."""
    stage = path.rstrip("/") + ".part"
    df.write.mode("overwrite").json(stage)
    swap_in(spark, stage, path)


def swap_in(spark: SparkSession, stage: str, path: str) -> None:
    """Put a finished stage folder in place; the old one steps aside first and comes back if that fails."""
    fs, new = _fs(spark, stage)
    _, out = _fs(spark, path)
    _, old = _fs(spark, path.rstrip("/") + ".old")
    fs.delete(old, True)
    had = fs.exists(out)
    if had and not fs.rename(out, old):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(new, out):
        if had:
            fs.rename(old, out)
        raise OSError(f"can't put {stage} in place")
    fs.delete(old, True)


def recover(spark: SparkSession, path: str) -> str:
    """After an interrupted swap: "restored" (the old folder is back), "cleaned" (left-overs are gone) or "nothing"."""
    fs, out = _fs(spark, path)
    _, old = _fs(spark, path.rstrip("/") + ".old")
    _, part = _fs(spark, path.rstrip("/") + ".part")
    had_part = fs.delete(part, True)
    if fs.exists(old):
        if fs.exists(out):
            fs.delete(old, True)
            return "cleaned"
        fs.rename(old, out)
        return "restored"
    return "cleaned" if had_part else "nothing"


def owner_of(spark: SparkSession, path: str, mark: str) -> str:
    """absent, empty, ours (it holds the file that marks our output) or foreign: only the first three may be replaced."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return "absent"
    if not fs.getFileStatus(p).isDirectory():
        return "foreign"
    if not fs.listStatus(p):
        return "empty"
    return "ours" if fs.exists(_fs(spark, f"{path.rstrip('/')}/{mark}")[1]) else "foreign"


def check_apart(*paths: str) -> None:
    """A ValueError if one of the local paths, links resolved, is or lies in another."""
    real = [os.path.realpath(p) for p in paths]
    for i, a in enumerate(real):
        for b in real[i + 1 :]:
            if os.path.commonpath((a, b)) in (a, b):
                raise ValueError(f"{a} and {b} are not apart")


def with_time_kept(before: DataFrame | None, files: DataFrame, now: str) -> DataFrame:
    """A manifest (file, bytes, sha256, at): the time of the one before if no file changed, else now."""
    if before is not None:
        key = ["file", "bytes", "sha256"]
        same = files.select(key).exceptAll(before.select(key)).isEmpty() and before.select(key).exceptAll(files.select(key)).isEmpty()
        if same:
            now = before.agg(F.max("at")).first()[0] or now
    return files.withColumn("at", F.lit(now))


def _sha_of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    h, first = hashlib.sha256(), True
    for b in batches:
        for line in b.column(0):
            h.update((b"" if first else b"\n") + line.as_py().encode())
            first = False
    yield pa.RecordBatch.from_arrays([pa.array([h.hexdigest()])], names=["fingerprint"])


def fingerprint(files: DataFrame, path: Column, digest: Column) -> DataFrame:
    """sha256 over the sorted lines 'digest  path'. One task reads them in order, a batch at a time (its sort spills); a null path or digest is left out."""
    line = files.select(F.concat(digest, F.lit("  "), path).alias("line")).where("line IS NOT NULL")
    return line.repartition(1).sortWithinPartitions("line").mapInArrow(_sha_of_lines, "fingerprint string")


#: Addresses that a sitemap may hold.
SITEMAP_URLS = 50_000
SITEMAP_FOOT = "</urlset>"


def sitemap_lines(urls: DataFrame, column: str, split: bool = True) -> DataFrame:
    """(part, ord, line): sitemaps of the distinct URLs in byte order, SITEMAP_URLS each, as lines to be written in the order of ord; without split one of all URLs (part 0)."""
    u = urls.select(F.col(column).alias("u")).where("u IS NOT NULL").distinct()
    cuts = u.repartitionByRange("u").select("u", F.spark_partition_id().alias("p"))
    from pyspark.sql import Window

    n = cuts.withColumn("k", F.row_number().over(Window.partitionBy("p").orderBy("u")))
    before = n.groupBy("p").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = n.join(F.broadcast(before), "p").withColumn("k", F.col("k") + F.col("before") - 1)
    part, ord_ = (F.floor(F.col("k") / SITEMAP_URLS), F.col("k") % SITEMAP_URLS) if split else (F.lit(0).cast("long"), F.col("k"))
    body = n.select(part.alias("part"), (ord_ + 1).alias("ord"), F.concat(F.lit("<url><loc>"), sitemap_loc(F.col("u")), F.lit("</loc></url>")).alias("line"))
    parts = body.select("part").distinct()
    head = parts.select("part", F.lit(0).cast("long").alias("ord"), F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">').alias("line"))
    foot = parts.select("part", F.lit(SITEMAP_URLS + 1).cast("long").alias("ord"), F.lit(SITEMAP_FOOT).alias("line"))
    if not split:
        foot = body.groupBy("part").agg((F.greatest(F.max("ord"), F.lit(SITEMAP_URLS)) + 1).alias("ord")).select("part", "ord", F.lit(SITEMAP_FOOT).alias("line"))
    return head.unionByName(body).unionByName(foot)


def report_json(**tables: DataFrame) -> DataFrame:
    """One row (json): an object of each table's rows as an array, sorted; for reports, whose tables are small (a row of JSON each)."""
    out = None
    for name, df in tables.items():
        col = df.select(F.to_json(F.struct(*df.columns)).alias("x")).agg(F.concat(F.lit(f'"{name}":['), F.array_join(F.array_sort(F.collect_list("x")), ","), F.lit("]")).alias(name))
        out = col if out is None else out.crossJoin(col)
    return out.select(F.concat(F.lit("{"), F.concat_ws(",", *tables), F.lit("}")).alias("json"))


def robots(site: str) -> str:
    return f"User-agent: *\nAllow: /\nSitemap: {site.rstrip('/')}/sitemap.xml\n"
