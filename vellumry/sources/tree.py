"""Trees of files: a two-phase data source writer for rows (file, content), distributed copies, and the site's whole tree.

Tasks write their rows' files below a stage folder, each under a name of its own that is moved to the file's when it is complete; their commit
messages carry how many files and bytes they wrote and a digest of names and contents, which don't depend on order or on attempts. The driver compares the
sums with those of the rows, the stage is read back against the rows, and only then takes the tree's place. What a lost task left is
overwritten by its next attempt or, being half written, removed. After an aborted write the old tree stays; what tasks that were still running leave of the
stage goes with the next write.

Names are checked before anything is written: safe relative paths, each once whatever its case, none a folder of another; null names or contents are
an error too. Stage and tree are folders that the driver and all executors reach through pyarrow's file systems.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from vellumry.functions.urls import page_url, safe_path, sitemap_loc
from vellumry.session import set_checkpoint_dir
from vellumry.sources.sinks import SITEMAP_URLS, robots, sitemap_lines, swap_in

#: Bytes that a copy holds at once.
BLOCK = 1 << 22
_MASK = (1 << 64) - 1


class TreeError(OSError):
    """A tree that isn't what was to be written."""


def _mark(file: str, digest: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{digest} {file}".encode()).digest()[:8], "big")


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int
    digest: int  # sum of marks, modulo 2**64


class TreeSink(DataSource):
    """df (file string, content binary).write.format("vellumry_tree").option("stage", folder).mode("append").save(): files below the folder."""

    @classmethod
    def name(cls) -> str:
        return "vellumry_tree"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options))


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.stage = options["stage"]
        self.want = tuple(int(options[k]) for k in ("files", "bytes", "digest")) if "files" in options else None

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = pafs.FileSystem.from_uri(self.stage)
        n = size = digest = 0
        made: set[str] = set()
        for b in iterator:
            for file, content in zip(b.column("file"), b.column("content")):
                file, content = file.as_py(), content.as_py()
                path = f"{root}/{file}"
                if (folder := path.rpartition("/")[0]) not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{path}.{uuid.uuid4().hex[:8]}.part"
                with fs.open_output_stream(part, compression=None) as f:
                    f.write(content)
                fs.move(part, path)
                n, size = n + 1, size + len(content)
                digest = (digest + _mark(file, hashlib.sha256(content).hexdigest())) & _MASK
        return Written(n, size, digest)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = [m for m in messages if m is not None]
        got = (sum(m.files for m in done), sum(m.bytes for m in done), sum(m.digest for m in done) & _MASK)
        if self.want is not None and got != self.want:
            self.abort(messages)
            raise TreeError(f"the tasks wrote {got[0]} files of {got[1]} bytes, not {self.want[0]} of {self.want[1]}, or other contents")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.stage)
        if fs.get_file_info(root).type == pafs.FileType.Directory:
            fs.delete_dir(root)


def name_faults(files: DataFrame) -> DataFrame:
    """files (file) -> (file, why) of names that can't be in one tree."""
    f = files.select("file")
    bad = f.where("file IS NULL OR file = ''").select("file", F.lit("no name").alias("why"))
    unsafe = f.where((F.col("file") != "") & ~safe_path(F.col("file"))).select("file", F.lit("not a safe relative path").alias("why"))
    # sums over names, so that a name that many rows have is one row before it is shuffled
    twice = f.where("file <> ''").groupBy(F.lower("file").alias("low")).agg(F.min("file").alias("file"), F.count(F.lit(1)).alias("n")).where("n > 1").select("file", F.lit("more than once, cases aside").alias("why"))
    parts = F.split("file", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    folders = f.where(F.size(parts) > 1).select(F.explode(above).alias("folder")).distinct()
    both = f.join(folders, F.lower("file") == F.lower("folder"), "left_semi").select("file", F.lit("a folder of another").alias("why"))
    return bad.unionByName(unsafe).unionByName(twice).unionByName(both)


def _digest(fs: pafs.FileSystem, path: str, to=None) -> tuple[int, str]:
    """(bytes, sha256) of a file, read block by block; the blocks also go to to."""
    h, n = hashlib.sha256(), 0
    with fs.open_input_stream(path, compression=None) as f:
        while block := f.read(BLOCK):
            h.update(block)
            n += len(block)
            if to is not None:
                to.write(block)
    return n, h.hexdigest()


#: Names of files that a task writes before it moves them.
_HALF = re.compile(r".*\.[0-9a-f]{8}\.part")


def list_tree(spark: SparkSession, folder: str, clean: bool = False) -> DataFrame:
    """(file) of all files below a folder, whatever their names begin with; one job for each level, a folder being one task's row. clean: half-written files of lost tasks are removed."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for below in b.column(0).to_pylist():
                at = f"{root}/{below}" if below else root
                found = fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
                half = [f for f in found if f.type == pafs.FileType.File and _HALF.fullmatch(f.base_name)] if clean else []
                for f in half:
                    fs.delete_file(f.path)
                gone = {f.path for f in half}
                left = [f for f in found if f.path not in gone]
                names = [f"{below}/{f.base_name}" if below else f.base_name for f in left]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([f.type == pafs.FileType.Directory for f in left], pa.bool_())], names=["file", "folder"])

    set_checkpoint_dir(spark)
    tasks = 4 * spark.sparkContext.defaultParallelism
    folders, files = spark.createDataFrame(pa.table({"file": [""]})), None
    while True:
        level = folders.repartition(tasks).mapInArrow(entries, "file string, folder boolean").checkpoint()
        own = level.where("NOT folder").select("file")
        files = own if files is None else files.unionByName(own)
        folders = level.where("folder").select("file")
        if folders.isEmpty():
            return files


def read_tree(spark: SparkSession, folder: str, clean: bool = False) -> DataFrame:
    """(file, bytes, sha256) of all files below a folder; none if it isn't there."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for b in batches:
            names = b.column(0).to_pylist()
            sizes, shas = zip(*(_digest(fs, f"{root}/{n}") for n in names)) if names else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())], names=["file", "bytes", "sha256"])

    files = list_tree(spark, folder, clean).repartition(4 * spark.sparkContext.defaultParallelism)
    return files.mapInArrow(read, "file string, bytes long, sha256 string")


def _sums(rows: DataFrame) -> tuple[int, int, int]:
    """What the tasks' messages should add up to, from (file, bytes, sha256)."""
    half = lambda a: F.conv(F.substring(F.sha2(F.concat_ws(" ", "sha256", "file"), 256), a, 8), 16, 10).cast("decimal(38,0)")
    r = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0)), F.sum(half(1)), F.sum(half(9))).first()
    return r[0], r[1], ((int(r[2] or 0) << 32) + int(r[3] or 0)) & _MASK


def write_tree(spark: SparkSession, files: DataFrame, path: str, tasks: int | None = None) -> DataFrame:
    """files (file string, content binary) as the tree at path, in the place of what was there; (file, bytes, sha256) of what was written.

    The rows are made once and kept beside the tree until it is verified.
    """
    base = path.rstrip("/")
    stage, kept = f"{base}.part", f"{base}.rows"
    files.select("file", F.col("content").cast("binary").alias("content")).write.mode("overwrite").parquet(kept)
    rows = spark.read.schema("file string, content binary").parquet(kept)
    if faults := name_faults(rows).unionByName(rows.where("content IS NULL AND file IS NOT NULL").select("file", F.lit("no content").alias("why"))).head(3):
        raise TreeError("; ".join(f"{r.file!r}: {r.why}" for r in faults))
    want = rows.select("file", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    n, size, digest = _sums(want)
    spark.dataSource.register(TreeSink)
    _Writer({"stage": stage}).abort([])
    spread = rows.repartition(tasks or max(1, min(n, 4 * spark.sparkContext.defaultParallelism)))
    spread.write.format("vellumry_tree").options(stage=stage, files=str(n), bytes=str(size), digest=str(digest)).mode("append").save()
    fs, root = pafs.FileSystem.from_uri(stage)
    fs.create_dir(root, recursive=True)  # a tree without files
    there = read_tree(spark, stage, clean=True).checkpoint()
    if not want.exceptAll(there).isEmpty() or not there.exceptAll(want).isEmpty():
        raise TreeError(f"{stage} doesn't hold what was written")
    swap_in(spark, stage, base)
    fs.delete_dir(pafs.FileSystem.from_uri(kept)[1])
    return there


def copy_checked(spark: SparkSession, files: DataFrame, source: str, target: str) -> DataFrame:
    """files (file) copied from below source to below target, byte for byte: (file, bytes, sha256), in tasks; an error if a copy differs or a file isn't there."""

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a, a_root), (b, b_root) = (pafs.FileSystem.from_uri(x) for x in (source, target))

        for batch in batches:
            names, sizes, shas = batch.column(0).to_pylist(), [], []
            for file in names:
                out = f"{b_root}/{file}"
                b.create_dir(out.rpartition("/")[0], recursive=True)
                part = f"{out}.{uuid.uuid4().hex[:8]}.part"
                with b.open_output_stream(part, compression=None) as to:
                    one = _digest(a, f"{a_root}/{file}", to)
                b.move(part, out)
                if _digest(b, out) != one:
                    raise TreeError(f"the copy of {file} differs")
                sizes.append(one[0]), shas.append(one[1])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(shas, pa.string())], names=["file", "bytes", "sha256"])

    if faults := name_faults(files).head(1):
        raise TreeError(f"{faults[0].file!r}: {faults[0].why}")
    spread = files.select("file").repartition(4 * spark.sparkContext.defaultParallelism)
    return spread.mapInArrow(copy, "file string, bytes long, sha256 string")


def site_files(pages: DataFrame, host: str, texts: dict[str, str] | None = None, split: bool = True) -> DataFrame:
    """pages (file, kind, html) and what a site has besides: (file, content) of pages, sitemaps, robots.txt and further texts (name -> text).

    The sitemap lists all pages but those of what isn't found; beyond SITEMAP_URLS addresses there are several, and sitemap.xml lists them,
    or, without split, one sitemap.xml holds all of them (a row of some 60 bytes an address).
    """
    spark = pages.sparkSession
    encoded = lambda c: F.encode(c, "UTF-8")
    own = pages.select("file", encoded(F.col("html")).alias("content"))
    urls = pages.where("kind <> 'not_found'").select(F.concat(F.lit(f"https://{host}"), page_url(F.col("file"))).alias("u"))
    lines = sitemap_lines(urls, "u", split).groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line"))), lambda x: x["line"]), "\n").alias("t"))  # with split SITEMAP_URLS lines at most
    several = lines.agg(F.count(F.lit(1)).alias("parts"))
    maps = lines.crossJoin(F.broadcast(several)).select(  # one row
        F.when(F.col("parts") == 1, "sitemap.xml").otherwise(F.concat(F.lit("sitemap-"), (F.col("part") + 1).cast("string"), F.lit(".xml"))).alias("file"), encoded(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n'), "t", F.lit("\n"))).alias("content")
    )
    each = F.transform(F.sequence(F.lit(1).cast("long"), F.col("parts")), lambda k: F.concat(F.lit("<sitemap><loc>"), sitemap_loc(F.concat(F.lit(f"https://{host}/sitemap-"), k.cast("string"), F.lit(".xml"))), F.lit("</loc></sitemap>")))
    index = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'), F.array_join(each, "\n"), F.lit("\n</sitemapindex>\n"))
    listed = several.where("parts > 1").select(F.lit("sitemap.xml").alias("file"), encoded(index).alias("content"))
    fixed = {"robots.txt": robots(f"https://{host}")} | (texts or {})
    rest = spark.createDataFrame(pa.table({"file": list(fixed), "content": pa.array([x.encode() for x in fixed.values()], pa.binary())}))
    return own.unionByName(maps).unionByName(listed).unionByName(rest)
