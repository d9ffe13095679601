"""Addresses in documents that a site hands out: PDF and word files read as far as they can be, and said so where they can't.

Null and empty content is of kind other. A PDF or word file that can't be opened has null text and count; one of which a part was beyond the reader's limits or broken is read
without it and isn't complete. Files are rows, read one by one within their task; repeated rows are counted each.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.sources import pdf
from vellumry.sources.files import _docx_text

#: Bytes of a word document's parts that are read at most, all together.
MOST_PARTS = 200_000_000
_TEXT = "file string, kind string, text string, complete boolean"


def _read(raw: bytes | None) -> tuple[str, str | None, bool]:
    """(kind, text, complete) of one file, by its content."""
    if not raw:
        return "other", None, True
    if b"%PDF-" in raw[:1024]:
        return "pdf", *pdf.read(raw)
    if raw[:4] == b"PK\x03\x04":
        try:
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                parts = [i for i in z.infolist() if re.fullmatch(r"word/[^/]+\.xml", i.filename)]
                if "word/document.xml" not in z.namelist():
                    return "zip", None, True
        except zipfile.BadZipFile:
            return "zip", None, False
        if sum(i.file_size for i in parts) > MOST_PARTS:
            return "word", None, False
        text = _docx_text(raw)
        return "word", text, text is not None
    return "other", None, True


def texts(files: DataFrame) -> DataFrame:
    """files (file, content binary) -> (file, kind, text, complete); kind is pdf, word, zip or other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0), b.column(1)):
                kind, text, complete = _read(raw.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()], pa.string()), pa.array([kind]), pa.array([text], pa.string()), pa.array([complete])], names=["file", "kind", "text", "complete"])

    return files.select(F.col("file").cast("string").alias("file"), F.col("content").cast("binary").alias("content")).mapInArrow(run, _TEXT)


def scan(files: DataFrame) -> DataFrame:
    """(file, kind, n, complete) of PDF and word files: the addresses in their texts, names of images left out; n is null if there is no text."""
    from vellumry.operators.audit import addresses

    found = texts(files).where("kind IN ('pdf', 'word')")
    return found.select("file", "kind", F.when(F.col("text").isNotNull(), F.size(addresses(F.col("text")))).cast("long").alias("n"), "complete")


def by_count(scanned: DataFrame) -> DataFrame:
    """(n, files) of scanned files with addresses, most addresses first, files by name."""
    return scanned.where("n > 0").groupBy("n").agg(F.array_sort(F.collect_set("file")).alias("files")).orderBy(F.desc("n"))
