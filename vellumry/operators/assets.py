"""Discovery of a site's assets: references from bodies and metadata, classified, grouped by path, with a journal of what is there.

Nulls hold no references; repeated references count once for each place; empty tables give no assets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.functions import urls as U
from vellumry.functions.text import extension
from vellumry.operators.integrity import case_collisions, first_k

# First segments of pages, and endings of content that isn't text.
PAGE_DIRS = "t c u g n tag tags user users group groups badges search about faq guidelines tos privacy top latest new unread posts categories login signup session admin my review invites p".split()
BINARY = "png jpg jpeg gif webp svg bmp ico pdf doc docx ppt pptx xls xlsx zip gz mp3 mp4".split()
#: Places named for each asset.
EXAMPLES = 5


def post_references(posts: DataFrame, html: str, own: str) -> DataFrame:
    """posts (topic_id, number, html) -> (ref 'topic/post', raw): the own host's URLs in bodies."""
    ref = F.concat_ws("/", F.col("topic_id").cast("string"), F.col("number").cast("string"))
    return posts.select(ref.alias("ref"), F.explode(U.own_references(F.col(html), own)).alias("raw"))


def field_references(records: DataFrame, label: str, fields: list[str], own: str) -> tuple[DataFrame, DataFrame]:
    """((ref, raw), (warning)) of URL columns of records (label is a column that names the record); what points elsewhere is a warning."""
    pairs = F.array(*[F.struct(F.concat_ws("/", label, F.lit(f)).alias("ref"), F.col(f).alias("raw")) for f in fields])
    rows = records.select(F.explode(pairs).alias("x")).select("x.*").where("raw IS NOT NULL AND raw <> ''")
    u = U.split_url(F.col("raw"))
    inside = (u["host"] == own) | ((u["scheme"] == "") & ~u["has_auth"] & F.startswith(u["path"], F.lit("/")))
    return rows.where(inside), rows.where(~inside).select(F.concat("ref", F.lit(" points off-host and is not fetched: "), "raw").alias("warning"))


def classified(refs: DataFrame) -> DataFrame:
    """refs (ref, raw) -> (ref, raw, kind, key, file, refused): each distinct URL is classified once and meets its references again.

    key: the decoded path, by which references are one asset; file: the safe relative file of an asset; refused: an asset whose path isn't safe.
    """
    u = U.split_url(F.col("raw"))
    path = U.percent_decode(u["path"])
    d = refs.select("raw").distinct().withColumn("kind", U.reference_kind(u["path"], PAGE_DIRS)).withColumn("path", F.coalesce(path, u["path"]))
    d = d.withColumn("file", F.when((F.col("kind") == "asset") & path.isNotNull(), U.safe_file(path)))
    d = d.withColumn("refused", (F.col("kind") == "asset") & F.col("file").isNull())
    d = d.withColumn("key", F.when(F.col("file").isNotNull(), F.concat(F.lit("/"), "file")).otherwise(F.col("path"))).drop("path")
    return refs.join(d, "raw")


def discovered(refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((kind, path, file, n_refs, examples), (warning)): assets and unclassified paths with the number of places that use them and the first
    EXAMPLES of these; warnings on refused paths and on assets that differ in case only."""
    c = classified(refs)
    use = first_k(c.where("kind <> 'page' AND NOT refused"), "key", "ref", EXAMPLES)
    of = c.where("kind <> 'page' AND NOT refused").groupBy("key").agg(F.first("kind").alias("kind"), F.first("file").alias("file"))
    found = of.join(use, "key").select("kind", F.col("key").alias("path"), "file", F.col("n").alias("n_refs"), F.array_join("firsts", ", ").alias("examples"))
    twins = case_collisions(found.where("kind = 'asset'"), "path").select(F.concat(F.lit("path collides with another one but for case: "), "path").alias("warning"))
    return found, c.where("refused").select(F.concat(F.lit("refused unsafe asset path: "), "key").alias("warning")).distinct().unionByName(twins)


def with_journal(assets: DataFrame, files: DataFrame, journal: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, still to fetch): assets (path, file, ...) whose file (file, size, sha256) is there, with the content type of the last journal
    (path, sha256, content_type) if its digest is still the file's; assets without a file are to be fetched."""
    there = assets.join(files.select("file", "size", "sha256"), "file")
    last = journal.select("path", F.col("sha256").alias("_sha"), "content_type").dropDuplicates(["path"])
    known = there.join(last, "path", "left").withColumn("content_type", F.when(F.col("_sha") == F.col("sha256"), F.col("content_type"))).drop("_sha")
    return known, assets.join(files.select("file"), "file", "left_anti")


def entry_warnings(entries: DataFrame) -> DataFrame:
    """(warning) of fetched entries: HTML where the ending says otherwise, and empty files."""
    html = F.lower(F.coalesce("content_type", F.lit(""))).startswith("text/html") & extension(F.col("path")).isin(BINARY)
    both = F.array(
        F.when(html, F.concat(F.lit("served as text/html although the path ends in ."), extension(F.col("path")), F.lit(": "), "path")),
        F.when(F.col("size") == 0, F.concat(F.lit("empty file: "), "path")),
    )
    return entries.select(F.explode(F.array_compact(both)).alias("warning"))


def reconciled(derived: DataFrame, reported: DataFrame, key: str, count: str) -> DataFrame:
    """(key, derived, reported) where counts differ; information only."""
    a, b = derived.select(key, F.col(count).alias("derived")), reported.select(key, F.col(count).alias("reported"))
    return a.join(b, key, "full_outer").where("NOT derived <=> reported")


def listed_category(topics: DataFrame, listing: DataFrame) -> DataFrame:
    """topics (id, category_id), listing (id, category_id; a topic may be in several) -> (id, category_id, differs): the topic's own category wins, a null one is the first listing's."""
    own = listing.groupBy("id").agg(F.min("category_id").alias("listed"))
    return topics.join(own, "id", "left").select("id", F.coalesce("category_id", "listed").alias("category_id"), F.coalesce(F.col("category_id") != F.col("listed"), F.lit(False)).alias("differs"))
