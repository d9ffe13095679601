"""File sources: nested JSON, listings, rule files, manifests, HTML, archives."""

from __future__ import annotations

import gzip
import io
import json
import re
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType(), "strings": T.ArrayType(T.StringType()), "longs": T.ArrayType(T.LongType())}


def fields(text: str) -> T.StructType:
    """A schema from 'name kind' pairs; no session is needed."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (x.split() for x in text.split(","))])


POST = fields(
    "id long, post_number long, post_type long, topic_id long, created_at string, username string, name string, "
    "reply_to_post_number long, cooked string, hidden boolean, user_deleted boolean, deleted_at string"
)
# tags are kept as JSON text, since they are strings or objects with a name (jsonedit.names_of reads them)
TOPIC = fields("id long, slug string, title string, category_id long, created_at string, last_posted_at string, pinned boolean, closed boolean, archived boolean, tags string")
TOPIC = T.StructType([*TOPIC.fields, T.StructField("post_stream", T.StructType([T.StructField("stream", _KINDS["longs"]), T.StructField("posts", T.ArrayType(POST))]))])
_LISTED = fields("id long, category_id long, posts_count long")
LISTING = T.StructType([T.StructField("topic_list", T.StructType([T.StructField("topics", T.ArrayType(_LISTED))]))])


def json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row for each JSON file, strictly read, with its file name."""
    r = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(schema).json(path)
    return r.withColumn("file", F.col("_metadata.file_name"))


def topics(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(topics, posts, stray files) of topic/{id}.json and topic/{id}-posts-{k}.json.

    Stray are files of other names, chunks without their topic, files whose id isn't their name's, and files with a post of another topic.
    """
    docs = json_documents(spark, f"{folder.rstrip('/')}/topic/*.json", TOPIC)
    whole = docs.where(F.col("file").rlike(r"^[0-9]+\.json$"))
    chunk = docs.where(F.col("file").rlike(r"^[0-9]+-posts-[0-9]+\.json$"))
    owner = F.regexp_extract("file", r"^([0-9]+)", 1).cast("long")
    stray = docs.where(~F.col("file").rlike(r"^[0-9]+(?:-posts-[0-9]+)?\.json$")).select("file")
    stray = stray.unionByName(chunk.withColumn("owner", owner).join(whole.select(F.col("id").alias("owner")), "owner", "left_anti").select("file"))
    stray = stray.unionByName(whole.where(~F.col("id").eqNullSafe(owner)).select("file"))
    foreign = docs.where(F.exists("post_stream.posts", lambda p: p["topic_id"].isNotNull() & (p["topic_id"] != owner)))
    stray = stray.unionByName(foreign.select("file")).distinct()
    posts = whole.unionByName(chunk).select(owner.alias("owner"), F.explode("post_stream.posts").alias("p")).select("owner", "p.*")
    return whole.drop("file"), post_records(posts), stray


def post_records(posts: DataFrame) -> DataFrame:
    """Defaults: type 1, and hidden if hidden, deleted by its author, or deleted at some time."""
    off = F.coalesce("hidden", F.lit(False)) | F.coalesce("user_deleted", F.lit(False)) | (F.coalesce("deleted_at", F.lit("")) != "")
    return posts.withColumn("post_type", F.coalesce("post_type", F.lit(1))).withColumn("hidden", off).drop("user_deleted", "deleted_at")


def renderable(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("post_type").isin(1, 2) & ~F.col("hidden"))


# Fixed value: pages of one listing at most.
MOST_PAGES = 200


def listing_complete(spark: SparkSession, folder: str) -> DataFrame:
    """(category_id, pages, complete, too_many): a full enumeration of category/{id}-p{N}.json ends with an empty page."""
    d = json_documents(spark, f"{folder.rstrip('/')}/category/*.json", LISTING)
    d = d.select(F.regexp_extract("file", r"^([0-9]+)-p([0-9]+)\.json$", 1).cast("long").alias("category_id"), F.regexp_extract("file", r"-p([0-9]+)\.json$", 1).cast("long").alias("page"), F.size("topic_list.topics").alias("n"))
    return d.groupBy("category_id").agg(F.count(F.lit(1)).alias("pages"), (F.max_by("n", "page") == 0).alias("complete"), (F.count(F.lit(1)) > MOST_PAGES).alias("too_many"))


def below(spark: SparkSession, folder: str, path: Column) -> Column:
    """The part of full paths (as Spark gives them) below a folder, whatever folders of its name lie above or in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")
    return F.when(F.startswith(path, F.lit(f"{root}/")), path.substr(F.lit(len(root) + 2), F.length(path)))


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, sha256) of all files below a folder."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return d.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def kind_by_magic(content: Column) -> Column:
    """pdf (its mark within the first 1024 bytes), word (a zip with a word document), zip, gzip or other, by content."""
    head = F.hex(F.substring(content, 1, 1024))
    zip_ = F.startswith(head, F.lit("504B0304"))

    @F.pandas_udf("boolean")
    def word(c: pd.Series) -> pd.Series:
        def has(b: bytes | None) -> bool:
            try:
                with zipfile.ZipFile(io.BytesIO(b)) as z:
                    return "word/document.xml" in z.namelist()
            except Exception:
                return False

        return c.map(has)

    kind = F.when(head.rlike("^(?:..)*?255044462D"), "pdf").when(zip_, F.when(word(F.when(zip_, content)), "word").otherwise("zip"))
    return kind.when(F.startswith(head, F.lit("1F8B")), "gzip").otherwise("other")


#: What search fragments begin with, once inflated.
FRAGMENT_WORD = "pagefind_dcd"


def _gzip_json(b: bytes | None, word: str) -> str | None:
    try:
        text = gzip.decompress(b).decode()
        if not text.startswith(word):
            return None
        json.loads(text[len(word) :])
        return text[len(word) :]
    except Exception:
        return None


def _docx_text(b: bytes | None) -> str | None:
    try:
        with zipfile.ZipFile(io.BytesIO(b)) as z:
            parts = [z.read(n).decode("utf-8", "replace") for n in z.namelist() if re.fullmatch(r"word/[^/]+\.xml", n)]
    except Exception:
        return None
    return "\n".join(re.sub(r"<[^>]*>", "", re.sub(r"</w:p>", "\n", p)) for p in parts) if parts else None


def gzip_json(content: Column, word: str = FRAGMENT_WORD) -> Column:
    """JSON text of gzip content behind its leading word; null if it isn't gzip, has another word, or isn't JSON."""

    @F.pandas_udf("string")
    def run(c: pd.Series) -> pd.Series:
        return c.map(lambda b: _gzip_json(b, word))

    return run(content)


def docx_text(content: Column) -> Column:
    """Text of the word/ parts of a zip document; null for other content."""

    @F.pandas_udf("string")
    def run(c: pd.Series) -> pd.Series:
        return c.map(_docx_text)

    return run(content)


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(loc) of a sitemap; no rows if it isn't there, an error if it is malformed."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "loc string")
    return spark.read.format("xml").option("rowTag", "url").option("mode", "FAILFAST").schema("loc string").load(path)


# ---- categories, site, values

_CATEGORY = "id long, slug string, name string, position long, topic_count long, topic_url string, description_text string, uploaded_logo struct<url:string>, uploaded_background struct<url:string>"


def category_schema(levels: int) -> str:
    """DDL of a category with so many levels of categories below it."""
    return _CATEGORY + (f", subcategory_list array<struct<{_ddl(category_schema(levels - 1))}>>" if levels else "")


def _ddl(fields_: str) -> str:
    return re.sub(r"(^|, )([a-z_]+) ", r"\1\2:", fields_)


def categories(spark: SparkSession, path: str, levels: int = 8) -> DataFrame:
    """(id, parent_id, slug, name, position, description, about_topic_id, logo_url, background_url) of a nested category file; strictly read.

    Each level is unnested in turn, up to levels below the top (a file that goes deeper is an error, never cut).
    """
    doc = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(f"category_list struct<categories:array<struct<{_ddl(category_schema(levels + 1))}>>>").json(path)
    level = doc.select(F.lit(None).cast("long").alias("parent_id"), F.explode("category_list.categories").alias("c"))
    out = None
    for k in range(levels + 1):
        about = F.regexp_extract(F.coalesce("c.topic_url", F.lit("")), "/([0-9]+)$", 1)
        own = level.select(
            "c.id", "parent_id", "c.slug", "c.name", "c.position", F.coalesce("c.description_text", F.lit("")).alias("description"), F.nullif(about, F.lit("")).cast("long").alias("about_topic_id"),
            F.col("c.uploaded_logo.url").alias("logo_url"), F.col("c.uploaded_background.url").alias("background_url"),
        )
        out = own if out is None else out.unionByName(own)
        level = level.select(F.col("c.id").alias("parent_id"), F.explode("c.subcategory_list").alias("c"))
    if not level.isEmpty():
        raise ValueError(f"categories are nested more than {levels} levels deep")
    return out.dropDuplicates(["id"])


def site_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row: title, description, logo, favicon, apple_touch_icon; what is missing or null is empty, a site without a file is all empty."""
    keys = {"title": "title", "description": "description", "logo_url": "logo", "favicon_url": "favicon", "apple_touch_icon_url": "apple_touch_icon"}
    d = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(", ".join(f"{k} string" for k in keys)).json(path).limit(1)
    return d.select(*[F.coalesce(k, F.lit("")).alias(v) for k, v in keys.items()])


def allowlist(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The checked addresses of {"addresses": [{"address", "reason"}]}."""
    from vellumry.functions.redact import MOST_ALLOWED, check_allowlist

    d = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema("addresses array<struct<address:string,reason:string>>").json(path)
    rows = d.select(F.explode("addresses").alias("a")).select("a.address", "a.reason").limit(MOST_ALLOWED + 1).collect()
    return check_allowlist([(r.address, r.reason) for r in rows])


def string_values(files: DataFrame) -> DataFrame:
    """files (file, content) -> (file, ord, value): every string value of JSON files, in document order."""
    from vellumry.operators.jsonedit import literals

    return literals(files).where("error IS NULL AND NOT is_key").select("file", "ord", "value")


def invalid_json(files: DataFrame) -> DataFrame:
    """(file, error) of files that can't be read as JSON."""
    from vellumry.operators.jsonedit import literals

    return literals(files).where("error IS NOT NULL").select("file", "error")


def asset_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, size, sha256) below a folder, relative, without the file manager's own, in byte order."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    rel = below(spark, folder, F.col("path"))
    return d.select(rel.alias("file"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256")).where("file NOT RLIKE '(^|/)[.]DS_Store$'").orderBy("file")


def html_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(file, html, clean) of the HTML files below a folder; html null and clean false where the bytes aren't UTF-8."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{html,htm}").load(folder)
    rel = below(spark, folder, F.col("path"))
    text = F.col("content").cast("string")
    return d.select(rel.alias("file"), F.when(F.is_valid_utf8(text), text).alias("html"), F.is_valid_utf8(text).alias("clean"))


def fragments(spark: SparkSession, folder: str) -> DataFrame:
    """(file, url, content) of the search index's fragments; url null where one can't be read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pf_fragment").load(folder)
    j = gzip_json(F.col("content"))
    return d.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.get_json_object(j, "$.url").alias("url"), F.get_json_object(j, "$.content").alias("content"))


def backoff(attempt: int, hint: float | None = None) -> float:
    """Seconds to wait before the next try: 10, 20, 40 ... at most 120, or the server's hint, at most 600."""
    return min(float(hint), 600.0) if hint is not None else min(10.0 * 2 ** (attempt - 1), 120.0)
