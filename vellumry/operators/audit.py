"""The audit of a built site against its source: seventeen checks over a Site.

Everything is derived anew from the source tables and the site's files, not from what the build says.
What several checks read (parsed pages and rules, personal data found) is persisted once, spilling to disk; release() frees it.
Every check is a DataFrame of offenders, so it runs distributed and is complete whatever the site's size.

Null ids, slugs and texts are treated as absent; repeated source rows of one id count once where the
source's ids are meant. An empty source or site passes where nothing is wanted.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.functions import redact as R
from vellumry.functions import text as X
from vellumry.functions import urls as U
from vellumry.operators import html as H
from vellumry.operators import rules as L
from vellumry.operators.checks import Abort, Check, run_checks
from vellumry.operators.integrity import first_k, gap_ranges
from vellumry.operators.secrets import ANYWHERE, SLUG, WORD, find_values

# Pages and files that every site has, pages with the search widget, kinds of files by ending,
# what a page's data attributes may be, and words and elements that mustn't be published.
FIXED_PAGES = ["index.html", "search/index.html", "404.html"]
FIXED_FILES = ["robots.txt", "sitemap.xml", "_redirects", "archive.css"]
WIDGET_PAGES = ["search/index.html", "index.html"]
DOCUMENTS = "pdf doc docx docm dot dotx rtf odt txt ppt pptx pps ppsx odp key xls xlsx ods csv tsv zip gz tgz tar 7z rar epub tex ipynb json xml html htm".split()
IMAGES = "png jpg jpeg gif webp svg bmp ico avif tif tiff heic".split()
RANKS = {e: 2 for e in IMAGES} | {e: 0 for e in DOCUMENTS}
KIND_DEPTH = {"uploads/default": 3}
DATA_ATTRIBUTES = ["data-pagefind-body", "data-pagefind-meta", "data-pagefind-filter"]
FORBIDDEN_STRINGS = ["trust_level", "avatar_template", "user_title", "last_seen", "ip_address", "primary_group"]
FORBIDDEN_ELEMENTS = ["iframe", "object", "embed", "form"]
#: Endings of names that look like addresses but are images, as this audit sees it.
NOT_ADDRESSES = "png jpg jpeg gif webp svg".split()


@dataclass
class Site:
    """host; source tables topics (id, slug, title, category_id, stream_n), posts (topic_id, number, type, hidden, cooked), categories (id, slug,
    parent_id, path); the site's files (file, size, sha256), pages (file, html), texts (file, text: other published text files); assets
    (file, size, sha256: of the source); fragments (file, url, content: of the search index, url null if it can't be read) and page_count
    (of its entry); locs (loc: of the sitemap); kept (address, kept: of the allowlist's report); report (file, rule, n: of the redaction);
    verbatim (origin, value: strings of the unredacted source, None without one) and redacted_verbatim (it is a redacted copy itself);
    attachments (file, kind, n: addresses in documents, null if unreadable, complete; see operators/attachments); spot (ids to compare by eye);
    held (tables that were persisted for the site, freed by release())."""

    spark: SparkSession
    host: str
    topics: DataFrame
    posts: DataFrame
    categories: DataFrame
    files: DataFrame
    pages: DataFrame
    texts: DataFrame
    assets: DataFrame
    fragments: DataFrame
    page_count: int | None = None
    locs: DataFrame | None = None
    kept: DataFrame | None = None
    report: DataFrame | None = None
    verbatim: DataFrame | None = None
    redacted_verbatim: bool = False
    attachments: DataFrame | None = None
    spot: list[int] = field(default_factory=list)
    held: list[DataFrame] = field(default_factory=list)

    @cached_property
    def renderable(self) -> DataFrame:
        """Posts of types 1 and 2 that aren't hidden."""
        return self.posts.where(F.col("type").isin(1, 2) & ~F.coalesce("hidden", F.lit(False)))

    @cached_property
    def wanted(self) -> DataFrame:
        """(file, topic_id, category_id) of pages that topics and categories have."""
        t = self.topics.select(F.concat(F.lit("t/"), "slug", F.lit("/"), "id", F.lit("/index.html")).alias("file"), F.col("id").alias("topic_id"), F.lit(None).cast("long").alias("category_id"))
        c = self.categories.select(F.concat(F.lit("c/"), "path", F.lit("/"), "id", F.lit("/index.html")).alias("file"), F.lit(None).cast("long").alias("topic_id"), F.col("id").alias("category_id"))
        return t.unionByName(c).where("file IS NOT NULL").dropDuplicates(["file"]).persist()

    @cached_property
    def attributes(self) -> DataFrame:
        return H.attribute_relation(self.pages, "file", "html").persist()

    @cached_property
    def anchors(self) -> DataFrame:
        return self.attributes.where(F.col("name").isin("id", "name")).select("file", F.col("value").alias("fragment")).distinct()

    @cached_property
    def shown(self) -> DataFrame:
        """(topic_id, ord, number, body) of posts on topics' pages."""
        p = H.posts_of_pages(self.pages, "html")
        return p.join(self.wanted.where("topic_id IS NOT NULL").select("file", "topic_id"), "file").drop("file").persist()

    @cached_property
    def rules(self) -> DataFrame:
        """Rules of the file; read in one task, as it is one text, and then dealt out."""
        return L.parse(self.texts.where("file = '_redirects'"), "text").repartition("source").persist()

    @cached_property
    def sightings(self) -> DataFrame:
        """(file, kind, view, rule, address, n): personal data in every view of what is published; a row for each address, and for each other rule."""
        return _sightings(self).persist()

    @cached_property
    def values(self) -> DataFrame:
        """Values to search for, of the unredacted source."""
        return values_of(self.verbatim if self.verbatim is not None else self.rows([], "origin string, value string")).persist()

    def release(self) -> None:
        for x in self.held + [self.__dict__[k] for k in ("wanted", "attributes", "shown", "rules", "sightings", "values") if k in self.__dict__]:
            x.unpersist()

    def rows(self, values: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(values, schema)

    def names(self, values: list[str]) -> DataFrame:
        return self.rows([(v,) for v in values], "file string")


def _say(df: DataFrame, pattern: str, *cols: Column | str) -> DataFrame:
    return df.select(F.format_string(pattern, *cols).alias("offender"))


def _all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _facts(**counts: DataFrame) -> DataFrame:
    """(fact, n): rows of each table."""
    return _all(*[df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("fact"), "n") for k, df in counts.items()])


def _not_in(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(other.select(*([on] if isinstance(on, str) else on)).distinct(), on, "left_anti")


# ---- 1 and 2: pages and posts


def pages(s: Site) -> DataFrame:
    want = s.wanted.select("file").unionByName(s.names(FIXED_PAGES + FIXED_FILES)).distinct()
    good = s.wanted.select("file").unionByName(s.names(FIXED_PAGES))
    return _all(
        _say(_not_in(want, s.files, "file"), "no file %s", "file"),
        _say(_not_in(s.pages.select("file"), good, "file"), "page that nothing asks for: %s", "file"),
        _say(s.pages.where("html IS NULL").select("file"), "page without readable text: %s", "file"),
    )


def posts(s: Site) -> DataFrame:
    p = s.posts.dropDuplicates(["topic_id", "number"])
    skipped = _not_in(p, s.renderable, ["topic_id", "number"]).where(F.btrim(F.coalesce("cooked", F.lit("")), F.lit(" \t\r\n")) != "")
    held = p.groupBy(F.col("topic_id").alias("id")).agg(F.count(F.lit(1)).alias("held"))
    stream = s.topics.join(held, "id", "left").where("stream_n > 0 AND stream_n <> coalesce(held, 0)")
    page_of = s.wanted.where("topic_id IS NOT NULL").select("file", "topic_id")
    there = page_of.join(s.pages.select("file"), "file").select("topic_id")
    want = s.renderable.select("topic_id", "number").distinct()
    got = s.shown.select("topic_id", "number")
    numbered = got.where("number IS NOT NULL")
    absent = _not_in(want, there, "topic_id").groupBy("topic_id").agg(F.count(F.lit(1)).alias("n"))
    return _all(
        _say(skipped, "%d/%d isn't shown, yet its body isn't empty", "topic_id", "number"),
        _say(stream, "%d: %d posts announced, %d in the source", "id", "stream_n", F.coalesce("held", F.lit(0))),
        _say(absent, "%d: without its page %d posts aren't shown", "topic_id", "n"),
        _say(_not_in(want.join(there, "topic_id", "left_semi"), numbered, ["topic_id", "number"]), "%d/%d is missing from its page", "topic_id", "number"),
        _say(_not_in(numbered.distinct(), want, ["topic_id", "number"]), "%d/%d is on the page without being meant for it", "topic_id", "number"),
        _say(numbered.groupBy("topic_id", "number").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "%d/%d is on the page more than once", "topic_id", "number"),
        _say(got.where("number IS NULL").groupBy("topic_id").agg(F.count(F.lit(1)).alias("n")), "%d: %d articles that tell no post number", "topic_id", "n"),
    )


def post_facts(s: Site) -> DataFrame:
    hidden = F.coalesce("hidden", F.lit(False))
    p = s.posts.dropDuplicates(["topic_id", "number"])
    return _facts(
        raw=p, renderable=s.renderable.dropDuplicates(["topic_id", "number"]), rendered=s.shown, hidden=p.where(hidden), system=p.where(~hidden & (F.col("type") == 3)),
        other=p.where(~hidden & ~F.col("type").isin(1, 2, 3)), topics_with_gaps=gap_ranges(p, "topic_id", "number").select("topic_id").distinct(),
    )


def words(s: Site) -> DataFrame:
    """Words of a source body that its page lacks, as multisets. A post's two bodies meet by one join; equal ones lose nothing, words of
    others are counted where the join left them, by its keys, so that no word is shuffled."""
    key = ["topic_id", "number"]
    rendered = s.shown.where("number IS NOT NULL").withColumn("_k", F.row_number().over(_window(key, "ord"))).where("_k = 1").select(*key, "body")
    want = s.renderable.dropDuplicates(key).select(*key, H.mapped(F.col("cooked"), H.raw_body).alias("raw"))
    have = rendered.select(*key, H.mapped(F.col("body"), H.shown_body).alias("page"))
    marked = lambda c, n, m: F.transform(X.tokens(X.visible_text(F.col(c))), lambda w: F.struct(w.alias("word"), F.lit(n).alias("n"), F.lit(m).alias("have")))
    differing = want.join(have, key).where("raw <> page").select(*key, F.explode(F.concat(marked("raw", 1, 0), marked("page", 0, 1))).alias("x"))
    per = differing.groupBy(*key, F.col("x.word").alias("word")).agg(F.sum("x.n").alias("n"), F.sum("x.have").alias("have"))
    short = F.greatest(F.col("n") - F.col("have"), F.lit(0))
    lost = per.groupBy(key).agg(F.sum(short).alias("lost"), F.sum("n").alias("all")).where("lost > 0")
    return _say(lost, "%d/%d lost %d of its %d words", *key, "lost", "all")


def _window(keys: list[str], order: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy(order)


# ---- 3 and 4: hosts and links


def _canonical(s: Site) -> DataFrame:
    a = s.attributes
    rel = a.where((F.col("el") == "link") & (F.col("name") == "rel") & H.has_class(F.lower("value"), "canonical")).select("file", "idx").distinct()
    return a.where((F.col("el") == "link") & (F.col("name") == "href") & F.lower("value").contains(s.host)).join(rel, ["file", "idx"], "left_semi")


def host(s: Site) -> DataFrame:
    named = s.attributes.where(F.lower("value").contains(s.host))
    own = _canonical(s).withColumn("u", U.split_url(F.col("value")))
    u = F.col("u")
    off = own.where((u["host"] != s.host) | (U.percent_decode_tolerant(u["path"]) != U.page_url(F.col("file"))))
    bad = named.join(own.select("file", "idx", "name"), ["file", "idx", "name"], "left_anti")
    return _all(_say(bad, "%s still points at the old host in %s@%s", "file", "el", "name"), _say(off, "%s is canonical for another address", "file"))


def host_text(s: Site) -> DataFrame:
    """Pages whose text names the host."""
    n = F.regexp_count(F.lower(X.visible_text(F.col("html"))), F.lit(s.host.replace(".", "\\.")))
    return _say(s.pages.select("file", n.alias("n")).where("n > 0"), "%s tells the old host %d times", "file", "n")


def _references(s: Site) -> DataFrame:
    """(file, attr, url): every URL in pages' attributes."""
    a = s.attributes.where(F.col("name").isin(U.URL_ATTRIBUTES)).select("file", F.col("name").alias("attr"), "value")
    many = F.when(F.col("attr").isin("srcset", "imagesrcset"), U.srcset_urls(F.col("value"))).otherwise(F.array("value"))
    return a.select("file", "attr", F.explode(many).alias("url"))


def _unresolved(s: Site, refs: DataFrame) -> DataFrame:
    """refs (place, what, r: struct(path, file, fragment)) -> offenders whose file or fragment isn't there."""
    flat = refs.select("place", "what", F.col("r.file").alias("file"), F.col("r.fragment").alias("fragment"))
    gone = _not_in(flat, s.files, "file")
    on_page = flat.where("fragment <> '' AND fragment <> 'top'").join(s.pages.select("file"), "file", "left_semi")
    return _all(_say(gone, "%s, %s: nothing is served there", "place", "what"), _say(_not_in(on_page, s.anchors, ["file", "fragment"]), "%s, %s: fragment %s isn't on %s", "place", "what", "fragment", "file"))


def links(s: Site) -> DataFrame:
    refs = _references(s).withColumn("u", U.split_url(F.col("url"))).withColumn("kind", U.link_kind(F.col("u"), s.host))
    inner = refs.where("kind = 'internal'").select(F.col("file").alias("place"), F.concat_ws(" ", "attr", "url").alias("what"), U.resolve(F.col("u"), U.page_url(F.col("file"))).alias("r"))
    rules = s.rules.where("dest IS NOT NULL").select("dest", U.split_url(F.col("dest")).alias("u"))
    plain = rules.where((U.link_kind(F.col("u"), s.host) == "internal") & ~F.col("u.path").rlike("[*:]"))
    dests = plain.select(F.lit("_redirects").alias("place"), F.concat(F.lit("destination "), "dest").alias("what"), U.resolve(F.col("u"), F.lit("/")).alias("r"))
    locs = (s.locs if s.locs is not None else s.rows([], "loc string")).select("loc", U.split_url(F.col("loc")).alias("u"))
    own = locs.where(F.col("u.host") == s.host).select(F.lit("sitemap.xml").alias("place"), F.concat(F.lit("<loc> "), "loc").alias("what"), U.resolve(F.col("u"), F.lit("/")).alias("r"))
    return _all(
        _unresolved(s, _all(inner, dests, own)),
        _say(refs.where("kind = 'malformed'"), "%s, %s %s: a web address without host", "file", "attr", "url"),
        _say(locs.where(F.col("u.host") != s.host), "the sitemap lists a foreign address: %s", "loc"),
    ).distinct()


def external(s: Site) -> DataFrame:
    """(host, n) of external URLs, as facts."""
    u = U.split_url(F.col("url"))
    refs = _references(s).withColumn("u", u).where(U.link_kind(F.col("u"), s.host) == "external").select(F.col("u.host").alias("fact"))
    return refs.groupBy("fact").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "fact").limit(10)


# ---- 5: assets


def asset_references(s: Site) -> DataFrame:
    """(path, topic_id, number) of assets that source bodies name."""
    return s.posts.select("topic_id", "number", F.explode(U.asset_paths(F.col("cooked"), s.host)).alias("path"))


def asset_rank(path: Column) -> Column:
    """Place in the report by the file's ending: RANKS, or 1."""
    known = F.create_map(*[F.lit(x) for ending, rank in RANKS.items() for x in (ending, rank)])
    return F.coalesce(F.try_element_at(known, X.extension(path)), F.lit(1))


def asset_kind(file: Column) -> Column:
    """The folder that tells what an asset is: as deep as KIND_DEPTH says for its top, else two."""
    folder = F.regexp_extract(file, "^(?:(.*)/)?[^/]*$", 1)
    depth = [F.when(F.startswith(file, F.lit(f"{top}/")), F.substring_index(folder, "/", n)) for top, n in KIND_DEPTH.items()]
    return F.coalesce(*depth, F.when(folder == "", "(no folder)"), F.substring_index(folder, "/", 2))


def missing_assets(s: Site) -> DataFrame:
    """(rank, path, n, where): asset paths that bodies name and the site lacks, documents first; avatars are left out on purpose."""
    refs = asset_references(s).withColumn("file", F.regexp_replace("path", "^/", ""))
    gone = _not_in(refs.where(~U.first_segment(F.col("path")).isin(U.AVATAR_DIRS)), s.files, "file")
    use = first_k(gone.withColumn("where", F.format_string("%d/%d", "topic_id", "number")), "path", "where", 3)
    return use.select(asset_rank(F.col("path")).alias("rank"), "path", "n", F.array_join("firsts", ", ").alias("where")).orderBy("rank", "path")


def assets(s: Site) -> DataFrame:
    from vellumry.operators.integrity import compare_bytes

    off = compare_bytes(s.assets, s.files, "file", "size", "sha256").where("status <> 'extra'")
    generated = s.pages.select("file").unionByName(s.names(FIXED_FILES)).unionByName(s.assets.select("file"))
    stray = _not_in(s.files.where("file NOT LIKE 'pagefind/%'").select("file"), generated, "file")
    return _all(
        _say(missing_assets(s), "asset %s isn't there; asked for by %s", "path", "where"),
        _say(off.where("status = 'missing'"), "asset %s wasn't copied", "file"),
        _say(off.where("status <> 'missing'"), "asset %s was changed", "file"),
        _say(stray, "file of unknown origin: %s", "file"),
    )


# ---- 6: personal data


def _kinds(s: Site) -> DataFrame:
    """(fact, n): texts of the corpus by kind."""
    kinds = {"page": s.pages, "text file": _not_in(s.texts, s.pages, "file"), "fragment": s.fragments.where("url IS NOT NULL")}
    return _facts(**kinds).where("n > 0")


def corpus(s: Site) -> DataFrame:
    """(file, kind, views array): everything published, pages as source, attribute values and text that readers see."""
    values = s.attributes.where("value IS NOT NULL").groupBy("file").agg(F.array_join(F.collect_list("value"), "\n").alias("values"))
    p = s.pages.join(values, "file", "left").select("file", F.lit("page").alias("kind"), F.array("html", F.coalesce("values", F.lit("")), X.visible_text(F.col("html"), keep_code=True)).alias("views"))
    t = _not_in(s.texts, s.pages, "file").select("file", F.lit("text file").alias("kind"), F.array("text").alias("views"))
    f = s.fragments.where("url IS NOT NULL").select("file", F.lit("fragment").alias("kind"), F.array("content").alias("views"))
    return _all(p, t, f).select("file", "kind", F.transform("views", lambda v: F.coalesce(v, F.lit(""))).alias("views"))


def addresses(text: Column) -> Column:
    """Address-like strings that aren't names of images."""
    found = F.regexp_extract_all(text, F.lit(r"(?<![\w.%+-])([\w.%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"), F.lit(1))
    return F.filter(found, lambda a: ~F.lower(F.substring_index(a, ".", -1)).isin(NOT_ADDRESSES))


def _kept(s: Site) -> DataFrame:
    return (s.kept if s.kept is not None else s.rows([], "address string, kept long")).select(F.lower("address").alias("address"), "kept")


def _sightings(s: Site) -> DataFrame:
    """Every view is read once, for all rules. (An inner explode would make Spark build all views once more, to ask first whether there are any.)"""
    views = corpus(s).select("file", "kind", F.posexplode_outer("views").alias("view", "v"))
    row = lambda rule, address, n: F.struct(F.lit(rule).alias("rule"), address.cast("string").alias("address"), n.cast("int").alias("n"))
    mail = F.when(F.col("v").contains("@"), F.transform(addresses(F.col("v")), lambda a: row("e-mail address", F.lower(a), F.lit(1))))
    others = F.array(
        row("mailto link", F.lit(None), F.regexp_count("v", F.lit("(?i)mailto:"))),
        row("passcode parameter", F.lit(None), R.count_rule(F.col("v"), R.RULES[3])),
        row("plain passcode", F.lit(None), R.count_rule(F.col("v"), R.RULES[4])),
    )
    all_ = F.concat(F.coalesce(mail, F.array().cast("array<struct<rule:string,address:string,n:int>>")), F.filter(others, lambda x: x["n"] > 0))
    return views.select("file", "kind", "view", F.explode(all_).alias("x")).select("file", "kind", "view", "x.rule", "x.address", "x.n")


def _personal(s: Site) -> DataFrame:
    """(file, kind, rule, n): the most that any view of a text holds."""
    per = s.sightings.join(_kept(s), "address", "left_anti").groupBy("file", "kind", "rule", "view").agg(F.sum("n").alias("n"))
    return per.groupBy("file", "kind", "rule").agg(F.max("n").alias("n"))


def personal(s: Site) -> DataFrame:
    """Addresses and passcodes anywhere; allowed addresses must be in pages, and in the search index, just as often as was reported, and nowhere else."""
    found = s.sightings.where(F.col("address").isNotNull() & (F.col("view") == F.when(F.col("kind") == "page", 2).otherwise(0)))
    n = found.groupBy("address").pivot("kind", ["page", "fragment", "text file"]).agg(F.count(F.lit(1)))
    k = _kept(s).join(n, "address", "left").na.fill(0).where("page <> kept OR fragment <> kept OR `text file` <> 0")
    return _all(
        _say(_personal(s), "%s: %d x %s", "file", "n", "rule"),
        _say(k, "allowed address seen %d times by readers, %d by searchers, %d elsewhere; %d were reported", "page", "fragment", "text file", "kept"),
    )


def inventory(s: Site) -> DataFrame:
    """Facts on links with secrets, redaction markers and reported redactions."""
    a = s.attributes
    href = a.where("el = 'a' AND name = 'href'")
    span = lambda c: a.where((F.col("el") == "span") & (F.col("name") == "class") & H.has_class(F.col("value"), c))
    zoom = href.where(U.split_url(F.col("value"))["host"].contains("zoom"))
    redacted = rf"(?i)[?&;](?:{'|'.join(R.PASSCODE_PARAMS)})=REDACTED(?:[\s\"'<>&#]|\z)"
    marks = s.pages.select(F.explode(F.regexp_extract_all("html", F.lit(r"(\[email redacted\])"), F.lit(1))))
    report = s.report if s.report is not None else s.rows([], "file string, rule string, n long")
    return _facts(
        zoom_links=zoom, zoom_links_redacted=zoom.where(F.col("value").rlike(redacted)), view_only_links=href.where(F.col("value").contains("view_only=")),
        rlkey_links=href.where(F.col("value").contains("rlkey=")), redacted_spans=span("email-redacted"), redacted_marks=marks, mentions=span("mention"),
    ).unionByName(report.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")).select(F.lit("reported_redactions").alias("fact"), "n"))


def values_of(strings: DataFrame) -> DataFrame:
    """strings (origin, value) -> (id, kind, value, what, origin): addresses, passcode parameters and labelled passcodes in unredacted strings, distinct ones."""
    coded = lambda k: R.passcodes(F.col("value"), R.RULES[k])
    found = F.array(
        F.struct(F.lit("e-mail address").alias("what"), F.lit(ANYWHERE).alias("kind"), F.transform(addresses(F.col("value")), F.lower).alias("v")),
        F.struct(F.lit("passcode parameter").alias("what"), F.lit(SLUG).alias("kind"), coded(3).alias("v")),
        F.struct(F.lit("plain passcode").alias("what"), F.lit(WORD).alias("kind"), coded(4).alias("v")),
    )
    rows = strings.where(F.col("value").rlike("[@=:]")).select("origin", F.explode(found).alias("x")).select("origin", "x.what", "x.kind", F.explode("x.v").alias("value")).where("value <> ''")
    rows = rows.groupBy("what", "kind", "value").agg(F.min("origin").alias("origin"))
    return rows.select(F.sha2(F.concat_ws(" ", "what", "value"), 256).alias("id"), "kind", "value", "what", "origin")


def _values(s: Site) -> DataFrame:
    if s.redacted_verbatim:
        raise Abort("the unredacted source is a redacted copy itself")
    return s.values


def verbatim(s: Site) -> DataFrame:
    """Unredacted values that the site still holds, in any view; the values themselves are never named."""
    v = _values(s)
    views = corpus(s).select("file", F.explode_outer("views").alias("v"))
    hit = find_values(views, "file", "v", v).distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("file"))
    return _say(hit.join(v.select("id", "what", "origin"), "id"), "%s of %s can still be read in %d texts, for one in %s", "what", "origin", "n", "file")


def attachments(s: Site) -> DataFrame:
    """Facts: documents by kind, with addresses, unreadable, read in part."""
    d = s.attachments if s.attachments is not None else s.rows([], "file string, kind string, n long, complete boolean")
    return _facts(pdf=d.where("kind = 'pdf'"), word=d.where("kind = 'word'"), with_addresses=d.where("n > 0"), unreadable=d.where("n IS NULL"), incomplete=d.where("NOT complete"))


# ---- 7 to 9: what to look at, and what mustn't be there


def spot(s: Site) -> DataFrame:
    ids = s.rows([(i,) for i in s.spot], "id long")
    return _say(_not_in(ids, s.topics.select("id"), "id"), "no topic %d to look at", "id")


def spot_facts(s: Site) -> DataFrame:
    """Features of the chosen topics that source and page have in different numbers."""
    ids = s.rows([(i,) for i in s.spot], "topic_id long")
    raw = H.feature_counts(s.renderable.join(ids, "topic_id"), "topic_id", "cooked")
    page = H.feature_counts(s.shown.join(ids, "topic_id"), "topic_id", "body").withColumnRenamed("n", "m")
    both = raw.join(page, ["topic_id", "feature"], "full_outer").na.fill(0)
    return both.where("n <> m").select(F.concat(F.lit("topic "), "topic_id", F.lit(" "), "feature").alias("fact"), (F.col("m") - F.col("n")).alias("n"))


def boxes(s: Site) -> DataFrame:
    """Facts: boxes of foreign content, external links and images."""
    a = s.attributes.where("name = 'class'")
    of = lambda el, c: a.where((F.col("el") == el) & H.has_class(F.col("value"), c))
    out = lambda el, name: s.attributes.where((F.col("el") == el) & (F.col("name") == name) & (U.link_kind(U.split_url(F.col("value")), s.host) == "external"))
    return _facts(oneboxes=of("aside", "onebox"), inline_oneboxes=of("a", "inline-onebox"), videos=of("div", "lazyYT"), polls=of("div", "poll"), external_links=out("a", "href"), external_images=out("img", "src"))


def minimisation(s: Site) -> DataFrame:
    a = s.attributes
    inner = a.where(F.col("name").isin([x for x in U.URL_ATTRIBUTES if "srcset" not in x])).withColumn("u", U.split_url(F.col("value")))
    inner = inner.where(U.link_kind(F.col("u"), s.host) == "internal")
    path = U.resolve(F.col("u"), U.page_url(F.col("file")))["path"]
    bare = F.lower(F.regexp_replace("value", r"[\s\x00-\x1f]+", ""))
    el = s.pages.select("file", F.explode(F.transform(F.regexp_extract_all("html", F.lit(rf"(?i)<(script|{'|'.join(FORBIDDEN_ELEMENTS)})(?![\w-])"), F.lit(1)), F.lower)).alias("el"))
    low = F.lower("html")
    strings = s.pages.select("file", F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.regexp_count(low, F.lit(x)).alias("n")) for x in FORBIDDEN_STRINGS])).alias("f")).select("file", "f.x", "f.n").where("n > 0")
    parts = [
        a.where((F.col("el") == "img") & (F.col("name") == "class") & H.has_class(F.col("value"), "avatar")).select("file", F.lit("an avatar").alias("what"), F.lit(1).alias("n")),
        inner.where(U.first_segment(path).isin(U.PROFILE_DIRS)).select("file", F.lit("link to a user or group page").alias("what"), F.lit(1).alias("n")),
        a.where(F.col("name").isin(U.URL_ATTRIBUTES) & F.startswith(bare, F.lit("javascript:"))).select("file", F.lit("javascript: URL").alias("what"), F.lit(1).alias("n")),
        a.where(F.startswith(F.col("name"), F.lit("data-")) & ~F.col("name").isin(DATA_ATTRIBUTES)).select("file", F.concat(F.lit("attribute "), "name").alias("what"), F.lit(1).alias("n")),
        a.where(F.col("name").rlike("^on[a-z]+$")).select("file", F.concat(F.lit("event handler "), "name").alias("what"), F.lit(1).alias("n")),
        el.where(~((F.col("el") == "script") & F.col("file").isin(WIDGET_PAGES))).select("file", F.concat(F.lit("<"), "el", F.lit(">")).alias("what"), F.lit(1).alias("n")),
        strings.select("file", F.concat(F.lit("the string "), "x").alias("what"), F.col("n").cast("int").alias("n")),
    ]
    return _say(_all(*parts).groupBy("file", "what").agg(F.sum("n").alias("n")), "%s: %s (%d)", "file", "what", "n")


# ---- 10 and 11: search index and redirects


def search(s: Site) -> DataFrame:
    want = s.wanted.select("file").unionByName(s.names(["index.html"])).distinct()
    n = want.agg(F.count(F.lit(1)).alias("want"))
    read = s.fragments.where("url IS NOT NULL").select("url", U.resolve(U.split_url(F.col("url")), F.lit("/"))["file"].alias("file"))
    have = s.fragments.agg(F.count(F.lit(1)).alias("have"))
    count = n.select("want", F.lit(s.page_count).cast("long").alias("have"))
    return _all(
        _say(count.where("have IS NULL"), "the search index tells no number of pages, but there are %d", "want"),
        _say(count.where("have <> want"), "the search index claims %d pages of %d", "have", "want"),
        _say(have.crossJoin(n).where("have <> want"), "%d pieces in the search index for %d pages", "have", "want"),
        _say(s.fragments.where("url IS NULL"), "unreadable piece of the search index: %s", "file"),
        _say(_not_in(read, s.pages, "file"), "the search index leads to %s, which is no page", "url"),
        _say(read.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "the search index has %s more than once", U.page_url(F.col("file"))),
        _say(_not_in(want, read, "file"), "the search index lacks %s", U.page_url(F.col("file"))),
    )


def redirects(s: Site) -> DataFrame:
    r = s.rules
    none = _not_in(s.names(["_redirects"]), s.texts, "file")
    full = r.where("n_words >= 2").withColumn("path", F.regexp_replace("dest", "#.*$", ""))
    static = full.where(~L.is_dynamic(F.col("source")))
    many = r.groupBy(L.is_dynamic(F.col("source")).alias("dyn")).agg(F.count(F.lit(1)).alias("n")).withColumn("most", F.when(F.col("dyn"), L.MOST_DYNAMIC).otherwise(L.MOST_STATIC)).where("n > most")
    urls = L.served_urls(s.files)
    home = urls.where("kind = 'page'").select("url")
    alias = static.withColumn("url", F.concat("source", F.lit("/"))).join(home, "url", "left_semi").where(F.col("path") != F.concat("source", F.lit("/")))
    shadow = static.select(F.col("source").alias("url")).join(urls.select("url"), "url", "left_semi").select(F.col("url").alias("source")).unionByName(alias.select("source")).distinct()
    dynamic = L.covered(full, urls.select("url").distinct()).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("url").alias("first"))
    to = full.where("path LIKE '/%'").select(F.col("path").alias("url")).distinct()
    again = to.join(static.select(F.col("source").alias("url")), "url", "left_semi").unionByName(L.covered(full, to).select("url")).distinct()
    need = s.wanted.select(U.page_url(F.col("file")).alias("path"))
    return _all(
        _say(none, "there is no %s", "file"),
        _say(r.where("n_words < 2"), "rule in line %d lacks a part", "line_no"),
        _say(many, "%d rules of a kind that may have %d", "n", "most"),
        _say(s.texts.where("file = '_redirects'").select(F.posexplode(F.split("text", "\n")).alias("k", "l")).where(F.octet_length("l") > L.MOST_CHARACTERS), "rule in line %d exceeds the length", F.col("k") + 1),
        _say(r.groupBy("source").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "more than one rule for %s", "source"),
        _say(shadow, "the rule for %s hides what is served there", "source"),
        _say(dynamic, "the pattern %s hides %d served addresses, for one %s", "source", "n", "first"),
        _say(again, "a rule leads to %s, which is redirected again", "url"),
        _say(_not_in(need, full, "path"), "no old address leads to %s", "path"),
    )


def audit(s: Site, ids: list[str] | None = None) -> DataFrame:
    """All rows of the audit, or those of some checks, each of them whole; what was persisted for it is freed, however it ends."""
    try:
        return run_checks(s.spark, [c for c in checks(s) if ids is None or c.id in ids])
    finally:
        s.release()


def checks(s: Site) -> list[Check]:
    """The seventeen rows of the audit."""
    nothing = lambda: s.rows([], "offender string")
    return [
        Check("1", "Pages", lambda: pages(s), facts=lambda: _facts(pages=s.pages, wanted=s.wanted)),
        Check("2", "Posts", lambda: posts(s), facts=lambda: post_facts(s)),
        Check("2b", "No word is lost", lambda: words(s)),
        Check("3", "Own host", lambda: host(s), facts=lambda: _facts(attributes=s.attributes.where("name IS NOT NULL"), canonical_links=_canonical(s))),
        Check("3b", "Own host in text", lambda: host_text(s), info=True),
        Check("4", "Internal links", lambda: links(s), facts=lambda: _facts(urls=_references(s), rules=s.rules)),
        Check("4b", "External URLs", nothing, info=True, facts=lambda: external(s)),
        Check("5", "Assets", lambda: assets(s), facts=lambda: s.assets.groupBy(asset_kind(F.col("file")).alias("fact")).agg(F.count(F.lit(1)).alias("n"))),
        Check("6a", "Personal data", lambda: personal(s), facts=lambda: _kinds(s)),
        Check("6b", "Redaction inventory", nothing, info=True, facts=lambda: inventory(s)),
        # nothing to search for is no pass
        Check("6c", "Unredacted values", lambda: verbatim(s), info=s.verbatim is None or _values(s).isEmpty(), facts=lambda: _facts(values=_values(s))),
        Check("6d", "Attachments", nothing, info=True, facts=lambda: attachments(s)),
        Check("7", "Spot-check", lambda: spot(s), info=True, may_fail=True, facts=lambda: spot_facts(s)),
        Check("8", "Boxes and external content", nothing, info=True, facts=lambda: boxes(s)),
        Check("9", "Data minimisation", lambda: minimisation(s)),
        Check("10", "Search index", lambda: search(s)),
        Check("11", "Redirects", lambda: redirects(s)),
    ]
