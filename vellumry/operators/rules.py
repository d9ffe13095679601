"""Redirect rules of a site: generation in five groups, rendering, parsing and checks.

Tables: topics (id long, slug), posts (topic_id long, number long), rendered (topic_id long,
number long: what the built pages show), categories (id long, parent_id long, slug, path:
slugs from the root), pages and files as (file): relative paths below the site.

Nulls: a topic or category without id or slug has no rules. Repeated rows give repeated
rules, which check() reports. Empty tables give no rules, but for the fixed groups.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumry.functions.urls import glob_regex, hrefs, link_kind, page_url, segments, split_url

# What the host of the rules accepts, the shapes of sources and destinations, the groups' names, pages
# of the live site that lead home, and what is below which a whole branch leads home.
MOST_STATIC, MOST_DYNAMIC, MOST_CHARACTERS = 2000, 100, 1000
STATUSES = ["301", "302", "303", "307", "308"]
WORD = "[A-Za-z0-9._~-]+"
GROUPS = ["site pages", "topics and posts", "categories", "stale topic slugs", "user, group, tag and badge pages (dynamic)"]
HOME_PAGES = "latest categories top new unread posts about faq guidelines tos privacy tags badges directory groups users".split()
SPLAT_PAGES = "u users g groups tag tags badges".split()


def is_dynamic(source: Column) -> Column:
    return source.rlike("[*:]")


def _address(*parts: Column | str) -> Column:
    return F.concat_ws("/", F.lit(""), *parts)


def _rules(df: DataFrame, group: int, order: Sequence[Column | str], source: Column, dest: Column) -> DataFrame:
    return df.select(F.lit(group).alias("grp"), F.struct(*order).cast("string").alias("ord"), source.alias("source"), dest.alias("dest"))


def site_rules(spark: SparkSession) -> DataFrame:
    """Group 1: pages without a counterpart lead home, the search page to its own."""
    rows = [(1, f"{k:04d}", f"/{p}", "/") for k, p in enumerate(HOME_PAGES)] + [(1, "9999", "/search", "/search/")]
    return spark.createDataFrame(rows, "grp int, ord string, source string, dest string")


def topic_rules(topics: DataFrame, posts: DataFrame, rendered: DataFrame) -> DataFrame:
    """Group 2: slug and id, id, slug alone (unless it is shared or a number), and one rule for every post number; from the second post on
    its fragment is in the destination if the page shows the post."""
    t = topics.where("id IS NOT NULL AND slug IS NOT NULL").select("id", "slug", F.concat(_address(F.lit("t"), "slug", "id"), F.lit("/")).alias("page"))
    alone = t.groupBy("slug").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") == 1) & ~F.col("slug").rlike("^[0-9]+$")).select("slug")
    shown = rendered.select(F.col("topic_id").alias("id"), "number").where("number >= 2").distinct().withColumn("shown", F.lit(True))
    of_posts = t.join(posts.select(F.col("topic_id").alias("id"), "number").where("number IS NOT NULL"), "id").join(shown, ["id", "number"], "left")
    at = F.when(F.col("shown"), F.concat("page", F.lit("#post-"), "number")).otherwise(F.col("page"))
    parts = [
        _rules(t, 2, [F.lpad(F.col("id").cast("string"), 19, "0"), F.lit("0")], _address(F.lit("t"), "slug", "id"), F.col("page")),
        _rules(t, 2, [F.lpad(F.col("id").cast("string"), 19, "0"), F.lit("1")], _address(F.lit("t"), "id"), F.col("page")),
        _rules(t.join(alone, "slug"), 2, [F.lpad(F.col("id").cast("string"), 19, "0"), F.lit("2")], _address(F.lit("t"), "slug"), F.col("page")),
        _rules(of_posts, 2, [F.lpad(F.col("id").cast("string"), 19, "0"), F.lit("3"), F.lpad(F.col("number").cast("string"), 19, "0")], _address(F.lit("t"), "slug", "id", "number"), at),
    ]
    return reduce(DataFrame.unionByName, parts)


def category_rules(categories: DataFrame) -> DataFrame:
    """Group 3: id, path, path and id, and for a category below another slug and id, to path and id."""
    k = categories.where("id IS NOT NULL AND path IS NOT NULL")
    page = F.concat(_address(F.lit("c"), "path", "id"), F.lit("/"))
    forms = [_address(F.lit("c"), "id"), _address(F.lit("c"), "path"), _address(F.lit("c"), "path", "id"), F.when(F.col("parent_id").isNotNull(), _address(F.lit("c"), "slug", "id"))]
    made = k.select("id", page.alias("page"), F.posexplode(F.array(*forms)).alias("form", "source")).where("source IS NOT NULL")
    return _rules(made, 3, [F.lpad(F.col("id").cast("string"), 19, "0"), "form"], F.col("source"), F.col("page"))


def topic_links(links: DataFrame, own: str, topics: DataFrame) -> DataFrame:
    """links (href, ...) -> the same with (slug, id) that the link names: /t/{slug}/{id}[/{n}], and of two numbers slug and id only if the topic has that slug."""
    u = F.col("_u")
    inside = (link_kind(u, own) == "internal") & ((u["scheme"] != "") | u["has_auth"] | F.startswith(u["path"], F.lit("/")))
    s = links.withColumn("_u", split_url(F.col("href"))).withColumn("_s", F.when(inside, segments(u["path"]))).drop("_u")
    number = lambda i: F.get("_s", F.lit(i)).rlike("^[0-9]{1,18}$")
    long = F.when(number(2) & ((F.size("_s") == 3) | ((F.size("_s") == 4) & number(3))), F.get("_s", F.lit(2)).cast("long"))
    s = s.where(F.get("_s", F.lit(0)) == "t").withColumn("slug", F.get("_s", F.lit(1))).withColumn("id", long).where("id IS NOT NULL")
    known = topics.select(F.col("id").alias("id"), F.col("slug").alias("real")).where("id IS NOT NULL").distinct()
    s = s.join(known, "id").where(~(number(1) & (F.size("_s") == 3)) | (F.col("slug") == F.col("real")))
    return s.drop("_s")


def stale_rules(links: DataFrame, own: str, topics: DataFrame) -> DataFrame:
    """Group 4: slugs in links that aren't their topic's own, one rule for each pair; slugs that can't be in a rule are left out (stale_unusable)."""
    old = _stale(links, own, topics).where(F.col("slug").rlike(f"^{WORD}$"))
    return _rules(old, 4, [F.lpad(F.col("id").cast("string"), 19, "0"), "slug"], _address(F.lit("t"), "slug", "id"), F.concat(_address(F.lit("t"), "real", "id"), F.lit("/")))


def stale_unusable(links: DataFrame, own: str, topics: DataFrame) -> DataFrame:
    """(id, slug) of stale slugs with other characters than a rule may have."""
    return _stale(links, own, topics).where(~F.col("slug").rlike(f"^{WORD}$")).select("id", "slug")


def _stale(links: DataFrame, own: str, topics: DataFrame) -> DataFrame:
    return topic_links(links, own, topics).where("slug <> real").select("id", "slug", "real").distinct()


def splat_rules(spark: SparkSession) -> DataFrame:
    """Group 5, the dynamic rules: whole branches lead home."""
    return spark.createDataFrame([(5, f"{k:04d}", f"/{p}/*", "/") for k, p in enumerate(SPLAT_PAGES)], "grp int, ord string, source string, dest string")


def all_rules(spark: SparkSession, topics: DataFrame, posts: DataFrame, rendered: DataFrame, categories: DataFrame, links: DataFrame, own: str) -> DataFrame:
    """(grp, ord, source, dest) of all five groups; grp and ord give the order of the file."""
    made = [site_rules(spark), topic_rules(topics, posts, rendered), category_rules(categories), stale_rules(links, own, topics), splat_rules(spark)]
    return reduce(DataFrame.unionByName, made)


def links_of(posts: DataFrame, html: str) -> DataFrame:
    """(href) of the links in posts' bodies."""
    return posts.select(F.explode(hrefs(F.col(html))).alias("href"))


def anchors_of(pages: DataFrame, html: str) -> DataFrame:
    """pages (file, html) -> (file, number) of the posts that a page shows, by its own markup."""
    found = F.regexp_extract_all(F.col(html), F.lit('<article class="post" id="post-([0-9]{1,18})">'), F.lit(1))
    return pages.select("file", F.explode(found).alias("number")).select("file", F.col("number").cast("long").alias("number"))


def misfit_anchors(anchors: DataFrame, topics: DataFrame, posts: DataFrame) -> DataFrame:
    """(file, number): posts that a topic's page shows and the source doesn't have, and (file, null) of topic pages that show none."""
    page = topics.select("id", F.concat(F.lit("t/"), "slug", F.lit("/"), "id", F.lit("/index.html")).alias("file"))
    on = anchors.join(page, "file").select("file", F.col("id").alias("topic_id"), "number")
    return on.join(posts.select("topic_id", "number"), ["topic_id", "number"], "left_anti").select("file", "number").distinct()


def render(rules: DataFrame, status: int = 301) -> DataFrame:
    """(grp, ord, line): a header with the counts of each group, then each group's rules in order."""
    line = rules.select("grp", F.concat(F.lit("1"), "ord").alias("ord"), F.format_string("%s %s %d", "source", "dest", F.lit(status)).alias("line"))
    name = F.element_at(F.array(*map(F.lit, GROUPS)), F.col("grp"))
    head = rules.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).select("grp", F.lit("0").alias("ord"), F.format_string("# %d %s: %d", "grp", name, "n").alias("line"))
    return head.unionByName(line)


def parse(text: DataFrame, column: str, *keys: str) -> DataFrame:
    """Rules of texts: (keys, line_no, line, source, dest, status, n_words); blank lines and # comments are left out."""
    lines = text.select(*keys, F.posexplode(F.split(column, "\n")).alias("k", "raw")).withColumn("line", F.btrim("raw", F.lit(" \t\r")))
    words = F.split("line", r"[ \t]+")
    kept = lines.where("line <> '' AND line NOT LIKE '#%'")
    return kept.select(
        *keys, (F.col("k") + 1).alias("line_no"), F.rtrim("raw", F.lit("\r")).alias("line"), F.get(words, F.lit(0)).alias("source"), F.get(words, F.lit(1)).alias("dest"),
        F.get(words, F.lit(2)).alias("status"), F.size(words).alias("n_words"),
    )


def served_urls(files: DataFrame) -> DataFrame:
    """files (file) -> (url, kind): what the site answers without a redirect. kind file: a file at its own path, x.html at /x too; kind page: x/index.html at /x/."""
    index = F.col("file").rlike("(^|/)index\\.html$")
    clean = F.when(F.endswith(F.col("file"), F.lit(".html")) & ~index, F.concat(F.lit("/"), F.regexp_replace("file", "\\.html$", "")))
    forms = F.array(
        F.struct(F.concat(F.lit("/"), "file").alias("url"), F.lit("file").alias("kind")),
        F.struct(clean.alias("url"), F.lit("file").alias("kind")),
        F.struct(F.when(index, page_url(F.col("file"))).alias("url"), F.lit("page").alias("kind")),
    )
    return files.where("file IS NOT NULL").select(F.explode(forms).alias("x")).select("x.*").where("url IS NOT NULL").distinct()


def under_prefix(urls: DataFrame, url: str, prefixes: DataFrame, sizes: list[int] | None = None) -> DataFrame:
    """urls with a column prefix: every prefix (of the table prefixes) that the URL begins with, one row each.

    A theta join as an equi-join: a URL has one row for each length that a prefix has. `sizes`: these lengths, where they are known.
    """
    if sizes is None:
        sizes = sorted(r.n for r in prefixes.select(F.length("prefix").alias("n")).distinct().collect())
    if not sizes:
        return urls.withColumn("prefix", F.lit(None).cast("string")).limit(0)
    heads = F.array(*[F.when(F.length(url) >= n, F.substring(url, 1, n)) for n in sizes])
    return urls.withColumn("prefix", F.explode(F.array_compact(heads))).join(prefixes.select("prefix").distinct(), "prefix")


def covered(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """urls (url) that a dynamic rule matches: (url, source).

    The longest literal text of a source narrows the URLs to be tried: what it starts with, what it ends with, or the
    literal start of one of its segments, each by an equi-join. The whole pattern decides. However many rules there are, each is
    tried; one that names nothing but slashes and wildcards is tried on every URL, as it matches most.
    """
    text = F.split("source", r":[A-Za-z_]\w*|\*")
    inner = F.flatten(F.transform(text, lambda p: F.slice(F.split(p, "/"), F.lit(2), F.size(F.split(p, "/")))))
    way = lambda name, key: F.struct(F.length(key).alias("n"), F.lit(name).alias("way"), key.alias("key"))
    ways = [way("start", F.get(text, F.lit(0))), way("end", F.reverse(F.element_at(text, -1))), way("segment", F.coalesce(F.array_max(F.transform(inner, lambda x: F.struct(F.length(x).alias("n"), x.alias("s"))))["s"], F.lit("")))]
    dynamic = rules.where(is_dynamic(F.col("source"))).select("source").distinct()
    dynamic = dynamic.select("source", glob_regex(F.col("source")).alias("_re"), F.greatest(*ways).alias("_w"))
    dynamic = dynamic.select("source", "_re", F.col("_w.way").alias("way"), F.col("_w.key").alias("prefix"))
    sizes: dict[str, list[int]] = {}
    for r in dynamic.select("way", F.length("prefix").alias("n")).distinct().collect():
        sizes.setdefault(r.way, []).append(r.n)
    one = urls.select("url").where("url IS NOT NULL").distinct()
    seen = {"start": F.col("url"), "end": F.reverse("url"), "segment": F.explode(F.array_distinct(F.split("url", "/")))}
    met = [
        under_prefix(one.withColumn("_seen", seen[w]), "_seen", mine := dynamic.where(F.col("way") == w), sorted(n)).join(mine, "prefix").where("url RLIKE _re").select("url", "source")
        for w, n in sorted(sizes.items())
    ]
    if not met:
        return one.withColumn("source", F.lit(None).cast("string")).limit(0)
    return urls.join(reduce(DataFrame.unionByName, met).distinct(), "url").select("url", "source")


def _flag(df: DataFrame, problem: str, what: Column | str) -> DataFrame:
    return df.select(F.lit(problem).alias("problem"), (F.col(what) if isinstance(what, str) else what).cast("string").alias("what"))


def check(rules: DataFrame, files: DataFrame, anchors: DataFrame) -> DataFrame:
    """(problem, what), one row for each fault of parsed rules (line_no, line, source, dest, status) on a site of files (file) whose pages hold anchors (file, number).

    Limits, characters, shapes, statuses, repeated sources, destinations and fragments that aren't there, loops (a destination
    that is a source or below a splat), static sources below a splat, and sources that shadow what the site serves.
    """
    path = F.regexp_replace("dest", "#.*$", "")
    r = rules.withColumn("path", path).withColumn("dynamic", is_dynamic(F.col("source")))
    static = r.where("NOT dynamic")
    splat = r.where("dynamic").select(F.regexp_replace("source", r"\*$", "").alias("prefix"), "source")
    word = rf"(?:{WORD}/)*"
    urls = served_urls(files)
    pages = urls.where("kind = 'page'").select("url")
    kind = F.when(F.col("dynamic"), "dynamic").otherwise("static")
    most = F.when(F.col("kind") == "dynamic", MOST_DYNAMIC).otherwise(MOST_STATIC)
    to_page = r.join(pages.select(F.col("url").alias("path")), "path", "left_semi")
    wanted = F.regexp_extract("dest", r"#post-([0-9]{1,18})$", 1)
    shown = anchors.select(page_url(F.col("file")).alias("path"), F.col("number").cast("string").alias("number"))
    places = r.select(F.col("path").alias("url")).distinct()
    alias = static.withColumn("url", F.concat("source", F.lit("/"))).join(pages, "url", "left_semi").where(F.col("path") != F.concat("source", F.lit("/")))
    faults = [
        _flag(r.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most), "too many", "kind"),
        _flag(r.where(F.octet_length("line") > MOST_CHARACTERS), "long line", "line_no"),
        _flag(r.where(F.col("line").rlike(r"[^\x20-\x7e]")), "characters", "line_no"),
        _flag(r.where(F.coalesce(~F.col("status").isin(STATUSES), F.lit(True))), "status", "line_no"),
        _flag(r.where(~F.col("source").rlike(rf"^/{word}(?:{WORD})$") & ~F.col("dynamic") | F.col("dynamic") & ~F.col("source").rlike(rf"^/(?:{WORD}/)+\*$")), "source shape", "source"),
        _flag(r.where(F.coalesce(~F.col("dest").rlike(rf"^/{word}(?:#post-[0-9]+)?$"), F.lit(True))), "destination shape", F.coalesce("dest", "source")),
        _flag(r.groupBy("source").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated source", "source"),
        _flag(r.join(pages.select(F.col("url").alias("path")), "path", "left_anti").where("path IS NOT NULL").select("path").distinct(), "no such page", "path"),
        _flag(to_page.where(F.col("dest").contains("#")).withColumn("number", wanted).join(shown, ["path", "number"], "left_anti"), "no such post", "dest"),
        _flag(places.join(r.select(F.col("source").alias("url")), "url", "left_semi").unionByName(under_prefix(places, "url", splat).select("url")).distinct(), "loop", "url"),
        _flag(under_prefix(static.select("source"), "source", splat).select("source").distinct(), "static below dynamic", "source"),
        _flag(static.join(urls.where("kind = 'file'").select(F.col("url").alias("source")), "source", "left_semi").select("source").unionByName(alias.select("source")).distinct(), "shadow", "source"),
        _flag(under_prefix(urls.select("url"), "url", splat).select("prefix").distinct().join(splat, "prefix").select("source").distinct(), "dynamic shadow", "source"),
    ]
    return reduce(DataFrame.unionByName, faults)
