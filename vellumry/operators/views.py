"""Nested views of a site and its pages: what a home page, a category, a topic and a post show.

Inputs: categories (id, parent_id, slug, name, position, description, about_topic_id, path: URL), topics (id, category_id, slug, title, pinned,
closed, archived, tags array, created_at, last_posted_at, n_posts), posts (topic_id, number, username, name, created_at, reply_to, body: clean).
Missing texts are empty, missing flags false, a missing activity is the earliest. Ties go to the smaller id (rows of a category: the larger).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumry.functions.text import day_and_minute, display_name, escape_html, iso, label_count, parse_utc
from vellumry.operators.hierarchy import paths


def _or_empty(c: str) -> Column:
    return F.coalesce(c, F.lit(""))


def counted(categories: DataFrame, topics: DataFrame) -> DataFrame:
    """categories with n: their own topics but for their about topic, if that is their own."""
    own = topics.select(F.col("category_id").alias("id"), F.col("id").alias("topic"))
    n = own.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    about = categories.select("id", F.col("about_topic_id").alias("topic")).join(own, ["id", "topic"], "left_semi").select("id", F.lit(1).alias("_a"))
    joined = categories.join(n, "id", "left").join(about, "id", "left")
    return joined.withColumn("n", F.coalesce("_n", F.lit(0)) - F.coalesce("_a", F.lit(0))).drop("_n", "_a")


def entry(n: str = "n") -> Column:
    """Category entry: name, path, label of its number of topics, description and whether it has one."""
    d = _or_empty("description")
    return F.struct(F.col("name"), F.col("path"), label_count(F.col(n), "topic", "topics").alias("topic_count_label"), (d != "").alias("has_description"), d.alias("description"))


def children(counted_: DataFrame) -> DataFrame:
    """(id of the parent, entries of its categories by position and id)."""
    k = counted_.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("id"), F.struct("position", F.col("id").alias("_i"), entry().alias("e")).alias("x"))
    return k.groupBy("id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["e"]).alias("children"))


def home(categories: DataFrame, topics: DataFrame, conference: str) -> DataFrame:
    """(ord, id, entry, has_children, children) of the top categories: conferences (slugs of the word and a year) by year, latest first, then the others in the forum's order."""
    c = counted(categories, topics)
    year = F.nullif(F.regexp_extract("slug", f"^{conference}([0-9]{{4}})$", 1), F.lit("")).cast("int")
    tops = c.where("parent_id IS NULL").join(children(c), "id", "left").withColumn("year", year)
    from pyspark.sql import Window

    order = Window.orderBy(F.col("year").isNull(), F.desc("year"), "position", "id")  # a site's top categories are few
    none = F.array().cast(children(c).schema["children"].dataType)
    return tops.select(F.row_number().over(order).alias("ord"), "id", entry().alias("entry"), F.col("children").isNotNull().alias("has_children"), F.coalesce("children", none).alias("children"))


def crumbs(categories: DataFrame) -> DataFrame:
    """(id, crumbs array<struct(name, path)>) from the root down, at any depth."""
    marked = categories.select("id", "parent_id", F.to_json(F.struct("name", "path")).alias("slug"))
    chain = paths(marked, separator="\u001f")
    one = lambda x: F.from_json(x, "name string, path string")
    return chain.select("id", F.transform(F.split("path", "\u001f"), one).alias("crumbs"))


def activity(topics: DataFrame) -> DataFrame:
    """topics with active (the last post's time, else the creation's, else the earliest time) and its text."""
    at = F.coalesce(parse_utc(F.col("last_posted_at"))["at"], parse_utc(F.col("created_at"))["at"])
    return topics.withColumn("active", F.coalesce(at, F.timestamp_seconds(F.lit(0)))).withColumn("activity", F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit("")))


def rows(topics: DataFrame) -> DataFrame:
    """(category_id, ord, path, title, pinned, tags, replies, created, activity): pinned first, then latest activity, then highest id."""
    from pyspark.sql import Window

    t = activity(topics).withColumn("pinned", F.coalesce("pinned", F.lit(False)))
    order = Window.partitionBy("category_id").orderBy(F.desc("pinned"), F.desc("active"), F.desc("id"))
    return t.select(
        "category_id", F.row_number().over(order).alias("ord"), topic_url().alias("path"), _or_empty("title").alias("title"), "pinned",
        F.array_join(F.coalesce("tags", F.array().cast("array<string>")), ", ").alias("tags"), F.greatest(F.coalesce("n_posts", F.lit(0)) - 1, F.lit(0)).cast("string").alias("replies"),
        F.coalesce(F.date_format(parse_utc(F.col("created_at"))["at"], "yyyy-MM-dd"), F.lit("")).alias("created"), "activity",
    )


def category(categories: DataFrame, topics: DataFrame) -> DataFrame:
    """(id, name, crumbs, description, has_subcategories, subcategories, has_topics)."""
    c = counted(categories, topics)
    has = topics.select(F.col("category_id").alias("id")).distinct().withColumn("_t", F.lit(True))
    out = c.join(crumbs(categories), "id", "left").join(children(c), "id", "left").join(has, "id", "left")
    return out.select("id", "name", "crumbs", _or_empty("description").alias("description"), F.col("children").isNotNull().alias("has_subcategories"), F.col("children").alias("subcategories"), F.col("_t").isNotNull().alias("has_topics"))


def status(closed: str = "closed", archived: str = "archived") -> Column:
    """What a closed or archived topic says of itself."""
    parts = F.array_compact(F.array(F.when(F.col(closed), "closed"), F.when(F.col(archived), "archived")))
    return F.when(F.size(parts) == 0, "").otherwise(F.concat(F.lit("This topic was "), F.array_join(parts, " and "), F.lit(" on the original forum.")))


def topic_url() -> Column:
    return F.concat(F.lit("/t/"), "slug", F.lit("/"), "id", F.lit("/"))


def topic(topics: DataFrame, categories: DataFrame) -> DataFrame:
    """(id, title, crumbs, has_tags, tags array<struct(name, comma)>, has_status, status); a topic of no known category has no crumbs."""
    t = topics.join(crumbs(categories).withColumnRenamed("id", "category_id"), "category_id", "left")
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    named = F.transform(tags, lambda x, i: F.struct(x.alias("name"), (i < F.size(tags) - 1).alias("comma")))
    return t.select("id", _or_empty("title").alias("title"), "crumbs", (F.size(tags) > 0).alias("has_tags"), named.alias("tags"), (status() != "").alias("has_status"), status().alias("status"))


def post(posts: DataFrame) -> DataFrame:
    """(topic_id, number, display_name, handle, both, iso, when, has_reply_to, reply_to, body): a reply is named if its post is another one of the topic."""
    other = posts.select("topic_id", F.col("number").alias("reply_to"), F.lit(True).alias("_there")).distinct()
    p = posts.join(other, ["topic_id", "reply_to"], "left")
    name, user, at = display_name(F.col("name"), F.col("username")), _or_empty("username"), parse_utc(F.col("created_at"))["at"]
    reply = F.coalesce(F.col("_there") & (F.col("reply_to") != F.col("number")), F.lit(False))
    return p.select(
        "topic_id", "number", name.alias("display_name"), F.when(user != "", F.concat(F.lit("@"), user)).otherwise("").alias("handle"), ((name != "") & (user != "")).alias("both"),
        F.coalesce(iso(at), F.lit("")).alias("iso"), F.coalesce(day_and_minute(at), F.col("created_at"), F.lit("")).alias("when"), reply.alias("has_reply_to"),
        F.coalesce(F.col("reply_to").cast("string"), F.lit("")).alias("reply_to"), _or_empty("body").alias("body"),
    )


def layout(pages: DataFrame, site: DataFrame, host: str) -> DataFrame:
    """pages (file, kind, title, description, content, noindex) with the fields of the base layout; site has one row (title, logo, favicon, apple_touch_icon)."""
    s = site.select(F.col("title").alias("site_title"), "logo", "favicon", "apple_touch_icon")
    from vellumry.functions.urls import page_url

    canonical = F.when(~F.coalesce("noindex", F.lit(False)), F.concat(F.lit(f"https://{host}"), page_url(F.col("file"))))
    return pages.crossJoin(s).withColumn("canonical", canonical)  # one row


def _text(c: str) -> Column:
    return escape_html(F.coalesce(F.col(c).cast("string"), F.lit("")), attribute=True)


def post_html() -> Column:
    """One post as an article, from the columns of post()."""
    name = F.when(F.col("display_name") != "", F.concat(F.lit('<span class="author-name">'), _text("display_name"), F.lit("</span>"))).otherwise("")
    handle = F.when(F.col("handle") != "", F.concat(F.lit('<span class="author-handle">'), _text("handle"), F.lit("</span>"))).otherwise("")
    reply = F.when(F.col("has_reply_to"), F.concat(F.lit('<a class="reply-to" href="#post-'), _text("reply_to"), F.lit('">in reply to post '), _text("reply_to"), F.lit("</a>"))).otherwise("")
    return F.concat(
        F.lit('<article class="post" id="post-'), F.col("number").cast("string"), F.lit('"><header>'), name, handle, F.lit('<time datetime="'), _text("iso"), F.lit('">'), _text("when"), F.lit("</time>"), reply,
        F.lit('</header><div class="post-body">'), F.col("body"), F.lit("</div></article>"),
    )


def topic_pages(topics: DataFrame, posts: DataFrame) -> DataFrame:
    """(file, html): the content of each topic's page, its posts in order; a topic without posts has its title alone.

    A topic's page is one text, so its posts are gathered in one row.
    """
    p = post(posts).select(F.col("topic_id").alias("id"), F.struct("number", post_html().alias("h")).alias("x"))
    body = p.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["h"]), "\n").alias("posts"))
    t = topics.join(body, "id", "left")
    html = F.concat(F.lit("<h1>"), _text("title"), F.lit("</h1>\n"), F.coalesce("posts", F.lit("")))
    return t.select(F.concat(F.lit("t/"), "slug", F.lit("/"), "id", F.lit("/index.html")).alias("file"), html.alias("html"))


def base_page() -> Column:
    """A whole page from the columns of layout()."""
    link = lambda rel, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f'<link rel="{rel}" href="'), _text(c), F.lit('">'))).otherwise("")
    meta = F.when(F.coalesce(F.col("description"), F.lit("")) != "", F.concat(F.lit('<meta name="description" content="'), _text("description"), F.lit('">'))).otherwise("")
    robots = F.when(F.coalesce("noindex", F.lit(False)), '<meta name="robots" content="noindex">').otherwise("")
    return F.concat(
        F.lit('<!DOCTYPE html>\n<html lang="en"><head><meta charset="utf-8"><title>'), _text("title"), F.lit("</title>"), meta, robots, link("canonical", "canonical"), link("icon", "favicon"), link("apple-touch-icon", "apple_touch_icon"),
        F.lit('</head><body class="'), _text("kind"), F.lit('"><header><a href="/">'), _text("site_title"), F.lit("</a></header><main>"), F.coalesce("content", F.lit("")), F.lit("</main></body></html>\n"),
    )
