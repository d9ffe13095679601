"""The pages of a site out of its views and templates: home, categories, topics, search and the page of what isn't found.

Each kind has a template that sees the columns of its data (``home_data`` ...), and ``base`` sees those of the layout with the page as content. Inputs as in
operators/views; site has one row (title, description, logo, favicon, apple_touch_icon, snapshot, version). A page is one text, so what it
shows is one row: a topic's posts, a category's topics. Null texts are empty; a category or topic without path, slug or id has no page.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.functions.urls import page_url
from vellumry.operators import views as V
from vellumry.operators.templates import render

KINDS = ("home", "category", "topic", "search", "not_found")

TEMPLATES = {
    "base": """<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><title>{{page_title}}</title>
{{#description}}<meta name="description" content="{{description}}">{{/description}}
{{#noindex}}<meta name="robots" content="noindex">{{/noindex}}{{^noindex}}<link rel="canonical" href="{{canonical}}">{{/noindex}}
{{#favicon}}<link rel="icon" href="{{favicon}}">{{/favicon}}{{#apple_touch_icon}}<link rel="apple-touch-icon" href="{{apple_touch_icon}}">{{/apple_touch_icon}}
<link rel="stylesheet" href="/archive.css"></head>
<body class="{{kind}}"><header><a href="/">{{#logo}}<img src="{{logo}}" alt="">{{/logo}}{{site_title}}</a> <a href="/search/">Search</a></header>
<main>
{{{content}}}
</main><footer>As of {{snapshot}}{{#version}}, {{version}}{{/version}}</footer></body></html>
""",
    "home": """<h1>{{site_title}}</h1>
{{#site_description}}
<p>{{site_description}}</p>
{{/site_description}}
<ul>
{{#categories}}
<li>{{>entry}}
{{#has_children}}
<ul>{{#children}}<li>{{>entry}}</li>{{/children}}</ul>
{{/has_children}}
</li>
{{/categories}}
</ul>""",
    "category": """<nav>{{#crumbs}}{{#linked}}<a href="{{path}}">{{name}}</a> / {{/linked}}{{^linked}}{{name}}{{/linked}}{{/crumbs}}</nav>
<h1>{{name}}</h1>
{{#description}}
<p>{{description}}</p>
{{/description}}
{{#has_subcategories}}
<ul>{{#subcategories}}<li>{{>entry}}</li>{{/subcategories}}</ul>
{{/has_subcategories}}
{{#has_topics}}
<table>
{{#topics}}
<tr><td><a href="{{path}}">{{title}}</a>{{#pinned}} (pinned){{/pinned}}</td><td>{{tags}}</td><td>{{replies}}</td><td>{{created}}</td><td>{{activity}}</td></tr>
{{/topics}}
</table>
{{/has_topics}}
{{^has_topics}}
<p>No topics.</p>
{{/has_topics}}""",
    "topic": """<nav>{{#crumbs}}<a href="{{path}}">{{name}}</a> / {{/crumbs}}</nav>
<h1>{{title}}</h1>
{{#has_tags}}
<p>{{#tags}}{{name}}{{#comma}}, {{/comma}}{{/tags}}</p>
{{/has_tags}}
{{#has_status}}
<p role="note">{{status}}</p>
{{/has_status}}
{{#posts}}
<article class="post" id="post-{{number}}"><header>{{display_name}}{{#both}} {{/both}}{{handle}} <time datetime="{{iso}}">{{when}}</time>{{#has_reply_to}} <a href="#post-{{reply_to}}">to {{reply_to}}</a>{{/has_reply_to}}</header>
<div class="post-body">{{{body}}}</div></article>
{{/posts}}""",
    "search": """<h1>Search {{site_title}}</h1>
<div id="search"></div>""",
    "not_found": """<h1>Not found</h1>
<p>There is no such page here. <a href="/">Home</a></p>""",
}
PARTIALS = {"entry": '<a href="{{path}}">{{name}}</a> {{topic_count_label}}{{#has_description}}: {{description}}{{/has_description}}'}


def home_data(site: DataFrame, categories: DataFrame, topics: DataFrame, conference: str = "conf") -> DataFrame:
    """One row: site_title, site_description, categories (entries with has_children and children, in order)."""
    one = F.struct("ord", F.struct("entry.*", "has_children", "children").alias("e"))
    tops = V.home(categories, topics, conference).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["e"]).alias("categories"))
    return site.select(F.col("title").alias("site_title"), F.col("description").alias("site_description")).crossJoin(tops)  # one row each


def category_data(categories: DataFrame, topics: DataFrame) -> DataFrame:
    """The columns of views.category with each crumb's linked (all but the last) and the category's topics, in order."""
    one = F.struct("ord", F.struct("path", "title", "pinned", "tags", "replies", "created", "activity").alias("t"))
    listed = V.rows(topics).groupBy(F.col("category_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["t"]).alias("topics"))
    crumbs = F.transform("crumbs", lambda c, i: F.struct(c["name"].alias("name"), c["path"].alias("path"), (i < F.size("crumbs") - 1).alias("linked")))
    return V.category(categories, topics).join(listed, "id", "left").withColumn("crumbs", crumbs)


def topic_data(topics: DataFrame, categories: DataFrame, posts: DataFrame) -> DataFrame:
    """The columns of views.topic and the topic's posts by number."""
    p = V.post(posts)
    one = F.struct("number", F.struct(*[c for c in p.columns if c != "topic_id"]).alias("p"))
    shown = p.groupBy(F.col("topic_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["p"]).alias("posts"))
    return V.topic(topics, categories).join(shown, "id", "left")


def contents(site: DataFrame, categories: DataFrame, topics: DataFrame, posts: DataFrame, templates: dict[str, str], partials: dict[str, str], conference: str = "conf") -> DataFrame:
    """(file, kind, title, description, noindex, content) of every page, without the base; title is the page's own, null for home."""
    text = lambda x: F.lit(x).cast("string")

    def page(df: DataFrame, kind: str, file, title, description, noindex: bool = False) -> DataFrame:
        done = render(df, templates[kind], "_content", partials)
        return done.select(file.alias("file"), F.lit(kind).alias("kind"), title.alias("title"), description.alias("description"), F.lit(noindex).alias("noindex"), F.col("_content").alias("content"))

    paths = categories.select("id", F.col("path").alias("_path"))
    named = site.select(F.col("title").alias("site_title"))
    slugs = topics.select("id", F.concat(F.lit("t/"), "slug", F.lit("/"), "id", F.lit("/index.html")).alias("_file"))
    parts = [
        page(home_data(site, categories, topics, conference), "home", F.lit("index.html"), text(None), F.col("site_description")),
        page(category_data(categories, topics).join(paths, "id"), "category", F.concat(F.regexp_replace("_path", "^/|/$", ""), F.lit("/index.html")), F.col("name"), F.col("description")),
        page(topic_data(topics, categories, posts).join(slugs, "id"), "topic", F.col("_file"), F.col("title"), text(None)),
        page(named, "search", F.lit("search/index.html"), F.lit("Search"), text(None)),
        page(named, "not_found", F.lit("404.html"), F.lit("Page not found"), text(None), True),
    ]
    return reduce(DataFrame.unionByName, parts).where("file IS NOT NULL")


def site_pages(
    site: DataFrame, categories: DataFrame, topics: DataFrame, posts: DataFrame, host: str, templates: dict[str, str] | None = None, partials: dict[str, str] | None = None, conference: str = "conf"
) -> DataFrame:
    """(file, kind, html): all pages. templates: KINDS and base, where they aren't the ones here."""
    t = TEMPLATES | (templates or {})
    inner = contents(site, categories, topics, posts, t, PARTIALS if partials is None else partials, conference)
    s = site.select(F.col("title").alias("site_title"), "logo", "favicon", "apple_touch_icon", "snapshot", "version")
    whole = inner.crossJoin(F.broadcast(s))  # one row
    whole = whole.withColumn("page_title", F.concat_ws(" - ", "title", "site_title")).withColumn("canonical", F.concat(F.lit(f"https://{host}"), page_url(F.col("file"))))
    return render(whole, t["base"], "html").select("file", "kind", "html")
