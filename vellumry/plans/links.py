"""URL, link and HTML queries over pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumry.functions import text as X
from vellumry.functions import urls as U
from vellumry.operators import html as H
from vellumry.operators import integrity as I
from vellumry.operators import jsonedit as J
from vellumry.plans._kit import query, table

_RE = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_HREF = r"""list_transform(regexp_extract_all(html, '(?i)href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1), lambda x: trim(x, '"'''))"""


@query("url_split", rf"SELECT page_id, lower(regexp_extract(url, '{_RE}', 1)) AS scheme, lower(regexp_extract(url, '{_RE}', 2)) AS host, regexp_extract(url, '{_RE}', 3) AS path, regexp_extract(url, '{_RE}', 4) AS query, regexp_extract(url, '{_RE}', 5) AS fragment FROM pages")
def url_split(spark, d):
    p = table(spark, d, "pages").withColumn("u", U.split_url(F.col("url")))
    return p.select("page_id", *[f"u.{x}" for x in ("scheme", "host", "path", "query", "fragment")])


@query("url_root_relative", rf"SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*(.*)$', 1) AS rel FROM pages")
def url_root_relative(spark, d):
    return table(spark, d, "pages").select("page_id", U.root_relative(U.split_url(F.col("url"))).alias("rel"))


@query("url_normalize_dots", rf"SELECT page_id, regexp_extract(url, '{_RE}', 3) AS path FROM pages")
def url_normalize_dots(spark, d):
    path = U.split_url(F.col("url"))["path"]
    messy = F.concat(F.lit("/./x/.."), path)
    return table(spark, d, "pages").select("page_id", U.normalize_dots(messy).alias("path"))


@query("url_target_file", rf"SELECT page_id, substr(regexp_extract(url, '{_RE}', 3), 2) || '/index.html' AS file, regexp_extract(url, '{_RE}', 3) || '/' AS back FROM pages")
def url_target_file(spark, d):
    f = U.target_file(F.concat(U.split_url(F.col("url"))["path"], F.lit("/")))
    return table(spark, d, "pages").select("page_id", f.alias("file"), U.page_url(f).alias("back"))


@query("url_percent_decode", "SELECT page_id, url || '+ü%' AS out FROM pages")
def url_percent_decode(spark, d):
    return table(spark, d, "pages").select("page_id", U.percent_decode(F.concat("url", F.lit("%2B%C3%BC%"))).alias("out"))


@query("url_first_segment", rf"SELECT page_id, string_split(regexp_extract(url, '{_RE}', 3), '/')[2] AS seg FROM pages")
def url_first_segment(spark, d):
    return table(spark, d, "pages").select("page_id", U.first_segment(U.split_url(F.col("url"))["path"]).alias("seg"))


@query("url_safe_path", rf"SELECT page_id, NOT contains(rtrim(regexp_extract(url, '{_RE}', 3), '/'), '//') AS ok, false AS bad FROM pages")
def url_safe_path(spark, d):
    p = F.concat(F.lit("x"), F.regexp_replace(U.split_url(F.col("url"))["path"], "/+$", ""))
    return table(spark, d, "pages").select("page_id", U.safe_path(p).alias("ok"), U.safe_path(F.concat(p, F.lit("/../x"))).alias("bad"))


@query("srcset_candidates", "SELECT page_id, url || '|b' || page_id || ',c.png|' || url || 'x' AS urls FROM pages")
def srcset_candidates(spark, d):
    v = F.concat(F.lit(" , "), "url", F.lit(", b"), "page_id", F.lit(",c.png 1.5x , "), "url", F.lit("x "), (F.col("page_id") % 900 + 1).cast("string"), F.lit("w"))
    return table(spark, d, "pages").select("page_id", F.array_join(U.srcset_urls(v), "|").alias("urls"))


def _links(spark, d):
    return table(spark, d, "pages").select("page_id", "url", F.explode(U.hrefs(F.col("html"))).alias("href"))


@query("page_anchors", f"SELECT page_id, href, count(*)::BIGINT AS n FROM (SELECT page_id, unnest({_HREF}) AS href FROM pages) GROUP BY page_id, href")
def page_anchors(spark, d):
    return _links(spark, d).groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


@query("link_kinds", f"SELECT CASE WHEN href LIKE '/%' THEN 'internal' ELSE 'other' END AS kind, count(*)::BIGINT AS n FROM (SELECT unnest({_HREF}) AS href FROM pages) GROUP BY 1")
def link_kinds(spark, d):
    u = U.split_url(F.col("href"))
    return _links(spark, d).groupBy(U.link_kind(u, "example.org").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


_MADE = ["javascript:x()", "mailto:a@{h}", "#top", "/t/1", "x/y", "http://{h}/a", "//{h}", "HTTPS://Own.example:80/b", "http:///a", "tel:1", "", "?q", "https://u@own.example/"]


@query(
    "url_kind",
    """SELECT page_id, link_kind, rewrite_kind FROM (SELECT page_id, ['skipped', 'skipped', 'internal', 'internal', 'internal', 'external', 'external', 'internal', 'malformed', 'skipped', 'internal', 'internal', 'internal'][k] AS link_kind,
        ['unsafe', 'mailto', 'fragment', 'internal', 'relative', 'external', 'external', 'external', 'external', 'external', 'other', 'relative', 'external'][k] AS rewrite_kind FROM (SELECT page_id, (page_id % 13 + 1)::INT AS k FROM pages))""",
)
def url_kind(spark, d):
    """FLT-05, FLT-06: both kinds of each shape of URL, with the pages' hosts in them."""
    shapes = F.element_at(F.array(*map(F.lit, _MADE)), (F.col("page_id") % len(_MADE) + 1).cast("int"))
    u = U.split_url(F.replace(shapes, F.lit("{h}"), U.split_url(F.col("url"))["host"]))
    return table(spark, d, "pages").select("page_id", U.link_kind(u, "own.example").alias("link_kind"), U.rewrite_kind(u, "own.example").alias("rewrite_kind"))


@query("external_host_top10", "SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, count(*)::BIGINT AS n FROM pages GROUP BY 1 ORDER BY n DESC, host LIMIT 10")
def external_host_top10(spark, d):
    return I.count_by(table(spark, d, "pages").select(U.split_url(F.col("url"))["host"].alias("host")), "host").limit(10)


@query(
    "broken_internal_links",
    f"""WITH l AS (SELECT page_id, unnest({_HREF}) AS href FROM pages), s AS (SELECT DISTINCT regexp_extract(url, '{_RE}', 3) AS path FROM pages)
        SELECT page_id, count(*)::BIGINT AS n_broken FROM l WHERE regexp_extract(href, '{_RE}', 3) NOT IN (SELECT path FROM s) GROUP BY page_id""",
)
def broken_internal_links(spark, d):
    there = table(spark, d, "pages").select(U.split_url(F.col("url"))["path"].alias("path")).distinct()
    asked = _links(spark, d).select("page_id", U.split_url(F.col("href"))["path"].alias("path"))
    return asked.join(there, "path", "left_anti").groupBy("page_id").agg(F.count(F.lit(1)).alias("n_broken"))


@query("url_dictionary_encode", "SELECT page_id, upper(host) AS label FROM (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages)")
def url_dictionary_encode(spark, d):
    """JON-25: costly work once for each distinct value, then back to all references."""
    p = table(spark, d, "pages").select("page_id", U.split_url(F.col("url"))["host"].alias("host"))
    return p.join(p.select("host").distinct().withColumn("label", F.upper("host")), "host").select("page_id", "label")


_BLOCKS = "|".join(X.BLOCK_ELEMENTS)
_VISIBLE = rf"""replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
 '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g'), '</?(?:{_BLOCKS})(?:[^A-Za-z0-9:>-][^>]*)?>', chr(10), 'g'), '<[^>]*>', '', 'g'),
 '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')"""


@query("visible_text", f"SELECT page_id, sha256({_VISIBLE}) AS h FROM pages")
def visible_text(spark, d):
    return table(spark, d, "pages").select("page_id", F.sha2(X.visible_text(F.col("html")), 256).alias("h"))


@query("token_counts", r"SELECT doc_id, len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))::BIGINT AS n FROM documents")
def token_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(X.tokens(F.col("text"))).cast("long").alias("n"))


@query(
    "missing_words",
    rf"""WITH t AS (SELECT page_id, unnest(regexp_extract_all(lower({_VISIBLE}), '[\p{{L}}\p{{N}}]+')) AS w FROM pages),
         c AS (SELECT page_id, w, count(*) AS n FROM t GROUP BY page_id, w)
         SELECT page_id, sum(n - 1)::BIGINT AS n_missing FROM c GROUP BY page_id""",
)
def missing_words(spark, d):
    """AGG-12: what a copy that has each word of a page only once lacks."""
    w = table(spark, d, "pages").select("page_id", F.explode(X.tokens(X.visible_text(F.col("html")))).alias("w"))
    return I.multiset_deficit(w, w.distinct(), ["page_id"], "w")


@query(
    "page_element_counts",
    r"""SELECT el, count(*)::BIGINT AS n FROM (SELECT unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->|<script>.*?</script>', '<script>', 'g'), '<([a-z][a-z0-9]*)', 1)) AS el FROM pages) WHERE el <> 'script' GROUP BY el""",
)
def page_element_counts(spark, d):
    a = H.attribute_relation(table(spark, d, "pages"), "page_id", "html").where("el <> 'script'")
    return a.select("page_id", "idx", "el").distinct().groupBy("el").agg(F.count(F.lit(1)).alias("n"))


@query("page_attr_relation", f"SELECT page_id, count(*)::BIGINT AS n, count(DISTINCT href)::BIGINT AS n_distinct FROM (SELECT page_id, unnest({_HREF}) AS href FROM pages) GROUP BY page_id")
def page_attr_relation(spark, d):
    a = H.attribute_relation(table(spark, d, "pages"), "page_id", "html").where("name = 'href'")
    return a.groupBy("page_id").agg(F.count("value").alias("n"), F.countDistinct("value").alias("n_distinct"))


@query("escape_text", """SELECT doc_id, sha256(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(160), '&nbsp;')) AS h, sha256(replace(replace(replace(replace(replace(t, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(160), '&nbsp;'), '"', '&quot;')) AS a
        FROM (SELECT doc_id, regexp_replace(text, '[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g') || chr(160) || '"<' || source AS t FROM documents)""")
def escape_text(spark, d):
    t = F.concat("text", F.lit("\u00a0\u0007\"<"), "source")
    return table(spark, d, "documents").select("doc_id", F.sha2(X.escape_html(t), 256).alias("h"), F.sha2(X.escape_html(t, attribute=True), 256).alias("a"))


@query("unix_lines", "SELECT doc_id, sha256(source || chr(10) || replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) || chr(10) || chr(10) || lang) AS h FROM documents")
def unix_lines(spark, d):
    """SNK-03, over all texts."""
    t = table(spark, d, "documents")
    return t.select("doc_id", F.sha2(X.unix_lines(F.concat("source", F.lit("\r\n"), "text", F.lit("\r\r\n"), "lang")), 256).alias("h"))


@query(
    "utf8_repair",
    "SELECT doc_id, sha256(CASE doc_id % 4 WHEN 0 THEN text ELSE substr(text, 1, length(text) // 2) || ['<c3>', '<e2><82>', '<f5><80><c0><af>'][(doc_id % 4)::INT] || substr(text, length(text) // 2 + 1) END) AS h FROM documents WHERE doc_id >= 0",
)
def utf8_repair(spark, d):
    """STR-11: whole texts with bytes in the middle that are no characters; a NUL among them goes."""
    half = F.floor(F.length("text") / 2).cast("int")
    raw = lambda c: F.hex(F.encode(c, "UTF-8"))
    bad = F.element_at(F.array(*map(F.lit, ["C3", "E20082", "F580C0AF00"])), (F.col("doc_id") % 4).cast("int"))
    whole = F.concat(raw(F.substring("text", F.lit(1), half)), bad, raw(F.col("text").substr(half + 1, F.length("text"))))
    t = table(spark, d, "documents").where("doc_id >= 0")
    return t.select("doc_id", F.sha2(X.repaired(F.unhex(F.when(F.col("doc_id") % 4 == 0, raw("text")).otherwise(whole)), drop_nul=True), 256).alias("h"))


_SHAPES = ["yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd HH:mm 'UTC'", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss'+02:00 UTC'", "yyyy-MM-dd HH:mm' -0530'", "yyyy-MM-dd HH:mm'+02:'", "dd.MM.yyyy"]


@query(
    "utc_parse_format",
    """SELECT event_id, CASE WHEN k < 5 THEN strftime(CASE k WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts) WHEN 2 THEN date_trunc('day', ts) WHEN 3 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
        ELSE date_trunc('minute', ts) + INTERVAL 330 MINUTE END, '%Y-%m-%dT%H:%M:%SZ') END AS iso, CASE WHEN k < 5 THEN k <> 2 END AS timed FROM (SELECT event_id, ts, event_id % 7 AS k FROM events WHERE ts IS NOT NULL)""",
)
def utc_parse_format(spark, d):
    """DAT-01, DAT-02: times of every event in seven spellings, two of which are none."""
    e = table(spark, d, "events").where("ts IS NOT NULL")
    k = F.col("event_id") % 7
    text = F.coalesce(*[F.when(k == i, F.date_format("ts", p)) for i, p in enumerate(_SHAPES)])
    p = X.parse_utc(text)
    return e.select("event_id", X.iso(p["at"]).alias("iso"), p["has_time"].alias("timed"))


@query("slug_form", r"SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def slug_form(spark, d):
    from vellumry.functions.redact import slug_form as slug

    return table(spark, d, "part").select("p_partkey", slug(F.col("p_name")).alias("slug"))


@query("url_decode_variants", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || ' ü+%' ELSE NULL END AS strict, CASE page_id % 4 WHEN 0 THEN url || ' ü+%' WHEN 1 THEN url || '%ff%20' WHEN 2 THEN url || ' ' ELSE url || '%e4x' END AS tolerant FROM pages")
def url_decode_variants(spark, d):
    """URL-04, URL-05."""
    tail = F.element_at(F.array(*map(F.lit, ["%20%C3%BC+%", "%ff%20", "%00%20", "%e4x"])), (F.col("page_id") % 4 + 1).cast("int"))
    u = F.concat("url", tail)
    return table(spark, d, "pages").select("page_id", U.percent_decode(u).alias("strict"), U.percent_decode_tolerant(u).alias("tolerant"))


@query("url_resolve", rf"SELECT page_id, CASE page_id % 5 WHEN 0 THEN regexp_replace(p, '[^/]*$', '') || 'a/c' WHEN 1 THEN '/x/' WHEN 2 THEN p WHEN 3 THEN '/' ELSE '/b c' END AS path, CASE page_id % 5 WHEN 2 THEN 'f ' || page_id ELSE '' END AS fragment FROM (SELECT page_id, regexp_extract(url, '{_RE}', 3) AS p FROM pages)")
def url_resolve(spark, d):
    """URL-08 with dots, decoding and fragments."""
    ref = F.element_at(F.array(F.lit("a/b/../c"), F.lit("/x/y/.."), F.concat(F.lit("#f%20"), "page_id"), F.lit("//other.example"), F.lit("/b%20c?q")), (F.col("page_id") % 5 + 1).cast("int"))
    r = U.resolve(U.split_url(ref), U.split_url(F.col("url"))["path"])
    return table(spark, d, "pages").select("page_id", r["path"].alias("path"), r["fragment"].alias("fragment"))


@query("own_references", "SELECT page_id, '/uploads/' || page_id || '.png?x|https://own.example/t/' || page_id || '&y|//own.example/z' AS refs, '/uploads/' || page_id || '.png|/images/a b.gif' AS assets FROM pages")
def own_references(spark, d):
    """URL-12, URL-14 in a body with other hosts' addresses around."""
    html = F.concat(F.lit('<img srcset="/uploads/'), "page_id", F.lit('.png?x, http://o.example/uploads/q.png 2x"> see https://own.example/t/'), "page_id", F.lit("&amp;y, <a href='//own.example/z'>, x//own.example.org/q, (images/n.gif) "))
    more = F.concat(html, F.lit("HTTPS://own.example/images/a%20b.gif!"))
    t = table(spark, d, "pages")
    return t.select("page_id", F.array_join(U.own_references(html, "own.example"), "|").alias("refs"), F.array_join(U.asset_paths(more, "own.example"), "|").alias("assets"))


@query("sitemap_locs", "SELECT page_id, replace(url, '&', '&amp;') || '?a%20b=%C3%BC&amp;c' AS line FROM pages WHERE NOT regexp_matches(url, '[^\x21-\x7e]')")
def sitemap_locs(spark, d):
    """STR-12."""
    t = table(spark, d, "pages").where(~F.col("url").rlike(r"[^\x21-\x7e]"))
    return t.select("page_id", U.sitemap_loc(F.concat("url", F.lit("?a b=ü&c"))).alias("line"))


@query("attribute_values", "SELECT page_id, n FROM (SELECT page_id, len(regexp_extract_all(html, '<div class=\"ad\">'))::BIGINT AS n FROM pages) WHERE n > 0")
def attribute_values(spark, d):
    """HTM-16: elements of a class, every one counted."""
    a = H.attribute_relation(table(spark, d, "pages"), "page_id", "html")
    return a.where((F.col("el") == "div") & (F.col("name") == "class") & H.has_class(F.col("value"), "ad")).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))


def _json_doc(spark, d, after: bool):
    """A JSON document for each row; the later one differs by doc_id modulo 6: not at all, in a string, in two, in a number, by a member, by a kind."""
    k = F.col("doc_id") % 6
    when = lambda n, new, old: F.when(F.lit(after) & (k == n), new).otherwise(old)
    text = F.to_json(
        F.struct(
            F.col("doc_id").alias("id"), when(1, F.reverse("text"), F.col("text")).alias("text"), F.struct(when(2, F.upper("lang"), F.col("lang")).alias("lang"), F.array(when(2, F.concat("source", F.lit("/")), F.col("source")), F.lit("é~/")).alias("tags")).alias("m"),
            when(3, F.col("n_chars") + 1, F.col("n_chars")).alias("n"), F.when(~(F.lit(after) & (k == 4)), F.lit(True)).alias("flag"), when(5, F.lit("1"), F.lit(None).cast("string")).alias("five"),
        )
    )
    return table(spark, d, "documents").where("doc_id >= 0").select(F.col("doc_id").cast("string").alias("file"), F.encode(text, "UTF-8").alias("content"))


_LATER = """SELECT doc_id::VARCHAR AS file, json_object('id', doc_id, 'text', text, 'm', json_object('lang', lang, 'tags', json_array(source, 'é~/')), 'n', n_chars, 'flag', true) AS a,
    CASE doc_id % 6 WHEN 1 THEN json_object('id', doc_id, 'text', reverse(text), 'm', json_object('lang', lang, 'tags', json_array(source, 'é~/')), 'n', n_chars, 'flag', true)
      WHEN 2 THEN json_object('id', doc_id, 'text', text, 'm', json_object('lang', upper(lang), 'tags', json_array(source || '/', 'é~/')), 'n', n_chars, 'flag', true)
      WHEN 3 THEN json_object('id', doc_id, 'text', text, 'm', json_object('lang', lang, 'tags', json_array(source, 'é~/')), 'n', n_chars + 1, 'flag', true)
      WHEN 4 THEN json_object('id', doc_id, 'text', text, 'm', json_object('lang', lang, 'tags', json_array(source, 'é~/')), 'n', n_chars)
      WHEN 5 THEN json_object('id', doc_id, 'text', text, 'm', json_object('lang', lang, 'tags', json_array(source, 'é~/')), 'n', n_chars, 'flag', true, 'five', '1') ELSE a END AS b FROM documents WHERE doc_id >= 0 AND text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL"""
_TREES = f"""docs AS ({_LATER}), x AS (SELECT file, t.fullkey AS k, t.type AS kind, t.atom AS leaf FROM docs, json_tree(docs.a) t), y AS (SELECT file, t.fullkey AS k, t.type AS kind, t.atom AS leaf FROM docs, json_tree(docs.b) t),
  d AS (SELECT file, CASE WHEN x.kind IS DISTINCT FROM y.kind THEN 'shape' WHEN x.kind = 'VARCHAR' THEN 'string' ELSE 'leaf' END AS what FROM x FULL JOIN y USING (file, k) WHERE x.kind IS DISTINCT FROM y.kind OR x.leaf::VARCHAR IS DISTINCT FROM y.leaf::VARCHAR)"""


@query("json_verdicts", f"WITH {_TREES} SELECT docs.file, CASE WHEN coalesce(count_if(what <> 'string'), 0) > 0 THEN 'refused' WHEN count(what) > 0 THEN 'changed' ELSE 'same' END AS verdict, coalesce(count_if(what = 'string'), 0)::BIGINT AS n_strings FROM docs LEFT JOIN d ON d.file = docs.file GROUP BY docs.file")
def json_verdicts(spark, d):
    """JSN-02, JSN-03: documents before and after, node by node, against DuckDB's trees of them."""
    full = table(spark, d, "documents").where("text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND n_chars IS NOT NULL").select(F.col("doc_id").cast("string").alias("file"))
    pair = [_json_doc(spark, d, after).join(full, "file", "left_semi") for after in (False, True)]
    return J.json_verdicts(*pair)
