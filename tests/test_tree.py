"""Templates against a plain renderer, trees of files with lost tasks, copies."""

import os

import pytest
from pyspark.sql import functions as F

from vellumry.operators import pages, templates
from vellumry.sources import tree


def rendered(spark, source, row, schema, **names):
    return templates.render(spark.createDataFrame([row], schema), source, "out", **names).first().out


@pytest.mark.parametrize(
    "source, want",
    [
        ("{{a}}|{{{a}}}|{{& a}}|{{n}}|{{b}}|{{none}}|{{missing}}", '&lt;x&gt; &amp; &quot;y&quot;|<x> & "y"|<x> & "y"|7|true||'),
        ("{{#b}}yes{{/b}}{{^b}}no{{/b}}{{#none}}x{{/none}}{{^none}}none{{/none}}{{#missing}}x{{/missing}}{{^missing}}gone{{/missing}}", "yesnonegone"),
        ("{{#s}}{{k}}{{n}}{{#inner}}{{.}}{{k}};{{/inner}}{{/s}}", "p7up;vp;q7"),
        ("{{#a}}{{.}}{{/a}}{{#empty}}x{{/empty}}{{^empty}}e{{/empty}}{{#n}}{{n}}{{/n}}", "&lt;x&gt; &amp; &quot;y&quot;e7"),
        ("{{o.k}} {{#o}}{{k}}{{a}}{{/o}}{{o.z}}", "in in&lt;x&gt; &amp; &quot;y&quot;"),
        ("a\n  {{#b}}\n  b\n  {{/b}}\n{{! comment\nover lines }}\nc\n", "a\n  b\nc\n"),
        ("{{#b}} {{^b}}x{{/b}} {{/b}}\n", "  \n"),
        ("{{>p}}!", "(7)!"),
        ("", ""),
        ("no tags { {x} }", "no tags { {x} }"),
    ],
)
def test_templates(spark, source, want):
    row = ('<x> & "y"', 7, True, None, [("p", ["u", "v"]), ("q", [])], "", ("in",))
    schema = "a string, n long, b boolean, none string, s array<struct<k: string, inner: array<string>>>, empty string, o struct<k: string>"
    assert rendered(spark, source, row, schema, partials={"p": "({{n}})"}) == want


@pytest.mark.parametrize("source", ["{{#a}}", "{{/a}}", "{{#a}}{{#n}}{{/a}}{{/n}}", "{{a b}}", "{{>q}}", "{{>p}}", "{{o}}"])
def test_templates_that_do_not_compile(spark, source):
    with pytest.raises(templates.TemplateError):
        rendered(spark, source, ("x", 1, ("k",)), "a string, n long, o struct<k: string>", partials={"p": "{{>p}}"})
    with pytest.raises(templates.TemplateError):
        rendered(spark, "{{missing}}", ("x",), "a string", strict=True)


def plain(nodes, scopes):
    """The rules again, over dicts and lists."""
    out = ""
    for n in nodes:
        if n.kind == "text":
            out += n.name
            continue
        found = scopes[-1] if n.name == "." else next((s[n.name] for s in reversed(scopes) if isinstance(s, dict) and n.name in s), None)
        if n.kind in ("value", "raw"):
            t = "" if found is None else str(found).lower() if isinstance(found, bool) else str(found)
            out += t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;") if n.kind == "value" else t
        elif n.kind == "inverted":
            out += plain(n.inner, scopes) if found in (None, False, "", []) else ""
        elif isinstance(found, list):
            out += "".join(plain(n.inner, [*scopes, x]) for x in found)
        elif found not in (None, False, ""):
            out += plain(n.inner, scopes if found is True else [*scopes, found])
    return out


@pytest.mark.parametrize("kind", ["home", "category", "topic", "search", "not_found"])
def test_pages_equal_a_plain_renderer(spark, kind):
    cats = spark.createDataFrame([(1, None, "a", "A & B", 2, "d<", 7, "/c/a/1/"), (2, 1, "b", "B", 1, None, None, "/c/a/b/2/"), (3, None, "conf2020", "C", 9, "", None, "/c/conf2020/3/")], "id long, parent_id long, slug string, name string, position int, description string, about_topic_id long, path string")
    topics = spark.createDataFrame(
        [(7, 1, "s", "T <1>", True, True, True, ["x", "y"], "2020-01-01T00:00:00Z", None, 3), (8, 1, "u", None, None, None, None, None, None, "2021-01-01T00:00:00Z", None), (9, 77, "v", "lost", False, False, False, [], None, None, 0)],
        "id long, category_id long, slug string, title string, pinned boolean, closed boolean, archived boolean, tags array<string>, created_at string, last_posted_at string, n_posts int",
    )
    posts = spark.createDataFrame([(7, 2, "u", "N", None, 1, "<p>b</p>"), (7, 1, None, None, "2020-01-01T00:00:00Z", 1, None), (7, 3, "w", None, "x", 9, "")], "topic_id long, number long, username string, name string, created_at string, reply_to long, body string")
    site = spark.createDataFrame([("S & T", "about", "l.png", "", "", "2024", "")], "title string, description string, logo string, favicon string, apple_touch_icon string, snapshot string, version string")
    data = {"home": lambda: pages.home_data(site, cats, topics), "category": lambda: pages.category_data(cats, topics), "topic": lambda: pages.topic_data(topics, cats, posts), "search": lambda: site.select(F.col("title").alias("site_title")), "not_found": lambda: site}[kind]()
    source = pages.TEMPLATES[kind].replace("{{>entry}}", pages.PARTIALS["entry"])
    got = templates.render(data, pages.TEMPLATES[kind], "out", pages.PARTIALS).collect()
    assert got and all(r.out == plain(templates.parse(source), [r.asDict(recursive=True)]) for r in got)
    whole = {r.file: r.html for r in pages.site_pages(site, cats, topics, posts, "h.org").collect()}
    assert set(whole) == {"index.html", "search/index.html", "404.html", "c/a/1/index.html", "c/a/b/2/index.html", "c/conf2020/3/index.html", "t/s/7/index.html", "t/u/8/index.html", "t/v/9/index.html"}
    assert "Python" not in pages.site_pages(site, cats, topics, posts, "h.org")._jdf.queryExecution().toString()
    assert 'content="noindex"' in whole["404.html"] and '<link rel="canonical" href="https://h.org/t/s/7/">' in whole["t/s/7/index.html"] and "<title>T &lt;1&gt; - S &amp; T</title>" in whole["t/s/7/index.html"]


def test_load_templates(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.html").write_text(f"{name}\n{{{{x}}}}\n")
    assert templates.load(spark, str(tmp_path), ["a", "b"]) == {"a": "a\n{{x}}\n", "b": "b\n{{x}}\n"}
    with pytest.raises(FileNotFoundError, match="c, d"):
        templates.load(spark, str(tmp_path), ["a", "c", "d"])


def files_of(spark, n, salt=""):
    return spark.range(n).select(F.concat(F.lit("d"), F.col("id") % 17, F.lit("/ü "), "id", F.lit(".html")).alias("file"), F.encode(F.concat(F.lit(f"body {salt}"), "id"), "UTF-8").alias("content"))


def on_disk(root):
    return {os.path.relpath(f"{d}/{f}", root): open(f"{d}/{f}", "rb").read() for d, _, names in os.walk(root) for f in names if not f.endswith(".crc")}


def test_tree_of_ten_thousand_files_and_its_copy(spark, tmp_path):
    at = str(tmp_path / "my-site/x/site")
    got = tree.write_tree(spark, files_of(spark, 10_000), at)
    assert on_disk(at) == {f"d{k % 17}/ü {k}.html": f"body {k}".encode() for k in range(10_000)}
    assert got.count() == 10_000 and sorted(os.listdir(tmp_path / "my-site/x")) == ["site"]
    copied = tree.copy_checked(spark, got.select("file"), at, str(tmp_path / "copy"))
    assert copied.exceptAll(got).isEmpty() and copied.count() == 10_000 and on_disk(tmp_path / "copy") == on_disk(at)
    tree.write_tree(spark, files_of(spark, 3, "new "), at)
    assert on_disk(at) == {f"d{k}/ü {k}.html": f"body new {k}".encode() for k in range(3)}
    assert tree.write_tree(spark, files_of(spark, 0), at).count() == 0 and on_disk(at) == {}


def test_failed_task_leaves_the_old_tree(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "site")
    tree.write_tree(spark, files_of(spark, 20), at)
    old = on_disk(at)
    # a file where a folder has to be: the tasks that need it fail
    real = tree.name_faults
    monkeypatch.setattr(tree, "name_faults", lambda f: real(f).limit(0))
    clash = files_of(spark, 20, "b").unionByName(spark.createDataFrame([("d3", b"x"), ("d3/y", b"x")], "file string, content binary"))
    with pytest.raises(Exception):  # noqa: B017
        tree.write_tree(spark, clash, at)
    assert on_disk(at) == old
    monkeypatch.undo()
    assert tree.write_tree(spark, files_of(spark, 2, "c"), at).count() == 2 and len(on_disk(at)) == 2 and not os.path.exists(f"{at}.rows")


def test_leftovers_of_a_lost_task_go_and_wrong_contents_are_seen(spark, tmp_path):
    stage = tmp_path / "s"
    w = tree._Writer({"stage": str(stage)})
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"file": ["a/x", "y"], "content": [b"1", b"22"]})
    first = w.write(iter([batch]))  # an attempt that is lost after it wrote
    (stage / "a/x.12ab34cd.part").write_bytes(b"half")
    second = w.write(iter([batch]))
    assert (first.files, first.bytes, first.digest) == (second.files, second.bytes, second.digest) == (2, 3, first.digest)
    (stage / "_hidden").write_bytes(b"3")
    assert sorted(r.file for r in tree.list_tree(spark, str(stage), clean=True).collect()) == ["_hidden", "a/x", "y"]
    (stage / "_hidden").unlink()
    assert on_disk(stage) == {"a/x": b"1", "y": b"22"}
    strict = tree._Writer({"stage": str(stage), "files": "2", "bytes": "3", "digest": str(first.digest + 1)})
    with pytest.raises(tree.TreeError):
        strict.commit([second, None])
    assert not stage.exists()


@pytest.mark.parametrize("names", [["a", "a"], ["a/B", "A/b"], ["a", "a/b"], ["../a"], ["/a"], ["a//b"], [""], [None], ["a\nb"]])
def test_names_that_no_tree_holds(spark, tmp_path, names):
    rows = spark.createDataFrame([(n, b"x") for n in ["ok", *names]], "file string, content binary")
    with pytest.raises(tree.TreeError):
        tree.write_tree(spark, rows, str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


def test_null_content_is_refused(spark, tmp_path):
    with pytest.raises(tree.TreeError, match="no content"):
        tree.write_tree(spark, spark.createDataFrame([("a", None)], "file string, content binary"), str(tmp_path / "t"))


def test_site_files_with_several_sitemaps(spark, monkeypatch):
    from vellumry.sources import sinks

    monkeypatch.setattr(sinks, "SITEMAP_URLS", 2)
    p = spark.createDataFrame([("index.html", "home", "h"), ("a/index.html", "topic", "a"), ("b&c.html", "topic", "b"), ("404.html", "not_found", "n")], "file string, kind string, html string")
    got = {r.file: bytes(r.content).decode() for r in tree.site_files(p, "h.org", {"x.css": "c"}).collect()}
    assert set(got) == {"index.html", "a/index.html", "b&c.html", "404.html", "robots.txt", "x.css", "sitemap.xml", "sitemap-1.xml", "sitemap-2.xml"}
    assert "404" not in got["sitemap-1.xml"] + got["sitemap-2.xml"] and "https://h.org/sitemap-2.xml" in got["sitemap.xml"] and "b&amp;c.html" in got["sitemap-2.xml"]
