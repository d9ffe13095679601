"""Relational operators, sources, sinks and the stream on small tables."""

import json
import re

import pytest
from pyspark.sql import functions as F

from vellumry.operators import asof, checks, hierarchy, html, integrity, rules
from vellumry.sources import files, sinks
from vellumry.streaming import ingest


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_sets_gaps_multisets(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    assert rows(integrity.compare_sets(a, b, ["k"])) == [(1, "missing"), (2, "duplicate"), (3, "extra")]
    n = spark.createDataFrame([("t", 1), ("t", 2), ("t", 5), ("u", 1)], "g string, n int")
    assert rows(integrity.number_gaps(n, "g", "n")) == [("t", 3), ("t", 4)]
    want = spark.createDataFrame([("p", x) for x in "aab"], "g string, w string")
    have = spark.createDataFrame([("p", x) for x in "abc"], "g string, w string")
    assert rows(integrity.multiset_deficit(want, have, ["g"], "w")) == [("p", 1)]


def test_asof(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, t int")
    right = spark.createDataFrame([(1, 2, "a"), (1, 5, "b"), (2, 10, "c")], "k int, t int, v string")
    assert sorted(asof.last_before(left, right, ["k"], "t", "v", "x").collect(), key=str) == sorted([(1, 5, "b"), (1, 1, None), (2, 9, None)], key=str)
    assert sorted(asof.first_after(left, right, ["k"], "t", "v", "x").collect(), key=str) == sorted([(1, 5, "b"), (1, 1, "a"), (2, 9, "c")], key=str)
    r = spark.createDataFrame([(0.0, 10.0, "x"), (5.0, 25.0, "y")], "lo double, hi double, n string")
    p = spark.createDataFrame([(7.0,), (25.0,), (30.0,)], "at double")
    assert rows(asof.range_lookup(p, r, "at", "lo", "hi", 10.0).select("at", "n")) == [(7.0, "x"), (7.0, "y"), (25.0, "y")]


def test_hierarchy(spark):
    n = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, 99, "d")], "id int, parent_id int, slug string")
    got = {r.id: r.path for r in hierarchy.paths(n).collect()}
    assert got[1] == "a" and got[2] == "a/b" and got[3] == "a/b/c"


def test_hierarchy_deep_and_cyclic(spark):
    schema = "id int, parent_id int, slug string"
    deep = spark.createDataFrame([(k, k - 1 if k else None, f"s{k}") for k in range(20)], schema)
    got = {r.id: (r.level, r.path) for r in hierarchy.paths(deep).collect()}
    assert got == {k: (k + 1, "/".join(f"s{j}" for j in range(k + 1))) for k in range(20)}
    for bad in ([(1, None, "a"), (2, 3, "b"), (3, 2, "c")], [(1, None, "a"), (2, 1, "b"), (1, 2, "c")]):
        with pytest.raises(ValueError, match="cycle"):
            hierarchy.paths(spark.createDataFrame(bad, schema))


def test_rules(spark):
    t = spark.createDataFrame([(7, "x"), (8, "x"), (9, "2022"), (10, "solo")], "id long, slug string")
    p = spark.createDataFrame([(7, 1), (7, 3), (7, 9)], "topic_id long, number long")
    shown = spark.createDataFrame([(7, 1), (7, 3)], "topic_id long, number long")
    made = {r.source: r.dest for r in rules.topic_rules(t, p, shown).collect()}
    assert "/t/x" not in made and "/t/2022" not in made and made["/t/solo"] == "/t/solo/10/"
    assert (made["/t/x/7/1"], made["/t/x/7/3"], made["/t/x/7/9"]) == ("/t/x/7/", "/t/x/7/#post-3", "/t/x/7/")
    k = spark.createDataFrame([(1, None, "a", "a"), (2, 1, "b", "a/b")], "id long, parent_id long, slug string, path string")
    assert rows(rules.category_rules(k).select("source", "dest")) == [("/c/1", "/c/a/1/"), ("/c/2", "/c/a/b/2/"), ("/c/a", "/c/a/1/"), ("/c/a/1", "/c/a/1/"), ("/c/a/b", "/c/a/b/2/"), ("/c/a/b/2", "/c/a/b/2/"), ("/c/b/2", "/c/a/b/2/")]
    links = spark.createDataFrame([("/t/old/7",), ("/t/x/7/3",), ("/t/2021/9",), ("/t/2022/9",), ("http://o.org/t/q/7",), ("/t/a%b/8",)], "href string")
    assert rows(rules.stale_rules(links, "own.org", t).select("source", "dest")) == [("/t/old/7", "/t/x/7/")] and rows(rules.stale_unusable(links, "own.org", t)) == [(8, "a%b")]
    text = spark.createDataFrame([("# c\n\n/a  /b 301\n/c\t/d 302\r",)], "t string")
    assert rows(rules.parse(text, "t").select("line_no", "source", "dest", "status")) == [(3, "/a", "/b", "301"), (4, "/c", "/d", "302")]


def parsed(spark, lines):
    return rules.parse(spark.createDataFrame([("\n".join(lines),)], "t string"), "t")


def test_rule_checks(spark):
    files = spark.createDataFrame([("x/index.html",), ("index.html",), ("s.html",), ("u/z.png",)], "file string")
    anchors = spark.createDataFrame([("x/index.html", 2)], "file string, number long")
    good = ["/a /x/ 301", "/b /x/#post-2 302", "/x /x/ 301", "/n/* / 301"]
    assert rows(rules.check(parsed(spark, good), files, anchors)) == []
    bad = ["/a /x/ 301", "/a /x/ 399", "/b/ /x/ 301", "/c /y/ 301", "/d /x/#post-3 301", "/e /n/q/ 301", "/s / 301", "/n/* / 301", "/n/k / 301", "/u/* / 301", "/é / 301", "/w /x 301"]
    assert rows(rules.check(parsed(spark, bad), files, anchors)) == sorted([
        ("repeated source", "/a"), ("status", "2"), ("source shape", "/b/"), ("no such page", "/y/"), ("no such page", "/n/q/"), ("no such page", "/x"), ("no such post", "/x/#post-3"), ("loop", "/n/q/"), ("shadow", "/s"),
        ("static below dynamic", "/n/k"), ("dynamic shadow", "/u/*"), ("characters", "11"), ("source shape", "/é"), ("destination shape", "/x"),
    ])


def test_rules_beyond_the_limit(spark):
    many = spark.createDataFrame([(f"/p{k}/*", "/x/") for k in range(150)], "source string, dest string")
    urls = spark.createDataFrame([(f"/p{k}/a",) for k in range(150)] + [("/x/",)], "url string")
    assert rows(rules.covered(many, urls)) == sorted((f"/p{k}/a", f"/p{k}/*") for k in range(150))
    lines = [f"/p{k}/* / 301" for k in range(120)] + [f"/s{k} / 301" for k in range(2500)]
    found = rules.check(parsed(spark, lines), spark.createDataFrame([("index.html",)], "file string"), spark.createDataFrame([], "file string, number long"))
    assert rows(found) == [("too many", "dynamic"), ("too many", "static")]


def test_rules_without_a_literal_start(spark):
    """Each rule against each URL by a plain matcher; sources that end, or go on, with their literal text are met by it."""
    sources = ["/*/old/page", "/:a/archive/*", "/*", "/:a/:b", "/*.html", "/x*/y:n/z", "/:lang/3*", "*", "/a*a", "/*/b/*/c", "/plain", "/::x/q", "/*old/"]
    paths = ["/", "/x/old/page", "/old/page", "/x/archive/", "/x/archive/1/2", "/a/b", "/en/31/x", "/k.html", "/x1/y2/z", "/x/y/z", "/aa", "/a", "/b/b/c", "/q/b/r/c", "/:k/q", "", "/x/old/old/", "old/"]
    one = lambda s: re.sub(r":[A-Za-z_]\w*|\*|.", lambda m: ".*" if m[0] == "*" else "[^/]+" if len(m[0]) > 1 else re.escape(m[0]), s)
    want = sorted((u, s) for s in sources if "*" in s or ":" in s for u in paths if re.fullmatch(one(s), u))
    rule = spark.createDataFrame([(s,) for s in [*sources, None, sources[0]]], "source string")
    urls = spark.createDataFrame([(u,) for u in [*paths, None]], "url string")
    assert rows(rules.covered(rule, urls)) == want and len(want) > 25
    assert rules.covered(rule.limit(0), urls).count() == rules.covered(rule, urls.limit(0)).count() == 0


def test_checks_isolate_faults(spark):
    ok = checks.Check("1", "fine", lambda: spark.createDataFrame([], "offender string"))
    bad = checks.Check("2", "broken", lambda: spark.table("no_such_table"))
    off = checks.Check("3", "found", lambda: spark.createDataFrame([("x",), ("x",)], "offender string"))
    got = {r.id: (r.status, r.n_failures) for r in checks.run_checks(spark, [ok, bad, off]).collect()}
    assert got == {"1": ("PASS", 0), "2": ("FAIL", 1), "3": ("FAIL", 2)}


def site_tables(spark):
    t = spark.createDataFrame([(7, "slug", "T"), (8, "2022", "N")], "id long, slug string, title string")
    shown = spark.createDataFrame([(7, 1), (7, 3)], "topic_id long, number long")
    k = spark.createDataFrame([(5, "x", "X", "/c/x/5/")], "id long, slug string, name string, path string")
    return t, shown, k


def test_rewriter(spark):
    body = '<p onclick=x style="clear: both"><a href="https://f.org/t/old/7/3">t</a><a href="/u/me">@me</a><script>x</script><img class="avatar"><b>k</p><a href="javascript:y">z</a><blink>q</blink><a href=/t/s/7/9>https://f.org/t/s/7/9</a>'
    posts = spark.createDataFrame([(7, 1, body), (7, 2, '<a name="h"></a><div class=lightbox-wrapper><a href="/uploads/f.png">f</a><div class=meta>m</div></div>'), (7, 3, '<a name="h" href="#h">l</a>'), (8, 1, None)], "topic_id long, number long, html string")
    got = {(r.topic_id, r.number): r for r in html.rewritten(posts, "html", "f.org", *site_tables(spark)).collect()}
    assert got[7, 1].clean == '<p class="clear-both"><a href="/t/slug/7/#post-3">t</a><span class="mention">@me</span><b>k</b></p>zq<a href="/t/slug/7/">T</a>'
    n = got[7, 1].counts
    assert n["dropped_script"] == n["avatars_removed"] == n["topic_post_anchors_dropped"] == n["clear_both_styles_to_class"] == n["javascript_urls_removed"] == 1 and n["topic_links_resolved"] == 2
    assert got[7, 1].unknown == {"blink": 1} and [u.target for u in got[7, 1].unresolved] == ["/t/s/7/9"]
    assert got[7, 2].clean == '<a name="h"></a><a href="/uploads/f.png">f</a>' and got[7, 3].clean == '<a name="h-p3" href="#h-p3">l</a>' and got[8, 1].clean == ""
    deep = html.rewritten(spark.createDataFrame([(1, 1, "<div>" * 3000 + "x")], "topic_id long, number long, html string"), "html", "f.org", *site_tables(spark)).first()
    assert "x" in deep.clean


def test_links(spark):
    want = {"/t/2022/8": "/t/2022/8/", "/t/7/3": "/t/slug/7/#post-3", "/t/s/7/1": "/t/slug/7/", "/t/s/7/9": "/t/slug/7/", "/c/a/5": "/c/x/5/", "/c/x": "/c/x/5/", "https://f.org": "/", "/t/99": "/t/99", "#a": "a", "/u/me": "me"}
    links = spark.createDataFrame([(h,) for h in [*want, *want, None]], "href string")
    assert {r.href: r.target for r in html.resolve_links(links, "f.org", *site_tables(spark)).collect()} == want


def test_bodies_and_pages(spark):
    page = '<article class="post" id="post-2"><div class="post-body"><p>a <time>t</time></p></div></article><article class="post" id="x"></article>'
    assert html.page_posts(page) == [(2, "<p>a <time>t</time></p>"), (None, None)] and html.shown_body("<p>a <time>t</time></p>") == "<p>a </p>"
    assert html.raw_body('a<svg>b</svg><div class="meta">c</div><span class="discourse-local-date">d</span>') == "a"
    assert html.features('<a class="attachment"></a><img><img class="emoji"><aside class="quote onebox">')["images"] == 1
    bad = spark.createDataFrame([("a", "<p data-x=1>"), ("s", "<script>"), ("b", '<script><a href="javascript:x" onclick=y>own.org')], "file string, html string")
    assert rows(html.page_faults(bad, "html", "own.org", ["s"])) == [("a", "data attribute"), ("b", "event handler"), ("b", "javascript"), ("b", "own host"), ("b", "script")]


def clean_site(spark):
    from vellumry.operators import audit

    df = spark.createDataFrame
    file = "t/x/7/index.html"
    page = '<html><head><link rel="canonical" href="https://own.org/t/x/7/"></head><body><article class="post" id="post-1"><div class="post-body"><p>Hello you <a href="#post-1">up</a></p></div></article></body></html>'
    pages = [(file, page), ("c/a/1/index.html", "<p>c</p>"), ("index.html", "<p>h</p>"), ("search/index.html", "<script></script>"), ("404.html", "<p>n</p>")]
    texts = [("_redirects", "/t/7 /t/x/7/ 301\n/c/1 /c/a/1/ 301\n"), ("robots.txt", "x"), ("sitemap.xml", "x"), ("archive.css", "x")]
    files = [(f, 1, "s") for f, _ in pages + texts] + [("uploads/a.png", 3, "q")]
    frags = [("f1", "/t/x/7/", "Hello"), ("f2", "/c/a/1/", ""), ("f3", "/", "")]
    return audit.Site(
        spark, "own.org", df([(7, "x", "T", 1, 1)], "id long, slug string, title string, category_id long, stream_n long"), df([(7, 1, 1, False, '<p>Hello you <img src="/uploads/a.png"></p>')], "topic_id long, number long, type int, hidden boolean, cooked string"),
        df([(1, None, "a", "a")], "id long, parent_id long, slug string, path string"), df(files, "file string, size long, sha256 string"), df(pages, "file string, html string"), df(texts, "file string, text string"),
        df([("uploads/a.png", 3, "q")], "file string, size long, sha256 string"), df(frags, "file string, url string, content string"), page_count=3, locs=df([("https://own.org/t/x/7/",)], "loc string"),
        verbatim=df([("topic/7", "http://z.org/j?pwd=AbCdEf123456xyz me@office.org Passwort: 12ab")], "origin string, value string"), spot=[7],
    )


def test_audit_of_a_clean_site(spark):
    from vellumry.operators import audit

    got = {r.id: (r.status, r.failures) for r in checks.run_checks(spark, audit.checks(clean_site(spark))).collect()}
    info = {"3b", "4b", "6b", "6d", "7", "8"}
    assert len(got) == 17 and got == {k: ("INFO" if k in info else "PASS", "") for k in got}


def test_audit_finds_values_and_aborts(spark):
    from vellumry.operators import audit

    site = clean_site(spark)
    leak = spark.createDataFrame([("robots.txt", "ABCDEF123456XYZ and 12ab, not x12ab; me@OFFICE.org")], "file string, text string")
    site.texts = site.texts.where("file <> 'robots.txt'").unionByName(leak)
    assert audit.verbatim(site).count() == 3 and rows(audit.personal(site)) == [("robots.txt: 1 x e-mail address",)]
    site.redacted_verbatim = True
    with pytest.raises(checks.Abort):
        checks.run_checks(spark, [checks.Check("6c", "x", lambda: audit.verbatim(site))])


def test_find_values_in_blocks(spark, monkeypatch):
    from vellumry.operators import secrets

    monkeypatch.setattr(secrets, "BLOCK", 500)
    values = spark.createDataFrame([(str(k), secrets.ANYWHERE, f"value{k}!") for k in range(6000)], "id string, kind string, value string")
    texts = spark.createDataFrame([(1, " ".join(f"VALUE{k}!" for k in range(0, 6000, 7))), (2, None)], "k long, t string")
    assert secrets.find_values(texts, "k", "t", values).count() == len(range(0, 6000, 7))


def test_wide_gaps_and_null_keys(spark):
    n = spark.createDataFrame([("t", 1), ("t", 2_000_000_000), ("u", None)], "g string, n long")
    assert rows(integrity.gap_ranges(n, "g", "n")) == [("t", 2, 1_999_999_999)]
    a = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    assert rows(integrity.compare_sets(a, a, ["a", "b"])) == [] and integrity.compare_sets(a, a.limit(0), ["a", "b"]).count() == 2
    left, right = spark.createDataFrame([(1, 5), (None, 5), (1, None)], "k int, t int"), spark.createDataFrame([(1, 4, None), (1, 3, "x"), (None, 1, "n")], "k int, t int, v string")
    assert {(r.k, r.t): r.o for r in asof.last_before(left, right, ["k"], "t", "v", "o").collect()} == {(1, 5): None, (None, 5): None, (1, None): None}
    p, r = spark.createDataFrame([(7.0,), (5e8,)], "at double"), spark.createDataFrame([(0.0, 1e9, "all"), (6.0, 8.0, "few")], "lo double, hi double, n string")
    assert rows(asof.range_lookup(p, r, "at", "lo", "hi", 1.0).select("at", "n")) == [(7.0, "all"), (7.0, "few"), (5e8, "all")]


def test_json_editing(spark):
    from vellumry.operators import jsonedit as J

    raw = '{"a@b.org": "x\\u00e9\\/ a@b.org", "n": [1, "k\\"q", {"t": "?pwd=12<4 z"}]}'.encode()
    files = spark.createDataFrame([("f", bytearray(raw)), ("g", bytearray(b'{"a": ')), ("h", bytearray(b'{"a": "\\u0000"}')), ("i", None)], "file string, content binary")
    done, report = J.redact_files(files)
    out = {r.file: r.content for r in done.collect()}
    assert bytes(out["f"]) == '{"a@b.org": "xé/ [email redacted]", "n": [1, "k\\"q", {"t": "?pwd=REDACTED\\u003c4 z"}]}'.encode() and bytes(out["g"]) == b'{"a": ' and out["i"] is None
    assert rows(report) == [("f", "R2", 1, 1), ("f", "R4", 1, 1)] and {r.file for r in files_invalid(files)} == {"g", "h", "i"}
    assert J.leaf_changes({"a": ["x", 1]}, {"a": ["y", 1]}) == [("x", "y")] and J.leaf_changes({"a": 1}, {"a": 2}) is None and not J.same_shape([1], [1, 2])
    with pytest.raises(ValueError):
        J.decode('"\\ud800"')
    assert J.decode('"\\ud83d\\ude00"') == "\U0001f600" and J.decode(J.encode('a"\\\x01<é')) == 'a"\\\x01<é'


def files_invalid(df):
    return files.invalid_json(df).collect()


def test_http_source(spark):
    from vellumry.sources import http

    replies = {"http://h.org/a": [http.Reply(302, b"", {"location": "/b"})], "http://h.org/b": [http.Reply(429, b"", {"retry-after": "7"}), http.Reply(200, b"ok", {"content-type": "t"})], "http://h.org/c": [http.Reply(301, b"", {"location": "http://o.org/"})], "http://h.org/d": [http.Reply(500)] * 9}
    slept, clock = [], [0.0]
    transport = lambda u: replies[u].pop(0) if len(replies[u]) > 1 else replies[u][0]
    c = http.Client(transport, lambda s: (slept.append(round(s, 1)), clock.__setitem__(0, clock[0] + s)), lambda: clock[0])
    assert c.fetch("http://h.org/a")[0].body == b"ok" and 7.0 in slept and slept.count(0.7) >= 1
    assert c.fetch("http://h.org/c")[0].status == 301 and c.fetch("http://h.org/d")[0].status == 500 and slept[-1] == 40.0
    spark.dataSource.register(http.HttpSource)
    df = spark.read.format("vellumry_http").option("urls", "x:1\nx:2").option("transport", "tests_transport_missing:none")
    assert df.load().columns == ["url", "status", "content_type", "content", "error"]


def test_documents(spark):
    import gzip
    import io
    import zipfile
    import zlib

    from vellumry.sources import pdf

    stream = zlib.compress(b"BT /F1 12 Tf (Hello \\(you\\)) Tj T* [(a) -20 (b@c.org)] TJ ET")
    raw = b"%PDF-1.4\n1 0 obj\n<< /Length 9 /Filter /FlateDecode >>\nstream\n" + stream + b"\nendstream\nendobj\n"
    assert pdf.text_of(raw) == "Hello (you)\nab@c.org" and pdf.text_of(b"x") is None
    m = pdf.cmap(b"begincodespacerange <00> <ff> endcodespacerange beginbfrange <01> <03> <0041> endbfrange beginbfchar <09> <00e9> endbfchar")
    assert pdf.mapped(b"\x01\x03\x09\x7f", m) == "ACé"
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("word/document.xml", "<w:p>one</w:p><w:p>two</w:p>")
    rows_ = [(raw,), (z.getvalue(),), (gzip.compress(b'pagefind_dcd{"url": "/a/"}'),), (gzip.compress(b'other{"url": 1}'),), (b"x",)]
    df = spark.createDataFrame([(bytearray(r),) for (r,) in rows_], "content binary")
    assert [r.k for r in df.select(files.kind_by_magic(F.col("content")).alias("k")).collect()] == ["pdf", "word", "gzip", "gzip", "other"]
    assert [r.j for r in df.select(files.gzip_json(F.col("content")).alias("j")).collect()] == [None, None, '{"url": "/a/"}', None, None]
    assert [r.d is not None for r in df.select(files.docx_text(F.col("content")).alias("d")).collect()] == [False, True, False, False, False]


def test_attribute_relation(spark):
    p = spark.createDataFrame([(1, "<a href=x class='b c'>t</a><br>"), (2, None)], "page_id long, html string")
    assert rows(html.attribute_relation(p, "page_id", "html").fillna("")) == [(1, 1, "a", "class", "b c"), (1, 1, "a", "href", "x"), (1, 2, "br", "", "")]


def test_json_source_and_sinks(spark, tmp_path):
    (tmp_path / "topic").mkdir()
    post = {"id": 1, "post_number": 1, "topic_id": 7, "cooked": "<p>", "hidden": False}
    (tmp_path / "topic/7.json").write_text(json.dumps({"id": 7, "slug": "s", "post_stream": {"stream": [1, 2], "posts": [post]}}))
    (tmp_path / "topic/7-posts-1.json").write_text(json.dumps({"post_stream": {"posts": [post | {"id": 2, "deleted_at": "2020"}]}}))
    (tmp_path / "topic/odd.json").write_text("{}")
    t, p, stray = files.topics(spark, str(tmp_path))
    (tmp_path / "topic/9-posts-1.json").write_text(json.dumps({"post_stream": {"posts": []}}))
    (tmp_path / "topic/8.json").write_text(json.dumps({"id": 8, "slug": "q", "tags": ["a", {"name": "b"}], "post_stream": {"posts": [post]}}))
    t, p, stray = files.topics(spark, str(tmp_path))
    assert sorted(r.id for r in t.collect()) == [7, 8] and sorted(r.file for r in stray.collect()) == ["8.json", "9-posts-1.json", "odd.json"]
    assert [r.id for r in files.renderable(p).collect()] == [1, 1] and p.count() == 3
    m = files.manifest(spark, str(tmp_path / "topic"))
    assert m.count() == 5 and m.where(F.length("sha256") == 64).count() == 5
    lines = spark.createDataFrame([("a",), ("b",)], "l string")
    for _ in range(2):
        sinks.write_text(spark, lines, "l", str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    with pytest.raises(OSError):
        sinks.write_text(spark, spark.createDataFrame([("a\nb",)], "l string"), "l", str(tmp_path / "bad"))
    assert sinks.owner_of(spark, str(tmp_path / "out"), "_SUCCESS") == "ours" and sinks.owner_of(spark, str(tmp_path), "mark") == "foreign" and sinks.owner_of(spark, str(tmp_path / "no"), "m") == "absent"
    with pytest.raises(ValueError):
        sinks.check_apart(str(tmp_path), str(tmp_path / "out"))
    (tmp_path / "categories.json").write_text(json.dumps({"category_list": {"categories": [{"id": 1, "slug": "a", "name": "A", "position": 2, "topic_url": "/t/about/5", "subcategory_list": [{"id": 2, "slug": "b", "name": "B", "subcategory_list": [{"id": 3, "slug": "c"}]}]}]}}))
    got = {r.id: (r.parent_id, r.about_topic_id) for r in files.categories(spark, str(tmp_path / "categories.json")).collect()}
    assert got == {1: (None, 5), 2: (1, None), 3: (2, None)}
    (tmp_path / "allow.json").write_text(json.dumps({"addresses": [{"address": "A@b.org", "reason": "office"}]}))
    assert files.allowlist(spark, str(tmp_path / "allow.json")) == ("a@b.org",)
    (tmp_path / "site.json").write_text(json.dumps({"title": "T", "logo_url": None}))
    assert tuple(files.site_metadata(spark, str(tmp_path / "site.json")).first()) == ("T", "", "", "", "")


def test_resumable_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = files.TOPIC
    for k in (1, 2):
        (src / f"{k}.json").write_text(json.dumps({"id": k, "slug": "s"}))
        ingest.ingest_json(spark, str(src), schema, str(tmp_path / "t"), str(tmp_path / "c"))
        assert spark.read.parquet(str(tmp_path / "t")).count() == k
