"""Pure column functions on hand-written cases."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellumry.functions import redact as R
from vellumry.functions import text as X
from vellumry.functions import urls as U
from vellumry.sources.files import backoff


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).collect()[0].r


@pytest.mark.parametrize(
    "before, after",
    [
        ("logo@2x.png", "logo@2x.png"),
        ("a.b@example.org.", "[email redacted]."),
        ('<a href="mailto:x@example.org">mail x@example.org</a>', '<span class="email-redacted">mail [email redacted]</span>'),
        ("jo (at) example (dot) org", "[email redacted]"),
        ("Vienna (AT) 21.May", "Vienna (AT) 21.May"),
        ("?pwd=Abc123&x=1", "?pwd=REDACTED&x=1"),
        ("Kenncode: 123456", "Kenncode: REDACTED"),
        ("Password: hello", "Password: hello"),
        ("u ?pwd=AbCdEf123456xyz and #u-abcdef123456xyz-", "u ?pwd=REDACTED and #u-REDACTED-"),
        ("?pwd=shortval123 shortval123", "?pwd=REDACTED shortval123"),
        ("a (at] b {dot) example", "a (at] b {dot) example"),
        ("a [at] b {dot} example (dot) co.uk, b(at)c(dot)d", "[email redacted].uk, b(at)c(dot)d"),
        ("x (at) y (at) z (dot) org1 (dot) de (dot) 7", "x (at) [email redacted] (dot) 7"),
        ("x (dot) y (at)  (dot) org and (at) z (dot) org", "x (dot) y (at)  (dot) org [email redacted]"),
        ("a (at) b (dot) orgx1 (at) c (dot) de", "[email redacted][email redacted]"),
        ("<a href=mailto:a@b.org>m</a>", "<a href=mailto:[email redacted]>m</a>"),
        ("<a x='1' HREF = 'mailto:a>b'>m</a >", '<span class="email-redacted">m</span>'),
        ("?pwd=REDACTED&password=REDACTEDx&pwd=", "?pwd=REDACTED&password=REDACTED&pwd="),
        ("", ""),
        (None, None),
    ],
)
def test_redact(spark, before, after):
    assert one(spark, before, R.redact) == after


def test_redact_twice_changes_nothing(spark):
    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.sampled_from(["a@b.org ", "?pwd=", "x1y2z3w4v5u6t7 ", "Kennwort: 12ab ", "(at)", " (dot) ", "org ", "<a href='mailto:q@r.de'>q</a> "]), max_size=8))
    def run(parts):
        once = one(spark, "".join(parts), R.redact)
        assert one(spark, once, R.redact) == once

    run()


def test_allowlist(spark):
    text = "HELP@example.org xhelp@example.org help@example.org.uk \ue0a1"
    assert one(spark, text, lambda c: R.redact(c, ("help@example.org",))) == "HELP@example.org [email redacted] [email redacted] \ue0a1"
    assert R.check_allowlist([("A@b.org", "office")]) == ("a@b.org",)
    for bad in ([("a@b.org", "")], [("a@b", "x")], [("a@b.org", "x"), ("A@B.org", "y")], [(f"a{k}@b.org", "x") for k in range(101)]):
        with pytest.raises(ValueError):
            R.check_allowlist(bad)


@pytest.mark.parametrize("path, out", [("/a/./b/../c/", "/a/c/"), ("/a/b", "/a/b"), ("/..", "/"), ("/a/..", "/"), ("", ""), (None, None)])
def test_normalize_dots(spark, path, out):
    assert one(spark, path, U.normalize_dots) == out


@pytest.mark.parametrize("text, out", [("100%zz", "100%zz"), ("a+b", "a+b"), ("a%20b", "a b"), ("%00", None), ("%ff", None), ("%C3%BC", "ü"), (None, None)])
def test_percent_decode(spark, text, out):
    assert one(spark, text, U.percent_decode) == out


def test_split_and_kinds(spark):
    r = one(spark, "HTTPS://u@H.Example.org:80/a b?q#f", U.split_url)
    assert (r.scheme, r.host, r.path, r.query, r.fragment) == ("https", "h.example.org", "/a b", "q", "f")
    kinds = {"//x.org/y": "external", "/a": "internal", "mailto:a": "skipped", "http:///a": "malformed", "#top": "internal"}
    assert {k: one(spark, k, lambda c: U.link_kind(U.split_url(c), "own.org")) for k in kinds} == kinds
    kinds = {"javascript:x": "unsafe", "#a": "fragment", "": "other", "a/b": "relative", "/t/1": "internal", "https://own.org/x": "internal"}
    assert {k: one(spark, k, lambda c: U.rewrite_kind(U.split_url(c), "own.org")) for k in kinds} == kinds


def test_srcset_hrefs_files(spark):
    assert one(spark, "u1, u2 1.5x, u3 2x", U.srcset_urls) == ["u1", "u2", "u3"]
    assert one(spark, "<a href='x'><a HREF=y><a href=\"z\">", U.hrefs) == ["x", "y", "z"]
    assert one(spark, "/t/a/", U.target_file) == "t/a/index.html"
    assert one(spark, "t/a/index.html", U.page_url) == "/t/a/"
    assert one(spark, "/t/:id/*", U.glob_regex) == r"^\Q/t/\E[^/]+\Q/\E.*$"


@pytest.mark.parametrize(
    "text, out",
    [
        ("2022-07-14T12:00:00.306Z", "2022-07-14 12:00:00"),
        ("2022-07-14 12:00 UTC", "2022-07-14 12:00:00"),
        ("2022-07-14", "2022-07-14 00:00:00"),
        ("2022-07-14T12:00+02:00", "2022-07-14 10:00:00"),
        ("2022-13-40", None),
        ("bogus", None),
        ("2022-07-14T12:00+02:00 UTC", "2022-07-14 10:00:00"),
        ("2022-07-14 12:00 +02:00", "2022-07-14 10:00:00"),
        ("2022-07-14 12:00Z UTC", "2022-07-14 12:00:00"),
        ("2022-07-14T12:00+02:", None),
    ],
)
def test_dates(spark, text, out):
    assert one(spark, text, lambda c: X.parse_utc(c)["at"].cast("string")) == out


def test_visible_text_and_tokens(spark):
    t = one(spark, "<p>foo<b>bar</b></p><p>x &amp; y</p><!-- z --><script>no()</script>", X.visible_text)
    assert t.split() == ["foobar", "x", "&", "y"]
    assert one(spark, "Foo-Bar é1", X.tokens) == ["foo", "bar", "é1"]


def test_backoff():
    assert [backoff(k) for k in (1, 2, 5)] == [10, 20, 120] and backoff(1, 900) == 600
