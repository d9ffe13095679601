"""URL expressions: tolerant splitting, kinds, decoding, normal forms, references in texts. Built-in functions only; nulls give nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumry.functions.redact import bound

_SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"
# First segments of assets, of avatars among them, and of pages; attributes that hold URLs.
ASSET_DIRS = ["uploads", "user_avatar", "letter_avatar_proxy", "images", "plugins", "assets", "secure-uploads"]
AVATAR_DIRS = ["user_avatar", "letter_avatar_proxy"]
PROFILE_DIRS = ["u", "users", "groups", "g"]
URL_ATTRIBUTES = ["href", "src", "srcset", "imagesrcset", "poster", "cite", "action", "formaction", "longdesc", "background"]
UNSAFE_SCHEMES = ["javascript", "vbscript", "data"]


def tidy(u: Column) -> Column:
    """White space at the ends, and line breaks and tabs anywhere, are no part of a URL."""
    return F.translate(F.btrim(u, F.lit(" \t\r\n")), "\t\r\n", "")


def _after(c: Column, sign: str) -> Column:
    at = F.instr(c, sign)
    return F.when(at > 0, c.substr(at + 1, F.length(c))).otherwise("")


def split_url(u: Column) -> Column:
    """struct(scheme, auth, host, path, query, fragment, has_auth, has_query, has_fragment); host without user and port.

    Cut from the outside in: fragment, query, scheme, authority; what is left is the path.
    """

    def parts(x: Column) -> Column:
        page = F.substring_index(x, "#", 1)
        rest = F.substring_index(page, "?", 1)
        below = F.regexp_replace(rest, _SCHEME, "")
        has_auth = F.startswith(below, F.lit("//"))
        auth = F.when(has_auth, F.substring_index(below.substr(F.lit(3), F.length(below)), "/", 1)).otherwise("")
        path = F.when(has_auth, below.substr(F.length(auth) + 3, F.length(below))).otherwise(below)
        host = F.lower(F.regexp_replace(F.substring_index(auth, "@", -1), ":[0-9]*$", ""))
        return F.struct(
            F.lower(F.regexp_extract(rest, _SCHEME, 1)).alias("scheme"), auth.alias("auth"), host.alias("host"), path.alias("path"),
            _after(page, "?").alias("query"), _after(x, "#").alias("fragment"),
            has_auth.alias("has_auth"), page.contains("?").alias("has_query"), x.contains("#").alias("has_fragment"),
        )

    return F.when(u.isNotNull(), bound(tidy(u), parts))


def _is_web(p: Column) -> Column:
    return p["scheme"].isin("http", "https") | ((p["scheme"] == "") & p["has_auth"])


def link_kind(p: Column, own: str) -> Column:
    """internal, external, malformed (a web address without host) or skipped (mailto, tel ...), as an audit of links sees it."""
    def kind(x: Column) -> Column:
        of_web = F.when(x["host"] == "", "malformed").when(x["host"] == own, "internal").otherwise("external")
        return F.when(x.isNotNull(), F.when(_is_web(x), of_web).when(x["scheme"] != "", "skipped").otherwise("internal"))

    return bound(p, kind)


def rewrite_kind(p: Column, own: str) -> Column:
    """unsafe, mailto, fragment, internal, external, relative or other, as a rewriter of links sees it: the authority counts whole."""

    def kind(x: Column) -> Column:
        local = F.when(F.startswith(x["path"], F.lit("/")), "internal").when((x["path"] != "") | x["has_query"], "relative").when(x["has_fragment"], "fragment").otherwise("other")
        k = F.when(x["scheme"].isin(UNSAFE_SCHEMES), "unsafe").when(x["scheme"] == "mailto", "mailto")
        k = k.when(x["scheme"].isin("http", "https") | ((x["scheme"] == "") & (x["auth"] != "")), F.when(F.lower(x["auth"]) == own, "internal").otherwise("external"))
        return F.when(x.isNotNull(), k.when(x["scheme"] != "", "external").otherwise(local))

    return bound(p, kind)


def reference_kind(path: Column, page_dirs: list[str]) -> Column:
    """asset, page or unclassified, of a path on the own host, by its first segment."""
    first = F.coalesce(F.get(F.split(path, "/"), F.lit(1)), F.lit(""))
    return F.when((first == "") | first.isin(page_dirs), "page").when(first.isin(ASSET_DIRS) & ~F.endswith(path, F.lit("/")), "asset").otherwise("unclassified")


def root_relative(p: Column) -> Column:

    def joined(x: Column) -> Column:
        query = F.when(x["has_query"], F.concat(F.lit("?"), x["query"])).otherwise("")
        return F.concat(x["path"], query, F.when(x["has_fragment"], F.concat(F.lit("#"), x["fragment"])).otherwise(""))

    return bound(p, joined)


def _decoded(c: Column) -> Column:
    return F.try_url_decode(F.replace(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B")))


def percent_decode(c: Column) -> Column:
    """%XX decoded as UTF-8, other % and + kept; null if a NUL or invalid UTF-8 comes out."""
    good = lambda x, y: F.when(~(x.contains("%00") | (y.contains("\ufffd") & ~x.rlike("(?i)\ufffd|%EF%BF%BD"))), y)
    return bound(c, lambda x: F.when(~x.contains("%"), x).otherwise(bound(_decoded(x), lambda y: good(x, y))))


def percent_decode_tolerant(c: Column) -> Column:
    """As percent_decode, but a NUL is dropped, and what would be invalid UTF-8 stays as it is written."""
    return bound(c, lambda x: F.coalesce(percent_decode(F.replace(x, F.lit("%00"), F.lit(""))), x))


def segments(path: Column) -> Column:
    """Segments of a path that aren't empty."""
    return F.filter(F.split(path, "/"), lambda s: s != "")


def normalize_dots(path: Column) -> Column:
    """. and .. segments resolved, the result from the root; paths without them stay as they are.

    Read from the right, a segment stays unless one of the .. behind it is still to be paid for.
    """
    step = lambda acc, s: (
        F.when(s == "..", F.struct(acc["kept"].alias("kept"), (acc["debt"] + 1).alias("debt")))
        .when(acc["debt"] > 0, F.struct(acc["kept"].alias("kept"), (acc["debt"] - 1).alias("debt")))
        .otherwise(F.struct(F.concat(F.array(s), acc["kept"]).alias("kept"), acc["debt"].alias("debt")))
    )
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("debt"))

    def inner(x: Column) -> Column:
        kept = F.aggregate(F.filter(F.reverse(segments(x)), lambda s: s != "."), start, step, lambda acc: acc["kept"])
        folder = F.element_at(F.split(x, "/"), -1).isin("", ".", "..")
        joined = bound(kept, lambda k: F.concat(F.lit("/"), F.array_join(k, "/"), F.when(folder & (F.size(k) > 0), "/").otherwise("")))
        return F.when(F.exists(F.split(x, "/"), lambda s: s.isin(".", "..")), joined).otherwise(x)

    return bound(path, inner)


def target_file(path: Column) -> Column:
    """The file a URL path asks for."""
    rel = F.regexp_replace(path, "^/", "")
    return F.concat(rel, F.when((rel == "") | F.endswith(rel, F.lit("/")), "index.html").otherwise(""))


def page_url(file: Column) -> Column:
    """Inverse of target_file."""
    name = F.element_at(F.split(file, "/"), -1)
    return F.concat(F.lit("/"), F.when(name == "index.html", file.substr(F.lit(1), F.length(file) - 10)).otherwise(file))


def resolve(p: Column, base: Column) -> Column:
    """struct(path, file, fragment) of a split URL on the page with the URL path base: absolute, dots resolved, decoded."""

    def path(s: Column) -> Column:
        own, below = s["p"]["path"], F.regexp_replace(s["base"], "[^/]*$", "")
        return F.when(own == "", F.when(s["p"]["has_auth"], "/").otherwise(s["base"])).when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(below, own))

    def found(s: Column) -> Column:
        whole = percent_decode_tolerant(normalize_dots(path(s)))
        return bound(whole, lambda x: F.struct(x.alias("path"), target_file(x).alias("file"), percent_decode_tolerant(s["p"]["fragment"]).alias("fragment")))

    return bound(F.struct(p.alias("p"), base.alias("base")), found)


def first_segment(path: Column) -> Column:
    return F.coalesce(F.get(segments(path), F.lit(0)), F.lit(""))


def srcset_candidates(c: Column) -> Column:
    """array<struct(url, descriptor)> of a srcset: candidates are parted by commas that white space or the end follows, or that follow white space."""
    parts = F.split(F.btrim(c, F.lit(" \t\r\n,")), r",+(?=\s)|(?<=\s),+|,+$|(?<=\s[0-9.]{1,9}[wx]),+")
    words = F.transform(parts, lambda p: F.split(F.btrim(p, F.lit(" \t\r\n,")), r"\s+"))
    one = lambda w: F.struct(F.get(w, F.lit(0)).alias("url"), F.coalesce(F.get(w, F.lit(1)), F.lit("")).alias("descriptor"))
    return F.filter(F.transform(words, one), lambda x: x["url"] != "")


def srcset_urls(c: Column) -> Column:
    """URLs of a srcset value."""
    return F.transform(srcset_candidates(c), lambda x: x["url"])


def hrefs(html: Column) -> Column:
    """All href values of a page, quoted either way or bare; other attributes that end in href aren't meant."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)(?<![\w:-])href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1))
    return F.transform(found, lambda v: F.when(v.substr(1, 1).isin('"', "'"), v.substr(F.lit(2), F.length(v) - 2)).otherwise(v))


def own_references(html: Column, own: str) -> Column:
    """URLs of the own host, absolute, without scheme or from the root, anywhere in raw HTML; &amp; decoded, a comma behind one dropped."""
    host = own.replace(".", "\\.")
    found = F.regexp_extract_all(html, F.lit(rf"""((?<![\w.~%:/<-])(?:(?i:(?:https?:)?//{host})(?![\w.-])|(?=/[A-Za-z0-9_]))[^\s"'<>\\)]*)"""), F.lit(1))
    urls = F.transform(found, lambda u: F.replace(F.regexp_replace(u, ",+$", ""), F.lit("&amp;"), F.lit("&")))
    return F.filter(urls, lambda u: u != "")


def asset_paths(html: Column, own: str) -> Column:
    """Decoded paths of the own host's assets that raw HTML names anywhere: own references whose path lies below a folder of assets.

    A comma or & ends a path, as lists of candidates and queries go on there; punctuation at its end isn't meant.
    """
    refs = own_references(F.translate(html, ",&", "  "), own)
    paths = F.transform(refs, lambda u: F.rtrim(split_url(u)["path"], F.lit(".;:!")))
    below = lambda p: F.get(F.split(p, "/"), F.lit(1)).isin(ASSET_DIRS) & (F.size(F.split(p, "/")) > 2)
    return F.transform(F.filter(paths, below), percent_decode_tolerant)


def glob_regex(glob: Column) -> Column:
    r"""Regex of a rule source: :name is one segment, * is anything, all else is meant literally (\Q..\E)."""
    pieces = F.regexp_extract_all(glob, F.lit(r"(:[A-Za-z_]\w*|\*|[^:*]+|:)"), F.lit(1))
    one = lambda p: F.when(p == "*", ".*").when(p.rlike("^:."), "[^/]+").otherwise(F.concat(F.lit("\\Q"), F.replace(p, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")))
    return F.concat(F.lit("^"), F.array_join(F.transform(pieces, one), ""), F.lit("$"))


def safe_path(path: Column) -> Column:
    """Whether a decoded path can be a file below a folder: no .. or empty segment, no control character or backslash, at most 255 bytes a segment."""
    good = lambda s: ~s.isin("", ".", "..") & (F.octet_length(s) <= 255)
    return ~path.rlike(r"[\x00-\x1f\x7f\\]") & F.forall(F.split(path, "/"), good)


def safe_file(path: Column) -> Column:
    """The relative file of a decoded path, empty and . segments left out; null if it isn't safe."""
    rel = F.array_join(F.filter(segments(path), lambda s: s != "."), "/")
    return F.when(safe_path(rel), rel)


def sitemap_loc(url: Column) -> Column:
    """A URL as text of a sitemap: characters that URLs don't hold percent-encoded (as UTF-8), & as a reference."""
    code = F.transform(F.split(url, ""), lambda ch: F.when(ch.rlike(r"^[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]$"), ch).otherwise(F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")))
    return F.replace(F.array_join(code, ""), F.lit("&"), F.lit("&amp;"))
