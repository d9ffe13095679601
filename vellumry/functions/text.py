"""Text expressions: visible text of HTML, tokens, escaping, dates. Nulls give nulls."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumry.functions.redact import PASSCODE_PARAMS, bound

# Elements that start a new line of text, and those whose content isn't shown.
BLOCK_ELEMENTS = (
    "address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul"
).split()
UNSHOWN = ("script", "style", "template")
# Character references that are decoded, & last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


def visible_text(html: Column, keep_code: bool = False) -> Column:
    """What a reader sees: block tags are line breaks, inline tags are nothing, four entities are decoded.

    The page is cut at every "<"; of each piece the tag goes, and leaves a line break if
    its name is a block element's. A "<" that no ">" follows is text.
    """
    off = [r"<!--.*?-->", *([] if keep_code else [rf"<{x}(?!\w)[^>]*>.*?</{x}\s*>" for x in UNSHOWN])]
    pieces = F.split(F.regexp_replace(html, "(?is)" + "|".join(off), ""), "<")

    def text_of(piece: Column, i: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, r"^/?([A-Za-z][\w:-]*)", 1))
        end = F.instr(piece, ">")
        rest = F.when(end > 0, piece.substr(end + 1, F.length(piece))).otherwise(F.concat(F.lit("<"), piece))
        return F.when(i == 0, piece).otherwise(F.concat(F.when((end > 0) & name.isin(BLOCK_ELEMENTS), "\n").otherwise(""), rest))

    text = F.array_join(F.transform(pieces, text_of), "")
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def escape_html(c: Column, attribute: bool = False) -> Column:
    """Text for HTML: & < > and no-break spaces as references, " too in attributes; control characters go."""
    x = F.regexp_replace(c, r"[\x01-\x08\x0b\x0c\x0e-\x1f\x7f]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\u00a0", "&nbsp;"), *([('"', "&quot;")] if attribute else [])):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def unix_lines(c: Column) -> Column:
    """CR LF and CR as LF."""
    return F.regexp_replace(c, r"\r\n?", "\n")


def _marked(e: UnicodeError) -> tuple[str, int]:
    """Each byte that is no part of a character as <xx>."""
    return "".join(f"<{b:02x}>" for b in e.object[e.start : e.end]), e.end


codecs.register_error("vellumry_marked", _marked)


def _repair(batch: pd.Series) -> pd.Series:
    codecs.register_error("vellumry_marked", _marked)  # in the worker's process
    return batch.map(lambda b: None if b is None else b.decode("utf-8", "vellumry_marked"))


def _repair_without_nul(batch: pd.Series) -> pd.Series:
    return _repair(batch.map(lambda b: None if b is None else b.replace(b"\0", b"")))


def repaired(bytes_: Column, drop_nul: bool = False) -> Column:
    """Text of bytes; every byte that belongs to no character (overlong forms, halves of pairs and what lies beyond U+10FFFF included) as <xx>, in hexadecimal.

    Valid texts, which all or nearly all are, stay in the JVM; null stays null. drop_nul: NUL bytes go first, so what they part comes together.
    """
    text = bytes_.cast("string")
    fix = F.pandas_udf(_repair_without_nul if drop_nul else _repair, "string")
    good = F.replace(text, F.lit("\u0000"), F.lit("")) if drop_nul else text
    return F.coalesce(F.when(F.is_valid_utf8(text), good), fix(F.when(~F.is_valid_utf8(text), bytes_)))


def clean_text(bytes_: Column) -> Column:
    """Text of bytes: NUL dropped, invalid UTF-8 repaired, LF line ends."""
    return unix_lines(repaired(bytes_, drop_nul=True))


def parse_utc(c: Column) -> Column:
    """struct(at timestamp, has_time boolean) of a date text; null where it isn't one.

    A day, then perhaps a time (T or a blank before it; seconds and their fraction may
    lack), then perhaps Z or an offset of hours (and minutes, a colon between them or not),
    blanks before it or not, then perhaps a blank and UTC. Seconds count whole.
    """
    day = r"(\d{4}-\d\d-\d\d)"
    clock = r"[T ](\d\d:\d\d)(?::(\d\d)(?:\.\d+)?)?"
    shape = rf"^{day}(?:{clock})?\s*(Z|[+-]\d\d(?::?\d\d)?)?(?:\s+UTC)?$"

    def parsed(x: Column) -> Column:
        part = lambda i: F.regexp_extract(x, shape, i)
        minute = F.when(part(2) == "", "00:00").otherwise(part(2))
        second = F.when(part(3) == "", "00").otherwise(part(3))
        local = F.try_to_timestamp(F.concat(part(1), F.lit(" "), minute, F.lit(":"), second), F.lit("yyyy-MM-dd HH:mm:ss"))
        digits = F.rpad(F.regexp_replace(part(4), "[^0-9]", ""), 4, "0")
        east = digits.substr(1, 2).cast("int") * 3600 + digits.substr(3, 2).cast("int") * 60
        shift = F.when(F.startswith(part(4), F.lit("-")), -east).otherwise(east)
        at = F.timestamp_seconds(F.unix_timestamp(local) - shift)
        return F.when(x.rlike(shape) & local.isNotNull(), F.struct(at.alias("at"), (part(2) != "").alias("has_time")))

    return bound(F.btrim(c, F.lit(" \t\r\n")), parsed)


def iso(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_and_minute(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm 'UTC'")


def extension(path: Column) -> Column:
    """Lower-case ending of the last segment of a path; empty without one."""
    return F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))


def scrub(c: Column) -> Column:
    """Addresses and parameter values out of a log line."""
    x = F.regexp_replace(c, r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<address>")
    return F.regexp_replace(x, rf"((?i:{'|'.join(PASSCODE_PARAMS)})=)[^\s\"'<>&#]+", "$1<value>")


def first_of(values: Column, most: int = 10) -> Column:
    """'a, b, c … (n in all)' of a sorted array: the first ``most``, and how many there are if there are more."""
    shown = F.array_join(F.slice(values, 1, most), ", ")
    return F.when(F.size(values) > most, F.concat(shown, F.lit(" … ("), F.size(values), F.lit(" in all)"))).otherwise(shown)


def label_count(n: Column, one: str, many: str) -> Column:
    return F.concat(n.cast("string"), F.when(n == 1, f" {one}").otherwise(f" {many}"))


def display_name(name: Column, user: Column) -> Column:
    """The name if there is one that differs from the user name, else nothing; '(unknown author)' without both."""
    has = F.coalesce(name, F.lit("")) != ""
    return F.when(has & (F.lower(name) != F.lower(F.coalesce(user, F.lit("")))), name).when(F.coalesce(user, F.lit("")) != "", "").otherwise("(unknown author)")
