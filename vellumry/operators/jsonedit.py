"""JSON files edited in place: string literals found by byte offsets, redacted as columns, put back byte by byte.

Only literals that change are written anew; every other byte of a file stays. Files are read and written by Spark,
literals are cut and put back in Python (Arrow batches), the rules run as Column expressions between.

Nulls and content that isn't JSON: ``literals`` gives one row with an error and no literals, ``splice`` returns the bytes as they are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumry.functions import redact as R

_STRING = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"', re.S)
_SURROGATE = re.compile(r"\\u([dD][89abAB][0-9a-fA-F]{2})(\\u[dD][c-fC-F][0-9a-fA-F]{2})?|\\u([dD][c-fC-F][0-9a-fA-F]{2})")
# What a changed literal escapes by letter, and what it writes as \uxxxx besides control characters.
_LETTERS = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
_CODES = "<>&  "
_ESCAPED = re.compile(rf'[\x00-\x1f"\\{_CODES}]')


def strict(text: str) -> object:
    """A parsed document; NaN, infinities and repeated keys are faults."""

    def no(x: str) -> None:
        raise ValueError(f"{x} is no JSON number")

    def pairs(p: list) -> dict:
        if len({k for k, _ in p}) < len(p):
            raise ValueError("a key occurs twice")
        return dict(p)

    return json.loads(text, parse_constant=no, object_pairs_hook=pairs)


def tokens(raw: bytes) -> list[tuple[int, int, bool]]:
    """(start, end, is a key) of every string literal of a JSON text, as byte offsets."""
    out = []
    for m in _STRING.finditer(raw):
        k = m.end()
        while raw[k : k + 1] in (b" ", b"\t", b"\r", b"\n"):
            k += 1
        out.append((m.start(), m.end(), raw[k : k + 1] == b":"))
    return out


def decode(literal: str) -> str:
    """The value of a literal; NUL escapes and surrogates without their other half are refused, as they can't be read safely."""
    if "\\u" in literal:
        if re.search(r"(?<!\\)(?:\\\\)*\\u0000", literal):
            raise ValueError("a NUL escape")
        bare = literal.replace("\\\\", "")
        for m in _SURROGATE.finditer(bare):
            if m[3] or (m[1] and not m[2]):
                raise ValueError("half a surrogate pair")
    return json.loads(literal, strict=False)


def encode(value: str) -> str:
    """The literal of a changed value: quotes, backslashes, control characters, < > & and the two line separators escaped, all else as it is."""
    return '"' + _ESCAPED.sub(lambda m: _LETTERS.get(m[0]) or f"\\u{ord(m[0]):04x}", value) + '"'


def splice(raw: bytes, edits: list[tuple[int, int, bytes]]) -> bytes:
    """raw with [start:end] replaced, for edits that don't overlap."""
    out, at = [], 0
    for start, end, new in sorted(edits):
        if start < at:
            raise ValueError("edits overlap")
        out += [raw[at:start], new]
        at = end
    return b"".join([*out, raw[at:]])


def strings(doc: object) -> tuple[list[str], list[str]]:
    """(values, keys) of a parsed document, in document order."""
    values, keys, todo = [], [], [doc]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            values.append(x)
        elif isinstance(x, dict):
            keys += x
            todo += reversed(x.values())
        elif isinstance(x, list):
            todo += reversed(x)
    return values, keys


def same_shape(a: object, b: object) -> bool:
    """Same kinds, names and lengths at every level."""
    if isinstance(a, dict) and isinstance(b, dict):
        return list(a) == list(b) and all(same_shape(a[k], b[k]) for k in a)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same_shape, a, b))
    return type(a) is type(b) and not isinstance(a, (dict, list))


def leaf_changes(a: object, b: object) -> list[tuple[str, str]] | None:
    """(before, after) of the strings that differ in documents of one shape; None if shapes or other leaves differ."""
    if not same_shape(a, b):
        return None
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        if isinstance(x, dict):
            todo += reversed([(x[k], y[k]) for k in x])
        elif isinstance(x, list):
            todo += reversed(list(zip(x, y)))
        elif x != y:
            if not isinstance(x, str):
                return None
            out.append((x, y))
    return out


_LITERAL = "file string, ord int, start long, stop long, is_key boolean, value string, error string"


def _read(raw: bytes | None) -> list[tuple[int, int, bool, str]]:
    """(start, end, is a key, value) of every string literal of a file; a ValueError if it isn't JSON that can be edited safely."""
    if raw is None:
        raise ValueError("no content")
    text = raw.decode("utf-8")
    if "\0" in text:
        raise ValueError("a NUL")
    doc = strict(text)
    found = [(s, e, k, decode(raw[s:e].decode())) for s, e, k in tokens(raw)]
    values, keys = strings(doc)
    if len(found) != len(values) + len(keys) or [v for *_, k, v in found if not k] != values:
        raise ValueError("literals and document disagree")
    return found


def _literals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string()]
    for b in batches:
        rows = []
        for file, raw in zip(b.column(0).to_pylist(), b.column(1)):
            raw = raw.as_py()
            try:
                rows += [(file, n, s, e, k, v, None) for n, (s, e, k, v) in enumerate(_read(raw))] or [(file, None, None, None, None, None, None)]
            except ValueError as e:
                rows.append((file, None, None, None, None, None, type(e).__name__ + ": " + str(e)[:80]))
        cols = zip(*rows) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["file", "ord", "start", "stop", "is_key", "value", "error"])


def literals(files: DataFrame, file: str = "file", content: str = "content") -> DataFrame:
    """files (file, content binary) -> (file, ord, start, stop, is_key, value, error): every string literal, decoded, with its byte offsets."""
    return files.select(F.col(file).cast("string"), F.col(content).cast("binary")).mapInArrow(_literals, _LITERAL)


def _splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for raw, edits in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            out.append(splice(raw, [(e["start"], e["stop"], encode(e["new"]).encode()) for e in edits]) if edits and raw is not None else raw)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["file", "content"])


def with_edits(files: DataFrame, edits: DataFrame) -> DataFrame:
    """files (file, content), edits (file, start, stop, new) -> (file, content): changed literals put in place."""
    e = edits.groupBy("file").agg(F.collect_list(F.struct("start", "stop", "new")).alias("edits"))
    return files.select("file", F.col("content").cast("binary").alias("content")).join(e, "file", "left").mapInArrow(_splice, "file string, content binary")


_FOUND = "file string, content binary, found array<struct<start: long, stop: long, value: string>>"


def _with_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("value", pa.string())]))
    for b in batches:
        out = []
        for raw in b.column(1):
            try:
                out.append([{"start": s, "stop": e, "value": v} for s, e, k, v in _read(raw.as_py()) if not k])
            except ValueError:
                out.append(None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, kind)], names=["file", "content", "found"])


def with_values(files: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """files (file, content) with each string value that change makes another one put in place; keys, and files that literals() has an error for, stay.

    A file is one row all along, so nothing is shuffled and names needn't differ.
    """
    found = files.select(F.col("file").cast("string").alias("file"), F.col("content").cast("binary").alias("content")).mapInArrow(_with_values, _FOUND)
    new = F.transform("found", lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["value"].alias("value"), change(x["value"]).alias("new")))
    edits = F.transform(F.filter(new, lambda x: x["new"] != x["value"]), lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["new"].alias("new")))
    return found.select("file", "content", edits.alias("edits")).mapInArrow(_splice, "file string, content binary")


def redacted_literals(files: DataFrame, allowed: tuple[str, ...] = ()) -> DataFrame:
    """The string values of files with redacted, n_R1..n_R6 and src_R1..src_R5; keys, and files with an error, are left alone."""
    v = literals(files).where("error IS NULL AND NOT is_key").select("file", "start", "stop", "value")
    return R.rule_counts(v, "value", allowed)


def redact_files(files: DataFrame, allowed: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(files (file, content) redacted, report (file, rule, n, in_source) of rules that did or found something)."""
    v = redacted_literals(files, allowed)
    sums = v.groupBy("file").agg(*[F.sum(f"n_{r}").cast("long").alias(f"n_{r}") for r in R.NAMES], *[F.sum(f"src_{r.id}").cast("long").alias(f"src_{r.id}") for r in R.RULES])
    rule = lambda r: F.struct(F.lit(r).alias("rule"), F.col(f"n_{r}").alias("n"), F.col(f"src_{r}" if r != R.R6 else "n_R6").alias("in_source"))
    report = sums.select("file", F.explode(F.array(*map(rule, R.NAMES))).alias("x")).select("file", "x.*").where("n > 0 OR in_source > 0")
    return with_values(files, lambda v: R.redact(v, allowed)), report


# ---- checks of a redacted tree


def kept_counts(strings_: DataFrame, value: str, allowed: tuple[str, ...]) -> DataFrame:
    """(address, n): how often each allowed address stands in the texts, whole and in any case."""
    found = R.address_pattern()
    each = strings_.where(F.col(value).contains("@")).select(F.explode(F.regexp_extract_all(value, F.lit(f"({found})"), F.lit(1))).alias("a")).select(F.lower("a").alias("address"))
    n = each.groupBy("address").agg(F.count(F.lit(1)).alias("n"))
    listed = strings_.sparkSession.createDataFrame([(a,) for a in allowed], "address string")
    return listed.join(n, "address", "left").na.fill(0)


def conservation(before: DataFrame, after: DataFrame, value: str, allowed: tuple[str, ...]) -> DataFrame:
    """(address, before, after) of allowed addresses that a redaction lost or made."""
    a, b = kept_counts(before, value, allowed).withColumnRenamed("n", "before"), kept_counts(after, value, allowed).withColumnRenamed("n", "after")
    return a.join(b, "address").where("before <> after")


def drift(report: DataFrame, expected: dict[str, int]) -> DataFrame:
    """(rule, n, expected) of rules whose total isn't the expected one: a warning, never a fault."""
    n = report.groupBy("rule").agg(F.sum("n").alias("n"))
    e = report.sparkSession.createDataFrame(list(expected.items()), "rule string, expected long")
    both = e.join(n, "rule", "full_outer").select("rule", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("expected", F.lit(0)).alias("expected"))
    return both.where("n <> expected")


def report_faults(report: DataFrame, totals: DataFrame, total: int) -> DataFrame:
    """(fault): a report whose rows by file, totals by rule (rule, n) and grand total disagree."""
    per = report.groupBy("rule").agg(F.sum("n").alias("m"))
    off = per.join(totals, "rule", "full_outer").na.fill(0).where("m <> n").select(F.concat(F.lit("rule "), "rule").alias("fault"))
    whole = report.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).where(F.col("n") != total).select(F.lit("total").alias("fault"))
    return off.unionByName(whole)


def omitted(entries: DataFrame, path: str, prefixes: list[str]) -> DataFrame:
    """Entries whose path lies below one of the prefixes: the omit rule's."""
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.startswith(F.col(path), F.lit(p))
    return entries.where(F.coalesce(hit, F.lit(False)))


def without_omitted(entries: DataFrame, path: str, prefixes: list[str]) -> tuple[DataFrame, DataFrame]:
    """(entries that stay, counts (assets, missing, ok) brought in line); entries have a column missing (boolean)."""
    rest = entries.join(omitted(entries, path, prefixes).select(path).distinct(), path, "left_anti")
    n = rest.agg(F.count(F.lit(1)).alias("assets"), F.count_if("missing").alias("missing"))
    return rest, n.withColumn("ok", F.col("assets") - F.col("missing"))


def names_of(tags: Column) -> Column:
    """Names of a JSON array of tags that are strings or objects with a name; as array<string>, null for anything else."""
    items = F.from_json(tags, "array<string>")
    one = lambda t: F.when(F.startswith(F.ltrim(t), F.lit("{")), F.get_json_object(t, "$.name")).otherwise(t)
    return F.array_compact(F.transform(items, one))


_NODE = "file string, place string, name string, path string, kind string, leaf string"
_KIND = {str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null"}


def _nodes_of(text: str) -> Iterator[tuple[str, str | None, str, str, str | None]]:
    """(place, name, path, kind, leaf) of every node, members and elements in their order; objects are lists of their members here, so equal names don't hide each other."""
    todo = [("", None, "", json.loads(text, object_pairs_hook=lambda m: ("object", m)))]
    while todo:
        place, name, path, x = todo.pop()
        if isinstance(x, tuple):
            yield place, name, path, "object", None
            todo += reversed([(f"{place}/{k}", key, f"{path}/{key.replace('~', '~0').replace('/', '~1')}", v) for k, (key, v) in enumerate(x[1])])
        elif isinstance(x, list):
            yield place, name, path, "array", None
            todo += reversed([(f"{place}/{k}", None, f"{path}/{k}", v) for k, v in enumerate(x)])
        else:
            yield place, name, path, _KIND[type(x)], x if isinstance(x, str) else json.dumps(x)


def _json_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=[c.split()[0] for c in _NODE.split(", ")])

    for b in batches:
        rows: list[tuple] = []
        for file, raw in zip(b.column(0).to_pylist(), b.column(1)):
            begun = len(rows)
            try:
                for node in _nodes_of(raw.as_py().decode("utf-8")):
                    rows.append((file, *node))
            except (ValueError, AttributeError, RecursionError) as e:
                rows[begun:] = [(file, "", None, "", "invalid", type(e).__name__)]
            if len(rows) >= 20_000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)


def json_nodes(files: DataFrame, file: str = "file", content: str = "content") -> DataFrame:
    """files (file, content binary) -> (file, place, name, path, kind, leaf): every node of each JSON document.

    place counts members and elements from the root down (two members of one name have two places), path is the JSON pointer; kind is object, array, string,
    integer, number, boolean, null, or invalid, with one row, for content that is null or can't be read. Strings are decoded, other leaves are JSON.
    """
    return files.select(F.col(file).cast("string").alias("file"), F.col(content).cast("binary").alias("content")).mapInArrow(_json_nodes, _NODE)


def json_compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """Nodes that differ between two sets of JSON files (file, content): (file, path, what, before, after).

    what is string (a string of another value), leaf (another kind of leaf has another value), shape (a kind or name differs, or one side lacks the node) or
    invalid (one side can't be read). Both sides are joined on file and place, so one very large file spreads over all tasks. Files are told apart by
    their names: one that a side lacks differs in every node. Null file names are left out.
    """
    a, b = (json_nodes(x.where("file IS NOT NULL")) for x in (before, after))
    j = a.alias("a").join(b.alias("b"), ["file", "place"], "full_outer")
    other = ~F.col("a.kind").eqNullSafe(F.col("b.kind")) | ~F.col("a.name").eqNullSafe(F.col("b.name"))
    invalid = (F.coalesce("a.kind", F.lit("")) == "invalid") | (F.coalesce("b.kind", F.lit("")) == "invalid")
    differs = ~F.col("a.leaf").eqNullSafe(F.col("b.leaf"))
    what = F.when(invalid, "invalid").when(other, "shape").when(differs & (F.col("a.kind") == "string"), "string").when(differs, "leaf")
    out = j.select("file", F.coalesce("a.path", "b.path").alias("path"), what.alias("what"), F.col("a.leaf").alias("before"), F.col("b.leaf").alias("after"))
    return out.where("what IS NOT NULL")


def json_verdicts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(file, verdict, n_strings) of every file of either side: same, changed (strings alone differ), or refused: a leaf that is no string, or the shape, differs, or a side is missing or invalid."""
    d = json_compare(before, after)
    n = d.groupBy("file").agg(F.count_if(F.col("what") == "string").alias("n_strings"), F.count_if(F.col("what") != "string").alias("_n"))
    names = before.select("file").unionByName(after.select("file")).where("file IS NOT NULL").distinct()
    verdict = F.when(F.col("_n") > 0, "refused").when(F.col("n_strings") > 0, "changed").otherwise("same")
    return names.join(n, "file", "left").na.fill(0, ["n_strings", "_n"]).select("file", verdict.alias("verdict"), "n_strings")
