"""Logic-less templates compiled into one Column: {{name}}, {{{name}}}, {{#section}}, {{^section}}, {{!comment}}, {{>partial}}.

A template is compiled against the columns it will see, so names are resolved once and Catalyst gets a plain expression: a section over an
array is a transform, over a boolean a condition, over a struct a change of scope. No Python runs on the rows. Names are looked up
from the innermost scope outwards, a.b goes into a struct, . is the element itself. A section is shown if its value is true, a struct, a
text that isn't empty, any number, or once for each element of an array; null is none of these. {{name}} is escaped for HTML,
{{{name}}} and {{&name}} aren't; null and unknown names give nothing (with strict, unknown names are an error). A tag of a section, comment or
partial that has its line to itself takes the line away.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellumry.functions.text import escape_html


class TemplateError(ValueError):
    """A template that can't be compiled."""


@dataclass
class Node:
    """kind: text, value (escaped), raw, section, inverted or partial; name is the text of a text."""

    kind: str
    name: str
    inner: list[Node] = field(default_factory=list)


_TAG = re.compile(r"\{\{\{\s*(?P<raw>[^{}]*?)\s*\}\}\}|\{\{(?P<sign>[#^/!>&]?)\s*(?P<name>.*?)\s*\}\}", re.S)
_KINDS = {"#": "section", "^": "inverted", ">": "partial", "&": "raw", "": "value"}
_NAME = re.compile(r"\.|[A-Za-z_][\w-]*(?:\.[A-Za-z_][\w-]*)*")


def parse(source: str) -> list[Node]:
    top = Node("section", "")
    open_ = [top]
    at = 0
    for m in _TAG.finditer(source):
        sign, name = m["sign"] or "", m["raw"] if m["raw"] is not None else m["name"]
        begin, end = m.start(), m.end()
        if m["raw"] is None and sign in ("#", "^", "/", "!", ">"):
            line = source.rfind("\n", 0, begin) + 1
            stop = source.find("\n", end)
            stop = len(source) if stop < 0 else stop + 1
            if not source[line:begin].strip() and not source[end:stop].strip():
                begin, end = max(at, line), stop
        if begin > at:
            open_[-1].inner.append(Node("text", source[at:begin]))
        at = end
        if sign == "!":
            continue
        if not _NAME.fullmatch(name):
            raise TemplateError(f"not a name: {name!r}")
        if sign == "/":
            if len(open_) == 1 or open_[-1].name != name:
                raise TemplateError(f"{{{{/{name}}}}} closes nothing that is open")
            open_.pop()
            continue
        node = Node("raw" if m["raw"] is not None else _KINDS[sign], name)
        open_[-1].inner.append(node)
        if sign in ("#", "^"):
            open_.append(node)
    if len(open_) > 1:
        raise TemplateError(f"{{{{#{open_[-1].name}}}}} isn't closed")
    if at < len(source):
        top.inner.append(Node("text", source[at:]))
    return top.inner


#: What a name may mean: a column (None: the row itself) and its type.
Scope = list[tuple[Column | None, T.DataType]]


def _field(scope: tuple[Column | None, T.DataType], name: str) -> tuple[Column, T.DataType] | None:
    value, kind = scope
    if isinstance(kind, T.StructType) and name in kind.fieldNames():
        return (F.col(f"`{name}`") if value is None else value[name]), kind[name].dataType
    return None


@dataclass
class Compiler:
    partials: dict[str, list[Node]]
    strict: bool

    def lookup(self, name: str, scopes: Scope) -> tuple[Column, T.DataType] | None:
        if name == ".":
            return scopes[-1] if scopes[-1][0] is not None else None
        first, *rest = name.split(".")
        found = next((x for s in reversed(scopes) if (x := _field(s, first)) is not None), None)
        for part in rest:
            found = _field(found, part) if found else None
        if found is None and self.strict:
            raise TemplateError(f"no column is called {name!r}")
        return found

    def body(self, nodes: list[Node], scopes: Scope, depth: int = 0) -> Column:
        parts = [p for n in nodes if (p := self.part(n, scopes, depth)) is not None]
        return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else F.lit("")

    def part(self, n: Node, scopes: Scope, depth: int) -> Column | None:
        if n.kind == "text":
            return F.lit(n.name)
        if n.kind == "partial":
            if depth > 20 or n.name not in self.partials:
                raise TemplateError(f"no partial is called {n.name!r}" if depth <= 20 else f"partial {n.name!r} holds itself")
            return self.body(self.partials[n.name], scopes, depth + 1)
        found = self.lookup(n.name, scopes)
        if n.kind in ("value", "raw"):
            return self.shown(*found, n.kind == "value") if found else None
        if found is None:
            return self.body(n.inner, scopes, depth) if n.kind == "inverted" else None
        value, kind = found
        if n.kind == "inverted":
            return F.when(F.coalesce(_says(value, kind), F.lit(False)), "").otherwise(self.body(n.inner, scopes, depth))
        if isinstance(kind, T.ArrayType):
            each = F.transform(value, lambda x: self.body(n.inner, [*scopes, (x, kind.elementType)], depth))
            return F.coalesce(F.array_join(each, ""), F.lit(""))
        inner = scopes if isinstance(kind, T.BooleanType) else [*scopes, found]
        return F.when(_says(value, kind), self.body(n.inner, inner, depth)).otherwise("")

    def shown(self, value: Column, kind: T.DataType, escaped: bool) -> Column:
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            raise TemplateError("a struct or array can't be written")
        text = value if isinstance(kind, T.StringType) else value.cast("string")
        return F.coalesce(escape_html(text, attribute=True) if escaped else text, F.lit(""))


def _says(value: Column, kind: T.DataType) -> Column:
    """Whether a section of this value is shown; null counts as no."""
    if isinstance(kind, T.BooleanType):
        return value
    if isinstance(kind, T.ArrayType):
        return F.size(value) > 0
    return value != "" if isinstance(kind, T.StringType) else value.isNotNull()


def compiled(source: str, schema: T.StructType, partials: dict[str, str] | None = None, strict: bool = False) -> Column:
    """The text of the template for rows of schema."""
    c = Compiler({k: parse(v) for k, v in (partials or {}).items()}, strict)
    return c.body(parse(source), [(None, schema)])


def render(df: DataFrame, source: str, into: str, partials: dict[str, str] | None = None, strict: bool = False) -> DataFrame:
    """df with the column into: the template filled from each row."""
    return df.withColumn(into, compiled(source, df.schema, partials, strict))


def load(spark: SparkSession, folder: str, names: list[str]) -> dict[str, str]:
    """The texts of the named template files of a folder; an error that names all missing ones."""
    rows = spark.read.text(f"{folder.rstrip('/')}/*.html", wholetext=True)
    found = {r.name: r.value for r in rows.select("value", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name")).where(F.col("name").isin([f"{n}.html" for n in names])).collect()}
    if missing := [n for n in names if f"{n}.html" not in found]:
        raise FileNotFoundError(f"no templates {', '.join(missing)} in {folder}")
    return {n: found[f"{n}.html"] for n in names}
