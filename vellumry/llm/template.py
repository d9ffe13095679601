"""A compiler of chat templates: text with {{ expressions }}, {% statements %} and {# comments #}.

compile_template parses a template into a syntax tree, folds what is constant (operators and filters of constants, branches of
known conditions, neighbouring pieces of text) and makes a Python closure of each node that is left. Nothing of Python is in
reach of a template: names are what is handed in, ``a.b`` and ``a['b']`` look up keys of dicts and places of lists, calls are
``namespace`` and ``raise_exception`` alone, filters and tests those listed here or given. Lists are the only things to loop over,
whole numbers have 64 bits, texts at most MOST_CHARS characters; what goes beyond raises TemplateError.

Statements: ``for x in list``/``else``/``endfor`` (with loop.index, index0, first, last, length, previtem, nextitem),
``if``/``elif``/``else``/``endif``, ``set name = value`` (of the enclosing loop), ``set space.name = value`` of a namespace,
``generation``/``endgeneration``, which marks what a model is to learn. Operators by falling precedence: ``.`` ``[]`` ``|``, unary ``-``, ``* // %``, ``+ -``, ``~``,
comparisons, ``in``, ``is``, ``not``, ``and``, ``or``, ``x if c else y``. A ``-`` inside a tag strips white space on its side. An unknown name
is undefined: it may be tested by ``is defined`` and ``default``, any other use raises.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

#: Characters of one text that a template makes, at most.
MOST_CHARS = 1 << 28


class TemplateError(ValueError):
    """A template that can't be compiled, or that refuses what it is given."""


class _Undefined:
    def __repr__(self) -> str:
        return "undefined"


UNDEFINED = _Undefined()


class _Space(dict):
    """A namespace: the one kind of value that a template may change."""


@dataclass(frozen=True)
class Node:
    """kind, what it consists of (nodes, lists of nodes, plain values)."""

    kind: str
    parts: tuple = ()


# --- values ---


def _text(x: Any) -> str:
    if x is UNDEFINED:
        raise TemplateError("an undefined value is written")
    if x is None or isinstance(x, bool):
        return {None: "none", True: "true", False: "false"}[x]
    if isinstance(x, (str, int, float)):
        return str(x)
    raise TemplateError(f"a {type(x).__name__} can't be written")


def _checked(x: Any) -> Any:
    if isinstance(x, str) and len(x) > MOST_CHARS:
        raise TemplateError(f"a text of over {MOST_CHARS} characters")
    if isinstance(x, int) and not -(1 << 63) <= x < 1 << 63:
        raise TemplateError("a number of over 64 bits")
    return x


def _numbers(*xs: Any) -> None:
    if not all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in xs):
        raise TemplateError("a number is needed")


def _arithmetic(op: str, a: Any, b: Any) -> Any:
    if op == "~":
        return _checked(_text(a) + _text(b))
    if op == "+" and (isinstance(a, str) and isinstance(b, str) or isinstance(a, list) and isinstance(b, list)):
        return _checked(a + b)
    _numbers(a, b)
    if op in ("//", "%") and b == 0:
        raise TemplateError("division by zero")
    return _checked({"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "//": lambda: a // b, "%": lambda: a % b}[op]())


def _compare(op: str, a: Any, b: Any) -> bool:
    if op in ("==", "!="):
        return (a == b) is (op == "==")
    if op in ("in", "not in"):
        if not (isinstance(b, (list, dict)) or isinstance(a, str) and isinstance(b, str)):
            raise TemplateError("'in' needs a list, a dict or two texts")
        return (a in b) is (op == "in")
    if not (isinstance(a, str) and isinstance(b, str)):
        _numbers(a, b)
    return {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[op]


def _item(x: Any, key: Any) -> Any:
    if x is UNDEFINED:
        raise TemplateError(f"{key!r} of an undefined value")
    if isinstance(x, dict):
        return x.get(key, UNDEFINED) if isinstance(key, (str, int)) else UNDEFINED
    if isinstance(x, (list, str)) and isinstance(key, int) and not isinstance(key, bool):
        return x[key] if -len(x) <= key < len(x) else UNDEFINED
    return UNDEFINED


def _need_text(f: Callable) -> Callable:
    def g(x: Any, *args: Any) -> Any:
        if not all(isinstance(y, str) for y in (x, *args)):
            raise TemplateError("a text is needed")
        return _checked(f(x, *args))

    return g


def _length(x: Any) -> int:
    if not isinstance(x, (str, list, dict)):
        raise TemplateError("only texts, lists and dicts have a length")
    return len(x)


FILTERS: dict[str, Callable] = {
    "trim": _need_text(lambda x: x.strip()), "upper": _need_text(str.upper), "lower": _need_text(str.lower), "title": _need_text(str.title), "capitalize": _need_text(str.capitalize),
    "replace": _need_text(lambda x, a, b: x.replace(a, b)), "length": _length, "string": _text, "first": lambda x: _item(x, 0), "last": lambda x: _item(x, -1),
    "join": lambda x, sep="": _checked(_text(sep).join(map(_text, x))), "default": lambda x, other="": other if x is UNDEFINED else x, "tojson": lambda x: _checked(json.dumps(x, ensure_ascii=False)),
}

TESTS: dict[str, Callable[[Any], bool]] = {
    "defined": lambda x: x is not UNDEFINED, "undefined": lambda x: x is UNDEFINED, "none": lambda x: x is None, "string": lambda x: isinstance(x, str),
    "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool), "mapping": lambda x: isinstance(x, dict), "iterable": lambda x: isinstance(x, (list, str, dict)),
    "true": lambda x: x is True, "false": lambda x: x is False,
}


# --- parsing ---

_TOKEN = re.compile(r"\s+|(?P<close>-?(?:\}\}|%\}))|(?P<number>\d+(?:\.\d+)?)|(?P<name>[A-Za-z_]\w*)|(?P<string>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<op>==|!=|<=|>=|//|[-+*%~<>=|.,:()\[\]])", re.S)
_ESCAPED = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "True": True, "false": False, "False": False, "none": None, "None": None}


class _Parser:
    def __init__(self, source: str, trim_blocks: bool):
        self.source, self.at, self.trim = source, 0, trim_blocks
        self.tokens: list[tuple[str, str]] = []
        self.marked = 0

    def fail(self, what: str) -> TemplateError:
        return TemplateError(f"line {self.source.count(chr(10), 0, self.at) + 1}: {what}")

    # tags

    def segments(self) -> Iterator[tuple[str, Any]]:
        """("text", text), ("{{", tokens) and ("{%", tokens), white space control applied."""
        strip = newline = False
        while True:
            m = re.compile(r"\{[{%#]").search(self.source, self.at)
            text = self.source[self.at : m.start() if m else len(self.source)]
            text = text.lstrip() if strip else text.removeprefix("\n") if newline else text
            if m and self.source.startswith("-", m.end()):
                text = text.rstrip()
            if text:
                yield "text", text
            if not m:
                return
            self.at = m.end() + self.source.startswith("-", m.end())
            if m[0] == "{#":
                end = self.source.find("#}", self.at)
                if end < 0:
                    raise self.fail("a comment doesn't end")
                strip, newline = self.source[end - 1] == "-", self.trim
                self.at = end + 2
                continue
            tokens = []
            while True:
                t = _TOKEN.match(self.source, self.at)
                if not t:
                    raise self.fail("a tag doesn't end" if self.at >= len(self.source) else f"{self.source[self.at]!r} isn't expected")
                self.at = t.end()
                if t.lastgroup == "close":
                    break
                if t.lastgroup:
                    tokens.append((t.lastgroup, t[0]))
            if t["close"][-2:] != {"{{": "}}", "{%": "%}"}[m[0]]:
                raise self.fail(f"{m[0]} is closed by {t['close']}")
            strip, newline = t["close"][0] == "-", self.trim and m[0] == "{%"
            yield m[0], tokens

    def parse(self) -> list[Node]:
        self.stream = self.segments()
        nodes, end = self.body(())
        if end:
            raise self.fail(f"{end!r} without a beginning")
        return nodes

    def body(self, ends: tuple[str, ...]) -> tuple[list[Node], str]:
        nodes: list[Node] = []
        for kind, x in self.stream:
            if kind == "text":
                nodes.append(Node("text", (x,)))
                continue
            self.tokens = x
            if kind == "{{":
                nodes.append(Node("write", (self.whole(),)))
                continue
            word = self.name()
            if word in ends:
                return nodes, word
            if word == "for":
                var = self.name()
                self.word("in")
                items = self.whole()
                inner, end = self.body(("else", "endfor"))
                other, end = self.body(("endfor",)) if end == "else" else ([], end)
                nodes.append(Node("for", (var, items, inner, other)))
            elif word == "if":
                branches, end, other = [], "elif", []
                while end == "elif":
                    test = self.whole()
                    inner, end = self.body(("elif", "else", "endif"))
                    branches.append((test, inner))
                if end == "else":
                    self.done()
                    other, end = self.body(("endif",))
                nodes.append(Node("if", (branches, other)))
            elif word == "set":
                name = self.name()
                key = self.name() if self.take(".") else None
                self.need("=")
                nodes.append(Node("set", (name, key, self.whole())))
                continue
            elif word == "generation":
                if self.marked:
                    raise self.fail("generation within generation")
                self.marked = 1
                inner, end = self.body(("endgeneration",))
                self.marked = 0
                nodes.append(Node("generation", (inner,)))
            else:
                raise self.fail(f"unknown or unexpected statement {word!r}")
            self.done()
        if ends:
            raise self.fail(f"{ends[-1]} is missing")
        return nodes, ""

    # expressions

    def take(self, *ops: str) -> str:
        if self.tokens and self.tokens[0][0] in ("op", "name") and self.tokens[0][1] in ops:
            return self.tokens.pop(0)[1]
        return ""

    def need(self, op: str) -> None:
        if not self.take(op):
            raise self.fail(f"{op!r} is expected")

    word = need

    def name(self) -> str:
        if not self.tokens or self.tokens[0][0] != "name":
            raise self.fail("a name is expected")
        return self.tokens.pop(0)[1]

    def done(self) -> None:
        if self.tokens:
            raise self.fail(f"{self.tokens[0][1]!r} isn't expected")

    def whole(self) -> Node:
        x = self.choice()
        self.done()
        return x

    def choice(self) -> Node:
        x = self.either()
        if self.take("if"):
            test = self.either()
            other = self.choice() if self.take("else") else Node("const", ("",))
            x = Node("choice", (test, x, other))
        return x

    def either(self) -> Node:
        x = self.both()
        while self.take("or"):
            x = Node("or", (x, self.both()))
        return x

    def both(self) -> Node:
        x = self.negated()
        while self.take("and"):
            x = Node("and", (x, self.negated()))
        return x

    def negated(self) -> Node:
        return Node("not", (self.negated(),)) if self.take("not") else self.comparison()

    def comparison(self) -> Node:
        x = self.level(0)
        while True:
            if op := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
                x = Node("compare", (op, x, self.level(0)))
            elif self.take("is"):
                no = bool(self.take("not"))
                x = Node("test", (self.name(), x))
                x = Node("not", (x,)) if no else x
            elif self.take("not"):
                self.need("in")
                x = Node("compare", ("not in", x, self.level(0)))
            else:
                return x

    _LEVELS = (("~",), ("+", "-"), ("*", "//", "%"))

    def level(self, k: int) -> Node:
        if k == len(self._LEVELS):
            return Node("minus", (self.level(k),)) if self.take("-") else self.postfix()
        x = self.level(k + 1)
        while op := self.take(*self._LEVELS[k]):
            x = Node("arithmetic", (op, x, self.level(k + 1)))
        return x

    def arguments(self) -> list[tuple[str | None, Node]]:
        out = []
        while not self.take(")"):
            named = len(self.tokens) > 1 and self.tokens[0][0] == "name" and self.tokens[1][1] == "="
            key = self.name() if named else None
            if named:
                self.need("=")
            out.append((key, self.choice()))
            if not self.take(","):
                self.need(")")
                break
        return out

    def postfix(self) -> Node:
        x = self.primary()
        while True:
            if self.take("."):
                x = Node("item", (x, Node("const", (self.name(),))))
            elif self.take("["):
                low = None if self.tokens[:1] == [("op", ":")] else self.choice()
                if self.take(":"):
                    high = None if self.tokens[:1] == [("op", "]")] else self.choice()
                    x = Node("slice", (x, low or Node("const", (None,)), high or Node("const", (None,))))
                else:
                    x = Node("item", (x, low))
                self.need("]")
            elif self.take("|"):
                name = self.name()
                args = self.arguments() if self.take("(") else []
                if any(key for key, _ in args):
                    raise self.fail("filters take no named arguments")
                x = Node("filter", (name, x, *(a for _, a in args)))
            else:
                return x

    def primary(self) -> Node:
        if not self.tokens:
            raise self.fail("a value is expected")
        kind, x = self.tokens.pop(0)
        if kind == "number":
            return Node("const", (_checked(float(x) if "." in x else int(x)),))
        if kind == "string":
            return Node("const", (re.sub(r"\\(.)", lambda m: _ESCAPED.get(m[1], m[1]), x[1:-1], flags=re.S),))
        if kind == "name" and x in _WORDS:
            return Node("const", (_WORDS[x],))
        if kind == "name":
            if self.take("("):
                args = self.arguments()
                if x == "raise_exception" and len(args) == 1 and args[0][0] is None:
                    return Node("refuse", (args[0][1],))
                if x == "namespace" and all(key for key, _ in args):
                    return Node("namespace", (tuple(key for key, _ in args), *(a for _, a in args)))
                raise self.fail(f"{x} can't be called so")
            return Node("name", (x,))
        if x == "(":
            inner = self.choice()
            self.need(")")
            return inner
        if x == "[":
            items = []
            while not self.take("]"):
                items.append(self.choice())
                if not self.take(","):
                    self.need("]")
                    break
            return Node("list", tuple(items))
        raise self.fail(f"{x!r} isn't expected")


# --- folding ---


def fold(node: Node, filters: dict[str, Callable]) -> Node:
    """The same expression with constant parts computed; what raises is left to raise when it is rendered."""
    parts = tuple(fold(p, filters) if isinstance(p, Node) else p for p in node.parts)
    node = Node(node.kind, parts)
    inner = [p for p in parts if isinstance(p, Node)]
    if node.kind in ("choice", "and", "or") and inner[0].kind == "const":
        first = inner[0].parts[0]
        if node.kind == "choice":
            return inner[1] if first else inner[2]
        return inner[1] if bool(first) is (node.kind == "and") else inner[0]
    if node.kind in ("name", "const", "refuse", "namespace", "list") or not all(p.kind == "const" for p in inner):
        return node
    try:
        return Node("const", (expression(node, filters)({}),))
    except TemplateError:
        return node


def fold_body(nodes: list[Node], filters: dict[str, Callable]) -> list[Node]:
    """Statements with constant expressions computed, known branches taken and neighbouring texts joined."""
    out: list[Node] = []

    def add(n: Node) -> None:
        if n.kind == "text" and out and out[-1].kind == "text":
            n = Node("text", (out.pop().parts[0] + n.parts[0],))
        if n.kind != "text" or n.parts[0]:
            out.append(n)

    for n in nodes:
        if n.kind == "write":
            x = fold(n.parts[0], filters)
            constant = x.kind == "const" and not isinstance(x.parts[0], list)
            add(Node("text", (_text(x.parts[0]),)) if constant and x.parts[0] is not UNDEFINED else Node("write", (x,)))
        elif n.kind == "if":
            branches, other = [], fold_body(n.parts[1], filters)
            for test, inner in n.parts[0]:
                test, inner = fold(test, filters), fold_body(inner, filters)
                if test.kind == "const":
                    if test.parts[0]:
                        other = inner
                        break
                    continue
                branches.append((test, inner))
            if branches:
                add(Node("if", (branches, other)))
            else:
                for x in other:
                    add(x)
        elif n.kind == "for":
            var, items, inner, other = n.parts
            add(Node("for", (var, fold(items, filters), fold_body(inner, filters), fold_body(other, filters))))
        elif n.kind == "set":
            add(Node("set", (*n.parts[:2], fold(n.parts[2], filters))))
        elif n.kind == "generation":
            add(Node("generation", (fold_body(n.parts[0], filters),)))
        else:
            add(n)
    return out


# --- closures ---

Env = dict[str, Any]


def expression(node: Node, filters: dict[str, Callable]) -> Callable[[Env], Any]:
    kind, p = node.kind, node.parts
    f = [expression(x, filters) for x in p if isinstance(x, Node)]
    if kind == "const":
        return lambda env, x=p[0]: x
    if kind == "name":
        return lambda env, x=p[0]: env.get(x, UNDEFINED)
    if kind == "item":
        return lambda env: _item(f[0](env), f[1](env))
    if kind == "slice":
        return lambda env: _sliced(f[0](env), f[1](env), f[2](env))
    if kind == "list":
        return lambda env: [x(env) for x in f]
    if kind == "not":
        return lambda env: not _truth(f[0](env))
    if kind == "and":
        return lambda env: f[1](env) if _truth(x := f[0](env)) else x
    if kind == "or":
        return lambda env: x if _truth(x := f[0](env)) else f[1](env)
    if kind == "choice":
        return lambda env: f[1](env) if _truth(f[0](env)) else f[2](env)
    if kind == "minus":
        return lambda env: _arithmetic("-", 0, f[0](env))
    if kind == "arithmetic":
        return lambda env, op=p[0]: _arithmetic(op, f[0](env), f[1](env))
    if kind == "compare":
        return lambda env, op=p[0]: _compare(op, f[0](env), f[1](env))
    if kind == "test":
        if p[0] not in TESTS:
            raise TemplateError(f"no test is called {p[0]!r}")
        return lambda env, t=TESTS[p[0]]: t(f[0](env))
    if kind == "filter":
        if p[0] not in filters:
            raise TemplateError(f"no filter is called {p[0]!r}")
        return _filtered(filters[p[0]], p[0], f)
    if kind == "namespace":
        return lambda env, keys=p[0]: _Space(zip(keys, (x(env) for x in f)))
    if kind == "refuse":
        return lambda env: _refuse(_text(f[0](env)))
    raise TemplateError(f"unknown expression {kind}")


def _filtered(g: Callable, name: str, f: list[Callable]) -> Callable[[Env], Any]:
    def apply(env: Env) -> Any:
        x = f[0](env)
        if x is UNDEFINED and name != "default":
            raise TemplateError(f"{name} of an undefined value")
        try:
            return g(x, *(a(env) for a in f[1:]))
        except TypeError as e:
            raise TemplateError(f"{name}: {e}") from None

    return apply


def _truth(x: Any) -> bool:
    if x is UNDEFINED:
        raise TemplateError("an undefined value is tested")
    return bool(x)


def _sliced(x: Any, low: Any, high: Any) -> Any:
    if not isinstance(x, (list, str)) or not all(y is None or isinstance(y, int) for y in (low, high)):
        raise TemplateError("only texts and lists are cut, at whole numbers")
    return x[low:high]


def _refuse(why: str) -> Any:
    raise TemplateError(why)


@dataclass
class Sink:
    """What was rendered since the last flush, and the marked spans in it; places count from the text's beginning."""

    parts: list[str] = field(default_factory=list)
    begins: int = 0
    at: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    marked: int | None = None

    def write(self, x: str) -> None:
        self.parts.append(x)
        self.at += len(x)

    def flush(self) -> tuple[int, str, list[tuple[int, int]]]:
        if self.marked is not None:
            self.close()
            self.marked = self.at
        out = (self.begins, "".join(self.parts), self.spans)
        self.parts, self.spans, self.begins = [], [], self.at
        return out

    def close(self) -> None:
        if self.at > self.marked:
            self.spans.append((self.marked, self.at))
        self.marked = None


def statements(nodes: list[Node], filters: dict[str, Callable]) -> Callable[[Env, Sink], None]:
    steps = [_statement(n, filters) for n in nodes]

    def run(env: Env, sink: Sink) -> None:
        for s in steps:
            s(env, sink)

    return steps[0] if len(steps) == 1 else run


def _looped(items: Iterable[Any], length: int | None) -> Iterator[tuple[Any, dict]]:
    before, k = UNDEFINED, 0
    source = iter(items)
    now = next(source, UNDEFINED)
    while now is not UNDEFINED:
        after = next(source, UNDEFINED)
        loop = {"index": k + 1, "index0": k, "first": k == 0, "last": after is UNDEFINED, "previtem": before, "nextitem": after}
        if length is not None:
            loop["length"] = length
        yield now, loop
        before, now, k = now, after, k + 1


def _statement(n: Node, filters: dict[str, Callable]) -> Callable[[Env, Sink], None]:
    kind, p = n.kind, n.parts
    if kind == "text":
        return lambda env, sink, x=p[0]: sink.write(x)
    if kind == "write":
        f = expression(p[0], filters)
        return lambda env, sink: sink.write(_text(f(env)))
    if kind == "set":
        f = expression(p[2], filters)

        def assign(env: Env, sink: Sink) -> None:
            if p[1] is None:
                env[p[0]] = f(env)
            elif isinstance(space := env.get(p[0]), _Space):
                space[p[1]] = f(env)
            else:
                raise TemplateError(f"{p[0]} is no namespace")

        return assign
    if kind == "generation":
        inner = statements(p[0], filters)

        def mark(env: Env, sink: Sink) -> None:
            sink.marked = sink.at
            inner(env, sink)
            sink.close()

        return mark
    if kind == "if":
        branches, other = [(expression(t, filters), statements(b, filters)) for t, b in p[0]], statements(p[1], filters)

        def choose(env: Env, sink: Sink) -> None:
            for test, inner in branches:
                if _truth(test(env)):
                    return inner(env, sink)
            return other(env, sink)

        return choose
    var, items, inner, other = p[0], expression(p[1], filters), statements(p[2], filters), statements(p[3], filters)

    def loop(env: Env, sink: Sink) -> None:
        x = items(env)
        if not isinstance(x, list):
            raise TemplateError("only lists are looped over")
        for item, state in _looped(x, len(x)):
            inner({**env, var: item, "loop": state}, sink)
        if not x:
            other(env, sink)

    return loop


def _names(x: Any) -> Iterator[Node]:
    if isinstance(x, Node):
        yield x
        x = x.parts
    if isinstance(x, (list, tuple)):
        for y in x:
            yield from _names(y)


class Template:
    """A compiled template. ``streams``: its only use of messages is one loop at the top, so it takes them one by one."""

    def __init__(self, nodes: list[Node], filters: dict[str, Callable]):
        self.nodes = nodes
        main = [k for k, n in enumerate(nodes) if n.kind == "for" and n.parts[1] == Node("name", ("messages",))]
        uses = [n for n in _names(nodes) if n == Node("name", ("messages",))]
        counts = any(n.kind == "item" and n.parts == (Node("name", ("loop",)), Node("const", ("length",))) for n in _names(nodes))
        self.streams = len(main) == 1 and len(uses) == 1 and not counts
        if not self.streams:
            self._run = statements(nodes, filters)
            return
        _, (var, _, inner, other), after = nodes[: main[0]], nodes[main[0]].parts, nodes[main[0] + 1 :]
        self._before, self._after, self._var = statements(nodes[: main[0]], filters), statements(after, filters), var
        self._inner, self._other = statements(inner, filters), statements(other, filters)

    def pieces(self, messages: Iterable[dict], limit: int = 1 << 20, **names: Any) -> Iterator[tuple[int, str, list[tuple[int, int]]]]:
        """(place, text, spans to learn) of consecutive pieces of the rendered text, each ended by the first message that brings it to limit characters. At least one."""
        sink, env = Sink(), dict(names)
        if not self.streams:
            self._run({**env, "messages": list(messages)}, sink)
            yield sink.flush()
            return
        self._before(env, sink)
        none = True
        for m, state in _looped(messages, None):
            none = False
            self._inner({**env, self._var: m, "loop": state}, sink)
            if sink.at - sink.begins >= limit and not state["last"]:
                yield sink.flush()
        if none:
            self._other(env, sink)
        self._after(env, sink)
        yield sink.flush()

    def render(self, messages: Iterable[dict], **names: Any) -> tuple[str, list[tuple[int, int]]]:
        """(text, spans to learn)."""
        found = list(self.pieces(messages, **names))
        return "".join(x[1] for x in found), [s for x in found for s in x[2]]


def compile_template(source: str, filters: dict[str, Callable] | None = None, trim_blocks: bool = False) -> Template:
    """filters: further ones, pure functions of texts. trim_blocks: the line end right after a statement or comment is not text."""
    known = FILTERS | (filters or {})
    return Template(fold_body(_Parser(source, trim_blocks).parse(), known), known)
