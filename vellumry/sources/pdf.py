"""Text of PDF files, best effort: objects, inflated streams, shown strings, fonts with a ToUnicode map.

A lower bound: fonts of other encodings without such a map are read as Latin-1, object streams and scans aren't read.
"""

from __future__ import annotations

import re
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Streams read of one file, and bytes of one stream before and after inflation, at most.
MOST_STREAMS, MOST_RAW, MOST_INFLATED = 20_000, 20_000_000, 8_000_000

_OBJECT = re.compile(rb"(\d+)\s+\d+\s+obj\b")
_REF = rb"\s+(\d+)\s+\d+\s+R"
_SHOW = re.compile(rb"/([^\s/<>\[\]()]+)\s+[-\d.]+\s+Tf|(\[(?:\\.|\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|[^\]\\()<>])*\])\s*TJ|(\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>)\s*(?:Tj|'|\")|(?<![A-Za-z])(T\*|Td|TD|ET)(?![A-Za-z*])", re.S)
_STRING = re.compile(rb"\(((?:\\.|[^\\()])*)\)|<([0-9A-Fa-f\s]*)>", re.S)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r\n|.)", re.S)
_LETTER = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f", b"\n": b"", b"\r\n": b"", b"\r": b""}


def _bytes(m: re.Match) -> bytes:
    if m[2] is not None:
        h = re.sub(rb"\s", b"", m[2])
        return bytes.fromhex((h + b"0" * (len(h) % 2)).decode())
    return _ESCAPE.sub(lambda e: bytes([int(e[1], 8) & 255]) if e[1][:1].isdigit() and e[1] < b"8" else _LETTER.get(e[1], e[1]), m[1])


def cmap(text: bytes) -> tuple[int, list[tuple[int, int, int | list[str]]], dict[int, str]]:
    """(bytes of a code, ranges (lo, hi, first target or list), single codes) of a ToUnicode map."""
    def word(h: bytes) -> str:
        h = re.sub(rb"\s", b"", h)
        return bytes.fromhex(h.decode()).decode("utf-16-be", "ignore")

    size = max((len(m[1]) // 2 for m in re.finditer(rb"<([0-9A-Fa-f]+)>\s*<[0-9A-Fa-f]+>", b"".join(re.findall(rb"begincodespacerange(.*?)endcodespacerange", text, re.S)))), default=1)
    single = {int(a, 16): word(b) for part in re.findall(rb"beginbfchar(.*?)endbfchar", text, re.S) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f\s]+)>", part)}
    ranges: list[tuple[int, int, int | list[str]]] = []
    for part in re.findall(rb"beginbfrange(.*?)endbfrange", text, re.S):
        for lo, hi, one, many in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*(?:<([0-9A-Fa-f\s]+)>|\[(.*?)\])", part, re.S):
            to = [word(x) for x in re.findall(rb"<([0-9A-Fa-f\s]+)>", many)] if many else ord(word(one)[-1:] or "\0")
            ranges.append((int(lo, 16), int(hi, 16), to))
    return size, sorted(ranges, key=lambda r: r[:2]), single


def mapped(raw: bytes, m: tuple) -> str:
    """Bytes of a shown string through a map; codes without a target are nothing."""
    size, ranges, single = m
    out = []
    for k in range(0, len(raw) - size + 1, size):
        code = int.from_bytes(raw[k : k + size], "big")
        if code in single:
            out.append(single[code])
            continue
        hit = next((r for r in ranges if r[0] <= code <= r[1]), None)
        if hit:
            lo, _, to = hit
            out.append(chr(to + code - lo) if isinstance(to, int) else to[code - lo] if code - lo < len(to) else "")
    return "".join(out)


def text_of(raw: bytes | None) -> str | None:
    """The text that a PDF shows, runs joined, lines where positions change; null for other content."""
    return read(raw)[0]


def read(raw: bytes | None) -> tuple[str | None, bool]:
    """(text, complete): the text as text_of gives it, and whether every stream was read, whole; beyond the limits above, or broken, one isn't."""
    if raw is None or b"%PDF-" not in raw[:1024]:
        return None, False
    complete = True
    starts = [(m.start(), m.end(), int(m[1])) for m in _OBJECT.finditer(raw)]
    objects: dict[int, bytes] = {}
    streams: dict[int, bytes] = {}
    for k, (_, at, number) in enumerate(starts):
        end = starts[k + 1][0] if k + 1 < len(starts) else len(raw)
        body = raw[at:end]
        cut = re.search(rb"\bstream\r?\n", body)
        objects[number] = body[: cut.start()] if cut else body
        if cut:
            data = body[cut.end() : body.rfind(b"endstream")]
            if len(streams) >= MOST_STREAMS or len(data) > MOST_RAW:
                complete = False
                continue
            try:
                whole = zlib.decompressobj()
                packed = b"FlateDecode" in objects[number]
                streams[number] = whole.decompress(data, MOST_INFLATED) if packed else data[:MOST_INFLATED]
                complete &= not whole.unconsumed_tail and whole.eof if packed else len(data) <= MOST_INFLATED
            except zlib.error:
                complete = False
    maps = {n: cmap(s) for n, s in streams.items() if b"beginbf" in s}
    fonts: dict[bytes, set[int]] = {}
    for o in objects.values():
        for name, ref in re.findall(rb"/([^\s/<>\[\]()]+)" + _REF, o):
            to = re.search(rb"/ToUnicode" + _REF, objects.get(int(ref), b""))
            if to and int(to[1]) in maps:
                fonts.setdefault(name, set()).add(int(to[1]))
    alone = {name: maps[next(iter(ids))] for name, ids in fonts.items() if len(ids) == 1}  # a name with one font only is sure
    out = []
    for number, s in streams.items():
        if number in maps or not re.search(rb"T[jJ]|'|\"", s):
            continue
        font = None
        for m in _SHOW.finditer(s):
            if m[1]:
                font = alone.get(m[1])
            elif m[4]:
                out.append("\n")
            else:
                shown = b"".join(_bytes(x) for x in _STRING.finditer(m[2] or m[3]))
                out.append(mapped(shown, font) if font else shown.decode("latin-1"))
        out.append("\n")
    return re.sub(r"\n{2,}", "\n", "".join(out)).strip("\n"), complete


def pdf_text(content: Column) -> Column:
    """Text of PDF content; null for other content."""

    @F.pandas_udf("string")
    def run(c: pd.Series) -> pd.Series:
        return c.map(text_of)

    return run(content)
