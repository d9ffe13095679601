"""Conversations as training text with a mask of what is learned, by compiled templates.

Rows of turns are brought together by conversation and sorted within their partition, then rendered as they stream by: a template
that takes its messages one by one never needs more than a turn and its neighbours, and its text leaves in pieces of about
PIECE characters, in order, in the conversation's partition. An ordinary conversation is one piece. A conversation's text is one chain, so however many of the rows
belong to one conversation, one task renders it; its sort spills and its memory doesn't grow. A template that
looks at all messages at once (``messages[0]``, ``loop.length``) gets them as one list.

Control strings within roles and texts are made harmless by ``escape``: where a control string would stand, backslashes
between its first character and the rest included, one more backslash goes behind the first character. ``unescape``
takes one away, so every text comes back, and no escaped text holds a control string.

Defined results: null roles and texts are empty; turns follow each other by turn (null first), then role, then text, and repeated
rows are turns of their own; rows without conv_id make one conversation without id. An empty table gives no rows. Other columns are ignored whatever their names. A conversation that
the template refuses gives one row with null text and the reason as error (after pieces that were complete before).
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumry.llm.template import Template, TemplateError, compile_template

#: Characters of a piece, but for its last turn.
PIECE = 1 << 20

CONTROLS = ("<turn>", "</role>", "</turn>")
TEMPLATE = """{#- A turn is <turn>role</role>text</turn> and a line end; assistants' texts are learned. -#}
{%- for m in messages -%}
<turn>{{ m.role|escape }}</role>
{%- if m.role == 'assistant' -%}
{%- generation -%}{{ m.text|escape }}{%- endgeneration -%}
{%- else -%}
{{ m.text|escape }}
{%- endif -%}
</turn>{{ '\\n' }}
{%- endfor -%}"""

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_PIECES = "conv_id long, piece long, start long, text string, spans array<struct<start: long, end: long>>, error string"


@functools.lru_cache(16)
def _marks(controls: tuple[str, ...]) -> tuple[re.Pattern, re.Pattern]:
    first = {c[:1] for c in controls}
    if any(len(c) < 2 or "\\" in c or first & set(c[1:]) for c in controls):
        raise ValueError("control strings need two characters or more, no backslash, and their first characters nowhere else")
    rests = {c: "|".join(re.escape(x[1:]) for x in controls if x[0] == c) for c in sorted(first)}
    either = lambda mid: "|".join(f"(?<={re.escape(c)}){mid}(?={rest})" for c, rest in rests.items())
    slashes = "|".join(rf"{re.escape(c)}(\\*)(?={rest})" for c, rest in rests.items())
    return re.compile(slashes), re.compile(either(r"\\+")) if controls else re.compile(r"(?!)")


def escape(text: str, controls: tuple[str, ...] = CONTROLS) -> str:
    """The text without any of the control strings in it."""
    return _marks(controls)[0].sub(lambda m: m[0][0] + "\\" + m[0][1:], text) if controls else text


def unescape(text: str, controls: tuple[str, ...] = CONTROLS) -> str:
    """What escape was given."""
    return _marks(controls)[1].sub(lambda m: m[0][1:], text) if controls else text


def chat_template(source: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS) -> Template:
    """A template with the filter escape."""
    _marks(controls)
    return compile_template(source, {"escape": lambda x: escape(x, controls)})


class _Rows:
    """Sorted rows (conv_id, role, text) as conversations, each an iterator of messages."""

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        self.now = next(self.rows, None)

    def messages(self, conv_id: int | None) -> Iterator[dict]:
        while self.now is not None and self.now[0] == conv_id:
            yield {"role": self.now[1] or "", "text": self.now[2] or ""}
            self.now = next(self.rows, None)

    def __iter__(self) -> Iterator[tuple[int | None, Iterator[dict]]]:
        while self.now is not None:
            conv_id = self.now[0]
            yield conv_id, self.messages(conv_id)
            for _ in self.messages(conv_id):  # what a refusing template left
                pass


def format_conversations(turns: DataFrame, source: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """turns (conv_id, turn, role, text) -> (conv_id, piece from 0, start, text, spans, error).

    spans are what the template marks as generated, in code points of the conversation's whole text; start is the piece's place there.
    The pieces of a conversation lie in one partition, in order.
    """
    chat_template(source, controls)  # a wrong template fails here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = chat_template(source, controls)
        out: list[tuple] = []
        held = 0
        for conv_id, messages in _Rows(batches):
            k = 0
            try:
                for k, (start, text, spans) in enumerate(template.pieces(messages, PIECE)):
                    out.append((conv_id, k, start, text, [{"start": a, "end": b} for a, b in spans], None))
                    held += len(text)
                    if held >= PIECE or len(out) >= 10_000:
                        yield _batch(out)
                        out, held = [], 0
            except TemplateError as e:
                out.append((conv_id, k, None, None, None, str(e)))
        if out:
            yield _batch(out)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(run, _PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "piece": pa.int64(), "start": pa.int64(), "text": pa.string(), "spans": _SPANS, "error": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds.values())], names=list(kinds))


_TURN = re.compile(r"<turn>(.*?)</role>(.*?)</turn>\n", re.S)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a text (or whole piece) that TEMPLATE made."""
    found, at = [], 0
    for m in _TURN.finditer(text):
        if m.start() != at:
            break
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn begins at {at}")
    return found


def digests(pieces: DataFrame) -> DataFrame:
    """What format_conversations made by TEMPLATE, read back: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), one row for each conversation.

    turns_sha256 is of role, line end, text, line end of each turn, loss_sha256 of all marked text, unescaped. Pieces follow each other in their partition, so nothing is shuffled.
    """
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            out = []
            for conv_id, piece, start, text, spans in zip(*(c.to_pylist() for c in b.columns)):
                if piece == 0:
                    if state:
                        out.append(_row(state))
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = read_turns(text)
                state[1] += len(turns)
                state[2].update("".join(f"{role}\n{said}\n" for role, said in turns).encode())
                for s in spans:
                    learned = unescape(text[s["start"] - start : s["end"] - start])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
                state[5] += len(text)
            yield _digest_batch(out, names)
        if state:
            yield _digest_batch([_row(state)], names)

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return pieces.select("conv_id", "piece", "start", "text", "spans").mapInArrow(run, kinds)


def _row(state: list) -> tuple:
    return (*state[:2], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])


def _digest_batch(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=list(names))
