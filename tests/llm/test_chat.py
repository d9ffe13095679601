"""The template compiler by cases, the chat format by round trips and a plain rendering."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from vellumry.llm import chat, queries
from vellumry.llm.template import Node, TemplateError, compile_template

DIR = "/root/testdata/sf0.001"


def render(source, messages=(), **names):
    return compile_template(source).render(list(messages), **names)[0]


@pytest.mark.parametrize(
    "source, want",
    [
        ("a{{ 1 + 2 * 3 }}b", "a7b"),
        ("{{ 'x' ~ 1 ~ true ~ none }}", "x1truenone"),
        ("{{ x.y['z'][1] }} {{ x['y'].z[-1] }}", "2 3"),
        ("{% if x.q is defined %}1{% elif x.y %}2{% else %}3{% endif %}", "2"),
        ("{% for k in x.y.z %}{{ loop.index }}{{ k }}{% if not loop.last %},{% endif %}{% else %}none{% endfor %}", "11,22,33"),
        ("{% for k in [] %}x{% else %}none{% endfor %}", "none"),
        ("{% set t = 'a' %}{% for k in x.y.z %}{% set t = 'b' %}{% endfor %}{{ t }}", "a"),
        ("{% set n = namespace(t=0) %}{% for k in x.y.z %}{% set n.t = n.t + k %}{% endfor %}{{ n.t }}", "6"),
        ("a  {{- 1 -}}  b {#- no -#} c", "a1bc"),
        ("{{ ' x '|trim|upper }}{{ q|default('d') }}{{ [1, 2]|join('-') }}{{ [1, 2]|length }}", "Xd1-22"),
        ("{{ 'yes' if 1 < 2 and not (2 in [3]) else 'no' }}{{ 'b' in 'abc' }}{{ 2 not in [1] }}", "yestruetrue"),
        ("{{ '}}' }}{{ \"%}\" }}{{ 'it\\'s\\n' }}", "}}%}it's\n"),
        ("{{ x.y.z[1:] |join }}{{ 'abcd'[:2] }}", "23ab"),
        ("{{ 7 // 2 }}{{ 7 % 2 }}{{ -3 }}{{ 'x' is string }}{{ 1 is not none }}", "31-3truetrue"),
        ("", ""),
    ],
)
def test_templates(source, want):
    assert render(source, x={"y": {"z": [1, 2, 3]}}) == want


@pytest.mark.parametrize(
    "source",
    ["{{ q }}", "{{ q.r }}", "{{ x.__class__ }}", "{% for a in 'text' %}{% endfor %}", "{{ 1 // 0 }}", "{{ 'a' * 3 }}", "{{ 9999999999 * 9999999999 }}", "{{ raise_exception('no') }}",
     "{% set x.k = 1 %}", "{{ 1|upper }}", "{{ x }}", "{% if q %}{% endif %}", "{% set n = namespace(t='ab') %}{% for k in many %}{% set n.t = n.t ~ n.t %}{% endfor %}"],
)
def test_templates_that_refuse(source):
    compiled = compile_template(source)
    with pytest.raises(TemplateError):
        compiled.render([], x={"y": 1}, many=list(range(64)))


@pytest.mark.parametrize("source", ["{{ 1", "{% for x in y %}", "{% endfor %}", "{{ x() }}", "{{ x|nothing }}", "{% while 1 %}", "{# x", "{{ 1 %}", "{% generation %}{% generation %}", "{{ 1 2 }}", "{{ x is odd }}", "{{ 'a }}"])
def test_templates_that_do_not_compile(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_constants_are_folded():
    assert compile_template("a{{ 'b' ~ 1 + 1 }}{% if 1 > 2 %}x{{ q }}{% elif true %}c{% endif %}{{ 'D'|lower }}").nodes == [Node("text", ("ab2cd",))]
    assert compile_template("{% if x and true %}a{% endif %}{% if false and x %}b{% endif %}").nodes[1:] == []
    assert compile_template("{{ true or q }}").render([])[0] == "true"


def test_generation_spans_and_streaming():
    source = "<{% for m in messages %}{{ m.role }}:{% generation %}{{ m.text }}{% endgeneration %};{% endfor %}>"
    messages = [{"role": "a", "text": "é🎉" * k} for k in range(5)]
    t = compile_template(source)
    text, spans = t.render(messages)
    assert t.streams and [text[a:b] for a, b in spans] == [m["text"] for m in messages[1:]]
    pieces = list(t.pieces(iter(messages), limit=1))
    assert "".join(p[1] for p in pieces) == text and len(pieces) == 5 and [p[0] for p in pieces] == [sum(len(q[1]) for q in pieces[:k]) for k in range(5)]
    whole = compile_template("{{ messages|length }}" + source)
    assert not whole.streams and whole.render(messages)[0] == "5" + text
    split = compile_template("{% for m in messages %}{% if loop.first %}{{ m.text }}{% endif %}{{ loop.previtem is defined }}{% endfor %}").render(messages[1:3])
    assert split == ("é🎉falsetrue", [])


def test_escape_round_trip():
    r = random.Random(2)
    for controls in (chat.CONTROLS, ("[INST]", "[/INST]", "#>"), ()):
        bits = ["\\", "a", "\n", *controls, *(c[:1] for c in controls), *(c[1:] for c in controls)]
        for _ in range(3000):
            t = "".join(r.choices(bits, k=r.randrange(9)))
            safe = chat.escape(t, controls)
            assert chat.unescape(safe, controls) == t and not any(c in safe for c in controls)
    for wrong in (("aa",), ("a",), ("a\\b",), ("ab", "ca")):
        with pytest.raises(ValueError):
            chat.escape("x", wrong)


def plain(rows):
    """conv_id -> what digests gives, from rows (conv_id, turn, role, text)."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    said = {}
    for c, t, role, text in sorted(rows, key=lambda x: tuple((y is not None, y) for y in x)):
        said.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in said.items():
        learned = "".join(x for role, x in turns if role == "assistant")
        length = sum(len(chat.escape(role)) + len(chat.escape(text)) + 21 for role, text in turns)
        out[c] = (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(learned), sha(learned), length)
    return out


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "</turn>\\</turn><\\/turn>"), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"), (2, None, None, "x"), (None, 0, "user", "n"), (None, None, "assistant", ""),
            (3, 0, "assistant", "long 🎉 <turn>" * 100_000), (3, 1, "</role>\n", "é"), (4, 5, "system", ""), *((5, k, "assistant" if k % 2 else "user", f"t{k}") for k in range(30))]
    df = spark.createDataFrame([(*r, "c", 7) for r in rows], "conv_id long, turn long, role string, text string, piece string, spans int")
    pieces = chat.format_conversations(df)
    got = {r.conv_id: tuple(r)[1:] for r in chat.digests(pieces).collect()}
    assert got == plain(rows)
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0
    text = pieces.where("conv_id = 4").first().text
    assert text == "<turn>system</role></turn>\n" and chat.read_turns(text) == [("system", "")]
    with pytest.raises(ValueError):
        chat.read_turns(text + "x")


def test_one_hot_conversation_comes_in_pieces(spark):
    df = spark.range(3000).select(F.lit(9).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.col("id").cast("string"), 300).alias("text"))
    pieces = chat.format_conversations(df)
    assert pieces.count() > 2 and pieces.agg(F.max(F.length("text"))).first()[0] < chat.PIECE + 2000
    assert {r.conv_id: tuple(r)[1:] for r in chat.digests(pieces).collect()} == plain([tuple(r) for r in df.collect()])


def test_a_refusing_template_tells_why(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "bad", "b"), (2, 1, "user", "c"), (3, 0, "user", "d")], "conv_id long, turn long, role string, text string")
    source = "{% for m in messages %}{% if m.role == 'bad' %}{{ raise_exception('role ' ~ m.role) }}{% endif %}{{ m.text }}{% endfor %}"
    assert sorted((r.conv_id, r.text, r.error) for r in chat.format_conversations(df, source).collect()) == [(1, "a", None), (2, None, "role bad"), (3, "d", None)]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = r"\### Assistant: </turn> ok"
    got = queries.op11_chat(spark, DIR).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == plain([*rows, (-7, 0, "user", odd), (-7, 1, "assistant", odd)]) and len(got) == len({r[0] for r in rows}) + 1
