"""As-of joins over the partitions of one key, joins of overlapping intervals, repair of bytes, comparison of JSON."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellumry.functions import text as X
from vellumry.operators import asof
from vellumry.operators import jsonedit as J


@pytest.mark.parametrize("n_keys", [1, 3, 40])
def test_spread_asof_equals_the_plain_one(spark, n_keys):
    r = random.Random(n_keys)
    key = lambda: r.choice([None, *range(n_keys)]) if n_keys > 1 else 0
    left = spark.createDataFrame([(key(), r.choice([None, *range(60)]), k) for k in range(500)], "k long, t long, id long")
    right = spark.createDataFrame([(key(), r.choice([None, *range(0, 60, 7)]), r.choice([None, "a", "b", "c"])) for _ in range(60)], "k long, t long, v string")
    for plain, spread in ((asof.last_before, asof.last_before_spread), (asof.first_after, asof.first_after_spread)):
        want = plain(left, right, ["k"], "t", "v", "x").collect()
        for partitions in (1, 7, 40):
            got = spread(left, right, ["k"], "t", "v", "x", partitions).collect()
            assert sorted(map(str, got)) == sorted(map(str, want))
    assert asof.last_before_spread(left.limit(0), right, ["k"], "t", "v", "x", 3).count() == 0
    none = asof.last_before_spread(left, right.limit(0), ["k"], "t", "v", "x", 3)
    assert none.count() == 500 and none.where("x IS NOT NULL").count() == 0


def test_one_key_with_all_rows_spreads(spark, monkeypatch):
    seen = {}
    real = asof.shared_folder
    monkeypatch.setattr(asof, "shared_folder", lambda s, n: seen.setdefault("at", real(s, n)))
    left = spark.range(40_000).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 40_000).alias("t"), "id")
    right = spark.createDataFrame([(1, 5, "only")], "k int, t long, v string")
    got = asof.last_before_spread(left, right, ["k"], "t", "v", "x", 16)
    assert got.where("x = 'only'").count() == 40_000 - 5
    sizes = sorted(r["count"] for r in spark.read.parquet(f"{seen['at']}/dealt").groupBy("_p").count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]


def test_overlaps_of_wide_and_narrow_intervals(spark):
    r = random.Random(1)

    def some(n):
        out = [(k, r.choice([0, 1, None]), float(r.randrange(-500, 500)), r.choice([0, 1, 3, 40, 2000, 10**7])) for k in range(n)]
        return [(k, c, a, a + w) for k, c, a, w in out] + [(n, 0, None, 1.0), (n + 1, 0, 5.0, 4.0), (n + 2, 0, 1.0, None), (0, 0, 7.0, 7.0)]

    a, b = some(150), some(120)
    left = spark.createDataFrame(a, "a long, c long, lo double, hi double")
    right = spark.createDataFrame(b, "b long, c long, lo2 double, hi2 double")
    meet = lambda x, y: None not in (*x, *y) and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and meet(x, y))
    got = asof.overlap_join(left, right, "lo", "hi", "lo2", "hi2", 1.0, ["c"]).select("a", "b").collect()
    assert sorted(map(tuple, got)) == want
    every = sorted((x[0], y[0]) for x in a for y in b if meet((0, 0, *x[2:]), (0, 0, *y[2:])))
    got = asof.overlap_join(left.drop("c"), right.drop("c"), "lo", "hi", "lo2", "hi2", 25.0).select("a", "b").collect()
    assert sorted(map(tuple, got)) == every and asof.overlap_join(left.limit(0), right, "lo", "hi", "lo2", "hi2", 1.0, ["c"]).count() == 0


def by_bytes(b):
    """The longest valid character at each place, or <xx> for one byte."""
    out, i = "", 0
    while i < len(b):
        for n in (1, 2, 3, 4):
            try:
                c = b[i : i + n].decode()
            except UnicodeDecodeError:
                continue
            if len(c) == 1 and len(b[i : i + n]) == n:
                out, i = out + c, i + n
                break
        else:
            out, i = out + f"<{b[i]:02x}>", i + 1
    return out


def test_repair_of_every_fault(spark):
    faults = [bytes([x]) for x in range(128, 256)] + [bytes([x, y]) for x in (0xC0, 0xC2, 0xDF, 0xE0, 0xED, 0xEF, 0xF0, 0xF4, 0xF5) for y in (0x41, 0x7F, 0x80, 0x8F, 0x90, 0x9F, 0xA0, 0xBF, 0xC0)]
    faults += [bytes([0xE0, 0x80, 0x80]), bytes([0xED, 0xA0, 0x80]), "é".encode()[:1] + "é".encode(), bytes([0xF4, 0x90, 0x80, 0x80]), bytes([0xF0, 0x9F, 0x8E]), bytes([0xF0, 0x9F, 0x41]), bytes([0xF8, 0x88, 0x80, 0x80, 0x80]), "🎉".encode()]
    rows = [b"a" + f + b"b" for f in faults] + faults + [b"", None, "valid é\0".encode()]
    got = spark.createDataFrame([(k, b) for k, b in enumerate(rows)], "k int, b binary").select("k", X.repaired(F.col("b")).alias("t")).collect()
    assert {r.k: r.t for r in got} == {k: None if b is None else by_bytes(b) for k, b in enumerate(rows)}

    @settings(max_examples=10, deadline=None)
    @given(st.lists(st.binary(max_size=12), min_size=1, max_size=60))
    def run(many):
        got = spark.createDataFrame([(k, b) for k, b in enumerate(many)], "k int, b binary").select("k", X.repaired(F.col("b")).alias("t"), X.clean_text(F.col("b")).alias("c")).collect()
        assert {r.k: r.t for r in got} == {k: by_bytes(b) for k, b in enumerate(many)}
        assert {r.k: r.c for r in got} == {k: by_bytes(b.replace(b"\0", b"")).replace("\r\n", "\n").replace("\r", "\n") for k, b in enumerate(many)}

    run()


def compare(spark, before, after):
    pair = [spark.createDataFrame([(k, None if x is None else x.encode()) for k, x in side.items()], "file string, content binary") for side in (before, after)]
    found = sorted((r.file, r.path, r.what, r.before, r.after) for r in J.json_compare(*pair).collect())
    return found, {r.file: (r.verdict, r.n_strings) for r in J.json_verdicts(*pair).collect()}


def test_json_compare_cases(spark):
    a = {"same": '{"a": [1, {"b": "x"}], "": null}', "text": '{"a/b": ["x", "y"], "~": "z"}', "leaf": '{"a": 1, "b": "x"}', "kind": '{"a": 1}', "order": '{"a": 1, "b": 2}', "more": "[1]", "twice": '{"a": "x", "a": "y"}', "gone": "{}", "bad": "{", "null": None, "deep": "[" * 3000 + "]" * 3000, "float": "[1.0, 1e2]", "empty": '{"a": {}}'}
    b = {"same": '{"a":[1,{"b":"\\u0078"}],"":null}', "text": '{"a/b": ["x", "Y"], "~": "Z"}', "leaf": '{"a": 2, "b": "y"}', "kind": '{"a": 1.0}', "order": '{"b": 2, "a": 1}', "more": "[1, 2]", "twice": '{"a": "x", "a": "z"}', "new": "[]", "bad": "{", "null": "1", "deep": "[]", "float": "[1.0, 100.0]", "empty": '{"a": []}'}
    found, verdicts = compare(spark, a, b)
    assert verdicts == {"same": ("same", 0), "text": ("changed", 2), "leaf": ("refused", 1), "kind": ("refused", 0), "order": ("refused", 0), "more": ("refused", 0), "twice": ("changed", 1), "gone": ("refused", 0), "new": ("refused", 0), "bad": ("refused", 0), "null": ("refused", 0), "deep": ("refused", 0), "float": ("same", 0), "empty": ("refused", 0)}
    assert ("text", "/a~1b/1", "string", "y", "Y") in found and ("text", "/~0", "string", "z", "Z") in found and ("leaf", "/a", "leaf", "1", "2") in found and ("more", "/1", "shape", None, "2") in found


def test_json_compare_equals_the_walk(spark):
    r = random.Random(3)

    def doc(depth):
        kind = r.randrange(7 if depth else 5)
        return [1, "s", "t", True, None, {k: doc(depth - 1) for k in r.sample("abc", r.randrange(4))} if kind == 5 else None, [doc(depth - 1) for _ in range(r.randrange(3))] if kind == 6 else None][kind]

    def change(x):
        if isinstance(x, dict):
            return {k: change(v) for k, v in x.items()}
        if isinstance(x, list):
            return [change(v) for v in x]
        return r.choice([x] * 9 + ["u"]) if isinstance(x, str) else r.choice([x] * 19 + [7])

    before = {str(k): doc(3) for k in range(300)}
    after = {k: change(v) for k, v in before.items()}
    _, verdicts = compare(spark, *({k: json.dumps(v) for k, v in side.items()} for side in (before, after)))
    for k in before:
        walk = J.leaf_changes(before[k], after[k])
        assert verdicts[k][0] == ("refused" if walk is None else "changed" if walk else "same")
        assert walk is None or verdicts[k][1] == len(walk)
