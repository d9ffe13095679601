"""Sessions: batch against a loop, streams against the batch, late rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vellumry.streaming import sessions as S

SCHEMA = "user_id long, ts timestamp_ntz, value long, first_ts string, n_events int"
T0 = datetime(2024, 3, 30, 20)


def _rows(n=400, seed=1):
    r = random.Random(seed)
    rows = [(r.choice([1, 2, 3, None]), T0 + timedelta(seconds=r.randint(0, 40_000)), k, "x", 0) for k in range(n)]
    rows += [(1, None, 5, None, None), (9, T0, None, None, None), (9, T0 + timedelta(minutes=10), 2, None, None)]
    return rows + rows[:3]


def _loop(rows, gap=timedelta(minutes=10)):
    out = []
    for key in {r[0] for r in rows}:
        run = []
        for t, v in sorted(((r[1], r[2]) for r in rows if r[0] == key and r[1] is not None), key=lambda x: x[0]):
            if run and t > run[-1][0] + gap:
                out.append((key, run))
                run = []
            run.append((t, v))
        if run:
            out.append((key, run))
    return sorted(((k, r[0][0], r[-1][0], len(r), sum(v for _, v in r if v is not None) if any(v is not None for _, v in r) else None) for k, r in out), key=repr)


def _deliver(spark, path, parts, schema, delay, close):
    frames = [spark.createDataFrame(p, SCHEMA) for p in parts]
    if close:
        frames.append(S.end_marker(spark, schema, "user_id", "ts", str(max(r[1] for p in parts for r in p if r[1])), "10 minutes", delay))
    for f in frames:
        f.write.mode("append").parquet(f"{path}/in")
        S.stream_sessions(spark, f"{path}/in", schema, f"{path}/out", f"{path}/state", "user_id", "ts", "10 minutes", delay, "value")
    return spark.read.parquet(f"{path}/out")


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_batch_equals_loop(spark, schema):
    e = spark.createDataFrame(_rows(), SCHEMA)
    assert _sorted(S.sessions(e, "user_id", "ts", "10 minutes", "value")) == _loop(_rows())
    assert S.sessions(e.limit(0), "user_id", "ts", "10 minutes").count() == 0


def test_shuffled_micro_batches_equal_batch(spark, schema, tmp_path):
    rows = _rows()
    random.Random(7).shuffle(rows)
    before = spark.conf.get(S._MERGE_FIRST)
    done = _deliver(spark, tmp_path, [rows[:130], rows[130:260], rows[260:]], schema, "1 day", True)
    assert _sorted(done) == _loop(_rows()) and spark.conf.get(S._MERGE_FIRST) == before
    assert S.late_rows(spark.createDataFrame(rows, SCHEMA), done, "user_id", "ts").count() == 0


def test_late_rows_are_counted(spark, schema, tmp_path):
    """The second delivery holds rows long past the watermark, of a key with sessions, of one without and without key."""
    day = timedelta(days=1)
    first = [(1, T0 + day, 1, None, 0), (1, T0 + day + timedelta(minutes=5), 2, None, 0)]
    second = [(1, T0, 3, None, 0), (1, T0, 4, None, 0), (2, T0, 5, None, 0), (None, T0, 6, None, 0), (1, T0 + day + timedelta(minutes=9), 7, None, 0)]
    done = _deliver(spark, tmp_path, [first, second], schema, "1 hour", True)
    assert _sorted(done) == _loop(first + second[-1:])
    late = S.late_rows(spark.createDataFrame(first + second, SCHEMA), done, "user_id", "ts")
    assert sorted(map(tuple, late.collect()), key=repr) == [(1, 2), (2, 1), (None, 1)]


def test_open_sessions_wait(spark, schema, tmp_path):
    assert _deliver(spark, tmp_path, [[(1, T0, 1, None, 0)]], schema, "1 hour", False).count() == 0
