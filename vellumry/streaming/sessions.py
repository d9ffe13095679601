"""Sessions of events by event time, as a stream that can stop and go on, and as a batch.

A session is a stretch of one key's events in which each comes `gap` or less after the one before it. The stream
gives a session out once the watermark (largest event time seen, less `delay`) has passed its last event by the gap, so its state
holds open sessions alone. Rows that come after their session's end has passed are late: they are in no session, and `late_rows` counts them.

All work is Spark's own session window, in the JVM. In the stream each partition merges its rows into sessions before the shuffle, so a
key with a third of all rows sends one row for each stretch and partition, not one for each event.

Rows without event time are left out; null keys are a key of their own; rows that occur twice count twice; events of one time are
one session whatever their order. An empty table has no sessions. Columns other than those named aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def sessions(events: DataFrame, key: str, ts: str, gap: str, value: str | None = None) -> DataFrame:
    """Batch or stream to sessions: key, first_ts, last_ts, n_events and, if asked for, the sum of a column as total."""
    total = [F.sum(value).alias("total")] if value else []
    by = events.where(F.col(ts).isNotNull()).groupBy(F.col(key), F.session_window(ts, gap))
    out = by.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n_events"), *total)
    return out.select(key, "first_ts", "last_ts", "n_events", *(["total"] if value else []))


def stream_sessions(spark: SparkSession, folder: str, schema: T.StructType, target: str, checkpoint: str, key: str, ts: str, gap: str, delay: str, value: str | None = None, files: int | None = None) -> None:
    """Read the Parquet files that are new in a folder, add the sessions that ended to a Parquet table, then stop.

    A later call goes on from the checkpoint: no file is read twice and no session is written twice, also after a
    call that died. `files` bounds the files of one micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    rows = reader.parquet(folder)
    # Watermarks need instants: times without zone are taken as UTC and given back without zone, whatever the session's zone is.
    plain = isinstance(schema[ts].dataType, T.TimestampNTZType)
    if plain:
        rows = rows.withColumn(ts, _instant(F.col(ts)))
    out = sessions(rows.withWatermark(ts, delay), key, ts, gap, value)
    if plain:
        out = out.withColumns({c: _wall(F.col(c)) for c in ("first_ts", "last_ts")})
    with _merging_first(spark):
        q = out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


def end_marker(spark: SparkSession, schema: T.StructType, key: str, ts: str, last: str, gap: str, delay: str) -> DataFrame:
    """One row without key, so late that the next call of `stream_sessions` gives out all sessions up to `last` (a time as text). Its own session stays open.

    Append it to the folder only when no event follows: what comes after it and is older is late.
    """
    at = F.lit(last).cast(schema[ts].dataType) + F.expr(f"INTERVAL {gap}") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 SECOND")
    return spark.range(1).select(*[(at if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def late_rows(events: DataFrame, done: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows of each key that are in no session, once all sessions are given out: key, n_late (none with 0)."""
    read = events.where(F.col(ts).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n_read"))
    there = done.groupBy(F.col(key).alias("k2")).agg(F.sum("n_events").alias("n_there"))
    both = read.join(there, F.col("k").eqNullSafe(F.col("k2")), "left")
    return both.select(F.col("k").alias(key), (F.col("n_read") - F.coalesce("n_there", F.lit(0))).alias("n_late")).where("n_late > 0")


def _instant(c: Column) -> Column:
    return F.timestamp_seconds(F.lit(0)) + (c - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def _wall(c: Column) -> Column:
    seconds = F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


@contextmanager
def _merging_first(spark: SparkSession) -> Iterator[None]:
    """Queries started inside merge sessions before the shuffle; the session's setting is put back."""
    before = spark.conf.get(_MERGE_FIRST)
    spark.conf.set(_MERGE_FIRST, "true")
    try:
        yield
    finally:
        spark.conf.set(_MERGE_FIRST, before)
