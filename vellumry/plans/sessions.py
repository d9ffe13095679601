"""Sessions of `events`, read as a stream whose rows arrive out of order."""

from __future__ import annotations

from vellumry.plans._kit import F, query, table
from vellumry.session import shared_folder
from vellumry.streaming import sessions as S

#: Rows arrive up to two hours after their time, in four deliveries.
DELIVERIES, LATENESS, GAP = 4, 7200, "1 hour"


@query(
    "event_sessions",
    """WITH g AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS first FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
       s AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
       SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*)::BIGINT AS n_events, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS total FROM s GROUP BY user_id, k""",
)
def event_sessions(spark, d):
    """All events as a stream of four deliveries; none is later than the watermark allows, so the sessions are those of the whole table."""
    e = table(spark, d, "events").select("user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("cents"), "event_id")
    arrival = F.unix_timestamp(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(LATENESS))
    come = e.withColumn("arrival", arrival)
    span = come.agg(F.min("arrival").alias("a"), F.max("arrival").alias("b"), F.max("ts").cast("string").alias("last")).first()
    folder, target, state = (shared_folder(spark, f"sessions-{x}") for x in ("in", "out", "state"))
    schema = e.drop("event_id").schema
    step = ((span.b or 0) - (span.a or 0)) // DELIVERIES + 1
    come = come.withColumn("delivery", F.floor((F.col("arrival") - F.lit(span.a or 0)) / F.lit(step)))
    staged = shared_folder(spark, "sessions-staged")
    come.drop("event_id", "arrival").write.partitionBy("delivery").parquet(staged)
    # Rows without time have no delivery, and no session.
    parts = [spark.read.schema(schema).parquet(f"{staged}/delivery={k}") for (k,) in spark.read.parquet(staged).select("delivery").distinct().where("delivery IS NOT NULL").orderBy("delivery").collect()]
    if span.last is not None:
        parts.append(S.end_marker(spark, schema, "user_id", "ts", span.last, GAP, f"{LATENESS} seconds"))
    for rows in parts:
        rows.write.mode("append").parquet(folder)
        S.stream_sessions(spark, folder, schema, target, state, "user_id", "ts", GAP, f"{LATENESS} seconds", "cents")
    if not parts:
        return S.sessions(e, "user_id", "ts", GAP, "cents")
    return spark.read.parquet(target)
