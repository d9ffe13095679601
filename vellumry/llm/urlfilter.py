"""URL filters as a temporal list join, in DataFrame functions only.

Dated list entries (a key is added to or removed from a list at some time) are
validity intervals: of each (list, kind, key) an addition holds until the next
entry. A capture has a key for each suffix of its host and each leading path of
its URL that is as long as some entry's. The as-of join merges captures and entries
of a (list, key) in order of time and carries the last entry along, so no pair
of a capture and an interval is formed; start included, end excluded.

Captures are met in distinct (key, time) form and counted before the shuffle back.
A key with more than SPLIT times is dealt to several groups, each with all
of the key's entries, so a host that a third of all captures share is no single task.

Hosts are compared without user, port and trailing dots; a numeric or bracketed
(IPv6) address has no suffixes but itself. Defined results: a null URL or time, or a URL
without a host, is on no list. Entries with a null field are no entries; of
entries of one key and time the removal comes last. Repeated captures give repeated
rows. Empty tables: no rows, or captures that are on no list. Other columns are
ignored. Only lengths of paths that entries have are cut from a URL, so a very long one costs no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of keys.
HOST, PREFIX = "host", "prefix"


#: Times of a key that are merged as one group.
SPLIT = 20_000


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots, a bracketed address with its brackets; null if there is none."""
    h = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)", 1))
    h = F.regexp_replace(h, r"\.+$", "")
    return F.when(h != "", h)


def segments_of(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda x: x != "")


def keys_of(url: Column, depths: list[int]) -> Column:
    """Array of struct(kind, key) that a list entry may name to cover the URL; depths: numbers of segments of paths that entries have."""
    host = host_of(url)
    parts, segs = F.split(host, r"\."), segments_of(url)
    whole = host.rlike(r"^\[|^[0-9.]+$")
    hosts = F.transform(
        F.sequence(F.lit(1), F.when(whole, 1).otherwise(F.size(parts))),
        lambda i: F.struct(F.lit(HOST).alias("kind"), F.array_join(F.slice(parts, i, F.size(parts)), ".").alias("key")),
    )
    if not depths:
        return F.when(host.isNotNull(), hosts)
    prefixes = F.transform(
        F.filter(F.array(*map(F.lit, depths)), lambda i: i <= F.size(segs)),
        lambda i: F.struct(F.lit(PREFIX).alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(segs, F.lit(1), i), "/")).alias("key")),
    )
    return F.when(host.isNotNull(), F.concat(hosts, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """entries (list, kind, key, action add/remove, at) -> (list, kind, key, since, until), until null if still valid."""
    e = entries.select("list", "kind", "key", "action", "at").dropna()
    w = Window.partitionBy("list", "kind", "key").orderBy("at", "action")
    e = e.withColumn("until", F.lead("at").over(w))
    return e.where("action = 'add' AND (until IS NULL OR until > at)").select("list", "kind", "key", F.col("at").alias("since"), "until")


def on_lists(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures (id, url, fetched) -> (id, url, fetched, n_lists long, lists string: names joined by ',')."""
    e = entries.select("list", "kind", "key", "action", "at").dropna()
    depths = sorted(r.n for r in e.where(F.col("kind") == PREFIX).select((F.size(F.split("key", "/")) - 1).alias("n")).distinct().collect())
    seen = captures.select("url", "fetched").dropna().distinct()
    keyed = seen.select("url", "fetched", F.explode(keys_of(F.col("url"), depths)).alias("k")).select("url", "fetched", "k.kind", "k.key")
    lists = e.select("list", "kind", "key").distinct()
    # each (key, time) meets the entries once, however many URLs share it, and only where a list has the key
    asked = keyed.select("kind", "key", "fetched").distinct().join(lists, ["kind", "key"])
    groups = asked.groupBy("list", "kind", "key").agg(F.ceil(F.count(F.lit(1)) / SPLIT).cast("int").alias("groups"))
    key = ["list", "kind", "key"]
    dealt = e.join(groups, key).withColumn("grp", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    dealt = dealt.select(*key, "grp", F.col("at").alias("t"), F.lit(0).alias("side"), "action")
    times = asked.join(groups, key).select(*key, F.pmod(F.xxhash64("fetched"), "groups").cast("int").alias("grp"), F.col("fetched").alias("t"), F.lit(1).alias("side"), F.lit(None).cast("string").alias("action"))
    w = Window.partitionBy(*key, "grp").orderBy("t", "side", "action").rowsBetween(Window.unboundedPreceding, 0)
    held = dealt.unionByName(times).withColumn("last", F.last("action", ignorenulls=True).over(w)).where("side = 1 AND last = 'add'")
    held = held.groupBy("kind", "key", F.col("t").alias("fetched")).agg(F.array_sort(F.collect_set("list")).alias("names"))
    found = keyed.join(held, ["kind", "key", "fetched"]).groupBy("url", "fetched").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"))
    out = captures.select("id", "url", "fetched").join(found, ["url", "fetched"], "left")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return out.select("id", "url", "fetched", F.size(names).cast("long").alias("n_lists"), F.array_join(names, ",").alias("lists"))


def _digit(key: Column, i: int) -> Column:
    return (F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(key.cast("binary")), i, 1)) - 1).cast("int")


def demo_entries(captures: DataFrame) -> DataFrame:
    """A list history over the hosts, leading paths and domains that captures hold, dated by hashes of the keys, and as many hosts that none holds."""
    url = F.col("url")
    host = host_of(url)
    parts = F.split(host, r"\.")
    keys = captures.select(
        F.explode(
            F.array(
                F.struct(F.lit("malware").alias("list"), F.lit(HOST).alias("kind"), host.alias("key")),
                F.struct(F.lit("phish").alias("list"), F.lit(PREFIX).alias("kind"), F.when(F.size(segments_of(url)) > 0, F.concat(host, F.lit("/"), segments_of(url)[0])).alias("key")),
                F.struct(F.lit("tracker").alias("list"), F.lit(HOST).alias("kind"), F.when(F.size(parts) >= 2, F.array_join(F.slice(parts, -2, 2), ".")).alias("key")),
            )
        ).alias("e")
    ).select("e.*").where("key IS NOT NULL").distinct()
    k = F.col("key")
    start = _digit(k, 1) * 16 + _digit(k, 2)
    steps = F.array(
        F.struct(F.lit("add").alias("action"), start.alias("day")),
        F.struct(F.when(_digit(k, 3) < 8, F.lit("remove")).alias("action"), (start + 40).alias("day")),
        F.struct(F.when(_digit(k, 4) < 8, F.lit("add")).alias("action"), (start + 90).alias("day")),
    )
    absent = keys.where("kind = 'host'").select(F.lit("elsewhere").alias("list"), "kind", F.concat(F.md5(F.col("key").cast("binary")), F.lit(".invalid")).alias("key")).distinct()
    keys = keys.unionByName(absent)
    chosen = keys.where((F.col("list") == "tracker") | (_digit(k, 5) < 6))
    flat = chosen.select("list", "kind", "key", F.explode(steps).alias("s")).select("list", "kind", "key", "s.action", "s.day").where("action IS NOT NULL")
    return flat.select("list", "kind", "key", "action", F.timestamp_seconds(F.lit(1704067200) + F.col("day").cast("long") * 86400).alias("at"))


ORACLE = r"""
WITH cap AS (
  SELECT page_id, url, to_timestamp(1704067200 + (page_id * 7919 % 365) * 86400) AS fetched,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS segs
  FROM pages),
keyed AS (
  SELECT page_id, fetched, 'host' AS kind, array_to_string(string_split(host, '.')[i:], '.') AS key
  FROM (SELECT page_id, fetched, host, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM cap WHERE host IS NOT NULL)
  UNION ALL
  SELECT page_id, fetched, 'prefix', host || '/' || array_to_string(list_slice(segs, 1, i), '/')
  FROM (SELECT page_id, fetched, host, segs, unnest(range(1, len(segs) + 1)) AS i FROM cap WHERE host IS NOT NULL)),
keys AS (
  SELECT 'malware' AS list, 'host' AS kind, host AS key FROM cap WHERE host IS NOT NULL
  UNION SELECT 'phish', 'prefix', host || '/' || segs[1] FROM cap WHERE host IS NOT NULL AND len(segs) > 0
  UNION SELECT 'tracker', 'host', array_to_string(string_split(host, '.')[-2:], '.') FROM cap WHERE len(string_split(host, '.')) >= 2),
digits AS (
  SELECT list, kind, key, instr('0123456789abcdef', substr(md5(key), 1, 1)) - 1 AS d1, instr('0123456789abcdef', substr(md5(key), 2, 1)) - 1 AS d2,
         instr('0123456789abcdef', substr(md5(key), 3, 1)) - 1 AS d3, instr('0123456789abcdef', substr(md5(key), 4, 1)) - 1 AS d4,
         instr('0123456789abcdef', substr(md5(key), 5, 1)) - 1 AS d5 FROM keys),
entries AS (
  SELECT list, kind, key, 'add' AS action, d1 * 16 + d2 AS day FROM digits WHERE list = 'tracker' OR d5 < 6
  UNION ALL SELECT list, kind, key, 'remove', d1 * 16 + d2 + 40 FROM digits WHERE (list = 'tracker' OR d5 < 6) AND d3 < 8
  UNION ALL SELECT list, kind, key, 'add', d1 * 16 + d2 + 90 FROM digits WHERE (list = 'tracker' OR d5 < 6) AND d4 < 8),
ivals AS (
  SELECT list, kind, key, action, day, lead(day) OVER (PARTITION BY list, kind, key ORDER BY day, action) AS until FROM entries),
found AS (
  SELECT page_id, list FROM keyed k JOIN ivals v ON k.kind = v.kind AND k.key = v.key AND v.action = 'add'
   AND epoch(k.fetched) >= 1704067200 + v.day * 86400 AND (v.until IS NULL OR epoch(k.fetched) < 1704067200 + v.until * 86400)
  GROUP BY page_id, list)
SELECT c.page_id, c.url, strftime(make_timestamp(1000000 * (1704067200 + (c.page_id * 7919 % 365) * 86400)), '%Y-%m-%d') AS fetched,
       count(f.list)::BIGINT AS n_lists, coalesce(string_agg(f.list, ',' ORDER BY f.list), '') AS lists
FROM cap c LEFT JOIN found f ON c.page_id = f.page_id GROUP BY c.page_id, c.url
"""
