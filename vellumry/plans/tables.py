"""Reconciliation, order, hierarchy, rule and audit queries over the star schema."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellumry.operators import asof as A
from vellumry.operators import hierarchy as T
from vellumry.operators import integrity as I
from vellumry.plans._kit import query, table, views


@query("order_line_reconcile", "SELECT o_orderkey AS k, 'missing' AS status FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT l_orderkey, CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders) THEN 'duplicate' ELSE 'extra' END FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1 OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def order_line_reconcile(spark, d):
    o, li = views(spark, d, "orders", "lineitem")
    return I.compare_sets(o.select(F.col("o_orderkey").alias("k")), li.select(F.col("l_orderkey").alias("k")), ["k"])


@query("stream_completeness", "SELECT conv_id, (max(turn) + 1)::BIGINT AS expected, count(DISTINCT turn)::BIGINT AS found FROM conversations GROUP BY conv_id")
def stream_completeness(spark, d):
    c = table(spark, d, "conversations")
    return c.groupBy("conv_id").agg((F.max("turn") + 1).cast("long").alias("expected"), F.countDistinct("turn").alias("found"))


@query("number_gaps", "WITH m AS (SELECT l_orderkey, max(l_linenumber) AS m FROM lineitem GROUP BY 1), e AS (SELECT l_orderkey, unnest(range(1, m + 1)) AS missing FROM m) SELECT l_orderkey, missing::BIGINT AS missing FROM e EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem")
def number_gaps(spark, d):
    return I.number_gaps(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("leftover_ids", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def leftover_ids(spark, d):
    o, li = views(spark, d, "orders", "lineitem")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left_anti").select("o_orderkey")


@query("post_chunks", "SELECT o_orderkey, ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + 19) // 20)::BIGINT AS chunk FROM orders")
def post_chunks(spark, d):
    return I.chunk_rows(table(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey").select("o_orderkey", "chunk")


@query("first_occurrence", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def first_occurrence(spark, d):
    return I.first_occurrence(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"])


@query(
    "anchor_name_uniqueness",
    """WITH n AS (SELECT DISTINCT conv_id, turn, role FROM conversations), f AS (SELECT *, min(turn) OVER (PARTITION BY conv_id, role) AS first FROM n)
       SELECT conv_id, turn, role, CASE WHEN turn = first THEN role ELSE role || '-p' || turn END AS anchor FROM f""",
)
def anchor_name_uniqueness(spark, d):
    n = table(spark, d, "conversations").select("conv_id", "turn", "role").distinct()
    first = F.min("turn").over(Window.partitionBy("conv_id", "role"))
    return n.withColumn("anchor", F.when(F.col("turn") == first, F.col("role")).otherwise(F.concat("role", F.lit("-p"), "turn")))


@query("category_paths", "SELECT 'r' || r_regionkey AS id, 1 AS level, r_name AS path FROM region UNION ALL SELECT 'n' || n_nationkey, 2, r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def category_paths(spark, d):
    r, n = views(spark, d, "region", "nation")
    top = r.select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("slug"))
    sub = n.select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("slug"))
    return T.paths(top.unionByName(sub))


@query("category_counts", "SELECT c_nationkey, (count(*) - 1)::BIGINT AS n FROM customer GROUP BY c_nationkey")
def category_counts(spark, d):
    c = table(spark, d, "customer").select("c_nationkey", F.col("c_custkey").alias("item_id"))
    about = c.groupBy("c_nationkey").agg(F.min("item_id").alias("item_id"))
    return T.own_counts(c, "c_nationkey", about)


@query("home_index", "SELECT r_name, string_agg(n_name, ',' ORDER BY n_nationkey) AS children FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name")
def home_index(spark, d):
    r, n = views(spark, d, "region", "nation")
    kids = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("k"))
    return r.join(kids, r.r_regionkey == kids.n_regionkey).select("r_name", F.array_join("k.n_name", ",").alias("children"))


@query(
    "category_rows",
    """SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY (c_mktsegment = 'BUILDING') DESC, coalesce(last, TIMESTAMP '1970-01-01') DESC, c_custkey DESC)::BIGINT AS pos
       FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def category_rows(spark, d):
    c, o = views(spark, d, "customer", "orders")
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    active = F.coalesce(F.col("last").cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    w = Window.partitionBy("c_nationkey").orderBy(F.desc(F.col("c_mktsegment") == "BUILDING"), F.desc(active), F.desc("c_custkey"))
    return c.join(last, c.c_custkey == last.o_custkey, "left").select("c_custkey", F.row_number().over(w).cast("long").alias("pos"))


@query("topic_category_join", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def topic_category_join(spark, d):
    c, n, r = views(spark, d, "customer", "nation", "region")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", "n_name", "r_name")


@query("unknown_category_guard", "SELECT count(*)::BIGINT AS n_unknown FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)")
def unknown_category_guard(spark, d):
    """JON-01's guard, with the categories of one region missing."""
    c, n = views(spark, d, "customer", "nation")
    return c.join(n.where("n_regionkey <> 2"), c.c_nationkey == n.n_nationkey, "left_anti").agg(F.count(F.lit(1)).alias("n_unknown"))


@query("reply_targets", "SELECT a.conv_id, a.turn, b.turn IS NOT NULL AS known FROM conversations a LEFT JOIN (SELECT DISTINCT conv_id, turn FROM conversations) b ON a.conv_id = b.conv_id AND a.turn - 1 = b.turn")
def reply_targets(spark, d):
    c = table(spark, d, "conversations")
    b = c.select(F.col("conv_id").alias("bc"), F.col("turn").alias("bt")).distinct()
    return c.join(b, (c.conv_id == b.bc) & (c.turn - 1 == b.bt), "left").select("conv_id", "turn", F.col("bt").isNotNull().alias("known"))


@query("manifest_sha256", "SELECT doc_id, octet_length(encode(text))::BIGINT AS bytes, sha256(text) AS sha256 FROM documents")
def manifest_sha256(spark, d):
    return table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"))


@query("site_fingerprint", "SELECT sha256(string_agg(sha256(text) || '  ' || doc_id, chr(10) ORDER BY sha256(text) || '  ' || doc_id)) AS fingerprint FROM documents")
def site_fingerprint(spark, d):
    from vellumry.sources.sinks import fingerprint

    m = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("p"), F.sha2("text", 256).alias("s"))
    return fingerprint(m, F.col("p"), F.col("s"))


@query("size_before_hash_diff", "SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN 'size' WHEN 2 THEN 'content' ELSE 'missing' END AS status FROM documents WHERE doc_id % 4 > 0")
def size_before_hash_diff(spark, d):
    a = table(spark, d, "documents").select("doc_id", F.octet_length("text").alias("size"), F.sha2("text", 256).alias("sha"))
    k = F.col("doc_id") % 4
    b = a.where(k < 3).select("doc_id", F.when(k == 1, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(k == 2, F.lit("x")).otherwise(F.col("sha")).alias("sha"))
    return I.compare_bytes(a, b, "doc_id", "size", "sha")


@query("last_marker_before", "SELECT p.event_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts >= v.ts")
def last_marker_before(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    out = A.last_before(e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), ["user_id"], "ts", "event_id", "view_id")
    return out.select("event_id", "view_id")


@query("next_marker_after", "SELECT p.event_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, ts, min(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts <= v.ts")
def next_marker_after(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    out = A.first_after(e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), ["user_id"], "ts", "event_id", "view_id")
    return out.select("event_id", "view_id")


_ONE = "SELECT p.event_id, v.event_id AS view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT ts, {0}(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1) v ON p.ts {1} v.ts"


def _one_key(spark, d, look):
    """Purchases and views of all users, as one key that all rows share."""
    e = table(spark, d, "events").select("event_id", F.lit("all").alias("k"), "ts", "event_type")
    out = look(e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), ["k"], "ts", "event_id", "view_id", 4 * spark.sparkContext.defaultParallelism)
    return out.select("event_id", "view_id")


@query("last_marker_one_key", _ONE.format("max", ">="))
def last_marker_one_key(spark, d):
    """JON-22, the rows of one key spread over all partitions."""
    return _one_key(spark, d, A.last_before_spread)


@query("next_marker_one_key", _ONE.format("min", "<="))
def next_marker_one_key(spark, d):
    """JON-23, likewise."""
    return _one_key(spark, d, A.first_after_spread)


@query(
    "interval_overlaps",
    """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, epoch(o_orderdate)::BIGINT AS lo, epoch(o_orderdate)::BIGINT + 86400 * CASE WHEN o_orderkey % 7 = 0 THEN 1000 ELSE o_orderkey % 40 END AS hi FROM orders)
       SELECT a.k AS a, b.k AS b FROM o a JOIN o b ON a.c = b.c AND a.k < b.k AND a.lo <= b.hi AND b.lo <= a.hi""",
)
def interval_overlaps(spark, d):
    """Orders of one customer whose times overlap; every seventh is open for a thousand days, the others for some."""
    lo = F.unix_timestamp(F.date_trunc("second", "o_orderdate"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("c"), lo.alias("lo"))
    o = o.withColumn("hi", F.col("lo") + 86400 * F.when(F.col("a") % 7 == 0, 1000).otherwise(F.col("a") % 40))
    other = o.select(F.col("a").alias("b"), "c", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    return A.overlap_join(o, other, "lo", "hi", "lo2", "hi2", 10 * 86400.0, ["c"]).where("a < b").select("a", "b")


@query("range_lookup", "SELECT p_partkey, r AS band FROM part, (VALUES (0, 0.0, 999.99), (1, 1000.0, 1299.99), (2, 1300.0, 1e9)) t(r, lo, hi) WHERE p_retailprice BETWEEN lo AND hi")
def range_lookup(spark, d):
    bands = spark.createDataFrame([(0, 0.0, 999.99), (1, 1000.0, 1299.99), (2, 1300.0, 1e9)], "band int, lo double, hi double")
    return A.range_lookup(table(spark, d, "part").select("p_partkey", "p_retailprice"), bands, "p_retailprice", "lo", "hi", 1000.0).select("p_partkey", "band")


@query("first_seen_counts", "SELECT source, count(*)::BIGINT AS n, min(doc_id) AS first_seen FROM documents GROUP BY source")
def first_seen_counts(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min_by("doc_id", "doc_id").alias("first_seen"))


@query("tag_usage", "SELECT tag, count(*)::BIGINT AS n, count(DISTINCT doc_id)::BIGINT AS n_docs FROM (SELECT doc_id, unnest([lang, source]) AS tag FROM documents) GROUP BY tag")
def tag_usage(spark, d):
    t = table(spark, d, "documents").select("doc_id", F.explode(F.array("lang", "source")).alias("tag"))
    return t.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query("asset_kind_counts", r"SELECT array_to_string(string_split(regexp_extract(url, '^[a-z]+://([^?#]*)', 1), '/')[1:2], '/') AS prefix, count(*)::BIGINT AS n FROM pages GROUP BY 1")
def asset_kind_counts(spark, d):
    p = F.split(F.regexp_extract("url", r"^[a-z]+://([^?#]*)", 1), "/")
    return table(spark, d, "pages").groupBy(F.array_join(F.slice(p, 1, 2), "/").alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


@query("case_collisions", "WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part), v AS (SELECT w FROM w UNION SELECT upper(w) FROM w WHERE length(w) > 4) SELECT w AS path, count(*) OVER (PARTITION BY lower(w)) AS n FROM v QUALIFY n > 1")
def case_collisions(spark, d):
    w = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("path")).distinct()
    return I.case_collisions(w.unionByName(w.where("length(path) > 4").select(F.upper("path").alias("path"))), "path")


@query("post_totals", "SELECT count(*)::BIGINT AS n_in, count_if(role = 'user' AND NOT h)::BIGINT AS n_rendered, count_if(role = 'system' AND NOT h)::BIGINT AS n_system, count_if(h)::BIGINT AS n_hidden, count_if(role NOT IN ('user', 'system') AND NOT h)::BIGINT AS n_other FROM (SELECT role, conv_id % 5 = 2 AND turn > 1 AS h FROM conversations)")
def post_totals(spark, d):
    """AGG-10: kinds of posts, which add up; user turns are rendered, other roles are another type."""
    h, role = (F.col("conv_id") % 5 == 2) & (F.col("turn") > 1), F.col("role")
    n = {"n_rendered": (role == "user") & ~h, "n_system": (role == "system") & ~h, "n_hidden": h, "n_other": ~role.isin("user", "system") & ~h}
    return table(spark, d, "conversations").agg(F.count(F.lit(1)).alias("n_in"), *[F.count_if(c).alias(k) for k, c in n.items()])


@query("reported_counts", "SELECT source, count(*)::BIGINT AS n, count_if(n_chars = length(text))::BIGINT AS n_agree FROM documents GROUP BY source")
def reported_counts(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_chars") == F.length("text")).alias("n_agree"))


@query("max_over_views", "SELECT sum(m)::BIGINT AS n FROM (SELECT page_id, greatest(length(html) - length(replace(html, '@', '')), length(url) - length(replace(url, '@', ''))) AS m FROM pages)")
def max_over_views(spark, d):
    v = table(spark, d, "pages").select("page_id", F.explode(F.array("html", "url")).alias("view"))
    n = F.regexp_count("view", F.lit("@"))
    return v.groupBy("page_id").agg(F.max(n).alias("m")).agg(F.sum("m").alias("n"))


@query("multiset_except", "SELECT o_orderpriority AS p, o_orderstatus AS s, count(*)::BIGINT AS n FROM (SELECT o_orderpriority, o_orderstatus FROM orders EXCEPT ALL SELECT o_orderpriority, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0) GROUP BY 1, 2")
def multiset_except(spark, d):
    o = table(spark, d, "orders")
    rest = o.select("o_orderpriority", "o_orderstatus").exceptAll(o.where("o_orderkey % 2 = 0").select("o_orderpriority", "o_orderstatus"))
    return rest.groupBy(F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s")).agg(F.count(F.lit(1)).alias("n"))


@query("first_k_label", "SELECT source, array_to_string(list_sort(list(DISTINCT doc_id))[1:3], ', ') || CASE WHEN count(DISTINCT doc_id) > 3 THEN ' … (' || count(DISTINCT doc_id) || ' in all)' ELSE '' END AS label FROM documents GROUP BY source")
def first_k_label(spark, d):
    g = I.first_k(table(spark, d, "documents"), "source", "doc_id", 3)
    return g.select("source", F.concat(F.array_join("firsts", ", "), F.when(F.col("n") > 3, F.concat(F.lit(" … ("), "n", F.lit(" in all)"))).otherwise("")).alias("label"))


@query("ambiguous_route", "WITH t AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey + 2000)::VARCHAR ELSE 'x' END AS slug FROM customer) SELECT id, CASE WHEN slug <> 'x' THEN id ELSE id + 2000 END AS topic FROM t")
def ambiguous_route(spark, d):
    """JON-12: /t/{a}/{b} is topic b if a is its slug, else topic a."""
    t = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, (F.col("c_custkey") + 2000).cast("string")).otherwise("x").alias("slug"))
    links = t.select((F.col("id") + 2000).alias("a"), F.col("id").alias("b"))
    return links.join(t, links.b == t.id, "left").select("id", F.when(F.col("slug") == F.col("a").cast("string"), F.col("b")).otherwise(F.col("a")).alias("topic"))


@query("leftover_in_order", "SELECT conv_id, pos::INT AS pos, turn FROM (SELECT conv_id, unnest(range(1, m + 1)) AS pos, m + 1 - unnest(range(1, m + 1)) AS turn FROM (SELECT conv_id, max(turn)::BIGINT AS m FROM conversations GROUP BY conv_id)) WHERE turn % 2 = 1")
def leftover_in_order(spark, d):
    """JON-07: what a stream (turns from the last to 0) lists and a table (turns of even number) lacks, at its place."""
    c = table(spark, d, "conversations")
    stream = c.groupBy("conv_id").agg(F.max("turn").cast("long").alias("m")).select("conv_id", F.reverse(F.sequence(F.lit(0).cast("long"), "m")).alias("ids"))
    out = I.leftover(stream, c.where("turn % 2 = 0").select("conv_id", "turn"), "conv_id", "ids", "turn")
    return out.select("conv_id", (F.col("pos") + 1).alias("pos"), "turn")


@query("font_objects", "SELECT o_custkey, min(o_orderstatus) AS status FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 1")
def font_objects(spark, d):
    """AGG-16: names that stand for one object only."""
    few = table(spark, d, "orders").groupBy("o_custkey").agg(F.countDistinct("o_orderstatus").alias("n"), F.min("o_orderstatus").alias("status"))
    return few.where("n = 1").select("o_custkey", "status")


@query("set_intersection", "SELECT lang, count(*)::BIGINT AS n FROM (SELECT lang, text FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT lang, text FROM documents WHERE doc_id % 2 = 1) GROUP BY lang")
def set_intersection(spark, d):
    """SET-02."""
    t = table(spark, d, "documents")
    both = t.where("doc_id % 2 = 0").select("lang", "text").intersect(t.where("doc_id % 2 = 1").select("lang", "text"))
    return both.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("sets_equal", "SELECT lang, count(DISTINCT source) = (SELECT count(DISTINCT source) FROM documents) AS equal FROM documents GROUP BY lang")
def sets_equal(spark, d):
    """SET-04: whether a language has every source, by differences both ways."""
    t = table(spark, d, "documents")
    langs = t.select("lang").distinct()
    want = langs.crossJoin(t.select("source").distinct())  # a few languages by a few sources
    gone = I.compare_sets(want, t.select("lang", "source").distinct(), ["lang", "source"]).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return langs.join(gone, "lang", "left").select("lang", F.col("n").isNull().alias("equal"))
