"""What happens beyond a size: queries against their SQL where the engine's own limits are low."""

import glob
import json
import os
import shutil

import duckdb
import pytest

from vellumry.plans import registry

DIR = "/root/testdata/sf0.001"


def same_as_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    r = con.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in r.description]
    return sorted(map(tuple, registry.queries()[name](spark, DIR).select(*cols).collect())) == sorted(r.fetchall())


@pytest.mark.parametrize("name", ["page_tree", "sitemap_file"])
def test_more_addresses_than_a_sitemap_should_hold(spark, monkeypatch, name):
    from vellumry.sources import sinks

    monkeypatch.setattr(sinks, "SITEMAP_URLS", 3)
    assert same_as_sql(spark, name)


def test_one_sitemap_ends_behind_its_last_address(spark, monkeypatch):
    from vellumry.sources import sinks

    monkeypatch.setattr(sinks, "SITEMAP_URLS", 2)
    urls = spark.createDataFrame([("c",), ("a",), ("b",), ("a",), (None,)], "u string")
    got = sorted(map(tuple, sinks.sitemap_lines(urls, "u", split=False).collect()))
    assert [r[:2] for r in got] == [(0, k) for k in range(5)] and got[-1][2] == "</urlset>" and got[3][2] == "<url><loc>c</loc></url>"
    assert sinks.sitemap_lines(urls.limit(0), "u", split=False).isEmpty()


def test_mailto_links_of_documents_without_text_or_id(spark, tmp_path):
    rows = [(1, "mail a@b.org", "en", "src0"), (2, None, "en", "src0"), (None, "x", "de", "src1"), (5, "y", "fr", "src2")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(registry.oracle_sql()["red01_mailto"]).fetchall()
    got = registry.queries()["red01_mailto"](spark, str(tmp_path)).select("doc_id", "h").collect()
    assert len(got) == 4 and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_files_redacted_in_one_pass(spark):
    """A file is one row from reading to writing: equal names, and none, don't matter, and no content is shuffled."""
    from vellumry.operators import jsonedit as J

    raw = ['{"a@b.org":"me a@b.org"}', '["x","you c@d.org \\\\u00e9<\\u2028"]', "[1", '["\\u0000 a@b.org"]', '[""]']
    files = spark.createDataFrame([("f", x.encode()) for x in raw[:2]] + [(None, x.encode()) for x in raw] + [("n", None)], "file string, content binary")
    done, report = J.redact_files(files)
    new = ['{"a@b.org":"me [email redacted]"}', '["x","you [email redacted] \\\\u00e9\\u003c\\u2028"]', *raw[2:]]
    want = [("f", x) for x in new[:2]] + [(None, x) for x in new] + [("n", None)]
    assert sorted(map(repr, [(r.file, r.content and bytes(r.content).decode()) for r in done.collect()])) == sorted(map(repr, want))
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    assert {(r.file, r.rule, r.n) for r in report.collect()} == {("f", "R2", 2), (None, "R2", 2)}


def test_a_crawl_reads_its_journal_as_often_however_many_batches(spark, tmp_path, monkeypatch):
    from vellumry.streaming import crawl

    read, whole = [], crawl.journal
    monkeypatch.setattr(crawl, "journal", lambda *a: (read.append(a), whole(*a))[1])
    wanted = spark.createDataFrame([(f"http://h{k}.org/{k}", f"p/{k}") for k in range(4)], "url string, file string")
    for name, batch in (("a", 4), ("b", 1)):
        read.clear()
        store = str(tmp_path / name)
        rows = crawl.crawl(spark, wanted, store, "r", batch=batch, transport="vellumry.sources.loopback:reply", sleep=False)
        assert rows.count() == 4 and len(read) == 2
        sums = json.loads(crawl.Store(store).get(f"runs/r/sums/{4 // batch - 1}.json"))
        assert sums == crawl._sums(whole(spark, store, "r")) and sums["fetched"] == 4


def counting(spark):
    """An identity of texts that counts the rows it is asked for."""
    from pyspark.sql import functions as F

    met = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def same(x):
        met.add(1)
        return x

    return same, met


def test_an_audit_finds_its_offenders_once(spark):
    from vellumry.operators import checks

    same, met = counting(spark)
    found = lambda: spark.range(60, numPartitions=3).selectExpr("if(id < 4, null, concat('f', id % 20)) AS x").select(same("x").alias("offender"))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    row = checks.run_checks(spark, [checks.Check("1", "x", found)]).first()
    assert (row.status, row.n_failures, row.failures) == ("FAIL", 60, ", ".join(["f0", "f1", *(f"f{k}" for k in range(10, 18))]))
    assert met.value == 60 and spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_an_audit_reads_what_is_published_once_for_personal_data(spark):
    from test_operators import clean_site

    from vellumry.operators import audit, checks

    same, met = counting(spark)
    site = clean_site(spark)
    texts = [("_redirects", "a@b.org A@b.org mailto:x"), ("robots.txt", "?pwd=1"), ("sitemap.xml", "a@own.org a@own.org"), ("archive.css", None)]
    site.texts = spark.createDataFrame(texts, "file string, text string").withColumn("text", same("text"))
    site.kept = spark.createDataFrame([("A@OWN.org", 0)], "address string, kept long")
    row = checks.run_checks(spark, [c for c in audit.checks(site) if c.id == "6a"]).first()
    want = ["_redirects: 1 x mailto link", "_redirects: 2 x e-mail address", "allowed address seen 0 times by readers, 0 by searchers, 2 elsewhere; 0 were reported", "robots.txt: 1 x passcode parameter"]
    assert row.n_failures == 4 and row.failures == ", ".join(want)
    assert row.facts == "fragment=3, page=5, text file=4" and met.value == len(texts)
    site.release()


def test_lost_words_without_a_shuffle_of_words(spark):
    from test_operators import clean_site

    from vellumry.operators import audit

    site = clean_site(spark)
    bodies = [("<p>a a B &amp; c</p>", "<p>a b</p>"), ("<p>x y</p>", "<p>y <time>z</time>x</p>"), (None, "<p>new</p>"), ("<p>q</p>", None), ("<p>s s</p>", "<p>s s</p>")]
    site.posts = spark.createDataFrame([(7, k, 1, False, b) for k, (b, _) in enumerate(bodies, 1)] + [(7, 9, 1, False, "<p>nowhere</p>")], "topic_id long, number long, type int, hidden boolean, cooked string")
    shown = "".join(f'<article class="post" id="post-{k}">' + (f'<div class="post-body">{b}</div>' if b else "") + "</article>" for k, (_, b) in enumerate(bodies, 1))
    site.pages = spark.createDataFrame([("t/x/7/index.html", shown)], "file string, html string")
    lost = audit.words(site)
    assert sorted(r.offender for r in lost.collect()) == ["7/1 lost 2 of its 4 words", "7/4 lost 1 of its 1 words"]
    plan = lost._jdf.queryExecution().sparkPlan().toString() + lost._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange" in x and "word" in x]
    site.release()


def test_audit_facts_runs_the_checks_that_it_tells_of(spark, monkeypatch):
    from vellumry.operators import checks

    run, result = [], checks.result
    monkeypatch.setattr(checks, "result", lambda c, *held: run.append(c.id) or result(c, *held))
    assert same_as_sql(spark, "audit_facts") and run == ["1", "4b", "5", "6b", "6d", "7", "8"]


def _planned(spark, tmp_path, sizes, **k):
    from vellumry.streaming import crawl

    wanted = spark.createDataFrame([(f"http://h{h}.org/{x}", f"p/{h}-{x}") for h, n in enumerate(sizes) for x in range(n)], "url string, file string")
    store = str(tmp_path / "store")
    crawl.plan(spark, wanted, store, "r", **k)
    return wanted, store, json.loads(crawl.Store(store).get("runs/r/lanes.json"))


def test_a_lane_reads_its_blocks_and_its_lease_is_written_where_it_is_taken_and_given_back(spark, tmp_path, monkeypatch):
    from vellumry.streaming import crawl

    monkeypatch.setattr(crawl, "BLOCK", 3)
    _, store, lanes = _planned(spark, tmp_path, [8], lanes=1)
    assert lanes == {"0": 8}
    reader, writes, write = crawl._Reader({"store": store, "run": "r", "transport": "vellumry.sources.loopback:reply", "sleep": "false"}), [], crawl.Lease._write
    monkeypatch.setattr(crawl.Lease, "_write", lambda self, seconds: (writes.append(seconds), write(self, seconds))[1])
    assert [r[1] for r in reader.read(crawl.Lane(0, 1, 7))] == [2, 3, 4, 5, 6, 7] and writes == [crawl.LEASE, 0.0]
    for k in (0, 1):
        shutil.rmtree(f"{store}/runs/r/frontier/lane=0/block={k}")
    assert [r[1] for r in reader.read(crawl.Lane(0, 6, 8))] == [7, 8]
    with pytest.raises(crawl.CrawlError, match="2 addresses from 4 to 8"):
        list(reader.read(crawl.Lane(0, 3, 8)))


def test_a_lost_or_half_spent_lease(tmp_path):
    from vellumry.streaming import crawl

    clock, store = [0.0], crawl.Store(str(tmp_path))
    a, b = (crawl.Lease(store, "r", 0, lambda: clock[0], lambda s: clock.__setitem__(0, clock[0] + s)) for _ in "ab")
    until = lambda: json.loads(store.get(a.name))["until"]
    a.take()
    clock[0] = crawl.LEASE / 2
    a.hold()
    assert until() == crawl.LEASE
    a.hold(crawl.LEASE / 2 + 1)  # a wait that would outlast it
    assert until() == crawl.LEASE * 1.5
    clock[0] = crawl.LEASE + 1
    a.hold()
    assert until() == crawl.LEASE * 2 + 1
    b.take()
    with pytest.raises(crawl.CrawlError):
        a.hold()


def test_large_hosts_lie_in_lanes_of_their_own(spark, tmp_path):
    _, _, lanes = _planned(spark, tmp_path, [6, 1, 2, 1, 2], lanes=2)
    assert sorted(lanes.values()) == [6, 6]


def test_a_crawl_in_several_streams_goes_on_where_it_was_left(spark, tmp_path, monkeypatch):
    from vellumry.streaming import crawl

    monkeypatch.setattr(crawl, "STREAM", 5)
    wanted, store, lanes = _planned(spark, tmp_path, [7, 3, 3, 2], lanes=4)
    assert json.loads(crawl.Store(store).get("runs/r/streams.json")) == crawl.dealt(lanes, 3) and len(lanes) == 4
    go = lambda: crawl.crawl(spark, wanted, store, "r", batch=2, transport="vellumry.sources.loopback:reply", sleep=False)
    swap, swaps = crawl.swap_in, []

    def stopped(*a):
        swaps.append(a)
        if len(swaps) > 2:
            raise OSError("stopped here")
        swap(*a)

    with monkeypatch.context() as m:
        m.setattr(crawl, "swap_in", stopped)
        with pytest.raises(Exception, match="stopped here"):
            go()
    rows = go().collect()
    assert sorted(r.file for r in rows) == sorted(r.file for r in wanted.collect()) and {(r.reused, r.status) for r in rows} <= {(False, 200), (False, 404)}
    assert all(len({r.lane for r in rows if r.batch % 3 == i}) > 0 for i in range(3)) and {r.batch for r in rows if r.lane == 0} & {r.batch for r in rows if r.lane == 1} == set()
    noted = [json.loads(crawl.Store(store).get(f"runs/r/streams/{i}/sums/{crawl._last(crawl.Store(store), f'runs/r/streams/{i}/sums')}.json")) for i in range(3)]
    assert {c: sum(n[c] for n in noted) for c in noted[0]} == crawl._sums(crawl.journal(spark, store, "r")) and sum(n["fetched"] for n in noted) == 15
    assert spark.read.json(f"{store}/runs/r/report").first().complete
