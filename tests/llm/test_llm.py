"""Operators of vellumry.llm against brute force, and their edge cases."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumry.llm import bpe, bytecnn, capfilter, components, histpack, htmlcut, langid, minhash, packing, queries, rpforest, suffix, urlfilter

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, ties, repeats, a very long text, and columns whose names clash with the operators' own."""
    r = random.Random(1)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 9))) for _ in range(400)]
    base = " ".join(r.choices(words, k=120))
    near = base.replace(base.split()[60], "changed", 1)
    texts = [None, "", " \t\n", "one", "One two", base, base, near, base + " tail here", "x " * 300, " ".join(r.choices(words, k=60_000)), "日本語 テキスト 🎉", "Ünïcode ÉTÉ", base[:130]]
    rows = [(k, t, "en", k, k, "c") for k, t in enumerate(texts)]
    rows.append(rows[5])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_bytes long, bin long, component_id string")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def classes(edges, nodes):
    up = {k: k for k in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    return {k: find(k) for k in nodes}


def test_minhash_brute(spark, odd, empty):
    got = {r.doc_id: r for r in minhash.near_duplicates(spark, odd).collect()}
    s = {r.doc_id: sets(r.text) for r in odd.collect()}
    edges = [(a, b) for a, b in itertools.combinations(s, 2) if s[a] and s[b] and 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b])]
    assert {k: r.component_id for k, r in got.items()} == classes(edges, s)
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(v) for k, v in s.items()}
    assert minhash.near_duplicates(spark, odd).count() == odd.count()
    assert minhash.near_duplicates(spark, empty).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f g"), (2, "a b c d e f g"), (3, "a b c d e f g")], "doc_id long, text string")
    assert sorted(map(str, (tuple(r) for r in minhash.near_duplicates(spark, nulls).collect()))) == ["(2, 3, 2, True)", "(3, 3, 2, False)", "(None, 3, None, True)"]


def test_minhash_group_of_near_copies(spark):
    r = random.Random(3)
    base = [f"w{r.randrange(10**6)}" for _ in range(150)]
    docs = []
    for k in range(60):
        w = list(base)
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(150)] = f"z{r.randrange(10**6)}"
        docs.append((k, " ".join(w)))
    s = {k: sets(t) for k, t in docs}
    edges = [(a, b) for a, b in itertools.combinations(s, 2) if 100 * len(s[a] & s[b]) >= 85 * len(s[a] | s[b])]
    got = minhash.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in got} == classes(edges, s)


def test_sketch_estimates_jaccard():
    r = np.random.default_rng(0)
    pool = r.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[1000:3000]
    est = np.mean([(minhash.sketch(a ^ np.uint64(k)) == minhash.sketch(b ^ np.uint64(k))).mean() for k in range(20)])
    assert abs(est - 1 / 3) < 0.05
    assert (minhash.sketch(pool[:1]) != np.uint64(2**64 - 1)).all()


def brute_repeats(rows, n=100):
    seen, out = set(), {}
    for k, t in sorted(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            w = b[p : p + n]
            if w in seen:
                gone[p : p + n] = True
            seen.add(w)
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        out[k] = (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_suffix_brute(spark, odd, empty):
    want = brute_repeats({(r.doc_id, r.text) for r in odd.collect()})
    got = suffix.remove_repeats(spark, odd.select("doc_id", "text"), mode="digest").collect()
    assert {r.doc_id: tuple(r[1:]) for r in got} == want and len(got) == odd.count()
    cut = suffix.remove_repeats(spark, odd, mode="text")
    assert cut.where("doc_id = 6").first().text == "" and cut.where("doc_id = 5").first().text == odd.where("doc_id = 5").first().text
    assert "component_id" in cut.columns and suffix.remove_repeats(spark, empty).count() == 0


def test_suffix_random_repeats(spark):
    r = random.Random(5)
    part = ["".join(r.choices("ab", k=r.randint(40, 160))) for _ in range(25)]
    rows = [(k, "".join(r.choices(part, k=r.randint(1, 8)))) for k in range(80)]
    got = suffix.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), mode="digest").collect()
    assert {x.doc_id: tuple(x[1:]) for x in got} == brute_repeats(rows)


def test_suffix_doubling_levels():
    assert suffix.doubling(100) == [(32, [0, 32, 36, 68]), (64, [0, 36])]
    assert suffix.doubling(128) == [(32, [0, 32, 64, 96]), (64, [0, 64]), (128, [0])]
    assert suffix.doubling(64) == [(32, [0, 32]), (64, [0])]


@pytest.mark.parametrize("length", [64, 150])
def test_suffix_lengths_clashing_names_and_null_ids(spark, length):
    r = random.Random(7)
    part = ["".join(r.choices("ab", k=r.randint(30, 200))) for _ in range(12)]
    rows = [(k, "".join(r.choices(part, k=r.randint(1, 6)))) for k in range(40)]
    nulls = [(None, rows[0][1]), (None, rows[0][1])]
    df = spark.createDataFrame([(k, t, 1, 2, 3, "x") for k, t in rows + nulls], "doc_id long, text string, _spans int, key int, c0 int, spans string")
    got = suffix.remove_repeats(spark, df, length=length, mode="digest").collect()
    assert {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got if x.doc_id is not None} == brute_repeats(rows, length)
    assert all((x._spans, x.key, x.c0, x.spans) == (1, 2, 3, "x") for x in got) and [x.n_removed for x in got if x.doc_id is None] == [0, 0]


def test_components(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (5, 5), (None, 3)]
    got = {r.id: r.component_id for r in components.connected_components(spark, spark.createDataFrame(e, "a long, b long")).collect()}
    assert got[40] == 0 and got[100] == 0 and got[201] == 200
    assert components.connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_bpe_equals_library(spark, odd, empty):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.tokenizer_path())
    e = bpe.Encoder(bpe.tokenizer_path())
    r = random.Random(2)
    texts = [x.text or "" for x in odd.collect()] + ["it's don't'll <|endoftext|>a</w>b <|x|>", "a\x1cb\x85c　d", "x" * 5000, "é ΑΣ İ"]
    texts += ["".join(r.choices("abeinrst'sd 01.!É", k=80)) for _ in range(300)]
    for t in texts:
        want = lib.encode(t, add_special_tokens=False).ids
        ids = e.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert e.decode(ids).decode() == lib.decode(want, skip_special_tokens=False)
    got = {x.doc_id: x for x in bpe.digests(odd).collect()}
    assert got[0].n_tokens == 0 and got[0].ids_sha256 == hashlib.sha256(b"").hexdigest() and bpe.digests(empty).count() == 0
    back = bpe.decode(bpe.encode(odd)).where("doc_id = 4").first().text
    assert back == lib.decode(lib.encode("One two", add_special_tokens=False).ids, skip_special_tokens=False)


def test_bpe_whole_latin_texts():
    """Texts of Latin-1 characters are cut at once, by no run of theirs, and as the library cuts them; others by runs."""
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.tokenizer_path())
    r = random.Random(5)
    latin = [chr(k) for k in range(256) if not 0x1C <= k <= 0x1F]
    texts = ["".join(r.choices(latin, k=60)) for _ in range(400)] + [a + b + c for a in latin[:70] for b in "'1é²\xa0\x85" for c in "sÉ!ª "]
    texts += ["It's ÀÉß, we'll've  don't''s 12½x¼ <|x|> |> µm\xadº\n", "x" * 3000, " ", "\x85"]
    odd = ["a\x1cb", "Σας œuvre", "e\u0301 É", "one<|endoftext|>two", "ÿŸ İ"]
    whole, by_runs = bpe.Encoder(bpe.tokenizer_path()), bpe.Encoder(bpe.tokenizer_path())
    by_runs._latin_words = None
    for t in texts:
        want = np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert whole.encode(t) == want == by_runs.encode(t), repr(t)
    assert not whole._runs and by_runs._runs
    for t in odd:
        assert np.frombuffer(whole.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
    assert whole._runs


def test_packing(spark, odd, empty):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.tokenizer_path())
    rows = packing.pack(spark, odd).collect()
    for k, text in {(r.doc_id, r.text) for r in odd.collect()} - {(5, None)}:
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == k)
        own = own[:: 2 if k == 5 else 1]
        assert [s for s, *_ in own] == list(np.cumsum([0, *[n for _, n, _, _ in own]])[:-1]) and sum(n for _, n, _, _ in own) == len(ids)
        assert all(c == zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) and d == len(ids) for s, n, c, d in own)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack(spark, empty).count() == 0


def test_shortest_pack_first():
    r = random.Random(4)
    for _ in range(20):
        counts = {n: r.randrange(1, 30) for n in r.sample(range(1, 65), 12)}
        packs = histpack.shortest_pack_first(counts, 64)
        assert all(sum(p) <= 64 for p, _ in packs)
        placed = {}
        for p, n in packs:
            for x in p:
                placed[x] = placed.get(x, 0) + n
        assert placed == counts
        # the same packs as piece by piece: longest first, each into the emptiest pack that has room
        room = []
        for n in sorted((n for n, m in counts.items() for _ in range(m)), reverse=True):
            k = max(range(len(room)), key=room.__getitem__, default=None)
            if k is None or room[k] < n:
                room.append(64)
                k = len(room) - 1
            room[k] -= n
        assert sorted(64 - sum(p) for p, n in packs for _ in range(n)) == sorted(room)


def test_packing_wastes_little(spark):
    """The number of sequences against the least that could hold all ids, and a null id."""
    rows = packing.pack(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    least = -(-sum(r.length for r in rows) // 2048)
    assert len({r.sequence_id for r in rows}) <= 1.01 * least + 1
    nulls = spark.createDataFrame([(None, "one two"), (None, None)], "doc_id long, text string")
    assert sorted(r.doc_tokens for r in packing.pack(spark, nulls).collect())[0] == 1


def test_bpe_unknown_ids():
    e = bpe.Encoder(bpe.tokenizer_path())
    ids = np.frombuffer(e.encode("one two"), "<u4")
    assert e.decode(np.append(ids, 10**6).astype("<u4").tobytes()) == e.decode(ids.tobytes()) and e.decode(np.array([10**6], "<u4").tobytes()) == b""


def test_quality(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = bytecnn.train(docs, labels.where(fold != 0))
    held = bytecnn.score(docs, model).join(labels, "doc_id").where(fold == 0).collect()
    assert np.mean([(r.score >= 0.3) == r.quality for r in held]) > 0.93
    s = bytecnn.score(odd, model).collect()
    assert len(s) == odd.count() and all(0 <= r.score <= 1 for r in s)
    assert {r.score for r in s if r.doc_id == 0} == {r.score for r in s if r.doc_id == 1}
    assert bytecnn.score(empty, model).count() == 0 and bytecnn.keep(odd, model, 0.0).count() == odd.count()
    assert bytecnn.score(odd, bytecnn.train(odd, labels.limit(0))).first().score == 0.5


def test_network_gradients():
    """The written gradients against differences."""
    r = np.random.default_rng(0)
    m = bytecnn.ByteCNN()
    texts = [bytes(r.integers(97, 105, n).astype(np.uint8)) for n in (5, 90, 200)]
    off = np.cumsum([0, *map(len, texts)])
    x = bytecnn.padded(np.frombuffer(b"".join(texts), np.uint8), off)
    y, w = np.array([0, 1, 0], np.float32), np.ones(3)
    loss = lambda: float(-(y * np.log(p := m.forward(*x)["p"].astype(float)) + (1 - y) * np.log(1 - p)).sum())
    g = m.gradients(*x, y, w)
    for p, q in zip((m.w, m.b, m.u, m.c, m.v, m.d), g):
        at = np.unravel_index(np.abs(q).argmax(), q.shape)
        keep, h = p[at], 2e-3  # small: rectifiers and maxima have kinks
        p[at] = keep + h
        a = loss()
        p[at] = keep - h
        b = loss()
        p[at] = keep
        assert abs((a - b) / (2 * h) - q[at]) < 0.05 * max(1, abs(q[at]))


def test_network_forward_by_hand():
    """Scores against a plain byte-by-byte pass: every byte is covered, chunks overlap, the largest response of each unit counts."""
    r = np.random.default_rng(2)
    m = bytecnn.ByteCNN()
    m.b, m.c, m.d = (r.normal(size=p.shape).astype(np.float32) * 0.1 for p in (m.b, m.c, m.d))
    texts = [b"", b"x", bytes(r.integers(0, 256, 64).astype(np.uint8)), bytes(r.integers(32, 127, 65).astype(np.uint8)), bytes(r.integers(32, 127, 300).astype(np.uint8)), b"ab " * 100_000]
    got = m.scores(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    for t, p in zip(texts[:5], got):
        raw = (t or b"\0") + bytes(bytecnn.WIDTH - 1)
        n = max(1, len(t))
        z = np.array([np.maximum(m.b + sum(m.w[k, raw[i + k]] for k in range(bytecnn.WIDTH)), 0) for i in range(n)], np.float64)
        cells = range(0, n, bytecnn.CELL)
        h = [np.maximum(z[c : c + 2 * bytecnn.CELL].mean(axis=0) @ m.u + m.c, 0) for c in cells]
        assert abs(1 / (1 + np.exp(-(np.max(h, axis=0) @ m.v + m.d[0]))) - p) < 1e-4
    assert 0 <= got[5] <= 1


def test_training_takes_whole_long_texts(spark, monkeypatch):
    """Labelled texts of any size are trained on while they fit the bound of bytes."""
    docs = spark.createDataFrame([(k, ("good words here " if k % 2 else "zz qq zz qq ") * (60_000 if k < 2 else 5)) for k in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(bytecnn.ByteCNN, "fit", lambda self, texts, y: seen.extend(map(len, texts)) or self)
    bytecnn.train(docs, labels)
    assert len(seen) == 40 and max(seen) > 600_000


def test_language(spark, odd, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    model = langid.train(docs.where(fold != 1))
    held = langid.predict(docs.where(fold == 1), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    got = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert got[0].lang_pred == got[1].lang_pred == "und" and got[0].score == 0 and not got[0].accepted
    assert got[11].lang_pred != "und" and langid.predict(empty, model).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.train(empty)).collect()} == {"und"}
    r = random.Random(3)
    noise = [" ".join("".join(r.choices(abc, k=r.randint(2, 9))) for _ in range(80)) for abc in ("abcdefghijklmnopqrstuvwxyz", "bcdfgklmnprstvzqx") for _ in range(10)]
    noise += ["То је један текст на језику који говори о рекама и шумама", "日本語のテキストです。これは未知の言語です。"]
    clash = spark.createDataFrame([(k, t, "x", 1.0, True) for k, t in enumerate(noise)], "doc_id long, text string, lang string, score double, accepted boolean")
    assert langid.keep(clash, model).count() <= 2 and langid.predict(clash, model).columns == ["doc_id", "lang_pred", "score", "accepted"]
    assert langid.keep(docs, model).count() >= 0.995 * docs.where("text rlike '[A-Za-z]'").count()


def test_min_cut_is_least():
    r = random.Random(2)

    def cost(g, e, lab):
        return sum(max(0, -x) if y else max(0, x) for x, y in zip(g, lab)) + sum(w for a, b, w in e if lab[a] != lab[b])

    for _ in range(150):
        n = r.randrange(1, 9)
        g = [r.uniform(-2, 2) for _ in range(n)]
        e = [(i, j, r.uniform(0, 1.5)) for i in range(n) for j in range(i + 1, n) if r.random() < 0.5]
        least = min(cost(g, e, lab) for lab in itertools.product([False, True], repeat=n))
        assert abs(cost(g, e, htmlcut.min_cut(g, e)) - least) < 1e-6


def test_html(spark):
    page = (
        "<html><head><title>T</title><style>x</style></head><body><nav><ul><li><a href=/>Menu</a></ul></nav><header><h2>Site</h2></header><article><h1>Big &amp; title</h1>"
        "<p>First  para <b>bold</b>\n text.<p>Second &#233; &nbsp; end.<div class='advert'>Buy</div><form><p>Sign up</p></form><script>var a='</p>';</script></article>"
        "<div id='comments'><p>I like this article with all of its words and more.</p></div><footer>c</footer>"
    )
    assert htmlcut.extract(page) == "Big & title\nFirst para bold text.\nSecond é end."
    rows = [(1, "u", page, "x"), (2, "u", None, "x"), (3, None, "", "x"), (4, "u", "<p>" * 3000 + "deep", "x"), (5, "u", "<div", "x"), (1, "u", page, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmlcut.main_text(df).collect()
    assert len(got) == 6 and {r.page_id: r.n_chars for r in got}[2] == 0 and htmlcut.main_text(df.limit(0)).count() == 0
    for r in queries.op3_htmlcut(spark, DIR).limit(50).collect():
        assert r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "skipped",
    [
        "<svg viewBox='0 0 1 1'/>", "<math />", "<br/>", "<svg><svg><text>x</text></svg><text>y</text></svg>", "<button>Buy</p>", "<select><option>x<option>y</p>", "<object data=x></p>", "<noscript>On</p>",
        "<svg><path d='M0'></p>", "<svg><g><text>x", "<button>Buy", "<object><b>x</b>", "<button>Buy<button>Sell</button>", "<button><p>Buy</p></button>", "<svg><foreignObject><p>x</p></foreignObject></svg>",
        "<noscript><p>x</p><script>'</noscript>'</script></noscript>", "<video src=x><p>No video</video>",
    ],
)
def test_html_left_out_elements_end(skipped):
    page = f"<body><article><h1>A title</h1><p>First words {skipped}<p>Second words of it.<p>Third words of it.</article></body>"
    assert htmlcut.extract(page) == "A title\nFirst words\nSecond words of it.\nThird words of it."
    assert htmlcut.extract(page.replace("</article></body>", "")).endswith("\nThird words of it.")


@pytest.mark.parametrize("outer", ["article", "main"])
@pytest.mark.parametrize("chrome", ["ad", "notice", "comments", "sidebar"])
@pytest.mark.parametrize("inner", ["{}", "<h3>A heading of some words</h3>{}", "<div>{}</div>"])
def test_html_long_chrome_in_body(outer, chrome, inner):
    def words(of, n=60):
        return " ".join(f"{of}{k}" for k in range(n))

    cut = f"<div class={chrome}>" + inner.format(f"<p>{words('cut')}</p>") + "</div>"
    if chrome != "sidebar":
        cut += f"<div class={chrome}><div class=text><p>{words('cut')}</p></div></div>"
    page = f"<body><{outer}><h1>A title</h1><p>{words('one')}</p>{cut}<p>{words('two')}</p></{outer}></body>"
    assert htmlcut.extract(page) == f"A title\n{words('one')}\n{words('two')}"
    wrapped = f"<body><main><h1>A title</h1><div class=has-sidebar><div class=entry-content><p>{words('one')}</p><p>{words('two')}</p></div></div></main></body>"
    assert htmlcut.extract(wrapped) == f"A title\n{words('one')}\n{words('two')}"


def test_html_edges_decide():
    """The cut repairs labels that the classifier alone gets wrong; without edges results are worse, on pages that nothing was fitted on."""
    by = htmlcut.labeller()
    alone = htmlcut.Labeller(by.weights, 0.0)
    page = "<body><div class=b7><p>The report that was asked for last year is ready, and here is what it says on rivers and roads.</p><p><a href=/s>Full report</a></p><p>Its figures were taken in spring, when the water was high, and they were taken again in autumn.</p></div></body>"
    assert "Full report" in htmlcut.extract(page, by) and "Full report" not in htmlcut.extract(page, alone)
    wrong = {}
    for name, m in (("cut", by), ("alone", alone)):
        made = [b for b in map(htmlcut.blocks, htmlcut.layouts.pages(150, seed=77)) if b]
        wrong[name] = sum(k != (b.text[0] == htmlcut.layouts.CONTENT) for f in made for b, k in zip(f, m.labels(f)))
    assert by.smooth > 0 and wrong["cut"] < 0.85 * wrong["alone"]


@pytest.mark.parametrize("wrap", ["<div class='side-by-side'>{}</div>", "<div id=legal-form>{}</div>", "<div class='row'><div class=col>{}</div></div>", "<a href=http://a.org/b/></a>{}", "<SCRIPT>var İ='x'</SCRIPT>{}", "<math><mi>x</mi></math>{}"])
def test_html_keeps_article_text(wrap):
    page = "<html><body><nav><a href=/>Menu</a></nav><article><h1>İstanbul title</h1><p>First words of it are here.</p>" + wrap.format("<p>Few words.</p>") + "<p>Last words of it are here.</p></article><footer>f</footer></body></html>"
    text = htmlcut.extract(page)
    assert "Few words." in text and text.startswith("İstanbul title\nFirst words of it are here.") and text.endswith("Last words of it are here.")
    assert "Menu" not in text and "var" not in text and ("x" in text) == ("math" in wrap)


def test_html_nesting_is_linear():
    import time

    def took(n):
        page = "<article>" + "<div><b>" * n + "words of it</i></p>" * n + "</article>"
        t = time.perf_counter()
        htmlcut.extract(page)
        return time.perf_counter() - t

    htmlcut.extract("<p>x</p>")
    assert took(8000) < 12 * took(2000) + 0.5


def test_html_known_articles():
    """The text of every page of the test data whose article is known, character by character."""
    import html
    import re

    import pyarrow.parquet as pq

    n = 0
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        a = re.search("<article>(.*?)</article>", page or "", re.S)
        if a:
            parts = re.split("</?(?:h1|p)[^>]*>", a[1].replace("<br>", " "))
            texts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in parts]
            assert htmlcut.extract(page) == "\n".join(x for x in texts if x)
            n += 1
    assert n == 250


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(600, 16))
    x[300:420] = x[7] + 0.02 * r.normal(size=(120, 16))
    x[420:440] = x[9]
    rows = [(k, [float(v) for v in a.astype(np.float32)], 0) for k, a in enumerate(x)]
    rows += [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [1.0, None] * 8, 0), (904, [], 0), (905, [float("inf")] * 16, 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, bin int")


def _matrix(vectors):
    rows = sorted((r.vec_id, r.embedding) for r in vectors.where("vec_id < 900").collect())
    return np.array([k for k, _ in rows]), np.array([v for _, v in rows], np.float64)


def _recall(got, ids, x, k=10):
    """Share of each query's k nearest by brute force that is found; ranks, ties and scores are as defined."""
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = n = 0
    for q, found in by.items():
        at = int(np.flatnonzero(ids == q)[0])
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        d[at] = np.inf
        want = ids[np.lexsort((ids, d))[:k]]
        found.sort()
        assert [m for m, _, _ in found] == list(range(1, len(want) + 1)) and [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        assert np.allclose([s for *_, s in found], d[np.searchsorted(ids, [v for _, v, _ in found])], rtol=0, atol=1e-12)
        hit += len(set(want.tolist()) & {v for _, v, _ in found})
        n += len(want)
    return hit / n


def test_nearest(spark, vectors):
    ids, x = _matrix(vectors)
    got = rpforest.nearest(spark, vectors, vectors.where("vec_id % 20 = 0")).collect()
    assert len({r.query_id for r in got}) == 30 and _recall(got, ids, x) >= 0.97
    assert rpforest.nearest(spark, vectors.limit(0), vectors.limit(0)).count() == 0
    few = rpforest.nearest(spark, vectors.where("vec_id < 3"), vectors.where("vec_id = 0")).collect()
    assert len(few) == 2
    # doubles, a repeated id (each row a query and a point of its own), nulls
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (2, [0.5, 0.5]), (3, [0.0, 1.0]), (None, [1.0, 0.0]), (4, None)]
    twice = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(r.query_id, r.rank, r.vec_id) for r in rpforest.nearest(spark, twice, twice, k=2).collect()]
    assert sorted(found) == sorted([(1, 1, 2), (1, 2, 2), (2, 1, 1), (2, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 2), (3, 2, 2)])


def test_nearest_skips_most_points(spark):
    """Most leaves aren't visited and most points aren't compared, and still recall holds on vectors without structure."""
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    got = rpforest.nearest(spark, t, t.where("vec_id % 20 = 0"), visits=2000, elect=160).collect()
    rows = sorted((r.vec_id, r.embedding) for r in t.collect())
    ids, x = np.array([k for k, _ in rows]), np.array([v for _, v in rows], np.float64)
    assert _recall(got, ids, x) >= 0.9
    points = t.select(F.col("vec_id").alias("key"), F.col("embedding").alias("v"))
    forest = rpforest.fit(points, 64, 24, 16384)
    assert forest.trees << forest.depth > 4 * 2000
    pairs = rpforest.elected_pairs(spark, points, points.where("key % 20 = 0"), forest, 10, 2000, 160).count()
    assert pairs < 0.08 * len(rows) * (len(rows) // 20)


def test_nearest_ranks_all_found(spark):
    """However few points are elected, the answer is the k nearest of all points in the visited leaves."""
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = sorted((r.vec_id, r.embedding) for r in t.collect())
    ids, x = np.array([k for k, _ in rows]), np.array([v for _, v in rows], np.float64)
    asked = t.where("vec_id % 50 = 0")
    forest = rpforest.fit(t.select(F.col("vec_id").alias("key"), F.col("embedding").alias("v")), 64, 24, 16384)
    leaf, tree = forest.leaves(x), np.arange(64)
    for elect in (20, 160):
        got = {}
        for r in rpforest.nearest(spark, t, asked, visits=1500, elect=elect).collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
        assert len(got) == 40
        for q, found in got.items():
            at = int(np.searchsorted(ids, q))
            seen = set(forest.search(x[at], 1500))
            inside = np.array([any((m, n) in seen for m, n in zip(tree, row)) for row in leaf.tolist()]) & (ids != q)
            d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
            d[~inside] = np.inf
            assert [v for _, v in sorted(found)] == ids[np.lexsort((ids, d))[:10]].tolist()


def test_nearest_bounds():
    """No distance lies outside its bounds, whatever the sizes of the components."""
    r = np.random.default_rng(3)
    for size in (1e-310, 1e-44, 1e-25, 1e-19, 1.0, 1e18, 1e30, 1e200):
        for dim in (1, 2, 64):
            x = r.normal(size=(400, dim)) * size
            y = x + r.normal(size=(400, dim)) * size * 10.0 ** r.integers(-9, 2, 400)[:, None]
            code, scale, rest = rpforest.coded(y)
            low, high = rpforest.bounds(x, code, scale, rest)
            far = np.array([math.hypot(*d) for d in x - y])
            assert (low <= far).all() and (far <= high).all()


def test_cap_filters(spark, vectors):
    ids, x = _matrix(vectors)
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = n @ n.T >= 0.95
    np.fill_diagonal(near, False)
    want = classes([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))], ids.tolist())
    got = {r.vec_id: r for r in capfilter.near_duplicates(spark, vectors).collect()}
    assert len(got) == 606
    assert all(got[k].n_links == near[k].sum() and got[k].component_id == want[k] for k in ids.tolist())
    assert all(got[k].n_links == 0 and got[k].component_id == k and got[k].kept for k in range(900, 906))
    assert capfilter.near_duplicates(spark, vectors.limit(0)).count() == 0


def test_cap_filters_mixed_lengths(spark):
    r = np.random.default_rng(4)
    x = {8: r.normal(size=(40, 8)), 16: r.normal(size=(700, 16)), 3: r.normal(size=(1, 3))}
    x[8][20:] = x[8][:20] + 0.01 * r.normal(size=(20, 8))
    x[16][600:] = x[16][:100] + 0.01 * r.normal(size=(100, 16))
    # the smallest vec_id has a length that nothing else has
    rows = list(enumerate(a.astype(np.float32).tolist() for dim in (3, 8, 16) for a in x[dim]))
    want = {}
    for dim in x:
        ids = [k for k, v in rows if len(v) == dim]
        u = np.array([v for _, v in rows if len(v) == dim])
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        want |= dict(zip(ids, ((u @ u.T >= 0.95).sum(axis=1) - 1).tolist()))
    got = capfilter.near_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {g.vec_id: g.n_links for g in got} == want and sum(want.values()) >= 240
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0, 0.0])], "vec_id long, embedding array<float>")
    assert capfilter.near_duplicates(spark, twice).count() == 4


def test_cap_filters_miss_no_more_in_large_tables():
    few, many = (capfilter.enough_codes(64, m, 16, 0.95, 1e-6) for m in (57, 542))
    assert len(few) < len(many)
    # m of 4.7 million vectors: two codes of twelve filters missed 5 of 15,000 such pairs
    assert capfilter.missed(many, *capfilter._pairs(15_000, 64, 0.95, seed=3)) == 0


def test_url_filter(spark):
    caps = spark.createDataFrame(
        [(1, "http://a.b.org/x/y?q", "2024-01-05"), (2, "https://B.org:80", "2024-01-10"), (3, "http://b.org/", "2024-01-20"), (4, None, "2024-01-05"), (5, "no url", None), (1, "http://a.b.org/x/y?q", "2024-01-05")],
        "id long, url string, d string",
    ).select("id", "url", F.to_timestamp("d").alias("fetched"), F.lit("k").alias("key"))
    ent = spark.createDataFrame(
        [("m", "host", "b.org", "add", "2024-01-10"), ("m", "host", "b.org", "remove", "2024-01-20"), ("p", "prefix", "a.b.org/x", "add", "2024-01-01"), ("z", "host", None, "add", "2024-01-01")],
        "list string, kind string, key string, action string, d string",
    ).withColumn("at", F.to_timestamp("d"))
    got = sorted((r.id, r.n_lists, r.lists) for r in urlfilter.on_lists(caps, ent).collect())
    assert got == [(1, 1, "p"), (1, 1, "p"), (2, 1, "m"), (3, 0, ""), (4, 0, ""), (5, 0, "")]
    assert urlfilter.on_lists(caps.limit(0), ent).count() == 0 and urlfilter.on_lists(caps, ent.limit(0)).where("n_lists > 0").count() == 0


def test_url_filter_hosts_and_hot_key(spark, monkeypatch):
    """Odd hosts, a very long path, and a key of many times in several groups, against a plain loop."""
    monkeypatch.setattr(urlfilter, "SPLIT", 7)
    r = random.Random(6)
    day = lambda n: f"2024-{1 + n // 28:02d}-{1 + n % 28:02d}"
    urls = ["http://hot.org/a", "http://u@hot.org./b", "http://[::1]:80/x", "http://10.0.0.1/", "http://hot.org/" + "s/" * 20_000, "http://sub.hot.org/a/b"]
    caps = [(k, r.choice(urls), day(r.randrange(300))) for k in range(200)]
    ent = [(r.choice("mn"), "host", r.choice(["hot.org", "[::1]", "10.0.0.1", "0.0.1", "none.org"]), r.choice(["add", "remove"]), day(r.randrange(300))) for _ in range(60)]
    ent += [("p", "prefix", "hot.org/s", "add", day(10)), ("p", "prefix", "sub.hot.org/a/b", "add", day(40))]
    keys = {urls[0]: ["hot.org", "org"], urls[1]: ["hot.org", "org"], urls[2]: ["[::1]"], urls[3]: ["10.0.0.1"], urls[4]: ["hot.org", "org", "hot.org/s"], urls[5]: ["sub.hot.org", "hot.org", "org", "sub.hot.org/a/b"]}
    want = []
    for k, u, t in caps:
        on = set()
        for lst in "mnp":
            for key in keys[u]:
                own = sorted((at, a) for n, _, x, a, at in ent if n == lst and x == key and at <= t)
                if own and own[-1][1] == "add":
                    on.add(lst)
        want.append((k, ",".join(sorted(on))))
    df = spark.createDataFrame(caps, "id long, url string, d string").select("id", "url", F.to_timestamp("d").alias("fetched"))
    entries = spark.createDataFrame(ent, "list string, kind string, key string, action string, d string").withColumn("at", F.to_timestamp("d"))
    assert sorted((x.id, x.lists) for x in urlfilter.on_lists(df, entries).collect()) == want


def test_url_filter_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{DIR}/pages.parquet'")
    r = con.execute(urlfilter.ORACLE)
    cols = [c[0] for c in r.description]
    df = queries.op2_urlfilter(spark, DIR).select(*cols)
    assert sorted(map(tuple, df.collect())) == sorted(r.fetchall())


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{DIR}/documents.parquet").withColumn("extra", F.lit(1))
    out = docs
    for name, stage in P.STAGES[:-1]:
        before, out = out, stage(spark, out, DIR)
        assert out.columns == docs.columns and 0 < out.count() <= before.count(), name
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    assert out.count() > 0.6 * docs.count() and out.join(labels.where("quality = 0"), "doc_id").count() <= 2
    pieces = P.run(spark, DIR)
    assert pieces.select("doc_id").distinct().count() == out.count()


def test_cap_filters_rows_of_one_id(spark):
    """Two vectors of one vec_id link; malformed vectors of the smallest id, null ids and doubles change nothing."""
    r = np.random.default_rng(8)
    x = r.normal(size=(12, 8))
    near = [(a + 0.01 * r.normal(size=8)).tolist() for a in x]
    rows = [(1, [1.0, 2.0])] + [(5 + k, v.tolist()) for k, v in enumerate(x)] + [(5 + k, v) for k, v in enumerate(near)] + [(None, x[0].tolist()), (70, None)]
    got = [tuple(g) for g in capfilter.near_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    assert sorted(g for g in got if g[0] is not None and 5 <= g[0] < 70) == sorted((5 + k, 1, 5 + k, True) for k in range(12) for _ in range(2))
    assert (1, 0, 1, True) in got and (70, 0, 70, True) in got and (None, 0, None, True) in got and len(got) == 27


def test_cap_filters_blocks(spark, monkeypatch):
    """One filter of many blocks, against all pairs."""
    monkeypatch.setattr(capfilter, "BLOCK", 40)
    r = np.random.default_rng(9)
    x = r.normal(size=(1, 12)) + 0.16 * r.normal(size=(300, 12))
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = n @ n.T >= 0.95
    np.fill_diagonal(near, False)
    want = classes([(int(a), int(b)) for a, b in zip(*np.nonzero(near))], range(300))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {g.vec_id: g for g in capfilter.near_duplicates(spark, df).collect()}
    assert 0 < near.sum() < 300 * 299 and all(got[k].n_links == near[k].sum() and got[k].component_id == want[k] for k in range(300))


def test_stages_hand_workers_small_batches(spark):
    import corpus_pipeline as P
    import pyarrow as pa
    from vellumry.llm import storage

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])

    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 800).alias("text"))
    before = spark.conf.get(storage._BATCH)
    try:
        spark.conf.unset(storage._BATCH)
        P.repeats(spark, docs.limit(0), DIR)
        n = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert len(n) > 3 and max(n) < storage.BATCH_BYTES + 100_000
        spark.conf.set(storage._BATCH, "1m")  # a smaller one of the session's stays
        storage.small_batches(spark)
        assert spark.conf.get(storage._BATCH) == "1m"
    finally:
        spark.conf.set(storage._BATCH, before)


def test_small_tables_need_no_python(spark):
    import pyarrow as pa
    from vellumry.llm import storage

    kinds = {"k": pa.int64(), "lang": pa.string()}
    t = storage.small_table(spark, [(1, "x"), (2, None)], kinds)
    assert t.dtypes == [("k", "bigint"), ("lang", "string")] and [tuple(r) for r in t.collect()] == [(1, "x"), (2, None)]
    assert storage.small_table(spark, [], kinds).count() == 0
    assert "Scan ExistingRDD" not in t._jdf.queryExecution().executedPlan().toString() or "PythonRDD" not in t._jdf.queryExecution().toRdd().toDebugString()


def test_working_memory_of_a_batch():
    import tracemalloc

    import pyarrow as pa

    r = random.Random(4)
    words = ["".join(r.choices("abcdefgh", k=6)) for _ in range(5000)]
    texts = [" ".join(r.choices(words, k=400)) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    for run in (suffix._runs(100), minhash._short_sets, bytecnn._score(bytecnn.ByteCNN()), langid._predict(langid.LanguageModel(["a", "b"]))):
        tracemalloc.start()
        try:
            for _ in run(iter([batch])):
                pass
            assert tracemalloc.get_traced_memory()[1] < 40e6
        finally:
            tracemalloc.stop()
