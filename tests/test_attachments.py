"""PDF and word files made here, read into the audit's rows; checks that pass, fail and free what they held."""

import io
import zipfile
import zlib

from pyspark.sql import functions as F

from vellumry.operators import attachments, audit
from vellumry.sources import pdf


def made_pdf(*streams, flate=True):
    out = b"%PDF-1.4\n"
    for k, s in enumerate(streams, 1):
        data = zlib.compress(s) if flate else s
        out += b"%d 0 obj\n<< %s /Length %d >>\nstream\n" % (k, b"/Filter /FlateDecode" if flate else b"", len(data)) + data + b"\nendstream\nendobj\n"
    return out


def made_docx(text, name="word/document.xml"):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name, f"<w:document><w:p><w:t>{text}</w:t></w:p><w:p>second</w:p></w:document>")
    return b.getvalue()


def test_scan_of_real_files(spark, monkeypatch):
    good = made_pdf(b"BT (write to a) Tj (nn@office.org) ' ET", b"BT [(or b) -20 (ob@office.org)] TJ ET")
    rows = [
        ("a.pdf", good), ("b.pdf", made_pdf(b"BT (no address) Tj ET", flate=False)), ("cut.pdf", good[:-60]), ("broken.pdf", good.replace(b"x\x9c", b"yy")), ("a.docx", made_docx("me@office.org, logo@2x.png")),
        ("a.zip", made_docx("me@office.org", "other.xml")), ("bad.docx", b"PK\x03\x04 not a zip"), ("a.txt", b"me@office.org"), ("none", None), ("empty", b""), ("a.pdf", good),
    ]
    df = spark.createDataFrame(rows, "file string, content binary")
    got = sorted(tuple(r) for r in attachments.scan(df).collect())
    assert [r for r in got if r[0] != "cut.pdf"] == [("a.docx", "word", 1, True), ("a.pdf", "pdf", 2, True), ("a.pdf", "pdf", 2, True), ("b.pdf", "pdf", 0, True), ("broken.pdf", "pdf", 0, False)]
    assert [r[3] for r in got if r[0] == "cut.pdf"] == [False]
    assert [(r.n, r.files) for r in attachments.by_count(attachments.scan(df).where("file <> 'cut.pdf'")).collect()] == [(2, ["a.pdf"]), (1, ["a.docx"])]
    assert attachments.scan(df.limit(0)).count() == 0


def test_pdf_limits_are_told(monkeypatch):
    many = made_pdf(*[b"BT (x) Tj ET"] * 5)
    assert pdf.read(many) == ("x\nx\nx\nx\nx", True)
    monkeypatch.setattr(pdf, "MOST_STREAMS", 3)
    assert pdf.read(many) == ("x\nx\nx", False)
    monkeypatch.setattr(pdf, "MOST_STREAMS", 9)
    monkeypatch.setattr(pdf, "MOST_INFLATED", 6)
    assert pdf.read(many)[1] is False and pdf.read(made_pdf(b"BT (x) Tj ET", flate=False))[1] is False
    assert pdf.read(b"no pdf") == (None, False) and pdf.text_of(None) is None


def test_audit_frees_what_it_held(spark):
    from test_operators import clean_site

    site = clean_site(spark)
    files = spark.createDataFrame([("x.pdf", made_pdf(b"BT (a@b.org) Tj ET")), ("y.docx", made_docx("none")), ("z.pdf", made_pdf(b"(")[:-22])], "file string, content binary")
    site.attachments = attachments.scan(files)
    site.held = [site.pages.persist()]
    got = {r.id: r for r in audit.audit(site).collect()}
    assert len(got) == 17 and {r.status for r in got.values()} == {"PASS", "INFO"}
    assert got["6d"].facts == "incomplete=1, pdf=2, unreadable=0, with_addresses=1, word=1"
    assert not site.pages.is_cached and not site.attributes.is_cached


def test_every_row_of_the_audit_can_fail(spark):
    from test_operators import clean_site

    df = spark.createDataFrame

    def faulty(change):
        site = clean_site(spark)
        change(site)
        return site

    page = "t/x/7/index.html"

    def with_html(find, put):
        def change(s):
            s.pages = s.pages.withColumn("html", F.when(F.col("file") == page, F.replace("html", F.lit(find), F.lit(put))).otherwise(F.col("html")))

        return change

    faults = {
        "1": lambda s: setattr(s, "files", s.files.where(f"file <> '{page}'")), "2": lambda s: setattr(s, "posts", s.posts.unionByName(df([(7, 2, 1, False, "more")], s.posts.schema))), "2b": with_html("Hello you", "Hello"),
        "3": with_html("<p>", '<p title="own.org">'), "4": with_html("#post-1", "/nowhere/"), "5": lambda s: setattr(s, "files", s.files.where("file <> 'uploads/a.png'")), "6a": with_html("Hello", "Hello a@b.org"),
        "6c": with_html("Hello", "Hello abcdef123456xyz"), "7": lambda s: setattr(s, "spot", [8]), "9": with_html("<p>", "<p onclick=x>"), "10": lambda s: setattr(s, "page_count", 4), "11": lambda s: setattr(s, "texts", s.texts.where("file <> '_redirects'")),
    }
    for id_, change in faults.items():
        site = faulty(change)
        (check,) = [c for c in audit.checks(site) if c.id == id_]
        from vellumry.operators.checks import result

        row = result(check).first()
        assert row.status == "FAIL" and row.n_failures > 0, id_
        site.release()
