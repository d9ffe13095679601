"""Redaction queries. Testdata holds few secrets, so inputs with secrets of varying kinds are built from columns, around whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumry.functions import redact as R
from vellumry.functions.text import scrub
from vellumry.operators import jsonedit as J
from vellumry.operators.secrets import ANYWHERE, find_many_values, find_values
from vellumry.plans._kit import query, table

_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_SAFE = rf"regexp_replace(text, '{_MAIL}', '[email redacted]', 'g')"
#: The value of a document, and its length, from 4 to 23.
_SQL_V = "substr(sha256(text), 1, (4 + doc_id % 20)::INT)"


def _value():
    return F.sha2("text", 256).substr(F.lit(1), (F.col("doc_id") % 20 + 4).cast("int"))


def _pick(*values):
    return F.element_at(F.array(*map(F.lit, values)), (F.col("doc_id") % len(values) + 1).cast("int"))


def _docs(spark, d):
    return table(spark, d, "documents").where("doc_id IS NOT NULL AND text IS NOT NULL")


_FROM = "FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL"


@query("red02_email_redaction", rf"SELECT doc_id, sha256({_SAFE}) AS text_sha256 FROM documents")
def red02(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(R.email_redacted(F.col("text")), 256).alias("text_sha256"))


@query("red01_mailto", f"""SELECT doc_id, sha256('<p>' || CASE WHEN doc_id % 3 = 2 THEN '<a TITLE=x href=mailto:[email redacted]>' || source || '</A >' ELSE '<span class="email-redacted">' || source || '</span>' END || ', <a href="/x">' || lang || '</a> ' || {_SAFE}) AS h FROM documents""")
def red01(spark, d):
    """RED-01, a row for every document, null where a part is null; a link without quotes is left to R2."""
    q = _pick('"', "'", "")
    link = F.concat(F.lit("<p><a "), _pick("", 'class="m" ', "TITLE=x "), F.lit("href="), q, F.lit("mailto:u"), "doc_id", F.lit("@"), "source", F.lit(".example.org"), q, F.lit(">"), "source", F.lit("</A >"))
    docs = table(spark, d, "documents").withColumns({"id": F.col("doc_id"), "doc_id": F.coalesce("doc_id", F.lit(0))})
    return docs.select(F.col("id").alias("doc_id"), F.sha2(R.redact(F.concat(link, F.lit(', <a href="/x">'), "lang", F.lit("</a> "), "text")), 256).alias("h"))


@query("red03_obfuscated", f"""SELECT doc_id, sha256('ask ' || CASE doc_id % 5 WHEN 3 THEN 'jo' || doc_id || ' (at) example.org' WHEN 4 THEN 'jo' || doc_id || ' (at] b {{dot) org' ELSE '[email redacted]' END || ' now; Vienna (AT) 21.May ' || {_SAFE}) AS h {_FROM}""")
def red03(spark, d):
    address = F.concat(F.lit("jo"), "doc_id", _pick(" (at) example (dot) ", "[ AT ]mail.example {dot} ", "{at}a(dot)b (DOT)", " (at) example.", " (at] b {dot) "), F.lit("org"))
    return _docs(spark, d).select("doc_id", F.sha2(R.redact(F.concat(F.lit("ask "), address, F.lit(" now; Vienna (AT) 21.May "), "text")), 256).alias("h"))


@query("red04_url_passcode", f"""SELECT doc_id, sha256('https://x.example/j' || ['?pwd=', '&PassCode=', ';password='][(doc_id % 3 + 1)::INT] || 'REDACTED' || ['&x=1 ', '#f ', '" ', ' '][(doc_id % 4 + 1)::INT] || {_SAFE}) AS h {_FROM}""")
def red04(spark, d):
    """RED-04, twice; no whole text holds its own digest's beginning, so R6 has nothing to do."""
    t = F.concat(F.lit("https://x.example/j"), _pick("?pwd=", "&PassCode=", ";password="), _value(), _pick("&x=1 ", "#f ", '" ', " "), "text")
    return _docs(spark, d).select("doc_id", F.sha2(R.redact(R.redact(t)), 256).alias("h"))


_LABELS = "['Kenncode: ', 'kennwort=', 'PASSCODE : ', 'passwort:', 'Password = ', 'zugangscode:', 'wachtwoord: ', 'Toegangscode:\t']"


@query(
    "red05_plain_passcode",
    f"""SELECT doc_id, sha256({_LABELS}[(doc_id % 8 + 1)::INT] || CASE WHEN length({_SQL_V}) <= 12 AND regexp_matches({_SQL_V}, '[0-9]') THEN 'REDACTED' ELSE {_SQL_V} END || ', xpassword: 1234 ' || {_SAFE}) AS h {_FROM}""",
)
def red05(spark, d):
    label = _pick("Kenncode: ", "kennwort=", "PASSCODE : ", "passwort:", "Password = ", "zugangscode:", "wachtwoord: ", "Toegangscode:\t")
    return _docs(spark, d).select("doc_id", F.sha2(R.redact(F.concat(label, _value(), F.lit(", xpassword: 1234 "), "text")), 256).alias("h"))


@query(
    "red06_secret_copies",
    f"""SELECT doc_id, sha256('<h2>j?pwd=REDACTED</h2><a name="h-' || CASE WHEN length({_SQL_V}) >= 12 THEN 'REDACTED-1"></a> REDACTED' ELSE {_SQL_V} || '-1"></a> ' || upper({_SQL_V}) END || ' ' || {_SAFE}) AS h {_FROM}""",
)
def red06(spark, d):
    t = F.concat(F.lit("<h2>j?pwd="), _value(), F.lit('</h2><a name="h-'), _value(), F.lit('-1"></a> '), F.upper(_value()), F.lit(" "), F.col("text"))
    return _docs(spark, d).select("doc_id", F.sha2(R.redact(t), 256).alias("h"))


@query(
    "red08_allowlist",
    f"""SELECT doc_id, sha256(CASE doc_id % 3 WHEN 0 THEN 'help@example.org' WHEN 1 THEN 'Help@EXAMPLE.org' ELSE '[email redacted]' END || ', [email redacted] ' || chr(57505) || ' and [email redacted] <span class="email-redacted">help@example.org</span> ' || {_SAFE}) AS h {_FROM}""",
)
def red08(spark, d):
    first = _pick("help@example.org", "Help@EXAMPLE.org", "xhelp@example.org")
    t = F.concat(first, F.lit(", help@example.org.uk  and u"), "doc_id", F.lit('@example.org <a href="mailto:help@example.org">help@example.org</a> '), "text")
    return _docs(spark, d).select("doc_id", F.sha2(R.redact(t, R.check_allowlist([("help@example.org", "an office")])), 256).alias("h"))


def _mixed():
    """A whole text with one secret of a kind that doc_id picks, and no secret in every sixth."""
    return F.concat(
        F.col("text"),
        _pick(" ", ' <a href="mailto:a@b.example">me</a>', " a (at) b (dot) example", " x?pwd=ab12", " Passwort: ab12", " y&password=abcdef123456; ABCDEF123456 abcdef123456"),
    )


#: rule -> how often _mixed() and the text give it; R6's two copies of a value that R4 removes.
_MIXED = {"R1": "(doc_id % 6 = 1)::INT", "R2": f"len(regexp_extract_all(text, '{_MAIL}'))", "R3": "(doc_id % 6 = 2)::INT", "R4": "(doc_id % 6 IN (3, 5))::INT", "R5": "(doc_id % 6 = 4)::INT", "R6": "2 * (doc_id % 6 = 5)::INT"}
_PER_DOC = " UNION ALL ".join(f"SELECT doc_id, '{r}' AS rule, {n} AS n {_FROM}" for r, n in _MIXED.items())


def _counts(spark, d):
    return R.rule_counts(_docs(spark, d).select("doc_id", _mixed().alias("text")), "text")


@query("red_rule_counts", f"SELECT rule, sum(n)::BIGINT AS n, sum(n + CASE WHEN rule = 'R2' AND doc_id % 6 = 1 OR rule = 'R5' AND doc_id % 6 = 5 THEN 1 ELSE 0 END)::BIGINT AS in_source FROM ({_PER_DOC}) GROUP BY rule")
def red_rule_counts(spark, d):
    """AGG-04; in_source counts what an earlier rule takes away first too: the address in a mailto link, the labelled passcode in a URL."""
    c = _counts(spark, d)
    s = c.agg(*[F.sum(f"n_{r}").cast("long").alias(f"n_{r}") for r in R.NAMES], *[F.sum(f"src_{r.id}").cast("long").alias(f"s_{r.id}") for r in R.RULES])
    rows = [F.struct(F.lit(r).alias("rule"), F.col(f"n_{r}").alias("n"), F.col(f"s_{r}" if r != "R6" else "n_R6").alias("in_source")) for r in R.NAMES]
    return s.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


@query("red_per_file_rows", f"SELECT doc_id, rule, n::BIGINT AS n FROM ({_PER_DOC}) WHERE n > 0")
def red_per_file_rows(spark, d):
    rows = _counts(spark, d).select("doc_id", *[F.col(f"n_{r}").cast("long").alias(r) for r in R.NAMES])
    return rows.unpivot(["doc_id"], R.NAMES, "rule", "n").where("n > 0")


@query("red_report_consistency", f"SELECT rule, count(DISTINCT doc_id)::BIGINT AS n_docs, sum(n)::BIGINT AS n, (SELECT sum(n) FROM ({_PER_DOC}))::BIGINT AS total FROM ({_PER_DOC}) WHERE n > 0 GROUP BY rule")
def red_report_consistency(spark, d):
    """AGG-05: totals by rule and in all from one pass of grouping sets."""
    g = red_per_file_rows(spark, d).groupingSets([["rule"], []], "rule").agg(F.countDistinct("doc_id").alias("n_docs"), F.sum("n").alias("n"), F.grouping_id().alias("g"))
    return g.where("g = 0").select("rule", "n_docs", "n").crossJoin(g.where("g = 1").select(F.col("n").alias("total")))


@query(
    "red10_residuals",
    f"""SELECT r AS rule, CASE r WHEN 'R1' THEN a WHEN 'R2' THEN b WHEN 'R3' THEN c WHEN 'R4' THEN e ELSE f END AS before, 0::BIGINT AS after FROM (VALUES ('R1'), ('R2'), ('R3'), ('R4'), ('R5')) t(r),
        (SELECT count_if(doc_id % 6 = 1) AS a, count_if(doc_id % 6 = 1 OR regexp_matches(text, '{_MAIL}')) AS b, count_if(doc_id % 6 = 2) AS c, count_if(doc_id % 6 IN (3, 5)) AS e, count_if(doc_id % 6 IN (4, 5)) AS f {_FROM})""",
)
def red10(spark, d):
    """RED-10: texts that each rule still matches, before and after redaction."""
    c = _docs(spark, d).select(_mixed().alias("t")).select("t", R.redact(F.col("t")).alias("r"))
    n = [F.count_if(x).alias(f"{k}{r.id}") for k, col in (("b", "t"), ("a", "r")) for r, x in zip(R.RULES, R.residuals(F.col(col)))]
    rows = [F.struct(F.lit(r.id).alias("rule"), F.col(f"b{r.id}").alias("before"), F.col(f"a{r.id}").alias("after")) for r in R.RULES]
    return c.agg(*n).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


@query("red12_marker_reconcile", f"SELECT doc_id, {_MIXED['R2']} + {_MIXED['R3']} AS addresses, {_MIXED['R4']} + {_MIXED['R5']} + {_MIXED['R6']} AS passcodes, true AS agrees {_FROM}")
def red12(spark, d):
    """RED-12: markers in the result, less those in the source, are the tallies."""
    c = _counts(spark, d)
    new = lambda mark: R.marks(F.col("redacted"), mark) - R.marks(F.col("text"), mark)
    a, p = F.col("n_R2") + F.col("n_R3"), F.col("n_R4") + F.col("n_R5") + F.col("n_R6")
    return c.select("doc_id", a.cast("long").alias("addresses"), p.cast("int").alias("passcodes"), ((new(R.ADDRESS_MARK) == a) & (new(R.SECRET_MARK) == p) & (new(R.LINK_MARK) == F.col("n_R1"))).alias("agrees"))


@query("scrub_log_lines", rf"SELECT doc_id, sha256(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}', '<address>', 'g') || ' ?pwd=<value>&x') AS h {_FROM}")
def scrubbed(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2(scrub(F.concat("text", F.lit(" ?pwd="), _value(), F.lit("&x"))), 256).alias("h"))


_SIX_WORDS = r"""WITH w AS (SELECT item_id, string_split(lower(text), ' ') AS w FROM benchmark WHERE text IS NOT NULL), s AS (SELECT item_id, array_to_string(w[i:i+5], ' ') AS v FROM (SELECT item_id, w, unnest(range(1, len(w) - 4)) AS i FROM w))
        SELECT s.item_id, count(DISTINCT d.doc_id)::BIGINT AS n_docs FROM s JOIN documents d ON contains(lower(d.text), s.v) GROUP BY s.item_id"""


def _six_words(spark, d, find):
    w = table(spark, d, "benchmark").where("text IS NOT NULL").select("item_id", F.split(F.lower("text"), " ").alias("w")).where("size(w) >= 6")
    runs = w.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 5), lambda i: F.array_join(F.slice("w", i, F.lit(6)), " "))).alias("value"))
    values = runs.select(F.col("item_id").cast("string").alias("id"), F.lit(ANYWHERE).alias("kind"), "value").distinct()
    hit = find(table(spark, d, "documents").where("doc_id IS NOT NULL"), "doc_id", "text", values).distinct()
    return hit.groupBy(F.col("id").cast("long").alias("item_id")).agg(F.count(F.lit(1)).alias("n_docs"))


@query("secret_value_scan", _SIX_WORDS)
def secret_value_scan(spark, d):
    """JON-21: every run of six words of every listed item against every whole text, in one pass over the texts."""
    return _six_words(spark, d, find_values)


@query("secret_values_joined", _SIX_WORDS)
def secret_values_joined(spark, d):
    """JON-21, RED-11: the same by joins on rare pieces of the values."""
    return _six_words(spark, d, find_many_values)


# ---- JSON files, one for each document: {"id": n, "tags": ["lang"], "text": "..."} in a file's own spelling


#: What a literal needs escaped, backslashes first; and what a changed literal escapes besides.
_CONTROL = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
_NEEDED = [("\\", "\\\\"), ('"', '\\"'), *[(chr(k), _CONTROL.get(k, f"\\u{k:04x}")) for k in range(1, 32)]]
_BESIDES = [(c, f"\\u{ord(c):04x}") for c in "<>&  "]


def _files(spark, d):
    esc = F.col("text")
    for a, b in _NEEDED:
        esc = F.replace(esc, F.lit(a), F.lit(b))
    esc = F.when(F.col("text").rlike(r'[\x01-\x1f"\\]'), esc).otherwise(F.col("text"))
    body = F.concat(F.lit('{ "id" : '), "doc_id", F.lit(',\t"tags":["'), "lang", F.lit('", "\\u00e9\\/"],"text":"'), esc, F.lit(' x?pwd=a<1"}\n'))
    return _docs(spark, d).select(F.col("doc_id").cast("string").alias("file"), F.encode(body, "UTF-8").alias("content"))


_PLAIN = f"{_FROM} AND lang IS NOT NULL"
_ESC = "{}"
for _a, _b in [*_NEEDED, *_BESIDES]:
    _ESC = f"replace({_ESC}, chr({ord(_a)}), '{_b}')"


@query("json_redacted_files", f"""SELECT doc_id::VARCHAR AS file, sha256('{{ "id" : ' || doc_id || ',' || chr(9) || '"tags":["' || lang || '", "\\u00e9\\/"],"text":"' || {_ESC.format(_SAFE)} || ' x?pwd=REDACTED\\u003c1"}}' || chr(10)) AS h {_PLAIN}""")
def json_redacted_files(spark, d):
    """JSN-04 to JSN-07: whole files, byte for byte; literals that don't change keep their spelling."""
    done, _ = J.redact_files(_files(spark, d))
    return done.select("file", F.sha2("content", 256).alias("h"))


@query("json_string_values", f"SELECT doc_id::VARCHAR AS file, unnest([2, 3, 5])::INT AS ord, unnest([sha256(lang), sha256('é/'), sha256(text || ' x?pwd=a<1')]) AS h {_PLAIN}")
def json_string_values(spark, d):
    """SRC-22, JSN-01: every string value in document order; keys take places too."""
    v = J.literals(_files(spark, d)).where("NOT is_key")
    return v.select("file", "ord", F.sha2("value", 256).alias("h"))


@query("json_invalid", f"SELECT doc_id::VARCHAR AS file, doc_id % 7 = 1 AS cut {_PLAIN} AND doc_id % 7 IN (1, 2)")
def json_invalid(spark, d):
    """MSC-06, JSN-05: cut files and NUL escapes are faults, whatever else the file holds."""
    k = F.col("file").cast("long") % 7
    text = F.col("content").cast("string")
    bad = F.when(k == 1, text.substr(F.lit(1), F.length(text) - 2)).when(k == 2, F.replace(text, F.lit("\\u00e9"), F.lit("\\u0000"))).otherwise(text)
    found = J.literals(_files(spark, d).select("file", F.encode(bad, "UTF-8").alias("content"))).where("error IS NOT NULL")
    return found.select("file", (~F.col("error").contains("NUL")).alias("cut"))


@query("json_report", f"SELECT rule, sum(n)::BIGINT AS n, sum(n)::BIGINT AS in_source FROM (SELECT 'R2' AS rule, {_MIXED['R2']} AS n {_PLAIN} UNION ALL SELECT 'R4', 1 {_PLAIN}) GROUP BY rule HAVING sum(n) > 0")
def json_report(spark, d):
    """SNK-12: what a redaction of files did, by rule."""
    return J.redact_files(_files(spark, d))[1].groupBy("rule").agg(F.sum("n").alias("n"), F.sum("in_source").alias("in_source"))


@query("allowlist_conservation", f"SELECT 'office@' || s || '.example' AS address, n AS before, n - lost AS after FROM (SELECT source AS s, count(*)::BIGINT AS n, count_if(doc_id % 9 = 4)::BIGINT AS lost {_FROM} AND source IN ('src0', 'src1', 'src2') GROUP BY source) WHERE lost > 0")
def allowlist_conservation(spark, d):
    """RED-13: allowed addresses that a faulty redaction lost."""
    t = _docs(spark, d).select("doc_id", F.concat(F.lit("to Office@"), "source", F.lit(".example, x")).alias("t"))
    after = t.select(F.when(F.col("doc_id") % 9 == 4, "gone").otherwise(F.col("t")).alias("t"))
    return J.conservation(t, after, "t", ("office@src0.example", "office@src1.example", "office@src2.example"))


@query("rule_drift", f"SELECT rule, sum(n)::BIGINT AS n, CASE rule WHEN 'R1' THEN sum(n) + 1 WHEN 'R6' THEN 0 ELSE 7 END::BIGINT AS expected FROM ({_PER_DOC}) WHERE rule IN ('R1', 'R6') GROUP BY rule HAVING sum(n) > 0")
def rule_drift(spark, d):
    """RED-14: totals that aren't the expected ones; a warning only."""
    r = red_per_file_rows(spark, d).where("rule IN ('R1', 'R6')")
    n = {x.rule: x.n for x in r.groupBy("rule").agg(F.sum("n").alias("n")).collect()}
    return J.drift(r, {"R1": n.get("R1", 0) + 1, "R6": 0})


@query("omit_rule", f"SELECT source, count(*)::BIGINT AS assets, count_if(doc_id % 3 = 0)::BIGINT AS missing, count_if(doc_id % 3 <> 0)::BIGINT AS ok {_FROM} AND source NOT IN ('src1', 'src2') GROUP BY source")
def omit_rule(spark, d):
    """RED-09, FLT-03: entries below omitted folders go, counts follow."""
    e = _docs(spark, d).select("source", F.concat(F.lit("/"), "source", F.lit("/"), "doc_id").alias("path"), (F.col("doc_id") % 3 == 0).alias("missing"))
    rest, _ = J.without_omitted(e, "path", ["/src1/", "/src2/"])
    return rest.groupBy("source").agg(F.count(F.lit(1)).alias("assets"), F.count_if("missing").alias("missing"), F.count_if(~F.col("missing")).alias("ok"))


@query("tag_names", f"SELECT doc_id, lang || '|' || source AS names {_FROM}")
def tag_names(spark, d):
    """JSN-08: tags are strings or objects with a name."""
    tags = F.concat(F.lit('["'), "lang", F.lit('", '), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit('{"name": "'), "source", F.lit('", "n": 1}'))).otherwise(F.concat(F.lit('"'), "source", F.lit('"'))), F.lit("]"))
    return _docs(spark, d).select("doc_id", F.array_join(J.names_of(tags), "|").alias("names"))
