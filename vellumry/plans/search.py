"""Queries on the full-text index: the texts of `benchmark` ask, all documents answer."""

from __future__ import annotations

from vellumry.operators import fulltext as X
from vellumry.plans._kit import F, query, views
from vellumry.session import shared_folder


def _indexed(spark, d):
    docs, asked = views(spark, d, "documents", "benchmark")
    path = shared_folder(spark, "fulltext")
    X.build(docs, path)
    return path, asked.select(F.col("item_id").alias("query_id"), "text")


_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"


@query(
    "fulltext_top10",
    rf"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
         f AS (SELECT count(*)::DOUBLE AS docs, sum(len(w))::DOUBLE / count(*) AS mean FROM d),
         tf AS (SELECT word, doc_id, count(*) AS n, any_value(size) AS size FROM (SELECT doc_id, len(w) AS size, unnest(w) AS word FROM d) GROUP BY word, doc_id),
         df AS (SELECT word, ln(1.0::DOUBLE + ((SELECT docs FROM f) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM tf GROUP BY word),
         q AS (SELECT DISTINCT item_id AS query_id, unnest({_WORDS}) AS word FROM benchmark),
         s AS (SELECT query_id, doc_id,
                      sum(floor(idf * (n * 2.2::DOUBLE / (n + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * size / (SELECT mean FROM f)))) * 1000000 + 0.5::DOUBLE)::BIGINT)::BIGINT AS score
               FROM q JOIN tf USING (word) JOIN df USING (word) GROUP BY query_id, doc_id)
         SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s
         QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) <= 10""",
)
def fulltext_top10(spark, d):
    path, asked = _indexed(spark, d)
    return X.search(spark, path, asked, k=10)


@query(
    "fulltext_phrases",
    rf"""WITH d AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, {_WORDS} AS w FROM documents)),
         t AS (SELECT doc_id, a, lead(a) OVER o AS b, lead(a, 2) OVER o AS c FROM d WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
         q AS (SELECT item_id AS query_id, w[1] AS a, w[2] AS b, w[3] AS c FROM (SELECT item_id, {_WORDS} AS w FROM benchmark))
         SELECT query_id, doc_id, count(*)::BIGINT AS n FROM q JOIN t ON q.a = t.a AND (q.b IS NULL OR q.b = t.b) AND (q.c IS NULL OR q.c = t.c) GROUP BY query_id, doc_id""",
)
def fulltext_phrases(spark, d):
    """Documents with the first three words of each text side by side."""
    path, asked = _indexed(spark, d)
    return X.phrases(spark, path, asked.select("query_id", F.array_join(F.slice(X.tokens(F.col("text")), 1, 3), " ").alias("text")))
