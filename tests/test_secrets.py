"""Very many listed values by joins, against looking each up in each text."""

import random
import re

from vellumry.operators import secrets


def brute(texts, values):
    out = set()
    for key, text in texts:
        for id_, kind, value in values:
            if key is None or not text or id_ is None or not value:
                continue
            slug = re.sub("[^a-z0-9]+", "-", value.lower()).strip("-")
            if kind == secrets.WORD:
                hit = re.search(rf"(?<![A-Za-z0-9]){re.escape(value)}(?![A-Za-z0-9])", text) is not None
            else:
                hit = value.lower() in text.lower() or kind == secrets.SLUG and len(slug) >= 12 and slug in text.lower()
            if hit:
                out.add((str(key), id_))
    return out


def test_joined_values_equal_brute_force(spark):
    r = random.Random(1)
    kinds = [secrets.ANYWHERE, secrets.SLUG, secrets.WORD]
    values = [(str(k), r.choice(kinds), "".join(r.choices("abAB1.é\\E $", k=r.randrange(0, 16)))) for k in range(300)]
    values += [("same", secrets.ANYWHERE, values[7][2]), (None, secrets.WORD, "x"), ("null", secrets.WORD, None), ("u", secrets.ANYWHERE, "https://www.example.org/one"), ("w", secrets.ANYWHERE, "https://www.example.org/two")]
    texts = [(k, "".join(r.choice([v[2] or "", v[2].upper() if v[2] else "", "ab", " ", "é", "-", "https://www.example.org/"]) for v in r.sample(values, 12))) for k in range(120)]
    texts += [(200, None), (201, ""), (None, "https://www.example.org/one"), (202, "see HTTPS://www.example.org/TWO"), (202, "see HTTPS://www.example.org/TWO")]
    t = spark.createDataFrame(texts, "k long, t string")
    v = spark.createDataFrame(values, "id string, kind string, value string")
    got = [tuple(x) for x in secrets.find_many_values(t, "k", "t", v).collect()]
    assert set(got) == brute(texts, values) and len(got) == len(set(got))
    assert secrets.find_many_values(t, "k", "t", v.limit(0)).count() == 0 and secrets.find_many_values(t.limit(0), "k", "t", v).count() == 0


def test_a_million_values_in_one_pass(spark):
    from pyspark.sql import functions as F

    v = spark.range(1_000_000).select(F.col("id").cast("string").alias("id"), F.lit(secrets.ANYWHERE).alias("kind"), F.concat(F.lit("token-"), F.sha2(F.col("id").cast("string"), 256).substr(1, 14)).alias("value"))
    held = v.where("id % 50021 = 3").agg(F.array_join(F.collect_list(F.upper("value")), " and ").alias("t")).select(F.lit(1).alias("k"), "t")
    t = held.unionByName(spark.range(2, 200).select(F.col("id").cast("int").alias("k"), F.repeat(F.lit("token- nothing of it "), 50).alias("t")))
    got = sorted(int(x.id) for x in secrets.find_many_values(t, "k", "t", v).collect())
    assert got == list(range(3, 1_000_000, 50021))


def test_several_passes(spark, monkeypatch):
    monkeypatch.setattr(secrets, "SIGNS", 100)
    rows = [(str(k), secrets.ANYWHERE, f"value number {k}!") for k in range(1000)]
    t = spark.createDataFrame([(1, " ".join(v.upper() for _, _, v in rows[::7]))], "k long, t string")
    got = secrets.find_many_values(t, "k", "t", spark.createDataFrame(rows, "id string, kind string, value string")).collect()
    assert sorted(int(x.id) for x in got) == list(range(0, 1000, 7))
