"""Set, sequence and multiset reconciliation.

Null keys equal each other, as in SQL's set operations; repeated rows count where a function counts;
empty tables are empty sets. Ties are ordered by the columns named.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _both(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join on equal keys, nulls equal nulls."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    joined = left.join(other, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]), how)
    rest = [c for c in (*left.columns, *right.columns) if c not in keys]
    key = [F.when(F.col("_in_l"), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) if how == "full_outer" else F.col(k) for k in keys]
    return joined.select(*key, *rest)


def compare_sets(want: DataFrame, have: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, status: missing (wanted only), extra (there only) or duplicate (there more than once)."""
    keys = list(keys)
    w = want.select(keys).groupBy(keys).agg(F.lit(True).alias("_in_l"))
    h = have.select(keys).groupBy(keys).agg(F.count(F.lit(1)).alias("_have"))
    status = F.when(F.col("_have").isNull(), "missing").when(F.col("_in_l").isNull(), "extra").when(F.col("_have") > 1, "duplicate")
    return _both(w, h, keys, "full_outer").withColumn("status", status).where("status IS NOT NULL").select(*keys, "status")


def compare_bytes(left: DataFrame, right: DataFrame, key: str, size: str, digest: str) -> DataFrame:
    """Full outer comparison of two trees: missing, extra, size (differing) or content (sizes agree, digests don't)."""
    a = left.select(key, F.col(size).alias("_ls"), F.col(digest).alias("_ld"), F.lit(True).alias("_in_l"))
    b = right.select(key, F.col(size).alias("_rs"), F.col(digest).alias("_rd"), F.lit(True).alias("_in_r"))
    status = F.when(F.col("_in_r").isNull(), "missing").when(F.col("_in_l").isNull(), "extra")
    status = status.when(~F.col("_ls").eqNullSafe(F.col("_rs")), "size").when(~F.col("_ld").eqNullSafe(F.col("_rd")), "content")
    return _both(a, b, [key], "full_outer").withColumn("status", status).where("status IS NOT NULL").select(key, "status")


#: Numbers of a gap that are listed at once.
GAP_STEP = 100_000


def gap_ranges(df: DataFrame, group: str, number: str, first: int = 1) -> DataFrame:
    """group, lo, hi: the runs of numbers that are absent between first and the group's largest number; null numbers are none."""
    n = df.select(group, F.col(number).cast("long").alias("_n")).where(F.col("_n") >= first).distinct()
    before = F.coalesce(F.lag("_n").over(Window.partitionBy(group).orderBy("_n")), F.lit(first - 1))
    return n.select(group, (before + 1).alias("lo"), (F.col("_n") - 1).alias("hi")).where("lo <= hi")


def number_gaps(df: DataFrame, group: str, number: str, first: int = 1) -> DataFrame:
    """group, missing number: what is absent between first and the group's largest number. A wide gap is listed in steps, never as one array."""
    r = gap_ranges(df, group, number, first).withColumn("lo", F.explode(F.sequence("lo", "hi", F.lit(GAP_STEP).cast("long"))))
    return r.select(group, F.explode(F.sequence("lo", F.least(F.col("hi"), F.col("lo") + GAP_STEP - 1))).alias("missing"))


def leftover(stream: DataFrame, present: DataFrame, group: str, ids: str, key: str) -> DataFrame:
    """stream (group, ids array), present (group, key) -> (group, pos, key): ids of the stream that aren't present, in the stream's order, repeats kept."""
    s = stream.select(group, F.posexplode(ids).alias("pos", key))
    return s.join(present.select(group, key), [group, key], "left_anti").select(group, "pos", key)


def multiset_deficit(want: DataFrame, have: DataFrame, group: Sequence[str], item: str) -> DataFrame:
    """group, n_missing: how many wanted items the group lacks, counting repeats."""
    keys = [*group, item]
    w = want.groupBy(keys).agg(F.count(F.lit(1)).alias("_want"))
    h = have.groupBy(keys).agg(F.count(F.lit(1)).alias("_have"))
    short = F.greatest(F.col("_want") - F.coalesce("_have", F.lit(0)), F.lit(0))
    return _both(w, h, keys, "left").groupBy(list(group)).agg(F.sum(short).alias("n_missing"))


def first_occurrence(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def count_by(df: DataFrame, value: str) -> DataFrame:
    """value, n: most frequent first, ties in byte order."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), value)


def chunk_rows(df: DataFrame, group: str, order: str, size: int = 20) -> DataFrame:
    """df with column chunk: rows of a group dealt in order to chunks of size, from 1."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("chunk", F.ceil(F.row_number().over(w) / size).cast("long"))


def case_collisions(df: DataFrame, path: str) -> DataFrame:
    """Paths that differ from another path in case only."""
    twins = df.select(path).distinct().withColumn("_low", F.lower(path))
    many = twins.groupBy("_low").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twins.join(many, "_low").select(path, "n")


def first_k(df: DataFrame, group: str, value: str, most: int) -> DataFrame:
    """group, n, firsts: how many distinct values there are, and the smallest ``most`` of them as a sorted array; no more are ever gathered."""
    d = df.select(group, value).distinct()
    n = d.groupBy(group).agg(F.count(value).alias("n"))
    top = d.withColumn("_k", F.row_number().over(Window.partitionBy(group).orderBy(value))).where(F.col("_k") <= most)
    top = top.groupBy(group).agg(F.array_sort(F.collect_list(value)).alias("firsts"))
    return _both(n, top, [group], "left").select(group, "n", "firsts")
