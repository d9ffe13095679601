"""As-of and range lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumry.session import shared_folder


def _merged(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    # the carried value is wrapped, so that a marker whose value is null is one too
    own = F.struct(F.col(value).alias("v"))
    a = left.withColumn("_v", F.lit(None).cast(right.select(own.alias("x")).schema["x"].dataType)).withColumn("_side", F.lit(1))
    known = right.where(reduce(and_, [F.col(k).isNotNull() for k in (*keys, at)]))
    return a.unionByName(known.select(*keys, at, own.alias("_v")).withColumn("_side", F.lit(0)), allowMissingColumns=True)


def _carried(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str, name: str, order: list) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    m = _merged(left, right, keys, at, value).withColumn(name, F.when(F.col(at).isNotNull(), F.last("_v", ignorenulls=True).over(w)["v"]))
    return m.where("_side = 1").select(*left.columns, name)


def last_before(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str, name: str) -> DataFrame:
    """left with the value of the last right row of the same keys at or before it (largest value of equal times).

    One shuffle by keys and one sort: both sides are merged and the last value
    is carried along, so no pair of rows is ever formed; a key of very many rows streams
    through one task's sort, which spills. Null keys and times match nothing; a marker with a null value is
    a marker (it comes first of equal times). Repeated left rows stay; empty tables give nulls or no rows.
    """
    return _carried(left, right, keys, at, value, name, [F.col(at).asc(), "_side", "_v"])


def first_after(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str, name: str) -> DataFrame:
    """left with the value of the first right row of the same keys at or after it (smallest value of equal times; nulls as in last_before)."""
    return _carried(left, right, keys, at, value, name, [F.desc(at), "_side", F.desc("_v")])


def _carried_across(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str, name: str, partitions: int, down: bool) -> DataFrame:
    spark = left.sparkSession
    folder = shared_folder(spark, "asof")
    m = _merged(left, right, keys, at, value).withColumn("_n", F.monotonically_increasing_id())
    m.write.parquet(f"{folder}/merged")
    way = F.desc if down else F.asc
    order = [*map(F.asc, keys), way(at), F.asc("_side"), way("_v"), F.asc("_n")]
    dealt = spark.read.schema(m.schema).parquet(f"{folder}/merged").repartitionByRange(partitions, *order).withColumn("_p", F.spark_partition_id())
    dealt.write.parquet(f"{folder}/dealt")
    rows = spark.read.schema(dealt.schema).parquet(f"{folder}/dealt")
    key = F.struct(*keys)
    latest = F.min if down else F.max
    marker = latest(F.when(F.col("_side") == 0, F.struct(F.col(at).alias("t"), F.col("_v").alias("v"))))
    of_key = rows.groupBy("_p", *keys).agg(marker.alias("m")).select("_p", key.alias("k"), "m")
    ends = of_key.groupBy("_p").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.max_by("m", "k").alias("m"))
    # one row for each partition from here on: what the partitions before left of the key that each begins with
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    left_by = F.last(F.when(F.col("m").isNotNull(), F.struct(F.col("last").alias("k"), F.col("m.v").alias("v"))), ignorenulls=True).over(before)
    carry = ends.withColumn("c", left_by).where("c.k = first").select("_p", F.col("first").alias("_k"), F.col("c.v").alias("_c"))
    own = F.last("_v", ignorenulls=True).over(Window.partitionBy("_p", *keys).orderBy(way(at), "_side", way("_v")).rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("_own", own).withColumn("_key", key)
    found = found.join(F.broadcast(carry.withColumnRenamed("_p", "_q")), (F.col("_p") == F.col("_q")) & (F.col("_key") == F.col("_k")), "left")
    return found.where("_side = 1").select(*left.columns, F.when(F.col(at).isNotNull(), F.coalesce("_own", "_c")["v"]).alias(name))


def last_before_spread(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str, name: str, partitions: int) -> DataFrame:
    """last_before for keys of very many rows: a key's rows are spread over the partitions they need.

    Both sides are merged and written, dealt to partitions by ranges of key and time, and written again with their partition. Each
    partition carries its own last markers; what a key's earlier partitions left is found from one row a partition (its first and last key,
    the last key's last marker) and handed in. Two writes more than last_before, and no task holds more than its range.
    Results, nulls, ties and empty tables are as in last_before. Columns named _v, _side, _n, _p, _q, _k, _key, _own and _c are the operator's.
    """
    return _carried_across(left, right, keys, at, value, name, partitions, False)


def first_after_spread(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str, name: str, partitions: int) -> DataFrame:
    """first_after for keys of very many rows, as last_before_spread."""
    return _carried_across(left, right, keys, at, value, name, partitions, True)


def overlap_join(left: DataFrame, right: DataFrame, lo: str, hi: str, right_lo: str, right_hi: str, width: float, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs of intervals that share a point, ends included: left.[lo, hi] and right.[right_lo, right_hi] of equal keys (names that both sides have).

    An interval lies on the finest level on which it fills few bins (see range_lookup) and is shown on every coarser level in use as well. Two intervals meet
    on the coarser of their own levels, where at least one of them is at home, and of the bins that they share there the one that holds the later
    start owns the pair; so each pair is made once, and a wide interval among narrow ones costs it a few bins instead of thousands.
    Null ends and intervals that end before they begin share nothing, nor do null keys. Repeated rows pair each for itself. Numbers only
    (epoch seconds for times). Column names but keys must differ; _level, _bin and _home are the operator's.
    """

    def level(a: str, b: str) -> Column:
        wide = (F.col(b) - F.col(a)) / width / BINS_A_RANGE
        return F.greatest(F.lit(0), F.ceil(F.log(float(BINS_A_RANGE), F.greatest(wide, F.lit(1.0))))).cast("int")

    sides = []
    for df, a, b in ((left, lo, hi), (right, right_lo, right_hi)):
        sides.append((df.where(F.col(a) <= F.col(b)).withColumn("_own", level(a, b)), a, b))
    # at most a level for each power of BINS_A_RANGE that a double spans
    levels = sorted({r._own for df, *_ in sides for r in df.select("_own").distinct().collect()})
    span = F.pow(F.lit(float(BINS_A_RANGE)), F.col("_level")) * width
    shown = []
    for df, a, b in sides:
        on = F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda x: x >= F.col("_own"))
        df = df.withColumn("_level", F.explode(on)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col(a) / span), F.floor(F.col(b) / span))))
        shown.append(df.withColumn("_home", F.col("_own") == F.col("_level")).drop("_own"))
    x, y = shown[0], shown[1].withColumnRenamed("_home", "_home2")
    both = x.join(y, [*keys, "_level", "_bin"]).where("_home OR _home2")
    both = both.where((F.col(lo) <= F.col(right_hi)) & (F.col(right_lo) <= F.col(hi)) & (F.col("_bin") == F.floor(F.greatest(lo, right_lo) / span)))
    return both.drop("_level", "_bin", "_home", "_home2")


#: Bins that one range may fill; wider ones fill bins of a coarser level, each level this many times as wide as the one before.
BINS_A_RANGE = 16


def range_lookup(points: DataFrame, ranges: DataFrame, at: str, lo: str, hi: str, width: float) -> DataFrame:
    """points joined with the ranges lo <= at <= hi, as an equi-join on bins and a residual test.

    A range goes to the finest level on which it touches at most BINS_A_RANGE + 1 bins (width, 16 widths, 256 widths ...), a
    point to its bin on each level that a range uses, so a range of any size has few rows and work follows the matches.
    Null bounds and points match nothing, nor do ranges with lo > hi. The levels in use are counted (at most 256).
    """
    level = F.greatest(F.lit(0), F.ceil(F.log(float(BINS_A_RANGE), F.greatest((F.col(hi) - F.col(lo)) / width / BINS_A_RANGE, F.lit(1.0)))))
    r = ranges.where(F.col(lo) <= F.col(hi)).withColumn("_level", level.cast("int"))
    levels = [x._level for x in r.select("_level").distinct().collect()]
    span = F.pow(F.lit(float(BINS_A_RANGE)), F.col("_level")) * width
    r = r.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(lo) / span), F.floor(F.col(hi) / span))))
    p = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("_bin", F.floor(F.col(at) / span))
    return p.join(r, ["_level", "_bin"]).where((F.col(at) >= F.col(lo)) & (F.col(at) <= F.col(hi))).drop("_bin", "_level")
