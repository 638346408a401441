"""Exact quantiles of long series in bounded memory.

Selection by repeated histograms: a range that holds the wanted order statistic is cut into buckets, counts find the
bucket it is in, and that bucket's least and largest value are the next range.  Counts add up in each task before they
cross the network, so a series of any length costs a few numbers a task and round.  Once few values are left they are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.scratch import cut, sized

#: Buckets of a round, and how many values one task may hold of a series.
BUCKETS, MOST = 512, 10_000


def _plain(values: Column | str, share: float) -> Column:
    return F.percentile(values, F.lit(float(share)))


def quantiles(df: DataFrame, keys: tuple[str, ...], value: Column, **shares: float) -> DataFrame:
    """(keys, count, then a column for each share): exact quantiles, linear between the two nearest values.

    Nulls, NaN and infinities are left out; a series that has nothing else has no row.  Equal to Spark's percentile, which
    does the work for series of up to MOST values.
    """
    rows = df.select(*keys, value.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != float("inf")))
    stats = cut(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.min("v").alias("lo"), F.max("v").alias("hi")), "series")
    long = cut(stats.filter(F.col("count") > MOST), "long")
    if long.isEmpty():
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), *(_plain("v", s).alias(n) for n, s in shares.items()))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    short = rows.alias("a").join(sized(long.select(*keys)).alias("b"), same, "left_anti")
    few = short.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), *(_plain("v", s).alias(n) for n, s in shares.items()))
    return few.unionByName(_selected(rows, long, keys, shares))


def _selected(rows: DataFrame, long: DataFrame, keys: tuple[str, ...], shares: dict[str, float]) -> DataFrame:
    """Quantiles of the series in long (keys, count, lo, hi)."""
    place = lambda s: (F.col("count") - 1) * F.lit(float(s))
    wanted = [F.struct(F.lit(n).alias("name"), F.lit(side).alias("side"), f(place(s)).cast("long").alias("rank")) for n, s in shares.items() for side, f in (("low", F.floor), ("high", F.ceil))]
    # rank counts from 0 inside the range lo to hi, which holds left values
    todo = long.select(*keys, F.inline(F.array(*wanted)), F.col("count").alias("left"), "lo", "hi")
    done = None
    while True:
        todo = cut(todo, "ranges")
        found = todo.filter("lo = hi").select(*keys, "name", "side", F.col("lo").alias("v"))
        small = todo.filter(F.col("lo") < F.col("hi")).filter(F.col("left") <= MOST)
        listed = _inside(rows, cut(small, "small"), keys).groupBy(*keys, "name", "side", "rank").agg(F.array_sort(F.collect_list("v")).alias("vs"))
        found = found.unionByName(listed.select(*keys, "name", "side", F.get("vs", F.col("rank").cast("int")).alias("v")))
        done = found if done is None else done.unionByName(found)
        todo = cut(todo.filter((F.col("lo") < F.col("hi")) & (F.col("left") > MOST)), "wide")
        if todo.isEmpty():
            break
        todo = _narrowed(rows, todo, keys)
    sides = done.groupBy(*keys).pivot("name", list(shares)).agg(F.max(F.when(F.col("side") == "low", F.col("v"))).alias("low"), F.max(F.when(F.col("side") == "high", F.col("v"))).alias("high"))
    sides = cut(sides, "sides")
    both = long.select(*keys, "count").alias("a").join(sides.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    out = []
    for n, s in shares.items():
        low, high = F.col(f"`{n}_low`"), F.col(f"`{n}_high`")
        at = place(s)
        out.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high).alias(n))
    return both.select(*(F.col(f"a.{k}").alias(k) for k in keys), "count", *out)


def _inside(rows: DataFrame, ranges: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Values of rows inside the ranges of their series, once for each range."""
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    met = rows.alias("a").join(sized(ranges).alias("b"), [*same, F.col("a.v").between(F.col("b.lo"), F.col("b.hi"))])
    return met.select(*(F.col(f"b.{k}").alias(k) for k in keys), "name", "side", "rank", "lo", "hi", "v")


def _narrowed(rows: DataFrame, todo: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Each range cut down to the bucket that holds its rank."""
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    halves = (v / 2 - lo / 2) / (hi / 2 - lo / 2)  # where the width overflows
    share = F.when(hi - lo == float("inf"), halves).otherwise((v - lo) / (hi - lo))
    bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
    counts = _inside(rows, todo, keys).groupBy(*keys, "name", "side", "rank", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("left"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    w = Window.partitionBy(*keys, "name", "side").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # over BUCKETS rows at most
    placed = counts.withColumn("below", F.coalesce(F.sum("left").over(w), F.lit(0)))
    return placed.filter((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("left"))).select(*keys, "name", "side", (F.col("rank") - F.col("below")).alias("rank"), "left", "lo", "hi")
