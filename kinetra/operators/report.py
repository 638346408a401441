"""Reports: runs, time lines, rates, segment statistics, plot ranges, overviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.operators.clean import SIGNAL, avg_hz
from kinetra.operators.quantiles import quantiles
from kinetra.operators.scan import WIDTH, scan


def run_summary(status: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """(level, key, n) from one status row a session (session_id, reason, segments, by_mode).

    total: seen, processed (at least one segment), skipped (with a reason), segments in all.  reason: skips by reason.
    mode: segments by mode.  With the readers' status of files (path, rows, reason, and dropped where a reader drops
    rows) also files: seen, rejected, rows, dropped, and file reason: rejected files by reason.
    """

    def totals(one: DataFrame, level: str) -> DataFrame:
        return one.select(F.inline(F.array(*(F.struct(F.lit(level).alias("level"), F.lit(c).alias("key"), F.col(c).alias("n")) for c in one.columns))))

    def reasons(df: DataFrame, level: str) -> DataFrame:
        return df.filter(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(F.lit(level).alias("level"), F.col("reason").alias("key"), "n")

    one = status.agg(
        F.count(F.lit(1)).alias("seen"), F.count_if(F.col("segments") > 0).alias("processed"),
        F.count_if(F.col("reason").isNotNull()).alias("skipped"), F.coalesce(F.sum("segments"), F.lit(0)).alias("segments"),
    )
    modes = status.select(F.explode("by_mode").alias("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))
    out = totals(one, "total").unionByName(reasons(status, "reason")).unionByName(modes.select(F.lit("mode").alias("level"), "key", "n"))
    if files is not None:
        dropped = F.coalesce(F.sum("dropped"), F.lit(0)) if "dropped" in files.columns else F.lit(0).cast("long")
        one = files.agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("reason").isNotNull()).alias("rejected"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), dropped.alias("dropped"))
        out = out.unionByName(totals(one, "files")).unionByName(reasons(files, "file reason"))
    return out


def _steps(df: DataFrame, keys: tuple[str, ...], width: float) -> DataFrame:
    """(keys, t_ms, dt): the time since the row before in file order, taken in chunks of width row numbers."""
    rows = scan(df.select(*keys, "row_idx", "t_ms"), keys, "row_idx", ("t_ms",), width)
    return rows.select(*keys, "t_ms", (F.col("t_ms") - F.col("before.t_ms")).alias("dt"))


def timeline_summary(df: DataFrame, keys: tuple[str, ...] = SIGNAL, width: float = WIDTH) -> DataFrame:
    """duration_sec, hz, median, least, 95th percentile and largest dt in file order, the dt that occurs most.

    dt is rounded to 3 digits for the mode; of equally frequent ones the least counts.
    """
    steps = _steps(df, keys, width)
    mode = steps.filter(F.col("dt").isNotNull()).groupBy(*keys, F.round("dt", 3).alias("r")).agg(F.count(F.lit(1)).alias("c"))
    mode = mode.groupBy(*keys).agg(F.min_by("r", F.struct(-F.col("c"), F.col("r"))).alias("dt_mode"))
    out = steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), ((F.max("t_ms") - F.min("t_ms")) / 1000.0).alias("duration_sec"),
        F.min("dt").alias("dt_min"), F.max("dt").alias("dt_max"), F.count_if(F.col("dt") <= 0).alias("non_positive_dt"),
    )
    middle = quantiles(steps, keys, F.col("dt"), dt_median=0.5, dt_p95=0.95).drop("count")
    out = out.withColumn("hz", F.when(F.col("duration_sec") > 0, (F.col("n") - 1) / F.col("duration_sec")))
    return out.join(middle, list(keys), "left").join(mode, list(keys), "left")


def dt_histogram(df: DataFrame, period_ms: float, tolerance: float = 1e-6, top: int = 10, keys: tuple[str, ...] = SIGNAL, width: float = WIDTH) -> DataFrame:
    """(dt, n, exact) of the most common steps, rounded to 6 digits; off_period counts all steps that differ."""
    steps = _steps(df, keys, width).select("dt").filter(F.col("dt").isNotNull())
    counted = steps.groupBy(F.round("dt", 6).alias("dt")).agg(F.count(F.lit(1)).alias("n"))
    off = steps.agg(F.count_if(F.abs(F.col("dt") - period_ms) > tolerance).alias("off_period"))
    return counted.orderBy(F.desc("n"), "dt").limit(top).crossJoin(off).withColumn("exact", F.abs(F.col("dt") - period_ms) <= tolerance)


def frame_rate_report(clean: DataFrame, min_hz: float, formula: str = "n-1", keys: tuple[str, ...] = SIGNAL, group: str = "signal") -> DataFrame:
    """(group, files, min_hz, max_hz, below): rates of single files, then of each kind of file."""
    rates = avg_hz(clean, formula, min_hz, keys)
    return rates.groupBy(group).agg(F.count(F.lit(1)).alias("files"), F.min("hz").alias("min_hz"), F.max("hz").alias("max_hz"), F.count_if(~F.col("passes")).alias("below"))


def segment_stats(segments: DataFrame, key: tuple[str, ...], signal: str = "acc") -> DataFrame:
    """min, max, mean, population std of each axis of array [T][4] columns, and of the magnitude with its median."""
    points = segments.select(*key, F.explode(signal).alias("p")).select(*key, *(F.get("p", i + 1).cast("double").alias(c) for i, c in enumerate("xyz")))
    points = points.withColumn("m", F.sqrt(sum((F.col(c) * F.col(c) for c in "yz"), F.col("x") * F.col("x"))))
    stats = [f(c).alias(f"{c}_{name}") for c in "xyzm" for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_pop))]
    return points.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *stats, F.median("m").alias("m_median"))


def robust_range(df: DataFrame, key: tuple[str, ...], value: str) -> DataFrame:
    """Plot range (lo, hi): 1st and 99th percentile with 12 % on either side.

    A constant gets a tenth of max(|value|, 1) on either side; a series without values, or with any that
    is not finite, gives (-1, 1).
    """
    finite = F.coalesce(~F.isnan(value) & (F.abs(value) != float("inf")), F.lit(False))
    whole = df.groupBy(*key).agg(F.bool_and(finite).alias("whole")).alias("w")
    ends = quantiles(df, key, F.col(value), a=0.01, b=0.99).alias("q")
    q = whole.join(ends, [F.col(f"w.{k}").eqNullSafe(F.col(f"q.{k}")) for k in key] + [F.col("w.whole")], "left")
    q = q.select(*(F.col(f"w.{k}").alias(k) for k in key), "q.a", "q.b")
    pad = F.when(F.col("a") == F.col("b"), F.greatest(F.abs("b"), F.lit(1.0)) * 0.1).otherwise((F.col("b") - F.col("a")) * 0.12)
    return q.select(*key, F.coalesce(F.col("a") - pad, F.lit(-1.0)).alias("lo"), F.coalesce(F.col("b") + pad, F.lit(1.0)).alias("hi"))


def downsample(df: DataFrame, most: int = 900, keys: tuple[str, ...] = SIGNAL, order: str = "t_ms", width: float = 500_000.0) -> DataFrame:
    """At most so many evenly spaced rows of each series: number trunc(i * (n - 1) / (most - 1)) for each i.

    Series of up to most rows stay whole.  A row is wanted if the first i at or above its place leads to it, so
    each row decides by itself.  Places are counted in chunks of the order, width units long.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows = scan(df, keys, order, (order,), width).drop("before").join(counts, list(keys))
    if most < 2:
        return rows.filter(F.col("nth") < most).drop("nth", "n")
    i = F.floor((F.col("nth") * (most - 1) + F.col("n") - 2) / (F.col("n") - 1))  # the least i with i * (n-1) >= nth * (most-1)
    hit = F.floor(i * (F.col("n") - 1) / (most - 1)) == F.col("nth")
    return rows.filter((F.col("n") <= most) | hit).drop("nth", "n")
