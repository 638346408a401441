"""Sampling quality: tumbling bins of a signal, and segments that touch valid bins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.functions.scalars import bin_index, choose
from kinetra.operators.clean import SIGNAL, time_stats
from kinetra.operators.quantiles import quantiles


def bin_range(clean: DataFrame, width: float, origin: str = "floor", keys: tuple[str, ...] = SIGNAL, stats: DataFrame | None = None) -> DataFrame:
    """start and n_bins of each signal's bins; they end with the first whole width at or after its last time.

    stats: time_stats() of the signals where they are known already.
    """
    w = F.lit(float(width))
    start = F.floor(F.col("t_first") / w) * w if origin == "floor" else F.lit(0.0)
    stats = (time_stats(clean, keys) if stats is None else stats).select(*keys, start.alias("bin_start"), "t_last")
    return stats.select(*keys, "bin_start", F.floor((F.ceil(F.col("t_last") / w) * w - F.col("bin_start")) / w).alias("n_bins"))


def quality_bins(clean: DataFrame, width: float, least: float | dict[str, float], origin: str = "floor", keys: tuple[str, ...] = SIGNAL, stats: DataFrame | None = None) -> DataFrame:
    """(keys, bin, n, valid) of bins that have rows; a bin without any has no row and counts as invalid.

    Counts are summed in each task first: one row a bin crosses the network, not one a sample.
    """
    placed = clean.join(bin_range(clean, width, origin, keys, stats), list(keys)).filter("n_bins > 0")
    bins = placed.select(*keys, bin_index(F.col("t_ms"), F.col("bin_start"), F.col("n_bins"), width).alias("bin")).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    need: Column = choose({k: float(v) for k, v in least.items()}, F.col("signal")) if isinstance(least, dict) else F.lit(float(least))
    return bins.withColumn("valid", F.coalesce(F.col("n") >= need, F.lit(False)))


def bin_summary(clean: DataFrame, bins: DataFrame, width: float, origin: str = "floor", first_bad: int = 10, keys: tuple[str, ...] = SIGNAL) -> DataFrame:
    """bins, valid_ratio, least, median and largest count, and the first bad bins, over the dense bin range."""
    dense = bin_range(clean, width, origin, keys).filter("n_bins > 0").select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bins").cast("long") - 1)).alias("bin"))
    every = dense.join(bins, [*keys, "bin"], "left").select(*keys, "bin", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("valid", F.lit(False)).alias("valid"))
    out = every.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("bins"), F.avg(F.col("valid").cast("double")).alias("valid_ratio"), F.min("n").alias("min_n"), F.max("n").alias("max_n")
    )
    invalid = every.filter(~F.col("valid")).select(*keys, "bin", F.row_number().over(Window.partitionBy(*keys).orderBy("bin")).alias("nth")).filter(F.col("nth") <= first_bad)
    bad = invalid.groupBy(*keys).agg(F.array_sort(F.collect_list("bin")).alias("bad_bins"))
    middle = quantiles(every, keys, F.col("n"), median_n=0.5).drop("count")
    out = out.join(middle, list(keys)).join(bad, list(keys), "left")
    return out.select(*keys, "bins", "valid_ratio", "min_n", "median_n", "max_n", F.coalesce("bad_bins", F.array().cast("array<bigint>")).alias("bad_bins"))


def touched_bins(segments: DataFrame, ranges: DataFrame, width: float) -> DataFrame:
    """A row for each segment, signal and bin from the segment's first to its last real frame.

    segments: session_id, mode, seg, t_lo, t_hi; ranges: bin_range() of the signals.  About eleven rows a
    segment, where its frames would be thousands.
    """
    both = segments.join(ranges, "session_id")
    lo, hi = (bin_index(F.col(c), F.col("bin_start"), F.col("n_bins"), width).cast("long") for c in ("t_lo", "t_hi"))
    return both.select("session_id", "mode", "seg", "signal", F.explode(F.sequence(lo, hi)).alias("bin"))


def segment_quality(segments: DataFrame, clean: DataFrame, bins: DataFrame, width: float, origin: str = "floor", stats: DataFrame | None = None) -> DataFrame:
    """(session_id, mode, seg, good): all bins that the segment touches are valid, for every signal."""
    touched = touched_bins(segments, bin_range(clean, width, origin, stats=stats), width)
    joined = touched.join(bins.select(*SIGNAL, "bin", "valid"), [*SIGNAL, "bin"], "left")
    return joined.groupBy("session_id", "mode", "seg").agg(F.bool_and(F.coalesce("valid", F.lit(False))).alias("good"))
