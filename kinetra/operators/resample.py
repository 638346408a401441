"""Uniform grids and linear interpolation, without a join of grid and samples.

Each raw interval [t_i, t_i+1) produces the grid points inside it: work is linear in samples plus frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.functions.scalars import first_frame_at
from kinetra.operators.clean import SIGNAL, time_stats

XYZ = ("x", "y", "z")
#: Frames in a cell of the join of raw intervals with wanted frame ranges.
WANTED_FRAMES = 2048


def grid(clean: DataFrame, period: float, end: str = "open", from_zero: bool = False, signals: int | None = None, stats: DataFrame | None = None) -> DataFrame:
    """(session_id, start, stop, n_frames) of the grid that all signals of a session cover.

    open: points below stop; closed: up to stop; tolerance: below stop + 1e-6, and overshoot is true where
    the last of them lies beyond stop.  from_zero: start at 0.  A session that lacks one of so many signals has
    no grid.  Only statistics are read, those given as stats or time_stats() of clean; no point is made here.
    """
    stats = (time_stats(clean) if stats is None else stats).groupBy("session_id").agg(F.max("t_first").alias("start"), F.min("t_last").alias("stop"), F.count(F.lit(1)).alias("signals"))
    if signals is not None:
        stats = stats.filter(F.col("signals") == signals)
    if from_zero:
        stats = stats.withColumn("start", F.lit(0.0))
    p, start, stop = F.lit(float(period)), F.col("start"), F.col("stop")
    below = first_frame_at(stop, start, period)  # points below stop
    at_stop = (start + below * p <= stop).cast("long")
    n = {"open": below, "closed": below + at_stop, "tolerance": first_frame_at(stop + 1e-6, start, period)}[end]
    out = stats.select("session_id", "start", "stop", F.greatest(n, F.lit(0)).cast("long").alias("n_frames"))
    return out.withColumn("overshoot", F.col("start") + (F.col("n_frames") - 1) * p > F.col("stop")).filter(stop > start)


def _next_rows(clean: DataFrame, values: tuple[str, ...], chunk_ms: float | None) -> DataFrame:
    """Each row with the next one of its signal as struct nxt, and whether it is the first.

    With chunk_ms the rows of a signal are dealt out in chunks of time; the last row of a chunk gets the first of the
    next chunk that has any, from a table of one row a chunk.  So a day of one recording fills no single task.
    """
    here = F.struct("t_ms", *values)
    if chunk_ms is None:
        w = Window.partitionBy(*SIGNAL).orderBy("t_ms")
        return clean.select("*", F.lead(here).over(w).alias("nxt"), (F.row_number().over(w) == 1).alias("is_first"))
    dealt = clean.withColumn("chunk", F.floor(F.col("t_ms") / chunk_ms))
    firsts = dealt.groupBy(*SIGNAL, "chunk").agg(F.min_by(here, F.col("t_ms")).alias("head"))
    order = Window.partitionBy(*SIGNAL).orderBy("chunk")
    halo = firsts.select(*SIGNAL, "chunk", F.lead("head").over(order).alias("halo"), (F.row_number().over(order) == 1).alias("first_chunk"))
    w = Window.partitionBy(*SIGNAL, "chunk").orderBy("t_ms")
    rows = dealt.select("*", F.lead(here).over(w).alias("own"), (F.row_number().over(w) == 1).alias("head")).join(halo, [*SIGNAL, "chunk"])
    return rows.select(*clean.columns, F.coalesce("own", "halo").alias("nxt"), (F.col("head") & F.col("first_chunk")).alias("is_first"))


def resample(clean: DataFrame, grids: DataFrame, period: float, values: tuple[str, ...] = XYZ, hold: bool = False, chunk_ms: float | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """(session_id, signal, frame_idx, t_ms, values) by linear interpolation at start + frame_idx * period.

    A grid point at a sample's time has that sample's value.  With hold, points before the first and after the
    last sample keep their values; without, there are none.  wanted (session_id, k_lo, k_hi): disjoint frame
    ranges; only frames inside one are made, by an equi-join on cells of frames, so gaps are not filled.
    """
    rows = _next_rows(clean, values, chunk_ms).join(grids.select("session_id", "start", "n_frames"), "session_id")
    last = F.col("nxt").isNull()
    lo = first_frame_at(F.col("t_ms"), F.col("start"), period)
    p = F.lit(float(period))
    at_end = F.when(F.lit(hold), F.col("n_frames")).otherwise(F.when(F.col("start") + lo * p == F.col("t_ms"), lo + 1).otherwise(lo))
    k_hi = F.when(last, at_end).otherwise(first_frame_at(F.col("nxt.t_ms"), F.col("start"), period)) - 1
    k_lo = F.when(F.lit(hold) & F.col("is_first"), F.lit(0)).otherwise(lo)
    rows = rows.withColumn("k0", F.greatest(k_lo, F.lit(0)).cast("long")).withColumn("k1", F.least(k_hi, F.col("n_frames") - 1).cast("long")).filter("k0 <= k1")
    if wanted is not None:
        inside = (F.col("k_lo") <= F.col("k1")) & (F.col("k_hi") >= F.col("k0"))
        step = F.lit(WANTED_FRAMES)
        cells = wanted.select("session_id", "k_lo", "k_hi", F.explode(F.sequence(F.floor(F.col("k_lo") / step), F.floor(F.col("k_hi") / step))).alias("cell"))
        hit = rows.select("*", F.explode(F.sequence(F.floor(F.col("k0") / step), F.floor(F.col("k1") / step))).alias("cell")).join(cells, ["session_id", "cell"]).filter(inside)
        cut_lo, cut_hi = F.greatest("k0", "k_lo", F.col("cell") * step), F.least("k1", "k_hi", (F.col("cell") + 1) * step - 1)
        rows = hit.withColumns({"k0": cut_lo.cast("long"), "k1": cut_hi.cast("long")}).filter("k0 <= k1")
    frames = rows.select(*SIGNAL, "start", "t_ms", "nxt", *values, F.explode(F.sequence("k0", "k1")).alias("frame_idx"))
    at = F.col("start") + F.col("frame_idx") * p

    def lerp(c: str) -> Column:
        y0, y1, t0, t1 = F.col(c), F.col(f"nxt.{c}"), F.col("t_ms"), F.col("nxt.t_ms")
        return F.when(F.col("nxt").isNull() | (at <= t0), y0).otherwise(y0 + (at - t0) * ((y1 - y0) / (t1 - t0)))

    return frames.select(*SIGNAL, "frame_idx", at.alias("at"), *(lerp(c).alias(c) for c in values)).withColumnRenamed("at", "t_ms")


def align(frames: DataFrame, signals: tuple[str, ...] = ("acc", "gyro")) -> DataFrame:
    """One row (session_id, frame_idx, t_ms, a struct x, y, z for each signal) a frame that all signals have.

    An aggregate, not a join: frames of all signals are hashed once by session and frame.
    """
    own = [F.first(F.when(F.col("signal") == s, F.struct(*XYZ)), ignorenulls=True).alias(s) for s in signals]
    out = frames.filter(F.col("signal").isin(*signals)).groupBy("session_id", "frame_idx").agg(F.min("t_ms").alias("t_ms"), *own)
    for s in signals:
        out = out.filter(F.col(s).isNotNull())
    return out
