"""Segments: cutting, padding, labels, assembly, numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.functions.scalars import segment_dir
from kinetra.operators.scan import scan
from kinetra.scratch import cut
from kinetra.spec import ModeSpec

POINTS = "array<array<float>>"
#: Sessions that one task numbers.
SESSIONS_A_RANGE = 20_000


def candidates(grids: DataFrame, modes: tuple[ModeSpec, ...], period: float) -> DataFrame:
    """(session_id, mode, frames, seg, k_lo, k_hi, real, t_lo, t_hi) of every segment a grid can hold, for each mode.

    Whole segments only, unless the mode pads: then a tail of at least min_real frames is one too.  This is
    arithmetic on one row a session; the modes fan out here and not over frames.
    """
    options = F.array(*(F.struct(F.lit(m.name).alias("mode"), F.lit(m.frames).cast("long").alias("frames"), F.lit(m.min_real or m.frames).cast("long").alias("least")) for m in modes))
    each = grids.select("session_id", "start", "n_frames", F.inline(options))
    n = F.floor((F.col("n_frames") + F.col("frames") - F.col("least")) / F.col("frames"))
    whole = each.withColumn("n_seg", n).filter("n_seg > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_seg").cast("long") - 1)).alias("seg"))
    lo = F.col("seg") * F.col("frames")
    real = F.least(F.col("frames"), F.col("n_frames") - lo)
    p = F.lit(float(period))
    return whole.select(
        "session_id", "mode", "frames", "seg", lo.alias("k_lo"), (lo + real - 1).alias("k_hi"), real.alias("real"),
        (F.col("start") + lo * p).alias("t_lo"), (F.col("start") + (lo + real - 1) * p).alias("t_hi"),
    )


def merge_ranges(segments: DataFrame) -> DataFrame:
    """(session_id, k_lo, k_hi): the frames that segments of any mode need, as disjoint ranges."""
    w = Window.partitionBy("session_id").orderBy("k_lo", "k_hi")
    before = F.max("k_hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = segments.select("session_id", "k_lo", "k_hi", F.coalesce(F.col("k_lo") > before + 1, F.lit(True)).cast("int").alias("new"))
    runs = marked.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("session_id", "run").agg(F.min("k_lo").alias("k_lo"), F.max("k_hi").alias("k_hi")).drop("run")


def segment_frames(frames: DataFrame, segments: DataFrame, modes: tuple[ModeSpec, ...]) -> DataFrame:
    """Frames of the given segments, one copy a mode, with their index inside the segment.

    Joined on session, mode and segment number, all equal: frames // T is the number.
    """
    each = frames.select("*", F.inline(F.array(*(F.struct(F.lit(m.name).alias("mode"), F.lit(m.frames).cast("long").alias("frames")) for m in modes))))
    each = each.withColumn("seg", F.floor(F.col("frame_idx") / F.col("frames"))).withColumn("i", F.col("frame_idx") % F.col("frames"))
    return each.join(segments.select("session_id", "mode", "seg", "real"), ["session_id", "mode", "seg"])


def assemble(placed: DataFrame, period: float, signals: tuple[str, ...] = ("acc", "gyro")) -> DataFrame:
    """(session_id, mode, seg, frames, real, then an array [T][4] of float for each signal).

    Rows are local time in ms from 0, x, y, z; float only here.  Frames that are missing up to T are padding:
    zero values with time going on.  A signal without frames is null.  T bounds what is collected.
    """
    keys = ["session_id", "mode", "seg", "frames", "real"]
    lists = [F.array_sort(F.collect_list(F.when(F.col("signal") == s, F.struct("i", "x", "y", "z")))).alias(s) for s in signals]
    grouped = placed.groupBy(*keys).agg(*lists)

    def points(s: str) -> Column:
        time = lambda i: (i * F.lit(float(period))).cast("float")
        real = F.transform(F.col(s), lambda p: F.array(time(p["i"]), p["x"].cast("float"), p["y"].cast("float"), p["z"].cast("float")))
        pad = F.when(F.col("real") < F.col("frames"), F.transform(F.sequence(F.col("real"), F.col("frames") - 1), lambda i: F.array(time(i), *[F.lit(0.0).cast("float")] * 3))).otherwise(F.array().cast(POINTS))
        return F.when(F.size(s) > 0, F.concat(real, pad)).alias(s)

    return grouped.select(*keys, *map(points, signals))


def number_segments(segments: DataFrame, order: tuple[str, ...] = ("session_id",), groups: tuple[str, ...] = ("mode",)) -> DataFrame:
    """segments with number: from 1 in each group, by session order and then segment.

    Segments are counted a session, the sessions dealt out as ranges of their order, and counts summed up inside each range
    and over the ranges, of which a group has a few hundred: no task sees all sessions of a group, or all segments.
    """
    by_session = [*groups, *dict.fromkeys((*order, "session_id"))]
    counts = cut(segments.groupBy(*by_session).agg(F.count(F.lit(1)).alias("n")), "counts")
    parts = max(1, min(10_000, counts.count() // SESSIONS_A_RANGE))
    ranged = cut(counts.repartitionByRange(parts, *by_session).withColumn("range", F.spark_partition_id()), "ranges")
    place = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = ranged.groupBy(*groups, "range").agg(F.sum("n").alias("n"))
    before = totals.select(*groups, "range", place(Window.partitionBy(*groups).orderBy("range")).alias("before"))
    inside = place(Window.partitionBy(*groups, "range").orderBy(*by_session[len(groups) :]))
    offsets = ranged.withColumn("inside", inside).alias("a").join(before.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*groups, "range")])
    offsets = offsets.select(*(F.col(f"a.{c}").alias(c) for c in by_session), (F.col("b.before") + F.col("a.inside")).alias("offset"))
    nth = F.row_number().over(Window.partitionBy(*by_session).orderBy("seg"))
    each = segments.withColumn("nth", nth).alias("s").join(offsets.alias("o"), [F.col(f"s.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by_session])
    return each.select("s.*", "o.offset").withColumn("number", F.col("offset") + F.col("nth")).drop("offset", "nth")


def strict_period(rows: DataFrame, period_us: int, tolerance_us: int = 0, key: str = "session_id") -> DataFrame:
    """(key, n, ok, first_bad_row) for rows (key, row_idx, t_us): every step, in file order, is the period.

    Steps are exact microseconds.  One bad step rejects the whole session; the row it leads to is reported.
    """
    step = F.col("t_us") - F.col("before.t_us")
    seen = scan(rows.select(key, "row_idx", "t_us"), (key,), "row_idx", ("t_us",))
    steps = seen.select(key, "row_idx", (F.abs(step - period_us) > tolerance_us).alias("bad"))
    return steps.groupBy(key).agg(F.count(F.lit(1)).alias("n"), (F.count_if("bad") == 0).alias("ok"), F.min(F.when(F.col("bad"), F.col("row_idx"))).alias("first_bad_row"))


def label_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with the activity of their annotation; null where the dictionary (annotation, activity) has none."""
    return rows.join(labels.select("annotation", "activity"), "annotation", "left")


def segment_label(labelled: DataFrame, frames: int, key: str = "session_id") -> DataFrame:
    """(key, seg, activity, annotations, reason) of whole segments of rows numbered pos from 0.

    A segment is good if every annotation is non-blank and known and all have one activity; annotations are
    listed in the order they first occur.  The first reason that applies is given otherwise.
    """
    text = F.trim(F.coalesce("annotation", F.lit("")))
    counted = labelled.withColumn("seg", F.floor(F.col("pos") / frames)).groupBy(key, "seg", text.alias("annotation"), "activity").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    grouped = counted.groupBy(key, "seg").agg(
        F.sum("n").alias("n"), F.count_if(F.col("annotation") == "").alias("blank"), F.count_if(F.col("activity").isNull()).alias("unknown"),
        F.count_distinct("activity").alias("activities"), F.min("activity").alias("activity"),
        F.transform(F.array_sort(F.collect_list(F.struct("first", "annotation"))), lambda a: a["annotation"]).alias("annotations"),
    )
    reason = F.when(F.col("blank") > 0, "empty annotation").when(F.col("unknown") > 0, "unmapped annotation").when(F.col("activities") != 1, "mixed activities")
    whole = grouped.filter(F.col("n") == frames).withColumn("reason", reason)
    return whole.select(key, "seg", F.when(F.col("reason").isNull(), F.col("activity")).alias("activity"), F.array_distinct("annotations").alias("annotations"), "reason")


def manifest_entry(segments: DataFrame, src: str, device: str, freq: float, label: Column | None = None) -> DataFrame:
    """The ten fields of a manifest line for numbered segments, which say whether they have gyro by has_gyro or by gyro."""
    has = F.col("has_gyro") if "has_gyro" in segments.columns else F.col("gyro").isNotNull() if "gyro" in segments.columns else F.lit(False)
    out = segments.select(
        segment_dir(F.lit(src), F.col("mode"), F.lit(device), F.col("number")).alias("dir"), F.lit(src).alias("src"), F.lit(device).alias("device"),
        F.lit(float(freq)).alias("freq"), "mode", F.col("frames").cast("int").alias("num_frames"), (F.col("frames") / F.lit(float(freq))).alias("duration_sec"),
        F.lit(True).alias("has_timestamp"), has.alias("has_gyro"),
        (label if label is not None else F.lit("{}")).alias("label"),
    )
    return out
