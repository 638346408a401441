"""Whole jobs: from raw samples to numbered segments, manifest lines and a status of each session."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetra.functions.scalars import choose
from kinetra.operators import clean as c
from kinetra.operators.quality import quality_bins, segment_quality
from kinetra.operators.resample import grid, resample
from kinetra.operators.segment import assemble, candidates, label_rows, manifest_entry, merge_ranges, number_segments, segment_frames, segment_label, strict_period
from kinetra.operators.validate import validate_segments
from kinetra.scratch import cut
from kinetra.sources.readers import number_rows
from kinetra.spec import SourceSpec


@dataclass
class Result:
    """segments with arrays and numbers, entries for a manifest, status (session_id, reason, segments, by_mode)."""

    segments: DataFrame
    entries: DataFrame
    status: DataFrame


def _wide(spec: SourceSpec, stats: DataFrame, suffix: str = "") -> DataFrame:
    """(session_id, a struct for each signal), from a row of time statistics a signal."""
    each = F.struct("n", "t_first", "t_last")
    return stats.groupBy("session_id").agg(*(F.first(F.when(F.col("signal") == s, each), ignorenulls=True).alias(s + suffix) for s in spec.signals))


def _skips(spec: SourceSpec, raw: DataFrame, whole: DataFrame, stats: DataFrame, grids: DataFrame, trimmed: DataFrame | None, sessions: DataFrame | None) -> DataFrame:
    """(session_id, reason): the first reason that applies, from one row of statistics a session.

    Order: excluded device, unknown label, then for each signal missing, too few unique rows, too short after the start-up
    drop; overlap of the signals where they are trimmed to it; no duration, low rate; then overlap, overshooting grid and
    too few frames.  whole: statistics of signals before anything is cut off; trimmed: overlaps() of the signals.
    """
    every = raw.select("session_id").distinct()
    if sessions is not None:
        every = every.join(sessions, "session_id", "left")
    rows = every.join(_wide(spec, whole, "_whole"), "session_id", "left").join(_wide(spec, stats), "session_id", "left").join(grids.select("session_id", "n_frames", "overshoot"), "session_id", "left")
    if trimmed is not None:
        rows = rows.join(trimmed.select("session_id", F.col("reason").alias("overlap")), "session_id", "left")
    checks: list[tuple[Column, Column]] = []
    if sessions is not None and spec.excluded:
        bad = F.lit(False)
        for part in spec.excluded:
            bad = bad | F.coalesce(F.col("device_id").contains(part), F.lit(False))
        checks.append((bad, F.lit("excluded device")))
    if sessions is not None and spec.label_map:
        checks.append((~F.coalesce(F.col("finger_raw").isin(*spec.label_map), F.lit(False)), F.concat(F.lit("unknown label: "), F.coalesce("finger_raw", F.lit("")))))
    steps = [("missing", lambda s: F.col(f"{s}_whole").isNull()), ("too few unique rows", lambda s: F.col(f"{s}_whole.n") < 2)]
    if spec.startup_sec > 0:
        steps.append(("too short after start-up drop", lambda s: F.coalesce(F.col(f"{s}.n"), F.lit(0)) < (spec.min_frames if spec.startup_rows is None else spec.startup_rows)))
    if trimmed is not None:
        steps.append(("", None))
    steps.append(("no duration", lambda s: F.col(f"{s}.t_last") <= F.col(f"{s}.t_first")))
    if spec.min_hz is not None:
        steps.append(("low average rate", lambda s: c.average_hz(F.col(f"{s}.n"), F.col(f"{s}.t_first"), F.col(f"{s}.t_last"), spec.hz_formula) < spec.min_hz))
    for what, test in steps:  # acc before gyro at every step
        checks += [(test(s), F.lit(f"{s}: {what}")) for s in spec.signals] if test else [(F.col("overlap").isNotNull(), F.col("overlap"))]
    checks += [
        (F.col("n_frames").isNull(), F.lit("no overlap")),
        (F.coalesce("overshoot", F.lit(False)) if spec.grid_end == "tolerance" else F.lit(False), F.lit("grid outside the timeline")),
        (F.col("n_frames") < spec.min_frames, F.lit("too few frames")),
    ]
    return rows.select("session_id", F.coalesce(*(F.when(cond, text) for cond, text in checks)).alias("reason"))


def resample_and_segment(raw: DataFrame, spec: SourceSpec, sessions: DataFrame | None = None, min_rows: dict[str, int] | None = None, chunk_ms: float | None = None, order: tuple[Column, ...] = ()) -> Result:
    """Clean, gate, resample and cut sessions of raw samples (session_id, signal, row_idx, t_ms, x, y, z) in SI units.

    sessions (session_id, device_id, finger_raw) are needed for exclusions and labels.  Only frames of
    accepted segments are ever made.  Cleaned samples, their statistics, the accepted segments and the finished arrays
    are written once each and read from there: raw samples are read once, and once more for the ids of sessions.
    Segments are numbered by order, which is made of columns of the session's id, then by that id.
    Recordings are resampled in chunks of chunk_ms, by default as long as 100,000 frames.  min_rows: rows that each signal
    of a trimmed source must have in the overlap, by default as many as a bin needs.
    """
    chunk_ms = chunk_ms or 100_000 * spec.period_ms
    cleaned = c.clean_timeline(c.finite_rows(raw))
    whole = trimmed = None
    if spec.startup_sec > 0 or spec.trim or spec.bin_origin == "zero":
        cleaned = cut(cleaned, "clean")
        whole = cut(c.time_stats(cleaned), "whole")
        cleaned = c.drop_startup(cleaned, spec.startup_sec)
    if spec.trim:
        before = None if spec.startup_sec > 0 else whole
        trimmed = cut(c.overlaps(cleaned, min_rows or {s: math.ceil(n) for s, n in spec.min_bin.items()}, stats=before), "overlaps")
        cleaned = c.trim_overlap(cleaned, {}, found=trimmed)
    elif spec.bin_origin == "zero":
        first = cleaned.groupBy("session_id").agg(F.min("t_ms").alias("t0"))
        cleaned = cleaned.join(first, "session_id").withColumn("t_ms", F.col("t_ms") - F.col("t0")).drop("t0")
    cleaned = cut(cleaned, "cleaned")
    stats = cut(c.time_stats(cleaned), "stats")
    grids = grid(cleaned, spec.period_ms, spec.grid_end, from_zero=spec.bin_origin == "zero", signals=len(spec.signals), stats=stats)
    skips = cut(_skips(spec, raw, stats if whole is None else whole, stats, grids, trimmed, sessions), "skips")
    usable = cut(grids.join(skips.filter("reason is null").select("session_id"), "session_id", "left_semi"), "grids")
    cand = candidates(usable, spec.modes, spec.period_ms)
    bins = quality_bins(cleaned, spec.bin_ms, spec.min_bin, spec.bin_origin, stats=stats)
    good = segment_quality(cand, cleaned, bins, spec.bin_ms, spec.bin_origin, stats=stats).filter("good")
    accepted = cut(cand.join(good.select("session_id", "mode", "seg"), ["session_id", "mode", "seg"], "left_semi"), "accepted")
    frames = resample(cleaned, usable, spec.period_ms, hold=spec.hold, chunk_ms=chunk_ms, wanted=merge_ranges(accepted))
    arrays = assemble(segment_frames(frames, accepted, spec.modes), spec.period_ms, spec.signals)
    keys = ["session_id", "mode", "seg"]
    checked = cut(validate_segments(arrays, gyro="gyro" in spec.signals).filter("reason is null").drop("reason"), "segments")
    has_gyro = F.col("gyro").isNotNull() if "gyro" in spec.signals else F.lit(False)
    places = [f"order_{i}" for i in range(len(order))]
    narrow = checked.select(*keys, "frames", "real", has_gyro.alias("has_gyro"), *(c.alias(n) for c, n in zip(order, places, strict=True)))
    numbers = number_segments(narrow, (*places, "session_id")).drop(*places)
    if spec.label_map and sessions is not None:
        labels = sessions.select("session_id", F.to_json(F.struct(choose(spec.label_map, F.col("finger_raw")).alias("finger"))).alias("label"))
        numbers = numbers.join(labels, "session_id", "left")
    else:
        padded = [(F.col("frames") - F.col("real")).alias("pad_frames")] if any(m.min_real for m in spec.modes) else []
        parts = [F.lit(value).alias(name) for name, value in spec.label.items()] + padded
        text = F.to_json(F.struct(*parts)) if parts else F.lit("{}")
        numbers = numbers.withColumn("label", text)
    numbers = cut(numbers, "numbers")
    entries = manifest_entry(numbers, spec.src, spec.device, spec.freq, F.col("label"))
    counts = numbers.groupBy("session_id").pivot("mode", [m.name for m in spec.modes]).agg(F.count(F.lit(1)))
    by_mode = F.create_map(*(x for m in spec.modes for x in (F.lit(m.name), F.coalesce(F.col(f"`{m.name}`"), F.lit(0)))))
    status = skips.join(counts, "session_id", "left").select("session_id", "reason", by_mode.alias("by_mode"))
    status = status.withColumn("segments", F.aggregate(F.map_values("by_mode"), F.lit(0).cast("long"), lambda a, x: a + x))
    if spec.trim:
        status = status.withColumn("reason", F.coalesce("reason", F.when(F.col("segments") == 0, "no valid segments")))
    return Result(checked.join(numbers.select(*keys, "number", "label"), keys), entries, status)


def segment_labelled(rows: DataFrame, labels: DataFrame, spec: SourceSpec, min_rows: int = 1000) -> Result:
    """Cut labelled rows (session_id, row_idx, t_us, x, y, z, annotation) of an exact period, without resampling.

    x, y, z in SI units.  A session is rejected by its first irregular step; a segment by its labels.
    """
    gate = strict_period(rows, round(spec.strict_period_ms * 1000), 0)
    reason = F.when(~F.col("ok"), F.concat(F.lit("irregular step at row "), F.col("first_bad_row").cast("string"))).when(F.col("n") < min_rows, "too few rows")
    skips = gate.select("session_id", reason.alias("reason"))
    kept = rows.join(skips.filter("reason is null").select("session_id"), "session_id", "left_semi")
    numbered = cut(number_rows(kept, "row_idx"), "rows")
    parts = []
    for m in spec.modes:
        named = segment_label(label_rows(numbered, labels), m.frames).filter("reason is null").drop("reason")
        rows_of = numbered.withColumn("seg", F.floor(F.col("pos") / m.frames)).withColumn("i", F.col("pos") % m.frames)
        rows_of = rows_of.join(named, ["session_id", "seg"]).select("session_id", F.lit(m.name).alias("mode"), "seg", F.lit(m.frames).alias("frames"), F.lit(m.frames).alias("real"), F.lit("acc").alias("signal"), "i", "x", "y", "z")
        label = named.select("session_id", "seg", F.lit(m.name).alias("mode"), F.to_json(F.struct("activity", "annotations")).alias("label"))
        parts.append(assemble(rows_of, spec.strict_period_ms, ("acc",)).join(label, ["session_id", "mode", "seg"]))
    arrays = parts[0]
    for p in parts[1:]:
        arrays = arrays.unionByName(p)
    checked = validate_segments(arrays, gyro=False, period_ms=spec.strict_period_ms).filter("reason is null").drop("reason")
    out = cut(number_segments(cut(checked, "segments")), "numbered")
    counts = out.groupBy("session_id").agg(F.count(F.lit(1)).alias("segments"))
    status = skips.join(counts, "session_id", "left").withColumn("segments", F.coalesce("segments", F.lit(0)))
    by_mode = out.groupBy("session_id", "mode").agg(F.count(F.lit(1)).alias("n")).groupBy("session_id").agg(F.map_from_entries(F.collect_list(F.struct("mode", "n"))).alias("by_mode"))
    status = status.join(by_mode, "session_id", "left")
    return Result(out, manifest_entry(out, spec.src, spec.device, spec.freq, F.col("label")), status)
