"""Checks of finished segments and of manifests against them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetra.functions.scalars import is_finite
from kinetra.spec import DEVICES, MODES


def _all(points: str, test) -> Column:
    return F.forall(points, test)


def _finite(points: str) -> Column:
    return _all(points, lambda p: F.forall(p, lambda v: is_finite(v)))


def validate_segments(segments: DataFrame, gyro: bool = True, period_ms: float | None = None, tolerance: float = 1e-3) -> DataFrame:
    """segments (frames, real, acc, gyro) with reason: the first of shape, time, finite, gyro time, padding, period."""
    t, end = F.col("frames").cast("int"), F.col("real").cast("int")
    four = lambda s: (F.size(s) == t) & _all(s, lambda p: F.size(p) == 4)
    zero = lambda s: _all(F.slice(s, end + 1, F.greatest(t - end, F.lit(0))), lambda p: F.forall(F.slice(p, 2, 3), lambda v: v == 0))
    checks = [
        ("acc shape", ~F.coalesce(four("acc"), F.lit(False))),
        ("time does not start at 0", F.get(F.get("acc", 0), 0) != 0),
        ("acc not finite", ~_finite("acc")),
        ("padding not zero", ~zero("acc")),
    ]
    if gyro:
        same = F.forall(F.zip_with("acc", "gyro", lambda a, g: F.get(a, 0) == F.get(g, 0)), lambda x: x)
        checks += [("gyro shape", ~F.coalesce(four("gyro"), F.lit(False))), ("gyro time differs", ~same), ("gyro not finite", ~_finite("gyro")), ("gyro padding not zero", ~zero("gyro"))]
    if period_ms is not None:
        steps = F.zip_with(F.slice("acc", 2, t - 1), F.slice("acc", 1, t - 1), lambda b, a: F.abs(F.get(b, 0) - F.get(a, 0) - period_ms) <= tolerance)
        checks.append(("period", ~F.forall(steps, lambda x: x)))
    return segments.withColumn("reason", F.coalesce(*(F.when(c, F.lit(name)) for name, c in checks)))


def acceptance_rules(devices: tuple[str, ...] = DEVICES, modes: tuple[str, ...] = MODES) -> dict[str, Column]:
    """Rule name to a column that is true where an entry, joined to its segment, breaks the rule."""
    n = F.col("num_frames")
    gyro = F.col("gyro").isNotNull()
    times = lambda s: F.transform(s, lambda p: F.get(p, 0))
    none = F.lit(False)
    return {
        "segment missing": ~F.col("found"),
        "dir is absolute": F.startswith(F.col("dir"), F.lit("/")),
        "device domain": ~F.col("device").isin(*devices),
        "mode domain": ~F.col("mode").isin(*modes),
        "src differs from dir": F.split_part(F.col("dir"), F.lit("/"), F.lit(2)) != F.col("src"),
        "mode differs from dir": F.split_part(F.col("dir"), F.lit("/"), F.lit(4)) != F.col("mode"),
        "device differs from dir": F.split_part(F.col("dir"), F.lit("/"), F.lit(5)) != F.col("device"),
        "acc missing": F.col("found") & F.col("acc").isNull(),
        "gyro missing": F.col("found") & F.col("has_gyro") & ~gyro,
        "gyro made up": F.col("found") & ~F.col("has_gyro") & gyro,
        "acc frames": F.size("acc") != n,
        "gyro frames": gyro & (F.size("gyro") != n),
        "acc columns": F.exists("acc", lambda p: F.size(p) != 4),
        "gyro columns": gyro & F.exists("gyro", lambda p: F.size(p) != 4),
        "acc time starts at 0": F.col("has_timestamp") & (F.get(F.get("acc", 0), 0) != 0),
        "gyro time starts at 0": gyro & F.col("has_timestamp") & (F.get(F.get("gyro", 0), 0) != 0),
        "acc time not all 0": ~F.col("has_timestamp") & F.exists(times("acc"), lambda t: t != 0),
        "gyro time not all 0": gyro & ~F.col("has_timestamp") & F.exists(times("gyro"), lambda t: t != 0),
        "acc finite": ~_finite("acc"),
        "gyro finite": F.when(gyro, ~_finite("gyro")).otherwise(none),
        "10s frames": (F.col("mode") == "10s") & (n != F.ceil(F.col("freq") * 10)),
        "1000f frames": (F.col("mode") == "1000f") & (n != 1000),
        "duration": F.abs(F.col("duration_sec") - n / F.col("freq")) > 1e-6,
    }


def source_rules(src: str, device: str, freq: float, label_keys: tuple[str, ...], has_gyro: bool) -> dict[str, Column]:
    """Rules of one source: its names, rate, signals, and the keys its labels must have."""
    keys = F.json_object_keys("label")
    return {
        "source": F.col("src") != src,
        "source device": F.col("device") != device,
        "source freq": F.col("freq") != freq,
        "source timestamp": ~F.col("has_timestamp"),
        "source gyro": F.col("has_gyro") != has_gyro,
        "source label": ~F.coalesce(F.array_sort(keys) == F.array(*map(F.lit, sorted(label_keys))) if label_keys else F.size(keys) == 0, F.lit(False)),
    }


def acceptance(entries: DataFrame, segments: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """(rule, violations) for every rule, over entries left-joined to segments (dir, acc, gyro)."""
    rules = rules or acceptance_rules()
    joined = entries.join(segments.select("dir", "acc", "gyro", F.lit(True).alias("hit")), "dir", "left").withColumn("found", F.coalesce("hit", F.lit(False)))
    counts = joined.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()))
    pairs = F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("violations")) for name in rules))
    return counts.select(F.inline(pairs))


def label_consistency(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries whose annotations don't all map to the entry's activity, or which have none."""
    shape = "activity string, annotations array<string>"
    parsed = entries.select("dir", F.from_json("label", shape).alias("l")).select("dir", "l.activity", F.explode_outer("l.annotations").alias("annotation"))
    named = labels.select("annotation", F.col("activity").alias("known"))
    per = parsed.join(named, "annotation", "left").groupBy("dir").agg(F.bool_and(F.coalesce(F.col("known") == F.col("activity"), F.lit(False))).alias("ok"))
    return per.filter(~F.col("ok")).select("dir")
