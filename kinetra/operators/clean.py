"""Timelines: cleaning, statistics, trimming, units.

Signals are long tables (session_id, signal, row_idx, t_ms, x, y, z); row_idx gives the order in the file and may
be any type that sorts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetra.functions.scalars import choose, is_finite, magnitude
from kinetra.operators.quantiles import quantiles
from kinetra.operators.scan import WIDTH, scan

SIGNAL = ("session_id", "signal")
VALUES = ("t_ms", "x", "y", "z")


def finite_rows(df: DataFrame, cols: tuple[str, ...] = VALUES) -> DataFrame:
    """Rows whose columns are all finite numbers; null is what could not be parsed."""
    keep = F.lit(True)
    for c in cols:
        keep = keep & is_finite(F.col(c))
    return df.filter(keep)


def clean_timeline(df: DataFrame, values: tuple[str, ...] = ("x", "y", "z"), keys: tuple[str, ...] = SIGNAL) -> DataFrame:
    """One row for each time: of rows with equal times the first in file order.

    A hash aggregate with partial results per task: no window sorts the raw rows, and a time that many rows have costs a row
    a task.  It hashes where row_idx is a number, for numbers are replaced in place; of rows that share time and
    row_idx too, which no reader gives, values may mix.
    """
    return df.groupBy(*keys, "t_ms").agg(*(F.min_by(v, "row_idx").alias(v) for v in values))


def clean_stats(df: DataFrame, keys: tuple[str, ...] = SIGNAL, width: float = WIDTH) -> DataFrame:
    """total, bad (unparsable), finite, clean (distinct times), duplicates and non_positive_dt in file order.

    Steps are taken in chunks of width row numbers.
    """
    parsed = F.lit(True)
    good = F.lit(True)
    for c in VALUES:
        parsed, good = parsed & F.col(c).isNotNull(), good & is_finite(F.col(c))
    rows = df.select(*keys, "row_idx", "t_ms", parsed.alias("parsed"), good.alias("good"))
    steps = scan(rows.filter("good").select(*keys, "row_idx", "t_ms"), keys, "row_idx", ("t_ms",), width).select(*keys, (F.col("t_ms") - F.col("before.t_ms")).alias("dt"), "t_ms")
    by_file = steps.groupBy(*keys).agg(F.count_if(F.col("dt") <= 0).alias("non_positive_dt"), F.countDistinct("t_ms").alias("clean"), F.count(F.lit(1)).alias("finite"))
    totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("parsed")).alias("bad"))
    out = totals.join(by_file, list(keys), "left")
    return out.select(*keys, "total", "bad", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("finite", "clean", "non_positive_dt")), (F.coalesce("finite", F.lit(0)) - F.coalesce("clean", F.lit(0))).alias("duplicates"))


def time_stats(clean: DataFrame, keys: tuple[str, ...] = SIGNAL) -> DataFrame:
    """n, t_first, t_last of each cleaned signal."""
    return clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("t_ms").alias("t_first"), F.max("t_ms").alias("t_last"))


def average_hz(n: Column, first: Column, last: Column, formula: str = "n") -> Column:
    """Samples, or intervals, a second; null if the duration isn't positive."""
    return F.when(last > first, (n - (1 if formula == "n-1" else 0)) / ((last - first) / F.lit(1000.0)))


def avg_hz(clean: DataFrame, formula: str = "n", min_hz: float = 0.0, keys: tuple[str, ...] = SIGNAL) -> DataFrame:
    """n, duration_sec, hz and whether the rate passes; a duration of 0 never does."""
    hz = average_hz(F.col("n"), F.col("t_first"), F.col("t_last"), formula)
    stats = time_stats(clean, keys).withColumn("hz", hz)
    return stats.select(*keys, "n", ((F.col("t_last") - F.col("t_first")) / 1000.0).alias("duration_sec"), "hz", F.coalesce(F.col("hz") >= min_hz, F.lit(False)).alias("passes"))


def drop_startup(df: DataFrame, seconds: float, keys: tuple[str, ...] = SIGNAL) -> DataFrame:
    """Rows from so many seconds after the signal's first on; the first times are aggregated, not windowed."""
    if seconds <= 0:
        return df
    first = df.groupBy(*keys).agg(F.min("t_ms").alias("t_first"))
    return df.join(first, list(keys)).filter(F.col("t_ms") >= F.col("t_first") + seconds * 1000.0).drop("t_first")


def overlaps(clean: DataFrame, min_rows: dict[str, int], key: str = "session_id", stats: DataFrame | None = None) -> DataFrame:
    """(key, lo, hi, reason) of every session: the time that all signals of min_rows cover, and why it cannot be used.

    Reasons, the first that applies: a signal is missing, no overlap, a signal has too few rows in it.
    stats: time_stats() of the signals where they are known already.
    """
    stats = time_stats(clean, (key, "signal")) if stats is None else stats
    has = [F.bool_or(F.col("signal") == s).alias(f"has_{i}") for i, s in enumerate(min_rows)]
    span = stats.filter(F.col("signal").isin(*min_rows)).groupBy(key).agg(F.max("t_first").alias("lo"), F.min("t_last").alias("hi"), *has)
    counts = [F.count_if(F.col("signal") == s).alias(f"n_{i}") for i, s in enumerate(min_rows)]
    inside = clean.join(span.select(key, "lo", "hi"), key).filter(F.col("t_ms").between(F.col("lo"), F.col("hi"))).groupBy(key).agg(*counts)
    checks = [(~F.col(f"has_{i}"), f"{s}: missing") for i, s in enumerate(min_rows)] + [(F.col("hi") <= F.col("lo"), "no overlap")]
    checks += [(F.coalesce(f"n_{i}", F.lit(0)) < least, f"{s}: too few overlap rows") for i, (s, least) in enumerate(min_rows.items())]
    return span.join(inside, key, "left").select(key, "lo", "hi", F.coalesce(*(F.when(cond, F.lit(text)) for cond, text in checks)).alias("reason"))


def trim_overlap(clean: DataFrame, min_rows: dict[str, int], key: str = "session_id", found: DataFrame | None = None) -> DataFrame:
    """Rows of all signals inside the time that all cover, times from 0 there.

    Sessions go where a signal of min_rows is missing, nothing overlaps, or a signal keeps too few rows, as overlaps() tells.
    """
    span = (overlaps(clean, min_rows, key) if found is None else found).filter("reason IS NULL").select(key, "lo", "hi")
    kept = clean.join(span, key).filter(F.col("t_ms").between(F.col("lo"), F.col("hi")))
    return kept.withColumn("t_ms", F.col("t_ms") - F.col("lo")).drop("lo", "hi")


def infer_unit(clean: DataFrame, keys: tuple[str, ...] = SIGNAL) -> DataFrame:
    """Median vector magnitude of each signal and the unit it tells: g, m/s2 or null."""
    out = quantiles(clean, keys, magnitude(F.col("x"), F.col("y"), F.col("z")), median_magnitude=0.5).drop("count")
    unit = F.when(F.col("median_magnitude").between(0.7, 1.5), "g").when(F.col("median_magnitude").between(6.0, 15.0), "m/s2")
    return out.withColumn("unit", unit)


def to_si(df: DataFrame, factor: Column | float, cols: tuple[str, ...] = ("x", "y", "z")) -> DataFrame:
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    return df.withColumns({c: F.col(c) * factor for c in cols})


def relative_ms(df: DataFrame, key: str = "session_id") -> DataFrame:
    """t_ms of rows with exact microseconds t_us: since the session's first row in file order."""
    first = df.groupBy(key).agg(F.min_by("t_us", "row_idx").alias("t_us_first"))
    return df.join(first, key).withColumn("t_ms", (F.col("t_us") - F.col("t_us_first")) / 1000.0).drop("t_us_first")


def exclude_devices(sessions: DataFrame, parts: tuple[str, ...], col: str = "device_id") -> DataFrame:
    """Sessions whose device id holds none of the parts; a null id holds none."""
    bad = F.lit(False)
    for p in parts:
        bad = bad | F.coalesce(F.col(col).contains(p), F.lit(False))
    return sessions.filter(~bad)


def map_label(sessions: DataFrame, mapping: dict[str, str], col: str, label: str = "label") -> DataFrame:
    """Label by a constant map and, where it has none, the reason to skip the session."""
    out = sessions.withColumn(label, choose(mapping, F.col(col)))
    return out.withColumn("reason", F.when(F.col(label).isNull(), F.concat(F.lit("unknown label: "), F.coalesce(F.col(col), F.lit("")))))


def attach_session(df: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows of known sessions with the sessions' columns; Spark broadcasts the sessions if they are small."""
    return df.join(sessions, "session_id")


def magnitudes(df: DataFrame) -> DataFrame:
    return df.withColumn("magnitude", magnitude(F.col("x"), F.col("y"), F.col("z")))
