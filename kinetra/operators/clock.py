"""Device clocks: data loss, and host time for every frame from a line fitted through the host clock's steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.operators.scan import scan


def data_loss(rows: DataFrame, hz: float, skip: int = 100, slack_us: float = 300.0, key: str = "file") -> DataFrame:
    """(key, n, expected, lost, lost_pct, gaps, max_gap_us) of rows (key, row_idx, ts in us), in file order.

    The first rows are skipped; a step longer than a period plus slack is a gap.  What is expected counts from
    ten rows later.  Files of up to skip + 1 rows, and files without a gap, have lost nothing; where there is a
    gap but no row to count from, lost_pct is null.
    """
    p = 1e6 / hz
    seen = scan(rows.select(key, "row_idx", "ts"), (key,), "row_idx", ("ts",))
    numbered = seen.select(key, "ts", (F.col("nth") + 1).alias("nth"), F.col("before.ts").alias("before"))
    gap = F.when((F.col("nth") > skip + 1) & (F.col("ts") - F.col("before") > p + slack_us), F.col("ts") - F.col("before"))
    per = numbered.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.max_by("ts", "nth").alias("last"), F.max(F.when(F.col("nth") == skip + 11, F.col("ts"))).alias("origin"),
        F.sum(gap).alias("gap_us"), F.count(gap).alias("gaps"), F.max(gap).alias("max_gap_us"),
    )
    lossy = F.col("gaps") > 0
    expected = ((F.col("last") - F.col("origin")) / p).cast("long")
    lost = F.coalesce((F.col("gap_us") / p).cast("long"), F.lit(0))
    pct = F.when(~lossy, F.lit(0.0)).when(F.col("expected") > 0, 100.0 * F.col("lost") / F.col("expected")).when(F.col("expected").isNotNull(), F.lit(0.0))
    out = per.select(key, "n", F.when(lossy, expected).alias("expected"), lost.alias("lost"), "gaps", "max_gap_us")
    return out.select(key, "n", "expected", "lost", pct.alias("lost_pct"), "gaps", "max_gap_us")


def loss_report(losses: DataFrame, pass_pct: float = 3.0, key: str = "type") -> DataFrame:
    """(key, files, lossy, passed): files, files with gaps, files within the limit."""
    return losses.groupBy(key).agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("gaps") > 0).alias("lossy"), F.count_if(F.col("lost_pct") <= pass_pct).alias("passed"))


def frame_utc(rows: DataFrame, skip_sec: float = 5.0, least_rows: int = 200, least_stable: int = 100, key: str = "file") -> tuple[DataFrame, DataFrame]:
    """Host time of each row of (key, row_idx, utc in ms, ts in us), and the fit of each file.

    Host time comes in packets and jumps; rows where it changes, after a warm-up of skip_sec, are anchors of a line
    utc = a + b * ts that all rows then follow, rounded half to even.  If fewer than least_stable rows are
    left after the warm-up, all rows count.  Files of fewer than least_rows rows or two anchors keep utc.
    The fit: n, anchors, ppm (deviation of b from 0.001), residual_std; sums are taken about the file's means.
    """
    head = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min_by("ts", "row_idx").alias("ts0"), F.min_by("utc", "row_idx").alias("utc0"))
    seen = rows.join(head, key).withColumn("settled", F.col("ts") - F.col("ts0") >= skip_sec * 1e6)
    stable = seen.groupBy(key).agg(F.count_if("settled").alias("stable"))
    used = seen.join(stable, key).filter(F.col("settled") | (F.col("stable") < least_stable))
    used = scan(used.select(key, "n", "row_idx", "utc", (F.col("ts") - F.col("ts0")).cast("double").alias("x"), (F.col("utc") - F.col("utc0")).cast("double").alias("y")), (key,), "row_idx", ("utc",))
    anchors = used.filter(F.col("utc") != F.col("before.utc")).select(key, "n", "x", "y")
    fit = anchors.groupBy(key).agg(F.count(F.lit(1)).alias("anchors"), F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a"))
    good = (F.col("n") >= least_rows) & (F.coalesce("anchors", F.lit(0)) >= 2) & F.col("b").isNotNull()
    residuals = anchors.join(fit, key).groupBy(key).agg(F.stddev_pop(F.col("y") - F.col("a") - F.col("b") * F.col("x")).alias("residual_std"))
    fits = head.join(fit, key, "left").join(residuals, key, "left").withColumn("fitted", good)
    line = F.col("utc0") + F.col("a") + F.col("b") * (F.col("ts") - F.col("ts0"))
    out = rows.join(fits.select(key, "fitted", "ts0", "utc0", "a", "b"), key).select(key, "row_idx", "utc", "ts", F.when(F.col("fitted"), F.bround(line, 0)).otherwise(F.col("utc").cast("double")).alias("frame_utc"))
    report = fits.select(key, "n", F.coalesce("anchors", F.lit(0)).alias("anchors"), "fitted", F.when(F.col("fitted"), (F.col("b") - 0.001) * 1e6).alias("ppm"), F.when(F.col("fitted"), F.col("residual_std")).alias("residual_std"))
    return out, report
