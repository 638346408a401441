"""Scans in chunks and quantiles by histograms against plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetra.operators import clean, clock, quantiles, report, segment
from kinetra.operators.scan import scan
from kinetra.sources import readers


@pytest.mark.parametrize("width", [1.0, 7.0, 1000.0])
def test_scan_sees_the_row_before_across_empty_chunks(spark, width):
    rng = np.random.default_rng(4)
    rows = [(s, int(i), float(rng.normal()), None if i % 5 else "x") for s in ("a", "b", None) for i in rng.permutation(np.unique(rng.integers(-50, 400, 60)))] + [("one", 3, 1.0, "y")]
    df = spark.createDataFrame(rows, "k string, i long, v double, w string")
    got = {(r.k, r.i): (r.nth, r.before and (r.before.v, r.before.w)) for r in scan(df, ("k",), "i", ("v", "w"), width).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        want |= {(k, r[1]): (n, tuple(own[n - 1][2:]) if n else None) for n, r in enumerate(own)}
    assert got == want
    assert scan(df.filter("i > 999"), ("k",), "i", ("v",), width).count() == 0


def test_scan_takes_orders_of_several_fields(spark):
    df = spark.createDataFrame([("a", (i // 3, i % 3), i) for i in range(30)], "k string, o struct<x: long, y: long>, v long")
    got = {r.v: (r.nth, r.before and r.before.v) for r in scan(df, ("k",), "o", ("v",), 2.0).collect()}
    assert got == {i: (i, i - 1 if i else None) for i in range(30)}


def test_no_window_takes_a_whole_series(spark):
    """In the plans of ordered scans, windows over rows of samples are dealt by series and chunk; others see chunks."""
    raw = spark.sql("SELECT 's' AS session_id, 'acc' AS signal, id AS row_idx, CAST(id AS DOUBLE) AS t_ms, 1D AS x, 1D AS y, 1D AS z, id AS ts, 's' AS file, id * 10 AS t_us FROM range(100)")
    plans = [clean.clean_stats(raw), report.dt_histogram(raw, 1.0), report.downsample(raw, 10), clock.data_loss(raw, 800.0), segment.strict_period(raw, 10), readers.number_rows(raw, "row_idx")]
    for df in plans:
        text = df._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in text.splitlines() if " Window " in line]
        assert windows
        for line in windows:
            assert "chunk#" in line, line


@pytest.mark.parametrize("most", [1, 40, 10_000])
def test_quantiles_equal_sorted_ones(spark, monkeypatch, most):
    monkeypatch.setattr(quantiles, "MOST", most)
    rng = np.random.default_rng(5)
    series = {
        "normal": rng.normal(size=3001), "steps": rng.integers(0, 9, 2000) * 1.5, "one": [7.0], "two": [1.0, 2.0], "same": [3.25] * 500, "wide": np.concatenate([rng.normal(size=400), [1e300, -1e300, 1e-300]]),
        "huge": np.arange(-166, 167) * 1e306, "tiny": np.arange(300) * 5e-324,
    }
    rows = [(k, float(v)) for k, vs in series.items() for v in vs] + [(None, 1.0), (None, 4.0), ("bad", float("nan")), ("bad", None), ("normal", None), ("normal", float("inf"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r.k: r for r in quantiles.quantiles(df, ("k",), F.col("v"), **shares).collect()}
    assert set(got) == {*series, None}
    assert got[None]["c"] == 2.5
    plain = {r.k: r for r in df.filter("k IS NOT NULL AND v IS NOT NULL AND abs(v) < 1.75e308 AND NOT isnan(v)").groupBy("k").agg(*(F.percentile("v", F.lit(s)).alias(n) for n, s in shares.items())).collect()}
    for k, vs in series.items():
        assert got[k]["count"] == len(vs)
        for n in shares:
            assert got[k][n] == plain[k][n] or np.isclose(got[k][n], plain[k][n], rtol=1e-15), (k, n)


def test_quantiles_hold_few_values_of_a_long_series(spark, monkeypatch):
    """No task's list and no group of counts grows with the series."""
    seen = []
    monkeypatch.setattr(quantiles, "MOST", 100)
    inside, narrowed = quantiles._inside, quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda rows, todo, keys: seen.append(todo.agg(F.max("left")).first()[0]) or narrowed(rows, todo, keys))
    listed = []

    def watched(rows, ranges, keys):
        out = inside(rows, ranges, keys)
        if ranges.filter(F.col("left") > 100).isEmpty():
            listed.append(out.groupBy(*keys, "name", "side").count().agg(F.max("count")).first()[0] or 0)
        return out

    monkeypatch.setattr(quantiles, "_inside", watched)
    df = spark.range(200_000).selectExpr("'s' AS k", "hash(id) AS v")
    row = quantiles.quantiles(df, ("k",), F.col("v"), median=0.5).first()
    want = df.agg(F.percentile("v", F.lit(0.5))).first()[0]
    assert row.median == want and len(seen) <= 4 and seen[0] == 200_000 and max(listed) <= 100
