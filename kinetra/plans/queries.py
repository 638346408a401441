"""Every operator over the given tables, with DuckDB SQL for the same result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.functions.scalars import low_byte
from kinetra.operators import clean as c
from kinetra.operators import clock, manifest, quality, report, resample, segment, validate
from kinetra.plans import views as v
from kinetra.plans.jobs import resample_and_segment
from kinetra.sources import readers, sinks
from kinetra.spec import ModeSpec, SourceSpec

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
MODES = (ModeSpec("24f", 24), ModeSpec("100f", 100))
PADDED = (ModeSpec("256f", 256, 128),)
SPEC = SourceSpec("events", "watch", 1000.0 / v.HOUR, v.LEAST, None, bin_ms=v.DAY, min_frames=24, modes=MODES)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = "WITH " + sql
        return f

    return add


def _rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({x: F.round(x, digits) for x in cols})


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return c.clean_timeline(v.raw_samples(spark, sf))


_STATS = "st AS (SELECT session_id, signal, count(*) AS n, min(t_ms) AS t_first, max(t_ms) AS t_last FROM clean GROUP BY ALL)"


@query(v.DUP_SQL + " SELECT session_id, signal, t_ms, arg_min(x, row_idx) AS x, arg_min(y, row_idx) AS y, arg_min(z, row_idx) AS z FROM raw GROUP BY ALL")
def clean_timeline(spark, sf):
    return c.clean_timeline(v.raw_dup(spark, sf))


@query(v.DUP_SQL + """, d AS (SELECT *, t_ms - lag(t_ms) OVER (PARTITION BY session_id ORDER BY row_idx) AS dt FROM raw)
SELECT session_id, signal, count(*) AS total, 0 AS bad, count(*) AS finite, count(DISTINCT t_ms) AS clean, count(*) FILTER (WHERE dt <= 0) AS non_positive_dt, count(*) - count(DISTINCT t_ms) AS duplicates FROM d GROUP BY session_id, signal""")
def clean_stats(spark, sf):
    return c.clean_stats(v.raw_dup(spark, sf), width=v.DUP_WIDTH).withColumn("bad", F.col("bad").cast("int"))


@query(v.RAW_SQL + ", f AS (SELECT * REPLACE (CASE WHEN row_idx % 7 = 0 THEN CAST('nan' AS DOUBLE) WHEN row_idx % 11 = 0 THEN NULL ELSE x END AS x) FROM raw) SELECT * FROM f WHERE x IS NOT NULL AND NOT isnan(x)")
def finite_rows(spark, sf):
    raw = v.raw_samples(spark, sf)
    bad = F.when(F.col("row_idx") % 7 == 0, F.lit(float("nan"))).when(F.col("row_idx") % 11 != 0, F.col("x"))
    return c.finite_rows(raw.withColumn("x", bad))


@query(v.RAW_SQL + ", f AS (SELECT session_id, signal, min(t_ms) AS t0 FROM raw GROUP BY ALL) SELECT raw.* FROM raw JOIN f USING (session_id, signal) WHERE t_ms >= t0 + 200000 * 1000.0")
def drop_startup(spark, sf):
    return c.drop_startup(v.raw_samples(spark, sf), 200_000).select("session_id", "signal", "row_idx", "t_ms", "x", "y", "z")


@query(v.CLEAN_SQL + f", {_STATS} SELECT session_id, signal, n, round((t_last - t_first) / 1000.0, 6) AS duration_sec, round(n / ((t_last - t_first) / 1000.0), 9) AS hz, n / ((t_last - t_first) / 1000.0) >= 0.0001 AS passes FROM st")
def avg_hz(spark, sf):
    return _rounded(_rounded(c.avg_hz(_clean(spark, sf), "n", 0.0001), "duration_sec"), "hz", digits=9)


@query(v.CLEAN_SQL + f", {_STATS}, r AS (SELECT *, (n - 1) / ((t_last - t_first) / 1000.0) AS hz FROM st) SELECT signal, count(*) AS files, round(min(hz), 9) AS min_hz, round(max(hz), 9) AS max_hz, count(*) FILTER (WHERE hz < 0.0001) AS below FROM r GROUP BY signal")
def frame_rate_report(spark, sf):
    return _rounded(report.frame_rate_report(_clean(spark, sf), 0.0001), "min_hz", "max_hz", digits=9)


_DT = "d AS (SELECT *, t_ms - lag(t_ms) OVER (PARTITION BY session_id, signal ORDER BY row_idx) AS dt FROM raw)"


@query(v.RAW_SQL + f""", {_DT}, m AS (SELECT session_id, signal, round(dt, 3) AS r, count(*) AS c FROM d WHERE dt IS NOT NULL GROUP BY ALL), mm AS (SELECT session_id, signal, arg_min(r, (-c, r)) AS dt_mode FROM m GROUP BY ALL)
SELECT session_id, signal, count(*) AS n, round((max(t_ms) - min(t_ms)) / 1000.0, 6) AS duration_sec, round(median(dt), 3) AS dt_median, round(min(dt), 3) AS dt_min, round(quantile_cont(dt, 0.95), 3) AS dt_p95, round(max(dt), 3) AS dt_max,
  count(*) FILTER (WHERE dt <= 0) AS non_positive_dt, round((count(*) - 1) / ((max(t_ms) - min(t_ms)) / 1000.0), 9) AS hz, any_value(dt_mode) AS dt_mode FROM d JOIN mm USING (session_id, signal) GROUP BY session_id, signal""")
def timeline_summary(spark, sf):
    out = _rounded(report.timeline_summary(v.raw_samples(spark, sf)), "dt_median", "dt_min", "dt_p95", "dt_max", digits=3)
    return _rounded(_rounded(out, "duration_sec"), "hz", digits=9)


@query(v.DUP_SQL + """, d AS (SELECT t_ms - lag(t_ms) OVER (PARTITION BY session_id ORDER BY row_idx) AS dt FROM raw)
SELECT round(dt, 6) AS dt, count(*) AS n, (SELECT count(*) FROM d WHERE abs(dt - 86400000.0) > 1e-6) AS off_period, abs(round(dt, 6) - 86400000.0) <= 1e-6 AS exact FROM d WHERE dt IS NOT NULL GROUP BY 1 ORDER BY n DESC, dt LIMIT 10""")
def dt_histogram(spark, sf):
    return report.dt_histogram(v.raw_dup(spark, sf), v.DAY, width=v.DUP_WIDTH)


_BINS = f"""br AS (SELECT session_id, signal, floor(t_first / {v.DAY}) * {v.DAY} AS bin_start, CAST(floor((ceil(t_last / {v.DAY}) * {v.DAY} - floor(t_first / {v.DAY}) * {v.DAY}) / {v.DAY}) AS BIGINT) AS n_bins FROM st),
bins AS (SELECT session_id, signal, least(greatest(CAST(floor((t_ms - bin_start) / {v.DAY}) AS BIGINT), 0), n_bins - 1) AS bin, count(*) AS n, count(*) >= CASE signal WHEN 'acc' THEN 6 ELSE 4 END AS valid FROM clean JOIN br USING (session_id, signal) WHERE n_bins > 0 GROUP BY 1, 2, 3)"""


@query(v.CLEAN_SQL + f", {_STATS}, {_BINS} SELECT * FROM bins")
def quality_bins(spark, sf):
    return quality.quality_bins(_clean(spark, sf), v.DAY, v.LEAST)


@query(v.CLEAN_SQL + f""", {_STATS}, {_BINS}, dense AS (SELECT session_id, signal, unnest(range(0, n_bins)) AS bin FROM br WHERE n_bins > 0),
e AS (SELECT d.session_id, d.signal, d.bin, coalesce(n, 0) AS n, coalesce(valid, false) AS valid FROM dense d LEFT JOIN bins USING (session_id, signal, bin))
SELECT session_id, signal, count(*) AS bins, round(avg(CASE WHEN valid THEN 1.0 ELSE 0.0 END), 6) AS valid_ratio, min(n) AS min_n, median(n) AS median_n, max(n) AS max_n, coalesce(array_to_string(list_slice(list(bin ORDER BY bin) FILTER (WHERE NOT valid), 1, 10), ','), '') AS bad_bins FROM e GROUP BY 1, 2""")
def bin_summary(spark, sf):
    clean = _clean(spark, sf)
    out = quality.bin_summary(clean, quality.quality_bins(clean, v.DAY, v.LEAST), v.DAY)
    return _rounded(out, "valid_ratio").withColumn("bad_bins", F.array_join("bad_bins", ","))


_GRID = f"""gr AS (SELECT session_id, max(t_first) AS start, min(t_last) AS stop, CAST(ceil((min(t_last) - max(t_first)) / {v.HOUR}) AS BIGINT) AS n_frames FROM st GROUP BY session_id HAVING count(*) = 2 AND min(t_last) > max(t_first))"""
_MODES = "modes AS (SELECT * FROM (VALUES ('24f', 24, 24), ('100f', 100, 100)) t(mode, frames, least))"
_PADDED = "modes AS (SELECT * FROM (VALUES ('256f', 256, 128)) t(mode, frames, least))"
_CAND = f"""cs AS (SELECT session_id, start, n_frames, mode, frames, unnest(range(0, CAST((n_frames + frames - least) // frames AS BIGINT))) AS seg FROM gr, modes),
cand AS (SELECT session_id, mode, frames, seg, seg * frames AS k_lo, seg * frames + least(frames, n_frames - seg * frames) - 1 AS k_hi, least(frames, n_frames - seg * frames) AS real, start + seg * frames * {v.HOUR} AS t_lo, start + (seg * frames + least(frames, n_frames - seg * frames) - 1) * {v.HOUR} AS t_hi FROM cs)"""
_GOOD = f"""touched AS (SELECT c.session_id, mode, seg, br.signal, unnest(range(CAST(least(greatest(floor((t_lo - bin_start) / {v.DAY}), 0), n_bins - 1) AS BIGINT), CAST(least(greatest(floor((t_hi - bin_start) / {v.DAY}), 0), n_bins - 1) AS BIGINT) + 1)) AS bin FROM cand c JOIN br ON br.session_id = c.session_id),
good AS (SELECT t.session_id, mode, seg, bool_and(coalesce(valid, false)) AS good FROM touched t LEFT JOIN bins b ON b.session_id = t.session_id AND b.signal = t.signal AND b.bin = t.bin GROUP BY ALL)"""
_FRAMES = f"""nx AS (SELECT *, lead(t_ms) OVER w AS t1, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(z) OVER w AS z1 FROM clean WINDOW w AS (PARTITION BY session_id, signal ORDER BY t_ms)),
pts AS (SELECT session_id, signal, k AS frame_idx, start + k * {v.HOUR} AS gt FROM (SELECT session_id, start, unnest(range(0, n_frames)) AS k FROM gr), (VALUES ('acc'), ('gyro')) s(signal)),
frames AS (SELECT p.session_id, p.signal, p.frame_idx, p.gt AS t_ms, CASE WHEN t1 IS NULL OR gt <= n.t_ms THEN x ELSE x + (gt - n.t_ms) * ((x1 - x) / (t1 - n.t_ms)) END AS x,
  CASE WHEN t1 IS NULL OR gt <= n.t_ms THEN y ELSE y + (gt - n.t_ms) * ((y1 - y) / (t1 - n.t_ms)) END AS y, CASE WHEN t1 IS NULL OR gt <= n.t_ms THEN z ELSE z + (gt - n.t_ms) * ((z1 - z) / (t1 - n.t_ms)) END AS z
  FROM pts p ASOF JOIN nx n ON p.session_id = n.session_id AND p.signal = n.signal AND p.gt >= n.t_ms)"""
_TO_FRAMES = v.CLEAN_SQL + f", {_STATS}, {_GRID}"


def _grids(clean):
    return resample.grid(clean, v.HOUR, signals=2)


@query(_TO_FRAMES + f", {_BINS}, {_MODES}, {_CAND}, {_GOOD} SELECT session_id, mode, seg, good FROM good")
def segment_quality(spark, sf):
    clean = _clean(spark, sf)
    bins = quality.quality_bins(clean, v.DAY, v.LEAST)
    return quality.segment_quality(segment.candidates(_grids(clean), MODES, v.HOUR), clean, bins, v.DAY)


@query(_TO_FRAMES + f", {_FRAMES} SELECT session_id, signal, frame_idx, round(t_ms, 3) AS t_ms, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM frames")
def resample_linear(spark, sf):
    clean = _clean(spark, sf)
    return _rounded(_rounded(resample.resample(clean, _grids(clean), v.HOUR), "x", "y", "z"), "t_ms", digits=3)


@query(_TO_FRAMES + f", {_FRAMES} SELECT session_id, signal, frame_idx, round(t_ms, 3) AS t_ms, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM frames")
def resample_in_chunks(spark, sf):
    clean = _clean(spark, sf)
    return _rounded(_rounded(resample.resample(clean, _grids(clean), v.HOUR, chunk_ms=5 * v.HOUR), "x", "y", "z"), "t_ms", digits=3)


@query(_TO_FRAMES + f", {_FRAMES} SELECT a.session_id, a.frame_idx, round(a.t_ms, 3) AS t_ms, round(a.x, 6) AS acc_x, round(g.x, 6) AS gyro_x, round(sqrt(a.y * a.y + a.z * a.z), 6) AS acc_yz FROM frames a JOIN frames g ON a.session_id = g.session_id AND a.frame_idx = g.frame_idx AND a.signal = 'acc' AND g.signal = 'gyro'")
def align(spark, sf):
    clean = _clean(spark, sf)
    both = resample.align(resample.resample(clean, _grids(clean), v.HOUR))
    yz = F.sqrt(F.col("acc.y") * F.col("acc.y") + F.col("acc.z") * F.col("acc.z"))
    return both.select("session_id", "frame_idx", F.round("t_ms", 3).alias("t_ms"), F.round("acc.x", 6).alias("acc_x"), F.round("gyro.x", 6).alias("gyro_x"), F.round(yz, 6).alias("acc_yz"))


@query(v.CLEAN_SQL + f""", {_STATS}, sp AS (SELECT session_id, max(t_first) AS lo, min(t_last) AS hi FROM st GROUP BY session_id HAVING count(*) = 2 AND min(t_last) > max(t_first)),
k AS (SELECT clean.*, lo FROM clean JOIN sp USING (session_id) WHERE t_ms BETWEEN lo AND hi), ok AS (SELECT session_id FROM k GROUP BY 1 HAVING count(*) FILTER (WHERE signal = 'acc') >= 30 AND count(*) FILTER (WHERE signal = 'gyro') >= 20)
SELECT session_id, signal, round(t_ms - lo, 3) AS t_ms, x, y, z FROM k SEMI JOIN ok USING (session_id)""")
def trim_overlap(spark, sf):
    out = c.trim_overlap(_clean(spark, sf), {"acc": 30, "gyro": 20})
    return _rounded(out.select("session_id", "signal", "t_ms", "x", "y", "z"), "t_ms", digits=3)


@query(_TO_FRAMES + f", {_MODES}, {_CAND} SELECT session_id, mode, seg, k_lo, k_hi, round(t_lo, 3) AS t_lo, round(t_hi, 3) AS t_hi FROM cand")
def segment_cut(spark, sf):
    cut = segment.candidates(_grids(_clean(spark, sf)), MODES, v.HOUR)
    return _rounded(cut.select("session_id", "mode", "seg", "k_lo", "k_hi", "t_lo", "t_hi"), "t_lo", "t_hi", digits=3)


@query(_TO_FRAMES + f", {_PADDED}, {_CAND} SELECT session_id, mode, seg, k_lo, k_hi, real, frames - real AS pad FROM cand")
def segment_padded(spark, sf):
    cut = segment.candidates(_grids(_clean(spark, sf)), PADDED, v.HOUR)
    return cut.select("session_id", "mode", "seg", "k_lo", "k_hi", "real", (F.col("frames") - F.col("real")).alias("pad"))


@query(_TO_FRAMES + f", {_MODES}, {_CAND} SELECT session_id, mode, seg, row_number() OVER (PARTITION BY mode ORDER BY session_id, seg) AS number FROM cand")
def number_segments(spark, sf):
    return segment.number_segments(segment.candidates(_grids(_clean(spark, sf)), MODES, v.HOUR)).select("session_id", "mode", "seg", "number")


def _assembled(spark, sf, modes=MODES):
    clean = _clean(spark, sf)
    grids = _grids(clean)
    cand = segment.candidates(grids, modes, v.HOUR)
    frames = resample.resample(clean, grids, v.HOUR, wanted=segment.merge_ranges(cand))
    return segment.assemble(segment.segment_frames(frames, cand, modes), v.HOUR)


_POINTS = """pt AS (SELECT c.session_id, c.mode, c.seg, c.frames, c.real, f.signal, CAST(f.frame_idx - c.k_lo AS BIGINT) AS i, CAST(x AS FLOAT) AS x, CAST(y AS FLOAT) AS y, CAST(z AS FLOAT) AS z FROM cand c JOIN frames f ON f.session_id = c.session_id AND f.frame_idx BETWEEN c.k_lo AND c.k_hi)"""


@query(_TO_FRAMES + f", {_FRAMES}, {_MODES}, {_CAND}, {_POINTS} SELECT session_id, mode, seg, signal, CAST(frames AS BIGINT) AS n, round(sum(CAST(x AS DOUBLE)), 3) AS sx, round(sum(CAST(y AS DOUBLE)), 3) AS sy, round(sum(i * CAST(x AS DOUBLE)), 2) AS ix FROM pt GROUP BY ALL")
def assemble(spark, sf):
    each = _assembled(spark, sf).select("session_id", "mode", "seg", F.inline(F.array(F.struct(F.lit("acc").alias("signal"), F.col("acc").alias("p")), F.struct(F.lit("gyro").alias("signal"), F.col("gyro").alias("p")))))
    add = lambda i: F.aggregate("p", F.lit(0.0), lambda a, q: a + F.get(q, i).cast("double"))
    weighed = F.aggregate(F.transform("p", lambda q, i: i * F.get(q, 1).cast("double")), F.lit(0.0), lambda a, b: a + b)
    return each.select("session_id", "mode", "seg", "signal", F.size("p").cast("long").alias("n"), F.round(add(1), 3).alias("sx"), F.round(add(2), 3).alias("sy"), F.round(weighed, 2).alias("ix"))


@query(_TO_FRAMES + f", {_FRAMES}, {_PADDED}, {_CAND}, {_POINTS} SELECT session_id, mode, seg, CAST(any_value(frames) AS BIGINT) AS n, CAST(any_value(frames - real) AS BIGINT) AS pad, round(sum(CAST(x AS DOUBLE)) FILTER (WHERE signal = 'acc'), 3) AS sx FROM pt GROUP BY ALL")
def assemble_padded(spark, sf):
    out = _assembled(spark, sf, PADDED)
    add = F.aggregate("acc", F.lit(0.0), lambda a, q: a + F.get(q, 1).cast("double"))
    return out.select("session_id", "mode", "seg", F.size("acc").cast("long").alias("n"), (F.col("frames") - F.col("real")).alias("pad"), F.round(add, 3).alias("sx"))


_JOB = _TO_FRAMES + f", {_BINS}, {_FRAMES}, {_MODES}, {_CAND}, {_GOOD}, gr2 AS (SELECT session_id FROM gr WHERE n_frames >= 24), acc AS (SELECT c.* FROM cand c JOIN good g USING (session_id, mode, seg) SEMI JOIN gr2 USING (session_id) WHERE g.good)"


@query(_JOB + """, nb AS (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY session_id, seg) AS number FROM acc), pt AS (SELECT n.*, f.signal, f.x FROM nb n JOIN frames f ON f.session_id = n.session_id AND f.frame_idx BETWEEN n.k_lo AND n.k_hi)
SELECT printf('sources/events/segments/%s/watch/%08d.npz', mode, number) AS dir, mode, CAST(frames AS INTEGER) AS num_frames, round(frames * 3600.0, 3) AS duration_sec, true AS has_gyro, round(sum(CAST(CAST(x AS FLOAT) AS DOUBLE)) FILTER (WHERE signal = 'acc'), 3) AS acc_x FROM pt GROUP BY mode, number, frames""")
def segment_job(spark, sf):
    done = resample_and_segment(v.raw_samples(spark, sf), SPEC)
    sums = F.round(F.aggregate("acc", F.lit(0.0), lambda a, q: a + F.get(q, 1).cast("double")), 3)
    e = done.entries.select("dir", "mode", "num_frames", F.round("duration_sec", 3).alias("duration_sec"), "has_gyro")
    from kinetra.functions.scalars import segment_dir

    s = done.segments.select(segment_dir(F.lit("events"), F.col("mode"), F.lit("watch"), F.col("number")).alias("dir"), sums.alias("acc_x"))
    return e.join(s, "dir")


@query(_JOB + """, per AS (SELECT session_id, count(*) AS segments FROM acc GROUP BY 1), s AS (SELECT r.session_id, CASE WHEN NOT EXISTS (SELECT 1 FROM st WHERE st.session_id = r.session_id AND signal = 'acc') THEN 'acc: missing' WHEN NOT EXISTS (SELECT 1 FROM st WHERE st.session_id = r.session_id AND signal = 'gyro') THEN 'gyro: missing'
  WHEN EXISTS (SELECT 1 FROM st WHERE st.session_id = r.session_id AND signal = 'acc' AND n < 2) THEN 'acc: too few unique rows' WHEN EXISTS (SELECT 1 FROM st WHERE st.session_id = r.session_id AND signal = 'gyro' AND n < 2) THEN 'gyro: too few unique rows' WHEN g.n_frames IS NULL THEN 'no overlap' WHEN g.n_frames < 24 THEN 'too few frames' END AS reason, coalesce(segments, 0) AS segments
  FROM (SELECT DISTINCT session_id FROM raw) r LEFT JOIN gr g ON g.session_id = r.session_id LEFT JOIN per p ON p.session_id = r.session_id)
SELECT 'total' AS level, 'seen' AS key, count(*) AS n FROM s UNION ALL SELECT 'total', 'processed', count(*) FROM s WHERE segments > 0 UNION ALL SELECT 'total', 'skipped', count(*) FROM s WHERE reason IS NOT NULL UNION ALL SELECT 'total', 'segments', CAST(coalesce(sum(segments), 0) AS BIGINT) FROM s
UNION ALL SELECT 'reason', reason, count(*) FROM s WHERE reason IS NOT NULL GROUP BY reason UNION ALL SELECT 'mode', m.mode, count(acc.seg) FROM modes m LEFT JOIN acc ON acc.mode = m.mode GROUP BY m.mode""")
def run_summary(spark, sf):
    return report.run_summary(resample_and_segment(v.raw_samples(spark, sf), SPEC).status)


@query(v.CLEAN_SQL + " , m AS (SELECT session_id, signal, median(sqrt(x * x + y * y + z * z)) AS m FROM clean GROUP BY ALL) SELECT session_id, signal, round(m, 6) AS median_magnitude, CASE WHEN m BETWEEN 0.7 AND 1.5 THEN 'g' WHEN m BETWEEN 6 AND 15 THEN 'm/s2' END AS unit FROM m")
def infer_unit(spark, sf):
    return _rounded(c.infer_unit(_clean(spark, sf)), "median_magnitude")


@query(v.RAW_SQL + " SELECT row_idx, round(sqrt(x * x + y * y + z * z), 6) AS magnitude FROM raw")
def magnitude(spark, sf):
    return _rounded(c.magnitudes(v.raw_samples(spark, sf)).select("row_idx", "magnitude"), "magnitude")


@query(v.RAW_SQL + " SELECT row_idx, round(x * 9.80665, 8) AS x, round(y * 9.80665, 8) AS y, round(z * 9.80665, 8) AS z FROM raw")
def to_si(spark, sf):
    return _rounded(c.to_si(v.raw_samples(spark, sf), 9.80665).select("row_idx", "x", "y", "z"), "x", "y", "z", digits=8)


@query(_TO_FRAMES + f", {_FRAMES}, {_MODES}, {_CAND}, {_POINTS}, p2 AS (SELECT session_id, mode, seg, CAST(x AS DOUBLE) AS x, sqrt(CAST(x AS DOUBLE) * CAST(x AS DOUBLE) + CAST(y AS DOUBLE) * CAST(y AS DOUBLE) + CAST(z AS DOUBLE) * CAST(z AS DOUBLE)) AS m FROM pt WHERE signal = 'acc') SELECT session_id, mode, seg, count(*) AS n, round(min(x), 5) AS x_min, round(max(x), 5) AS x_max, round(avg(x), 5) AS x_mean, round(stddev_pop(x), 4) AS x_std, round(avg(m), 5) AS m_mean, round(median(m), 5) AS m_median FROM p2 GROUP BY ALL")
def segment_stats(spark, sf):
    out = report.segment_stats(_assembled(spark, sf), ("session_id", "mode", "seg")).select("session_id", "mode", "seg", "n", "x_min", "x_max", "x_mean", "x_std", "m_mean", "m_median")
    return _rounded(_rounded(out, "x_min", "x_max", "x_mean", "m_mean", "m_median", digits=5), "x_std", digits=4)


@query(v.RAW_SQL + """, f AS (SELECT session_id, signal, CASE WHEN row_idx % 997 = 0 THEN CAST('nan' AS DOUBLE) ELSE x END AS x FROM raw), q AS (SELECT session_id, signal, quantile_cont(x, 0.01) FILTER (WHERE NOT isnan(x)) AS a, quantile_cont(x, 0.99) FILTER (WHERE NOT isnan(x)) AS b, bool_or(isnan(x)) AS bad FROM f GROUP BY ALL), p AS (SELECT *, CASE WHEN a = b THEN greatest(abs(b), 1.0) * 0.1 ELSE (b - a) * 0.12 END AS pad FROM q)
SELECT session_id, signal, CASE WHEN bad THEN -1.0 ELSE round(a - pad, 6) END AS lo, CASE WHEN bad THEN 1.0 ELSE round(b + pad, 6) END AS hi FROM p""")
def robust_range(spark, sf):
    raw = v.raw_samples(spark, sf).withColumn("x", F.when(F.col("row_idx") % 997 == 0, F.lit(float("nan"))).otherwise(F.col("x")))
    return _rounded(report.robust_range(raw, c.SIGNAL, "x"), "lo", "hi")


@query(v.RAW_SQL + """, o AS (SELECT *, row_number() OVER (PARTITION BY session_id, signal ORDER BY t_ms) - 1 AS nth, count(*) OVER (PARTITION BY session_id, signal) AS n FROM raw),
w AS (SELECT DISTINCT session_id, signal, CAST(trunc(i * (n - 1) / 39.0) AS BIGINT) AS nth FROM (SELECT DISTINCT session_id, signal, n FROM o WHERE n > 40), range(0, 40) r(i))
SELECT session_id, signal, row_idx, t_ms, x FROM o WHERE n <= 40 UNION ALL SELECT o.session_id, o.signal, row_idx, t_ms, x FROM o SEMI JOIN w USING (session_id, signal, nth)""")
def downsample(spark, sf):
    return report.downsample(v.raw_samples(spark, sf), 40, width=7 * v.DAY).select("session_id", "signal", "row_idx", "t_ms", "x")


@query("d AS (SELECT user_id AS session_id, event_id AS row_idx, abs(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY event_id) - 3600000000) > 18000000000 AS bad FROM events) SELECT session_id, count(*) AS n, count(*) FILTER (WHERE bad) = 0 AS ok, min(row_idx) FILTER (WHERE bad) AS first_bad_row FROM d GROUP BY 1")
def strict_period(spark, sf):
    return segment.strict_period(v.labelled(spark, sf), 3_600_000_000, 18_000_000_000)


@query(v.DICT_SQL + " SELECT user_id AS session_id, event_id AS row_idx, event_type AS annotation, activity FROM events LEFT JOIN dict ON annotation = event_type")
def label_rows(spark, sf):
    return segment.label_rows(v.labelled(spark, sf), v.dictionary(spark, sf)).select("session_id", "row_idx", "annotation", "activity")


@query(v.DICT_SQL + """, r AS (SELECT user_id AS session_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, event_type AS annotation, activity FROM events LEFT JOIN dict ON annotation = event_type),
g AS (SELECT session_id, pos // 2 AS seg, annotation, any_value(activity) AS activity, min(pos) AS first, count(*) AS n FROM r GROUP BY ALL),
s AS (SELECT session_id, seg, sum(n) AS n, count(*) FILTER (WHERE activity IS NULL) AS unknown, count(DISTINCT activity) AS k, min(activity) AS activity, string_agg(annotation, ',' ORDER BY first) AS annotations FROM g GROUP BY 1, 2)
SELECT session_id, seg, CASE WHEN unknown = 0 AND k = 1 THEN activity END AS activity, annotations, CASE WHEN unknown > 0 THEN 'unmapped annotation' WHEN k <> 1 THEN 'mixed activities' END AS reason FROM s WHERE n = 2""")
def segment_label(spark, sf):
    rows = readers.number_rows(segment.label_rows(v.labelled(spark, sf), v.dictionary(spark, sf)), "row_idx")
    return segment.segment_label(rows, 2).withColumn("annotations", F.array_join("annotations", ","))


@query("x AS (SELECT * FROM labels) SELECT " + "'activity' AS keys, o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderkey % 41 NOT IN (7, 8, 9) GROUP BY 2 UNION ALL SELECT NULL, NULL, count(*) FROM orders WHERE o_orderkey % 41 IN (7, 8, 9) HAVING count(*) > 0")
def label_counts(spark, sf):
    return manifest.label_counts(_checked(spark, sf), "activity")


def _file_sets(spark, sf):
    o = v.table(spark, sf, "orders")
    path = F.concat(F.lit("/"), F.col("key").cast("string"))
    acc = o.filter("o_orderstatus != 'F'").select(F.col("o_custkey").alias("key")).distinct().withColumn("path", path)
    gyro = o.filter("o_orderstatus != 'O'").select(F.col("o_custkey").alias("key")).distinct().withColumn("path", path)
    return acc, gyro


_FILES = "a AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus <> 'F'), g AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus <> 'O')"


@query(_FILES + " SELECT key, '/' || key AS acc_path, '/' || key AS gyro_path FROM a JOIN g USING (key)")
def pair_signals(spark, sf):
    return readers.pair_signals(*_file_sets(spark, sf))


@query(_FILES + " SELECT count(a.key) AS acc, count(g.key) AS gyro, count(a.key + g.key) AS paired, count(*) FILTER (WHERE g.key IS NULL) AS acc_only, count(*) FILTER (WHERE a.key IS NULL) AS gyro_only FROM a FULL JOIN g ON a.key = g.key")
def pair_counts(spark, sf):
    return readers.pair_counts(*_file_sets(spark, sf))


def _sessions(spark, sf):
    """A session for each customer: segment as finger, name as device."""
    return v.table(spark, sf, "customer").select(F.col("c_custkey").alias("session_id"), F.col("c_name").alias("device_id"), F.col("c_mktsegment").alias("finger_raw"))


@query("r AS (SELECT o_custkey AS session_id, o_orderkey, o_totalprice FROM orders) SELECT r.*, c_name AS device_id, c_mktsegment AS finger_raw FROM r JOIN customer ON c_custkey = session_id")
def attach_session(spark, sf):
    rows = v.table(spark, sf, "orders").select(F.col("o_custkey").alias("session_id"), "o_orderkey", "o_totalprice")
    return c.attach_session(rows, _sessions(spark, sf))


@query("m AS (SELECT * FROM (VALUES ('BUILDING', 'right_thumb'), ('MACHINERY', 'right_index')) t(k, label)) SELECT c_custkey AS session_id, c_name AS device_id, c_mktsegment AS finger_raw, label, CASE WHEN label IS NULL THEN 'unknown label: ' || c_mktsegment END AS reason FROM customer LEFT JOIN m ON k = c_mktsegment")
def map_label(spark, sf):
    return c.map_label(_sessions(spark, sf), {"BUILDING": "right_thumb", "MACHINERY": "right_index"}, "finger_raw")


@query("x AS (SELECT c_custkey AS session_id, c_name AS device_id, c_mktsegment AS finger_raw FROM customer) SELECT * FROM x WHERE device_id NOT LIKE '%0001%' AND device_id NOT LIKE '%77%'")
def exclude_devices(spark, sf):
    return c.exclude_devices(_sessions(spark, sf), ("0001", "77"))


@query("x AS (SELECT c_custkey AS session_id, c_name AS device_id, c_mktsegment AS finger_raw FROM customer) SELECT * FROM x WHERE finger_raw IN ('BUILDING', 'MACHINERY') ORDER BY session_id LIMIT 25")
def select_inputs(spark, sf):
    return readers.select_inputs(_sessions(spark, sf), [F.col("session_id")], 25, finger_raw=["BUILDING", "MACHINERY"])


@query("f AS (SELECT DISTINCT o_custkey AS session_id, o_orderstatus AS name FROM orders) SELECT session_id, count(*) FILTER (WHERE name IN ('F', 'O')) = 2 AS complete FROM f GROUP BY 1")
def discover(spark, sf):
    return readers.discover(v.table(spark, sf, "orders").select(F.col("o_custkey").alias("session_id"), F.col("o_orderstatus").alias("name")), ["F", "O"])


def _checked(spark, sf):
    return manifest.validate_entries(v.manifest_lines(spark, sf))


@query(v.LINES_SQL + " SELECT file, line_number, reason FROM checked")
def validate_entries(spark, sf):
    return _checked(spark, sf).select("file", "line_number", "reason")


@query(v.LINES_SQL + """, e AS (SELECT * FROM checked WHERE reason IS NULL), s AS (
SELECT 'src_device_mode' AS level, src, device, mode, count(*) AS n FROM e GROUP BY src, device, mode UNION ALL SELECT 'src_mode', src, NULL, mode, count(*) FROM e GROUP BY src, mode
UNION ALL SELECT 'src', src, NULL, NULL, count(*) FROM e GROUP BY src UNION ALL SELECT 'total', NULL, NULL, NULL, count(*) FROM e
UNION ALL SELECT 'device', NULL, d, NULL, count(e.device) FROM (VALUES ('phone'), ('watch'), ('ring'), ('other')) t(d) LEFT JOIN e ON e.device = d GROUP BY d
UNION ALL SELECT 'mode', NULL, NULL, m, count(e.mode) FROM (VALUES ('10s'), ('1000f')) t(m) LEFT JOIN e ON e.mode = m GROUP BY m) SELECT * FROM s""")
def manifest_summary(spark, sf):
    return manifest.manifest_summary(manifest.require_valid(_checked(spark, sf), skip_invalid=True))


@query(v.LINES_SQL + """, b AS (SELECT * FROM checked WHERE reason IS NOT NULL) SELECT 'total' AS level, NULL AS key, count(*) AS n FROM b UNION ALL SELECT 'source', path_src, count(*) FROM b GROUP BY 2 UNION ALL SELECT 'reason', reason, count(*) FROM b GROUP BY 2
UNION ALL SELECT 'example', file || ':' || line_number || ':' || reason, 1 FROM (SELECT * FROM b ORDER BY file, line_number LIMIT 50)""")
def invalid_summary(spark, sf):
    return manifest.invalid_summary(_checked(spark, sf))


@query(v.LINES_SQL + " SELECT dir, src, device, mode FROM checked WHERE reason IS NULL AND device = 'watch'")
def global_manifest(spark, sf):
    return manifest.global_manifest(manifest.require_valid(_checked(spark, sf), True), "watch").select("dir", "src", "device", "mode")


@query(v.LINES_SQL + " SELECT dir, CASE WHEN line_number % 10 = 3 THEN 'only first' ELSE 'only second' END AS side FROM checked WHERE reason IS NULL AND line_number % 10 IN (3, 4)")
def manifest_diff(spark, sf):
    e = manifest.require_valid(_checked(spark, sf), True).select("dir", "line_number")
    return manifest.manifest_diff(e.filter("line_number % 10 != 4").select("dir"), e.filter("line_number % 10 != 3").select("dir"))


@query(v.LINES_SQL + " SELECT dir FROM checked WHERE reason IS NULL AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = line_number)")
def missing_segments(spark, sf):
    e = manifest.require_valid(_checked(spark, sf), True)
    there = v.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("line_number")).distinct()
    return manifest.missing_segments(e.select("dir"), e.join(there, "line_number").select("dir"))


@query(v.LINES_SQL + ", h AS (SELECT line_number, fault, md5('7:' || dir) AS h, dir, src, mode FROM checked WHERE reason IS NULL), r AS (SELECT *, row_number() OVER (PARTITION BY src, mode ORDER BY substr(h, 1, 15), dir) AS k FROM h) SELECT dir, src, mode FROM r WHERE k <= 3")
def sample_per_group(spark, sf):
    return manifest.sample_per_group(manifest.require_valid(_checked(spark, sf), True).select("dir", "src", "mode"), ("src", "mode"), 3, 7)


@query(v.LINES_SQL + ", h AS (SELECT activity, md5('9:' || dir) AS h, dir FROM checked WHERE reason IS NULL), r AS (SELECT *, row_number() OVER (PARTITION BY activity ORDER BY substr(h, 1, 15), dir) AS k FROM h) SELECT dir, activity FROM r WHERE k <= 5")
def sample_per_label(spark, sf):
    e = manifest.require_valid(_checked(spark, sf), True).select("dir", F.get_json_object("label", "$.activity").alias("activity"))
    return manifest.sample_per_label(e, 5, 9)


def _made(spark, sf):
    """Segments of the events with their entries, some of them faulty."""
    arrays = segment.number_segments(_assembled(spark, sf))
    e = segment.manifest_entry(arrays, "events", "watch", 1000.0 / v.HOUR)
    segs = arrays.select(segment.segment_dir(F.lit("events"), F.col("mode"), F.lit("watch"), F.col("number")).alias("dir"), "acc", "gyro", "number")
    n = F.regexp_extract("dir", r"(\d+)\.npz", 1).cast("long")
    e = e.withColumn("num_frames", F.when(n % 5 == 0, F.col("num_frames") + 1).otherwise(F.col("num_frames"))).withColumn("has_gyro", n % 7 != 0)
    return e, segs.filter("number % 11 != 0")


@query(_TO_FRAMES + f""", {_MODES}, {_CAND}, n AS (SELECT mode, frames, row_number() OVER (PARTITION BY mode ORDER BY session_id, seg) AS k FROM cand), s AS (SELECT * FROM n WHERE k % 11 <> 0)
SELECT 'segment missing' AS rule, (SELECT count(*) FROM n WHERE k % 11 = 0) AS violations UNION ALL SELECT 'mode domain', (SELECT count(*) FROM n) UNION ALL SELECT 'gyro made up', (SELECT count(*) FROM s WHERE k % 7 = 0)
UNION ALL SELECT 'acc frames', (SELECT count(*) FROM s WHERE k % 5 = 0) UNION ALL SELECT 'gyro frames', (SELECT count(*) FROM s WHERE k % 5 = 0) UNION ALL SELECT 'duration', (SELECT count(*) FROM n WHERE k % 5 = 0)""")
def acceptance(spark, sf):
    rules = validate.acceptance_rules()
    shown = ("segment missing", "mode domain", "gyro made up", "acc frames", "gyro frames", "duration")
    return validate.acceptance(*_made(spark, sf), rules).filter(F.col("rule").isin(*shown) | (F.col("violations") > 0))


@query(_TO_FRAMES + f", {_MODES}, {_CAND} SELECT 'source freq' AS rule, (SELECT count(*) FROM cand) AS violations UNION ALL SELECT 'source gyro', (SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY mode ORDER BY session_id, seg) AS k FROM cand) WHERE k % 7 = 0)")
def acceptance_source(spark, sf):
    return validate.acceptance(*_made(spark, sf), validate.source_rules("events", "watch", 100.0, (), True)).filter("violations > 0")


@query(_TO_FRAMES + f", {_MODES}, {_CAND} SELECT mode, CAST(NULL AS VARCHAR) AS reason, count(*) AS n FROM cand GROUP BY mode")
def validate_segments(spark, sf):
    return validate.validate_segments(_assembled(spark, sf)).groupBy("mode", "reason").agg(F.count(F.lit(1)).alias("n"))


# Each fault that is put in, by its number, and the rules that it breaks.
_BROKEN = {
    1: ["segment missing"], 2: ["dir is absolute", "src differs from dir", "mode differs from dir", "device differs from dir"], 3: ["device domain", "device differs from dir"],
    4: ["mode domain", "mode differs from dir"], 5: ["src differs from dir"], 6: ["device differs from dir"], 7: ["mode differs from dir"], 8: ["acc missing"], 9: ["gyro missing"], 10: ["gyro made up"],
    11: ["acc frames"], 12: ["gyro frames"], 13: ["acc columns"], 14: ["gyro columns"], 15: ["acc time starts at 0"], 16: ["gyro time starts at 0"], 17: ["acc time not all 0"], 18: ["gyro time not all 0"],
    19: ["acc finite"], 20: ["gyro finite"], 21: ["acc frames", "gyro frames", "duration"], 22: ["duration"], 23: ["mode domain", "mode differs from dir", "10s frames"], 24: ["mode domain", "mode differs from dir", "1000f frames"],
}
_NUMBERED = _TO_FRAMES + f", {_MODES}, {_CAND}, n AS (SELECT mode, row_number() OVER (PARTITION BY mode ORDER BY session_id, seg) AS k FROM cand)"


def _with(points: str, first: Column | None = None, value: Column | None = None) -> Column:
    """An array [T][4] with other times, or with other values of x."""
    return F.transform(points, lambda p: F.array(F.get(p, 0) if first is None else first.cast("float"), F.get(p, 1) if value is None else value.cast("float"), F.get(p, 2), F.get(p, 3)))


def _put(column: str, number: Column, **faults: Column) -> Column:
    """A column with each fault's value where the row has that fault's number."""
    out = F.col(column)
    for name, value in faults.items():
        out = F.when(number == int(name[1:]), value).otherwise(out)
    return out.alias(column)


@query(_NUMBERED + f", b AS (SELECT * FROM (VALUES {', '.join(f"({k}, '{r}')" for k, rules in _BROKEN.items() for r in rules)}) t(fault, rule)) SELECT rule, count(k) AS violations FROM b LEFT JOIN n ON k % 31 = fault GROUP BY rule")
def acceptance_faults(spark, sf):
    """Every rule over all segments of the events, each fault put into one in 31."""
    arrays = segment.number_segments(_assembled(spark, sf))
    e, n = segment.manifest_entry(arrays, "events", "watch", 1000.0 / v.HOUR), F.regexp_extract("dir", r"(\d+)\.npz", 1).cast("long") % 31
    entries = e.select(
        _put("dir", n, f2=F.concat(F.lit("/"), "dir")), _put("src", n, f5=F.lit("other")), _put("device", n, f3=F.lit("hat"), f6=F.lit("ring")), "freq",
        _put("mode", n, f4=F.lit("5s"), f7=F.when(F.col("mode") == "24f", "100f").otherwise("24f"), f23=F.lit("10s"), f24=F.lit("1000f")), _put("num_frames", n, f21=F.col("num_frames") + 1),
        _put("duration_sec", n, f22=F.col("duration_sec") + 1), _put("has_timestamp", n, f17=F.lit(False), f18=F.lit(False)), _put("has_gyro", n, f10=F.lit(False)), "label",
    )
    place, n = segment.segment_dir(F.lit("events"), F.col("mode"), F.lit("watch"), F.col("number")), F.col("number") % 31
    segs = arrays.select(place.alias("dir"), "number", "frames", "acc", "gyro").filter(n != 1)
    zero, late, nan, few = F.lit(0), F.lit(1), F.lit(float("nan")), F.col("frames").cast("int") - 1
    none, three = F.lit(None).cast(segment.POINTS), lambda s: F.transform(s, lambda p: F.slice(p, 1, 3))
    segs = segs.select(
        _put("dir", n, f2=F.concat(F.lit("/"), "dir")),
        _put("acc", n, f8=none, f11=F.slice("acc", 1, few), f13=three("acc"), f15=_with("acc", late), f18=_with("acc", zero), f19=_with("acc", value=nan)),
        _put("gyro", n, f9=none, f12=F.slice("gyro", 1, few), f14=three("gyro"), f16=_with("gyro", late), f17=_with("gyro", zero), f20=_with("gyro", value=nan)),
    )
    return validate.acceptance(entries, segs, validate.acceptance_rules(modes=("24f", "100f")))


# The reason that each fault gives a segment, by its number.
_REASONS = {1: "acc shape", 2: "time does not start at 0", 3: "acc not finite", 4: "padding not zero", 5: "gyro shape", 6: "gyro time differs", 7: "gyro not finite", 8: "gyro padding not zero"}


@query(_NUMBERED + f" SELECT mode, CASE k % 13 {' '.join(f"WHEN {k} THEN '{r}'" for k, r in _REASONS.items())} END AS reason, count(*) AS n FROM n GROUP BY 1, 2")
def validate_faults(spark, sf):
    """Every check of finished segments over all of the events, each fault put into one in 13."""
    arrays, n = segment.number_segments(_assembled(spark, sf)), F.col("number") % 13
    few, nan, late = F.col("frames").cast("int") - 1, F.lit(float("nan")), F.lit(1)
    ends = lambda s: F.concat(F.slice(s, 1, few), F.array(F.array(F.get(F.get(s, few), 0), *[F.lit(0.0).cast("float")] * 3)))
    faulty = arrays.select(
        "mode", "frames", _put("real", n, f4=F.col("frames") - 1, f8=F.col("frames") - 1), _put("acc", n, f1=F.slice("acc", 1, few), f2=_with("acc", late), f3=_with("acc", value=nan), f8=ends("acc")),
        _put("gyro", n, f5=F.slice("gyro", 1, few), f6=_with("gyro", late), f7=_with("gyro", value=nan)),
    )
    return validate.validate_segments(faulty).groupBy("mode", "reason").agg(F.count(F.lit(1)).alias("n"))


_LOSS = """o AS (SELECT *, row_number() OVER w AS nth, ts - lag(ts) OVER w AS d FROM clock WINDOW w AS (PARTITION BY file ORDER BY row_idx)),
g AS (SELECT file, count(*) AS n, arg_max(ts, nth) AS last, max(ts) FILTER (WHERE nth = 111) AS origin, sum(d) FILTER (WHERE nth > 101 AND d > 1e6 / 0.0001 + 300) AS gap_us, count(d) FILTER (WHERE nth > 101 AND d > 1e6 / 0.0001 + 300) AS gaps, max(d) FILTER (WHERE nth > 101 AND d > 1e6 / 0.0001 + 300) AS max_gap_us FROM o GROUP BY file),
l AS (SELECT file, n, CASE WHEN gaps > 0 THEN CAST(trunc((last - origin) / (1e6 / 0.0001)) AS BIGINT) END AS expected, CAST(coalesce(trunc(gap_us / (1e6 / 0.0001)), 0) AS BIGINT) AS lost, gaps, max_gap_us FROM g),
loss AS (SELECT *, CASE WHEN gaps = 0 THEN 0 WHEN expected > 0 THEN 100.0 * lost / expected WHEN expected IS NOT NULL THEN 0 END AS lost_pct FROM l)"""


@query(v.CLOCK_SQL + f", {_LOSS} SELECT file, n, expected, lost, round(lost_pct, 6) AS lost_pct, gaps, max_gap_us FROM loss")
def data_loss(spark, sf):
    return _rounded(clock.data_loss(v.clock_rows(spark, sf), 0.0001), "lost_pct")


@query(v.CLOCK_SQL + f", {_LOSS} SELECT file % 3 AS type, count(*) AS files, count(*) FILTER (WHERE gaps > 0) AS lossy, count(*) FILTER (WHERE lost_pct <= 3.0) AS passed FROM loss GROUP BY 1")
def loss_report(spark, sf):
    losses = clock.data_loss(v.clock_rows(spark, sf), 0.0001)
    return clock.loss_report(losses.withColumn("type", F.col("file") % 3))


_FIT = """h AS (SELECT file, count(*) AS n, arg_min(ts, row_idx) AS ts0, arg_min(utc, row_idx) AS utc0 FROM clock GROUP BY file), s AS (SELECT c.*, n, ts0, utc0, ts - ts0 >= 5e6 AS settled FROM clock c JOIN h USING (file)),
u AS (SELECT * FROM s JOIN (SELECT file, count(*) FILTER (WHERE settled) AS stable FROM s GROUP BY file) USING (file) WHERE settled OR stable < 100),
a AS (SELECT file, CAST(ts - ts0 AS DOUBLE) AS x, CAST(utc - utc0 AS DOUBLE) AS y, utc <> lag(utc) OVER (PARTITION BY file ORDER BY row_idx) AS step FROM u), f AS (SELECT file, count(*) AS anchors, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM a WHERE step GROUP BY file)"""


@query(v.CLOCK_SQL + f", {_FIT} SELECT s.file, row_idx, CASE WHEN n >= 200 AND anchors >= 2 THEN round_even(utc0 + a + b * (ts - ts0), 0) ELSE CAST(utc AS DOUBLE) END AS ms FROM s LEFT JOIN f USING (file)")
def frame_utc(spark, sf):
    rows, _ = clock.frame_utc(v.clock_rows(spark, sf))
    return rows.select("file", "row_idx", F.col("frame_utc").alias("ms"))


@query(v.CLOCK_SQL + f", {_FIT} SELECT h.file, h.n, coalesce(anchors, 0) AS anchors, h.n >= 200 AND coalesce(anchors, 0) >= 2 AS fitted, CASE WHEN h.n >= 200 AND anchors >= 2 THEN round((b - 0.001) * 1e6, 4) END AS ppm FROM h LEFT JOIN f USING (file)")
def frame_utc_fit(spark, sf):
    _, fits = clock.frame_utc(v.clock_rows(spark, sf))
    return _rounded(fits.drop("residual_std"), "ppm", digits=4)


@query("x AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS BIGINT) & 255 AS stat0 FROM lineitem) SELECT * FROM x")
def mask_stat(spark, sf):
    return v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", low_byte(F.col("l_quantity").cast("long")).alias("stat0"))


@query(_TO_FRAMES + f", {_FRAMES}, {_MODES}, {_CAND}, {_POINTS}, nb AS (SELECT session_id, mode, seg, row_number() OVER (PARTITION BY mode ORDER BY session_id, seg) AS k FROM cand) SELECT printf('sources/events/segments/%s/watch/%08d.npz', mode, k) AS dir, CAST(any_value(frames) AS BIGINT) AS n, CAST(6 AS BIGINT) AS width, round(sum(CAST(x AS DOUBLE) + CAST(y AS DOUBLE) + CAST(z AS DOUBLE)), 2) AS total FROM pt JOIN nb USING (session_id, mode, seg) GROUP BY mode, k")
def training_tensors(spark, sf):
    arrays = segment.number_segments(_assembled(spark, sf))
    segs = arrays.select(segment.segment_dir(F.lit("events"), F.col("mode"), F.lit("watch"), F.col("number")).alias("dir"), "acc", "gyro")
    out = sinks.training_tensors(segment.manifest_entry(arrays, "events", "watch", 1.0), segs)
    total = F.aggregate(F.flatten("tensor"), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return out.select("dir", F.size("tensor").cast("long").alias("n"), F.size(F.get("tensor", 0)).cast("long").alias("width"), F.round(total, 2).alias("total"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, gate, resample, cut and number the signals, with thresholds that thin tables meet."""
    spec = SourceSpec("events", "watch", 1000.0 / v.HOUR, {"acc": 1.0, "gyro": 1.0}, None, bin_ms=v.DAY, min_frames=24, modes=MODES)
    return resample_and_segment(v.raw_samples(spark, sf_dir), spec).entries
