"""Signal operators against a NumPy model on random sessions, and the rules that are easy to get wrong."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetra import scratch
from kinetra.operators import clean, clock, manifest, quality, report, resample, segment, validate
from kinetra.plans.jobs import resample_and_segment, segment_labelled
from kinetra.sources import readers, sinks
from kinetra.spec import ModeSpec, SourceSpec, phone_40, ring_200, ten_seconds, watch_100

RAW = "session_id string, signal string, row_idx long, t_ms double, x double, y double, z double"


def sessions(seed, n=6, gap=True):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(n):
        start = float(rng.choice([0.0, 1.7e12, 1.7e12 + 333]))
        for signal in ("acc", "gyro"):
            t = start + np.sort(rng.integers(0, 60_000, int(rng.integers(200, 600)))).astype(float)
            if gap and s % 2:
                t = t[(t < start + 20_000) | (t > start + 29_500)]
            t = np.concatenate([t, t[5:9]])  # duplicates, out of order
            v = rng.normal(size=(len(t), 3))
            rows += [(f"s{s}", signal, i, float(a), *map(float, b)) for i, (a, b) in enumerate(zip(t, v, strict=True))]
    return rows


def model(rows):
    out = {}
    for s, g, _, t, *v in rows:
        out.setdefault((s, g), {}).setdefault(t, v)
    return {k: (np.array(sorted(d)), np.array([d[t] for t in sorted(d)])) for k, d in out.items()}


@pytest.mark.parametrize("chunk", [None, 700.0])
def test_clean_and_resample_match_numpy(spark, chunk):
    rows = sessions(1)
    want = model(rows)
    cleaned = clean.clean_timeline(spark.createDataFrame(rows, RAW))
    assert cleaned.count() == sum(len(t) for t, _ in want.values())
    period = 7.0
    grids = resample.grid(cleaned, period, signals=2)
    got = {}
    for r in resample.resample(cleaned, grids, period, chunk_ms=chunk).collect():
        got.setdefault((r.session_id, r.signal), {})[r.frame_idx] = (r.t_ms, r.x)
    for s in {k[0] for k in want}:
        start, stop = max(want[s, g][0][0] for g in ("acc", "gyro")), min(want[s, g][0][-1] for g in ("acc", "gyro"))
        k = np.arange(int(np.ceil((stop - start) / period)))
        for g in ("acc", "gyro"):
            t, v = want[s, g]
            assert sorted(got[s, g]) == k.tolist()
            assert np.allclose([got[s, g][i][1] for i in k], np.interp(start + k * period, t, v[:, 0]), atol=1e-9)


def test_grid_ends_and_hold(spark):
    rows = [("a", "acc", i, float(t), float(t), 0.0, 0.0) for i, t in enumerate([0, 10, 20, 40])] + [("a", "gyro", i, float(t), 1.0, 0.0, 0.0) for i, t in enumerate([4, 35])]
    cleaned = clean.clean_timeline(spark.createDataFrame(rows, RAW))
    only = cleaned.filter("signal = 'acc'")
    n = {e: resample.grid(only, 10.0, e).first()["n_frames"] for e in ("open", "closed", "tolerance")}
    assert n == {"open": 4, "closed": 5, "tolerance": 5}
    held = resample.resample(cleaned, resample.grid(only, 10.0, "closed"), 10.0, hold=True)
    assert sorted((r.signal, r.frame_idx, r.x) for r in held.collect()) == [("acc", i, 10.0 * i) for i in range(5)] + [("gyro", i, 1.0) for i in range(5)]


def test_bins_match_histogram(spark):
    rows = sessions(2)
    cleaned = clean.clean_timeline(spark.createDataFrame(rows, RAW))
    bins = {(r.session_id, r.signal, r.bin): r.n for r in quality.quality_bins(cleaned, 1000.0, 5).collect()}
    for (s, g), (t, _) in model(rows).items():
        lo, hi = np.floor(t[0] / 1000) * 1000, np.ceil(t[-1] / 1000) * 1000
        counts, _ = np.histogram(t, np.arange(lo, hi + 1000, 1000))
        assert [bins.get((s, g, i), 0) for i in range(len(counts))] == counts.tolist()


def test_segments_need_valid_bins(spark):
    t = [i * 10.0 for i in range(3000) if not 1000 <= i < 1100]
    rows = [("a", g, i, x, x, 1.0, 2.0) for g in ("acc", "gyro") for i, x in enumerate(t)]
    spec = SourceSpec("s", "watch", 100.0, {"acc": 90, "gyro": 90}, 90.0, min_frames=100, modes=(ModeSpec("2s", 200),))
    done = resample_and_segment(spark.createDataFrame(rows, RAW), spec)
    got = sorted(r.seg for r in done.segments.select("seg").collect())
    assert got == [i for i in range(14) if i != 5]
    first = done.segments.filter("number = 1").first()
    assert len(first.acc) == 200 and first.acc[1] == [10.0, 10.0, 1.0, 2.0] and first.acc[0][0] == 0
    assert [json.loads(r.label) for r in done.entries.collect()] == [{}] * 13
    assert done.status.first()["segments"] == 13


def test_padded_tail(spark):
    for frames, want in ((255, []), (383, [128]), (600, [0, 0, 88]), (512, [0, 0])):
        g = spark.createDataFrame([("a", 0.0, frames)], "session_id string, start double, n_frames long")
        cut = segment.candidates(g, (ModeSpec("m", 256, 128),), 1.0)
        pads = sorted((r.seg, r.frames - r.real) for r in cut.collect())
        expected = [max(0, 256 * (i + 1) - frames) for i in range(frames // 256 + (frames % 256 >= 128))]
        assert [p for _, p in pads] == expected, (frames, want)


def test_labelled(spark):
    rows = [("p", i, 10_000 * i, 1.0, 0.0, 0.0, "walk" if i < 1500 else "run") for i in range(3000)] + [("q", i, 10_000 * i + (i > 700), 1.0, 0.0, 0.0, "walk") for i in range(1500)]
    labels = spark.createDataFrame([("walk", "w"), ("run", "r")], "annotation string, activity string")
    done = segment_labelled(spark.createDataFrame(rows, "session_id string, row_idx long, t_us long, x double, y double, z double, annotation string"), labels, watch_100("s"))
    assert sorted((r.mode, r.seg, r.label) for r in done.segments.collect()) == [(m, s, json.dumps({"activity": a, "annotations": [n]}, separators=(",", ":"))) for m in ("1000f", "10s") for s, a, n in ((0, "w", "walk"), (2, "r", "run"))]
    assert {r.session_id: r.reason for r in done.status.collect()} == {"p": None, "q": "irregular step at row 701"}


def test_unit_trim_startup(spark):
    rows = [("a", "acc", i, float(i), 0.0, 0.0, 1.0) for i in range(10)] + [("a", "gyro", i, 3.0 + i, 9.8, 0.0, 0.0) for i in range(10)]
    cleaned = clean.clean_timeline(spark.createDataFrame(rows, RAW))
    assert {r.signal: r.unit for r in clean.infer_unit(cleaned).collect()} == {"acc": "g", "gyro": "m/s2"}
    assert clean.trim_overlap(cleaned, {"acc": 7, "gyro": 7}).agg(F.min("t_ms"), F.max("t_ms"), F.count("*")).first()[:] == (0.0, 6.0, 14)
    assert clean.trim_overlap(cleaned, {"acc": 8, "gyro": 7}).count() == 0
    assert clean.drop_startup(spark.createDataFrame(rows, RAW), 0.005).count() == 10


def test_clock(spark):
    ts = [i * 1250 + (40_000 if i >= 500 else 0) for i in range(1000)]
    rows = spark.createDataFrame([("f", i, t // 20_000 * 20, t) for i, t in enumerate(ts)], "file string, row_idx long, utc long, ts long")
    loss = clock.data_loss(rows, 800).first()
    assert (loss.gaps, loss.lost, loss.max_gap_us) == (1, 33, 41_250)
    frames, fit = clock.frame_utc(rows, skip_sec=0.1)
    got = fit.first()
    anchors = [i for i in range(1, 1000) if ts[i] >= 100_000 and ts[i] // 20_000 != ts[i - 1] // 20_000 and ts[i - 1] >= 100_000]
    b, a = np.polyfit([ts[i] for i in anchors], [ts[i] // 20_000 * 20 for i in anchors], 1)
    assert got.fitted and got.ppm == pytest.approx((b - 0.001) * 1e6, abs=1e-6)
    assert [r.frame_utc for r in frames.orderBy("row_idx").collect()] == pytest.approx([float(np.round(a + b * t)) for t in ts], abs=1)


def test_readers(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/ok.csv").write_text("t,x,extra\n1,2,3\n2,nan,3\n3,4,5\n")
    (tmp_path / "a/bad.csv").write_text("t,x,extra\n1,2,3\n2,oops,3\n")
    (tmp_path / "a/head.csv").write_text("q,x\n1,2\n")
    rows, status = readers.read_csv_strict(spark, f"{tmp_path}/a/*.csv", ["t", "x"])
    assert [(r.row_idx, r.t, r.x) for r in rows.orderBy("row_idx").collect()] == [(0, 1.0, 2.0), (2, 3.0, 4.0)]
    assert {r.path.rsplit("/", 1)[1]: r.reason for r in status.collect()} == {"ok.csv": None, "bad.csv": "unparsable cell", "head.csv": "bad header"}
    rows, status = readers.read_csv_tolerant(spark, f"{tmp_path}/a/bad.csv", ["x", "t"], by_name=True)
    assert [(r.t, r.x) for r in rows.collect()] == [(1.0, 2.0)] and status.first()["dropped"] == 1
    (tmp_path / "b.bin").write_bytes(struct.pack("<QQfff4x", 5, 6, 1, 2, 3) * 2 + b"xx")
    assert readers.read_binary(spark, f"{tmp_path}/b.bin")[1].first()["reason"] is not None
    assert [tuple(r)[1:] for r in readers.read_binary(spark, f"{tmp_path}/b.bin", strict=False)[0].collect()] == [(0, 5, 6, 1.0, 2.0, 3.0), (1, 5, 6, 1.0, 2.0, 3.0)]
    (tmp_path / "c.dat").write_text(" 1 2 3 4\n5 6 7 8 \n")
    assert [(r.t, r.z) for r in readers.read_dat(spark, f"{tmp_path}/c.dat")[0].collect()] == [(1.0, 4.0), (5.0, 8.0)]


def test_manifest_files(spark, tmp_path):
    entry = {"dir": "sources/s/segments/10s/watch/00000001.npz", "src": "s", "device": "watch", "freq": 100.0, "mode": "10s", "num_frames": 1000, "duration_sec": None, "has_timestamp": True, "has_gyro": False, "label": {"a": "é"}}
    folder = tmp_path / "sources/s/manifests"
    folder.mkdir(parents=True)
    short = {k: v for k, v in entry.items() if k != "freq"}
    (folder / "watch_10s.jsonl").write_text("\n".join([json.dumps(entry), "", "{", json.dumps(short), json.dumps(entry | {"label": 3})]) + "\n")
    (folder / "watch_512f.jsonl").write_text(json.dumps(entry))
    checked = manifest.validate_entries(readers.read_source_manifests(spark, str(tmp_path)))
    assert [(r.line_number, r.reason) for r in checked.orderBy("line_number").collect()] == [(1, None), (3, "json decode error"), (4, "missing field freq"), (5, "label is not object")]
    with pytest.raises(ValueError, match="watch_10s.jsonl:3"):
        manifest.require_valid(checked)
    good = manifest.require_valid(checked, True).select(F.from_json("value", "dir string, src string, device string, freq double, mode string, num_frames int, duration_sec double, has_timestamp boolean, has_gyro boolean").alias("e"), "label").select("e.*", "label")
    sinks.write_global_manifests(good, str(tmp_path / "out"))
    assert json.loads(sinks.read_global_manifest(spark, str(tmp_path / "out"), "10s").first()["value"]) == entry


def test_segment_sink_refuses_and_replaces(spark, tmp_path):
    one = spark.createDataFrame([("s", "10s", "watch", 1)], "src string, mode string, device string, number long")
    sinks.write_segments(one, str(tmp_path / "seg"))
    with pytest.raises(FileExistsError):
        sinks.write_segments(one, str(tmp_path / "seg"))
    sinks.write_segments(one.withColumn("number", F.lit(2).cast("long")), str(tmp_path / "seg"), overwrite=True)
    assert [r.number for r in spark.read.parquet(str(tmp_path / "seg")).collect()] == [2]


def test_intermediate_tables_can_go(spark):
    with scratch.recorded() as names:
        one = scratch.cut(spark.range(3), "one")
    two = scratch.cut(spark.range(4), "two")
    assert len(names) == 1 and one.count() == 3
    scratch.clean_up(spark, names)
    assert two.count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(one.inputFiles()[0]).count()


def test_small_things(spark):
    assert ten_seconds(150).frames == 1500 and ring_200("r").signals == ("acc", "gyro") and phone_40("p").hold
    rows = spark.createDataFrame([("a", "acc", float(i)) for i in range(1000)], "session_id string, signal string, t_ms double")
    want = sorted({int(i * 999 / 899) for i in range(900)})
    assert sorted(int(r.t_ms) for r in report.downsample(rows, 900).collect()) == want
    ranges = report.robust_range(spark.createDataFrame([("c", 5.0), ("n", float("nan"))], "k string, v double"), ("k",), "v")
    assert {r.k: (r.lo, r.hi) for r in ranges.collect()} == {"c": (4.5, 5.5), "n": (-1.0, 1.0)}
    bad = spark.createDataFrame([("m", 2, 2, [[1.0, 0.0, 0.0, 0.0]] * 2, None)], "mode string, frames long, real long, acc array<array<float>>, gyro array<array<float>>")
    assert validate.validate_segments(bad, gyro=False).first()["reason"] == "time does not start at 0"
