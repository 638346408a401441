"""Jobs from files to segments, for every kind of source against a NumPy model, and the readers' odd cases."""

import gzip
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetra.functions.scalars import timestamp_micros
from kinetra.operators import report, validate
from kinetra.plans import sources
from kinetra.plans.jobs import resample_and_segment
from kinetra.sources import readers, sinks
from kinetra.spec import ModeSpec, daily_phone_200, daily_ring_200, phone_40, phone_200, ring_200, watch_100, watch_200, wearable_150

FINGER = "右手食指"
LOOSE = {"min_bin": {"acc": 5, "gyro": 5}, "min_hz": 5.0, "min_frames": 40, "modes": (ModeSpec("20f", 20),)}


def wave(seed, seconds=6, hz=100):
    """Sorted times in s from 0, with jitter, and six columns."""
    rng = np.random.default_rng(seed)
    t = np.sort(np.concatenate([[0.0], np.arange(1, seconds * hz) / hz + rng.uniform(-0.003, 0.003, seconds * hz - 1)]))
    return t, rng.normal(size=(len(t), 6))


def csv(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *(",".join(map(repr, map(float, r))) for r in rows)]) + "\n")


def check(result, session, model):
    """The segments of a session hold what model gives for each signal: times in ms and values in SI units."""
    got = {}
    for r in result.result.segments.filter(F.col("session_id") == session).collect():
        for s in model:
            got.setdefault(s, {})[r.seg] = np.array(getattr(r, s))
    start = max(t[0] for t, _ in model.values())
    for s, (t, xyz) in model.items():
        assert got[s]
        for seg, points in got[s].items():
            assert np.allclose(points[:, 0], np.arange(len(points)) * PERIOD[0], atol=1e-3)
            at = start + (seg * len(points) + np.arange(len(points))) * PERIOD[0]
            for i in range(3):
                assert np.allclose(points[:, i + 1], np.interp(at, t, xyz[:, i]), atol=1e-4)
    return sorted(got["acc"])


PERIOD = [0.0]


def summary(result):
    return {(r.level, r.key): r.n for r in result.summary().collect()}


def test_ring(spark, tmp_path):
    t, v = wave(1)
    PERIOD[0] = 5.0
    for name, device, finger in (("s1", "ok", FINGER), ("s2", "ok", "left"), ("s3", "ok", FINGER)):
        folder = tmp_path / "p1" / name
        csv(folder / "ring_imu.csv", "timestamp,accX,accY,accZ,gyroX,gyroY,gyroZ" if name != "s3" else "time,accX", np.column_stack([t * 16384, v]))
        (folder / "session.json").write_text(json.dumps({"ringDeviceId": device, "ringWearingFinger": finger}))
    done = sources.ring_job(spark, str(tmp_path), ring_200("r", **LOOSE))
    check(done, "p1/s1", {"acc": (t * 1000, v[:, :3]), "gyro": (t * 1000, v[:, 3:])})
    reasons = {r.session_id: r.reason for r in done.result.status.collect()}
    assert reasons == {"p1/s1": None, "p1/s2": "unknown label: left", "p1/s3": "acc: bad header"}
    assert {json.loads(r.label)["finger"] for r in done.result.entries.collect()} == {"right_index"}
    n = summary(done)
    assert (n["total", "seen"], n["total", "processed"], n["files", "rejected"], n["file reason", "bad header"]) == (3, 1, 1, 1)
    assert n["mode", "20f"] == n["total", "segments"] == done.result.entries.count()


def test_phone(spark, tmp_path):
    t, v = wave(2)
    u, w = wave(3)
    PERIOD[0] = 5.0
    csv(tmp_path / "p/s/phone_acc.csv", "timestamp,x,y,z", np.column_stack([t * 1000, v[:, :3]]))
    csv(tmp_path / "p/s/phone_gyro.csv", "timestamp,x,y,z", np.column_stack([u * 1000 + 40, w[:, :3]]))
    (tmp_path / "p/s/session.json").write_text(json.dumps({"ringWearingFinger": FINGER}))
    done = sources.phone_job(spark, str(tmp_path), phone_200("p", **LOOSE))
    check(done, "p/s", {"acc": (t * 1000, v[:, :3]), "gyro": (u * 1000 + 40, w[:, :3])})


def test_wearable(spark, tmp_path):
    PERIOD[0] = 1000 / 150
    names = "x,deviceTimestamp," + ",".join(f"accel_with_gravity_{c}" for c in "xyz") + "," + ",".join(f"gyro_{c}" for c in "xyz")
    for group in (2, 10):
        t, v = wave(group)
        csv(tmp_path / f"{group}/IMU/IMU_Ring/calibrated_imu_a.csv", "﻿" + names, np.column_stack([t, t * 1000, v]))
    done = sources.wearable_job(spark, str(tmp_path), "IMU_Ring", wearable_150("w", "ring", **LOOSE))
    check(done, "10/calibrated_imu_a", {"acc": (t * 1000, v[:, :3]), "gyro": (t * 1000, v[:, 3:] * np.pi / 180)})
    first = done.result.segments.filter("number = 1").first()
    assert first.session_id == "2/calibrated_imu_a"


def test_phone_40(spark, tmp_path):
    PERIOD[0] = 25.0
    rng = np.random.default_rng(5)
    t = np.arange(0, 20, 1 / 50)
    acc, gyro = rng.normal(size=(len(t), 3)) * 0.05 + [0, 0, 1], rng.normal(size=(len(t), 3))
    for key, scale in (("1", 1.0), ("2", 100.0)):
        for name, x in ((f"acc/u/{key}.m_raw_acc.dat", acc * scale), (f"gyro/u/{key}.m_proc_gyro.dat", gyro)):
            (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / name).write_text("".join(f"{a!r} {b!r} {c!r} {d!r}\n" for a, (b, c, d) in zip(t.tolist(), x.tolist(), strict=True)))
    done = sources.phone_40_job(spark, f"{tmp_path}/acc", f"{tmp_path}/gyro", phone_40("e", modes=(ModeSpec("20f", 20),)))
    check(done, "u/1", {"acc": (t * 1000, acc * 9.80665), "gyro": (t * 1000, gyro)})
    assert {r.session_id: r.reason for r in done.result.status.collect()} == {"u/1": None, "u/2": "acc: unknown acc unit"}


def test_daily_ring(spark, tmp_path):
    PERIOD[0] = 5.0
    t, v = wave(11)
    header = "timestamp,accX,accY,accZ,gyroX,gyroY,gyroZ"
    csv(tmp_path / "p/s1/ring_imu.csv", header, np.column_stack([t * 16384, v]))
    lines = (tmp_path / "p/s1/ring_imu.csv").read_text().splitlines()
    bad = ["1,2", "", "a,1,2,3,4,5,6", "9,nan,2,3,4,5,6"]
    (tmp_path / "p/s1/ring_imu.csv").write_text("\n".join([*lines[:50], *bad, *lines[50:]]) + "\n")
    for name, text in (("s2", "foo,bar\n1,2\n"), ("s3", ""), ("s4", header + "\n1,2\n"), ("s5", "\n".join(lines[:12]) + "\n")):
        (tmp_path / "p" / name).mkdir()
        (tmp_path / "p" / name / "ring_imu.csv").write_text(text)
    done = sources.daily_ring_job(spark, str(tmp_path), daily_ring_200("d", **LOOSE))
    check(done, "p/s1", {"acc": (t * 1000, v[:, :3]), "gyro": (t * 1000, v[:, 3:])})
    assert {r.session_id: r.reason for r in done.result.status.collect()} == {"p/s1": None, "p/s2": "acc: bad header", "p/s3": "acc: empty file", "p/s4": "acc: no finite rows", "p/s5": "too few frames"}
    assert {json.loads(r.label)["finger"] for r in done.result.entries.collect()} == {"right_index"}
    n = summary(done)
    assert (n["files", "seen"], n["files", "rejected"], n["files", "dropped"], n["files", "rows"], n["total", "seen"], n["total", "processed"]) == (5, 3, 5, len(t) + 4 + 1 + 11, 5, 1)


def test_daily_phone(spark, tmp_path):
    PERIOD[0] = 5.0
    t, v = wave(12)
    u, w = wave(13)
    csv(tmp_path / "p/s/phone_acc.csv", "timestamp,x,y,z,more", np.column_stack([t * 1000, v[:, :4]]))
    csv(tmp_path / "p/s/phone_gyro.csv", "timestamp,x,y,z", np.column_stack([u * 1000 + 40, w[:, :3]]))
    csv(tmp_path / "p/half/phone_acc.csv", "timestamp,x,y,z", np.column_stack([t * 1000, v[:, :3]]))
    done = sources.daily_phone_job(spark, str(tmp_path), daily_phone_200("d", **LOOSE))
    check(done, "p/s", {"acc": (t * 1000, v[:, :3]), "gyro": (u * 1000 + 40, w[:, :3])})
    assert [(r.session_id, r.reason) for r in done.result.status.collect()] == [("p/s", None)]
    assert {r.label for r in done.result.entries.collect()} == {'{"finger":"right_index"}'}


RAW = "session_id string, signal string, row_idx long, t_ms double, x double, y double, z double"


def test_gates_of_trimmed_and_started_sessions(spark):
    def signal(session, name, times):
        return [(session, name, i, float(t), 1.0, 2.0, 3.0) for i, t in enumerate(times)]

    rows = signal("apart", "acc", range(0, 1000, 20)) + signal("apart", "gyro", range(5000, 6000, 20))
    rows += signal("few", "acc", [0, 20, 2000]) + signal("few", "gyro", range(0, 2000, 20)) + signal("few gyro", "acc", range(0, 2000, 20)) + signal("few gyro", "gyro", [0, 2000])
    rows += signal("lone", "acc", range(0, 1000, 20)) + signal("good", "acc", range(0, 4000, 20)) + signal("good", "gyro", range(3, 4000, 20))
    rows += signal("single", "acc", [5]) + signal("single", "gyro", range(0, 1000, 20))
    spec = phone_40("e", min_frames=20, modes=(ModeSpec("20f", 20),))
    done = resample_and_segment(spark.createDataFrame(rows, RAW), spec)
    assert {r.session_id: r.reason for r in done.status.collect()} == {
        "apart": "no overlap", "few": "acc: too few overlap rows", "few gyro": "gyro: too few overlap rows", "lone": "gyro: missing", "good": None, "single": "acc: too few unique rows",
    }
    assert "acc: too few overlap rows" not in {r.reason for r in resample_and_segment(spark.createDataFrame(rows, RAW), spec, min_rows={"acc": 2, "gyro": 2}).status.collect()}
    rows = signal("short", "acc", range(0, 3000, 5)) + signal("short", "gyro", range(0, 9000, 5)) + signal("gone", "acc", range(0, 9000, 5)) + signal("gone", "gyro", range(0, 900, 5)) + signal("fine", "acc", range(0, 9000, 5)) + signal("fine", "gyro", range(0, 9000, 5))
    done = resample_and_segment(spark.createDataFrame(rows, RAW), watch_200("x", startup_sec=2.0))
    assert {r.session_id: r.reason for r in done.status.collect()} == {"short": "acc: too short after start-up drop", "gone": "gyro: too short after start-up drop", "fine": None}


@pytest.mark.parametrize("binary", [False, True])
def test_watch(spark, tmp_path, binary):
    PERIOD[0] = 5.0
    t, v = wave(7)
    t, v = np.round(t, 6), v.astype(np.float32).astype(float)
    for name, x in (("accel", v[:, :3]), ("gyroscope", v[:, 3:])):
        path = tmp_path / f"s/{name}-200hz.csv"
        path.parent.mkdir(exist_ok=True)
        if binary:
            path.write_bytes(b"".join(struct.pack("<QQfff4x", 0, round(a * 1e6), *b) for a, b in zip(t, x, strict=True)))
        else:
            rows = [f"0,{a * 1000!r},{b!r},{c!r},{d!r}" for a, (b, c, d) in zip(t.tolist(), x.tolist(), strict=True)]
            path.write_text("\n".join(["notes", "CurrentTimestamp(ms),EventTimestamp(ms),x,y,z", *rows[:9], "0,1", "0,x,1,2,3", *rows[9:]]) + "\n")
    done = sources.watch_job(spark, str(tmp_path), watch_200("x", startup_sec=1.0, **LOOSE), binary)
    late = t >= 1.0
    check(done, "s", {"acc": (t[late] * 1000, v[late, :3]), "gyro": (t[late] * 1000, v[late, 3:])})
    assert summary(done)["files", "dropped"] == (0 if binary else 4)


def test_labelled(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:59:59.99 on this day exists in no clock there
    try:
        times = (np.datetime64("2020-03-08T01:59:50") + np.arange(2000) * np.timedelta64(10, "ms")).astype(str)
        body = [f'{a.replace("T", " ")},0.5,0,1,"sleep, in bed"' for a in times]
        with gzip.open(tmp_path / "P001.csv.gz", "wt") as f:
            f.write("\n".join(["time,x,y,z,annotation", *body]) + "\n")
        with gzip.open(tmp_path / "P002.csv.gz", "wt") as f:
            f.write("time,x,y,z,annotation\n2020-01-01,1,2\n")
        (tmp_path / "d.csv").write_text('annotation,label:S\n"sleep, in bed",sleep\n"sleep, in bed", sleep \nx,\n')
        done = sources.labelled_job(spark, str(tmp_path), f"{tmp_path}/d.csv", "label:S", watch_100("c"))
        got = done.result.segments.collect()
        assert sorted((r.mode, r.seg, r.label) for r in got) == [(m, s, '{"activity":"sleep","annotations":["sleep, in bed"]}') for m in ("1000f", "10s") for s in (0, 1)]
        assert np.allclose(np.array(got[0].acc)[:, 1:], [0.5 * 9.80665, 0, 9.80665], atol=1e-5)
        assert {r.session_id: r.reason for r in done.result.status.collect()} == {"P001": None, "P002": "acc: bad row"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_readers_odd_cases(spark, tmp_path):
    line = 'a,"b, ""c""",,"",d'
    assert spark.createDataFrame([(line,), ("x,y",), ("",)], "v string").select(readers.split_csv(F.col("v")).alias("c")).collect()[0].c == ["a", 'b, "c"', "", "", "d"]
    times = ["2020-03-08 02:30:00.123456", "1969-12-31T23:59:59.5", "junk", None]
    got = [r.t for r in spark.createDataFrame([(i, x) for i, x in enumerate(times)], "i int, v string").orderBy("i").select(timestamp_micros(F.col("v")).alias("t")).collect()]
    assert got == [1583634600123456, -500000, None, None]
    rows = spark.createDataFrame([("a", i) for i in range(9)], "session_id string, row_idx long")
    assert readers.limit_rows(rows, 4).count() == 4
    assert [tuple(r) for r in spark.createDataFrame([("/d/eng-800hz.csv",), ("/d/accel-200hz.csv",), ("/d/PPG1.csv",), ("/d/x.csv",)], "p string").select(readers.layout_of(F.col("p")), readers.rate_of(F.col("p"))).collect()] == [("eng", 800), ("imu", 200), ("ppg", None), (None, None)]
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.bin").write_bytes(b"123")
    assert [(r.session_id, r.name, r.length) for r in readers.list_files(spark, f"{tmp_path}/s/*").collect()] == [("s", "a.bin", 3)]
    (tmp_path / "s/session.json").write_text("{broken")
    assert tuple(readers.read_sessions(spark, f"{tmp_path}/s/session.json").first())[1:] == (None, None)


ENTRY = {"dir": "sources/s/segments/10s/watch/00000001.npz", "src": "s", "device": "watch", "freq": 1.0, "mode": "10s", "num_frames": 10, "duration_sec": 10.0, "has_timestamp": True, "has_gyro": True, "label": '{"activity":"a","annotations":["w"]}'}
POINTS = [[float(i), 1.0, 2.0, 3.0] for i in range(10)]
SHAPE = "dir string, src string, device string, freq double, mode string, num_frames int, duration_sec double, has_timestamp boolean, has_gyro boolean, label string, acc array<array<float>>, gyro array<array<float>>, there boolean"
NAN = [[0.0, float("nan"), 2.0, 3.0], *POINTS[1:]]
LATE = [[1.0, *p[1:]] if i == 0 else p for i, p in enumerate(POINTS)]
FAULTS = {
    "segment missing": {"there": False}, "dir is absolute": {"dir": "/" + ENTRY["dir"]}, "device domain": {"device": "hat"}, "mode domain": {"mode": "5s"},
    "src differs from dir": {"src": "t"}, "mode differs from dir": {"mode": "1000f"}, "device differs from dir": {"device": "ring"}, "acc missing": {"acc": None},
    "gyro missing": {"gyro": None}, "gyro made up": {"has_gyro": False}, "acc frames": {"acc": POINTS[:9]}, "gyro frames": {"gyro": POINTS[:9]},
    "acc columns": {"acc": [p[:3] for p in POINTS]}, "gyro columns": {"gyro": [p[:3] for p in POINTS]}, "acc time starts at 0": {"acc": LATE}, "gyro time starts at 0": {"gyro": LATE},
    "acc time not all 0": {"has_timestamp": False, "gyro": [[0.0, *p[1:]] for p in POINTS]}, "gyro time not all 0": {"has_timestamp": False, "acc": [[0.0, *p[1:]] for p in POINTS]},
    "acc finite": {"acc": NAN}, "gyro finite": {"gyro": NAN}, "10s frames": {"freq": 2.0}, "1000f frames": {"mode": "1000f", "dir": ENTRY["dir"].replace("10s", "1000f")}, "duration": {"duration_sec": 9.0},
}


def test_every_acceptance_rule_fires_once(spark):
    assert set(FAULTS) == set(validate.acceptance_rules())
    faulty = [(rule, ENTRY | {"acc": POINTS, "gyro": POINTS, "there": True} | fault) for rule, fault in [("none", {}), *FAULTS.items()]]
    rows = spark.createDataFrame([tuple(r[c.split()[0]] for c in SHAPE.split(", ")) + (rule,) for rule, r in faulty], SHAPE + ", fault string")
    rules = validate.acceptance_rules()
    found = rows.withColumns({"found": F.col("there"), "acc": F.when(F.col("there"), F.col("acc")), "gyro": F.when(F.col("there"), F.col("gyro"))})
    broken = found.select("fault", *(F.coalesce(c, F.lit(False)).alias(n) for n, c in rules.items())).collect()
    allowed = {"10s frames": {"duration"}, "1000f frames": set(), "dir is absolute": {"src differs from dir", "mode differs from dir", "device differs from dir"}, "device domain": {"device differs from dir"}, "mode domain": {"mode differs from dir"}, "mode differs from dir": {"1000f frames"}}
    for r in broken:
        fired = {n for n in rules if r[n]}
        want = set() if r.fault == "none" else {r.fault}
        assert want <= fired <= want | allowed.get(r.fault, set()), (r.fault, fired)


def test_every_source_and_segment_rule_fires(spark):
    rules = validate.source_rules("s", "watch", 1.0, ("activity", "annotations"), True)
    faults = {"source": {"src": "t"}, "source device": {"device": "ring"}, "source freq": {"freq": 2.0}, "source timestamp": {"has_timestamp": False}, "source gyro": {"has_gyro": False}, "source label": {"label": '{"activity":"a"}'}}
    assert set(faults) == set(rules)
    plain = ", ".join(SHAPE.split(", ")[:10])
    for rule, fault in faults.items():
        row = spark.createDataFrame([tuple((ENTRY | fault)[c.split()[0]] for c in plain.split(", "))], plain)
        assert [n for n, c in rules.items() if row.select(c.alias("x")).first().x] == [rule]
    shape = "rule string, frames long, real long, acc array<array<float>>, gyro array<array<float>>"
    padded = POINTS[:8] + [[8.0, 0.0, 0.0, 0.0], [9.0, 0.0, 0.0, 0.0]]
    segments = [
        (None, 10, 8, padded, padded), ("acc shape", 10, 10, POINTS[:9], POINTS), ("time does not start at 0", 10, 10, LATE, POINTS), ("acc not finite", 10, 10, NAN, POINTS),
        ("padding not zero", 10, 8, POINTS, padded), ("gyro shape", 10, 10, POINTS, POINTS[:9]), ("gyro time differs", 10, 10, POINTS, LATE), ("gyro not finite", 10, 10, POINTS, NAN),
        ("gyro padding not zero", 10, 8, padded, POINTS), ("period", 10, 10, [[p[0] * (1.5 if i == 9 else 1), *p[1:]] for i, p in enumerate(POINTS)], [[p[0] * (1.5 if i == 9 else 1), *p[1:]] for i, p in enumerate(POINTS)]),
    ]
    got = validate.validate_segments(spark.createDataFrame(segments, shape), period_ms=1.0).collect()
    assert [r.reason for r in got] == [r.rule for r in got]
    labels = spark.createDataFrame([("w", "a"), ("r", "b")], "annotation string, activity string")
    entries = spark.createDataFrame([("1", '{"activity":"a","annotations":["w"]}'), ("2", '{"activity":"a","annotations":["w","r"]}'), ("3", '{"activity":"a","annotations":[]}'), ("4", "{}")], "dir string, label string")
    assert sorted(r.dir for r in validate.label_consistency(entries, labels).collect()) == ["2", "3", "4"]


def test_manifest_outputs(spark, tmp_path):
    plain = ", ".join(SHAPE.split(", ")[:10])
    entries = spark.createDataFrame([tuple(ENTRY[c.split()[0]] for c in plain.split(", "))], plain)
    sinks.write_global_manifests(entries, str(tmp_path / "g"))
    assert len(list((tmp_path / "g/manifests").glob("mode=*/device=*/part-*"))) == 8
    assert sinks.read_global_manifest(spark, str(tmp_path / "g"), "1000f").count() == 0 and sinks.read_global_manifest(spark, str(tmp_path / "g"), "10s", "watch").count() == 1
    assert spark.read.json(str(tmp_path / "g/summary")).filter("level = 'total'").first()["n"] == 1
    sinks.write_manifest(entries, str(tmp_path / "m"))
    assert json.loads(next((tmp_path / "m/src=s/mode=10s/device=watch").glob("part-*")).read_text()) == ENTRY | {"label": json.loads(ENTRY["label"])}
    rows = spark.createDataFrame([("f", 0, 7.0, 1, 2, 1.0, 2.0, 3.0)], "file string, row_idx long, frame_utc double, utc long, ts long, x double, y double, z double")
    sinks.write_parsed(rows, str(tmp_path / "p"), kind="accel")
    assert next((tmp_path / "p/file=f").glob("part-*")).read_text().splitlines()[0] == "FrameUTC,CurrentTimestamp(ms),EventTimestamp(us),acc_x,acc_y,acc_z"


def test_range_of_a_series_with_a_gap(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", 1.0), ("b", None), ("c", 5.0)], "k string, v double")
    assert {r.k: (r.lo, r.hi) for r in report.robust_range(rows, ("k",), "v").collect()} == {"a": (-1.0, 1.0), "b": (-1.0, 1.0), "c": (4.5, 5.5)}
