"""Publication of segments with their entries, numbers of many sessions, parts of parsed recordings."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinetra.operators import segment
from kinetra.sources import sinks

SEGMENTS = "dir string, src string, mode string, device string, acc array<array<float>>"
ENTRIES = "dir string, src string, mode string, device string, label string"


def made(spark, src, mode="10s", n=3, tag=1.0, less=0):
    rows = [(f"{src}/{mode}/{i}", src, mode, "watch") for i in range(n)]
    segments = spark.createDataFrame([(*r, [[tag, 2.0]]) for r in rows], SEGMENTS)
    return segments, spark.createDataFrame([(*r, "{}") for r in rows[less:]], ENTRIES)


def seen(spark, root, **options):
    tags = {(r.src, r.mode): r.acc[0][0] for r in sinks.read_published(spark, root, **options).collect()}
    dirs = [sorted(r.dir for r in sinks.read_published(spark, root, w, **options).collect()) for w in ("segments", "entries")]
    assert dirs[0] == dirs[1]
    return tags, len(dirs[0])


def test_versions_follow_each_other(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, root)
    first = sinks.publish(*made(spark, "007"), root)
    assert seen(spark, root) == ({("007", "10s"): 1.0}, 3)
    sinks.publish(*made(spark, "b c=d", n=2), root)
    assert seen(spark, root) == ({("007", "10s"): 1.0, ("b c=d", "10s"): 1.0}, 5)
    with pytest.raises(FileExistsError, match="007/10s/watch"):
        sinks.publish(*made(spark, "007", tag=9.0), root)
    sinks.publish(*made(spark, "007", n=1, tag=2.0), root, overwrite=True)
    assert seen(spark, root) == ({("007", "10s"): 2.0, ("b c=d", "10s"): 1.0}, 3)
    assert seen(spark, root, version=first) == ({("007", "10s"): 1.0}, 3)


def test_a_writer_that_stops_leaves_nothing(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/p"
    sinks.publish(*made(spark, "a"), root)
    with pytest.raises(ValueError, match="nothing is published"):
        sinks.publish(*made(spark, "b", less=1), root)
    before = seen(spark, root)
    kept = sinks._store

    class Stops:
        def __init__(self, store):
            self.store = store

        def __getattr__(self, name):
            return getattr(self.store, name)

        def create(self, path, overwrite):
            raise RuntimeError("the driver is lost")

    monkeypatch.setattr(sinks, "_store", lambda s, r: (Stops(kept(s, r)[0]), kept(s, r)[1]))
    with pytest.raises(RuntimeError):
        sinks.publish(*made(spark, "b"), root)
    monkeypatch.undo()
    assert seen(spark, root) == before
    Path(tmp_path / "p/_commits/00000002.json").write_text('{"key": "b/10s/watch", "folder": "staged/x"}\n')  # stopped inside the record
    assert seen(spark, root) == before
    assert sinks.publish(*made(spark, "b"), root) == "00000003.json"
    assert set(seen(spark, root)[0]) == {("a", "10s"), ("b", "10s")}


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/p"
    sinks.publish(*made(spark, "a"), root)
    last = sinks._last_record

    def late(s, r):  # another writer publishes after this one has looked
        held = last(s, r)
        monkeypatch.undo()
        sinks.publish(*made(spark, "b"), root)
        return held

    monkeypatch.setattr(sinks, "_last_record", late)
    with pytest.raises(FileExistsError, match="another writer"):
        sinks.publish(*made(spark, "c"), root)
    assert set(seen(spark, root)[0]) == {("a", "10s"), ("b", "10s")}


@pytest.mark.parametrize("size", [3, 20_000])
def test_numbers_of_many_sessions(spark, monkeypatch, size):
    monkeypatch.setattr(segment, "SESSIONS_A_RANGE", size)
    rng = random.Random(3)
    rows = [(f"s{i:03}", rng.choice([None, 2, 10]), mode, seg) for i in range(90) for mode in ("a", "b") for seg in range(rng.randint(0, 4))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "session_id string, g int, mode string, seg long")
    got = segment.number_segments(df, ("g", "session_id")).collect()
    want = {}
    for mode in ("a", "b"):
        own = sorted((r for r in rows if r[2] == mode), key=lambda r: (r[1] is not None, r[1] or 0, r[0], r[3]))
        want |= {(r[0], mode, r[3]): n + 1 for n, r in enumerate(own)}
    assert {(r.session_id, r.mode, r.seg): r.number for r in got} == want and len(got) == len(want)
    assert segment.number_segments(df.filter(F.lit(False))).count() == 0


def test_parts_of_a_parsed_recording_are_in_order(spark, tmp_path):
    rows = spark.range(3000).selectExpr("concat('f', id % 2) AS file", "id AS row_idx", "CAST(id AS DOUBLE) AS frame_utc", "id AS utc", "id AS ts", "1D AS x", "2D AS y", "3D AS z").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_parsed(rows, str(tmp_path / "p"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for f in (0, 1):
        parts = sorted((tmp_path / f"p/file=f{f}").glob("part-*"))
        lines = [line.split(",")[0] for p in parts for line in p.read_text().splitlines()[1:]]
        assert len(parts) > 1 and lines == [str(i) for i in range(f, 3000, 2)]
