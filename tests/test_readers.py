"""Readers of files larger than a task, and a status for every kind of file."""

import random
import struct

import numpy as np
import pytest

from kinetra.sources import readers


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "700")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_lines_of_split_files_are_numbered(spark, tmp_path, small_splits):
    rng = random.Random(1)
    want = {}
    for n, end in enumerate(["\n", "\r\n", ""]):
        lines = ["é" * rng.randint(0, 30) + str(i) * rng.randint(0, 3) for i in range(rng.choice([1, 400]))]
        name = f"a {n}.txt"
        (tmp_path / name).write_bytes((end or "\n").join(lines).encode() + end.encode())
        want |= {(name, i + 1): x for i, x in enumerate(lines)}
    (tmp_path / "blank.txt").write_text("\n\n\nx\n\n")
    want |= {("blank.txt", i + 1): x for i, x in enumerate(["", "", "", "x", ""])}
    (tmp_path / "none.txt").write_text("")
    (tmp_path / "long.txt").write_text("y" * 5000 + "\nz")
    want |= {("long.txt", 1): "y" * 5000, ("long.txt", 2): "z"}
    lines = readers.read_lines(spark, f"{tmp_path}/*.txt")
    got = {(r.path.rsplit("/", 1)[1].replace("%20", " "), r.line): r.value for r in lines.collect()}
    assert got == want and lines.count() == len(want)
    assert lines.rdd.getNumPartitions() > 10


NAMES = ["t", "x"]
FILES = {
    "good.csv": ("t,x\n1,2\n3,4\n", None, None), "empty.csv": ("", "empty file", "empty file"), "header.csv": ("t,x\n", "empty file", "empty file"),
    "other.csv": ("foo,bar\n1,2\n", "bad header", "bad header"), "wider.csv": ("t,x,y\n1,2,3\n4,5,6\n", None, None), "ragged.csv": ("t,x\n1,2\n3,4,5\n", "rows of different widths", None),
    "short.csv": ("t,x\n1,2\n3\n", "unparsable cell", None), "text.csv": ("t,x\n1,2\n3,a\n", "unparsable cell", None), "nan.csv": ("t,x\nnan,2\n", "no finite rows", "no finite rows"),
    "mark.csv": ("﻿t,x\n1,2\n", None, None), "late.csv": ("t,x\n" + "1,2\n" * 500 + "1,b\n", "unparsable cell", None),
}


def status_of(status):
    return {r.path.rsplit("/", 1)[1]: r for r in status.collect()}


def test_every_file_has_a_status(spark, tmp_path, small_splits):
    for name, (text, *_) in FILES.items():
        (tmp_path / name).write_text(text)
    rows, status = readers.read_csv_strict(spark, f"{tmp_path}/*.csv", NAMES)
    got = status_of(status)
    assert {n: r.reason for n, r in got.items()} == {n: strict for n, (_, strict, _) in FILES.items()}
    assert {r.path.rsplit("/", 1)[1] for r in rows.collect()} == {n for n, (_, strict, _) in FILES.items() if strict is None}
    rows, status = readers.read_csv_tolerant(spark, f"{tmp_path}/*.csv", NAMES)
    got = status_of(status)
    assert {n: r.reason for n, r in got.items()} == {n: tolerant for n, (*_, tolerant) in FILES.items()}
    assert (got["late.csv"].rows, got["late.csv"].dropped, got["short.csv"].dropped, got["ragged.csv"].dropped) == (501, 1, 1, 0)
    assert max(r.row_idx for r in rows.collect() if r.path.endswith("late.csv")) == 499


def test_header_gates_and_blank_lines(spark, tmp_path):
    texts = {"a.csv": "notes\nhost,event,x,y,z\n0,1,2,3,4\n\n0,1\n0,5,6,7,8,9\n", "b.csv": "notes\n", "c.csv": "notes\nhost,event,x\n0,1,2,3,4\n", "d.csv": ""}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows, status = readers.read_csv_tolerant(spark, f"{tmp_path}/*.csv", ["t", "x", "y", "z"], skip_lines=2, first=1, header="width")
    got = status_of(status)
    assert {n: (r.rows, r.dropped, r.reason) for n, r in got.items()} == {"a.csv": (4, 2, None), "b.csv": (0, 0, "empty file"), "c.csv": (0, 0, "bad header"), "d.csv": (0, 0, "empty file")}
    assert sorted((r.row_idx, r.t, r.z) for r in rows.collect()) == [(0, 1.0, 4.0), (3, 5.0, 8.0)]
    (tmp_path / "n").mkdir()
    (tmp_path / "n/a.txt").write_text("﻿b,t,x\n\n1,2,3\n4,5\n\n")
    rows, status = readers.read_csv_tolerant(spark, f"{tmp_path}/n/*.txt", NAMES, by_name=True)
    assert [(r.rows, r.dropped, r.reason) for r in status.collect()] == [(2, 1, None)] and [(r.t, r.x) for r in rows.collect()] == [(2.0, 3.0)]
    (tmp_path / "n/b.txt").write_text("t\n1\n")
    assert {r.reason for r in readers.read_csv_tolerant(spark, f"{tmp_path}/n/b.txt", NAMES, by_name=True)[1].collect()} == {"missing columns"}


def test_dat_status(spark, tmp_path, small_splits):
    texts = {"a.dat": "1 2 3 4\n  5\t6 7 8 \n\n" * 200, "b.dat": "", "c.dat": "\n\n", "d.dat": "1 2 3\n", "e.dat": "1 2 3 4\n1 2 3 x\n", "f.dat": "1 2 3 nan\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows, status = readers.read_dat(spark, f"{tmp_path}/*.dat")
    got = status_of(status)
    assert {n: r.reason for n, r in got.items()} == {"a.dat": None, "b.dat": "empty file", "c.dat": "empty file", "d.dat": "unparsable cell", "e.dat": "unparsable cell", "f.dat": "no finite rows"}
    assert sorted(r.row_idx for r in rows.collect()) == [i for i in range(600) if i % 3 != 2]


@pytest.mark.parametrize("whole", [False, True])
def test_records_are_read_in_ranges(spark, tmp_path, monkeypatch, whole):
    n = 1000
    pack = lambda i: struct.pack("<QQfff4x", i, 2 * i, i, -i, 0.5)
    for name, data in (("a b.bin", b"".join(map(pack, range(n)))), ("cut.bin", b"".join(map(pack, range(40))) + b"123"), ("small.bin", b"1"), ("none.bin", b""), ("one.bin", pack(7))):
        (tmp_path / name).write_bytes(data)
    if whole:
        monkeypatch.setattr(readers, "_has_store", lambda files: False)
    rows, status = readers.read_binary(spark, f"{tmp_path}/*.bin", split_bytes=32 * 7 + 5)
    got = {n.replace("%20", " "): (r.rows, r.reason) for n, r in status_of(status).items()}
    assert got == {"a b.bin": (n, None), "cut.bin": (40, "size is no multiple of the record"), "small.bin": (0, "empty file"), "none.bin": (0, "empty file"), "one.bin": (1, None)}
    parts = rows.collect()
    data = {(r.path.rsplit("/", 1)[1].replace("%20", " "), r.row_idx): (r.utc, r.ts, r.x, r.y, r.z) for r in parts}
    assert data == {("a b.bin", i): (i, 2 * i, i, -i, 0.5) for i in range(n)} | {("one.bin", 0): (7, 14, 7, -7, 0.5)} and len(parts) == n + 1
    assert whole or rows.rdd.getNumPartitions() > 100  # ranges of seven records
    loose, _ = readers.read_binary(spark, f"{tmp_path}/*.bin", strict=False, split_bytes=64)
    assert loose.filter("path like '%cut%'").count() == 40
    assert np.isclose(loose.agg({"z": "sum"}).first()[0], (n + 41) / 2)
