"""A job for each kind of source: from its files to numbered segments, manifest entries and a summary of the run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.functions.scalars import degrees_to_si, g_to_si, micros_to_ms, seconds_to_ms, ticks_to_ms
from kinetra.operators.clean import clean_timeline, finite_rows, infer_unit, relative_ms, to_si
from kinetra.operators.report import run_summary
from kinetra.plans.jobs import Result, resample_and_segment, segment_labelled
from kinetra.scratch import cut, sized
from kinetra.sources import readers
from kinetra.spec import G, SourceSpec

XYZ = ("x", "y", "z")


@dataclass
class SourceResult:
    """What a job makes: a Result, and the readers' status of files (session_id, signal, path, rows, dropped, reason)."""

    result: Result
    files: DataFrame

    def summary(self) -> DataFrame:
        return run_summary(self.result.status, self.files)


def _part(i: int) -> Column:
    """A part of the path, counted from its end."""
    return F.element_at(F.split("path", "/"), i)


def _files(status: DataFrame, session: Column, signal: str) -> DataFrame:
    dropped = F.col("dropped") if "dropped" in status.columns else F.lit(0).cast("long")
    return status.select(session.alias("session_id"), F.lit(signal).alias("signal"), "path", "rows", dropped.alias("dropped"), "reason")


def _signal(rows: DataFrame, session: Column, signal: str, t_ms: Column, *xyz: Column) -> DataFrame:
    return rows.select(session.alias("session_id"), F.lit(signal).alias("signal"), "row_idx", t_ms.alias("t_ms"), *(c.alias(n) for c, n in zip(xyz, XYZ, strict=True)))


def _finish(result: Result, files: DataFrame) -> SourceResult:
    """The result with a status for every session that has a file; a rejected file's reason comes before all others."""
    files = cut(files, "files")
    text = F.concat("signal", F.lit(": "), "reason")
    every = files.groupBy("session_id").agg(F.min_by(text, F.when(F.col("reason").isNotNull(), F.col("signal"))).alias("file_reason"))
    none = F.from_json(F.lit("{}"), "map<string,bigint>")
    status = every.join(result.status, "session_id", "left").select(
        "session_id", F.coalesce("file_reason", "reason").alias("reason"), F.coalesce("segments", F.lit(0)).alias("segments"), F.coalesce(F.col("by_mode").cast("map<string,bigint>"), none).alias("by_mode")
    )
    return SourceResult(Result(result.segments, result.entries, status), files)


def _ring(spark: SparkSession, root: str, read) -> tuple[DataFrame, DataFrame]:
    """Raw samples and files of participant/session/ring_imu.csv: clock ticks, both signals in a row."""
    session = F.concat_ws("/", _part(-3), _part(-2))
    names = ["timestamp", "accX", "accY", "accZ", "gyroX", "gyroY", "gyroZ"]
    rows, status = read(spark, f"{root}/*/*/ring_imu.csv", names)
    t = ticks_to_ms(F.col("timestamp"))
    raw = _signal(rows, session, "acc", t, *map(F.col, names[1:4])).unionByName(_signal(rows, session, "gyro", t, *map(F.col, names[4:])))
    return cut(raw, "raw"), _files(status, session, "acc")


def _phone(spark: SparkSession, root: str, read) -> tuple[DataFrame, DataFrame]:
    """Raw samples and files of participant/session/phone_acc.csv and phone_gyro.csv, in ms."""
    session = F.concat_ws("/", _part(-3), _part(-2))
    raw = files = None
    for signal in ("acc", "gyro"):
        rows, status = read(spark, f"{root}/*/*/phone_{signal}.csv", ["timestamp", *XYZ])
        one, own = _signal(rows, session, signal, F.col("timestamp"), *map(F.col, XYZ)), _files(status, session, signal)
        raw, files = (one, own) if raw is None else (raw.unionByName(one), files.unionByName(own))
    return cut(raw, "raw"), files


def _sessions(spark: SparkSession, root: str) -> DataFrame:
    session = F.concat_ws("/", _part(-3), _part(-2))
    return readers.read_sessions(spark, f"{root}/*/*/session.json").withColumn("session_id", session).drop("path")


def ring_job(spark: SparkSession, root: str, spec: SourceSpec) -> SourceResult:
    """participant/session folders with ring_imu.csv and session.json; one bad cell rejects a file."""
    raw, files = _ring(spark, root, readers.read_csv_strict)
    return _finish(resample_and_segment(raw, spec, _sessions(spark, root)), files)


def phone_job(spark: SparkSession, root: str, spec: SourceSpec) -> SourceResult:
    """participant/session folders with phone_acc.csv, phone_gyro.csv and session.json; one bad cell rejects a file."""
    raw, files = _phone(spark, root, readers.read_csv_strict)
    return _finish(resample_and_segment(raw, spec, _sessions(spark, root)), files)


def daily_ring_job(spark: SparkSession, root: str, spec: SourceSpec) -> SourceResult:
    """Day-long recordings, participant/session/ring_imu.csv without session.json: bad rows are dropped and counted, labels constant."""
    raw, files = _ring(spark, root, readers.read_csv_tolerant)
    return _finish(resample_and_segment(raw, spec), files)


def daily_phone_job(spark: SparkSession, root: str, spec: SourceSpec) -> SourceResult:
    """The phone's part of such recordings, phone_acc.csv and phone_gyro.csv; only sessions that have both are taken."""
    paths = [f"{root}/*/*/phone_{s}.csv" for s in ("acc", "gyro")]
    names = readers.files_of(spark, paths).select(F.concat_ws("/", _part(-3), _part(-2)).alias("session_id"), _part(-1).alias("name"))
    complete = cut(readers.discover(names, ["phone_acc.csv", "phone_gyro.csv"]).filter("complete").select("session_id"), "complete")
    raw, files = (df.join(sized(complete), "session_id", "left_semi") for df in _phone(spark, root, readers.read_csv_tolerant))
    return _finish(resample_and_segment(raw, spec), files)


def wearable_job(spark: SparkSession, root: str, folder: str, spec: SourceSpec) -> SourceResult:
    """group/IMU/folder/calibrated_imu_*.csv with named columns; device ms, gyro in degrees a second.

    Groups are numbers and segments are numbered in their order, then by file name.
    """
    session = F.concat_ws("/", _part(-4), F.regexp_replace(_part(-1), r"\.csv$", ""))
    acc, gyro = ([f"{name}_{c}" for c in XYZ] for name in ("accel_with_gravity", "gyro"))
    rows, status = readers.read_csv_tolerant(spark, f"{root}/*/IMU/{folder}/calibrated_imu_*.csv", ["deviceTimestamp", *acc, *gyro], by_name=True)
    t = F.col("deviceTimestamp")
    raw = _signal(rows, session, "acc", t, *map(F.col, acc)).unionByName(_signal(rows, session, "gyro", t, *(degrees_to_si(F.col(c)) for c in gyro)))
    group = F.split_part("session_id", F.lit("/"), F.lit(1)).try_cast("int")
    return _finish(resample_and_segment(cut(raw, "raw"), spec, order=(group,)), _files(status, session, "acc"))


def phone_40_job(spark: SparkSession, acc_root: str, gyro_root: str, spec: SourceSpec, min_rows: dict[str, int] | None = None) -> SourceResult:
    """user/time.m_raw_acc.dat and .m_proc_gyro.dat in seconds; the unit of acc is told by its median magnitude."""
    session = F.concat_ws("/", _part(-2), F.regexp_extract(_part(-1), r"^([^.]+)\.", 1))
    rows, status = readers.read_dat(spark, f"{acc_root}/*/*.m_raw_acc.dat")
    acc = cut(_signal(rows, session, "acc", seconds_to_ms(F.col("t")), *map(F.col, XYZ)), "acc")
    units = cut(infer_unit(clean_timeline(finite_rows(acc))).select("session_id", "unit"), "units")
    factor = F.when(F.col("unit") == "g", F.lit(G)).otherwise(F.lit(1.0))
    known = to_si(acc.join(units.filter("unit IS NOT NULL"), "session_id"), factor).drop("unit")
    files = _files(status, session, "acc").join(units.filter("unit IS NULL").select("session_id", F.lit("unknown acc unit").alias("no_unit")), "session_id", "left")
    files = files.withColumn("reason", F.coalesce("reason", "no_unit")).drop("no_unit")
    rows, status = readers.read_dat(spark, f"{gyro_root}/*/*.m_proc_gyro.dat")
    gyro = _signal(rows, session, "gyro", seconds_to_ms(F.col("t")), *map(F.col, XYZ))
    return _finish(resample_and_segment(cut(known.unionByName(gyro), "raw"), spec, min_rows=min_rows), files.unionByName(_files(status, session, "gyro")))


def watch_job(spark: SparkSession, root: str, spec: SourceSpec, binary: bool = False) -> SourceResult:
    """Session folders with accel-200hz.csv and gyroscope-200hz.csv.

    As text: a line of notes, a header, then host ms, event ms, x, y, z.  As records of 32 bytes: event times in microseconds.
    """
    session = _part(-2)
    raw = files = None
    for signal, name in (("acc", "accel"), ("gyro", "gyroscope")):
        path = f"{root}/*/{name}-*hz.csv"
        if binary:
            rows, status = readers.read_binary(spark, path)
            one = _signal(rows, session, signal, micros_to_ms(F.col("ts")), *(F.col(c).cast("double") for c in XYZ))
        else:
            rows, status = readers.read_csv_tolerant(spark, path, ["t", *XYZ], skip_lines=2, first=1, header="width")
            one = _signal(rows, session, signal, F.col("t"), *map(F.col, XYZ))
        own = _files(status, session, signal)
        raw, files = (one, own) if raw is None else (raw.unionByName(one), files.unionByName(own))
    return _finish(resample_and_segment(cut(raw, "raw"), spec), files)


def labelled_job(spark: SparkSession, root: str, dictionary: str, scheme: str, spec: SourceSpec, min_rows: int = 1000) -> SourceResult:
    """P*.csv.gz with time, x, y, z in g and annotation, used as they are, and a dictionary of annotations."""
    session = F.regexp_replace(_part(-1), r"\.csv\.gz$", "")
    rows, status = readers.read_labelled_csv(spark, f"{root}/P*.csv.gz")
    rows = cut(rows.select(session.alias("session_id"), "row_idx", "t_us", *(g_to_si(F.col(c)).alias(c) for c in XYZ), "annotation"), "raw")
    labels = cut(readers.read_label_dict(spark, dictionary, scheme), "labels")
    return _finish(segment_labelled(relative_ms(rows), labels, spec, min_rows), _files(status, session, "acc"))
