"""Writers of segments, manifests and parsed signals, and the training read."""

from __future__ import annotations

import json
import uuid
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinetra.functions.scalars import low_byte
from kinetra.operators.manifest import FIELDS, manifest_summary
from kinetra.scratch import cut
from kinetra.spec import DEVICES, MODES


def write_segments(segments: DataFrame, root: str, overwrite: bool = False) -> None:
    """Segments (src, mode, device, ...) as Parquet by src, mode, device.

    Without overwrite, fails if a partition to write is there; with it, replaces just those partitions.
    Arrays of a segment are one row of a large file, not a file of its own.
    """
    spark = segments.sparkSession
    keys = ["src", "mode", "device"]
    if not overwrite:
        try:
            there = spark.read.parquet(root).select(*keys).distinct()
        except Exception as error:  # nothing written yet
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            there = None
        if there is not None and not there.join(segments.select(*keys).distinct(), keys, "left_semi").isEmpty():
            raise FileExistsError(f"{root} already has segments of this source, mode and device")
    writer = segments.write.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite" if overwrite else "append").parquet(root)


def to_lines(entries: DataFrame) -> DataFrame:
    """Compact JSON lines with nulls kept; label is JSON text and becomes an object, other columns follow the ten."""
    label = F.coalesce(F.col("label"), F.lit("{}"))
    others = [c for c in FIELDS if c != "label"]
    head = F.to_json(F.struct(*others), {"ignoreNullFields": "false"})
    more = [c for c in entries.columns if c not in FIELDS]
    tail = F.concat(F.lit(","), F.substring(F.to_json(F.struct(*more), {"ignoreNullFields": "false"}), 2, 1 << 30)) if more else F.lit("}")
    return entries.select(F.concat(F.regexp_replace(head, r"\}\z", ""), F.lit(',"label":'), label, tail).alias("value"), "src", "mode", "device")


def write_manifest(entries: DataFrame, root: str) -> None:
    """Source manifests as JSON lines under src, mode, device folders."""
    to_lines(entries).write.partitionBy("src", "mode", "device").mode("overwrite").option("partitionOverwriteMode", "dynamic").text(root)


def write_global_manifests(entries: DataFrame, root: str, devices: tuple[str, ...] = DEVICES, modes: tuple[str, ...] = MODES) -> None:
    """Derived manifests and their summary: lines under manifests by mode and device, summary as JSON lines.

    All of a mode is that mode's folder.  Modes and devices that no entry has get a folder whose file has a blank line only.
    """
    entries = cut(entries, "entries")
    pairs = entries.sparkSession.createDataFrame([(m, d) for m in modes for d in devices], "mode string, device string")
    empty = pairs.join(entries.select("mode", "device").distinct(), ["mode", "device"], "left_anti")
    lines = to_lines(entries).select("value", "mode", "device").unionByName(empty.select(F.lit("").alias("value"), "mode", "device"))
    lines.write.partitionBy("mode", "device").mode("overwrite").text(f"{root}/manifests")
    manifest_summary(entries, devices, modes).coalesce(1).write.mode("overwrite").json(f"{root}/summary")


def read_global_manifest(spark: SparkSession, root: str, mode: str, device: str | None = None) -> DataFrame:
    """Lines of one mode, and of one device if given; other folders are not read."""
    lines = spark.read.text(f"{root}/manifests").filter((F.col("mode") == mode) & (F.col("value") != ""))
    return lines if device is None else lines.filter(F.col("device") == device)


def parsed_columns(layout: str, kind: str = "") -> list:
    """What a parsed signal's CSV holds after FrameUTC, with acc or gyro before the axes' names if the kind says so; the status word is split into its low byte and blanks."""
    base = [F.col("utc").alias("CurrentTimestamp(ms)"), F.col("ts").alias("EventTimestamp(us)")]
    if layout == "eng":
        return [*base, *(F.col(f"voltage{i}") for i in range(4)), low_byte(F.col("stat")).alias("stat0"), *(F.lit(None).cast("string").alias(f"stat{i}") for i in (1, 2, 3))]
    if layout == "ppg":
        return [*base, *map(F.col, ("ppg0", "ppg1", "ppg2", "ppg3", "current", "gain0", "gain1", "gain2", "gain3"))]
    names = {"accel": "acc", "gyroscope": "gyro"}.get(kind, kind)
    return [*base, *(F.col(c).alias(f"{names}_{c}" if names else c) for c in "xyz")]


def write_parsed(rows: DataFrame, root: str, layout: str = "imu", kind: str = "") -> None:
    """Parsed records with their host time (file, row_idx, frame_utc, ...) as CSV, a folder a file, in file order.

    A long recording has several parts, ranges of its rows; in the order of their names they are the recording.
    """
    out = rows.select("file", "row_idx", F.col("frame_utc").cast("long").alias("FrameUTC"), *parsed_columns(layout, kind))
    out = out.repartitionByRange("file", "row_idx").sortWithinPartitions("file", "row_idx").drop("row_idx")
    out.write.partitionBy("file").mode("overwrite").csv(root, header=True)


def training_tensors(entries: DataFrame, segments: DataFrame) -> DataFrame:
    """(dir, tensor): an array [T][6] of acc x, y, z and gyro x, y, z, or [T][3] without gyro, in manifest entries."""
    joined = entries.select("dir").join(segments.select("dir", "acc", "gyro"), "dir")
    xyz = lambda p: F.slice(p, 2, 3)
    six = F.zip_with("acc", "gyro", lambda a, g: F.concat(xyz(a), xyz(g)))
    return joined.select("dir", F.when(F.col("gyro").isNotNull(), six).otherwise(F.transform("acc", xyz)).alias("tensor"))


def _store(spark: SparkSession, root: str):
    """Hadoop's file system of root, and its class of paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, root: str) -> list[str]:
    store, path = _store(spark, root)
    place = path(f"{root}/_commits")
    return sorted(x.getPath().getName() for x in store.listStatus(place)) if store.exists(place) else []


def _record(spark: SparkSession, root: str, version: str) -> dict[str, str] | None:
    """A commit's map from src/mode/device to the staged folder that holds it; None if its writer died before its end mark."""
    held = {r.key: r.folder for r in spark.read.schema("key string, folder string").json(f"{root}/_commits/{version}").collect()}
    return held if held.pop(_END, None) is not None else None


def _last_record(spark: SparkSession, root: str) -> dict[str, str] | None:
    return next((held for v in reversed(_versions(spark, root)) if (held := _record(spark, root, v)) is not None), None)


#: The key of a record's last line.
_END = "end"
_KEYS = ("src", "mode", "device")


def publish(segments: DataFrame, entries: DataFrame, root: str, overwrite: bool = False) -> str:
    """Publish segments and their manifest entries together; returns the version.

    Both are written to a folder of this call's own and read again: every entry must have its segment and every segment its
    entry, once each.  Only then is a commit record created that says which folder holds each source, mode and device, those of
    the version before included.  Readers follow the last whole record, so a writer that dies on its way leaves nothing that
    they see.  A record is created, never replaced: of two writers that began from one version the second fails.  Without
    overwrite, fails too if a source, mode and device to write is there.  A record has a line for each of these, which are few.
    """
    spark = segments.sparkSession
    before, there = _versions(spark, root), _last_record(spark, root) or {}
    folder = f"staged/{uuid.uuid4().hex}"
    written = []
    for df, name in ((segments, "segments"), (entries, "entries")):
        df.write.partitionBy(*_KEYS).parquet(f"{root}/{folder}/{name}")
        written.append(spark.read.schema(df.schema).parquet(f"{root}/{folder}/{name}"))
    both = written[0].select("dir", F.lit(1).alias("s"), F.lit(0).alias("e")).unionByName(written[1].select("dir", F.lit(0).alias("s"), F.lit(1).alias("e")))
    odd = both.groupBy("dir").agg(F.sum("s").alias("s"), F.sum("e").alias("e")).filter("s != 1 OR e != 1").first()
    if odd is not None:
        raise ValueError(f"{odd['dir']} has {odd['s']} segments and {odd['e']} entries; nothing is published")
    new = ["/".join(r) for r in written[1].select(*_KEYS).distinct().collect()]
    if not overwrite and (taken := sorted(set(new) & set(there))):
        raise FileExistsError(f"{root} already has {', '.join(taken)}")
    version = f"{int(before[-1].split('.')[0]) + 1 if before else 1:08d}.json"
    held = [*sorted((there | dict.fromkeys(new, folder)).items()), (_END, "")]
    store, path = _store(spark, root)
    try:
        out = store.create(path(f"{root}/_commits/{version}"), False)
    except Exception as error:
        if "exist" not in str(error).lower():
            raise
        raise FileExistsError(f"another writer has published {version} of {root} meanwhile") from error
    out.write("".join(json.dumps({"key": k, "folder": f}) + "\n" for k, f in held).encode())
    out.close()
    return version


def read_published(spark: SparkSession, root: str, what: Literal["segments", "entries"] = "segments", version: str | None = None) -> DataFrame:
    """The rows of the last version, or of an earlier one; folders that no record names are not looked at."""
    held = _record(spark, root, version) if version else _last_record(spark, root)
    if held is None:
        raise FileNotFoundError(f"nothing is published in {root}" + f" as {version}" * bool(version))
    folders: dict[str, list[str]] = {}
    for key, folder in held.items():
        folders.setdefault(folder, []).append(key)
    out = None
    for folder, keys in folders.items():
        kind = spark.read.parquet(f"{root}/{folder}/{what}").schema
        kind = StructType([StructField(f.name, StringType()) if f.name in _KEYS else f for f in kind.fields])  # not as numbers
        rows = spark.read.schema(kind).parquet(f"{root}/{folder}/{what}").filter(F.concat_ws("/", *_KEYS).isin(keys))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
