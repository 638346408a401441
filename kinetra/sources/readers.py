"""Readers of raw recordings, session metadata and manifests.

All take glob paths, so that Spark lists and packs files; each row knows its file by ``path``.  Text files may be of any
size: Spark cuts them into byte ranges, and lines are numbered by counts of the ranges before.  Binary files are read
record range by record range.  A status names every file, those without a single line too.
"""

from __future__ import annotations

from typing import Literal

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.functions.scalars import is_finite, timestamp_micros
from kinetra.operators.scan import scan
from kinetra.scratch import cut, sized
from kinetra.spec import DEVICES, MODES

#: What counts as a number in text files: the forms that both Spark's casts and plain decimal notation know.
NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[nN][aA][nN]|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"


def number(text: Column) -> Column:
    """Double of a decimal text, nan and inf included; null for anything else."""
    t = F.lower(F.trim(text))
    special = F.when(t.rlike("^[+]?inf(inity)?$"), F.lit(float("inf"))).when(t.rlike("^-inf(inity)?$"), F.lit(float("-inf"))).when(t.rlike("^[+-]?nan$"), F.lit(float("nan")))
    return F.when(text.rlike(NUMBER), F.coalesce(special, t.try_cast("double")))


def _path() -> Column:
    """The row's file, spelt as in Spark's list of input files."""
    return F.regexp_replace("_metadata.file_path", "^file:/(?!/)", "file:///")


def files_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length) of files; their contents are not read.

    No source of Spark has rows of files without a byte, so these come from its list of input files, which the driver holds anyway.
    """
    files = spark.read.format("binaryFile").load(paths)
    names = spark.createDataFrame([(x,) for x in files.inputFiles()], "path string")
    return names.join(files.select(_path().alias("path"), "length"), "path", "left").select("path", F.coalesce("length", F.lit(0)).alias("length"))


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line, value) of text files, lines numbered from 1; blank lines count too, an empty file has none.

    A line ends at a line feed, with or without a carriage return before it.  Spark splits large files at line ends, so
    that no task holds more than a range of one.  Ascending ids number the lines inside a range; a first pass counts the
    lines of each, and their sums up to a range number the lines of the file.
    """
    text = spark.read.option("lineSep", "\n").text(paths)
    text = text.select(_path().alias("path"), F.col("_metadata.file_block_start").alias("begin"), "value", F.monotonically_increasing_id().alias("id"))
    ranges = text.groupBy("path", "begin").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id0"))
    before = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)  # a row a range, not a line
    ranges = cut(ranges.select("path", "begin", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("id0")).alias("shift")), "ranges")
    numbered = text.join(sized(ranges), ["path", "begin"])
    return numbered.select("path", (F.col("id") + F.col("shift")).alias("line"), F.regexp_replace("value", r"\r\z", "").alias("value"))


def split_csv(line: Column) -> Column:
    """Cells of a CSV line; a cell in quotes may hold commas, and doubled quotes for one."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"[^,]*|[^,]*)'), F.lit(1))
    bare = lambda c: F.when(c.startswith('"'), F.replace(F.regexp_replace(c, r'^"|"[^"]*$', ""), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.when(F.contains(line, F.lit('"')), F.transform(cells, bare)).otherwise(F.split(line, ",", -1))


def _cells(rows: DataFrame, n: int, separator: str = ",") -> DataFrame:
    parts = split_csv(F.col("value")) if separator == "," else F.split(F.col("value"), separator, -1)
    return rows.withColumn("cells", parts).withColumn("v", F.transform("cells", lambda c: number(c))).withColumn("width", F.size("cells")).withColumn("need", F.lit(n))


def _names(value: Column) -> Column:
    """Names in a header line, without a byte-order mark."""
    return F.transform(split_csv(value), lambda c: F.trim(F.regexp_replace(c, "^﻿", "")))


def _all_finite(columns: list[str]) -> Column:
    keep = F.lit(True)
    for c in columns:
        keep = keep & is_finite(F.col(c))
    return keep


def _starts_with(names: Column, columns: list[str]) -> Column:
    return F.slice(names, 1, len(columns)) == F.array(*map(F.lit, columns))


def _judge(files: DataFrame, per: DataFrame, counts: tuple[str, ...], reasons: list[tuple[Column, str]]) -> DataFrame:
    """(path, counts, reason) of every file, from what its lines gave; the first reason that applies."""
    text = F.coalesce(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(what)) for cond, what in reasons))
    return files.join(per, "path", "left").select("path", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts), text.alias("reason"))


def read_csv_strict(spark: SparkSession, paths: str | list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows (path, row_idx, columns) and a status (path, rows, finite, reason) of each file.

    The header must start with the columns; additional columns must be numbers too and are cut off.  A single
    short row, row of another width than the others or unparsable cell rejects the file; rows with a NaN or infinity only
    drop.  Blank lines are skipped.
    """
    lines = read_lines(spark, paths)
    rows = _cells(lines.filter("line > 1 and value != ''"), len(columns))
    bad = (F.col("width") < len(columns)) | F.exists("v", lambda x: x.isNull())
    values = [F.get("v", i).alias(c) for i, c in enumerate(columns)]
    good = rows.select("path", (F.col("line") - 2).alias("row_idx"), bad.alias("bad"), "width", *values)
    finite = _all_finite(columns)
    per = good.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_or("bad").alias("broken"), F.count_if(finite).alias("finite"), (F.min("width") != F.max("width")).alias("ragged")
    )
    head = lines.filter("line = 1").select("path", _starts_with(_names(F.col("value")), columns).alias("header_ok"))
    status = _judge(files_of(spark, paths), head.join(per, "path", "left"), ("rows", "finite"), [
        (F.col("header_ok").isNull(), "empty file"), (~F.col("header_ok"), "bad header"), (F.col("broken"), "unparsable cell"),
        (F.col("ragged"), "rows of different widths"), (F.col("rows").isNull(), "empty file"), (F.col("finite") == 0, "no finite rows"),
    ])
    status = cut(status, "status")
    kept = good.filter(finite).drop("bad", "width").join(sized(status.filter("reason is null").select("path")), "path", "left_semi")
    return kept, status


def read_csv_tolerant(
    spark: SparkSession, paths: str | list[str], columns: list[str], skip_lines: int = 1, by_name: bool = False, first: int = 0, header: Literal["names", "width"] = "names"
) -> tuple[DataFrame, DataFrame]:
    """As read_csv_strict, but short, unparsable and non-finite rows are dropped and counted (status.dropped).

    skip_lines: header lines, the last of which names the columns; a file without it is empty.  by_name: find the columns by
    name, in any place, a byte-order mark ignored, and skip blank lines; else take them from place first on, and
    drop and count blank lines as short.  Then header tells what the header must hold from the first place on: the columns'
    names, or only as many names as lead to the last of them.
    """
    lines = read_lines(spark, paths)
    head = lines.filter(F.col("line") == skip_lines).select("path", _names(F.col("value")).alias("names"))
    known = F.lit(True)
    for c in columns:
        known = known & F.array_contains("names", c)
    if not by_name:
        known = _starts_with(F.slice("names", first + 1, len(columns)), columns) if header == "names" else F.size("names") >= first + len(columns)
    head = cut(head.withColumn("known", known), "heads")
    body = lines.filter(F.col("line") > skip_lines)
    rows = _cells(body.filter("value != ''") if by_name else body, len(columns)).join(sized(head.filter("known")), "path")
    place = lambda i, c: F.array_position("names", c).cast("int") - 1 if by_name else F.lit(first + i)
    enough = F.col("width") >= (0 if by_name else first + len(columns))
    values = (F.when(enough & (place(i, c) >= 0), F.get("v", place(i, c))).alias(c) for i, c in enumerate(columns))
    good = rows.select("path", (F.col("line") - skip_lines - 1).alias("row_idx"), *values)
    finite = _all_finite(columns)
    per = good.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~finite).alias("dropped"))
    status = _judge(files_of(spark, paths), head.select("path", "known").join(per, "path", "left"), ("rows", "dropped"), [
        (F.col("known").isNull(), "empty file"), (~F.col("known"), "missing columns" if by_name else "bad header"), (F.col("rows").isNull(), "empty file"),
        (F.col("rows") == F.col("dropped"), "no finite rows"),
    ])
    return good.filter(finite), cut(status, "status")


def read_dat(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Four white-space columns t, x, y, z; a ragged or unparsable line, or no line, rejects the file."""
    lines = read_lines(spark, paths).filter(F.trim("value") != "").withColumn("value", F.trim(F.regexp_replace("value", r"\s+", " ")))
    rows = _cells(lines, 4, " ")
    bad = (F.col("width") != 4) | F.exists("v", lambda x: x.isNull())
    names = ["t", "x", "y", "z"]
    good = rows.select("path", (F.col("line") - 1).alias("row_idx"), bad.alias("bad"), *(F.get("v", i).alias(c) for i, c in enumerate(names)))
    finite = _all_finite(names)
    per = good.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.bool_or("bad").alias("broken"), F.count_if(finite).alias("finite"))
    reasons = [(F.col("rows").isNull(), "empty file"), (F.col("broken"), "unparsable cell"), (F.col("finite") == 0, "no finite rows")]
    status = cut(_judge(files_of(spark, paths), per, ("rows", "finite"), reasons), "status")
    return good.filter(finite).drop("bad").join(sized(status.filter("reason is null").select("path")), "path", "left_semi"), status


def read_labelled_csv(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Compressed time, x, y, z, annotation files with exactly that header; any bad row rejects the participant.

    A gz file is one task, read line by line and never whole; rows come in order, so their ids number them.
    Repartition by session afterwards.
    """
    text = spark.read.text(paths).select(_path().alias("path"), "value", F.monotonically_increasing_id().alias("id"))
    first = text.groupBy("path").agg(F.min("id").alias("id0"), F.min_by("value", "id").alias("header"))
    rows = text.join(first, "path").filter("id > id0").withColumn("c", split_csv(F.col("value")))
    parsed = rows.select(
        "path", (F.col("id") - F.col("id0") - 1).alias("row_idx"), timestamp_micros(F.get("c", 0)).alias("t_us"),
        *(number(F.get("c", i + 1)).alias(a) for i, a in enumerate("xyz")), F.trim(F.get("c", 4)).alias("annotation"), (F.size("c") != 5).alias("ragged"),
    )
    bad = F.col("ragged") | F.col("t_us").isNull() | ~is_finite(F.col("x")) | ~is_finite(F.col("y")) | ~is_finite(F.col("z"))
    per = parsed.groupBy("path").agg(F.count(F.lit(1)).alias("rows"), F.min(F.when(F.coalesce(bad, F.lit(True)), F.col("row_idx"))).alias("first_bad_row"))
    named = F.regexp_replace("header", "^﻿", "") == "time,x,y,z,annotation"
    reason = F.when(F.col("header").isNull(), "empty file").when(~named, "bad header").when(F.col("first_bad_row").isNotNull(), "bad row").when(F.col("rows").isNull(), "empty file")
    status = files_of(spark, paths).join(first, "path", "left").join(per, "path", "left").select("path", F.coalesce("rows", F.lit(0)).alias("rows"), "first_bad_row", reason.alias("reason"))
    return parsed.drop("ragged").join(status.filter("reason is null").select("path"), "path", "left_semi"), status


# The little-endian record layouts of binary recordings, as numpy types; pad bytes are named _.
LAYOUTS = {
    "imu": [("utc", "<u8"), ("ts", "<u8"), ("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("_", "V4")],
    "eng": [("utc", "<u8"), ("ts", "<u8"), ("voltage0", "<f4"), ("voltage1", "<f4"), ("voltage2", "<f4"), ("voltage3", "<f4"), ("stat", "<u4"), ("_", "V4")],
    "ppg": [("utc", "<u8"), ("ts", "<u8"), ("ppg0", "<u4"), ("ppg1", "<u4"), ("ppg2", "<u4"), ("ppg3", "<u4"), ("current", "<u4"), ("gain0", "<u2"), ("gain1", "<u2"), ("gain2", "<u2"), ("gain3", "<u2"), ("_", "V4")],
}


def read_binary(spark: SparkSession, paths: str | list[str], layout: str = "imu", strict: bool = True, split_bytes: int = 64 << 20) -> tuple[DataFrame, DataFrame]:
    """Records (path, row_idx, fields) of binary files, and a status of each.

    strict: a size that is no multiple of the record size rejects the file; else a trailing part is ignored.
    Files smaller than a record are empty.  The only Python step of the readers: files are listed without their
    contents, dealt out as ranges of whole records of up to split_bytes, and each task reads its ranges from the store, so that
    many tasks share a large file and none holds more than one range.  From a store that only Spark can read, a file is a row.
    """
    kind = np.dtype(LAYOUTS[layout])
    fields = [n for n in kind.names if n != "_"]
    wide = {"u8": "long", "u4": "long", "u2": "int", "f4": "float"}
    types = [wide[kind.fields[n][0].str[1:]] for n in fields]
    size, most = kind.itemsize, max(1, split_bytes // kind.itemsize)
    files = files_of(spark, paths)
    reason = F.when(F.col("length") < size, "empty file").when(F.lit(strict) & (F.col("length") % size != 0), "size is no multiple of the record")
    status = cut(files.select("path", F.floor(F.col("length") / size).alias("rows"), reason.alias("reason")), "status")
    good = status.filter("reason IS NULL")

    def batch(path: str, first: int, data, count: int):
        import pyarrow as pa

        raw = np.frombuffer(data, dtype=kind, count=count)
        columns = [pa.array([path]).take(pa.array(np.zeros(count, dtype=np.int8))), pa.array(np.arange(first, first + count, dtype=np.int64))]
        columns += [pa.array(raw[n].astype({"long": np.int64, "int": np.int32, "float": np.float32}[t])) for n, t in zip(fields, types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["path", "row_idx", *fields])

    def from_ranges(batches):
        from pyarrow import fs

        for b in batches:
            for path, first, rows in zip(*(b.column(c).to_pylist() for c in ("path", "first", "rows")), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                count = min(most, rows - first)
                with store.open_input_file(name) as f:
                    f.seek(first * size)
                    data = f.read(count * size)
                if len(data) != count * size:
                    raise OSError(f"{path} has become shorter while it was read")
                yield batch(path, first, data, count)

    def from_whole(batches):
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                yield batch(path, 0, content.as_buffer(), len(content.as_buffer()) // size)

    kinds = ", ".join(["path string", "row_idx long", *(f"{n} {t}" for n, t in zip(fields, types, strict=True))])
    if not _has_store(good):
        content = spark.read.format("binaryFile").load(paths).select(_path().alias("path"), "content")
        return content.join(sized(good.select("path")), "path", "left_semi").mapInArrow(from_whole, kinds), status
    firsts = F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(most).cast("long"))
    ranges = cut(good.select("path", F.explode(firsts).alias("first"), "rows"), "ranges")
    tasks = min(max(ranges.count(), 1), 100_000)
    return ranges.repartition(tasks, "path", "first").mapInArrow(from_ranges, kinds), status


def _has_store(files: DataFrame) -> bool:
    """Whether tasks can open these files by themselves; some stores can only be read by Spark."""
    import pyarrow as pa
    from pyarrow import fs

    first = files.select("path").first()
    try:
        return first is None or bool(fs.FileSystem.from_uri(first.path))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def layout_of(path: Column) -> Column:
    """Which layout a file has, by the start of its name; null for other files."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(name.startswith("eng-"), "eng").when(name.startswith("accel-") | name.startswith("gyroscope-"), "imu").when(name.startswith("PPG"), "ppg")


def rate_of(path: Column) -> Column:
    """The sampling rate in a file name such as accel-200hz.csv; null if there is none."""
    return F.regexp_extract(path, r"-(\d+)hz[^/]*$", 1).try_cast("int")


def read_sessions(spark: SparkSession, paths: str | list[str], device: str = "ringDeviceId", finger: str = "ringWearingFinger") -> DataFrame:
    """(path, device_id, finger_raw) of one JSON object a file; null where a key is absent or the text is no JSON."""
    text = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return text.select("path", *(F.get_json_object("value", f"$.{k}").alias(a) for k, a in ((device, "device_id"), (finger, "finger_raw"))))


def read_label_dict(spark: SparkSession, path: str, scheme: str) -> DataFrame:
    """(annotation, activity) of a CSV with a header, trimmed; rows with a blank go, the last of equal keys wins."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"').withColumn("nth", F.monotonically_increasing_id())
    rows = rows.select(F.trim("annotation").alias("annotation"), F.trim(F.col(f"`{scheme}`")).alias("activity"), "nth")
    return rows.filter("annotation != '' and activity != ''").groupBy("annotation").agg(F.max_by("activity", "nth").alias("activity"))


def read_source_manifests(spark: SparkSession, root: str, devices: tuple[str, ...] = DEVICES, modes: tuple[str, ...] = MODES) -> DataFrame:
    """Lines for validate_entries() of all sources/{src}/manifests/{device}_{mode}.jsonl of known devices and modes."""
    lines = read_lines(spark, f"{root}/sources/*/manifests/*.jsonl").withColumnRenamed("line", "line_number")
    part = lambda i: F.regexp_extract("path", r"/sources/([^/]+)/manifests/([^/_]+)_([^/]+)\.jsonl$", i)
    out = lines.select(part(1).alias("path_src"), part(2).alias("path_device"), part(3).alias("path_mode"), F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "line_number", "value")
    return out.filter(F.col("path_device").isin(*devices) & F.col("path_mode").isin(*modes) & (F.trim("value") != "")).withColumn("file", F.concat_ws("/", "path_src", "name")).drop("name")


def discover(files: DataFrame, required: list[str]) -> DataFrame:
    """(session_id, complete) of a listing (session_id, name): whether a session has all required files."""
    have = files.groupBy("session_id").agg(F.collect_set("name").alias("names"))
    return have.select("session_id", (F.size(F.array_except(F.array(*map(F.lit, required)), "names")) == 0).alias("complete"))


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, session_id, name, length) of files; their folder is the session.  Contents are not read."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    parts = F.split("path", "/")
    return files.select("path", F.element_at(parts, -2).alias("session_id"), F.element_at(parts, -1).alias("name"), "length")


def select_inputs(files: DataFrame, order: list[Column], limit: int | None = None, **allowed: list) -> DataFrame:
    """Files whose columns hold allowed values (an empty list allows all), the first so many in order."""
    out = files
    for c, values in allowed.items():
        if values:
            out = out.filter(F.col(c).isin(*values))
    out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def pair_signals(acc: DataFrame, gyro: DataFrame, key: str = "key") -> DataFrame:
    """Keys that both file sets have, with both paths, sorted."""
    return acc.select(key, F.col("path").alias("acc_path")).join(gyro.select(key, F.col("path").alias("gyro_path")), key).orderBy(key)


def pair_counts(acc: DataFrame, gyro: DataFrame, key: str = "key") -> DataFrame:
    """Counts of files of either kind, of pairs, and of keys only one has."""
    both = acc.select(key, F.lit(1).alias("a")).join(gyro.select(key, F.lit(1).alias("g")), key, "full_outer")
    return both.agg(
        F.count("a").alias("acc"), F.count("g").alias("gyro"), F.count(F.col("a") + F.col("g")).alias("paired"),
        F.count_if(F.col("g").isNull()).alias("acc_only"), F.count_if(F.col("a").isNull()).alias("gyro_only"),
    )


def limit_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows of each session in file order."""
    return rows.filter(F.col("row_idx") < n)


def number_rows(rows: DataFrame, order: str, key: str = "session_id") -> DataFrame:
    """pos from 0 in each session by an order column."""
    return scan(rows, (key,), order, (order,)).drop("before").withColumnRenamed("nth", "pos")
