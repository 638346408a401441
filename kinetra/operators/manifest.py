"""Manifests: validation of raw lines, derived manifests, summaries, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinetra.spec import DEVICES, MODES

# The fields every entry must have, in the order in which they are looked for.
FIELDS = ("dir", "src", "device", "freq", "mode", "num_frames", "duration_sec", "has_timestamp", "has_gyro", "label")


def validate_entries(lines: DataFrame, devices: tuple[str, ...] = DEVICES, modes: tuple[str, ...] = MODES) -> DataFrame:
    """Raw lines with the entry's fields and, if one applies, the first reason against it.

    lines: path_src, path_device, path_mode, file, line_number, value.  Adds dir, src, device, mode, label (all as text),
    reason_code (few values, to group by) and reason (with the values).  A field counts as present if its key
    is, even with null.  Text that is no JSON, and JSON that is no object, have codes of their own.
    One chain of conditions on each row; nothing is shuffled.
    """
    v = F.try_parse_json("value")
    keys = F.json_object_keys(F.when(v.isNotNull(), F.col("value")))
    parsed = lines.select("*", v.isNull().alias("_broken"), keys.alias("_keys"))
    rows = parsed.select("*", F.json_tuple("value", "dir", "src", "device", "mode", "label").alias("dir", "src", "device", "mode", "label"))
    at = F.concat(F.col("file"), F.lit(":"), F.col("line_number").cast("string"))
    checks: list[tuple[Column, str, Column]] = [
        (F.col("_broken"), "json", F.lit("json decode error")),
        (F.col("_keys").isNull(), "not an object", F.lit("not an object")),
        *((~F.array_contains("_keys", f), "missing field", F.lit(f"missing field {f}")) for f in FIELDS),
        (~F.col("src").eqNullSafe(F.col("path_src")), "src mismatch", F.concat(F.lit("src mismatch: "), F.coalesce("src", F.lit("None")), F.lit(" != "), F.col("path_src"))),
        (~F.col("device").eqNullSafe(F.col("path_device")), "device mismatch", F.concat(F.lit("device mismatch at "), at)),
        (~F.col("mode").eqNullSafe(F.col("path_mode")), "mode mismatch", F.concat(F.lit("mode mismatch at "), at)),
        (~F.coalesce(F.col("device").isin(*devices), F.lit(False)), "invalid device", F.concat(F.lit("invalid device: "), F.coalesce("device", F.lit("None")))),
        (~F.coalesce(F.col("mode").isin(*modes), F.lit(False)), "invalid mode", F.concat(F.lit("invalid mode: "), F.coalesce("mode", F.lit("None")))),
        (F.json_object_keys("label").isNull(), "label", F.lit("label is not object")),
        (F.coalesce(F.startswith(F.col("dir"), F.lit("/")), F.lit(False)), "absolute dir", F.lit("dir is absolute")),
        (~F.coalesce(F.startswith(F.col("dir"), F.concat(F.lit("sources/"), F.col("src"), F.lit("/segments/"), F.col("mode"), F.lit("/"), F.col("device"), F.lit("/"))), F.lit(False)), "dir prefix", F.concat(F.lit("dir does not match src/mode/device: "), F.coalesce("dir", F.lit("None")))),
    ]
    code = F.coalesce(*(F.when(c, F.lit(k)) for c, k, _ in checks))
    reason = F.coalesce(*(F.when(c, r) for c, _, r in checks))
    return rows.select(*lines.columns, "dir", "src", "device", "mode", "label", code.alias("reason_code"), reason.alias("reason"))


def require_valid(validated: DataFrame, skip_invalid: bool = False) -> DataFrame:
    """The valid entries.  Unless told to skip them, an invalid one raises, and nothing has been written then."""
    if not skip_invalid:
        bad = validated.filter(F.col("reason").isNotNull()).orderBy("file", "line_number").first()
        if bad is not None:
            raise ValueError(f"{bad['file']}:{bad['line_number']}: {bad['reason']}")
    return validated.filter(F.col("reason").isNull())


def manifest_summary(entries: DataFrame, devices: tuple[str, ...] = DEVICES, modes: tuple[str, ...] = MODES) -> DataFrame:
    """(level, src, device, mode, n): totals by mode, device, source and their combinations in one aggregation.

    Modes and devices that no entry has count 0; the domains are fixed and small.
    """
    sets = entries.groupingSets([["src", "device", "mode"], ["src", "mode"], ["src"], ["device"], ["mode"], []], "src", "device", "mode")
    counted = sets.agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    names = {0: "src_device_mode", 2: "src_mode", 3: "src", 5: "device", 6: "mode", 7: "total"}
    level = F.coalesce(*(F.when(F.col("g") == g, F.lit(name)) for g, name in names.items()))
    spark = entries.sparkSession
    zero = [("mode", None, None, m, 0) for m in modes] + [("device", None, d, None, 0) for d in devices] + [("total", None, None, None, 0)]
    empty = spark.createDataFrame(zero, "level string, src string, device string, mode string, n long")
    both = counted.select(level.alias("level"), "src", "device", "mode", "n").unionByName(empty)
    return both.groupBy("level", "src", "device", "mode").agg(F.sum("n").alias("n"))


def invalid_summary(validated: DataFrame, examples: int = 50) -> DataFrame:
    """(level, key, n) of invalid lines in total, by source and by reason, and the first examples by file order."""
    bad = validated.filter(F.col("reason").isNotNull())
    sets = bad.groupingSets([["path_src"], ["reason"], []], "path_src", "reason").agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    level = F.when(F.col("g") == 1, "source").when(F.col("g") == 2, "reason").otherwise("total")
    counts = sets.select(level.alias("level"), F.coalesce("path_src", "reason").alias("key"), "n")
    first = bad.orderBy("file", "line_number").limit(examples)
    shown = first.select(F.lit("example").alias("level"), F.concat_ws(":", "file", F.col("line_number").cast("string"), "reason").alias("key"), F.lit(1).cast("long").alias("n"))
    return counts.unionByName(shown)


def global_manifest(entries: DataFrame, device: str | None = None) -> DataFrame:
    """Entries of all sources, or of one device."""
    return entries if device is None else entries.filter(F.col("device") == device)


def manifest_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Entries, with multiplicity, that only one of two manifests has."""
    return a.exceptAll(b).withColumn("side", F.lit("only first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only second")))


def missing_segments(entries: DataFrame, segments: DataFrame) -> DataFrame:
    """Entries whose segment doesn't exist."""
    return entries.join(segments.select("dir"), "dir", "left_anti")


def _seeded(seed: int, key: str) -> Column:
    """A number from md5 of seed and key that other engines can compute as well."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 15), 16, 10).cast("long")


def sample_per_group(df: DataFrame, keys: tuple[str, ...], k: int, seed: int, by: str = "dir") -> DataFrame:
    """k rows of each group, evenly drawn: the least of a seeded hash, the same in every run.

    Spark cuts each task's rows to k a group before the exchange, so a few huge groups don't matter.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(_seeded(seed, by), by))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def sample_per_label(df: DataFrame, k: int, seed: int, label: str = "activity", by: str = "dir") -> DataFrame:
    """k rows of each label, sorted by label and place; rows without a label go."""
    return sample_per_group(df.filter(F.col(label).isNotNull()), (label,), k, seed, by).orderBy(label, by)


def label_counts(entries: DataFrame, field: str) -> DataFrame:
    """(keys, value, n): how often each set of label keys, with each value of one field, occurs."""
    keys = F.array_join(F.array_sort(F.json_object_keys("label")), ",")
    return entries.groupBy(keys.alias("keys"), F.get_json_object("label", f"$.{field}").alias("value")).agg(F.count(F.lit(1)).alias("n"))
