"""The given tables as signals, labels, manifests and clocks, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR, DAY = 3_600_000.0, 86_400_000.0
#: Fewest rows a day, about half of what a signal has on average in the middle-sized tables.
LEAST = {"acc": 6.0, "gyro": 4.0}
ACTIVITIES = {"click": "active", "view": "active", "signup": "rare", "purchase": "rare"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as two signals of twenty sessions."""
    e = table(spark, sf_dir, "events")
    return e.select(
        (F.col("user_id") % 20).alias("session_id"), F.when(F.col("event_type").isin("click", "view", "signup"), "acc").otherwise("gyro").alias("signal"),
        F.col("event_id").alias("row_idx"), (micros("ts") / 1000.0).alias("t_ms"), F.col("value").alias("x"),
        F.get_json_object("props", "$.k").cast("double").alias("y"), F.col("user_id").cast("double").alias("z"),
    )


RAW_SQL = """raw AS (SELECT user_id % 20 AS session_id, CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'acc' ELSE 'gyro' END AS signal, event_id AS row_idx,
  epoch_us(ts) / 1000.0 AS t_ms, value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y, CAST(user_id AS DOUBLE) AS z FROM events)"""
CLEAN_SQL = RAW_SQL + ", clean AS (SELECT session_id, signal, t_ms, arg_min(x, row_idx) AS x, arg_min(y, row_idx) AS y, arg_min(z, row_idx) AS z FROM raw GROUP BY ALL)"


#: 100,000 orders in row numbers of raw_dup.
DUP_WIDTH = float(100_000 * 8 * 8192 * 256)


def raw_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as one signal for each supplier, with many rows on one day.

    row_idx packs order, line, quantity, discount and tax into one number that sorts as they do.
    """
    item = table(spark, sf_dir, "lineitem")
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    place = (((F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber")) * 8192 + cents("l_quantity")) * 16 + cents("l_discount")) * 16 + cents("l_tax")
    return item.select(
        F.col("l_suppkey").alias("session_id"), F.lit("acc").alias("signal"), place.alias("row_idx"),
        (micros("l_shipdate") / 1000.0).alias("t_ms"), F.col("l_quantity").alias("x"), F.col("l_discount").alias("y"), F.col("l_tax").alias("z"),
    )


DUP_SQL = """raw AS (SELECT l_suppkey AS session_id, 'acc' AS signal, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_quantity, l_discount, l_tax) AS row_idx,
  epoch_us(l_shipdate) / 1000.0 AS t_ms, l_quantity AS x, l_discount AS y, l_tax AS z FROM lineitem)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events of each user as annotated rows."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("session_id"), F.col("event_id").alias("row_idx"), micros("ts").alias("t_us"), F.col("event_type").alias("annotation"), "value")


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities of the event types that have one; the types are read from the table."""
    from kinetra.functions.scalars import choose

    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("annotation")).distinct()
    return kinds.withColumn("activity", choose(ACTIVITIES, F.col("annotation"))).filter("activity is not null")


DICT_SQL = "dict AS (SELECT * FROM (VALUES ('click', 'active'), ('view', 'active'), ('signup', 'rare'), ('purchase', 'rare')) t(annotation, activity))"


def _pick(*names: str):
    return lambda key: F.element_at(F.array(*map(F.lit, names)), (key % len(names) + 1).cast("int"))


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as manifest lines, with faults put in by order key."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    device, mode = _pick("phone", "watch", "ring", "other")(k), _pick("10s", "1000f")(F.floor(k / 4))
    src = F.concat(F.lit("s"), (F.col("o_custkey") % 5).cast("string"))
    fault = k % 41
    dir_ = F.format_string("sources/%s/segments/%s/%s/%08d.npz", src, mode, device, k)
    dir_ = F.when(fault == 1, F.concat(F.lit("/"), dir_)).when(fault == 2, F.concat(F.lit("x"), dir_)).otherwise(dir_)
    entry = F.concat(
        F.lit('{"dir":"'), dir_, F.lit('","src":"'), F.when(fault == 3, F.lit("zz")).otherwise(src), F.lit('","device":"'), F.when(fault == 4, F.lit("hat")).otherwise(device),
        F.lit('","freq":100.0,"mode":"'), F.when(fault == 5, F.lit("5s")).otherwise(mode), F.lit('","num_frames":1000,'), F.when(fault == 6, F.lit("")).otherwise(F.lit('"duration_sec":null,')),
        F.lit('"has_timestamp":true,"has_gyro":false,"label":'), F.when(fault == 7, F.lit("[]")).otherwise(F.concat(F.lit('{"activity":"'), F.col("o_orderpriority"), F.lit('"}'))), F.lit("}"),
    )
    value = F.when(fault == 8, F.lit("{broken")).when(fault == 9, F.lit("[1]")).otherwise(entry)
    return o.select(src.alias("path_src"), device.alias("path_device"), mode.alias("path_mode"), F.concat_ws("/", src, F.concat_ws("_", device, mode)).alias("file"), k.alias("line_number"), value.alias("value"))


LINES_SQL = """k AS (SELECT o_orderkey AS line_number, 's' || (o_custkey % 5) AS path_src, ['phone', 'watch', 'ring', 'other'][o_orderkey % 4 + 1] AS path_device,
  ['10s', '1000f'][(o_orderkey // 4) % 2 + 1] AS path_mode, o_orderkey % 41 AS fault, o_orderpriority AS activity FROM orders),
v AS (SELECT *, path_src || '/' || path_device || '_' || path_mode AS file, CASE fault WHEN 1 THEN '/' WHEN 2 THEN 'x' ELSE '' END || printf('sources/%s/segments/%s/%s/%08d.npz', path_src, path_mode, path_device, line_number) AS dir,
  CASE WHEN fault = 3 THEN 'zz' ELSE path_src END AS src, CASE WHEN fault = 4 THEN 'hat' ELSE path_device END AS device, CASE WHEN fault = 5 THEN '5s' ELSE path_mode END AS mode FROM k),
checked AS (SELECT *, CASE fault WHEN 8 THEN 'json decode error' WHEN 9 THEN 'not an object' WHEN 6 THEN 'missing field duration_sec' WHEN 3 THEN 'src mismatch: zz != ' || path_src
  WHEN 4 THEN 'device mismatch at ' || file || ':' || line_number WHEN 5 THEN 'mode mismatch at ' || file || ':' || line_number WHEN 7 THEN 'label is not object'
  WHEN 1 THEN 'dir is absolute' WHEN 2 THEN 'dir does not match src/mode/device: ' || dir END AS reason FROM v)"""


def clock_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as twenty device clocks whose host time jumps once a second."""
    e = table(spark, sf_dir, "events")
    t = micros("ts")
    return e.select((F.col("user_id") % 20).alias("file"), F.col("event_id").alias("row_idx"), (F.floor(t / 1000000) * 1000).alias("utc"), t.alias("ts"))


CLOCK_SQL = "clock AS (SELECT user_id % 20 AS file, event_id AS row_idx, epoch_us(ts) // 1000000 * 1000 AS utc, epoch_us(ts) AS ts FROM events)"
