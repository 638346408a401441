"""Ordered scans of long series without a task a series.

A series is cut into chunks of its order.  Inside a chunk a window looks back; over chunks a summary (rows, first and last
row) of each merges with those before.  Rows so cross the network once, dealt by series and chunk; the windows
over whole series see one row a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

#: Width of a chunk in units of the order column: row numbers are cut every 100,000 rows.
WIDTH = 100_000


def chunk_of(df: DataFrame, order: str, width: float = WIDTH) -> Column:
    """The chunk a row is in; later rows are never in an earlier one.  An order of several fields is cut by the first."""
    kind = df.schema[order].dataType
    first = F.col(order)[kind.names[0]] if isinstance(kind, StructType) else F.col(order)
    return F.floor(first / F.lit(width))


def _summaries(chunked: DataFrame, keys: tuple[str, ...], order: str, values: tuple[str, ...]) -> DataFrame:
    """(keys, chunk, rows_before, row_before): how many rows earlier chunks of the series have, and the last of them."""
    ends = chunked.groupBy(*keys, "chunk").agg(F.count(F.lit(1)).alias("n"), *(F.max_by(v, order).alias(f"last_{v}") for v in values))
    w = Window.partitionBy(*keys).orderBy("chunk")
    earlier = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = F.lag(F.struct(*(F.col(f"last_{v}").alias(v) for v in values))).over(w)
    return ends.select(*keys, "chunk", earlier.alias("rows_before"), last.alias("row_before"))


def scan(df: DataFrame, keys: tuple[str, ...], order: str, values: tuple[str, ...], width: float = WIDTH) -> DataFrame:
    """df with before, a struct of the values of the row before in its series, null in the first row, and nth from 0.

    order sorts the rows of a series and does not repeat in it.  An empty df gives an empty result; null keys are a series.
    df is read twice, so it should be a table or cheap to make.
    """
    chunked = df.withColumn("chunk", chunk_of(df, order, width))
    summaries = _summaries(chunked, keys, order, values)
    # A row of each chunk's summary stands before the chunk's own rows, so that one window serves both.
    head = summaries.select(*keys, "chunk", F.col("rows_before").alias("at"), F.col("row_before").alias("own"), F.lit(None).cast(df.schema[order].dataType).alias(order))
    own = F.struct(*values).alias("own")
    rows = chunked.withColumn("row", F.struct(*df.columns)).select(*keys, "chunk", F.lit(None).cast("long").alias("at"), own, order, "row")
    w = Window.partitionBy(*keys, "chunk").orderBy(F.col(order).asc_nulls_first())
    both = rows.unionByName(head, allowMissingColumns=True)
    nth = F.max("at").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.row_number().over(w) - 2
    seen = both.select("row", F.lag("own").over(w).alias("before"), nth.alias("nth"), F.col("row").isNotNull().alias("real"))
    return seen.filter("real").select("row.*", "before", "nth")
