"""Intermediate tables in the folder that all machines of the cluster share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.  Where that is unset, as in tests, an own one of local mode."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all its machines share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-kinetra-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_dir(spark: SparkSession, what: str) -> str:
    """A new place in this application's own folder."""
    return f"{shared_dir(spark)}/kinetra-{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


_RECORDS = threading.local()


@contextmanager
def recorded():
    """A set that gets the names of the tables that this thread writes inside the block."""
    names: set[str] = set()
    _RECORDS.open = [*getattr(_RECORDS, "open", []), names]
    try:
        yield names
    finally:
        _RECORDS.open = [x for x in _RECORDS.open if x is not names]


def cut(df: DataFrame, what: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: later jobs neither repeat its work nor need its lineage."""
    path = new_dir(df.sparkSession, what)
    for names in getattr(_RECORDS, "open", []):
        names.add(path.rsplit("/", 1)[1])
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Up to so many rows of a few columns, some ten MB, are broadcast.
SMALL_ROWS = 400_000


def sized(few: DataFrame) -> DataFrame:
    """A written table of few columns as the right side of a join: broadcast if it is small enough, else shuffled as Spark sees fit."""
    return F.broadcast(few) if few.count() <= SMALL_ROWS else few


def _folder(spark: SparkSession):
    """Hadoop's file system and path of the application's folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(new_dir(spark, "x")).getParent()
    return path.getFileSystem(conf), path


def clean_up(spark: SparkSession, names: set[str] | None = None) -> None:
    """Delete these intermediate tables, or all of the application.  No DataFrame that reads them may be in use."""
    fs, path = _folder(spark)
    for place in [path] if names is None else [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, name) for name in names]:
        fs.delete(place, True)
