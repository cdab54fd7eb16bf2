"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches handed to Python hold at most so many rows.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (`spark.checkpoint.dir`).

    Only a local master may run without the setting: driver and tasks are then
    one machine, and a temporary folder is set once for the session.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame) -> DataFrame:
    """`df` written as Parquet in the shared folder and read again.

    Cuts the lineage: a lost executor costs the tasks it ran, never the steps
    before the table. The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):  # nothing reads the job's shuffles again
        df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Jobs run in this block have the setting; the session's own comes back after it."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@contextmanager
def at_least_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Jobs run in this block shuffle to `n` partitions or more: for tables that are many times their input."""
    with setting(spark, "spark.sql.shuffle.partitions", str(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))))):
        yield


@contextmanager
def joined_as_measured(spark: SparkSession) -> Iterator[None]:
    """Jobs run in this block broadcast what a finished shuffle has measured to be small, nothing for its estimated size.

    Spark takes the size of what `mapInArrow` or `explode` makes for that of
    what goes in, so it would bring a table of many rows a row to the driver.
    """
    most = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with setting(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", most), setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        yield


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` with batches that stay small when texts are long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def with_place(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The `columns` of `docs` with a stable row identity (f, r): file and row where it is a Parquet scan, else of a written copy.

    A column of the table's own that is called `_metadata` hides the file's: such a table is written too.
    """
    place = [F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")]
    if "_metadata" not in (c.lower() for c in docs.columns):
        try:
            return docs.select(*place, *columns)
        except AnalysisException:
            pass
    copy = written(docs.select(*columns))
    return copy.select(*place, *copy.columns)
