"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidemark",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF, **{"spark.sql.shuffle.partitions": str(shuffle_partitions),
                                 "spark.driver.memory": "8g"})
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: Counter = Counter()  # by session: the blocks that are open, in any thread
_BEFORE: dict = {}
_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside, an action that is over leaves no shuffle files.

    Otherwise they stay on the executors' disks until the driver's JVM happens
    to collect its garbage, so a run of many writes keeps the shuffles of all of
    them. A DataFrame made inside that runs again shuffles again.
    """
    key = spark._jsparkSession.sessionUUID()
    with _LOCK:
        if not _FREEING[key]:
            _BEFORE[key] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _FREEING[key] += 1
    try:
        yield
    finally:
        with _LOCK:
            _FREEING[key] -= 1
            if not _FREEING[key]:
                del _FREEING[key]
                before = _BEFORE.pop(key)
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder that the caller has written and nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The cluster names its shared folder in `spark.checkpoint.dir`; it is read
    from the session. Only with a local master, where driver and tasks are one
    machine, an unset folder is created and registered; elsewhere that is an
    error, as executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return f"{base}/{name or 'run'}-{uuid.uuid4().hex[:12]}"
