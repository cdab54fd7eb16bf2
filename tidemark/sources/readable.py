"""Files that cannot be read are set aside, the others load.

A cut gzip file, a Parquet file without its footer or a text file in another
encoding fails the task that reads it, and with it the whole load. So new files
are judged before they are loaded, by Spark's own readers: a job reads many files
to their end; if it fails, each half is judged by itself, down to single files. With b bad
files among n this reads at most about log2(b) + 2 times the input and runs some
b * log2(n) jobs more; without a bad file it is one pass. Only file names and
judgements reach the driver. Failures that do not tell of an unreadable file
(lost executors, denied access, a vanished file) are raised; a single file has
failed in every job down to its own, each with Spark's retries.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import _exists
from tidemark.sources.files import relative_path
from tidemark.sources.raw import Catalog, write_batch

UNREADABLE, NOT_UTF8 = "cannot be read", "not UTF-8"
# Names of the errors that Spark's readers give for a damaged file.
DAMAGED = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA")
# Errors of the same readers that say nothing about the file's content.
OTHER = ("FAILED_READ_FILE.FILE_NOT_EXIST", "AccessControlException", "AccessDenied")
JUDGED_SCHEMA = "client_id string, source string, file string, reject_reason string, _loaded_at timestamp_ntz"


def landing_files(spark: SparkSession, landing: str, prefix: str, name_regex: str) -> dict[str, str]:
    """Path by `_metadata.file_path` of the files under the prefix whose relative path matches; contents are not read. Empty files, which no scan opens, are not listed."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{landing.rstrip('/')}/{prefix}")
             .filter(relative_path(prefix).rlike(name_regex)).select(F.col("_metadata.file_path").alias("file"), "path"))
    return {r["file"]: r["path"] for r in found.collect()}


def _read_to_end(spark: SparkSession, files: dict[str, str], fmt: str) -> dict[str, str]:
    """Reads every byte that a load would; returns text files in another encoding, raises if a file is damaged."""
    if fmt == "parquet":
        rows = spark.read.parquet(*files.values())
        rows.select(F.xxhash64(*[F.col(c).cast("string") for c in rows.columns]).alias("h")).agg(F.bit_xor("h")).collect()
        return {}
    lines = spark.read.text(list(files.values())).groupBy(F.col("_metadata.file_path").alias("file"))
    bad = lines.agg(F.bool_and(F.is_valid_utf8("value")).alias("valid")).where("NOT valid").collect()
    return {r["file"]: NOT_UTF8 for r in bad}


def unreadable(spark: SparkSession, files: dict[str, str], fmt: str = "text") -> dict[str, str]:
    """Reason by file, for the files (see `landing_files`) that a load could not read. `fmt`: "text" or "parquet"."""
    if not files:
        return {}
    try:
        return _read_to_end(spark, files, fmt)
    except (PySparkException, Py4JJavaError) as e:
        text = str(e)
        if not any(name in text for name in DAMAGED) or any(name in text for name in OTHER):
            raise
    names = sorted(files)
    if len(names) == 1:
        return {names[0]: UNREADABLE}
    halves = names[:len(names) // 2], names[len(names) // 2:]
    return {k: v for half in halves for k, v in unreadable(spark, {n: files[n] for n in half}, fmt).items()}


def split_files(spark: SparkSession, landing: str, prefix: str, name_regex: str, fmt: str) -> tuple[list[str], dict[str, str]]:
    """(paths that can be read, reason by file of the others), for a scan of all files."""
    files = landing_files(spark, landing, prefix, name_regex)
    bad = unreadable(spark, files, fmt)
    return [p for f, p in sorted(files.items()) if f not in bad], bad


def set_aside(spark: SparkSession, landing: str, prefix: str, name_regex: str, catalog: Catalog, source: str,
              client_id: str, run_ts: str) -> list[str]:
    """Judge the source's files that no earlier run judged; returns all its bad files.

    Judgements are kept in `rejects/files` (no reason: the file is fine). A
    file that arrives after this and is bad fails the load, and the next run sets
    it aside. A mended file must come under a new name, like any new file.
    """
    path = catalog.path("rejects", "files")
    known = {}
    if _exists(spark, path):
        rows = spark.read.schema(f"{JUDGED_SCHEMA}, _batch string").parquet(path).where(F.col("source") == source)
        known = {r["file"]: r["reject_reason"] for r in rows.select("file", "reject_reason").collect()}
    files = landing_files(spark, landing, prefix, name_regex)
    new = {f: p for f, p in files.items() if f not in known}
    if new:
        bad = unreadable(spark, new)
        rows = spark.createDataFrame([(client_id, source, f, bad.get(f)) for f in sorted(new)], "client_id string, source string, file string, reject_reason string")
        write_batch(rows.withColumn("_loaded_at", F.lit(run_ts).cast("timestamp_ntz")), path, f"{source}_{uuid.uuid4().hex}")
        known |= {f: bad.get(f) for f in new}
    return sorted(f for f, reason in known.items() if reason is not None)


def without(scan: DataFrame, bad: list[str]) -> DataFrame:
    """The scan without the bad files; the condition stands on file metadata alone, so they are never opened."""
    return scan.filter(~F.col("_metadata.file_path").isin(bad)) if bad else scan
