"""Landing-file scans into RAW rows.

* Delimited files: all columns text, addressed by position, first line of
  each file skipped (a banner line there pushes the real header into the
  data, where the garbage-id filter later drops it), optional `"` quotes,
  null tokens, short rows padded with NULL, long rows cut (A1-A4).
* File discovery: a client prefix plus a case-insensitive regex on the path
  relative to the landing root (A7); a glob on the extension prunes the
  listing first.
* Per-client positional mapping into the shared RAW schema (A9) and lineage
  stamps: client id, source file, one load timestamp per run, position in
  the file (A10).
* XML payload files are cut at `</Transaction>` by the line reader, so a
  large file is split across tasks; JSON documents are read whole, or cut at
  `}` across tasks and put together from their brackets (A5, A6, json_split.py).

The same transformations serve batch reads and Structured Streaming reads
(the streaming loader in `tidemark.streaming` calls them per micro-batch).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C
from tidemark.config import CsvSource, Options, PayloadSource
from tidemark.functions import columns as X
from tidemark.sources.json_split import SEPARATOR, json_records
from tidemark.sources.payload import XML_RECORD_SEPARATOR, xml_records

CORRUPT = "_corrupt_record"
ALL_RAW = {e: [c for c, _ in cols] for e, cols in C.RAW_COLUMNS.items()}


def csv_schema(spec: CsvSource, strict: bool = False) -> T.StructType:
    fields = [T.StructField(f"_c{i}", T.StringType()) for i in range(len(spec.columns))]
    if strict:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def csv_options(strict: bool = False) -> dict:
    opts = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",  # a quote inside is doubled
            "pathGlobFilter": "*.[cC][sS][vV]*", "recursiveFileLookup": "true"}
    if strict:
        opts["columnNameOfCorruptRecord"] = CORRUPT
    return opts


def relative_path(prefix: str) -> F.Column:
    """Path of the file from the client prefix on ('client_a/Customer.csv')."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"({re.escape(prefix)}.*)$", 1)


def with_lineage(df: DataFrame, prefix: str, name_regex: str, position: bool = True) -> DataFrame:
    """Keep the files whose relative path matches `name_regex`, then add the
    source file (relative), split start and row position within the split.

    The path filter is applied right on the scan: it references only file
    metadata, so Spark prunes the non-matching files before reading them
    (it could not if it sat above the non-deterministic row position).
    Streams cannot number rows; they take `position=False` and number each
    micro-batch with `add_position` inside foreachBatch.
    """
    df = df.filter(relative_path(prefix).rlike(name_regex))
    df = df.select("*", relative_path(prefix).alias("_source_file"),
                   F.col("_metadata.file_block_start").alias("_split_start"))
    return add_position(df) if position else df


def add_position(df: DataFrame) -> DataFrame:
    """Increasing within each split (and unique): with `_split_start` it
    orders the rows of a file as they appear in it."""
    return df.withColumn("_row_pos", F.monotonically_increasing_id())


def map_csv_rows(df: DataFrame, spec: CsvSource, run_ts: str, opts: Options = Options()) -> DataFrame:
    """Positional columns + lineage -> RAW rows of `spec.entity`.

    Keeps `_corrupt_record` (short/long rows) when the scan was strict.
    """
    def field(i):
        c = F.col(f"_c{i}")
        if opts.strip_inline_notes:
            c = X.strip_inline_note(c)
        return X.null_tokens(c)

    by_name = {name: field(i) for i, name in enumerate(spec.columns)}
    cols = [F.lit(spec.client_id).alias("client_id")]
    cols += [by_name.get(c, F.lit(None).cast("string")).alias(c) for c in ALL_RAW[spec.entity]]
    cols += [F.col("_source_file"), F.lit(run_ts).cast("timestamp_ntz").alias("_loaded_at"),
             F.col("_split_start"), F.col("_row_pos")]
    if CORRUPT in df.columns:
        cols.append(F.col(CORRUPT))
    return df.select(*cols)


def read_csv_source(spark: SparkSession, landing: str, spec: CsvSource, run_ts: str,
                    opts: Options = Options()) -> DataFrame:
    """Batch scan of one client's files for one entity -> RAW rows."""
    strict = opts.strict_field_count
    df = (spark.read.schema(csv_schema(spec, strict)).options(**csv_options(strict))
          .csv(f"{landing.rstrip('/')}/{spec.prefix}"))
    return map_csv_rows(with_lineage(df, spec.prefix, spec.name_regex), spec, run_ts, opts)


def field_count_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """With a strict scan, rows with a wrong number of fields are rejects."""
    if CORRUPT not in raw.columns:
        return raw, raw.limit(0).withColumn("reject_reason", F.lit(None).cast("string"))
    bad = raw.filter(F.col(CORRUPT).isNotNull()).withColumn("reject_reason", F.lit("field count")).drop(CORRUPT)
    return raw.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


# ---------------------------------------------------------------------------
# Payload files
# ---------------------------------------------------------------------------
def read_payload_text(spark: SparkSession, src: PayloadSource, path: str, stream: bool = False) -> DataFrame:
    """XML: chunks cut at the record end tag (splittable); JSON: one row per
    file; JSON lines ("jsonl"): one document per line (splittable); "jsonarray":
    chunks of documents cut at `}` (splittable).

    (`text()` sets its own wholetext/lineSep, so they are passed to it directly.)
    """
    r = (spark.readStream if stream else spark.read).option("recursiveFileLookup", "true")
    if stream:
        r = r.option("maxFileAge", "36500d")  # late files count, see streaming.loader
    if src.fmt == "xml":
        return r.text(path, lineSep=XML_RECORD_SEPARATOR)
    if src.fmt == "jsonl":
        return r.text(path)
    if src.fmt == "jsonarray":
        return r.text(path, lineSep=SEPARATOR)
    return r.text(path, wholetext=True)


def map_payload_rows(df: DataFrame, src: PayloadSource, run_ts: str) -> DataFrame:
    """Text chunks/documents + lineage -> RAW transaction rows."""
    if src.fmt == "xml":
        df = xml_records(df)
    elif src.fmt == "jsonarray":
        df = json_records(df)
    else:
        df = df.withColumnRenamed("value", "raw_payload")
        if src.fmt == "jsonl":  # blank lines and banner lines carry no document
            df = df.filter(F.trim("raw_payload").startswith("{"))
    return df.select(F.lit(src.client_id).alias("client_id"), "raw_payload", "_source_file",
                     F.lit(run_ts).cast("timestamp_ntz").alias("_loaded_at"), "_split_start", "_row_pos")


def read_payload_source(spark: SparkSession, landing: str, src: PayloadSource, run_ts: str) -> DataFrame:
    df = read_payload_text(spark, src, f"{landing.rstrip('/')}/{src.prefix}")
    return map_payload_rows(with_lineage(df, src.prefix, src.name_regex), src, run_ts)


def read_landing(spark: SparkSession, landing: str, run_ts: str, opts: Options = Options()) -> dict[str, DataFrame]:
    """All configured sources of a landing folder -> RAW DataFrames by entity."""
    out: dict[str, DataFrame] = {}
    for spec in C.CSV_SOURCES:
        df = read_csv_source(spark, landing, spec, run_ts, opts)
        out[spec.entity] = df if spec.entity not in out else out[spec.entity].unionByName(df)
    for src in C.PAYLOAD_SOURCES:
        df = read_payload_source(spark, landing, src, run_ts)
        out["transactions"] = df if "transactions" not in out else out["transactions"].unionByName(df)
    return out


def read_parquet_source(spark: SparkSession, landing: str, entity: str, client_id: str, prefix: str,
                        name_regex: str, run_ts: str, columns: dict[str, str] | None = None,
                        files: list[str] | None = None) -> DataFrame:
    """Parquet landing files -> RAW rows. Columns are mapped by name
    (`columns`: RAW name -> file column, default the same name), cast to text
    like every RAW business column; absent columns become NULL. `files`: only these (e.g. `readable.split_files`)."""
    columns = columns or {}
    df = (spark.read.parquet(*files) if files else
          spark.read.option("recursiveFileLookup", "true").parquet(f"{landing.rstrip('/')}/{prefix}"))
    df = with_lineage(df, prefix, name_regex)
    have = set(df.columns)
    cols = [F.lit(client_id).alias("client_id")]
    for c in ALL_RAW[entity]:
        src = columns.get(c, c)
        cols.append((F.col(src).cast("string") if src in have else F.lit(None).cast("string")).alias(c))
    cols += [F.col("_source_file"), F.lit(run_ts).cast("timestamp_ntz").alias("_loaded_at"),
             F.col("_split_start"), F.col("_row_pos")]
    return df.select(*cols)
