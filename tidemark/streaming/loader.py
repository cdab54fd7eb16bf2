"""Load each landing file once (A14) with Structured Streaming.

The reference re-runs a daily copy over a folder whose files are never
purged and relies on the warehouse's load history to skip files it has
seen. Here each (entity, client) source is a file stream with its own
checkpoint, run with `trigger(availableNow=True)`: a run reads exactly the
files that arrived since the previous run, then stops. Each micro-batch is
mapped to RAW rows, split into accepted rows and rejects (widths, NOT NULL,
optionally field counts) and written with `write_batch`, which is
idempotent per batch id, so a replayed batch does not load twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark import config as C
from tidemark.config import CsvSource, Options, PayloadSource
from tidemark.operators.dedup import first_per_key
from tidemark.operators.quarantine import split_payload_rejects, split_rejects
from tidemark.plans.parallel import run_stages
from tidemark.sources import files as FS
from tidemark.sources import readable as R
from tidemark.sources.raw import Catalog, write_batch


def _run(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> int:
    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(int(p.get("numInputRows", 0)) for p in q.recentProgress)


# A file is new if its path was not seen, however old it is: the source's own
# limit (7 days behind the newest file) would drop late files for good.
ANY_AGE = {"maxFileAge": "36500d"}


def _bounded(reader, max_files: int | None):
    """Bound a micro-batch to `max_files` new files (availableNow still drains all)."""
    reader = reader.options(**ANY_AGE)
    return reader.option("maxFilesPerTrigger", str(max_files)) if max_files else reader


def load_csv_once(spark: SparkSession, landing: str, spec: CsvSource, catalog: Catalog, checkpoint_root: str,
                  run_ts: str, opts: Options = Options(), max_files_per_trigger: int | None = None) -> int:
    """New files of one delimited source -> RAW (+ rejects). Returns rows read."""
    strict = opts.strict_field_count
    reader = _bounded(spark.readStream.schema(FS.csv_schema(spec, strict)).options(**FS.csv_options(strict)),
                      max_files_per_trigger)
    key = f"{spec.client_id}_{spec.entity}"
    stream = reader.csv(f"{landing.rstrip('/')}/{spec.prefix}")
    if opts.check_files:
        stream = R.without(stream, R.set_aside(spark, landing, spec.prefix, spec.name_regex, catalog, key, spec.client_id, run_ts))
    scanned = FS.with_lineage(stream, spec.prefix, spec.name_regex, position=False)

    def sink(batch: DataFrame, batch_id: int) -> None:
        # the micro-batch feeds two writes (accepted rows, rejects): keep it
        # for the duration of the batch instead of reading the files twice
        df = FS.map_csv_rows(FS.add_position(batch), spec, run_ts, opts).persist()
        try:
            df, count_bad = FS.field_count_rejects(df)
            good, bad = split_rejects(df, spec.entity) if opts.enforce_widths else (df, None)
            write_batch(good, catalog.path("raw", spec.entity), f"{key}_{batch_id}")
            rejects = count_bad if bad is None else count_bad.unionByName(bad)
            write_batch(rejects, catalog.path("rejects", spec.entity), f"{key}_{batch_id}")
        finally:
            df.unpersist()

    return _run(scanned, f"{checkpoint_root.rstrip('/')}/{key}", sink)


def load_payload_once(spark: SparkSession, landing: str, src: PayloadSource, catalog: Catalog,
                      checkpoint_root: str, run_ts: str, opts: Options = Options()) -> int:
    key = f"{src.client_id}_transactions"
    stream = FS.read_payload_text(spark, src, f"{landing.rstrip('/')}/{src.prefix}", stream=True)
    if opts.check_files:
        stream = R.without(stream, R.set_aside(spark, landing, src.prefix, src.name_regex, catalog, key, src.client_id, run_ts))
    scanned = FS.with_lineage(stream, src.prefix, src.name_regex, position=False)

    def sink(batch: DataFrame, batch_id: int) -> None:
        df = FS.map_payload_rows(FS.add_position(batch), src, run_ts).persist()
        try:
            good, bad = split_payload_rejects(df)
            write_batch(good, catalog.path("raw", "transactions"), f"{key}_{batch_id}")
            write_batch(bad, catalog.path("rejects", "transactions"), f"{key}_{batch_id}")
        finally:
            df.unpersist()

    return _run(scanned, f"{checkpoint_root.rstrip('/')}/{key}", sink)


def load_all_once(spark: SparkSession, landing: str, catalog: Catalog, checkpoint_root: str, run_ts: str,
                  opts: Options = Options(), entities=None, threads: int = 4) -> dict[str, int]:
    """One daily load: every configured source, new files only.

    Entities load concurrently (one thread each); the client sources of one
    entity run one after the other, as they write into the same RAW table.
    Returns rows read per source.
    """
    per_entity: dict[str, list] = {}
    for spec in C.CSV_SOURCES:
        if entities is None or spec.entity in entities:
            per_entity.setdefault(spec.entity, []).append(
                (f"{spec.client_id}_{spec.entity}",
                 lambda spec=spec: load_csv_once(spark, landing, spec, catalog, checkpoint_root, run_ts, opts)))
    for src in C.PAYLOAD_SOURCES:
        if entities is None or "transactions" in entities:
            per_entity.setdefault("transactions", []).append(
                (f"{src.client_id}_transactions",
                 lambda src=src: load_payload_once(spark, landing, src, catalog, checkpoint_root, run_ts, opts)))

    def entity_task(jobs):
        return lambda: {name: job() for name, job in jobs}
    results = run_stages({e: entity_task(j) for e, j in per_entity.items()}, threads=threads)
    return {name: n for part in results.values() for name, n in part.items()}


def merge_stream(stream: DataFrame, checkpoint: str, merge_batch: Callable[[DataFrame, int], None]) -> int:
    """File stream -> foreachBatch merge (A14 + I2): e.g. a VersionedTable upsert."""
    return _run(stream, checkpoint, merge_batch)


#: Keeps the state on local disk and its changes in the checkpoint, so it may outgrow the memory.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def keep_first_stream(stream: DataFrame, keys: Sequence[str], checkpoint: str, merge_batch: Callable[[DataFrame, int], None],
                      order: Sequence[str] = C.ORDER_COLUMNS) -> int:
    """E1, V7 on a stream: the first row per key by `order`, over all micro-batches and runs.

    The state store holds the first row of every key seen (map-side partial
    aggregates, so a hot key sends one row a task). Each micro-batch passes the
    first rows of the keys that it touched to `merge_batch`, an upsert on the
    keys: a replayed file or a re-delivery brings the row that is there already,
    a late row that precedes it replaces it. So the result does not depend on the
    order of arrival and equals `first_per_key` over all rows. The state grows
    with the number of keys, as keys may come back at any time.
    """
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        q = (first_per_key(stream, keys, order).writeStream.outputMode("update").foreachBatch(merge_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return sum(int(p.get("numInputRows", 0)) for p in q.recentProgress)
