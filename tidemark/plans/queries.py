"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Each builds its RAW input from the driver tables (derive.py) and runs the
pipeline over the whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

import os
import threading
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as _C
from tidemark.config import Options
from tidemark.functions import columns as X
from tidemark.operators import checks as K
from tidemark.operators import quarantine as QT
from tidemark.operators.mask import DEFAULT_CUSTOMER_POLICY
from tidemark.operators.mask import mask_pii as _mask
from tidemark.operators.mask import mask_tagged as _mask_tagged
from tidemark.plans import derive, gold, silver
from tidemark.plans import incremental as I
from tidemark.plans.parallel import run_stages
from tidemark.plans.run import LARGEST_FIRST, run_pipeline
from tidemark.sources import drift as DR
from tidemark.sources import files as FS
from tidemark.sources import readable as R
from tidemark.sources.raw import Catalog, write_batch
from tidemark.streaming import loader as L
from tidemark.session import shuffles_freed, work_dir

RAW_ENTITIES = ("customers", "orders", "products", "payments")
INPUTS = (*RAW_ENTITIES, "transactions", "parsed_transactions")
_ROOTS: dict = {}
_DONE: dict = {}
_LOCK = threading.Lock()


def load_inputs(spark: SparkSession, sf: str, tables=INPUTS) -> str:
    """Derive the RAW tables from the driver tables (once per application and
    table) and write them, plus the payloads parsed once, as Parquet
    partitioned by client under the shared work folder. Models then scan
    Parquet with column pruning instead of re-deriving their input. Only the
    tables asked for (and what they depend on) are derived."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf))
    with _LOCK:
        if key not in _ROOTS:
            _ROOTS[key] = work_dir(spark, "raw")
        root = _ROOTS[key]
        done = _DONE.setdefault(key, set())
        want = set(tables) - done
        if "parsed_transactions" in want:
            want.add("transactions")
        want -= done
        if not want:
            return root

        def raw_entity(e):
            return lambda: (derive.raw_table(spark, sf, e).write.mode("overwrite")  # a retry rewrites
                            .option("compression", "zstd").partitionBy("client_id").parquet(f"{root}/{e}"))

        def raw_tx():
            derive.raw_transactions(spark, sf).write.mode("overwrite").option("compression", "zstd").partitionBy(
                "client_id").parquet(f"{root}/transactions")

        def parse():
            silver.parse(spark.read.parquet(f"{root}/transactions")).write.mode("overwrite").option(
                "compression", "zstd").partitionBy("client_id").parquet(f"{root}/parsed_transactions")
        makers = {e: raw_entity(e) for e in RAW_ENTITIES}
        makers.update({"transactions": raw_tx, "parsed_transactions": parse})
        tasks = {t: makers[t] for t in want}
        deps = {"parsed_transactions": {"transactions"} & want}
        with shuffles_freed(spark):
            run_stages(tasks, deps, threads=4)
        done |= want
        return root


def _raw(spark, sf, entity):
    return spark.read.parquet(f"{load_inputs(spark, sf, (entity,))}/{entity}")


def _parsed(spark, sf):
    return spark.read.parquet(f"{load_inputs(spark, sf, ('parsed_transactions',))}/parsed_transactions")


def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stg_customers(_raw(spark, sf, "customers"))


def silver_orders(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stg_orders(_raw(spark, sf, "orders"), silver_customers(spark, sf))


def silver_products(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stg_products(_raw(spark, sf, "products"))


def silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stg_transactions(_parsed(spark, sf))


def silver_items(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stg_transaction_items(_parsed(spark, sf))


def silver_payments(spark: SparkSession, sf: str) -> DataFrame:
    return silver.stg_payments(_raw(spark, sf, "payments"), _parsed(spark, sf))


_SILVER = {
    "customers": silver_customers, "orders": silver_orders, "products": silver_products,
    "transactions": silver_transactions, "transaction_items": silver_items, "payments": silver_payments,
}


def stg(entity):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return silver.public(_SILVER[entity](spark, sf), entity)
    q.__name__ = f"stg_{entity}"
    return q


def mart(entity):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return gold.gold(_SILVER[entity](spark, sf), entity)
    q.__name__ = f"mart_{entity}"
    return q


mart_orders = mart("orders")

QUERIES = {}
for _e in _SILVER:
    QUERIES[f"stg_{_e}"] = stg(_e)
    QUERIES[f"mart_{_e}"] = mart(_e)


# ---------------------------------------------------------------------------
# Quarantine, rejects, checks, freshness, masking, payload parsing, merges
# ---------------------------------------------------------------------------


_QCOLS = ["entity", "client_id", "quarantine_reason", "_source_file", "_loaded_at"]


def quarantine_all(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _parsed(spark, sf)
    cleaned = {
        "customers": silver.clean_customers(_raw(spark, sf, "customers")),
        "orders": silver.clean_orders(_raw(spark, sf, "orders")),
        "products": silver.clean_products(_raw(spark, sf, "products")),
        "transactions": silver.clean_transactions(parsed),
        "transaction_items": silver.clean_items(parsed),
        "payments": silver.clean_payments_csv(_raw(spark, sf, "payments")).unionByName(
            silver.clean_payments_embedded(parsed)),
    }
    out = None
    for e, df in cleaned.items():
        q = QT.quarantine(df, e).select(*_QCOLS)
        out = q if out is None else out.unionByName(q)
    return out


# Strict-load planting for the width checks: inline notes left in place and
# an over-long first name (same SQL in the oracle).
STRICT_PLANT = {
    "is_active": "CASE WHEN _row_pos % 14 = 0 THEN is_active || '   <-- duplicate' ELSE is_active END",
    "first_name": "CASE WHEN _row_pos % 202 = 0 THEN repeat(first_name, 30) ELSE first_name END",
}


def _strict_customers(spark, sf):
    raw = _raw(spark, sf, "customers")
    for c, e in STRICT_PLANT.items():
        raw = raw.withColumn(c, F.expr(e))
    return raw


def raw_width_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = QT.split_rejects(_strict_customers(spark, sf), "customers")
    return bad.select("client_id", "customer_id", "reject_reason", "_source_file", "_loaded_at")


def rejects_and_rows_balance(spark: SparkSession, sf: str) -> DataFrame:
    raw = _strict_customers(spark, sf)
    good, bad = QT.split_rejects(raw, "customers")
    cleaned = silver.clean_customers(good)
    silver_rows = silver.stg_customers(good)
    parts = {
        "raw_rows": raw, "rejected": bad, "silver_rows": silver_rows,
        "quarantined": QT.quarantine(cleaned, "customers"),
        "garbage_rows": QT.garbage_rows(cleaned, "customers"),
    }
    out = None
    for name, df in parts.items():
        c = df.agg(F.count(F.lit(1)).cast("bigint").alias("value")).select(F.lit(name).alias("metric"), "value")
        out = c if out is None else out.unionByName(c)
    return out


def _pipeline(spark, sf):
    raw = {e: _raw(spark, sf, e) for e in (*RAW_ENTITIES, "transactions")}
    return run_pipeline(spark, raw, work_dir(spark, "pipeline"), RUN_TS)


RUN_TS = "2025-01-16 12:00:00"


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return _pipeline(spark, sf)["checks"]


FRESHNESS_RUN_TS = "2024-02-01 00:30:00"


def source_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """T8 over the events table: one source per event type, `ts` as load time."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return K.freshness_by(ev, "event_type", "ts", FRESHNESS_RUN_TS).select(
        "source", "max_loaded_at", "age_seconds", "status")


def mask_pii(spark: SparkSession, sf: str) -> DataFrame:
    g = mart("customers")(spark, sf)
    return _mask(g.select("customer_sk", "client_id", "email", "first_name", "last_name", "full_name"),
                 DEFAULT_CUSTOMER_POLICY)


def mask_tagged(spark: SparkSession, sf: str) -> DataFrame:
    """PO1: the six marts, each written and read again, every tagged column masked by its tag; columns joined with `|` (NULL as `~`)."""
    root, parts = work_dir(spark, "mask_tagged"), []
    for e in LARGEST_FIRST:  # while little else is written; no mart's shuffles stay when it is
        rows = mart(e)(spark, sf)
        with shuffles_freed(spark):
            rows.write.option("compression", "zstd").parquet(f"{root}/{e}")
    for e in _SILVER:
        g = _mask_tagged(spark.read.parquet(f"{root}/{e}"))
        text = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in g.columns if c != "_loaded_at"]
        parts.append(g.select(F.lit(e).alias("entity"), F.concat_ws("|", *text).alias("row_text")))
    return K.union_all(parts)


def payload_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Every path of the JSON payloads, how often it occurs, and whether the typed schema has it."""
    return DR.path_counts(_raw(spark, sf, "transactions"))


def _parse_out(parsed):
    t = F.col("txn")
    return parsed.select(
        "client_id", "_source_file", "_loaded_at",
        *[X.clean_string(t[f]).alias(f) for f in
          ("txn_id", "order_id", "order_date", "customer_id", "first_name", "last_name", "customer_name",
           "email", "payment_method", "amount", "currency", "processing_fee")],
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"))


def parse_json_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _parse_out(_parsed(spark, sf).filter(F.col("fmt") == "json"))


def parse_xml_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _parse_out(_parsed(spark, sf).filter(F.col("fmt") == "xml"))


SPLIT_DATE = "1996-01-01"


def _orders_two_batches(spark, sf):
    raw = _raw(spark, sf, "orders")
    late = F.coalesce(X.to_date(X.clean_string("order_date")) >= F.lit(SPLIT_DATE).cast("date"), F.lit(False))
    second = late | (F.col("_loaded_at") == F.lit(derive.LOAD_2).cast("timestamp_ntz"))
    return raw.withColumn("_loaded_at", F.when(second, F.lit(derive.LOAD_2)).otherwise(
        F.lit(derive.LOAD_1)).cast("timestamp_ntz"))


def _written_customers(spark, sf, root):
    """The SILVER customers that every run looks its orders up in, as the table that a daily run finds."""
    silver_customers(spark, sf).select("client_id", "source_customer_id", "_is_duplicate").write.parquet(f"{root}/customers")
    return spark.read.parquet(f"{root}/customers")


def _merge_orders(spark, sf, latest_batch_wins):
    opts = Options(latest_batch_wins=latest_batch_wins)
    raw = _orders_two_batches(spark, sf)
    root = work_dir(spark, "merge_orders")
    customers = _written_customers(spark, sf, root)
    s, g = I.silver_table(spark, root, "orders"), I.gold_table(spark, root, "orders")

    def build(r):
        return silver.stg_orders(r, customers, opts)
    # run 1: only the first load has arrived; run 2: everything
    first = raw.filter(F.col("_loaded_at") == F.lit(derive.LOAD_1).cast("timestamp_ntz"))
    for arrived in (first, raw):
        I.run_silver(s, arrived, build, "orders", opts)
        I.run_gold(g, s, "orders")
    return g.read()


def incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _merge_orders(spark, sf, True)


def incremental_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return _merge_orders(spark, sf, False)


LOAD_3 = "2025-01-17 02:00:00"


def _orders_three_days(spark, sf):
    """Day 1: orders before SPLIT_DATE; day 2: the others, and every fifth of
    day 1 again; day 3: every seventh of all again. Re-deliveries differ in status."""
    base = _orders_two_batches(spark, sf)
    day1 = F.col("_loaded_at") == F.lit(derive.LOAD_1).cast("timestamp_ntz")

    def again(df, status, ts):
        return (df.withColumn("order_status", F.lit(status)).withColumn("_loaded_at", F.lit(ts).cast("timestamp_ntz"))
                .withColumn("_source_file", F.concat(F.lit("again/"), F.col("_source_file"))))
    second = again(base.filter(day1 & (F.col("_row_pos") % 5 == 0)), "REDELIVERED", derive.LOAD_2)
    third = again(base.filter(F.col("_row_pos") % 7 == 0), "THIRD", LOAD_3)
    return base.unionByName(second).unionByName(third)


def incremental_three_days(spark: SparkSession, sf: str) -> DataFrame:
    """Three daily runs in both modes; GOLD misses day 2, and day 3 is run twice.

    Per mode and key the published order, and how many SILVER rows of the key count (one).
    """
    raw = _orders_three_days(spark, sf)
    customers = _written_customers(spark, sf, work_dir(spark, "three_days"))
    out = None
    for mode, latest in (("latest", True), ("first", False)):
        opts = Options(latest_batch_wins=latest)
        root = work_dir(spark, f"three_days_{mode}")
        s, g = I.silver_table(spark, root, "orders"), I.gold_table(spark, root, "orders")

        def build(r, opts=opts):
            return silver.stg_orders(r, customers, opts)
        for day, publish in ((derive.LOAD_1, True), (derive.LOAD_2, False), (LOAD_3, True), (LOAD_3, True)):
            arrived = raw.filter(F.col("_loaded_at") <= F.lit(day).cast("timestamp_ntz"))
            I.run_silver(s, arrived, build, "orders", opts)
            if publish:
                I.run_gold(g, s, "orders")
        counting = (s.read().filter(~F.col("_is_duplicate")).groupBy("order_sk")
                    .agg(F.count(F.lit(1)).alias("n_counting")))
        rows = g.read().join(counting, "order_sk", "left").withColumn("mode", F.lit(mode))
        out = rows if out is None else out.unionByName(rows)
    return out


def incremental_schema_change(spark: SparkSession, sf: str) -> DataFrame:
    """A column (and the run timestamp, I4) that appears with the second batch reads NULL in the rows of the first."""
    rows = silver_orders(spark, sf)
    late = F.coalesce(F.col("order_date") >= F.lit(SPLIT_DATE).cast("date"), F.lit(False))
    root = work_dir(spark, "schema_change")
    s, g = I.silver_table(spark, root, "orders"), I.gold_table(spark, root, "orders")
    I.merge_silver(s, rows.filter(~late).withColumn("channel", F.lit(None).cast("string")), "orders")
    g.merge(gold.gold(s.changes(0), "orders").drop("channel"), processed=[f"silver:{s.version()}"])  # GOLD before the column came
    changed = rows.filter(late | (F.pmod(F.length("source_order_id"), F.lit(2)) == 0))
    I.merge_silver(s, changed, "orders")
    I.run_gold(g, s, "orders", RUN_TS, Options(add_updated_at=True))
    return g.read()


def schema_type_sync(spark: SparkSession, sf: str) -> DataFrame:
    """A column that arrives as a whole number, then as a decimal, then as text; older rows are cast when they are read."""
    part = spark.read.parquet(f"{sf}/part.parquet").withColumn("key", F.col("p_partkey").cast("bigint"))
    table = I.VersionedTable(spark, work_dir(spark, "type_sync"), ["key"])
    table.merge(part.select("key", F.col("p_size").cast("int").alias("v")))
    table.merge(part.filter("key % 5 = 0").select("key", F.col("p_retailprice").cast("decimal(12,2)").alias("v")))
    table.merge(part.filter("key % 7 = 0").select("key", F.concat(F.lit("x"), F.col("p_size").cast("string")).alias("v")))
    return table.read()


def late_customers(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the customers arrives after the orders were published; only these and orders without a reference meet."""
    root = work_dir(spark, "late_customers")
    raw = _raw(spark, sf, "customers")
    tables = {e: (I.silver_table(spark, root, e), I.gold_table(spark, root, e)) for e in ("customers", "orders")}
    (s_customers, g_customers), (s_orders, g_orders) = tables["customers"], tables["orders"]
    late = F.col("_row_pos") % 3 == 0

    def load(rows, ts):
        I.run_silver(s_customers, rows.withColumn("_loaded_at", F.lit(ts).cast("timestamp_ntz")), silver.stg_customers, "customers")
        I.run_gold(g_customers, s_customers, "customers")
    load(raw.filter(~late), derive.LOAD_1)
    I.run_silver(s_orders, _raw(spark, sf, "orders"), lambda r: silver.stg_orders(r, s_customers.read()), "orders")
    I.run_gold(g_orders, s_orders, "orders")
    before = g_customers.version()
    load(raw.filter(late), derive.LOAD_2)
    I.repair_refs(g_orders, g_customers, before)
    return g_orders.read()


def reload_same_load_time(spark: SparkSession, sf: str) -> DataFrame:
    """A source that is loaded under the load time of a run that is over is read by the next run, once."""
    root = work_dir(spark, "reload")
    cat = Catalog(f"{root}/tables")
    customers = _written_customers(spark, sf, root)
    s, g = I.silver_table(spark, root, "orders"), I.gold_table(spark, root, "orders")
    for client in ("client_a", "client_c", None):
        if client:
            rows = _raw(spark, sf, "orders").filter(F.col("client_id") == client)
            write_batch(rows, cat.path("raw", "orders"), f"{client}_orders_0")
        I.run_silver(s, cat.read(spark, "raw", "orders"), lambda r: silver.stg_orders(r, customers), "orders")
        I.run_gold(g, s, "orders")
    return g.read()


def payload_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """NULL and broken payloads planted by transaction and file number, counted per file and reason."""
    raw = _raw(spark, sf, "transactions")
    xml = F.col("client_id") == F.lit("client_a")
    number = F.regexp_extract("raw_payload", "<TransactionID>[^<0-9]*([0-9]+)", 1).try_cast("bigint")
    group = F.regexp_extract("_source_file", "([0-9]+)[.]json$", 1).try_cast("bigint")
    n = F.length("raw_payload")
    planted = (F.when(xml & (number % 47 == 0), F.lit(None).cast("string"))
               .when(xml & (number % 43 == 0), F.substring("raw_payload", F.lit(1), n - 15))
               .when(~xml & (group % 3 == 0), F.substring("raw_payload", F.lit(1), (n / 2).cast("int")))
               .otherwise(F.col("raw_payload")))
    _, bad = QT.split_payload_rejects(raw.withColumn("raw_payload", planted))
    return bad.groupBy("client_id", "_source_file", "reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def scan_parquet_landing(spark: SparkSession, sf: str) -> DataFrame:
    """RAW products written as Parquet landing files under other column names and types, and scanned."""
    root = work_dir(spark, "parquet_landing")
    rows = _raw(spark, sf, "products")
    names = {"unit_price": "price", "sku": "code"}
    out = None
    for client in ("client_a", "client_c"):
        part = rows.filter(F.col("client_id") == client).select(
            F.col("sku").alias("code"), "product_name", "category", F.col("unit_price").alias("price"), "currency", "is_active")
        part.write.parquet(f"{root}/{client}/products")
        scanned = FS.read_parquet_source(spark, root, "products", client, f"{client}/", r"products/.*[.]parquet$", LOAD_TS, names)
        scanned = scanned.select(*_PRODUCT_OUT, F.regexp_extract("_source_file", "^[^/]+/[^/]+", 0).alias("folder"), "_loaded_at")
        out = scanned if out is None else out.unionByName(scanned)
    return out


QUERIES.update({
    "incremental_three_days": incremental_three_days,
    "incremental_schema_change": incremental_schema_change,
    "schema_type_sync": schema_type_sync,
    "late_customers": late_customers,
    "reload_same_load_time": reload_same_load_time,
    "payload_rejects": payload_rejects,
    "scan_parquet_landing": scan_parquet_landing,
    "quarantine_all": quarantine_all,
    "raw_width_rejects": raw_width_rejects,
    "rejects_and_rows_balance": rejects_and_rows_balance,
    "dq_report": dq_report,
    "source_freshness": source_freshness,
    "mask_pii": mask_pii,
    "mask_tagged": mask_tagged,
    "payload_drift": payload_drift,
    "parse_json_transactions": parse_json_transactions,
    "parse_xml_transactions": parse_xml_transactions,
    "incremental_merge": incremental_merge,
    "incremental_keep_first": incremental_keep_first,
})


# ---------------------------------------------------------------------------
# Scans and load-once streams
# ---------------------------------------------------------------------------

LOAD_TS = "2025-01-15 02:00:00"
_PRODUCT_OUT = ["client_id", "sku", "product_name", "category", "unit_price", "currency", "is_active"]


def scan_text_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """CSV lines held in a DataFrame -> positional parse -> RAW product rows."""
    lines = derive.product_csv_lines(spark, sf)
    out = None
    for spec in _C.CSV_SOURCES:
        if spec.entity != "products":
            continue
        ddl = ", ".join(f"_c{i} string" for i in range(len(spec.columns)))
        parsed = (lines.filter(F.col("client_id") == spec.client_id)
                  .select(F.from_csv("line", ddl, {"mode": "PERMISSIVE", "escape": '"'}).alias("r"),
                          F.concat(F.lit(spec.prefix), F.lit("products.csv")).alias("_source_file"),
                          F.lit(0).cast("bigint").alias("_split_start"), F.col("line_no").alias("_row_pos"))
                  .select("r.*", "_source_file", "_split_start", "_row_pos"))
        rows = FS.map_csv_rows(parsed, spec, LOAD_TS).select(*_PRODUCT_OUT)
        out = rows if out is None else out.unionByName(rows)
    return out


def scan_file_once(spark: SparkSession, sf: str) -> DataFrame:
    """Client files on disk loaded by two daily runs: the second reads nothing new."""
    root = work_dir(spark, "landing")
    derive.write_product_files(spark, sf, f"{root}/landing")
    cat = Catalog(f"{root}/tables")
    for run_ts in (LOAD_TS, derive.LOAD_2):
        L.load_all_once(spark, f"{root}/landing", cat, f"{root}/checkpoints", run_ts, entities={"products"})
    return cat.read(spark, "raw", "products").select(*_PRODUCT_OUT)


# A name with a doubled quote and a comma inside (same SQL in the oracle).
QUOTED_PLANT = "CASE WHEN {c} IS NOT NULL AND _row_pos % 6 = 0 THEN {c} || ' \"XL\", blue' ELSE {c} END"
NAMES = {"customers": {"client_a": "last_name", "client_c": "customer_name"}, "products": {"client_a": "product_name", "client_c": "product_name"}}


def scan_all_sources(spark: SparkSession, sf: str) -> DataFrame:
    """All seven delimited sources and the XML and TXT payloads as client files, loaded once by two daily runs
    (JSON files: `scan_json_documents`).

    Per row: entity, client, the RAW columns joined with `|` (NULL as `~`); for payloads the transaction id.
    """
    root = work_dir(spark, "sources")
    landing = f"{root}/landing"
    for spec in _C.CSV_SOURCES:
        rows = _raw(spark, sf, spec.entity).filter(F.col("client_id") == spec.client_id)
        name = NAMES.get(spec.entity, {}).get(spec.client_id)
        if name:
            rows = rows.withColumn(name, F.expr(QUOTED_PLANT.format(c=name)))
        (rows.select(*spec.columns).write.csv(
            f"{landing}/{spec.prefix}{spec.entity}", header=True, quote='"', escape='"', nullValue="NULL", emptyValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False))
    payload = _C.PAYLOAD_SOURCES[0]
    derive.transaction_files(spark, sf).filter(F.col("fmt") == "xml").select("text").write.text(f"{landing}/{payload.prefix}transactions")
    cat = Catalog(f"{root}/tables")
    for run_ts in (LOAD_TS, derive.LOAD_2):
        L.load_all_once(spark, landing, cat, f"{root}/checkpoints", run_ts, entities=set(RAW_ENTITIES))
        L.load_payload_once(spark, landing, payload, cat, f"{root}/checkpoints", run_ts)
    parts = []
    for entity in RAW_ENTITIES:
        columns = [F.coalesce(F.col(c), F.lit("~")) for c, _ in _C.RAW_COLUMNS[entity]]
        parts.append(cat.read(spark, "raw", entity).select(F.lit(entity).alias("entity"), "client_id", F.concat_ws("|", *columns).alias("row_text")))
    parts.append(cat.read(spark, "raw", "transactions").select(
        F.lit("transactions").alias("entity"), "client_id", F.regexp_extract("raw_payload", "<TransactionID>([^<]*)", 1).alias("row_text")))
    return K.union_all(parts)


#: Bytes of a split while the documents of `scan_json_documents` are loaded: small, so that each document crosses borders.
JSON_SPLIT_BYTES = 1 << 18
#: Documents that one task of it writes as files.
TASK_FILES = 200
# Put into every document: a field that the schema does not know, and a comment, both with brackets and quotes.
JSON_PLANT = '"order":/* } ] " */{"note":"} ]{[ \\\\" /* \' //",'


def scan_json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """JSON files, cut across splits, loaded once by two daily runs (the second brings re-deliveries)."""
    root = work_dir(spark, "json_documents")
    source = _C.PayloadSource("client_c", "client_c/", r"(?i).*transaction.*[.]json/.*", "jsonarray")
    docs = derive.transaction_files(spark, sf).filter(F.col("fmt") == "json").select(
        "_loaded_at", F.regexp_replace("text", r'"order":\{', JSON_PLANT).alias("text"), F.regexp_extract("_source_file", "[^/]+$", 0).alias("doc"))
    docs.write.parquet(f"{root}/docs")
    docs = spark.read.parquet(f"{root}/docs")
    cat = Catalog(f"{root}/tables")
    # opening a file counts nothing, so a task takes small documents up to the bytes of a split, not one each; nor does a task list one folder only
    scan = {"spark.sql.files.maxPartitionBytes": str(JSON_SPLIT_BYTES), "spark.sql.files.openCostInBytes": "0",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k) for k in scan}
    for k, v in scan.items():
        spark.conf.set(k, v)
    try:
        for day in (derive.LOAD_1, derive.LOAD_2):
            new = docs.filter(F.col("_loaded_at") == F.lit(day).cast("timestamp_ntz")).select("text", "doc")
            # a file takes some 10 ms to make, however small: tasks are counted by files, not by bytes
            tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), new.count() // TASK_FILES + 1)
            (new.repartition(tasks, "doc").write.mode("append").option("compression", "none").partitionBy("doc").text(f"{root}/landing/client_c"))
            L.load_payload_once(spark, f"{root}/landing", source, cat, f"{root}/checkpoints", day)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    parsed = silver.parse(cat.read(spark, "raw", "transactions"))
    return _parse_out(parsed).withColumn("_source_file", F.regexp_extract("_source_file", "doc=([^/]+)", 1))


def stream_events_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Event files arriving in slices, loaded once each by a file stream and
    merged on event_id (a later slice carries corrections)."""
    root = work_dir(spark, "events")
    ev = spark.read.parquet(f"{sf}/events.parquet")
    landing = f"{root}/landing"
    first = ev.filter(F.dayofmonth("ts") <= 15)
    second = ev.filter(F.dayofmonth("ts") > 15)
    fixes = ev.filter(F.col("event_id") % 10 == 0).withColumn("value", F.col("value") + F.lit(1.0))
    table = I.VersionedTable(spark, f"{root}/table", ["event_id"])

    def merge_batch(df, batch_id):
        table.merge(df.select(*ev.columns))

    def stream():
        return spark.readStream.schema(ev.schema).parquet(landing)

    first.write.parquet(f"{landing}/slice=1")
    second.write.parquet(f"{landing}/slice=2")
    L.merge_stream(stream(), f"{root}/checkpoint", merge_batch)       # day 1: two slices
    fixes.write.parquet(f"{landing}/slice=3")
    L.merge_stream(stream(), f"{root}/checkpoint", merge_batch)       # day 2: only the fixes
    return table.read()


def _keep_first_slices(spark, sf):
    """Slice 1: orders before SPLIT_DATE; 2: the others, and every fifth of slice 1 with another status; 3: slice 1 once more."""
    base = _orders_two_batches(spark, sf)
    first = base.filter(F.col("_loaded_at") == F.lit(derive.LOAD_1).cast("timestamp_ntz"))
    again = (first.filter(F.col("_row_pos") % 5 == 0).withColumn("order_status", F.lit("REDELIVERED"))
             .withColumn("_loaded_at", F.lit(derive.LOAD_2).cast("timestamp_ntz")))
    later = base.filter(F.col("_loaded_at") == F.lit(derive.LOAD_2).cast("timestamp_ntz"))
    return [first, later.unionByName(again), first]


def stream_orders_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """RAW orders streamed in three slices, the last one a replay, with a restart after each; state keeps the first row per key."""
    root = work_dir(spark, "keep_first")
    customers = _written_customers(spark, sf, root)
    table = I.VersionedTable(spark, f"{root}/orders", ["order_sk"])
    schema = _raw(spark, sf, "orders").schema

    def merge_batch(df, batch_id):
        table.merge(gold.gold(df.withColumn("_is_duplicate", F.lit(False)), "orders"))
    for i, rows in enumerate(_keep_first_slices(spark, sf)):
        rows.write.parquet(f"{root}/landing/slice={i}")
        raw = spark.readStream.schema(schema).options(**L.ANY_AGE).option("recursiveFileLookup", "true").parquet(f"{root}/landing")
        orders = silver.keyed(silver.referenced_orders(raw, customers), "orders")
        L.keep_first_stream(orders, ["order_sk"], f"{root}/checkpoint", merge_batch)
    return table.read()


# Products by file: of eight files a client, one is cut, one is in another encoding (same SQL in the oracle).
FILE_NUMBER = "CAST(FLOOR(_row_pos / 4) AS BIGINT) % 8"
ACCENTED = "CASE WHEN product_name IS NOT NULL THEN product_name || ' é' END"
CUT_FILE, LATIN_FILE, CUT_PARQUET = 3, 5, 2


def bad_files(spark: SparkSession, sf: str) -> DataFrame:
    """Gzip files and Parquet files with cut ones and one encoding that is not UTF-8 among them, loaded by two daily runs.

    The rows of the readable files, and a row with the reason for each other file.
    """
    root = work_dir(spark, "bad_files")
    landing, cat = f"{root}/landing", Catalog(f"{root}/tables")
    rows = _raw(spark, sf, "products").withColumn("product_name", F.expr(ACCENTED)).withColumn("grp", F.expr(FILE_NUMBER))
    number = F.regexp_extract("file", "grp=([0-9]+)", 1).cast("bigint").alias("grp")
    out = []
    for spec in [s for s in _C.CSV_SOURCES if s.entity == "products"]:
        spec = replace(spec, name_regex=r"(?i).*product.*[.]csv[.]gz$")
        mine = rows.filter(F.col("client_id") == spec.client_id).select(*spec.columns, "grp").repartition("grp")

        def write(which, path, mine=mine, **more):
            mine.filter(which).write.mode("append").partitionBy("grp").csv(
                path, header=True, quote='"', escape='"', nullValue="NULL", emptyValue="", compression="gzip",
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **more)
        folder = f"{landing}/{spec.prefix}products"
        write(~F.col("grp").isin(CUT_FILE, LATIN_FILE), folder)
        write(F.col("grp") == LATIN_FILE, folder, encoding="ISO-8859-1")
        write(F.col("grp") == CUT_FILE, f"{root}/whole/{spec.client_id}")
        derive.copy_cut(spark, f"{root}/whole/{spec.client_id}/grp={CUT_FILE}", f"{folder}/grp={CUT_FILE}")
        for run_ts in (LOAD_TS, derive.LOAD_2):
            L.load_csv_once(spark, landing, spec, cat, f"{root}/checkpoints", run_ts, Options(check_files=True))

        prefix, regex = f"parquet/{spec.client_id}/", r"products/.*[.]parquet$"
        mine.filter(F.col("grp") != CUT_PARQUET).write.partitionBy("grp").parquet(f"{landing}/{prefix}products")
        mine.filter(F.col("grp") == CUT_PARQUET).write.partitionBy("grp").parquet(f"{root}/whole_parquet/{spec.client_id}")
        derive.copy_cut(spark, f"{root}/whole_parquet/{spec.client_id}/grp={CUT_PARQUET}", f"{landing}/{prefix}products/grp={CUT_PARQUET}")
        good, bad = R.split_files(spark, landing, prefix, regex, "parquet")
        out.append(FS.read_parquet_source(spark, landing, "products", spec.client_id, prefix, regex, LOAD_TS, files=good)
                   .select(F.lit("parquet").alias("fmt"), *_PRODUCT_OUT, F.lit(None).cast("bigint").alias("grp"), F.lit(None).cast("string").alias("reject_reason")))
        listed = spark.createDataFrame([(spec.client_id, f, r) for f, r in bad.items()], "client_id string, file string, reject_reason string")
        out.append(listed.select(F.lit("parquet").alias("fmt"), "client_id", number, "reject_reason"))
    out.append(cat.read(spark, "raw", "products").select(F.lit("csv").alias("fmt"), *_PRODUCT_OUT))
    out.append(cat.read(spark, "rejects", "files").filter("reject_reason IS NOT NULL").select(F.lit("csv").alias("fmt"), "client_id", number, "reject_reason"))
    found = out[0]
    for part in out[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    return found


QUERIES.update({
    "stream_orders_keep_first": stream_orders_keep_first,
    "bad_files": bad_files,
    "scan_text_nulls": scan_text_nulls,
    "scan_file_once": scan_file_once,
    "scan_all_sources": scan_all_sources,
    "scan_json_documents": scan_json_documents,
    "stream_events_incremental": stream_events_incremental,
})
