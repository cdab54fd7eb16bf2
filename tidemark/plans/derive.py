"""RAW rows derived from the driver tables (test and benchmark input).

The driver ships TPC-H-like tables; the pipeline consumes client files. This
module turns the tables into RAW-shaped rows with planted anomalies (blank,
padded and garbage ids, bad e-mails, sentinels, bad numbers and dates,
duplicates in the same load and re-deliveries in a later load) and into
transaction payload files (XML with and without a root, JSON documents with
banners and comments).

The per-field expressions are plain SQL in the subset shared by Spark SQL and
DuckDB, so the DuckDB oracle derives the very same RAW rows; the operators
under test are implemented separately on each side.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.payload import xml_chunks, xml_record

LOAD_1 = "2025-01-15 02:00:00"
LOAD_2 = "2025-01-16 02:00:00"
FILE_ROWS = 1000        # rows per derived CSV file
PAYLOAD_FILE_ORDERS = 100  # orders per derived XML / JSON file


def cust_id(k: str) -> str:
    return (f"CASE WHEN {k} % 2 = 0 THEN 'CUST-A-' || lpad(CAST({k} AS STRING), 7, '0') "
            f"ELSE 'C-CUST-' || CAST({k} AS STRING) END")


def client_of(k: str) -> str:
    return f"CASE WHEN {k} % 2 = 0 THEN 'client_a' ELSE 'client_c' END"


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _bool_text(k: str, shift: int) -> str:
    return (f"CASE ({k} + {shift}) % 8 WHEN 0 THEN 'true' WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'false' "
            f"WHEN 3 THEN 'yes' WHEN 4 THEN 'Off' WHEN 5 THEN 'N' WHEN 6 THEN NULL ELSE 'maybe' END")


def _group(k: str, n: int) -> str:
    return f"lpad({_s(f'CAST(FLOOR({k} / {n}) AS BIGINT)')}, 5, '0')"


@dataclass(frozen=True)
class RawSpec:
    table: str
    key: str
    client: str
    stem: str
    columns: dict
    where: str = "TRUE"
    redelivery_changes: tuple = ()  # (column, expression over the base column)


_CK = "c_custkey"
_OK = "o_orderkey"
_PK = "p_partkey"
_OID = f"CASE WHEN o_custkey % 2 = 0 THEN 'ORD-' || {_s(_OK)} ELSE 'C-ORD-' || {_s(_OK)} END"
_TOTAL = "CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)"

RAW_SPECS = {
    "customers": RawSpec(
        table="customer", key=_CK, client=client_of(_CK), stem="customers",
        columns={
            "customer_id": (f"CASE WHEN {_CK} % 97 = 0 THEN NULL WHEN {_CK} % 89 = 0 THEN '   ' "
                            f"WHEN {_CK} % 83 = 0 THEN 'Customer_ID' "
                            f"WHEN {_CK} % 79 = 0 THEN '----- END OF FILE -----' "
                            f"WHEN {_CK} % 13 = 0 THEN '  ' || {cust_id(_CK)} || ' ' ELSE {cust_id(_CK)} END"),
            "first_name": (f"CASE WHEN {_CK} % 2 = 1 THEN NULL WHEN {_CK} % 19 = 0 THEN NULL "
                           f"WHEN {_CK} % 23 = 0 THEN '  ' ELSE 'First' || {_s(f'{_CK} % 37')} END"),
            "last_name": (f"CASE WHEN {_CK} % 2 = 1 THEN NULL WHEN {_CK} % 11 = 0 THEN 'Unknown' "
                          f"WHEN {_CK} % 17 = 0 THEN ' Unknown ' WHEN {_CK} % 29 = 0 THEN NULL "
                          f"ELSE 'Last' || {_s(f'{_CK} % 41')} END"),
            "customer_name": (f"CASE WHEN {_CK} % 2 = 0 THEN NULL "
                              f"WHEN {_CK} % 5 = 0 THEN 'Solo' || {_s(f'{_CK} % 37')} "
                              f"WHEN {_CK} % 5 = 1 THEN 'First' || {_s(f'{_CK} % 37')} || ' Mid Last' || {_s(f'{_CK} % 41')} "
                              f"WHEN {_CK} % 5 = 2 THEN '  ' "
                              f"ELSE ' First' || {_s(f'{_CK} % 37')} || ' Last' || {_s(f'{_CK} % 41')} END"),
            "email": (f"CASE WHEN {_CK} % 31 = 0 THEN NULL "
                      f"WHEN {_CK} % 11 = 1 THEN 'user' || {_s(_CK)} || '@@mail..com' "
                      f"WHEN {_CK} % 11 = 2 THEN 'user' || {_s(_CK)} || '@mail' "
                      f"WHEN {_CK} % 11 = 3 THEN '@mail.com' "
                      f"WHEN {_CK} % 11 = 4 THEN '  user' || {_s(_CK)} || '@Mail.Example.org ' "
                      f"WHEN {_CK} % 11 = 5 THEN 'user' || {_s(_CK)} || '@mail..com' "
                      f"ELSE 'user' || {_s(_CK)} || '@example.com' END"),
            "loyalty_tier": (f"CASE WHEN {_CK} % 2 = 1 THEN NULL ELSE CASE {_CK} % 7 WHEN 0 THEN 'GOLD' "
                             f"WHEN 1 THEN 'silver' WHEN 2 THEN ' Bronze ' WHEN 3 THEN 'PLATINUM' "
                             f"WHEN 4 THEN 'VIP' WHEN 5 THEN NULL ELSE 'Gold' END END"),
            "segment": (f"CASE WHEN {_CK} % 2 = 0 THEN NULL WHEN {_CK} % 9 = 0 THEN 'UNKNOWN' "
                        f"WHEN {_CK} % 9 = 1 THEN ' UNKNOWN ' WHEN {_CK} % 9 = 2 THEN 'gold' "
                        f"WHEN {_CK} % 9 = 3 THEN 'Silver' ELSE c_mktsegment END"),
            "signup_source": (f"CASE WHEN {_CK} % 2 = 1 THEN NULL ELSE CASE {_CK} % 4 WHEN 0 THEN 'Web' "
                              f"WHEN 1 THEN ' Store ' WHEN 2 THEN NULL ELSE 'MobileApp' END END"),
            "is_active": _bool_text(_CK, 0),
        },
        redelivery_changes=(("email", "upper(email)"),),
    ),
    "orders": RawSpec(
        table="orders", key=_OK, client=client_of("o_custkey"), stem="orders",
        columns={
            "order_id": (f"CASE WHEN {_OK} % 97 = 0 THEN NULL WHEN {_OK} % 89 = 0 THEN 'ORDER_ID' "
                         f"WHEN {_OK} % 83 = 0 THEN '----- START OF FILE: orders.csv -----' "
                         f"WHEN {_OK} % 13 = 0 THEN ' ' || {_OID} || '  ' ELSE {_OID} END"),
            "customer_id": (f"CASE WHEN {_OK} % 37 = 0 THEN CASE WHEN o_custkey % 2 = 0 "
                            f"THEN 'CUST-A-X' || {_s(_OK)} ELSE 'C-CUST-X' || {_s(_OK)} END "
                            f"WHEN {_OK} % 41 = 0 THEN NULL "
                            f"WHEN {_OK} % 7 = 0 THEN ' ' || {cust_id('o_custkey')} "
                            f"ELSE {cust_id('o_custkey')} END"),
            "order_date": (f"CASE WHEN {_OK} % 53 = 0 THEN NULL WHEN {_OK} % 59 = 0 THEN 'not a date' "
                           f"WHEN {_OK} % 61 = 0 THEN '2024-02-30' WHEN {_OK} % 67 = 0 THEN '2025' "
                           f"WHEN {_OK} % 71 = 0 THEN '   ' "
                           f"ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"),
            "order_status": (f"CASE WHEN {_OK} % 5 = 0 THEN ' ' ELSE '' END || CASE o_orderstatus "
                             f"WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'cancelled' END"),
            "channel": (f"CASE WHEN o_custkey % 2 = 1 THEN NULL ELSE CASE {_OK} % 3 WHEN 0 THEN 'Online' "
                        f"WHEN 1 THEN ' Store ' ELSE NULL END END"),
        },
        redelivery_changes=(("order_status", "lower(order_status)"),),
    ),
    "products": RawSpec(
        table="part", key=_PK, client=client_of(_PK), stem="products",
        columns={
            "sku": (f"CASE WHEN {_PK} % 97 = 0 THEN NULL WHEN {_PK} % 89 = 0 THEN 'SKU' "
                    f"WHEN {_PK} % 83 = 0 THEN '----- END OF FILE -----' "
                    f"WHEN {_PK} % 13 = 0 THEN ' ' || CASE WHEN {_PK} % 2 = 0 THEN 'SKU-A-' || lpad({_s(_PK)}, 5, '0') ELSE 'C-SKU-' || {_s(_PK)} END "
                    f"ELSE CASE WHEN {_PK} % 2 = 0 THEN 'SKU-A-' || lpad({_s(_PK)}, 5, '0') ELSE 'C-SKU-' || {_s(_PK)} END END"),
            "product_name": (f"CASE WHEN {_PK} % 41 = 0 THEN 'Unknown Product' WHEN {_PK} % 43 = 0 THEN NULL "
                             f"WHEN {_PK} % 7 = 0 THEN ' ' || p_name || ' ' ELSE p_name END"),
            "category": (f"CASE WHEN {_PK} % 9 = 0 THEN 'UNKNOWN' WHEN {_PK} % 9 = 1 THEN lower(p_type) "
                         f"ELSE p_type END"),
            "unit_price": (f"CASE WHEN {_PK} % 37 = 0 THEN '-' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) "
                           f"WHEN {_PK} % 31 = 0 THEN '0' WHEN {_PK} % 29 = 0 THEN 'abc' "
                           f"WHEN {_PK} % 47 = 0 THEN '12345678901.50' WHEN {_PK} % 53 = 0 THEN NULL "
                           f"WHEN {_PK} % 59 = 0 THEN ' ' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) || ' ' "
                           f"ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END"),
            "currency": (f"CASE {_PK} % 5 WHEN 0 THEN 'usd' WHEN 1 THEN ' EUR ' WHEN 2 THEN NULL "
                         f"ELSE 'USD' END"),
            "is_active": _bool_text(_PK, 3),
        },
        redelivery_changes=(("currency", "lower(currency)"),),
    ),
    "payments": RawSpec(
        table="orders", key=_OK, client="'client_c'", stem="payments", where="o_custkey % 2 = 1",
        columns={
            "payment_id": (f"CASE WHEN {_OK} % 97 = 0 THEN NULL WHEN {_OK} % 89 = 0 THEN 'payment_id' "
                           f"WHEN {_OK} % 83 = 0 THEN '----- END OF FILE -----' "
                           f"WHEN {_OK} % 13 = 0 THEN ' PAY-C-' || {_s(_OK)} || ' ' "
                           f"ELSE 'PAY-C-' || {_s(_OK)} END"),
            "order_id": f"CASE WHEN {_OK} % 53 = 0 THEN NULL ELSE 'C-ORD-' || {_s(_OK)} END",
            "payment_method": (f"CASE {_OK} % 4 WHEN 0 THEN 'CreditCard' WHEN 1 THEN ' PayPal ' "
                               f"WHEN 2 THEN NULL ELSE 'BankTransfer' END"),
            "amount": (f"CASE WHEN {_OK} % 37 = 0 THEN '-' || {_TOTAL} WHEN {_OK} % 31 = 0 THEN '0.00' "
                       f"WHEN {_OK} % 29 = 0 THEN 'n/a' WHEN {_OK} % 47 = 0 THEN '99999999999.99' "
                       f"ELSE {_TOTAL} END"),
            "currency": f"CASE {_OK} % 3 WHEN 0 THEN 'usd' WHEN 1 THEN 'USD' ELSE NULL END",
            "status": (f"CASE WHEN {_OK} % 43 = 0 THEN 'REFUNDED' WHEN {_OK} % 7 = 0 THEN 'refunded' "
                       f"WHEN {_OK} % 5 = 0 THEN 'Pending' ELSE 'Completed' END"),
        },
        redelivery_changes=(("status", "upper(status)"),),
    ),
}

ALL_RAW_COLUMNS = {
    "customers": ["customer_id", "first_name", "last_name", "customer_name", "email",
                  "loyalty_tier", "segment", "signup_source", "is_active"],
    "orders": ["order_id", "customer_id", "order_date", "order_status", "channel"],
    "products": ["sku", "product_name", "category", "unit_price", "currency", "is_active"],
    "payments": ["payment_id", "order_id", "payment_method", "amount", "currency", "status"],
}


def raw_copies(spec: RawSpec, ts_type: str):
    """The three row sets of a derived RAW table as (select list, where) pairs:
    every row in load 1; a same-load repeat at a later position for keys
    divisible by 20; a re-delivery in load 2 for keys divisible by 10."""
    k = spec.key
    base_file = f"{spec.client} || '/{spec.stem}_' || {_group(k, FILE_ROWS)} || '.csv'"
    redo_file = f"{spec.client} || '/{spec.stem}_redelivery.csv'"
    cols = [f"{spec.client} AS client_id"] + [f"{e} AS {c}" for c, e in spec.columns.items()]
    t1 = f"CAST('{LOAD_1}' AS {ts_type})"
    t2 = f"CAST('{LOAD_2}' AS {ts_type})"
    zero = "CAST(0 AS BIGINT)"
    base = cols + [f"{base_file} AS _source_file", f"{t1} AS _loaded_at", f"{zero} AS _split_start",
                   f"CAST(2 * {k} AS BIGINT) AS _row_pos"]
    again = cols + [f"{base_file} AS _source_file", f"{t1} AS _loaded_at", f"{zero} AS _split_start",
                    f"CAST(2 * {k} + 1 AS BIGINT) AS _row_pos"]
    redo = cols + [f"{redo_file} AS _source_file", f"{t2} AS _loaded_at", f"{zero} AS _split_start",
                   f"CAST({k} AS BIGINT) AS _row_pos"]
    return [(base, spec.where), (again, f"({spec.where}) AND {k} % 20 = 0"),
            (redo, f"({spec.where}) AND {k} % 10 = 0")], dict(spec.redelivery_changes)


def _finalise(entity: str) -> list[str]:
    present = RAW_SPECS[entity].columns
    return (["client_id"] + [c if c in present else f"CAST(NULL AS STRING) AS {c}"
                             for c in ALL_RAW_COLUMNS[entity]]
            + ["_source_file", "_loaded_at", "_split_start", "_row_pos"])


def raw_table(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Derived RAW rows for `entity` as a Spark DataFrame."""
    spec = RAW_SPECS[entity]
    src = spark.read.parquet(f"{sf_dir}/{spec.table}.parquet")
    copies, changes = raw_copies(spec, "TIMESTAMP_NTZ")
    frames = []
    for i, (sel, where) in enumerate(copies):
        df = src.filter(F.expr(where)).selectExpr(*sel)
        if i == 2:
            for c, e in changes.items():
                df = df.withColumn(c, F.expr(e))
        frames.append(df.selectExpr(*_finalise(entity)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def raw_table_sql(entity: str) -> str:
    """The same derived RAW rows as DuckDB SQL."""
    spec = RAW_SPECS[entity]
    copies, changes = raw_copies(spec, "TIMESTAMP")
    parts = []
    for i, (sel, where) in enumerate(copies):
        inner = f"SELECT {', '.join(sel)} FROM {spec.table} WHERE {where}"
        outer = []
        for c in _finalise(entity):
            name = c.split(" AS ")[-1]
            if i == 2 and name in changes:
                outer.append(f"{changes[name]} AS {name}")
            else:
                outer.append(c)
        parts.append(f"SELECT {', '.join(outer)} FROM ({inner}) t")
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------------------
# Transaction payloads: one transaction per order, items from its lineitems.
# ---------------------------------------------------------------------------
_TID = f"CASE WHEN o_custkey % 2 = 0 THEN 'TXN-' || {_s(_OK)} ELSE 'C-TXN-' || {_s(_OK)} END"
_IK = "(l_orderkey + l_linenumber)"

TXN_TEXT = {
    "client_id": client_of("o_custkey"),
    "txn_id": (f"CASE WHEN {_OK} % 97 = 0 THEN '' WHEN {_OK} % 89 = 0 THEN '  ' "
               f"WHEN {_OK} % 83 = 0 THEN 'Transaction_ID' "
               f"WHEN {_OK} % 13 = 0 THEN ' ' || {_TID} || ' ' ELSE {_TID} END"),
    "order_id": f"CASE WHEN {_OK} % 53 = 0 THEN '' ELSE {_OID} END",
    "order_date": (f"CASE WHEN {_OK} % 59 = 0 THEN '' WHEN {_OK} % 61 = 0 THEN '2024-02-30' "
                   f"WHEN {_OK} % 67 = 0 THEN 'yesterday' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"),
    "customer_id": f"CASE WHEN {_OK} % 41 = 0 THEN '' ELSE {cust_id('o_custkey')} END",
    # XML customers carry first/last elements; JSON customers one name
    "first_name": f"CASE WHEN {_OK} % 19 = 0 THEN '' ELSE 'First' || {_s('o_custkey % 37')} END",
    "last_name": f"CASE WHEN {_OK} % 17 = 0 THEN NULL ELSE 'Last' || {_s('o_custkey % 41')} END",
    "last_tag": f"CASE WHEN {_OK} % 11 = 0 THEN 'LastLastName' ELSE 'LastName' END",
    "customer_name": (f"CASE WHEN {_OK} % 5 = 0 THEN 'Solo' || {_s('o_custkey % 37')} "
                      f"WHEN {_OK} % 19 = 0 THEN '' "
                      f"ELSE 'First' || {_s('o_custkey % 37')} || ' Last' || {_s('o_custkey % 41')} END"),
    "email": (f"CASE WHEN {_OK} % 31 = 0 THEN NULL "
              f"WHEN {_OK} % 11 = 1 THEN 'user' || {_s('o_custkey')} || '@@mail..com' "
              f"WHEN {_OK} % 11 = 2 THEN 'user' || {_s('o_custkey')} || '@mail' "
              f"ELSE 'user' || {_s('o_custkey')} || '@example.com' END"),
    "payment_method": (f"CASE {_OK} % 4 WHEN 0 THEN 'CreditCard' WHEN 1 THEN 'PayPal' WHEN 2 THEN '' "
                       f"ELSE 'BankTransfer' END"),
    "amount": (f"CASE WHEN {_OK} % 37 = 0 THEN '-' || {_TOTAL} WHEN {_OK} % 31 = 0 THEN '0' "
               f"WHEN {_OK} % 29 = 0 THEN 'abc' ELSE {_TOTAL} END"),
    "currency": (f"CASE WHEN o_custkey % 2 = 0 THEN CASE {_OK} % 3 WHEN 0 THEN 'usd' WHEN 1 THEN 'USD' END "
                 f"ELSE CASE WHEN {_OK} % 3 = 0 THEN 'usd' END END"),
    "processing_fee": f"CASE WHEN o_custkey % 2 = 0 AND {_OK} % 7 = 0 THEN '1.50' END",
    "items_mode": f"CASE WHEN {_OK} % 71 = 0 THEN 'absent' WHEN {_OK} % 73 = 0 THEN 'empty' ELSE 'lines' END",
    "drift": f"{_OK} % 9 = 0",
    "file_group": f"CAST(FLOOR({_OK} / {PAYLOAD_FILE_ORDERS}) AS BIGINT)",
}

ITEM_TEXT = {
    "sku": (f"CASE WHEN {_IK} % 37 = 0 THEN '' WHEN {_IK} % 89 = 0 THEN 'SKU' "
            f"ELSE 'SKU-' || {_s('l_partkey')} END"),
    "description": (f"CASE WHEN {_IK} % 13 = 0 THEN ' Part ' || {_s('l_partkey')} || ' ' "
                    f"ELSE 'Part ' || {_s('l_partkey')} END"),
    "qty": (f"CASE WHEN {_IK} % 23 = 0 THEN '-' || {_s('CAST(l_quantity AS INT)')} "
            f"WHEN {_IK} % 19 = 0 THEN '0' WHEN {_IK} % 29 = 0 THEN '2.7' WHEN {_IK} % 43 = 0 THEN 'two' "
            f"ELSE {_s('CAST(l_quantity AS INT)')} END"),
    "price": (f"CASE WHEN {_IK} % 17 = 0 THEN '-5.00' WHEN {_IK} % 31 = 0 THEN NULL "
              f"ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END"),
    "currency": (f"CASE WHEN {_IK} % 31 = 0 THEN NULL ELSE CASE {_IK} % 3 WHEN 0 THEN 'usd' "
                 f"WHEN 1 THEN 'USD' END END"),
}
# Total order of the lines of one order (line numbers repeat in the data).
ITEM_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _el(tag: str, value, attrs=None):
    """<tag attr="..">value</tag>, or nothing when value is NULL."""
    open_tag = F.lit(f"<{tag}>") if attrs is None else F.concat(
        F.lit(f"<{tag}"), F.concat_ws("", *[F.when(v.isNotNull(), F.concat(F.lit(f' {a}="'), v, F.lit('"')))
                                           for a, v in attrs]), F.lit(">"))
    return F.when(value.isNotNull(), F.concat(open_tag, value, F.lit(f"</{tag}>")))


#: Rows of orders and lines that one task turns into file texts: a few tens of MB, so that no task needs its disk.
TASK_ROWS = 150_000
_ORDER_INPUT = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: its columns as text, and the texts of its lines in line order (NULL without lines).

    Orders and lines meet in one shuffle by file, as the few columns the texts
    are made of; everything up to the file texts is then done in that place.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").filter(F.col("l_orderkey").isNotNull())
    key = {"order": F.col("o_orderkey").cast("bigint"), "line": F.col("l_orderkey").cast("bigint")}
    met = (orders.select(key["order"].alias("key"), F.struct(*_ORDER_INPUT).alias("o"))
           .unionByName(lines.select(key["line"].alias("key"), F.struct("l_orderkey", *ITEM_ORDER).alias("line")), allowMissingColumns=True)
           .withColumn("file_group", F.expr(f"CAST(FLOOR(key / {PAYLOAD_FILE_ORDERS}) AS BIGINT)")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), met.count() // TASK_ROWS + 1)
    text = F.struct(*[F.col(f"line.{c}") for c in ITEM_ORDER],
                    *[F.expr(re.sub(r"\bl_", "line.l_", e)).alias(n) for n, e in {**ITEM_TEXT, "drift": f"{_IK} % 9 = 0"}.items()])
    grouped = (met.repartition(tasks, "file_group")
               .select("file_group", "key", "o", F.when(F.col("line").isNotNull(), text).alias("line"))
               .groupBy("file_group", "key").agg(F.collect_list("o").alias("orders"), F.sort_array(F.collect_list("line")).alias("lines")))
    rows = (grouped.withColumn("lines", F.when(F.size("lines") > 0, F.col("lines")))
            .select("file_group", "lines", (F.size("orders") > 1).alias("repeated"), F.explode("orders").alias("o"))
            .select("file_group", "lines", "repeated", "o.*"))
    return rows.select("file_group", "o_orderkey", "lines", "repeated",
                       *[F.expr(e).alias(n) for n, e in TXN_TEXT.items() if n != "file_group"])


def _item_xml(x):
    return F.concat(
        F.lit("<Item>"), F.concat_ws(
            "",
            _el("SKU", x["sku"]), _el("Description", x["description"]),
            _el("Quantity", x["qty"]),
            _el("UnitPrice", x["price"], [("currency", x["currency"])]),
            F.when(x["drift"], F.lit("<Warranty><Years>2</Years></Warranty>"))),
        F.lit("</Item>"))


def _item_js(x):
    return F.struct(x["sku"].alias("sku"), x["description"].alias("description"), x["qty"].alias("qty"),
                    F.struct(x["price"].alias("amount"), x["currency"].alias("currency")).alias("price"))


def transaction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files as rows: client_id, _source_file, _loaded_at, fmt, text."""
    o = _orders_with_lines(spark, sf_dir)
    # each order is written in the format of its client; XML also orders the rows of a repeated key
    o = (o.withColumn("items_xml", F.when((F.col("client_id") == "client_a") | F.col("repeated"), F.array_join(F.transform("lines", _item_xml), "")))
         .withColumn("items_js", F.when(F.col("client_id") != "client_a", F.transform("lines", _item_js))))
    c = F.col
    mode = c("items_mode")
    items_xml = (F.when(mode == "absent", F.lit(None))
                 .when((mode == "empty") | c("items_xml").isNull(), F.lit("<Items/>"))
                 .otherwise(F.concat(F.lit("<Items>"), c("items_xml"), F.lit("</Items>"))))
    xml = F.concat(
        F.lit("<!-- order "), c("o_orderkey").cast("string"),
        F.when(c("o_orderkey") % 43 == 0, F.lit(" (was a <Transaction> draft)")).otherwise(F.lit("")),
        F.lit(" -->\n<Transaction>"),
        F.concat_ws(
            "",
            _el("TransactionID", c("txn_id")),
            F.concat(F.lit("<Order>"), F.concat_ws(
                "", _el("OrderID", c("order_id")), _el("OrderDate", c("order_date")),
                F.concat(F.lit("<Customer>"), F.concat_ws(
                    "", _el("CustomerID", c("customer_id")),
                    F.concat(F.lit("<Name>"), F.concat_ws(
                        "", _el("FirstName", c("first_name")),
                        F.when(c("last_name").isNotNull(), F.concat(
                            F.lit("<"), c("last_tag"), F.lit(">"), c("last_name"),
                            F.lit("</"), c("last_tag"), F.lit(">")))), F.lit("</Name>")),
                    _el("Email", c("email")),
                    F.when(c("drift"), F.lit("<LoyaltyTier>GOLD</LoyaltyTier><Tags><Tag>x</Tag></Tags>"))),
                    F.lit("</Customer>"))), F.lit("</Order>")),
            items_xml,
            F.concat(F.lit("<Payment>"), F.concat_ws(
                "", _el("Method", c("payment_method")),
                _el("Amount", c("amount"), [("currency", c("currency"))]),
                F.when(c("processing_fee").isNotNull(), F.concat(
                    F.lit("<Fees><ProcessingFee>"), c("processing_fee"), F.lit("</ProcessingFee></Fees>")))),
                F.lit("</Payment>"))),
        F.lit("</Transaction>\n"))
    items_js = (F.when(mode == "absent", F.lit(None))
                .when(mode == "empty", F.array())
                .otherwise(F.coalesce(c("items_js"), F.array())))
    js = F.struct(
        c("txn_id").alias("id"),
        F.struct(c("order_id").alias("id"), c("order_date").alias("date"),
                 F.struct(c("customer_id").alias("id"), c("customer_name").alias("name"),
                          c("email").alias("email")).alias("customer")).alias("order"),
        items_js.alias("items"),
        F.struct(c("payment_method").alias("method"), c("amount").alias("total"),
                 c("currency").alias("currency")).alias("payment"),
        F.when(c("drift"), F.struct(F.lit("web").alias("channel"))).alias("metadata"))
    is_a = c("client_id") == "client_a"
    o = o.select("o_orderkey", "client_id", "file_group", F.when(is_a | c("repeated"), xml).alias("xml"), F.when(~is_a, js).alias("js"))

    # copy 0: every order in load 1; copy 1: a same-load repeat (key % 20);
    # copy 2: a re-delivery in load 2 (key % 10), in its own file.
    key = c("o_orderkey")
    numbers = F.when(key % 20 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).when(key % 10 == 0, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    copies = o.withColumn("copy", F.explode(numbers))
    copies = copies.withColumn("load", F.when(c("copy") == 2, F.lit(2)).otherwise(F.lit(1)))
    files = copies.groupBy("client_id", "file_group", "load").agg(
        F.sort_array(F.collect_list(F.struct("o_orderkey", "copy", "xml", "js"))).alias("t"))
    grp = F.lpad(c("file_group").cast("string"), 5, "0")
    redo = c("load") == 2
    name = F.when(is_a, F.concat(
        F.lit("client_a/ClientA_Transactions_"), F.when(redo, F.lit("redelivery_")).otherwise(F.lit("")), grp,
        F.when(redo | (c("file_group") % 2 == 0), F.lit(".xml")).otherwise(F.lit(".txt")))).otherwise(
        F.concat(F.lit("client_c/transactions_"), F.when(redo, F.lit("redelivery_")).otherwise(F.lit("")),
                 grp, F.lit(".json")))
    rooted = redo | (c("file_group") % 2 == 0)
    body_xml = F.array_join(F.transform("t", lambda x: x["xml"]), "")
    xml_text = F.concat(
        F.lit("----- START OF FILE: "), name, F.lit(" -----\n"),
        F.when(rooted, F.lit('<SalesData client="ClientA">\n')).otherwise(F.lit("")),
        body_xml,
        F.when(rooted, F.lit("</SalesData>\n")).otherwise(F.lit("")),
        F.lit("----- END OF FILE -----\n"))
    doc = F.to_json(F.struct(F.lit("ClientC").alias("client"),
                             F.lit("2025-01-15T02:00:00Z").alias("batchTimestamp"),
                             F.transform("t", lambda x: x["js"]).alias("transactions")))
    json_text = F.concat(F.lit("----- START OF FILE: "), name, F.lit(" -----\n// export of one batch\n"),
                         doc, F.lit("\n// end of batch\n----- END OF FILE -----\n"))
    loaded = F.when(redo, F.lit(LOAD_2)).otherwise(F.lit(LOAD_1)).cast("timestamp_ntz")
    return files.select("client_id", name.alias("_source_file"), loaded.alias("_loaded_at"),
                        F.when(is_a, F.lit("xml")).otherwise(F.lit("json")).alias("fmt"),
                        F.when(is_a, xml_text).otherwise(json_text).alias("text"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW transactions: one row per XML <Transaction> record, one per JSON document; the files are made once for both."""
    files = transaction_files(spark, sf_dir)
    is_xml = F.col("fmt") == "xml"
    chunks = files.select("client_id", "_source_file", "_loaded_at", "fmt",
                          F.posexplode(F.when(is_xml, xml_chunks("text")).otherwise(F.array("text"))).alias("_row_pos", "value"))
    rows = chunks.withColumn("raw_payload", F.when(is_xml, xml_record("value")).otherwise(F.col("value")))
    return rows.filter(~is_xml | F.col("raw_payload").isNotNull()).select(
        "client_id", "raw_payload", "_source_file", "_loaded_at",
        F.lit(0).cast("bigint").alias("_split_start"), F.col("_row_pos").cast("bigint"))


# ---------------------------------------------------------------------------
# Delimited client files: product lines from `part`
# ---------------------------------------------------------------------------
PRODUCT_FILE_ROWS = 500
PRODUCT_HEADER = "sku,product_name,category,unit_price,currency,is_active"
NULL_TOKEN_TEXT = f"CASE WHEN {_PK} % 7 = 0 THEN 'NULL' WHEN {_PK} % 11 = 0 THEN 'null' ELSE '' END"
SHORT_ROW = f"{_PK} % 13 = 0"     # only the first four fields
LONG_ROW = f"{_PK} % 17 = 0"      # one extra field
NOTE_ROW = f"{_PK} % 10 = 0"      # inline reviewer note at the end of the line
QUOTED_NAME = f"{_PK} % 3 = 0"    # product name in double quotes


def product_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV text line per part: client_id, file_group, line_no, line."""
    spec = RAW_SPECS["products"]
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    token = F.expr(NULL_TOKEN_TEXT)
    f = {c: F.expr(e) for c, e in spec.columns.items()}
    name = F.when(F.expr(QUOTED_NAME) & f["product_name"].isNotNull(),
                  F.concat(F.lit('"'), f["product_name"], F.lit('"'))).otherwise(f["product_name"])
    text = [F.coalesce(f["sku"], token), F.coalesce(name, token), F.coalesce(f["category"], token),
            F.coalesce(f["unit_price"], token), F.coalesce(f["currency"], token),
            F.coalesce(f["is_active"], token)]
    full = F.concat_ws(",", *text)
    short = F.concat_ws(",", *text[:4])
    line = F.when(F.expr(SHORT_ROW), short).when(F.expr(LONG_ROW), F.concat(full, F.lit(",EXTRA"))).otherwise(full)
    line = F.when(F.expr(NOTE_ROW), F.concat(line, F.lit("   <-- duplicate"))).otherwise(line)
    return part.select(F.expr(spec.client).alias("client_id"),
                       F.expr(f"CAST(FLOOR({_PK} / {PRODUCT_FILE_ROWS}) AS BIGINT)").alias("file_group"),
                       F.col(_PK).cast("bigint").alias("line_no"), line.alias("line"))


def write_product_files(spark: SparkSession, sf_dir: str, landing: str, batch: str = "batch1") -> None:
    """Client product files: banner line, header line, data lines, end banner."""
    lines = product_csv_lines(spark, sf_dir)
    groups = lines.select("client_id", "file_group").distinct()
    frame = (groups.select("client_id", "file_group", F.lit(-2).cast("bigint").alias("line_no"),
                           F.concat(F.lit("----- START OF FILE: products_"), F.col("file_group").cast("string"),
                                    F.lit(".csv -----")).alias("line"))
             .unionByName(groups.select("client_id", "file_group", F.lit(-1).cast("bigint").alias("line_no"),
                                        F.lit(PRODUCT_HEADER).alias("line")))
             .unionByName(groups.select("client_id", "file_group", F.lit(2 ** 62).cast("bigint").alias("line_no"),
                                        F.lit("----- END OF FILE -----").alias("line"))))
    all_lines = lines.unionByName(frame)
    for client in ("client_a", "client_c"):  # one folder per configured client prefix
        (all_lines.filter(F.col("client_id") == client).drop("client_id")
         .repartition("file_group").sortWithinPartitions("file_group", "line_no").drop("line_no")
         # one text column per line: a separator that never occurs keeps the
         # writer from quoting lines that contain commas
         .write.mode("overwrite").option("sep", "\u0001").option("quote", "").option("escapeQuotes", "false")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .partitionBy("file_group").csv(f"{landing.rstrip('/')}/{client}/products_{batch}"))


def copy_cut(spark: SparkSession, source: str, target: str) -> None:
    """The files of a folder (names without a leading dot or underscore) copied to another, each without its second half."""
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    folder, to = hadoop.fs.Path(source), hadoop.fs.Path(target)
    fs = folder.getFileSystem(conf)
    for st in fs.listStatus(folder):
        name = st.getPath().getName()
        if not name.startswith((".", "_")):
            whole, cut = fs.open(st.getPath()), fs.create(hadoop.fs.Path(to, name))
            spark._jvm.org.apache.commons.io.IOUtils.copyLarge(whole, cut, 0, st.getLen() // 2)
            cut.close()
            whole.close()
