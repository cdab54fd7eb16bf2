"""DuckDB oracle SQL for the driver queries.

Each model is re-implemented here in plain SQL (window row numbers, CASE
chains, joins) over the RAW rows derived from the driver tables. Only the
fixture derivation (planted anomalies) is shared with the Spark side.
"""

from __future__ import annotations

from tidemark import config as C
from tidemark.plans import derive as D

TOK = C.SURROGATE_KEY_NULL
EMAIL = C.EMAIL_PATTERN
ORDER = "_loaded_at, _source_file, _split_start, _row_pos"


def clean(x: str) -> str:
    return f"NULLIF(TRIM({x}), '')"


def word(x: str, n: int) -> str:
    return f"NULLIF(TRIM(split_part({x}, ' ', {n})), '')"


def email_ok(x: str) -> str:
    return f"COALESCE(regexp_full_match({x}, '{EMAIL}'), false)"


def clean_id(x: str, name: str) -> str:
    return f"({x} NOT ILIKE '%---%' AND lower({x}) <> '{name}')"


def to_bool(x: str) -> str:
    t = ", ".join(f"'{v}'" for v in C.TRUE_TOKENS)
    f = ", ".join(f"'{v}'" for v in C.FALSE_TOKENS)
    return f"CASE WHEN lower(TRIM({x})) IN ({t}) THEN true WHEN lower(TRIM({x})) IN ({f}) THEN false END"


def to_date(x: str) -> str:
    return f"CASE WHEN regexp_full_match(TRIM({x}), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(TRIM({x}) AS DATE) END"


def to_dec(x: str) -> str:
    return f"TRY_CAST(TRIM({x}) AS DECIMAL(12,2))"


def to_int(x: str) -> str:
    return f"TRY_CAST(TRY_CAST(TRIM({x}) AS DECIMAL(38,0)) AS INTEGER)"


def sk(*cols: str) -> str:
    return "md5(" + " || '-' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '{TOK}')" for c in cols) + ")"


def dup(keys: str, order: str = ORDER) -> str:
    return f"(ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) > 1)"


COLS = {
    "customers": "customer_sk, client_id, source_customer_id, first_name, last_name, full_name, email, "
                 "email_is_valid, source_customer_tier, canonical_customer_tier, signup_source, is_active",
    "orders": "order_sk, client_id, source_order_id, source_customer_id, order_date, order_date_is_missing, "
              "order_status, channel, customer_ref_is_valid",
    "products": "product_sk, client_id, source_sku, product_name, category, unit_price, unit_price_is_valid, "
                "currency, is_active",
    "transactions": "transaction_sk, client_id, source_transaction_id, source_order_id, source_customer_id, "
                    "order_date, order_date_is_missing, customer_first_name, customer_last_name, "
                    "customer_email, customer_email_is_valid, payment_method, payment_amount, "
                    "payment_amount_is_valid, payment_currency, has_line_items",
    "transaction_items": "item_sk, client_id, source_transaction_id, source_sku, item_description, quantity, "
                         "quantity_is_valid, unit_price, unit_price_is_valid, currency, line_total",
    "payments": "payment_sk, client_id, source_payment_id, source_order_id, payment_method, status, amount, "
                "amount_is_valid, is_refund, currency, processing_fee, source_type",
}
GOLD_REQUIRED = {
    "customers": "source_customer_id IS NOT NULL",
    "orders": "source_order_id IS NOT NULL",
    "products": "source_sku IS NOT NULL",
    "transactions": "source_transaction_id IS NOT NULL",
    "transaction_items": "source_transaction_id IS NOT NULL AND source_sku IS NOT NULL",
    "payments": "source_payment_id IS NOT NULL",
}


def silver_select(entity: str) -> str:
    return f"SELECT {COLS[entity]}, _is_duplicate, _source_file, _loaded_at FROM stg_{entity}"


def gold_select(entity: str) -> str:
    return (f"SELECT {COLS[entity]}, _loaded_at FROM stg_{entity} "
            f"WHERE NOT _is_duplicate AND {GOLD_REQUIRED[entity]}")


# ---------------------------------------------------------------------------
# CTEs, one per SILVER model (each returns public columns + lineage)
# ---------------------------------------------------------------------------
def cte_customers(raw_sql: str | None = None) -> str:
    raw_sql = raw_sql or D.raw_table_sql('customers')
    last_a = "NULLIF(NULLIF(TRIM(last_name), 'Unknown'), '')"
    tier = (f"CASE WHEN client_id = 'client_a' THEN {clean('loyalty_tier')} "
            f"ELSE NULLIF(NULLIF(TRIM(segment), 'UNKNOWN'), '') END")
    canon = "CASE upper(tier) " + " ".join(f"WHEN '{t}' THEN '{t}'" for t in C.CANONICAL_TIERS) + " END"
    return f"""
raw_customers AS ({raw_sql}),
c1 AS (
  SELECT client_id, {clean('customer_id')} AS source_customer_id,
    CASE WHEN client_id = 'client_a' THEN {clean('first_name')} ELSE {word(clean('customer_name'), 1)} END AS first_name,
    CASE WHEN client_id = 'client_a' THEN {last_a} ELSE {word(clean('customer_name'), 2)} END AS last_name,
    CASE WHEN client_id = 'client_a' THEN NULLIF(TRIM(concat_ws(' ', {clean('first_name')}, {last_a})), '')
         ELSE {clean('customer_name')} END AS full_name,
    {clean('email')} AS email, {email_ok(clean('email'))} AS email_is_valid,
    {tier} AS tier,
    CASE WHEN client_id = 'client_a' THEN {clean('signup_source')} END AS signup_source,
    {to_bool('is_active')} AS is_active,
    _source_file, _loaded_at, _split_start, _row_pos
  FROM raw_customers),
stg_customers AS (
  SELECT {sk('client_id', 'source_customer_id')} AS customer_sk, client_id, source_customer_id, first_name,
    last_name, full_name, email, email_is_valid, tier AS source_customer_tier,
    {canon} AS canonical_customer_tier, signup_source, is_active,
    {dup('client_id, source_customer_id')} AS _is_duplicate, _source_file, _loaded_at, _split_start, _row_pos
  FROM c1 WHERE {clean_id('source_customer_id', 'customer_id')})"""


def cte_orders(raw_sql: str | None = None, batch_col: str = "") -> str:
    raw_sql = raw_sql or D.raw_table_sql('orders')
    part = f"{batch_col}, client_id, source_order_id" if batch_col else "client_id, source_order_id"
    return f"""
raw_orders AS ({raw_sql}),
valid_customers AS (SELECT DISTINCT client_id, source_customer_id FROM stg_customers WHERE NOT _is_duplicate),
o1 AS (
  SELECT r.client_id, {clean('r.order_id')} AS source_order_id, {clean('r.customer_id')} AS source_customer_id,
    {to_date(clean('r.order_date'))} AS order_date, ({clean('r.order_date')} IS NULL) AS order_date_is_missing,
    {clean('r.order_status')} AS order_status,
    CASE WHEN r.client_id = 'client_a' THEN {clean('r.channel')} END AS channel,
    (vc.source_customer_id IS NOT NULL) AS customer_ref_is_valid,
    r._source_file, r._loaded_at, r._split_start, r._row_pos
  FROM raw_orders r LEFT JOIN valid_customers vc
    ON r.client_id = vc.client_id AND {clean('r.customer_id')} = vc.source_customer_id),
stg_orders AS (
  SELECT {sk('client_id', 'source_order_id')} AS order_sk, client_id, source_order_id, source_customer_id,
    order_date, order_date_is_missing, order_status, channel, customer_ref_is_valid,
    {dup(part)} AS _is_duplicate, _source_file, _loaded_at, _split_start, _row_pos
  FROM o1 WHERE {clean_id('source_order_id', 'order_id')})"""


def cte_products() -> str:
    return f"""
raw_products AS ({D.raw_table_sql('products')}),
p1 AS (
  SELECT client_id, {clean('sku')} AS source_sku, {clean('product_name')} AS product_name,
    {clean('category')} AS category, {to_dec('unit_price')} AS unit_price,
    ({to_dec('unit_price')} IS NOT NULL AND {to_dec('unit_price')} > 0) AS unit_price_is_valid,
    upper({clean('currency')}) AS currency, {to_bool('is_active')} AS is_active,
    _source_file, _loaded_at, _split_start, _row_pos
  FROM raw_products),
stg_products AS (
  SELECT {sk('client_id', 'source_sku')} AS product_sk, client_id, source_sku, product_name, category,
    unit_price, unit_price_is_valid, currency, is_active,
    {dup('client_id, source_sku')} AS _is_duplicate, _source_file, _loaded_at, _split_start, _row_pos
  FROM p1 WHERE {clean_id('source_sku', 'sku')})"""


def cte_payload() -> str:
    """Expected parse of the derived payload files, straight from the tables."""
    texts = ",\n    ".join(f"{e} AS {n}" for n, e in D.TXN_TEXT.items())
    g = "lpad(CAST(file_group AS VARCHAR), 5, '0')"
    redo = "CASE WHEN copy = 2 THEN 'redelivery_' ELSE '' END"
    fname = (f"CASE WHEN client_id = 'client_a' THEN 'client_a/ClientA_Transactions_' || {redo} || {g} || "
             f"CASE WHEN copy = 2 OR file_group % 2 = 0 THEN '.xml' ELSE '.txt' END "
             f"ELSE 'client_c/transactions_' || {redo} || {g} || '.json' END")
    return f"""
items_n AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey),
t0 AS (
  SELECT o_orderkey, o_custkey, {texts}, n_lines
  FROM orders LEFT JOIN items_n ON l_orderkey = o_orderkey),
t1 AS (
  SELECT *, 0 AS copy FROM t0
  UNION ALL SELECT *, 1 AS copy FROM t0 WHERE o_orderkey % 20 = 0
  UNION ALL SELECT *, 2 AS copy FROM t0 WHERE o_orderkey % 10 = 0),
src AS (
  SELECT *, CASE WHEN client_id = 'client_a' THEN 'xml' ELSE 'json' END AS fmt,
    {fname} AS _source_file,
    CASE WHEN copy = 2 THEN TIMESTAMP '{D.LOAD_2}' ELSE TIMESTAMP '{D.LOAD_1}' END AS _loaded_at,
    CAST(0 AS BIGINT) AS _split_start,
    -- XML: one record per chunk; JSON: one document per file, transactions in it
    CASE WHEN client_id = 'client_a' THEN CAST(2 * o_orderkey + copy AS BIGINT) ELSE CAST(0 AS BIGINT) END AS _row_pos,
    CASE WHEN client_id = 'client_a' THEN CAST(0 AS BIGINT) ELSE CAST(2 * o_orderkey + copy AS BIGINT) END AS _txn_pos
  FROM t1)"""


def cte_transactions() -> str:
    return f"""
tx1 AS (
  SELECT client_id, {clean('txn_id')} AS source_transaction_id, {clean('order_id')} AS source_order_id,
    {clean('customer_id')} AS source_customer_id, {to_date(clean('order_date'))} AS order_date,
    CASE WHEN fmt = 'xml' THEN {clean('first_name')} ELSE {word(clean('customer_name'), 1)} END AS customer_first_name,
    CASE WHEN fmt = 'xml' THEN {clean('last_name')} ELSE {word(clean('customer_name'), 2)} END AS customer_last_name,
    {clean('email')} AS customer_email, {clean('payment_method')} AS payment_method,
    {to_dec('amount')} AS payment_amount, upper({clean('currency')}) AS payment_currency,
    CASE WHEN items_mode = 'lines' THEN COALESCE(n_lines, 0) > 0 ELSE false END AS has_line_items,
    _source_file, _loaded_at, _split_start, _row_pos, _txn_pos
  FROM src),
stg_transactions AS (
  SELECT {sk('client_id', 'source_transaction_id')} AS transaction_sk, client_id, source_transaction_id,
    source_order_id, source_customer_id, order_date, (order_date IS NULL) AS order_date_is_missing,
    customer_first_name, customer_last_name, customer_email, {email_ok('customer_email')} AS customer_email_is_valid,
    payment_method, payment_amount, (payment_amount IS NOT NULL AND payment_amount > 0) AS payment_amount_is_valid,
    payment_currency, has_line_items,
    {dup('client_id, source_transaction_id', ORDER + ', _txn_pos')} AS _is_duplicate,
    _source_file, _loaded_at, _split_start, _row_pos
  FROM tx1
  WHERE source_transaction_id IS NOT NULL AND {clean_id('source_transaction_id', 'transaction_id')})"""


def cte_items() -> str:
    texts = ",\n    ".join(f"{e} AS i_{n}" for n, e in D.ITEM_TEXT.items())
    order = ", ".join(D.ITEM_ORDER)
    return f"""
li AS (
  SELECT l_orderkey, {texts},
    ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {order}) - 1 AS _item_pos
  FROM lineitem),
it1 AS (
  SELECT s.client_id, {clean('s.txn_id')} AS source_transaction_id, {clean('li.i_sku')} AS source_sku,
    {clean('li.i_description')} AS item_description, {to_int('li.i_qty')} AS quantity,
    {to_dec('li.i_price')} AS unit_price, upper({clean('li.i_currency')}) AS currency,
    s._source_file, s._loaded_at, s._split_start, s._row_pos, s._txn_pos, li._item_pos
  FROM src s JOIN li ON li.l_orderkey = s.o_orderkey
  WHERE s.items_mode = 'lines'),
stg_transaction_items AS (
  SELECT {sk('client_id', 'source_transaction_id', 'source_sku')} AS item_sk, client_id, source_transaction_id,
    source_sku, item_description, quantity, (quantity IS NOT NULL AND quantity > 0) AS quantity_is_valid,
    unit_price, (unit_price IS NOT NULL AND unit_price > 0) AS unit_price_is_valid, currency,
    CASE WHEN quantity > 0 AND unit_price > 0 THEN CAST(quantity * unit_price AS DECIMAL(12,2)) END AS line_total,
    {dup('client_id, source_transaction_id, source_sku', ORDER + ', _txn_pos, _item_pos')} AS _is_duplicate,
    _source_file, _loaded_at, _split_start, _row_pos
  FROM it1
  WHERE source_transaction_id IS NOT NULL AND {clean_id('source_transaction_id', 'transaction_id')}
    AND {clean_id('source_sku', 'sku')})"""


def cte_payments() -> str:
    xml_prefix = C.EMBEDDED_PAYMENT_PREFIX["transaction_xml"]
    json_prefix = C.EMBEDDED_PAYMENT_PREFIX["transaction_json"]
    return f"""
raw_payments AS ({D.raw_table_sql('payments')}),
pay_csv AS (
  SELECT client_id, {clean('payment_id')} AS source_payment_id, {clean('order_id')} AS source_order_id,
    {clean('payment_method')} AS payment_method, {clean('status')} AS status, {to_dec('amount')} AS amount,
    upper({clean('currency')}) AS currency, CAST(NULL AS DECIMAL(12,2)) AS processing_fee,
    'payments_csv' AS source_type, _source_file, _loaded_at, _split_start, _row_pos, CAST(0 AS BIGINT) AS _txn_pos
  FROM raw_payments),
pay_txn AS (
  SELECT client_id,
    CASE WHEN fmt = 'xml' THEN '{xml_prefix}' ELSE '{json_prefix}' END || {clean('txn_id')} AS source_payment_id,
    {clean('order_id')} AS source_order_id, {clean('payment_method')} AS payment_method,
    CAST(NULL AS VARCHAR) AS status, {to_dec('amount')} AS amount, upper({clean('currency')}) AS currency,
    CASE WHEN fmt = 'xml' THEN {to_dec('processing_fee')} END AS processing_fee,
    CASE WHEN fmt = 'xml' THEN 'transaction_xml' ELSE 'transaction_json' END AS source_type,
    _source_file, _loaded_at, _split_start, _row_pos, _txn_pos
  FROM src WHERE {clean('txn_id')} IS NOT NULL),
pay_all AS (SELECT * FROM pay_csv UNION ALL SELECT * FROM pay_txn),
stg_payments AS (
  SELECT {sk('client_id', 'source_payment_id')} AS payment_sk, client_id, source_payment_id, source_order_id,
    payment_method, status, amount, (amount IS NOT NULL AND amount > 0) AS amount_is_valid,
    (COALESCE(amount < 0, false) OR COALESCE(upper(status) = 'REFUNDED', false)) AS is_refund,
    currency, processing_fee, source_type,
    {dup('client_id, source_payment_id', ORDER + ', _txn_pos')} AS _is_duplicate,
    _source_file, _loaded_at, _split_start, _row_pos
  FROM pay_all
  WHERE source_payment_id IS NOT NULL AND {clean_id('source_payment_id', 'payment_id')})"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip() and c for c in ctes)


CTES = {
    "customers": [cte_customers],
    "orders": [cte_customers, cte_orders],
    "products": [cte_products],
    "transactions": [cte_payload, cte_transactions],
    "transaction_items": [cte_payload, cte_items],
    "payments": [cte_payload, cte_payments],
}


def model_sql(entity: str, layer: str) -> str:
    head = with_ctes(*[f() for f in CTES[entity]])
    body = silver_select(entity) if layer == "silver" else gold_select(entity)
    return f"{head}\n{body}"



# ---------------------------------------------------------------------------
# Quarantine, rejects, checks, freshness, masking, parsing, merges
# ---------------------------------------------------------------------------
from tidemark.operators import checks as K  # noqa: E402
from tidemark.sources import readable as R  # noqa: E402
from tidemark.plans import queries as Q  # noqa: E402


def _garbage(col: str, name: str) -> str:
    return f"({col} IS NOT NULL AND NOT COALESCE({clean_id(col, name)}, false))"


def quarantine_all_sql() -> str:
    head = with_ctes(cte_customers(), cte_orders(), cte_products(), cte_payload(), cte_transactions(),
                     cte_items(), cte_payments())
    sel = "SELECT '{e}' AS entity, client_id, {r} AS quarantine_reason, _source_file, _loaded_at FROM {t} WHERE {c}"
    parts = [
        sel.format(e="customers", r="'missing customer id'", t="c1", c="source_customer_id IS NULL"),
        sel.format(e="orders", r="'missing order id'", t="raw_orders", c=f"{clean('order_id')} IS NULL"),
        sel.format(e="products", r="'missing sku'", t="p1", c="source_sku IS NULL"),
        sel.format(e="transactions", r="'missing transaction id'", t="tx1", c="source_transaction_id IS NULL"),
        sel.format(e="transaction_items", t="it1",
                   c=f"(source_transaction_id IS NULL OR source_sku IS NULL) AND NOT ("
                     f"{_garbage('source_transaction_id', 'transaction_id')} OR {_garbage('source_sku', 'sku')})",
                   r="CASE WHEN source_transaction_id IS NULL THEN 'missing transaction id' ELSE 'missing sku' END"),
        sel.format(e="payments", t="pay_all",
                   c=f"(source_payment_id IS NULL OR source_order_id IS NULL) AND NOT "
                     f"{_garbage('source_payment_id', 'payment_id')}",
                   r="CASE WHEN source_payment_id IS NULL THEN 'missing payment id' ELSE 'missing order id' END"),
    ]
    return head + "\n" + "\nUNION ALL\n".join(parts)


def _strict_raw_customers() -> str:
    cols = []
    for c in ["client_id"] + D.ALL_RAW_COLUMNS["customers"] + ["_source_file", "_loaded_at", "_split_start", "_row_pos"]:
        cols.append(f"{Q.STRICT_PLANT[c]} AS {c}" if c in Q.STRICT_PLANT else c)
    return f"SELECT {', '.join(cols)} FROM ({D.raw_table_sql('customers')}) r"


def _reject_reason() -> str:
    rules = [("client_id IS NULL", "client_id is null"), ("_source_file IS NULL", "_source_file is null"),
             ("_loaded_at IS NULL", "_loaded_at is null"),
             (f"length(client_id) > {C.CLIENT_ID_WIDTH}", "client_id too wide"),
             (f"length(_source_file) > {C.SOURCE_FILE_WIDTH}", "_source_file too wide")]
    rules += [(f"length({c}) > {n}", f"{c} longer than {n}") for c, n in C.RAW_COLUMNS["customers"]]
    return "CASE " + " ".join(f"WHEN {w} THEN '{r}'" for w, r in rules) + " END"


def raw_width_rejects_sql() -> str:
    return (f"WITH raw AS ({_strict_raw_customers()}), tagged AS (SELECT *, {_reject_reason()} AS reject_reason FROM raw)\n"
            "SELECT client_id, customer_id, reject_reason, _source_file, _loaded_at FROM tagged "
            "WHERE reject_reason IS NOT NULL")


def rejects_and_rows_balance_sql() -> str:
    good = f"SELECT * EXCLUDE (reject_reason) FROM (SELECT *, {_reject_reason()} AS reject_reason FROM ({_strict_raw_customers()}) a) b WHERE reject_reason IS NULL"
    head = with_ctes(f"\nstrict_raw AS ({_strict_raw_customers()})", cte_customers(good))
    return head + f"""
SELECT 'raw_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM strict_raw
UNION ALL SELECT 'rejected', CAST(count(*) AS BIGINT) FROM (SELECT {_reject_reason()} AS r FROM strict_raw) x WHERE r IS NOT NULL
UNION ALL SELECT 'silver_rows', CAST(count(*) AS BIGINT) FROM stg_customers
UNION ALL SELECT 'quarantined', CAST(count(*) AS BIGINT) FROM c1 WHERE source_customer_id IS NULL
UNION ALL SELECT 'garbage_rows', CAST(count(*) AS BIGINT) FROM c1
  WHERE source_customer_id IS NOT NULL AND NOT COALESCE({clean_id('source_customer_id', 'customer_id')}, false)"""


def _check_sql(ck) -> str:
    t = ck.model
    w = f" AND ({ck.where})" if ck.where else ""
    if ck.kind == "not_null":
        q = f"SELECT count(*) FROM {t} WHERE {ck.column} IS NULL{w}"
    elif ck.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in ck.values)
        q = f"SELECT count(*) FROM {t} WHERE {ck.column} IS NOT NULL AND {ck.column} NOT IN ({vals}){w}"
    elif ck.kind == "unique":
        q = (f"SELECT count(*) FROM (SELECT {ck.column} FROM {t} WHERE {ck.column} IS NOT NULL{w} "
             f"GROUP BY {ck.column} HAVING count(*) > 1) d")
    elif ck.kind == "relationships":
        pm, pc = ck.to
        q = (f"SELECT count(*) FROM {t} c WHERE c.{ck.column} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {pm} p WHERE p.{pc} = c.{ck.column})")
    else:  # type_number: by the type that the column has in DuckDB; an empty model has nothing to fail
        q = (f"SELECT COALESCE(max(CASE WHEN typeof({ck.column}) LIKE 'DECIMAL%' OR typeof({ck.column}) IN "
             f"('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', 'FLOAT', 'DOUBLE') THEN 0 ELSE 1 END), 0) FROM {t}")
    return (f"SELECT '{t}' AS model, '{ck.column}' AS column_name, '{ck.kind}' AS check, '{ck.severity}' AS severity, "
            f"CAST(({q}) AS BIGINT) AS failures")


def dq_report_sql() -> str:
    marts = [f"\nmart_{e} AS ({gold_select(e)})" for e in COLS]
    head = with_ctes(cte_customers(), cte_orders(), cte_products(), cte_payload(), cte_transactions(),
                     cte_items(), cte_payments(),
                     "\nraw_transactions AS (SELECT client_id, 'payload' AS raw_payload, _loaded_at FROM src)",
                     *marts)
    body = "\nUNION ALL\n".join(_check_sql(ck) for ck in K.declared_checks())
    return (head + f"\nSELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
            f"ELSE 'fail' END AS status FROM (\n{body}\n) r")


def source_freshness_sql() -> str:
    run = Q.FRESHNESS_RUN_TS
    return f"""
SELECT event_type AS source, max(ts) AS max_loaded_at,
  CAST(date_diff('second', max(ts), TIMESTAMP '{run}') AS BIGINT) AS age_seconds,
  CASE WHEN max(ts) IS NULL THEN 'error'
       WHEN date_diff('second', max(ts), TIMESTAMP '{run}') / 3600.0 > {C.FRESHNESS_ERROR_HOURS} THEN 'error'
       WHEN date_diff('second', max(ts), TIMESTAMP '{run}') / 3600.0 > {C.FRESHNESS_WARN_HOURS} THEN 'warn'
       ELSE 'pass' END AS status
FROM events GROUP BY event_type"""


def _mask(x: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace({x}, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')"


def mask_pii_sql() -> str:
    head = with_ctes(cte_customers())
    return (head + f"\nSELECT customer_sk, client_id, sha256(email) AS email, {_mask('first_name')} AS first_name, "
            f"{_mask('last_name')} AS last_name, {_mask('full_name')} AS full_name FROM stg_customers "
            f"WHERE NOT _is_duplicate AND source_customer_id IS NOT NULL")


def mask_tagged_sql() -> str:
    how = {"hash": lambda c: f"sha256({c})", "mask": _mask}
    parts = []
    for e, cols in COLS.items():
        names = [c.strip() for c in cols.split(",")]
        shown = [how[C.MASK_BY_TAG[C.PII_TAGS[c]]](c) if c in C.PII_TAGS else f"CAST({c} AS VARCHAR)" for c in names]
        text = " || '|' || ".join(f"COALESCE({x}, '~')" for x in shown)
        parts.append(f"SELECT '{e}' AS entity, {text} AS row_text FROM ({gold_select(e)}) g_{e}")
    head = with_ctes(cte_customers(), cte_orders(), cte_products(), cte_payload(), cte_transactions(), cte_items(), cte_payments())
    return head + "\n" + "\nUNION ALL\n".join(parts)


def payload_drift_sql() -> str:
    """What the derivation puts into the JSON documents, counted from the tables."""
    docs = "SELECT DISTINCT _source_file FROM src WHERE fmt = 'json'"
    txn = "SELECT * FROM src WHERE fmt = 'json'"
    item = f"SELECT li.* FROM ({txn}) s JOIN li ON li.l_orderkey = s.o_orderkey WHERE s.items_mode = 'lines'"
    seen = [("client", docs, "TRUE"), ("batchTimestamp", docs, "TRUE"), ("transactions", docs, "TRUE"), ("transactions[]", txn, "TRUE")]
    t = "transactions[]"
    seen += [(f"{t}.{p}", txn, c) for p, c in {
        "id": "txn_id IS NOT NULL", "order": "TRUE", "order.id": "order_id IS NOT NULL", "order.date": "order_date IS NOT NULL",
        "order.customer": "TRUE", "order.customer.id": "customer_id IS NOT NULL", "order.customer.name": "customer_name IS NOT NULL",
        "order.customer.email": "email IS NOT NULL", "items": "items_mode <> 'absent'", "payment": "TRUE",
        "payment.method": "payment_method IS NOT NULL", "payment.total": "amount IS NOT NULL", "payment.currency": "currency IS NOT NULL",
        "metadata": "drift", "metadata.channel": "drift"}.items()]
    seen += [(f"{t}.items[]{p}", item, c) for p, c in {
        "": "TRUE", ".sku": "i_sku IS NOT NULL", ".description": "i_description IS NOT NULL", ".qty": "i_qty IS NOT NULL",
        ".price": "TRUE", ".price.amount": "i_price IS NOT NULL", ".price.currency": "i_currency IS NOT NULL"}.items()]
    counts = "\nUNION ALL\n".join(f"SELECT 'client_c' AS client_id, '{p}' AS path, CAST(count(*) AS BIGINT) AS n, "
                                   f"{'FALSE' if 'metadata' in p else 'TRUE'} AS known FROM ({rows}) r WHERE {c}" for p, rows, c in seen)
    texts = ", ".join(f"{e} AS i_{n}" for n, e in D.ITEM_TEXT.items())
    return with_ctes(cte_payload(), f"\nli AS (SELECT l_orderkey, {texts} FROM lineitem)") + f"\nSELECT * FROM ({counts}) c WHERE n > 0"


def keep_first_stream_sql() -> str:
    l1, l2 = D.LOAD_1, D.LOAD_2
    late = f"COALESCE({to_date(clean('order_date'))} >= DATE '{Q.SPLIT_DATE}', false)"
    base = (f"SELECT * REPLACE (CASE WHEN {late} OR _loaded_at = TIMESTAMP '{l2}' THEN TIMESTAMP '{l2}' "
            f"ELSE TIMESTAMP '{l1}' END AS _loaded_at) FROM ({D.raw_table_sql('orders')}) r0")
    raw = (f"SELECT * FROM base UNION ALL BY NAME SELECT * REPLACE ('REDELIVERED' AS order_status, TIMESTAMP '{l2}' AS _loaded_at) "
           f"FROM base WHERE _loaded_at = TIMESTAMP '{l1}' AND _row_pos % 5 = 0 "
           f"UNION ALL BY NAME SELECT * FROM base WHERE _loaded_at = TIMESTAMP '{l1}'")
    return with_ctes(f"\nbase AS ({base})", cte_customers(), cte_orders(raw)) + "\n" + gold_select("orders")


def bad_files_sql() -> str:
    cols = [c for c, _ in C.RAW_COLUMNS["products"]]
    null = {c: f"CASE WHEN {c} IS NULL OR {c} IN ('', 'NULL', 'null') THEN NULL ELSE {c} END AS {c}" for c in cols}
    none = "CAST(NULL AS BIGINT) AS grp, CAST(NULL AS VARCHAR) AS reject_reason"
    empty = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in cols)
    parts = [
        f"SELECT 'csv' AS fmt, client_id, {', '.join(null.values())}, {none} FROM r WHERE grp NOT IN ({Q.CUT_FILE}, {Q.LATIN_FILE})",
        f"SELECT 'parquet', client_id, {', '.join(cols)}, {none} FROM r WHERE grp <> {Q.CUT_PARQUET}"]
    for fmt, grp, reason in (("csv", Q.CUT_FILE, R.UNREADABLE), ("csv", Q.LATIN_FILE, R.NOT_UTF8), ("parquet", Q.CUT_PARQUET, R.UNREADABLE)):
        parts.append(f"SELECT DISTINCT '{fmt}', client_id, {empty}, CAST({grp} AS BIGINT), '{reason}' FROM r WHERE grp = {grp}")
    raw = f"SELECT * REPLACE ({Q.ACCENTED} AS product_name), {Q.FILE_NUMBER} AS grp FROM ({D.raw_table_sql('products')}) r0"
    return f"WITH r AS ({raw})\n" + "\nUNION ALL\n".join(parts)


def parse_sql(fmt: str) -> str:
    head = with_ctes(cte_payload())
    xml = fmt == "xml"
    f = lambda c, on=True: clean(c) if on else "CAST(NULL AS VARCHAR)"
    return head + f"""
SELECT client_id, _source_file, _loaded_at, {clean('txn_id')} AS txn_id, {clean('order_id')} AS order_id,
  {clean('order_date')} AS order_date, {clean('customer_id')} AS customer_id,
  {f('first_name', xml)} AS first_name, {f('last_name', xml)} AS last_name,
  {f('customer_name', not xml)} AS customer_name, {clean('email')} AS email,
  {clean('payment_method')} AS payment_method, {clean('amount')} AS amount, {clean('currency')} AS currency,
  {f('processing_fee', xml)} AS processing_fee,
  CASE WHEN items_mode = 'lines' THEN COALESCE(n_lines, 0) ELSE 0 END AS n_items
FROM src WHERE fmt = '{fmt}'"""


def merge_sql(latest_batch_wins: bool) -> str:
    l1, l2 = D.LOAD_1, D.LOAD_2
    late = f"COALESCE({to_date(clean('order_date'))} >= DATE '{Q.SPLIT_DATE}', false)"
    raw = (f"SELECT * REPLACE (CASE WHEN {late} OR _loaded_at = TIMESTAMP '{l2}' THEN TIMESTAMP '{l2}' "
           f"ELSE TIMESTAMP '{l1}' END AS _loaded_at) FROM ({D.raw_table_sql('orders')}) r0")
    head = with_ctes(cte_customers(), cte_orders(raw, batch_col="_loaded_at"),
                     f"\ng AS ({gold_select('orders')})",
                     f"\ng1 AS (SELECT * FROM g WHERE _loaded_at = TIMESTAMP '{l1}')",
                     f"\ng2 AS (SELECT * FROM g WHERE _loaded_at = TIMESTAMP '{l2}')")
    if latest_batch_wins:
        return head + "\nSELECT * FROM g2 UNION ALL SELECT * FROM g1 WHERE order_sk NOT IN (SELECT order_sk FROM g2)"
    return head + "\nSELECT * FROM g1 UNION ALL SELECT * FROM g2 WHERE order_sk NOT IN (SELECT order_sk FROM g1)"


def three_days_sql() -> str:
    l1, l2, l3 = D.LOAD_1, D.LOAD_2, Q.LOAD_3
    late = f"COALESCE({to_date(clean('order_date'))} >= DATE '{Q.SPLIT_DATE}', false)"
    base = (f"SELECT * REPLACE (CASE WHEN {late} OR _loaded_at = TIMESTAMP '{l2}' THEN TIMESTAMP '{l2}' "
            f"ELSE TIMESTAMP '{l1}' END AS _loaded_at) FROM ({D.raw_table_sql('orders')}) r0")
    again = ("SELECT * REPLACE ('{status}' AS order_status, TIMESTAMP '{ts}' AS _loaded_at, 'again/' || _source_file AS _source_file) "
             "FROM three_base WHERE {where}")
    raw = ("SELECT * FROM three_base UNION ALL BY NAME "
           + again.format(status="REDELIVERED", ts=l2, where=f"_loaded_at = TIMESTAMP '{l1}' AND _row_pos % 5 = 0")
           + " UNION ALL BY NAME " + again.format(status="THIRD", ts=l3, where="_row_pos % 7 = 0"))
    head = with_ctes(f"\nthree_base AS ({base})", cte_customers(), cte_orders(raw, batch_col="_loaded_at"), f"\ng AS ({gold_select('orders')})")
    pick = ("SELECT *, CAST(1 AS BIGINT) AS n_counting, '{mode}' AS mode FROM g "
            "QUALIFY row_number() OVER (PARTITION BY order_sk ORDER BY _loaded_at {way}) = 1")
    return f"{head}\n{pick.format(mode='latest', way='DESC')}\nUNION ALL\n{pick.format(mode='first', way='ASC')}"


def schema_change_sql() -> str:
    head = with_ctes(cte_customers(), cte_orders(), f"\ng AS ({gold_select('orders')})")
    late = f"COALESCE(order_date >= DATE '{Q.SPLIT_DATE}', false)"
    second = f"{late} OR length(source_order_id) % 2 = 0"
    return head + (f"\nSELECT *, TIMESTAMP '{Q.RUN_TS}' AS _updated_at FROM g WHERE {second}\nUNION ALL\n"
                   f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS channel), CAST(NULL AS TIMESTAMP) AS _updated_at FROM g WHERE NOT ({second})")


def type_sync_sql() -> str:
    return ("SELECT CAST(p_partkey AS BIGINT) AS key, CASE WHEN p_partkey % 7 = 0 THEN 'x' || p_size "
            "WHEN p_partkey % 5 = 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) "
            "ELSE CAST(CAST(p_size AS DECIMAL(12,2)) AS VARCHAR) END AS v FROM part")


def json_documents_sql() -> str:
    return f"SELECT * REPLACE (regexp_extract(_source_file, '[^/]+$') AS _source_file) FROM ({parse_sql('json')}) p"


def payload_rejects_sql() -> str:
    return with_ctes(cte_payload()) + """
SELECT client_id, _source_file, reject_reason, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT client_id, _source_file, CASE WHEN num % 47 = 0 THEN 'raw_payload is null'
      WHEN num % 43 = 0 THEN 'raw_payload does not parse' END AS reject_reason
  FROM (SELECT *, TRY_CAST(regexp_extract(txn_id, '([0-9]+)', 1) AS BIGINT) AS num FROM src WHERE fmt = 'xml') x
  UNION ALL SELECT DISTINCT client_id, _source_file, 'raw_payload does not parse' FROM src WHERE fmt = 'json' AND file_group % 3 = 0) r
WHERE reject_reason IS NOT NULL GROUP BY client_id, _source_file, reject_reason"""


def parquet_landing_sql() -> str:
    return (f"SELECT client_id, sku, product_name, category, unit_price, currency, is_active, client_id || '/products' AS folder, "
            f"TIMESTAMP '{Q.LOAD_TS}' AS _loaded_at FROM ({D.raw_table_sql('products')}) r")


def all_sources_sql() -> str:
    parts = []
    for spec in C.CSV_SOURCES:
        name = Q.NAMES.get(spec.entity, {}).get(spec.client_id)
        text = []
        for c, _ in C.RAW_COLUMNS[spec.entity]:
            v = "NULL" if c not in spec.columns else Q.QUOTED_PLANT.format(c=c) if c == name else c
            text.append(f"CASE WHEN {v} IS NULL OR {v} IN ('', 'NULL', 'null') THEN '~' ELSE {v} END" if c in spec.columns else "'~'")
        parts.append(f"SELECT '{spec.entity}' AS entity, client_id, {" || '|' || ".join(text)} AS row_text "
                     f"FROM ({D.raw_table_sql(spec.entity)}) r WHERE client_id = '{spec.client_id}'")
    parts.append("SELECT 'transactions', client_id, COALESCE(txn_id, '') FROM src WHERE fmt = 'xml'")
    return with_ctes(cte_payload()) + "\n" + "\nUNION ALL\n".join(parts)


def _product_rows(with_frame: bool) -> str:
    spec = D.RAW_SPECS["products"]
    v = spec.columns

    def last(x, when):  # an inline note after the last field takes its trailing blanks with it
        return f"CASE WHEN {D.NOTE_ROW} AND {when} THEN regexp_replace({x}, '\\s+$', '') ELSE {x} END"
    short = D.SHORT_ROW
    full = f"NOT ({D.SHORT_ROW}) AND NOT ({D.LONG_ROW})"  # a long row's note sits in the extra field
    rows = f"""
SELECT {spec.client} AS client_id, CAST(FLOOR(p_partkey / {D.PRODUCT_FILE_ROWS}) AS BIGINT) AS file_group,
  {v['sku']} AS sku, {v['product_name']} AS product_name, {v['category']} AS category,
  CASE WHEN {short} THEN {last(v['unit_price'], 'TRUE')} ELSE {v['unit_price']} END AS unit_price,
  CASE WHEN {short} THEN NULL ELSE {v['currency']} END AS currency,
  CASE WHEN {short} THEN NULL ELSE {last(v['is_active'], full)} END AS is_active
FROM part"""
    sel = "SELECT client_id, sku, product_name, category, unit_price, currency, is_active FROM"
    if not with_frame:
        return f"{sel} ({rows}) r"
    hdr = ", ".join(f"'{h}' AS {h}" for h in D.PRODUCT_HEADER.split(","))
    return f"""WITH r AS ({rows}), g AS (SELECT DISTINCT client_id, file_group FROM r)
{sel} r
UNION ALL SELECT client_id, {hdr} FROM g
UNION ALL SELECT client_id, '----- END OF FILE -----', NULL, NULL, NULL, NULL, NULL FROM g"""


def oracles() -> dict[str, str]:
    out = {}
    for e in CTES:
        out[f"stg_{e}"] = model_sql(e, "silver")
        out[f"mart_{e}"] = model_sql(e, "gold")
    out.update({
        "quarantine_all": quarantine_all_sql(),
        "raw_width_rejects": raw_width_rejects_sql(),
        "rejects_and_rows_balance": rejects_and_rows_balance_sql(),
        "dq_report": dq_report_sql(),
        "source_freshness": source_freshness_sql(),
        "mask_pii": mask_pii_sql(),
        "mask_tagged": mask_tagged_sql(),
        "payload_drift": payload_drift_sql(),
        "stream_orders_keep_first": keep_first_stream_sql(),
        "bad_files": bad_files_sql(),
        "parse_json_transactions": parse_sql("json"),
        "parse_xml_transactions": parse_sql("xml"),
        "incremental_three_days": three_days_sql(),
        "incremental_schema_change": schema_change_sql(),
        "schema_type_sync": type_sync_sql(),
        "late_customers": model_sql("orders", "gold"),
        "reload_same_load_time": model_sql("orders", "gold"),
        "scan_json_documents": json_documents_sql(),
        "payload_rejects": payload_rejects_sql(),
        "scan_parquet_landing": parquet_landing_sql(),
        "incremental_merge": merge_sql(True),
        "incremental_keep_first": merge_sql(False),
        "scan_text_nulls": _product_rows(False),
        "scan_file_once": _product_rows(True),
        "scan_all_sources": all_sources_sql(),
        "stream_events_incremental": "SELECT event_id, ts, user_id, event_type, "
                                     "CASE WHEN event_id % 10 = 0 THEN value + 1.0 ELSE value END AS value, "
                                     "props FROM events",
    })
    return out
