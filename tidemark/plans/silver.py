"""SILVER models K1-K6: clean, type, flag and de-duplicate RAW rows.

Each model is a lazy DataFrame -> DataFrame function. Order of work inside a
model: clean every field (the key first), drop garbage ids, flag duplicates,
project. The garbage-id filter references only key columns, so Catalyst runs
it before the duplicate flag's shuffle.

Every model returns its public columns plus the lineage position columns
(`_split_start`, `_row_pos`, and `_item_pos` for items) used as the row
identity by the SILVER merge; `public()` drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.config import Options
from tidemark.functions import columns as X
from tidemark.operators.dedup import flag_duplicates
from tidemark.operators.mask import tagged
from tidemark.sources.payload import parse_transactions

# Output columns of the SILVER models, in order.
SILVER_COLUMNS = {
    "customers": ["customer_sk", "client_id", "source_customer_id", "first_name", "last_name",
                  "full_name", "email", "email_is_valid", "source_customer_tier",
                  "canonical_customer_tier", "signup_source", "is_active", "_is_duplicate",
                  "_source_file", "_loaded_at"],
    "orders": ["order_sk", "client_id", "source_order_id", "source_customer_id", "order_date",
               "order_date_is_missing", "order_status", "channel", "customer_ref_is_valid",
               "_is_duplicate", "_source_file", "_loaded_at"],
    "products": ["product_sk", "client_id", "source_sku", "product_name", "category", "unit_price",
                 "unit_price_is_valid", "currency", "is_active", "_is_duplicate", "_source_file",
                 "_loaded_at"],
    "transactions": ["transaction_sk", "client_id", "source_transaction_id", "source_order_id",
                     "source_customer_id", "order_date", "order_date_is_missing",
                     "customer_first_name", "customer_last_name", "customer_email",
                     "customer_email_is_valid", "payment_method", "payment_amount",
                     "payment_amount_is_valid", "payment_currency", "has_line_items",
                     "_is_duplicate", "_source_file", "_loaded_at"],
    "transaction_items": ["item_sk", "client_id", "source_transaction_id", "source_sku",
                          "item_description", "quantity", "quantity_is_valid", "unit_price",
                          "unit_price_is_valid", "currency", "line_total", "_is_duplicate",
                          "_source_file", "_loaded_at"],
    "payments": ["payment_sk", "client_id", "source_payment_id", "source_order_id",
                 "payment_method", "status", "amount", "amount_is_valid", "is_refund", "currency",
                 "processing_fee", "source_type", "_is_duplicate", "_source_file", "_loaded_at"],
}
POSITION_COLUMNS = {e: ["_split_start", "_row_pos"] for e in SILVER_COLUMNS}
for _e in ("transactions", "payments"):
    POSITION_COLUMNS[_e] = ["_split_start", "_row_pos", "_txn_pos"]
POSITION_COLUMNS["transaction_items"] = ["_split_start", "_row_pos", "_txn_pos", "_item_pos"]

_LINEAGE = ["_source_file", "_loaded_at", "_split_start", "_row_pos"]
_TXN_LINEAGE = [*_LINEAGE, "_txn_pos"]             # rows parsed from payloads
_TXN_ORDER = (*C.ORDER_COLUMNS, "_txn_pos")


def key_columns(entity: str) -> list[str]:
    """The columns that the surrogate key is made of."""
    return ["client_id", "source_transaction_id", "source_sku"] if entity == "transaction_items" else ["client_id", C.ENTITY_KEYS[entity][1]]


def public(df: DataFrame, entity: str) -> DataFrame:
    return df.select(*SILVER_COLUMNS[entity])


def keyed(cleaned: DataFrame, entity: str, keys=None) -> DataFrame:
    """Garbage-id filter and surrogate key."""
    header, source_col, sk = C.ENTITY_KEYS[entity]
    keys = keys or ["client_id", source_col]
    return cleaned.filter(X.is_clean_id(source_col, header)).withColumn(sk, X.surrogate_key(*keys))


def _finish(cleaned: DataFrame, entity: str, keys=None, order=C.ORDER_COLUMNS,
            opts: Options = Options()) -> DataFrame:
    """Garbage-id filter, surrogate key, duplicate flag, projection with the tags of personal columns."""
    keys = keys or ["client_id", C.ENTITY_KEYS[entity][1]]
    header, source_col, sk = C.ENTITY_KEYS[entity]
    flagged = flag_duplicates(cleaned.filter(X.is_clean_id(source_col, header)), keys, order, strategy=opts.dedup_strategy)
    flagged = flagged.withColumn(sk, X.surrogate_key(*keys))  # after the shuffles: a digest does not compress
    return flagged.select(*[tagged(c) for c in SILVER_COLUMNS[entity]], *POSITION_COLUMNS[entity])


# ---------------------------------------------------------------------------
# K1 customers
# ---------------------------------------------------------------------------
def clean_customers(raw: DataFrame, opts: Options = Options()) -> DataFrame:
    is_a = F.col("client_id") == F.lit("client_a")
    name = X.clean_string("customer_name")
    first_a = X.clean_string("first_name")
    last_a = X.null_if_sentinel("last_name", C.LAST_NAME_SENTINEL)
    # a sentinel that trims to '' is no name either
    last_a = F.nullif(last_a, F.lit(""))
    tier = F.when(is_a, X.clean_string("loyalty_tier")).otherwise(
        F.nullif(X.null_if_sentinel("segment", C.SEGMENT_SENTINEL), F.lit("")))
    return raw.select(
        "client_id",
        X.clean_string("customer_id").alias("source_customer_id"),
        F.when(is_a, first_a).otherwise(X.word(name, 1)).alias("first_name"),
        F.when(is_a, last_a).otherwise(X.word(name, 2)).alias("last_name"),
        F.when(is_a, X.full_name(first_a, last_a, opts.strict_full_name)).otherwise(name).alias("full_name"),
        X.clean_string("email").alias("email"),
        X.is_valid_email(X.clean_string("email")).alias("email_is_valid"),
        tier.alias("source_customer_tier"),
        X.canonical_tier(tier, opts.tier_map).alias("canonical_customer_tier"),
        F.when(is_a, X.clean_string("signup_source")).alias("signup_source"),
        X.to_bool("is_active").alias("is_active"),
        *_LINEAGE,
    )


def stg_customers(raw: DataFrame, opts: Options = Options()) -> DataFrame:
    return _finish(clean_customers(raw, opts), "customers", opts=opts)


# ---------------------------------------------------------------------------
# K2 orders (needs the SILVER customers for the reference flag)
# ---------------------------------------------------------------------------
def clean_orders(raw: DataFrame, opts: Options = Options()) -> DataFrame:
    date_text = X.clean_string("order_date")
    status = X.clean_string("order_status")
    return raw.select(
        "client_id",
        X.clean_string("order_id").alias("source_order_id"),
        X.clean_string("customer_id").alias("source_customer_id"),
        X.to_date(date_text).alias("order_date"),
        date_text.isNull().alias("order_date_is_missing"),
        (F.upper(status) if opts.upper_status else status).alias("order_status"),
        F.when(F.col("client_id") == F.lit("client_a"), X.clean_string("channel")).alias("channel"),
        *_LINEAGE,
    )


def valid_customer_refs(silver_customers: DataFrame) -> DataFrame:
    """DISTINCT (client_id, source_customer_id) of non-duplicate customers."""
    return (silver_customers.filter(~F.col("_is_duplicate"))
            .select("client_id", "source_customer_id").distinct())


def referenced_orders(raw: DataFrame, silver_customers: DataFrame, opts: Options = Options()) -> DataFrame:
    """Cleaned orders with `customer_ref_is_valid`; also for a stream of RAW rows."""
    # left join on the cleaned id; match presence becomes the flag. The join
    # strategy (broadcast when small, sort-merge otherwise) is left to AQE.
    # Rows without an id match nothing: a digest of their place, a number and
    # never an id of a customer (`_none`), spreads them over all partitions.
    refs = valid_customer_refs(silver_customers).select(
        "client_id", F.col("source_customer_id").alias("_ref"), F.lit(False).alias("_none"), F.lit(True).alias("_ref_hit"))
    cleaned = clean_orders(raw, opts)
    none = F.col("source_customer_id").isNull()
    with_ref = (cleaned.withColumn("_none", none)
                .withColumn("_ref", F.when(none, F.xxhash64(*_LINEAGE).cast("string")).otherwise(F.col("source_customer_id"))))
    return (with_ref.join(refs, ["client_id", "_ref", "_none"], "left")
            .withColumn("customer_ref_is_valid", F.col("_ref_hit").isNotNull())
            .select(*cleaned.columns, "customer_ref_is_valid"))


def stg_orders(raw: DataFrame, silver_customers: DataFrame, opts: Options = Options()) -> DataFrame:
    return _finish(referenced_orders(raw, silver_customers, opts), "orders", opts=opts)


# ---------------------------------------------------------------------------
# K3 products
# ---------------------------------------------------------------------------
def clean_products(raw: DataFrame, opts: Options = Options()) -> DataFrame:
    price = X.to_decimal("unit_price")
    name = X.clean_string("product_name")
    category = X.clean_string("category")
    if opts.product_sentinels:
        name = F.nullif(name, F.lit("Unknown Product"))
        category = F.nullif(category, F.lit(C.SEGMENT_SENTINEL))
    if opts.upper_status:
        category = F.upper(category)
    return raw.select(
        "client_id",
        X.clean_string("sku").alias("source_sku"),
        name.alias("product_name"),
        category.alias("category"),
        price.alias("unit_price"),
        X.is_positive(price).alias("unit_price_is_valid"),
        F.upper(X.clean_string("currency")).alias("currency"),
        X.to_bool("is_active").alias("is_active"),
        *_LINEAGE,
    )


def stg_products(raw: DataFrame, opts: Options = Options()) -> DataFrame:
    return _finish(clean_products(raw, opts), "products", opts=opts)


# ---------------------------------------------------------------------------
# K4 transactions, K5 items, K6 payments (one parse of the payloads)
# ---------------------------------------------------------------------------
def _is_xml():
    return F.col("fmt") == F.lit("xml")


def clean_transactions(parsed: DataFrame, opts: Options = Options()) -> DataFrame:
    t = F.col("txn")
    name = X.clean_string(t["customer_name"])
    order_date = X.to_date(X.clean_string(t["order_date"]))
    amount = X.to_decimal(t["amount"])
    email = X.clean_string(t["email"])
    currency = F.upper(X.clean_string(t["currency"]))
    if opts.default_currency:
        currency = F.when(_is_xml(), currency).otherwise(F.coalesce(currency, F.lit(opts.default_currency)))
    return parsed.select(
        "client_id",
        X.clean_string(t["txn_id"]).alias("source_transaction_id"),
        X.clean_string(t["order_id"]).alias("source_order_id"),
        X.clean_string(t["customer_id"]).alias("source_customer_id"),
        order_date.alias("order_date"),
        order_date.isNull().alias("order_date_is_missing"),
        F.when(_is_xml(), X.clean_string(t["first_name"])).otherwise(X.word(name, 1)).alias("customer_first_name"),
        F.when(_is_xml(), X.clean_string(t["last_name"])).otherwise(X.word(name, 2)).alias("customer_last_name"),
        email.alias("customer_email"),
        X.is_valid_email(email).alias("customer_email_is_valid"),
        X.clean_string(t["payment_method"]).alias("payment_method"),
        amount.alias("payment_amount"),
        X.is_positive(amount).alias("payment_amount_is_valid"),
        currency.alias("payment_currency"),
        F.coalesce(F.size("items") > 0, F.lit(False)).alias("has_line_items"),
        *_TXN_LINEAGE,
    )


def stg_transactions(parsed: DataFrame, opts: Options = Options()) -> DataFrame:
    cleaned = clean_transactions(parsed, opts).filter(F.col("source_transaction_id").isNotNull())
    return _finish(cleaned, "transactions", order=_TXN_ORDER, opts=opts)


def explode_items(parsed: DataFrame) -> DataFrame:
    """Transaction rows -> one row per item with its position.

    The transaction id is projected before the generator, so the scan of the
    parsed payloads reads only `txn.txn_id` and `items`, not the whole struct.
    """
    return (parsed.select("client_id", *_TXN_LINEAGE,
                          X.clean_string(F.col("txn")["txn_id"]).alias("source_transaction_id"), "items")
            .select("client_id", *_TXN_LINEAGE, "source_transaction_id",
                    F.posexplode("items").alias("_item_pos", "it")))


def clean_items(parsed: DataFrame, opts: Options = Options()) -> DataFrame:
    it = F.col("it")
    qty = X.to_int(it["qty"])
    price = X.to_decimal(it["price"])
    return explode_items(parsed).select(
        "client_id", "source_transaction_id",
        X.clean_string(it["sku"]).alias("source_sku"),
        X.clean_string(it["description"]).alias("item_description"),
        qty.alias("quantity"),
        X.is_positive(qty).alias("quantity_is_valid"),
        price.alias("unit_price"),
        X.is_positive(price).alias("unit_price_is_valid"),
        F.upper(X.clean_string(it["currency"])).alias("currency"),
        X.line_total(qty, price).alias("line_total"),
        *_TXN_LINEAGE, "_item_pos",
    )


def stg_transaction_items(parsed: DataFrame, opts: Options = Options()) -> DataFrame:
    cleaned = (clean_items(parsed, opts)
               .filter(F.col("source_transaction_id").isNotNull())
               .filter(X.is_clean_id("source_transaction_id", "transaction_id")))
    return _finish(cleaned, "transaction_items", keys=key_columns("transaction_items"), order=(*_TXN_ORDER, "_item_pos"), opts=opts)


def clean_payments_csv(raw_payments: DataFrame) -> DataFrame:
    return raw_payments.select(
        "client_id",
        X.clean_string("payment_id").alias("source_payment_id"),
        X.clean_string("order_id").alias("source_order_id"),
        X.clean_string("payment_method").alias("payment_method"),
        X.clean_string("status").alias("status"),
        X.to_decimal("amount").alias("amount"),
        F.upper(X.clean_string("currency")).alias("currency"),
        F.lit(None).cast("decimal(12,2)").alias("processing_fee"),
        F.lit("payments_csv").alias("source_type"),
        *_LINEAGE, F.lit(0).cast("bigint").alias("_txn_pos"),
    )


def clean_payments_embedded(parsed: DataFrame, opts: Options = Options()) -> DataFrame:
    t = F.col("txn")
    txn_id = X.clean_string(t["txn_id"])
    prefix = F.when(_is_xml(), F.lit(C.EMBEDDED_PAYMENT_PREFIX["transaction_xml"])).otherwise(
        F.lit(C.EMBEDDED_PAYMENT_PREFIX["transaction_json"]))
    currency = F.upper(X.clean_string(t["currency"]))
    if opts.default_currency:
        currency = F.when(_is_xml(), currency).otherwise(F.coalesce(currency, F.lit(opts.default_currency)))
    return parsed.filter(txn_id.isNotNull()).select(
        "client_id",
        F.concat(prefix, txn_id).alias("source_payment_id"),
        X.clean_string(t["order_id"]).alias("source_order_id"),
        X.clean_string(t["payment_method"]).alias("payment_method"),
        F.lit(None).cast("string").alias("status"),
        X.to_decimal(t["amount"]).alias("amount"),
        currency.alias("currency"),
        F.when(_is_xml(), X.to_decimal(t["processing_fee"])).alias("processing_fee"),
        F.when(_is_xml(), F.lit("transaction_xml")).otherwise(F.lit("transaction_json")).alias("source_type"),
        *_TXN_LINEAGE,
    )


def stg_payments(raw_payments: DataFrame, parsed: DataFrame, opts: Options = Options()) -> DataFrame:
    csv = clean_payments_csv(raw_payments)
    embedded = clean_payments_embedded(parsed, opts)
    if opts.payments_precedence == "csv":
        # open question in the contract: a CSV payment of the same order wins
        csv_orders = csv.select("client_id", "source_order_id").filter(F.col("source_order_id").isNotNull())
        embedded = embedded.join(csv_orders.distinct(), ["client_id", "source_order_id"], "left_anti")
    combined = csv.unionByName(embedded).filter(F.col("source_payment_id").isNotNull())
    combined = (combined
                .withColumn("amount_is_valid", X.is_positive("amount"))
                .withColumn("is_refund", X.is_refund(F.col("amount"), F.col("status"))))
    return _finish(combined, "payments", order=_TXN_ORDER, opts=opts)


def parse(raw_transactions: DataFrame) -> DataFrame:
    return parse_transactions(raw_transactions)
