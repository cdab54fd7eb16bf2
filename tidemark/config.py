"""Source specifications, fixed values and pipeline options.

Everything a deployment may change (paths, clients, mappings, options) is
plain data here; the Spark code in the sub-packages reads it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. Results depend on these exact strings; keep them as stated.
# ---------------------------------------------------------------------------
CLIENTS = ("client_a", "client_c")

# Tokens the CSV loader turns into NULL (besides an empty field).
NULL_TOKENS = ("", "NULL", "null")

# Anchored e-mail pattern used by the validity flags.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\z"

# Surrogate keys: md5 over the text of the key columns joined by '-', with
# NULL replaced by this token (public behaviour of the key macro package).
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_KEY_SEPARATOR = "-"

# Canonical loyalty tiers (source tier upper-cased; anything else -> NULL).
CANONICAL_TIERS = ("BRONZE", "SILVER", "GOLD", "PLATINUM")

# Text -> boolean conversion (case-insensitive, after trimming).
TRUE_TOKENS = ("true", "t", "yes", "y", "on", "1")
FALSE_TOKENS = ("false", "f", "no", "n", "off", "0")

# Sentinels that mean "no value".
LAST_NAME_SENTINEL = "Unknown"
SEGMENT_SENTINEL = "UNKNOWN"

# Garbage-id rule: file banner artefacts contain three dashes.
BANNER_LIKE = "%---%"

# Payment id prefixes for payments embedded in transaction payloads.
EMBEDDED_PAYMENT_PREFIX = {"transaction_xml": "PAY-XML-", "transaction_json": "PAY-JSON-"}
PAYMENT_SOURCE_TYPES = ("payments_csv", "transaction_xml", "transaction_json")
REFUND_STATUS = "REFUNDED"

# Inline reviewer notes at the end of CSV lines ("true   <-- duplicate").
INLINE_NOTE_PATTERN = r"\s*<--.*$"

# Banner lines around JSON documents ("----- START OF FILE: x -----").
BANNER_LINE_PATTERN = r"(?m)^\s*-{3,}.*$"

# Freshness thresholds for the RAW tables, in hours.
FRESHNESS_WARN_HOURS = 25
FRESHNESS_ERROR_HOURS = 49

# What a column says about a person (PO1), and how each kind is masked when a table is published.
PII_TAGS = {
    "source_customer_id": "person_id", "first_name": "name", "last_name": "name", "full_name": "name", "email": "contact",
    "customer_first_name": "name", "customer_last_name": "name", "customer_email": "contact",
}
MASK_BY_TAG = {"person_id": "hash", "name": "mask", "contact": "hash"}

# ISO calendar date text accepted by the date parser.
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}\z"

# ---------------------------------------------------------------------------
# RAW table layout, business columns (all text) with declared widths.
# ---------------------------------------------------------------------------
RAW_COLUMNS = {
    "customers": [
        ("customer_id", 100), ("first_name", 200), ("last_name", 200),
        ("customer_name", 400), ("email", 400), ("loyalty_tier", 50),
        ("segment", 50), ("signup_source", 100), ("is_active", 10),
    ],
    "orders": [
        ("order_id", 100), ("customer_id", 100), ("order_date", 50),
        ("order_status", 50), ("channel", 50),
    ],
    "products": [
        ("sku", 100), ("product_name", 400), ("category", 100),
        ("unit_price", 50), ("currency", 10), ("is_active", 10),
    ],
    "payments": [
        ("payment_id", 100), ("order_id", 100), ("payment_method", 50),
        ("amount", 50), ("currency", 10), ("status", 50),
    ],
}
CLIENT_ID_WIDTH = 50
SOURCE_FILE_WIDTH = 500

# Lineage columns every RAW row carries and their order for "earliest wins":
# load time, then file, then position in the file (`_split_start` and
# `_row_pos`), a total order (V6).
ORDER_COLUMNS = ("_loaded_at", "_source_file", "_split_start", "_row_pos")


@dataclass(frozen=True)
class CsvSource:
    """One client's delimited file feeding one RAW entity (positional map)."""

    entity: str
    client_id: str
    prefix: str
    name_regex: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class PayloadSource:
    """One client's transaction payload files (XML records or JSON docs)."""

    client_id: str
    prefix: str
    name_regex: str
    fmt: str  # "xml", "json" (one document per file), "jsonl" (one per line) or "jsonarray" (large documents, a row per record)


# Positional column mappings of the client files into the shared RAW schema.
CSV_SOURCES = (
    CsvSource("customers", "client_a", "client_a/", r"(?i).*customer.*\.csv$",
              ("customer_id", "first_name", "last_name", "email", "loyalty_tier",
               "signup_source", "is_active")),
    CsvSource("customers", "client_c", "client_c/", r"(?i).*customer.*\.csv$",
              ("customer_id", "customer_name", "email", "segment", "is_active")),
    CsvSource("orders", "client_a", "client_a/", r"(?i).*order.*\.csv$",
              ("order_id", "customer_id", "order_date", "order_status", "channel")),
    CsvSource("orders", "client_c", "client_c/", r"(?i).*order.*\.csv$",
              ("order_id", "customer_id", "order_date", "order_status")),
    CsvSource("products", "client_a", "client_a/", r"(?i).*product.*\.csv$",
              ("sku", "product_name", "category", "unit_price", "currency", "is_active")),
    CsvSource("products", "client_c", "client_c/", r"(?i).*product.*\.csv$",
              ("sku", "product_name", "category", "unit_price", "currency", "is_active")),
    CsvSource("payments", "client_c", "client_c/", r"(?i).*payment.*\.csv$",
              ("payment_id", "order_id", "payment_method", "amount", "currency", "status")),
)

PAYLOAD_SOURCES = (
    PayloadSource("client_a", "client_a/", r"(?i).*transaction.*\.(xml|txt)$", "xml"),
    PayloadSource("client_c", "client_c/", r"(?i).*transaction.*\.json$", "json"),
)

# Source-id column and garbage-id header name per entity.
ENTITY_KEYS = {
    "customers": ("customer_id", "source_customer_id", "customer_sk"),
    "orders": ("order_id", "source_order_id", "order_sk"),
    "products": ("sku", "source_sku", "product_sk"),
    "transactions": ("transaction_id", "source_transaction_id", "transaction_sk"),
    "transaction_items": ("sku", "source_sku", "item_sk"),
    "payments": ("payment_id", "source_payment_id", "payment_sk"),
}


@dataclass(frozen=True)
class Options:
    """Behaviour switches for the divergences listed in the survey (§2.13)."""

    strip_inline_notes: bool = True          # V17
    enforce_widths: bool = True              # A12
    strict_field_count: bool = False         # V24
    check_files: bool = False                # A11: files that cannot be read are set aside, the others load
    latest_batch_wins: bool = True           # V7
    strict_full_name: bool = False           # H4: NULL when a part is NULL
    product_sentinels: bool = False          # V16: 'Unknown Product'/'UNKNOWN' -> NULL
    upper_status: bool = False               # V16: upper-case order status / category
    default_currency: str | None = None      # V12
    payments_precedence: str | None = None   # V21: "csv" drops JSON payments with a CSV twin
    tier_map: dict = field(default_factory=lambda: {t: t for t in CANONICAL_TIERS})  # V9
    add_updated_at: bool = False             # I4: GOLD rows carry the run timestamp
    dedup_strategy: str = "aggregate"        # E1: "aggregate" (skew-tolerant) or "window"
