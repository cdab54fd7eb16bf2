"""GOLD models K7-K12: publish filters over SILVER."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.silver import SILVER_COLUMNS

_AUDIT = ("_is_duplicate", "_source_file")

GOLD_COLUMNS = {e: [c for c in cols if c not in _AUDIT] for e, cols in SILVER_COLUMNS.items()}

# Columns that must be present for a row to be published.
REQUIRED = {
    "customers": ["source_customer_id"],
    "orders": ["source_order_id"],
    "products": ["source_sku"],
    "transactions": ["source_transaction_id"],
    "transaction_items": ["source_transaction_id", "source_sku"],
    "payments": ["source_payment_id"],
}


def gold(silver: DataFrame, entity: str) -> DataFrame:
    cond = ~F.col("_is_duplicate")
    for c in REQUIRED[entity]:
        cond = cond & F.col(c).isNotNull()
    return silver.filter(cond).select(*GOLD_COLUMNS[entity])
