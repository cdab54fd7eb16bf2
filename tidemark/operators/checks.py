"""Declarative data checks (T1-T8) compiled into a few Spark jobs.

A check is data: (model, column, kind, severity, args). `run_checks` groups
the checks of one model so that all not-null / accepted-values checks (with
their optional `where`) fold into ONE aggregate over that model; uniqueness
is one group-by per check; relationships one anti-join per check; type
checks read only the schema. The result is one row per check:
(model, column_name, check, severity, failures, status). A failing check
does not raise: the severity decides `warn` or `fail`, like the reference's
policy of not rolling back a run on a test failure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config as C

@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str                  # not_null | unique | accepted_values | relationships | type_number
    severity: str = "error"
    values: tuple = ()
    where: str | None = None   # SQL predicate limiting the rows checked
    to: tuple | None = None    # (parent model, parent column) for relationships


def _nn(m, *cols, severity="error"):
    return [Check(m, c, "not_null", severity) for c in cols]


CLIENT_VALUES = C.CLIENTS
_NOT_DUP = "_is_duplicate = false"


def declared_checks() -> list[Check]:
    """The checks the reference declares for its sources, SILVER and GOLD models."""
    ck = []
    acc = lambda m, c, v, where=None: Check(m, c, "accepted_values", values=tuple(v), where=where)
    # sources
    ck += _nn("raw_customers", "client_id") + [acc("raw_customers", "client_id", CLIENT_VALUES)]
    ck += _nn("raw_customers", "_loaded_at")
    for t in ("raw_orders", "raw_products", "raw_payments"):
        ck += _nn(t, "client_id", "_loaded_at")
    ck += _nn("raw_transactions", "client_id", "raw_payload", "_loaded_at")
    # SILVER
    m = "stg_customers"
    ck += _nn(m, "customer_sk") + [Check(m, "customer_sk", "unique", where=_NOT_DUP)]
    ck += _nn(m, "client_id") + [acc(m, "client_id", CLIENT_VALUES)]
    ck += _nn(m, "source_customer_id", "email_is_valid", severity="warn")
    ck += [acc(m, "canonical_customer_tier", C.CANONICAL_TIERS, "canonical_customer_tier is not null")]
    ck += _nn(m, "_is_duplicate", "_loaded_at")
    m = "stg_orders"
    ck += _nn(m, "order_sk") + [Check(m, "order_sk", "unique", where=_NOT_DUP)]
    ck += _nn(m, "client_id") + [acc(m, "client_id", CLIENT_VALUES)]
    ck += _nn(m, "source_order_id", "source_customer_id", severity="warn")
    ck += _nn(m, "order_date_is_missing", "customer_ref_is_valid", "_is_duplicate", "_loaded_at")
    m = "stg_products"
    ck += _nn(m, "product_sk") + [Check(m, "product_sk", "unique", where=_NOT_DUP)]
    ck += _nn(m, "client_id") + [acc(m, "client_id", CLIENT_VALUES)]
    ck += _nn(m, "source_sku", severity="warn") + [Check(m, "unit_price", "type_number")]
    ck += _nn(m, "unit_price_is_valid", "_is_duplicate", "_loaded_at")
    m = "stg_transactions"
    ck += _nn(m, "transaction_sk") + [Check(m, "transaction_sk", "unique", where=_NOT_DUP)]
    ck += _nn(m, "client_id") + [acc(m, "client_id", CLIENT_VALUES)]
    ck += _nn(m, "source_transaction_id", "order_date_is_missing")
    ck += _nn(m, "customer_email_is_valid", severity="warn")
    ck += _nn(m, "payment_amount_is_valid", "has_line_items", "_is_duplicate", "_loaded_at")
    m = "stg_transaction_items"
    ck += _nn(m, "item_sk", "client_id") + [acc(m, "client_id", CLIENT_VALUES)]
    ck += _nn(m, "source_transaction_id")
    ck += [Check(m, "source_transaction_id", "relationships", to=("stg_transactions", "source_transaction_id"))]
    ck += _nn(m, "quantity_is_valid", "unit_price_is_valid", "_loaded_at")
    m = "stg_payments"
    ck += _nn(m, "payment_sk") + [Check(m, "payment_sk", "unique", where=_NOT_DUP)]
    ck += _nn(m, "client_id") + [acc(m, "client_id", CLIENT_VALUES)]
    ck += _nn(m, "source_payment_id", "amount_is_valid") + _nn(m, "is_refund", severity="warn")
    ck += _nn(m, "source_type") + [acc(m, "source_type", C.PAYMENT_SOURCE_TYPES)]
    ck += _nn(m, "_is_duplicate", "_loaded_at")
    # GOLD
    for m, key, src in (("mart_customers", "customer_sk", "source_customer_id"),
                        ("mart_orders", "order_sk", "source_order_id"),
                        ("mart_payments", "payment_sk", "source_payment_id"),
                        ("mart_products", "product_sk", "source_sku"),
                        ("mart_transactions", "transaction_sk", "source_transaction_id"),
                        ("mart_transaction_items", "item_sk", "source_transaction_id")):
        ck += _nn(m, key) + [Check(m, key, "unique")]
        ck += _nn(m, "client_id") + [acc(m, "client_id", CLIENT_VALUES)]
        ck += _nn(m, src)
        if m == "mart_payments":
            ck += _nn(m, "source_type") + [acc(m, "source_type", C.PAYMENT_SOURCE_TYPES)]
        if m == "mart_products":
            ck += [Check(m, "unit_price", "type_number")]
        if m == "mart_transaction_items":
            ck += [Check(m, "source_transaction_id", "relationships",
                         to=("mart_transactions", "source_transaction_id"))]
            ck += _nn(m, "source_sku")
        ck += _nn(m, "_loaded_at")
    return ck


def _status(failures: F.Column, severity: F.Column) -> F.Column:
    return (F.when(failures == 0, F.lit("pass"))
            .when(severity == F.lit("warn"), F.lit("warn")).otherwise(F.lit("fail")))


def _row_failure(ck: Check) -> F.Column:
    c = F.col(ck.column)
    if ck.kind == "not_null":
        cond = c.isNull()
    else:  # accepted_values: NULL passes
        cond = c.isNotNull() & ~c.isin(*ck.values)
    if ck.where:
        cond = cond & F.coalesce(F.expr(ck.where), F.lit(False))
    return cond


def _counter(ck: Check) -> str:
    return f"{ck.kind} {ck.column}"


def row_counters(model: str) -> dict[str, F.Column]:
    """The failures of a model's row checks as aggregates, to be observed while the model is written."""
    return {_counter(c): F.count_if(_row_failure(c)) for c in declared_checks() if c.model == model and c.kind in ("not_null", "accepted_values")}


def run_checks(spark: SparkSession, models: dict[str, DataFrame], checks: list[Check] | None = None,
               observed: dict[str, dict] | None = None, kept_unique: dict[str, str] | None = None) -> DataFrame:
    """Evaluate `checks` over the given model DataFrames -> one row per check.

    observed: by model, what `row_counters` gave while its live rows were
    written; these checks need no scan. kept_unique: by model the column that
    the merge keeps unique (its key among the rows checked; a merge counts the
    rows per key of each batch and reading drops older rows of a key), so
    that check needs none either.
    """
    checks = [c for c in (checks or declared_checks()) if c.model in models]
    known = [(c.model, c.column, c.kind, c.severity, n) for c in checks
             if (n := (observed or {}).get(c.model, {}).get(_counter(c)) if c.kind in ("not_null", "accepted_values")
                 else 0 if c.kind == "unique" and (kept_unique or {}).get(c.model) == c.column else None) is not None]
    done = {k[:3] for k in known}
    checks = [c for c in checks if (c.model, c.column, c.kind) not in done]
    parts: list[DataFrame] = []
    if known:
        parts.append(spark.createDataFrame(known, "model string, column_name string, check string, severity string, failures bigint"))
    by_model: dict[str, list[Check]] = {}
    for ck in checks:
        by_model.setdefault(ck.model, []).append(ck)
    for model, cks in by_model.items():
        df = models[model]
        rowwise = [c for c in cks if c.kind in ("not_null", "accepted_values")]
        if rowwise:
            aggs = [F.count_if(_row_failure(c)).alias(f"c{i}") for i, c in enumerate(rowwise)]
            stack = F.inline(F.array(*[
                F.struct(F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check"),
                         F.lit(c.severity).alias("severity"), F.col(f"c{i}").cast("bigint").alias("failures"))
                for i, c in enumerate(rowwise)]))
            parts.append(df.agg(*aggs).select(stack).withColumn("model", F.lit(model)))
        for c in cks:
            if c.kind == "unique":
                base = df.filter(F.expr(c.where)) if c.where else df
                dup_keys = (base.filter(F.col(c.column).isNotNull()).groupBy(c.column).count()
                            .filter(F.col("count") > 1))
                parts.append(dup_keys.agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
                             .select(F.lit(model).alias("model"), F.lit(c.column).alias("column_name"),
                                     F.lit(c.kind).alias("check"), F.lit(c.severity).alias("severity"),
                                     "failures"))
            elif c.kind == "relationships":
                parent_model, parent_col = c.to
                parent = models[parent_model].select(F.col(parent_col).alias("_k")).filter(F.col("_k").isNotNull())
                # child keys are counted before the anti-join, so a key held by
                # many rows crosses the shuffle as one row with its count
                child = (df.select(F.col(c.column).alias("_k")).filter(F.col("_k").isNotNull())
                         .groupBy("_k").agg(F.count(F.lit(1)).alias("_n")))
                orphans = child.join(parent.distinct(), "_k", "left_anti")
                parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("failures"))
                             .select(F.lit(model).alias("model"), F.lit(c.column).alias("column_name"),
                                     F.lit(c.kind).alias("check"), F.lit(c.severity).alias("severity"),
                                     "failures"))
            elif c.kind == "type_number":
                ok = isinstance(df.schema[c.column].dataType, (T.DecimalType, T.IntegralType, T.FractionalType))
                parts.append(spark.createDataFrame(
                    [(model, c.column, c.kind, c.severity, 0 if ok else 1)],
                    "model string, column_name string, check string, severity string, failures bigint"))
    cols = ["model", "column_name", "check", "severity", "failures"]
    out = union_all([p.select(*cols) for p in parts])
    return out.withColumn("status", _status(F.col("failures"), F.col("severity"))).select(*cols, "status")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union as a balanced tree (each union re-analyses its inputs, so a
    left-deep chain of many parts costs quadratic planning time)."""
    while len(parts) > 1:
        parts = [parts[i].union(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def freshness_by(df: DataFrame, source: str, loaded_at: str, run_ts: str,
                 warn_hours: int = C.FRESHNESS_WARN_HOURS, error_hours: int = C.FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Age of the newest row of each `source` value against the run time (times as in the session's zone)."""
    newest = df.groupBy(F.col(source).alias("source")).agg(F.max(loaded_at).alias("max_loaded_at"))
    age = (F.unix_timestamp(F.lit(run_ts).cast("timestamp_ntz").cast("timestamp"))
           - F.unix_timestamp(F.col("max_loaded_at").cast("timestamp")))
    hours = age / F.lit(3600)
    return newest.select(
        "source", "max_loaded_at", age.cast("bigint").alias("age_seconds"), F.round(hours, 3).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
         .when(hours > error_hours, F.lit("error"))
         .when(hours > warn_hours, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


def freshness(raw: dict[str, DataFrame], run_ts: str,
              warn_hours: int = C.FRESHNESS_WARN_HOURS, error_hours: int = C.FRESHNESS_ERROR_HOURS,
              loaded_at: str = "_loaded_at") -> DataFrame:
    """T8 for named tables; an empty table is an error."""
    parts = []
    for name, df in raw.items():
        newest = df.agg(F.max(loaded_at).alias("_at")).withColumn("_name", F.lit(name))
        parts.append(freshness_by(newest, "_name", "_at", run_ts, warn_hours, error_hours)
                     .select("source", "max_loaded_at", "age_hours", "status"))
    return union_all(parts)
