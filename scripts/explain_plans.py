"""Print the physical plans that matter at scale (formatted explain).

python scripts/explain_plans.py [sf_dir] [query ...]
Shows, per query: scans with their ReadSchema / PushedFilters, the number of
shuffles (Exchange) and broadcasts, and aggregate strategies.
"""
import re
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from tidemark.plans import queries as Q  # noqa: E402
from tidemark.plans import incremental as I  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def summary(name, df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    text = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    formatted = df._jdf.queryExecution().explainString(text)
    print(f"== {name}")
    print(f"   exchanges={plan.count('Exchange hashpartitioning') + plan.count('Exchange SinglePartition')}"
          f" broadcasts={plan.count('BroadcastExchange')} sort_aggregates={plan.count('SortAggregate')}"
          f" hash_aggregates={plan.count('HashAggregate')} windows={plan.count('Window ')}")
    for m in re.finditer(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?ReadSchema: ([^\n]+)", formatted):
        block = m.group(0)
        pushed = re.search(r"PushedFilters: ([^\n]+)", block)
        print(f"   scan ReadSchema={m.group(1)[:160]}")
        if pushed and pushed.group(1) != "[]":
            print(f"        PushedFilters={pushed.group(1)[:160]}")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or ["stg_customers", "stg_orders", "stg_transaction_items", "stg_payments", "mart_orders"]
    spark = build_session("local[8]", 16)
    Q.load_inputs(spark, sf)
    for n in names:
        summary(n, Q.QUERIES[n](spark, sf))
    # an incremental run: the watermark predicate reaches the RAW scan
    raw = Q._raw(spark, sf, "orders")
    newer = I.newer_than(raw, "2025-01-15 02:00:00")
    summary("incremental SILVER orders input", Q.silver.stg_orders(newer, Q.silver_customers(spark, sf)))


if __name__ == "__main__":
    main()
