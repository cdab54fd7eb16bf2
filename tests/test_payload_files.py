"""The payload files derived from orders and lines: one shuffle, whatever the keys hold."""

import json
import re
from datetime import datetime

import pytest

from tidemark.plans import derive

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
LINES = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime(1995, 3, 4)
    orders = [(k, c, "F", 100.0 + c0, day, "1") for c0, (k, c) in enumerate(((1, 2), (2, 3), (20, 2), (120, 5), (20, 4), (2, 7), (None, 9), (None, 2), (3, None)))]
    lines = [(1, 5, 1, 2, 3.0, 10.0), (1, 4, 1, 1, 1.0, 7.5), (2, 6, 1, 1, 2.0, 8.0), (20, 7, 1, 1, 2.0, 9.0), (20, 7, 1, 1, 2.0, 9.0), (None, 8, 1, 1, 2.0, 9.0), (777, 8, 1, 1, 2.0, 9.0)]
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_raw_transactions_are_derived_in_one_shuffle(spark, tables):
    plan = derive.raw_transactions(spark, tables)._jdf.queryExecution().executedPlan().toString()
    shuffles = len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))
    assert shuffles == 1 and "Join" not in plan


def test_repeated_and_null_keys_keep_their_orders_and_lines(spark, tables):
    rows = derive.raw_transactions(spark, tables).collect()
    xml = [r["raw_payload"] for r in rows if r["client_id"] == "client_a" and r["raw_payload"]]
    documents = [json.loads("".join(x for x in r["raw_payload"].split("\n") if x[:1] == "{")) for r in rows if r["client_id"] == "client_c" and r["raw_payload"]]
    txns = [t for d in documents for t in d["transactions"]]
    # key 20 is there twice (both clients a), each with both equal lines, in load 1, repeated, and in load 2
    assert sum("<TransactionID>TXN-20<" in x for x in xml) == 6
    assert all(x.count("<SKU>SKU-7<") == 2 for x in xml if "TXN-20<" in x)
    one = next(x for x in xml if "TXN-1<" in x)
    assert one.index("<SKU>SKU-4<") < one.index("<SKU>SKU-5<")
    assert sorted((t["id"], len(t["items"])) for t in txns) == sorted([("C-TXN-2", 1)] * 2 + [("C-TXN-120", 0)] * 3 + [("C-TXN-3", 0)])
    # of a repeated key the row with the smaller text comes first
    assert [t["order"]["customer"]["id"] for d in documents for t in d["transactions"] if t["id"] == "C-TXN-2"] == ["C-CUST-3", "C-CUST-7"]
    assert not any("SKU-8" in str(r["raw_payload"]) for r in rows)
    assert sum(r["raw_payload"] is None for r in rows) == 1  # the document of orders without a key
