"""What large runs keep on the disks: one entity's shuffles at a time, no stage's files longer than they are read."""

import glob
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.plans import queries as Q
from tidemark.plans import run
from tidemark.session import work_dir

from test_disk import _left, _shuffle_files

TABLES = {
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", lambda i: (i, f"Customer {i}", i % 25, 10.5 * i, "BUILDING")),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", lambda i: (i, f"part {i}", "Brand#1", "STEEL", i % 50, 1.5 * i)),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
               lambda i: (i, i % 50, "F", 100.25 + i, datetime(1995, 1 + i % 12, 1 + i % 28), "1-URGENT")),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double",
                 lambda i: (i // 3, i % 40, 1, i % 3, 2.0 + i % 7, 8.25 * i)),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    for (name, (schema, row)), n in zip(TABLES.items(), (60, 40, 240, 720), strict=True):
        spark.createDataFrame([row(i) for i in range(n)], schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_digests_cross_the_shuffle_of_a_merge_as_bytes(spark, tmp_path):
    rows = [(k, i, "v") for i, k in enumerate(["ABCD", "abc", None, "", "zz", "abcd", "00", "d41d8cd98f00b204e9800998ecf8427e", "D41D8cd98f00b204e9800998ecf8427e"])]
    spark.createDataFrame(rows, "k string, n long, v string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = M._ranged(df, ["k", "n"])
    assert out.schema == df.schema and sorted(map(repr, out.collect())) == sorted(map(repr, df.collect()))
    plan = out.withColumn("i", F.row_number().over(Window.partitionBy("k", "n").orderBy("k", "n")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "unhex" in plan[plan.index("Exchange"):]


def test_mask_tagged_leaves_no_shuffle_files(spark, tables):
    for table in Q.INPUTS:
        Q.load_inputs(spark, tables, (table,))
    before = _shuffle_files(spark)
    out = Q.mask_tagged(spark, tables)
    assert not _left(spark, before), "shuffles of the marts stay on disk"
    assert out.inputFiles() and all(f.endswith(".zstd.parquet") for f in out.inputFiles())
    assert {r["entity"] for r in out.select("entity").distinct().collect()} == set(run.ENTITIES)


def test_a_large_run_stages_each_entity_and_gives_the_same_tables(spark, tables, monkeypatch):
    def raw():
        root = Q.load_inputs(spark, tables)
        return {e: spark.read.parquet(f"{root}/{e}") for e in (*Q.RAW_ENTITIES, "transactions")}

    def rows(out):
        return {m: sorted(map(repr, df.collect())) for m, df in out.items() if m.startswith(("stg_", "mart_", "quarantine_", "checks"))}

    assert 0 < run.size_bytes(raw()["orders"]) < 1 << 20
    seen, stages = [], run.run_stages
    monkeypatch.setattr(run, "run_stages", lambda tasks, deps, threads: (seen.append(threads), stages(tasks, deps, threads)))
    small = rows(run.run_pipeline(spark, raw(), work_dir(spark, "small"), Q.RUN_TS))
    calls, staged = [], run.staged
    monkeypatch.setattr(run, "staged", lambda df, entity, path: (calls.append(entity), staged(df, entity, path))[1])
    monkeypatch.setattr(run, "ALONE_BYTES", 0)
    at = work_dir(spark, "large")
    large = rows(run.run_pipeline(spark, raw(), at, Q.RUN_TS))
    assert seen == [4, 1] and sorted(calls) == sorted(run.ENTITIES)
    assert small == large and len(small["stg_transaction_items"]) > 500
    path = at.removeprefix("file://")
    assert glob.glob(f"{path}/silver/*/data") and not glob.glob(f"{path}/staged/*") and not glob.glob(f"{path}/parsed_transactions/*")
