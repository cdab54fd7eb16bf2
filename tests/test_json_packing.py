"""Small JSON documents share tasks while `scan_json_documents` loads them."""

from datetime import datetime

from tidemark.plans import queries as Q
from tidemark.sources import files as FS
from tidemark.streaming import loader as L


def test_small_documents_share_tasks(spark, tmp_path, monkeypatch):
    orders = [(100 * i + 1, 3, "F", 10.0, datetime(1995, 3, 4), "1") for i in range(30)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(100 * i + 1, 5, 1, 1, 2.0, 8.0) for i in range(30)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, load = [], L.load_payload_once

    def spy(spark, landing, source, *more):
        read = FS.read_payload_text(spark, source, f"{landing}/{source.prefix}")
        seen.append((len(read.inputFiles()), read.rdd.getNumPartitions()))
        return load(spark, landing, source, *more)
    monkeypatch.setattr(L, "load_payload_once", spy)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in names]
    assert Q.scan_json_documents(spark, str(tmp_path)).count() == 30
    files, tasks = seen[0]
    assert files == 30 and tasks < 10
    assert [spark.conf.get(k) for k in names] == before
