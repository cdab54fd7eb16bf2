"""What a run leaves on the disks of the executors, and what it sends through them."""

import re
import threading
import time

from pyspark.sql import functions as F

from tidemark.operators.merge import VersionedTable
from tidemark.plans import silver
from tidemark.session import _CLEANUP, shuffles_freed

LINEAGE = "cast(0 AS bigint) AS _split_start, cast(id AS bigint) AS _row_pos, 'f' AS _source_file, TIMESTAMP_NTZ'2025-01-01' AS _loaded_at"


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if re.search(r"/shuffle_\d+_\d+_\d+\.data$", f)}


def _left(spark, before):
    """Shuffle files that stay; they are removed beside the driver's next steps."""
    for _ in range(40):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.25)
    return left


def test_a_merge_leaves_no_shuffle_files(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    before = _shuffle_files(spark)
    for v in (1, 2):
        batch = spark.range(5000).select((F.col("id") % 700).cast("string").alias("k"), F.lit(v).alias("v"), F.current_timestamp().alias("_loaded_at"), "id")
        batch = batch.groupBy("k").agg(F.max("v").alias("v"), F.max("_loaded_at").alias("_loaded_at"))
        table.merge(batch)
        assert not _left(spark, before), "shuffles of a merge stay on disk"
    assert table.read().count() == 700


def test_shuffles_are_freed_only_inside_and_by_any_thread(spark):
    was = spark.conf.get(_CLEANUP, None)
    entered, leave = threading.Event(), threading.Event()

    def other():
        with shuffles_freed(spark):
            entered.set()
            leave.wait(10)

    t = threading.Thread(target=other)
    with shuffles_freed(spark):
        t.start()
        entered.wait(10)
    assert spark.conf.get(_CLEANUP) == "true"  # the other one is still inside
    leave.set()
    t.join()
    assert spark.conf.get(_CLEANUP, None) == was
    with shuffles_freed(spark):
        again = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
        assert len(again.collect()) == len(again.collect()) == 7


def test_surrogate_keys_are_made_after_the_shuffles_of_the_duplicate_flag(spark):
    raw = spark.range(50).selectExpr("'client_a' AS client_id", "concat('SKU-', id % 40) AS sku", "'n' AS product_name", "'c' AS category",
                                     "'1.00' AS unit_price", "'USD' AS currency", "'true' AS is_active", *LINEAGE.split(", "))
    out = silver.stg_products(raw)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("md5(") < plan.index("Join"), plan  # a plan is printed from the top
    rows = out.collect()
    assert len(rows) == 50 and sum(r["_is_duplicate"] for r in rows) == 10
    assert len({r["product_sk"] for r in rows}) == 40
