"""Properties of the merge, the duplicate flag and the scans."""
from datetime import datetime

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import first_per_key, flag_duplicates
from tidemark.operators.merge import VersionedTable
from tidemark.plans.incremental import newer_than
from tidemark.sources.payload import split_xml_text, xml_records


def _batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, _loaded_at timestamp_ntz")


T1, T2 = datetime(2025, 1, 1, 2), datetime(2025, 1, 2, 2)


def test_merge_upserts_and_is_idempotent(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    assert t.watermark() is None
    t.merge(_batch(spark, [("a", 1, T1), ("b", 2, T1)]))
    second = _batch(spark, [("b", 20, T2), ("c", 3, T2)])
    t.merge(second)
    once = sorted(map(tuple, t.read().collect()))
    t.merge(second)                                   # replay of the same batch
    assert sorted(map(tuple, t.read().collect())) == once
    assert [(r[0], r[1]) for r in once] == [("a", 1), ("b", 20), ("c", 3)]
    assert t.watermark() == str(T2)


def test_merge_keep_existing(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    t.merge(_batch(spark, [("a", 1, T1)]))
    t.merge(_batch(spark, [("a", 9, T2), ("z", 2, T2)]), keep_existing=True)
    assert sorted((r.k, r.v) for r in t.read().collect()) == [("a", 1), ("z", 2)]


def test_merge_schema_sync(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    t.merge(_batch(spark, [("a", 1, T1), ("b", 2, T1)]))
    wider = spark.createDataFrame([("c", 3, T2, "x")], "k string, v int, _loaded_at timestamp_ntz, extra string")
    t.merge(wider)
    got = t.read()
    assert got.columns == ["k", "v", "_loaded_at", "extra"]
    assert sorted((r.k, r.extra) for r in got.collect()) == [("a", None), ("b", None), ("c", "x")]
    t.merge(spark.createDataFrame([("d", T2)], "k string, _loaded_at timestamp_ntz"))  # a column vanished
    assert t.read().columns == ["k", "_loaded_at"] and t.read().count() == 4


def test_uncommitted_version_is_invisible_and_never_committed(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    t.merge(_batch(spark, [("a", 1, T1)]))
    # a crashed merge: files for version 2 are written, but no manifest is committed
    t._commit = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        t.merge(_batch(spark, [(f"x{i}", 99, T2) for i in range(15)]))
    again = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    assert [(r.k, r.v) for r in again.read().collect()] == [("a", 1)]
    again.merge(_batch(spark, [("b", 2, T2)]))       # the retry brings another batch
    assert sorted((r.k, r.v) for r in again.read().collect()) == [("a", 1), ("b", 2)]


def test_repeated_keys_in_a_batch(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    twice = _batch(spark, [("a", 2, T1), ("a", 3, T2)])
    with pytest.raises(ValueError):
        t.merge(twice)
    assert not t.exists()
    t.merge(twice, order=["_loaded_at"])
    assert [(r.k, r.v) for r in t.read().collect()] == [("a", 3)]


def test_changed_type_becomes_the_common_one(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    t.merge(_batch(spark, [(f"a{i}", i, T1) for i in range(50)]))
    before = set(t.files())
    t.merge(_batch(spark, [("b", 2, T2)]).withColumn("v", F.lit("2.50").cast("decimal(6,2)")))
    assert t.read().schema["v"].dataType.simpleString() == "decimal(12,2)"
    t.merge(_batch(spark, [("c", 3, T2), ("a7", 70, T2)]).withColumn("v", F.concat(F.lit("x"), F.col("v"))))
    t.merge(_batch(spark, [("d", 4, T2)]))  # a narrower batch is widened
    got = {r.k: r.v for r in t.read().collect()}
    assert (got["a3"], got["a7"], got["b"], got["c"], got["d"]) == ("3.00", "x70", "2.50", "x3", "4") and len(got) == 53
    assert before <= set(t.files())
    with pytest.raises(ValueError):
        t.merge(_batch(spark, [("a", 1, T1)]).withColumn("v", F.array("v")))
    t.merge(_batch(spark, [(f"z{i}", i, T2) for i in range(60)]))  # folds: no value changes
    assert not before & set(t.files()) and {r.k: r.v for r in t.read().collect()}.items() >= got.items()
    t.merge(_batch(spark, [("y", 1, T2)]).drop("v"))
    t.merge(_batch(spark, [("y", 1, T2)]))  # a column that went and came back is new
    assert t.read().filter("v IS NOT NULL").count() == 1


def test_key_that_changes_its_type(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"], "t")
    t.merge(spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v")))
    t.merge(spark.createDataFrame([("7", "new"), ("x", "new")], "k string, v string"))
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 101 and got["7"] == "new" and got["8"] == "old"


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("int", "decimal(4,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(10,5)", "string"), ("bigint", "double", "double"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "string", "string"), ("date", "int", None), ("array<int>", "string", None)])
def test_common_type(spark, a, b, want):
    from pyspark.sql import types as T

    from tidemark.functions.common_type import common_type
    x, y = (T.StructType.fromDDL(f"c {t}")["c"].dataType for t in (a, b))
    for got in (common_type(x, y), common_type(y, x)):
        assert (got and got.simpleString()) == want


def test_watermark_filter(spark):
    df = _batch(spark, [("a", 1, T1), ("b", 2, T2)])
    assert newer_than(df, None).count() == 2
    assert [r.k for r in newer_than(df, T1).collect()] == ["b"]


def test_flag_duplicates_equals_row_number_with_a_hot_key(spark):
    rows = [("hot", i % 7, f"f{i % 3}", i) for i in range(3000)] + [(f"k{i}", 0, "f0", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "key string, _loaded_at int, _source_file string, _row_pos int")
    order = ("_loaded_at", "_source_file", "_row_pos")
    got = flag_duplicates(df, ["key"], order)
    w = Window.partitionBy("key").orderBy(*order)
    want = df.withColumn("_is_duplicate", F.row_number().over(w) > 1)
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()
    assert got.filter(~F.col("_is_duplicate")).count() == 1001
    firsts = first_per_key(df, ["key"], order)
    assert firsts.filter(F.col("key") == "hot").first()["_row_pos"] == 0


def test_xml_records_take_the_last_opening_tag(spark):
    text = ("----- START OF FILE: x.xml -----\n<SalesData>\n<!-- old <Transaction> draft -->\n"
            "<Transaction><TransactionID>T1</TransactionID></Transaction>\n"
            "<Transaction id=\"2\"><TransactionID>T2</TransactionID></Transaction>\n</SalesData>\n"
            "----- END OF FILE -----\n")
    files = spark.createDataFrame([("f.xml", text)], "_source_file string, text string")
    recs = xml_records(split_xml_text(files)).orderBy("_row_pos").collect()
    assert [r.raw_payload for r in recs] == [
        "<Transaction><TransactionID>T1</TransactionID></Transaction>",
        "<Transaction id=\"2\"><TransactionID>T2</TransactionID></Transaction>"]


def test_insert_only_batch_appends_without_rewriting(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    t.merge(_batch(spark, [(f"a{i}", i, T1) for i in range(40)]))
    before = t.files()
    t.merge(_batch(spark, [(f"b{i}", i, T2) for i in range(40)]))   # new keys only
    assert set(before) < set(t.files()) and t.read().count() == 80


def _many_files(spark, table, rows, n):
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table.merge(rows)
    for c, v in old.items():
        spark.conf.set(c, v)


def _keyed(spark, ids, v, ts):
    """Keys are digests, as in the models: every batch is scattered over the whole key range."""
    return spark.createDataFrame([(i,) for i in ids], "i int").select(F.md5(F.col("i").cast("string")).alias("k"), F.lit(v).alias("v"), F.lit(ts).alias("_loaded_at"))


def test_scattered_updates_rewrite_nothing(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    _many_files(spark, t, _keyed(spark, range(20_000), 0, T1), 50)
    before = set(t.files())
    assert len(before) >= 40
    t.merge(_keyed(spark, range(0, 20_000, 200), 1, T2))  # 0.5 % scattered re-deliveries
    assert before < set(t.files())
    assert t.read().count() == 20_000 and t.read().filter("v = 1").count() == 100
    t.merge(_keyed(spark, range(0, 20_000, 400), 2, T2).withColumn("extra", F.lit("x")))
    assert before < set(t.files()) and t.read().filter("v = 2 AND extra = 'x'").count() == 50
    assert t.read().filter("v = 1").count() == 50 and t.read().filter("extra IS NULL").count() == 19_950
    assert t.changes(1).count() == 100 and t.changes(2).count() == 50 and t.changes(3).count() == 0


def test_files_stay_bounded_over_thirty_days(spark, tmp_root):
    """New rows and re-deliveries every day: parts are folded by size, and each day reads as if all had been rewritten."""
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    want, most = {}, 0
    for day in range(30):
        ids = [*range(day * 100, day * 100 + 100), *range(day % 7, day * 100, 97)]
        t.merge(_keyed(spark, ids, day, T1))
        want.update({i: day for i in ids})
        most = max(most, len(t._manifest().parts))
    assert most <= 6 and len(t.files()) <= 20
    got = sorted((r.v, r.n) for r in t.read().groupBy("v").agg(F.count("*").alias("n")).collect())
    assert got == sorted((v, list(want.values()).count(v)) for v in set(want.values()))


def test_disjoint_parts_stay_bounded_too(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    for day in range(16):
        t.merge(spark.range(day * 10, day * 10 + 10).select(F.format_string("%06d", "id").alias("k"), F.lit(day).alias("v"), F.lit(T1).alias("_loaded_at")))
    assert len(t._manifest().parts) <= 12 and t.read().count() == 160


def test_neighbouring_updates_leave_other_files_out_of_the_join(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    rows = spark.range(20_000).select(F.format_string("%06d", "id").alias("k"), F.col("id").cast("int").alias("v"), F.lit(T1).alias("_loaded_at"))
    _many_files(spark, t, rows, 40)
    t.merge(spark.range(5000, 5100).select(F.format_string("%06d", "id").alias("k"), F.lit(-1).alias("v"), F.lit(T2).alias("_loaded_at")))
    base, new = t._manifest().parts
    spans = t._spans(new.files.values())
    assert 0 < sum(t._meets(r, spans) for r in base.files.values()) <= 0.1 * len(base.files)
    assert t.read().count() == 20_000 and t.read().filter("v = -1").count() == 100


def test_counters_describe_the_live_rows_or_nothing(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"], counters={"null v": F.count_if(F.col("v").isNull())})
    t.merge(_batch(spark, [(f"k{i}", None if i < 3 else i, T1) for i in range(100)]))
    assert t.counters() == {"null v": 3}
    t.merge(_batch(spark, [("k1", 1, T2)]))
    assert t.counters() is None  # two parts: a row of the first is replaced
    t.merge(_batch(spark, [(f"n{i}", i, T2) for i in range(100)]))
    assert t.counters() == {"null v": 2}  # folded into one


def test_batch_log(spark, tmp_root):
    from tidemark.plans.incremental import unread
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    raw = _batch(spark, [("a", 1, T1), ("b", 2, T1)]).withColumn("_batch", F.concat(F.lit("s_"), F.col("k")))
    rows, ids = unread(raw.filter("k = 'a'"), t)
    assert ids == ["s_a"]
    t.merge(rows.drop("_batch"), processed=ids)
    rows, ids = unread(raw, t)  # loaded under the same load time, after the models ran
    assert ids == ["s_b"] and [r.k for r in rows.collect()] == ["b"]
    t.merge(rows.drop("_batch"), processed=ids)
    assert unread(raw, t)[1] == [] and unread(raw, t)[0].count() == 0 and t.read().count() == 2


def test_no_job_runs_while_the_flag_is_planned(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("string").alias("key"), "id")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "planning")
    flag_duplicates(df, ["key"], ("id",))
    assert tracker.getJobIdsForGroup("plan-only") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_window_strategy_gives_the_same_flags(spark):
    rows = [("hot", i % 5, f"f{i % 2}", i) for i in range(500)] + [(f"k{i}", 0, "f0", i) for i in range(50)]
    df = spark.createDataFrame(rows, "key string, _loaded_at int, _source_file string, _row_pos int")
    order = ("_loaded_at", "_source_file", "_row_pos")
    a = flag_duplicates(df, ["key"], order)
    w = flag_duplicates(df, ["key"], order, strategy="window")
    assert a.exceptAll(w.select(*a.columns)).count() == 0 and a.count() == w.count()


def test_freshness_thresholds(spark):
    from tidemark.operators.checks import freshness
    t = spark.createDataFrame([(datetime(2025, 1, 1, 0),)], "_loaded_at timestamp_ntz")
    status = lambda run: freshness({"s": t}, run).first().status
    assert status("2025-01-02 00:00:00") == "pass"     # 24 h
    assert status("2025-01-02 02:00:00") == "warn"     # 26 h > 25 h
    assert status("2025-01-03 02:00:00") == "error"    # 50 h > 49 h


def test_empty_target_means_no_watermark_filter(spark, tmp_root):
    """A target that exists but is empty has no watermark, so the next
    run reads every RAW row instead of none."""
    t = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    t.merge(_batch(spark, []))
    assert t.exists() and t.watermark() is None and t.read().count() == 0
    raw = _batch(spark, [("a", 1, T1), ("b", 2, T2)])
    assert newer_than(raw, t.watermark()).count() == 2
    t.merge(newer_than(raw, t.watermark()))
    assert t.read().count() == 2 and t.watermark() == str(T2)


def test_xml_file_split_across_tasks_yields_every_record_once(spark, tmp_root):
    import os
    from tidemark.config import PAYLOAD_SOURCES
    from tidemark.sources.files import read_payload_source
    src = [s for s in PAYLOAD_SOURCES if s.fmt == "xml"][0]
    os.makedirs(f"{tmp_root}/land/client_a", exist_ok=True)
    n = 4000
    with open(f"{tmp_root}/land/client_a/Big_Transactions.xml", "w") as f:
        f.write("----- START OF FILE -----\n<SalesData>\n")
        for i in range(n):
            f.write(f"  <!-- record {i} -->\n  <Transaction><TransactionID>T{i}</TransactionID>"
                    f"<Payment><Amount currency=\"USD\">{i}.00</Amount></Payment></Transaction>\n")
        f.write("</SalesData>\n----- END OF FILE -----\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        raw = read_payload_source(spark, f"{tmp_root}/land", src, "2025-01-01 00:00:00")
        assert raw.rdd.getNumPartitions() > 4
        from tidemark.sources.payload import parse_transactions
        ids = [r.txn.txn_id for r in parse_transactions(raw).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(ids) == n and len(set(ids)) == n


def test_first_line_in_file_wins_across_splits(spark, tmp_root):
    """Tie-break V6 on one load: the earlier line of a file wins even when the
    duplicate sits in a later split of the same file."""
    import os
    from tidemark.config import CSV_SOURCES
    from tidemark.plans.silver import stg_payments
    from tidemark.sources.files import read_csv_source
    from tidemark.sources.payload import parse_transactions
    spec = [s for s in CSV_SOURCES if s.entity == "payments"][0]
    os.makedirs(f"{tmp_root}/land/client_c", exist_ok=True)
    with open(f"{tmp_root}/land/client_c/Payments_big.csv", "w") as f:
        f.write("----- banner -----\npayment_id,order_id,payment_method,amount,currency,status\n")
        f.write("PAY-DUP,O-1,Card,1.00,USD,OK\n")
        for i in range(6000):
            f.write(f"PAY-{i:06d},O-{i},Card,{i}.00,USD,OK\n")
        f.write("PAY-DUP,O-1,Card,2.00,USD,OK\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 * 1024))
    try:
        raw = read_csv_source(spark, f"{tmp_root}/land", spec, "2025-01-01 00:00:00")
        assert raw.rdd.getNumPartitions() > 3
        empty = parse_transactions(raw.limit(0).selectExpr(
            "client_id", "CAST(NULL AS STRING) AS raw_payload", "_source_file", "_loaded_at", "_split_start",
            "_row_pos"))
        rows = stg_payments(raw, empty).filter("source_payment_id = 'PAY-DUP'").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((str(r.amount), r._is_duplicate) for r in rows)
    assert got == [("1.00", False), ("2.00", True)]


def test_hot_key_with_nine_tenths_of_the_rows(spark):
    """Same flags as row_number, and only the repeated key crosses the join's other side."""
    rows = [("hot", i % 3, "f", i) for i in range(36000)] + [(f"k{i}", 0, "f", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "key string, _loaded_at int, _source_file string, _row_pos int")
    order = ("_loaded_at", "_source_file", "_row_pos")
    got = flag_duplicates(df, ["key"], order)
    want = flag_duplicates(df, ["key"], order, strategy="window")
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count() == 40000
    assert got.filter(~F.col("_is_duplicate")).count() == 4001
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final  # chosen by the measured size of the repeated keys


def test_work_folder_needs_a_shared_one_on_a_cluster(tmp_path):
    from types import SimpleNamespace

    from tidemark.session import work_dir

    def session(master, folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: folder, set=lambda k, v: None),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))
    with pytest.raises(ValueError):
        work_dir(session("spark://host:7077", None))
    assert work_dir(session("spark://host:7077", "hdfs:///shared/")).startswith("hdfs:///shared/run-")
    assert work_dir(session("local[2]", None), "x").rsplit("/", 1)[1].startswith("x-")


def test_late_file_with_an_old_date_is_loaded(spark, tmp_root):
    import os

    from tidemark.config import CSV_SOURCES
    from tidemark.sources.raw import Catalog
    from tidemark.streaming.loader import load_csv_once

    spec = next(s for s in CSV_SOURCES if s.entity == "products")
    land = f"{tmp_root}/late"
    os.makedirs(f"{land}/{spec.prefix}", exist_ok=True)
    cat = Catalog(f"{tmp_root}/late_tables")

    def put(name, text, days):
        path = f"{land}/{spec.prefix}{name}"
        with open(path, "w") as f:
            f.write("banner\n" + text + "\n")
        t = os.path.getmtime(path) - days * 86400
        os.utime(path, (t, t))

    put("Products.csv", 'S1,"Widget ""XL"", blue",cat,1.00,usd,true', 0)
    assert load_csv_once(spark, land, spec, cat, f"{tmp_root}/late_ck", "2025-01-01 00:00:00") == 1
    put("Products_2.csv", "S2,b,cat,2.00,usd,true", 0)
    put("Products_3.csv", "S3,c,cat,3.00,usd,true", 30)
    load_csv_once(spark, land, spec, cat, f"{tmp_root}/late_ck", "2025-01-02 00:00:00")
    got = {r.sku: (r.product_name, r.unit_price) for r in cat.read(spark, "raw", "products").collect()}
    assert got == {"S1": ('Widget "XL", blue', "1.00"), "S2": ("b", "2.00"), "S3": ("c", "3.00")}


def test_payload_rejects(spark):
    from tidemark.config import PAYLOAD_SOURCES
    from tidemark.operators.quarantine import split_payload_rejects

    x = next(s.client_id for s in PAYLOAD_SOURCES if s.fmt == "xml")
    j = next(s.client_id for s in PAYLOAD_SOURCES if s.fmt != "xml")
    rows = [(x, "<Transaction><TransactionID>T</TransactionID></Transaction>"), (x, "<Transaction><TransactionID>T</Tra"), (x, None),
            (j, '{"client": "c", "transactions": [{"id": "1"}]}'), (j, '{"client": "c", "transactions": [{"id": '), (j, '{"client": "c"}'), (j, "")]
    raw = spark.createDataFrame([(*r, "f", T1) for r in rows], "client_id string, raw_payload string, _source_file string, _loaded_at timestamp_ntz")
    good, bad = split_payload_rejects(raw)
    assert sorted(r.client_id for r in good.collect()) == sorted([x, j])
    assert sorted((r.client_id, r.reject_reason) for r in bad.collect()) == sorted(
        [(x, "raw_payload does not parse"), (x, "raw_payload is null")] + [(j, "raw_payload does not parse")] * 3)
