"""What a load of many small JSON documents costs: scans, tasks, rows at the driver."""

import os

from tidemark.sources import files as FS
from tidemark.sources import json_split as J

from test_json_split import SOURCE, document, files, loaded


def chunks_of(spark, root):
    read = FS.read_payload_text(spark, SOURCE, f"{root}/{SOURCE.prefix}")
    return FS.with_lineage(read, SOURCE.prefix, SOURCE.name_regex)


def test_documents_smaller_than_a_split_bring_no_rows_to_the_driver_and_are_scanned_once_more(spark, tmp_root):
    texts = {str(i): document(i)[0] for i in range(12)}
    want = {f"client_c/Transactions_{i}.json": document(i)[1] for i in range(1, 12)}
    rows = files(spark, tmp_root, texts)
    assert J.changes(chunks_of(spark, tmp_root)).count() == 0
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert loaded(rows.collect()) == want


def test_only_records_that_cross_a_border_are_put_together(spark, tmp_root):
    text, want = document(400)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20011")
    try:
        rows = files(spark, tmp_root, {"big": text, **{f"small{i}": document(3)[0] for i in range(3)}})
        begins, broken = J.composed(J.changes(chunks_of(spark, tmp_root)).collect())
        crossing = J.crossed_splits(begins)
        got = loaded(rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert not broken and {f for f, _ in begins} == {f for f, _ in crossing} == {"client_c/Transactions_big.json"}
    assert got["client_c/Transactions_big.json"] == want and len(got) == 4


def test_small_splits_share_tasks_and_keep_their_order(spark, tmp_root):
    os.makedirs(f"{tmp_root}/client_c")
    for i in range(40):
        with open(f"{tmp_root}/client_c/Transactions_{i}.json", "w") as f:
            f.write("".join(f"{i}-{j}}}" for j in range(300)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        chunks = chunks_of(spark, tmp_root)
        splits, packed = chunks.rdd.getNumPartitions(), J.packed(chunks)
        assert packed.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism < splits
        a, b = (x.select("value", "_source_file", "_split_start", "_row_pos").collect() for x in (chunks, packed))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(a) == sorted(b) and len(a) == 12000
    at = {}
    for r in b:  # rows of a split stand together, in the order of the file
        assert at.setdefault((r["_source_file"], r["_split_start"]), -1) < r["_row_pos"]
        at[r["_source_file"], r["_split_start"]] = r["_row_pos"]


def test_brackets_of_joined_chunks_are_those_of_each():
    texts = [document(6, 1)[0], "a} --- banner }\n{b}--- c }\n{", "\"} ' }\" // } \n /* } --- */ [}]", "}\n ----} x\n[{}"]
    for text in texts:
        for place in J.PLACES:
            now, at, want = place, 0, []
            for c in text.split(J.SEPARATOR):
                found, now = J.brackets(c, now)
                want += [(at + pos, b) for pos, b in found]
                at += len(c) + 1
            assert J.brackets(text, place) == (want, now)
