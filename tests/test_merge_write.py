"""A part is written sorted by its key, and the write itself tells whether a key repeats."""

from tidemark.operators.merge import VersionedTable


def test_a_write_sorts_by_key_and_counts_repeats(spark, tmp_root):
    table = VersionedTable(spark, f"{tmp_root}/t", ["k", "s"])
    rows = spark.createDataFrame([(str((i * 37) % 1000), i % 2, i) for i in range(1000)], "k string, s int, v long")
    part, _, repeats = table._write(rows, "data/one", 0)
    assert part.rows == 1000 and not repeats
    for f in part.files:
        keys = [(r["k"], r["s"]) for r in spark.read.parquet(f"{table.path}/{f}").collect()]
        assert keys == sorted(keys)
    _, _, repeats = table._write(rows.unionByName(rows.limit(1)), "data/two", 0)
    assert repeats


def test_rows_without_a_key_repeat_too(spark, tmp_root):
    table = VersionedTable(spark, f"{tmp_root}/t", ["k"])
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v long")
    part, _, repeats = table._write(rows, "data/one", 0)
    assert part.rows == 3 and repeats
    empty, _, repeats = table._write(rows.limit(0), "data/two", 0)
    assert empty.rows == 0 and not repeats
