"""Tags and masking, the keep-first stream, files set aside, JSON payloads as VARIANT."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.config import Options
from tidemark.operators.mask import TAG, mask_tagged, tagged
from tidemark.operators.merge import VersionedTable
from tidemark.plans import queries as Q
from tidemark.sources import drift, payload, readable
from tidemark.sources.raw import Catalog
from tidemark.streaming import loader as L

SF = "/root/testdata/sf0.001"


def test_tags_reach_merged_gold(spark, tmp_path):
    g = Q.mart("customers")(spark, SF)
    table = VersionedTable(spark, str(tmp_path / "gold"), ["customer_sk"])
    table.merge(g)
    table.merge(g.limit(5))
    tags = {f.name: f.metadata.get(TAG) for f in table.read().schema.fields if f.metadata.get(TAG)}
    assert tags == {c: t for c, t in C.PII_TAGS.items() if c in g.columns}


def test_a_tag_without_a_rule_is_an_error(spark):
    df = spark.createDataFrame([("a@b.cd", 1)], "email string, n int").select(tagged("email"), "n")
    assert mask_tagged(df).first()["email"] != "a@b.cd"
    with pytest.raises(ValueError):
        mask_tagged(df, {"name": "mask"})


def test_keep_first_stream_takes_a_late_row_that_precedes(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    schema = "k string, at int, v string"
    for i, rows in enumerate(([("a", 5, "a5"), ("b", 1, "b1"), ("a", 6, "a6")], [("a", 7, "a7"), ("c", 1, "c1")],
                              [("a", 5, "a5")], [("a", 2, "a2"), ("b", 9, "b9")])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in/s={i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        L.keep_first_stream(stream, ["k"], f"{tmp_path}/cp", lambda df, _: table.merge(df), order=["at"])
    assert sorted((r.k, r.at, r.v) for r in table.read().collect()) == [("a", 2, "a2"), ("b", 1, "b1"), ("c", 1, "c1")]


def _landing(tmp_path):
    folder = tmp_path / "landing" / "client_c"
    folder.mkdir(parents=True)
    rows = "sku,product_name,category,unit_price,currency,is_active\n" + "".join(f"S-{i},café {i},C,1.00,USD,true\n" for i in range(3000))
    whole = gzip.compress(rows.encode())
    (folder / "product_1.csv.gz").write_bytes(whole)
    (folder / "product_2.csv.gz").write_bytes(whole[:len(whole) // 2])
    (folder / "product_3.csv").write_bytes(rows.encode("latin-1"))
    (folder / "product 4.csv").write_bytes(rows.encode())
    (folder / "product_5.csv").write_bytes(b"")
    return folder


def test_bad_files_are_listed_and_the_others_load_once(spark, tmp_path):
    _landing(tmp_path)
    spec = C.CsvSource("products", "client_c", "client_c/", r"(?i).*product.*[.]csv([.]gz)?$", C.CSV_SOURCES[5].columns)
    cat = Catalog(str(tmp_path / "tables"))
    for ts in ("2025-01-15 02:00:00", "2025-01-16 02:00:00"):
        L.load_csv_once(spark, str(tmp_path / "landing"), spec, cat, str(tmp_path / "cp"), ts, Options(check_files=True))
    raw = cat.read(spark, "raw", "products")
    assert raw.count() == 6000 and raw.filter(F.col("product_name").contains("café")).count() == 6000
    judged = {r.file.rsplit("/", 1)[1]: r.reject_reason for r in cat.read(spark, "rejects", "files").collect()}
    assert judged == {"product_1.csv.gz": None, "product_2.csv.gz": readable.UNREADABLE, "product_3.csv": readable.NOT_UTF8,
                      "product%204.csv": None}  # an empty file is never opened


def test_no_files_and_parquet_that_is_none(spark, tmp_path):
    assert readable.unreadable(spark, {}) == {}
    spark.range(10).write.parquet(f"{tmp_path}/x/p/good")
    (tmp_path / "x" / "p" / "bad.parquet").write_bytes(b"PAR1 no footer")
    good, bad = readable.split_files(spark, f"{tmp_path}/x", "p/", r".*[.]parquet$", "parquet")
    assert spark.read.parquet(*good).count() == 10
    assert [(f.rsplit("/", 1)[1], r) for f, r in bad.items()] == [("bad.parquet", readable.UNREADABLE)]


def test_typed_transactions_from_variant_equal_the_typed_parse(spark):
    raw = Q._raw(spark, SF, "transactions").filter("client_id = 'client_c'")
    kind = payload.JSON_DOCUMENT_SCHEMA.simpleString()
    lists = F.size(F.from_json(payload.clean_json_document(F.col("raw_payload")), payload.JSON_DOCUMENT_SCHEMA, payload.JSON_OPTIONS)["transactions"])
    docs = drift.variant_documents(raw).select(F.try_variant_get("payload", "$", kind).alias("v"), F.from_json(
        payload.clean_json_document(F.col("raw_payload")), payload.JSON_DOCUMENT_SCHEMA, payload.JSON_OPTIONS).alias("t"), lists.alias("n"))
    assert docs.filter("n > 0").count() > 0
    assert docs.filter(~F.col("v").eqNullSafe(F.col("t"))).count() == 0


def test_paths_of_unknown_fields(spark):
    rows = [("client_c", '{"client":"c","transactions":[{"id":"1","new":{"a":[1,[2]]}},{"id":"2","items":[]}]}'), ("client_c", "not json"),
            ("client_c", None), ("client_a", "<Transaction/>")]
    got = {r.path: (r.n, r.known) for r in drift.path_counts(spark.createDataFrame(rows, "client_id string, raw_payload string")).collect()}
    t = "transactions[]"
    assert got == {"client": (1, True), "transactions": (1, True), t: (2, True), f"{t}.id": (2, True), f"{t}.items": (1, True),
                   f"{t}.new": (1, False), f"{t}.new.a": (1, False), f"{t}.new.a[]": (2, False), f"{t}.new.a[][]": (1, False)}
    assert drift.path_counts(spark.createDataFrame([], "client_id string, raw_payload string")).count() == 0
