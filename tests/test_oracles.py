"""Every registered query against its DuckDB oracle on the smallest driver tables
(the driver repeats this at sf0.01)."""
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


_TYPES = {"string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal(12,2)": "DECIMAL(12,2)"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "order_sk" in df.columns


def test_every_pipeline_query_has_an_oracle():
    from tidemark.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, map(str, rel.types)))
    assert len(rows) == len(orows) > 0
    assert _digest(df.columns, rows) == _digest(rel.columns, orows)


def test_rows_balance(spark):
    m = {r.metric: r.value for r in E.queries()["rejects_and_rows_balance"](spark, SF_SMALL).collect()}
    assert m["rejected"] > 0 and m["quarantined"] > 0 and m["garbage_rows"] > 0
    assert m["raw_rows"] == m["rejected"] + m["silver_rows"] + m["quarantined"] + m["garbage_rows"]
