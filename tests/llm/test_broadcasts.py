"""Nothing is broadcast that Spark sizes by its input but has many rows for each of its input's."""

from __future__ import annotations

from tidemark.llm import simhash, suffix_dedup
from tidemark.llm.common import joined_as_measured, written

NAMES = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def _docs(spark, path, n=60):
    rows = [(i, " ".join(f"word{(i // 3) * 31 + j}" for j in range(40))) for i in range(n)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fingerprint_keys_are_not_broadcast_by_estimate(spark, tmp_path, monkeypatch):
    before, plans = [spark.conf.get(k, None) for k in NAMES], []

    def spy(df):
        plans.append(_plan(df))
        return written(df)
    monkeypatch.setattr(simhash, "written", spy)
    docs = _docs(spark, f"{tmp_path}/docs.parquet")
    found = simhash.near_duplicates(docs).collect()
    assert {r["component_id"] for r in found} == set(range(0, 60, 3))
    joins = [p for p in plans if "MapInArrow" in p and "Join" in p]
    assert len(joins) >= 3  # stars, asks, offers
    assert not [p for p in joins if "BroadcastExchange" in p], "the keys would pass through the driver"
    assert [spark.conf.get(k, None) for k in NAMES] == before


def test_spans_are_not_broadcast(spark, tmp_path):
    docs = _docs(spark, f"{tmp_path}/docs.parquet")
    for df in (suffix_dedup.cleaned(docs), suffix_dedup.digests(docs)):
        assert "BroadcastExchange" not in _plan(df)
        assert df.count() in (0, 60)


def test_measured_threshold_is_the_sessions(spark):
    most = spark.conf.get(NAMES[0])
    with joined_as_measured(spark):
        assert [spark.conf.get(k) for k in NAMES] == ["-1", most]
        with joined_as_measured(spark):
            assert [spark.conf.get(k) for k in NAMES] == ["-1", most]
