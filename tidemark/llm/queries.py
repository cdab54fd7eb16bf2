"""Registered queries of the training-data operators: opN_<name>(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    cover_dedup, decontamination, html_text, langid, licenses, multi_index, periodic_runs, pieces, ppm, quality, simhash, suffix_dedup, whitening,
)
from tidemark.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, seed=42)


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.lm_scores(table(spark, sf_dir, "documents"), folds=7, held=2)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(table(spark, sf_dir, "documents"), folds=4, held=2)


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(table(spark, sf_dir, "documents"), pieces.model_file(), dropout=0.1, seed=42)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), modulus=20, top=20)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(table(spark, sf_dir, "embeddings"), count=16)
    return found.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def with_cycles(docs: DataFrame) -> Column:
    """The text of each document, in some with a tail that repeats: for h = crc32 of the id and h % 10 = 0, word i from place a on is word a + (i - a) % p."""
    h = F.crc32(docs["doc_id"].cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def cycled(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.element_at(words, (F.lit(1) + a + (i - a) % p).cast("int")))), " ")

    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    replaced = F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, cycled(ws)).otherwise(F.lit("")))[0]
    return F.when(h % 10 == 0, replaced).otherwise(docs["text"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.found(docs.select("doc_id", with_cycles(docs).alias("text")), "text", "doc_id")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.less")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_cover_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cover_dedup.removed(table(spark, sf_dir, "documents"), window=50)
    kept = F.coalesce("kept", F.lit("")).cast("binary")
    return found.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_ppm": op2_ppm,
    "op3_licenses": op3_licenses,
    "op4_quality": op4_quality,
    "op5_language": op5_language,
    "op6_pieces": op6_pieces,
    "op7_decontamination": op7_decontamination,
    "op8_html": op8_html,
    "op9_multi_index": op9_multi_index,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_whitening": op11_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_cover_dedup": op13_cover_dedup,
}

#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force.
ORACLES: dict[str, str] = {"op3_licenses": licenses.oracle_sql()}
