"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, html_text, langid, licenses, multi_index, pieces, ppm, quality, simhash, suffix_dedup
from tidemark.llm.common import with_place

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, comp string, ids string"
LABELS = "doc_id long, quality int, toxic int"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
PASSAGE = " ".join(f"word{i}" for i in range(60))


def rows():
    plain = [(i, f"document number {i} speaks of thing{i} and place{i * 7} at length", "en", "s", 60) for i in range(30)]
    odd = [(100, None, None, None, None), (101, "", "en", "s", 0), (None, "a row without id", "en", "s", 16), (102, " \n\t ", "en", "s", 4),
           (103, "x" * 100_000, "en", "s", 100_000), (104, "same text here and there", "en", "s", 24), (105, "same text here and there", "en", "s", 24),
           (105, "same text here and there", "en", "s", 24), (106, "1234 5678 !!", "en", "s", 12), (107, f"one {PASSAGE} two", "en", "s", 400),
           (108, f"three {PASSAGE} four", "en", "s", 400), (109, "licensed under the Apache  License, version 2.0", None, "s", 40)]
    return [(*r, 9.0, 7, "clash", "clash") for r in plain + odd]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(rows(), DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(30)] + [(100, 0, 0), (None, 1, 0), (3, 1, 0), (5, 7, None)], LABELS)


def by_id(df, *columns):
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns))
    return out


N = len(rows())


def test_simhash(docs, empty):
    found = by_id(simhash.near_duplicates(docs), "fingerprint", "component_id")
    assert sum(map(len, found.values())) == N
    assert found[100] == found[101] == found[102] == [("0" * 16, 100)]
    assert found[104][0][1] == 104 and [c for _, c in found[105]] == [104, 104]
    assert simhash.near_duplicates(empty).collect() == []
    kept = by_id(simhash.deduplicated(docs), *docs.columns)
    assert 105 not in kept and 101 not in kept and len(kept[104]) == 1 and None in kept
    assert simhash.deduplicated(docs).schema == docs.schema
    assert simhash.deduplicated(empty).collect() == []


def test_ppm(docs, empty):
    found = by_id(ppm.lm_scores(docs), "held_out", "n_tokens", "n_known", "score")
    assert sum(map(len, found.values())) == N
    assert found[100] == found[101] and found[100][0][1] == 1 and found[100][0][3] < 0
    assert found[102][0][1] == 1 and found[None][0][0] is True
    assert len(set(found[105])) == 1
    assert ppm.lm_scores(empty).collect() == []
    untrained = docs.where("doc_id IS NULL")
    assert ppm.lm_scores(untrained).first()["train_tokens"] == 0


def test_licenses(docs, empty):
    found = by_id(licenses.scanned(docs), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert sum(map(len, found.values())) == N
    assert found[100] == found[101] == found[102] == [(0, 0, None, None, "", "", 0.0)]
    assert found[109] == [(8, 1, 3, 3, "apache", "apache", 1.0)]
    assert found[103][0][0] == 1
    assert licenses.scanned(empty).collect() == []


def test_quality(docs, empty, labels):
    found = by_id(quality.scores(docs, labels), "score", "keep")
    assert sum(map(len, found.values())) == N
    assert all(0 <= s <= 1 and k == (s >= 0.5) for v in found.values() for s, k in v)
    assert quality.kept(docs, labels).schema == docs.schema
    kept = by_id(quality.kept(docs, labels), "text")
    assert {i: len(v) for i, v in kept.items()} == {i: sum(k for _, k in v) for i, v in found.items() if any(k for _, k in v)}
    assert quality.scores(empty, labels).collect() == quality.kept(empty, labels).collect() == []
    unlabelled = quality.scores(docs, labels.where("false"))
    assert unlabelled.where("keep AND score = 0.5").count() == N
    assert quality.kept(docs, labels.where("false")).count() == N


def test_language(docs, empty):
    found = by_id(langid.language_ids(docs), "lang_pred", "score", "held_out")
    assert sum(map(len, found.values())) == N
    for i in (100, 101, 102, 106):
        assert found[i][0][:2] == ("und", 0.0)
    assert found[104][0][0] == "en" and found[None][0][2] is False
    assert langid.language_ids(empty).collect() == []
    untaught = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.language_ids(untaught).collect()} == {"und"}


def test_language_with_hundreds_of_languages(spark):
    data = [(i, f"{chr(0x4e00 + 40 * (i % 200))}{chr(0x4e01 + 40 * (i % 200))} " * 4, f"l{i % 200:03}") for i in range(1200)]
    found = langid.language_ids(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    assert len(found) == 1200 and len({r["lang_pred"] for r in found}) >= 195  # some have few rows to learn from
    assert sum(r["lang_pred"] == data[r["doc_id"]][2] for r in found) >= 0.97 * 1200


def test_language_sample_of_one_repeated_id(spark):
    data = [(7, f"the words of row {i} are many and this is english", "en") for i in range(2000)] + [(8, "das ist ein kurzer deutscher satz", "de")] * 40
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    langs, rows_ = langid.sample(with_place(df, "doc_id", "text", "lang"), 100)
    assert langs == ["de", "en"] and [sum(r[0] == x for r in rows_) for x in langs] == [40, 50]


def test_pieces(docs, empty):
    model = pieces.model_file()
    found = by_id(pieces.round_trips(docs, model), "n_bytes", "n_tokens", "ids_sha256", "decoded_ok")
    assert sum(map(len, found.values())) == N and all(v[3] for x in found.values() for v in x)
    assert found[100] == found[101] == [(0, 0, EMPTY_SHA, True)]
    assert found[104][0] == found[105][0] == found[105][1]
    tokens = pieces.encoded(docs, model)
    assert tokens.columns == docs.columns and dict(tokens.dtypes)["ids"] == "array<int>"
    assert by_id(tokens, "ids")[100] == [(None,)] and by_id(tokens, "ids")[101] == [([],)]
    assert pieces.round_trips(empty, model).collect() == pieces.encoded(empty, model).collect() == []


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, PASSAGE), (2, None), (3, "too short"), (None, PASSAGE), (4, ""), (1, PASSAGE)], "item_id long, text string")
    found = decontamination.leaks(docs, items)
    assert sorted((r["doc_id"], r["item_id"], r["exact"]) for r in found.collect()) == [(107, 1, True), (108, 1, True)]
    clean = decontamination.clean(docs, items)
    assert clean.schema == docs.schema and clean.count() == N - 2
    assert decontamination.leaks(empty, items).collect() == decontamination.clean(empty, items).collect() == []
    assert decontamination.leaks(docs, items.where("false")).collect() == []
    assert decontamination.clean(docs, items.where("false")).count() == N


def test_html(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 2), (None, "v", "<p>a &amp; b", 3), (3, "w", "<p>" + "long " * 50_000, 4),
                                   (3, "w", "<nav>menu</nav>", 5)], "page_id long, url string, html string, text int")
    found = sorted(((r["page_id"] or 0), r["n_chars"], r["text"][:5]) for r in html_text.extracted(pages).collect())
    assert found == [(0, 5, "a & b"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (3, 249_999, "long ")]
    assert html_text.extracted(pages.where("false")).collect() == []


def test_multi_index(spark):
    inf, nan = float("inf"), float("nan")
    data = [(20 * i, [float(i), 1.0, 0.5 * i, 2.0], 0) for i in range(1, 5)] + [(i, [1.0, float(i), 2.0, 1.0], 0) for i in range(1, 5)]
    odd = [(40, None, 0), (60, [0.0] * 4, 0), (100, [nan, 1.0, 1.0, 1.0], 0), (120, [inf, 1.0, 1.0, 1.0], 0), (140, [None, 1.0, 1.0, 1.0], 0),
           (160, [1.0], 0), (None, [1.0] * 4, 0), (180, [], 0), (7, [1.0, 2.0, 2.0, 1.0], 0), (20, [1.0, 1.0, 0.5, 2.0], 0)]
    vectors = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>, rank int")
    found: dict = {}
    for r in multi_index.search(vectors).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == [20, 40, 60, 80] and all([k for k, *_ in v] == list(range(1, 9)) for v in found.values())
    good = {i: v for i, v, _ in data} | {7: [1.0, 2.0, 2.0, 1.0]}
    for q, hits in found.items():
        score = {i: sum(a * b for a, b in zip(good[q], v, strict=True)) for i, v in good.items() if i != q}
        assert [i for _, i, _ in hits] == sorted(score, key=lambda i: (-score[i], i))[:20]
        assert all(abs(s - score[i]) < 1e-9 for _, i, s in hits)
    assert multi_index.search(vectors.where("false")).collect() == []


def test_suffix_dedup(docs, empty):
    found = by_id(suffix_dedup.digests(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sum(map(len, found.values())) == N
    assert found[100] == found[101] == [(0, 0, 0, EMPTY_SHA)]
    assert found[103] == [(100_000, 100_000, 1, EMPTY_SHA)]
    kept = hashlib.sha256(b"onetwo").hexdigest()
    shared = len(f" {PASSAGE} ") + 0
    assert found[107][0][1] in (shared, shared + 1, shared - 1) and kept != EMPTY_SHA
    cut = by_id(suffix_dedup.cleaned(docs), "text", "score", "comp")
    assert cut[100] == [(None, 9.0, "clash")] and cut[101] == [("", 9.0, "clash")] and 103 not in cut
    assert PASSAGE not in cut[107][0][0] and suffix_dedup.cleaned(docs).columns == docs.columns
    assert suffix_dedup.digests(empty).collect() == suffix_dedup.cleaned(empty).collect() == []


def test_pipeline(spark, docs, labels, tmp_path):
    import corpus_pipeline

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == docs.columns and dict(out.dtypes)["ids"] == "array<int>"
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), str(tmp_path)).collect() == []
