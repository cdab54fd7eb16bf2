"""Whitening, periodic runs and cover dedup against plain versions over whole small tables, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import cover_dedup, periodic_runs, queries, whitening
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, f long, r long, starts string, _metadata string, runs string, collapsed string"


def sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


def docs_of(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame([(i, t, "en", 1, 2, "x", "m", "y", "z") for i, t in rows], DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------------ op13

def plain_removed(docs: list[tuple[int, bytes]]) -> dict:
    first: dict = {}
    for i, text in docs:
        w = text.split()
        for s in range(len(w) - 49):
            key = tuple(w[s:s + 50])
            first[key] = min(first.get(key, i), i)
    out: dict = {}
    for i, text in docs:
        w = text.split()
        gone = [False] * len(w)
        for s in range(len(w) - 49):
            if first[tuple(w[s:s + 50])] < i:
                gone[s:s + 50] = [True] * 50
        out.setdefault(i, []).append((len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return {i: sorted(v) for i, v in out.items()}


def by_id(df, *columns):
    out: dict = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns))
    return {i: sorted(v) for i, v in out.items()}


def test_cover_dedup_equals_brute_force(spark, texts):
    assert by_id(queries.op13_cover_dedup(spark, SF), "n_words", "n_removed", "kept_sha256") == plain_removed(texts)


def test_every_shift_lies_on_the_cover():
    assert {(a - b) % 31 for a in cover_dedup.COVER for b in cover_dedup.COVER} == set(range(31))


def passages(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    shared = [[f"p{k}w{i}" for i in range(rng.choice([49, 50, 51, 80, 300]))] for k in range(6)]
    line = [f"line{i}" for i in range(25)]
    out = []
    for i in range(60):
        words: list[str] = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.randrange(4)
            if kind == 0:
                p = rng.choice(shared)
                a = rng.randrange(3)
                words += p[a:len(p) - rng.randrange(3)]
            elif kind == 1:
                words += line
            else:
                words += [f"d{i}x{rng.randrange(10**6)}" for _ in range(rng.randint(1, 40))]
        out.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return out


def test_cover_dedup_edges_of_passages(spark, tmp_path_factory, monkeypatch):
    monkeypatch.setattr(cover_dedup, "CHUNK", 64)
    monkeypatch.setattr(cover_dedup, "_POWERS", {})
    for seed in (1, 2):
        rows = passages(seed)
        found = cover_dedup.removed(docs_of(spark, tmp_path_factory, rows)).collect()
        want = plain_removed([(i, t.encode()) for i, t in rows])
        for r in found:
            assert (r["n_words"], r["n_removed"], sha(r["kept"].encode())) == want[r["doc_id"]][0]
            assert sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_removed"]


def test_cover_dedup_cases(spark, tmp_path_factory):
    sixty = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, sixty), (5, sixty), (5, sixty), (6, sixty + " end"), (7, "word " * 30_000), (8, "x" * 100_000), (9, "word " * 49)]
    docs = docs_of(spark, tmp_path_factory, rows)
    found = by_id(cover_dedup.removed(docs), "n_words", "n_removed", "kept")
    assert found[1] == [(0, 0, None)] and found[2] == found[3] == [(0, 0, "")]
    assert found[5] == [(60, 0, sixty)] * 2 and found[None] == [(60, 0, sixty)]
    assert found[6] == [(61, 60, "end")] and found[7][0][:2] == (30_000, 0) and found[9][0][:2] == (49, 0)
    cleaned = cover_dedup.cleaned(docs)
    assert cleaned.schema == docs.schema and cleaned.count() == len(rows)
    kept = by_id(cleaned, "text", "_metadata", "starts")
    assert kept[6] == [("end", "m", "x")] and kept[7] == [("word " * 30_000, "m", "x")] and kept[1] == [(None, "m", "x")]
    empty = spark.createDataFrame([], DOCS)
    assert cover_dedup.removed(empty).collect() == [] and cover_dedup.cleaned(empty).collect() == []
    with pytest.raises(ValueError):
        cover_dedup.removed(docs, window=31)


def test_cover_dedup_hot_passage_stays_linear(spark, tmp_path_factory):
    """A passage that stands in every document makes a row per window and document, no pairs."""
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"a{i} b{i} {passage} c{i}") for i in range(300)]
    docs = docs_of(spark, tmp_path_factory, rows)
    anchors = cover_dedup.anchor_table(cover_dedup._rows(docs), 50)
    assert anchors.count() <= 300 * 13
    found = by_id(cover_dedup.removed(docs), "n_removed", "kept")
    assert found[0] == [(0, rows[0][1])] and all(found[i] == [(60, f"a{i} b{i} c{i}")] for i in range(1, 300))


# ------------------------------------------------------------------------ op12

def plain_runs(words: list) -> list[tuple[int, int, int]]:
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in out.items())


def plain_row(doc_id: int, text: bytes) -> tuple:
    words = text.split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *four, sha(lines.encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_periodic_runs_equal_brute_force(spark, texts):
    found = by_id(queries.op12_periodic_runs(spark, SF), "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    short = [(i, t) for i, t in texts if len(t.split()) <= 1500]
    assert len(found) == len({i for i, _ in texts}) and len(short) > 100
    for i, t in short:
        assert found[i] == [plain_row(i, t)], i


@st.composite
def sequences(draw):
    words = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 2, 4]))), max_size=90))
    for _ in range(draw(st.integers(0, 3))):
        if len(words) > 3:
            a = draw(st.integers(0, len(words) - 1))
            p = draw(st.integers(1, max(1, len(words) // 2)))
            for i in range(a + p, min(len(words), a + p * draw(st.integers(1, 7)))):
                words[i] = words[i - p]
    return words


@settings(max_examples=300, deadline=None)
@given(st.lists(sequences(), min_size=1, max_size=4))
def test_runs_of_any_sequences(texts):
    got = periodic_runs.runs_of([np.array(t, np.int64) for t in texts])
    assert [[tuple(x) for x in g.tolist()] for g in got] == [plain_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 200), min_size=1, max_size=60), st.integers(0, 210), st.integers(0, 210))
def test_wavelet_tree_range_successor(values, begin, width):
    end = begin + width
    tree = periodic_runs.WaveletTree(np.array(values))
    spans = [(a, b) for a in range(0, len(values), 7) for b in range(a, len(values) + 1, 5)]
    low, high = np.array([a for a, _ in spans]), np.array([b for _, b in spans])
    first, second, count = tree.progression(low, high, np.full(len(low), begin), np.full(len(low), end))
    for k, (a, b) in enumerate(spans):
        inside = sorted(v for v in values[a:b] if begin <= v <= end)
        assert count[k] == len(inside)
        assert first[k] == (inside[0] if inside else -1) and second[k] == (inside[1] if len(inside) > 1 else -1)


def test_names_give_intervals_of_the_suffix_array():
    symbols = np.array([3, 1, 3, 1, 3, 1, 2, 3, 1, 3, 0])
    names = periodic_runs.Names(symbols)
    assert names.order.tolist() == sorted(range(11), key=lambda i: symbols[i:].tolist())
    for k, name in enumerate(names.levels):
        blocks = {}
        for i in range(11):
            blocks.setdefault(tuple(symbols[i:i + (1 << k)]), set()).add(int(name[i]))
        assert all(len(v) == 1 for v in blocks.values()) and len({min(v) for v in blocks.values()}) == len(blocks)


def test_periodic_runs_cases(spark, tmp_path_factory):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a " * 11), (5, "a " * 12), (5, "a " * 12), (None, "a b " * 6 + "c"), (7, "word " * 200_000), (8, "x" * 100_000),
            (9, " ".join(f"w{i % 5000}" for i in range(12_000)))]
    docs = docs_of(spark, tmp_path_factory, rows)
    found = by_id(periodic_runs.found(docs, "text", "doc_id", "_metadata", "collapsed").toDF("doc_id", "_metadata", "own", "n_words", "runs", "collapsed"), "n_words", "runs", "collapsed", "own")
    plain = {i: [(n, [tuple(r) for r in runs], left) for n, runs, left, own in v] for i, v in found.items()}
    assert plain[1] == plain[2] == plain[3] == [(0, [], "")]
    assert plain[4] == [(11, [], " ".join(["a"] * 11))] and plain[5] == [(12, [(0, 12, 1)], "a")] * 2
    assert plain[None] == [(13, [(0, 12, 2)], "a b c")] and plain[7] == [(200_000, [(0, 200_000, 1)], "word")]
    assert plain[8] == [(1, [], "x" * 100_000)] and plain[9][0][1] == [(0, 12_000, 5000)]
    assert periodic_runs.found(spark.createDataFrame([], DOCS), "text", "doc_id").collect() == []


# ------------------------------------------------------------------------ op11

def test_whitening_equals_eigenvectors(spark):
    vectors = table(spark, SF, "embeddings").collect()
    x = np.array([np.floor(64 * np.array(r["embedding"], np.float64)) + 1_000_000 for r in vectors])
    fit = np.unique(x, axis=0)
    n, mean = len(fit), fit.mean(0)
    e, axes = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    e, axes = e[::-1], axes[:, ::-1]
    want = {r["vec_id"]: w for r, w in zip(vectors, (x - mean) @ axes[:, :16] / np.sqrt(e[:16]), strict=True)}
    sums = fit.sum(0).astype(int).tolist()
    found = queries.op11_whitening(spark, SF).collect()
    assert len(found) == 16 * len(vectors)
    sign: dict = {}
    deviation = {r["vec_id"]: sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for r, row in zip(vectors, x, strict=True)}
    for r in found:
        k, w = r["component"], want[r["vec_id"]][r["component"] - 1]
        if abs(w) > 0.01:
            assert sign.setdefault(k, np.sign(w) == np.sign(r["whitened"])) == (np.sign(w) == np.sign(r["whitened"]))
        assert abs(abs(w) - abs(r["whitened"])) < 1e-7
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]] and r["identity_error"] < 1e-9
        assert abs(r["explained"] / (e[k - 1] / e.sum()) - 1) < 1e-9


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 7), st.integers(0, 10**6), st.integers(1, 10**9))
def test_polynomial_modulo_a_prime(d, seed, size):
    rng = random.Random(seed)
    half = [[rng.choice([0, rng.randint(-size, size)]) for _ in range(d)] for _ in range(d)]
    m = [[sum(half[k][i] * half[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    p = whitening.primes_below((1 << 31) - 1, 20)[0]
    got = whitening.characteristic(np.array([[v % p for v in row] for row in m], np.int64), p)
    # Faddeev-LeVerrier, exactly
    c, aux = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        aux = [[sum(m[i][x] * aux[x][j] for x in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(m[i][x] * aux[x][i] for i in range(d) for x in range(d)) / k)
    assert got == [int(v) % p for v in reversed(c)]
    assert max(abs(int(v)).bit_length() for v in c) <= whitening.coefficient_bits(sum(m[i][i] for i in range(d)), d)


@pytest.mark.parametrize("roots", [[5], [1, 2, 3], [7, 7, 2], [0, 0, 9], [1000000007, 1000000006, 3], [4, 4, 4]])
def test_roots_of_integer_polynomials(roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    positive = sorted((r for r in roots if r), reverse=True)
    assert whitening.changes(poly) == len(positive)
    for k, r in enumerate(positive):
        assert abs(whitening.root(poly, k + 1) - (r << whitening.BITS)) <= 1


def test_whitening_cases(spark):
    schema = "vec_id long, embedding array<float>, component int, code string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, 0.0, 1.0]), (4, [0.0, 0.0, 0.0]), (4, [0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]),
            (5, None), (6, []), (7, [nan, 0.0, 0.0]), (8, [inf, 0.0, 0.0]), (9, [None, 0.0, 0.0]), (10, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], schema)
    found = whitening.whitened(df).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in found) == sorted((i, k) for i in (0, 1, 2, 3, 4, 4) for k in (1, 2, 3))
    assert all(r["n"] == 4 and r["identity_error"] < 1e-9 for r in found)  # two eigenvalues are equal
    whitening.whitened(spark.createDataFrame([(1, [3e38, 1.0], 1, "x"), (2, [-3e38, 2.0], 1, "x"), (3, [0.5, 9.0], 1, "x")], schema)).collect()
    assert whitening.whitened(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0], 1, "x"), (2, [1.0], 1, "x")], schema)).collect() == []


def test_whitening_sums_of_large_entries_are_exact():
    y = np.array([[3 * 10**9, -5], [2, 7 * 10**11]])
    assert whitening.products(y) == [[9 * 10**18 + 4, -15 * 10**9 + 14 * 10**11, 3 * 10**9 + 2],
                                     [-15 * 10**9 + 14 * 10**11, 25 + 49 * 10**22, 7 * 10**11 - 5], [3 * 10**9 + 2, 7 * 10**11 - 5, 2]]
    codes = [whitening.code_of(np.array(v, np.float64)) for v in ([0.5, -1.0], [1e3, 0.0], [1e9, 1.0])]
    assert [c[0] for c in codes] == [1, 4, 8] and whitening.entries(codes).tolist() == [[32, -64], [64000, 0], [64 * 10**9, 64]]


# ------------------------------------------------- a column called _metadata

def test_operators_on_a_table_with_a_metadata_column(spark, tmp_path_factory):
    from tidemark.llm import simhash, suffix_dedup
    passage = " ".join(f"w{i}" for i in range(60))
    docs = docs_of(spark, tmp_path_factory, [(1, passage), (2, passage), (3, f"other text {passage} and more"), (4, None)])
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}[2] == 1
    kept = simhash.deduplicated(docs)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} >= {1, 4} and kept.filter("doc_id = 2").count() == 0
    cleaned = suffix_dedup.cleaned(docs)
    assert cleaned.schema == docs.schema and {r["doc_id"]: r["text"] for r in cleaned.collect()}[3] == "other text  and more"


def test_repeated_regions_of_one_text_join_once(spark, tmp_path_factory):
    """A line that stands often in many texts: at most one joined row per text and region."""
    from tidemark.llm import suffix_dedup
    line = "".join(f"common line {i} of every text; " for i in range(12))
    rows = [(i, " ".join(f"{i} {k} {line}" for k in range(20))) for i in range(40)]
    docs = docs_of(spark, tmp_path_factory, rows)
    seen = {}
    plain = suffix_dedup.spans_of

    def spy(met, shared):
        mixed = met.where("mixed")
        seen["met"], seen["joined"] = mixed.count(), mixed.join(shared, ["h", "d"]).count()
        seen["regions"] = mixed.selectExpr("sum(size(s)) AS n").first()["n"]
        return plain(met, shared)

    suffix_dedup.spans_of = spy
    try:
        suffix_dedup.digests(docs).count()
    finally:
        suffix_dedup.spans_of = plain
    assert seen["joined"] <= seen["met"] <= seen["regions"]
