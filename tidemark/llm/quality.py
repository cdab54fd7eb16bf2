"""Quality classifier by co-training of two views.

View "text": shares of characters, lines and repeated words in the whole text.
View "page": what is known without reading it (source, language, given length).
Each view has its own logistic regression. In every round each view scores all
rows without a label, labels the `each` of either class that it is surest of
(calibrated probability at or beyond `sure`), and the other view learns from
them. At the end both views are calibrated on labelled rows that no round used,
and a logistic regression on the two calibrated log-odds, fitted there too,
gives the score of all rows.

Fitted on at most `max_labelled` labelled rows (the same number of each class
where there are enough) and what the rounds label, 4 * `each` rows a round.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.llm.common import map_batches, with_place, written

SOURCE_BINS, LANG_BINS = 64, 16
PUNCTUATION = [i for i in range(33, 127) if not chr(i).isalnum()]
TEXT_DIMS = len(PUNCTUATION) + 13
PAGE_DIMS = SOURCE_BINS + LANG_BINS + 3


def text_view(text: bytes | None) -> np.ndarray:
    """Features of the whole text (UTF-8); all zero but a flag for a null or blank one."""
    out = np.zeros(TEXT_DIMS)
    words = (text or b"").split()
    if not words:
        out[-1] = 1.0
        return out
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(float)
    n = hist.sum()
    k = len(PUNCTUATION)
    out[:k] = np.sqrt(hist[PUNCTUATION] / n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = max(1.0, hist[65:91].sum() + hist[97:123].sum())
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    distinct = len(set(words))
    out[k:k + 12] = (
        hist[65:91].sum() / letters, hist[48:58].sum() / n, hist[128:].sum() / n, hist[9:11].sum() / n, hist[32] / n,
        distinct / len(words), np.log(distinct) / np.log(len(words) + 1.0), repeats / len(words), len(set(lines)) / len(lines),
        min(20.0, (n - hist[32]) / len(words)) / 10.0, np.log1p(len(words)) / 10.0, np.log1p(len(words) / len(lines)) / 5.0)
    return out


def page_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Features of the page's data; a missing value has a bin of its own."""
    out = np.zeros(PAGE_DIMS)
    out[0 if source is None else 1 + zlib.crc32(source.encode()) % (SOURCE_BINS - 1)] = 1.0
    out[SOURCE_BINS + (0 if lang is None else 1 + zlib.crc32(lang.encode()) % (LANG_BINS - 1))] = 1.0
    out[-3] = n_chars is None
    length = np.log1p(max(0, n_chars or 0)) / 10.0
    out[-2:] = length, length * length
    return out


COLUMNS = ["doc_id", "text", "source", "lang", "n_chars"]


def plain_columns() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"),
            F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
            F.col("n_chars").cast("long").alias("n_chars")]


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(*plain_columns())


def views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    _, text, source, lang, n = (c.to_pylist() for c in batch.columns[:5])
    a = np.array([text_view(t) for t in text]).reshape(-1, TEXT_DIMS)
    return a, np.array([page_view(*x) for x in zip(source, lang, n, strict=True)]).reshape(-1, PAGE_DIMS)


# ---------------------------------------------------------------------- fitting

def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights, the intercept last: Newton's method with a ridge, classes weighted alike."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0.5, 0.5 / max(1, (y > 0.5).sum()), 0.5 / max(1, (y <= 0.5).sum()))
    w = np.zeros(x.shape[1])
    reg = ridge * np.eye(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (share * p * (1 - p))[:, None]).T @ x + reg
        step = np.linalg.solve(h, x.T @ (share * (p - y)) + reg @ w)
        w -= step / max(1.0, np.abs(step).max() / 5.0)
        if np.abs(step).max() < 1e-6:
            break
    return w


def apply(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


FEATURES = ["a", "b"]
ORDER = ["h", "doc_id", "f", "r"]


def featured(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(f, r, h, doc_id, y, a, b) of all rows with a doc_id: both views, the label or null, a hash that fixes an order. A written table."""
    label = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.round(F.avg("quality")).cast("int").alias("y")))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(x), pa.list_(pa.float64())) for x in views(batch))], names=["doc_id", "a", "b"])

    rows = map_batches(docs.where("doc_id IS NOT NULL").select(*COLUMNS), run, "doc_id long, a array<double>, b array<double>")
    rows = written(rows.join(label, "doc_id", "left").withColumn("h", F.xxhash64("doc_id", "a")))
    return with_place(rows, "h", "doc_id", "y", "a", "b")


def matrices(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array(found.column(c).to_pylist(), float).reshape(-1, n) for c, n in (("a", TEXT_DIMS), ("b", PAGE_DIMS)))


def labelled(rows: DataFrame, max_labelled: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text view, page view, label) of at most half of `max_labelled` labelled rows a class, in the order of their hashes."""
    half = max_labelled // 2
    slot = F.shiftrightunsigned("h", 52)  # 4,096 slots of hashes: only rows of the first ones that hold enough are ordered
    sizes = sorted(map(tuple, rows.where("y IS NOT NULL").groupBy("y", slot.alias("slot")).count().collect()))
    parts = []
    for y in (0, 1):
        mine = [(s, n) for cls, s, n in sizes if cls == y]
        enough = np.searchsorted(np.cumsum([n for _, n in mine]), half)
        last = mine[min(int(enough), len(mine) - 1)][0] if mine else 0
        parts.append(rows.where((F.col("y") == y) & (slot <= last)).orderBy(slot, *ORDER).limit(half))
    found = parts[0].union(parts[1]).select("h", "doc_id", "y", *FEATURES).orderBy("h", "doc_id", *FEATURES).toArrow()
    return *matrices(found), found.column("y").to_numpy()


def odds_of(view: int, w, platt, x: np.ndarray) -> np.ndarray:
    """Calibrated log-odds of one view."""
    return apply(platt[view], apply(w[view], x)[:, None])


def surest(rows: DataFrame, w, platt, sure: float, each: int, taken: set[tuple[int, int]]) -> list[tuple[int, int, tuple[int, int], np.ndarray, np.ndarray]]:
    """(view, class, place, text view, page view) of the `each` rows without a label that a view is surest of, for both views and classes.

    All rows without a label are scored; a task hands on its own best only.
    """

    def run(batches):
        best: dict[tuple[int, int], list] = {(v, c): [] for v in (0, 1) for c in (0, 1)}
        for batch in batches:
            place = list(zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True))
            tie = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
            for v, x in enumerate(matrices(pa.table({"a": batch.column(4), "b": batch.column(5)}))):
                p = sigmoid(odds_of(v, w, platt, x))
                for c in (0, 1):
                    side = np.round(p if c else 1 - p, 9)  # the last bits depend on the batch
                    mine = best[v, c]
                    mine += [(-side[i], *tie[i], *place[i]) for i in np.flatnonzero(side >= sure).tolist() if place[i] not in taken]
                    if len(mine) > each:
                        best[v, c] = sorted(mine)[:each]
        out = [(v, c, *x) for (v, c), found in best.items() for x in found]
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=["v", "c", "unsure", *ORDER])

    found = map_batches(rows.where("y IS NULL").select("f", "r", "h", "doc_id", *FEATURES), run,
                        "v int, c int, unsure double, h long, doc_id long, f long, r long")
    order = Window.partitionBy("v", "c").orderBy("unsure", *ORDER)
    chosen = written(found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= each))
    out = chosen.join(rows.select("f", "r", *FEATURES), ["f", "r"]).orderBy("v", "c", "k").toArrow()  # 4 * each rows
    place = list(zip(out.column("f").to_pylist(), out.column("r").to_pylist(), strict=True))
    return list(zip(out.column("v").to_pylist(), out.column("c").to_pylist(), place, *matrices(out), strict=True))


def co_train(a: np.ndarray, b: np.ndarray, y: np.ndarray, pool, rounds: int = 5, sure: float = 0.97, each: int = 200):
    """(text weights, page weights, their calibrations, combination), or None if a class is missing.

    `pool(w, platt, sure, each, taken)` gives what `surest` gives.
    """
    fitted = np.arange(len(y)) % 4 != 3
    if len(set(y[fitted])) < 2 or len(set(y[~fitted])) < 2:
        return None
    held = (a[~fitted], b[~fitted])
    truth = y[~fitted].astype(float)
    x = [[a[fitted]], [b[fitted]]]  # what each view learns from, and the labels it was given
    lab = [[y[fitted].astype(float)], [y[fitted].astype(float)]]
    taken: set[tuple[int, int]] = set()
    for i in range(rounds + 1):
        w = [logistic(np.concatenate(x[v]), np.concatenate(lab[v])) for v in (0, 1)]
        platt = [logistic(apply(w[v], held[v])[:, None], truth, 1e-4) for v in (0, 1)]
        found = pool(w, platt, sure, each, taken) if i < rounds else []
        if not found:
            break
        for v, cls, place, *both in found:
            x[1 - v].append(both[1 - v][None, :])
            lab[1 - v].append(np.array([float(cls)]))
            taken.add(place)
    odds = np.stack([odds_of(v, w, platt, held[v]) for v in (0, 1)], axis=1)
    return w, platt, logistic(odds, truth, 1e-4)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 6000):
    rows = featured(plain(docs), labels)
    return co_train(*labelled(rows, max_labelled), lambda *state: surest(rows, *state))


def probabilities(model, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Calibrated probabilities of good quality: text view, page view, both."""
    if model is None:
        half = np.full(len(a), 0.5)
        return half, half, half
    w, platt, mix = model
    odds = [odds_of(v, w, platt, x) for v, x in enumerate((a, b))]
    return sigmoid(odds[0]), sigmoid(odds[1]), sigmoid(apply(mix, np.stack(odds, axis=1)))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labelled: int = 6000) -> DataFrame:
    """One row per row of `docs`: doc_id, text_score, page_score, score (all 0 to 1), keep.

    Null and blank texts are scored like others, by a feature of their own;
    unknown or null sources and languages have theirs. Labels other than 0 and
    1 are ignored, of several for a document the majority counts (a tie: good).
    Without labels of both classes nothing is known: scores 0.5, all kept.
    """
    model = fit(docs, labels, max_labelled)

    def run(batches):
        for batch in batches:
            one, two, both = probabilities(model, *views(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(one), pa.array(two), pa.array(both), pa.array(both >= threshold)],
                names=["doc_id", "text_score", "page_score", "score", "keep"])

    return map_batches(plain(docs).select(*COLUMNS), run, "doc_id long, text_score double, page_score double, score double, keep boolean")


def kept(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labelled: int = 6000) -> DataFrame:
    """The rows of `docs` that `scores` keeps, all columns as they are."""
    model = fit(docs, labels, max_labelled)
    kinds = [StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)]
    names = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    casts = [x.alias(f"v{i}") for i, x in enumerate(plain_columns())]

    def run(batches):
        for batch in batches:
            n = len(kinds)
            seen = pa.RecordBatch.from_arrays(batch.columns[n:], names=COLUMNS)
            good = pa.array(probabilities(model, *views(seen))[2] >= threshold, pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:n], names=[k.name for k in kinds]).filter(good)

    out = map_batches(docs.select(*names, *casts), run, StructType(kinds))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
