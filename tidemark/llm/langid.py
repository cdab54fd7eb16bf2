"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

n-grams of one to three code points are hashed to `DIMS` features; document
frequencies come from all training rows. All languages of the training rows are
learned, on a bounded sample of rows of each (`max_train` shared evenly, 20 at
least) with
follow-the-regularised-leader (FTRL-proximal) under an elastic net, and a
temperature is fitted on a fifth of the sample that training does not see.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, setting, with_place, written

DIMS = 1 << 14
CHUNK = 1 << 20


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of the lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    out = np.zeros(DIMS, np.int64)
    for at in range(0, len(points), CHUNK):
        x = points[at:at + CHUNK + 2]  # the last two start no gram here but in the next chunk
        own = min(CHUNK, len(points) - at)
        gram = x * np.uint32(2654435761)
        for n in range(1, 4):
            if n > 1:
                gram = (gram[:len(x) - n + 1] ^ np.uint32(n)) * np.uint32(2246822519) + x[n - 1:] * np.uint32(3266489917)
            out += np.bincount((gram[:own] >> np.uint32(18)).astype(np.int32), minlength=DIMS)
    return out


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def vector(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices and unit-length TF-IDF weights."""
    at = np.flatnonzero(count)
    x = np.log1p(count[at]) * idf[at]
    return at, x / max(np.sqrt(x @ x), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


# ---------------------------------------------------------------------- fitting

def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Rows that have each feature, over all training rows; DIMS + 1 rows reach the driver."""

    def run(batches):
        df, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df += counts(text) > 0
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, DIMS)), pa.array(np.append(df[at], n))], names=["i", "n"])

    found = map_batches(train.select("text"), run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(DIMS + 1, np.int64)
    df[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return df[:DIMS], int(df[DIMS])


def sample(train: DataFrame, max_train: int) -> tuple[list[str], list[tuple[str, np.ndarray, np.ndarray]]]:
    """Languages, and (lang, indices, counts) of at most `max_train` rows or 20 of each language, the same number of each.

    Rows are drawn, not ids, so an id of many rows brings no more than that.
    The languages are the model's classes and reach the driver, one row each.
    """
    langs = sorted(r[0] for r in train.select("lang").distinct().collect())
    if not langs:
        return [], []
    each = max(20, max_train // len(langs))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "f", "r")
    with setting(train.sparkSession, "spark.sql.optimizer.windowGroupLimitThreshold", str(each)):  # tasks keep so many of a language before the shuffle
        chosen = written(train.select("f", "r", "lang", "doc_id").withColumn("k", F.row_number().over(order)).where(F.col("k") <= each).select("f", "r"))

    def run(batches):
        for batch in batches:
            found = [counts(t) for t in batch.column(1).to_pylist()]
            at = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())),
                 pa.array([c[a].astype(np.int32) for c, a in zip(found, at, strict=True)], pa.list_(pa.int32())), batch.column(2)],
                names=["lang", "at", "n", "doc_id"])

    rows = train.join(chosen, ["f", "r"], "left_semi").select("lang", "text", "doc_id")
    rows = map_batches(rows, run, "lang string, at array<int>, n array<int>, doc_id long").orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "at").toArrow()
    return langs, [(lang, np.array(a, np.int64), np.array(n, float)) for lang, a, n in
                   zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True)]


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int, l1: float, l2: float, alpha: float, beta: float, epochs: int) -> np.ndarray:
    """Weights (DIMS, classes) by FTRL-proximal with an elastic net."""
    z, n = np.zeros((DIMS, classes)), np.zeros((DIMS, classes))

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for y, at, x in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - step * w
            n[at] = ni + g * g
    return weights(z, n)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the smallest log loss, by golden-section search over its logarithm."""
    def loss(t):
        return -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()

    lo, hi, g = -4.0, 3.0, (np.sqrt(5) - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(train: DataFrame, max_train: int = 3000, l1: float = 0.02, l2: float = 0.01, alpha: float = 1.0, beta: float = 1.0, epochs: int = 3):
    """(languages, idf, weights divided by the temperature)."""
    df, total = document_frequencies(train)
    langs, rows = sample(train, max_train)
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    if not langs:
        return [], idf, np.zeros((DIMS, 0))
    data = []
    for lang, at, n in rows:
        x = np.log1p(n) * idf[at]
        data.append((langs.index(lang), at, x / max(np.sqrt(x @ x), 1e-12)))
    kept = [d for i, d in enumerate(data) if i % 5] or data
    held = data[::5]
    w = ftrl(kept, len(langs), l1, l2, alpha, beta, epochs)
    t = temperature(np.array([x @ w[at] for _, at, x in held]), np.array([y for y, _, _ in held]))
    return langs, idf, w / t


def predict(docs: DataFrame, langs: list[str], idf: np.ndarray, weights: np.ndarray) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast((langs, idf, weights))  # 128 kB a language

    def one(text):
        names, idf, w = model.value
        if not names or not has_letter(text):
            return "und", 0.0
        at, x = vector(counts(text), idf)
        p = softmax(x @ w[at])
        best = int(p.argmax())
        return names[best], float(p[best])

    def run(batches):
        for batch in batches:
            found = [one(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", "held_out", "text"), run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_ids(docs: DataFrame, folds: int = 4, held: int = 2, max_train: int = 3000) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score.

    Learned from rows with doc_id, text and lang whose crc32(doc_id) mod
    `folds` is not `held`. `und` with score 0 for a text that is null or has
    no letter, and for every text if there is nothing to learn from. A row
    without doc_id is never held out nor learned from.
    """
    rows = with_place(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    rows = rows.withColumn("held_out", F.coalesce(fold == held, F.lit(False)))
    train = rows.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL AND NOT held_out")
    return predict(rows, *fit(train, max_train))
