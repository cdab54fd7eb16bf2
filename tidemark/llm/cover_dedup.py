"""Removes words covered by a 50-word window that also starts in a document with a smaller id.

Word positions are taken modulo 31 and anchors of 20 words are hashed only at
the places of a difference cover: for any two positions i and j some shift
below 31 brings both onto the cover. Two equal windows therefore share an
anchor that both documents hash, at the same place of the window, and 20 words
from a shift of at most 30 lie inside the window's 50.

Texts with the same words are found first, by a digest: all but the one with the
smallest id go whole. Anchors that stand in two different texts are found by one
aggregate (the smallest and the largest text per hash, combined map-side, so a
passage that stands in a third of the corpus costs a row per map task). Around
those alone a document is extended: each window that holds a shared anchor is
hashed once, by 128 bits over all its words, and goes if the smallest id of its
hash is below its own. No pairs of documents are made; a window in n documents
is n rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, with_place, written

WINDOW = 50
PERIOD = 31
#: A difference set modulo 31; every shift is the difference of two of them.
COVER = (1, 5, 11, 24, 25, 27)
#: Words whose windows are hashed at a time.
CHUNK = 1 << 16
#: Rows in one batch that a task hands back.
ROWS_OUT = 1 << 16
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_POWERS: dict = {}


def split(text: bytes | None) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+ (bytes.split parts at exactly these six)."""
    return (text or b"").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(hashes: np.ndarray, size: int, way: int = 0) -> np.ndarray:
    """A 64-bit hash of the `size` words from each place. The two ways are independent of each other."""
    if way not in _POWERS:
        up, down = (np.full(CHUNK + 1, b, np.uint64) for b in (_BASES[way], pow(_BASES[way], -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS[way] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    up, down = _POWERS[way]
    own = mixed(hashes + np.uint64(_BASES[way])) if way else hashes
    parts = []
    for at in range(0, max(0, len(own) - size + 1), CHUNK - size + 1):
        piece = own[at:at + CHUNK]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(piece * up[:len(piece)], dtype=np.uint64)))
        n = len(piece) - size + 1
        parts.append(mixed((sums[size:] - sums[:-size]) * down[:n]))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def anchor_places(n: int, size: int) -> np.ndarray:
    at = np.arange(max(0, n - size + 1))
    on = np.zeros(PERIOD, bool)
    on[list(COVER)] = True
    return at[on[at % PERIOD]]


def windows_around(anchors: np.ndarray, n: int, window: int) -> np.ndarray:
    """Starts of the windows of a text of n words that hold one of the anchors."""
    size = window - PERIOD + 1
    low, high = np.maximum(anchors - (window - size), 0), np.minimum(anchors, n - window)
    steps = np.bincount(low, minlength=n + 2) - np.bincount(high + 1, minlength=n + 2)
    return np.flatnonzero(np.cumsum(steps) > 0)


def sent(columns: list[np.ndarray], kinds: tuple, names: list[str]):
    for i in range(0, len(columns[0]), ROWS_OUT):
        yield pa.RecordBatch.from_arrays([pa.array(c[i:i + ROWS_OUT], t) for c, t in zip(columns, kinds, strict=True)], names=names)


def whole_texts(rows: DataFrame, window: int) -> DataFrame:
    """(f, r, doc, n, d1, d2): number of words and a digest of all of them, of every text that has a window."""

    def run(batches):
        for batch in batches:
            out = []
            for f, r, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = split(text)
                if len(words) >= window:
                    d = xxhash.xxh3_128_digest(b" ".join(words))
                    out.append((f, r, doc, len(words), int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["f", "r", "doc", "n", "d1", "d2"])

    return map_batches(rows.select("f", "r", "doc", "text").where("doc IS NOT NULL"), run, "f long, r long, doc long, n long, d1 long, d2 long")


def anchor_table(rows: DataFrame, window: int) -> DataFrame:
    """(h, t, f, r, s): the anchors of every text that has a window; t tells whole texts apart."""
    size = window - PERIOD + 1

    def run(batches):
        for batch in batches:
            out = []
            for f, r, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = split(text)
                if len(words) < window:
                    continue
                at = anchor_places(len(words), size)
                h = rolling(word_hashes(words), size)[at].view(np.int64)
                t = np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64).view(np.int64)
                out.append((h, np.full(len(at), t), np.full(len(at), f), np.full(len(at), r), at))
            if out:
                yield from sent([np.concatenate(c) for c in zip(*out, strict=True)], (pa.int64(),) * 4 + (pa.int32(),), ["h", "t", "f", "r", "s"])

    return map_batches(rows.where("doc IS NOT NULL").select("f", "r", "text"), run, "h long, t long, f long, r long, s int")


def window_table(rows: DataFrame, window: int) -> DataFrame:
    """(g1, g2, doc, f, r, s) of the windows around the `anchors` of each row."""

    def run(batches):
        for batch in batches:
            for f, r, doc, text, anchors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = word_hashes(split(text))
                at = windows_around(np.array(anchors), len(h), window)
                columns = [rolling(h, window, way)[at].view(np.int64) for way in (0, 1)]
                columns += [np.full(len(at), x) for x in (doc, f, r)] + [at]
                yield from sent(columns, (pa.int64(),) * 5 + (pa.int32(),), ["g1", "g2", "doc", "f", "r", "s"])

    return map_batches(rows.select("f", "r", "doc", "text", "anchors"), run, "g1 long, g2 long, doc long, f long, r long, s int")


def repeated_windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(f, r, starts array<int>) of the rows (f, r, doc, text) of which windows also start in a document with a smaller id."""
    if window < PERIOD + 1:
        raise ValueError(f"a window needs more than {PERIOD} words")
    texts = written(whole_texts(rows, window))
    least = texts.groupBy("d1", "d2").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("d1", "d2", "low")
    copies = written(texts.join(least, ["d1", "d2"]).where("doc > low").select("f", "r", "n"))
    anchors = anchor_table(rows, window)
    shared = written(anchors.groupBy("h").agg(F.min("t").alias("low"), F.max("t").alias("high")).where("low < high").select("h"))
    around = written(anchors.select("h", "f", "r", "s").join(shared, "h").groupBy("f", "r").agg(F.collect_list("s").alias("anchors"))
                     .join(copies, ["f", "r"], "left_anti"))
    windows = written(window_table(rows.join(around, ["f", "r"]), window))
    first = written(windows.groupBy("g1", "g2").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("g1", "g2", "low"))
    later = windows.join(first, ["g1", "g2"]).where("doc > low")
    parts = later.groupBy("f", "r").agg(F.collect_list("s").alias("starts"))
    return written(parts.union(copies.select("f", "r", F.sequence(F.lit(0), (F.col("n") - window).cast("int")).alias("starts"))))


def covered(starts: list[int] | None, n: int, window: int) -> np.ndarray:
    """Which of n words lie in a window from one of the starts."""
    steps = np.zeros(n + 1, np.int64)
    if starts:
        at = np.array(starts)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + window, -1)
    return np.cumsum(steps[:n]) > 0


def _kept(rows: DataFrame, others: list[str], window: int) -> DataFrame:
    """(n_words, n_removed, spans, kept, others...) of each row (f, r, doc, text, others...)."""
    starts = repeated_windows(rows.select("f", "r", "doc", "text"), window)
    joined = rows.join(starts, ["f", "r"], "left").select("text", "starts", *others)
    schema = "n_words long, n_removed long, spans array<struct<first: long, last: long>>, kept binary"

    def run(batches):
        for batch in batches:
            out = []
            for text, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = split(text)
                gone = covered(at, len(words), window)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                kept = b" ".join(words if not spans else [words[i] for i in np.flatnonzero(~gone)])
                out.append((len(words), int(gone.sum()), spans, None if text is None else kept))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.binary())
            columns = [pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[2:]], names=["n_words", "n_removed", "spans", "kept", *others])

    fields = ", ".join(f"{c} {joined.schema[c].dataType.simpleString()}" for c in others)
    return map_batches(joined, run, schema + (", " + fields if fields else ""))


def _rows(docs: DataFrame, *others: Column) -> DataFrame:
    return with_place(docs, F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").cast("binary").alias("text"), *others)


def removed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, spans (first and last word), kept (the words left, joined by a space).

    A null text has no words and keeps null, an empty one keeps an empty text;
    texts under `window` words lose nothing. Of rows with one doc_id none is
    smaller, so they lose nothing to each other. Rows without a doc_id lose
    nothing, and nobody loses words to them. Other columns are not read.
    """
    found = _kept(_rows(docs, F.col("doc_id").cast("long").alias("own_id")), ["own_id"], window)
    return found.select(F.col("own_id").alias("doc_id"), "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("kept"))


def cleaned(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with the same columns; texts that lose words become the words left, joined by a space. Rows stay."""
    others = [c for c in docs.columns if c != "text"]
    rows = _rows(docs, *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)))
    found = _kept(rows.withColumn("own", F.col("text")), ["own", *(f"c{i}" for i in range(len(others)))], window)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("own")).cast("string").alias("text")
    at = {c: F.col(f"c{i}").cast(docs.schema[c].dataType).alias(c) for i, c in enumerate(others)} | {"text": text}
    return found.select(*(at[c] for c in docs.columns))
