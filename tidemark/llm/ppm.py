"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to five bytes, trained on the training
documents. A symbol that a context has seen gets n / (T + d) (T: count of the
context, d: its distinct symbols); the escape gets d / (T + d) (method C). An
escape goes on to the next shorter context, without the symbols of the longer
one (symbol exclusion), down to a uniform share of the symbols never seen. The
score of a text is the log10 probability of its bytes and of its end.

The trie is kept as counts of six-symbol grams, the nearest context symbol
first: in key order, all contexts with one ending are neighbours, and the
counts of every shorter context are sums over a key range. A model of more than
`MAX_GRAMS` grams is cut in key ranges; each range is broadcast on its own and
adds the log probabilities of the positions whose context lies in it.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, written

ORDER = 5
END = 256  # the end of a text, and what stands before its first byte
SYMBOLS = 257
BITS = 9
#: Below the two nearest context symbols of a key.
PAIR = (ORDER - 1) * BITS
#: Grams in one broadcast: 12 bytes each.
MAX_GRAMS = 6_000_000
#: Words in the broadcast table of word counts; rarer words are joined.
MAX_WORDS = 300_000
#: Symbols that are turned into keys at a time.
CHUNK = 500_000
#: A task's distinct grams or words before it hands its counts on.
FLUSH = 1_200_000


# ------------------------------------------------------------------- symbols

def gram_keys(texts: list[bytes]):
    """Yields (owner, keys): six-symbol grams of the texts and the text each comes from, in chunks."""
    pieces, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text)), CHUNK):
            body = text[at:at + CHUNK]
            pieces.append((i, text[at - ORDER:at] if at else b"", body, at + CHUNK >= len(text)))
            size += len(body) + ORDER + 1
            if size >= CHUNK:
                yield pieces_to_keys(pieces)
                pieces, size = [], 0
    if pieces:
        yield pieces_to_keys(pieces)


def pieces_to_keys(pieces: list[tuple[int, bytes, bytes, bool]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(body) + last for _, _, body, last in pieces], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + ORDER)[:-1]))
    flat = np.full(int(lengths.sum()) + ORDER * len(pieces), END, np.int64)
    for (_, before, body, _), start in zip(pieces, starts.tolist(), strict=True):
        if before:
            flat[start:start + ORDER] = np.frombuffer(before, np.uint8)
        flat[start + ORDER:start + ORDER + len(body)] = np.frombuffer(body, np.uint8)
    n = len(flat) - ORDER
    key = flat[ORDER:].copy()
    for back in range(1, ORDER + 1):  # nearest symbol in the highest bits
        key |= flat[ORDER - back:ORDER - back + n] << (BITS * (ORDER + 1 - back))
    valid = np.ones(n, bool)
    inner = starts[1:, None] - ORDER + np.arange(ORDER)[None, :]
    valid[inner.ravel()] = False
    owner = np.repeat(np.array([p[0] for p in pieces], np.int64), lengths)
    return owner, key[valid]


# --------------------------------------------------------------------- model

def merge_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted key, -1 where it is missing."""
    if not len(sorted_keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == wanted, at, -1)


def suffix_keys(keys: np.ndarray, order: int, shorter: int) -> np.ndarray:
    """Keys of the same symbols with only the nearest `shorter` context symbols."""
    return (keys >> (BITS * (order - shorter + 1)) << BITS) | (keys & 511)


class HashTable:
    """Float values of int64 keys, looked up by arrays (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(2 * len(keys)).bit_length()))
        self.mask = (1 << (64 - int(self.shift))) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.zeros(self.mask + 1, np.float32)
        left, slot = np.arange(len(keys)), self.slots(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]
            won = self.keys[slot] == keys[left]
            self.values[slot[won]] = values[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, positions of missing keys)."""
        slot = self.slots(keys)
        held = self.keys[slot]
        out = self.values[slot]
        left = np.flatnonzero(held != keys)
        missing = []
        slot = slot[left]
        while len(left):
            gone = self.keys[slot] == -1
            missing.append(left[gone])
            left, slot = left[~gone], (slot[~gone] + 1) & self.mask
            hit = self.keys[slot] == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            left, slot = left[~hit], slot[~hit]
        return out, np.concatenate(missing) if missing else left


@dataclass
class Level:
    """Grams of one context length and the nodes (contexts) they belong to."""

    keys: np.ndarray
    counts: np.ndarray
    nodes: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    #: T and d that this node's escape finds in the next shorter context, without this node's symbols.
    rest_total: np.ndarray
    rest_distinct: np.ndarray


class Model:
    """Scores grams; `grams` are those of the longest contexts, `shared` the levels 0 and 1 over the whole corpus."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, shared: list[tuple[np.ndarray, np.ndarray]]):
        counts = counts.astype(np.float64)
        grams = {k: (a, b.astype(np.float64)) for k, (a, b) in enumerate(shared)}
        grams[ORDER] = merge_counts(keys, counts)
        for k in range(ORDER - 1, 1, -1):
            grams[k] = merge_counts(suffix_keys(grams[ORDER][0], ORDER, k), grams[ORDER][1])
        self.levels = []
        for k in range(ORDER + 1):
            key, n = grams[k]
            node, total = merge_counts(key >> BITS, n)
            distinct = merge_counts(key >> BITS, np.ones(len(key)))[1]
            if k:
                lower = self.levels[k - 1]
                inside = lower.counts[find(lower.keys, suffix_keys(key, k, k - 1))]
                below = find(lower.nodes, node >> BITS)
                rest = lower.total[below] - merge_counts(key >> BITS, inside)[1]
                rest_d = lower.distinct[below] - distinct
            else:
                rest = rest_d = np.full(len(node), 0.0)
            self.levels.append(Level(key, n, node, total, distinct, rest, rest_d))
        top = self.levels[ORDER]
        at = find(top.nodes, top.keys >> BITS)
        self.top = HashTable(top.keys, np.log10(top.counts / (top.total[at] + top.distinct[at])))
        top.keys = top.counts = np.zeros(0)  # the table has them

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's symbol after its context."""
        out, left = self.top.get(keys)
        out = out.astype(np.float64)
        if not len(left):
            return out
        out[left] = 0.0
        previous = find(self.levels[ORDER].nodes, keys[left] >> BITS)
        self.escape(out, left, previous, ORDER, np.zeros(0), np.zeros(0), fresh=True)
        for k in range(ORDER - 1, -1, -1):
            level, upper = self.levels[k], self.levels[k + 1]
            key = suffix_keys(keys[left], ORDER, k)
            node = find(level.nodes, key >> BITS)
            safe, seen = np.maximum(previous, 0), previous >= 0
            here = np.maximum(node, 0)
            total = np.where(seen, upper.rest_total[safe], np.where(node >= 0, level.total[here], 0)) if len(level.nodes) else np.zeros(len(left))
            distinct = np.where(seen, upper.rest_distinct[safe], np.where(node >= 0, level.distinct[here], 0)) if len(level.nodes) else np.zeros(len(left))
            at = find(level.keys, key)
            hit = at >= 0
            out[left[hit]] += np.log10(level.counts[at[hit]] / (total[hit] + distinct[hit]))
            left, previous = left[~hit], node[~hit]
            self.escape(out, left, previous, k, total[~hit], distinct[~hit], fresh=False)
            if not len(left):
                return out
        unseen = SYMBOLS - (self.levels[0].distinct[0] if len(self.levels[0].nodes) else 0)
        out[left] -= np.log10(unseen)
        return out

    def escape(self, out, left, node, k, total, distinct, fresh: bool) -> None:
        """Adds the escape from level k; a context never seen, or one with no symbol left, costs nothing."""
        if fresh:
            level, known = self.levels[k], node >= 0
            total = np.where(known, level.total[np.maximum(node, 0)], 0) if len(level.nodes) else np.zeros(len(left))
            distinct = np.where(known, level.distinct[np.maximum(node, 0)], 0) if len(level.nodes) else np.zeros(len(left))
        some = distinct > 0
        out[left[some]] += np.log10(distinct[some] / (total[some] + distinct[some]))


_MODELS: dict[str, Model] = {}


def loaded(token: str, parts) -> Model:
    """The model of a broadcast, built once in a Python worker; only the newest is kept."""
    if token not in _MODELS:
        _MODELS.clear()
        _MODELS[token] = Model(*parts.value)
    return _MODELS[token]


# -------------------------------------------------------------------- counts

def gram_counts(docs: DataFrame) -> DataFrame:
    """(key, n) of all six-symbol grams of `docs`; each task sums its own first."""

    def emit(held):
        key, n = merge_counts(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
        for i in range(0, len(key), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(key[i:i + (1 << 18)]), pa.array(n[i:i + (1 << 18)])], names=["key", "n"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, keys in gram_keys([t or b"" for t in batch.column(0).to_pylist()]):
                held.append(np.unique(keys, return_counts=True))
                size += len(held[-1][0])
                if size > FLUSH:
                    held = [merge_counts(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))]
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield from emit(held)
                        held, size = [], 0
        if held:
            yield from emit(held)

    rows = docs.select(F.col("text").cast("binary"))
    return map_batches(rows, run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n) of all words of `docs`; each task sums its own first."""

    def emit(held):
        words = list(held)
        for i in range(0, len(words), 1 << 16):
            part = words[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), pa.array([held[w] for w in part], pa.int64())], names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(tokens(text))
                if len(held) > FLUSH // 6:
                    yield from emit(held)
                    held = Counter()
        yield from emit(held)

    rows = docs.select(F.col("text").cast("binary"))
    return map_batches(rows, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --------------------------------------------------------------------- score

def arrays(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    found = df.toArrow()
    return found.column(0).to_numpy(), found.column(1).to_numpy()


def key_ranges(grams: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of the two nearest context symbols, at most `most` grams each (or one pair's, 257^3 at most)."""
    pairs = (grams.groupBy(F.shiftright("key", PAIR).alias("pair")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy("pair").toArrow())  # 257^2 rows at most
    ranges, size, start = [], 0, 0
    for pair, n in zip(pairs.column(0).to_pylist(), pairs.column(1).to_pylist(), strict=True):
        if size and size + n > most:
            ranges.append((start, pair))
            start, size = pair, 0
        size += n
    return [*ranges, (start, 1 << 18)]


def scored(docs: DataFrame, train: DataFrame, max_grams: int = MAX_GRAMS, max_words: int = MAX_WORDS) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `docs`: doc_id, text, held_out; `train`: the rows of it to learn from.
    Base: a word model with add-one counts; score: the PPM model. A null text
    is an empty one: it has one token, the end. Without training rows all
    counts are 0 and every byte costs log10(257).
    """
    spark = docs.sparkSession
    grams = written(gram_counts(train))
    shared = [arrays(grams.groupBy((F.col("key").bitwiseAND(511) if k == 0 else
                                    F.shiftright("key", ORDER * BITS) * 512 + F.col("key").bitwiseAND(511)).alias("k"))
                     .agg(F.sum("n").alias("n")).orderBy("k")) for k in (0, 1)]  # 257 and 257^2 rows at most
    words = written(word_counts(train))
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = train.count()
    total, distinct = sums[0] + ends, sums[1] + (ends > 0)
    # the most frequent words, not more than max_words: those with at least `least` occurrences
    least, room = 1, max_words
    if sums[1] > max_words:
        for n, count in (words.groupBy("n").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("n")).limit(max_words)
                         .select("n", "c").collect()):
            if count > room:
                break
            least, room = n, room - count
        else:
            least = n
    frequent = words.where(F.col("n") >= least).select("word", "n").toArrow()
    frequent = spark.sparkContext.broadcast(dict(zip(frequent.column(0).to_pylist(), frequent.column(1).to_pylist(), strict=True)))
    all_known = sums[1] <= max_words
    ranges = key_ranges(grams, max_grams)
    rows = docs.select("doc_id", "held_out", F.col("text").cast("binary").alias("text"), F.lit(0.0).alias("score"))
    for i, (lo, hi) in enumerate(ranges):
        part = grams.where(F.shiftright("key", PAIR).between(lo, hi - 1)).select("key", "n").orderBy("key")
        model = spark.sparkContext.broadcast((*arrays(part), shared))
        last = i == len(ranges) - 1
        rows = score_range(rows, model, None if len(ranges) == 1 else (lo, hi), frequent if last else None, ends, all_known)
        if not last:
            rows = written(rows)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    rare = (rows.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x"))
            .select("row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("times"))
            .join(words.where(F.col("n") < least), "word")
            .groupBy("row").agg(F.sum("times").alias("known2"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("logs2")))
    logs = F.col("logs") + F.coalesce("logs2", F.lit(0.0))
    return rows.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known2", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))).alias("base_score"), "score")


def score_range(rows: DataFrame, model, limits: tuple[int, int] | None, frequent, ends: int, all_known: bool) -> DataFrame:
    """Adds a key range's log probabilities to `score`; with `frequent`, the word counts replace the text."""
    token = uuid.uuid4().hex

    def run(batches):
        ppm = loaded(token, model)
        counts = frequent.value if frequent is not None else {}
        logs = {n: float(np.log10(n + 1.0)) for n in set(counts.values())}
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            score = np.array(batch.column(3), np.float64)
            for owner, keys in gram_keys(texts):
                if limits is not None:
                    inside = (keys >> PAIR >= limits[0]) & (keys >> PAIR < limits[1])
                    owner, keys = owner[inside], keys[inside]
                score += np.bincount(owner, weights=ppm.log10(keys), minlength=len(texts))
            if frequent is None:
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], names=["doc_id", "held_out", "text", "score"])
                continue
            n_tokens, known, sums, rare, rare_n = [], [], [], [], []
            for text in texts:
                found = tokens(text)
                hits = [n for n in map(counts.get, found) if n]
                other = Counter(w for w in found if w not in counts) if len(hits) < len(found) and not all_known else {}
                n_tokens.append(len(found) + 1)
                known.append(len(hits) + (ends > 0))
                sums.append(sum(map(logs.__getitem__, hits)) + float(np.log10(ends + 1.0)))
                rare.append(list(other))
                rare_n.append(list(other.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(sums, pa.float64()), pa.array(score), pa.array(rare, pa.list_(pa.binary())), pa.array(rare_n, pa.list_(pa.int64()))],
                names=["doc_id", "held_out", "n_tokens", "known", "logs", "score", "rare", "rare_n"])

    schema = "doc_id long, held_out boolean, " + (
        "text binary, score double" if frequent is None else
        "n_tokens long, known long, logs double, score double, rare array<binary>, rare_n array<long>")
    return map_batches(rows, run, schema)


def lm_scores(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Scores of all rows; those with crc32(doc_id) mod `folds` = `held`, or no doc_id, are not learned from."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held, F.lit(True)))
    return scored(rows, rows.where(~F.col("held_out")))
