"""Periodic runs of words by internal pattern matching (Kociumaka, Radoszewski, Rytter, Walen).

A run is a stretch of words with smallest period q and at least two periods
(and at least `SHORTEST` words) that no neighbouring word extends. If it is long
enough, a block of b = 2^k words from a place on the dyadic grid lies in it
together with the block's next occurrence q words on. So for every block of a
level its occurrences in the neighbouring window are asked for:

* the suffix array is sorted by doubling, so the sorts of level k name every
  block of 2^k words and give its interval in the suffix array;
* a wavelet tree over the suffix array answers, for an interval, how many
  places lie in a window and which comes next (range successor);
* in a window of b/2 + 1 places the occurrences are one arithmetic progression,
  described by its first, its difference and its length. A progression inside
  one run of its own difference gives no new period and goes; of the others
  each term is a candidate period.

Candidates are extended in both directions by the names of the dyadic blocks;
what is long enough is a run, and the smallest period of a stretch is its
period. Every step is an array operation over all texts of a batch; words are
numbered per text, so no block ever meets one of another text.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.llm.common import map_batches

SHORTEST = 12
#: Words of texts that are searched together; a longer text is searched alone.
WORDS = 1 << 17
#: Words of the smallest block. Its copies may lie 1 to 14 words on.
BLOCK = 4


class Names:
    """Names of the blocks of 2^k words (equal blocks, equal names) and the suffix array of a sequence.

    A block's name is the first place of its interval in the suffix array.
    Only levels on which some block of the level below repeats are kept: past
    them all names differ.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.n = n
        self.order = np.argsort(symbols, kind="stable")
        self.levels = [self._named(symbols[self.order], np.arange(n), np.full(n, -1))]
        self.sizes: list[np.ndarray] = [self._sizes(self.levels[0])]
        while (self.sizes[-1] > 1).any():
            self._double()

    def _named(self, sorted_keys, at: np.ndarray, name: np.ndarray) -> np.ndarray:
        """`name` with those of the suffixes order[at], whose keys come sorted: the first place of equal ones."""
        new = np.ones(len(at), bool)
        new[1:] = sorted_keys[1:] != sorted_keys[:-1]
        name = name.copy()
        name[self.order[at]] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        return name

    def _sizes(self, name: np.ndarray) -> np.ndarray:
        return np.bincount(name, minlength=self.n)

    def _double(self) -> None:
        """The next level: only suffixes whose block repeats are sorted anew, by the block that follows."""
        name, b = self.levels[-1], 1 << (len(self.levels) - 1)
        at = np.flatnonzero(self.sizes[-1][name[self.order]] > 1)
        suffix = self.order[at]
        after = np.where(suffix + b < self.n, name[np.minimum(suffix + b, self.n - 1)], -1)
        key = name[suffix] * np.int64(self.n + 1) + after + 1
        moved = np.argsort(key, kind="stable")
        self.order[at] = suffix[moved]
        self.levels.append(self._named(key[moved], at, name))
        self.sizes.append(self._sizes(self.levels[-1]))

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes i and j (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name = self.levels[k]
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                inside = j + out < self.n
                same = inside & (name[np.minimum(i + out, self.n - 1)] == name[np.minimum(j + out, self.n - 1)])
                out += same.astype(np.int64) << k
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common suffix of what ends before i and before j (i < j)."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            name, b = self.levels[k], 1 << k
            for _ in range(2 if k == len(self.levels) - 1 else 1):
                a = i - out - b
                same = (a >= 0) & (name[np.maximum(a, 0)] == name[np.maximum(j - out - b, 0)])
                out += same.astype(np.int64) << k
        return out


class WaveletTree:
    """Levels of bits over a sequence of numbers, the highest bit first; each level is a stable partition of the one above."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros: list[np.ndarray] = []  # by level: how many of the first i bits are 0
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate(([0], np.cumsum(~one))))
            values = np.concatenate((values[~one], values[one]))

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of the places low <= i < high are under x."""
        out = np.zeros(len(low), np.int64)
        past, size = x >> self.bits > 0, high - low
        for level, zeros in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = zeros[low], zeros[high]
            out += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return np.where(past, size, out)

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of the given rank (from 0) among the places low <= i < high."""
        out = np.zeros(len(low), np.int64)
        rank = rank.copy()
        for zeros in self.zeros:
            a, b = zeros[low], zeros[high]
            one = rank >= b - a
            rank -= np.where(one, b - a, 0)
            out = out << 1 | one
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return out

    def progression(self, low, high, begin, end):
        """(first, second, count) of the values v of the places low <= i < high with begin <= v <= end, for begin <= end (range successor, twice)."""
        before = self.below(low, high, begin)
        count = self.below(low, high, end + 1) - before
        first, second = np.full(len(low), -1), np.full(len(low), -1)
        some, more = np.flatnonzero(count > 0), np.flatnonzero(count > 1)
        first[some] = self.smallest(low[some], high[some], before[some])
        second[more] = self.smallest(low[more], high[more], before[more] + 1)
        return first, second, count


def windows(b: int) -> list[tuple[int, int, int]]:
    """(grid step, nearest, farthest): for blocks of b words, the windows of at most b/2 + 1 places where copies are asked for.

    A run of q words a period and at least max(SHORTEST, 2 q) words holds a
    block from the grid with its copy if step + b - 1 <= length - q.
    """
    wide = [(b, 2 * b - 1, 4 * b - 2)] if b > BLOCK else [(b // 2, 1, b + 2), (b, b + 3, 4 * b - 2)]
    return [(step, at, min(at + b // 2, far)) for step, near, far in wide for at in range(near, far + 1, b // 2 + 1)]


def candidates(names: Names, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): a block at the place and one a period on are equal. limit: by place, the end of its text."""
    if len(names.levels) <= BLOCK.bit_length() - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    level = BLOCK.bit_length() - 1
    # blocks that stand once are never asked for, and all longer ones of them neither
    repeated = np.flatnonzero(names.sizes[level][names.levels[level][names.order]] > 1)
    tree = WaveletTree(names.order[repeated])
    rank = np.full(names.n + 1, len(repeated))
    rank[:-1] = np.searchsorted(repeated, np.arange(names.n))
    places, periods = [], []
    while level < len(names.levels):
        b, name, size = 1 << level, names.levels[level], names.sizes[level]
        for step, near, far in windows(b):
            i = np.arange(0, names.n, step)
            i = i[(size[name[i]] > 1) & (i + near + b <= limit[i])]
            if not len(i):
                continue
            low = rank[name[i]]
            first, second, count = tree.progression(low, low + size[name[i]], i + near, i + far)
            some = count > 0
            i, first, second, count = i[some], first[some], second[some], count[some]
            step_of = np.where(count > 1, second - first, 1)
            # the progression and the block itself inside one run of its difference: no new period
            many = np.flatnonzero(count > 2)
            inside = names.forward(i[many], i[many] + step_of[many]) >= first[many] + (count[many] - 1) * step_of[many] + b - i[many] - step_of[many]
            one_run = np.zeros(len(i), bool)
            one_run[many[inside]] = True
            if one_run.any():  # the difference itself is a period
                places.append(i[one_run])
                periods.append(step_of[one_run])
            i, first, count, step_of = (x[~one_run] for x in (i, first, count, step_of))
            term = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            places.append(np.repeat(i, count))
            periods.append(np.repeat(first - i, count) + term * np.repeat(step_of, count))
        level += 1
    return (np.concatenate(places), np.concatenate(periods)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def runs_of(texts: list[np.ndarray], shortest: int = SHORTEST) -> list[np.ndarray]:
    """For each sequence of numbers its runs (start, length, period), by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1  # an own symbol after each text
    n = int((lengths + 1).sum())
    own = np.repeat(np.arange(len(texts)), lengths + 1)
    symbols = np.zeros(n, np.int64)
    words = np.ones(n, bool)
    words[begins + lengths] = False
    symbols[words] = np.concatenate([np.zeros(0, np.int64), *texts]) + 1
    symbols += own * (int(symbols.max(initial=0)) + 1)
    names = Names(symbols)
    i, q = candidates(names, (begins + lengths)[own])
    keys = np.unique(i * np.int64(n + 1) + q)
    i, q = keys // (n + 1), keys % (n + 1)
    start = i - names.backward(i, i + q)
    end = i + q + names.forward(i, i + q)
    long = end - start >= np.maximum(shortest, 2 * q)
    start, end, q = start[long], end[long], q[long]
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), bool)  # of one stretch the smallest period
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    of = own[start] if len(start) else np.zeros(0, np.int64)
    out = np.stack((start - begins[of], end - start, q), axis=1) if len(start) else np.zeros((0, 3), np.int64)
    out = out[np.lexsort((out[:, 2], out[:, 0], of))]
    cuts = np.cumsum(np.bincount(of, minlength=len(texts)))[:-1]
    return np.split(out, cuts)


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not len(runs):
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)])


def batches_of(texts: list[bytes | None]):
    """(words, runs) of each text in order; texts are searched together up to WORDS words."""
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = (text or b"").split()
        if held and size + len(words) > WORDS:
            yield from zip(held, runs_of([numbered(w) for w in held]), strict=True)
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield from zip(held, runs_of([numbered(w) for w in held]), strict=True)


def found(docs: DataFrame, text: str = "text", *others: str) -> DataFrame:
    """One row per row of `docs`: the `others`, n_words, runs array<struct<start, length, period>> (by start, then period), collapsed.

    Words are [^\\x20\\x09-\\x0D]+, numbered from 0. `collapsed` holds the words
    that no run holds after its first period, joined by a space. A null or
    empty text has no words, no runs and an empty text left. Rows are judged
    one by one, so repeated rows, ties and ids play no part; texts under
    `SHORTEST` words have no run.
    """
    names = [f"c{i}" for i in range(len(others))]
    rows = docs.select(F.col(f"`{text}`").cast("string").cast("binary").alias("text"), *(F.col(f"`{c}`").alias(k) for c, k in zip(others, names, strict=True)))
    kinds = (pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.binary())

    def run(batches):
        for batch in batches:
            n_words, runs, left = [], [], []
            for words, own in batches_of(batch.column(0).to_pylist()):
                n_words.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()])
                left.append(collapsed(words, own))
            columns = [pa.array(x, t) for x, t in zip((n_words, runs, left), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[1:]], names=["n_words", "runs", "collapsed", *names])

    schema = StructType.fromDDL("n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    schema = StructType([*schema.fields, *(StructField(k, rows.schema[k].dataType) for k in names)])
    out = map_batches(rows, run, schema)
    return out.select(*(F.col(k).alias(c) for c, k in zip(others, names, strict=True)), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
