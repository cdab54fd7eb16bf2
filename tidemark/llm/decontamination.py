"""Benchmark decontamination by template canonicalisation.

Words become typed placeholders: numbers, units (also stuck to a number) and
names (capitalised words inside a sentence); the others are lower-cased. Every
text has two streams of tokens: in the second one names stay plain words, so
that a copy in other case is found as well. Windows of `WINDOW` tokens of the
documents are joined by hash with those of the benchmark items. On each
diagonal (document place less item place) one name of the item should always
stand for one name of the document and the other way round: windows whose names
are not those of most places go, so renamed questions are found but not texts
that only have the same frame. Numbers and units may change one by one.

Items without any window (fewer than five tokens, or hardly a plain word) are
found by their own words: all of them if fewer than five, else five at a time.

An item is found in a document if consistent diagonals hold 0.8 or more of its
windows, or `LONG` windows of it.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, written

WINDOW = 5
SHARE = 0.8
LONG = 20
#: Windows of which fewer tokens than this are plain words say nothing.
PLAIN = 2
#: Benchmark windows that are broadcast to sift the documents' windows (8 bytes each); beyond it Spark joins all of them.
MAX_KNOWN = 4_000_000
#: Words a Python worker remembers.
MAX_WORDS = 200_000
#: Words that are looked up at a time.
WORDS_AT_ONCE = 200_000

# Units of measure.
UNITS = frozenset("""
    mm cm dm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t ton tons tonne tonnes oz ounce ounces lb lbs pound pounds
    ml cl l liter liters litre litres gallon gallons ms s sec secs second seconds min mins minute minutes h hr hrs hour hours day days
    week weeks month months year years km/h mph kph hz khz mhz ghz w kw mw kwh v a k c f percent degree degrees
    dollar dollars euro euros cent cents usd eur gbp b kb mb gb tb
""".split())
_NUMBER = re.compile(r"[+-]?[$€£]?(\d[\d.,:/]*)(%|[a-z/]*)")
_EDGES = "\"'`.,;:!?()[]{}<>*#&$%@|~^_=+-/\\«»“”‘’…"

WORD, NUMBER, UNIT, NAME, ENDS, NOTHING = 0, 1, 2, 4, 8, 16


def canonical(word: str) -> tuple[str, int]:
    """(token, flags) of a word without its place: NAME if it is capitalised, ENDS if a sentence ends after it."""
    ends = ENDS if word.rstrip("\"')]}»”’").endswith((".", "!", "?", ":")) else 0
    bare = word.strip(_EDGES)
    low = bare.lower()
    if not low:
        return "", NOTHING | ends
    m = _NUMBER.fullmatch(low)
    if m and (not m.group(2) or m.group(2) == "%" or m.group(2) in UNITS):
        return f"<number>{'<unit>' if m.group(2) else ''}", NUMBER | ends
    if low in UNITS and len(low) > 1:
        return "<unit>", UNIT | ends
    named = NAME if bare[0].isupper() and any(map(str.islower, bare)) else 0
    return low, named | ends


class Words(dict):
    """Numbers of words; their token hashes and flags. Forgets all when there are too many."""

    def __init__(self):
        super().__init__()
        self.hashes = np.zeros(0, np.uint64)
        self.literal = np.zeros(0, np.uint64)  # of the words themselves
        self.flags = np.zeros(0, np.uint8)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self) > MAX_WORDS:
            self.clear()
            self.hashes, self.literal, self.flags = self.hashes[:0], self.literal[:0], self.flags[:0]
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            new = [canonical(w) for w in self.new]
            self.hashes = np.concatenate((self.hashes, np.array([xxhash.xxh3_64_intdigest(t.encode()) for t, _ in new], np.uint64)))
            own = [xxhash.xxh3_64_intdigest(w.strip(_EDGES).lower().encode()) for w in self.new]
            self.literal = np.concatenate((self.literal, np.array(own, np.uint64)))
            self.flags = np.concatenate((self.flags, np.array([f for _, f in new], np.uint8)))
            self.new = []
        return self.hashes[at], self.literal[at], self.flags[at]


_NAME_HASH = np.uint64(xxhash.xxh3_64_intdigest(b"<name>"))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def streams(words: list[str], first: np.ndarray, memory: Words) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(places of the words that are tokens, (token hashes, whether a slot) of the two streams, the words' hashes); first: words that begin a text."""
    hashes, literal, flags = memory.look_up(words)
    starts = first.copy()  # of sentences
    starts[1:] |= (flags[:-1] & ENDS) > 0
    kept = np.flatnonzero((flags & NOTHING) == 0)
    slot = (flags & (NUMBER | UNIT)) > 0
    name = ((flags & NAME) > 0) & ~starts
    return kept, [(np.where(name, _NAME_HASH, hashes)[kept], (slot | name)[kept]), (hashes[kept], slot[kept])], literal[kept]


def windows(hashes: np.ndarray, slots: np.ndarray, owner: np.ndarray, stream: int, k: int = WINDOW, least: int = PLAIN) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of the windows inside one text with enough plain words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = np.full(n, stream + 1, np.uint64)
    for j in range(k):
        x = (x ^ hashes[j:j + n]) * _FACTOR
        x ^= x >> np.uint64(29)
    plain = np.concatenate(([0], np.cumsum(~slots)))
    at = np.flatnonzero((plain[k:] - plain[:-k] >= least) & (owner[:n] == owner[k - 1:]))
    return at, x[at].view(np.int64)


def window_rows(texts: DataFrame, sieve=None, sizes: list[int] | None = None) -> DataFrame:
    """(id, n, stream, at, hash, slots): windows of (id, text); n: windows of the whole text in that stream.

    slots: the words in the window's slots, each with its place in the window;
    names begin with "@". Stream 1 + k has windows of k words as they are: with
    `sizes` those k of every text, else five or all words of texts without other windows.
    `sieve`: a broadcast sorted array of hashes; windows with others are left out.
    """
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string()))

    def of_texts(ids, found, memory):
        """Rows for some texts' words, all looked up at once."""
        count = np.array([len(w) for w in found], np.int64)
        words = list(chain.from_iterable(found))
        first = np.zeros(len(words), bool)
        first[(np.cumsum(count) - count)[count > 0]] = True
        owner = np.repeat(np.arange(len(found)), count)
        kept, both, literal = streams(words, first, memory)
        own = owner[kept]
        begin = np.searchsorted(own, np.arange(len(found)))  # a text's first token
        out = []
        more = [(stream, *x, *windows(*x, own, stream)) for stream, x in enumerate(both)]
        alone = np.ones(len(found), bool)  # texts whose own words count
        length = np.full(len(found), WINDOW)
        if sizes is None:
            for *_, at, _ in more:
                alone[own[at]] = False
            length = np.minimum(np.bincount(own, minlength=len(found)), WINDOW)
        for k in range(1, WINDOW + 1) if sizes is None else sizes:
            none = np.zeros(len(literal), bool)
            at, h = windows(literal, none, own, 1 + k, k, 0)
            if sizes is None:
                mine = alone[own[at]] & (length[own[at]] == k)
                at, h = at[mine], h[mine]
            more.append((1 + k, literal, none, at, h))
        for stream, hashes, slots, at, h in more:
            n = np.bincount(own[at], minlength=len(found))
            if sieve is not None:
                known = sieve.value
                hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
                at, h = at[hit], h[hit]
            for i, x in zip(at.tolist(), h.tolist(), strict=True):
                held = [f"{j}:{'@' * int(hashes[i + j] == _NAME_HASH)}{words[kept[i + j]].strip(_EDGES).lower()}" for j in np.flatnonzero(slots[i:i + WINDOW]).tolist()]
                t = own[i]
                out.append((ids[t], int(n[t]), stream, i - int(begin[t]), x, held))
        return out

    def run(batches):
        memory = Words()
        for batch in batches:
            ids, found, size, out = [], [], 0, []
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for i, (row, text) in enumerate(rows):
                ids.append(row)
                found.append((text or "").split())
                size += len(found[-1])
                if size >= WORDS_AT_ONCE or i == len(rows) - 1:
                    out += of_texts(ids, found, memory)
                    ids, found, size = [], [], 0
            for i in range(0, len(out), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + (1 << 16)], strict=True), kinds, strict=True)],
                                                 names=["id", "n", "stream", "at", "hash", "slots"])

    return map_batches(texts.select("id", "text"), run, "id long, n long, stream int, at long, hash long, slots array<string>")


def leaks(docs: DataFrame, benchmark: DataFrame, max_known: int = MAX_KNOWN) -> DataFrame:
    """One row for each item found in a document: doc_id, item_id, share, n_windows, exact (no slot differs).

    Null texts and texts without a letter or digit hold and match nothing; rows
    without doc_id or item_id are left out. Rows that repeat an id count as one
    document or item with all their windows. An empty benchmark: no rows.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id IS NOT NULL")
    known = written(window_rows(items).select(F.col("id").alias("item_id"), F.col("n").alias("total"), "stream", F.col("at").alias("item_at"),
                                              "hash", F.col("slots").alias("item_slots")))
    sieve = None
    if known.count() <= max_known:
        hashes = known.select("hash").distinct().toArrow().column(0).to_numpy()
        sieve = docs.sparkSession.sparkContext.broadcast(np.sort(hashes))
    sizes = sorted(r[0] - 1 for r in known.where("stream > 1").select("stream").distinct().collect())  # five at most
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id IS NOT NULL")
    hits = (window_rows(rows, sieve, sizes).select(F.col("id").alias("doc_id"), "stream", "at", "hash", "slots")
            .join(known, ["hash", "stream"]).withColumn("diagonal", F.col("at") - F.col("item_at")))
    hits = written(hits)
    # on each diagonal, one name of the item for one of the document: the pair of most places, for either side
    diagonal = ["doc_id", "item_id", "stream", "diagonal"]
    differing = hits.where("slots != item_slots").select(*diagonal).distinct()
    places = (hits.join(differing, diagonal, "left_semi").select(*diagonal, "item_at", F.explode(F.arrays_zip("slots", "item_slots")).alias("x"))
              .select(*diagonal, (F.col("item_at") + F.substring_index("x.slots", ":", 1).cast("long")).alias("place"),
                      F.expr("substr(x.slots, instr(x.slots, ':') + 1)").alias("a"), F.expr("substr(x.item_slots, instr(x.item_slots, ':') + 1)").alias("b"))
              .where("startswith(a, '@')").distinct())
    pairs = places.groupBy(*diagonal, "a", "b").count()
    for_b = Window.partitionBy(*diagonal, "b").orderBy(F.desc("count"), "a")
    for_a = Window.partitionBy(*diagonal, "a").orderBy(F.desc("count"), "b")
    clash = (pairs.withColumn("i", F.row_number().over(for_b)).withColumn("j", F.row_number().over(for_a)).where("i > 1 OR j > 1")
             .groupBy(*diagonal).agg(F.collect_set(F.concat_ws(" ", "a", "b")).alias("clashes")))
    odd = differing.join(clash, diagonal, "left").withColumn("differs", F.lit(True))
    held = F.transform(F.arrays_zip("slots", "item_slots"), lambda x: F.concat_ws(
        " ", F.regexp_replace(x["slots"], r"^\d+:", ""), F.regexp_replace(x["item_slots"], r"^\d+:", "")))
    fit = (hits.join(odd, diagonal, "left").where(F.col("clashes").isNull() | ~F.arrays_overlap(held, F.col("clashes")))
           .groupBy("doc_id", "item_id", "stream", "item_at")
           .agg(F.max("total").alias("total"), F.min(F.coalesce("differs", F.lit(False))).alias("differs")))
    found = (fit.groupBy("doc_id", "item_id", "stream")
             .agg(F.count(F.lit(1)).alias("n"), F.max("total").alias("total"), F.max("differs").alias("differs"))
             .withColumn("share", F.col("n") / F.col("total"))
             .where((F.col("share") >= SHARE) | (F.col("n") >= LONG)))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("share").alias("share"), F.max("n").alias("n_windows"), (~F.min("differs")).alias("exact"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` in which no item is found; rows without doc_id stay."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))
