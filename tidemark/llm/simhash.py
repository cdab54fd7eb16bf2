"""SimHash near-duplicates with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut in three segments of 22, 21 and 21 bits. The
perfect binary Golay code [23, 12, 7] maps each segment (padded with zeros)
and all its one-bit neighbours to the indices of their nearest codewords,
about six for each segment. Two segments at distance 2 or less share at least
one index, and for distance 1 or less the other's own index is among them.

Pigeonhole for at most four differing bits over three segments:
* some segment is equal, then one of the other two differs in at most 2 bits:
  key = the equal segment's bits + one index of the other (six families);
* none is equal, then two of them differ in exactly one bit and the third in at
  most two: key = one index of each. One side sends all combinations, the other
  only those with its own index in two segments.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import at_least_partitions, joined_as_measured, map_batches, with_place, written
from tidemark.llm.components import components

GOLAY_POLYNOMIAL = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (shift, bits)
MAX_BITS = 4
#: A fingerprint has some 230 keys: their shuffles take this many partitions at least.
KEY_PARTITIONS = 64


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 if there are no words."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(found))
    spans = zip(starts[: len(found) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], seed) for s, e in spans], dtype=">u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def with_fingerprint(rows: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, f, r, fp long): one row per row of (doc_id, f, r, text binary)."""

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t, words, seed) for t in batch.column(3).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps.view(np.int64))], names=["doc_id", "f", "r", "fp"])

    return map_batches(rows.select("doc_id", "f", "r", "text"), run, "doc_id long, f long, r long, fp long")


# ------------------------------------------------------------------ Golay keys

def syndrome(word: int) -> int:
    """Remainder of a 23-bit word by the code's polynomial."""
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GOLAY_POLYNOMIAL << (bit - 11)
    return word


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and the error pattern of each syndrome."""
    low = np.array([syndrome(x) for x in range(1 << 12)], np.int64)
    high = np.array([syndrome(x << 12) for x in range(1 << 11)], np.int64)
    errors = np.zeros(1 << 11, np.int64)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            errors[syndrome(e)] = e
    return low, high, errors


def codeword_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    low, high, errors = tables()
    return (words ^ errors[low[words & 4095] ^ high[words >> 12]]) >> 11


def near_indices(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Different indices of each word and its one-bit neighbours (six at most), and which entries hold one."""
    ball = np.concatenate(([0], 1 << np.arange(bits, dtype=np.int64)))
    found = np.sort(codeword_index(words[:, None] ^ ball[None, :]), axis=1)
    first = np.ones(found.shape, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    order = np.argsort(~first, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(found, order, 1), np.take_along_axis(first, order, 1)


def keys(fps: np.ndarray, side: str) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) arrays; side 'probe' or 'build'. Linked pairs share a key in both directions."""
    u = fps.view(np.uint64)
    raw = [((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    own = [codeword_index(r) for r in raw]
    near = [near_indices(r, n) for r, (_, n) in zip(raw, SEGMENTS, strict=True)]
    rows, out = [], []
    for family, (i, j) in enumerate(permutations(range(3), 2)):
        r, c = np.nonzero(near[j][1])
        rows.append(r)
        out.append((family << 40) | (raw[i][r] << 12) | near[j][0][r, c])
    (a, fa), (b, fb), (c, fc) = near
    top = 6 << 40
    if side == "probe":
        r, x, y, z = np.nonzero(fa[:, :, None, None] & fb[:, None, :, None] & fc[:, None, None, :])
        rows.append(r)
        out.append(top | a[r, x] << 24 | b[r, y] << 12 | c[r, z])
    else:
        rows.append(np.arange(len(fps)))
        out.append(top | own[0] << 24 | own[1] << 12 | own[2])
        for free in range(3):
            r, x = np.nonzero(near[free][1] & (near[free][0] != own[free][:, None]))
            part = [o[r] for o in own]
            part[free] = near[free][0][r, x]
            rows.append(r)
            out.append(top | part[0] << 24 | part[1] << 12 | part[2])
    return np.concatenate(rows), np.concatenate(out)


def with_keys(fps: DataFrame, side: str, star: bool = False) -> DataFrame:
    """(key, fp, comp): one row for each key of each fingerprint; star: only the equal-segment families.

    comp is null where it is the fingerprint itself, which is most often so: the shuffled rows pack better.
    """

    def run(batches):
        for batch in batches:
            fp = np.asarray(batch.column(0))
            comp = pc.if_else(pc.equal(batch.column(0), batch.column(1)), pa.scalar(None, pa.int64()), batch.column(1))
            row, key = keys(fp, "build" if star else side)
            if star:
                row, key = row[key >> 40 < 6], key[key >> 40 < 6]
            for i in range(0, len(key), 1 << 18):
                r = row[i:i + (1 << 18)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[i:i + (1 << 18)]), pa.array(fp[r]), comp.take(pa.array(r))], names=["key", "fp", "comp"])

    rows = fps.select("fp", "comp").repartition(KEY_PARTITIONS)  # a small table; its keys are not
    return map_batches(rows, run, "key long, fp long, comp long")


# ----------------------------------------------------------------------- links

def differ(a: str, b: str) -> F.Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def star_links(fps: DataFrame) -> DataFrame:
    """Each fingerprint to the smallest one that shares a key, where they link: a row per key at most."""
    rows = with_keys(fps.select("fp", F.col("fp").alias("comp")), "build", star=True).select("key", "fp")
    least = rows.groupBy("key").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "hub")
    return (rows.join(least, "key").where(F.col("fp") != F.col("hub")).where(differ("fp", "hub") <= MAX_BITS)
            .select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct())


def cross_links(fps: DataFrame) -> DataFrame:
    """Verified links between fingerprints of different components, all of them.

    Only keys under which different components meet go on, and there the
    largest component is only compared with the others, so that a dense group
    which the stars have joined costs nothing.
    """
    own = F.coalesce("comp", "fp")
    build = with_keys(fps, "build")
    span = build.groupBy("key").agg(F.min(own).alias("lo"), F.max(own).alias("hi"))
    asks = (with_keys(fps, "probe").join(span, "key").where((own != F.col("lo")) | (own != F.col("hi")))
            .select("key", F.col("fp").alias("a"), own.alias("ca")))
    asks = written(asks)
    offers = written(build.join(asks.select("key").distinct(), "key", "left_semi").withColumn("comp", own))
    main = (offers.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("main")))
    wants = F.when(F.col("ca") == F.col("main"), F.array(F.lit(False))).otherwise(F.array(F.lit(True), F.lit(False)))
    asks = asks.join(main, "key").select("key", "a", "ca", F.explode(wants).alias("is_main"))
    offers = (offers.join(main, "key")
              .select("key", F.col("fp").alias("b"), F.col("comp").alias("cb"), (F.col("comp") == F.col("main")).alias("is_main")))
    near = (asks["key"] == offers["key"]) & (asks["is_main"] == offers["is_main"]) & (F.col("ca") != F.col("cb")) & (differ("a", "b") <= MAX_BITS)
    return asks.join(offers, near).select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()


def grouped(rows: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, f, r, fp, component, component_id): every row (f, r, doc_id, text) with its group; component is the group's key."""
    prints = written(with_fingerprint(rows, words, seed))
    fps = written(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    with at_least_partitions(rows.sparkSession, KEY_PARTITIONS), joined_as_measured(rows.sparkSession):
        links = written(star_links(fps))
    stars = components(links)
    fps = written(fps.join(stars.select(F.col("id").alias("fp"), F.col("root").alias("r")), "fp", "left")
                  .select("fp", "rep", F.coalesce("r", "fp").alias("comp")))
    with at_least_partitions(rows.sparkSession, KEY_PARTITIONS), joined_as_measured(rows.sparkSession):
        links = written(cross_links(fps))
    cross = components(links)
    fps = (fps.join(cross.select(F.col("id").alias("comp"), F.col("root").alias("r")), "comp", "left")
           .select("fp", "rep", F.coalesce("r", "comp").alias("component")))
    least = fps.groupBy("component").agg(F.min("rep").alias("component_id"))
    return prints.join(fps.join(least, "component").select("fp", "component", "component_id"), "fp")


def near_duplicates(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    Null and blank texts have fingerprint 0 and link with each other. A
    repeated doc_id is one document of its component for each of its texts; a
    null doc_id is never a component_id (a component of such rows only has
    null). No documents: no rows. Other columns of `docs` play no part.
    """
    rows = with_place(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return grouped(rows, words, seed).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """The row with the smallest doc_id of each group, all columns as they are; a row without doc_id only where all are."""
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    placed = with_place(docs, *(F.col(f"`{c}`").alias(k) for c, k in at.items()))
    rows = placed.select("f", "r", F.col(at["doc_id"]).cast("long").alias("doc_id"), F.col(at["text"]).cast("string").cast("binary").alias("text"))
    first = (grouped(rows, words, seed).groupBy("component")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "f", "r")).alias("x")).select("x.f", "x.r"))
    return placed.join(first, ["f", "r"], "left_semi").select(*(F.col(k).alias(c) for c, k in at.items()))
