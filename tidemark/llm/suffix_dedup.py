"""Removes every byte covered by a 200-byte string that also starts elsewhere.

Each 200-byte window is dealt by its smallest 32-byte gram hash, so equal
windows meet under one hash, wherever they stand. Neighbouring windows whose
smallest hash stands at one place make a region (about 85 windows; no two of
them are equal). Regions that are the same bytes are
counted, not compared. Where different regions meet under one hash, one of each
is fetched, and the windows that two of them share are found in the suffix
order of their text (tidemark.llm.suffix). A hash with more than `MAX_REGIONS`
different regions (a line that stands in very many contexts) is never brought
to one task: its regions are dealt anew by ever longer strings that equal
windows have in common (see `halved`).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import map_batches, with_place, written
from tidemark.llm.suffix import suffix_order

LENGTH = 200
GRAM = 32
#: Bytes that are hashed at a time.
CHUNK = 1 << 18
#: Low bits of a hash that give way to its place in the chunk.
PLACE_BITS = np.uint64(18)
#: Different regions of a hash that one suffix order takes.
MAX_REGIONS = 500
#: Bytes of text in one suffix order.
SUFFIX_BYTES = 1 << 14
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    size = CHUNK + LENGTH
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_POWERS: list = []


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the GRAM bytes from each place."""
    if not _POWERS:
        _POWERS.extend(_powers())
    up, down = _POWERS
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(data * up[:len(data)], dtype=np.uint64)))
    x = (sums[GRAM:] - sums[:-GRAM]) * down[:len(data) - GRAM + 1]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def anchors(hashes: np.ndarray) -> np.ndarray:
    """For each window the place of its smallest gram hash, the leftmost of equal ones."""
    low = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    span, width = LENGTH - GRAM + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    return (low & np.uint64((1 << 18) - 1)).view(np.int64)


def regions(texts: list[bytes]):
    """Yields (text, start, windows, hash, digest) arrays: the regions of the texts."""
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, CHUNK - LENGTH):
            piece = text[at:at + CHUNK - 1]  # its last window starts just before the next piece
            if size + len(piece) > CHUNK and group:
                yield regions_of(group)
                group, size = [], 0
            group.append((i, at, piece))
            size += len(piece)
    if group:
        yield regions_of(group)


def regions_of(group: list[tuple[int, int, bytes]]):
    joined = b"".join(g[2] for g in group)
    hashes = gram_hashes(np.frombuffer(joined, np.uint8).astype(np.uint64))
    places = anchors(hashes)
    lengths = np.array([len(g[2]) for g in group])
    begins = np.cumsum(lengths) - lengths
    counts = lengths - LENGTH + 1
    own = np.repeat(np.arange(len(group)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = places[begins[own] + at]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(place)))
    begin = begins[own[first]] + at[first]
    digest = xxhash.xxh3_64_intdigest
    digests = np.array([digest(joined[b:e]) for b, e in zip(begin.tolist(), (begin + size + LENGTH - 1).tolist(), strict=True)], np.uint64)
    text = np.array([g[0] for g in group])[own[first]]
    start = np.array([g[1] for g in group])[own[first]] + at[first]
    return text, start, size, hashes[place[first]].view(np.int64), digests.view(np.int64)


# ------------------------------------------------------------- shared windows

def shared_windows(items: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int, int]]:
    """(hash, digest, first, last): runs of windows of each region that another place of the items shares.

    Items: (hash, digest, copies, bytes), all different regions of some hashes.
    Windows whose digest stands once among the items are left out first; the
    suffix order of what is left decides.
    """
    out = [(h, d, 0, len(b) - LENGTH) for h, d, copies, b in items if copies > 1]
    digest = xxhash.xxh3_64_intdigest
    marks = [[digest(b[i:i + LENGTH]) for i in range(len(b) - LENGTH + 1)] for _, _, _, b in items]
    flat = np.concatenate([np.array(m, np.uint64) for m in marks])
    _, back, times = np.unique(flat, return_inverse=True, return_counts=True)
    twice = times[back] > 1
    spans = []  # (item, first window, last window) of runs that may be shared
    begin = 0
    for i, m in enumerate(marks):
        spans += [(i, a, b) for a, b in runs(np.flatnonzero(twice[begin:begin + len(m)]))]
        begin += len(m)
    if not any(items[i][2] == 1 for i, _, _ in spans):
        return out
    text, windows = bytearray(), []  # windows: place in text, item, offset
    cuts = []
    for i, a, b in spans:
        windows += [(len(text) + j, i, a + j) for j in range(b - a + 1)]
        text += items[i][3][a:b + LENGTH]
        cuts.append(len(text))
        text += b"\0"
    symbols = [x + 2 for x in text]
    for c in cuts:
        symbols[c] = 1
    symbols.append(0)
    where = {p: (i, o) for p, i, o in windows}
    ranked = [p for p in suffix_order(symbols) if p in where]
    data = bytes(text)
    found: dict[int, set[int]] = {}
    for p, q in zip(ranked, ranked[1:], strict=False):
        if data[p:p + LENGTH] == data[q:q + LENGTH]:
            for i, o in (where[p], where[q]):
                found.setdefault(i, set()).add(o)
    for i, offsets in found.items():
        if items[i][2] == 1:
            out += [(items[i][0], items[i][1], a, b) for a, b in runs(np.array(sorted(offsets)))]
    return out


def runs(at: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of runs of consecutive numbers."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) != 1)
    return list(zip(at[np.append(0, cut + 1)].tolist(), at[np.append(cut, len(at) - 1)].tolist(), strict=True))


# ------------------------------------------------------------------ Spark jobs

def region_table(docs: DataFrame) -> DataFrame:
    """(f, r, s, n, h, d): the regions of each text; those that are the same bytes make one row, s lists their starts."""
    def run(batches):
        for batch in batches:
            f, r = np.array(batch.column(0)), np.array(batch.column(1))
            for text, start, size, h, d in regions([t or b"" for t in batch.column(2).to_pylist()]):
                if not len(text):
                    continue
                order = np.lexsort((start, d, h, text))
                text, start, size, h, d = (x[order] for x in (text, start, size, h, d))
                new = np.append(True, (text[1:] != text[:-1]) | (h[1:] != h[:-1]) | (d[1:] != d[:-1]))
                at = np.flatnonzero(new)
                starts = pa.ListArray.from_arrays(pa.array(np.append(at, len(text)), pa.int32()), pa.array(start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f[text[at]]), pa.array(r[text[at]]), starts, pa.array(size[at]), pa.array(h[at]), pa.array(d[at])],
                    names=["f", "r", "s", "n", "h", "d"])

    return map_batches(docs.select("f", "r", "text"), run, "f long, r long, s array<long>, n long, h long, d long")


def fetched(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """The bytes of the needed regions: (h, d, copies, hot, text)."""
    lists = needed.groupBy("f", "r").agg(F.collect_list(F.struct("h", "d", "copies", "hot", "s", "n")).alias("wanted"))

    def run(batches):
        for batch in batches:
            rows = [(w["h"], w["d"], w["copies"], w["hot"], text[w["s"]:w["s"] + w["n"] + LENGTH - 1])
                    for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for w in wanted]
            for i in range(0, len(rows), 4096):
                cols = list(zip(*rows[i:i + 4096], strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["h", "d", "copies", "hot", "text"])

    rows = docs.join(lists, ["f", "r"]).select("text", "wanted")
    return map_batches(rows, run, "h long, d long, copies long, hot boolean, text binary")


def compared(found: DataFrame) -> DataFrame:
    """(h, d, lo, hi) of the windows shared by regions of one hash; whole hashes are taken together up to SUFFIX_BYTES."""

    def run(batches):
        held, size, last = [], 0, None
        rows = (x for batch in batches for x in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for h, d, copies, text in rows:
            if h != last and size > SUFFIX_BYTES:
                yield from answer(held)
                held, size = [], 0
            held.append((h, d, copies, text))
            size += len(text)
            last = h
        if held:
            yield from answer(held)

    def answer(held):
        out = shared_windows(held)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["h", "d", "lo", "hi"])

    rows = found.select("h", "d", "copies", "text").repartition("h").sortWithinPartitions("h", "d")
    return map_batches(rows, run, "h long, d long, lo long, hi long")


def halved(regions: DataFrame) -> DataFrame:
    """The same for hashes with very many regions, by Spark's grouping alone.

    Windows are told apart by how far their anchor lies from their start, in
    classes of falling width. All windows of a class hold one core of bytes, so
    equal windows have equal cores. In each round regions are cut into the
    pieces of their classes; a piece whose core stands nowhere else goes,
    pieces that are the same bytes are reported, and one of them goes on as a
    partner of the others. A line in very many contexts goes in the first
    round; along the edge of a repeated passage one piece a round is left.
    """
    keep = ["h", "d", "at", "copies", "report", "text", "l"]

    def start(batches):
        for batch in batches:
            l0 = [int(anchors(gram_hashes(np.frombuffer(t, np.uint8).astype(np.uint64)))[0]) for t in batch.column(3).to_pylist()]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([0] * n, pa.int64()), batch.column(2), pa.array([True] * n), batch.column(3), pa.array(l0, pa.int64())],
                names=keep)

    def cut(width):
        def run(batches):
            for batch in batches:
                out = []
                for h, d, at, copies, report, text, l in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    n, i = len(text) - LENGTH + 1, 0
                    while i < n:  # window i has its anchor l - i bytes after its start
                        group = (l - i) // width
                        j = min(n, l - group * width + 1)
                        core = text[l - group * width:l - (group + 1) * width + 1 + LENGTH]
                        piece = text[i:j + LENGTH - 1]
                        out.append((h, d, at + i, copies, report, piece, l - i, xxhash.xxh3_128_digest(core, group), xxhash.xxh3_128_digest(piece, l - i)))
                        i = j
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[*keep, "core", "piece"])
        return run

    schema = "h long, d long, at long, copies long, report boolean, text binary, l long"
    rows = map_batches(regions.select("h", "d", "copies", "text"), start, schema)
    shared = []
    for width in (43, 11, 3, 1):
        pieces = written(map_batches(rows.select(keep), cut(width), schema + ", core binary, piece binary"))
        same = pieces.groupBy("core", "piece").agg(F.sum("copies").alias("of_piece"), F.min(F.struct("h", "d", "at")).alias("one"))
        cores = same.groupBy("core").agg(F.sum("of_piece").alias("of_core")).where("of_core > 1")
        met = written(pieces.join(same.join(cores, "core"), ["core", "piece"]))
        n = F.length("text") - LENGTH
        shared.append(met.where("report AND of_piece > 1").select("h", "d", F.col("at").alias("lo"), (F.col("at") + n).alias("hi")))
        rows = (met.where("of_core > of_piece").where((F.col("of_piece") == F.col("copies")) | (F.struct("h", "d", "at") == F.col("one")))
                .withColumn("report", F.col("report") & (F.col("of_piece") == 1)).withColumn("copies", F.col("of_piece")))
        if rows.isEmpty():
            break
    out = shared[0]
    for part in shared[1:]:
        out = out.union(part)
    return out


def repeated_spans(docs: DataFrame, max_regions: int = MAX_REGIONS) -> DataFrame:
    """(f, r, spans array<struct<a, b>>) of the rows (f, r, text) of `docs` that have repeated bytes [a, b)."""
    table = written(region_table(docs))
    # written on its own: a join of two plain exchanges is what Spark can split at a very common hash
    twice = written(table.groupBy("h").agg(F.sum(F.size("s")).alias("c"), F.min("d").alias("lo"), F.max("d").alias("hi")).where("c > 1")
                    .select("h", (F.col("lo") != F.col("hi")).alias("mixed")))
    met = written(table.join(twice, "h"))
    kinds = met.where("mixed").groupBy("h", "d").agg(F.sum(F.size("s")).alias("copies"), F.min(F.struct("f", "r", F.col("s")[0].alias("s"), "n")).alias("one"))
    kinds = written(kinds.select("h", "d", "copies", "one.*"))
    many = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("copies").alias("least"))
    needed = (kinds.join(many.where("least = 1"), "h").select("h", "d", "copies", (F.col("kinds") > max_regions).alias("hot"), "f", "r", "s", "n"))
    found = written(fetched(docs, needed))
    shared = compared(found.where("NOT hot"))
    if not found.where("hot").isEmpty():
        shared = shared.union(halved(found.where("hot")))
    # where all regions of a hash have copies nothing was fetched
    plenty = kinds.join(many.where("least > 1").select("h"), "h").select("h", "d", F.lit(0).cast("long").alias("lo"), (F.col("n") - 1).alias("hi"))
    # all runs of a region in one row, so that each of its copies meets one row
    shared = written(shared.union(plenty).groupBy("h", "d").agg(F.collect_list(F.struct("lo", "hi")).alias("runs")))
    return written(spans_of(met, shared).groupBy("f", "r").agg(F.flatten(F.collect_list("own")).alias("spans")))


def spans_of(met: DataFrame, shared: DataFrame) -> DataFrame:
    """(f, r, own array<struct<a, b>>): at most one row per row of `met`, with its repeated bytes [a, b)."""
    def span(s, lo, hi):
        return F.struct((s + lo).alias("a"), (s + hi + LENGTH).alias("b"))

    whole = met.where("NOT mixed").select("f", "r", F.transform("s", lambda s: span(s, F.lit(0), F.col("n") - 1)).alias("own"))
    parts = met.where("mixed").join(shared, ["h", "d"]).select(
        "f", "r", F.flatten(F.transform("s", lambda s: F.transform("runs", lambda x: span(s, x["lo"], x["hi"])))).alias("own"))
    return whole.union(parts)


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((x["a"], x["b"]) for x in spans or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])


def digests(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is an empty one; texts under 200 bytes lose nothing. Rows that
    repeat a whole text of 200 bytes or more lose all of it, each of them.
    """
    rows = with_place(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text, spans = text or b"", merged(spans)
                kept = kept_bytes(text, spans)
                out.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([x[i] for x in out], t) for i, t in enumerate(kinds))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = repeated_spans(rows.select("f", "r", "text")).hint("merge")  # lists are far longer than their files, by which Spark would size them
    joined = rows.join(found, ["f", "r"], "left").select("doc_id", "text", "spans")
    return map_batches(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cleaned(docs: DataFrame) -> DataFrame:
    """`docs` without the repeated bytes of its texts: same columns, `text` cut.

    A character of which only some bytes are covered goes whole. A row that had
    a text and loses all of it goes; null and empty texts stay.
    """
    others = [c for c in docs.columns if c != "text"]
    fields = [docs.schema[c].dataType for c in others]
    names = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]
    rows = with_place(docs, F.col("text").cast("string").cast("binary").alias("text"), *names)

    def run(batches):
        for batch in batches:
            before = batch.column(0).to_pylist()
            texts = [None if text is None else kept_bytes(text, merged(spans)).decode("utf-8", "ignore")
                     for text, spans in zip(before, batch.column(1).to_pylist(), strict=True)]
            keep = pa.array([not t or bool(x) for t, x in zip(before, texts, strict=True)], pa.bool_())
            out = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[2:]], names=["text", *(f"c{i}" for i in range(len(others)))])
            yield out.filter(keep)

    found = repeated_spans(rows.select("f", "r", "text")).hint("merge")
    joined = rows.join(found, ["f", "r"], "left").select("text", "spans", *(f"c{i}" for i in range(len(others))))
    schema = StructType([StructField("text", StringType()), *(StructField(f"c{i}", t) for i, t in enumerate(fields))])
    out = map_batches(joined, run, schema)
    at = {c: f"c{i}" for i, c in enumerate(others)} | {"text": "text"}
    return out.select(*(F.col(at[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns))
