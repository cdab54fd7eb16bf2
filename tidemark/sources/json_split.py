"""JSON documents cut across splits (A6): a large document uses as many tasks as it has splits.

A document is `{..., "transactions": [{record}, ...], ...}` with banner lines
around it, comments, and any characters inside strings. The line reader cuts the
file at every `}`, so its splits are spread over tasks like those of any text
file. Where a split begins, neither the nesting nor the place (inside a string,
a comment ...) is known. So

1. every split tells, for each place it may begin in, where it ends and how it
   changes the open brackets: how many it closes, and which it leaves open;
2. these small functions, one row per split, are composed in the order of the
   file, which gives every split its true beginning;
3. every split emits the records that lie in it whole; only pieces of the
   records that cross a border are put together, by a grouping of a few rows.

A document that does not end with all brackets closed gives one broken payload,
as it would not parse as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATOR = "}"
#: Where a split may begin: plain text, a string in double or single quotes, a line or a block comment.
PLAIN, DOUBLE, SINGLE, LINE, BLOCK = PLACES = ("plain", "double", "single", "line", "block")
_STRINGS = {DOUBLE: r'"(?:[^"\\]++|\\.)*+"', SINGLE: r"'(?:[^'\\]++|\\.)*+'"}
_BANNER = r"(?:\A|(?<=[\r\n}]))\s*-{3,}"  # three dashes or more begin a banner line
#: What changes nothing (whole strings and comments among it), then a bracket, or what begins a string or comment that does not end here.
_NEXT = re.compile(rf"""(?:[^"'{{}}\[\]/\s-]++|{_STRINGS[DOUBLE]}|{_STRINGS[SINGLE]}|//[^\r\n]*+[\r\n]|/\*.*?\*/|{_BANNER}[^\r\n]*[\r\n])*+"""
                   rf"""(?:(?P<bracket>[{{}}\[\]])|(?P<double>")|(?P<single>')|(?P<line>//|{_BANNER})|(?P<block>/\*)|(?P<other>.))?""", re.S)
_ENDS = {DOUBLE: re.compile(r'(?:[^"\\]|\\.)*"', re.S), SINGLE: re.compile(r"(?:[^'\\]|\\.)*'", re.S), LINE: re.compile(r"[^\r\n]*[\r\n]"),
         BLOCK: re.compile(r".*?\*/", re.S)}
_LIST = re.compile(r'"transactions"\s*:\s*\Z')
_COMMENT = re.compile(r"//[^\r\n]*|/\*.*?\*/", re.S)
#: Kinds of open brackets; RECORDS is the list of transactions of the document.
OBJECT, ARRAY, RECORDS = "{", "[", "R"
_BEFORE_RECORD = [OBJECT, RECORDS]
#: Bytes that a task scans where splits are smaller.
TASK_BYTES = 1 << 24


def brackets(text: str, place: str) -> tuple[list[tuple[int, str]], str]:
    """The brackets of some chunks (joined by the separator, and one after them) outside strings and comments, and the place after them."""
    out, at = [], 0
    if place != PLAIN:
        m = _ENDS[place].match(text)
        if m is None:
            return out, place  # the separator belongs to the string or comment
        at = m.end()
    while True:
        m = _NEXT.match(text, at)
        at, found = m.end(), m.lastgroup
        if found == "bracket":
            pos, b = at - 1, m.group(found)
            if b == "[" and _LIST.search(_COMMENT.sub("", text[max(text.rfind(SEPARATOR, 0, pos) + 1, pos - 1000):pos])):
                b = RECORDS
            out.append((pos, b))
        elif found is None:
            out.append((len(text), SEPARATOR))
            return out, PLAIN
        elif found != "other":
            return out, found


def applied(stack: list[str], bracket: str) -> int:
    """Changes the open brackets; 1 if one was closed that is not on the stack."""
    if bracket in "}]":
        if not stack:
            return 1
        stack.pop()
    else:
        stack.append(bracket)
    return 0


def _by_split(batches) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(file, split start), and of each split of a task, in order, some chunks at a time: (that key, their text, the rows' positions)."""

    def blocks():
        for b in batches:
            if not b.num_rows:
                continue
            file = b.column(0).dictionary_encode()
            names, number = file.dictionary.to_pylist(), file.indices.to_numpy()
            start, text, row = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            cuts = (np.flatnonzero((number[1:] != number[:-1]) | (start[1:] != start[:-1])) + 1).tolist()
            for i, j in zip([0, *cuts], [*cuts, len(text)], strict=True):
                yield (names[number[i]], int(start[i])), SEPARATOR.join(text[i:j]), row[i:j]

    return groupby(blocks(), key=lambda block: block[0])


def changes(chunks: DataFrame) -> DataFrame:
    """(_source_file, _split_start, place, after, closed, open): what each split does, for each place it may begin in.

    A file begins in plain text; its first split has no row if it ends there with all brackets closed, as it
    then changes nothing. So documents that are smaller than a split bring no rows to the driver.
    """
    names = ["_source_file", "_split_start", "place", "after", "closed", "open"]

    def run(batches):
        for (file, start), blocks in _by_split(batches):
            state = {p: (p, 0, []) for p in (PLACES if start else (PLAIN,))}
            for _, text, _ in blocks:
                seen: dict = {}
                for p, (now, closed, stack) in state.items():
                    if now not in seen:
                        seen[now] = brackets(text, now)
                    found, after = seen[now]
                    for _, b in found:
                        closed += applied(stack, b)
                    state[p] = after, closed, stack
            out = [(file, start, p, after, closed, "".join(stack)) for p, (after, closed, stack) in state.items() if start or stack or after != PLAIN]
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in out], schema=schema)

    schema = pa.schema([("_source_file", pa.string()), ("_split_start", pa.int64()), ("place", pa.string()), ("after", pa.string()), ("closed", pa.int64()), ("open", pa.string())])
    return chunks.select("_source_file", "_split_start", "value", "_row_pos").mapInArrow(run, "_source_file string, _split_start long, place string, after string, closed long, open string")


def composed(rows: list) -> tuple[dict, set]:
    """From all splits' changes: by (file, split) its place, open brackets and the split in which an open record began; and the broken files."""
    by_split: dict = {}
    for r in rows:
        by_split.setdefault((r["_source_file"], r["_split_start"]), {})[r["place"]] = (r["after"], r["closed"], list(r["open"]))
    begins, place, stack, since, file, broken = {}, PLAIN, [], None, None, set()
    for key in sorted(by_split):
        if key[0] != file:
            if stack or place in (DOUBLE, SINGLE, BLOCK):
                broken.add(file)
            file, place, stack, since = key[0], PLAIN, [], None
        begins[key] = (place, stack, since)
        place, closed, left = by_split[key][place]
        if left and len(stack) - closed <= 2:
            since = key[1]
        stack = stack[:max(0, len(stack) - closed)] + left
    if stack or place in (DOUBLE, SINGLE, BLOCK):
        broken.add(file)
    return begins, broken


def crossed_splits(begins: dict) -> set:
    """The splits that hold a piece of a record that crosses their border: a later one begins, or they begin, inside it."""
    out, last = set(), None
    for key in sorted(begins):
        _, stack, _ = begins[key]
        if stack[:2] == _BEFORE_RECORD and len(stack) > 2:
            out.add(key)
            if last and last[0] == key[0]:
                out.add(last)
        last = key
    return out


def packed(chunks: DataFrame) -> DataFrame:
    """The same rows in the same order, small splits of a scan a few to a task: a task takes TASK_BYTES of them, where every core has some."""
    spark = chunks.sparkSession
    each = max(1, TASK_BYTES // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    splits = chunks._jdf.queryExecution().toRdd().getNumPartitions()
    tasks = max(splits // each, 4 * spark.sparkContext.defaultParallelism)
    return chunks.coalesce(tasks) if tasks < splits else chunks


def json_records(chunks: DataFrame) -> DataFrame:
    """Chunks of files cut at `}` (value, _source_file, _split_start, _row_pos) -> one row per record.

    raw_payload is a document of its own that holds just the record. Rows of a
    split must come in the order of the file, as a scan gives them.
    """
    chunks = packed(chunks.select("_source_file", "_split_start", "value", "_row_pos"))
    begins, broken = composed(changes(chunks).collect())  # a few rows per split that a document leaves or enters open, never text
    crossing = crossed_splits(begins)
    names = ["_source_file", "_split_start", "_row_pos", "part", "text"]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(batches, parts: bool):
        """The records that lie in a split whole, or the pieces of those that cross a border."""
        for (file, start), blocks in _by_split(batches):
            if parts and (file, start) not in crossing:
                continue
            place, stack, since = begins.get((file, start), (PLAIN, [], None))
            stack, out = list(stack), []
            if file in broken:
                if not start and not parts:
                    yield record_batch([(file, start, int(next(blocks)[2][0]), None, "{")])
                continue
            buffer: list[str] = []
            first_row, inside = 0, stack[:2] == _BEFORE_RECORD and len(stack) > 2
            crossed = inside  # the record began in an earlier split
            for _, text, rows in blocks:
                found, place = brackets(text, place)
                at = row = seen = 0  # row: of the chunk that `seen` lies in
                for pos, b in found:
                    if b == OBJECT and stack == _BEFORE_RECORD:
                        row, seen = row + text.count(SEPARATOR, seen, pos), pos
                        inside, crossed, at, first_row = True, False, pos, int(rows[row])
                    applied(stack, b)
                    if inside and stack == _BEFORE_RECORD:  # the record ends, with this chunk
                        end = text.find(SEPARATOR, pos)
                        buffer.append(text[at:end if end >= 0 else len(text)] + SEPARATOR)
                        if crossed == parts:
                            out.append((file, since if crossed else start, first_row, start if crossed else None, "".join(buffer)))
                        buffer, inside = [], False
                if inside:
                    buffer.append(text[at:] + SEPARATOR)
                if len(out) >= 4096:
                    yield record_batch(out)
                    out = []
            if buffer and parts:
                out.append((file, since if crossed else start, first_row, start, "".join(buffer)))
            if out:
                yield record_batch(out)

    def record_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    def scanned(parts: bool) -> DataFrame:
        return chunks.mapInArrow(lambda batches: run(batches, parts), "_source_file string, _split_start long, _row_pos long, part long, text string")

    rows = scanned(False).select("_source_file", "_split_start", "_row_pos", "text")
    if crossing:  # else no record needs a second scan
        pieces = F.array_sort(F.collect_list(F.struct("part", "_row_pos", "text")))
        joined = (scanned(True).groupBy("_source_file", "_split_start").agg(pieces.alias("p"))
                  .select("_source_file", "_split_start", F.col("p")[0]["_row_pos"].alias("_row_pos"), F.array_join("p.text", "").alias("text")))
        rows = rows.unionByName(joined)
    document = F.when(F.col("text") == "{", F.col("text")).otherwise(F.concat(F.lit('{"transactions":['), F.col("text"), F.lit("]}")))
    return rows.select("_source_file", "_split_start", "_row_pos", document.alias("raw_payload"))
