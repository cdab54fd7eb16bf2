"""Nearest neighbours by largest inner product with an inverted multi-index.

Both halves of the vectors are quantised by k-means codebooks; a row's cell is
its pair of centroids. A query visits centroid pairs in descending order of the
summed inner products of its halves with the centroids, by a heap. First it
takes the cells that hold `first` entries; the score of the k-th best entry
found there is its bar. Then it goes on as long as a cell's sum is above the
bar less a margin, and every entry there that reaches the bar is kept with its
exact inner product. The margin is how far the true score of a near pair lies
above its cell's sum; it is measured (`quantile`) on some queries and their true
neighbours among all rows.

Cells are dealt to tasks by their first centroid, in chunks of entries and
blocks of queries, so that neither a full cell nor a popular one meets whole.
The traversal comes first: only the queries that visit a centroid's cells count
for its blocks, so its entries are copied once per `BLOCK_QUERIES` visitors, and
not at all without one.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, written

#: Rows that the codebooks are fitted on, at most.
FIT_ROWS = 10_000
#: Queries that are scored against all rows for the margin, at most.
MARGIN_QUERIES = 256
CHUNK_ENTRIES = 8192
BLOCK_QUERIES = 1024
#: Queries whose traversals one task does, about.
TASK_QUERIES = 4096


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>): rows with an id and a finite vector that is not zero, of the most frequent length."""
    v = F.col("embedding").cast("array<double>")
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
            .where(F.exists("v", lambda x: x != 0)))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (lengths["n"] if lengths else 0))


def matrix(column) -> np.ndarray:
    """The rows of an Arrow list column of equal lengths."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


# -------------------------------------------------------------------- codebooks

def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids; starts from rows spread over the sample, an empty one keeps its place."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmax(x @ c.T - 0.5 * (c * c).sum(1), axis=1)


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = (x.shape[1] + 1) // 2
    return x[:, :cut], x[:, cut:]


class Codebooks:
    def __init__(self, sample: np.ndarray, k: int):
        self.books = [k_means(h, k) for h in halves(sample)]
        self.k = len(self.books[0])
        self.margin = 0.0

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = halves(x)
        return nearest(a, self.books[0]), nearest(b, self.books[1])

    def sums(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = halves(q)
        return a @ self.books[0].T, b @ self.books[1].T


def fit_margin(rows: DataFrame, books: Codebooks, modulus: int, top: int, quantile: float) -> float:
    """Quantile of score less cell sum over the true nearest pairs of some queries, each scored against all rows."""
    some = (rows.where(F.col("vec_id") % modulus == 0).orderBy(F.xxhash64("vec_id"), "vec_id").limit(MARGIN_QUERIES)).toArrow()
    if not some.num_rows:
        return 0.0
    query, q = some.column(0).to_numpy(), matrix(some.column(1))
    s, t = books.sums(q)

    def run(batches):
        best = np.full((len(q), top), -np.inf)  # of this task, with their gaps
        gaps = np.full((len(q), top), np.nan)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            score = q @ x.T
            score[query[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
            if not (score > best.min(axis=1)[:, None]).any():
                continue
            i, j = books.cells(x)
            both = np.concatenate((best, score), axis=1)
            gap = np.concatenate((gaps, score - s[:, i] - t[:, j]), axis=1)
            at = np.argpartition(-both, top - 1, axis=1)[:, :top]
            best, gaps = np.take_along_axis(both, at, 1), np.take_along_axis(gap, at, 1)
        n, c = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(query[n]), pa.array(best[n, c]), pa.array(gaps[n, c])], names=["query_id", "score", "gap"])

    near = map_batches(rows.select("vec_id", "v"), run, "query_id long, score double, gap double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "gap")
    found = near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top).select("gap").toArrow().column(0).to_numpy()
    return float(np.quantile(found, quantile)) if len(found) else 0.0


def fit(rows: DataFrame, modulus: int, top: int, quantile: float) -> tuple[Codebooks, int]:
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).toArrow()
    k = max(1, min(256, int(math.sqrt(n / 12)), max(1, sample.num_rows // 20)))
    books = Codebooks(matrix(sample.column(1)), k)
    books.margin = fit_margin(rows, books, modulus, top, quantile)
    return books, n


# -------------------------------------------------------------------- traversal

def traverse(s: np.ndarray, t: np.ndarray):
    """Pairs (i, j, sum) in descending order of s[i] + t[j]."""
    a, b = np.argsort(-s, kind="stable"), np.argsort(-t, kind="stable")
    sa, tb = s[a].tolist(), t[b].tolist()
    a, b = a.tolist(), b.tolist()
    heap = [(-(sa[0] + tb[0]), 0, 0)]
    while heap:
        total, x, y = heapq.heappop(heap)
        yield a[x], b[y], -total
        if y + 1 < len(tb):  # the pair to the right; the pair below only from the first column
            heapq.heappush(heap, (-(sa[x] + tb[y + 1]), x, y + 1))
        if y == 0 and x + 1 < len(sa):
            heapq.heappush(heap, (-(sa[x + 1] + tb[0]), x + 1, 0))


def visits(queries: DataFrame, books: Codebooks, counts: np.ndarray, first: int) -> DataFrame:
    """(i, query_id, mask): the cells of first centroid i that a query visits.

    Without a bar: the cells that hold `first` entries. With one: all cells
    whose sum is above it less the margin. Cells without entries are passed.
    """
    k = books.k

    def run(batches):
        for batch in batches:
            out = []
            ids, bars = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            q = matrix(batch.column(1))
            s, t = books.sums(q)
            for n, (query, bar) in enumerate(zip(ids, bars, strict=True)):
                seen = {}
                have = 0
                for i, j, total in traverse(s[n], t[n]):
                    if have >= first if bar is None else total < bar - books.margin:
                        break
                    if counts[i, j]:
                        have += int(counts[i, j])
                        seen.setdefault(i, []).append(j)
                for i, js in seen.items():
                    mask = np.zeros(k, bool)
                    mask[js] = True
                    out.append((i, query, np.packbits(mask).tobytes()))
            for at in range(0, len(out), 4096):
                i, query, mask = zip(*out[at:at + 4096], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(query, pa.int64()), pa.array(mask, pa.binary())],
                                                 names=["i", "query_id", "mask"])

    return map_batches(queries.select("query_id", "v", "bar"), run, "i long, query_id long, mask binary")


def meetings(queries: DataFrame, index: DataFrame, books: Codebooks, counts: np.ndarray, first: int, tasks: int) -> tuple[DataFrame, DataFrame]:
    """(visits with their queries, entries), both dealt by (i, chunk, block)."""
    # a number of its own: a scan or AQE would put small vectors into one task, which then does all traversals
    visited = written(visits(queries.repartition(tasks, "query_id"), books, counts, first))
    chunks = -(-counts.sum(axis=1) // CHUNK_ENTRIES)
    blocks = np.zeros(books.k, np.int64)
    for i, n in visited.groupBy("i").count().collect():  # 256 rows at most
        blocks[i] = -(-n // BLOCK_QUERIES)

    def per(numbers):  # of the row's first centroid
        return F.element_at(F.lit(numbers.tolist()), (F.col("i") + 1).cast("int"))

    def each(numbers):  # 0 to the number less one
        return F.explode(F.sequence(F.lit(0).cast("long"), per(numbers) - 1))
    left = (visited.join(queries, "query_id").withColumn("block", F.pmod(F.xxhash64("query_id"), per(blocks))).withColumn("chunk", each(chunks)))
    right = (index.where(per(blocks) > 0).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), per(chunks))).withColumn("block", each(blocks)))
    return left, right


def found(visited: DataFrame, entries: DataFrame, k: int, top: int) -> DataFrame:
    """(query_id, vec_id, score): each chunk's best `top` entries in the visited cells; with a bar all that reach it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return empty
        x, vec, cell = matrix(right["v"]), right["vec_id"].to_numpy(), right["j"].to_numpy()
        q, query, bar = matrix(left["v"]), left["query_id"].to_numpy(), left["bar"].to_numpy()
        mask = np.unpackbits(np.frombuffer(b"".join(left["mask"].to_pylist()), np.uint8).reshape(len(q), -1), axis=1)[:, :k].astype(bool)
        out = []
        for at in range(0, len(q), 256):
            score = q[at:at + 256] @ x.T
            score[~mask[at:at + 256][:, cell] | (query[at:at + 256, None] == vec[None, :])] = -np.inf
            low = bar[at:at + 256].copy()
            if np.isnan(low).any():  # no bar yet: the top-th best score here
                low = np.partition(score, -top, axis=1)[:, -top] if score.shape[1] > top else np.full(len(score), -np.inf)
            r, c = np.nonzero((score >= low[:, None] - 1e-9) & (score > -np.inf))
            exact = np.einsum("ij,ij->i", q[at + r], x[c])
            out.append((query[at + r], vec[c], exact))
        parts = [np.concatenate(p) for p in zip(*out, strict=True)]
        return pa.table({"query_id": parts[0], "vec_id": parts[1], "score": parts[2]})

    keys = ["i", "chunk", "block"]
    return visited.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")


def best(pairs: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(vectors: DataFrame, modulus: int = 20, top: int = 20, first: int = 1000, quantile: float = 0.97) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest `top` rows found for each query.

    Queries: rows whose vec_id is divisible by `modulus`; candidates: all rows
    but those with the query's own id. Rows without id, and vectors that are
    null, empty, zero, of another length than most, or that hold null or
    non-finite components take no part. Of rows that repeat a vec_id, the one
    with the largest vector (compared as arrays) counts. No usable vectors: no rows.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors).groupBy("vec_id").agg(F.max("v").alias("v")))
    books, n = fit(rows, modulus, top, quantile) if not rows.isEmpty() else (None, 0)
    if books is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))

    def assign(batches):
        for batch in batches:
            i, j = books.cells(matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(i), pa.array(j)], names=["vec_id", "v", "i", "j"])

    index = written(map_batches(rows, assign, "vec_id long, v array<double>, i long, j long"))
    counts = np.zeros((books.k, books.k), np.int64)
    for i, j, c in index.groupBy("i", "j").count().collect():  # 256 * 256 rows at most
        counts[i, j] = c
    queries = rows.where(F.col("vec_id") % modulus == 0).select(F.col("vec_id").alias("query_id"), "v", F.lit(None).cast("double").alias("bar"))
    tasks = max(-(-queries.count() // TASK_QUERIES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    start = written(best(found(*meetings(queries, index, books, counts, first, tasks), books.k, top), top))
    bars = start.groupBy("query_id").agg(F.min("score").alias("bar"), F.count(F.lit(1)).alias("n"))
    bars = bars.select("query_id", F.when(F.col("n") >= top, F.col("bar")).otherwise(F.lit(-1e300)).alias("bar"))
    queries = queries.drop("bar").join(bars, "query_id", "left").withColumn("bar", F.coalesce("bar", F.lit(-1e300)))
    more = found(*meetings(written(queries), index, books, counts, first, tasks), books.k, top)
    both = start.drop("rank").union(more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (best(both, top)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
