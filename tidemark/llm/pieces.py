"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text becomes a space and the text; its characters are merged to pieces of the
vocabulary, always the candidate with the best score first (the leftmost of
equal ones). A candidate is two neighbouring symbols; whether it is skipped is
a keyed hash of (seed, text, place in the text, lengths), so every occurrence of
a word draws anew, a skipped candidate stays skipped and every run gives the
same result (equal texts get equal ids). Characters without a piece
become their bytes' pieces, and so does a literal U+2581, which the vocabulary
uses for the space: whatever is skipped, decoding gives the text back.

No piece holds a space after another character or a line feed beside one, so a
text is cut into units there. What does not depend on the draws is remembered:
each unit has a tree of its agenda's states, with two branches for a candidate
that is merged or skipped. All units of a batch walk their trees together, one
candidate a step, and what is not known yet is added. With `variants` a text
draws by one of so many keys and by unit, not by place; without dropout units
are merged once.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import tempfile
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidemark.llm.common import map_batches

SPACE = "▁"
#: Rank of no merge.
NONE = 1 << 32
#: Characters above which a unit is merged by a heap of its own.
LONG_UNIT = 96
#: Characters of texts that are encoded together.
AT_ONCE = 1 << 20
_UNITS = re.compile(r" *[^ \n]+| +|\n")


def model_file(path: str = "/opt/tokenizers/piece_bpe_32k.model") -> bytes:
    """The content of a vocabulary file on the driver."""
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Pieces of a SentencePiece BPE model with byte fallback; `▁` in pieces is taken as a space."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = sp.get_piece_size()
        self.byte = np.full(256, -1, np.int64)
        self.bytes: list[bytes] = []
        self.ids: dict[str, int] = {}
        score = np.full(self.size, -np.inf)
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes.append(b"")
            else:
                text = piece.replace(SPACE, " ")
                self.ids[text] = i
                self.bytes.append(text.encode())
                score[i] = sp.get_score(i)
        if (self.byte < 0).any():
            raise ValueError("the model has no byte fallback: texts could not be decoded")
        if any(" " in p.lstrip(" ") or "\n" in p and p != "\n" for p in self.ids):
            raise ValueError("the model's pieces reach over spaces or lines")
        #: 0 for the piece that is merged first
        self.rank = np.empty(self.size, np.int64)
        self.by_rank = np.argsort(-score, kind="stable")
        self.rank[self.by_rank] = np.arange(self.size)
        self.chars = {p: i for p, i in self.ids.items() if len(p) == 1}
        codes, merged = [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.part(piece[:cut]), self.part(piece[cut:])
                if a is not None and b is not None:
                    codes.append(a << 32 | b)
                    merged.append(i)
        order = np.argsort(codes)
        self.pair = dict(zip(codes, merged, strict=True))
        self.codes, self.merged = np.array(codes, np.int64)[order], np.array(merged, np.int64)[order]

    def part(self, text: str) -> int | None:
        if text in self.ids or len(text) > 1:
            return self.ids.get(text)
        return self.symbol(text)

    def symbol(self, char: str) -> int:
        """Id of a character; one without a piece gets a number above the vocabulary."""
        found = self.chars.get(char)
        return self.size + ord(char) if found is None else found

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece of each pair, -1 where there is none."""
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.merged[at], -1)

    def decode(self, ids) -> bytes:
        """The bytes of a token sequence, without the space that encoding puts in front."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:]


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def merge_units(units: list[str], vocab: Vocabulary, dropout: float, key: int) -> tuple[np.ndarray, np.ndarray]:
    """(token ids of all units one after the other, tokens of each). All units take one step of their agendas at a time."""
    longer = [(n, u) for n, u in enumerate(units) if len(u) > LONG_UNIT]
    units = ["" if len(u) > LONG_UNIT else u for u in units]
    rows = np.flatnonzero([bool(u) for u in units])
    units, total = [u for u in units if u], len(units)
    count = np.array([len(u) for u in units], np.int64)
    points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
    distinct, back = np.unique(points, return_inverse=True)
    symbol = np.array([vocab.symbol(chr(c)) for c in distinct], np.int64)[back]
    start = np.arange(len(points)) - np.repeat(np.cumsum(count) - count, count)
    size = np.ones(len(points), np.int64)
    unit = np.repeat(np.arange(len(units)), count)
    name = np.array([xxhash.xxh3_64_intdigest(u.encode(), key) for u in units], np.uint64) if dropout > 0 else None
    limit = np.uint64(min(1.0, max(0.0, dropout)) * float(1 << 53))

    def candidates(at: np.ndarray) -> np.ndarray:
        """The piece that each symbol makes with the next one; NONE if there is none or it is skipped."""
        piece = vocab.merge_of(symbol[at], symbol[at + 1])
        if dropout > 0:
            what = (start[at] << 24 ^ size[at] << 12 ^ size[at + 1]).astype(np.uint64)
            piece[mixed(name[unit[at]] ^ mixed(what)) >> np.uint64(11) < limit] = -1
        return np.where(piece >= 0, vocab.rank[np.maximum(piece, 0)], NONE)

    inner = np.flatnonzero(unit[1:] == unit[:-1])
    rank = np.full(len(symbol), NONE, np.int64)  # of the merge with the next symbol
    rank[inner] = candidates(inner)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbol):
        n = len(symbol)
        first = np.cumsum(count) - count
        best = np.minimum.reduceat(rank * n + np.arange(n), first)  # smallest rank, then leftmost
        going = best < NONE * n
        best = best[going] % n
        symbol[best] = vocab.by_rank[rank[best]]
        size[best] += size[best + 1]
        left = np.repeat(going, count)
        out = ~left
        if out.any():
            done.append((unit[out], symbol[out]))
        left[best + 1] = False
        at = (np.cumsum(left) - 1)[best]
        unit, start, symbol, size, rank = unit[left], start[left], symbol[left], size[left], rank[left]
        count = count[going] - 1
        rank[at] = NONE
        for changed in (at[at + 1 < len(symbol)], at[at > 0] - 1):
            changed = changed[unit[changed] == unit[changed + 1]]
            rank[changed] = candidates(changed)
    done = [(rows[u], x) for u, x in done]
    for n, u in longer:
        found = np.array(merge_long(u, vocab, dropout, key), np.int64)
        done.append((np.full(len(found), n), found))
    if not done:
        return np.zeros(0, np.int64), np.zeros(total, np.int64)
    unit, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(unit, kind="stable")  # a unit ends at once, its symbols in order
    unit, symbol = unit[order], symbol[order]
    bare = np.flatnonzero(symbol >= vocab.size)  # characters without a piece: their bytes
    if len(bare):
        data = [chr(c).encode() for c in (symbol[bare] - vocab.size).tolist()]
        width = np.ones(len(symbol), np.int64)
        width[bare] = [len(x) for x in data]
        unit, symbol = np.repeat(unit, width), np.repeat(symbol, width)
        symbol[symbol >= vocab.size] = vocab.byte[np.frombuffer(b"".join(data), np.uint8)]
    return symbol, np.bincount(unit, minlength=total)


def merge_long(unit: str, vocab: Vocabulary, dropout: float, key: int) -> list[int]:
    """Symbols of one long unit, by a heap of candidates: n log n steps where `merge_units` takes n of them."""
    mask = (1 << 64) - 1
    name = xxhash.xxh3_64_intdigest(unit.encode(), key)
    limit = int(min(1.0, max(0.0, dropout)) * float(1 << 53))
    symbol = [vocab.symbol(c) for c in unit]
    size = [1] * len(symbol)
    after = [*range(1, len(symbol)), -1]
    before = list(range(-1, len(symbol) - 1))
    agenda: list[tuple[int, int, int, int]] = []

    def stir(x: int) -> int:  # as `mixed`
        x ^= x >> 31
        x = x * 0x9E3779B97F4A7C15 & mask
        x ^= x >> 29
        x = x * 0xBF58476D1CE4E5B9 & mask
        return x ^ x >> 32

    def propose(i: int) -> None:
        j = after[i]
        piece = vocab.pair.get(symbol[i] << 32 | symbol[j]) if j >= 0 else None
        if piece is not None and (not limit or stir(name ^ stir(i << 24 ^ size[i] << 12 ^ size[j])) >> 11 >= limit):
            heapq.heappush(agenda, (int(vocab.rank[piece]), i, size[i], size[j]))

    for i in range(len(symbol)):
        propose(i)
    while agenda:
        rank, i, n, m = heapq.heappop(agenda)
        j = after[i]
        if size[i] != n or j < 0 or size[j] != m:
            continue  # one of the two has been merged since
        symbol[i], size[i], size[j] = int(vocab.by_rank[rank]), n + m, 0
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        propose(i)
        if before[i] >= 0:
            propose(before[i])
    return [s for s, n in zip(symbol, size, strict=True) if n]


class Column:
    """An array that grows."""

    def __init__(self, dtype, width: int = 0):
        self.n, self.data = 0, np.zeros((1024, width) if width else 1024, dtype)

    def add(self, x: np.ndarray) -> None:
        end = self.n + len(x)
        if end > len(self.data):
            more = np.zeros((max(end, len(self.data) * 3 // 2), *self.data.shape[1:]), self.data.dtype)
            more[:self.n] = self.data[:self.n]
            self.data = more
        self.data[self.n:end] = x
        self.n = end


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of the stretches, one after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Agendas:
    """Trees of the states that units pass; a node tests its best candidate and has a child for merged (0) and skipped (1)."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.roots: dict[str, int] = {}
        self.symbol, self.rank, self.size = Column(np.int32), Column(np.int64), Column(np.int16)  # of all states
        self.begin, self.count, self.best, self.what = Column(np.int64), Column(np.int64), Column(np.int64), Column(np.uint64)
        self.child = Column(np.int64, 2)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        piece = self.vocab.merge_of(left.astype(np.int64), right.astype(np.int64))
        return np.where(piece >= 0, self.vocab.rank[np.maximum(piece, 0)], NONE)

    def add(self, symbol: np.ndarray, rank: np.ndarray, size: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Nodes of new states, none of them empty; best is -1 where no candidate is left."""
        n, first = len(symbol), np.cumsum(count) - count
        best = np.minimum.reduceat(rank * n + np.arange(n), first)  # smallest rank, then leftmost
        going = best < NONE * n
        at = np.where(going, best % n, first)
        before = np.cumsum(size, dtype=np.int64) - size
        after = size[np.minimum(at + 1, n - 1)].astype(np.int64)
        what = (before[at] - before[first]) << 24 ^ size[at].astype(np.int64) << 12 ^ after
        nodes = self.begin.n + np.arange(len(count))
        self.begin.add(self.symbol.n + first)
        self.count.add(count)
        self.best.add(np.where(going, at - first, -1))
        self.what.add(mixed(what.astype(np.uint64)))
        self.child.add(np.full((len(count), 2), -1))
        self.symbol.add(symbol)
        self.rank.add(rank)
        self.size.add(size)
        return nodes

    def learn(self, units: list[str]) -> None:
        """Roots of new units."""
        count = np.array([len(u) for u in units], np.int64)
        distinct, back = np.unique(np.frombuffer("".join(units).encode("utf-32-le"), np.uint32), return_inverse=True)
        symbol = np.array([self.vocab.symbol(chr(c)) for c in distinct], np.int32)[back]
        rank = np.full(len(symbol), NONE, np.int64)
        rank[:-1] = self.ranks(symbol[:-1], symbol[1:])
        rank[np.cumsum(count) - 1] = NONE
        self.roots.update(zip(units, self.add(symbol, rank, np.ones(len(symbol), np.int16), count).tolist(), strict=True))

    def grow(self, nodes: np.ndarray, skipped: np.ndarray) -> np.ndarray:
        """The children of nodes that have none on that side."""
        count = self.count.data[nodes]
        at = spread(self.begin.data[nodes], count)
        symbol, rank, size = self.symbol.data[at], self.rank.data[at], self.size.data[at]
        best = np.cumsum(count) - count + self.best.data[nodes]
        merged = best[~skipped]
        symbol[merged] = self.vocab.by_rank[rank[merged]]
        size[merged] += size[merged + 1]
        rank[best] = NONE
        left = np.ones(len(symbol), bool)
        left[merged + 1] = False
        at = (np.cumsum(left) - 1)[merged]
        unit = np.repeat(np.arange(len(nodes)), count)[left]
        symbol, rank, size = symbol[left], rank[left], size[left]
        for changed in (at[at + 1 < len(symbol)], at[at > 0] - 1):
            changed = changed[unit[changed] == unit[changed + 1]]
            rank[changed] = self.ranks(symbol[changed], symbol[changed + 1])
        new = self.add(symbol, rank, size, count - ~skipped)
        self.child.data[nodes, skipped.astype(np.int64)] = new
        return new

    def walk(self, node: np.ndarray, name: np.ndarray, limit: np.uint64) -> np.ndarray:
        """The last node of each occurrence; name: its key."""
        node = node.copy()
        going = np.flatnonzero(self.best.data[node] >= 0)
        while len(going):
            here = node[going]
            skipped = mixed(name[going] ^ self.what.data[here]) >> np.uint64(11) < limit
            there = self.child.data[here, skipped.astype(np.int64)]
            new = np.flatnonzero(there < 0)
            if len(new):
                code, back = np.unique(here[new] * 2 + skipped[new], return_inverse=True)
                there[new] = self.grow(code // 2, code % 2 == 1)[back]
            node[going] = there
            going = going[self.best.data[there] >= 0]
        return node


class Encoder:
    """Encodes texts; keeps the units it has merged, at most about `most` of them, or states of some `most` * 30 symbols."""

    def __init__(self, vocab: Vocabulary, dropout: float = 0.0, seed: int = 0, variants: int = 1, most: int = 300_000):
        self.vocab, self.dropout, self.seed = vocab, dropout, seed
        self.agendas = Agendas(vocab) if dropout > 0 and not variants else None
        self.variants = variants if dropout > 0 and variants else 1
        self.most = most // self.variants
        self.known: list[dict[str, int]] = [{} for _ in range(self.variants)]
        self.flat = [np.zeros(0, np.int64)] * self.variants
        self.count = [np.zeros(0, np.int64)] * self.variants

    def variant(self, text: str) -> int:
        return xxhash.xxh3_64_intdigest(text.encode(), self.seed) % self.variants if self.variants > 1 else 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text; an empty one has none."""
        if self.agendas is not None:
            out, some, size = [], [], 0
            for n, text in enumerate(texts):
                some.append(text)
                size += len(text)
                if size >= AT_ONCE or n == len(texts) - 1:
                    out += self.drawn(some)
                    some, size = [], 0
            return out
        out = [np.zeros(0, np.int64)] * len(texts)
        groups: dict[int, list[int]] = {}
        for n, text in enumerate(texts):
            if text:
                groups.setdefault(self.variant(text), []).append(n)
        for v, members in groups.items():
            if len(self.known[v]) > self.most:
                self.known[v], self.flat[v], self.count[v] = {}, np.zeros(0, np.int64), np.zeros(0, np.int64)
            known = self.known[v]
            before = len(known)
            found = [np.array([known.setdefault(u, len(known)) for u in _UNITS.findall(" " + texts[n])], np.int64) for n in members]
            new = list(islice(known, before, None))
            if new:
                ids, count = merge_units(new, self.vocab, self.dropout, self.seed * 1_000_003 + v)
                self.flat[v], self.count[v] = np.concatenate((self.flat[v], ids)), np.concatenate((self.count[v], count))
            flat, count = self.flat[v], self.count[v]
            starts = np.cumsum(count) - count
            for n, units in zip(members, found, strict=True):
                c = count[units]
                out[n] = flat[np.repeat(starts[units] - (np.cumsum(c) - c), c) + np.arange(c.sum())]
        return out


    def drawn(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text; every occurrence of a unit draws by the text and its place there."""
        if self.agendas.symbol.n > self.most * 30:
            self.agendas = Agendas(self.vocab)
        trees = self.agendas
        found = [_UNITS.findall(" " + t) if t else [] for t in texts]
        count = np.array([len(x) for x in found], np.int64)
        units = list(chain.from_iterable(found))
        if not units:
            return [np.zeros(0, np.int64) for _ in texts]
        text = np.array([xxhash.xxh3_64_intdigest(t.encode(), self.seed) for t in texts], np.uint64)
        name = mixed(np.repeat(text, count) ^ mixed(spread(np.ones(len(texts), np.int64), count).astype(np.uint64)))
        new = [u for u in dict.fromkeys(units) if u not in trees.roots and len(u) <= LONG_UNIT]
        if new:
            trees.learn(new)
        node = np.fromiter((trees.roots.get(u, -1) for u in units), np.int64, len(units))
        short = np.flatnonzero(node >= 0)
        limit = np.uint64(min(1.0, max(0.0, self.dropout)) * float(1 << 53))
        node[short] = trees.walk(node[short], name[short], limit)
        for n in np.flatnonzero(node < 0).tolist():
            x = np.array(merge_long(units[n], self.vocab, self.dropout, int(name[n])), np.int32)
            node[n] = trees.add(x, np.full(len(x), NONE), np.ones(len(x), np.int16), np.array([len(x)]))[0]
        tokens = trees.count.data[node]
        symbol = trees.symbol.data[spread(trees.begin.data[node], tokens)].astype(np.int64)
        owner = np.repeat(np.repeat(np.arange(len(texts)), count), tokens)
        bare = np.flatnonzero(symbol >= self.vocab.size)  # characters without a piece: their bytes
        if len(bare):
            data = [chr(c).encode() for c in (symbol[bare] - self.vocab.size).tolist()]
            width = np.ones(len(symbol), np.int64)
            width[bare] = [len(x) for x in data]
            owner, symbol = np.repeat(owner, width), np.repeat(symbol, width)
            symbol[symbol >= self.vocab.size] = self.vocab.byte[np.frombuffer(b"".join(data), np.uint8)]
        return np.split(symbol, np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1])


_VOCABULARIES: dict[bytes, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    """The vocabulary of a model file's content, kept in a Python worker: executors need no path to the file."""
    key = hashlib.sha256(model).digest()
    if key not in _VOCABULARIES:
        with tempfile.NamedTemporaryFile(suffix=".model") as f:
            f.write(model)
            f.flush()
            _VOCABULARIES[key] = Vocabulary(f.name)
    return _VOCABULARIES[key]


def encoder(model: bytes, dropout: float = 0.0, seed: int = 0, variants: int = 1) -> Encoder:
    """An encoder with nothing remembered; a task has its own."""
    return Encoder(vocabulary(model), dropout, seed, variants)


def encoded(docs: DataFrame, model: bytes, dropout: float = 0.1, seed: int = 42, variants: int = 0, column: str = "ids") -> DataFrame:
    """`docs` with a column of token ids (array<int>): null for a null text, empty for an empty one.

    A column of `docs` with that name is replaced. `model`: the content of the
    vocabulary's file. `variants`: 0, or how many segmentations a word may have.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)  # one model file
    others = [c for c in docs.columns if c != column]

    def run(batches):
        coder = encoder(broadcast.value, dropout, seed, variants)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            ids = coder.encode([t or "" for t in texts])
            lists = pa.array([None if t is None else x.astype(np.int32) for t, x in zip(texts, ids, strict=True)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=[str(i) for i in range(len(others))] + ["ids"])

    fields = [StructField(str(i), docs.schema[c].dataType) for i, c in enumerate(others)]
    rows = docs.select(*(F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(others)), F.col("text").cast("string").alias("ids"))
    out = map_batches(rows, run, StructType([*fields, StructField("ids", ArrayType(IntegerType()))]))
    return out.select(*(F.col(str(i)).alias(c) for i, c in enumerate(others)), F.col("ids").alias(column))


def round_trips(docs: DataFrame, model: bytes, dropout: float = 0.1, seed: int = 42, variants: int = 0) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, ids_sha256, decoded_ok.

    The digest is over the ids as little-endian 32-bit integers; a null text
    counts as an empty one. decoded_ok: decoding the ids gives the text's bytes.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        coder = encoder(broadcast.value, dropout, seed, variants)
        for batch in batches:
            texts, out = batch.column(1).to_pylist(), []
            for text, ids in zip(texts, coder.encode(texts), strict=True):
                data = text.encode()
                out.append((len(data), len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), coder.vocab.decode(ids.tolist()) == data))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in out], t) for i, t in enumerate(kinds))],
                                             names=["doc_id", "n_bytes", "n_tokens", "ids_sha256", "decoded_ok"])

    return map_batches(rows, run, "doc_id long, n_bytes long, n_tokens long, ids_sha256 string, decoded_ok boolean")
