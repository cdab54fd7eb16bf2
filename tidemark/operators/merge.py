"""Incremental sinks (I1-I3, B5) on plain Parquet: merge on read.

Plain Parquet has no MERGE, and Spark will not overwrite a path it is reading.
A target table is a list of parts, oldest first, and a manifest:

    <table>/data/<attempt>/<step>/part-*.parquet   files of one part
    <table>/_manifest/v=<n>/part-*.parquet         live files: part, key range, rows; schemas, watermark,
                                                   counters, and the source batches taken in so far

A merge writes its batch once, ranged by the key, as a newer part, and rewrites
nothing that is there: a row of an older part whose key stands in a newer one is
dropped when the table is read, by an anti-join on the key columns. Files whose
key range meets no newer file's are read without it.

Parts are folded into one by size: when the parts after some part hold more than
a quarter of its rows and meet its key ranges (or there are over `MAX_PARTS`
parts), they become one part with it. So a table has few parts, each row is
rewritten some log(N) times in its life, and reading costs joins with at most a
quarter of the rows.

Every attempt writes to a folder of its own and the manifest is committed last
(a `_SUCCESS` marker), so a crash leaves the previous version readable, what it
left behind is never read, and replaying a batch gives the same table.

A batch has one row per key: with `order` the last one in that order is taken,
without it a repeated key is an error before anything is committed. A column
that the batch adds reads as NULL in older parts, one that it lacks is no longer
read; a changed type becomes the common type (functions/common_type.py), to
which each part is cast when it is read. None of them rewrites a file. Every row
carries the version that brought it, so `changes(v)` are the rows newer than v.
Only the manifest (a row per file) reaches the driver.
"""

from __future__ import annotations

import json
import re
import uuid
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common_type import common_type
from tidemark.session import shuffles_freed

#: Column of the files (reserved): the version that brought the row.
VERSION = "_merged_version"
#: Number of a row among those of its key, while a part is written (reserved).
_NUMBER = "_number_in_key"
#: Columns of the bytes of a key that is a hexadecimal digest, while a part is dealt (reserved).
_DIGEST = "_key_digest_"
#: Parts are folded into an older one when they hold more than one row for so many of its rows.
FOLD = 4
#: More parts are folded by size even if no key range meets another's.
MAX_PARTS = 12
_MANIFEST_SCHEMA = "part int, path string, lo string, hi string, n bigint, since int, new_keys boolean, schema string, watermark string, counters string"
#: In place of a part's number: the row names a source batch.
_LOG = -1


@dataclass(frozen=True)
class Part:
    """Files of one part with their key ranges. since: the schema of the table's history that it was written under.
    new_keys: none of its keys stands in an older part."""
    files: dict
    schema: T.StructType
    rows: int
    since: int = 0
    new_keys: bool = False
    counters: dict | None = None


@dataclass(frozen=True)
class Manifest:
    version: int
    parts: tuple
    history: tuple  # every schema that the table has had; the last one counts
    watermark: str | None
    batches: frozenset = frozenset()

    @property
    def schema(self) -> T.StructType:
        return self.history[-1]


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], watermark_column: str = "_loaded_at",
                 counters: dict[str, Column] | None = None):
        """counters: aggregates that are observed while a part is written (see `counters`)."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.watermark_column = watermark_column
        self.observed = counters or {}
        self._cached = None

    # -- manifest -----------------------------------------------------------
    def _manifest(self) -> Manifest:
        """Newest committed manifest; version 0 without parts if there is none."""
        if self._cached is not None:
            return self._cached
        versions = [v for v in _child_values(self.spark, f"{self.path}/_manifest", "v")
                    if _exists(self.spark, f"{self.path}/_manifest/v={v}/_SUCCESS")]
        if not versions:
            return Manifest(0, (), (), None)
        rows = self.spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{self.path}/_manifest/v={max(versions)}").collect()
        head = next(r for r in rows if r["part"] is None)
        parts = []
        for p in sorted({r["part"] for r in rows if r["part"] is not None and r["part"] != _LOG}):
            own = next(r for r in rows if r["part"] == p and r["path"] is None)
            files = {r["path"]: (r["lo"], r["hi"]) for r in sorted((r for r in rows if r["part"] == p and r["path"]), key=lambda r: r["path"])}
            parts.append(Part(files, T.StructType.fromJson(json.loads(own["schema"])), own["n"], own["since"], own["new_keys"], json.loads(own["counters"])))
        history = tuple(T.StructType.fromJson(x) for x in json.loads(head["schema"]))
        batches = frozenset(r["path"] for r in rows if r["part"] == _LOG)
        self._cached = Manifest(max(versions), tuple(parts), history, head["watermark"], batches)
        return self._cached

    def exists(self) -> bool:
        return self.version() > 0

    def version(self) -> int:
        return self._manifest().version

    def files(self) -> list[str]:
        """Paths of the live files, relative to the table."""
        return [f for p in self._manifest().parts for f in p.files]

    def watermark(self, column: str | None = None):
        """max(watermark column) of the target, or None when it is missing or
        empty (V14). Recorded in the manifest at commit, so reading it costs
        no scan of the table."""
        if column not in (None, self.watermark_column):
            return self.read().agg(F.max(column)).first()[0] if self.exists() else None
        return self._manifest().watermark

    def counters(self) -> dict | None:
        """What was observed while the table was written, if that describes the live rows: it is one part. None otherwise."""
        man = self._manifest()
        return man.parts[0].counters if len(man.parts) == 1 else None

    def processed(self) -> frozenset[str]:
        """The source batches that the committed versions took in (an id per load)."""
        return self._manifest().batches

    # -- read ---------------------------------------------------------------
    def read(self) -> DataFrame:
        """The newest row of each key."""
        return self._live(self._known().parts, self._known().history).drop(VERSION)

    def changes(self, since: int) -> DataFrame:
        """The live rows that a version after `since` brought (parts without one are not read)."""
        return self._live(self._known().parts, self._known().history, F.col(VERSION) > since).drop(VERSION)

    def _known(self) -> Manifest:
        man = self._manifest()
        if not man.version:
            raise FileNotFoundError(f"no committed version under {self.path}")
        return man

    def _live(self, parts: Sequence[Part], history: Sequence[T.StructType], condition: Column | None = None) -> DataFrame:
        """Rows of the parts (with the version) that no newer part replaces; `condition` goes to the scans."""
        out, key_type = [], history[-1][self.keys[0]].dataType
        for i, part in enumerate(parts):
            newer = [p for p in parts[i + 1:] if not p.new_keys]
            spans = self._spans([r for p in newer for r in self._ranges(p, key_type).values()])
            ranges = self._ranges(part, key_type)
            met = [f for f, r in ranges.items() if self._meets(r, spans)]
            alone = sorted(set(part.files) - set(met))
            if alone:
                out.append(self._scan(part, history, alone, condition))
            if met:
                taken = self._keys_near(newer, [ranges[f] for f in met], history)
                out.append(self._scan(part, history, met, condition).join(taken, self.keys, "left_anti"))
        return self._union(out, T.StructType([*history[-1].fields, T.StructField(VERSION, T.LongType())]))

    def _keys_near(self, parts: Sequence[Part], ranges: list, history: Sequence[T.StructType]) -> DataFrame:
        """Keys of the files of the parts whose key range meets one of `ranges`."""
        spans, out = self._spans(ranges), []
        for p in parts:
            own = [f for f, r in self._ranges(p, history[-1][self.keys[0]].dataType).items() if self._meets(r, spans)]
            if own:
                out.append(self._scan(p, history, own).select(*self.keys))
        return self._union(out, T.StructType([history[-1][k] for k in self.keys]))

    def _union(self, parts: list[DataFrame], schema: T.StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        full = parts[0]
        for df in parts[1:]:
            full = full.unionByName(df)
        return full

    def _ranges(self, part: Part, key_type: T.DataType) -> dict:
        """Key range by file, as text; a key that was stored as another type may stand anywhere."""
        if part.schema[self.keys[0]].dataType == key_type:
            return part.files
        return {f: ("", chr(0x10FFFF)) for f in part.files}

    @staticmethod
    def _spans(ranges) -> list[tuple[str, str]]:
        """The ranges in order, those that overlap as one."""
        out: list[tuple[str, str]] = []
        for lo, hi in sorted(ranges):
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], max(hi, out[-1][1]))
            else:
                out.append((lo, hi))
        return out

    @staticmethod
    def _meets(r: tuple[str, str], spans: list[tuple[str, str]]) -> bool:
        at = bisect_right(spans, r[1], key=lambda s: s[0]) - 1
        return at >= 0 and spans[at][1] >= r[0]

    def _scan(self, part: Part, history: Sequence[T.StructType], files=None, condition: Column | None = None) -> DataFrame:
        """Files of one part (all if not told) with the columns of the newest schema.

        The values pass through every schema that the table has had since the
        part was written, as if each change had rewritten it: cast to the
        types, NULL where a column is new. So folding changes no value.
        """
        df = (self.spark.read.schema(T.StructType([*part.schema.fields, T.StructField(VERSION, T.LongType())]))
              .parquet(*[f"{self.path}/{f}" for f in files or part.files]))
        if condition is not None:
            df = df.where(condition)
        values = {f.name: (F.col(f.name), f.dataType) for f in part.schema.fields}
        for schema in history[part.since:]:
            values = {f.name: values[f.name] if f.name in values and values[f.name][1] == f.dataType
                      else (values.get(f.name, (F.lit(None), None))[0].cast(f.dataType), f.dataType) for f in schema.fields}
        return df.select(*[c.alias(name) for name, (c, _) in values.items()], VERSION)

    # -- merge --------------------------------------------------------------
    def merge(self, batch: DataFrame, keep_existing: bool = False, order: Sequence[str] | None = None,
              processed: Sequence[str] = ()) -> int:
        """Upsert `batch` on the key: matched rows replaced, new rows inserted.

        keep_existing=True keeps the target's row for keys it already has
        (earliest load wins) and inserts only new keys. `processed` names the
        source batches that this one takes in. Returns the committed version.
        """
        man = self._manifest()
        version = man.version + 1
        history = self._synced(man.history, batch.schema)
        since = len(history) - 1
        attempt = f"data/{version}-{uuid.uuid4().hex}"
        part, mark, repeats = self._write(batch.withColumn(VERSION, F.lit(version).cast("bigint")), f"{attempt}/new", since)
        if repeats:
            if not order:
                raise ValueError(f"the batch repeats keys of {self.path}; give the order that picks one row")
            part, mark, _ = self._write(self._last_rows(self._scan(part, history), order), f"{attempt}/last", since)
        if keep_existing and man.parts and part.files:
            live = self._keys_near(man.parts, list(self._ranges(part, history[-1][self.keys[0]].dataType).values()), history)
            part, mark, _ = self._write(self._scan(part, history).join(live, self.keys, "left_anti"), f"{attempt}/added", since)
            part = replace(part, new_keys=True)
        parts = [*man.parts, *([part] if part.rows else [])]
        first = self._foldable(parts, history)
        if first is not None:
            folded, _, _ = self._write(self._live(parts[first:], history), f"{attempt}/folded", since)
            parts = [*parts[:first], replace(folded, new_keys=all(p.new_keys for p in parts[first:]))]
        marks = [w for w in (man.watermark, mark) if w is not None]
        self._commit(Manifest(version, tuple(parts), history, max(marks) if marks else None, man.batches | set(processed)))
        return version

    def _foldable(self, parts: Sequence[Part], history: Sequence[T.StructType]) -> int | None:
        """The first part that the ones after it have outgrown and must be joined with, or that makes too many parts."""
        key_type = history[-1][self.keys[0]].dataType
        for i, part in enumerate(parts[:-1]):
            newer = parts[i + 1:]
            if FOLD * sum(p.rows for p in newer) > part.rows:
                spans = self._spans([r for p in newer if not p.new_keys for r in self._ranges(p, key_type).values()])
                if len(parts) > MAX_PARTS or any(self._meets(r, spans) for r in self._ranges(part, key_type).values()):
                    return i
        return None

    def _commit(self, man: Manifest) -> None:
        rows = [(None, None, None, None, None, None, None, json.dumps([x.jsonValue() for x in man.history]), man.watermark, None)]
        for i, p in enumerate(man.parts):
            rows.append((i, None, None, None, p.rows, p.since, p.new_keys, p.schema.json(), None, json.dumps(p.counters)))
            rows += [(i, f, lo, hi, None, None, None, None, None, None) for f, (lo, hi) in p.files.items()]
        rows += [(_LOG, b, None, None, None, None, None, None, None, None) for b in sorted(man.batches)]
        (self.spark.createDataFrame(rows, _MANIFEST_SCHEMA).coalesce(1).write.option("partitionOverwriteMode", "static")
         .mode("overwrite").parquet(f"{self.path}/_manifest/v={man.version}"))
        self._cached = man

    def _synced(self, history: tuple, new: T.StructType) -> tuple:
        """The history with the columns of the batch, if they differ; a column whose type changed gets the common type."""
        old = history[-1] if history else T.StructType()
        fields = []
        for f in new.fields:
            kind = common_type(old[f.name].dataType, f.dataType) if f.name in old.names else f.dataType
            if kind is None:
                raise ValueError(f"{self.path}: {f.name} changed from {old[f.name].dataType.simpleString()} to {f.dataType.simpleString()}, "
                                 "which have no common type")
            fields.append(T.StructField(f.name, kind, True, f.metadata))
        schema = T.StructType(fields)
        return history if history and schema == old else (*history, schema)

    def _last_rows(self, batch: DataFrame, order: Sequence[str]) -> DataFrame:
        """One row per key: the last by `order`, then by all columns; a partial aggregate, so a repeated key gathers nowhere."""
        rest = [c for c in batch.columns if c not in self.keys]
        plain = [c for c in rest if not isinstance(batch.schema[c].dataType, T.MapType)]
        rank = F.struct(*order, *[c for c in plain if c not in order])
        last = batch.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
        return last.select(*[F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in batch.columns])

    def _relative(self, file: str) -> str:
        return file[file.rindex("/data/") + 1:]

    def _write(self, df: DataFrame, path: str, since: int) -> tuple[Part, str | None, bool]:
        """Writes `df` ranged and sorted by the key. Returns the part, the highest watermark as text, and whether a key repeats.

        Repeats and counters are observed by the write itself: equal keys lie in
        one partition, so their rows are numbered where they are. Reading the
        files back gives a row per file, no key is shuffled again.
        """
        stored = T.StructType([f for f in df.schema.fields if f.name != VERSION])
        seen = Observation()
        ranged = _ranged(df, self.keys).withColumn(_NUMBER, F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self.keys)))
        repeats = F.sum(F.when(F.col(_NUMBER) > 1, 1).otherwise(0))
        ranged = ranged.observe(seen, repeats.alias(_NUMBER), *[c.alias(name) for name, c in self.observed.items()])
        key = F.col(self.keys[0]).cast("string")
        mark = F.max(self.watermark_column).cast("string") if self.watermark_column in df.columns else F.lit(None).cast("string")
        with shuffles_freed(df.sparkSession):
            ranged.drop(_NUMBER).write.mode("error").option("compression", "zstd").parquet(f"{self.path}/{path}")
            rows = (df.sparkSession.read.schema(df.schema).parquet(f"{self.path}/{path}").groupBy(F.col("_metadata.file_path").alias("f"))
                    .agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"), mark.alias("wm")).collect())
        marks = [r["wm"] for r in rows if r["wm"] is not None]
        files = {self._relative(r["f"]): (r["lo"] or "", r["hi"] or "") for r in rows}
        found = {name: int(n or 0) for name, n in seen.get.items()}
        repeated = found.pop(_NUMBER, 0) > 0
        return (Part(files, stored, sum(r["n"] for r in rows), since, counters=found if self.observed else None), max(marks) if marks else None, repeated)


def _ranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` dealt by ranges of the keys. Hexadecimal digests among them cross the shuffle as bytes, which are half as long and do not compress."""
    texts = [k for k in keys if isinstance(df.schema[k].dataType, T.StringType)]
    at = {k: f"{_DIGEST}{i}" for i, k in enumerate(texts)}
    found = {k: F.when(F.lower(F.hex(F.unhex(k))) == F.col(k), F.unhex(k)) for k in texts}
    back = {k: F.coalesce(F.col(k), F.lower(F.hex(F.col(at[k])))) for k in texts}
    packed = df.select(*[F.when(found[c].isNull(), F.col(c)).alias(c) if c in at else F.col(c) for c in df.columns],
                       *[found[k].alias(at[k]) for k in texts])
    dealt = packed.repartitionByRange(*[back.get(k, F.col(k)) for k in keys])
    return dealt.select(*[back[c].alias(c, metadata=df.schema[c].metadata) if c in at else F.col(c) for c in df.columns])


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem of `path` (works for any cluster file system)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _child_values(spark: SparkSession, path: str, name: str) -> list[int]:
    """Integer values of `<path>/<name>=<n>` sub-folders (metadata listing only)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    pat = re.compile(rf"^{re.escape(name)}=(\d+)$")
    out = []
    for st in fs.listStatus(p):
        m = pat.match(st.getPath().getName())
        if st.isDirectory() and m:
            out.append(int(m.group(1)))
    return out
