"""Tables that change in whole steps, which any session can follow.

A version is a list of data files. A change writes new files and a new list, and then the
next commit, whose name no other writer can take. Readers go by the newest complete commit:
they see the table before a change or after it. Files never change once written, so that
readers of older versions are not disturbed until :meth:`StoredTable.vacuum` takes them away.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retinue.operators.keyed import first_per_key
from retinue.operators.staging import settle

FILE_LIST = "file string, shard int, rows bigint, keys string, words bigint"
_SHARD = "_shard"


class Conflict(RuntimeError):
    """Another writer took the next version; read it and start again."""


@dataclass(frozen=True)
class Version:
    """One state of a table. ``files`` names the list of its files."""

    number: int
    schema: T.StructType
    files: str
    written: datetime
    key: tuple[str, ...]
    shards: int


@dataclass(frozen=True)
class Change:
    """What a change did: the version it left, rows written, and the files it had to read or replace."""

    version: int
    rows: int
    files: tuple[str, ...]


class _Folder:
    """The few file operations that Spark has no words for, on whatever system holds the folder."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        return sorted(n for n, _ in self.listed(name))

    def listed(self, name: str) -> list[tuple[str, datetime]]:
        """Names in a folder with the time each was last written; none if there is no such folder."""
        if not self._fs.exists(self._at(name)):
            return []
        found = [(s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(self._at(name))]
        return [(n, datetime.fromtimestamp(at / 1000, timezone.utc)) for n, at in found if not n.startswith((".", "_"))]

    def create(self, name: str, text: str) -> bool:
        """Write a small file, unless there is one of that name."""
        try:
            out = self._fs.create(self._at(name), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception) or self._fs.exists(self._at(name)):
                return False
            raise
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        return True

    def text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def _open(kind: T.DataType) -> T.DataType:
    """The same type with nulls allowed everywhere, as files are read."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _open(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_open(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_open(kind.keyType), _open(kind.valueType))
    return kind


def shard_of(key: Sequence[str], shards: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int")


def _dealt(df: DataFrame, key: Sequence[str], shards: int) -> DataFrame:
    """Rows in a task per shard."""
    return df.withColumn(_SHARD, shard_of(key, shards)).repartitionById(shards, F.col(_SHARD))


def _word_of(key: Sequence[str], words: Column) -> Column:
    """Which 64-bit word of a filter of ``words`` (a power of two) a key sets bits in."""
    return F.xxhash64(F.lit(1), *key).bitwiseAND(words - 1)


def _bits_of(key: Sequence[str]) -> Column:
    """Four of 64 bits."""
    h = F.xxhash64(F.lit(2), *key)
    bits = []
    for place in range(4):
        low = F.shiftrightunsigned(h, 6 * place).bitwiseAND(63).cast("int")
        bits.append(F.call_function("shiftleft", F.lit(1).cast("bigint"), low))
    return reduce(Column.bitwiseOR, bits)


class StoredTable:
    """A table in ``folder``, with or without a key.

    Rows of a table with a key are dealt to ``shards`` by a hash of it, one file a shard and
    change, and each file has a Bloom filter of its keys beside it: a 64-bit word for every
    four keys at most, of which a key sets four bits. So a new key is compared with the
    filters of one shard, and files are only read where a filter lets a key through.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._disk = _Folder(spark, folder)

    # --- versions ------------------------------------------------------------------------

    def versions(self) -> list[Version]:
        """All complete commits, oldest first. One that is being written does not count yet."""
        found = (self._parsed(name) for name in self._disk.names("commits"))
        return [v for v in found if v is not None]

    def _parsed(self, name: str) -> Version | None:
        try:
            body = json.loads(self._disk.text(f"commits/{name}"))
        except (json.JSONDecodeError, Py4JJavaError):
            return None
        return Version(
            int(name.removesuffix(".json")),
            T.StructType.fromJson(body["schema"]),
            body["files"],
            datetime.fromisoformat(body["written"]),
            tuple(body["key"]),
            body["shards"],
        )

    def version(self, number: int | None = None) -> Version:
        """The newest version, or one by its number."""
        names = self._disk.names("commits")
        wanted = reversed(names) if number is None else [n for n in names if int(n.removesuffix(".json")) == number]
        for name in wanted:
            found = self._parsed(name)
            if found is not None:
                return found
        raise LookupError(f"no such version in {self.folder}")

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, number: int | None = None) -> DataFrame:
        v = self.version(number)
        return self._frame(v, self.files(v.number))

    def files(self, number: int | None = None) -> list[str]:
        """Data files of a version, below ``folder``."""
        return sorted(r.file for r in self._list(self.version(number)).select("file").collect())

    def _list(self, v: Version) -> DataFrame:
        return self.spark.read.schema(FILE_LIST).parquet(f"{self.folder}/{v.files}")

    def _frame(self, v: Version, files: Sequence[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], v.schema)
        return self.spark.read.schema(v.schema).parquet(*[f"{self.folder}/{f}" for f in files])

    def _next(self) -> int:
        # An unfinished commit keeps its number.
        names = self._disk.names("commits")
        return int(names[-1].removesuffix(".json")) + 1 if names else 0

    def _commit(self, number: int, schema: T.StructType, key: Sequence[str], shards: int, files: list[tuple]) -> int:
        place = f"lists/{uuid.uuid4().hex}"
        self.spark.createDataFrame(files, FILE_LIST).coalesce(1).write.parquet(f"{self.folder}/{place}")
        body = {
            "schema": _open(schema).jsonValue(),
            "files": place,
            "written": datetime.now(timezone.utc).isoformat(),
            "key": list(key),
            "shards": shards,
        }
        if not self._disk.create(f"commits/{number:020d}.json", json.dumps(body)):
            raise Conflict(f"version {number} of {self.folder} was taken")
        return number

    # --- writing files -------------------------------------------------------------------

    def _write(self, df: DataFrame, key: Sequence[str], shards: int, dealt: bool = False) -> list[tuple]:
        """Write rows, and the filters of their keys. Returns the lines of the file list.

        Rows that are ``dealt`` to their shards already are not shuffled again.
        """
        run = uuid.uuid4().hex
        place = f"{self.folder}/files/{run}"
        schema = df.schema
        if key and not dealt:
            df = _dealt(df, key, shards).drop(_SHARD)
        df.write.parquet(place)
        written = self.spark.read.schema(schema).parquet(place)
        file = F.concat(F.lit(f"files/{run}/"), F.col("_metadata.file_name")).alias("file")
        shard = shard_of(key, shards) if key else F.lit(None).cast("int")
        counted = written.groupBy(file).agg(F.max(shard).alias("shard"), F.count("*").alias("rows")).collect()
        if not key or not counted:
            return [(r.file, r.shard, r.rows, None, None) for r in counted]
        words = 1 << max(0, (max(r.rows for r in counted) // 4)).bit_length()
        bits = written.select(
            file, shard.alias("shard"), _word_of(key, F.lit(words)).alias("word"), _bits_of(key).alias("bits")
        )
        filters = bits.groupBy("file", "shard", "word").agg(F.bit_or("bits").alias("bits"))
        filters.withColumn("words", F.lit(words).cast("bigint")).write.parquet(f"{self.folder}/keys/{run}")
        return [(r.file, r.shard, r.rows, f"keys/{run}", words) for r in counted]

    def _may_hold(self, v: Version, rows: DataFrame) -> DataFrame:
        """Keys of ``rows``, each with the files whose filters let it through."""
        listed = self._list(v)
        runs = listed.select("keys", "words").distinct().collect()
        if not runs:
            return rows.select(*v.key, F.lit("").alias("file")).limit(0)
        filters = self.spark.read.parquet(*[f"{self.folder}/{r['keys']}" for r in runs])
        filters = filters.join(listed.select("file"), "file", "left_semi")
        sizes = F.array(*[F.lit(w).cast("bigint") for w in sorted({r["words"] for r in runs})])
        asked = (
            rows.select(*v.key, shard_of(v.key, v.shards).alias("shard"), F.explode(sizes).alias("words"))
            .withColumn("word", _word_of(v.key, F.col("words")))
            .withColumn("_bits", _bits_of(v.key))
        )
        met = asked.join(filters, ["shard", "words", "word"])
        return met.where(F.col("bits").bitwiseAND(F.col("_bits")) == F.col("_bits")).select(*v.key, "file")

    def _known(self, v: Version, rows: DataFrame) -> tuple[DataFrame, list[str]]:
        """Keys of ``rows`` that are stored, and the files that hold them; only files with a hit are read."""
        hits = settle(self._may_hold(v, rows))
        files = sorted(r.file for r in hits.select("file").distinct().collect())
        name = F.concat_ws("/", F.lit("files"), F.element_at(F.split("_metadata.file_path", "/"), -2), "_metadata.file_name")
        stored = self._frame(v, files)
        if files:
            stored = stored.select(*v.key, name.alias("file"))
        else:
            stored = stored.select(*v.key, F.lit("").alias("file"))
        return settle(stored.join(hits.select(*v.key).distinct(), list(v.key), "left_semi")), files

    # --- changes -------------------------------------------------------------------------

    def replace(
        self, df: DataFrame, *, key: Sequence[str] = (), shards: int = 16, sort_by: str | None = None
    ) -> Change:
        """A new version with exactly the rows of ``df``, which may read a former one.

        ``sort_by`` orders rows inside files, so that filters on the column skip parts of them.
        """
        number = self._next()
        if sort_by:
            df = df.sortWithinPartitions(sort_by)
        files = self._write(df, key, shards)
        return Change(self._commit(number, df.schema, key, shards, files), sum(f[2] for f in files), ())

    def insert_ignore(self, rows: DataFrame, position: str) -> Change:
        """Add rows whose key is not stored yet, of several with one key the first by ``position``.

        Rows without a key stay out. Most new keys pass the filters and cost no reading; the
        others are compared with the files that may hold them. Without a new row there is no
        new version.
        """
        v = self.version()
        number = self._next()
        complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in v.key])
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in v.schema.fields]
        new = settle(first_per_key(rows.where(complete), list(v.key), position).select(*columns))
        known, files = self._known(v, new)
        fresh = new.join(known.select(*v.key), list(v.key), "left_anti") if files else new
        added = self._write(fresh.select(*v.schema.names), v.key, v.shards)
        if not added:
            return Change(v.number, 0, tuple(files))
        kept = [tuple(r) for r in self._list(v).collect()]
        return Change(self._commit(number, v.schema, v.key, v.shards, kept + added), sum(f[2] for f in added), tuple(files))

    def update(self, condition: Column, **values: Column) -> Change:
        """Set columns where ``condition`` holds. Files without such a row stay as they are."""
        v = self.version()
        number = self._next()
        if set(values) & set(v.key):
            raise ValueError("a key cannot be updated")
        live = self.files(v.number)
        if not live:
            return Change(v.number, 0, ())
        paths = self._frame(v, live).where(condition).select(F.col("_metadata.file_path").alias("path")).distinct()
        touched = sorted("/".join(["files", *r.path.split("/")[-2:]]) for r in paths.collect())
        if not touched:
            return Change(v.number, 0, ())
        changed = self._frame(v, touched).select(
            *[
                F.when(condition, values[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
                if f.name in values
                else F.col(f.name)
                for f in v.schema.fields
            ]
        )
        return self._rewritten(v, number, changed, touched)

    def merge(self, rows: DataFrame, merged: dict[str, Callable[[Column, Column], Column]]) -> Change:
        """Bring ``rows`` (one per key) together with the stored rows of the same keys.

        ``merged`` gives a column from its stored and its new value, of which one is null
        where the other side lacks the key. Only files that hold such keys are replaced.
        """
        v = self.version()
        number = self._next()
        rows = settle(rows.select(*v.schema.names))
        known, _ = self._known(v, rows)
        touched = sorted(r.file for r in known.select("file").distinct().collect())
        others = [c for c in v.schema.names if c not in v.key]
        whole = F.struct(*others)
        none = F.lit(None).cast(T.StructType([v.schema[c] for c in others]))
        old = self._frame(v, touched).select(*v.key, whole.alias("_old"), none.alias("_new"))
        both = old.unionByName(rows.select(*v.key, none.alias("_old"), whole.alias("_new")))
        # A row that lacks a part of its key meets no other.
        apart = reduce(Column.__or__, [F.col(c).isNull() for c in v.key])
        both = both.withColumn("_alone", F.when(apart, F.monotonically_increasing_id()))
        # One shuffle deals both sides to the shards that are written.
        met = _dealt(both, v.key, v.shards).groupBy(_SHARD, *v.key, "_alone")
        changed = met.agg(*[F.first(side, ignorenulls=True).alias(side) for side in ("_old", "_new")]).select(
            *v.key,
            *[
                F.when(F.col("_new").isNull(), F.col("_old")[c])
                .otherwise(merged[c](F.col("_old")[c], F.col("_new")[c]))
                .cast(v.schema[c].dataType)
                .alias(c)
                for c in others
            ],
        )
        return self._rewritten(v, number, changed.select(*v.schema.names), touched, dealt=True)

    def _rewritten(
        self, v: Version, number: int, rows: DataFrame, replaced: list[str], dealt: bool = False
    ) -> Change:
        written = self._write(rows, v.key, v.shards, dealt)
        kept = [tuple(r) for r in self._list(v).collect() if r.file not in set(replaced)]
        done = self._commit(number, v.schema, v.key, v.shards, kept + written)
        return Change(done, sum(f[2] for f in written), tuple(replaced))

    # --- clearing ------------------------------------------------------------------------

    def vacuum(self, keep: timedelta) -> int:
        """Delete versions that were followed by another one before ``keep`` ago, and what only they need.

        Files of changes that never were committed go once they are that old. Returns the
        number of versions deleted; the newest always stays.
        """
        limit = datetime.now(timezone.utc) - keep
        versions = self.versions()
        gone = [v for v, after in zip(versions, versions[1:]) if after.written <= limit]
        for v in gone:
            self._disk.delete(f"commits/{v.number:020d}.json")
        left = [v for v in versions if v not in gone]
        listed = [r for v in left for r in self._list(v).select("file", "keys").distinct().collect()]
        used = {r.file for r in listed} | {r["keys"] for r in listed if r["keys"]} | {v.files for v in left}
        for name, at in self._disk.listed("files"):
            own = [f"files/{name}/{file}" for file in self._disk.names(f"files/{name}")]
            if not used.intersection(own):
                if at <= limit:
                    self._disk.delete(f"files/{name}")
                continue
            for file in own:
                if file not in used:
                    self._disk.delete(file)
        for folder in ("keys", "lists"):
            for name, at in self._disk.listed(folder):
                if f"{folder}/{name}" not in used and at <= limit:
                    self._disk.delete(f"{folder}/{name}")
        return len(gone)
