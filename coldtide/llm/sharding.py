"""Size-tiered sharding with versioned manifests (DataFrame functions only).

Arrivals are appended as small immutable Parquet shards. Compaction sorts the
live shards into tiers by size, each ``fanout`` times the one below, and merges
every tier that holds at least ``fanout`` shards into files of about the target
size. The merge has no shuffle: Spark's own packing of small files into scan
partitions of the target size decides which shards meet in one task, and each
task writes one file. Shards of at least half the target size are final.

A manifest names all live shards of one version. It is written aside and
renamed to its number without overwriting, so a version has one author and is
complete once it is visible. An append that loses the race is repeated on the
new version; a compaction commits only if all shards it replaces are still
live. Files that no manifest names, as a lost driver leaves them, are never
read; ``vacuum`` deletes retired shards at once, and unnamed files when they are
old enough that no append can still be about to name them. An append makes sure
that its files are there when it names them.

Columns that an arrival adds are added to the store, null in earlier rows; one
that lacks columns has nulls there; one with another type for a column is
rejected before it is written.

Defined cases: an empty arrival commits a version without a new shard, and an
empty store reads as an empty table; nulls, repeated rows, long texts and extra
columns pass through unchanged; shards of equal size are merged in the order of
their paths.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldtide.session import scratch_path


@dataclass(frozen=True)
class Shard:
    path: str
    size: int
    generation: int


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: str | None
    shards: tuple[Shard, ...]
    #: Paths of shards that were replaced since the last vacuum.
    retired: tuple[str, ...] = ()


class Conflict(Exception):
    """Another writer committed the version first."""


def merged_schema(held: str | None, new: T.StructType) -> str:
    """The store's schema with the columns of an arrival; ValueError if one has
    another type there."""
    fields = T.StructType.fromJson(json.loads(held)).fields if held else []
    known = {f.name.lower(): f for f in fields}
    for f in new.fields:
        if (old := known.get(f.name.lower())) is None:
            fields.append(T.StructField(f.name, f.dataType, True))
        elif old.dataType != f.dataType:
            raise ValueError(f"column {f.name} is {old.dataType.simpleString()} in the store and {f.dataType.simpleString()} in the arrival")
    return T.StructType(fields).json()


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fanout: int = 4):
        self.spark, self.root, self.target, self.fanout = spark, root.rstrip("/"), target_bytes, fanout
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)
        self._fs.mkdirs(self._path("/manifests"))

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.root + below)

    def _files(self, folder: str, before_ms: float = math.inf) -> list[tuple[str, int]]:
        """Parquet files below a folder, changed before a time, with their
        sizes, by path."""
        found, top = [], self._jvm.org.apache.hadoop.fs.Path(folder)
        if not self._fs.exists(top):
            return []
        walk = self._fs.listFiles(top, True)
        while walk.hasNext():
            status = walk.next()
            if status.getPath().getName().endswith(".parquet") and status.getModificationTime() <= before_ms:
                found.append((status.getPath().toString(), status.getLen()))
        return sorted(found)

    def manifest(self, version: int | None = None) -> Manifest:
        """A version, the latest by default; version 0 is the empty store."""
        if version is None:
            version = max((int(s.getPath().getName()) for s in self._fs.listStatus(self._path("/manifests")) if s.getPath().getName().isdigit()), default=0)
        if version == 0:
            return Manifest(0, None, ())
        stream = self._fs.open(self._path(f"/manifests/{version:012d}"))
        try:
            told = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Manifest(told["version"], told["schema"], tuple(Shard(**x) for x in told["shards"]), tuple(told["retired"]))

    def _commit(self, new: Manifest) -> Manifest:
        """Make a version visible at once, or raise Conflict."""
        aside = self._path(f"/manifests/.{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        stream.write(bytearray(json.dumps(asdict(new)), "utf-8"))
        stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self._conf)
        how = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.valueOf("NONE")
        try:
            files.rename(aside, self._path(f"/manifests/{new.version:012d}"), how)
        except Exception as lost:
            self._fs.delete(aside, False)
            if "FileAlreadyExists" in str(lost):
                raise Conflict(str(new.version)) from lost
            raise
        return new

    def _publish(self, shards: list[Shard], schema: T.StructType) -> Manifest:
        while True:
            now = self.manifest()
            if gone := [s.path for s in shards if not self._fs.exists(self._jvm.org.apache.hadoop.fs.Path(s.path))]:
                raise FileNotFoundError(f"files of an arrival are gone before it was published: {gone[:3]}")
            try:
                return self._commit(Manifest(now.version + 1, merged_schema(now.schema, schema), now.shards + tuple(shards), now.retired))
            except Conflict:
                continue

    def append(self, df: DataFrame) -> Manifest:
        """One arrival: its partitions become shards of generation 0."""
        merged_schema(self.manifest().schema, df.schema)
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(folder)
        return self._publish([Shard(p, n, 0) for p, n in self._files(folder)], df.schema)

    def append_many(self, df: DataFrame, arrival: F.Column | str) -> list[Manifest]:
        """One arrival per value of ``arrival``, written in one pass and
        committed as one version each."""
        merged_schema(self.manifest().schema, df.schema)
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        df.withColumn("coldtide_arrival", arrival).write.option("compression", "zstd").partitionBy("coldtide_arrival").parquet(folder)
        groups: dict[str, list[Shard]] = {}
        for path, size in self._files(folder):
            groups.setdefault(path.rsplit("/", 2)[1], []).append(Shard(path, size, 0))
        return [self._publish(groups[k], df.schema) for k in sorted(groups)] or [self._publish([], df.schema)]

    def tier(self, size: int) -> int:
        """0 for final shards, else how many fanouts below the target."""
        return 0 if 2 * size >= self.target else 1 + int(math.log(self.target / max(size, 1)) / math.log(self.fanout))

    def compact(self) -> Manifest:
        """Merge full tiers, smallest first, until none is left to merge."""
        while True:
            now = self.manifest()
            tiers: dict[int, list[Shard]] = {}
            for shard in now.shards:
                tiers.setdefault(self.tier(shard.size), []).append(shard)
            ready = [t for t, held in tiers.items() if t and len(held) >= self.fanout]
            if not ready:
                return now
            run = sorted(tiers[max(ready)], key=lambda s: s.path)
            merged = self._merge(run, now)
            if len(merged) >= len(run):
                return self._replace(run, merged)
            self._replace(run, merged)

    def _merge(self, run: list[Shard], now: Manifest) -> list[Shard]:
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        session = self.spark.newSession()
        for key, value in (("maxPartitionBytes", self.target), ("openCostInBytes", 0), ("minPartitionNum", 1)):
            session.conf.set(f"spark.sql.files.{key}", str(value))
        schema = T.StructType.fromJson(json.loads(now.schema))
        session.read.schema(schema).parquet(*[s.path for s in run]).write.option("compression", "zstd").parquet(folder)
        return [Shard(p, n, 1 + max(s.generation for s in run)) for p, n in self._files(folder)]

    def _replace(self, old: list[Shard], new: list[Shard], deleted: set[str] = frozenset()) -> Manifest:
        gone = {s.path for s in old}
        while True:
            now = self.manifest()
            if not gone <= {s.path for s in now.shards}:
                return now
            try:
                return self._commit(Manifest(now.version + 1, now.schema, tuple(s for s in now.shards if s.path not in gone) + tuple(new), tuple(p for p in now.retired if p not in deleted) + tuple(sorted(gone))))
            except Conflict:
                continue

    def vacuum(self, grace_s: float = 86_400) -> int:
        """Delete retired shards, and files older than ``grace_s`` that no
        manifest names; no append may take longer than that."""
        now = self.manifest()
        live, retired = {s.path for s in now.shards}, set(now.retired)
        if retired:
            # Readers of the version see first that these go.
            self._replace([], [], retired)
        dead = [p for p, _ in self._files(f"{self.root}/data") if p in retired]
        before = time.time() * 1000 - 1000 * grace_s
        dead += [p for p, _ in self._files(f"{self.root}/data", before) if p not in live and p not in retired]
        for path in dead:
            self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(path), False)
        return len(dead)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        now = self.manifest(version)
        schema = T.StructType.fromJson(json.loads(now.schema)) if now.schema else T.StructType()
        if not now.shards:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[s.path for s in now.shards])


def op1(spark, sf_dir: str) -> DataFrame:
    """Four arrivals of documents, compacted; every row as the store holds it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = ShardStore(spark, scratch_path(spark, "shards"))
    store.append_many(docs, F.pmod(F.xxhash64("doc_id", "source"), F.lit(4)))
    store.compact()
    store.vacuum()
    held = store.read()
    size = F.col("_metadata.file_size") if store.manifest().shards else F.lit(0)
    rows = held.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"), (size <= store.target).alias("within_target"))
    return rows.groupBy("doc_id", "n_chars", "text_sha256", "within_target").agg(F.count("*").alias("live_copies"))


SQL = """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha256, true AS within_target, count(*) AS live_copies
FROM documents GROUP BY doc_id, text
"""
