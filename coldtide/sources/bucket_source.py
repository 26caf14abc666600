"""The ``coldbucket`` data source: bucket trees as DataFrames.

Listing, de-duplication and pruning happen once, in planning; each partition is
one bucket, or several small ones, and is decoded by an executor into Arrow
batches. Filters are used to drop whole buckets and handed back to Spark, which
evaluates them on every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from coldtide.operators.fields import sampled_fields
from coldtide.session import ship_code
from coldtide.sources import options as settings_of
from coldtide.sources.discovery import Bounds, Bucket, DiscoveryError, discover
from coldtide.sources.journal import CorruptJournal, JournalDecoder
from coldtide.sources.options import Settings, SettingError
from coldtide.sources.schema import BatchBuilder, flat_schema, nested_schema
from coldtide.sources.storage import FileStore, ObjectStore, open_store
from coldtide.sources.streams import StreamError, chunks

NAME = "coldbucket"
#: Stored bytes that are worth a task of their own.
LEAST_SPLIT = 4 << 20


class BucketReadError(RuntimeError):
    """A bucket that cannot be decoded; the query fails, no bucket is skipped."""


@dataclass
class BucketPartition(InputPartition):
    """Buckets of one task with the exact objects to read."""

    buckets: tuple[Bucket, ...]


def read_small(store: FileStore | ObjectStore, key: str) -> bytes:
    with store.open(key) as handle:
        return handle.read()


def find_buckets(settings: Settings, store: FileStore | ObjectStore, ranges: bool = False) -> list[Bucket]:
    """The buckets of a dataset; none is an error unless a window is set."""
    found = discover(store.list(), lambda key: read_small(store, key), settings.root_name, settings.index, settings.index_pattern, settings.earliest, settings.latest, ranges)
    if not found and settings.earliest is None and settings.latest is None:
        raise DiscoveryError(f"[{store.describe()}] holds no bucket")
    return found


def grouped(buckets: list[Bucket], target: int) -> list[BucketPartition]:
    """Neighbours in order, newest first, packed up to ``target`` stored bytes."""
    out: list[BucketPartition] = []
    held: list[Bucket] = []
    size = 0
    for bucket in buckets:
        if held and size + bucket.stored_bytes > target:
            out.append(BucketPartition(tuple(held)))
            held, size = [], 0
        held.append(bucket)
        size += bucket.stored_bytes
    if held:
        out.append(BucketPartition(tuple(held)))
    return out


def split_target(settings: Settings, buckets: list[Bucket]) -> int:
    """Stored bytes of a task: less than ``split_bytes`` if ``min_splits`` tasks
    would else not come about."""
    share = -(-sum(b.stored_bytes for b in buckets) // max(1, settings.min_splits))
    return min(settings.split_bytes, max(LEAST_SPLIT, share)) if settings.min_splits > 1 else settings.split_bytes


def _millis(value: object, up: bool) -> int | None:
    """A time literal in ms, rounded so that a bound never tightens."""
    if not isinstance(value, datetime):
        return None
    moment = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    delta = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    micros = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    return -(-micros // 1000) if up else micros // 1000


def bounds_of(filters: list, event_time: bool) -> Bounds:
    """What top-level filters say of time and index; others say nothing."""
    bounds = Bounds()
    for f in filters:
        name = ".".join(getattr(f, "attribute", ()))
        if name == "splunk.index":
            if isinstance(f, (EqualTo, EqualNullSafe)) and isinstance(f.value, str):
                bounds.one_of([f.value])
            elif isinstance(f, In) and all(isinstance(v, str) for v in f.value):
                bounds.one_of(f.value)
        elif name == "splunk.time" or (name == "@timestamp" and event_time):
            value = getattr(f, "value", None)
            if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)) and (ms := _millis(value, up=False)) is not None:
                bounds.at_least(ms)
            if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)) and (ms := _millis(value, up=True)) is not None:
                bounds.at_most(ms)
    return bounds


class BucketReader(DataSourceReader):
    def __init__(self, settings: Settings, schema):
        self.settings, self.schema = settings, schema
        self.bounds = Bounds()

    def partitions(self) -> list[BucketPartition]:
        store = open_store(self.settings)
        found = find_buckets(self.settings, store, ranges=self.bounds.prunes_time)
        kept = [b for b in found if self.bounds.keeps(b)]
        kept = grouped(kept, split_target(self.settings, kept))
        # Without a partition Spark would call read() for none.
        return kept or [BucketPartition(())]

    def read(self, partition: BucketPartition) -> Iterator[pa.RecordBatch]:
        settings = self.settings
        store = open_store(settings)
        builder = BatchBuilder(self.schema, settings.timestamp_kind)
        low = None if settings.earliest is None else settings.earliest * 1000
        high = None if settings.latest is None else settings.latest * 1000 + 999
        left = settings.limit_per_split
        for bucket in partition.buckets if partition else ():
            index, name = bucket.index.encode("utf-8", "surrogateescape"), bucket.bucket_id.encode("utf-8", "surrogateescape")
            source = chunks(store.open, bucket.journal_keys)
            decoder = JournalDecoder(source, builder.wants_fields, "message" in builder.names)
            try:
                for event in decoder:
                    if low is not None and event.time_ms < low or high is not None and event.time_ms > high:
                        continue
                    if left is not None:
                        if left <= 0:
                            break
                        left -= 1
                    builder.add(event, index, name)
                    if len(builder.events) >= settings.batch_rows or builder.raw_bytes >= settings.batch_bytes:
                        yield builder.build()
            except (CorruptJournal, StreamError, OSError) as bad:
                raise BucketReadError(f"failed decoding bucket [{bucket.index}/{bucket.bucket_id}] from {store.describe()} at journal offset {decoder.position}: {bad}") from bad
            finally:
                source.close()
        if builder.events:
            yield builder.build()


class PruningBucketReader(BucketReader):
    """A reader that sees the filters above it; all are handed back."""

    def pushFilters(self, filters: list) -> Iterator:
        self.bounds = bounds_of(filters, self.settings.timestamp_kind == "event")
        yield from filters


class BucketSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _settings(self) -> Settings:
        given = {k.lower(): v for k, v in dict(self.options).items()}
        location = given.pop("location", None) or given.pop("resource", None) or given.pop("path", None)
        if not location:
            raise SettingError("a location is needed: load(path) or option [location]")
        for key in ("location", "resource", "path"):
            given.pop(key, None)
        return settings_of.parse(location, given)

    def schema(self):
        settings = self._settings()
        if settings.layout == "nested":
            return nested_schema(settings.columns)
        names = list(settings.fields)
        if settings.discover_fields:
            store = open_store(settings)
            names += [n for n in sampled_fields(store, find_buckets(settings, store)) if n not in names]
        return flat_schema(names, settings.columns)

    def reader(self, schema) -> BucketReader:
        settings = self._settings()
        return (PruningBucketReader if settings.pushdown else BucketReader)(settings, schema)

    def streamReader(self, schema):
        from coldtide.streaming.new_buckets import NewBucketReader

        return NewBucketReader(self._settings(), schema)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("coldbucket")`` available in a session."""
    ship_code(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BucketSource)
