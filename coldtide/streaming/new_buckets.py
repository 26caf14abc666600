"""Buckets that appear in a tree, as a stream (an extension of this engine).

An offset lists the directories of all buckets seen (a few rows per bucket, as in
the listing itself), so a restart neither repeats nor skips a bucket that was
there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSourceStreamReader

from coldtide.sources.discovery import Bucket
from coldtide.sources.options import Settings
from coldtide.sources.storage import open_store


class NewBucketReader(DataSourceStreamReader):
    """Each micro-batch decodes the buckets that were not there before."""

    def __init__(self, settings: Settings, schema):
        self.settings, self.schema = settings, schema

    def _listing(self) -> dict[str, Bucket]:
        from coldtide.sources.bucket_source import find_buckets
        from coldtide.sources.discovery import DiscoveryError

        try:
            found = find_buckets(self.settings, open_store(self.settings))
        except DiscoveryError:
            found = []
        return {b.directory: b for b in found}

    def initialOffset(self) -> dict:
        return {"seen": []}

    def latestOffset(self) -> dict:
        return {"seen": sorted(self._listing())}

    def partitions(self, start: dict, end: dict) -> list:
        from coldtide.sources.bucket_source import BucketPartition, grouped

        now, before = self._listing(), set(start["seen"])
        new = [now[d] for d in end["seen"] if d in now and d not in before]
        return grouped(new, self.settings.split_bytes) or [BucketPartition(())]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        from coldtide.sources.bucket_source import BucketReader

        return BucketReader(self.settings, self.schema).read(partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept outside of Spark's own checkpoint."""
