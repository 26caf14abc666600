"""Names of indexed fields: by bounded sampling, or exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtide.sources.journal import JournalDecoder
from coldtide.sources.streams import chunks

# The bounds of sampling.
INDEXES, BUCKETS, EVENTS, STALE = 32, 8, 20_000, 5_000


def sampled_fields(store, buckets: list) -> list[str]:
    """Sorted field names in samples of the largest buckets of each index.

    A bucket's sample ends early after a run of events without a new name. A
    bucket that cannot be decoded fails the sampling.
    """
    by_index: dict[str, list] = {}
    for bucket in buckets:
        by_index.setdefault(bucket.index, []).append(bucket)
    found: set[bytes] = set()
    for index in list(by_index)[:INDEXES]:
        for bucket in sorted(by_index[index], key=lambda b: -b.stored_bytes)[:BUCKETS]:
            stale = 0
            source = chunks(store.open, bucket.journal_keys)
            try:
                for n, event in enumerate(JournalDecoder(source)):
                    new = {name for name, _ in event.fields if name} - found
                    found |= new
                    stale = 0 if new else stale + 1
                    if stale >= STALE or n + 1 >= EVENTS:
                        break
            finally:
                source.close()
    return sorted(name.decode("utf-8", "surrogateescape") for name in found)


def exact_fields(events: DataFrame) -> DataFrame:
    """All field names of a nested scan with their numbers of events."""
    return events.select(F.explode(F.map_keys("splunk.fields")).alias("field")).groupBy("field").agg(F.count("*").alias("events"))
