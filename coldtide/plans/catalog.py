"""Named data sources and datasets, as views of a session."""

from __future__ import annotations

import re
import time
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from coldtide.operators.fields import sampled_fields
from coldtide.sources import options
from coldtide.sources.bucket_source import NAME, find_buckets, register
from coldtide.sources.schema import flat_schema
from coldtide.sources.storage import open_store

_VIEW = re.compile(r"[A-Za-z_]\w*", re.ASCII)


class Catalog:
    """Data sources hold shared settings; a dataset adds a resource and its own
    settings on top, and is queried by its name."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.sources: dict[str, dict[str, Any]] = {}
        self.datasets: dict[str, tuple[str | None, str, dict[str, Any]]] = {}
        register(spark)

    def put_source(self, name: str, settings: Mapping[str, Any] | None = None) -> None:
        """Create or replace a data source; all errors are told at once."""
        if errors := options.validate_source(settings or {}):
            raise options.SettingError("; ".join(errors))
        self.sources[name] = dict(settings or {})
        for dataset, (source, resource, own) in list(self.datasets.items()):
            if source == name:
                self.put_dataset(dataset, source, resource, own)

    def put_dataset(self, name: str, source: str | None, resource: str, settings: Mapping[str, Any] | None = None) -> DataFrame:
        """Create or replace a dataset and its view."""
        if not _VIEW.fullmatch(name):
            raise options.SettingError(f"[{name}] cannot name a dataset")
        if source is not None and source not in self.sources:
            raise options.SettingError(f"unknown data source [{source}]")
        below = self.sources.get(source, {})
        if errors := options.validate_dataset(below, resource, settings or {}):
            raise options.SettingError("; ".join(errors))
        merged = options.layered({**(settings or {}), options.ENVELOPE: below})
        options.parse(resource, merged)
        df = read(self.spark, resource, **merged)
        df.createOrReplaceTempView(name)
        self.datasets[name] = (source, resource, dict(settings or {}))
        return df

    def drop_dataset(self, name: str) -> None:
        del self.datasets[name]
        self.spark.catalog.dropTempView(name)

    def drop_source(self, name: str) -> None:
        if used := [d for d, (source, _, _) in self.datasets.items() if source == name]:
            raise options.SettingError(f"data source [{name}] is used by {', '.join(sorted(used))}")
        del self.sources[name]


#: Seconds for which sampled field names are remembered.
FIELDS_LAST = 600
_fields: dict[tuple, tuple[float, tuple[str, ...]]] = {}


def discovered_fields(settings: options.Settings) -> tuple[str, ...]:
    """Sampled field names of a dataset, remembered by all that chooses its
    buckets (credentials excluded). A sampling that fails is not remembered."""
    key = (settings.location, settings.endpoint, settings.region, settings.path_style, settings.index, settings.index_pattern, settings.earliest, settings.latest)
    now = time.monotonic()
    for old in [k for k, (until, _) in _fields.items() if until <= now]:
        _fields.pop(old, None)
    if key not in _fields:
        store = open_store(settings)
        _fields[key] = now + FIELDS_LAST, tuple(sampled_fields(store, find_buckets(settings, store)))
    return _fields[key][1]


def read(spark: SparkSession, location: str, schema=None, **settings: Any) -> DataFrame:
    """A bucket tree as a DataFrame. ``schema`` may be a part of the layout."""
    register(spark)
    if schema is None:
        parsed = options.parse(location, {k.lower(): v for k, v in settings.items() if v is not None})
        if parsed.layout == "flat" and parsed.discover_fields:
            # Planning runs in a process of its own per query, so the driver remembers.
            schema = flat_schema(list(dict.fromkeys(parsed.fields + discovered_fields(parsed))), parsed.columns)
    if not {"split_bytes", "min_splits"} & {k.lower() for k, v in settings.items() if v is not None}:
        # As Spark packs files: no core is left without a task.
        settings["min_splits"] = spark.sparkContext.defaultParallelism
    reader = spark.read.format(NAME).options(**{k: str(v) for k, v in settings.items() if v is not None})
    return (reader.schema(schema) if schema is not None else reader).load(location)
