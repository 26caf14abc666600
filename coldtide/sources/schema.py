"""Output columns in both layouts, and the Arrow batches that carry them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import types as T

from coldtide.sources.options import FIELD_PREFIX

# The columns of the data model, in order, with their types.
CORE = (
    ("@timestamp", "time"), ("message", "text"), ("host.name", "text"), ("log.file.path", "text"),
    ("splunk.index", "text"), ("splunk.host", "text"), ("splunk.source", "text"), ("splunk.sourcetype", "text"),
    ("splunk.time", "time"), ("splunk.index_time", "time"), ("splunk.bucket", "text"),
)
FIELDS = FIELD_PREFIX.rstrip(".")
CORE_NAMES = tuple(name for name, _ in CORE)
_FILE = re.compile(rb"/|[A-Za-z]:\\")
_TIME = pa.timestamp("us", tz="UTC")


def is_file_path(source: bytes) -> bool:
    """Whether a source is an absolute path: ``/...`` or ``X:\\...``."""
    return _FILE.match(source) is not None


def column_name(name: str) -> str:
    """Full name of a column; what is not a core column is an indexed field."""
    return name if name in CORE_NAMES or name == FIELDS or name.startswith(FIELD_PREFIX) else FIELD_PREFIX + name


def nested_schema(columns: Iterable[str] | None = None) -> T.StructType:
    """Struct columns, so that dotted names resolve without quotes; indexed
    fields are one map. ``columns`` keeps only some leaves."""
    kinds = {"time": T.TimestampType(), "text": T.StringType()}
    leaves = [(name, kinds[kind]) for name, kind in CORE] + [(FIELDS, T.MapType(T.StringType(), T.ArrayType(T.StringType())))]
    if columns is not None:
        wanted = {column_name(c) for c in columns}
        wanted = {FIELDS if c.startswith(FIELD_PREFIX) else c for c in wanted}
        leaves = [leaf for leaf in leaves if leaf[0] in wanted]

    def grouped(items: list[tuple[list[str], T.DataType]]) -> T.StructType:
        heads: dict[str, list[tuple[list[str], T.DataType]]] = {}
        for path, kind in items:
            heads.setdefault(path[0], []).append((path[1:], kind))
        return T.StructType([T.StructField(head, below[0][1] if not below[0][0] else grouped(below)) for head, below in heads.items()])

    # The time column's name holds no dot; all others split at theirs.
    return grouped([(name.split("."), kind) for name, kind in leaves])


def flat_schema(fields: Sequence[str], columns: Iterable[str] | None = None) -> T.StructType:
    """The exact dotted columns, one array column per indexed field."""
    out = T.StructType([T.StructField(name, T.TimestampType() if kind == "time" else T.StringType()) for name, kind in CORE])
    for name in fields:
        out.add(FIELD_PREFIX + name, T.ArrayType(T.StringType()))
    if columns is not None:
        kept = [column_name(c) for c in columns]
        have = {f.name: f for f in out.fields}
        out = T.StructType([have.get(c, T.StructField(c, T.ArrayType(T.StringType()))) for c in dict.fromkeys(kept)])
    return out


def leaves(schema: T.StructType) -> set[str]:
    """Full dotted names of the leaves that a requested schema holds."""
    out = set()

    def walk(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        else:
            out.add(path)

    walk(schema, "")
    return out


def as_text(values: list[bytes | None]) -> pa.Array:
    """Bytes as a string column, byte for byte, without a check for UTF-8."""
    held = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(held), held.buffers(), held.null_count)


class BatchBuilder:
    """Collects events and builds record batches of a requested schema."""

    def __init__(self, schema: T.StructType, timestamp: str):
        self.schema, self.timestamp = schema, timestamp
        self.names = leaves(schema)
        self.field_names = {n.removeprefix(FIELD_PREFIX).encode("utf-8", "surrogateescape") for n in self.names if n.startswith(FIELD_PREFIX)}
        self.wants_map = FIELDS in self.names
        self.wants_fields = self.wants_map or bool(self.field_names) or (timestamp not in ("event", "index") and "@timestamp" in self.names)
        self.clear()

    def clear(self) -> None:
        self.events: list = []
        self.index: list[bytes] = []
        self.bucket: list[bytes] = []
        self.raw_bytes = 0

    def add(self, event, index: bytes, bucket: bytes) -> None:
        self.events.append(event)
        self.index.append(index)
        self.bucket.append(bucket)
        self.raw_bytes += len(event.raw)

    def _timestamps(self) -> list[int | None]:
        if self.timestamp == "event":
            return [e.time_ms * 1000 for e in self.events]
        if self.timestamp == "index":
            return [e.index_time * 1_000_000 for e in self.events]
        from coldtide.functions.timeparse import parse_millis

        key, out = self.timestamp.encode(), []
        for e in self.events:
            found = None
            for name, value in e.fields:
                if name == key and (found := parse_millis(value)) is not None:
                    break
            out.append(None if found is None else found * 1000)
        return out

    def _leaf(self, name: str, kind: T.DataType) -> pa.Array:
        events = self.events
        if name == "@timestamp":
            return pa.array(self._timestamps(), _TIME)
        if name == "splunk.time":
            return pa.array([e.time_ms * 1000 for e in events], _TIME)
        if name == "splunk.index_time":
            return pa.array([e.index_time * 1_000_000 for e in events], _TIME)
        if name == "message":
            return as_text([e.raw for e in events])
        if name in ("host.name", "splunk.host"):
            return as_text([e.host for e in events])
        if name == "log.file.path":
            return as_text([e.source if is_file_path(e.source) else None for e in events])
        if name == "splunk.source":
            return as_text([e.source for e in events])
        if name == "splunk.sourcetype":
            return as_text([e.sourcetype for e in events])
        if name == "splunk.index":
            return as_text(self.index)
        if name == "splunk.bucket":
            return as_text(self.bucket)
        if name == FIELDS:
            return self._map()
        return self._field(name.removeprefix(FIELD_PREFIX).encode("utf-8", "surrogateescape"))

    def _field(self, key: bytes) -> pa.Array:
        offsets, values, empty = [0], [], []
        for e in self.events:
            values += [v for n, v in e.fields if n == key]
            empty.append(len(values) == offsets[-1])
            offsets.append(len(values))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), as_text(values), mask=pa.array(empty, pa.bool_()))

    def _map(self) -> pa.Array:
        ends, keys, lists, values = [0], [], [0], []
        for e in self.events:
            held: dict[bytes, list[bytes]] = {}
            for name, value in e.fields:
                held.setdefault(name, []).append(value)
            for name, own in held.items():
                keys.append(name)
                values += own
                lists.append(len(values))
            ends.append(len(keys))
        items = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), as_text(values))
        return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), as_text(keys), items)

    def build(self) -> pa.RecordBatch:
        def column(kind: T.DataType, path: str) -> pa.Array:
            if isinstance(kind, T.StructType):
                return pa.StructArray.from_arrays([column(f.dataType, f"{path}.{f.name}" if path else f.name) for f in kind.fields], [f.name for f in kind.fields])
            return self._leaf(path, kind)

        arrays = [column(f.dataType, f.name) for f in self.schema.fields]
        batch = pa.RecordBatch.from_arrays(arrays, [f.name for f in self.schema.fields])
        self.clear()
        return batch
