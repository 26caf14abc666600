"""Journals and bucket trees written from tables, for tests and queries.

The engine itself never writes buckets. The writer follows the format notes in
``coldtide.sources.journal``; mapping of rows: see ``build_events``.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, groupby, islice
from typing import BinaryIO
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtide.session import ship_code, shared_folder

#: Day 0 of the weeks that buckets cover: 2024-01-01 in days since the epoch.
FIRST_DAY = 19_723
CODECS = ("gzip", "zstd", "lz4", "none", "lz4_legacy")
ENDINGS = {"gzip": "journal.gz", "zstd": "journal.zst", "lz4": "journal.lz4", "none": "journal", "lz4_legacy": "journal.lz4"}
INDEX_OF = {"click": "web", "view": "web", "signup": "auth", "error": "auth", "purchase": "sales"}
WEEK_US = 7 * 86_400_000_000
#: Bytes that a writer holds before they go to a file.
PART = 1 << 20
#: Strings of a table that a writer remembers; later uses of others enter anew.
REMEMBERED = 1 << 17
#: Most tasks that write a tree; a task writes its buckets one after the other.
TASKS = 1_000


def varint(value: int) -> bytes:
    value &= 0xFFFFFFFFFFFFFFFF
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def subsecond_code(fraction: str) -> int:
    """The code of a fraction's digits, as they are written."""
    if not fraction:
        return 0
    digits = fraction.lstrip("0")
    zeros = len(fraction) - len(digits)
    return ((int(digits) << 1 | 1) if digits else 1) << zeros


class JournalWriter:
    """Appends records; strings enter the tables on first use. ``out`` may be
    emptied between records."""

    def __init__(self, base_index: int):
        self.out = bytearray(b"\x0a\x01\x00" + base_index.to_bytes(4, "little", signed=True))
        self.base_index, self.base_time = base_index, None
        self.tables: list[dict[bytes, int]] = [{}, {}, {}, {}]
        self.sizes = [0, 0, 0, 0]
        self.active: list[int | None] = [None, None, None]

    def number(self, table: int, text: bytes) -> int:
        held = self.tables[table]
        if text not in held:
            if len(held) >= REMEMBERED:
                held.clear()
            self.sizes[table] += 1
            held[text] = self.sizes[table]
            full = (b"host::", b"source::", b"sourcetype::", b"")[table] + text
            self.out += bytes([3 + table]) + varint(len(full)) + full
        return held[text]

    def event(self, seconds: int, fraction: str, index_time: int, host: bytes, source: bytes, sourcetype: bytes, raw: bytes, fields: Sequence[tuple[bytes, int, object]] = (), opcode: int = 41) -> None:
        """One event. A field is (name, type, value): type 0 bytes, 8 and 9
        magnitudes, 4 (length, offset), others as many integers as they have."""
        wanted = [self.number(i, x) for i, x in enumerate((host, source, sourcetype))]
        entries = bytearray()
        for name, kind, value in fields:
            key = self.number(3, name) << 4 | kind
            entries += varint(key >> 2 if 32 <= opcode <= 35 else key)
            if kind == 0:
                entries += varint(self.number(3, value))
            elif isinstance(value, tuple):
                entries += b"".join(map(varint, value))
            else:
                entries += varint(value)
        code, state = 16, bytearray()
        for i, bit in enumerate((8, 4, 2)):
            if self.active[i] != wanted[i]:
                code |= bit
                state += varint(wanted[i])
        if self.base_time != seconds:
            code |= 1
            state += seconds.to_bytes(4, "little", signed=True)
        if code > 16:
            self.out += bytes([code]) + state
        self.active, self.base_time = wanted, seconds
        extension = b"ext" if opcode & 4 else b""
        body = (varint(len(extension)) if opcode & 4 else b"") + (b"" if opcode & 1 else bytes(20)) + bytes(8)
        body += varint(0) + varint(0) + varint((index_time - self.base_index) & 0xFFFFFFFF) + varint(subsecond_code(fraction)) + varint(len(fields)) + bytes(entries) + extension + raw
        self.out += bytes([opcode]) + varint(len(body)) + body


def compressed(data: bytes, codec: str, member: int = 14_000) -> bytes:
    """A journal under a codec; gzip in many members, as journals are."""
    out = io.BytesIO()
    compress(io.BytesIO(data), len(data), codec, out, member)
    return out.getvalue()


def compress(plain: BinaryIO, size: int, codec: str, out: BinaryIO, member: int = 14_000) -> None:
    """``size`` bytes under a codec, read and written in parts."""
    if codec == "gzip":
        for _ in range(0, max(1, size), member):
            out.write(gzip.compress(plain.read(member), 6, mtime=0))
    elif codec in ("zstd", "lz4"):
        for left in (size // 2, size - size // 2):
            with pa.CompressedOutputStream(pa.PythonFile(_Open(out), "w"), codec) as frame:
                for part in _parts(plain, left):
                    frame.write(part)
    elif codec == "lz4_legacy":
        raw = pa.Codec("lz4_raw")
        out.write(bytes.fromhex("02214c18"))
        for part in _parts(plain, size):
            block = raw.compress(part, asbytes=True)
            out.write(len(block).to_bytes(4, "little") + block)
    else:
        for part in _parts(plain, size):
            out.write(part)


def _parts(source: BinaryIO, size: int) -> Iterator[bytes]:
    """The next ``size`` bytes."""
    while size:
        part = source.read(min(size, PART))
        if not part:
            raise EOFError(f"{size} bytes are missing")
        size -= len(part)
        yield part


class _Open:
    """A file that a frame's end leaves open."""

    closed = False

    def __init__(self, out: BinaryIO):
        self._out = out

    def write(self, data: bytes) -> int:
        return self._out.write(data)

    def flush(self) -> None:
        pass

    def close(self) -> None:
        pass


def put(root: str, key: str, data: bytes) -> None:
    put_range(root, key, io.BytesIO(data), 0, len(data))


def put_range(root: str, key: str, source: BinaryIO, start: int, size: int) -> None:
    """A file of a part of another; it takes its name when it is whole, so that
    a task which is tried again leaves no halves."""
    path = os.path.join(root, key)
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    aside = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    source.seek(start)
    with open(aside, "wb") as out:
        for part in _parts(source, size):
            out.write(part)
    os.replace(aside, path)


def _guid(index: str) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_DNS, index)).upper()


def event_fields(event_id: int, seconds: int, micros: int, user_id: int, event_type: str, value: float, props: str) -> list[tuple[bytes, int, object]]:
    """Indexed fields of a row of ``events``, every value type among them."""
    fields: list[tuple[bytes, int, object]] = [
        (b"event_id", 8, event_id), (b"neg_user", 9, user_id), (b"value", 0, repr(float("nan" if value is None else value)).encode()),
        (b"k", 4, (len(props.encode()) - 7, 6)), (b"tag", 0, event_type.encode()),
    ]
    if user_id % 3 == 0:
        fields.append((b"tag", 0, b"vip"))
    if event_id % 10 == 0:
        fields.append((b"rare", 0, b"yes"))
    millis = micros // 1000
    text = (
        _iso(seconds, micros), f"{seconds}.{millis:03d}", f"{seconds * 1000 + millis}", "not-a-time",
    )[event_id % 4]
    fields.append((b"evt_time", 0, text.encode()))
    return fields


def _iso(seconds: int, micros: int) -> str:
    from datetime import datetime, timezone

    return datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S") + f".{micros:06d}+0000"


#: Records that hold no event: padding, a slice's hash, a private block.
FILLERS = (bytes(5), b"\x0b" + bytes(range(32)), b"\x09" + varint(300) + b"\x29" * 300)
#: Metadata types that no field comes from, by their numbers of integers.
OTHER_TYPES = ((3, 2), (6, 2), (7, 3), (10, 1), (12, 3), (13, 0), (14, 2))


def events_journal(rows: Iterable[tuple], extras: bool = False) -> Iterator[bytes]:
    """The journal of rows from the oldest on, in parts; with ``extras``,
    records and metadata between them that readers pass over."""
    writer = None
    for event_id, micros, user_id, event_type, value, props in rows:
        seconds, rest = divmod(micros, 1_000_000)
        writer = writer or JournalWriter(seconds)
        if extras:
            kind, many = OTHER_TYPES[event_id % len(OTHER_TYPES)]
            writer.out += FILLERS[event_id % len(FILLERS)]
            writer.event(seconds, f"{rest:06d}", seconds, f"host{user_id % 10}".encode(), b"s", event_type.encode(), props.encode(), [(b"event_id", 8, event_id), (b"odd", kind, (1,) * many), (b"last", 0, b"end")], opcode=36 + event_id % 8)
        else:
            source = f"/var/log/{event_type}.log" if user_id % 2 == 0 else "tcp:514"
            writer.event(seconds, f"{rest:06d}", seconds + event_id % 11 - 5, f"host{user_id % 10}".encode(), source.encode(), event_type.encode(), props.encode(), event_fields(event_id, seconds, rest, user_id, event_type, value, props))
        yield from _drained(writer)
    if writer:
        yield bytes(writer.out)


def _drained(writer: JournalWriter) -> Iterator[bytes]:
    if len(writer.out) >= PART:
        yield bytes(writer.out)
        writer.out.clear()


class Packed:
    """A compressed journal in a temporary file of the task, with the number of
    its rows and the times of the first and the last. Memory holds a part."""

    def __init__(self, rows: Iterable[tuple], journal: Callable[[Iterable[tuple]], Iterable[bytes]], codec: str, seconds: Callable[[tuple], int]):
        self.count = self.size = 0
        self.oldest = self.newest = 0

        def seen() -> Iterator[tuple]:
            for row in rows:
                self.newest = seconds(row)
                if not self.count:
                    self.oldest = self.newest
                self.count += 1
                yield row

        self.file = tempfile.TemporaryFile()
        with tempfile.TemporaryFile() as plain:
            size = sum(plain.write(part) for part in journal(seen()))
            plain.seek(0)
            compress(plain, size, codec, self.file)
        self.size = self.file.tell()

    def put(self, root: str, key: str, start: int = 0, end: int | None = None) -> None:
        end = self.size if end is None else min(end, self.size)
        put_range(root, key, self.file, start, end - start)

    def __enter__(self) -> Packed:
        return self

    def __exit__(self, *_: object) -> None:
        self.file.close()


def _event_seconds(row: tuple) -> int:
    return row[1] // 1_000_000


def bucket_of(row: tuple) -> tuple[str, int]:
    """Index and week of a row."""
    return INDEX_OF[row[3]], (row[1] // 86_400_000_000 - FIRST_DAY) // 7


def build_events(rows: Iterable[tuple], root: str) -> None:
    """A tree of all layouts from (event_id, ts in us, user_id, event_type,
    value, props) rows: one bucket per index and week, codec by week.

    ``web`` is classic and has a disabled copy, ``auth`` has replicas, and
    ``sales`` has slices with a receipt and a second, damaged upload.
    """
    put_events(sorted(rows, key=lambda r: (*bucket_of(r), r[1], r[0])), root)


def put_events(rows: Iterable[tuple], root: str, part: int = 0) -> int:
    """The buckets of rows that come bucket by bucket, oldest first; how many
    rows they hold."""
    total = 0
    for (index, week), held in groupby(rows, key=bucket_of):
        codec = CODECS[week % 5]
        with Packed(held, events_journal, codec, _event_seconds) as data:
            total += data.count
            number, guid = week + 1, _guid(index)
            name = f"{data.newest}_{data.oldest}_{number}_{guid}"
            if index == "sales":
                home = f"sales/db/{number:02x}/a7/{number}~{guid}"
                step = max(1, data.size // 12)
                for at in range(0, data.size, step) or [0]:
                    data.put(root, f"{home}/guidSplunk-B/rawdata/{at}", at, at + step)
                data.put(root, f"{home}/guidSplunk-A/rawdata/0", 0, data.size // 2)
                told = {"objects": [{"name": f"{home}/guidSplunk-B/rawdata/0"}], "manifest": {"path": f"db_{name}"}}
                put(root, f"{home}/receipt.json", json.dumps(told).encode())
                continue
            data.put(root, f"{index}/{'db' if week % 2 else 'colddb'}/db_{name}/rawdata/{ENDINGS[codec]}")
            put(root, f"{index}/{'db' if week % 2 else 'colddb'}/db_{name}/rawdata/{index}.tsidx", b"index")
            if index == "auth":
                data.put(root, f"auth/colddb/rb_{name}/rawdata/{ENDINGS[codec]}")
            if index == "web" and week == 0:
                data.put(root, f"web/db/DISABLED-db_{name}/rawdata/{ENDINGS[codec]}")
    return total


def _runs(rows: Iterable[tuple], most: int) -> Iterator[Iterator[tuple]]:
    """Up to ``most`` rows at a time; each run is read before the next."""
    rows = iter(rows)
    for first in rows:
        yield chain([first], islice(rows, most - 1))


def put_extras(rows: Iterable[tuple], root: str, part: int = 0, per_bucket: int = 5_000) -> int:
    """Events in buckets of one index, with records that readers pass over.
    Rows come oldest first; ``part`` keeps the names of several tasks apart."""
    total = 0
    for n, held in enumerate(_runs(rows, per_bucket)):
        with Packed(held, lambda r: events_journal(r, extras=True), "zstd", _event_seconds) as data:
            data.put(root, f"odd/db/db_{data.newest}_{data.oldest}_{part * 10**9 + n}/rawdata/journal.zst")
            total += data.count
    return total


def documents_journal(rows: Iterable[tuple[int, str]]) -> Iterator[bytes]:
    writer = None
    for doc_id, text in rows:
        seconds = 1_700_000_000 + doc_id
        writer = writer or JournalWriter(seconds)
        writer.event(seconds, "", seconds, b"docs", b"docs", b"text", text.encode(), [(b"doc_id", 8, doc_id)], opcode=37)
        yield from _drained(writer)
    if writer:
        yield bytes(writer.out)


def put_documents(rows: Iterable[tuple[int, str]], root: str, part: int = 0, per_bucket: int = 500) -> int:
    """Texts as events: raw bytes that are long, of many lines, not ASCII."""
    total = 0
    for n, held in enumerate(_runs(rows, per_bucket)):
        with Packed(held, documents_journal, "zstd", lambda r: 1_700_000_000 + r[0]) as data:
            data.put(root, f"docs/db/db_{data.newest}_{data.oldest}_{part * 10**9 + n}_{_guid('docs')}/rawdata/journal.zst")
            total += data.count
    return total


def _folder(spark) -> str:
    where = urlsplit(shared_folder(spark))
    if where.scheme not in ("", "file"):
        raise ValueError(f"bucket trees are built on a file system that all executors mount, not on [{where.scheme}]")
    return where.path


def _made(aside: str, root: str) -> str:
    try:
        os.rename(aside, root)
    except OSError:
        # Another process built it meanwhile.
        shutil.rmtree(aside, ignore_errors=True)
    return root


def fixed_tree(spark, what: str, files: dict[str, bytes]) -> str:
    """Root of a tree of given files, built once per content."""
    told = hashlib.md5(b"".join(k.encode() + b"\0" + v for k, v in sorted(files.items()))).hexdigest()[:12]
    root = os.path.join(_folder(spark), f"bucket-tree-{what}-{told}")
    if os.path.isdir(root):
        return root
    aside = f"{root}-{uuid.uuid4().hex}"
    for key, data in files.items():
        put(aside, key, data)
    return _made(aside, root)


def _by_bucket(rows: DataFrame) -> DataFrame:
    """Rows of ``events``, those of a bucket in one partition and in order."""
    start, indexes = FIRST_DAY * 86_400_000_000, sorted(set(INDEX_OF.values()))
    number = F.coalesce(F.create_map(*(F.lit(x) for kind, index in INDEX_OF.items() for x in (kind, indexes.index(index))))[F.col("event_type")], F.lit(0))
    rows = rows.withColumns({"week": F.expr(f"(us - {start} - pmod(us - {start}, {WEEK_US})) div {WEEK_US}"), "number": number})
    first, last = rows.agg(F.min("week"), F.max("week")).first()
    tasks = 1 if first is None else min(TASKS, (last - first + 1) * len(indexes))
    place = F.pmod((F.col("week") - F.lit(first or 0)) * len(indexes) + F.col("number"), F.lit(tasks)).cast("int")
    return rows.repartitionById(tasks, place).sortWithinPartitions("week", "number", "us", "event_id").drop("week", "number")


def tree(spark, sf_dir: str, what: str = "events") -> str:
    """Root of the tree built from a table, built once per shared folder.

    Executors write it, each its own buckets; the driver holds no rows.
    """
    folder = _folder(spark)
    name = f"bucket-tree-{what}-{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"
    root = os.path.join(folder, name)
    if os.path.isdir(root):
        return root
    aside = f"{root}-{uuid.uuid4().hex}"
    if what in ("events", "extras"):
        rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts) as us", "user_id", "event_type", "value", "props")
        rows, write = (_by_bucket(rows), put_events) if what == "events" else (rows.repartitionByRange("us", "event_id").sortWithinPartitions("us", "event_id"), put_extras)
    else:
        rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null").select("doc_id", "text")
        rows, write = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id"), put_documents
    ship_code(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        written = write(held, aside, TaskContext.get().partitionId())
        yield pa.RecordBatch.from_pydict({"written": [written]})

    rows.mapInArrow(run, "written long").agg(F.sum("written")).collect()
    return _made(aside, root)
