"""From a listing to logical buckets: layout, index, copies, time range.

Everything here is a pure function of (key, size) rows and a reader of small
receipt files, so it runs on the driver without Spark: listings have a few rows
per bucket.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from coldtide.sources.storage import RAW_FOLDER, RECEIPT

# Name patterns and folder names of the bucket layouts.
CLASSIC = re.compile(r"(db|rb)_([0-9]+)_([0-9]+)_([0-9]+)(?:_(.+))?", re.ASCII)
REMOTE = re.compile(r"([0-9]+)~(.+)", re.ASCII)
HASH = re.compile(r"[0-9a-f]{2}", re.ASCII | re.IGNORECASE)
HOMES = ("db", "colddb", "thaweddb")
UPLOAD = "guidSplunk"
DISABLED = "DISABLED"
WHOLE_NAMES = ("journal.zst", "journal.gz", "journal.lz4", "journal")


class DiscoveryError(ValueError):
    """No bucket where some are expected."""


@dataclass(frozen=True)
class Bucket:
    index: str
    bucket_id: str
    directory: str
    journal_keys: tuple[str, ...]
    newest: int | None
    oldest: int | None
    stored_bytes: int

    def overlaps(self, earliest: int | None, latest: int | None) -> bool:
        """Whether events from earliest to latest (seconds) can be inside."""
        if earliest is not None and self.newest is not None and self.newest < earliest:
            return False
        return not (latest is not None and self.oldest is not None and self.oldest > latest)


def parent(path: str) -> str:
    return path.rpartition("/")[0]


def name_of(path: str) -> str:
    return path.rpartition("/")[2]


def journal_keys(keys: Iterable[str]) -> tuple[str, ...]:
    """One whole journal by preference, else all slices in numeric order."""
    keys = list(keys)
    wholes = [k for k in keys if name_of(k).startswith("journal")]
    if wholes:
        rank = {name: i for i, name in enumerate(WHOLE_NAMES)}
        return (min(wholes, key=lambda k: (rank.get(name_of(k), len(rank)), k)),)
    return tuple(sorted((k for k in keys if name_of(k).isdigit()), key=lambda k: (int(name_of(k)), k)))


def index_of(directory: str, root_name: str, pattern: str | None = None) -> str:
    """Index name of a bucket directory relative to the root."""
    if pattern and (found := re.search(pattern, directory)) and found[1]:
        return found[1]
    if not directory:
        return root_name or "unknown"
    parts = directory.split("/")
    if len(parts) > 3 and parts[-4] in HOMES and REMOTE.fullmatch(parts[-1]) and HASH.fullmatch(parts[-2]) and HASH.fullmatch(parts[-3]):
        # The folders of a hash are no homes, not even that of 0xdb.
        del parts[-3:]
    for at in range(len(parts) - 1, -1, -1):
        if parts[at] in HOMES:
            return parts[at - 1] if at else root_name
    return parts[-2] if len(parts) > 1 else root_name


def receipt_range(receipt: dict | None) -> tuple[int | None, int | None]:
    """(newest, oldest) seconds that a receipt tells, both or neither."""
    manifest = (receipt or {}).get("manifest")
    if not isinstance(manifest, dict):
        return None, None
    path = manifest.get("path")
    if isinstance(path, str) and (found := CLASSIC.fullmatch(name_of(path.rstrip("/")))):
        return int(found[2]), int(found[3])
    newest = oldest = None
    for key, value in manifest.items():
        word = str(key).lower()
        if "time" not in word or "index" in word:
            continue
        try:
            number = int(float(value))
        except (TypeError, ValueError, OverflowError):
            continue
        if "latest" in word:
            newest = number
        elif "earliest" in word:
            oldest = number
    return (newest, oldest) if newest is not None and oldest is not None else (None, None)


def _receipt(read: Callable[[str], bytes], key: str | None) -> dict | None:
    """A parsed receipt; one that is missing, unreadable or odd is no receipt."""
    if key is None:
        return None
    try:
        told = json.loads(read(key))
    except (OSError, ValueError):
        return None
    return told if isinstance(told, dict) else None


def _chosen_copy(copies: dict[str, list[str]], receipt: Callable[[], dict | None]) -> str:
    """Of several uploads of a bucket, the one to read."""
    if len(copies) == 1:
        return next(iter(copies))
    told = (receipt() or {}).get("objects")
    for entry in told if isinstance(told, list) else []:
        name = entry.get("name") if isinstance(entry, dict) else None
        for folder in sorted(copies):
            if isinstance(name, str) and f"/{name_of(folder)}/" in f"/{name}":
                return folder
    for folder in sorted(copies):
        if any(name_of(k).startswith("journal") for k in copies[folder]):
            return folder
    return min(copies)


def discover(listing: Iterable[tuple[str, int]], read: Callable[[str], bytes], root_name: str, index: str | None = None, index_pattern: str | None = None, earliest: int | None = None, latest: int | None = None, ranges: bool = False) -> list[Bucket]:
    """Buckets, newest first, one per (index, identity).

    Receipts are fetched only to choose between copies, or for the time range
    of buckets whose name has none, if a window (or ``ranges``) can use it.
    """
    sizes: dict[str, int] = {}
    folders: dict[str, dict[str, list[str]]] = {}
    receipts: dict[str, str] = {}
    for key, size in listing:
        own = parent(key)
        content = parent(own) if name_of(own) == RAW_FOLDER else own
        directory = parent(content) if name_of(content).startswith(UPLOAD) else content
        if name_of(key) == RECEIPT:
            receipts[directory] = key
            continue
        sizes[key] = size
        folders.setdefault(directory, {}).setdefault(content, []).append(key)

    chosen: dict[tuple[str, str], tuple[bool, Bucket]] = {}
    for directory in sorted(folders):
        bucket_id = name_of(directory) if directory else root_name
        if bucket_id.startswith(DISABLED):
            continue
        told: list[dict | None] = []

        def receipt(directory: str = directory, told: list = told) -> dict | None:
            if not told:
                told.append(_receipt(read, receipts.get(directory)))
            return told[0]

        copies = {folder: keys for folder, keys in folders[directory].items() if journal_keys(keys)}
        if not copies:
            continue
        keys = journal_keys(copies[_chosen_copy(copies, receipt)])
        newest = oldest = None
        replica = primary = False
        if found := CLASSIC.fullmatch(bucket_id):
            newest, oldest, replica = int(found[2]), int(found[3]), found[1] == "rb"
            primary = not replica
            identity = f"{found[4]}_{found[5]}" if found[5] else directory
        elif found := REMOTE.fullmatch(bucket_id):
            identity = f"{found[1]}_{found[2]}"
        else:
            identity = directory
        if newest is None and (ranges or earliest is not None or latest is not None):
            newest, oldest = receipt_range(receipt())
        name = index or index_of(directory, root_name, index_pattern)
        bucket = Bucket(name, bucket_id, directory, keys, newest, oldest, sum(max(0, sizes[k]) for k in keys))
        if not bucket.overlaps(earliest, latest):
            continue
        held = chosen.get((name, identity))
        if held is None or held[0] and primary:
            chosen[name, identity] = replica, bucket
    return sorted((b for _, b in chosen.values()), key=lambda b: (-(b.newest if b.newest is not None else -1), b.directory))


@dataclass
class Bounds:
    """What predicates above the scan allow: time in ms, and index names."""

    earliest_ms: int | None = None
    latest_ms: int | None = None
    indexes: frozenset[str] | None = None

    def at_least(self, ms: int) -> None:
        self.earliest_ms = ms if self.earliest_ms is None else max(self.earliest_ms, ms)

    def at_most(self, ms: int) -> None:
        self.latest_ms = ms if self.latest_ms is None else min(self.latest_ms, ms)

    def one_of(self, names: Iterable[str]) -> None:
        names = frozenset(names)
        self.indexes = names if self.indexes is None else self.indexes & names

    @property
    def prunes_time(self) -> bool:
        return self.earliest_ms is not None or self.latest_ms is not None

    def keeps(self, bucket: Bucket) -> bool:
        """False only if no event of the bucket can satisfy the predicates."""
        if self.indexes is not None and bucket.index not in self.indexes:
            return False
        if self.earliest_ms is not None and bucket.newest is not None and (bucket.newest + 1) * 1000 <= self.earliest_ms:
            return False
        return not (self.latest_ms is not None and bucket.oldest is not None and bucket.oldest * 1000 > self.latest_ms)
