"""Settings of data sources and datasets: parsing, defaults, layering."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import unquote, urlsplit

from coldtide.functions.timeparse import epoch_seconds

# The location schemes, setting names and time field names that
# existing datasets use.
FILE_SCHEMES = ("splunkfs", "file")
OBJECT_SCHEMES = ("splunks3", "s3")
SOURCE_KEYS = ("region", "endpoint", "path_style", "access_key", "secret_key", "session_token", "earliest", "latest", "index", "index_pattern", "fields", "timestamp_field", "connect_timeout_ms", "request_timeout_ms", "format")
EVENT_TIME_NAMES = ("_time", "@timestamp", "splunk.time")
INDEX_TIME_NAMES = ("_indextime", "splunk.index_time")
FIELD_PREFIX = "splunk.fields."
ENVELOPE = "_datasource"

#: Settings of this engine alone.
OWN_KEYS = ("path", "location", "resource", "layout", "columns", "limit_per_split", "batch_rows", "batch_bytes", "split_bytes", "min_splits", "pushdown")


class SettingError(ValueError):
    """A setting or location that cannot be used."""


def can_handle(location: str) -> bool:
    """Whether the location has one of the schemes, in lower case."""
    return location.startswith(tuple(f"{s}://" for s in FILE_SCHEMES + OBJECT_SCHEMES))


def layered(settings: Mapping[str, Any]) -> dict[str, Any]:
    """Dataset settings over those of their data source."""
    below = settings.get(ENVELOPE) or {}
    own = {k: v for k, v in settings.items() if not k.startswith("_")}
    return {**{k: v for k, v in below.items() if not k.startswith("_")}, **own}


def _text(settings: Mapping[str, Any], key: str) -> str | None:
    value = settings.get(key)
    value = None if value is None else str(value)
    return value if value and value.strip() else None


def _flag(settings: Mapping[str, Any], key: str, default: bool) -> bool:
    value = settings.get(key)
    if value is None or (isinstance(value, str) and not value.strip()):
        return default
    return value if isinstance(value, bool) else str(value).strip().lower() == "true"


def _whole(settings: Mapping[str, Any], key: str, default: int | None) -> int | None:
    value = settings.get(key)
    if value is None or (isinstance(value, str) and not value.strip()):
        return default
    try:
        return int(value) if isinstance(value, (int, float)) else int(str(value).strip())
    except ValueError:
        raise SettingError(f"[{key}] must be a whole number, got [{value}]") from None


@dataclass(frozen=True)
class Settings:
    """A dataset's checked settings."""

    location: str
    scheme: str
    bucket: str | None
    root: str
    region: str = "us-east-1"
    endpoint: str | None = None
    path_style: bool = False
    access_key: str | None = field(default=None, repr=False)
    secret_key: str | None = field(default=None, repr=False)
    session_token: str | None = field(default=None, repr=False)
    earliest: int | None = None
    latest: int | None = None
    index: str | None = None
    index_pattern: str | None = None
    discover_fields: bool = True
    fields: tuple[str, ...] = ()
    timestamp_field: str = "_time"
    connect_timeout_ms: int = 5_000
    request_timeout_ms: int = 300_000
    layout: str = "nested"
    columns: tuple[str, ...] | None = None
    limit_per_split: int | None = None
    batch_rows: int = 1_000
    batch_bytes: int = 8 << 20
    split_bytes: int = 64 << 20
    min_splits: int = 1
    pushdown: bool = True

    @property
    def is_object_store(self) -> bool:
        return self.scheme in OBJECT_SCHEMES

    @property
    def root_name(self) -> str:
        """Last segment of the root, the store's bucket name at its top."""
        parts = [p for p in self.root.split("/") if p]
        return parts[-1] if parts else (self.bucket or "")

    @property
    def timestamp_kind(self) -> str:
        """``event``, ``index``, or the indexed field that times come from."""
        if self.timestamp_field in EVENT_TIME_NAMES:
            return "event"
        if self.timestamp_field in INDEX_TIME_NAMES:
            return "index"
        return self.timestamp_field.removeprefix(FIELD_PREFIX)


def parse_location(location: str) -> tuple[str, str | None, str]:
    """(scheme, bucket, root path) of a location."""
    if not can_handle(location):
        if location.startswith("/"):
            return "file", None, location
        raise SettingError(f"unsupported location [{location}]; expected one of {', '.join(s + '://' for s in FILE_SCHEMES + OBJECT_SCHEMES)}")
    parts = urlsplit(location)
    if parts.scheme in FILE_SCHEMES:
        if parts.netloc:
            raise SettingError(f"[{location}] must not have a host; use {parts.scheme}:///absolute/path")
        if not parts.path.startswith("/"):
            raise SettingError(f"[{location}] must hold an absolute path")
        return parts.scheme, None, unquote(parts.path)
    if not parts.netloc:
        raise SettingError(f"[{location}] must name a bucket")
    return parts.scheme, parts.netloc, unquote(parts.path).strip("/")


def parse_fields(value: Any) -> tuple[bool, tuple[str, ...]]:
    """(discover, names) of the ``fields`` setting."""
    text = "auto" if value is None or not str(value).strip() else str(value)
    discover, names = False, []
    for token in (t.strip() for t in text.split(",")):
        if token.lower() == "auto":
            discover = True
        elif token and token.lower() != "none":
            name = token.removeprefix(FIELD_PREFIX)
            if name and name not in names:
                names.append(name)
    return discover, tuple(names)


def check_known(settings: Mapping[str, Any], own: bool = True) -> list[str]:
    """One message per key that is not a setting."""
    known = set(SOURCE_KEYS) | (set(OWN_KEYS) if own else set())
    return [f"unknown setting [{k}]" for k in settings if k not in known and not k.startswith("_")]


def parse(location: str, settings: Mapping[str, Any]) -> Settings:
    """Check everything a dataset is given; no input or output happens here."""
    merged = layered(settings)
    if unknown := check_known(merged):
        raise SettingError("; ".join(unknown))
    scheme, bucket, root = parse_location(location)
    region = _text(merged, "region") or "us-east-1"
    endpoint = _text(merged, "endpoint")
    pattern = _text(merged, "index_pattern")
    if pattern is not None:
        try:
            compiled = re.compile(pattern)
        except re.error as bad:
            raise SettingError(f"[index_pattern] is not a regular expression: {bad}") from None
        if not compiled.groups:
            raise SettingError(f"[index_pattern] needs a capture group, got [{pattern}]")
    try:
        earliest, latest = epoch_seconds("earliest", merged.get("earliest")), epoch_seconds("latest", merged.get("latest"))
    except ValueError as bad:
        raise SettingError(str(bad)) from None
    if earliest is not None and latest is not None and earliest > latest:
        raise SettingError(f"[earliest] {earliest} is after [latest] {latest}")
    discover, names = parse_fields(merged.get("fields"))
    layout = (_text(merged, "layout") or "nested").lower()
    if layout not in ("nested", "flat"):
        raise SettingError(f"[layout] must be nested or flat, got [{layout}]")
    columns = _text(merged, "columns")
    access, secret = _text(merged, "access_key"), _text(merged, "secret_key")
    if access and not secret:
        raise SettingError("[access_key] needs [secret_key]")
    limit = _whole(merged, "limit_per_split", None)
    return Settings(
        location=location, scheme=scheme, bucket=bucket, root=root, region=region,
        endpoint=endpoint or (f"https://s3.{region}.amazonaws.com" if scheme in OBJECT_SCHEMES else None),
        path_style=_flag(merged, "path_style", endpoint is not None),
        access_key=access, secret_key=secret, session_token=_text(merged, "session_token"),
        earliest=earliest, latest=latest, index=_text(merged, "index"), index_pattern=pattern,
        discover_fields=discover, fields=names, timestamp_field=_text(merged, "timestamp_field") or "_time",
        connect_timeout_ms=_whole(merged, "connect_timeout_ms", 5_000), request_timeout_ms=_whole(merged, "request_timeout_ms", 300_000),
        layout=layout, columns=tuple(c.strip() for c in columns.split(",") if c.strip()) if columns else None,
        limit_per_split=None if limit is None or limit < 0 else limit,
        batch_rows=_whole(merged, "batch_rows", 1_000), batch_bytes=_whole(merged, "batch_bytes", 8 << 20),
        split_bytes=_whole(merged, "split_bytes", 64 << 20), min_splits=_whole(merged, "min_splits", 1), pushdown=_flag(merged, "pushdown", True),
    )


def validate_source(settings: Mapping[str, Any]) -> list[str]:
    """Errors of a data source's settings: unknown keys only."""
    return check_known(settings, own=False)


def validate_dataset(source: Mapping[str, Any], resource: str, settings: Mapping[str, Any]) -> list[str]:
    """Errors of a dataset: scheme, unknown keys, then its own settings."""
    errors = [] if can_handle(resource) else [f"unsupported resource [{resource}]"]
    errors += check_known(settings)
    if not errors:
        try:
            parse(resource, {k: v for k, v in settings.items() if not k.startswith("_")})
        except SettingError as bad:
            errors.append(str(bad))
    return errors


def for_workers(settings: Mapping[str, Any], location: str) -> dict[str, Any]:
    """The settings that executors need, and no other key."""
    merged = layered(settings)
    return {**{k: merged[k] for k in (*SOURCE_KEYS, *OWN_KEYS) if k in merged}, "location": location}
