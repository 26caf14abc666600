"""Stores that hold bucket trees: a file system and S3-compatible services."""

from __future__ import annotations

import hashlib
import hmac
import http.client
import io
import os
import stat
import time
import xml.etree.ElementTree as ElementTree
from collections.abc import Iterator
from datetime import datetime, timezone
from typing import BinaryIO
from urllib.parse import quote, urlsplit

from coldtide.sources.options import Settings

# Names of the files that buckets are made of.
RECEIPT = "receipt.json"
RAW_FOLDER = "rawdata"
LOOSE = ("journal.gz", "journal.zst", "journal.lz4")
#: Deepest level that a file system is listed to.
DEPTH = 32
PAGE_KEYS = 1000
TRIES = 4


class StoreError(OSError):
    """A store that cannot be listed or read."""


def interesting(key: str) -> bool:
    """Whether a key can be part of a bucket: receipts, journals, slices."""
    parts = key.split("/")
    name = parts[-1]
    if name == RECEIPT or name in LOOSE:
        return True
    if len(parts) > 1 and parts[-2] == RAW_FOLDER:
        return name.startswith("journal") or (name.isascii() and name.isdigit())
    return False


class FileStore:
    """Buckets below a directory of a file system that all executors mount."""

    def __init__(self, root: str):
        self.root = root

    def describe(self) -> str:
        return self.root

    def list(self) -> Iterator[tuple[str, int]]:
        """(key, size) of interesting regular files; links are not followed."""
        if not os.path.isdir(self.root):
            raise StoreError(f"[{self.root}] is no directory that buckets could be in")
        todo = [(self.root, "", 1)]
        while todo:
            folder, prefix, depth = todo.pop()
            with os.scandir(folder) as entries:
                for entry in entries:
                    if entry.is_dir(follow_symlinks=False):
                        if depth < DEPTH:
                            todo.append((entry.path, f"{prefix}{entry.name}/", depth + 1))
                    elif entry.is_file(follow_symlinks=False) and interesting(prefix + entry.name):
                        try:
                            size = entry.stat(follow_symlinks=False).st_size
                        except OSError:
                            size = -1
                        yield prefix + entry.name, size

    def open(self, key: str) -> BinaryIO:
        root = os.path.normpath(self.root)
        path = os.path.normpath(os.path.join(root, key))
        if path != root and not path.startswith(root.rstrip("/") + "/"):
            raise StoreError(f"key [{key}] is outside of [{self.root}]")
        handle = open(path, "rb")
        if not stat.S_ISREG(os.fstat(handle.fileno()).st_mode):
            handle.close()
            raise StoreError(f"key [{key}] is not a regular file")
        return handle


def excerpt(answer: http.client.HTTPResponse) -> str:
    try:
        return answer.read(2048).decode("utf-8", "replace")
    except (OSError, http.client.HTTPException) as lost:
        return f"({lost})"


class Body:
    """What a service sends of an object. A body that ends before its announced
    length, or breaks off, is an error and never a clean end."""

    def __init__(self, answer: http.client.HTTPResponse, name: str):
        self._answer, self._name, self._left = answer, name, answer.length

    def read(self, size: int = -1) -> bytes:
        try:
            data = self._answer.read() if size < 0 else self._answer.read(size)
        except http.client.IncompleteRead as cut:
            raise StoreError(f"[{self._name}] broke off: {cut}") from cut
        except http.client.HTTPException as bad:
            raise StoreError(f"[{self._name}] cannot be read: {bad!r}") from bad
        if self._left is not None:
            self._left -= len(data)
            if self._left > 0 and size != 0 and (size < 0 or not data):
                raise StoreError(f"[{self._name}] broke off {self._left} bytes before its end")
        return data

    def close(self) -> None:
        self._answer.close()

    def __enter__(self) -> Body:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


class ObjectStore:
    """Buckets below a prefix of an S3-compatible service.

    Connection failures and 5xx answers are tried again; others are final.
    """

    def __init__(self, settings: Settings):
        self.settings = settings
        self.prefix = settings.root.strip("/") + "/" if settings.root.strip("/") else ""
        where = urlsplit(settings.endpoint)
        self.secure = where.scheme == "https"
        port = f":{where.port}" if where.port else ""
        self.host = f"{where.hostname}{port}" if settings.path_style else f"{settings.bucket}.{where.hostname}{port}"
        self.base = f"/{settings.bucket}" if settings.path_style else ""

    def describe(self) -> str:
        return f"{self.settings.scheme}://{self.settings.bucket}/{self.prefix}"

    def _request(self, path: str, query: dict[str, str]) -> http.client.HTTPResponse:
        target = encode(path, slash=False)
        text = "&".join(f"{encode(k)}={encode(v)}" for k, v in sorted(query.items()))
        headers = signed_headers(self.settings, self.host, target, text, datetime.now(timezone.utc))
        kind = http.client.HTTPSConnection if self.secure else http.client.HTTPConnection
        for attempt in range(TRIES):
            connection = kind(self.host, timeout=self.settings.connect_timeout_ms / 1000)
            try:
                connection.connect()
                connection.sock.settimeout(self.settings.request_timeout_ms / 1000)
                connection.request("GET", target + ("?" + text if text else ""), headers=headers)
                answer = connection.getresponse()
                if answer.status < 500 or attempt == TRIES - 1:
                    return answer
                answer.close()
            except (OSError, http.client.HTTPException) as lost:
                if attempt == TRIES - 1:
                    raise StoreError(f"cannot reach [{self.host}]: {lost}") from lost
            connection.close()
            time.sleep(0.2 * 2**attempt)
        raise AssertionError

    def list(self) -> Iterator[tuple[str, int]]:
        token = None
        while True:
            query = {"list-type": "2", "max-keys": str(PAGE_KEYS)} | ({"prefix": self.prefix} if self.prefix else {}) | ({"continuation-token": token} if token else {})
            with self._request(self.base + "/", query) as answer:
                if answer.status != 200:
                    raise StoreError(f"listing [{self.describe()}] failed with status {answer.status}: {excerpt(answer)}")
                token = None
                body = Body(answer, self.describe()).read()
            if b"<!DOCTYPE" in body[:1024] or b"<!ENTITY" in body:
                raise StoreError("S3 list holds a document type")
            for _, node in ElementTree.iterparse(io.BytesIO(body)):
                name = node.tag.rpartition("}")[2]
                if name == "Contents":
                    told = {child.tag.rpartition("}")[2]: child.text or "" for child in node}
                    key = told.get("Key", "").removeprefix(self.prefix)
                    if interesting(key):
                        yield key, int(told.get("Size") or -1)
                    node.clear()
                elif name == "NextContinuationToken":
                    token = node.text
            if not token:
                return

    def open(self, key: str) -> BinaryIO:
        answer = self._request(f"{self.base}/{self.prefix}{key}", {})
        if answer.status != 200:
            with answer:
                raise StoreError(f"reading [{key}] failed with status {answer.status}: {excerpt(answer)}")
        return Body(answer, key)


def encode(text: str, slash: bool = True) -> str:
    """RFC 3986 encoding; slashes stay unless ``slash``."""
    return quote(text, safe="-_.~" if slash else "-_.~/")


def signed_headers(settings: Settings, host: str, path: str, query: str, now: datetime) -> dict[str, str]:
    """Headers of a GET, with a version 4 signature if there is an access key."""
    if not settings.access_key:
        return {"Host": host}
    stamp, empty = now.strftime("%Y%m%dT%H%M%SZ"), hashlib.sha256(b"").hexdigest()
    sent = {"host": host, "x-amz-content-sha256": empty, "x-amz-date": stamp}
    if settings.session_token:
        sent["x-amz-security-token"] = settings.session_token
    names = ";".join(sorted(sent))
    canonical = "\n".join(["GET", path, query, *(f"{k}:{sent[k]}" for k in sorted(sent)), "", names, empty])
    scope = f"{stamp[:8]}/{settings.region}/s3/aws4_request"
    text = "\n".join(["AWS4-HMAC-SHA256", stamp, scope, hashlib.sha256(canonical.encode()).hexdigest()])
    key = b"AWS4" + settings.secret_key.encode()
    for part in scope.split("/"):
        key = hmac.new(key, part.encode(), hashlib.sha256).digest()
    signature = hmac.new(key, text.encode(), hashlib.sha256).hexdigest()
    return {**sent, "Authorization": f"AWS4-HMAC-SHA256 Credential={settings.access_key}/{scope}, SignedHeaders={names}, Signature={signature}"}


def open_store(settings: Settings) -> FileStore | ObjectStore:
    return ObjectStore(settings) if settings.is_object_store else FileStore(settings.root)
