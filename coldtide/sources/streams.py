"""Stored journal objects to one stream of decompressed chunks.

The codec is told by the first bytes of the first object, never by its name.
Slices are joined before decompression.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa

CHUNK = 256 << 10
# Magic numbers of the containers.
GZIP = b"\x1f\x8b"
ZSTD = bytes.fromhex("28b52ffd")
LZ4_FRAME = bytes.fromhex("04224d18")
LZ4_LEGACY = bytes.fromhex("02214c18")
LEGACY_BLOCK = 8 << 20


class StreamError(ValueError):
    """A journal object that its codec cannot read."""


class Joined:
    """Objects read one after the other, each opened when its turn comes."""

    def __init__(self, opener: Callable[[str], BinaryIO], keys: tuple[str, ...]):
        self._opener, self._left, self._now = opener, list(keys), None
        self._held = b""
        self.closed = False

    def _next(self, size: int) -> bytes:
        while True:
            if self._now is None:
                if not self._left:
                    return b""
                self._now = self._opener(self._left.pop(0))
            if data := self._now.read(size):
                return data
            self._now.close()
            self._now = None

    def peek(self, size: int) -> bytes:
        while len(self._held) < size and (more := self._next(size - len(self._held))):
            self._held += more
        return self._held[:size]

    def read(self, size: int = -1) -> bytes:
        if size < 0:
            return b"".join(iter(lambda: self.read(CHUNK), b""))
        if self._held:
            out, self._held = self._held[:size], self._held[size:]
            return out
        return self._next(size)

    def exactly(self, size: int) -> bytes:
        parts, left = [], size
        while left and (data := self.read(left)):
            parts.append(data)
            left -= len(data)
        return b"".join(parts)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return False

    def writable(self) -> bool:
        return False

    def close(self) -> None:
        if self._now is not None:
            self._now.close()
        self._now, self._left, self.closed = None, [], True


def sniff(head: bytes) -> str:
    """Codec of a journal by its first four bytes."""
    if head[:2] == GZIP:
        return "gzip"
    return {ZSTD: "zstd", LZ4_FRAME: "lz4", LZ4_LEGACY: "lz4_legacy"}.get(head[:4], "none")


def chunks(opener: Callable[[str], BinaryIO], keys: tuple[str, ...]) -> Iterator[bytes]:
    """Decompressed chunks of a bucket's journal."""
    source = Joined(opener, keys)
    try:
        codec = sniff(source.peek(4))
        if codec == "none":
            yield from iter(lambda: source.read(CHUNK), b"")
        elif codec == "gzip":
            yield from _gzip(source)
        elif codec == "lz4_legacy":
            yield from _lz4_legacy(source)
        else:
            yield from _arrow(source, codec)
    finally:
        source.close()


def _gzip(source: Joined) -> Iterator[bytes]:
    """Members one after the other; what follows the last is not looked at."""
    data = source.read(CHUNK)
    while True:
        while len(data) < 2 and (more := source.read(CHUNK)):
            data += more
        if data[:2] != GZIP:
            return
        member = zlib.decompressobj(31)
        while not member.eof:
            if not data and not (data := source.read(CHUNK)):
                raise StreamError("gzip member is cut off")
            try:
                out = member.decompress(data, CHUNK)
            except zlib.error as bad:
                raise StreamError(f"gzip member is damaged: {bad}") from bad
            data = member.unconsumed_tail or member.unused_data
            if out:
                yield out


def _arrow(source: Joined, codec: str) -> Iterator[bytes]:
    """Frames, one or many, by Arrow's readers, which notice a cut."""
    try:
        with pa.CompressedInputStream(pa.PythonFile(source, "r"), codec) as stream:
            while data := stream.read(CHUNK):
                yield data
    except (OSError, pa.ArrowException) as bad:
        raise StreamError(f"{codec} frame is damaged or cut off: {bad}") from bad


def _lz4_legacy(source: Joined) -> Iterator[bytes]:
    """Blocks of at most 8 MiB until the end; a repeated magic starts a frame."""
    raw = pa.Codec("lz4_raw")
    source.exactly(4)
    while head := source.exactly(4):
        if head == LZ4_LEGACY:
            continue
        if len(head) < 4:
            raise StreamError("LZ4 block header is cut off")
        size = int.from_bytes(head, "little")
        if size > LEGACY_BLOCK + LEGACY_BLOCK // 255 + 16:
            raise StreamError(f"LZ4 block of {size} bytes is too large")
        block = source.exactly(size)
        if len(block) < size:
            raise StreamError("LZ4 block is cut off")
        plain = block_size(block)
        if plain > LEGACY_BLOCK:
            raise StreamError(f"LZ4 block holds {plain} bytes")
        if plain:
            try:
                yield raw.decompress(block, plain, asbytes=True)
            except (OSError, pa.ArrowException) as bad:
                raise StreamError(f"LZ4 block is damaged: {bad}") from bad


def block_size(block: bytes) -> int:
    """Decompressed size of a raw LZ4 block, by walking its sequences."""
    at, total, end = 0, 0, len(block)
    try:
        while at < end:
            token = block[at]
            at += 1
            size = token >> 4
            if size == 15:
                while (more := block[at]) == 255:
                    size += 255
                    at += 1
                size += more
                at += 1
            at += size
            total += size
            if at >= end:
                break
            at += 2
            size = token & 15
            if size == 15:
                while (more := block[at]) == 255:
                    size += 255
                    at += 1
                size += more
                at += 1
            total += size + 4
    except IndexError:
        raise StreamError("LZ4 block is cut off") from None
    if at != end:
        raise StreamError("LZ4 block is damaged")
    return total
