"""Event journals: a byte-code stream with string tables, decoded in order.

Opcodes, each at a record boundary (fixed values of the format):

    0        padding
    1, 2     event, old style;  32-43  event
    3-6      a string for the table of hosts, sources, sourcetypes, strings
    9        private block: length, bytes
    10       header: 2 bytes, base index time
    11       slice hash: 32 bytes
    17-31    state: bit 8 host, 4 source, 2 sourcetype, 1 base event time

The decoder works on a buffer with index arithmetic. A record that runs past
the buffer is tried again after more chunks have come; its effects take place
only once it is complete.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

MAX_LENGTH = 256 << 20
_TOP = 1 << 63
# How many integers follow a metadata key, by its type.
VALUE_COUNTS = (1, 0, 1, 2, 2, 0, 2, 3, 1, 1, 1, 2, 3, 0, 2, 0)
PREFIXES = (b"host::", b"source::", b"sourcetype::", b"")


class CorruptJournal(ValueError):
    """Bytes that no journal has, or a journal that ends inside a record."""


class Event(NamedTuple):
    time_ms: int
    index_time: int
    host: bytes
    source: bytes
    sourcetype: bytes
    raw: bytes
    fields: list[tuple[bytes, bytes]]


def subsecond_micros(raw: int) -> int:
    """Microseconds of a sub-second code.

    The lowest set bit ends a run of zero bits, one per leading zero digit; the
    bits above are the digits as a number.
    """
    if not raw:
        return 0
    zeros = (raw & -raw).bit_length() - 1
    digits = raw >> zeros >> 1
    places = zeros + len(str(digits)) if digits else 0
    return digits * 10 ** (6 - places) if places <= 6 else digits // 10 ** (places - 6)


class _More(Exception):
    """The record runs past the buffer."""


class JournalDecoder:
    """Iterates events. ``position`` is the offset of the record in work.

    Without ``decode_fields`` metadata is walked but not kept, and without
    ``decode_raw`` as well, raw bytes are not copied. Damage is noticed alike.
    """

    def __init__(self, chunks: Iterator[bytes], decode_fields: bool = True, decode_raw: bool = True):
        self._chunks, self._want = iter(chunks), decode_fields
        self._skip = not decode_fields and not decode_raw
        self._buffer, self._start = b"", 0
        self._at = 0
        self.tables: tuple[list[bytes], ...] = ([], [], [], [])
        self._active = [b"", b"", b""]
        self._base_time = self._base_index = 0

    @property
    def position(self) -> int:
        return self._start + self._at

    def _grow(self) -> bool:
        """Drop what is decoded, add at least as much as is left."""
        left = self._buffer[self._at :]
        parts, size = [left], 0
        while size <= len(left):
            chunk = next(self._chunks, None)
            if chunk is None:
                break
            parts.append(chunk)
            size += len(chunk)
        self._start += self._at
        self._buffer, self._at = b"".join(parts), 0
        return size > 0

    def _varint(self, at: int) -> tuple[int, int]:
        buffer = self._buffer
        byte = buffer[at]
        if byte < 128:
            return byte, at + 1
        value, shift = byte & 127, 7
        for i in range(1, 10):
            byte = buffer[at + i]
            value |= (byte & 127) << shift
            if byte < 128:
                return value & 0xFFFFFFFFFFFFFFFF, at + i + 1
            shift += 7
        raise CorruptJournal(f"integer of more than 10 bytes at offset {self._start + at}")

    def _length(self, at: int, most: int = MAX_LENGTH) -> tuple[int, int]:
        value, after = self._varint(at)
        if value > most:
            raise CorruptJournal(f"length {value} at offset {self._start + at}")
        return value, after

    def _need(self, end: int) -> None:
        if end > len(self._buffer):
            raise IndexError

    def _i32(self, at: int) -> int:
        self._need(at + 4)
        return int.from_bytes(self._buffer[at : at + 4], "little", signed=True)

    def __iter__(self) -> Iterator[Event]:
        varint = self._varint
        while True:
            buffer, at, end = self._buffer, self._at, len(self._buffer)
            try:
                while at < end:
                    code = buffer[at]
                    if 32 <= code <= 43 or code == 1 or code == 2:
                        event, self._at = self._event(code, at + 1)
                        at = self._at
                        yield event
                        continue
                    if code == 0:
                        at += 1
                    elif 17 <= code <= 31:
                        at = self._state(code, at + 1)
                    elif 3 <= code <= 6:
                        size, after = self._length(at + 1)
                        self._need(after + size)
                        self.tables[code - 3].append(buffer[after : after + size].removeprefix(PREFIXES[code - 3]))
                        at = after + size
                    elif code == 9:
                        size, after = varint(at + 1)
                        if size >= _TOP:
                            raise CorruptJournal(f"length {size} at offset {self._start + at}")
                        self._need(after + size)
                        at = after + size
                    elif code == 10:
                        self._base_index = self._i32(at + 3)
                        at += 7
                    elif code == 11:
                        self._need(at + 33)
                        at += 33
                    else:
                        raise CorruptJournal(f"unknown opcode {code} at offset {self._start + at}")
                    self._at = at
            except IndexError:
                pass
            if not self._grow():
                if self._at < len(self._buffer):
                    raise CorruptJournal(f"the journal stops inside a record, after byte {self._start + len(self._buffer)}")
                return

    def _state(self, code: int, at: int) -> int:
        active, base = list(self._active), self._base_time
        for which, bit in enumerate((8, 4, 2)):
            if code & bit:
                number, at = self._varint(at)
                active[which] = self._entry(which, number)
        if code & 1:
            base = self._i32(at)
            at += 4
        self._active, self._base_time = active, base
        return at

    def _entry(self, table: int, number: int) -> bytes:
        """An entry by its number from 1; any other number is the empty text."""
        held = self.tables[table]
        return held[number - 1] if 1 <= number <= len(held) else b""

    def _event(self, code: int, at: int) -> tuple[Event, int]:
        varint, buffer, begin = self._varint, self._buffer, at - 1
        size, at = self._length(at)
        end = at + size
        if end > len(buffer):
            raise IndexError
        extension = 0
        if code & 4:
            extension, at = self._length(at, _TOP - 1)
        at += 8 if code & 1 else 28
        # Integers of one byte, nearly all, are read in place.
        at = at + 1 if buffer[at] < 128 else varint(at)[1]
        at = at + 1 if buffer[at] < 128 else varint(at)[1]
        delta = buffer[at]
        if delta < 128:
            at += 1
        else:
            delta, at = varint(at)
            delta = ((delta & 0xFFFFFFFF) ^ 0x80000000) - 0x80000000
        fraction, at = varint(at)
        host, source, sourcetype = self._active
        time_ms = self._base_time * 1000 + (subsecond_micros(fraction) // 1000 if fraction else 0)
        count = buffer[at]
        if count < 128:
            at += 1
        else:
            count, at = varint(at)
        if count > size:
            raise CorruptJournal(f"{count} metadata entries at offset {self._start + begin}")
        fields: list[tuple[bytes, bytes]] = []
        slices: list[tuple[int, bytes, int, int]] | None = None
        strings, want, old = self.tables[3], self._want, code <= 2
        known = len(strings)
        shift = 2 if 32 <= code <= 35 else 0
        for _ in range(count):
            key = buffer[at]
            if key < 128:
                at += 1
            else:
                key, at = varint(at)
            if old:
                kind, number = 0, key >> 1
            else:
                if shift:
                    key = key << shift & 0xFFFFFFFFFFFFFFFF
                kind, number = key & 15, key >> 4
            values = VALUE_COUNTS[kind]
            first = second = 0
            if values:
                first = buffer[at]
                if first < 128:
                    at += 1
                else:
                    first, at = varint(at)
                if values > 1:
                    second, at = varint(at)
                    if values > 2:
                        at = varint(at)[1]
            if not want or not 1 <= number <= known:
                continue
            if kind == 0:
                if 1 <= first <= known:
                    fields.append((strings[number - 1], strings[first - 1]))
            elif kind == 8:
                fields.append((strings[number - 1], b"%d" % first))
            elif kind == 9:
                fields.append((strings[number - 1], b"-%d" % first if first else b"0"))
            elif kind == 4:
                if slices is None:
                    slices = []
                slices.append((len(fields), strings[number - 1], first, second))
                fields.append((strings[number - 1], b""))
        at += extension
        if at > end:
            raise CorruptJournal(f"an event at offset {self._start + begin} is shorter than its own header")
        raw = b"" if self._skip else buffer[at:end]
        if slices:
            for place, name, length, offset in slices:
                if offset + length <= len(raw):
                    fields[place] = (name, raw[offset : offset + length])
        return Event(time_ms, self._base_index + delta, host, source, sourcetype, raw, fields), end
