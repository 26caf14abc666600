import io

import pytest

from coldtide.fixtures import CODECS, compressed
from coldtide.sources.streams import StreamError, block_size, chunks, sniff

DATA = b"".join(b"line %d of some text that repeats, repeats and repeats\n" % i for i in range(3000))


def read(parts):
    held = {str(i): p for i, p in enumerate(parts)}
    return b"".join(chunks(lambda k: io.BytesIO(held[k]), tuple(held)))


@pytest.mark.parametrize("codec", CODECS)
@pytest.mark.parametrize("slices", [1, 2, 9])
def test_codecs_whole_and_sliced(codec, slices):
    data = compressed(DATA, codec)
    assert sniff(data[:4]) == codec
    step = -(-len(data) // slices)
    assert read([data[i : i + step] for i in range(0, len(data), step)]) == DATA


@pytest.mark.parametrize("codec", CODECS)
def test_empty_slices_between(codec):
    data = compressed(DATA, codec)
    assert read([data[:1], b"", data[1:3], b"", data[3:]]) == DATA


def test_nothing_at_all():
    assert read([b""]) == b"" and read([]) == b""


@pytest.mark.parametrize("codec", ["gzip", "zstd", "lz4", "lz4_legacy"])
def test_truncation_raises(codec):
    data = compressed(DATA, codec)
    for cut in (len(data) - 1, len(data) - 5, len(data) // 2 + 3):
        if codec == "gzip" and data[cut - 1 : cut + 1] == b"\x1f\x8b":
            continue
        with pytest.raises(StreamError):
            read([data[:cut]])


def test_gzip_ignores_what_follows():
    assert read([compressed(DATA, "gzip") + b"trailing junk"]) == DATA


def test_gzip_checks_content():
    data = bytearray(compressed(DATA, "gzip"))
    data[-6] ^= 1
    with pytest.raises(StreamError):
        read([bytes(data)])


def test_legacy_repeated_magic_and_sizes():
    data = compressed(DATA, "lz4_legacy")
    assert read([data + data]) == DATA + DATA
    block = data[8:]
    assert block_size(block[: int.from_bytes(data[4:8], "little")]) == min(len(DATA), 1 << 20)


def test_codec_is_told_by_content():
    assert sniff(b"\x00\x01") == "none" and sniff(b"\x1f\x8b") == "gzip" and sniff(b"") == "none"
