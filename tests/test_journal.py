import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coldtide.fixtures import JournalWriter, subsecond_code, varint
from coldtide.sources.journal import VALUE_COUNTS, CorruptJournal, JournalDecoder, subsecond_micros

GOLDEN = bytes.fromhex(
    "0a010080009265030b686f73743a3a77656230310416736f757263653a3a2f7661722f6c6f672f612e6c6f67050f736f75726365747970653a3a6163630604757365720602616c06047a6f6e65"
    "1f0101018700926529210000000000000000000005eff51503100214040439f001474554202f7820323030291200000000000000000000fdffffff0f2c006200"
)


def decoded(data, **kw):
    return list(JournalDecoder([data] if isinstance(data, bytes) else data, **kw))


def test_golden_journal():
    first, second = decoded(GOLDEN)
    assert (first.time_ms, first.index_time) == (1704067207179, 1704067205)
    assert (first.host, first.source, first.sourcetype) == (b"web01", b"/var/log/a.log", b"acc")
    assert first.raw == b"GET /x 200"
    assert first.fields == [(b"user", b"al"), (b"user", b"/x 2"), (b"zone", b"-240")]
    assert (second.time_ms, second.index_time, second.raw, second.fields) == (1704067207005, 1704067197, b"b", [])


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_records_straddle_chunks(size):
    assert decoded(GOLDEN[i : i + size] for i in range(0, len(GOLDEN), size)) == decoded(GOLDEN)


def test_every_cut_ends_at_a_record_or_raises():
    whole = decoded(GOLDEN)
    clean = 0
    for n in range(len(GOLDEN)):
        try:
            got = decoded(GOLDEN[:n])
        except CorruptJournal as bad:
            assert f"after byte {n}" in str(bad)
        else:
            clean += 1
            assert got == whole[: len(got)]
    assert clean == 11  # empty, and the end of each record but the last byte's


@pytest.mark.parametrize("code,micros", [(241, 120000), (44, 5000), (359151, 179575), (20436, 2554), (8, 0), (11, 500000), (96, 1), (246913579, 123456), (0, 0)])
def test_subseconds(code, micros):
    assert subsecond_micros(code) == micros


@given(st.text("0123456789", min_size=1, max_size=6))
def test_subsecond_round_trip(digits):
    assert subsecond_micros(subsecond_code(digits)) == int(digits.ljust(6, "0"))


@pytest.mark.parametrize("code", [7, 8, 12, 13, 14, 15, 16, 44, 128, 255])
def test_unknown_opcodes(code):
    with pytest.raises(CorruptJournal, match=f"unknown opcode {code} at offset 7"):
        decoded(GOLDEN[:7] + bytes([code]))


def test_less_is_decoded_when_less_is_asked():
    bare = decoded(GOLDEN, decode_fields=False)
    assert [e[:6] for e in bare] == [e[:6] for e in decoded(GOLDEN)] and not any(e.fields for e in bare)
    times = decoded(GOLDEN, decode_fields=False, decode_raw=False)
    assert [e[:5] for e in times] == [e[:5] for e in decoded(GOLDEN)] and not any(e.raw for e in times)


def test_skipped_records():
    hashed, private = bytes([11]) + bytes(range(32)), bytes([9]) + varint(300) + bytes(300)
    assert decoded(GOLDEN[:7] + hashed + private + bytes(5) + GOLDEN[7:]) == decoded(GOLDEN)


@pytest.mark.parametrize("opcode", range(36, 44))
def test_event_opcodes(opcode):
    w = JournalWriter(100)
    w.event(200, "5", 103, b"h", b"s", b"t", b"raw", [(b"a", 0, b"x"), (b"n", 8, 7), (b"m", 9, 0), (b"p", 4, (2, 1))], opcode)
    (event,) = decoded(bytes(w.out))
    assert event.fields == [(b"a", b"x"), (b"n", b"7"), (b"m", b"0"), (b"p", b"aw")] and event.raw == b"raw"


@pytest.mark.parametrize("opcode", range(32, 36))
def test_shifted_keys(opcode):
    w = JournalWriter(0)
    w.event(1, "", 1, b"h", b"s", b"t", b"raw", [(b"a", 0, b"x"), (b"n", 8, 300)], opcode)
    assert decoded(bytes(w.out))[0].fields == [(b"a", b"x"), (b"n", b"300")]


@pytest.mark.parametrize("kind", range(16))
def test_every_metadata_type_consumes_its_values(kind):
    entry = varint(1 << 4 | kind) + b"".join(varint(1) for _ in range(VALUE_COUNTS[kind]))
    body = bytes(8) + varint(0) * 4 + varint(2) + entry + varint(1 << 4) + varint(2) + b"raw"
    data = bytes([6, 1]) + b"k" + bytes([6, 1]) + b"v" + bytes([41]) + varint(len(body)) + body
    (event,) = decoded(data)
    assert event.raw == b"raw" and event.fields[-1] == (b"k", b"v")
    assert len(event.fields) == (2 if kind in (0, 4, 8, 9) else 1)


def test_slices_and_references_out_of_range():
    w = JournalWriter(0)
    w.event(1, "", 1, b"h", b"s", b"t", b"abc", [(b"k", 4, (9, 0)), (b"k", 4, (1, 2))])
    assert decoded(bytes(w.out))[0].fields == [(b"k", b""), (b"k", b"c")]
    body = bytes(8) + varint(0) * 4 + varint(3) + varint(0) + varint(1) + varint(9 << 4) + varint(1) + varint(1 << 4) + varint(9) + b"x"
    assert decoded(bytes([6, 1]) + b"k" + bytes([41]) + varint(len(body)) + body)[0].fields == []


def test_old_events_have_plain_keys():
    body = bytes(20) + bytes(8) + varint(0) * 4 + varint(1) + varint(1 << 1) + varint(2) + b"old"
    data = bytes([6, 1]) + b"k" + bytes([6, 1]) + b"v" + bytes([2]) + varint(len(body)) + body
    assert decoded(data)[0][5:] == (b"old", [(b"k", b"v")])


def test_state_without_strings_is_empty_text():
    body = bytes(8) + varint(0) * 5 + b"x"
    (event,) = decoded(bytes([28]) + varint(0) + varint(99) + bytes([41]) + varint(len(body)) + body)
    assert (event.host, event.source, event.sourcetype) == (b"", b"", b"")


def test_times_before_1970_and_negative_delta():
    w = JournalWriter(-50)
    w.event(-100, "25", -53, b"h", b"s", b"t", b"x")
    assert decoded(bytes(w.out))[0][:2] == (-99750, -53)


def test_limits():
    with pytest.raises(CorruptJournal, match="length"):
        decoded(bytes([6]) + varint((256 << 20) + 1))
    with pytest.raises(CorruptJournal, match="more than 10 bytes"):
        decoded(bytes([6]) + b"\xff" * 11)
    with pytest.raises(CorruptJournal, match="shorter than its own header"):
        decoded(bytes([41]) + varint(9) + bytes(40))


FIELD = st.one_of(st.tuples(st.sampled_from([b"a", b"bb", b"\xff"]), st.just(0), st.binary(max_size=9)), st.tuples(st.just(b"n"), st.sampled_from([8, 9]), st.integers(0, 2**64 - 1)))
EVENT = st.tuples(st.integers(-(2**31), 2**31 - 1), st.text("0123456789", max_size=6), st.integers(-1000, 1000), st.binary(max_size=5), st.binary(max_size=5), st.binary(max_size=5), st.binary(max_size=40), st.lists(FIELD, max_size=4), st.sampled_from(range(36, 44)))


@settings(max_examples=60, deadline=None)
@given(st.lists(EVENT, max_size=6), st.integers(1, 50))
def test_round_trip(events, chunk):
    w = JournalWriter(0)
    for e in events:
        w.event(*e)
    data = bytes(w.out)
    got = decoded(data[i : i + chunk] for i in range(0, len(data), chunk))
    assert len(got) == len(events)
    for event, (seconds, digits, index_time, host, source, sourcetype, raw, fields, _) in zip(got, events):
        assert event.time_ms == seconds * 1000 + int(digits.ljust(6, "0")) // 1000
        assert (event.index_time, event.raw) == (index_time, raw)
        assert (event.host, event.source, event.sourcetype) == (host, source, sourcetype)
        want = [(n, v if k == 0 else str(v).encode() if k == 8 else (b"-%d" % v if v else b"0")) for n, k, v in fields]
        assert event.fields == want
