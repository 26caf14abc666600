import pytest

from coldtide.functions.timeparse import epoch_seconds, parse_millis
from coldtide.sources import options as o


@pytest.mark.parametrize("text,ms", [
    ("1704067207", 1704067207000), ("1704067207.179", 1704067207179), ("1704067207.0005", 1704067207001), ("1704067207179", 1704067207179),
    ("1704067207179.9", 1704067207179), ("12345678901", 12345678901000), (" 5 ", 5000), ("\x01 7\t", 7000),
    ("2024-01-01T00:00:07Z", 1704067207000), ("2024-01-01 00:00:07.179+0000", 1704067207179), ("2024-01-01T00:00+05:30", 1704047400000),
    ("2024-01-01t00:00:07z", 1704067207000), ("2024-01-01T00:00:07.123456789", 1704067207123), ("2024-01-01T24:00", 1704153600000),
    ("2024-02-30T00:00", 1709164800000), ("2023-02-31 12:00:00-0130", 1677591000000),
    ("", None), ("   ", None), (None, None), ("2024-01-01", None), ("-5", None), ("abc", None), ("1e5", None), ("2024-13-01T00:00", None),
    ("2024-01-01T25:00", None), ("2024-01-01T24:01", None), ("2024-01-32T00:00", None), ("٣", None), (b"7", 7000), (b"\xff", None),
])
def test_parse_millis(text, ms):
    assert parse_millis(text) == ms


def test_epoch_seconds():
    assert epoch_seconds("earliest", 5.9) == 5 and epoch_seconds("earliest", "-1") == -1
    assert epoch_seconds("earliest", "2024-01-01T00:00:07Z") == 1704067207 and epoch_seconds("earliest", " ") is None
    for bad in ("2024-01-01T00:00:07", "yesterday", "1.5"):
        with pytest.raises(ValueError, match="earliest"):
            epoch_seconds("earliest", bad)


def test_locations():
    assert o.parse_location("splunkfs:///a/b")[1:] == (None, "/a/b")
    assert o.parse_location("splunks3://bucket/a/b/") == ("splunks3", "bucket", "a/b")
    assert o.parse("s3://bucket", {}).root_name == "bucket" and o.parse("file:///a/b/", {}).root_name == "b"
    for bad in ("splunkfs://host/a", "splunks3:///a", "SPLUNKFS:///a", "http://x"):
        with pytest.raises(o.SettingError):
            o.parse_location(bad)
    assert o.can_handle("splunkfs:///a") and not o.can_handle("Splunkfs:///a")


def test_defaults_and_coercion():
    s = o.parse("s3://b/p", {"path_style": " TRUE ", "region": " ", "connect_timeout_ms": "7", "format": "anything"})
    assert (s.region, s.endpoint, s.path_style, s.connect_timeout_ms, s.request_timeout_ms) == ("us-east-1", "https://s3.us-east-1.amazonaws.com", True, 7, 300_000)
    assert o.parse("s3://b", {"endpoint": "http://x:1"}).path_style and not o.parse("s3://b", {}).path_style
    assert o.parse("s3://b", {"region": "eu-1"}).endpoint == "https://s3.eu-1.amazonaws.com"
    assert o.parse("file:///a", {"earliest": -1}).earliest == -1


@pytest.mark.parametrize("value,want", [
    (None, (True, ())), ("AUTO", (True, ())), ("none", (False, ())), ("none, x", (False, ("x",))), ("auto,splunk.fields.x,x,y", (True, ("x", "y"))), ("a,b", (False, ("a", "b"))),
])
def test_fields(value, want):
    assert o.parse_fields(value) == want


def test_layering_and_validation():
    merged = o.layered({"_datasource": {"index": "a", "region": "r"}, "index": "b", "_other": 1})
    assert merged == {"index": "b", "region": "r"}
    assert o.validate_source({"nope": 1, "worse": 2, "region": "x"}) == ["unknown setting [nope]", "unknown setting [worse]"]
    assert o.validate_dataset({}, "http://x", {"nope": 1}) == ["unsupported resource [http://x]", "unknown setting [nope]"]
    assert "capture group" in o.validate_dataset({}, "file:///a", {"index_pattern": "x"})[0]
    assert o.validate_dataset({}, "file:///a", {"index_pattern": "(x", })[0].startswith("[index_pattern]")
    assert o.for_workers({"_datasource": {"region": "r"}, "index": "i", "junk": 1}, "file:///a") == {"region": "r", "index": "i", "location": "file:///a"}
    with pytest.raises(o.SettingError, match="unknown setting"):
        o.parse("file:///a", {"nope": 1})
    with pytest.raises(o.SettingError, match="after"):
        o.parse("file:///a", {"earliest": 5, "latest": 4})
    assert "hidden" not in repr(o.parse("s3://b", {"access_key": "a", "secret_key": "hidden"}))


def test_timestamp_kinds():
    kind = lambda x: o.parse("file:///a", {"timestamp_field": x}).timestamp_kind
    assert [kind(x) for x in ("_time", "@timestamp", "splunk.time", "_indextime", "splunk.index_time", "splunk.fields.f", "f")] == ["event"] * 3 + ["index"] * 2 + ["f"] * 2
