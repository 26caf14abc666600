import os

import pytest
from differential import DIR, rows_of

from coldtide import fixtures
from coldtide.plans import edge_queries  # noqa: F401
from coldtide.plans.queries import ORACLES, QUERIES
from coldtide.sources import options
from coldtide.sources.bucket_source import grouped, split_target
from coldtide.sources.discovery import Bucket
from coldtide.sources.journal import JournalDecoder
from coldtide.sources.streams import chunks

#: Queries of FINDINGS_r02.md, whose trees the driver built from all rows.
FOUND = [
    "batch_bounds", "bare_field_names", "buckets_read", "catalog_life", "codec_gzip", "codec_lz4", "codec_lz4_legacy", "dataset_layering", "disabled_skip", "codec_none", "codec_zstd", "dissect_extract",
    "field_cache", "field_missing_null", "field_negative", "field_multivalue", "field_unsigned", "field_string", "field_slice", "earliest_latest_window", "flat_layout", "index_from_path", "index_override", "index_pattern",
]


@pytest.fixture
def fresh(monkeypatch, tmp_path):
    """A shared folder without trees."""
    monkeypatch.setattr(fixtures, "shared_folder", lambda spark: tmp_path.as_uri())


@pytest.fixture
def few_rows(spark, monkeypatch):
    """The driver may hold few rows."""
    kind = type(spark.range(0))
    collect = kind.collect

    def checked(self):
        rows = collect(self)
        assert len(rows) < 20
        return rows

    def refused(self):
        raise AssertionError("all rows come to the driver")

    monkeypatch.setattr(kind, "toPandas", refused)
    monkeypatch.setattr(kind, "collect", checked)


@pytest.mark.parametrize("name", [*FOUND, "journal_extras", "large_messages"])
def test_the_driver_holds_no_table(spark, fresh, few_rows, tmp_path, name):
    import duckdb

    out = str(tmp_path / "out")
    QUERIES[name](spark, DIR).write.parquet(out)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in ("events", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    assert rows_of(con.execute(f"SELECT * FROM '{out}/*.parquet'").df()) == rows_of(con.execute(ORACLES[name]).df())


def files(root):
    return {os.path.relpath(os.path.join(d, n), root): open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(root) for n in names}


def test_executors_write_the_tree_of_one_process(spark, fresh, tmp_path):
    frame = spark.read.parquet(f"{DIR}/events.parquet").selectExpr("event_id", "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', ts) as us", "user_id", "event_type", "value", "props")
    fixtures.build_events([tuple(r) for r in frame.toLocalIterator()], str(tmp_path / "whole"))
    got, want = files(fixtures.tree(spark, DIR)), files(str(tmp_path / "whole"))
    assert len(want) > 20 and got == want


def test_strings_that_a_writer_forgets(monkeypatch):
    monkeypatch.setattr(fixtures, "REMEMBERED", 3)
    monkeypatch.setattr(fixtures, "PART", 100)
    rows = [(i, (1_000 + i) * 1_000_000, i % 7, "click", float(i % 5), '{"k": %d}' % i) for i in range(300)]
    parts = list(fixtures.events_journal(iter(rows)))
    assert len(parts) > 100
    events = list(JournalDecoder(iter(parts)))
    assert [dict(e.fields)[b"value"] for e in events] == [repr(r[4]).encode() for r in rows]
    assert [e.host for e in events] == [b"host%d" % r[2] for r in rows]


@pytest.mark.parametrize("codec", fixtures.CODECS)
def test_journals_of_several_parts(tmp_path, monkeypatch, codec):
    monkeypatch.setattr(fixtures, "PART", 1_000)
    data = bytes(range(256)) * 100 + os.urandom(5_000)
    fixtures.put(str(tmp_path), "journal", fixtures.compressed(data, codec))
    assert b"".join(chunks(lambda key: open(tmp_path / key, "rb"), ("journal",))) == data
    assert os.listdir(tmp_path) == ["journal"]


def test_batch_bounds_is_read_by_many_tasks(spark, fresh, monkeypatch):
    seen = []
    monkeypatch.setattr(edge_queries, "attempts", lambda spark, cases, run=edge_queries.attempts: seen.append(cases) or run(spark, cases))
    QUERIES["batch_bounds"](spark, DIR)
    per_case = {name: [c[2]["part"] for c in seen[0] if c[0] == name] for name in ("default", "by bytes", "small")}
    assert per_case["default"] == [0]
    assert per_case["small"] == per_case["by bytes"] == list(range(15))


def test_no_core_is_left_without_a_split():
    parsed = options.parse("file:///a", {"min_splits": "6"})
    buckets = [Bucket("i", str(n), str(n), (), None, None, 3 << 20) for n in range(15)]
    assert len(grouped(buckets, split_target(parsed, buckets))) >= 6
    assert len(grouped(buckets[:1], split_target(parsed, buckets[:1]))) == 1
    assert split_target(options.parse("file:///a", {}), buckets) == 64 << 20
    assert split_target(options.parse("file:///a", {"min_splits": "6", "split_bytes": "1"}), buckets) == 1
