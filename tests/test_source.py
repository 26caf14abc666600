import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coldtide import fixtures
from coldtide.functions.extract import dissect, dissect_regex, grok, grok_regex
from coldtide.operators.fields import sampled_fields
from coldtide.plans.catalog import Catalog, read
from coldtide.sources import options
from coldtide.sources.bucket_source import bounds_of, find_buckets, grouped
from coldtide.sources.storage import FileStore, StoreError, open_store

DAY = 86_400_000_000
TYPES = ("click", "view", "signup", "error", "purchase")


def rows(n=400):
    first = fixtures.FIRST_DAY * DAY
    return [(i, first + i * 29 * DAY // n + i * 1234567 % 1_000_000, i * 7 % 50, TYPES[i % 5], i / 8, '{"k": %d}' % (i % 90)) for i in range(n)]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    path = tmp_path_factory.mktemp("tree") / "archive"
    fixtures.build_events(rows(), str(path))
    return str(path)


def ids(df):
    return sorted(int(r[0]) for r in df.select(F.get(F.col("splunk.fields")["event_id"], F.lit(0))).collect())


def test_all_events_once(spark, root):
    assert ids(read(spark, f"splunkfs://{root}")) == list(range(400))


def test_file_store(root, tmp_path):
    store = FileStore(root)
    assert all(size >= 0 for _, size in store.list())
    with pytest.raises(StoreError, match="outside"):
        store.open("../x")
    with pytest.raises(StoreError, match="is no directory"):
        list(FileStore(root + "/nothing").list())
    deep = tmp_path / "/".join("d" * 40)
    os.makedirs(deep)
    (deep / "journal.gz").write_bytes(b"")
    (tmp_path / "b").mkdir()
    (tmp_path / "b/journal.gz").write_bytes(b"")
    os.symlink(tmp_path / "b", tmp_path / "link")
    assert [k for k, _ in FileStore(str(tmp_path)).list()] == ["b/journal.gz"]


def test_raw_bytes_survive(spark, tmp_path):
    w = fixtures.JournalWriter(0)
    w.event(1, "", 1, b"h\xff", b"C:\\x", b"t", b"\xff\xfe\x00a", [(b"f", 0, b"\x80")])
    fixtures.put(str(tmp_path), "i/b/journal.lz4", bytes(w.out))
    r = read(spark, f"file://{tmp_path}").selectExpr("hex(cast(message as binary)) m", "hex(cast(host.name as binary)) h", "hex(cast(splunk.fields['f'][0] as binary)) f", "log.file.path p", "splunk.index i", "splunk.bucket b").first()
    assert tuple(r) == ("FFFE0061", "68FF", "80", "C:\\x", "i", "b")


def test_plan_keeps_filters_and_prunes(spark, root):
    found = find_buckets(options.parse(f"file://{root}", {}), FileStore(root))
    df = read(spark, f"file://{root}", split_bytes=1)
    assert df.rdd.getNumPartitions() == len(found)
    one = df.where("splunk.index = 'sales'")
    assert one.rdd.getNumPartitions() == sum(b.index == "sales" for b in found) < len(found)
    assert "Filter" in one._jdf.queryExecution().executedPlan().toString()
    assert df.where("splunk.index = 'none'").count() == 0
    assert read(spark, f"file://{root}", pushdown="false").where("splunk.index = 'sales'").count() == 80


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(low=st.integers(-1, 31), span=st.integers(0, 20), index=st.sampled_from(["web", "auth", "sales", None]), strict=st.booleans())
def test_pruning_is_sound(spark, root, low, span, index, strict):
    at = (fixtures.FIRST_DAY + low) * 86_400
    df = read(spark, f"file://{root}")
    lo, hi = F.timestamp_seconds(F.lit(at)), F.timestamp_seconds(F.lit(at + span * 86_400))
    keep = (F.col("`@timestamp`") > lo) & (F.col("splunk.time") < hi) if strict else F.col("`@timestamp`").between(lo, hi)
    if index:
        keep &= F.col("splunk.index") == index
    want = [r[0] for r in rows() if (at * 1000 <= r[1] // 1000 <= (at + span * 86_400) * 1000) and (not index or fixtures.INDEX_OF[r[3]] == index)]
    if strict:
        want = [i for i in want if at * 1000 < rows()[i][1] // 1000 < (at + span * 86_400) * 1000]
    assert ids(df.where(keep)) == want


def test_bounds_ignore_what_they_cannot_use():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, Not

    got = bounds_of([Not(EqualTo(("splunk", "index"), "a")), GreaterThan(("@timestamp",), 5), In(("host", "name"), ("x",))], True)
    assert got.indexes is None and got.earliest_ms is None
    from datetime import datetime, timezone

    moment = datetime(2024, 1, 1, 0, 0, 0, 1500, tzinfo=timezone.utc)
    assert bounds_of([GreaterThan(("@timestamp",), moment)], False).earliest_ms is None
    assert bounds_of([EqualTo(("splunk.time",), moment)], False).earliest_ms == 1704067200001
    assert bounds_of([EqualTo(("splunk.time",), moment)], False).latest_ms == 1704067200002


def test_grouping_keeps_order_and_all(root):
    found = find_buckets(options.parse(f"file://{root}", {}), FileStore(root))
    for target in (1, 3000, 1 << 40):
        assert [b for p in grouped(found, target) for b in p.buckets] == found
    assert len(grouped(found, 1 << 40)) == 1


def test_flat_layout_and_sampling(spark, root):
    df = read(spark, f"file://{root}", layout="flat", fields="extra,auto")
    assert df.columns[:11] == ["@timestamp", "message", "host.name", "log.file.path", "splunk.index", "splunk.host", "splunk.source", "splunk.sourcetype", "splunk.time", "splunk.index_time", "splunk.bucket"]
    assert df.columns[11:] == ["splunk.fields." + x for x in ("extra", "event_id", "evt_time", "k", "neg_user", "rare", "tag", "value")]
    assert df.where("`splunk.fields.rare` is not null").count() == 40 and df.where("`splunk.fields.extra` is null").count() == 400
    assert read(spark, f"file://{root}", layout="flat", fields="none").columns[-1] == "splunk.bucket"
    settings_ = options.parse(f"file://{root}", {})
    assert sampled_fields(open_store(settings_), find_buckets(settings_, open_store(settings_)))[0] == "event_id"


def test_projection_reads_only_what_is_asked(spark, root):
    df = read(spark, f"file://{root}", columns="message,splunk.index,host.name,tag")
    assert df.schema.simpleString() == "struct<message:string,host:struct<name:string>,splunk:struct<index:string,fields:map<string,array<string>>>>"
    assert read(spark, f"file://{root}", columns="splunk.bucket", layout="flat").count() == 400


def test_failures_name_the_bucket(spark, tmp_path):
    fixtures.put(str(tmp_path), "web/db/db_2_1_3_g/rawdata/journal", bytes([7]))
    with pytest.raises(Exception, match=r"failed decoding bucket \[web/db_2_1_3_g\].*offset 0: unknown opcode 7"):
        read(spark, f"file://{tmp_path}").count()
    os.makedirs(tmp_path / "empty")
    with pytest.raises(Exception, match="holds no bucket"):
        read(spark, f"file://{tmp_path}/empty").count()
    assert read(spark, f"file://{tmp_path}/empty", earliest=5).count() == 0


def test_catalog(spark, root):
    c = Catalog(spark)
    with pytest.raises(options.SettingError, match=r"\[a\].*\[b\]"):
        c.put_source("s", {"a": 1, "b": 2})
    c.put_source("s", {"index": "x"})
    c.put_dataset("d", "s", f"file://{root}")
    assert [tuple(r) for r in spark.sql("SELECT splunk.index, count(*) FROM d GROUP BY 1").collect()] == [("x", 400)]
    c.put_source("s", {"index": "y"})
    assert spark.table("d").select("splunk.index").first()[0] == "y"
    with pytest.raises(options.SettingError, match="used by d"):
        c.drop_source("s")
    with pytest.raises(options.SettingError, match="unknown data source"):
        c.put_dataset("e", "missing", f"file://{root}")
    c.drop_dataset("d")
    c.drop_source("s")
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW v USING coldbucket OPTIONS (path 'splunkfs://{root}', index 'z')")
    assert spark.sql("SELECT count(*) FROM v WHERE splunk.index = 'z'").first()[0] == 400


def test_stream_of_new_buckets(spark, tmp_path):
    root, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    early = [r for r in rows(60) if r[1] // DAY - fixtures.FIRST_DAY < 14]
    fixtures.build_events(early, root)
    read(spark, f"file://{root}").count()

    def run():
        q = spark.readStream.format("coldbucket").option("columns", "message,splunk.index,splunk.bucket").load(f"file://{root}").writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.read.parquet(out).count()

    assert run() == len(early)
    fixtures.build_events(rows(60)[len(early) :], root)
    assert run() == 60
    assert run() == 60


def test_grok(spark):
    df = spark.createDataFrame([("55.3.244.1 GET /index.html?x 15824 0.043",), ("nothing",), (None,)], "message string")
    got = grok(df, "message", "%{IP:client} %{WORD:method} %{URIPATHPARAM:request} %{INT:bytes:int} %{NUMBER:duration:double}").drop("message").collect()
    assert [tuple(r) for r in got] == [("55.3.244.1", "GET", "/index.html?x", 15824, 0.043), (None,) * 5, (None,) * 5]
    assert grok(df, "message", "(GET|PUT) %{NOTSPACE:what}").select("what").first()[0] == "/index.html?x"
    assert grok(df, "message", "%{MINE:m}", {"MINE": r"[a-z]+\.html"}).select("m").first()[0] == "index.html"
    assert grok_regex("%{TIMESTAMP_ISO8601:t} %{GREEDYDATA}")[1] == [("t", "string")]
    for bad in ("%{NOPE:x}", "%{INT:x:date}"):
        with pytest.raises(ValueError):
            grok_regex(bad)


def test_dissect(spark):
    df = spark.createDataFrame([("a - b   c|d",), ("x",), (None,)], "message string")
    got = dissect(df, "message", "%{one} - %{two->} %{?skip}|%{+one}", append_separator="/").drop("message").collect()
    assert [tuple(r) for r in got] == [("a/d", "b"), (None, None), (None, None)]
    with pytest.raises(ValueError):
        dissect_regex("no keys")
