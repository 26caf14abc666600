"""The query catalogue: each reads a bucket tree through the data source.

Trees are built once from the ``events`` (or ``documents``) table; see
``coldtide.fixtures``. Times are compared as epoch milliseconds.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldtide import fixtures
from coldtide.functions.extract import dissect, grok
from coldtide.functions.timeparse import parse_event_time
from coldtide.operators.fields import exact_fields
from coldtide.plans.catalog import Catalog, read
from coldtide.sources.schema import nested_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: What a reader of the tree sees, from the table that it was built from.
SEEN = """
WITH seen AS (
  SELECT event_id, user_id, event_type, value, props, epoch_us(ts) // 1000 AS time_ms,
    CAST(epoch_us(ts) // 1000000 + event_id % 11 - 5 AS BIGINT) AS index_time,
    CASE WHEN event_type IN ('click', 'view') THEN 'web' WHEN event_type IN ('signup', 'error') THEN 'auth' ELSE 'sales' END AS index_name,
    'host' || (user_id % 10) AS host,
    CASE WHEN user_id % 2 = 0 THEN '/var/log/' || event_type || '.log' ELSE 'tcp:514' END AS source,
    CASE WHEN user_id % 2 = 0 THEN '/var/log/' || event_type || '.log' END AS file_path,
    (epoch_us(ts) // 86400000000 - 19723) // 7 AS week
  FROM events)
"""
DAY = 86_400
START = fixtures.FIRST_DAY * DAY
#: A window inside the table's range, in seconds.
LOW, HIGH = START + 5 * DAY + 3_601, START + 12 * DAY + 7_199


def events(spark: SparkSession, sf_dir: str, below: str = "", **settings) -> DataFrame:
    return read(spark, "file://" + fixtures.tree(spark, sf_dir) + below, **settings)


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = (SEEN if "seen" in sql else "") + sql
        return function

    return add


def one(name: str) -> F.Column:
    """First value of an indexed field."""
    return F.get(F.col("splunk.fields")[name], F.lit(0))


def event_id() -> F.Column:
    return one("event_id").cast("bigint").alias("event_id")


@query("SELECT host, CAST(count(*) AS BIGINT) AS events FROM seen WHERE event_type = 'click' GROUP BY host")
def stats_by_host(spark, sf_dir):
    events(spark, sf_dir, columns="host.name,splunk.sourcetype").createOrReplaceTempView("archive")
    return spark.sql("FROM archive |> WHERE splunk.sourcetype = 'click' |> AGGREGATE count(*) AS events GROUP BY host.name |> SELECT name AS host, events")


@query("SELECT event_id, time_ms, props AS message, host, file_path, index_name, source, event_type AS sourcetype, index_time FROM seen")
def scan_core(spark, sf_dir):
    return events(spark, sf_dir).select(
        event_id(), F.unix_millis("`@timestamp`").alias("time_ms"), "message", F.col("host.name").alias("host"), F.col("log.file.path").alias("file_path"),
        F.col("splunk.index").alias("index_name"), F.col("splunk.source").alias("source"), F.col("splunk.sourcetype").alias("sourcetype"), F.unix_seconds("splunk.index_time").alias("index_time"),
    )


@query("SELECT event_id, time_ms, CAST(0 AS BIGINT) AS micros FROM seen")
def time_truncation(spark, sf_dir):
    return events(spark, sf_dir).select(event_id(), F.unix_millis("splunk.time").alias("time_ms"), (F.unix_micros("splunk.time") % 1000).alias("micros"))


@query("SELECT event_id, index_time, index_time - time_ms // 1000 AS lag FROM seen")
def index_time_signed(spark, sf_dir):
    at = F.unix_seconds("splunk.index_time")
    return events(spark, sf_dir).select(event_id(), at.alias("index_time"), (at - F.floor(F.unix_millis("splunk.time") / 1000)).alias("lag"))


@query("SELECT CAST(event_id AS VARCHAR) AS text FROM seen")
def field_unsigned(spark, sf_dir):
    return events(spark, sf_dir).select(one("event_id").alias("text"))


@query("SELECT event_id, CASE WHEN user_id = 0 THEN '0' ELSE '-' || user_id END AS text FROM seen")
def field_negative(spark, sf_dir):
    return events(spark, sf_dir).select(event_id(), one("neg_user").alias("text"))


@query("SELECT event_id, value FROM seen")
def field_string(spark, sf_dir):
    return events(spark, sf_dir).select(event_id(), one("value").cast("double").alias("value"))


@query("SELECT event_id, regexp_extract(props, ': (.*)}', 1) AS k FROM seen")
def field_slice(spark, sf_dir):
    return events(spark, sf_dir).select(event_id(), one("k").alias("k"))


@query("SELECT event_id, 0 AS pos, event_type AS tag FROM seen UNION ALL SELECT event_id, 1, 'vip' FROM seen WHERE user_id % 3 = 0")
def field_multivalue(spark, sf_dir):
    return events(spark, sf_dir).select(event_id(), F.posexplode("splunk.fields.tag").alias("pos", "tag"))


@query("SELECT tag, CAST(count(*) AS BIGINT) AS n FROM (SELECT event_type AS tag FROM seen UNION ALL SELECT 'vip' FROM seen WHERE user_id % 3 = 0) GROUP BY tag")
def stats_by_multivalue(spark, sf_dir):
    return events(spark, sf_dir).select(F.explode("splunk.fields.tag").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'yes' END AS rare, CAST(NULL AS VARCHAR) AS never FROM seen")
def field_missing_null(spark, sf_dir):
    return events(spark, sf_dir).select(event_id(), one("rare").alias("rare"), one("never").alias("never"))


@query("SELECT event_id, file_path FROM seen")
def log_file_path(spark, sf_dir):
    return events(spark, sf_dir).select(event_id(), F.col("log.file.path").alias("file_path"))


def _codec(week: int, codec: str) -> None:
    low, high = START + 7 * week * DAY, START + 7 * (week + 1) * DAY - 1

    def run(spark, sf_dir):
        return events(spark, sf_dir, earliest=low, latest=high).groupBy(F.col("splunk.index").alias("index_name")).agg(F.count("*").alias("n"), F.sum(one("event_id").cast("bigint")).alias("ids"), F.sum(F.length("message")).alias("chars"))

    run.__name__ = f"codec_{codec}"
    query(f"SELECT index_name, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(sum(length(props)) AS BIGINT) AS chars FROM seen WHERE week = {week} GROUP BY index_name")(run)


for _week, _name in enumerate(fixtures.CODECS):
    _codec(_week, _name)


@query("SELECT event_id, props AS message FROM seen WHERE index_name = 'sales'")
def smartstore_slices(spark, sf_dir):
    return events(spark, sf_dir).where("splunk.index = 'sales'").select(event_id(), "message")


@query("SELECT event_type AS sourcetype, CAST(count(*) AS BIGINT) AS n FROM seen WHERE index_name = 'sales' GROUP BY event_type")
def receipt_copy(spark, sf_dir):
    return events(spark, sf_dir, below="/sales", index="sales").groupBy(F.col("splunk.sourcetype").alias("sourcetype")).agg(F.count("*").alias("n"))


@query("SELECT event_id, CAST(1 AS BIGINT) AS copies FROM seen WHERE index_name = 'auth'")
def replica_dedup(spark, sf_dir):
    return events(spark, sf_dir).where("splunk.index = 'auth'").groupBy(event_id()).agg(F.count("*").alias("copies"))


@query("SELECT event_id, CAST(1 AS BIGINT) AS copies FROM seen WHERE index_name = 'web'")
def disabled_skip(spark, sf_dir):
    return events(spark, sf_dir).where("splunk.index = 'web'").groupBy(event_id()).agg(F.count("*").alias("copies"))


def _count_by_index(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("splunk.index").alias("index_name")).agg(F.count("*").alias("n"))


@query("SELECT index_name, CAST(count(*) AS BIGINT) AS n FROM seen GROUP BY index_name")
def index_from_path(spark, sf_dir):
    return _count_by_index(events(spark, sf_dir))


@query("SELECT 'one' AS index_name, CAST(count(*) AS BIGINT) AS n FROM seen")
def index_override(spark, sf_dir):
    return _count_by_index(events(spark, sf_dir, index="one"))


@query("SELECT substr(index_name, 1, 2) AS index_name, CAST(count(*) AS BIGINT) AS n FROM seen GROUP BY ALL")
def index_pattern(spark, sf_dir):
    return _count_by_index(events(spark, sf_dir, index_pattern="^([a-z]{2})"))


@query(f"SELECT event_id, time_ms FROM seen WHERE time_ms BETWEEN {LOW}000 AND {HIGH}999")
def earliest_latest_window(spark, sf_dir):
    return events(spark, sf_dir, earliest=LOW, latest=datetime.fromtimestamp(HIGH, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")).select(event_id(), F.unix_millis("`@timestamp`").alias("time_ms"))


@query(f"SELECT event_id FROM seen WHERE time_ms > {LOW}000 AND time_ms <= {HIGH}000")
def prune_time(spark, sf_dir):
    return events(spark, sf_dir).where((F.col("`@timestamp`") > F.timestamp_seconds(F.lit(LOW))) & (F.col("`@timestamp`") <= F.timestamp_seconds(F.lit(HIGH)))).select(event_id())


@query("SELECT event_id FROM seen WHERE index_name = 'auth'")
def prune_index_eq(spark, sf_dir):
    return events(spark, sf_dir).where(F.col("splunk.index") == "auth").select(event_id())


@query("SELECT event_id FROM seen WHERE index_name IN ('auth', 'sales')")
def prune_index_in(spark, sf_dir):
    return events(spark, sf_dir).where(F.col("splunk.index").isin("auth", "sales")).select(event_id())


@query("SELECT event_id FROM seen WHERE index_name = 'auth' OR event_type = 'click'")
def prune_or_ignored(spark, sf_dir):
    return events(spark, sf_dir).where("splunk.index = 'auth' OR splunk.sourcetype = 'click'").select(event_id())


@query("SELECT event_id FROM seen WHERE index_name <> 'web'")
def prune_not_ignored(spark, sf_dir):
    return events(spark, sf_dir).where("splunk.index <> 'web'").select(event_id())


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM seen WHERE index_name = 'nowhere'")
def prune_everything(spark, sf_dir):
    return events(spark, sf_dir).where("splunk.index = 'nowhere'").agg(F.count("*").alias("n"))


@query("SELECT event_id, index_time FROM seen")
def timestamp_field_indextime(spark, sf_dir):
    return events(spark, sf_dir, timestamp_field="_indextime").select(event_id(), F.unix_seconds("`@timestamp`").alias("index_time"))


@query("SELECT event_id, CASE WHEN event_id % 4 < 3 THEN time_ms END AS time_ms FROM seen")
def timestamp_field_field(spark, sf_dir):
    return events(spark, sf_dir, timestamp_field="evt_time").select(event_id(), F.unix_millis("`@timestamp`").alias("time_ms"))


@query("SELECT event_id, CASE WHEN event_id % 4 < 3 THEN time_ms END AS time_ms FROM seen")
def parse_event_time_function(spark, sf_dir):
    return events(spark, sf_dir).select(event_id(), parse_event_time(one("evt_time")).alias("time_ms"))


@query(f"SELECT event_id FROM seen WHERE event_id % 4 < 3 AND time_ms >= {HIGH}000")
def timestamp_field_not_pruned(spark, sf_dir):
    return events(spark, sf_dir, timestamp_field="evt_time").where(F.col("`@timestamp`") >= F.timestamp_seconds(F.lit(HIGH))).select(event_id())


@query("SELECT host, event_type AS sourcetype, CAST(count(*) AS BIGINT) AS n FROM seen GROUP BY ALL")
def projection_subset(spark, sf_dir):
    part = nested_schema(["host.name", "splunk.sourcetype"])
    return events(spark, sf_dir, schema=part).groupBy(F.col("host.name").alias("host"), F.col("splunk.sourcetype").alias("sourcetype")).agg(F.count("*").alias("n"))


@query("SELECT CAST(sum(least(n, 3)) AS BIGINT) AS n FROM (SELECT count(*) AS n FROM seen GROUP BY index_name, week)")
def limit_per_split(spark, sf_dir):
    return events(spark, sf_dir, limit_per_split=3, split_bytes=1).agg(F.count("*").alias("n"))


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT * FROM seen LIMIT 7)")
def limit(spark, sf_dir):
    return events(spark, sf_dir).limit(7).agg(F.count("*").alias("n"))


@query("SELECT index_name, event_type AS sourcetype, CAST(count(*) AS BIGINT) AS n, min(time_ms) AS first_ms, max(time_ms) AS last_ms FROM seen GROUP BY ALL")
def stats_by_index_sourcetype(spark, sf_dir):
    at = F.unix_millis("splunk.time")
    return events(spark, sf_dir).groupBy(F.col("splunk.index").alias("index_name"), F.col("splunk.sourcetype").alias("sourcetype")).agg(F.count("*").alias("n"), F.min(at).alias("first_ms"), F.max(at).alias("last_ms"))


@query(f"SELECT index_name, CAST(count(*) AS BIGINT) AS n FROM seen WHERE time_ms >= {LOW}000 AND time_ms <= {HIGH}000 GROUP BY index_name")
def param_time_range(spark, sf_dir):
    events(spark, sf_dir).createOrReplaceTempView("archive")
    span = {"low": datetime.fromtimestamp(LOW, timezone.utc), "high": datetime.fromtimestamp(HIGH, timezone.utc)}
    return spark.sql("FROM archive |> WHERE `@timestamp` >= :low AND `@timestamp` <= :high |> AGGREGATE count(*) AS n GROUP BY splunk.index AS index_name", args=span)


@query("""SELECT event_id, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k FROM seen""")
def grok_extract(spark, sf_dir):
    return grok(events(spark, sf_dir), "message", r'"%{WORD}": %{INT:k:int}\}').select(event_id(), "k")


@query("""SELECT event_id, 'k' AS name, regexp_extract(props, '"k": (\\d+)', 1) AS number FROM seen""")
def dissect_extract(spark, sf_dir):
    return dissect(events(spark, sf_dir), "message", '{"%{name}": %{number}}').select(event_id(), "name", "number")


@query("SELECT 'kept' AS index_name, CAST(count(*) AS BIGINT) AS n FROM seen WHERE week = 1")
def dataset_layering(spark, sf_dir):
    catalog = Catalog(spark)
    catalog.put_source("cold", {"index": "lost", "earliest": str(START + 7 * DAY)})
    catalog.put_dataset("layered_events", "cold", "file://" + fixtures.tree(spark, sf_dir), {"index": "kept", "latest": str(START + 14 * DAY - 1)})
    return _count_by_index(spark.table("layered_events"))


@query("SELECT event_id, index_name, user_id, [event_type] || CASE WHEN user_id % 3 = 0 THEN ['vip'] ELSE [] END AS tags FROM seen")
def flat_layout(spark, sf_dir):
    df = events(spark, sf_dir, layout="flat", fields="auto")
    return df.select(F.col("`splunk.fields.event_id`")[0].cast("bigint").alias("event_id"), F.col("`splunk.index`").alias("index_name"), (-F.col("`splunk.fields.neg_user`")[0].cast("bigint")).alias("user_id"), F.col("`splunk.fields.tag`").alias("tags"))


@query("SELECT field, CAST(sum(n) AS BIGINT) AS events FROM (SELECT unnest(['event_id', 'neg_user', 'value', 'k', 'tag', 'evt_time']) AS field, count(*) AS n FROM seen GROUP BY field UNION ALL SELECT 'rare', count(*) FROM seen WHERE event_id % 10 = 0) GROUP BY field")
def indexed_fields(spark, sf_dir):
    return exact_fields(events(spark, sf_dir))


@query("SELECT CAST(count(*) AS BIGINT) AS buckets, CAST(sum(n) AS BIGINT) AS n FROM (SELECT count(*) AS n FROM seen GROUP BY index_name, week)")
def buckets_read(spark, sf_dir):
    each = events(spark, sf_dir, columns="splunk.bucket").groupBy("splunk.bucket").agg(F.count("*").alias("n"))
    return each.agg(F.count("*").alias("buckets"), F.sum("n").alias("n"))


@query("SELECT doc_id, md5(text) AS message_md5, 1700000000 + doc_id AS seconds FROM documents WHERE text IS NOT NULL")
def large_messages(spark, sf_dir):
    root = fixtures.tree(spark, sf_dir, "documents")
    return read(spark, "file://" + root).select(one("doc_id").cast("bigint").alias("doc_id"), F.md5("message").alias("message_md5"), F.unix_seconds("splunk.time").alias("seconds"))
