"""Streams of JSON messages made from the event table; each equals its batch answer."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.plans.load import load_reports, loaded_rows
from rowfold.plans.replay import replay
from rowfold.plans.state import LoadStore
from rowfold.registry import query, table
from rowfold.registry.loads import load_buckets
from rowfold.session import new_work_dir
from rowfold.sinks.messages import publish_files
from rowfold.sources.messages import read_text_messages
from rowfold.sources.records import read_records, record_ranges
from rowfold.streaming.messages import (
    REPEATED,
    count_and_sample,
    count_to_table,
    counted_total,
    dedup_load_stream,
    distinct_stream,
    distinct_within,
    fate_counts,
    fates,
    finish,
    latest_count,
    matching,
    parse_messages,
    result_table,
    sampled_rows,
    state_store,
    to_memory,
    to_table,
)


def _width(spark) -> int:
    """Files written at a time: as many as the cluster has cores."""
    return max(4, spark.sparkContext.defaultParallelism)


def _event_messages(spark, sf_dir, columns, batches=2):
    """The schema of the chosen event columns, and a stream of all events as messages, taken in about ``batches``."""
    events = table(spark, sf_dir, "events")
    path = f"{new_work_dir(spark, 'messages')}/events"
    files = _width(spark)
    publish_files(events, path, "overwrite", files)
    return events.select(*columns).schema, read_text_messages(spark, path, -(-files // batches))


@query("stream_count", "SELECT count(*) AS total_records FROM events WHERE lower(trim(event_type)) = 'click'")
def stream_count(spark, sf_dir):
    out = new_work_dir(spark, "stream-count")
    schema, messages = _event_messages(spark, sf_dir, ["event_type"])
    rows = matching(messages, schema, "event_type", "Click")
    finish(count_to_table(rows, f"{out}/count", f"{out}/checkpoint"))
    return latest_count(spark, f"{out}/count")


@query(
    "stream_filter",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'purchase'",
)
def stream_filter(spark, sf_dir):
    out = new_work_dir(spark, "stream-filter")
    schema, messages = _event_messages(spark, sf_dir, ["event_id", "user_id", "event_type", "value"])
    rows = matching(messages, schema, "event_type", "purchase", exact=True)
    finish(to_table(rows, f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.schema(schema).parquet(f"{out}/rows")


@query("stream_distinct_sample", "SELECT DISTINCT user_id FROM events WHERE lower(trim(event_type)) = 'click'")
def stream_distinct_sample(spark, sf_dir):
    out = new_work_dir(spark, "stream-distinct")
    schema, messages = _event_messages(spark, sf_dir, ["user_id", "event_type"])
    rows = distinct_stream(matching(messages, schema, "event_type", "click"), ["user_id"])
    finish(to_table(rows, f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.schema(schema).parquet(f"{out}/rows").select("user_id")


@query(
    "stream_count_and_sample",
    """SELECT DISTINCT user_id, (SELECT count(*) FROM events WHERE event_type = 'view') AS total_records
       FROM events WHERE event_type = 'view'""",
)
def stream_count_and_sample(spark, sf_dir):
    out = new_work_dir(spark, "stream-both")
    schema, messages = _event_messages(spark, sf_dir, ["user_id", "event_type"])
    rows = matching(messages, schema, "event_type", "view")
    finish(count_and_sample(rows, ["user_id"], ["user_id", "event_type"], f"{out}/rows", f"{out}/checkpoint"))
    users = sampled_rows(spark, f"{out}/rows", schema, ["user_id"]).select("user_id")
    total = counted_total(spark, f"{out}/rows").first()[0]
    return users.withColumn("total_records", F.lit(total).cast("bigint"))


@query("stream_replay", "SELECT * FROM orders")
def stream_replay(spark, sf_dir):
    out = new_work_dir(spark, "stream-replay")
    orders = table(spark, sf_dir, "orders")
    finish(to_table(replay(orders, f"{out}/messages", _width(spark)), f"{out}/rows", f"{out}/checkpoint"))
    return spark.read.schema(orders.schema).parquet(f"{out}/rows")


@query(
    "stream_dedup_load",
    """WITH pairs AS (SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events))
       SELECT count(*) AS rows, n AS unique_records, count(*) - n AS duplicate_records FROM events, pairs GROUP BY n""",
)
def stream_dedup_load(spark, sf_dir):
    """The (user, type) pairs of all events, over several micro-batches."""
    out = new_work_dir(spark, "stream-load")
    schema, messages = _event_messages(spark, sf_dir, ["event_id", "user_id", "event_type"])
    rows = parse_messages(messages, schema)
    store = LoadStore(f"{out}/store", load_buckets(spark))
    finish(
        dedup_load_stream(
            rows, store, f"{out}/checkpoint", ["event_id"], columns=["user_id", "event_type"], chunk_size=1000
        )
    )
    return load_reports(spark, store).agg(
        F.sum("rows").alias("rows"),
        F.sum("new").alias("unique_records"),
        F.sum(F.col("in_chunk") + F.col("hash_dedup") + F.col("already")).alias("duplicate_records"),
    )


@query(
    "two_stream_load",
    """WITH pairs AS (SELECT DISTINCT user_id, event_type FROM events)
       SELECT CAST(1 AS BIGINT) AS load_of, count(*) AS stored FROM pairs WHERE event_type = 'click'
       UNION ALL SELECT 2, count(*) FROM pairs WHERE event_type <> 'click'""",
)
def two_stream_load(spark, sf_dir):
    """Pairs of user and type of clicks, then of all other events, as two streams into one store.

    Both number their batches from 0.
    """
    out = new_work_dir(spark, "two-streams")
    store = LoadStore(f"{out}/store", load_buckets(spark))
    events, ends = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), [0]
    clicks = F.col("event_type") == "click"
    for number, part in enumerate((events.filter(clicks), events.filter(~clicks))):
        rows = replay(part, f"{out}/messages-{number}", _width(spark))
        finish(dedup_load_stream(rows, store, f"{out}/checkpoint-{number}", ["event_id"], columns=["user_id", "event_type"]))
        ends.append(load_reports(spark, store).agg(F.max("load")).first()[0])
    stored = loaded_rows(spark, store, events.select("user_id", "event_type").schema)
    own = F.when(F.col("load") <= ends[1], F.lit(1)).otherwise(F.lit(2)).cast("bigint")
    return stored.groupBy(own.alias("load_of")).agg(F.count("*").alias("stored"))


@query(
    "stream_dedup_watermark",
    """SELECT count(*) AS events, count(DISTINCT user_id) AS users, true AS all_accounted_for, true AS some_came_again
       FROM events""",
)
def stream_dedup_watermark(spark, sf_dir):
    """Users of a day, by events published in the order of their time, over several micro-batches."""
    out = new_work_dir(spark, "stream-watermark")
    events = table(spark, sf_dir, "events").select("user_id", "ts")
    files = _width(spark)
    seconds = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(seconds, [0.25, 0.5, 0.75], 1000)).first()[0]
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = events if low is None else events.filter(seconds > low)
        publish_files(part if high is None else part.filter(seconds <= high), f"{out}/messages", num_files=files)
    # a quarter of the time in each micro-batch
    rows = parse_messages(read_text_messages(spark, f"{out}/messages", files), events.schema)
    with state_store(spark):
        finish(distinct_within(rows, ["user_id"], "ts", "1 day", f"{out}/result", f"{out}/checkpoint"))
    written = fates(spark, f"{out}/result", T.StructType([events.schema["user_id"]])).filter(F.col("_fate") != REPEATED)
    users = written.agg(F.countDistinct("user_id").alias("users"), F.count("*").alias("written"))
    # two rows of totals
    return fate_counts(spark, f"{out}/result").crossJoin(users).select(
        F.col("rows").alias("events"),
        "users",
        (F.col("written") + F.col("repeated") == F.col("rows")).alias("all_accounted_for"),
        (F.col("kept") > F.col("users")).alias("some_came_again"),
    )


@query("rows_published", "SELECT count(*) AS published, count(*) AS received FROM orders")
def rows_published(spark, sf_dir):
    """What publishing reports, and what arrives."""
    path = f"{new_work_dir(spark, 'published')}/orders"
    published = publish_files(table(spark, sf_dir, "orders"), path, "overwrite")
    return spark.read.text(path).agg(F.lit(published).alias("published"), F.count("*").alias("received"))


@query(
    "stream_since",
    "SELECT 'after' AS part, count(*) AS rows FROM orders WHERE o_orderstatus <> 'F'",
)
def stream_since(spark, sf_dir):
    """Only messages of files written since a moment between two publications."""
    out = new_work_dir(spark, "stream-since")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    finished = F.col("o_orderstatus") == "F"
    publish_files(orders.filter(finished), f"{out}/messages", "append")
    written = spark.read.format("text").load(f"{out}/messages").select("_metadata.file_modification_time")
    # file times are in whole seconds on some file systems
    time.sleep(1.1)
    since = written.agg((F.max("file_modification_time") + F.expr("INTERVAL 1 SECOND")).cast("string")).first()[0]
    publish_files(orders.filter(~finished), f"{out}/messages", "append")
    rows = parse_messages(read_text_messages(spark, f"{out}/messages", since=since), orders.schema)
    finish(to_table(rows, f"{out}/rows", f"{out}/checkpoint"))
    got = spark.read.schema(orders.schema).parquet(f"{out}/rows")
    return got.agg(F.count("*").alias("rows")).select(F.lit("after").alias("part"), "rows")


@query("stream_named_result", "SELECT count(*) AS total_records FROM events WHERE event_type = 'purchase'")
def stream_named_result(spark, sf_dir):
    """A running count under a name of its own, asked by SQL."""
    schema, messages = _event_messages(spark, sf_dir, ["event_type"])
    rows = matching(messages, schema, "event_type", "purchase")
    name = f"purchases_{uuid.uuid4().hex}"
    finish(to_memory(rows.agg(F.count("*").alias("total_records")), name, "complete"))
    return result_table(spark, name)


@query("stream_continuous", "SELECT event_id, user_id FROM events WHERE event_type = 'view'")
def stream_continuous(spark, sf_dir):
    """A stream that runs on until it is stopped, here when all that was published has been taken."""
    out = new_work_dir(spark, "stream-continuous")
    schema, messages = _event_messages(spark, sf_dir, ["event_id", "user_id", "event_type"])
    rows = matching(messages, schema, "event_type", "view", exact=True).select("event_id", "user_id")
    running = to_table(rows, f"{out}/rows", f"{out}/checkpoint", continuous="1 second")
    running.processAllAvailable()
    running.stop()
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")


ADMITTED = 3_000


@query(
    "stream_by_records",
    f"""SELECT event_id, user_id, CAST(ceil((SELECT count(*) FROM events) / {ADMITTED}.0) AS BIGINT) AS batches, true AS none_too_large
       FROM events""",
)
def stream_by_records(spark, sf_dir):
    """All events, at most so many records in a micro-batch whatever the files; stopped and gone on with on the way.

    Streams side by side share the messages by whole micro-batches; each is stopped and gone on with.
    """
    out = new_work_dir(spark, "stream-records")
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    publish_files(events, f"{out}/messages", "overwrite", 3)
    schema = T.StructType([*events.schema.fields, T.StructField("stream", T.LongType()), T.StructField("batch", T.LongType())])

    def start(stream: int, starting: str, until: str | None):
        def keep(batch, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/rows/stream={stream}/batch={number}")

        rows = parse_messages(read_records(spark, f"{out}/messages", ADMITTED, starting, until=until), events.schema)
        return rows.writeStream.foreachBatch(keep).option("checkpointLocation", f"{out}/checkpoint-{stream}").trigger(processingTime="0 seconds").start()

    for runs in ("first", "second"):
        ranges = record_ranges(spark, f"{out}/messages", f"{out}/ranges", ADMITTED)
        streams = [start(k, *ends) for k, ends in enumerate(ranges)]
        try:
            for running in streams:
                if runs == "first":
                    while running.isActive and not (running.lastProgress and running.lastProgress.batchId >= 1):
                        time.sleep(0.1)
                else:
                    running.processAllAvailable()
                running.stop()
                if running.exception() is not None:
                    raise running.exception()
        finally:
            for running in streams:
                running.stop()
    held = spark.read.schema(schema).parquet(f"{out}/rows")
    sizes = held.groupBy("stream", "batch").agg(F.count("*").alias("n")).agg(F.count("*").alias("batches"), F.max("n").alias("most"))
    # one row of totals
    return held.crossJoin(sizes).select("event_id", "user_id", "batches", (F.col("most") <= ADMITTED).alias("none_too_large"))
