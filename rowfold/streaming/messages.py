"""Streams of JSON messages. The transforms are plain DataFrame functions and serve batches too."""

from __future__ import annotations

import contextlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rowfold.functions.hashing import quote
from rowfold.operators.distinct import keep_first, row_count
from rowfold.operators.filters import equals, equals_ignoring_case, present
from rowfold.operators.projection import binary_to_text, flatten, parse_json
from rowfold.plans.load import load_table
from rowfold.plans.state import LoadStore
from rowfold.session import list_names, path_exists, remove_work_dir
from rowfold.sources.files import read_or_empty


def parse_messages(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Binary JSON messages to flat rows; empty messages are dropped."""
    return flatten(present(parse_json(binary_to_text(messages, column), schema)))


def unreadable_messages(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """The texts that do not parse, for a side table."""
    marked = parse_json(binary_to_text(messages, column), schema, corrupt_column="_corrupt")
    return marked.filter(F.col("data._corrupt").isNotNull()).select("json_str")


def matching(
    messages: DataFrame, schema: T.StructType, column: str, value: str, exact: bool = False
) -> DataFrame:
    """Rows of the stream whose column equals a value, by default trimmed and case-blind."""
    rows = parse_messages(messages, schema)
    return equals(rows, column, value) if exact else equals_ignoring_case(rows, column, value)


def distinct_stream(rows: DataFrame, keys: Sequence[str], salts: int = 16) -> DataFrame:
    """One row per key over the whole life of a stream, keeping every key seen.

    Rows of a key first meet per (key, salt), where the salt is the input partition, and only the
    survivors meet per key: a key that holds a third of the stream is spread over ``salts`` tasks.
    """
    salted = rows.withColumn("_salt", F.spark_partition_id() % F.lit(salts))
    return salted.dropDuplicates([*keys, "_salt"]).drop("_salt").dropDuplicates(list(keys))


def _writer(rows: DataFrame, checkpoint: str | None, continuous: str | None):
    writer = rows.writeStream
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    # by default take what is there, in rate-limited batches, and stop
    return writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)


def to_table(rows: DataFrame, path: str, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Append to a Parquet table, each row exactly once."""
    return _writer(rows, checkpoint, continuous).format("parquet").outputMode("append").start(path)


def to_console(rows: DataFrame, checkpoint: str, continuous: str | None = None) -> StreamingQuery:
    """Print every batch; for debugging."""
    writer = _writer(rows, checkpoint, continuous).format("console").outputMode("append")
    return writer.option("truncate", False).start()


def to_memory(rows: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    """In-memory table on the driver, for tests and small results; query it with ``spark.table(name)``."""
    return _writer(rows, None, None).format("memory").queryName(name).outputMode(mode).start()


#: What became of a row of :func:`distinct_within`.
KEPT, LATE, REPEATED = "kept", "late", "repeated"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def state_store(spark: SparkSession, provider: str = ROCKSDB):
    """Start streams with this state store, whatever the session's own."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, provider)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _first_within(columns: Sequence[str], event_time: str, delay_ms: int):
    """The processor of one key, with all it needs, for workers that do not have this package; event times are microseconds."""
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    told = Row(*columns, "_fate", "_rows")

    class FirstWithin(StatefulProcessor):
        """Keeps the first row of a key, until ``delay`` after its event; marks late rows and counts repeated ones."""

        def init(self, handle) -> None:
            self.handle = handle
            self.expires = handle.getValueState("expires", "at long")

        def handleInputRows(self, key, rows, timerValues):
            # no event has been seen before the first watermark
            mark = timerValues.getCurrentWatermarkInMs()
            total, example, first = 0, None, None
            for row in rows:
                at = None if row[event_time] is None else row[event_time] // 1000
                if at is not None and at < mark and mark > 0:
                    yield told(*[row[c] for c in columns], "late", 1)
                    continue
                total += 1
                # the earliest of the batch; rows without a time come last
                time = float("inf") if at is None else at
                if example is None:
                    example = row
                if first is None or time < first[0]:
                    first = (time, row)
            if first is None:
                return
            held = self.expires.get()
            if held is None or held[0] < mark:
                end = (mark if first[0] == float("inf") else first[0]) + delay_ms
                self.expires.update((end,))
                self.handle.registerTimer(max(end, mark) + 1)
                yield told(*[first[1][c] for c in columns], "kept", 1)
                total -= 1
            if total:
                yield told(*[example[c] for c in columns], "repeated", total)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            # the key may have come again since the timer was set
            held = self.expires.get()
            if held is not None and held[0] < timerValues.getCurrentWatermarkInMs():
                self.expires.clear()
            return iter(())

        def close(self) -> None:
            pass

    return FirstWithin()


def distinct_within(
    rows: DataFrame,
    keys: Sequence[str],
    event_time: str,
    delay: str,
    path: str,
    checkpoint: str,
    continuous: str | None = None,
) -> StreamingQuery:
    """Distinct with bounded memory: a key is forgotten ``delay`` (such as ``1 day``) after the event that kept it.

    It may then come again. Live keys are in the engine's state store, each with a timer, so a micro-batch costs as much as its
    own keys; set ``spark.sql.streaming.stateStore.providerClass`` to :data:`ROCKSDB` before (:func:`build_session` does).
    The watermark is the latest event time of the batches before, less the delay. Events before it are late: their key may
    be forgotten already, so they are neither kept nor dropped but written beside. Every micro-batch writes under its number,
    so one that is delivered again replaces what it wrote: :func:`fates` reads ``kept`` and ``late`` rows, and
    :func:`fate_counts` how many rows were kept, late and repeated.

    A key of a micro-batch is handled row by row, without a data frame of its own; only its late rows are held until it is done.
    Checkpoints written when keys were data frames cannot be gone on with.

    Events without a time are never late and expire ``delay`` after the watermark of their batch; a null key is a key.
    """
    spark, keys = rows.sparkSession, list(keys)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB:
        raise ValueError("live keys with timers need the RocksDB state store")
    seconds = spark.sql(f"SELECT unix_seconds(timestamp '1970-01-02 00:00:00' + INTERVAL {delay}) - 86400").first()[0]
    timed = rows.withColumn(event_time, F.col(quote(event_time)).cast("timestamp"))
    # the watermark is kept on a copy that goes no further, so that the engine leaves late rows to the processor
    marked = timed.withColumn("_mark", F.col(quote(event_time))).withWatermark("_mark", delay).select(*[F.col(quote(c)) for c in timed.columns])
    # a time travels as a number, whose way to the processor and back is short
    numbered = marked.withColumn(event_time, F.unix_micros(quote(event_time)))
    columns = numbered.columns
    out = T.StructType([*numbered.schema.fields, T.StructField("_fate", T.StringType()), T.StructField("_rows", T.LongType())])
    grouped = numbered.groupBy(*[F.col(quote(k)) for k in keys])
    told = grouped.transformWithState(_first_within(columns, event_time, seconds * 1000), out, "append", "EventTime")
    told = told.withColumn(event_time, F.timestamp_micros(quote(event_time)))

    def feed(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("_fate").parquet(f"{path}/batch={batch_id}")

    return _writer(told, checkpoint, continuous).foreachBatch(feed).start()


def fates(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows kept or late, with ``batch`` and ``_fate``; of repeated ones an example with the number in ``_rows``."""
    more = [T.StructField("_rows", T.LongType()), T.StructField("batch", T.LongType()), T.StructField("_fate", T.StringType())]
    return read_or_empty(spark, path, T.StructType([*schema.fields, *more]))


def fate_counts(spark: SparkSession, path: str) -> DataFrame:
    """``rows, kept, late, repeated``, in one row."""
    told = fates(spark, path, T.StructType([]))
    of = lambda fate: F.coalesce(F.sum(F.when(F.col("_fate") == fate, F.col("_rows"))), F.lit(0)).alias(fate)
    return told.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), *[of(f) for f in (KEPT, LATE, REPEATED)])


def count_to_table(
    rows: DataFrame, path: str, checkpoint: str, name: str = "total_records", continuous: str | None = None
) -> StreamingQuery:
    """Keep the running row count; :func:`latest_count` reads it.

    Every batch writes a version of its own, and the one before stays, so a reader, or a crash, always finds a whole one.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        if path_exists(spark, f"{path}/version={batch_id - 2}"):
            remove_work_dir(spark, f"{path}/version={batch_id - 2}")

    writer = _writer(row_count(rows, name), checkpoint, continuous).outputMode("complete")
    return writer.foreachBatch(replace).start()


def latest_count(spark: SparkSession, path: str, name: str = "total_records") -> DataFrame:
    """The count of the last batch, in one row; 0 before the first."""
    schema = T.StructType([T.StructField(name, T.LongType()), T.StructField("version", T.LongType())])
    versions = read_or_empty(spark, path, schema)
    return versions.agg(F.coalesce(F.max_by(name, "version"), F.lit(0)).alias(name))


def stream_task(checkpoint: str) -> str:
    """The load task of a stream: batch numbers start anew with each checkpoint, so each has a task of its own."""
    return f"stream {checkpoint.rstrip('/')}"


def dedup_load_stream(
    rows: DataFrame,
    store: LoadStore,
    checkpoint: str,
    order: Sequence[str],
    continuous: str | None = None,
    task: str | None = None,
    **load_options,
) -> StreamingQuery:
    """Load each micro-batch with the de-duplicating load.

    The checkpoint takes the place of the cursor, and the load skips a batch that is delivered again, so every record is
    stored once. A micro-batch is always loaded whole.
    """
    if load_options.get("max_chunks") is not None:
        raise ValueError("a micro-batch is delivered once and loaded whole: max_chunks would leave rows behind")
    task = task or stream_task(checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        load_table(batch, order, store, batch_id=str(batch_id), task=task, sequence=batch_id, **load_options)

    return _writer(rows, checkpoint, continuous).foreachBatch(load).start()


#: Parts of one level that are merged into one of the next.
PARTS_MERGED = 8


def _part(path: str, level: int, number: int) -> str:
    return f"{path}/level-{level}/part-{number}"


def _parts(spark: SparkSession, path: str) -> list[str]:
    """Whole parts that cover all micro-batches, the widest there are: ``(PARTS_MERGED - 1) * log(batches)`` at most."""
    levels = sorted(int(n.removeprefix("level-")) for n in list_names(spark, path))
    numbers = {k: {int(n.removeprefix("part-")) for n in list_names(spark, f"{path}/level-{k}")} for k in levels}
    whole = lambda k, n: n in numbers[k] and path_exists(spark, f"{_part(path, k, n)}/_SUCCESS")
    found, at = [], 0
    while True:
        for level in reversed(levels):
            width = PARTS_MERGED**level
            if at % width == 0 and whole(level, at // width):
                found.append(_part(path, level, at // width))
                at += width
                break
        else:
            return found


def count_and_sample(
    rows: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    path: str,
    checkpoint: str,
    continuous: str | None = None,
) -> StreamingQuery:
    """Feed a row count and a distinct sample from one pass over the source.

    Every micro-batch is counted per key in its map tasks and written under its own number, so a batch
    that is delivered again replaces what it wrote. Eight parts of a level are merged into one of the next, so a reader
    opens few parts however long the stream has run. :func:`counted_total` adds the counts up and :func:`sampled_rows`
    keeps one row per key.
    """
    others = [F.first(c).alias(c) for c in columns if c not in keys]
    names = [*columns, "records"]

    def feed(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keyed = batch.groupBy(*keys).agg(F.count("*").alias("records"), *others)
        keyed.select(*names).write.mode("overwrite").parquet(_part(path, 0, batch_id))
        level, done = 0, batch_id + 1
        while done % PARTS_MERGED == 0:
            first, done = done - PARTS_MERGED, done // PARTS_MERGED
            held = spark.read.schema(keyed.select(*names).schema).parquet(*[_part(path, level, first + k) for k in range(PARTS_MERGED)])
            merged = held.groupBy(*keys).agg(F.sum("records").alias("records"), *others)
            merged.select(*names).write.mode("overwrite").parquet(_part(path, level + 1, done - 1))
            # those merged the time before; readers may still hold the ones merged now
            for number in range(first - PARTS_MERGED, first):
                if number >= 0 and path_exists(spark, _part(path, level, number)):
                    remove_work_dir(spark, _part(path, level, number))
            level += 1

    return _writer(rows, checkpoint, continuous).foreachBatch(feed).start()


def sampled_rows(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    parts = _parts(spark, path)
    held = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    return held.dropDuplicates(list(keys))


def counted_total(spark: SparkSession, path: str, name: str = "total_records") -> DataFrame:
    parts, schema = _parts(spark, path), "records bigint"
    counts = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    return counts.agg(F.coalesce(F.sum("records"), F.lit(0)).alias(name))


def finish(query: StreamingQuery, timeout: int | None = None) -> bool:
    """Wait for the end, at most ``timeout`` seconds; raises what the query raised."""
    if timeout is None:
        query.awaitTermination()
        return True
    return query.awaitTermination(timeout)


def result_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """Query a named in-memory result."""
    table = spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})
    return table.limit(limit) if limit is not None else table
