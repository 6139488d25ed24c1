"""Streams give the batch answer, once, whatever the batching."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.plans.load import load_reports, loaded_rows, report_totals
from rowfold.plans.replay import replay
from rowfold.plans.state import LoadStore
from rowfold.sinks.messages import publish_files
from rowfold.sources.messages import read_text_messages
from rowfold.streaming import messages as M

EVENTS = "/root/testdata/sf0.001/events.parquet"
SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
    ]
)


@pytest.fixture
def events(spark):
    return spark.read.parquet(EVENTS)


@pytest.fixture
def source(spark, events, tmp_path):
    path = f"{tmp_path}/messages"
    assert publish_files(events, path, num_files=5) == events.count()
    return path


def stream(spark, source, files_per_trigger=2):
    return read_text_messages(spark, source, files_per_trigger)


def test_memory_sinks_hold_count_and_sample(spark, events, source):
    clicks = M.matching(stream(spark, source), SCHEMA, "event_type", " Click ")
    count = M.to_memory(clicks.agg(F.count("*").alias("total_records")), "total_count", "complete")
    sample = M.to_memory(M.distinct_stream(clicks.select("user_id", "event_type"), ["user_id"]), "sample")
    assert M.finish(count, 120) and M.finish(sample, 120)
    expected = events.filter("event_type = 'click'")
    assert M.result_table(spark, "total_count").first()[0] == expected.count()
    assert M.result_table(spark, "sample").count() == expected.select("user_id").distinct().count()
    assert M.result_table(spark, "sample", 10).count() == 10


def test_distinct_stream_is_distinct_for_a_hot_key(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id"))
    publish_files(rows, f"{tmp_path}/m", num_files=6)
    parsed = M.parse_messages(read_text_messages(spark, f"{tmp_path}/m", 2), rows.schema)
    M.finish(M.to_table(M.distinct_stream(parsed, ["k"], salts=4), f"{tmp_path}/out", f"{tmp_path}/cp"), 120)
    got = spark.read.schema(rows.schema).parquet(f"{tmp_path}/out")
    assert got.count() == got.select("k").distinct().count() == rows.select("k").distinct().count()


def test_second_run_finds_nothing_new(spark, events, source, tmp_path):
    rows = M.parse_messages(stream(spark, source), SCHEMA)
    for _ in range(2):
        M.finish(M.to_table(rows, f"{tmp_path}/out", f"{tmp_path}/cp"), 120)
    assert spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").count() == events.count()


def test_files_before_the_start_are_left_out(spark, source, tmp_path):
    late = read_text_messages(spark, source, since="2999-01-01 00:00:00")
    M.finish(M.to_table(M.parse_messages(late, SCHEMA), f"{tmp_path}/out", f"{tmp_path}/cp"), 120)
    assert spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").count() == 0


def test_count_and_sample_from_one_pass(spark, events, source, tmp_path):
    rows = M.parse_messages(stream(spark, source), SCHEMA)
    out = f"{tmp_path}/both"
    M.finish(M.count_and_sample(rows, ["user_id"], ["user_id", "event_type"], out, f"{tmp_path}/cp"), 120)
    assert M.counted_total(spark, out).first()[0] == events.count()
    sample = M.sampled_rows(spark, out, T.StructType(SCHEMA.fields[1:]), ["user_id"])
    assert sample.count() == events.select("user_id").distinct().count()


def test_stream_load_equals_batch_and_skips_redelivery(spark, events, source, tmp_path):
    rows = M.parse_messages(stream(spark, source), SCHEMA)
    store = LoadStore(f"{tmp_path}/store", 4)
    options = dict(columns=["user_id", "event_type"], chunk_size=200)
    M.finish(M.dedup_load_stream(rows, store, f"{tmp_path}/cp", ["event_id"], **options), 300)
    pairs = events.select("user_id", "event_type")
    schema = T.StructType(SCHEMA.fields[1:])
    got = loaded_rows(spark, store, schema).drop("load")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pairs.distinct().collect()))
    totals = report_totals(load_reports(spark, store)).first()
    assert totals["rows"] == events.count()
    loads = load_reports(spark, store).select("load").distinct().count()
    assert loads == 3
    # the last batch once more, as after a crash between the load and the checkpoint
    task, rows = M.stream_task(f"{tmp_path}/cp"), events.select(*SCHEMA.fieldNames())
    for number in (loads - 1, 0):
        M.load_table(rows, ["event_id"], store, str(number), task=task, sequence=number, **options)
    assert report_totals(load_reports(spark, store)).first() == totals


def bounded(spark, tmp_path, batches, delay="1 day"):
    """Run batches of (user, time) one after the other, each as a file of its own."""
    rows = spark.createDataFrame([], "user_id long, ts timestamp")
    for number, batch in enumerate(batches):
        publish_files(spark.createDataFrame(batch, "user_id long, ts string").selectExpr("user_id", "timestamp(ts) AS ts"), f"{tmp_path}/m", num_files=1)
        stream_rows = M.parse_messages(read_text_messages(spark, f"{tmp_path}/m"), rows.schema)
        query = M.distinct_within(stream_rows, ["user_id"], "ts", delay, f"{tmp_path}/out", f"{tmp_path}/cp")
        assert M.finish(query, 120)
    told = M.fates(spark, f"{tmp_path}/out", stream_rows.schema)
    return {p: told.filter(F.col("_fate") == p) for p in ("kept", "late")} | {"counts": M.fate_counts(spark, f"{tmp_path}/out")}


def test_bounded_dedup_expires_keys_and_keeps_late_rows_apart(spark, tmp_path):
    day = lambda d: f"2024-01-{d:02d} 00:00:00"
    parts = bounded(
        spark,
        tmp_path,
        [
            [(1, day(1)), (1, day(1)), (2, day(1)), (None, day(1))],
            [(1, day(2)), (3, day(5)), (None, day(1))],
            # behind day 4: late; user 1 was forgotten and comes again
            [(2, day(2)), (1, day(6)), (3, day(5))],
        ],
    )
    assert sorted(((r["user_id"], r["ts"].day) for r in parts["kept"].collect()), key=str) == sorted(
        [(1, 1), (2, 1), (None, 1), (3, 5), (1, 6)], key=str
    )
    assert [(r["user_id"], r["ts"].day) for r in parts["late"].collect()] == [(2, 2)]
    assert tuple(parts["counts"].first()) == (10, 5, 1, 4)
    # live keys are in the engine's store and in no table
    assert not list((tmp_path / "out").glob("**/state*")) and list((tmp_path / "cp" / "state").glob("**/*.zip"))


def test_every_event_is_kept_repeated_or_late(spark, events, tmp_path):
    publish_files(events.select("user_id", "ts"), f"{tmp_path}/m", num_files=5)
    rows = M.parse_messages(read_text_messages(spark, f"{tmp_path}/m", 1), events.select("user_id", "ts").schema)
    M.finish(M.distinct_within(rows, ["user_id"], "ts", "1 day", f"{tmp_path}/out", f"{tmp_path}/cp"), 300)
    told = M.fates(spark, f"{tmp_path}/out", events.select("user_id", "ts").schema)
    parts = {p: told.filter(F.col("_fate") == p) for p in ("kept", "late")}
    counts = M.fate_counts(spark, f"{tmp_path}/out").first()
    assert counts["rows"] == events.count() == counts["kept"] + counts["late"] + counts["repeated"]
    assert (counts["kept"], counts["late"]) == (parts["kept"].count(), parts["late"].count())
    assert counts["late"] > 0
    users = parts["kept"].select("user_id").union(parts["late"].select("user_id")).distinct().count()
    assert users == events.select("user_id").distinct().count()


def test_two_streams_share_a_store(spark, tmp_path):
    store = LoadStore(f"{tmp_path}/store", 4)
    for part in range(2):
        rows = spark.range(10 * part, 10 * part + 10).select("id", F.concat(F.lit("n"), "id").alias("name"))
        stream_rows = replay(rows, f"{tmp_path}/m{part}", 1)
        query = M.dedup_load_stream(stream_rows, store, f"{tmp_path}/cp{part}", ["id"], columns=["name"])
        assert M.finish(query, 120)
    assert report_totals(load_reports(spark, store)).first()["total_unique_records"] == 20
    with pytest.raises(ValueError, match="max_chunks"):
        M.dedup_load_stream(stream_rows, store, f"{tmp_path}/cp3", ["id"], max_chunks=1)


def test_count_is_whole_at_any_time(spark, events, source, tmp_path):
    rows = M.parse_messages(stream(spark, source), SCHEMA)
    out = f"{tmp_path}/count"
    assert M.latest_count(spark, out).first()[0] == 0
    M.finish(M.count_to_table(rows, out, f"{tmp_path}/cp"), 120)
    assert M.latest_count(spark, out).first()[0] == events.count()
    # the version before is still there for readers that have begun
    assert spark.read.parquet(out).select("version").distinct().count() == 2


def test_unreadable_messages_go_to_the_side(spark):
    texts = [('{"event_id": 1}',), ("oops",), ("",), ("[1]",)]
    df = spark.createDataFrame(texts, "t string").select(F.col("t").cast("binary").alias("value"))
    assert "oops" in [r[0] for r in M.unreadable_messages(df, SCHEMA).collect()]
    assert M.parse_messages(df, SCHEMA).filter("event_id = 1").count() == 1


def test_console_sink(spark, source, tmp_path):
    rows = M.matching(stream(spark, source, None), SCHEMA, "event_type", "click", exact=True)
    assert M.finish(M.to_console(rows, f"{tmp_path}/cp"), 120)


def test_counts_and_samples_of_many_batches_are_few_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "PARTS_MERGED", 2)
    rows = spark.range(44).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    publish_files(rows, f"{tmp_path}/m", num_files=11)
    stream_rows = M.parse_messages(read_text_messages(spark, f"{tmp_path}/m", 1), rows.schema)
    M.finish(M.count_and_sample(stream_rows, ["k"], ["k", "v"], f"{tmp_path}/out", f"{tmp_path}/cp"), 200)
    # eight, two and one batches
    assert [p.split("/")[-2] for p in M._parts(spark, f"{tmp_path}/out")] == ["level-3", "level-1", "level-0"]
    assert M.counted_total(spark, f"{tmp_path}/out").first()[0] == 44
    assert sorted(r["k"] for r in M.sampled_rows(spark, f"{tmp_path}/out", rows.schema, ["k"]).collect()) == list(range(10))
    assert M.counted_total(spark, f"{tmp_path}/none").first()[0] == 0


def test_console_takes_every_row(spark, events, source, tmp_path):
    rows = M.parse_messages(stream(spark, source), SCHEMA)
    query = M.to_console(rows.filter("event_type = 'click'"), f"{tmp_path}/cp")
    assert M.finish(query, 120)
    done = query.recentProgress
    assert all("Console" in p["sink"]["description"] for p in done)
    assert sum(p["numInputRows"] for p in done) == events.count()


def test_keys_of_a_bounded_dedup_are_handled_as_rows_with_any_time(spark, tmp_path):
    times = ["1969-12-31 23:59:59.999999", "1969-12-31 23:59:59.999998", None, "3000-01-01 00:00:00.000001"]
    rows = spark.createDataFrame([(k, t) for k in (1, None) for t in times], "user_id long, ts string").selectExpr("user_id", "timestamp(ts) AS ts")
    publish_files(rows, f"{tmp_path}/m", num_files=1)
    stream_rows = M.parse_messages(read_text_messages(spark, f"{tmp_path}/m"), rows.schema)
    query = M.distinct_within(stream_rows, ["user_id"], "ts", "1 hour", f"{tmp_path}/out", f"{tmp_path}/cp")
    assert M.finish(query, 120)
    # no data frame for each key
    assert query.recentProgress[0]["stateOperators"][0]["operatorName"] == "transformWithStateInPySparkExec"
    told = M.fates(spark, f"{tmp_path}/out", rows.schema)
    kept = told.filter(F.col("_fate") == "kept").select("user_id", F.unix_micros("ts").alias("at")).collect()
    # times of one millisecond: the first that comes
    assert {r["user_id"] for r in kept} == {1, None} and len(kept) == 2 and all(r["at"] in (-1, -2) for r in kept)
    assert tuple(M.fate_counts(spark, f"{tmp_path}/out").first()) == (8, 2, 0, 6)


def test_null_keys_lose_no_other_key(spark, tmp_path):
    rows = spark.range(400).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 40).alias("user_id"), F.expr("timestamp('2024-01-01') + make_interval(0, 0, 0, 0, cast(id / 10 AS int))").alias("ts")
    )
    publish_files(rows, f"{tmp_path}/m", num_files=1)
    stream_rows = M.parse_messages(read_text_messages(spark, f"{tmp_path}/m"), rows.schema)
    assert M.finish(M.distinct_within(stream_rows, ["user_id"], "ts", "90 days", f"{tmp_path}/out", f"{tmp_path}/cp"), 120)
    kept = M.fates(spark, f"{tmp_path}/out", rows.schema).filter(F.col("_fate") == "kept").collect()
    assert sorted((r["user_id"] for r in kept), key=str) == sorted([*range(40), None], key=str)
    assert tuple(M.fate_counts(spark, f"{tmp_path}/out").first()) == (400, 41, 0, 359)
