"""Row groups, record streams, curve layouts, merges, sketches, selection by rank and samples."""

from __future__ import annotations

import json
import math
import os
import random
import re
import time
from collections import Counter
from urllib.parse import unquote

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rowfold.operators import selection, sets
from rowfold.plans import merge, sketches
from rowfold.plans.load import load_files, load_reports, load_sketches, load_table, loaded_rows
from rowfold.plans.state import LoadStore
from rowfold.sinks import clustered
from rowfold.sources import files, footers, records

# --- footers


def test_row_groups_are_those_of_arrow_and_duckdb(spark, tmp_path):
    root = tmp_path / "a folder 100%20"
    root.mkdir()
    for name, n, size in (("one", 1000, 300), ("two", 10, 100), ("none", 0, 10)):
        table = pa.table({"k": pa.array(range(n), pa.int64()), "t": [f"v{k}" for k in range(n)]})
        pq.write_table(table, root / f"{name}.parquet", row_group_size=size)
    (root / "_hidden.parquet").write_bytes(b"not a file of rows")
    got = footers.row_group_listing(spark, f"file://{root}", "k").collect()
    told = sorted((os.path.basename(r["file_path"]), r["row_group"], r["first_row"], r["rows"], r["least"], r["most"]) for r in got)
    want = duckdb.sql(
        f"""SELECT DISTINCT file_name, row_group_id, row_group_num_rows, row_group_bytes, stats_min_value, stats_max_value
            FROM parquet_metadata('{root}/[not]*.parquet') WHERE path_in_schema = 'k'"""
    ).fetchall()
    assert [(n, g, c, a, b) for n, g, _, c, a, b in told] == sorted((os.path.basename(f), g, c, a, b) for f, g, c, _, a, b in want)
    assert {(n, g): f for n, g, f, *_ in told} == {("one.parquet", g): 300 * g for g in range(4)} | {("two.parquet", 0): 0, ("none.parquet", 0): 0}
    for r in got:
        group = pq.ParquetFile(unquote(re.sub("^file:/+", "/", r["file_path"]))).metadata.row_group(r["row_group"])
        assert (r["rows"], r["bytes"]) == (group.num_rows, group.total_byte_size)
    # the names are those of a scan
    scanned = spark.read.parquet(f"file://{root}").select("_metadata.file_path").distinct().collect()
    assert {r["file_path"] for r in scanned} == {r["file_path"] for r in got if r["rows"]}
    inside = footers.groups_between(footers.row_group_listing(spark, f"file://{root}"), 299, 601)
    assert sorted((r["rows"], r["row_group"]) for r in inside.collect()) == [(300, 0), (300, 1), (300, 2)]


def test_files_are_numbered_without_a_scan(spark, tmp_path):
    for k in range(4):
        spark.range(10 * k).coalesce(1).write.parquet(f"{tmp_path}/t/part={k}")
    df = spark.read.parquet(f"{tmp_path}/t")
    by_footer, by_scan = files.row_groups(df, f"{tmp_path}/t"), files.row_groups(df)
    names = ["row_group", "file_path", "rows"]
    assert sorted(map(tuple, by_footer.select(*names).collect())) == sorted(map(tuple, by_scan.select(*names).collect()))
    assert "FileScan parquet" not in by_footer._jdf.queryExecution().executedPlan().toString()
    before = [(r["bytes_before"], r["bytes"]) for r in by_footer.orderBy("row_group").collect()]
    assert before[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(before, before[1:])) and before[-1][1] > 0
    assert not footers.can_read_footers("viewfs://x/y") and footers.can_read_footers("/tmp/x") and footers.can_read_footers("file:/tmp")


def test_steps_of_a_file_load_are_bounded_by_bytes(spark, tmp_path):
    for k in range(5):
        spark.range(100 * k, 100 * k + 100).selectExpr("concat('n', id) AS name").coalesce(1).write.parquet(f"{tmp_path}/t/part={k}")
    store, steps = LoadStore(f"file://{tmp_path}/store", 4), []
    load_files(spark, f"{tmp_path}/t", store, columns=["name"], step_bytes=1, on_step=steps.append)
    assert [s["total_unique_records"] for s in steps] == [100, 200, 300, 400, 500]


# --- streams by records


def run_records(spark, tmp_path, starting="earliest", records_at_once=7, name="a", stop_after=None):
    """Values by batch, of a query that runs until nothing is left, or is stopped on the way."""
    rows = records.read_records(spark, f"file://{tmp_path}/in", records_at_once, starting, slice_bytes=20)
    out = f"{tmp_path}/out-{name}"

    def keep(batch, number):
        batch.withColumn("n", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    running = rows.writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/cp-{name}").trigger(processingTime="0 seconds").start()
    if stop_after is None:
        running.processAllAvailable()
    else:
        while running.isActive and not (running.lastProgress and running.lastProgress.batchId >= stop_after):
            time.sleep(0.05)
    running.stop()
    assert running.exception() is None
    if not os.path.exists(out):
        return {}
    got: dict[int, list[str]] = {}
    for r in spark.read.parquet(out).collect():
        got.setdefault(r["n"], []).append(bytes(r["value"]).decode())
    return got


def test_batches_are_bounded_by_records_and_a_restart_loses_and_repeats_none(spark, tmp_path):
    (tmp_path / "in").mkdir()
    want = []
    for k, n in enumerate((3, 20, 0, 11)):
        lines = [f'{{"file": {k}, "line": {i}, "t": "é{"x" * (i % 5)}"}}' for i in range(n)]
        # the last line of a file may have no end
        (tmp_path / "in" / f"f{k}.json").write_text("\n".join(lines) + ("\n" if k % 2 else ""))
        os.utime(tmp_path / "in" / f"f{k}.json", (1000 + k, 1000 + k))
        want += lines
    (tmp_path / "in" / "_hidden").write_text("no\n")
    run_records(spark, tmp_path, stop_after=1)
    got = run_records(spark, tmp_path)
    assert Counter(x for b in got.values() for x in b) == Counter(want)
    sizes = [len(got[k]) for k in sorted(got)]
    assert max(sizes) <= 7 and sizes[:-1] == [7] * (len(sizes) - 1)
    # a file that comes later
    (tmp_path / "in" / "late.json").write_text("late\n")
    assert [x for b in run_records(spark, tmp_path).values() for x in b if x == "late"] == ["late"]


def test_streams_by_records_start_at_the_latest_or_at_a_time(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"f{k}").write_text(f"line {k}\n")
        os.utime(tmp_path / "in" / f"f{k}", (100 + k, 100 + k))
    since = run_records(spark, tmp_path, starting="1970-01-01T00:01:41", name="time")
    assert sorted(x for b in since.values() for x in b) == ["line 1", "line 2"]
    assert run_records(spark, tmp_path, starting="latest", name="latest") == {}


# --- layouts on a curve


def test_filters_on_each_column_open_few_files_and_lose_nothing(spark, tmp_path):
    rng = random.Random(3)
    # skewed, with nulls, a hot value, text and time
    rows = [
        (k, int(rng.expovariate(0.01)) if rng.random() < 0.95 else None, rng.choice(["", "é", f"t{rng.randrange(300):03d}"]), rng.randrange(10**6) if k % 3 else 7)
        for k in range(20_000)
    ]
    df = spark.createDataFrame(rows, "id long, a long, b string, c long").withColumn("c", F.timestamp_seconds("c"))
    clustered.write_clustered(df, f"{tmp_path}/t", ["a", "b", "c"], files=128)
    held = spark.read.parquet(f"{tmp_path}/t")
    assert sorted(r["id"] for r in held.collect()) == list(range(20_000)) and held.columns == ["id", "a", "b", "c"]
    total = held.select("_metadata.file_path").distinct().count()
    day = held.agg(F.expr("timestamp_seconds(900000)")).first()[0]
    for column, bounds, keep in (
        ("a", (300, 400), lambda r: r[1] is not None and 300 <= r[1] <= 400),
        ("b", ("t010", "t030"), lambda r: "t010" <= r[2] <= "t030"),
        ("c", (day, None), lambda r: r[3] >= 900_000),
    ):
        assert 3 * len(clustered.files_within(spark, f"{tmp_path}/t", {column: bounds})) < total, column
        got = clustered.read_clustered(spark, f"{tmp_path}/t", **{column: bounds})
        assert sorted(r["id"] for r in got.collect()) == [r[0] for r in rows if keep(r)]
    assert clustered.read_clustered(spark, f"{tmp_path}/t", a=(10**9, None)).count() == 0
    with pytest.raises(ValueError, match="2 to 4"):
        clustered.with_curve(df, ["a"])


def test_curve_of_equal_rows_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None)] * 50, "a int, b double")
    clustered.write_clustered(df, f"{tmp_path}/t", ["a", "b"], files=4)
    assert clustered.read_clustered(spark, f"{tmp_path}/t", a=(1, 1)).count() == 50
    assert clustered.read_clustered(spark, f"{tmp_path}/t", b=(0, None)).count() == 0


# --- merges


def test_merges_rewrite_touched_files_only(spark, tmp_path):
    rng = random.Random(4)
    table = merge.MergeTable(f"file://{tmp_path}/t", ("k", "n"), file_rows=50)
    model = {(rng.randrange(2000), rng.randrange(3)): "old" for _ in range(1200)}
    to_df = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], "k long, n int, v string")
    merge.create_table(to_df(model), table)
    with pytest.raises(ValueError, match="already"):
        merge.create_table(to_df(model), table)
    for round_, (low, high, n) in enumerate(((500, 560, 40), (-50, 3000, 30), (1990, 5000, 400), (700, 701, 3))):
        new = {(rng.randrange(low, high), rng.randrange(3)): f"new {round_}" for _ in range(n)}
        before = merge.manifest(spark, table, merge.current_version(spark, table)).collect()
        done = merge.merge_rows(to_df(new), table)
        model.update(new)
        got = {(r["k"], r["n"]): r["v"] for r in merge.read_table(spark, table).collect()}
        assert got == model
        after = {r["file_path"] for r in merge.manifest(spark, table, done.version).collect()}
        kept = [r for r in before if r["file_path"] in after]
        assert len(before) - len(kept) == done.rewritten and done.after == len(after)
        # a file that was taken over holds no new key
        assert not [1 for r in kept for k, _ in new if r["least"] <= k <= r["most"]]
        if round_ in (0, 3):
            assert done.rewritten <= 5 < len(before)
    ranges = sorted((r["least"], r["most"]) for r in merge.manifest(spark, table, merge.current_version(spark, table)).collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert merge.merge_rows(to_df(model).limit(0), table).rewritten == 0
    # versions before stay readable
    assert {r["v"] for r in merge.read_table(spark, table, 1).collect()} == {"old"}


def test_merges_with_null_keys_single_files_and_two_writers(spark, tmp_path, monkeypatch):
    table = merge.MergeTable(f"file://{tmp_path}/t", ("k",))
    rows = lambda *r: spark.createDataFrame(list(r), "k long, v string")
    merge.create_table(rows((1, "a"), (None, "n")), table)
    assert merge.merge_rows(rows((1, "b"), (None, "m"), (2, "c")), table).version == 2
    assert sorted(map(tuple, merge.read_table(spark, table).collect()), key=repr) == sorted([(1, "b"), (2, "c"), (None, "m"), (None, "n")], key=repr)
    monkeypatch.setattr(merge, "current_version", lambda *_: 1)
    with pytest.raises(RuntimeError, match="another writer"):
        merge.merge_rows(rows((1, "lost")), table)
    monkeypatch.undo()
    assert "lost" not in {r["v"] for r in merge.read_table(spark, table).collect()}


# --- sketches


def test_sketches_of_loads_add_up(spark, tmp_path):
    store = LoadStore(f"file://{tmp_path}/s", 4)
    for part, (low, high) in enumerate(((0, 9000), (6000, 15_000), (14_000, 14_500))):
        rows = spark.range(low, high).selectExpr("id AS seq", "id AS k", "id % 97 AS small", "CAST(NULL AS string) AS none")
        load_table(rows, ["seq"], store, f"p{part}", ["k", "small", "none"], sketches=["k", "small", "none"])
    held = load_sketches(spark, store)
    assert held.count() == 9
    counts = {r["column"]: r for r in sketches.distinct_counts(held).collect()}
    for column, exact in (("k", 15_000), ("small", 97), ("none", 0)):
        assert abs(counts[column]["distinct"] - exact) <= counts[column]["error"] <= 0.05 * max(exact, 1) * 1.05
    added = {r["column"]: r for r in sketches.new_values(held, 2).collect()}
    assert abs(added["k"]["added"] - 6000) <= added["k"]["error"] and added["small"]["added"] == 0
    # the union of parts is the sketch of the whole
    whole = sketches.sketch_columns(spark.range(15_000).selectExpr("id AS k"), ["k"])
    assert sketches.distinct_counts(whole).first()["distinct"] == counts["k"]["distinct"]


# --- selection and samples


@pytest.mark.parametrize("kind", ["even", "skewed", "ties", "dates", "times"])
def test_cuts_hold_the_rank_and_little_more(spark, kind):
    rng = random.Random(6)
    n = 5000
    value = {
        "even": lambda: rng.randrange(10**6),
        "skewed": lambda: int(math.exp(rng.uniform(0, 25))),
        "ties": lambda: rng.choice([1, 1, 1, 5, 9]),
        "dates": lambda: rng.randrange(20_000),
        "times": lambda: rng.randrange(10**9),
    }[kind]
    values = [value() if rng.random() < 0.97 else None for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    if kind == "dates":
        df = df.selectExpr("date_from_unix_date(CAST(v AS int)) AS v")
    if kind == "times":
        df = df.selectExpr("CAST(timestamp_seconds(v) AS timestamp_ntz) AS v")
    assert selection.can_rank(df, "v")
    for rank in (1, 100, 2500, n):
        cut = selection.cut_at_rank(df, "v", rank)
        part = selection.up_to(df, "v", cut)
        assert part.count() == cut.rows >= rank
        if kind != "ties" and rank > 500:
            assert cut.rows <= rank * 1.05 + 1
    assert selection.cut_at_rank(df, "v", n + 1) is None
    assert selection.cut_at_rank(df.filter("false"), "v", 1) is None and not selection.can_rank(df.selectExpr("CAST(v AS string) AS v"), "v")


def test_a_cap_hashes_little_more_than_it_lets_in(spark, tmp_path, monkeypatch):
    from rowfold.plans import load as load_module

    hashed, real = [], load_module.ordered_rows

    def counting(part, *args):
        hashed.append(part.count())
        return real(part, *args)

    monkeypatch.setattr(load_module, "ordered_rows", counting)
    rows = spark.range(20_000).selectExpr("id AS seq", "concat('n', id % 15000) AS name")
    for cap, most in ((500, 1200), (14_000, 16_500), (15_001, 20_000)):
        store = LoadStore(f"file://{tmp_path}/{cap}", 4)
        hashed.clear()
        load_table(rows, ["seq"], store, "a", ["name"], cap=cap, chunk_size=100)
        assert max(hashed) <= most
        assert loaded_rows(spark, store, rows.select("name").schema).count() == min(cap, 15_000)
        report = load_reports(spark, store).agg(F.sum("rows"), F.max("chunk"), F.min("rows")).first()
        assert report[2] == 100 and report[0] == 100 * (report[1] + 1)
    # half of what comes first is repeated, so that the first cut does not reach the cap
    store = LoadStore(f"file://{tmp_path}/again", 4)
    twice = spark.range(20_000).selectExpr("id AS seq", "if(id < 8000, 'same', concat('n', id)) AS name")
    load_table(twice, ["seq"], store, "a", ["name"], cap=3000, chunk_size=100)
    got = {r["name"] for r in loaded_rows(spark, store, rows.select("name").schema).collect()}
    assert got == {"same", *(f"n{k}" for k in range(8000, 10_999))}


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(40_000).selectExpr("id", "id % 7 AS b", "if(id % 5 = 0, NULL, concat('t', id)) AS t")
    for mean in (0.1, 2.5):
        draws = [sorted(r["id"] for r in sets.sample_with_replacement(df.repartition(n), mean, 3).collect()) for n in (1, 64)]
        assert draws[0] == draws[1] != sorted(r["id"] for r in sets.sample_with_replacement(df, mean, 4).collect())
        times = Counter(Counter(draws[0]).values())
        for k in (1, 2):
            expected = 40_000 * math.exp(-mean) * mean**k / math.factorial(k)
            assert abs(times[k] - expected) < 6 * math.sqrt(expected)
    with pytest.raises(ValueError, match="mean"):
        sets.sample_with_replacement(df, 0.0)


def test_a_small_micro_batch_is_read_by_one_task_and_a_large_one_is_dealt(spark, tmp_path):
    (tmp_path / "in").mkdir()
    want = [f"line {i}" for i in range(50)]
    (tmp_path / "in" / "f").write_text("\n".join(want) + "\n")
    plan = lambda rows: rows._jdf.queryExecution().analyzed().toString()
    assert "Repartition" not in plan(records.read_records(spark, f"{tmp_path}/in", 3_000))
    assert "Repartition" in plan(records.read_records(spark, f"{tmp_path}/in", 10 * records.TASK_RECORDS))
    for tasks in (1, 3):
        rows = records.read_records(spark, f"{tmp_path}/in", 20, slice_bytes=30, tasks=tasks)
        running = rows.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp{tasks}").trigger(processingTime="0 seconds").start(f"{tmp_path}/out{tasks}")
        running.processAllAvailable()
        running.stop()
        got = spark.read.schema("value binary").parquet(f"{tmp_path}/out{tasks}").collect()
        assert sorted(bytes(r["value"]).decode() for r in got) == sorted(want)


def test_streams_share_a_backlog_by_whole_micro_batches(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    want = []
    for k, n in enumerate((3, 41, 0, 1, 18)):
        lines = [f"file {k} line {i} é{'x' * (i % 7)}" if i % 9 else "" for i in range(n)]
        # the last line of a file may have no end
        (tmp_path / "in" / f"f{k}").write_text("".join(f"{x}\n" for x in lines[:-1]) + (lines[-1] + "\n" * (k % 2) if lines else ""))
        os.utime(tmp_path / "in" / f"f{k}", (1000 + k, 1000 + k))
        want += lines
    assert want[-1] and want[2]
    path, plan = f"file://{tmp_path}/in", f"file://{tmp_path}/ranges"
    monkeypatch.setattr(records, "STREAM_BATCHES", 3)
    # 63 lines are 13 micro-batches of 5
    ranges = records.record_ranges(spark, path, plan, 5, streams=8, slice_bytes=20)
    assert len(ranges) == 4 and ranges[-1][1] is None
    assert [stop for _, stop in ranges[:-1]] == [first for first, _ in ranges[1:]]
    assert ranges == records.record_ranges(spark, path, f"{plan}-2", 5, streams=8)
    assert len(records.record_ranges(spark, path, f"{plan}-3", 5, streams=2)) == 2
    for name, starting, want_ranges in (("latest", "latest", 1), ("time", "1970-01-01T00:16:44", 2)):
        assert len(records.record_ranges(spark, path, f"{plan}-{name}", 3, starting)) == want_ranges

    def run(only_one: bool) -> dict:
        for k, (starting, until) in enumerate(records.record_ranges(spark, path, plan, 5)):
            def keep(batch, number, k=k):
                batch.write.mode("overwrite").parquet(f"{tmp_path}/out/stream={k}/batch={number}")

            rows = records.read_records(spark, path, 5, starting, slice_bytes=20, until=until)
            running = rows.writeStream.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/cp-{k}").trigger(processingTime="0 seconds").start()
            if only_one:
                while running.isActive and not (running.lastProgress and running.lastProgress.batchId >= 1):
                    time.sleep(0.05)
            else:
                running.processAllAvailable()
            running.stop()
            assert running.exception() is None
        got: dict[tuple[int, int], list[str]] = {}
        for r in spark.read.schema("value binary, stream long, batch long").parquet(f"{tmp_path}/out").collect():
            got.setdefault((r["stream"], r["batch"]), []).append(bytes(r["value"]).decode())
        return got

    run(only_one=True)
    got = run(only_one=False)
    assert Counter(x for b in got.values() for x in b) == Counter(want)
    assert sorted(len(b) for b in got.values()) == [3] + [5] * 12
    # a file that comes later goes to the last stream, and the ranges stay as they were
    (tmp_path / "in" / "late").write_text("late\n")
    assert records.record_ranges(spark, path, plan, 5) == ranges
    assert [k for k, b in run(only_one=False).items() if "late" in b] == [(3, max(b for s, b in got if s == 3) + 1)]


def test_a_cut_may_fall_behind_a_line_without_an_end(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"f{k}").write_text("a\nb")
        os.utime(tmp_path / "in" / f"f{k}", (1000 + k, 1000 + k))
    monkeypatch.setattr(records, "STREAM_BATCHES", 1)
    ranges = records.record_ranges(spark, f"{tmp_path}/in", f"file://{tmp_path}/ranges", 2, streams=4, slice_bytes=2)
    ends = [json.loads(stop) for _, stop in ranges[:-1]]
    assert [(x["file"][-2:], x["byte"]) for x in ends] == [("f0", 3), ("f1", 3), ("f2", 3)]


def test_the_query_by_records_runs_streams_side_by_side(spark, tmp_path, monkeypatch):
    from rowfold.registry import streams

    rows = [(i % 300 if i % 11 else None, i % 7, "x") for i in range(355)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    shared = []
    monkeypatch.setattr(streams, "ADMITTED", 10)
    monkeypatch.setattr(streams, "record_ranges", lambda *a: shared.append(records.record_ranges(*a)) or shared[-1])
    got = streams.stream_by_records(spark, str(tmp_path)).collect()
    assert Counter((r["event_id"], r["user_id"]) for r in got) == Counter(r[:2] for r in rows)
    assert {(r["batches"], r["none_too_large"]) for r in got} == {(36, True)}
    # started twice, with the same ranges
    assert len(shared) == 2 and shared[0] == shared[1] and len(shared[0]) == 2
