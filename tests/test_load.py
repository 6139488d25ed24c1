"""The de-duplicating load against a sequential model, and its invariants."""

from __future__ import annotations

import math
import random
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.operators.dedup import chunk_groups, chunk_report, new_records, ordered_rows
from rowfold.plans import load as load_module
from rowfold.plans import seen as seen_module
from rowfold.plans.load import (
    compact_seen,
    finalize_load,
    lift_claim,
    load_files,
    load_reports,
    load_table,
    loaded_rows,
    report_totals,
    reset_load,
    seen_hashes,
)
from rowfold.plans.seen import not_stored
from rowfold.plans.state import DONE, RUNNING, LoadState, LoadStore, Run, StateMoved, claim, read_state, save_state, state_table
from rowfold.session import create_new

SCHEMA = T.StructType([T.StructField("seq", T.LongType()), T.StructField("name", T.StringType())])
RECORD = T.StructType([SCHEMA["name"]])


def model(names, chunk_size, seen=(), cap=None, already=0, start_chunk=0, max_chunks=None):
    """Chunk by chunk, as a loader with a table of stored records would do it."""
    stored, report, accepted = set(seen), [], []
    total = already
    for chunk, begin in enumerate(range(0, len(names), chunk_size)):
        if chunk < start_chunk:
            continue
        if cap is not None and total >= cap or max_chunks is not None and len(report) >= max_chunks:
            break
        rows = names[begin : begin + chunk_size]
        unique = list(dict.fromkeys(rows))
        fresh = [n for n in unique if n not in stored]
        kept = fresh if cap is None else fresh[: cap - total]
        stored.update(kept)
        accepted += kept
        total += len(kept)
        report.append(
            (chunk, len(rows), len(rows) - len(unique), len(unique) - len(fresh), len(kept), len(fresh) - len(kept))
        )
    return report, accepted


def table(spark, names):
    return spark.createDataFrame(list(enumerate(names)), SCHEMA)


def reported(spark, store, load=None):
    reports = load_reports(spark, store)
    if load is not None:
        reports = reports.filter(F.col("load") == load)
    columns = ["chunk", "rows", "in_chunk", "already", "new", "capped"]
    return sorted(tuple(r) for r in reports.select(*columns).collect())


def stored_names(spark, store):
    return sorted((r["name"] for r in loaded_rows(spark, store, RECORD).collect()), key=str)


@pytest.fixture
def store(tmp_path):
    return LoadStore(f"file://{tmp_path}/store", 4)


def draws(seed, n, kinds):
    rng = random.Random(seed)
    return [f"n{rng.randrange(kinds)}" for _ in range(n)]


@pytest.mark.parametrize(
    ("seed", "n", "kinds", "chunk", "cap"),
    [(1, 60, 20, 7, None), (2, 60, 50, 10, 23), (3, 40, 5, 4, 0), (4, 55, 40, 100, 12), (5, 30, 30, 5, 30)],
)
def test_matches_sequential_model(spark, store, seed, n, kinds, chunk, cap):
    first, second = draws(seed, n, kinds), draws(seed + 100, n, kinds)
    load_table(table(spark, first), ["seq"], store, "a", ["name"], cap=cap, chunk_size=chunk)
    report, accepted = model(first, chunk, cap=cap)
    assert reported(spark, store, 1) == report
    assert stored_names(spark, store) == sorted(accepted)

    state = load_table(table(spark, second), ["seq"], store, "b", ["name"], cap=cap, chunk_size=chunk)
    report2, accepted2 = model(second, chunk, accepted, cap, len(accepted))
    assert reported(spark, store, 2) == report2
    assert stored_names(spark, store) == sorted(accepted + accepted2)
    assert state["total_unique_records"] == len(accepted) + len(accepted2)
    assert state["total_duplicate_records"] == sum(r[2] + r[3] for r in report + report2)


def test_rows_add_up_and_second_load_adds_nothing(spark, store):
    names = draws(7, 80, 30)
    for batch in ("a", "b"):
        load_table(table(spark, names), ["seq"], store, batch, ["name"], chunk_size=9)
    for _, rows, in_chunk, already, new, capped in reported(spark, store):
        assert rows == in_chunk + already + new + capped
    assert sum(r[4] for r in reported(spark, store, 2)) == 0
    assert stored_names(spark, store) == sorted(set(names))


def test_split_in_batches_equals_one_batch(spark, tmp_path):
    names = draws(8, 90, 40)
    whole, split = LoadStore(f"{tmp_path}/whole", 4), LoadStore(f"{tmp_path}/split", 4)
    load_table(table(spark, names), ["seq"], whole, "all", ["name"], chunk_size=10)
    for i in range(3):
        load_table(table(spark, names[30 * i : 30 * i + 30]), ["seq"], split, f"part{i}", ["name"], chunk_size=10)
    assert stored_names(spark, whole) == stored_names(spark, split)
    totals = [report_totals(load_reports(spark, s)).first() for s in (whole, split)]
    assert totals[0] == totals[1]


def test_stop_and_resume_equals_one_run(spark, tmp_path):
    names = draws(9, 70, 25)
    whole, steps = LoadStore(f"{tmp_path}/whole", 4), LoadStore(f"{tmp_path}/steps", 4)
    load_table(table(spark, names), ["seq"], whole, "all", ["name"], chunk_size=10, cap=20)
    status = []
    for _ in range(6):
        state = load_table(table(spark, names), ["seq"], steps, "all", ["name"], chunk_size=10, cap=20, max_chunks=2)
        status.append(state["status"])
        if state["status"] == DONE:
            break
    assert status[0] == RUNNING and status[-1] == DONE
    assert reported(spark, steps) == reported(spark, whole)
    assert stored_names(spark, steps) == stored_names(spark, whole)


def test_finished_batch_is_not_loaded_again(spark, store):
    names = draws(10, 20, 10)
    first = load_table(table(spark, names), ["seq"], store, "a", ["name"])
    assert load_table(table(spark, names), ["seq"], store, "a", ["name"]) == first
    assert load_reports(spark, store).select("load").distinct().count() == 1


def test_file_loads_number_rows_by_file_and_place(spark, tmp_path, store):
    source = tmp_path / "source"
    names = draws(11, 50, 20)
    for i in range(5):
        rows = table(spark, names[10 * i : 10 * i + 10]).select("name")
        rows.coalesce(1).write.parquet(f"{source}/part={i}")
    state = load_files(spark, str(source), store, columns=["name"], chunk_size=4)
    groups = load_reports(spark, store).select("row_group", "chunk", "rows").collect()
    assert sorted(map(tuple, groups)) == [(g, c, 2 if c == 2 else 4) for g in range(5) for c in range(3)]
    assert stored_names(spark, store) == sorted(set(names))
    assert (state["last_processed_row_group"], state["last_processed_chunk"]) == (5, 0)
    assert state["status"] == DONE


def test_file_load_in_steps(spark, tmp_path):
    source = tmp_path / "source"
    names = draws(12, 40, 18)
    for i in range(4):
        table(spark, names[10 * i : 10 * i + 10]).select("name").coalesce(1).write.parquet(f"{source}/part={i}")
    whole, steps = LoadStore(f"{tmp_path}/whole", 4), LoadStore(f"{tmp_path}/steps", 4)
    load_files(spark, str(source), whole, columns=["name"], chunk_size=4, cap=15)
    for _ in range(12):
        state = load_files(spark, str(source), steps, columns=["name"], chunk_size=4, cap=15, max_chunks=2)
        if state["status"] == DONE:
            break
    assert state["status"] == DONE
    columns = ["row_group", "chunk", "rows", "in_chunk", "already", "new", "capped"]
    both = [sorted(map(tuple, load_reports(spark, s).select(*columns).collect())) for s in (whole, steps)]
    assert both[0] == both[1]
    assert stored_names(spark, whole) == stored_names(spark, steps)


def test_nothing_shows_before_the_state_is_saved(spark, store, monkeypatch):
    names = draws(13, 30, 12)
    load_table(table(spark, names[:10]), ["seq"], store, "a", ["name"])
    before = stored_names(spark, store)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(load_module, "update_state", fail)
        with pytest.raises(RuntimeError, match="lost"):
            load_table(table(spark, names), ["seq"], store, "b", ["name"])
    assert stored_names(spark, store) == before
    # the number still belongs to the writer that died
    with pytest.raises(RuntimeError, match="another writer"):
        load_table(table(spark, names[10:20]), ["seq"], store, "c", ["name"])
    assert lift_claim(spark, store) and not lift_claim(spark, store)
    assert seen_hashes(spark, store).count() == len(before)
    load_table(table(spark, names[10:20]), ["seq"], store, "c", ["name"])
    assert stored_names(spark, store) == sorted(set(names[:20]))


def test_fresh_load_forgets_and_reset_empties(spark, store):
    names = draws(14, 30, 12)
    load_table(table(spark, names), ["seq"], store, "a", ["name"])
    state = load_table(table(spark, names[:10]), ["seq"], store, "b", ["name"], fresh=True)
    assert state["total_unique_records"] == len(set(names[:10]))
    assert stored_names(spark, store) == sorted(set(names[:10]))
    row = finalize_load(spark, store)
    assert row["total_unique_records"] == len(set(names[:10])) and row["status"] == DONE
    reset_load(spark, store)
    assert stored_names(spark, store) == []
    assert {r["total_unique_records"] for r in state_table(spark, store).collect()} == {0}
    assert {r["status"] for r in read_state(spark, store).rows.values()} == {"PENDING"}


def test_empty_batch_and_null_records(spark, store):
    state = load_table(table(spark, []), ["seq"], store, "none", ["name"])
    assert state["status"] == DONE and state["total_unique_records"] == 0
    rows = [(0, None), (1, ""), (2, None), (3, "~")]
    load_table(spark.createDataFrame(rows, SCHEMA), ["seq"], store, "nulls", ["name"])
    assert stored_names(spark, store) == sorted([None, "", "~"], key=str)


def test_partitioned_target(spark, store):
    rows = [(i, f"c{i % 3}", i % 7) for i in range(50)]
    df = spark.createDataFrame(rows, "seq long, country string, score long")
    load_table(df, ["seq"], store, "a", ["country", "score"], partition_by=["country"])
    schema = T.StructType([T.StructField("score", T.LongType()), T.StructField("country", T.StringType())])
    got = loaded_rows(spark, store, schema).select("country", "score")
    assert sorted(map(tuple, got.collect())) == sorted({(c, s) for _, c, s in rows})


def test_one_record_may_fill_a_third_of_the_batch(spark, store):
    """Copies of one record span chunks and are counted, not gathered."""
    df = spark.range(30_000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), F.col("id") % 5000)).alias("name"),
    )
    groups = chunk_groups(ordered_rows(df, ["seq"], ["name"]), 1000)
    per_hash = groups.groupBy("record_hash").agg(F.count("*").alias("groups"), F.sum("copies").alias("copies"))
    hottest = per_hash.orderBy(F.desc("copies")).first()
    assert hottest["copies"] == 10_000 and hottest["groups"] == 30
    load_table(df, ["seq"], store, "a", ["name"], chunk_size=1000)
    totals = report_totals(load_reports(spark, store)).first()
    distinct = df.select("name").distinct().count()
    assert (totals["rows"], totals["total_unique_records"]) == (30_000, distinct)


def test_copies_with_equal_order_values_are_spread(spark):
    """Equal rows do not all end in one range, and each gets a place of its own."""
    df = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("seq"), F.lit("same").alias("name"))
    rows = ordered_rows(df, ["seq"], ["name"])
    ends = rows.agg(F.min("position"), F.max("position"), F.countDistinct("position")).first()
    assert tuple(ends) == (0, 7999, 8000)
    per_task = rows.groupBy(F.spark_partition_id()).count()
    files = [f for f in rows.inputFiles()]
    assert len(files) > 3 and per_task.agg(F.sum("count")).first()[0] == 8000


def test_first_positions_are_narrow_and_combined_in_map_tasks(spark):
    rows = [(bytes([i % 5]), 7, i) for i in range(20)]
    groups = chunk_groups(spark.createDataFrame(rows, "record_hash binary, check_hash int, position long"), 5)
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan and "partial_min(position" in plan
    seen = spark.createDataFrame([(bytes([0]),), (bytes([9]),)], "record_hash binary")
    assert sorted(r["position"] for r in new_records(groups, seen).collect()) == [1, 2, 3, 4]


def test_stored_hashes_are_scanned_not_shuffled(spark, store, tmp_path):
    load_table(table(spark, draws(15, 60, 40)), ["seq"], store, "a", ["name"])
    batch = chunk_groups(ordered_rows(table(spark, draws(16, 60, 90)), ["seq"], ["name"]), 10)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = new_records(batch, not_stored(spark, store, read_state(spark, store), str(tmp_path / "w")))
        expected = set(draws(16, 60, 90)) - set(draws(15, 60, 40))
        assert new.count() == len(expected)
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line]
    assert scans and "SelectedBucketsCount: 4 out of 4" in plan and "ShuffledHashJoin" in plan
    for i in scans:
        # between the scan and the join above it
        above = next(j for j in range(i, -1, -1) if "Join" in lines[j])
        assert not any("Exchange" in line for line in lines[above:i])


def opened(monkeypatch):
    """The files of runs that loads open from here on."""
    files, real = [], seen_module.run_files

    def note(*args):
        held = real(*args)
        files.extend(r[0] for r in held.select("_metadata.file_path").distinct().collect())
        return held

    monkeypatch.setattr(seen_module, "run_files", note)
    return files


def test_a_load_of_new_keys_opens_no_run_and_one_of_a_known_key_one_file(spark, store, monkeypatch):
    for part in range(3):
        load_table(spark.range(2000 * part, 2000 * part + 2000).selectExpr("id AS seq", "concat('k', id) AS name"), ["seq"], store, f"p{part}", ["name"])
    files = opened(monkeypatch)
    load_table(spark.range(9000, 13_000).selectExpr("id AS seq", "concat('k', id) AS name"), ["seq"], store, "new", ["name"])
    assert files == []
    load_table(table(spark, ["k4001", "fresh", None]), ["seq"], store, "one", ["name"])
    assert len(files) == 1
    assert reported(spark, store, 5) == [(0, 3, 0, 1, 2, 0)]
    assert len(stored_names(spark, store)) == 10_002


def test_filters_miss_nothing_and_cells_are_bounded(spark, store, monkeypatch, tmp_path):
    """Several filter rows in a bucket, short hashes, all stored and none stored."""
    monkeypatch.setattr(seen_module, "FILTER_ROWS", 100)
    for algorithm in ("sha256", "xxhash64"):
        own = LoadStore(f"{store.root}-{algorithm}", 4)
        load_table(table(spark, [f"n{k}" for k in range(3000)]), ["seq"], own, "a", ["name"], algorithm=algorithm)
        state = read_state(spark, own)
        rows = seen_module.filter_rows(spark, own, state.runs)
        assert rows.count() > 20 and rows.agg(F.max(F.octet_length("marks"))).first()[0] <= 400
        known = seen_hashes(spark, own, state).withColumn("position", F.lit(1).cast("long"))
        assert not_stored(spark, own, state, str(tmp_path / f"{algorithm}-known"))(known).count() == 0
        others = spark.range(3000).select(F.unhex(F.sha2(F.concat(F.lit("other"), "id"), 256)).alias("record_hash"), F.col("id").alias("position"))
        assert not_stored(spark, own, state, str(tmp_path / f"{algorithm}-others"))(others).count() == 3000


def test_runs_stay_few_whatever_is_loaded():
    for sizes in ([1000] * 400, [10**6, *[10] * 300], [random.Random(5).randrange(1, 10**6) for _ in range(400)], list(range(1, 300))):
        runs, written, total = [], 0, 0
        for number, size in enumerate(sizes):
            merged = seen_module.to_merge(runs, size)
            runs = [r for r in runs if r not in merged] + [Run(str(number), size + sum(r.records for r in merged))]
            written, total = written + runs[-1].records, total + size
            tiers = math.log(total, seen_module.FAN) + 1
            assert len(runs) <= (seen_module.FAN - 1) * tiers and sum(r.records for r in runs) == total
        # each hash is written anew once for each tier at most
        assert written <= total * (tiers + 1)


def test_many_loads_keep_few_runs_and_all_rows(spark, store):
    names = draws(23, 240, 150)
    for part in range(12):
        load_table(table(spark, names[20 * part : 20 * part + 20]), ["seq"], store, f"p{part}", ["name"])
    state = read_state(spark, store)
    assert len(state.runs) <= 6 and sum(r.records for r in state.runs) == len(set(names))
    assert stored_names(spark, store) == sorted(set(names))
    # runs that were merged go with the commit after
    held = {p.name for p in (Path(store.root.removeprefix("file://")) / "seen").iterdir()}
    assert held <= {r.id for r in state.runs} | set(state.retired)


def test_compaction_keeps_what_is_known(spark, store):
    names = draws(17, 40, 25)
    for part in range(2):
        load_table(table(spark, names[20 * part : 20 * part + 20]), ["seq"], store, f"p{part}", ["name"])
    before = sorted(bytes(r[0]) for r in seen_hashes(spark, store).collect())
    compact_seen(spark, store)
    assert sorted(bytes(r[0]) for r in seen_hashes(spark, store).collect()) == before
    assert len(read_state(spark, store).runs) == 1
    load_table(table(spark, [*names, "new"]), ["seq"], store, "again", ["name"])
    assert stored_names(spark, store) == sorted({*names, "new"})


def test_a_load_that_commits_during_finalize_is_not_lost(spark, store, monkeypatch):
    """A second load commits between the reading and the saving of the totals: 20 rows stored, 20 visible."""
    load_table(table(spark, [f"a{k}" for k in range(10)]), ["seq"], store, "one", ["name"])
    real, between = load_module.report_totals, [True]

    def late(report):
        totals = real(report)
        if between.pop() if between else False:
            load_table(table(spark, [f"b{k}" for k in range(10)]), ["seq"], store, "two", ["name"])
        return totals

    monkeypatch.setattr(load_module, "report_totals", late)
    row = finalize_load(spark, store)
    assert row["total_unique_records"] == 20 and len(stored_names(spark, store)) == 20
    load_table(table(spark, ["a1", "c"]), ["seq"], store, "three", ["name"])
    assert len(stored_names(spark, store)) == 21


def test_of_two_writers_with_one_state_the_second_fails(spark, store):
    load_table(table(spark, ["a"]), ["seq"], store, "one", ["name"])
    state = read_state(spark, store)
    saved = save_state(spark, store, state, state.of("x") | {"total_unique_records": 1})
    for stale in (state, LoadState(state.version - 1, {})):
        with pytest.raises(StateMoved):
            save_state(spark, store, stale, stale.of("y"))
    assert read_state(spark, store).rows.keys() == saved.rows.keys() == {"load", "x"}
    # a writer that died between claim and save, and its claim lifted
    create_new(spark, store.version(saved.version + 1), "")
    with pytest.raises(StateMoved):
        save_state(spark, store, saved, saved.of("z"))
    assert lift_claim(spark, store)
    save_state(spark, store, saved, saved.of("z"))
    assert set(read_state(spark, store).rows) == {"load", "x", "z"}


def test_reset_waits_for_a_load_that_runs(spark, store):
    load_table(table(spark, ["a"]), ["seq"], store, "one", ["name"])
    claim(spark, store, 2)
    with pytest.raises(RuntimeError, match="another writer"):
        reset_load(spark, store)
    assert stored_names(spark, store) == ["a"]


def test_a_folder_that_has_grown_is_gone_on_with(spark, tmp_path, store):
    source = tmp_path / "source"
    names = draws(18, 40, 30)
    for i in (1, 2):
        table(spark, names[20 * i - 20 : 20 * i]).select("name").coalesce(1).write.parquet(f"{source}/part={i}")
        assert load_files(spark, str(source), store, columns=["name"], chunk_size=7)["status"] == DONE
        assert stored_names(spark, store) == sorted(set(names[: 20 * i]))
    loads = load_reports(spark, store).select("load").distinct().count()
    load_files(spark, str(source), store, columns=["name"], chunk_size=7)
    assert load_reports(spark, store).select("load").distinct().count() == loads == 2
    table(spark, ["early"]).select("name").coalesce(1).write.parquet(f"{source}/part=0")
    with pytest.raises(ValueError, match="before"):
        load_files(spark, str(source), store, columns=["name"], chunk_size=7)


def test_file_load_commits_step_by_step_and_stops_at_the_cap(spark, tmp_path, store):
    source = tmp_path / "source"
    names = [f"n{i:02d}" for i in range(50)]
    for i in range(5):
        table(spark, names[10 * i : 10 * i + 10]).select("name").coalesce(1).write.parquet(f"{source}/part={i}")
    steps = []
    state = load_files(spark, str(source), store, columns=["name"], cap=25, step_files=1, on_step=steps.append)
    assert [s["total_unique_records"] for s in steps] == [10, 20, 25] and state["status"] == DONE
    assert stored_names(spark, store) == names[:25]


def test_a_cap_that_is_reached_reads_nothing(spark, store, monkeypatch):
    load_table(table(spark, ["a", "b"]), ["seq"], store, "x", ["name"], cap=2)
    monkeypatch.setattr(load_module, "ordered_rows", lambda *_: pytest.fail("sorted"))
    assert load_table(table(spark, ["c"]), ["seq"], store, "y", ["name"], cap=2)["status"] == DONE


def test_a_new_batch_waits_for_an_unfinished_one(spark, store):
    names = draws(19, 40, 30)
    load_table(table(spark, names), ["seq"], store, "a", ["name"], chunk_size=10, max_chunks=1)
    with pytest.raises(ValueError, match="unfinished"):
        load_table(table(spark, names), ["seq"], store, "b", ["name"], chunk_size=10)
    load_table(table(spark, names), ["seq"], store, "a", ["name"], chunk_size=10)
    assert stored_names(spark, store) == sorted(set(names))


def test_a_store_remembers_what_its_hashes_are_made_of(spark, tmp_path):
    df = spark.createDataFrame([(i, f"a{i}", f"b{i}") for i in range(10)], "seq long, a string, b string")
    store = LoadStore(f"{tmp_path}/store", 4)
    load_table(df, ["seq"], store, "one", ["a", "b"])
    with pytest.raises(ValueError, match="sha256"):
        load_table(df, ["seq"], store, "two", ["a", "b"], algorithm="md5")
    with pytest.raises(ValueError, match="hashes of"):
        load_table(df, ["seq"], store, "three", ["a"])
    load_table(df, ["seq"], store, "four", ["b", "a"])
    assert report_totals(load_reports(spark, store)).first()["total_unique_records"] == 10
    turned = df.select("seq", F.col("a").alias("b"), F.col("b").alias("a"))
    load_table(turned, ["seq"], store, "five", ["a", "b"])
    assert report_totals(load_reports(spark, store)).first()["total_unique_records"] == 20


def test_different_rows_with_one_hash_are_counted(spark):
    rows = [(b"h", 1, 0), (b"h", 2, 1), (b"h", 1, 2), (b"g", 5, 3)]
    groups = chunk_groups(spark.createDataFrame(rows, "record_hash binary, check_hash int, position long"), 10)
    seen = spark.createDataFrame([], "record_hash binary")
    report = chunk_report(groups, new_records(groups, seen), 10).first()
    assert (report["rows"], report["in_chunk"], report["hash_dedup"], report["new"]) == (4, 1, 1, 2)


def test_loads_of_different_tasks_share_numbers(spark, store):
    load_table(table(spark, ["a", "b"]), ["seq"], store, "x", ["name"], task="one")
    load_table(table(spark, ["b", "c"]), ["seq"], store, "y", ["name"], task="two")
    state = read_state(spark, store)
    assert state.visible == (0, 2)
    assert state.rows["one"]["total_unique_records"] == 2 and state.rows["two"]["total_unique_records"] == 1
    assert threading.active_count() < 50
