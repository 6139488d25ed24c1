"""What a query moves and holds must not outgrow its input: plans and widths of the steps that did."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowfold import registry
from rowfold.functions.seeded import MODULUS, wide_mix
from rowfold.operators.dedup import row_keys
from rowfold.operators.sets import sample_with_replacement
from rowfold.plans import load as load_module
from rowfold.plans import seen as seen_module
from rowfold.plans.load import load_reports, load_table, loaded_rows, seen_hashes
from rowfold.plans.state import LoadStore
from rowfold.registry import rows as row_queries

SF_DIR = "/root/testdata/sf0.001"
registry.load_all()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_groups_are_met_without_sorting_the_lines(spark, monkeypatch):
    monkeypatch.setattr(row_queries, "LISTED_ROWS", 500)
    got = registry.QUERIES["row_group_listing"](spark, SF_DIR)
    plan = plan_of(got)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "SortAggregate" not in plan
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert got.collect() == [(lines, True, True, True)]
    # more lines are more files, not larger ones
    assert len(set(got.inputFiles())) >= lines // 500 // 2


KEYS, ORDER = ["a", "b"], ["at", "a", "b"]


def keyed(spark, n: int, kinds: int):
    """Records of two numbers, some of them null, in the order of a time."""
    return spark.range(n).selectExpr("id * 7 % 1009 AS at", f"IF(id % {kinds} = 0, NULL, id % {kinds}) AS a", "CAST(id % 3 AS int) AS b")


def model(rows, size: int, stored=()):
    """Chunk by chunk: rows, copies inside, stored before, new."""
    seen, report = set(stored), []
    rows = sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))
    for k in range(0, len(rows), size):
        part = [r[1:] for r in rows[k : k + size]]
        fresh = set(part) - seen
        report.append((k // size, len(part), len(part) - len(set(part)), len(set(part)) - len(fresh), len(fresh)))
        seen |= fresh
    return report, seen


def test_narrow_records_stand_for_their_hash(spark, tmp_path):
    first, second = keyed(spark, 900, 40), keyed(spark, 1500, 70)
    assert row_keys(first, KEYS, order=ORDER) == KEYS
    # a wide or inexact type, a digest that different rows may share, and records outside the order
    assert not row_keys(first.selectExpr("at", "CAST(a AS string) AS a", "b"), KEYS)
    assert not row_keys(first.selectExpr("at", "CAST(a AS double) AS a", "b"), KEYS)
    assert not row_keys(first, KEYS, "xxhash64") and not row_keys(first, KEYS, order=["at", "a"])
    seen = ()
    for number, df in enumerate((first, second, first), 1):
        for algorithm in ("sha256", "xxhash64"):
            store = LoadStore(f"file://{tmp_path}/{algorithm}", 4)
            load_table(df, ORDER, store, f"batch-{number}", KEYS, chunk_size=100, algorithm=algorithm)
        want, after = model([tuple(r) for r in df.collect()], 100, seen)
        for algorithm in ("sha256", "xxhash64"):
            store = LoadStore(f"file://{tmp_path}/{algorithm}", 4)
            report = load_reports(spark, store).filter(F.col("load") == number)
            assert sorted(map(tuple, report.select("chunk", "rows", "in_chunk", "already", "new").collect())) == want
            held = loaded_rows(spark, store, df.select(*KEYS).schema).select(*KEYS).collect()
            assert len(held) == len(after) and {tuple(r) for r in held} == after
            assert seen_hashes(spark, store).distinct().count() == seen_hashes(spark, store).count() == len(after)
        seen = after


def test_a_load_writes_a_hash_of_narrow_records_only_where_it_is_stored(spark, tmp_path, monkeypatch):
    staged = []
    for module in (load_module, seen_module):
        real = module.stage

        def noted(df, *args, real=real, **options):
            staged.append(df.columns)
            return real(df, *args, **options)

        monkeypatch.setattr(module, "stage", noted)
    store = LoadStore(f"file://{tmp_path}/store", 4)
    for name, n in (("one", 300), ("two", 500)):
        load_table(keyed(spark, n, 40), ORDER, store, name, KEYS, chunk_size=100)
    assert staged and not any("record_hash" in columns for columns in staged)


def test_a_load_of_few_chunks_looks_at_no_others(spark, tmp_path, monkeypatch):
    counted, real = [], load_module.plan_dedup
    monkeypatch.setattr(load_module, "plan_dedup", lambda rows, *args: counted.append(rows.count()) or real(rows, *args))
    store = LoadStore(f"file://{tmp_path}/store", 4)
    for most in (2, None):
        load_table(keyed(spark, 900, 40), ORDER, store, "a", KEYS, chunk_size=100, max_chunks=most)
    assert counted == [200, 700]
    assert load_reports(spark, store).count() == 9


def test_a_draw_is_written_out_once(spark):
    """Wherever a filter on it is pushed to."""
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    plan = plan_of(sample_with_replacement(lines, 0.1, 5, F.col("l_orderkey") * 10 + F.col("l_linenumber")))
    assert 0 < plan.count("48271") <= 20
    # as the nested products are
    start = lambda x, salt: (x * 48271 + salt * 40503) % MODULUS
    mixed = lambda x, salt: (start(x, salt) ** 2 % MODULUS + start(x, salt) * 16807) % MODULUS
    ids = [0, 1, 7, MODULUS - 1, MODULUS, 10**13 + 3]
    rows = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id bigint").select("id", wide_mix(F.col("id"), 5).alias("n"))
    got = {r["id"]: r["n"] for r in rows.collect()}
    for i in ids:
        second = mixed(i // MODULUS + mixed(i, 5), 6)
        assert got[i] == mixed(second + i // MODULUS, 5) * MODULUS + second
    assert got[None] is None


def test_small_files_are_written_by_many_tasks(spark, monkeypatch):
    tasks, real = [], row_queries.write_table

    def noted(df, *args, **options):
        tasks.append(df.rdd.getNumPartitions())
        return real(df, *args, **options)

    monkeypatch.setattr(row_queries, "write_table", noted)
    assert registry.QUERIES["file_counts"](spark, SF_DIR).first()["capped_files"]
    assert tasks[0] >= 4
