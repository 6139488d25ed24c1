"""The de-duplicating load on order lines, whose (order, line) keys repeat."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowfold.operators.dedup import ordered_rows, row_keys
from rowfold.plans.load import (
    SEEN_SCHEMA,
    compact_seen,
    finalize_load,
    load_files,
    load_reports,
    load_sketches,
    load_table,
    loaded_rows,
    plan_dedup,
)
from rowfold.plans.sketches import distinct_counts, new_values
from rowfold.plans.state import LoadStore, read_state, state_table
from rowfold.registry import query, table, table_path
from rowfold.session import new_work_dir
from rowfold.sources.files import empty_table

KEYS = ["l_orderkey", "l_linenumber"]
ORDER = ["l_shipdate", "l_orderkey", "l_linenumber"]
CHUNK = 10_000

# one row per line in arrival order, with its chunk and its rank among the copies of its key
RANKED = f"""
  positioned AS (
    SELECT l_orderkey, l_linenumber,
           row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS position FROM lineitem),
  chunked AS (SELECT *, position // {CHUNK} AS chunk FROM positioned),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY chunk, l_orderkey, l_linenumber ORDER BY position) AS in_chunk_rank,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY position) AS overall_rank
    FROM chunked),
  report AS (
    SELECT chunk, count(*) AS rows, count(*) FILTER (in_chunk_rank > 1) AS in_chunk,
           count(*) FILTER (in_chunk_rank = 1 AND overall_rank > 1) AS already,
           count(*) FILTER (overall_rank = 1) AS new FROM ranked GROUP BY chunk)
"""


def load_buckets(spark) -> int:
    """Buckets for a store that holds one table of the session's size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _store(spark) -> LoadStore:
    return LoadStore(new_work_dir(spark, "store"), load_buckets(spark))


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query(
    "dedup_report",
    f"""WITH {RANKED}
    SELECT CAST(0 AS BIGINT) AS row_group, chunk, rows, in_chunk, CAST(0 AS BIGINT) AS hash_dedup, already, new,
           CAST(0 AS BIGINT) AS capped, CAST(sum(new) OVER w AS BIGINT) AS total_new,
           CAST(sum(in_chunk + already) OVER w AS BIGINT) AS total_duplicates
    FROM report WINDOW w AS (ORDER BY chunk)""",
)
def dedup_report(spark, sf_dir):
    rows = ordered_rows(_lines(spark, sf_dir).select(*ORDER), ORDER, KEYS)
    keys = row_keys(_lines(spark, sf_dir), KEYS, order=ORDER)
    return plan_dedup(rows, empty_table(spark, SEEN_SCHEMA), CHUNK, keys=keys).report


@query(
    "two_batch_load",
    """WITH first AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'),
        every AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
        counts AS (SELECT (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS rows1,
          (SELECT count(*) FROM first) AS new1, (SELECT count(*) FROM lineitem) AS rows2,
          (SELECT count(*) FROM every) - (SELECT count(*) FROM first) AS new2)
       SELECT CAST(1 AS BIGINT) AS load, rows1 AS rows, new1 AS unique_records, rows1 - new1 AS duplicate_records,
         new1 AS loaded FROM counts
       UNION ALL SELECT 2, rows2, new2, rows2 - new2, new2 FROM counts""",
)
def two_batch_load(spark, sf_dir):
    """Returned lines first, then the file with all lines on top."""
    store = _store(spark)
    lines = _lines(spark, sf_dir)
    load_table(lines.filter(F.col("l_returnflag") == "R").select(*ORDER), ORDER, store, "returned", KEYS, chunk_size=CHUNK)
    load_files(spark, table_path(sf_dir, "lineitem"), store, "all", KEYS, chunk_size=CHUNK)
    reports = load_reports(spark, store).groupBy("load").agg(
        F.sum("rows").alias("rows"),
        F.sum("new").alias("unique_records"),
        F.sum(F.col("in_chunk") + F.col("hash_dedup") + F.col("already")).alias("duplicate_records"),
    )
    loaded = loaded_rows(spark, store, lines.select(*KEYS).schema).groupBy("load").agg(F.count("*").alias("loaded"))
    return reports.join(loaded, "load")


@query(
    "loaded_keys",
    "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
)
def loaded_keys(spark, sf_dir):
    """Rows that a load of the line file stores."""
    store = _store(spark)
    load_files(spark, table_path(sf_dir, "lineitem"), store, columns=KEYS, chunk_size=CHUNK)
    return loaded_rows(spark, store, _lines(spark, sf_dir).select(*KEYS).schema).drop("load")


@query(
    "fresh_load",
    """WITH every AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
       SELECT 'totals' AS task, n AS total_unique_records, (SELECT count(*) FROM lineitem) - n
         AS total_duplicate_records, 'DONE' AS status FROM every
       UNION ALL SELECT 'load', n, (SELECT count(*) FROM lineitem) - n, 'DONE' FROM every""",
)
def fresh_load(spark, sf_dir):
    """A load that empties the store first does not know the lines loaded before."""
    store = _store(spark)
    returned = _lines(spark, sf_dir).filter(F.col("l_returnflag") == "R").select(*ORDER)
    load_table(returned, ORDER, store, "returned", KEYS, chunk_size=CHUNK)
    load_files(spark, table_path(sf_dir, "lineitem"), store, "all", KEYS, chunk_size=CHUNK, fresh=True)
    finalize_load(spark, store)
    return state_table(spark, store).select("task", "total_unique_records", "total_duplicate_records", "status")


@query(
    "capped_load",
    f"""WITH {RANKED}
    SELECT l_orderkey, l_linenumber FROM ranked WHERE overall_rank = 1
    ORDER BY position LIMIT (SELECT count(*) // 2 FROM lineitem)""",
)
def capped_load(spark, sf_dir):
    """Only as many records as half the lines are let in, the first by arrival."""
    store = _store(spark)
    lines = _lines(spark, sf_dir).select(*ORDER)
    load_table(lines, ORDER, store, "lines", KEYS, cap=lines.count() // 2, chunk_size=CHUNK)
    return loaded_rows(spark, store, lines.select(*KEYS).schema).drop("load")


@query(
    "resume_load",
    f"""WITH {RANKED}
    SELECT CAST(CASE WHEN chunk < 2 THEN 1 ELSE 2 END AS BIGINT) AS load, chunk, rows, in_chunk, already, new
    FROM report""",
)
def resume_load(spark, sf_dir):
    """Stop after two chunks, then go on from the saved cursor."""
    store = _store(spark)
    lines = _lines(spark, sf_dir).select(*ORDER)
    for max_chunks in (2, None):
        load_table(lines, ORDER, store, "lines", KEYS, chunk_size=CHUNK, max_chunks=max_chunks)
    return load_reports(spark, store).select("load", "chunk", "rows", "in_chunk", "already", "new")


@query(
    "grown_load",
    """WITH done AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
        later AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus <> 'F')
       SELECT CAST(1 AS BIGINT) AS folders, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS rows,
         (SELECT count(*) FROM done) AS stored
       UNION ALL SELECT 2, (SELECT count(*) FROM orders),
         (SELECT count(*) FROM (SELECT * FROM done UNION SELECT * FROM later))""",
)
def grown_load(spark, sf_dir):
    """A folder is loaded, grows by more files, and is gone on with."""
    store, path = _store(spark), new_work_dir(spark, "grown")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    finished, counts = F.col("o_orderstatus") == "F", []
    for number, part in enumerate((orders.filter(finished), orders.filter(~finished)), 1):
        part.select("o_custkey").write.parquet(f"{path}/part={number}")
        load_files(spark, path, store, columns=["o_custkey"], chunk_size=CHUNK)
        totals = load_reports(spark, store).agg(F.sum("rows").alias("rows"), F.sum("new").alias("stored"))
        # written down before the folder grows
        counts.append((number, *totals.first()))
    return spark.createDataFrame(counts, "folders bigint, rows bigint, stored bigint")


@query(
    "second_load_report",
    f"""WITH {RANKED}
    SELECT CAST(0 AS BIGINT) AS row_group, chunk, rows, in_chunk, rows - in_chunk AS already, CAST(0 AS BIGINT) AS new
    FROM report""",
)
def second_load_report(spark, sf_dir):
    """All lines once more, after compaction of the stored hashes: each chunk's report."""
    store = _store(spark)
    lines = _lines(spark, sf_dir).select(*ORDER)
    load_table(lines, ORDER, store, "first", KEYS, chunk_size=CHUNK)
    compact_seen(spark, store)
    load_table(lines, ORDER, store, "second", KEYS, chunk_size=CHUNK)
    last = load_reports(spark, store)
    last = last.join(last.agg(F.max("load").alias("load")), "load", "left_semi")
    return last.select("row_group", "chunk", "rows", "in_chunk", "already", "new")


@query(
    "filtered_load",
    """WITH parts AS (SELECT *, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE 2 END AS load FROM lineitem),
        counts AS (SELECT load, count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS new FROM parts GROUP BY load)
       SELECT CAST(load AS BIGINT) AS load, rows, rows - new AS duplicates, new FROM counts""",
)
def filtered_load(spark, sf_dir):
    """Lines of even orders, then those of odd ones: all keys of the second load are new, and no run is opened for them."""
    store = _store(spark)
    lines = _lines(spark, sf_dir).select(*ORDER)
    for name, part in (("even", lines.filter("l_orderkey % 2 = 0")), ("odd", lines.filter("l_orderkey % 2 <> 0"))):
        load_table(part, ORDER, store, name, KEYS, chunk_size=CHUNK)
    duplicates = F.sum(F.col("in_chunk") + F.col("hash_dedup") + F.col("already")).alias("duplicates")
    return load_reports(spark, store).groupBy("load").agg(F.sum("rows").alias("rows"), duplicates, F.sum("new").alias("new"))


PARTS = 9


@query(
    "many_loads",
    f"""SELECT CAST({PARTS} AS BIGINT) AS loads, true AS few_runs, l_orderkey, l_linenumber
       FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
)
def many_loads(spark, sf_dir):
    """The lines in parts by supplier, so that keys come in several of them: all rows, in few runs of hashes."""
    store = _store(spark)
    lines = _lines(spark, sf_dir).select(*ORDER, "l_suppkey")
    for part in range(PARTS):
        load_table(lines.filter(F.col("l_suppkey") % PARTS == part).drop("l_suppkey"), ORDER, store, f"part-{part}", KEYS, chunk_size=CHUNK)
    few = len(read_state(spark, store).runs) <= 6
    rows = loaded_rows(spark, store, lines.select(*KEYS).schema)
    loads = load_reports(spark, store).select("load").distinct().count()
    return rows.select(F.lit(loads).cast("bigint").alias("loads"), F.lit(few).alias("few_runs"), *KEYS)


SKETCHED = ["o_orderkey", "o_custkey", "o_orderdate"]


@query(
    "load_sketches",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS exact, count(DISTINCT {c}) - count(DISTINCT {c}) FILTER (o_orderstatus = 'F')
        AS exact_added, true AS distinct_in_bounds, true AS added_in_bounds FROM orders"""
        for c in SKETCHED
    ),
)
def load_sketches_of_orders(spark, sf_dir):
    """Finished orders, then the others: distinct values and new ones by sketches alone, beside the exact counts."""
    store = _store(spark)
    orders = table(spark, sf_dir, "orders").select(*SKETCHED, "o_orderstatus")
    finished = F.col("o_orderstatus") == "F"
    for name, part in (("finished", orders.filter(finished)), ("open", orders.filter(~finished))):
        load_table(part, ["o_orderkey"], store, name, SKETCHED, chunk_size=CHUNK, sketches=SKETCHED)
    held = load_sketches(spark, store)
    last = held.agg(F.max("load")).first()[0]
    rows = loaded_rows(spark, store, orders.select(*SKETCHED).schema)
    counts = []
    for c in SKETCHED:
        ends = rows.agg(F.countDistinct(c).alias("exact"), F.countDistinct(F.when(F.col("load") < last, F.col(c))).alias("before"))
        counts.append(ends.select(F.lit(c).alias("column"), "exact", (F.col("exact") - F.col("before")).alias("exact_added")))
    exact = counts[0].unionByName(counts[1]).unionByName(counts[2])
    united = distinct_counts(held)
    added = new_values(held, last).withColumnRenamed("error", "added_error")
    met = exact.join(united, "column").join(added, "column")
    return met.select(
        "column",
        "exact",
        "exact_added",
        (F.abs(F.col("distinct") - F.col("exact")) <= F.col("error")).alias("distinct_in_bounds"),
        (F.abs(F.col("added") - F.col("exact_added")) <= F.col("added_error")).alias("added_in_bounds"),
    )
