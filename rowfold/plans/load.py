"""The de-duplicating load: hash, drop copies, drop what is stored, cap, append, remember.

One load reads its batch twice. The first pass reduces it to (hash, chunk) counts, from which the
report, the cap and the accepted hashes follow; the second moves each accepted record once. A load
writes under its own number, which it claims first, and saves the state last. A load that dies before
that leaves nothing visible; its claim is lifted with :func:`lift_claim`, and the next load overwrites
what is there.

Stored hashes are runs with membership filters (:mod:`rowfold.plans.seen`), so that a load opens few of them, or none.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.hashing import RECORD_HASH, record_hash
from rowfold.operators.dedup import (
    at_or_before,
    chunk_groups,
    chunk_report,
    hashed_rows,
    last_position_kept,
    ordered_rows,
    row_keys,
    unseen,
    with_first,
    with_progress,
)
from rowfold.operators.distinct import distinct_by
from rowfold.operators.joins import already_seen
from rowfold.operators.positions import ASCENDING, ROW_GROUP_SPAN
from rowfold.operators.selection import can_rank, cut_at_rank, up_to
from rowfold.plans import seen as stored
from rowfold.plans.seen import SEEN_SCHEMA
from rowfold.plans.state import (
    DONE,
    PENDING,
    RUNNING,
    STATE_DEFAULTS,
    LoadState,
    LoadStore,
    Run,
    claim,
    drop_claim,
    drop_version,
    read_state,
    save_state,
    update_state,
)
from rowfold.plans.sketches import SKETCH_SCHEMA, sketch_columns
from rowfold.session import new_work_dir, path_exists, remove_work_dir, stage
from rowfold.sinks.tables import write_table
from rowfold.sources.files import empty_table, read_or_empty, row_groups, with_file_position

CHUNK_ROWS = 250_000
# Names of the state rows that a caller need not choose.
TASK = "load"
FINAL_TASK = "totals"
# Files and bytes of one step of a file load: a step is committed as a whole, and its file list is broadcast.
STEP_FILES, STEP_BYTES = 4_096, 64 << 30

REPORT_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in (
            "row_group",
            "chunk",
            "rows",
            "in_chunk",
            "hash_dedup",
            "already",
            "new",
            "capped",
            "total_new",
            "total_duplicates",
        )
    ]
)
_LOAD = T.StructField("load", T.LongType())


@dataclass(frozen=True)
class DedupPlan:
    """What a load is going to do: hashes to accept, chunk report, and where it stops."""

    accepted: DataFrame
    report: DataFrame
    unique: int
    duplicates: int
    all_new: bool
    stopped_at: tuple[int, int] | None
    #: the record's columns, if ``accepted`` has them
    keys: tuple[str, ...] = ()


def plan_dedup(
    rows: DataFrame,
    seen: DataFrame | Callable[[DataFrame], DataFrame],
    chunk_size: int,
    remaining: int | None = None,
    max_chunks: int | None = None,
    work_dir: str | None = None,
    keys: Sequence[str] = (),
    algorithm: str = "sha256",
) -> DedupPlan:
    """Decide which records of a batch are accepted, from its (hash, position) rows.

    ``seen`` are the stored hashes, or what keeps the rows whose hash is not stored (:func:`rowfold.plans.seen.not_stored`).
    ``remaining`` is how many records the cap still allows. The chunk that reaches it is the last one
    reported; its records beyond the cap are counted as ``capped`` and are not remembered. ``keys`` are the columns that stand
    for the hash (:func:`rowfold.operators.dedup.row_keys`), of which ``algorithm`` makes it.
    """
    spark = rows.sparkSession
    work_dir = work_dir or new_work_dir(spark, "plan")
    nothing = empty_table(spark, T.StructType([*SEEN_SCHEMA.fields, T.StructField("position", T.LongType())]))
    if (remaining is not None and remaining <= 0) or max_chunks == 0:
        return DedupPlan(nothing, empty_table(spark, REPORT_SCHEMA), 0, 0, False, None)

    columns = REPORT_SCHEMA.fieldNames()
    keys = tuple(keys)
    groups = stage(with_first(chunk_groups(rows, chunk_size, keys), keys), work_dir, "groups", **ASCENDING)
    # what stands for a hash is staged in its place
    digest = record_hash(rows, keys, algorithm, as_hex=False).alias(RECORD_HASH) if keys else F.col(RECORD_HASH)
    held = [*(keys or [RECORD_HASH]), "position"]
    firsts = groups.filter("is_first").select(digest, *keys, "position")
    new = unseen(firsts, seen)
    if new is not firsts:
        new = stage(new.select(*held), work_dir, "new", **ASCENDING).select(digest, *keys, "position")
    progress = stage(with_progress(chunk_report(groups, new, chunk_size)), work_dir, "progress")

    reached = F.lit(False)
    if remaining is not None:
        reached = reached | (F.col("total_new") >= remaining)
    if max_chunks is not None:
        reached = reached | (F.col("total_steps") >= max_chunks)
    fields = ["row_group", "chunk", "new", "total_new", "total_duplicates"]
    totals = progress.agg(
        F.sum("rows").alias("rows"),
        F.sum("new").alias("new"),
        F.sum("duplicates").alias("duplicates"),
        F.min(F.when(reached, F.struct(*fields))).alias("boundary"),
    ).first()
    boundary = totals["boundary"]

    report = progress.withColumn("capped", F.lit(0).cast("bigint"))
    if boundary is None:
        unique, duplicates = totals["new"] or 0, totals["duplicates"] or 0
        accepted = new if unique else nothing
        all_new = totals["rows"] == totals["new"]
        return DedupPlan(accepted, report.select(*columns), unique, duplicates, all_new, None, keys)

    at = (boundary["row_group"], boundary["chunk"])
    report = report.filter(at_or_before(*at))
    capped = 0
    if remaining is not None:
        capped = max(0, boundary["total_new"] - remaining)
    if capped:
        keep = boundary["new"] - capped
        last = last_position_kept(new, *at, chunk_size, keep)
        is_last = (F.col("row_group") == at[0]) & (F.col("chunk") == at[1])
        cut = F.when(is_last, F.lit(capped)).otherwise(F.lit(0)).cast("bigint")
        report = (
            report.withColumn("capped", cut)
            .withColumn("new", F.col("new") - F.col("capped"))
            .withColumn("total_new", F.col("total_new") - F.col("capped"))
        )
    else:
        last = at[0] * ROW_GROUP_SPAN + (at[1] + 1) * chunk_size - 1
    accepted = new.filter(F.col("position") <= last)
    unique = boundary["total_new"] - capped
    return DedupPlan(accepted, report.select(*columns), unique, boundary["total_duplicates"], False, at, keys)


def accepted_rows(
    batch: DataFrame,
    plan: DedupPlan,
    columns: Sequence[str],
    algorithm: str = "sha256",
    whole_batch: bool = True,
) -> DataFrame:
    """One full row, with its hash, per accepted record.

    Copies are dropped in the map tasks, then the rest is shuffled by hash once, for both the final
    distinct and the semi-join. Copies are equal in every column, so any of them will do. A planned
    batch (``whole_batch``: no part of it was loaded before) without any duplicate is not shuffled. Records that the plan holds
    themselves are taken from it, and if there are none the batch is not read.
    """
    if plan.unique and plan.keys:
        return plan.accepted.select(*columns, RECORD_HASH)
    if not plan.unique:
        batch = batch.limit(0)
    hashed = batch.select(*columns, record_hash(batch, columns, algorithm, as_hex=False).alias(RECORD_HASH))
    if plan.all_new and whole_batch:
        return hashed
    return already_seen(distinct_by(hashed, [RECORD_HASH]), plan.accepted.select(RECORD_HASH), RECORD_HASH)


def accepted_at(placed: DataFrame, plan: DedupPlan, columns: Sequence[str], whole_batch: bool = True) -> DataFrame:
    """Accepted rows of a batch whose rows carry their position: no hash is computed again.

    Positions are unique, so the semi-join is even however often a record is repeated.
    """
    if plan.unique and plan.keys:
        return plan.accepted.select(*columns)
    if not plan.unique:
        return placed.select(*columns).limit(0)
    if plan.all_new and whole_batch:
        return placed.select(*columns)
    kept = already_seen(placed.select(*columns, "position"), plan.accepted.select("position"), "position")
    return kept.drop("position")


# --- stored hashes


def seen_hashes(spark: SparkSession, store: LoadStore, state: LoadState | None = None) -> DataFrame:
    """Hashes of all committed records, each once; runs of lost attempts are not among the committed ones."""
    return stored.seen_hashes(spark, store, state or read_state(spark, store))


def compact_seen(spark: SparkSession, store: LoadStore) -> None:
    """Merge all runs into one; loads merge runs of one size by themselves.

    Claims a load number like any other writer, so that no load runs meanwhile.
    """
    state = read_state(spark, store)
    if not state.rows or len(state.runs) < 2:
        return
    number = state.visible[1] + 1
    attempt = claim(spark, store, number)
    stored.write_run(spark, store, attempt, empty_table(spark, SEEN_SCHEMA), state.runs)
    run = Run(attempt, sum(r.records for r in state.runs))
    _save(spark, store, state, number, [run], [r.id for r in state.runs], lambda rows: [r | {"last_load": number} for r in rows.values()])


def _save(
    spark: SparkSession,
    store: LoadStore,
    state: LoadState,
    number: int,
    runs: list[Run],
    retired: list[str],
    rows: Callable[[dict[str, dict]], list[dict]],
) -> LoadState:
    """Make a claimed number current; rows of other tasks that were saved meanwhile are kept."""

    def change(now: LoadState) -> tuple[LoadState, list[dict]]:
        if now.visible[1] >= number or now.runs != state.runs:
            raise RuntimeError(f"load {number} of {store.root} was overtaken by another writer")
        return LoadState(now.version, now.rows, runs, retired), rows(now.rows)

    saved = update_state(spark, store, change)
    # nobody reads the state before the last one any more
    stored.remove_runs(spark, store, state.retired)
    return saved


# --- contract, claims and commits


def _contract(store: LoadStore, columns: Sequence[str], algorithm: str) -> str:
    """What a store's hashes are made of, and how they are kept."""
    return f"{algorithm}({', '.join(sorted(columns))}) in {store.buckets} buckets"


def _commit(
    spark: SparkSession,
    store: LoadStore,
    plan: DedupPlan,
    rows: DataFrame,
    state: LoadState,
    row: dict,
    partition_by: Sequence[str],
    sketches: Sequence[str] = (),
) -> tuple[LoadState, dict]:
    """Claim a number, write rows, hashes and report under it, then the state that makes them visible."""
    number = state.visible[1] + 1
    attempt = claim(spark, store, number)
    wide = rows.hint("rebalance", *partition_by) if partition_by else rows
    merged = stored.to_merge(state.runs, plan.unique) if plan.unique else []
    writes: list[Callable[[], None]] = [
        lambda: write_table(wide, f"{store.target}/load={number}", "overwrite", partition_by=partition_by),
        lambda: write_table(plan.report, f"{store.report}/load={number}", "overwrite"),
    ]
    if plan.unique:
        writes.append(lambda: stored.write_run(spark, store, attempt, plan.accepted, merged))
    with ThreadPoolExecutor(len(writes)) as pool:
        # independent Spark jobs; list() raises what any of them raised
        list(pool.map(lambda write: write(), writes))
    if sketches:
        # of the rows as they were written, a narrow scan
        written = spark.read.schema(rows.schema).parquet(f"{store.target}/load={number}")
        write_table(sketch_columns(written, sketches), f"{store.sketches}/load={number}", "overwrite")
    row = row | {
        "total_unique_records": row["total_unique_records"] + plan.unique,
        "total_duplicate_records": row["total_duplicate_records"] + plan.duplicates,
        "last_load": number,
    }
    runs = [r for r in state.runs if r not in merged]
    if plan.unique:
        runs.append(Run(attempt, plan.unique + sum(r.records for r in merged)))
    return _save(spark, store, state, number, runs, [r.id for r in merged], lambda _: [row]), row


def lift_claim(spark: SparkSession, store: LoadStore) -> bool:
    """Free the number and the state claimed by a load that died; never call it while a load runs. False if none is claimed."""
    saving = drop_version(spark, store)
    return drop_claim(spark, store, read_state(spark, store).visible[1] + 1) or saving


def _finish(spark: SparkSession, store: LoadStore, row: dict) -> None:
    """Save that a batch is done which brings no load."""

    def change(now: LoadState) -> tuple[LoadState, list[dict]]:
        # loads of other tasks may have come in between
        base, last = now.visible
        return now, [row | {"base_load": max(base, row["base_load"]), "last_load": max(last, row["last_load"])}]

    update_state(spark, store, change)


def _begin(
    spark: SparkSession,
    store: LoadStore,
    task: str,
    batch_id: str,
    contract: str,
    fresh: bool,
    grows: bool = False,
    sequence: int | None = None,
) -> tuple[LoadState, dict, bool]:
    """State, row to start from, and whether there is anything to do.

    The row holds the cursor of an unfinished batch or the start of a new one. A batch that is done is skipped, but
    for one that ``grows``, which goes on behind its cursor. Batches with a ``sequence`` number are done up to the last
    one. A new batch is refused while another of the same task is unfinished, and so are hashes of another make.
    """
    if fresh:
        reset_load(spark, store)
    state = read_state(spark, store)
    row = state.of(task)
    known = state.contract
    if known is not None and known != contract:
        raise ValueError(f"the store holds hashes of {known}, not of {contract}")
    row["contract"] = contract
    if row["batch_id"] == batch_id:
        pending = row["status"] != DONE or grows
        return state, row | ({"status": RUNNING} if pending else {}), pending
    if sequence is not None and row["batch_id"] is not None and sequence <= int(row["batch_id"]):
        return state, row, False
    if row["status"] == RUNNING:
        raise ValueError(f"batch {row['batch_id']!r} of task {task!r} is unfinished; finish it before {batch_id!r}")
    start = {"batch_id": batch_id, "last_processed_row_group": 0, "last_processed_chunk": 0, "last_file": None}
    return state, row | start | {"status": RUNNING}, True


def _remaining(cap: int | None, row: dict) -> int | None:
    return None if cap is None else cap - row["total_unique_records"]


def _full(cap: int | None, row: dict) -> bool:
    return cap is not None and row["total_unique_records"] >= cap


def load_table(
    batch: DataFrame,
    order: Sequence[str],
    store: LoadStore,
    batch_id: str,
    columns: Sequence[str] | None = None,
    cap: int | None = None,
    chunk_size: int = CHUNK_ROWS,
    max_chunks: int | None = None,
    task: str = TASK,
    fresh: bool = False,
    algorithm: str = "sha256",
    partition_by: Sequence[str] = (),
    sequence: int | None = None,
    sketches: Sequence[str] = (),
) -> dict:
    """Load any table whose arrival order is given by columns; returns the task's state row.

    ``columns`` make up the record (all by default); ``order`` may use others. ``max_chunks`` commits after
    that many chunks; calling again with the same ``batch_id`` resumes from there, on the numbered hashes that
    the store keeps until the batch is done. A cap that is reached already reads nothing.
    """
    spark = batch.sparkSession
    columns = list(columns or batch.columns)
    state, row, pending = _begin(spark, store, task, batch_id, _contract(store, columns, algorithm), fresh, sequence=sequence)
    if not pending:
        return row
    if _full(cap, row):
        row["status"] = DONE
        _finish(spark, store, row)
        return row
    work_dir = new_work_dir(spark, "load")
    numbered = store.numbered(task, batch_id)
    keys = row_keys(batch, columns, algorithm, order)
    not_stored = stored.not_stored(spark, store, state, work_dir, record_hash(batch, columns, algorithm, as_hex=False))
    if max_chunks is None and not path_exists(spark, f"{numbered}/rows/_SUCCESS"):
        part, plan = _capped_plan(batch, order, columns, algorithm, not_stored, chunk_size, _remaining(cap, row), work_dir)
    else:
        if not path_exists(spark, f"{numbered}/rows/_SUCCESS"):
            rows = ordered_rows(batch, order, columns, algorithm, work_dir)
            write_table(rows.select(*keys, "position") if keys else rows, f"{numbered}/rows", "overwrite")
        held = spark.read.parquet(f"{numbered}/rows")
        if RECORD_HASH in held.columns:
            keys = []
        rows = after_cursor(hashed_rows(held, keys, algorithm) if keys else held, chunk_size, row)
        if max_chunks is not None:
            # no chunk behind the last one allowed is looked at
            rows = rows.filter(F.col("position") < (row["last_processed_chunk"] + max_chunks) * chunk_size)
        part = batch
        plan = plan_dedup(rows, not_stored, chunk_size, _remaining(cap, row), max_chunks, work_dir, keys, algorithm)
    found = accepted_rows(part, plan, columns, algorithm, whole_batch=row["last_processed_chunk"] == 0)
    _move_cursor(row, plan, cap, end=1, whole=True)
    _, row = _commit(spark, store, plan, found.drop(RECORD_HASH), state, row, partition_by, sketches)
    if row["status"] == DONE and path_exists(spark, numbered):
        remove_work_dir(spark, numbered)
    remove_work_dir(spark, work_dir)
    return row


def _capped_plan(
    batch: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    algorithm: str,
    not_stored: Callable[[DataFrame], DataFrame],
    chunk_size: int,
    remaining: int | None,
    work_dir: str,
) -> tuple[DataFrame, DedupPlan]:
    """The plan of a batch, and the part of it that it covers: with a cap, what lies before a cut of the order key.

    The first rows up to a key have the same positions as among all rows. As many are taken as the cap allows records, and a
    chunk; if the cap lies further behind, twice as many, and so on. Only those are hashed and sorted.
    """
    cut, wanted = None, None
    if remaining is not None and can_rank(batch, order[0]):
        wanted = (-(-remaining // chunk_size) + 1) * chunk_size
    while True:
        step_dir = f"{work_dir}/up-to-{wanted}"
        cut = cut_at_rank(batch, order[0], wanted) if wanted is not None else None
        part = up_to(batch, order[0], cut) if cut is not None else batch
        rows, keys = ordered_rows(part, order, columns, algorithm, step_dir), row_keys(batch, columns, algorithm, order)
        plan = plan_dedup(rows, not_stored, chunk_size, remaining, work_dir=step_dir, keys=keys, algorithm=algorithm)
        # the chunk that reaches the cap has to be whole
        if cut is None or (plan.stopped_at is not None and cut.rows >= (plan.stopped_at[1] + 1) * chunk_size):
            return part, plan
        wanted = 2 * cut.rows


def load_files(
    spark: SparkSession,
    path: str,
    store: LoadStore,
    batch_id: str | None = None,
    columns: Sequence[str] | None = None,
    cap: int | None = None,
    chunk_size: int = CHUNK_ROWS,
    max_chunks: int | None = None,
    task: str = TASK,
    fresh: bool = False,
    algorithm: str = "sha256",
    partition_by: Sequence[str] = (),
    step_files: int = STEP_FILES,
    step_bytes: int = STEP_BYTES,
    sketches: Sequence[str] = (),
    on_step: Callable[[dict], None] | None = None,
) -> dict:
    """Load Parquet files in path order; a file is a row group and positions come from the scan.

    Nothing is sorted. The load runs in steps of ``step_files`` files, commits each, tells ``on_step`` the state row,
    and stops when the cap is reached, so a failure loses a step at most. Files before the cursor are not read again. A
    folder that has grown is gone on with: new files must come behind those loaded before, by path.
    """
    columns = list(columns or spark.read.parquet(path).columns)
    contract = _contract(store, columns, algorithm)
    state, row, pending = _begin(spark, store, task, batch_id or path, contract, fresh, grows=True)
    if _full(cap, row):
        if row["status"] != DONE:
            row["status"] = DONE
            _finish(spark, store, row)
        return row
    work_dir = new_work_dir(spark, "load")
    files = spark.read.parquet(path)
    groups = stage(row_groups(files, path), work_dir, "files")
    count = groups.count()
    _check_cursor(groups, row)
    left, committed = max_chunks, False
    while row["last_processed_row_group"] < count and left != 0:
        start = row["last_processed_row_group"]
        # a step of few chunks needs no more files than these can reach
        stop = min(count, start + (step_files if left is None else min(step_files, left)), _reach(groups, start, step_bytes))
        step_dir = f"{work_dir}/step-{start}-{row['last_processed_chunk']}"
        plan, before = _step(spark, files, groups, store, state, row, columns, chunk_size, cap, left, algorithm, start, stop, step_dir)
        _move_cursor(row, plan, cap, end=stop, whole=stop == count)
        row["last_file"] = _file_at(groups, row["last_processed_row_group"] - 1)
        state, row = _commit(spark, store, plan, before, state, row, partition_by, sketches)
        committed = True
        remove_work_dir(spark, step_dir)
        if left is not None:
            left = max(0, left - spark.read.parquet(f"{store.report}/load={row['last_load']}").count())
        if on_step is not None:
            on_step(dict(row))
        if _full(cap, row):
            break
    if not committed:
        row["status"] = DONE
        if count == 0 or state.of(task)["status"] != DONE:
            _finish(spark, store, row)
    remove_work_dir(spark, work_dir)
    return row


def _reach(groups: DataFrame, start: int, size: int) -> int:
    """The number of the first file that the bytes of one step do not reach; at least one file is taken."""
    before = groups.filter(F.col("row_group") == start).select("bytes_before").first()[0]
    inside = groups.filter((F.col("row_group") > start) & (F.col("bytes_before") + F.col("bytes") > before + size))
    first = inside.agg(F.min("row_group")).first()[0]
    return groups.count() if first is None else first


def _step(spark, files, groups, store, state, row, columns, chunk_size, cap, max_chunks, algorithm, start, stop, work_dir):
    """Plan and accepted rows of the files ``start`` to ``stop``."""
    inside = groups.filter((F.col("row_group") >= start) & (F.col("row_group") < stop))
    placed = with_file_position(files, inside, stop - start)
    hashed = after_cursor(hashed_rows(placed, columns, algorithm), chunk_size, row)
    keys = row_keys(files, columns, algorithm)
    not_stored = stored.not_stored(spark, store, state, work_dir, record_hash(files, columns, algorithm, as_hex=False))
    plan = plan_dedup(hashed, not_stored, chunk_size, _remaining(cap, row), max_chunks, work_dir, keys, algorithm)
    return plan, accepted_at(placed, plan, columns, whole_batch=row["last_processed_chunk"] == 0)


def _file_at(groups: DataFrame, number: int) -> str | None:
    found = groups.filter(F.col("row_group") == number).select("file_path").first()
    return found["file_path"] if found else None


def _check_cursor(groups: DataFrame, row: dict) -> None:
    """Files loaded before must still be the first ones by path."""
    last = row["last_file"]
    if last is not None and _file_at(groups, row["last_processed_row_group"] - 1) != last:
        raise ValueError(f"files were added or removed before {last}, up to which the folder is loaded")


def _move_cursor(row: dict, plan: DedupPlan, cap: int | None, end: int, whole: bool) -> None:
    """Point the state at the next unit: after the chunk the plan stopped at, else at group ``end``."""
    full = cap is not None and row["total_unique_records"] + plan.unique >= cap
    if plan.stopped_at is not None:
        row["last_processed_row_group"], row["last_processed_chunk"] = plan.stopped_at[0], plan.stopped_at[1] + 1
    elif not full:
        row["last_processed_row_group"], row["last_processed_chunk"] = end, 0
    finished = plan.stopped_at is None and whole
    row["status"] = DONE if full or finished else RUNNING


def after_cursor(rows: DataFrame, chunk_size: int, row: dict) -> DataFrame:
    """Rows at or after the saved cursor."""
    group, chunk = row["last_processed_row_group"], row["last_processed_chunk"]
    if (group, chunk) == (0, 0):
        return rows
    return rows.filter(F.col("position") >= group * ROW_GROUP_SPAN + chunk * chunk_size)


# --- results


def _visible(
    spark: SparkSession, store: LoadStore, path: str, schema: T.StructType, state: LoadState | None = None
) -> DataFrame:
    base, last = (state or read_state(spark, store)).visible
    table = read_or_empty(spark, path, T.StructType([*schema.fields, _LOAD]))
    return table.filter((F.col("load") > base) & (F.col("load") <= last))


def loaded_rows(spark: SparkSession, store: LoadStore, schema: T.StructType) -> DataFrame:
    """Committed rows, with the number of the load that brought them."""
    return _visible(spark, store, store.target, schema)


def load_reports(spark: SparkSession, store: LoadStore) -> DataFrame:
    """Chunk reports of all committed loads; ``total_*`` run within a load."""
    return _visible(spark, store, store.report, REPORT_SCHEMA)


def load_sketches(spark: SparkSession, store: LoadStore) -> DataFrame:
    """``column, hll, theta, load`` of all committed loads that were asked for sketches; unite them with
    :func:`rowfold.plans.sketches.distinct_counts`."""
    return _visible(spark, store, store.sketches, SKETCH_SCHEMA)


def report_totals(report: DataFrame) -> DataFrame:
    duplicates = F.col("in_chunk") + F.col("hash_dedup") + F.col("already")
    return report.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("total_unique_records"),
        F.coalesce(F.sum(duplicates), F.lit(0)).alias("total_duplicate_records"),
        F.coalesce(F.sum("capped"), F.lit(0)).alias("capped"),
    )


def finalize_load(spark: SparkSession, store: LoadStore, task: str = FINAL_TASK) -> dict:
    """Save the totals of all committed reports as a state row of their own."""
    saved: dict = {}

    def change(now: LoadState) -> tuple[LoadState, list[dict]]:
        # of the loads of the very state that the row is saved into
        totals = report_totals(_visible(spark, store, store.report, REPORT_SCHEMA, now)).first()
        saved.update(now.of(task) | {"status": DONE})
        saved.update({c: totals[c] for c in ("total_unique_records", "total_duplicate_records")})
        return now, [saved]

    update_state(spark, store, change)
    return dict(saved)


def reset_load(spark: SparkSession, store: LoadStore) -> None:
    """Empty the store: one state save hides all loads, then their files are overwritten with nothing.

    Claims a load number, so it fails while a load runs.
    """
    state = read_state(spark, store)
    _, last = state.visible
    if last == 0:
        return
    number = last + 1
    claim(spark, store, number)
    empty = {**STATE_DEFAULTS, "status": PENDING, "base_load": number, "last_load": number}
    _save(spark, store, state, number, [], [r.id for r in state.runs], lambda rows: [{"task": task, **empty} for task in rows])
    hollow = empty_table(spark, T.StructType([*SEEN_SCHEMA.fields, _LOAD]))
    for path in (store.target, store.report):
        write_table(hollow, path, "overwrite", partition_by=["load"])
