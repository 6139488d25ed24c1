"""Load state: one small row per task, saved as the commit point of every load.

Two directories take turns. A new version goes to the one that does not hold the current version, so
a writer that dies half-way leaves the current version whole.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowfold.session import create_new, path_exists, remove_work_dir
from rowfold.sources.files import read_or_empty

PENDING, RUNNING, DONE = "PENDING", "RUNNING", "DONE"

STATE_SCHEMA = T.StructType(
    [
        T.StructField("task", T.StringType()),
        T.StructField("last_processed_row_group", T.LongType()),
        T.StructField("last_processed_chunk", T.LongType()),
        T.StructField("total_unique_records", T.LongType()),
        T.StructField("total_duplicate_records", T.LongType()),
        T.StructField("status", T.StringType()),
        # batch the cursor belongs to, last load of any task when the row was saved, and the last
        # load before the store was emptied
        T.StructField("batch_id", T.StringType()),
        T.StructField("last_load", T.LongType()),
        T.StructField("base_load", T.LongType()),
        # what the store's hashes are made of, and the last whole file of a file load
        T.StructField("contract", T.StringType()),
        T.StructField("last_file", T.StringType()),
    ]
)
_LOG_SCHEMA = T.StructType(
    [
        *STATE_SCHEMA.fields,
        T.StructField("version", T.LongType()),
        # the runs of stored hashes, with their sizes, and those that were merged into them by the last commit
        T.StructField(
            "runs", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("records", T.LongType())]))
        ),
        T.StructField("retired", T.ArrayType(T.StringType())),
        T.StructField("slot", T.IntegerType()),
    ]
)
STATE_DEFAULTS = {
    "last_processed_row_group": 0,
    "last_processed_chunk": 0,
    "total_unique_records": 0,
    "total_duplicate_records": 0,
    "status": PENDING,
    "batch_id": None,
    "last_load": 0,
    "base_load": 0,
    "contract": None,
    "last_file": None,
}


@dataclass(frozen=True)
class LoadStore:
    """Where a load keeps its rows, hashes, reports and state.

    ``buckets`` is how many files the stored hashes are spread over, about one for each 50 million records that the store
    is to hold; it cannot change later.
    """

    root: str
    buckets: int = 16

    @property
    def target(self) -> str:
        return f"{self.root}/target"

    def run(self, run: str) -> str:
        return f"{self.root}/seen/{run}"

    def filters(self, run: str) -> str:
        return f"{self.root}/filters/{run}"

    def numbered(self, task: str, batch_id: str) -> str:
        """Numbered hashes of a batch that is loaded in steps."""
        return f"{self.root}/numbered/{hashlib.md5(f'{task}|{batch_id}'.encode()).hexdigest()}"

    def claim(self, number: int) -> str:
        return f"{self.root}/claims/{number}"

    def version(self, number: int) -> str:
        return f"{self.root}/versions/{number}"

    @property
    def report(self) -> str:
        return f"{self.root}/report"

    @property
    def sketches(self) -> str:
        return f"{self.root}/sketches"

    @property
    def state(self) -> str:
        return f"{self.root}/state"


class StateMoved(RuntimeError):
    """Another writer saved a state, or is about to, since the one at hand was read."""


@dataclass(frozen=True)
class Run:
    """Stored hashes that were written together."""

    id: str
    records: int


@dataclass
class LoadState:
    """The current state version: one dict per task, as few rows as there are tasks."""

    version: int
    rows: dict[str, dict]
    runs: list[Run] = field(default_factory=list)
    retired: list[str] = field(default_factory=list)

    @property
    def contract(self) -> str | None:
        return next((r["contract"] for r in self.rows.values() if r["contract"] is not None), None)

    @property
    def visible(self) -> tuple[int, int]:
        """Numbers (base, last): committed data is in loads ``base < n <= last``."""
        base = max((r["base_load"] for r in self.rows.values()), default=0)
        return base, max((r["last_load"] for r in self.rows.values()), default=0)

    def of(self, task: str) -> dict:
        """A copy of one task's row, with defaults when it has none."""
        base, last = self.visible
        return dict(self.rows.get(task) or {"task": task, **STATE_DEFAULTS, "base_load": base, "last_load": last})


def read_state(spark: SparkSession, store: LoadStore) -> LoadState:
    log = [r.asDict() for r in read_or_empty(spark, store.state, _LOG_SCHEMA).collect()]
    version = max((r["version"] for r in log), default=0)
    names = STATE_SCHEMA.fieldNames()
    current = [{n: r[n] for n in names} for r in log if r["version"] == version]
    own = next((r for r in log if r["version"] == version), None)
    runs = [Run(r["id"], r["records"]) for r in own["runs"]] if own else []
    return LoadState(version, {r["task"]: r for r in current}, runs, list(own["retired"]) if own else [])


def save_state(spark: SparkSession, store: LoadStore, state: LoadState, *changed: dict) -> LoadState:
    """Upsert rows by task and make the result the current version, if the one it was made from still is.

    A version is claimed by a file that must not exist yet, so of two writers with one version at hand the second fails
    with :class:`StateMoved`. Old claims are removed; a writer that is far behind gets one of these, but then sees the newer state.
    A writer that dies between claim and save holds the next version until :func:`drop_version` lifts its claim.
    """
    changes = {r["task"]: dict(r) for r in changed}
    saved = LoadState(state.version + 1, {**state.rows, **changes}, state.runs, state.retired)
    own = store.version(saved.version)
    try:
        create_new(spark, own, "")
    except Py4JJavaError as error:
        if not path_exists(spark, own):
            raise
        raise StateMoved(f"state {saved.version} of {store.root} belongs to another writer, or to one that died") from error
    if read_state(spark, store).version != state.version:
        remove_work_dir(spark, own)
        raise StateMoved(f"state {state.version} of {store.root} is no longer the current one")
    runs = [(r.id, r.records) for r in saved.runs]
    rows = [(*[r[n] for n in STATE_SCHEMA.fieldNames()], saved.version, runs, saved.retired) for r in saved.rows.values()]
    table = spark.createDataFrame(rows, T.StructType(_LOG_SCHEMA.fields[:-1]))
    table.coalesce(1).write.mode("overwrite").parquet(f"{store.state}/slot={saved.version % 2}")
    if path_exists(spark, store.version(saved.version - 2)):
        remove_work_dir(spark, store.version(saved.version - 2))
    return saved


def update_state(
    spark: SparkSession, store: LoadStore, change: Callable[[LoadState], tuple[LoadState, list[dict]]], tries: int = 20
) -> LoadState:
    """Save what ``change`` makes of the current state; another writer's save in between is taken in by asking it again."""
    for left in reversed(range(tries)):
        after, rows = change(read_state(spark, store))
        try:
            return save_state(spark, store, after, *rows)
        except StateMoved:
            if not left:
                raise
            time.sleep(0.2)
    raise ValueError("no tries")


def drop_version(spark: SparkSession, store: LoadStore) -> bool:
    """Lift the claim of a writer that died while it saved the state."""
    own = store.version(read_state(spark, store).version + 1)
    found = path_exists(spark, own)
    if found:
        remove_work_dir(spark, own)
    return found


def state_table(spark: SparkSession, store: LoadStore) -> DataFrame:
    """The current state as a table."""
    rows = read_state(spark, store).rows.values()
    return spark.createDataFrame([tuple(r[n] for n in STATE_SCHEMA.fieldNames()) for r in rows], STATE_SCHEMA)


def claim(spark: SparkSession, store: LoadStore, number: int) -> str:
    """Take a load number for this writer alone; returns the name of the attempt.

    The claim is a file that must not exist yet. It stays when the load is committed; that of a writer that died has to be
    lifted by hand, because only its owner knows that it is dead.
    """
    attempt = uuid.uuid4().hex
    try:
        create_new(spark, store.claim(number), attempt)
    except Py4JJavaError as error:
        if not path_exists(spark, store.claim(number)):
            raise
        raise RuntimeError(f"load {number} of {store.root} belongs to another writer, or to one that died") from error
    return attempt


def drop_claim(spark: SparkSession, store: LoadStore, number: int) -> bool:
    found = path_exists(spark, store.claim(number))
    if found:
        remove_work_dir(spark, store.claim(number))
    return found
