"""Stored hashes: sorted, bucketed runs, each with a membership filter.

A load writes the hashes it accepted as one run, a table bucketed by hash. Runs of one size are merged by the load that
would make them too many (size-tiered, ``FAN`` runs of a tier become one of the next), so a bucket has
``(FAN - 1) * log(n)`` runs at most whoever wrote them, and each hash is rewritten ``log(n)`` times.

Beside each run lies a filter of 4 bytes and a little for each hash. A batch is first shuffled into the buckets and held
against the filters there; a run's files are opened only for buckets in which some hash of the batch may be in it, and only
then are the hashes themselves compared. A filter cuts the first 64 bits of a hash into a block number and the 32 bits
behind it, and keeps the latter, sorted: it never misses a stored hash, and takes one in 70 million others for stored. A filter
row holds ``FILTER_ROWS`` hashes at most; a task holds the filters of one bucket at a time.

Runs, like everything else, count once the state that names them is saved; a run that no state names is not read. Runs that were
merged into others stay until the commit after, for readers of the state before.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.hashing import RECORD_HASH
from rowfold.operators.positions import ASCENDING
from rowfold.plans.state import LoadState, LoadStore, Run
from rowfold.session import path_exists, remove_work_dir, stage
from rowfold.sinks.tables import bucketed_table
from rowfold.sources.files import empty_table

FAN = 4
FILTER_ROWS = 1 << 20
SEEN_SCHEMA = T.StructType([T.StructField(RECORD_HASH, T.BinaryType())])
FILTER_SCHEMA = "bucket int, bits int, offsets binary, marks binary"


def bucket_of(buckets: int) -> Column:
    """The bucket that Spark files a hash in."""
    return F.pmod(F.hash(RECORD_HASH), F.lit(buckets)).cast("int")


def _file_bucket() -> Column:
    """The bucket of a file of a bucketed table, by its name."""
    return F.regexp_extract("_metadata.file_name", r"_(\d+)\.c\d+", 1).cast("int")


def run_table(spark: SparkSession, store: LoadStore, run: str) -> str:
    """The catalogue name of a run; registered in each session that uses it."""
    path = store.run(run)
    name = f"seen_{hashlib.md5(path.encode()).hexdigest()}"
    return bucketed_table(spark, name, path, SEEN_SCHEMA, RECORD_HASH, store.buckets)


def seen_hashes(spark: SparkSession, store: LoadStore, state: LoadState) -> DataFrame:
    """Hashes of all committed records, each once."""
    runs = [spark.table(run_table(spark, store, r.id)) for r in state.runs]
    return reduce(DataFrame.unionByName, runs) if runs else empty_table(spark, SEEN_SCHEMA)


# --- runs


def _tier(records: int) -> int:
    return int(math.log(max(records, 1), FAN) + 1e-9)


def to_merge(runs: list[Run], records: int) -> list[Run]:
    """The runs that a new one of ``records`` hashes takes in, so that no tier has ``FAN`` of them."""
    left, merged = list(runs), []
    while True:
        alike = [r for r in left if _tier(r.records) <= _tier(records)]
        if sum(_tier(r.records) == _tier(records) for r in alike) < FAN - 1:
            return merged
        merged += alike
        records += sum(r.records for r in alike)
        left = [r for r in left if r not in alike]


def write_run(spark: SparkSession, store: LoadStore, run: str, accepted: DataFrame, merged: list[Run]) -> None:
    """Write a run of the accepted hashes and those of the runs it takes in, then its filter."""
    hashes = reduce(DataFrame.unionByName, [accepted.select(RECORD_HASH), *(spark.table(run_table(spark, store, r.id)) for r in merged)])
    hashes.repartition(store.buckets, RECORD_HASH).sortWithinPartitions(RECORD_HASH).write.insertInto(run_table(spark, store, run))
    # files are read as they were written, sorted; nothing is shuffled
    written = spark.read.schema(SEEN_SCHEMA).parquet(store.run(run)).select(RECORD_HASH, _file_bucket().alias("bucket"))
    written.mapInArrow(_filter_builder(FILTER_ROWS), FILTER_SCHEMA).write.mode("overwrite").parquet(store.filters(run))


def remove_runs(spark: SparkSession, store: LoadStore, runs: list[str]) -> None:
    for run in runs:
        for path in (store.run(run), store.filters(run)):
            if path_exists(spark, path):
                remove_work_dir(spark, path)


# --- filters; what runs in tasks is self-contained, for workers that do not have this package


def _filter_builder(most_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        def made(bucket: int, parts: list) -> pa.RecordBatch:
            prefixes = np.sort(np.concatenate(parts))
            bits = max(0, math.ceil(math.log2(len(prefixes) / 64)))
            block = prefixes >> np.uint64(64 - bits) if bits else np.zeros(len(prefixes), np.uint64)
            marks = ((prefixes << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
            offsets = np.searchsorted(block, np.arange((1 << bits) + 1, dtype=np.uint64)).astype("<u4")
            row = {"bucket": bucket, "bits": bits, "offsets": offsets.tobytes(), "marks": marks.tobytes()}
            kinds = {"bucket": pa.int32(), "bits": pa.int32(), "offsets": pa.binary(), "marks": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array([row[n]], k) for n, k in kinds.items()], names=list(kinds))

        bucket, parts, held = None, [], 0
        for batch in batches:
            joined = b"".join(h[:8].ljust(8, b"\0") for h in batch.column(0).to_pylist())
            prefixes = np.frombuffer(joined, ">u8").astype(np.uint64)
            of = batch.column("bucket").to_numpy()
            start = 0
            while start < len(of):
                if parts and (of[start] != bucket or held >= most_rows):
                    yield made(bucket, parts)
                    parts, held = [], 0
                bucket = int(of[start])
                other = np.flatnonzero(of[start:] != bucket)
                stop = min(start + most_rows - held, start + int(other[0]) if len(other) else len(of))
                parts.append(prefixes[start:stop])
                held += stop - start
                start = stop
        if parts:
            yield made(bucket, parts)

    return build


def _prober(carried: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa

        # (run, bits, block number and mark of each hash as one sorted number)
        bucket, filters = None, []
        for batch in batches:
            of, kind = batch.column("bucket").to_numpy(), batch.column("run").to_numpy()
            start = 0
            while start < len(of):
                if of[start] != bucket:
                    bucket, filters = of[start], []
                if kind[start] >= 0:
                    bits = batch.column("bits")[start].as_py()
                    offsets = np.frombuffer(batch.column("offsets")[start].as_py(), "<u4")
                    marks = np.frombuffer(batch.column("marks")[start].as_py(), "<u4").astype(np.uint64)
                    block = np.repeat(np.arange(1 << bits, dtype=np.uint64), np.diff(offsets.astype(np.int64)))
                    filters.append((int(kind[start]), bits, (block << np.uint64(32)) | marks))
                    start += 1
                    continue
                # hashes of one bucket that stand together
                other = np.flatnonzero((of[start:] != bucket) | (kind[start:] >= 0))
                stop = start + int(other[0]) if len(other) else len(of)
                rows = batch.slice(start, stop - start)
                hashes = rows.column("record_hash").to_pylist()
                prefixes = np.frombuffer(b"".join(h[:8].ljust(8, b"\0") for h in hashes), ">u8").astype(np.uint64)
                found: list[list[int]] = [[] for _ in hashes]
                for run, bits, known in filters:
                    block = prefixes >> np.uint64(64 - bits) if bits else np.zeros(len(prefixes), np.uint64)
                    wanted = (block << np.uint64(32)) | ((prefixes << np.uint64(bits)) >> np.uint64(32))
                    at = np.searchsorted(known, wanted)
                    hit = known[np.minimum(at, len(known) - 1)] == wanted
                    for k in np.flatnonzero(hit):
                        if run not in found[k]:
                            found[k].append(run)
                columns = [*(rows.column(c) for c in [*carried, "bucket"]), pa.array(found, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, "bucket", "runs"])
                start = stop

    return probe


def filter_rows(spark: SparkSession, store: LoadStore, runs: list[Run]) -> DataFrame:
    """The filters of some runs, with the place of each in the list."""
    tables = [spark.read.schema(FILTER_SCHEMA).parquet(store.filters(r.id)).withColumn("run", F.lit(k)) for k, r in enumerate(runs)]
    return reduce(DataFrame.unionByName, tables)


def not_stored(
    spark: SparkSession, store: LoadStore, state: LoadState, work_dir: str, digest: Column | None = None
) -> Callable[[DataFrame], DataFrame]:
    """What keeps, of ``record_hash, position`` with each hash once, the rows whose hash is in no run.

    Other columns of the rows are what ``digest`` makes the hash of: they are kept, and moved in its place.
    """

    def keep(firsts: DataFrame) -> DataFrame:
        runs = state.runs
        if not runs:
            return firsts
        names = firsts.columns
        made = len(names) > 2
        moved = [c for c in names if c != RECORD_HASH] if made else names
        hashed = digest.alias(RECORD_HASH) if made else F.col(RECORD_HASH)
        nothing = F.lit(None)
        marks = filter_rows(spark, store, runs).select(
            "bucket", "run", "bits", "offsets", "marks", *[nothing.cast(firsts.schema[c].dataType).alias(c) for c in moved]
        )
        rows = firsts.select(
            bucket_of(store.buckets).alias("bucket"), F.lit(-1).alias("run"), nothing.cast("int").alias("bits"),
            nothing.cast("binary").alias("offsets"), nothing.cast("binary").alias("marks"), *moved,
        )
        met = rows.unionByName(marks).repartition(store.buckets, "bucket").sortWithinPartitions("bucket", F.desc("run"))
        met = met.select(*rows.columns, hashed) if made else met
        fields = [firsts.schema[c] for c in moved]
        out = T.StructType([*fields, T.StructField("bucket", T.IntegerType()), T.StructField("runs", T.ArrayType(T.IntegerType()))])
        probed = stage(met.mapInArrow(_prober(moved), out), work_dir, f"probed-{uuid.uuid4().hex}", **ASCENDING)
        maybe = probed.filter(F.size("runs") > 0)
        # a row for each file at most
        hits = maybe.select("bucket", F.explode("runs").alias("run")).distinct().collect()
        others = [c for c in names if c != RECORD_HASH]
        new = probed.filter(F.size("runs") == 0).select(hashed, *others)
        if not hits:
            return new
        # the batch is moved to the buckets once and held in memory, part by part; stored hashes are looked up in it
        asked = maybe.select(*moved).repartition(store.buckets, digest if made else F.col(RECORD_HASH)).select(hashed, *others)
        for k in sorted({h["run"] for h in hits}):
            held = run_files(spark, store, runs[k], sorted(h["bucket"] for h in hits if h["run"] == k))
            held = held.select(RECORD_HASH, F.lit(True).alias("_held"))
            met = held.join(asked.hint("shuffle_hash"), RECORD_HASH, "right_outer")
            asked = met.filter(F.col("_held").isNull()).select(*names)
        return new.unionByName(asked)

    return keep


def run_files(spark: SparkSession, store: LoadStore, run: Run, buckets: list[int]) -> DataFrame:
    """The hashes of some buckets of a run; files of the others are not opened."""
    held = spark.table(run_table(spark, store, run.id))
    return held if len(buckets) == store.buckets else held.filter(_file_bucket().isin(buckets))
