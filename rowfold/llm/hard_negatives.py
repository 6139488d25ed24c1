"""Hard negatives by inner product, searched best first in STR-packed R-trees.

*Points.* Components are multiplied by ``scale`` and rounded down, so scores are whole numbers. Rows with a null label, a null
vector or a component that is null or not finite (also when scaled) take no part; vectors meet vectors of their length only.

*Trees.* Points are range-partitioned and sorted by length, label and first coordinate, and each run of ``SHARD`` of them is
one tree: points of a label are cut into slabs along its widest coordinates in turn (sort-tile-recursive) down to leaves of
``LEAF``; labels with fewer points share leaves. Leaves and inner nodes have minimum bounding boxes and the range of their labels.
A box bounds every inner product with it, coordinate by coordinate.

*Search.* Anchors are packed into blocks in the same way and go to the trees in rounds of at most ``ROUND_BYTES``, which is
the size of what is broadcast. For each anchor a queue takes the box with the highest bound first; boxes whose labels do not
fit, whose scores lie outside every window, or strictly below the k-th best of each window they meet, are dropped. The k-th
best is carried from tree to tree of a task. Each task returns k rows for each anchor and window at most; the k best of all
tasks are the result, exactly.

*Positives* of an anchor are the ``positives`` best other rows of its label. *Negatives* are, for each positive, the first
``negatives`` rows of other labels whose score is between ``low`` and ``high`` hundredths of the positive's score. Higher scores
come first, then smaller ids. Equal rows are rows of their own; every row that is an anchor is searched for, so a repeated anchor
gives its rows again. Anchors without positives, and positives without negatives, give no row. An empty table gives no row.
Scores beyond 64 bits are counted as the greatest or least long. Columns other than id, vector and label are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowfold.session import new_work_dir, stage

POSITIVES, NEGATIVES = 5, 10
#: Hundredths of a positive's score between which its negatives score.
LOW, HIGH = 30, 90
SCALE = 256
#: Points of a tree, of a leaf, and leaves of an inner node.
SHARD, LEAF, FAN = 4_096, 128, 8
#: Trees of a file at most, anchors of a block, and bytes of anchors that are broadcast at once.
FILE_SHARDS, ANCHORS, ROUND_BYTES = 32, 1_024, 64 << 20
_EXACT = 2.0**53
_LONG = 2**63 - 1
_SLAB_AXES = 3

_POINT_SCHEMA = "id long, label long, anchor boolean, size int, first double, q array<double>"
_TREE_SCHEMA = (
    "size int, n int, least_label long, most_label long, wide boolean, ids binary, keys binary, labels binary, q binary, leaves binary"
)


def _points(scale: float):
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("vector").is_valid())
            vectors = batch.column("vector")
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale) + 0.0
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            fine = np.diff(np.concatenate([[0], np.cumsum(~np.isfinite(values))])[bounds]) == 0
            first = np.where(sizes > 0, values[np.minimum(bounds[:-1], max(len(values) - 1, 0))] if len(values) else 0.0, 0.0)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
            arrays = [batch.column(c) for c in ("id", "label", "anchor")]
            arrays += [pa.array(sizes, pa.int32()), pa.array(first), lists]
            out = pa.RecordBatch.from_arrays(arrays, names=["id", "label", "anchor", "size", "first", "q"])
            yield out.filter(pa.array(fine))

    return prepare


def tile(q: np.ndarray, rows: np.ndarray, axes: list[int], leaf: int) -> list[np.ndarray]:
    """Sort-tile-recursive: leaves of about ``leaf`` rows, cut along the axes in turn."""
    if len(rows) <= leaf:
        return [rows]
    ordered = rows[np.argsort(q[rows, axes[0]], kind="stable")] if axes else rows
    leaves = -(-len(rows) // leaf)
    slabs = leaves if len(axes) <= 1 else max(1, round(leaves ** (1 / len(axes))))
    if slabs == 1:
        return tile(q, ordered, axes[1:], leaf)
    return [t for part in np.array_split(ordered, slabs) for t in (tile(q, part, axes[1:], leaf) if len(axes) > 1 else [part])]


def pack(q: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows that come sorted by label, and the bounds of the leaves; a leaf has one label, or several small ones."""
    starts = np.flatnonzero(np.concatenate([[True], labels[1:] != labels[:-1]])[: len(labels)])
    leaves, small = [], []
    for start, stop in zip(starts, np.append(starts[1:], len(labels)), strict=True):
        rows = np.arange(start, stop)
        if len(rows) >= leaf // 2:
            spread = q[rows].max(axis=0) - q[rows].min(axis=0)
            axes = np.argsort(-spread, kind="stable")[:_SLAB_AXES].tolist()
            leaves += tile(q, rows, axes, leaf)
            continue
        small.append(rows)
        if sum(map(len, small)) >= leaf // 2:
            leaves.append(np.concatenate(small))
            small = []
    if small:
        leaves.append(np.concatenate(small))
    order = np.concatenate(leaves) if leaves else np.zeros(0, np.int64)
    return order, np.concatenate([[0], np.cumsum([len(x) for x in leaves])]).astype(np.int64)


def _trees(points: int, leaf: int):
    """Sorted points to packed trees of ``points`` points."""

    def tree(size: int, held: list[tuple]) -> dict:
        ids, keys, labels, q = (np.concatenate(x) for x in zip(*held, strict=True))
        q = q.reshape(len(ids), size)
        order, leaves = pack(q, labels, leaf)
        q = q[order]
        wide = bool(len(q) and size and np.abs(q).max() > 32_767)
        return {
            "size": size, "n": len(ids), "least_label": int(labels.min()), "most_label": int(labels.max()), "wide": wide,
            "ids": ids[order].tobytes(), "keys": keys[order].tobytes(), "labels": labels[order].tobytes(),
            "q": q.astype(np.float64 if wide else np.int16).tobytes(), "leaves": leaves.tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["size", "n", "least_label", "most_label", "wide", "ids", "keys", "labels", "q", "leaves"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), *[pa.binary()] * 5]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        size, held, count = -1, [], 0
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            ids, keys, labels = (batch.column(c).to_numpy() for c in ("id", "key", "label"))
            lists = batch.column("q")
            values, bounds = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            bounds = bounds - bounds[0]
            start = 0
            while start < batch.num_rows:
                if held and (sizes[start] != size or count == points):
                    yield pa.RecordBatch.from_pylist([tree(size, held)], schema=schema)
                    held, count = [], 0
                size = int(sizes[start])
                other = np.flatnonzero(sizes[start:] != size)
                stop = min(start + points - count, start + int(other[0]) if len(other) else batch.num_rows)
                held.append((ids[start:stop], keys[start:stop], labels[start:stop], values[bounds[start] : bounds[stop]]))
                count += stop - start
                start = stop
        if held:
            yield pa.RecordBatch.from_pylist([tree(size, held)], schema=schema)

    return run


class Tree:
    """A packed tree: points in the order of their leaves, boxes of leaves and inner nodes."""

    def __init__(self, row: dict) -> None:
        self.size, self.n = row["size"], row["n"]
        self.ids, self.keys, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "keys", "labels"))
        self.q = np.frombuffer(row["q"], np.float64 if row["wide"] else np.int16).astype(np.float64).reshape(self.n, self.size)
        self.most = float(np.abs(self.q).max(initial=0.0))
        self.leaves = np.frombuffer(row["leaves"], np.int64)
        at = self.leaves[:-1]
        self.low, self.high = np.minimum.reduceat(self.q, at), np.maximum.reduceat(self.q, at)
        self.least, self.top = np.minimum.reduceat(self.labels, at), np.maximum.reduceat(self.labels, at)
        inner = np.arange(0, len(at), FAN)
        self.inner = (
            np.minimum.reduceat(self.low, inner), np.maximum.reduceat(self.high, inner),
            np.minimum.reduceat(self.least, inner), np.maximum.reduceat(self.top, inner),
        )
        self.whole = False

    def exact(self, most: float) -> Tree:
        """With whole numbers of any size instead of floats, where sums of products could be rounded."""
        if not self.whole and most * self.most * max(self.size, 1) >= _EXACT:
            self.q, self.low, self.high = _whole(self.q), _whole(self.low), _whole(self.high)
            self.inner = (_whole(self.inner[0]), _whole(self.inner[1]), *self.inner[2:])
            self.whole = True
        return self


def _whole(values: np.ndarray) -> np.ndarray:
    out = np.empty(values.shape, object)
    out.ravel()[:] = [int(v) for v in values.ravel().tolist()]
    return out


def intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner products of each row of ``q`` with each box, coordinate by coordinate."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


class Best:
    """The ``k`` first rows in each of an anchor's windows of scores: by score, then id, then key."""

    def __init__(self, windows: list[tuple[float, float]], k: int) -> None:
        self.k, self.low, self.high = k, [w[0] for w in windows], [w[1] for w in windows]
        #: what a row has to score to count, window by window
        self.floor = list(self.low)
        self.rows: list[list[tuple]] = [[] for _ in windows]

    def wants(self, least, most) -> bool:
        return any(most >= floor and least <= high for floor, high in zip(self.floor, self.high, strict=True))

    def take(self, scores: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        for w, (floor, high) in enumerate(zip(self.floor, self.high, strict=True)):
            at = np.flatnonzero((scores >= floor) & (scores <= high))
            if not len(at):
                continue
            if len(at) > self.k:
                kth = np.partition(scores[at], len(at) - self.k)[len(at) - self.k]
                at = at[scores[at] >= kth]
            found = [(-int(scores[i]), int(ids[i]), int(keys[i])) for i in at]
            self.rows[w] = sorted(self.rows[w] + found)[: self.k]
            if len(self.rows[w]) == self.k:
                self.floor[w] = -self.rows[w][-1][0]


def search(tree: Tree, q: np.ndarray, labels: np.ndarray, keys: np.ndarray, best: list[Best | None], same: bool) -> None:
    """Go on with the search of each anchor in one tree, best box first; ``same``: rows of its own label, or of others."""
    if tree.whole:
        q = _whole(q)
    least, most = intervals(q, *tree.inner[:2])
    for i, own in enumerate(best):
        if own is None:
            continue
        label, vector = labels[i], q[i]

        def open_to(low, top, label=label):
            return low <= label <= top if same else not (low == label == top)

        queue = [
            (-most[i, k], 0, k)
            for k in range(least.shape[1])
            if open_to(tree.inner[2][k], tree.inner[3][k]) and own.wants(least[i, k], most[i, k])
        ]
        heapq.heapify(queue)
        while queue:
            bound, is_leaf, k = heapq.heappop(queue)
            if -bound < min(own.floor):
                break
            if not is_leaf:
                inside = slice(k * FAN, min((k + 1) * FAN, len(tree.low)))
                low, high = intervals(vector[None, :], tree.low[inside], tree.high[inside])
                for leaf, (lo, hi) in enumerate(zip(low[0].tolist(), high[0].tolist(), strict=True), k * FAN):
                    if open_to(tree.least[leaf], tree.top[leaf]) and own.wants(lo, hi):
                        heapq.heappush(queue, (-hi, 1, leaf))
                continue
            at = slice(tree.leaves[k], tree.leaves[k + 1])
            scores, ids, own_keys = tree.q[at] @ vector, tree.ids[at], tree.keys[at]
            fits = (tree.labels[at] == label) & (own_keys != keys[i]) if same else tree.labels[at] != label
            if not fits.all():
                scores, ids, own_keys = scores[fits], ids[fits], own_keys[fits]
            if len(scores):
                own.take(scores, ids, own_keys)


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Scores n with low * score <= 100 * n <= high * score; empty if the first is greater."""
    return -(-low * score // 100), high * score // 100


_FOUND_SCHEMA = "anchor_key long, positive_score long, id long, key long, score long"


def _searched(k: int, same: bool, low: int, high: int):
    """Trees with the blocks of anchors they meet, to the best rows of each anchor and window among all trees of a task."""
    whole = (float("-inf"), float("inf"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # best rows of every anchor of the round so far, and the positive's score of each window
        held: dict[int, tuple[np.ndarray, list[list[int | None]], list[Best | None]]] = {}
        for batch in batches:
            for place in range(batch.num_rows):
                row = {c: batch.column(c)[place].as_py() for c in batch.schema.names}
                tree = Tree(row)
                anchors = Tree({c: row[f"a_{c}"] for c in ("size", "n", "ids", "keys", "labels", "q", "wide", "leaves")})
                number = row["block"]
                if number not in held:
                    scores: list[list[int | None]] = [[] for _ in range(anchors.n)]
                    if same:
                        scores = [[None] for _ in range(anchors.n)]
                    else:
                        of = {int(key): at for at, key in enumerate(anchors.keys)}
                        for key, score in zip(row["w_keys"], row["w_scores"], strict=True):
                            low_, high_ = window(score, low, high)
                            if low_ <= high_:
                                scores[of[key]].append(score)
                    bests = [Best([whole if s is None else window(s, low, high) for s in own], k) if own else None for own in scores]
                    held[number] = (anchors.keys, scores, bests)
                search(tree.exact(anchors.most), anchors.q, anchors.labels, anchors.keys, held[number][2], same)
        for keys, scores, bests in held.values():
            out = [
                (int(keys[i]), score, found_id, key, max(-_LONG - 1, min(_LONG, -negated)))
                for i, best in enumerate(bests)
                if best is not None
                for score, rows in zip(scores[i], best.rows, strict=True)
                for negated, found_id, key in rows
            ]
            columns = list(zip(*out, strict=True)) or [()] * 5
            names = ["anchor_key", "positive_score", "id", "key", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of each block."""
    for batch in batches:
        for block, keys in zip(batch.column("block").to_pylist(), batch.column("keys").to_pylist(), strict=True):
            own = np.frombuffer(keys, np.int64)
            yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(own), block)), "anchor_key": pa.array(own)})


def _packed(points: DataFrame, files: int, size: int, leaf: int) -> DataFrame:
    order = ["size", "label", "first", "key"]
    ranged = points.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return ranged.select("size", "label", "id", "key", "q").mapInArrow(_trees(size, leaf), _TREE_SCHEMA)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: float = SCALE,
    shard: int = SHARD,
    leaf: int = LEAF,
    block: int = ANCHORS,
    round_bytes: int = ROUND_BYTES,
    work_dir: str | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` is a condition on the columns of ``vectors``; labels are integers.
    """
    spark = vectors.sparkSession
    work_dir = work_dir or new_work_dir(spark, "hard-negatives")
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    usable = rows.filter("label IS NOT NULL AND id IS NOT NULL").mapInArrow(_points(scale), _POINT_SCHEMA)
    # written down, so that rows keep their keys
    points = stage(usable.withColumn("key", F.monotonically_increasing_id()), work_dir, "points")
    seen = points.agg(F.count("*").alias("n"), F.sum(F.col("anchor").cast("int")).alias("anchors"), F.max("size").alias("size")).first()
    count = seen["n"]
    files = max(min(spark.sparkContext.defaultParallelism, -(-count // shard)), -(-count // (shard * FILE_SHARDS)), 1)
    trees = stage(_packed(points, files, shard, leaf), work_dir, "trees")
    blocks_wanted = max(1, -(-(seen["anchors"] or 0) // block))
    packed = _packed(points.filter("anchor"), blocks_wanted, block, leaf)
    blocks = stage(packed.withColumn("raw", F.monotonically_increasing_id()), work_dir, "anchor-blocks")
    # a row of two numbers for each block of anchors
    numbers = blocks.select("raw", (F.row_number().over(Window.orderBy("raw")) - 1).cast("long").alias("block"))
    blocks = stage(blocks.join(numbers, "raw").drop("raw"), work_dir, "blocks")
    per_round = max(1, round_bytes // (block * (8 * (seen["size"] or 0) + 64)))

    def rounds(sides: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        renamed = [F.col(c).alias(f"a_{c}") for c in ("size", "n", "ids", "keys", "labels", "q", "wide", "leaves")]
        extra = [] if same else ["w_keys", "w_scores"]
        anchors = sides.select("block", *renamed, F.col("least_label").alias("a_least"), F.col("most_label").alias("a_most"), *extra)
        one = (F.col("least_label") == F.col("most_label")) & (F.col("a_least") == F.col("a_most"))
        if same:
            meets = (F.col("least_label") <= F.col("a_most")) & (F.col("a_least") <= F.col("most_label"))
        else:
            meets = ~(one & (F.col("least_label") == F.col("a_least")))
        total = sides.count()
        for start in range(0, max(total, 1), per_round):
            # ``round_bytes`` of anchors at most, or one block
            some = F.broadcast(anchors.filter(F.col("block").between(start, start + per_round - 1)))
            met = trees.join(some, (F.col("size") == F.col("a_size")) & meets).drop("least_label", "most_label", "a_least", "a_most")
            met.mapInArrow(_searched(k, same, low, high), _FOUND_SCHEMA).write.parquet(f"{work_dir}/{name}/round={start}")
        return spark.read.schema(_FOUND_SCHEMA).parquet(f"{work_dir}/{name}")

    order = [F.desc("score"), "id", "key"]
    found = rounds(blocks, positives, True, "positives")
    first = F.row_number().over(Window.partitionBy("anchor_key").orderBy(*order))
    best = found.withColumn("place", first).filter(F.col("place") <= positives)
    best = best.select("anchor_key", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    best = stage(best, work_dir, "best-positives")

    keys = blocks.select("block", "keys").mapInArrow(_keys, "block long, anchor_key long")
    wanted = best.select("anchor_key", "positive_score").distinct().join(keys, "anchor_key")
    # a block's anchors and their positives at most
    sides = wanted.groupBy("block").agg(F.collect_list(F.struct("anchor_key", "positive_score")).alias("w"))
    sides = blocks.join(sides.select("block", F.col("w.anchor_key").alias("w_keys"), F.col("w.positive_score").alias("w_scores")), "block")
    sides = stage(sides, work_dir, "windows")
    found = rounds(sides, negatives, False, "negatives")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_key", "positive_score").orderBy(*order)))
    ranked = ranked.filter(F.col("rank") <= negatives)
    ranked = ranked.select("anchor_key", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = points.filter("anchor").select(F.col("key").alias("anchor_key"), F.col("id").alias("anchor_id"))
    told = best.join(ranked, ["anchor_key", "positive_score"]).join(named, "anchor_key")
    return told.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
