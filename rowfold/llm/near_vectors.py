"""Near-duplicate vectors by counting collisions of one-dimensional projections.

*Projections.* Unit vectors are projected on ``m`` orthonormal directions. Around a vector's own projection lies a window
of half-width ``w``; another vector *collides* with it where its projection falls into that window. Two unit vectors with
cosine ``c`` are ``r = sqrt(2 - 2c)`` apart, and the squares of their projected differences sum to ``r * r`` at most, so
no more than ``(r / w) ** 2`` projections can miss: a pair with at least ``m`` minus that many collisions is a candidate,
and every pair at or above the threshold is one. This count is calibrated for a recall of 1 where the directions span the
space (``m`` = dimensions); with fewer directions than dimensions it is set so that a pair at the threshold falls short
with a probability of ``MISS`` at most. Candidates are verified by their cosine in double precision.

*Work.* Exact copies are one vector with a weight. Vectors of one label are put in the order of a curve over their first
``CURVE`` projections and cut into blocks of about ``block`` vectors; blocks whose bounds are more than ``r`` apart, over all
projections, never meet. Each pair of blocks is a group of its own: inside, every projection is sorted, a query's window
is a run of each sorted projection, found by binary search, and what lies in its runs is counted. A group returns one row per
vector: its number of links there, and the smallest vector it is connected with; pairs are never written. Work grows with the
pairs of blocks that meet, so with the square of a label's vectors where these fill the space evenly; a task's memory does not.

Vectors that are null, empty, zero, or hold null or non-finite components, and those with a null label, link with nothing. Nor
do rows with a null id (they have a null component and are not kept) or vectors of different lengths. Every row gives one
row; equal rows are vectors of their own and link with each other. An id is taken for one vector: if it stands for several
different ones, they count as one in components. Columns other than id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.llm.graph import components
from rowfold.session import new_work_dir, stage

COSINE = 0.93
BLOCK = 8_192
#: Projections at most, and the window's half-width as a multiple of a pair's mean difference at the threshold.
PROJECTIONS, WIDTH = 64, 1.75
#: Projections that the order of blocks follows, and bits of each.
CURVE, CURVE_BITS = 6, 4
MISS = 1e-9
_SEED = 20_240_501
# Share of the projections that are sorted; after these, few pairs can still reach the count.
FIRST_SHARE = 0.65
# Candidate pairs that are verified together, by the components of their vectors, about.
_COMPONENTS = 1 << 22

_POINT_SCHEMA = "id long, label string, size int, digest binary, unit array<double>, p array<double>"


def directions(size: int) -> np.ndarray:
    """Orthonormal columns, the same in every task."""
    random = np.random.default_rng(_SEED + size).standard_normal((size, size))
    return np.linalg.qr(random)[0][:, : min(size, PROJECTIONS)]


def least_collisions(size: int, cosine: float) -> tuple[float, int]:
    """Half-width of the window and the count that a pair must reach."""
    m, r = min(size, PROJECTIONS), math.sqrt(2 - 2 * cosine)
    if m == size:
        w = min(WIDTH * r / math.sqrt(size), 2.0)
        return w, max(0, m - int((r / w) ** 2 + 1e-9))
    w = 1.5 * r / math.sqrt(size)
    hit = math.erf(1.5 / math.sqrt(2))
    short, k = 0.0, 0
    while k <= m and (short := short + math.comb(m, k) * hit**k * (1 - hit) ** (m - k)) <= MISS:
        k += 1
    return w, k


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors, projections and a digest of the exact components."""
    for batch in batches:
        rows = []
        for key, label, vector in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "vector")), strict=True):
            if not vector or any(v is None for v in vector):
                continue
            x = np.asarray(vector, np.float64) + 0.0  # no negative zero
            if not np.isfinite(x).all() or not x.any():
                continue
            scaled = x / np.abs(x).max()
            unit = scaled / math.sqrt(float(scaled @ scaled))
            digest = hashlib.blake2b(x.tobytes(), digest_size=20).digest()
            rows.append((key, label, len(x), digest, unit.tolist(), (unit @ directions_of(len(x))).tolist()))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "label", "size", "digest", "unit", "p"]
        )


_DIRECTIONS: dict[int, np.ndarray] = {}


def directions_of(size: int) -> np.ndarray:
    if size not in _DIRECTIONS:
        _DIRECTIONS[size] = directions(size)
    return _DIRECTIONS[size]


class Windows:
    """Sorted projections of a group's vectors, and the window of every vector on each as a run of the sorted order."""

    def __init__(self, p: np.ndarray, half: float, queries: np.ndarray) -> None:
        self.orders, self.runs, self.n = [], [], len(p)
        for column in p.T:
            order = np.argsort(column, kind="stable").astype(np.int32)
            ranked = column[order]
            # a little wider, so that no rounding takes a pair out
            low = np.searchsorted(ranked, column[queries] - half * (1 + 1e-9), side="left")
            high = np.searchsorted(ranked, column[queries] + half * (1 + 1e-9), side="right")
            self.orders.append(order)
            self.runs.append((low.tolist(), high.tolist()))

    def collisions(self, query: int) -> np.ndarray:
        """With how many of its windows each vector collides; ``query`` counts among the queries."""
        inside = [order[low[query] : high[query]] for order, (low, high) in zip(self.orders, self.runs, strict=True)]
        return np.bincount(np.concatenate(inside), minlength=self.n)


def candidates(p: np.ndarray, half: float, least: int, queries: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, other) with ``least`` collisions or more, some more than ``most`` of them at a time.

    The last projections are looked at only for pairs that can still reach the count.
    """
    first = math.ceil(p.shape[1] * FIRST_SHARE)
    rest = np.ascontiguousarray(p[:, first:])
    windows, held, size = Windows(p[:, :first], half, queries), [], 0
    for k, own in enumerate(queries):
        count = windows.collisions(k)
        near = np.flatnonzero(count >= least - rest.shape[1])
        more = (np.abs(rest[near] - rest[own]) <= half * (1 + 1e-9)).sum(axis=1)
        near = near[count[near] + more >= least]
        held.append((np.full(len(near), own), near))
        size += len(near)
        if size > most or k == len(queries) - 1:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
            held, size = [], 0


def block_links(unit: np.ndarray, p: np.ndarray, part: np.ndarray, weight: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of one block, or of two, the weight it is linked with and the smallest position it can reach.

    ``part`` tells the block of a vector; of two blocks, only pairs across them are wanted, and the vectors of the first are the
    queries. Pairs are counted and joined as they are found and not kept, so that memory grows with the vectors and not
    with their links.
    """
    n, size = unit.shape
    half, least = least_collisions(size, cosine)
    blocks = np.unique(part)
    queries = np.flatnonzero(part == blocks[0])
    links, root = np.zeros(n), np.arange(n)
    step = max(1, _COMPONENTS // size)
    for a, b in candidates(p, half, least, queries, step):
        wanted = part[b] != blocks[0] if len(blocks) > 1 else b > a
        a, b = a[wanted], b[wanted]
        for at in range(0, len(a), step):
            x, y = a[at : at + step], b[at : at + step]
            hit = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
            x, y = x[hit], y[hit]
            links += np.bincount(x, weight[y], n) + np.bincount(y, weight[x], n)
            apart = root[x] != root[y]
            if apart.any():
                root = forest(n, root[x[apart]], root[y[apart]])[root]
    return links, root


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position that each of ``n`` vectors can reach by the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _link(cosine: float):
    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        ids, weight = group["id"].to_numpy(), group["weight"].to_numpy()
        unit, p = np.stack(group["unit"].to_list()), np.stack(group["p"].to_list())
        links, root = block_links(unit, p, group["own"].to_numpy(), weight, cosine)
        met = links > 0
        return pd.DataFrame({"rep": ids[met], "links": links[met].astype(np.int64), "root": ids[root[met]]})

    return link


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
    work_dir: str | None = None,
) -> DataFrame:
    """``id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    work_dir = work_dir or new_work_dir(spark, "near-vectors")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    points = stage(rows.filter("label IS NOT NULL AND id IS NOT NULL").mapInArrow(_points, _POINT_SCHEMA), work_dir, "points")
    same = ["label", "size", "digest"]
    # copies are equal in every component, so any of their unit vectors will do
    merged = points.groupBy(*same).agg(
        F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("unit").alias("unit"), F.first("p").alias("p")
    )
    reps = stage(merged, work_dir, "copies")
    copies = reps.select(*same, "rep", "weight")

    count = copies.count()
    blocks = max(1, -(-count // block))
    cut = reps.repartitionByRange(blocks, "label", "size", _curve(), "rep").withColumn("own", F.spark_partition_id())
    cut = stage(cut.select(F.col("rep").alias("id"), "label", "size", "unit", "p", "weight", "own"), work_dir, "blocks")

    kind = ["label", "size"]
    bounds = cut.select(*kind, "own", F.posexplode("p").alias("k", "x")).groupBy(*kind, "own", "k")
    bounds = bounds.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    boxes = bounds.groupBy(*kind, "own").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "low", "high"))), lambda s: s["low"]).alias("low"),
        F.transform(F.array_sort(F.collect_list(F.struct("k", "low", "high"))), lambda s: s["high"]).alias("high"),
    )
    boxes = stage(boxes, work_dir, "boxes")
    near = boxes.alias("x").join(boxes.alias("y"), kind).filter("x.own <= y.own")
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("x.low", "y.high", lambda lo, hi: lo - hi),
            F.zip_with("y.low", "x.high", lambda lo, hi: lo - hi),
            lambda s, t: F.greatest(s, t, F.lit(0.0)),
        ),
        F.lit(0.0),
        lambda total, g: total + g * g,
    )
    near = near.filter(gap <= 2 - 2 * cosine + 1e-9).select(*kind, F.col("x.own").alias("one"), F.col("y.own").alias("two"))
    near = stage(near, work_dir, "pairs")
    sides = near.select(*kind, "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("own"))
    met = cut.join(sides, [*kind, "own"])
    found = met.groupBy(*kind, "one", "two").applyInPandas(_link(cosine), "rep long, links long, root long")
    found = stage(found.select("rep", "links", "root"), work_dir, "links")

    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.selectExpr("rep AS a", "root AS b"), work_dir)
    classes = (
        copies.join(totals, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*same, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    )
    linked = points.select("id", *same).join(classes, same).select("id", "n_links", "component_id")
    usable = F.col("label").isNotNull() & F.col("id").isNotNull()
    alone = rows.filter(~usable | ~_usable_vector()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    everything = linked.unionByName(alone)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return everything.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))


def _curve() -> Column:
    """The place on a Z curve over the first projections, each cut into even steps of its spread."""
    place = F.lit(0).cast("long")
    for k in range(CURVE):
        # a projection of a unit vector spreads by one over the root of its components
        scaled = F.coalesce(F.element_at("p", F.lit(k + 1)), F.lit(0.0)) * F.sqrt(F.col("size")) / 4 + 0.5
        rank = F.least(F.greatest(F.floor(scaled * (1 << CURVE_BITS)), F.lit(0)), F.lit((1 << CURVE_BITS) - 1)).cast("long")
        for bit in range(CURVE_BITS):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * CURVE + CURVE - 1 - k))
    return place


def _usable_vector():
    vector = F.col("vector")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    other = F.exists(vector, lambda v: v != 0)
    return F.coalesce((F.size(vector) > 0) & finite & other, F.lit(False))
