"""SimHash near-duplicates by a generalised pigeonhole search.

*Fingerprints.* A text's words (A-Z lower-cased) are joined to shingles; a bit of the fingerprint is 1 if it is set in
over half of the shingles' 64-bit hashes. On request a second word of 64 bits, made from the same hashes mixed once more,
sharpens the comparison of what the search on the first has found.

*Search.* The 64 bits are grouped into ``parts`` so that correlated bits share one. Two fingerprints that differ in at most
``radius`` bits must, for any thresholds that sum to ``radius - parts + 1``, agree to within its threshold in one part (a
threshold of -1 leaves the part out). Each distinct fingerprint gets its own thresholds, by dynamic programming over the
candidates that each part and threshold is estimated to bring, from histograms of the parts' leading bits. A fingerprint is
filed under its value in every part, and is also sent to every value within its threshold. What meets under a part and a
value is compared in full.

*Work.* A part and value with more fingerprints than ``BLOCK`` is split into blocks, and each pair of blocks meets in a
group of its own, so that no group is larger than two blocks. A group gives one link per fingerprint at most: what
it finds connected is written as a tree, not as all pairs. Exact copies share a fingerprint and are never paired.

A null or empty text has fingerprint zero and is linked like any other. A text with fewer words than a shingle is one
shingle. Rows are kept as they are, repeated ids included; a row with a null id belongs to its fingerprint's component,
whose name is the smallest id that is not null. Columns other than id and text are not read, but for those of
:func:`deduplicated`, which returns whole rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.llm.flat import map_texts
from rowfold.llm.graph import components
from rowfold.session import new_work_dir, stage

BITS = 64
SEED = 42
RADIUS = 2
BLOCK = 8_192
# Leading bits of a part that its histogram counts, whatever the number of fingerprints.
HISTOGRAM_BITS = 12
# Groups up to this size are compared side by side with others; larger ones are searched one by one.
SMALL_GROUP = 8
# No part gets a wider threshold: it would be sent to too many values.
WIDEST = 3


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """Hashes of all shingles of a text, repeats included."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(itertools.islice(found, k, None) for k in range(words)), strict=False))
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Majority of each bit; few hashes are unpacked at a time."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Other 64 bits for each hash, by the finaliser of splitmix64 (fixed constants of that generator)."""
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprints(
    docs: DataFrame, words: int = 3, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), wide: bool = False
) -> DataFrame:
    """``fp, more`` of every row as signed longs, with the columns ``keep``; ``more`` is 0 unless ``wide``."""

    def work(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        fp, more = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
        for k, text in enumerate(batch.column("text").to_pylist()):
            hashes = shingle_hashes(text or b"", words)
            fp[k] = fingerprint(hashes)
            if wide:
                more[k] = fingerprint(mixed(hashes))
        return {"fp": fp.view(np.int64), "more": more.view(np.int64)}

    schema = T.StructType([T.StructField("fp", T.LongType()), T.StructField("more", T.LongType())])
    return map_texts(docs, work, schema, text=text_col, keep=keep)


# --- parts


def _bit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each bit, and each pair of bits, is set."""
    both, rows = np.zeros((BITS, BITS)), 0
    for batch in batches:
        bits = unpack(batch.column("fp").to_numpy()).astype(np.float32)
        both += bits.T @ bits
        rows += len(bits)
    yield pa.RecordBatch.from_pydict(
        {"bit": pa.array(range(BITS), pa.int32()), "rows": pa.array([rows] * BITS, pa.int64()), "both": pa.array(both.tolist())}
    )


def unpack(fp: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each fingerprint."""
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(fps: DataFrame, parts: int) -> list[list[int]]:
    """Bits grouped into parts of even size; a part grows by the bit most correlated with those it has."""
    sums = fps.select("fp").mapInArrow(_bit_sums, "bit int, rows long, both array<double>")
    entry = F.posexplode("both").alias("other", "n")
    # 64 x 64 counts
    counted = sums.select("bit", "rows", entry).groupBy("bit", "other").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    both, rows = np.zeros((BITS, BITS)), 1.0
    for r in counted.collect():
        both[r["bit"], r["other"]] = r["n"]
        rows = max(rows, r["rows"])
    share = np.diag(both) / rows
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    near = np.abs((both / rows - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(near, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = -(-len(left) // (parts - k))
        first = max(left, key=lambda b: (near[b, list(left)].sum(), -b))
        part = [first]
        left.discard(first)
        while len(part) < size:
            nxt = max(left, key=lambda b: (near[b, part].sum(), -b))
            part.append(nxt)
            left.discard(nxt)
        out.append(sorted(part))
    return out


def part_values(fp: np.ndarray, parts: list[list[int]]) -> np.ndarray:
    """A row of part values for each fingerprint."""
    bits = unpack(fp)
    weights = [(1 << np.arange(len(p), dtype=np.int64)) for p in parts]
    return np.stack([bits[:, p].astype(np.int64) @ w for p, w in zip(parts, weights, strict=True)], axis=1)


def _flips(width: int, threshold: int) -> np.ndarray:
    """All masks of ``width`` bits with at most ``threshold`` ones."""
    masks = [0]
    for k in range(1, threshold + 1):
        masks += [sum(1 << b for b in bits) for bits in itertools.combinations(range(width), k)]
    return np.array(masks, np.int64)


# --- thresholds


def histograms(fps: DataFrame, parts: list[list[int]]) -> list[np.ndarray]:
    """For each part, fingerprints by the leading bits of its value: ``2 ** HISTOGRAM_BITS`` counts at most."""
    shifts = [max(0, len(p) - HISTOGRAM_BITS) for p in parts]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1 << (len(p) - s), np.int64) for p, s in zip(parts, shifts, strict=True)]
        for batch in batches:
            values = part_values(batch.column("fp").to_numpy(), parts)
            for k, s in enumerate(shifts):
                total[k] += np.bincount(values[:, k] >> s, minlength=len(total[k]))
        for k, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array(np.full(len(at), k, np.int32)), "bin": pa.array(at.astype(np.int32)), "n": pa.array(t[at])}
            )

    summed = fps.select("fp").mapInArrow(count, "part int, bin int, n long").groupBy("part", "bin").agg(F.sum("n").alias("n"))
    out = [np.zeros(1 << (len(p) - s), np.float64) for p, s in zip(parts, shifts, strict=True)]
    for r in summed.collect():
        out[r["part"]][r["bin"]] = r["n"]
    return out


def thresholds(values: np.ndarray, parts: list[list[int]], counts: list[np.ndarray], radius: int) -> np.ndarray:
    """For each fingerprint the thresholds of its parts that bring the fewest candidates and probes.

    Dynamic programming over the parts: the least cost for every sum of thresholds spent so far. They sum to
    ``radius - parts + 1``; none is below -1 or above ``WIDEST``.
    """
    n, total, widest = len(values), radius - len(parts) + 1, min(radius, WIDEST)
    choices = range(-1, widest + 1)
    costs = np.zeros((len(parts), len(choices), n))
    for k, part in enumerate(parts):
        shift = max(0, len(part) - HISTOGRAM_BITS)
        lead = values[:, k] >> shift
        scale = 1.0 / (1 << shift)
        here = counts[k][lead] * scale
        near = sum(counts[k][lead ^ (1 << b)] for b in range(len(part) - shift)) * scale
        costs[k, 1] = 1 + here
        probes = 1 + len(part)
        costs[k, 2] = probes + here * (1 + shift) + near
        for j in range(3, len(choices)):
            # wider ones by the number of their probes, at the mean of the ring before
            more = sum(math.comb(len(part), i) for i in range(j))
            costs[k, j] = costs[k, 2] * more / probes
    low, high = -len(parts), widest * len(parts)
    best = np.full((high - low + 1, n), np.inf)
    best[-low] = 0
    taken = []
    for k in range(len(parts)):
        new, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
        for j, t in enumerate(choices):
            moved = np.full_like(best, np.inf)
            if t < 0:
                moved[:t] = best[-t:]
            elif t == 0:
                moved[:] = best
            else:
                moved[t:] = best[:-t]
            moved = moved + costs[k, j]
            less = moved < new
            new[less], pick[less] = moved[less], t
        best = new
        taken.append(pick)
    at, out = np.full(n, total - low), np.zeros((n, len(parts)), np.int64)
    for k in reversed(range(len(parts))):
        out[:, k] = taken[k][at, np.arange(n)]
        at = at - out[:, k]
    return out


def best_parts(n: int, radius: int) -> int:
    """The number of parts that brings the fewest rows and candidates for each of ``n`` fingerprints.

    Few fingerprints are told apart by short parts; many need long ones, and then are sent to the values beside theirs. As if bits
    were even; the thresholds themselves follow the histograms.
    """

    def cost(parts: int) -> float:
        width, left = BITS // parts, radius - parts + 1
        limits = [left // parts + (k < left % parts) for k in range(parts)]
        probes = [sum(math.comb(width, i) for i in range(t + 1)) for t in limits]
        return sum(p * (1 + n / 2**width) for p in probes)

    return min(range(1, radius + 2), key=cost)


# --- search


def _keys(batches: Iterator[pa.RecordBatch], parts: list[list[int]], counts: list[np.ndarray], radius: int) -> Iterator[pa.RecordBatch]:
    """``part, value`` where each fingerprint is filed and where it is sent, with ``node, fp, more``."""
    for batch in batches:
        whole = [batch.column(c).to_numpy() for c in _NODE]
        for start in range(0, len(whole[0]), 4_096):
            rows = [c[start : start + 4_096] for c in whole]
            values = part_values(rows[1], parts)
            limits = thresholds(values, parts, counts, radius)
            for k, part in enumerate(parts):
                yield _key_batch(k, values[:, k], rows)
                for t in range(1, WIDEST + 1):
                    wide = limits[:, k] == t
                    if wide.any():
                        masks = _flips(len(part), t)[1:]
                        near = (values[wide, k][:, None] ^ masks[None]).ravel()
                        yield _key_batch(k, near, [np.repeat(c[wide], len(masks)) for c in rows])


def _key_batch(part: int, values: np.ndarray, rows: list[np.ndarray]) -> pa.RecordBatch:
    columns = [np.full(len(values), part, np.int32), values, *rows]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "value", *_NODE])


_NODE = ["node", "fp", "more"]
_GROUP = ["part", "value", "one", "two"]


class Reach:
    """What counts as near: ``radius`` bits of the fingerprint, and ``total`` bits of both words."""

    def __init__(self, radius: int, total: int | None = None) -> None:
        self.radius, self.total = radius, BITS * 2 if total is None else total

    def near(self, fp: np.ndarray, more: np.ndarray, other_fp: np.ndarray, other_more: np.ndarray) -> np.ndarray:
        first = np.bitwise_count(fp ^ other_fp)
        hit = first <= self.radius
        if self.total < 2 * BITS:
            hit &= first + np.bitwise_count(more ^ other_more) <= self.total
        return hit


def connect(node: np.ndarray, fp: np.ndarray, more: np.ndarray, reach: Reach) -> tuple[np.ndarray, np.ndarray]:
    """A forest of links among near fingerprints: each one reached, with the one it was reached from.

    Fingerprints are compared a slice at a time with all that are left; those near nothing go, one that is near
    something takes all it is connected with, and they go too.
    """
    left = np.unique(node, return_index=True)[1]
    ones, others = [], []
    match = lambda a, b: reach.near(fp[a][:, None], more[a][:, None], fp[b][None], more[b][None])
    while len(left) > 1:
        head = left[:128]
        hit = match(head, left)
        hit[np.arange(len(head)), np.arange(len(head))] = False
        some = np.flatnonzero(hit.any(axis=1))
        if not len(some):
            left = left[len(head) :]
            continue
        front, left = left[some[:1]], left[some[0] + 1 :]
        while len(front) and len(left):
            found = []
            for start in range(0, len(front), 128):
                own = front[start : start + 128]
                hit = match(own, left)
                reached = hit.any(axis=0)
                ones.append(node[own[hit.argmax(axis=0)[reached]]])
                others.append(node[left[reached]])
                found.append(left[reached])
                left = left[~reached]
            front = np.concatenate(found)
    return _joined(ones), _joined(others)


def group_links(keys: np.ndarray, rows: list[np.ndarray], reach: Reach) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal keys; ``rows`` are node, fp and more."""
    node, fp, more = rows[0], rows[1].view(np.uint64), rows[2].view(np.uint64)
    if not len(node):
        return node, node
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(edge, len(node)))
    group = np.repeat(np.arange(len(sizes)), sizes)
    small = (sizes <= SMALL_GROUP)[group]
    ones, others = [], []
    for off in range(1, min(SMALL_GROUP, len(node))):
        at = np.flatnonzero((group[off:] == group[:-off]) & small[off:])
        at = at[reach.near(fp[at], more[at], fp[at + off], more[at + off]) & (node[at] != node[at + off])]
        ones.append(node[at])
        others.append(node[at + off])
    for k in np.flatnonzero(sizes > SMALL_GROUP):
        own = slice(edge[k], edge[k] + sizes[k])
        a, b = connect(node[own], fp[own], more[own], reach)
        ones.append(a)
        others.append(b)
    return _joined(ones), _joined(others)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _search(batches: Iterator[pa.RecordBatch], reach: Reach) -> Iterator[pa.RecordBatch]:
    """Links of sorted groups; a group that may go on in the next batch waits for it."""
    held: list[np.ndarray] = []

    def links(columns: list[np.ndarray]) -> pa.RecordBatch:
        keys, rows = columns[: len(_GROUP)], columns[len(_GROUP) :]
        number = np.concatenate([[0], np.cumsum(np.any([k[1:] != k[:-1] for k in keys], axis=0))])
        a, b = group_links(number, rows, reach)
        return pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in (*_GROUP, *_NODE)]
        if held:
            columns = [np.concatenate(pair) for pair in zip(held, columns, strict=True)]
        last = np.all([k == k[-1] for k in columns[: len(_GROUP)]], axis=0)
        start = 0 if last.all() else len(last) - int(np.argmin(last[::-1]))
        held = [c[start:] for c in columns]
        if start:
            yield links([c[:start] for c in columns])
    if held:
        yield links(held)


def near_links(
    fps: DataFrame, radius: int = RADIUS, parts: int | None = None, block: int = BLOCK, total: int | None = None
) -> DataFrame:
    """``a, b``: a forest that connects the ``node`` of near fingerprints; ``fps`` has ``node, fp, more``, each once.

    Without ``parts``, their number follows from that of the fingerprints (:func:`best_parts`).

    Near are fingerprints within ``radius`` bits, and ``total`` bits of both words if that is given.
    """
    layout = correlated_parts(fps, parts or best_parts(fps.count(), radius))
    counts = histograms(fps, layout)
    kinds = "part int, value long, node long, fp long, more long"
    keys = fps.select(*_NODE).mapInArrow(lambda b: _keys(b, layout, counts, radius), kinds)
    sizes = keys.groupBy("part", "value").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    # one row for each part and value with more than a block of fingerprints
    return _group_forest(keys.join(sizes, ["part", "value"], "left"), block, Reach(radius, total))


def _group_forest(sized: DataFrame, block: int, reach: Reach) -> DataFrame:
    """``a, b``: a forest of the links inside every ``part, value``; ``n`` is its number of rows, if above ``block``."""
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # a fingerprint meets every block of its group, its own included
    paired = sized.select("part", "value", *_NODE, own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    grouped = paired.select("part", "value", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), *_NODE)
    sorted_groups = grouped.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return sorted_groups.mapInArrow(lambda b: _search(b, reach), "a long, b long")


def _classes(hashed: DataFrame, work_dir: str, radius: int, parts: int | None, total: int | None = None) -> DataFrame:
    """``fp, more, name`` from ``key, fp, more``: the smallest key that near fingerprints can reach."""
    firsts = hashed.groupBy("fp", "more").agg(F.min("key").alias("first"))
    # written down, so that the nodes keep their numbers
    firsts = stage(firsts.withColumn("node", F.monotonically_increasing_id()), work_dir, "firsts")
    roots = components(near_links(firsts, radius, parts, total=total), work_dir).withColumnRenamed("root", "linked")
    rooted = firsts.join(roots, "node", "left").select("fp", "more", "first", F.coalesce("linked", "node").alias("root"))
    rooted = stage(rooted, work_dir, "rooted")
    named = rooted.groupBy("root").agg(F.min("first").alias("name"))
    return rooted.join(named, "root").select("fp", "more", "name")


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    radius: int = RADIUS,
    parts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    work_dir: str | None = None,
) -> DataFrame:
    """``id, fp, component_id`` of every row: the smallest id that links of at most ``radius`` bits can reach."""
    work_dir = work_dir or new_work_dir(docs.sparkSession, "simhash")
    hashed = fingerprints(docs, words, text_col, (id_col,)).withColumnRenamed(id_col, "key")
    hashed = stage(hashed, work_dir, "fingerprints")
    classes = _classes(hashed, work_dir, radius, parts)
    found = hashed.join(classes, ["fp", "more"])
    return found.select(F.col("key").alias(id_col), "fp", F.col("name").alias("component_id"))


def deduplicated(
    docs: DataFrame,
    words: int = 3,
    radius: int = RADIUS,
    parts: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    work_dir: str | None = None,
) -> DataFrame:
    """The rows that stay when of each group of near copies (as in :func:`near_duplicates`) one does; all columns.

    The one with the smallest id stays; of several rows with that id exactly one does, and a row with a null id only where
    no other id is in the group. Texts are read for their fingerprints and for the rows that stay, and are not written in between.
    """
    work_dir = work_dir or new_work_dir(docs.sparkSession, "simhash")
    own_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("text")
    # all that tells rows apart; equal rows are interchangeable
    key = F.struct(own_id.isNull().alias("none"), own_id.alias("id"), row_hash(docs).alias("row"))
    hashed = stage(fingerprints(docs.select(key.alias("key"), text), words, "text", ("key",)), work_dir, "fingerprints")
    stay = stage(_classes(hashed, work_dir, radius, parts).select("name").distinct(), work_dir, "stay")
    # columns are numbered, so that none clashes with the one that is added
    numbered = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]
    rows = docs.select(*numbered, key["row"].alias("row_"))
    found = rows.join(stay.select(F.col("name.row").alias("row_")), "row_", "left_semi")
    alike = hashed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").join(stay, F.col("key") == F.col("name"))
    if not alike.isEmpty():
        found = found.dropDuplicates(["row_"])
    return found.drop("row_").toDF(*docs.columns)


def row_hash(df: DataFrame) -> Column:
    """A text of 128 bits that tells rows apart by all their columns, nulls and their places included."""
    values = [F.col(f"`{c}`") for c in df.columns]
    # the hash passes over nulls
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    return F.concat_ws("-", F.hex(F.xxhash64(nulls, *values)), F.hex(F.xxhash64(F.lit(1), nulls, *reversed(values), *values)))
