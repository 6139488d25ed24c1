"""Toxicity, hard negatives and conversation repair on odd rows, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowfold.llm import conversations, hard_negatives, near_vectors, rule_ensemble, simhash, token_counts, toxicity, units
from rowfold.llm.flat import FlatTexts
from rowfold.llm.queries import BYTE_BPE, ORACLES, QUERIES, tokenizer_path

# --- toxicity


def toxic_texts(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ba", "ko", "li", "ster", "an", "tho"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for k in range(n):
        words, toxic = [word() for _ in range(rng.randint(30, 300))], k % 4 == 0
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["Zwergnase", "vollpfosten", "quarkkopf"])
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_toxicity_on_odd_rows(spark):
    rows = toxic_texts(400)
    odd = [(1000, None), (1001, ""), (1002, " \n"), (None, "x"), (1003, "ba ko " * 200_000), (1003, "li"), (1004, "\U0001f600 é"), (1005, "quarkkopf " * 20)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + odd, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("rank", F.lit(1))
    labels = [(k, y) for k, _, y in rows] + [(5, None), (None, 1), (9999, 1), (0, 0), (0, 1), (0, 1), (1003, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int").withColumn("text", F.lit("x"))
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == docs.count() and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    told = {r["doc_id"]: r["predicted"] for r in got}
    wrong = [k for k, _, y in rows if told[k] != y]
    assert len(wrong) < 8 and told[1005] == 1 and told[1000] == told[1001] == told[1003] == 0
    again = {(r["doc_id"], r["score"]) for r in toxicity.toxicity_scores(docs.repartition(7), labels.repartition(3)).collect()}
    assert again == {(r["doc_id"], r["score"]) for r in got}


def test_toxicity_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r["score"] < 1e-6, r["predicted"]) for r in toxicity.toxicity_scores(docs, none).collect()} == {(True, 0)}
    ones = spark.createDataFrame([(k, 1) for k in (1, 2)], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.toxicity_scores(docs, ones).collect()} == {1}
    assert toxicity.toxicity_scores(docs.limit(0), ones).count() == 0


def test_windows_cover_texts_and_savings_are_those_of_single_frames():
    texts = FlatTexts.of(pa.array(["", "a", "b" * 64, "c" * 65, "d" * 500, None]))
    starts, sizes, counts = toxicity.windows(texts)
    assert counts.tolist() == [0, 1, 1, 2, 11, 0]
    covered = np.zeros(len(texts.data), int)
    for a, n in zip(starts, sizes):
        assert 0 < n <= toxicity.WINDOW
        covered[a : a + n] += 1
    assert covered.min() == 1
    own = toxicity.Dictionaries(b"the quick brown fox " * 50, b"jumped over lazy dogs " * 50 + b"the quick brown fox " * 50)
    data = np.frombuffer(b"a lazy dogs day; the quick one; jumped over", np.uint8)
    found = own.saved(data, np.array([0, 16, 10]), np.array([16, 15, 30]))
    for k, (a, n) in enumerate(((0, 16), (16, 15), (10, 30))):
        plain, toxic = (len(toxicity.compressor(c).compress(data[a : a + n].tobytes())) for c in (own.ordinary, own.toxic))
        assert found[k] == plain - toxic


def test_best_cut_is_that_of_all_cuts():
    rng = np.random.default_rng(2)
    for _ in range(50):
        x, y = rng.integers(0, 12, 30).astype(float), rng.integers(0, 2, 30)
        if not y.any():
            continue
        f1 = lambda cut: 2 * y[x >= cut].sum() / ((x >= cut).sum() + y.sum())
        assert math.isclose(f1(toxicity.best_cut(x, y)), max(f1(c) for c in x))


# --- hard negatives


def brute_negatives(rows, positives=5, negatives=10):
    points = []
    for at, (key, vector, label) in enumerate(rows):
        if key is None or label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        points.append((at, key, (label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * v) for v in vector]))
    out = []
    for at, key, label, q in points:
        if key % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, r)), k, i, y) for i, k, y, r in points if i != at and len(r) == len(q)]
        best = sorted(s for s in scored if s[3] == label)[:positives]
        for p, pk, _, _ in best:
            fits = sorted(s for s in scored if s[3] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:negatives]
            out += [(key, pk, n, s[1], -p, -s[0]) for n, s in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("x")).withColumn("rank", F.lit(0))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label=moved, **options)
    return sorted(tuple(r) for r in found.collect())


def test_hard_negatives_on_odd_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [(100, [1.0, 0.5], 0), (1, [0.9, 0.5], 0), (2, [0.5, 0.5], 1), (3, [0.4, 0.5], 2), (4, [0.4, 0.5], 2), (4, [0.4, 0.5], 2)]
    rows += [(5, None, 0), (6, [1.0, nan], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1.0, 0.4], None), (None, [1.0, 1.0], 1)]
    rows += [(200, [], 0), (11, [], 0), (12, [], 1), (300, [0.5], 3), (400, [-1.0, 0.2], 5), (13, [1.0, 0.2], 5), (100, [1.0, 0.5], 0)]
    assert mined(spark, rows) == brute_negatives(rows)
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("size, spread", [(2, 0.02), (3, 0.5), (16, 0.3)])
def test_hard_negatives_against_brute_force(spark, size, spread):
    """Many ties (a coarse grid), one hot label, exact copies; small trees, leaves, blocks and rounds."""
    rng = np.random.default_rng(size)
    centres = rng.standard_normal((12, size))
    rows = []
    for k in range(1500):
        v = centres[k % 12] / np.linalg.norm(centres[k % 12]) + spread * rng.standard_normal(size)
        rows.append((int(k * 5 + rng.integers(0, 2)), np.round(v, 2).tolist(), int(rng.integers(0, 4)) if k % 3 else 1))
    rows += rows[:40]
    want = brute_negatives(rows)
    assert want and mined(spark, rows, shard=200, leaf=8, block=4, round_bytes=4_000) == want
    assert mined(spark, rows) == want


def test_scores_beyond_floats_are_exact(spark):
    rng = random.Random(4)
    rows = [(100 * k if k < 3 else k + 300, [rng.uniform(-1, 1) * 3e9 for _ in range(3)], k % 3) for k in range(60)]
    rows = [(k, np.float32(v).astype(float).tolist(), y) for k, v, y in rows]
    want = [r for r in brute_negatives(rows) if abs(r[4]) < 2**63]
    assert mined(spark, rows, leaf=4) == [tuple(max(-(2**63), min(2**63 - 1, x)) for x in r) for r in brute_negatives(rows)] or want == []


def test_boxes_bound_their_points():
    rng = np.random.default_rng(5)
    q = np.floor(rng.standard_normal((500, 6)) * 100)
    labels = np.sort(rng.integers(0, 9, 500))
    order, leaves = hard_negatives.pack(q, labels, 16)
    assert sorted(order.tolist()) == list(range(500)) and np.diff(leaves).max() <= 32
    anchor = np.floor(rng.standard_normal((7, 6)) * 100)
    for a, b in zip(leaves, leaves[1:]):
        own = q[order[a:b]]
        low, high = hard_negatives.intervals(anchor, own.min(axis=0)[None], own.max(axis=0)[None])
        scores = anchor @ own.T
        assert (low[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= high[:, 0]).all()


# --- conversations


def brute_repair(rows):
    """All edit texts of a few rows: ``rows`` are (initial, fault)."""
    best = [(4 * len(rows), "D" * len(rows))]

    def go(at, roles, cost, audit, inserts):
        if cost > best[0][0]:
            return
        if inserts < 2:
            for r in "ua":
                go(at, roles + r, cost + 3, audit + "I", inserts + 1)
        if at == len(rows):
            if re.fullmatch(r"(s?(ua)+)?", roles):
                best[0] = min(best[0], (cost, audit))
            return
        initial, fault = rows[at]
        go(at + 1, roles, cost + 4, audit + "D", 0)
        if fault in ("blank", "duplicate"):
            return
        more = 3 if fault == "truncated" else 0
        go(at + 1, roles + (initial or "?"), cost + more, audit + "K", 0)
        for r in "ua":
            go(at + 1, roles + r, cost + 3 + more, audit + "R", 0)

    go(0, "", 0, "", 0)
    return best[0]


def test_cheapest_edits_are_those_of_all_edits():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(rng.choice("ssuuaax"), rng.choice([None, None, None, "truncated", "blank"])) for _ in range(rng.randint(0, 4))]
        progress = conversations.Progress()
        numbers = [progress.add(k, initial, fault) for k, (initial, fault) in enumerate(rows)]
        _, role, end = conversations.ending(progress.state)
        edits, first = conversations.walk_back(np.array(numbers, int), role)
        assert ((progress.summary()["cost"], "".join(edits) + end), first) == (brute_repair(rows), conversations.NONE), rows
    assert len(conversations.all_steps().steps) < 1 << 16


SCHEMA = "conv_id long, turn long, role string, text string"


def random_conversations(rng, n):
    rows = []
    for k in range(n):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 60])):
            text = rng.choice(["Yes.", "no", " ", "", "Why? ", "é!\n", "a b c.", None, f"own {turn}.", "x. y", "\u00a0"])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ü"])
            rows.append((k if rng.random() < 0.98 else None, rng.choice([turn, turn, turn, turn + 3, None, 2**60 + turn]), role, text))
    return rows


def sql_rows(rows):
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    table = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "turn", "role", "text"])
    connection = duckdb.connect()
    connection.register("conversations", table)
    found = connection.execute(ORACLES["op13_conversations"])
    return [d[0] for d in found.description], found.fetchall()


@pytest.mark.parametrize("options", [{}, {"block_rows": 3}, {"block_bytes": 10}, {"block_rows": 1}])
def test_conversations_against_sql(spark, options):
    """Nulls, ties, repeated rows, odd roles, huge turns; and giants, with blocks of a few rows."""
    rows = random_conversations(random.Random(7), 60)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("copy", F.lit("x")).withColumn("present", F.lit(False)).withColumn("conv", F.lit(1))
    found = conversations.repair(conversations.damage(df), copy_col="copy", present_col="present", **options)
    assert (found.giants is not None) == bool(options)
    names, want = sql_rows(rows)
    got = [tuple(r[n] for n in names) for r in found.with_digest().collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # the summary alone, and the turns themselves
    assert found.summary().count() == len(want)
    parts = {}
    for r in found.parts().orderBy("conv", "part").collect():
        parts.setdefault(r["conv"], []).extend(f"{t['role']}:{t['text']}" for t in r["turns"])
    digest = {r[names.index("conv_id")]: r[names.index("repaired_sha256")] for r in want}
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in parts.items()} == digest


def test_one_conversation_with_very_many_rows_and_long_texts(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice(["same.", f"text {k}.", "cut", "z" * 5000 + "."])) for k in range(3000)]
    rows += [(2, 0, "user", "q" * 2_000_000 + "."), (2, 1, "assistant", "ok.")]
    names, want = sql_rows(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    found = conversations.repair(conversations.damage(df), copy_col="copy", present_col="present", block_rows=500)
    assert sorted(tuple(r[n] for n in names) for r in found.with_digest().collect()) == sorted(want)


def test_no_conversations(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(conversations.damage(df), copy_col="copy", present_col="present").with_digest().count() == 0


# --- mends of this round


def test_row_hash_tells_nulls_in_different_columns_apart(spark):
    df = spark.createDataFrame([(5, "x", None, "web"), (5, "x", "web", None), (5, "x", None, None), (5, "x", "web", "web")], "a int, b string, c string, d string")
    assert df.select(simhash.row_hash(df)).distinct().count() == 4


def test_rules_compiled_into_columns_score_as_plain_python(spark):
    """The ensemble's column against the rules evaluated by hand on each text's statistics."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    joined = docs.join(labels.filter("quality IS NOT NULL"), "doc_id").withColumn("label", F.col("quality").cast("double"))
    figures = rule_ensemble.text_statistics(joined, "text", ("label",))
    model = rule_ensemble.fit(figures, rule_ensemble.new_work_dir(spark, "rules"))
    assert model.rules
    for r in figures.select("*", model.score().alias("score")).collect():
        total = model.intercept
        for rule, weight in model.rules:
            total += weight * all(low < r[name] <= high for name, low, high in rule.conditions)
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_units_are_remembered_between_slices_and_forgotten_when_full():
    memory = units.ByteUnits(tokenizer_path(BYTE_BPE), units=50)
    tokenizer = units.byte_tokenizer(tokenizer_path(BYTE_BPE))
    rng = random.Random(3)
    for _ in range(30):
        texts = [" ".join(rng.choice(["the", "cat", "é", "x" * rng.randint(0, 9), "a\nb", "\u00a0", " "]) + str(rng.randint(0, 40)) * rng.randint(0, 1) for _ in range(20)) for _ in range(5)]
        found = memory.encode(FlatTexts.of(pa.array(texts)))
        for k, text in enumerate(texts):
            assert found.ids[found.bounds[k] : found.bounds[k + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_huge_texts_without_spaces_are_spliced(spark):
    """Han, kana and Hangul with marks, minified code and long lines: no window fails, and counts are the library's."""
    rng = random.Random(12)
    path = tokenizer_path(BYTE_BPE)
    tokenizer = units.byte_tokenizer(path)
    texts = [
        "".join(rng.choice("漢字交文日本語かなカナ한국어、。，") for _ in range(30_000)),
        ";".join(f"var a{k}=function(b,c){{return b+c*{k}}}" for k in range(2000)),
        "\n".join("x" * rng.randrange(1, 90) + str(k) for k in range(1500)),
        "don't;it's'" * 4000,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    found = {r["row"]: r for r in token_counts._huge_counts(df, path, 4_000, 512).collect()}
    assert {k: (r["failed"], r["n_tokens"]) for k, r in found.items()} == {
        k: (False, len(tokenizer.encode(t, add_special_tokens=False).ids)) for k, t in enumerate(texts)
    }


def test_near_vectors_beyond_a_block_and_uneven_clusters(spark):
    """Several blocks along the curve, many labels of one vector, and links across blocks: as all pairs."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 16))
    x[200:] = x[:200] + 0.15 * rng.standard_normal((200, 16))
    labels = [0 if k % 5 else k for k in range(400)]
    df = spark.createDataFrame([(k, v.tolist(), y) for k, (v, y) in enumerate(zip(x, labels))], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in near_vectors.near_vectors(df, block=30).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None])
    np.fill_diagonal(linked, False)
    assert got == dict(enumerate(linked.sum(axis=1).tolist())) and linked.sum() > 100


def test_many_fingerprints_take_longer_parts():
    assert [simhash.best_parts(n, 2) for n in (0, 250_000, 10**6, 10**9)] == [3, 3, 3, 2] and simhash.best_parts(10**6, 0) == 1


def test_every_query_of_this_package_is_registered():
    assert {"op11_toxicity", "op12_hard_negatives", "op13_conversations"} <= QUERIES.keys()
