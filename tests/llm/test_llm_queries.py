"""The numbered queries and the pipeline's stages over whole tables: against their SQL, or brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from compare import assert_same, connect
from rowfold.llm import fertility, mixing, simhash
from rowfold.llm.queries import BYTE_BPE, ORACLES, PIECE_BPE, QUERIES, tokenizer_path

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])


def test_thirteen_operators():
    assert [re.match(r"op(\d+)_", n)[1] for n in QUERIES] == [str(n) for n in range(1, 14)]


def test_mixture_meets_targets(spark):
    rows = QUERIES["op3_mixture"](spark, SF_DIR).collect()
    by_source = defaultdict(int)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(taken - target) <= 1 for (_, target), taken in by_source.items())
    assert math.isclose(sum(t for _, t in by_source), sum(s for s, _ in by_source))


def test_mixture_is_the_curriculum_by_time_varying_schedules(spark, tmp_path):
    """Taken words are those of the uses; a source's uses follow its schedule, and files follow positions."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert any(len({w for _, w in s}) > 1 for s in mixing.CYCLE) and [mixing.demand(s) for s in mixing.CYCLE] == [1, 2, 3]
    placed, told = mixing.scheduled(mixing.mixture(docs, work_dir=f"{tmp_path}/a"), f"{tmp_path}/b")
    taken = Counter()
    for r in placed.collect():
        taken[r["doc_id"]] += r["words"]
        assert 0 <= r["position"] <= 1
    assert {r["doc_id"]: r["taken"] for r in told.collect() if r["taken"]} == dict(taken)
    # a use is due when its source's schedule has brought as much of its demand as comes before it in the line
    for r in placed.collect():
        schedule, area = mixing.CYCLE[r["kind"]], 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
            x = min(max(r["position"] - t0, 0), t1 - t0)
            area += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        before = r["epoch"] * r["source_size"] + r["before"]
        assert math.isclose(area / mixing.demand(schedule), before / r["target"], abs_tol=1e-9)
    bounds = placed.groupBy(F.input_file_name()).agg(F.min("position"), F.max("position")).collect()
    ends = sorted((r[1], r[2]) for r in bounds)
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_toxicity_separates_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op11_toxicity"](spark, sf_dir)
    rows = scored.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert auc([r["score"] for r in rows], [r["toxic"] for r in rows]) > 0.93
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(caught) > 0.75 and np.mean(clean) < 0.02


def test_conversations_and_hard_negatives_match_sql_on_more_rows(spark):
    more = connect("/root/testdata/sf0.1")
    for name in ("op12_hard_negatives", "op13_conversations"):
        assert_same(QUERIES[name](spark, "/root/testdata/sf0.1"), more, ORACLES[name])


def auc(scores, labels):
    ones = [s for s, y in zip(scores, labels) if y]
    zeros = [s for s, y in zip(scores, labels) if not y]
    return np.mean([[(a > b) + (a == b) / 2 for b in zeros] for a in ones])


def test_quality_separates_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op4_quality"](spark, sf_dir)
    rows = scored.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert auc([r["score"] for r in rows], [r["quality"] for r in rows]) > 0.95


def base_figures(text):
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count, marked = Counter(windows), set()
    for k, window in enumerate(windows):
        if count[window] > 1:
            marked |= {k, k + 1, k + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(marked)


def test_fertility_against_brute_force(spark, texts, duck):
    processor = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
    languages = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = {r["doc_id"]: r for r in QUERIES["op5_fertility"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    groups = defaultdict(list)
    for key, text in texts.items():
        row = rows[key]
        figures = base_figures(text)
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == figures
        assert row["base_failed"] == (figures[0] < 50 or 100 * figures[4] > 50 * figures[0])
        ids = processor.encode(text)
        counts = np.array(list(Counter(ids).values()))
        entropy = float((counts / len(ids) * np.log2(len(ids) / counts)).sum()) if ids else 0.0
        assert row["n_tokens"] == len(ids) and row["n_byte_tokens"] == sum(map(processor.is_byte, ids))
        assert math.isclose(row["entropy"], entropy, abs_tol=1e-9)
        if not row["base_failed"]:
            groups[languages[key], int(math.log2(len(ids)))].append(math.floor(entropy * fertility.STEPS))
    share_step = lambda r: math.floor(r["entropy"] / min(math.log2(max(r["n_tokens"], 2)), 10) * fertility.STEPS)
    of_script = defaultdict(list)
    for row in rows.values():
        if not row["base_failed"]:
            of_script[row["script"]].append(share_step(row))
    median = {script: sorted(v)[math.ceil(len(v) / 2) - 1] for script, v in of_script.items()}
    band = fertility.SCRIPT_BANDS["latin"]
    for key, row in rows.items():
        if row["base_failed"]:
            assert not row["kept"]
            continue
        chars, share = row["word_chars"] / row["n_tokens"], row["n_byte_tokens"] / row["n_tokens"]
        inside = band.min_chars_per_token <= chars <= band.max_chars_per_token and share <= band.max_byte_share
        inside &= row["entropy"] >= band.min_entropy_share * min(math.log2(row["n_tokens"]), 10)
        group = sorted(groups[languages[key], int(math.log2(row["n_tokens"]))])
        low, middle, high = (group[math.ceil(q * len(group) / 4) - 1] for q in (1, 2, 3))
        inside &= math.floor(row["entropy"] * fertility.STEPS) >= min(fertility.ENTROPY_DROP * middle, low - 2 * (high - low)) - 1e-6
        inside &= share_step(row) >= fertility.SCRIPT_DROP * median[row["script"]] - 1e-6
        assert row["kept"] == inside


def test_token_counts_against_library(spark, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    rows = {r["doc_id"]: r for r in QUERIES["op7_token_counts"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    for key, text in texts.items():
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (rows[key]["n_bytes"], rows[key]["n_tokens"], rows[key]["over_limit"]) == (len(text.encode()), n, n > 512)


def test_pieces_against_library(spark, texts):
    processor = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
    rows = {r["doc_id"]: r for r in QUERIES["op8_pieces"](spark, SF_DIR).collect()}
    assert rows.keys() == texts.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for key, text in texts.items():
        ids = processor.encode(text)
        want = len(ids), sha(",".join(map(str, ids))), sha(processor.decode(ids)), len(text.encode())
        assert tuple(rows[key][c] for c in ("n_tokens", "ids_sha256", "decoded_sha256", "spanned_bytes")) == want


def brute_fingerprint(text, words):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(keys, linked):
    """Smallest key of each one's component; ``linked(i)`` gives the positions linked with i."""
    order, root = sorted(range(len(keys)), key=lambda i: keys[i]), {}
    for start in order:
        if start in root:
            continue
        todo = [start]
        root[start] = keys[start]
        while todo:
            for j in linked(todo.pop()):
                if j not in root:
                    root[j] = keys[start]
                    todo.append(j)
    return {keys[i]: r for i, r in root.items()}


def test_simhash_against_brute_force(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op9_simhash"](spark, SF_DIR).collect()}
    keys = sorted(texts)
    prints = np.array([brute_fingerprint(texts[k], 3) for k in keys], np.uint64)
    roots = smallest_reachable(keys, lambda i: np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2))
    for key, fp in zip(keys, prints):
        assert (rows[key]["fingerprint"], rows[key]["component_id"]) == (f"{int(fp):016x}", roots[key])


def test_token_table_against_library(spark, texts):
    tokenizer = Tokenizer.from_file(tokenizer_path(BYTE_BPE))
    rows = {r["doc_id"]: r for r in QUERIES["op10_token_table"](spark, SF_DIR).collect()}
    start = 0
    for key in sorted(texts):
        ids = [*tokenizer.encode(texts[key], add_special_tokens=False).ids, 2]
        want = start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(rows[key][c] for c in ("start", "n_tokens", "ids_crc32")) == want
        start += len(ids)


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage on what its predecessor kept, against plain Python."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    results = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        results.append(docs)
        if number < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
    ruled, good, single, mixed, encoded = [r.collect() for r in results]
    verdicts = QUERIES["op5_fertility"](spark, SF_DIR).filter("kept").select("doc_id").collect()
    assert {r["doc_id"] for r in ruled} == {r["doc_id"] for r in verdicts}
    assert 0 < len(single) < len(good) < len(ruled) and {r["doc_id"] for r in good} < {r["doc_id"] for r in ruled}

    # near copies, by the contract of the operator
    rows = sorted(good, key=lambda r: r["doc_id"])
    prints = np.array([brute_fingerprint(r["text"], 3) for r in rows], np.uint64)
    roots = smallest_reachable([r["doc_id"] for r in rows], lambda i: np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2))
    assert {r["doc_id"] for r in single} == set(roots.values())

    # mixing: whole documents, in the seeded order, as often as their places come before the target
    lines, sizes = defaultdict(list), defaultdict(int)
    hashes = results[2].select("doc_id", simhash.row_hash(results[2]).alias("key"))
    keys = dict(map(tuple, hashes.collect()))
    assert len(set(keys.values())) == len(keys) == len(single)
    for r in single:
        n = len(WORD.findall(r["text"]))
        key = keys[r["doc_id"]]
        lines[r["source"]].append((hashlib.md5(f"mix|{key}".encode()).hexdigest(), r["doc_id"], n))
        sizes[r["source"]] += n
    want = Counter()
    targets = brute_targets(sizes)
    for source, line in lines.items():
        at = 0
        for epoch in range(3):
            for _, doc_id, n in sorted(line):
                want[doc_id] += n > 0 and at < round(targets[source])
                at += n
    assert Counter(r["doc_id"] for r in mixed) == +want
    assert Counter(r["doc_id"] for r in encoded) == +want


def brute_targets(sizes):
    """Share by weight, stop sources at three times their size, share the rest again."""
    names = sorted(sizes)
    weights = {s: 1 + k % 3 for k, s in enumerate(names)}
    left, budget, out = set(names), float(sum(sizes.values())), {}
    while left:
        level = budget / sum(weights[s] for s in left)
        over = {s for s in left if level * weights[s] > 3 * sizes[s]}
        if not over:
            return out | {s: level * weights[s] for s in left}
        out |= {s: 3.0 * sizes[s] for s in over}
        budget -= sum(3 * sizes[s] for s in over)
        left -= over
    return out


def test_mixing_stage_on_repeated_rows_nulls_and_no_rows(spark):
    """Equal rows are used as often as so many different ones."""
    rows = [(1, "a b c", "en", "s0", 5)] * 4 + [(None, None, None, None, None)] * 2 + [(2, "d e f", "en", None, 5)] * 3 + [(3, "", "en", "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mix_sources(spark, docs, SF_DIR)
    # rows that differ only in which column is null are not taken for one another
    pair = spark.createDataFrame([(5, "a b c d", None, "web", 38), (5, "a b c d", "web", None, 38)], docs.schema)
    assert sorted((r["lang"] or "", r["source"] or "") for r in corpus_pipeline.mix_sources(spark, pair, SF_DIR).distinct().collect()) == [("", "web"), ("web", "")]
    marked = docs.withColumn("doc_id", F.monotonically_increasing_id())
    apart = corpus_pipeline.mix_sources(spark, marked, SF_DIR)
    assert Counter(r["text"] for r in out.collect()) == Counter(r["text"] for r in apart.collect())
    assert out.columns == corpus_pipeline.COLUMNS
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), SF_DIR).count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:3]])
def test_filtering_stages_on_odd_rows(spark, stage):
    """Nulls in different columns, equal rows, clashing columns and no rows."""
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    rng = np.random.default_rng(3)
    text, long = (" ".join("".join(syllables[i] for i in rng.integers(0, 60, rng.integers(1, 4))) for _ in range(n)) for n in (200, 60_000))
    rows = [(5, text, None, "web", 38), (5, text, "web", None, 38), (6, text, "en", "a", 1), (6, text, "en", "a", 1), (None, text, None, None, None)]
    rows += [(7, None, None, None, None), (8, "", "en", "s", 0), (9, long, "de", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("row_key", F.lit("x")).withColumn("kept", F.lit(False)).withColumn("score", F.lit(2.0))
    out = stage(spark, docs, SF_DIR)
    assert out.columns == corpus_pipeline.COLUMNS
    found = Counter(tuple(r) for r in out.collect())
    if stage is corpus_pipeline.quality_rules:
        # equal texts stay or go together, as often as they come; texts without enough words, or of repeated ones, go
        assert found == Counter(rows[:5]) + Counter([rows[-1]])
    elif stage is corpus_pipeline.quality_classifier:
        assert set(found.values()) <= {1, 2} and all(found[r] == n for r, n in Counter(rows).items() if found[r])
    else:
        # one of the five equal texts (one of the two rows with the smallest id), one of the texts without words, and the long one
        assert sum(found.values()) == 3 and sum(found[r] for r in rows[:2]) == 1 and found[rows[5]] == 1 and found[rows[7]] == 1
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_curriculum_follows_schedule(spark):
    rising, falling = ((0.0, 0.0), (1.0, 2.0)), ((0.0, 2.0), (1.0, 0.0))
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("if(id % 2 = 0, 'a', 'b')").alias("source"), F.lit("x y z").alias("text")
    )
    cycle = (rising, falling)
    placed = mixing.curriculum(mixing.mixture(docs, cycle), cycle).groupBy("source", F.floor(F.col("position") * 4).alias("quarter"))
    words = {(r["source"], r["quarter"]): r["n"] for r in placed.agg(F.sum("words").alias("n")).collect()}
    # the integral of 2t over quarters of the run: 1, 3, 5 and 7 sixteenths of 6000 words
    for quarter, share in enumerate((1, 3, 5, 7)):
        assert abs(words["a", quarter] - 6000 * share / 16) <= 6
        assert abs(words["b", 3 - quarter] - 6000 * share / 16) <= 6
