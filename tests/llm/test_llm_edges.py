"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names; and the methods' own promises."""

from __future__ import annotations

import gzip
import io
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from rowfold.llm import (
    fertility,
    flat,
    mixing,
    near_vectors,
    piece_encoding,
    pieces,
    rule_ensemble,
    simhash,
    token_counts,
    token_tables,
    units,
    url_rules,
    warc,
)
from rowfold.llm.graph import components
from rowfold.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer_path

BYTES, PIECES = tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE)
LONG = "lorem ipsum dolor " * 30_000
ODD = [
    "", " ", "  ", "a  b", " a", "a ", "a\n b", "a \nb", "<|endoftext|> hi <|endoftext|>", "a ▁ b", "▁▁", "日本語 テスト",
    "　a 　 b", "a\tb \t c", "don't I'll  we've", "😀 😀😀 ☃ è́", "<s> </s> <unk> <0x41>", "a\x1fb \x1fc", "\x00 a\x00b", "x" * 5000,
]
#: Rows with nulls in every column, repeated rows, a repeated id, and columns named like those that are added.
DOCS = [
    (1, "one two three four five", "en", "s0"), (1, "one two three four five", "en", "s0"), (1, "another text", None, "s1"),
    (None, "no id at all", "de", "s0"), (2, None, "en", None), (3, "", "xx", "s1"), (4, LONG, "en", "s0"), (5, " \n\t ", "fr", "s2"),
]
CLASH = ["n_tokens", "kept", "size", "fp", "row", "id", "target", "score", "key", "start", "kept_doc_id", "row_", "c0"]


def documents(spark, rows=DOCS):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.withColumns({c: F.lit(7) for c in CLASH})


@pytest.fixture(params=["some", "none"])
def docs(request, spark):
    return documents(spark, DOCS if request.param == "some" else [])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_texts(n, seed=1):
    rng = random.Random(seed)
    bits = [" ", "a", "b1", "\n", "\t", "é", "中", "▁", " the", "'s", "<|endoftext|>", " ", "😀", ".", "  "]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(n)]


# --- units, pieces and flat texts


def test_units_give_the_library_ids():
    texts = [*ODD, *random_texts(3000)]
    column = flat.FlatTexts.of(pa.array(texts))
    tokenizer = Tokenizer.from_file(BYTES)
    found = units.ByteUnits(BYTES).encode(column)
    for k, text in enumerate(texts):
        own = found.ids[found.bounds[k] : found.bounds[k + 1]].tolist()
        assert own == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    memory = units.PieceUnits(PIECES, units=50)
    assert memory.cuts
    for _ in range(2):  # the second time the memory has started afresh
        found = memory.encode(column)
        starts, stops = memory.spans(found)
        for k, text in enumerate(texts):
            own = slice(found.bounds[k], found.bounds[k + 1])
            assert found.ids[own].tolist() == memory.model.processor.encode(text), repr(text)
            if own.stop > own.start:
                assert starts[own][0] == 0 and stops[own][-1] == len(text.encode())
                assert (starts[own][1:] == stops[own][:-1]).all()


def test_spans_hold_their_pieces():
    memory = units.PieceUnits(PIECES)
    text = "The quick  brown fox, naïve 日本 😀!"
    found = memory.encode(flat.FlatTexts.of(pa.array([text])))
    raw = text.encode()
    for token, a, b in zip(found.ids, *memory.spans(found)):
        piece = memory.model.pieces[token]
        if memory.model.is_byte[token]:
            assert raw[a:b] == bytes([int(piece[3:5], 16)])
        else:
            assert raw[a:b].decode() in (piece.replace("▁", " "), piece.replace("▁", "", 1).replace("▁", " "))


def test_normalisation_by_a_compiled_map_follows_the_library():
    """The map of a rule that the library has built in, with the library's own normaliser as the measure."""
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    blob = normalizer.serialized_model_proto()
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(blob)
    model = pieces.PieceModel.__new__(pieces.PieceModel)
    model.normalizer, model.map = proto.normalizer_spec, pieces.CharMap(proto.normalizer_spec.precompiled_charsmap)
    assert len(model.map.units) > 1000
    for text in ["ｆｕｌｌ　ｗｉｄｔｈ ①②", "ﬁne  ŀ", "é́ ㌔ ½", "plain text", "a b\tc\n", "  two  spaces ", "", "안녕 각", *random_texts(300, 2)]:
        out, places = model.normalize(text.encode())
        assert out.decode() == normalizer.normalize(text), repr(text)
        assert len(places) == len(out) + 1 and (np.diff(places) >= 0).all() and places[-1] <= len(text.encode())


def test_flat_words_match_split():
    texts = [*ODD, None, *random_texts(500)]
    column = flat.FlatTexts.of(pa.array(texts).slice(1))
    words, bounds = column.words()
    for k, text in enumerate(texts[1:]):
        assert words[bounds[k] : bounds[k + 1]].to_pylist() == (text or "").encode().split()


# --- operators


def test_near_vectors_edges(spark):
    nan, inf = math.nan, math.inf
    e = [1.0, 0.0, 0.0, 0.0]
    rows = [
        (1, e, 0), (2, e, 0), (2, e, 0), (3, [2.0, 0.1, 0.0, 0.0], 0), (4, e, 1), (5, e, None), (6, None, 0), (7, [0.0] * 4, 0),
        (8, [nan, 0.0, 0.0, 1.0], 0), (9, [inf, 0.0, 0.0, 1.0], 0), (10, [1.0, None, 0.0, 0.0], 0), (11, [], 0), (None, e, 0),
        (12, [1.0, 0.0], 0), (13, [-0.0, 1.0, 0.0, 0.0], 0), (14, [0.0, 3.0, 0.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("weight", F.lit(1))
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_vectors.near_vectors(df).collect()}
    assert near_vectors.near_vectors(df).count() == len(rows)
    alone = {(k, 0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 11, 12)} | {(None, 0, None, False)}
    assert got == alone | {(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (13, 1, 13, True), (14, 1, 13, False)}
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [8, 64, 100])
def test_near_vectors_against_brute_force(spark, size):
    """Many at the threshold itself, several blocks, one hot label; nothing is lost where directions span the space."""
    rng = np.random.default_rng(size)
    base = rng.standard_normal((60, size))
    near = []
    for v in base[:30]:
        for c in (0.90, 0.925, 0.9301, 0.935, 0.99):
            u = v / np.linalg.norm(v)
            w = rng.standard_normal(size)
            w -= w @ u * u
            near.append(c * u + math.sqrt(1 - c * c) * w / np.linalg.norm(w))
    x = np.concatenate([base, near]).astype(np.float32)
    labels = [0 if k % 3 else 1 for k in range(len(x))]
    df = spark.createDataFrame([(k, v.tolist(), y) for k, (v, y) in enumerate(zip(x, labels))], "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors.near_vectors(df, block=40).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    linked = (u @ u.T >= 0.93) & (np.array(labels)[:, None] == np.array(labels)[None])
    np.fill_diagonal(linked, False)
    root = np.arange(len(x))
    while True:
        new = np.array([min([root[k], *root[linked[k]]]) for k in range(len(x))])
        if (new == root).all():
            break
        root = new
    assert got == {k: (int(linked[k].sum()), int(root[k])) for k in range(len(x))}


def test_dense_blocks_take_memory_by_vectors_and_not_by_links():
    """Two full blocks of different vectors, all near each other: 268 million links, 4.3 GB as pairs."""
    n = 2 * near_vectors.BLOCK
    rng = np.random.default_rng(3)
    x = np.stack([np.ones(n), rng.uniform(-0.1, 0.1, n)], axis=1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    part, weight = np.arange(n) % 2, 1 + np.arange(n) % 3
    tracemalloc.start()
    links, root = near_vectors.block_links(x, x @ near_vectors.directions(2), part, weight, 0.93)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (root == 0).all() and (links == np.where(part == 0, weight[part == 1].sum(), weight[part == 0].sum())).all()
    assert peak < 400 << 20


def test_components_of_chains_and_stars(spark, tmp_path):
    rng = random.Random(3)
    chain = list(range(200))
    rng.shuffle(chain)
    edges = [*zip(chain, chain[1:]), *[(1000, k) for k in range(1001, 1300)], (5000, 5000), (7000, 7001), (7001, 7000)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df, str(tmp_path)).collect()}
    want = {k: 0 for k in range(200)} | {k: 1000 for k in range(1000, 1300)} | {5000: 5000, 7000: 7000, 7001: 7000}
    assert got == want


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("x"))


def test_warc_edges(spark, tmp_path):
    big, tail = "<p>ü" + "x" * 2000, "y" * 1000
    rows = [
        (1, "http://a/", big), (2, "http://b/\r\nX-Page-ID: 9", big), (2, "http://b/\r\nX-Page-ID: 9", big), (3, None, None),
        (None, "http://c/", big), (4, "u", ""), (5, "u", "small"), (6, "u", "small"), (7, "u", tail), (8, "u", tail), (9, "u", LONG),
    ]
    got = warc.round_trip(spark, pages(spark, rows), f"file://{tmp_path}/w", range_bytes=700).collect()
    told = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got), key=repr)
    n = len(big.encode())
    assert told == sorted(
        [
            (1, n, "revisit", 2), (2, n, "response", None), (2, n, "revisit", 2), (3, 0, "response", None), (None, n, "revisit", 2),
            (4, 0, "response", None), (5, 5, "response", None), (6, 5, "response", None), (7, 1000, "revisit", 8),
            (8, 1000, "response", None), (9, len(LONG), "response", None),
        ],
        key=repr,
    )
    import hashlib

    digests = {(r[0], r[1]): hashlib.sha1((h or "").encode()).hexdigest() for r, h in zip([(p, len((h or "").encode())) for p, _, h in rows], [h for _, _, h in rows])}
    assert all(r["payload_digest"] == digests[r["page_id"], r["payload_bytes"]] for r in got)
    assert warc.round_trip(spark, pages(spark, []), f"file://{tmp_path}/none").count() == 0


def test_warc_reads_back_urls_of_any_length(spark, tmp_path):
    rng = random.Random(8)
    noise = "http://n/" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(400_000))
    html = "<p>" + "x" * 2000
    rows = [(1, "http://a/", html), (2, "http://b/" + " " * 300_000, html), (3, noise, html), (4, noise, "small")]
    got = warc.round_trip(spark, pages(spark, rows), f"file://{tmp_path}/w", range_bytes=5_000).collect()
    told = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got)
    n = len(html)
    assert told == [(1, n, "revisit", 3), (2, n, "revisit", 3), (3, n, "response", None), (4, 5, "response", None)]


def test_archives_are_standard_and_read_alike_in_ranges_of_any_size(spark, tmp_path):
    rng = random.Random(4)
    noise = ["".join(chr(rng.randrange(32, 127)) for _ in range(rng.randrange(3000))) for _ in range(40)]
    manifest = warc.write_pages(pages(spark, [(k, f"http://x/{k}", t) for k, t in enumerate(noise)]).coalesce(1), f"file://{tmp_path}/w")
    (path,) = [r["path"] for r in manifest.filter("records > 0").collect()]
    with open(path.removeprefix("file://"), "rb") as file:
        data = file.read()
    plain = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
    assert plain.count(b"WARC/1.1\r\n") == 40 and b"WARC-Payload-Digest: sha1:" in plain
    for size in (1, 997, 10_000, 1 << 30):
        offsets = []
        for start in range(0, len(data), size) if size > 1 else ():
            source = warc.ByteRange(io.BytesIO(data), start, min(len(data), start + size), len(data))
            offsets += [r.offset for r in warc.range_records(source)]
        if size > 1:
            assert len(offsets) == len(set(offsets)) == 40


def test_false_magic_is_no_record():
    inner = gzip.compress(b"not a record") + b"\x1f\x8b\x08" + b"WARC/1.1\r\n\r\n"
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    block = b"HTTP/1.1 200 OK\r\n\r\n" + inner * 50
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(block)
    member = stored.compress(head + block + b"\r\n\r\n") + stored.flush()
    data = b"junk\x1f\x8b\x08" + member + member
    found = []
    for start in range(0, len(data), 64):
        source = warc.ByteRange(io.BytesIO(data), start, min(len(data), start + 64), len(data))
        found += [(r.offset, r.block) for r in warc.range_records(source)]
    assert found == [(7, block), (7 + len(member), block)]


def test_mixture_edges(spark):
    taken = lambda df: mixing.scheduled(mixing.mixture(df), mixing.new_work_dir(spark, "mixed"))[1]
    got = rows_of(taken(documents(spark)).select("doc_id", "size", "source", "source_size", "target", "taken"))
    assert len(got) == len(DOCS)
    assert all(0 <= r[5] <= 3 * r[1] for r in got)
    again = rows_of(taken(documents(spark).repartition(3)).select("doc_id", "size", "source", "source_size", "target", "taken"))
    assert got == again
    assert taken(documents(spark, [])).count() == 0
    nothing = taken(documents(spark, [(1, None, "en", "a"), (2, "", "en", "b")])).collect()
    assert {(r["taken"], r["target"]) for r in nothing} == {(0, 0.0)}


def test_mixture_with_hot_rows_and_sources(spark):
    """A third of all rows are one and the same; lines are cut into slices; totals are exact."""
    n = 9000
    docs = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 10 == 9, "b").when(F.col("id") % 100 == 1, None).otherwise("a").alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 7).cast("int")).alias("text"),
    )
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(mixing, "SLICE_ROWS", 500)
        rows = mixing.scheduled(mixing.mixture(docs), mixing.new_work_dir(spark, "mixed"))[1].collect()
    assert len(rows) == n
    for source in ("a", "b", None):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == round(own[0]["target"]) <= 3 * own[0]["source_size"]


def test_quality_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, None, 0), (3, 0, 0), (99, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.filter("quality = 1")):
        rows = rule_ensemble.quality_scores(docs, known).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] is not None for r in rows)


def test_rules_are_read_from_trees():
    described = """RandomForestClassificationModel: uid=x, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 0.5)
     Predict: 1.0
"""
    rules = [r.conditions for r in rule_ensemble.forest_rules(described, ("a", "b"))]
    inf = math.inf
    assert rules == [
        (("a", -inf, 0.5),), (("a", -inf, 0.5), ("b", -inf, 2.0)), (("a", -inf, 0.5), ("b", 2.0, inf)), (("a", 0.5, inf),),
    ]


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "AA!! BB!!").otherwise("aa bb cc").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    turned = labels.withColumn("quality", F.when(rule_ensemble.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (rows_of(rule_ensemble.quality_scores(docs, y)) for y in (labels, turned))
    assert first == second and len({r[3] for r in first}) == 2


def test_fertility_edges(spark, docs):
    rows = fertility.judged(docs, PIECES).collect()
    assert len(rows) == docs.count()
    assert all(r["kept"] is not None and not (r["base_failed"] and r["kept"]) for r in rows)


def test_fertility_bands(spark):
    """Clean prose stays, encoded data and monotonous text goes, in several scripts."""
    rng = random.Random(5)
    common = "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were when".split()
    prose = [" ".join(rng.choice(common) + rng.choice(["", "s", "ing", "er"]) for _ in range(120)) for _ in range(60)]
    rare = "".join(chr(rng.randrange(0x1F300, 0x1F5FF)) + " " for _ in range(200))
    few = " ".join(rng.choice(["yes", "no"]) + str(k) * 0 + rng.choice("ab") for k in range(300))
    greek = " ".join("".join(rng.choice("αβγδεζηθικλμνοπρστυφχψω") for _ in range(5)) for _ in range(120))
    rows = [(k, t, None, "s") for k, t in enumerate([*prose, rare, few, greek])]
    kept = {r["doc_id"]: r["kept"] for r in fertility.judged(documents(spark, rows), PIECES).collect()}
    assert all(kept[k] for k in range(60)) and kept[62]
    assert not kept[60] and not kept[61]


def test_thin_groups_have_entropy_bands_too(spark):
    """Monotonous texts go, and their neighbours stay, in a rare language, a sparse length and a small table."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnoprstu") for _ in range(rng.randint(3, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    flat = lambda n: " ".join(rng.choice(words[:24]) for _ in range(n))
    few = [*[(prose(150), "en") for _ in range(9)], (flat(150), "en")]
    many = [*[(prose(150), "en") for _ in range(90)], *[(flat(150), "en") for _ in range(3)], (prose(150), "is"), (flat(150), "is"), (prose(3_000), "en"), (" ".join(rng.choice(words[:40]) for _ in range(3_000)), "en")]
    for table, gone in ((few, {9}), (many, {90, 91, 92, 94, 96})):
        rows = fertility.judged(documents(spark, [(k, *t, "s") for k, t in enumerate(table)]), PIECES).collect()
        assert not any(r["base_failed"] for r in rows)
        assert {r["doc_id"] for r in rows if not r["kept"]} == gone
        # the same texts in the same proportions, many times over: the same verdicts
        times = documents(spark, [(k, *t, "s") for k, t in enumerate(table)]).crossJoin(spark.range(40))
        verdicts = fertility.judged(times, PIECES).groupBy("doc_id", "kept").count().collect()
        assert {r["doc_id"] for r in verdicts if not r["kept"]} == gone and all(r["count"] == 40 for r in verdicts)


def test_url_edges(spark):
    urls = [
        "http://x.net/a", "http://NET/", "http://net", "http://x.example.net/en/1?q=/", "HTTP://Example.NET/en/", "http://notexample.net/en/",
        "https://example.com/de/#x", "https://example.com/DE/", "http://a.org/fr/", "http://spam-x.org/fr/", "http://spam-x.org/en/",
        "ftp:nothing", "", None, "http://", "://a.net/", "http://h.org?x=://y.net/", "http://a.org/login.php", "http://a.org/xlogin.php",
        "http://a.org/\nb://c.net/", "http://a.org/exe/x.exe",
    ]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string").withColumn("host", F.lit("x"))
    got = {r["page_id"]: r for r in url_rules.url_verdicts(df.union(df)).collect()}
    assert url_rules.url_verdicts(df.union(df)).count() == 2 * len(urls)
    told = [(got[k]["rule"], got[k]["verdict"]) for k in range(len(urls))]
    assert told == [
        ("net/", "block"), ("net/", "block"), (None, "allow"), ("example.net/en/", "allow"), ("example.net/en/", "allow"), ("net/", "block"),
        ("example.com/de/", "block"), (None, "allow"), ("org/fr/", "allow"), ("org/fr/", "allow"), (None, "block"),
        (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), ("net/", "block"), (None, "allow"), (None, "block"), (None, "allow"),
        (None, "allow"), (None, "block"),
    ]
    assert (got[16]["host"], got[16]["path"]) == ("h.org", "") and (got[13]["host"], got[13]["path"]) == ("", "")
    assert url_rules.url_verdicts(df.limit(0)).count() == 0


def test_only_candidates_run_their_expressions():
    """Rules are filed under their rarest token, and every rule that matches is a candidate."""
    index = url_rules.PatternIndex(url_rules.PATTERN_RULES, {"login": 500, "php": 2, "cgi": 1, "bin": 90})
    assert "php" in index.by_token and "login" not in index.by_token and "cgi" in index.by_token
    assert index.candidates("http://a.org/login") == [] and len(index.candidates("http://a.org/login.php")) == 1
    rng = random.Random(6)
    bits = sorted({t for r in url_rules.PATTERN_RULES for a in r.tokens for t in a}) + ["http", "://", ".", "/", "-", "?", "=", "#", "a", "2024/01"]
    for _ in range(4000):
        url = "".join(rng.choice(bits) for _ in range(rng.randint(1, 10)))
        every = [n for n, r in enumerate(index.rules) if r[0].search(url)]
        assert index.first(url) == (every[0] if every else None), url


def test_tokens_follow_from_expressions():
    tokens = lambda p: {frozenset(t) for t in url_rules.PatternRule(p).tokens}
    assert tokens(r"://ads?\.") == {frozenset(["ad"]), frozenset(["ads"])}
    assert tokens(r"/(?:wp-)?login\.php\b") == {frozenset(["login", "php"]), frozenset(["wp", "login", "php"])}
    assert tokens(r"/(?:user|account)/signup\b") == {frozenset(["user", "signup"]), frozenset(["account", "signup"])}
    for unproven in (r"spam", r"/spam", r"/[a-z]*spam/", r"/spam\d*/", r"a*", r"(?:/x/)?", r".x."):
        assert not all(url_rules.PatternRule(unproven).tokens), unproven


def test_expressions_mean_the_same_as_in_sql(spark):
    """Line ends, digits and letters outside ASCII, random URLs: the query and its SQL agree."""
    import duckdb

    from rowfold.llm.queries import ORACLES

    rng = random.Random(11)
    bits = ["http://", "a.com", "/x.exe", "\n", "/calendar/٢٠٢٤/١١", "/calendar/2024/11", "é", "_", "?", "#", "/", ".", "ads", "x.apk", "farm", "İ", "K", "ſpam-", "spam-", "poker", "\r", "CASINO", "ß"]
    urls = ["http://a.com/x.exe\n", "http://a.com/calendar/٢٠٢٤/١١", *("".join(rng.choice(bits) for _ in range(rng.randint(1, 7))) for _ in range(3000))]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {tuple(r) for r in url_rules.url_verdicts(df).drop("pattern").collect()}
    pages = pa.table({"page_id": list(range(len(urls))), "url": urls})  # noqa: F841
    connection = duckdb.connect()
    connection.register("pages", pages)
    assert got == set(connection.execute(ORACLES["op6_url_rules"]).fetchall())


def test_many_host_rules_are_looked_up(spark):
    hosts = [url_rules.HostRule(f"h{k}.example", "/a/" if k % 2 else "/", "block") for k in range(50_000)]
    df = spark.createDataFrame([(1, "http://x.h7.example/a/b"), (2, "http://x.h7.example/b"), (3, "http://xh8.example/"), (4, "http://" + "a." * 200_000 + "h8.example/")], "page_id long, url string")
    got = {r["page_id"]: r["rule"] for r in url_rules.url_verdicts(df, hosts=hosts, patterns=()).collect()}
    assert got == {1: "h7.example/a/", 2: None, 3: None, 4: "h8.example/"}


def test_rules_are_found_by_tokens_they_match_but_do_not_list():
    """Tokens of the expressions themselves, shortened and lengthened, as well as the listed ones."""
    index = url_rules.PatternIndex(url_rules.PATTERN_RULES, {})
    assert index.first("http://ad.example.com/x") is not None and index.first("http://ads.example.com/x") is not None
    rng = random.Random(7)
    words = {w for r in url_rules.PATTERN_RULES for w in re.findall("[a-z0-9]+", re.sub(r"\\.", " ", r.pattern))}
    words |= {w[:-1] for w in words} | {w + "s" for w in words}
    bits = sorted(words - {""}) + ["http://", "http://", "://", ".", ".", "/", "-", "?", "=", "#", "&", "_", "2024/01"]
    for _ in range(20_000):
        url = "".join(rng.choice(bits) for _ in range(rng.randint(2, 8)))
        every = [n for n, r in enumerate(index.rules) if r[0].search(url)]
        assert index.first(url) == (every[0] if every else None), url


def test_token_counts_edges(spark, docs):
    rows = token_counts.token_counts(docs, BYTES, window=2000, overlap=256).collect()
    tokenizer = Tokenizer.from_file(BYTES)
    want = []
    for r in docs.select("doc_id", "text").collect():
        text = r["text"] or ""
        want.append((r["doc_id"], len(text.encode()), len(tokenizer.encode(text, add_special_tokens=False).ids)))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


def test_windows_fit_together_or_widen(spark):
    """Huge texts with seams, without any, and with special strings and white space at the seams."""
    rng = random.Random(7)
    texts = [
        "x" * 9000, "word " * 2000, "a  b   c\n\n " * 900, "<|endoftext|>" * 700, "".join(random_texts(2000, 8)), "日本語 " * 2000,
        "y" * 3000 + " z" * 2000, "".join(rng.choice("ab \n") for _ in range(9000)), "é" * 2100 + " e",
    ]
    tokenizer = Tokenizer.from_file(BYTES)
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(documents(spark, rows), BYTES, window=2000, overlap=256).collect()}
    assert got == {k: len(tokenizer.encode(t, add_special_tokens=False).ids) for k, t in enumerate(texts)}
    assert token_counts.window_count(tokenizer, "x" * 3000, 256, 0) is None


def test_piece_edges(spark, docs):
    rows = piece_encoding.encode_pieces(docs, PIECES).collect()
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert len(rows) == docs.count()
    assert {(r["doc_id"], tuple(r["ids"])) for r in rows} == {(k, tuple(processor.encode(t or ""))) for k, t in texts}
    back = piece_encoding.decode_pieces(piece_encoding.encode_pieces(docs, PIECES), PIECES).collect()
    assert {(r["doc_id"], r["text"]) for r in back} == {(k, t or "") for k, t in texts}


def test_simhash_edges(spark, docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by_id = {(r["doc_id"], r["component_id"], r["fp"] == 0) for r in rows}
    if rows:
        # texts without words are one group
        assert {(2, 2, True), (3, 2, True), (5, 2, True), (None, None, False)} <= by_id
    stay = simhash.deduplicated(docs).collect()
    # two different texts have the id 1: each is its group's
    assert sorted((r["doc_id"] for r in stay), key=str) == ([1, 1, 2, 4, None] if rows else [])
    if stay:
        assert stay[0].asDict().keys() == set(docs.columns)


@pytest.mark.parametrize(("radius", "parts"), [(2, 3), (2, 2), (3, 4), (10, 6)])
def test_pigeonhole_search_finds_all_links(spark, tmp_path, radius, parts):
    """Dense and sparse groups, blocks of a few fingerprints, correlated bits."""
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, radius + 3), replace=False))) for b in base[:20] for _ in range(6)]
    dense = [base[0] ^ np.uint64(1 << k) for k in range(64)]
    fps = np.unique(np.array([*base, *flips, *dense], np.uint64))
    more = rng.integers(0, 1 << 62, len(fps), dtype=np.int64)
    df = spark.createDataFrame([(k, int(np.int64(f.view(np.int64))), int(m)) for k, (f, m) in enumerate(zip(fps, more))], "node long, fp long, more long")
    links = simhash.near_links(df, radius, parts, block=16)
    got = {r["node"]: r["root"] for r in components(links, str(tmp_path)).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= radius
    root = np.arange(len(fps))
    while (new := np.array([root[near[k]].min() for k in range(len(fps))])).tolist() != root.tolist():
        root = new
    assert {k: got.get(k, k) for k in range(len(fps))} == dict(enumerate(root.tolist()))


def test_thresholds_sum_to_the_pigeonhole_bound():
    rng = np.random.default_rng(1)
    parts = [list(range(0, 10)), list(range(10, 30)), list(range(30, 64))]
    fp = rng.integers(-(1 << 62), 1 << 62, 500)
    counts = [rng.integers(0, 1000, 1 << min(len(p), simhash.HISTOGRAM_BITS)).astype(float) for p in parts]
    for radius in (2, 5):
        found = simhash.thresholds(simhash.part_values(fp, parts), parts, counts, radius)
        assert (found.sum(axis=1) == radius - 2).all() and found.min() >= -1 and found.max() <= simhash.WIDEST
    # a crowded part is left out
    crowded = [np.zeros_like(c) for c in counts]
    crowded[0] += 1e9
    assert (simhash.thresholds(simhash.part_values(fp, parts), parts, crowded, 2)[:, 0] == -1).all()


def test_token_table_edges(spark, docs, tmp_path):
    token_tables.write_token_table(docs, f"{tmp_path}/t", BYTES, files=3)
    rows = sorted(token_tables.read_back(spark, f"{tmp_path}/t", work_dir=f"{tmp_path}/w").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in docs.collect()), key=lambda k: (k is not None, k or 0))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    if rows:
        nulls = [r for r in rows if r["doc_id"] == 2]
        assert [(r["n_tokens"], r["ids_crc32"]) for r in nulls] == [(1, zlib.crc32(np.array([2], "<u4").tobytes()))]


def test_token_table_layout(spark, tmp_path):
    """Dictionary or delta encoded columns, several row groups, a page index, reads of few columns and few rows."""
    rng = random.Random(10)
    rows = [(k, " ".join(f"w{rng.randrange(500)}" for _ in range(60)), "en", "s") for k in range(4000)]
    token_tables.write_token_table(documents(spark, rows), f"{tmp_path}/t", BYTES, files=2, row_group_bytes=64 << 10, page_bytes=8 << 10)
    files = sorted((tmp_path / "t").glob("part-*.parquet"))
    meta = pq.ParquetFile(files[0]).metadata
    columns = {meta.row_group(0).column(k).path_in_schema: meta.row_group(0).column(k) for k in range(meta.num_columns)}
    assert meta.num_row_groups > 1
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    ids = next(c for name, c in columns.items() if name.startswith("ids."))
    assert {"RLE_DICTIONARY", "PLAIN_DICTIONARY", "DELTA_BINARY_PACKED"} & set(ids.encodings)
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    plan = token_tables.read_tokens(spark, f"{tmp_path}/t", "doc_id", "n_tokens").filter("doc_id = 17")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,17)" in text and "ids:" not in text
    assert plan.count() == 1
