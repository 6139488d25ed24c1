"""What encoding to token tables holds beside its ids."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa

from rowfold.llm import queries, token_tables, units
from rowfold.llm.flat import FlatTexts


def test_checksums_do_not_copy_the_ids():
    ids, bounds = np.arange(4_000_000, dtype=np.int32), np.array([0, 1_000_000, 1_000_000, 4_000_000])
    tracemalloc.start()
    try:
        got = token_tables.checksums(ids, bounds)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < ids.nbytes // 8
    assert got.tolist() == [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    # part of a larger array, and ids of another width
    assert token_tables.checksums(ids[::2], np.array([0, 3])).tolist() == [zlib.crc32(np.array([0, 2, 4], "<u4").tobytes())]
    assert token_tables.checksums(ids.astype(np.int64), np.array([0, 3])).tolist() == [zlib.crc32(np.array([0, 1, 2], "<u4").tobytes())]


def test_workers_remember_half_the_units():
    held = units.byte_units(public_tokenizers.path("byte_bpe_50k.json"))
    assert held.most_units <= units.MEMORY_UNITS // 2


def test_a_full_memory_keeps_the_units_in_use():
    for kind, vocabulary in ((units.ByteUnits, queries.BYTE_BPE), (units.PieceUnits, queries.PIECE_BPE)):
        path, asked = queries.tokenizer_path(vocabulary), []
        small, large = kind(path, units=40), kind(path)
        encode = small.encode_units
        small.encode_units = lambda new: (asked.append(new), encode(new))[1]
        for k in range(6):
            texts = FlatTexts.of(pa.array([f"a common word and wörd{k}é" + "".join(f" rare{k}x{i}" for i in range(30)), "", None, f" common {k}"]))
            mine, whole = small.encode(texts), large.encode(texts)
            assert mine.ids.tolist() == whole.ids.tolist() and mine.bounds.tolist() == whole.bounds.tolist()
        encoded = [u.strip() for new in asked for u in new]
        assert encoded.count(b"common") == 1 and len(small.places) <= 40 + 40


def test_units_that_may_follow_anything_are_told_as_one_by_one():
    words = [b" a", b" ", b"  ", b" \n", b"a", b"\n", " é".encode(), "  ".encode(), b" .", b"..", b" x y"]
    assert units._follow(words).tolist() == [w[:1] == b" " and len(w) > 1 and not units._MAYBE_SPACE[w[1]] for w in words]
