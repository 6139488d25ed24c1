"""Tokenising whole texts through a memory of their space-separated units.

A text is cut where no token can cross the cut, so its ids are those of its units, end to end. Each distinct unit is encoded
once by the tokeniser library itself and remembered; finding the units of a batch and joining their ids is numpy and Arrow
work. Where a cut is not proven there is none.

*Byte-level BPE* whose pre-tokeniser is the usual pattern (``' ?\\p{L}+ | ?\\p{N}+ | ... | \\s+(?!\\S) | \\s+'``). Boundaries are:
before a space that a non-space follows (a match that holds the space and the character before it would have to be a run of white
space, and such a run gives its last space to the word behind it); between an ASCII letter and ASCII punctuation (no match goes on
from one to the other); before and behind a line break between ASCII characters that are not white space (a match of its
own). Texts that hold a special string of the vocabulary are not cut.

*SentencePiece BPE* without a character map, with a space put in front and white space kept: merges give vocabulary
pieces only, and if no piece has the space mark behind another character, none crosses the start of a run of spaces.
"""

from __future__ import annotations

import functools
import os
from itertools import chain, compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rowfold.llm.flat import FlatTexts, gather
from rowfold.llm.pieces import PieceModel

# What one Python worker remembers at most (a unit takes some 150 bytes); beyond it the memory starts afresh with the units in use.
MEMORY_UNITS = 750_000
MEMORY_BYTES = 24 << 20
# New units that are encoded as one text; the library takes longer for each byte of a longer one.
JOINED_UNITS = 64
# ASCII white space and separators, and lead bytes of the characters that may be white space outside ASCII.
_MAYBE_SPACE = np.zeros(256, dtype=bool)
_MAYBE_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_INK, _LETTER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_INK[33:127] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_PUNCTUATION = _INK & ~_LETTER & ~_DIGIT


class Encoded:
    """Token ids of a slice of texts: ``ids``, and ``bounds`` of each text's ids among them.

    ``places`` are the units in the memory, ``unit_bounds`` each text's units, ``positions`` the tokens in the memory.
    """

    def __init__(self, memory: UnitMemory, places: np.ndarray, unit_bounds: np.ndarray) -> None:
        self.places, self.unit_bounds = places, unit_bounds
        self.positions, self.unit_tokens = gather(memory.bounds.values, places)
        self.ids, self.bounds = memory.ids.values[self.positions], self.unit_tokens[unit_bounds]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


class Growing:
    """An array that is added to, with room kept for more, so that adding copies little."""

    def __init__(self, kind: type) -> None:
        self.held, self.size = np.zeros(1 << 12, kind), 0

    def add(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.held):
            wider = np.zeros(max(end, 3 * len(self.held) // 2), self.held.dtype)
            wider[: self.size] = self.values
            self.held = wider
        self.held[self.size : end] = more
        self.size = end

    @property
    def values(self) -> np.ndarray:
        return self.held[: self.size]


class UnitMemory:
    """Ids (and more, by subclass) of the units seen so far, in flat arrays, and a table of their places."""

    def __init__(self, units: int = MEMORY_UNITS, size: int = MEMORY_BYTES) -> None:
        self.most_units, self.most_bytes = units, size
        self.forget()

    def forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.bytes = 0
        self.ids, self.bounds = Growing(np.int32), Growing(np.int64)
        self.bounds.add(np.zeros(1, np.int64))

    def in_groups(self, units: list[bytes]) -> list[bytes]:
        """New units in the order in which they are encoded."""
        return units

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units end to end, and how many each has."""
        raise NotImplementedError

    def remember(self, units: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.bounds.add(self.ids.size + np.cumsum(sizes))
        self.ids.add(ids)

    def renew(self, units: list[bytes]) -> None:
        """Start afresh with what is known of these units, the common ones among them; with nothing if that is half the memory."""
        known = [u for u in dict.fromkeys(units) if u in self.places]
        size = sum(map(len, known))
        if 2 * len(known) > self.most_units or 2 * size > self.most_bytes:
            self.forget()
            return
        positions, bounds = gather(self.bounds.values, np.array([self.places[u] for u in known], np.int64))
        ids = self.ids.values[positions]
        self.forget()
        self.places, self.bytes = dict(zip(known, range(len(known)), strict=True)), size
        if known:
            self.remember(known, ids, np.diff(bounds))

    def encode(self, texts: FlatTexts) -> Encoded:
        """Ids of all texts, by their units."""
        raise NotImplementedError

    def _places(self, units: pa.Array) -> np.ndarray:
        """Where each of the units is remembered; new ones are encoded."""
        held = units.to_pylist()
        if len(self.places) > self.most_units or self.bytes > self.most_bytes:
            self.renew(held)
        places = self.places
        found = list(map(places.get, held))
        missing = [k for k, at in enumerate(found) if at is None]
        if missing:
            fresh = self.in_groups(list(dict.fromkeys([held[k] for k in missing])))
            places.update(zip(fresh, range(len(places), len(places) + len(fresh)), strict=True))
            self.bytes += sum(map(len, fresh))
            self.remember(fresh, *self.encode_units(fresh))
            for k in missing:
                found[k] = places[held[k]]
        return np.array(found, np.int64)


def as_text(unit: bytes) -> str:
    return unit.decode("utf-8", "replace")


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes


class ByteUnits(UnitMemory):
    """Units of a byte-level BPE file of the tokenizers library, special strings handled as its default."""

    def __init__(self, path: str, **limits: int) -> None:
        self.tokenizer = byte_tokenizer(path)
        # in a byte-level vocabulary a character stands for a byte; added tokens are plain text
        decoder = self.tokenizer.get_added_tokens_decoder()
        added = {i: len(t.content.encode()) for i, t in decoder.items()}
        self.special = [t.content.encode() for t in decoder.values() if t.content]
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = added.get(i, len(token))
        super().__init__(**limits)

    def encode(self, texts: FlatTexts) -> Encoded:
        data, n = texts.data, len(texts.data)
        if not n:
            return Encoded(self, np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
        # ``inner[i]``: bytes i and i + 1 are of one text
        inner = np.ones(n, bool)
        inner[texts.bounds[1:][texts.sizes > 0] - 1] = False
        before, behind = data[:-1], data[1:]
        cut = np.zeros(n + 1, bool)
        cut[1:-1] = _LETTER[before] & _PUNCTUATION[behind]
        cut[:-2] |= inner[:-1] & (before == 32) & ~_MAYBE_SPACE[behind]
        breaks = np.flatnonzero(data == 10)
        breaks = breaks[(breaks > 0) & (breaks < n - 1)]
        breaks = breaks[inner[breaks - 1] & inner[breaks] & _INK[data[breaks - 1]] & _INK[data[breaks + 1]]]
        cut[breaks] = cut[breaks + 1] = True
        for k in self._special(texts):
            cut[texts.bounds[k] : texts.bounds[k + 1]] = False
        cut[texts.bounds[:-1]] = True
        cut[n] = False
        at = np.flatnonzero(cut).astype(np.int64)
        units = pa.Array.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, n)), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        places = self._places(units.dictionary)[units.indices.to_numpy(zero_copy_only=False)]
        # texts without bytes have no unit
        return Encoded(self, places, np.searchsorted(at, texts.bounds))

    def _special(self, texts: FlatTexts) -> set[int]:
        """The texts that hold a special string."""
        found, whole = set(), texts.data.tobytes()
        for content in self.special:
            at = whole.find(content)
            while at >= 0:
                found.add(int(np.searchsorted(texts.bounds, at, side="right")) - 1)
                at = whole.find(content, at + 1)
        return found

    def in_groups(self, units: list[bytes]) -> list[bytes]:
        """In an order in which many of them can be encoded as one text: units that have to be first, each before some others."""
        follow = _follow(units)
        others, firsts = list(compress(units, follow)), list(compress(units, ~follow))
        size, out = JOINED_UNITS - 1, []
        for k, first in enumerate(firsts):
            out.append(first)
            out += others[k * size : (k + 1) * size]
        return out + others[len(firsts) * size :]

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """New units are encoded end to end, many as one text, and told apart by the bytes of their tokens."""
        follow = _follow(units)
        follow[:1] = False
        runs = [*np.flatnonzero(~follow).tolist(), len(units)]
        starts = [k for a, b in pairwise(runs) for k in range(a, b, JOINED_UNITS)]
        whole, ends = b"".join(units), np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        cuts = [0, *ends[np.array(starts[1:], np.int64) - 1].tolist(), len(whole)]
        texts = [as_text(whole[a:b]) for a, b in pairwise(cuts)]
        ids = _flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])[0]
        covered = np.concatenate([[0], np.cumsum(self.token_bytes[ids])])
        at = np.searchsorted(covered, ends)
        if covered[-1] != ends[-1] or (covered[at] != ends).any():
            # bytes that are not UTF-8: one by one
            return _flat([self.tokenizer.encode(as_text(u), add_special_tokens=False).ids for u in units])
        return ids, np.diff(at, prepend=0)


def _follow(units: list[bytes]) -> np.ndarray:
    """Whether a cut before each unit is proven whatever comes before: it is a space and a non-space. No unit is empty."""
    data = np.frombuffer(b"".join(units) + b" ", np.uint8)
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    first = np.cumsum(sizes) - sizes
    return (data[first] == 32) & (sizes > 1) & ~_MAYBE_SPACE[data[first + 1]]


class PieceUnits(UnitMemory):
    """Units of a SentencePiece model; texts are not cut where its settings leave no proof."""

    MARK = "▁"

    def __init__(self, path: str, **limits: int) -> None:
        self.model = PieceModel(path)
        spec = self.model.normalizer
        self.cuts = (
            self.model.is_bpe
            and not spec.precompiled_charsmap
            and spec.add_dummy_prefix
            and not spec.remove_extra_whitespaces
            and spec.escape_whitespaces
            and not self.model.user_defined
            and not any(self.MARK in p.lstrip(self.MARK) for p in self.model.pieces)
        )
        super().__init__(**limits)

    def forget(self) -> None:
        super().forget()
        self.starts, self.stops, self.unit_sizes = Growing(np.int32), Growing(np.int32), Growing(np.int32)

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.model.processor.encode(list(map(as_text, units)), num_threads=1))

    def remember(self, units: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        super().remember(units, ids, sizes)
        starts, stops = self.model.spans(units, ids, sizes)
        self.starts.add(starts)
        self.stops.add(stops)
        self.unit_sizes.add(np.fromiter(map(len, units), np.int32, len(units)))

    def unproven(self, units: pa.Array, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not self.cuts:
            return np.ones(len(units), bool)
        # a written space mark is a space to the model
        return (sizes == 0) | pc.match_substring(units, self.MARK).to_numpy(zero_copy_only=False)

    def encode(self, texts: FlatTexts) -> Encoded:
        column = pa.Array.from_buffers(
            pa.large_string(),
            len(texts),
            [None, pa.py_buffer(np.ascontiguousarray(texts.bounds)), pa.py_buffer(np.ascontiguousarray(texts.data))],
        )
        lists = pc.split_pattern(column, " ")
        units = lists.flatten()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        whole = self._whole(units, ends)

        # units behind the first ones, then the first ones; texts that are not cut count as a first unit
        counts = np.where(whole, 1, np.diff(ends))
        unit_bounds = np.concatenate([[0], np.cumsum(counts)])
        behind = np.ones(len(units), bool)
        behind[ends[:-1]] = False
        behind &= np.repeat(~whole, np.diff(ends))
        is_first = np.zeros(unit_bounds[-1], bool)
        is_first[unit_bounds[:-1]] = True
        lead = pa.array(ends[:-1])
        firsts = pc.if_else(pa.array(whole), column, units.take(lead))
        rest = units.filter(pa.array(behind)).cast(pa.large_binary()).dictionary_encode()
        firsts = firsts.cast(pa.large_binary()).dictionary_encode()
        known = rest.dictionary
        at = self._places(pa.concat_arrays([known, firsts.dictionary]))
        places = np.empty(unit_bounds[-1], np.int64)
        places[~is_first] = at[: len(known)][rest.indices.to_numpy(zero_copy_only=False)]
        places[is_first] = at[len(known) :][firsts.indices.to_numpy(zero_copy_only=False)]
        return Encoded(self, places, unit_bounds)

    def _whole(self, units: pa.Array, ends: np.ndarray) -> np.ndarray:
        flat = FlatTexts.of(units)
        first = np.zeros(len(units), np.uint8)
        filled = flat.sizes > 0
        first[filled] = flat.data[flat.bounds[:-1][filled]]
        total = np.concatenate([[0], np.cumsum(self.unproven(units, first, flat.sizes))])
        return np.diff(total[ends]) > 0

    def spans(self, found: Encoded) -> tuple[np.ndarray, np.ndarray]:
        """Start and stop of every token in its text's bytes."""
        sizes = self.unit_sizes.values[found.places].astype(np.int64) + 1  # with the space behind
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        shift = begin - np.repeat(begin[found.unit_bounds[:-1]], np.diff(found.unit_bounds))
        moved = np.repeat(shift, np.diff(found.unit_tokens))
        starts, stops = self.starts.values[found.positions] + moved, self.stops.values[found.positions] + moved
        # the space in front of a unit belongs to the unit's first token
        led = found.unit_tokens[:-1][(shift > 0) & (np.diff(found.unit_tokens) > 0)]
        starts[led] -= 1
        return starts, stops


@functools.lru_cache(maxsize=4)
def byte_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.lru_cache(maxsize=4)
def byte_units(path: str) -> ByteUnits:
    """One memory for each Python worker and file; an executor has as many workers as tasks, beside the buffers of what they write."""
    return ByteUnits(path, units=MEMORY_UNITS // 2)


@functools.lru_cache(maxsize=4)
def piece_units(path: str) -> PieceUnits:
    # these have spans as well
    return PieceUnits(path, units=MEMORY_UNITS // 2)
