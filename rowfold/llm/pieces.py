"""SentencePiece models: normalisation that remembers where every byte came from, and the spans of pieces.

The text is normalised by longest-prefix look-ups in the model's compiled character map, noting for every normalised
byte its place in the source. The pieces the library returns are laid over the normalised bytes and projected back.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

MARK = "▁".encode()
_REPLACEMENT = "�".encode()
# piece types of the model file (fixed values of the format)
_UNKNOWN, _USER_DEFINED, _BYTE = 2, 4, 6
_BPE = 2


class CharMap:
    """The compiled character map of a model: a double-array trie of prefixes, and what replaces them.

    Format: size of the trie in bytes (32 bits, little-endian), the trie in units of 32 bits, the replacements, each
    ended by a zero byte. Bits 0 to 7 of a unit are its label, bit 8 tells that a value hangs below it, bit 31 that it
    is a value itself; bits 10 up are the offset to its children, in units of 256 if bit 9 is set.
    """

    def __init__(self, blob: bytes) -> None:
        self.units, self.replacements = np.zeros(0, np.uint32), b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4)
            self.replacements = blob[4 + size :]

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << (8 if unit & 0x200 else 0)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Size of the longest mapped prefix of ``text[at:]`` and what replaces it."""
        if not len(self.units):
            return None
        found = None
        node = self._children(int(self.units[0]))
        for stop in range(at, len(text)):
            node ^= text[stop]
            if node >= len(self.units):
                break
            unit = int(self.units[node])
            if unit & 0x800000FF != text[stop]:
                break
            node ^= self._children(unit)
            if unit & 0x100:
                found = stop + 1 - at, int(self.units[node]) & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.replacements[start : self.replacements.index(b"\0", start)]


class PieceModel:
    """A model file: the library's processor, its pieces and its normaliser."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as file:
            self._read(file.read())

    def _read(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.normalizer = proto.normalizer_spec
        self.map = CharMap(self.normalizer.precompiled_charsmap)
        self.pieces = [p.piece for p in proto.pieces]
        self.is_bpe = proto.trainer_spec.model_type == _BPE
        self.user_defined = any(p.type == _USER_DEFINED for p in proto.pieces)
        self.is_byte = np.array([p.type == _BYTE for p in proto.pieces])
        self.is_unknown = np.array([p.type == _UNKNOWN for p in proto.pieces])
        # normalised bytes each piece covers; those of an unknown piece depend on the text
        self.sizes = np.array([1 if p.type == _BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)

    def normalize(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the place in ``text`` of each of them and of the end.

        ``text`` is valid UTF-8. Bytes of a replacement, and of an added space, have the place of what they stand for.
        """
        spec = self.normalizer
        space = MARK if spec.escape_whitespaces else b" "
        pieces: list[tuple[int, int, bytes, bool]] = []
        at = 0
        while at < len(text):
            mapped = self.map.longest(text, at)
            size = mapped[0] if mapped else 1 if text[at] < 0x80 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
            pieces.append((at, size, mapped[1] if mapped else text[at : at + size], mapped is None))
            at += size
        if spec.remove_extra_whitespaces:
            while pieces and pieces[0][2] == b" ":
                pieces.pop(0)
        if not pieces:
            return b"", np.array([len(text)], np.int64)
        out, places = bytearray(), []
        if spec.add_dummy_prefix:
            out += space
            places += [pieces[0][0]] * len(space)
        spaced, end = spec.remove_extra_whitespaces, 0
        for start, size, new, copied in pieces:
            if spaced:
                new = new.lstrip(b" ")
            for i, byte in enumerate(new):
                wide = space if byte == 32 else bytes([byte])
                out += wide
                places += [start + i if copied else start] * len(wide)
            if new and spec.remove_extra_whitespaces:
                spaced = new.endswith(b" ")
            end = start + size
        if spec.remove_extra_whitespaces:
            while out.endswith(space):
                end = places[-len(space)]
                del out[-len(space) :], places[-len(space) :]
        return bytes(out), np.array([*places, end], np.int64)

    def spans(self, texts: Sequence[bytes], ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and stop of every piece in the original bytes of its text, text after text.

        ``ids`` are those of all texts end to end, ``counts`` how many each has.
        """
        spec = self.normalizer
        copied = (
            not spec.precompiled_charsmap
            and spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
        )
        bounds = np.concatenate([[0], np.cumsum(counts)])
        sizes = self.sizes[ids]
        total = np.concatenate([[0], np.cumsum(sizes)])
        base = np.repeat(total[bounds[:-1]], counts)
        # without a map, and without a space inside, the normalised text is the mark and then the text as it is
        starts = np.maximum(total[:-1] - base - len(MARK), 0)
        stops = np.maximum(total[1:] - base - len(MARK), 0)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        plain = np.array([copied and len(t) > 0 and b" " not in t for t in texts], bool)
        plain &= np.diff(total[bounds]) == lengths + len(MARK)
        if self.is_unknown[ids].any():
            plain &= np.diff(np.concatenate([[0], np.cumsum(self.is_unknown[ids])])[bounds]) == 0
        for k in np.flatnonzero(~plain):
            own = slice(bounds[k], bounds[k + 1])
            starts[own], stops[own] = self._mapped(texts[k], ids[own])
        return starts, stops

    def _mapped(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = text.decode("utf-8", "replace").encode()
        sizes, unknown = self.sizes[ids], self.is_unknown[ids]
        if unknown.any():
            shown = self.processor.encode(text.decode(), out_type=str)
            sizes = np.where(unknown, [len(p.encode()) for p in shown], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        normal, places = self.normalize(text)
        if ends[-1] != len(normal):
            # a setting of the model that :meth:`normalize` does not know: every piece has the whole text's span
            return np.zeros(len(ids), np.int64), np.full(len(ids), len(text), np.int64)
        at = places[ends]
        return at[:-1], at[1:]
