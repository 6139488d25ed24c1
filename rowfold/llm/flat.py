"""Arrow columns of text as flat numpy arrays: one pass over the bytes of a whole batch, no Python loop over words.

Words are runs of bytes other than space and ``\\t\\n\\v\\f\\r``; all of these are single bytes in UTF-8, so words can be
found without decoding. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE_BYTES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACE_BYTES)] = True
# Texts are handled in slices of about this many bytes, whatever the size of the batch: a slice takes some 30 times as
# much for its words, tokens and their places.
SLICE_BYTES = 4 << 20


class FlatTexts:
    """The bytes of a column of texts end to end: ``data``, and ``bounds`` with one more entry than texts."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @classmethod
    def of(cls, column: pa.Array) -> FlatTexts:
        """From a string or binary Arrow column."""
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = column.buffers()
        n = len(column)
        if not n:
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        bounds = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        return cls(whole[bounds[0] : bounds[-1]], bounds - bounds[0])

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def sums(self, marks: np.ndarray) -> np.ndarray:
        """How many marked bytes each text has."""
        total = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=total[1:])
        return np.diff(total[self.bounds])

    def count_in(self, members: np.ndarray) -> np.ndarray:
        """How many bytes of each text belong to a 256-entry table of booleans."""
        return self.sums(members[self.data])

    def word_starts(self) -> np.ndarray:
        """Marks the first byte of every word."""
        inside = ~IS_SPACE[self.data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        # a text that begins with a word does so whatever the text before it ends with
        first = self.bounds[:-1][self.sizes > 0]
        starts[first] = inside[first]
        return starts

    def word_counts(self) -> np.ndarray:
        return self.sums(self.word_starts())

    def words(self) -> tuple[pa.Array, np.ndarray]:
        """All words in order, and ``bounds`` of each text's words among them."""
        starts = self.word_starts()
        inside = ~IS_SPACE[self.data]
        packed = np.ascontiguousarray(self.data[inside])
        at = np.flatnonzero(starts[inside]).astype(np.int64)
        offsets = np.append(at, len(packed)).astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
        )
        bounds = np.concatenate([[0], np.cumsum(self.sums(starts))])
        return words, bounds


def gather(bounds: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the items of the picked lists, list after list, and the bounds of the result."""
    sizes = np.diff(bounds)[picks]
    out = np.concatenate([[0], np.cumsum(sizes)])
    positions = np.arange(out[-1], dtype=np.int64) + np.repeat(bounds[:-1][picks] - out[:-1], sizes)
    return positions, out


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``size`` bytes of text, or one row that is larger."""
    ends = np.cumsum(FlatTexts.of(batch.column(text)).sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], dict[str, pa.Array | np.ndarray]],
    schema: T.StructType,
    text: str = "text",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Add columns computed from a text column in Arrow batches; ``keep`` names the columns carried along.

    ``work`` gets slices with bounded bytes of text in a binary column named ``text``, and returns the new
    columns. One row comes out per row that goes in.
    """
    keep = list(keep)
    picked = df.select(F.col(f"`{text}`").cast("binary").alias("text"), *[F.col(f"`{c}`").alias(f"kept_{c}") for c in keep])
    out = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep] + list(schema.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                new = work(part)
                arrays = [part.column(f"kept_{c}") for c in keep]
                arrays += [new[f.name] if isinstance(new[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(new[f.name]) for f in schema.fields]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *schema.fieldNames()])

    return picked.mapInArrow(run, out)
