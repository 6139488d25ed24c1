"""Token counts of whole documents; huge ones are encoded in overlapping windows that are proven to fit together.

A document of up to ``window`` characters is encoded in one go. A longer one is cut into windows that overlap, which are
shuffled, so that its work is spread over tasks. Each window is encoded with offsets. Neighbours share an overlap, and
the first place in it that is a *stable boundary* is the seam: before a space or line break between two characters that are
not white space, or between a letter and punctuation, so that texts without spaces have seams too. No token of the
vocabulary's pre-tokeniser crosses these, whatever stands around. Both sides must have a token
boundary there; a window counts its tokens between its two seams. A window without such a seam fails, and its documents
are encoded again with overlaps four times as wide, up to the whole text.

Nulls and empty texts have 0 bytes and 0 tokens. Rows are counted one by one, whether or not ids repeat or are null.
Columns other than id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.llm.flat import FlatTexts, map_texts
from rowfold.llm.units import byte_tokenizer, byte_units
from rowfold.session import new_work_dir, stage

WINDOW = 65_536
OVERLAP = 512
# Letters and punctuation that are so in every version of the character tables: ASCII, kana, Han and Hangul, and CJK marks.
_SEAM = re.compile(
    r"(?<=\S)[ \n](?=\S)|(?<=[A-Za-z\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])(?=[!-/:-@\[-`{-~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])"
)
_SPECIAL_REACH = 64  # a special string is shorter; a seam keeps this far from the ends of the overlap

COUNT_SCHEMA = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


def windows(length: int, window: int, overlap: int) -> list[tuple[int, int]]:
    """Windows of about ``window`` characters; each begins ``overlap`` characters before the last one ends."""
    step = max(window, overlap) - overlap + 1 if overlap >= window else window - overlap
    if overlap >= window:
        return [(0, length)]
    found, start = [], 0
    while start + window < length:
        found.append((start, start + window))
        start += step
    return [*found, (start, length)]


def seam(text: str) -> int | None:
    """The first stable boundary in an overlap, away from its ends; both neighbours see the same one."""
    inside = text[_SPECIAL_REACH : len(text) - _SPECIAL_REACH]
    found = _SEAM.search(inside)
    return None if found is None else found.start() + _SPECIAL_REACH


def window_count(tokenizer, text: str, head: int, tail: int) -> int | None:
    """Tokens of a window between its seams; ``head`` and ``tail`` are its overlaps with its neighbours (or 0).

    None if a seam is missing or is not a boundary of this window's tokens.
    """
    first, last = 0, len(text)
    if head:
        at = seam(text[:head])
        if at is None:
            return None
        first = at
    if tail:
        at = seam(text[len(text) - tail :])
        if at is None:
            return None
        last = len(text) - tail + at
    coded = tokenizer.encode(text, add_special_tokens=False)
    if not head and not tail:
        return len(coded.ids)
    if not coded.offsets:
        return None
    # offsets leave a leading space out of a token, so a token's cut lies where the text before it ends
    spans = np.asarray(coded.offsets, np.int64)
    starts = spans[:, 0].copy()
    spaced = np.array([text[s - 1] == " " if s else False for s in starts]) & (np.concatenate([[0], spans[:-1, 1]]) < starts)
    starts[spaced] -= 1
    for cut in (first, last):
        if 0 < cut < len(text) and cut not in starts:
            return None
    return int(((starts >= first) & (starts < last)).sum())


def _count_whole(path: str, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    texts = FlatTexts.of(batch.column("text"))
    return {"n_bytes": texts.sizes, "n_tokens": byte_units(path).encode(texts).counts.astype(np.int64)}


def _cut(batches: Iterator[pa.RecordBatch], window: int, overlap: int) -> Iterator[pa.RecordBatch]:
    """One row per window of each document."""
    for batch in batches:
        for row in range(batch.num_rows):
            text = batch.column("text")[row].as_py()
            for k, (start, stop) in enumerate(found := windows(len(text), window, overlap)):
                part = text[start:stop]
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array([batch.column("row")[row].as_py()], pa.int64()),
                        "n_bytes": pa.array([len(text.encode()) if k == 0 else 0], pa.int64()),
                        "part": pa.array([part]),
                        "head": pa.array([overlap if k else 0], pa.int32()),
                        "tail": pa.array([overlap if k + 1 < len(found) else 0], pa.int32()),
                    }
                )


_CUT_SCHEMA = "row long, n_bytes long, part string, head int, tail int"


def _count_windows(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokenizer = byte_tokenizer(path)
    for batch in batches:
        counts = [
            window_count(tokenizer, part, head, tail)
            for part, head, tail in zip(*(batch.column(c).to_pylist() for c in ("part", "head", "tail")), strict=True)
        ]
        yield pa.RecordBatch.from_pydict(
            {
                "row": batch.column("row"),
                "n_bytes": batch.column("n_bytes"),
                "n_tokens": pa.array([c or 0 for c in counts], pa.int64()),
                "failed": pa.array([c is None for c in counts]),
            }
        )


def _huge_counts(huge: DataFrame, path: str, window: int, overlap: int) -> DataFrame:
    """``row, n_bytes, n_tokens, failed`` of documents cut into windows."""
    parts = huge.select("row", "text").mapInArrow(lambda b: _cut(b, window, overlap), _CUT_SCHEMA)
    # a document's windows go to different tasks
    spread = parts.repartition("row", "n_bytes", F.xxhash64("part"))
    counted = spread.mapInArrow(lambda b: _count_windows(b, path), "row long, n_bytes long, n_tokens long, failed boolean")
    return counted.groupBy("row").agg(
        F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"), F.max("failed").alias("failed")
    )


def token_counts(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``id, n_bytes, n_tokens`` of every row, by the byte-level BPE file at ``path``."""
    if not 4 * _SPECIAL_REACH <= overlap < window:
        raise ValueError(f"the overlap must be at least {4 * _SPECIAL_REACH} and less than the window")
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    is_huge = F.coalesce(F.length("text") > window, F.lit(False))
    small = map_texts(rows.filter(~is_huge), lambda b: _count_whole(path, b), COUNT_SCHEMA, keep=["id"])

    # huge documents get a number that is written down, so that it stays the same in every round
    work_dir = new_work_dir(spark, "token-counts")
    huge = stage(rows.filter(is_huge).withColumn("row", F.monotonically_increasing_id()), work_dir, "huge")
    left, done, size, lap = huge, [], window, overlap
    while True:
        counted = stage(_huge_counts(left, path, size, lap), work_dir, f"overlap-{lap}")
        done.append(counted.filter(~F.col("failed")))
        if counted.filter("failed").isEmpty():
            break
        left = huge.join(counted.filter("failed").select("row"), "row", "left_semi")
        # a window holds at least half of new text until one window is the whole text
        lap, size = 4 * lap, max(size, 8 * lap)
    counts = done[0]
    for more in done[1:]:
        counts = counts.unionByName(more)
    large = huge.select("id", "row").join(counts, "row").select("id", *COUNT_SCHEMA.fieldNames())
    return small.unionByName(large).withColumnRenamed("id", id_col)
