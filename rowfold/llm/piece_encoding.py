"""SentencePiece encoding of whole documents with the original bytes of every piece, and decoding.

Ids are those of the sentencepiece library, without begin or end ids. Normalisation by the model's own compiled map
records where each normalised byte came from (:mod:`rowfold.llm.pieces`), so that every piece has a span of the original
UTF-8 bytes; the spans of a text follow each other from its first byte to its last.

A null text counts as an empty one: no ids, and an empty decoded text. Every row gives one row, repeated or null ids
included. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rowfold.llm.flat import FlatTexts, map_texts
from rowfold.llm.units import piece_units

_IDS = T.ArrayType(T.IntegerType(), False)
SPAN_SCHEMA = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", _IDS),
        T.StructField("starts", _IDS),
        T.StructField("stops", _IDS),
    ]
)
DIGEST_SCHEMA = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("spanned_bytes", T.LongType()),
    ]
)


class EncodedTexts:
    """Ids and spans of a slice of texts."""

    def __init__(self, path: str, batch: pa.RecordBatch) -> None:
        memory = piece_units(path)
        found = memory.encode(FlatTexts.of(batch.column("text")))
        self.processor = memory.model.processor
        self.ids, self.bounds, self.counts = found.ids, found.bounds, found.counts
        self.starts, self.stops = memory.spans(found)

    def __len__(self) -> int:
        return len(self.counts)

    def lists(self, flat: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(self.bounds, pa.int32()), pa.array(flat.astype(np.int32)))

    def decoded(self, row: int) -> str:
        return self.processor.decode(self.ids[self.bounds[row] : self.bounds[row + 1]].tolist())


def _with_spans(path: str, batch: pa.RecordBatch) -> dict[str, pa.Array | np.ndarray]:
    found = EncodedTexts(path, batch)
    lists = {"ids": found.lists(found.ids), "starts": found.lists(found.starts), "stops": found.lists(found.stops)}
    return {"n_tokens": found.counts, **lists}


def _sha256(text: str | None) -> str:
    return hashlib.sha256((text or "").encode()).hexdigest()


def _digests(path: str, batch: pa.RecordBatch) -> dict[str, pa.Array | np.ndarray]:
    found = EncodedTexts(path, batch)
    numbers = pa.ListArray.from_arrays(pa.array(found.bounds, pa.int32()), pa.array(found.ids).cast(pa.string()))
    joined = pc.binary_join(numbers, ",").to_pylist()
    total = np.concatenate([[0], np.cumsum(found.stops - found.starts)])
    return {
        "n_tokens": found.counts,
        "ids_sha256": pa.array([_sha256(x) for x in joined], pa.string()),
        "decoded_sha256": pa.array([_sha256(found.decoded(i)) for i in range(len(found))], pa.string()),
        "spanned_bytes": np.diff(total[found.bounds]),
    }


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids, starts, stops``: the ids of each text and the original bytes each one stands for."""
    return map_texts(docs, lambda b: _with_spans(path, b), SPAN_SCHEMA, text=text_col, keep=[id_col])


def piece_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256, spanned_bytes`` of the same encoding, and of its decoded text.

    ``spanned_bytes`` is the number of original bytes under the spans, which is the size of the text.
    """
    return map_texts(docs, lambda b: _digests(path, b), DIGEST_SCHEMA, text=text_col, keep=[id_col])


def decode_pieces(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` from lists of ids; a null list gives an empty text."""
    out = T.StructType([T.StructField("id", encoded.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def run(batches):
        processor = piece_units(path).model.processor
        for batch in batches:
            texts = [processor.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    picked = encoded.selectExpr(f"`{id_col}` AS id", f"`{ids_col}` AS ids")
    return picked.mapInArrow(run, out).withColumnRenamed("id", id_col)
