"""Toxicity by compression distance: what two zstandard dictionaries save on windows of the text.

*Dictionaries.* One dictionary is trained on ordinary text. The other one is trained on toxic text, on the segments that set it
apart (words, or beginnings of words, that far more toxic documents have than ordinary ones), and holds the ordinary one's
content behind its own. Both therefore do equally well on ordinary windows, and a window that takes fewer bytes with the toxic
one holds toxic segments.

*Windows.* Every text, lower-cased in A-Z, is cut into overlapping windows of ``WINDOW`` bytes, which are compressed with both
dictionaries. The differences of a text's windows (the greatest, the three greatest, their mean, the shares and the number of
windows above thresholds) are weighed by a logistic regression on the labelled documents, and its threshold is moved to where
it tells them apart best (F1), so that a score of 0.5 or more means toxic.

Labels are used for fitting only. Fitting takes ``FIT_ROWS`` labelled ids at most (those with the smallest hash, one row of
each), ``SEGMENTS`` segments and about ``ORDINARY_SAMPLES`` windows of ordinary text, so it does not grow with the corpus.

A null or empty text has no windows and gets a score like any other. Rows are scored one by one, repeated or null ids
included. Labels that are null or of unknown documents are not used; several labels of a document count as their mean,
rounded. Without labels of both classes every score is the mean label, or 0 without any. Columns other than id, text and
label are not read; output columns are ``id, held_out, score, predicted``.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.llm.flat import FlatTexts, map_texts, slices
from rowfold.llm.rule_ensemble import held_out, labelled_sample
from rowfold.session import new_work_dir, stage

FIT_ROWS = 20_000
THRESHOLD = 0.5
#: Bytes of a window, and from one window's start to the next one's.
WINDOW, STEP = 64, 48
#: Sizes of the dictionaries, and the level of compression.
ORDINARY_BYTES, TOXIC_BYTES, LEVEL = 128 << 10, 6 << 10, 9
ORDINARY_SAMPLES, SAMPLE_BYTES = 20_000, 512
#: A segment is taken from this many toxic documents on, if its share of them is ``LEAST_RATIO`` times its share of ordinary
#: ones and the logarithm of the ratio is ``LEAST_Z`` standard errors above 0.
LEAST_DOCUMENTS, LEAST_RATIO, LEAST_Z = 3, 3.0, 3.0
SEGMENTS, SEGMENT_USES = 4_096, 20_000
SHORTEST, LONGEST = 4, 11
FEATURES = ("greatest", "three_greatest", "mean_saved", "share_3", "share_5", "windows_4", "windows")
_SMOOTH = 4  # windows added to each text's number, so that one window of a short text does not decide

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def segments(text: bytes) -> set[bytes]:
    """The words of a text, and their beginnings."""
    words = set(_WORD.findall(text.lower()))
    return words.union(*({w[:n] for n in range(SHORTEST, min(len(w), LONGEST + 1))} for w in words))


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                found = list(segments(text or b""))
                columns = [pa.array(found, pa.binary()), pa.array(np.full(len(found), label))]
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "label"])


def telling_segments(labelled: DataFrame, toxic: int, ordinary: int) -> list[bytes]:
    """The segments that toxic documents have far more often, ``SEGMENTS`` at most; ``labelled`` has a binary ``text``."""
    rows = labelled.mapInArrow(_segment_rows, "segment binary, label double")
    counted = rows.groupBy("segment").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o"))
    ratio = ((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("o") + 0.5) / (ordinary + 1))
    z = F.log(ratio) / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("o") + 0.5))
    clear = (F.col("t") >= LEAST_DOCUMENTS) & (z > LEAST_Z) & (F.col("t") * ordinary > LEAST_RATIO * F.col("o") * toxic)
    best = counted.filter(clear).orderBy(z.desc(), "segment").limit(SEGMENTS)
    return [bytes(r["segment"]) for r in best.select("segment").collect()]


def segment_uses(text: bytes, chosen: frozenset[bytes]) -> list[bytes]:
    """The longest chosen beginning of each word of the text that has one, with the spaces around it."""
    uses = []
    for word in _WORD.findall(text.lower()):
        hit = next((word[:n] for n in range(len(word), 0, -1) if word[:n] in chosen), None)
        if hit is not None:
            uses.append(b" " + hit + (b" " if hit == word else b""))
    return uses


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on the samples; samples too few to train on are the content themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def toxic_content(uses: dict[bytes, int]) -> bytes:
    """Trained on segments as often as they are used, in an order without meaning."""
    total = sum(uses.values())
    share = min(1.0, SEGMENT_USES / max(1, total))
    drawn = [s for s in sorted(uses) for _ in range(max(1, round(uses[s] * share)))]
    drawn = [drawn[k] for k in np.random.default_rng(1).permutation(len(drawn))]
    return train_dictionary([b"".join(drawn[k : k + 8]) for k in range(0, len(drawn), 8)] * 3, TOXIC_BYTES)


@dataclass(frozen=True)
class Dictionaries:
    """Contents of the two dictionaries; the toxic one ends in the ordinary one."""

    ordinary: bytes
    toxic: bytes

    def saved(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many bytes fewer each window takes with the toxic dictionary."""
        if not len(starts):
            return np.zeros(0, np.int64)
        held = zstandard.BufferWithSegments(data.tobytes(), np.stack([starts, sizes], axis=1).astype(np.uint64).tobytes())
        with_each = [compressor(c).multi_compress_to_buffer(held, threads=1) for c in (self.ordinary, self.toxic)]
        plain, toxic = (np.fromiter(map(len, frames), np.int64, len(starts)) for frames in with_each)
        return plain - toxic


@functools.lru_cache(maxsize=4)
def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """For frames without headers; the dictionary is digested once for each Python worker."""
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(content), source_size=2 * WINDOW, write_content_size=False, write_dict_id=False,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


def windows(texts: FlatTexts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and sizes of the windows of all texts, and how many each text has; the last ones may be shorter."""
    counts = np.where(texts.sizes > 0, 1 + np.maximum(0, -(-(texts.sizes - WINDOW) // STEP)), 0)
    ends = np.cumsum(counts)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    starts = np.repeat(texts.bounds[:-1], counts) + place * STEP
    return starts, np.minimum(WINDOW, np.repeat(texts.bounds[1:], counts) - starts), counts


def features(dictionaries: Dictionaries, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    texts = FlatTexts.of(batch.column("text"))
    starts, sizes, counts = windows(texts)
    saved = dictionaries.saved(_LOWER[texts.data], starts, sizes)
    owner = np.repeat(np.arange(len(texts)), counts)
    order = np.lexsort((-saved, owner))
    rank = np.arange(len(saved)) - np.repeat(np.cumsum(counts) - counts, counts)
    ranked = saved[order]
    total = lambda values: np.bincount(owner, values, len(texts))
    smooth = counts + _SMOOTH
    return {
        "greatest": total(np.where(rank == 0, ranked, 0)),
        "three_greatest": total(np.where(rank < 3, ranked, 0)),
        "mean_saved": total(np.maximum(saved - 1, 0)) / smooth,
        "share_3": total(saved >= 3) / smooth,
        "share_5": total(saved >= 5) / smooth,
        "windows_4": np.log1p(total(saved >= 4)),
        "windows": np.log1p(counts),
    }


def text_features(docs: DataFrame, dictionaries: Dictionaries, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    schema = T.StructType([T.StructField(f, T.DoubleType()) for f in FEATURES])

    def work(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        return {k: v.astype(np.float64) for k, v in features(dictionaries, batch).items()}

    return map_texts(docs, work, schema, text=text_col, keep=keep)


@dataclass(frozen=True)
class ToxicityModel:
    """``score`` is the logistic function of the weighted features; ``intercept`` holds the calibrated threshold."""

    dictionaries: Dictionaries
    weights: tuple[float, ...]
    intercept: float

    def score(self):
        total = F.lit(self.intercept)
        for name, weight in zip(FEATURES, self.weights, strict=True):
            total = total + F.lit(weight) * F.col(name)
        return 1.0 / (1.0 + F.exp(-total))


def best_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The value at or above which "toxic" has the greatest F1 on the rows, half-way to the next lower one."""
    order = np.argsort(-logits, kind="stable")
    values, hits = logits[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(values) + 1) + labels.sum())
    # a cut lies between different values only
    f1[:-1][values[:-1] == values[1:]] = -1
    at = int(np.argmax(f1))
    return float((values[at] + values[min(at + 1, len(values) - 1)]) / 2)


def fit(labelled: DataFrame, work_dir: str) -> ToxicityModel:
    """From documents with ``text`` (binary), ``label`` (0 or 1) and ``rank`` (an order without meaning)."""
    sample = stage(labelled, work_dir, "sample")
    seen = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("toxic")).first()
    n, toxic = seen["n"], int(seen["toxic"])
    if not 0 < toxic < n:
        share = min(max(toxic / n if n else 0.0, 1e-9), 1 - 1e-9)
        return ToxicityModel(Dictionaries(b"", b""), (0.0,) * len(FEATURES), math.log(share / (1 - share)))
    chosen = frozenset(telling_segments(sample.select("text", "label"), toxic, n - toxic))
    starts = F.expr(f"explode(sequence(0, greatest(0, octet_length(text) - 1), {SAMPLE_BYTES}))")
    pieces = sample.filter("label = 0").select("rank", "text", starts.alias("at"))
    pieces = pieces.select("rank", "at", F.expr(f"substring(text, at + 1, {SAMPLE_BYTES})").alias("piece"))
    # short pieces only, about ``ORDINARY_SAMPLES`` of them: told by their hash in the tasks, so that no others leave these
    known = max(1, pieces.count())
    pieces = pieces.withColumn("hash", F.xxhash64("rank", "at"))
    drawn = pieces.filter(F.pmod("hash", F.lit(known)) < ORDINARY_SAMPLES).select("hash", "rank", "at", "piece").collect()
    # mixed, so that neighbours are of different texts: training takes them part by part
    drawn.sort(key=lambda r: (r["hash"], r["rank"], r["at"]))
    ordinary = train_dictionary([bytes(r["piece"]).lower() for r in drawn], ORDINARY_BYTES)

    def uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                yield pa.RecordBatch.from_pydict({"segment": pa.array(segment_uses(text or b"", chosen), pa.binary())})

    used = sample.filter("label = 1").select("text").mapInArrow(uses, "segment binary").groupBy("segment").count()
    dictionaries = Dictionaries(ordinary, toxic_content({bytes(r["segment"]): r["count"] for r in used.collect()}) + ordinary)

    figures = stage(text_features(sample, dictionaries, "text", ("label", "rank")), work_dir, "figures")
    figures = figures.coalesce(1).orderBy("rank").select("label", *FEATURES)
    inputs = stage(figures, work_dir, "inputs").select("label", array_to_vector(F.array(*FEATURES)).alias("features"))
    model = LogisticRegression(regParam=1e-3, maxIter=100, tol=1e-7).fit(inputs)
    weights = model.coefficients.toArray()
    # ``FIT_ROWS`` rows of figures at most
    held = figures.toPandas()
    logits = held[list(FEATURES)].to_numpy() @ weights + model.intercept
    cut = best_cut(logits, held["label"].to_numpy())
    return ToxicityModel(dictionaries, tuple(float(w) for w in weights), float(model.intercept) - cut)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
    fit_rows: int = FIT_ROWS,
    work_dir: str | None = None,
) -> DataFrame:
    """``id, held_out, score, predicted`` of every row."""
    work_dir = work_dir or new_work_dir(docs.sparkSession, "toxicity")
    key = F.col(f"`{id_col}`")
    chosen = labelled_sample(docs, labels, id_col, label_col, fit_rows, work_dir)
    # at most ``fit_rows`` short rows; of several documents with one id the one with the smallest hash is read
    met = docs.select(key.alias("chosen_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    met = met.join(F.broadcast(chosen), "chosen_id")
    single = met.groupBy("chosen_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    score_of = fit(single.select("first.text", F.col("label").cast("double").alias("label"), F.xxhash64("chosen_id").alias("rank")), work_dir)
    score = score_of.score()
    return text_features(docs, score_of.dictionaries, text_col, (id_col,)).select(
        F.col(f"`{id_col}`"),
        held_out(id_col).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
    )
