"""Quality rules: how well a public vocabulary fits a text, with rejection bands for each script or language.

Three figures of the text's tokens: characters of words per token, share of byte-fallback tokens, and entropy of the
token distribution in bits. A text outside the bands of its script is rejected: too few characters per token or many
byte tokens mean symbols, encoded data or broken text; a low entropy means a few tokens said over and over. The fixed
bands are wide; a second entropy band is drawn from all texts of the same language (script if null) and about the same
length, because entropy grows with length. Where these are few, it is drawn from the lengths beside it, then from the script's
texts of that length, then from all of the script, so that every text meets one, whatever the number of rows.

Base figures come from one pass over the bytes: words are runs of other characters than space and ``\\t\\n\\v\\f\\r``.

A null text counts as an empty one: all counts 0, rejected by the base rules. Every row gives one row, repeated or null
ids included. A null or unknown language is judged by script. Columns other than id, text and language are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.llm.flat import IS_SPACE, FlatTexts, map_texts
from rowfold.llm.units import piece_units
from rowfold.session import new_work_dir, stage

SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.zeros(256, dtype=bool)
IS_SYMBOL[list(SYMBOLS)] = True
MIN_WORDS = 50
MAX_REPEATED = 50
# A text's entropy may be so much of the median of its language and length, and its share of what its length allows so much of its
# script's median.
ENTROPY_DROP, SCRIPT_DROP = 0.93, 0.8
# Entropies are counted in steps of a bit, so that quantiles are exact, and add up over any partitioning.
STEPS = 1_024
MOST_BANDS = 10_000


@dataclass(frozen=True)
class Band:
    """Limits of a script or language; texts outside are rejected."""

    min_chars_per_token: float = 1.3
    max_chars_per_token: float = 12.0
    max_byte_share: float = 0.30
    min_entropy_share: float = 0.45


# By the script of most letters. A vocabulary made mostly for Latin text cuts the others finer.
SCRIPT_BANDS = {
    "latin": Band(),
    "cyrillic": Band(min_chars_per_token=1.0, max_byte_share=0.35),
    "greek": Band(min_chars_per_token=0.7, max_byte_share=0.6),
    "cjk": Band(min_chars_per_token=0.3, max_byte_share=0.9, min_entropy_share=0.4),
    "other": Band(min_chars_per_token=0.25, max_byte_share=1.0, min_entropy_share=0.4),
}
# Languages with a band of their own; it takes the place of their script's. Languages written without spaces, or in scripts whose
# lead bytes :func:`main_script` does not tell apart.
LANGUAGE_BANDS: dict[str, Band] = {
    **dict.fromkeys(("zh", "ja", "ko"), Band(min_chars_per_token=0.3, max_byte_share=0.9, min_entropy_share=0.4)),
    **dict.fromkeys(("th", "lo", "km", "my"), Band(min_chars_per_token=0.25, max_byte_share=1.0, min_entropy_share=0.4)),
    **dict.fromkeys(("ar", "fa", "he", "hi", "bn"), Band(min_chars_per_token=0.4, max_byte_share=0.8, min_entropy_share=0.4)),
    **dict.fromkeys(("vi", "cs", "pl", "tr", "hu"), Band(min_chars_per_token=0.9, max_byte_share=0.35)),
}

FIGURES_SCHEMA = T.StructType(
    [
        *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_byte_tokens")),
        T.StructField("entropy", T.DoubleType()),
        T.StructField("script", T.StringType()),
    ]
)


def repeated_words(words: np.ndarray, bounds: np.ndarray, width: int = 3) -> np.ndarray:
    """Words of each text that lie in a window of ``width`` words that the text has twice or more.

    ``words`` are numbers, equal for equal words; ``bounds`` separates the texts.
    """
    n = len(words)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    windows = max(n - width + 1, 0)
    if not windows:
        return np.zeros(len(bounds) - 1, np.int64)
    key = words[:windows].astype(np.int64)
    for k in range(1, width):
        # exact: pairs of (window so far, next word) are numbered anew
        key = np.unique(key * (words.max() + 1) + words[k : k + windows], return_inverse=True)[1].astype(np.int64)
    whole = text[:windows] == text[width - 1 :]
    key, at = key[whole], np.flatnonzero(whole)
    _, number, count = np.unique(text[at] * (key.max(initial=0) + 1) + key, return_inverse=True, return_counts=True)
    again = at[count[number] > 1]
    marked = np.zeros(n, bool)
    for k in range(width):
        marked[again + k] = True
    total = np.concatenate([[0], np.cumsum(marked)])
    return np.diff(total[bounds])


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def token_entropy(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Entropy in bits of the token distribution of each text."""
    counts = np.diff(bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    width = int(ids.max(initial=0)) + 1
    pairs, times = np.unique(text * width + ids, return_counts=True)
    owner = pairs // width
    n = counts[owner]
    return np.bincount(owner, times / n * np.log2(n / times), len(counts)) if len(pairs) else np.zeros(len(counts))


def main_script(texts: FlatTexts) -> np.ndarray:
    """Script of most letters, told by the lead bytes of their UTF-8 form."""
    lead = texts.data
    letters = np.zeros(256, bool)
    letters[[*range(65, 91), *range(97, 123)]] = True
    ranges = {"latin": (0xC3, 0xCA), "greek": (0xCD, 0xD0), "cyrillic": (0xD0, 0xD5), "cjk": (0xE3, 0xEE)}
    votes = []
    for name, (low, high) in ranges.items():
        members = letters.copy() if name == "latin" else np.zeros(256, bool)
        members[low:high] = True
        votes.append(texts.count_in(members))
    members = np.zeros(256, bool)
    members[0xD5:0xE3] = True
    members[0xEE:] = True
    votes.append(texts.count_in(members))
    return np.array([*ranges, "other"])[np.argmax(np.stack(votes), axis=0)] if len(lead) else np.full(len(texts), "latin")


def text_figures(path: str, batch: pa.RecordBatch) -> dict[str, pa.Array | np.ndarray]:
    texts = FlatTexts.of(batch.column("text"))
    words, word_bounds = texts.words()
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    memory = piece_units(path)
    tokens = memory.encode(texts)
    is_byte = memory.model.is_byte[tokens.ids]
    total = np.concatenate([[0], np.cumsum(is_byte)])
    raw = texts.data.tobytes()
    begins_char = (texts.data & 0xC0) != 0x80
    return {
        "n_words": np.diff(word_bounds),
        "word_chars": texts.sums(begins_char & ~IS_SPACE[texts.data]),
        "n_symbols": texts.count_in(IS_SYMBOL),
        "n_dup_lines": np.array(
            [duplicate_lines(raw[a:b]) for a, b in zip(texts.bounds[:-1], texts.bounds[1:], strict=True)], np.int64
        ),
        "n_repeat_words": repeated_words(numbers, word_bounds),
        "n_tokens": tokens.counts,
        "n_byte_tokens": np.diff(total[tokens.bounds]),
        "entropy": token_entropy(tokens.ids, tokens.bounds),
        "script": pa.array(main_script(texts), pa.string()),
    }


def quality_figures(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base figures and token figures of every text, with the columns ``keep``."""
    return map_texts(docs, lambda b: text_figures(path, b), FIGURES_SCHEMA, text=text_col, keep=keep)


def base_failed() -> Column:
    """Too short, or most words repeated."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def in_bands(
    language: str | None = None, scripts: dict[str, Band] = SCRIPT_BANDS, languages: dict[str, Band] = LANGUAGE_BANDS
) -> Column:
    """Whether the token figures lie inside the bands of the text's language, if it has some, or else script."""
    limit = {}
    for name in (f.name for f in fields(Band)):
        value = F.lit(getattr(scripts["other"], name))
        for script, band in scripts.items():
            value = F.when(F.col("script") == script, F.lit(getattr(band, name))).otherwise(value)
        for lang, band in languages.items() if language else ():
            value = F.when(F.col(f"`{language}`") == lang, F.lit(getattr(band, name))).otherwise(value)
        limit[name] = value
    chars = F.col("word_chars") / F.col("n_tokens")
    # the most that so many tokens can have, capped where the vocabulary in use sets it rather than the length
    reach = F.least(F.log2(F.col("n_tokens").cast("double")), F.lit(10.0))
    inside = (
        (chars >= limit["min_chars_per_token"])
        & (chars <= limit["max_chars_per_token"])
        & (F.col("n_byte_tokens") / F.col("n_tokens") <= limit["max_byte_share"])
        & (F.col("entropy") >= limit["min_entropy_share"] * reach)
    )
    return F.when(F.col("n_tokens") > 1, inside).otherwise(F.lit(True))


def entropy_bands(figures: DataFrame, group: Column) -> DataFrame:
    """``band_group, octave, entropy_limit``: what is too low among texts of one language and about one length.

    Entropy grows with length, so texts are compared within a doubling of their number of tokens. The limit lies under
    the median by ``ENTROPY_DROP``, and below the lower quartile by twice the middle half, whichever is lower: the first
    keeps the band open where many copies of one text narrow the quartiles, the second where texts really vary. All
    texts that pass the base rules count. Every group has its own limit, however few its texts are, so a verdict depends on
    a text and the proportions of its group and not on the size of the input. What a group of few texts cannot tell, the
    script's limit does (:func:`script_bands`), which every text meets as well.
    """
    passed = figures.filter(~F.col("base_failed")).select(group.alias("band_group"), _octave().alias("octave"), _steps().alias("step"))
    q1, q2, q3 = (F.col(f"q{k}") for k in (1, 2, 3))
    limit = F.least(F.lit(ENTROPY_DROP) * q2, q1 - 2 * (q3 - q1))
    return _quartiles(passed, ["band_group", "octave"]).select("band_group", "octave", (limit / STEPS).alias("entropy_limit"))


def script_bands(figures: DataFrame) -> DataFrame:
    """``script, share_limit``: entropy as a share of what the number of tokens allows, for texts whose language or length is rare."""
    passed = figures.filter(~F.col("base_failed")).select("script", F.floor(_share() * STEPS).cast("long").alias("step"))
    return _quartiles(passed, ["script"]).select("script", (SCRIPT_DROP * F.col("q2") / STEPS).alias("share_limit"))


def _quartiles(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Exact quartiles of ``step``; a row for each step that occurs, some ten thousand of a group at most."""
    counted = texts.groupBy(*keys, "step").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("step"))
    of = F.sum("n").over(Window.partitionBy(*keys))
    placed = counted.withColumn("upto", upto).withColumn("of", of)
    quartiles = [F.min(F.when(4 * F.col("upto") >= k * F.col("of"), F.col("step"))).alias(f"q{k}") for k in (1, 2, 3)]
    return placed.groupBy(*keys).agg(*quartiles)


def _steps() -> Column:
    return F.floor(F.col("entropy") * STEPS).cast("long")


def _share() -> Column:
    """Entropy as a share of the most that so many tokens can have, capped where the vocabulary in use sets it rather than the length."""
    return F.col("entropy") / F.least(F.log2(F.greatest(F.col("n_tokens"), F.lit(2)).cast("double")), F.lit(10.0))


def _octave() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double"))).cast("int")


def judged(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    language: str | None = "lang",
    work_dir: str | None = None,
) -> DataFrame:
    """Figures of every text with ``base_failed`` and ``kept``, and the columns ``keep``.

    Figures are written down once; the bands come from all of them and are applied to all of them.
    """
    columns = tuple(dict.fromkeys([*keep, *([language] if language else [])]))
    figures = quality_figures(docs, path, text_col, columns).withColumn("base_failed", base_failed())
    work_dir = work_dir or new_work_dir(docs.sparkSession, "fertility")
    figures = stage(figures, work_dir, "figures")
    group = F.coalesce(F.col(f"`{language}`"), F.col("script")) if language else F.col("script")
    bands = stage(entropy_bands(figures, group), work_dir, "bands")
    # one short row per language and octave: every task gets them, unless the languages are out of all proportion
    if bands.count() <= MOST_BANDS:
        bands = F.broadcast(bands)
    met = figures.withColumn("band_group", group).withColumn("octave", _octave()).join(bands, ["band_group", "octave"], "left")
    # one row for each script
    scripts = stage(script_bands(figures), work_dir, "scripts")
    met = met.join(F.broadcast(scripts), "script", "left")
    # only texts that fail the base rules can be without a limit
    high_enough = (_steps() / STEPS >= F.col("entropy_limit")) & (F.floor(_share() * STEPS) / STEPS >= F.col("share_limit"))
    high_enough = F.coalesce(high_enough, F.lit(True))
    kept = met.withColumn("kept", ~F.col("base_failed") & in_bands(language) & high_enough)
    return kept.select(*[F.col(f"`{c}`") for c in keep], *FIGURES_SCHEMA.fieldNames(), "base_failed", "kept")
