"""Quality classifier: a sparse ensemble of rules over statistics of the text.

Trees are grown on the labelled documents' statistics (Spark ML's random forest), every path from a root to a node is a
rule, a conjunction of comparisons, and a logistic regression with an L1 penalty gives most rules the weight 0. The rules
left are compiled into one Spark column expression over the statistics. Scores are probabilities of label 1.

Statistics come from one pass over the bytes of the whole text. Labels are used for fitting only. Fitting takes
``FIT_ROWS`` labelled ids at most, those with the smallest hash, so it does not grow with the corpus.

A null or empty text has the statistics of an empty one and gets a score like any other. Rows are scored one by one, repeated
or null ids included. Labels that are null or of unknown documents are not used; several labels of a document count as
their mean, rounded; of several documents with one id the one with the least statistics is fitted on. Without labels of both classes every score is the mean label, or 0.5 without any.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.llm.fertility import IS_SYMBOL, duplicate_lines, repeated_words
from rowfold.llm.flat import IS_SPACE, FlatTexts, map_texts
from rowfold.session import new_work_dir, stage

FIT_ROWS = 20_000
TREES, DEPTH, PENALTY = 20, 3, 0.002
THRESHOLD = 0.3
STATISTICS = (
    "log_words", "word_bytes", "line_words", "symbol_share", "upper_share", "digit_share", "stop_share", "mark_share",
    "wide_share", "dup_line_share", "repeat_share", "distinct_share", "top_word_share", "bare_word_share",
)


def _members(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_UPPER = _members(bytes(range(65, 91)))
_LOWER = _members(bytes(range(97, 123)))
_DIGIT = _members(b"0123456789")
_STOP = _members(b".,;:")
_MARK = _members(b"!?")
_LETTERISH = _UPPER | _LOWER | _members(bytes(range(128, 256)))


def statistics(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    texts = FlatTexts.of(batch.column("text"))
    words, bounds = texts.words()
    n = np.diff(bounds)
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), n)
    width = int(numbers.max(initial=0)) + 1
    pairs, times = np.unique(owner * width + numbers, return_counts=True)
    distinct = np.bincount(pairs // width, minlength=len(texts)) if len(pairs) else np.zeros(len(texts))
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, pairs // width, times)
    flat = FlatTexts.of(words)
    bare = flat.count_in(_LETTERISH) == 0
    total = np.concatenate([[0], np.cumsum(bare)])
    raw = texts.data.tobytes()
    lines = texts.sums(texts.data == 10) + 1
    dup = np.array([duplicate_lines(raw[a:b]) for a, b in zip(texts.bounds[:-1], texts.bounds[1:], strict=True)])
    ink = np.maximum(texts.sums(~IS_SPACE[texts.data]), 1)
    upper = texts.count_in(_UPPER)
    per_word = np.maximum(n, 1)
    return {
        "log_words": np.log1p(n),
        "word_bytes": texts.sums(~IS_SPACE[texts.data]) / per_word,
        "line_words": n / lines,
        "symbol_share": texts.count_in(IS_SYMBOL) / ink,
        "upper_share": upper / np.maximum(upper + texts.count_in(_LOWER), 1),
        "digit_share": texts.count_in(_DIGIT) / ink,
        "stop_share": texts.count_in(_STOP) / per_word,
        "mark_share": texts.count_in(_MARK) / per_word,
        "wide_share": texts.sums(texts.data >= 128) / ink,
        "dup_line_share": dup / lines,
        "repeat_share": repeated_words(numbers, bounds) / per_word,
        "distinct_share": distinct / per_word,
        "top_word_share": top / per_word,
        "bare_word_share": np.diff(total[bounds]) / per_word,
    }


def text_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The statistics of every text as doubles, with the columns ``keep``."""
    schema = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS])
    return map_texts(docs, lambda b: {k: np.asarray(v, np.float64) for k, v in statistics(b).items()}, schema, text=text_col, keep=keep)


@dataclass(frozen=True)
class Rule:
    """A conjunction: each condition is (statistic, at most, at least or None), true if ``least < x <= most``."""

    conditions: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, least, most in self.conditions:
            if not math.isinf(least):
                out = out & (F.col(name) > F.lit(least))
            if not math.isinf(most):
                out = out & (F.col(name) <= F.lit(most))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{lo:.4g} < {n} <= {hi:.4g}" for n, lo, hi in self.conditions)


_NODE = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)$")


def forest_rules(described: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """Paths from the roots to all nodes, from Spark's description of the trees; equal ones once."""
    path: list[tuple[int, str, float, float]] = []
    found: dict[Rule, None] = {}
    for line in described.splitlines():
        if line.lstrip().startswith("Tree"):
            path = []
        node = _NODE.match(line)
        if node is None:
            continue
        depth, name, at = len(node[1]), names[int(node[3])], float(node[5])
        path = [p for p in path if p[0] < depth]
        path.append((depth, name, -math.inf, at) if node[4] == "<=" else (depth, name, at, math.inf))
        merged: dict[str, tuple[float, float]] = {}
        for _, key, least, most in path:
            low, high = merged.get(key, (-math.inf, math.inf))
            merged[key] = max(low, least), min(high, most)
        found.setdefault(Rule(tuple((k, *v) for k, v in sorted(merged.items()))))
    return list(found)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules; ``intercept`` alone where there was nothing to learn from."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1, as a column over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def fit(labelled: DataFrame, work_dir: str) -> RuleEnsemble:
    """From statistics with a column ``label`` (0 or 1), which are few enough for one task to hold."""
    # computed where the documents are, then brought together in one file and one order: the same trees in every run
    sample = labelled.select("label", *STATISTICS).repartition(1).sortWithinPartitions("label", *STATISTICS)
    sample = stage(sample, work_dir, "sample")
    seen = sample.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    n, ones = seen["n"], seen["ones"] or 0
    if not 0 < ones < n:
        share = min(max(ones / n if n else 0.5, 1e-6), 1 - 1e-6)
        return RuleEnsemble((), math.log(share / (1 - share)))
    inputs = sample.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    trees = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="onethird", minInstancesPerNode=5)
    rules = forest_rules(trees.fit(inputs).toDebugString)
    if not rules:
        return RuleEnsemble((), math.log(ones / (n - ones)))
    fired = sample.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60, tol=1e-5)
    # written down: the rules are evaluated once, not in every step of the regression
    model = lasso.fit(stage(fired, work_dir, "fired"))
    weights = [float(w) for w in model.coefficients.toArray()]
    kept = tuple((r, w) for r, w in zip(rules, weights, strict=True) if w)
    return RuleEnsemble(kept, float(model.intercept))


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Rows kept out of fitting: ``crc32(id as text) mod folds = 0``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), F.lit(folds)) == 0


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, fit_rows: int, work_dir: str
) -> DataFrame:
    """``chosen_id, label`` of the documents to fit on: those with the smallest hash of their id, ``fit_rows`` at most."""
    key = F.col(f"`{id_col}`")
    marked = labels.filter(F.col(f"`{label_col}`").isNotNull() & key.isNotNull())
    marked = marked.groupBy(key.alias("chosen_id")).agg(F.round(F.avg(F.col(f"`{label_col}`"))).alias("label"))
    marked = marked.filter(~held_out("chosen_id"))
    known = docs.select(key.alias("chosen_id")).filter("chosen_id IS NOT NULL")
    found = marked.join(known, "chosen_id", "left_semi").orderBy(F.xxhash64("chosen_id"), "chosen_id").limit(fit_rows)
    return stage(found, work_dir, "chosen")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    keep: tuple[str, ...] = (),
    fit_rows: int = FIT_ROWS,
    work_dir: str | None = None,
) -> DataFrame:
    """``id, held_out, score, predicted`` of every row, and the columns ``keep``.

    Statistics are computed for the chosen labelled documents, and after fitting for all, in the pass that scores them.
    """
    work_dir = work_dir or new_work_dir(docs.sparkSession, "quality")
    columns = tuple(dict.fromkeys([id_col, *keep]))
    key = F.col(f"`{id_col}`")
    chosen = labelled_sample(docs, labels, id_col, label_col, fit_rows, work_dir)
    # at most ``fit_rows`` short rows
    met = docs.select(key.alias("chosen_id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(chosen), "chosen_id")
    # of several documents with one id the one with the least statistics counts
    single = text_statistics(met, "text", ("chosen_id", "label")).groupBy("chosen_id", "label")
    single = single.agg(F.min(F.struct(*STATISTICS)).alias("first")).select("label", "first.*")
    score = fit(single, work_dir).score()
    return text_statistics(docs, text_col, columns).select(
        *[F.col(f"`{c}`") for c in columns],
        held_out(id_col).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
    )
