"""A corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowfold.llm import fertility, mixing, piece_encoding, rule_ensemble, simhash
from rowfold.llm.queries import PIECE_BPE, tokenizer_path
from rowfold.llm.shipping import with_package
from rowfold.session import new_work_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@with_package
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the token bands keep.

    A null or empty text has no words and goes. Equal rows stay or go together, as often as they come; rows that differ in
    any column, or in which of them is null, are rows of their own. No rows give no rows; other columns are left out.
    """
    # figures are kept without their texts; equal rows have equal figures
    keyed = docs.select(simhash.row_hash(docs.select(*COLUMNS)).alias("row_key"), *COLUMNS)
    told = fertility.judged(keyed, tokenizer_path(PIECE_BPE), keep=("row_key",))
    return keyed.join(told.filter("kept").select("row_key"), "row_key", "left_semi").select(*COLUMNS)


@with_package
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted to the labelled ones among them, predicts to be good.

    Every row is scored by its own text, null or empty ones as empty; repeated rows stay or go together. Without labels of
    both classes all rows have one score: all stay, or none. No rows give no rows; other columns are left out.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = rule_ensemble.quality_scores(docs, labels, keep=tuple(COLUMNS))
    return scored.filter("predicted = 1").select(*COLUMNS)


@with_package
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of three-word shingles that link at two bits or fewer.

    The one with the smallest id stays, of several with that id exactly one, a null id only where there is no other. Texts
    without words are near copies of each other. No rows give no rows; other columns are left out.
    """
    return simhash.deduplicated(docs.select(*COLUMNS))


@with_package
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, in the order of their training positions.

    A document that fills up its source's target is taken whole. Texts without words are not taken. Equal rows are used as
    often as so many different ones; a null source is a source. No rows give no rows; other columns are left out.
    """
    folder = new_work_dir(spark, "mixture")
    keyed = docs.select(simhash.row_hash(docs.select(*COLUMNS)).alias("row_key"), *COLUMNS)
    mixed = mixing.mixture(keyed.select("row_key", "source", "text"), id_col="row_key", work_dir=folder)
    used = mixing.scheduled(mixed, folder)[0].select("row_key", "position", "epoch")
    # the mix has a row for each copy, so of equal rows one is enough
    if not mixed.groupBy("row_key").count().filter("count > 1").isEmpty():
        keyed = keyed.dropDuplicates(["row_key"])
    placed = keyed.join(used, "row_key")
    ordered = placed.repartitionByRange("position", "epoch", "row_key").sortWithinPartitions("position", "epoch", "row_key")
    return ordered.select(*COLUMNS)


@with_package
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document with the original bytes of each piece, as digests.

    A null text counts as an empty one; every row gives a row, repeated ones too. No rows give no rows.
    """
    return piece_encoding.piece_digests(docs, tokenizer_path(PIECE_BPE))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode),
]
#: The quality and near-copy stages are not expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    folder = new_work_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            path = f"{folder}/{number}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
