"""Random-forest regression: fit, save, load and score as batch jobs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowfold.functions.hashing import quote


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int = 20,
    depth: int = 5,
    seed: int = 0,
) -> PipelineModel:
    """Trees grow level by level from histograms of the split columns; rows stay in the executors.

    Rows with a null label or feature are not used for fitting.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    forest = RandomForestRegressor(
        featuresCol="_features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed
    )
    needed = df.select(*features, label).dropna()
    return Pipeline(stages=[assembler, forest]).fit(needed)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All rows with their ``prediction``, which is null where a feature is."""
    features = model.stages[0].getInputCols()
    complete = reduce(lambda a, b: a & b, [F.col(quote(c)).isNotNull() for c in features])
    scored = model.transform(df).drop("_features")
    return scored.withColumn("prediction", F.when(complete, F.col("prediction")))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
