"""Gradient-boosted trees on a bounded sample of labelled rows, by Spark's own learner. DataFrame functions only."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import bounded_sample, save

#: Labelled rows a model is fitted on, the least by the hash of the row's key.
MAX_TRAINING_ROWS = 20_000
TREES, DEPTH = 12, 4


def at_least(good: float, n: float, z: float) -> float:
    """Lower end of the Wilson interval for a share of which good of n are seen; 0 for none."""
    if n <= 0:
        return 0.0
    share, zz = good / n, z * z
    return (share + zz / (2 * n) - z * (share * (1 - share) / n + zz / (4 * n * n)) ** 0.5) / (1 + zz / n)


class Boosted:
    def __init__(self, features: list[str], model):
        self.model = model
        self.assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")

    def score(self, df: DataFrame, to: str) -> DataFrame:
        """df with the probability of label 1."""
        scored = self.model.transform(self.assembler.transform(df))
        return scored.withColumn(to, vector_to_array("_probability")[1]).drop("_features", "_raw", "_probability", "_prediction")


def fit(labelled: DataFrame, features: list[str], label: str, key: str, rows: int = MAX_TRAINING_ROWS) -> Boosted | None:
    """A model, or None where the sample has not both labels."""
    sample = bounded_sample(labelled.select(F.col(key).alias("_key"), *features, F.col(label).cast("double").alias("_label")), "_key", rows)
    sample = save(sample, "training")
    if sample.select("_label").distinct().count() < 2:
        return None
    trees = GBTClassifier(labelCol="_label", featuresCol="_features", predictionCol="_prediction", maxIter=TREES, maxDepth=DEPTH, seed=7, maxMemoryInMB=64)
    trees = trees.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    assembler = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")
    return Boosted(features, trees.fit(assembler.transform(sample.coalesce(4)).select("_features", "_label")))
