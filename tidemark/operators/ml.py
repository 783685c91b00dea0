"""Features, training and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    OneVsRest,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IndexToString,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sentiment import FEATURES

# The settings of the four classifiers.
N_TREES = 100
SVC_ITERATIONS = 10
SVC_REGULARISATION = 0.1
GBT_ITERATIONS = 10
SEED = 42

LOADERS = {
    "rf": RandomForestClassificationModel,
    "ovr_rf": PipelineModel,
    "ovr_svc": PipelineModel,
    "ovr_gbt": PipelineModel,
    "pipeline": PipelineModel,
}


def assemble(df: DataFrame, columns: Iterable[str] = FEATURES, out: str = "features") -> DataFrame:
    """Number columns → one vector. A missing number is an error: fill or drop it first."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error").transform(df)


def price_features(windows: DataFrame, prices: str = "prices", out: str = "features") -> DataFrame:
    """Price arrays → vectors. Windows with a missing price cannot be scored and are left out."""
    return windows.where(F.forall(prices, lambda p: p.isNotNull())).withColumn(out, array_to_vector(F.col(prices)))


def index_labels(df: DataFrame, label: str = "label", out: str = "indexed_label") -> StringIndexerModel:
    """Labels by falling frequency, equal ones in alphabetical order."""
    return StringIndexer(inputCol=label, outputCol=out, stringOrderType="frequencyDesc").fit(df)


def index_features(df: DataFrame, features: str = "features", out: str = "indexed_features") -> VectorIndexerModel:
    """Treat features with few distinct values as categories."""
    return VectorIndexer(inputCol=features, outputCol=out, handleInvalid="keep").fit(df)


def classifier(kind: str, label: str = "label", features: str = "features", seed: int = SEED, **params):
    """``rf``, or one-vs-rest over it (``ovr_rf``), a linear SVC (``ovr_svc``) or boosted trees (``ovr_gbt``)."""
    columns = {"labelCol": label, "featuresCol": features}
    if kind in ("rf", "ovr_rf"):
        base = RandomForestClassifier(**columns, seed=seed, **{"numTrees": N_TREES, **params})
    elif kind == "ovr_svc":
        base = LinearSVC(**columns, **{"maxIter": SVC_ITERATIONS, "regParam": SVC_REGULARISATION, **params})
    elif kind == "ovr_gbt":
        base = GBTClassifier(**columns, seed=seed, **{"maxIter": GBT_ITERATIONS, **params})
    else:
        raise ValueError(f"unknown classifier {kind!r}")
    # The three class models are independent of each other: fit them side by side.
    return base if kind == "rf" else OneVsRest(classifier=base, **columns, parallelism=3)


def train(df: DataFrame, kind: str, **params) -> Model:
    """Fit on ``features`` and ``label``. Fitting reads its input many times, so pass a written table."""
    if kind == "rf":
        # The label column names its three classes, so a forest has three probabilities also when a class is
        # missing from the sample.
        classes = {"ml_attr": {"type": "nominal", "vals": ["0", "1", "2"]}}
        label = F.col("label").cast("double").alias("label", metadata=classes)
        return classifier(kind, **params).fit(df.select(label, "features"))
    # One-vs-rest needs rows of every class it counts: number the classes that occur, and turn back after.
    rows = df.select(F.col("label").cast("double").alias("label"), "features")
    numbers = StringIndexer(inputCol="label", outputCol="class_number", stringOrderType="alphabetAsc").fit(rows)
    model = classifier(kind, label="class_number", **params).setPredictionCol("class_predicted").fit(
        numbers.transform(rows)
    )
    names = IndexToString(inputCol="class_predicted", outputCol="prediction", labels=numbers.labels)
    return PipelineModel(stages=[model, names])


def score(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and, where the model gives probabilities, the array ``prob``."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        scored = scored.withColumn("prob", vector_to_array("probability"))
    internal = ("features", "rawPrediction", "probability", "class_predicted")
    kept = [c for c in scored.columns if c not in internal]
    return scored.select(*kept).withColumn("prediction", F.col("prediction").cast("double").cast("int"))


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind: str) -> Model:
    return LOADERS[kind].load(path)


def evaluate(df: DataFrame, metric: str = "accuracy", label: str = "label", prediction: str = "prediction") -> float:
    """Spark's own evaluator: ``accuracy``, ``f1``, ``weightedFMeasure`` …"""
    ready = df.select(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction"))
    return MulticlassClassificationEvaluator(metricName=metric).evaluate(ready)
