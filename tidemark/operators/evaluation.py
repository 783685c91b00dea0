"""Classifier quality from the confusion matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Row counts per (label, prediction); everything else is computed from these few rows."""
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count("*").alias("n")
    )


def metrics(matrix: DataFrame) -> DataFrame:
    """Accuracy and F1 weighted by class frequency, one row."""
    both = F.explode(
        F.array(
            F.struct(F.col("label").alias("cls"), F.col("n").alias("truth"), F.lit(0).cast("bigint").alias("guess")),
            F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("truth"), F.col("n").alias("guess")),
        )
    )
    hit = F.when((F.col("label") == F.col("prediction")) & (F.col("side.truth") > 0), F.col("n")).otherwise(0)
    per_class = (
        matrix.select("label", "prediction", "n", both.alias("side"))
        .groupBy(F.col("side.cls").alias("cls"))
        .agg(F.sum("side.truth").alias("truth"), F.sum("side.guess").alias("guess"), F.sum(hit).alias("hit"))
    )
    # 2PR/(P+R) with the divisions cancelled; 0 where a class is never hit.
    f1 = F.try_divide((2 * F.col("hit")).cast("double"), (F.col("truth") + F.col("guess")).cast("double"))
    return per_class.agg(
        F.sum("truth").alias("n"),
        (F.sum("hit") / F.sum("truth")).alias("accuracy"),
        (F.sum(F.coalesce(f1, F.lit(0.0)) * F.col("truth")) / F.sum("truth")).alias("f1_weighted"),
    )
