"""Late fusion: two classifiers vote with their probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import add_elementwise, argmax_label


def pair_probabilities(stock: DataFrame, posts: DataFrame, on: str = "window_id") -> DataFrame:
    """Both probability arrays of each key; inputs hold ``on`` and an array ``prob``.

    Paired by key, never by row order.
    """
    return stock.select(on, F.col("prob").alias("prob_stock")).join(
        posts.select(on, F.col("prob").alias("prob_posts")), on
    )


def fuse(stock: DataFrame, posts: DataFrame, on: str = "window_id") -> DataFrame:
    """Sum the two arrays and take the class with the largest sum."""
    pairs = pair_probabilities(stock, posts, on)
    summed = pairs.withColumn("prob", add_elementwise(F.col("prob_stock"), F.col("prob_posts")))
    return summed.withColumn("label", argmax_label(F.col("prob")))
