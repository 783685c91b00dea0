"""Pipeline stages over built-in functions, usable on tables and on streams."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sentiment import EMPTY_MEANS, bucket_of_score, feature_columns


class SentimentFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """All scored posts so far → one row of six features, empty buckets at their default means."""

    closedNeutral = Param(Params._dummy(), "closedNeutral", "does ±0.2 count as neutral", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, closedNeutral=True):
        super().__init__()
        self._setDefault(closedNeutral=True)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        bucket = bucket_of_score("sentiment", self.getOrDefault(self.closedNeutral))
        return dataset.withColumn("sentiment_bucket", bucket).agg(*feature_columns(defaults=EMPTY_MEANS))


class WindowPivot(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Numbered ticks → one feature vector per complete window, also on a stream, which has no pivot call.

    Keyed by the window: without the key, points of all windows seen so far would run together.
    """

    size = Param(Params._dummy(), "size", "points per window", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, size=100):
        super().__init__()
        self._setDefault(size=100)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        size = self.getOrDefault(self.size)
        points = F.array_sort(F.collect_list(F.struct("num", "p")))
        rows = dataset.where(F.col("p").isNotNull()).groupBy("window_id").agg(points.alias("pts"))
        return rows.where(F.size("pts") == size).select("window_id", array_to_vector(F.col("pts.p")).alias("features"))
