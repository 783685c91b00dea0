"""Sentiment buckets and the six features made from them.

A text's polarity is ``sum10 / (10 * hits)``: word weights are whole tenths, so the bucket borders at ±0.2 are
compared in integers and hold exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Means assumed for a bucket without posts, so that a model always gets six numbers.
EMPTY_MEANS = {"neg": -0.4, "neutral": 0.0, "pos": 0.4}
BUCKETS = ("neg", "pos", "neutral")
# Scores are added up as whole billionths: a mean is then the same in whatever order its rows arrive.
SCORE_UNIT = 1_000_000_000
FEATURES = ["nr_neg", "nr_pos", "nr_neutral", "mean_neg", "mean_pos", "mean_neutral"]


def polarity_value(sum10: str = "sum10", hits: str = "hits") -> Column:
    """Mean weight of the matched words in [-1, 1]; 0 for a text without any."""
    return F.when(F.col(hits) > 0, F.col(sum10) / (F.col(hits) * 10)).otherwise(F.lit(0.0))


def sentiment_bucket(sum10: str = "sum10", hits: str = "hits", closed_neutral: bool = True) -> Column:
    """``neg`` below -0.2, ``pos`` above 0.2, ``neutral`` between.

    With ``closed_neutral=False`` exactly ±0.2 belongs to no bucket (NULL).
    """
    total, border = F.col(sum10), F.col(hits) * 2
    bucket = F.when(total < -border, "neg").when(total > border, "pos")
    if closed_neutral:
        return bucket.otherwise("neutral")
    return bucket.when((F.col(hits) == 0) | ((total > -border) & (total < border)), "neutral")


def bucket_of_score(score: str = "sentiment", closed_neutral: bool = True) -> Column:
    """The same buckets for a ready-made score; what is not a number is in none."""
    s = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    bucket = F.when(s < -0.2, "neg").when(s > 0.2, "pos")
    if closed_neutral:
        return bucket.when(s.between(-0.2, 0.2), "neutral")
    return bucket.when((s > -0.2) & (s < 0.2), "neutral")


def score_total(score: str | Column, keep: Column | None = None) -> Column:
    """Sum of a score in SCORE_UNITs, as a decimal that cannot overflow."""
    units = F.round((F.col(score) if isinstance(score, str) else score) * SCORE_UNIT).cast("bigint").cast("decimal(18,0)")
    return F.sum(units if keep is None else F.when(keep, units))


def mean_of_total(total: Column, n: Column) -> Column:
    """The mean behind a :func:`score_total`; NULL for no rows."""
    return F.try_divide(total.cast("double"), n.cast("double") * F.lit(float(SCORE_UNIT)))


def mean_score(score: str, keep: Column | None = None) -> Column:
    present = F.col(score).isNotNull() if keep is None else keep & F.col(score).isNotNull()
    return mean_of_total(score_total(score, keep), F.count_if(present))


def feature_columns(
    bucket: str = "sentiment_bucket", score: str = "sentiment", defaults: dict[str, float] | None = None
) -> list[Column]:
    """Aggregates for the six features; ``defaults`` replaces the NULL mean of an empty bucket."""
    counts, means = [], []
    for name in BUCKETS:
        inside = F.col(bucket) == name
        counts.append(F.count_if(inside).alias(f"nr_{name}"))
        mean = mean_score(score, inside)
        if defaults is not None:
            mean = F.coalesce(mean, F.lit(float(defaults[name])))
        means.append(mean.alias(f"mean_{name}"))
    return counts + means


def sentiment_features(
    scored: DataFrame,
    keys: tuple[str, ...] = (),
    defaults: dict[str, float] | None = None,
    closed_neutral: bool = True,
    extra: tuple[Column, ...] = (),
) -> DataFrame:
    """The six features per ``keys`` from posts with ``sum10`` and ``hits``; one row in total without keys."""
    ready = scored.withColumns(
        {"sentiment": polarity_value(), "sentiment_bucket": sentiment_bucket(closed_neutral=closed_neutral)}
    )
    return ready.groupBy(*keys).agg(*extra, *feature_columns(defaults=defaults))


def partial_features(scored: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Counts and score totals per bucket, in a form that can be added up later."""
    ready = scored.withColumns({"sentiment": polarity_value(), "sentiment_bucket": sentiment_bucket()})
    sums = []
    for name in BUCKETS:
        inside = F.col("sentiment_bucket") == name
        sums.append(F.count_if(inside).alias(f"nr_{name}"))
        sums.append(score_total("sentiment", inside).alias(f"total_{name}"))
    return ready.groupBy(*keys).agg(*sums)


def combine_features(partial: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Finish :func:`partial_features` on coarser keys."""
    added = partial.groupBy(*keys).agg(
        *[F.sum(f"nr_{b}").alias(f"nr_{b}") for b in BUCKETS],
        *[F.sum(f"total_{b}").alias(f"total_{b}") for b in BUCKETS],
    )
    means = [mean_of_total(F.col(f"total_{b}"), F.col(f"nr_{b}")).alias(f"mean_{b}") for b in BUCKETS]
    return added.select(*keys, *[f"nr_{b}" for b in BUCKETS], *means)


def fill_empty_means(features: DataFrame, defaults: dict[str, float] | None = None) -> DataFrame:
    """Zero counts and default means where a window has no posts of a bucket."""
    values = defaults or EMPTY_MEANS
    filled = {f"nr_{b}": F.coalesce(F.col(f"nr_{b}"), F.lit(0).cast("bigint")) for b in BUCKETS}
    filled |= {f"mean_{b}": F.coalesce(F.col(f"mean_{b}"), F.lit(float(values[b]))) for b in BUCKETS}
    return features.withColumns(filled)
