"""The two daily views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import view_key
from tidemark.functions.sentiment import FEATURES, sentiment_features
from tidemark.functions.timeparts import last_day, on_day
from tidemark.operators.text import polarity


def stocks_daily_view(ticks: DataFrame, as_of: datetime) -> DataFrame:
    """Count and price statistics of the last 24 hours; one row also when there are no ticks."""
    day = F.lit(as_of.date())
    return last_day(ticks, as_of).agg(
        view_key("stocks", day).alias("key"),
        F.count("*").alias("count"),
        F.min("p").alias("min_price"),
        F.max("p").alias("max_price"),
        F.avg("p").alias("avg_price"),
        day.alias("day"),
    )


def posts_daily_view(
    posts: DataFrame, lexicon: DataFrame, as_of: datetime, max_lag_days: int | None = None
) -> DataFrame:
    """Sentiment features of the day's distinct posts, with the count before duplicates were removed.

    One shuffle scores the posts, merges equal ones and counts the copies. Without posts the single row has
    zero counts and NULL means.
    """
    today = on_day(posts, as_of, max_lag_days=max_lag_days)
    return _day_features(polarity(today, lexicon, keep=("id", "created_at", "source", "ingestion_date")), as_of)


def posts_day_summary(scored: DataFrame, as_of: datetime) -> DataFrame:
    """:func:`posts_daily_view` for posts whose totals are there already (created_at, copies, sum10, hits)."""
    return _day_features(on_day(scored, as_of), as_of)


def _day_features(scored: DataFrame, as_of: datetime) -> DataFrame:
    total = F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("count")
    day = F.lit(as_of.date())
    features = sentiment_features(scored, extra=(total,))
    return features.select(view_key("posts", day).alias("key"), "count", *FEATURES, day.alias("day"))
