"""From raw ticks and posts to labelled windows with features for both models."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.sentiment import FEATURES, combine_features, fill_empty_means, partial_features
from tidemark.operators.interval_join import locate
from tidemark.operators.series import price_series
from tidemark.operators.text import polarity
from tidemark.operators.windows import (
    SIZE,
    count_window_index,
    full_windows,
    label_windows,
    table_summary,
    window_summary,
    window_table,
)


def indexed_points(ticks: DataFrame, size: int = SIZE) -> DataFrame:
    return count_window_index(price_series(ticks), size)


def labelled_windows(ticks: DataFrame, size: int = SIZE) -> DataFrame:
    return label_windows(window_summary(indexed_points(ticks, size), size), size)


def window_sentiment(windows: DataFrame, scored: DataFrame) -> DataFrame:
    """Sentiment features of the posts inside each window; windows without posts stay, with NULLs.

    Posts are added up per instant before they meet the windows, so an instant with very many posts is one row.
    """
    per_instant = partial_features(scored, ("created_at",))
    inside = locate(per_instant, windows, "created_at")
    return windows.join(combine_features(inside, ("window_id",)), "window_id", "left")


def post_windows(ticks: DataFrame, posts: DataFrame, lexicon: DataFrame, size: int = SIZE) -> DataFrame:
    """Labelled windows with raw sentiment features (NULL mean = no post of that kind)."""
    return scored_post_windows(ticks, polarity(posts, lexicon, keep=("id", "created_at")), size)


def scored_post_windows(ticks: DataFrame, scored: DataFrame, size: int = SIZE) -> DataFrame:
    """:func:`post_windows` for posts whose totals are there already (created_at, sum10, hits)."""
    return window_sentiment(labelled_windows(ticks, size), scored)


def complete_post_windows(features: DataFrame) -> DataFrame:
    """Windows that can train the posts model: labelled and with posts of every kind."""
    return features.dropna("any", subset=[*FEATURES, "label"])


def scorable_post_windows(features: DataFrame) -> DataFrame:
    """All windows with the defaults of the speed layer in place of missing means."""
    return fill_empty_means(features)


def stock_windows(ticks: DataFrame, size: int = SIZE) -> DataFrame:
    """Labelled windows with their price arrays."""
    table = window_table(indexed_points(ticks, size))
    labels = label_windows(table_summary(table), size).select("window_id", "label")
    return full_windows(table, size).join(labels, "window_id")
