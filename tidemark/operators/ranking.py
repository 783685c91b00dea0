"""Ordered slices of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def bottom_k(df: DataFrame, score: str, key: str, k: int = 5) -> DataFrame:
    """The ``k`` rows with the lowest score; ``key`` decides between equal scores."""
    return df.orderBy(score, key).limit(k)


def rank_slice(df: DataFrame, order: list[Column], first: int, last: int) -> DataFrame:
    """Ranks ``first`` to ``last`` (counted from 1) in a total order."""
    return df.orderBy(*order).offset(first - 1).limit(last - first + 1)


def preview(df: DataFrame, order: list[str], n: int = 100) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
