"""The price series and time bins without gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

MILLION = 1_000_000


def price_series(ticks: DataFrame, t: str = "t", p: str = "p") -> DataFrame:
    """One point per distinct time, priced at the mean of its ticks.

    Ticks without a time have no place in it; a price that is not a number counts as missing.
    """
    return ticks.where(F.col(t).isNotNull()).groupBy(t).agg(exact_mean(exact(F.col(p))).alias(p))


def exact(value: Column) -> Column:
    """A number as a decimal, so that sums don't depend on the order of rows; NULL for what is not finite."""
    return value.cast("double").try_cast("decimal(28,12)")


def exact_mean(value: Column) -> Column:
    """Mean of decimals as a double; NULL if all are missing."""
    return F.try_divide((F.sum(value) * MILLION).cast("double"), (F.count(value) * MILLION).cast("double"))


def dense_bins(df: DataFrame, t: str, unit: str, aggs: list[Column]) -> DataFrame:
    """Aggregate per ``day`` or ``minute``, with every bin between the first and the last one present.

    Bins without rows carry NULL; count columns are filled by the caller.
    """
    if unit not in ("day", "minute"):
        raise ValueError(f"unit must be 'day' or 'minute', not {unit!r}")
    counted = df.where(F.col(t).isNotNull()).groupBy(F.date_trunc(unit, t).alias("bin")).agg(*aggs)
    filled = materialise(counted, "bins")  # few rows, read twice
    row = F.struct(*filled.columns)
    span = filled.agg(F.min(row).alias("lo"), F.max(row).alias("hi")).select(
        F.col("lo.bin").alias("lo"), F.col("hi.bin").alias("hi")
    )
    days = span.select(
        "lo", "hi", F.explode(F.sequence(F.date_trunc("day", "lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))).alias("bin")
    )
    if unit == "minute":
        days = days.repartition("bin")  # the minutes of each day are laid out in another task
        minutes = F.sequence(F.col("bin"), F.col("bin") + F.expr("INTERVAL 1439 MINUTES"), F.expr("INTERVAL 1 MINUTE"))
        days = days.select("lo", "hi", F.explode(minutes).alias("bin")).where("bin BETWEEN lo AND hi")
    return days.select("bin").join(filled, "bin", "left")
