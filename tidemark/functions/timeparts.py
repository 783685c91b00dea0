"""Parsing times that arrive as text, and the day filters of the daily views."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The strict format of post times, and the forms a lenient reader accepts.
STRICT_FORMAT = "yyyy-MM-dd HH:mm:ss"
LENIENT_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "yyyy-MM-dd",
)


def strict_time(text: Column) -> Column:
    """NULL unless the text has exactly the strict format."""
    return F.try_to_timestamp(text, F.lit(STRICT_FORMAT))


def lenient_time(text: Column) -> Column:
    """The first accepted form that parses; NULL if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(form)) for form in LENIENT_FORMATS])


def hour_of(text: Column) -> Column:
    return F.date_format(strict_time(text), "HH")


def day_of(text: Column) -> Column:
    return F.date_format(strict_time(text), "dd")


def last_day(ticks: DataFrame, as_of: datetime, column: str = "ingestion_date") -> DataFrame:
    """Rows ingested in the 24 hours up to ``as_of``.

    A partition day counts as its midnight. Written as bounds on the bare date column, which prune partitions.
    """
    since = (as_of - timedelta(days=1)).date()
    return ticks.where((F.col(column) > F.lit(since)) & (F.col(column) <= F.lit(as_of.date())))


def on_day(
    posts: DataFrame, as_of: datetime, column: str = "created_at", max_lag_days: int | None = None
) -> DataFrame:
    """Rows of the calendar day of ``as_of``, as a range on the bare time column.

    Where rows are known to be ingested within ``max_lag_days`` after the day, only those partitions are read.
    """
    first = datetime(as_of.year, as_of.month, as_of.day)
    rows = posts.where(
        (F.col(column) >= F.lit(str(first)).cast("timestamp"))
        & (F.col(column) < F.lit(str(first + timedelta(days=1))).cast("timestamp"))
    )
    if max_lag_days is None:
        return rows
    last = (first + timedelta(days=max_lag_days)).date()
    return rows.where(F.col("ingestion_date").between(F.lit(first.date()), F.lit(last)))
