"""Declared schemas of every table, file and message; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Tables partitioned by ingestion day. The stored time columns are text, as the feeds deliver them.
TICK_TABLE = _struct(
    ("s", StringType()),
    ("p", DoubleType()),
    ("t", StringType()),
    ("v", DoubleType()),
    ("c", StringType()),
    ("ingestion_date", StringType()),
)
POST_TABLE = _struct(
    ("id", StringType()),
    ("text", StringType()),
    ("created_at", StringType()),
    ("source", StringType()),
    ("ingestion_date", StringType()),
)

# Files exchanged between the layers.
TICK_FILE = _struct(("t", TimestampType()), ("p", DoubleType()), ("num", IntegerType()), ("window_id", LongType()))
POST_FILE = _struct(("created_at", TimestampType()), ("sentiment", DoubleType()), ("window_id", LongType()))
WINDOW_FILE = _struct(
    ("window_id", LongType()),
    ("start_timestamp", TimestampType()),
    ("stop_timestamp", TimestampType()),
    ("label", IntegerType()),
)
SPLIT_FILE = _struct(("window_id", LongType()))
PREDICTION_FILE = _struct(
    ("window_id", LongType()), ("label", IntegerType()), *[(f"prob_{i}", DoubleType()) for i in range(3)]
)

# Messages: headerless CSV.
POST_LINE = _struct(
    ("id", StringType()), ("text", StringType()), ("timestamp", StringType()), ("source", StringType())
)
WINDOW_LINE = _struct(("t", StringType()), ("p", DoubleType()), ("num", IntegerType()))

# Views kept for serving.
POSTS_VIEW = _struct(
    ("key", StringType()),
    ("count", LongType()),
    ("nr_neg", LongType()),
    ("nr_pos", LongType()),
    ("nr_neutral", LongType()),
    ("mean_neg", DoubleType()),
    ("mean_pos", DoubleType()),
    ("mean_neutral", DoubleType()),
    ("day", DateType()),
)
STOCKS_VIEW = _struct(
    ("key", StringType()),
    ("count", LongType()),
    ("min_price", DoubleType()),
    ("max_price", DoubleType()),
    ("avg_price", DoubleType()),
    ("day", DateType()),
)
LABEL_VIEW = _struct(
    ("key", StringType()),
    ("window_id", LongType()),
    ("label", IntegerType()),
    ("prob", ArrayType(DoubleType())),
    ("stock", StringType()),
    ("posts", StringType()),
    ("batch_id", LongType()),
)
WINDOW_MESSAGE = _struct(("window_id", LongType()), ("payload", StringType()))
SCORED_POST = _struct(
    ("id", StringType()),
    ("created_at", TimestampType()),
    ("hits", LongType()),
    ("sum10", LongType()),
    ("day", DateType()),
)

# The raw tables the sample fixtures are made of. `ts` is declared as an instant so that filters on it reach
# the Parquet scan; the files hold UTC wall time.
EVENTS = _struct(
    ("event_id", LongType()),
    ("ts", TimestampType()),
    ("user_id", LongType()),
    ("event_type", StringType()),
    ("value", DoubleType()),
    ("props", StringType()),
)
