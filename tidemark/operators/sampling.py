"""Samples and splits that come out the same however the rows are partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import digest_number, seeded_digest
from tidemark.operators.ordered import BUCKET, carry_in

SLICE_DIGITS = 5  # 16**5 slices: about a million, whatever the number of rows
SPLIT_PARTS = 10_000


def sample_fixed(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer): those with the smallest seeded digest of their unique ``key``.

    Rows fall into slices by the head of the digest. Counting the slices tells which of them lie wholly inside
    the sample, so ranking happens inside slices only and no task merges candidates from all others.
    """
    drawn = df.withColumn("digest", seeded_digest(F.col(key), seed))
    drawn = drawn.withColumn(BUCKET, digest_number(F.col("digest"), SLICE_DIGITS))
    sizes = drawn.groupBy(BUCKET).agg(F.count("*").alias("size"))
    wanted = carry_in(sizes, "size", "sum", "before", block_bits=10).where(F.col("before") < n)
    rank = F.row_number().over(Window.partitionBy(BUCKET).orderBy("digest", key))
    return (
        drawn.join(wanted, BUCKET)
        .withColumn("rank", F.col("before") + rank)
        .where(F.col("rank") <= n)
        .select(*df.columns)
    )


def split_by_hash(df: DataFrame, key: str = "window_id", train: float = 0.7, seed: int = 42) -> DataFrame:
    """Add ``is_train``; a key always lands on the same side."""
    place = F.pmod(digest_number(seeded_digest(F.col(key), seed), 8), F.lit(SPLIT_PARTS))
    return df.withColumn("is_train", place < int(round(train * SPLIT_PARTS)))


def split_random(df: DataFrame, train: float = 0.7, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own split. It depends on partitioning, so write both sides down before sharing them."""
    left, right = df.randomSplit([train, 1.0 - train], seed)
    return left, right


def keep_split(df: DataFrame, index: DataFrame, key: str = "window_id") -> DataFrame:
    """Rows whose key is in a split index. Catalyst broadcasts the index if its measured size is small."""
    return df.join(index.select(key), key, "left_semi")
