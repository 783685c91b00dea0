"""Running values over a totally ordered table without a single-task sort.

A table ordered by time is cut into one-second buckets. Times are distinct microseconds wherever this module is
used, so a bucket never holds more than a million rows, however the data is spread over days or hours. Work
inside a bucket is a window over that bucket; what earlier buckets contribute is a prefix over one row per
bucket, taken inside blocks of 65,536 buckets (18 hours) and then over blocks (about 5,000 per decade).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "bucket"
BLOCK_BITS = 16


def bucket_of(t: str) -> Column:
    # coalesce only says "never NULL", which keeps the optimiser from adding different null checks to the
    # branches below and so lets them share one scan and one shuffle. Callers have dropped NULL times.
    return F.coalesce(F.unix_seconds(F.col(t)), F.lit(0).cast("bigint"))


def bucket_tail(placed: DataFrame, order: list[str], value: str) -> DataFrame:
    """``value`` of the last row of every bucket: the one that none follows.

    The look-ahead takes the whole row. It so keeps the same columns alive as the detail branch, and both read
    one shuffle instead of computing the input twice.
    """
    row = F.struct(*[c for c in placed.columns if c != BUCKET])
    following = F.lead(row).over(Window.partitionBy(BUCKET).orderBy(*order))
    return placed.withColumn("following", following).where("following IS NULL").select(BUCKET, value)


def _sum_of(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


# Associative aggregates, each with its two-argument form: running positions, and the latest item so far.
COMBINE = {"sum": (F.sum, _sum_of), "latest": (F.max, F.greatest)}


def carry_in(per_bucket: DataFrame, value: str, combine: str, out: str, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``value`` combined over all earlier buckets; the input has one row per bucket.

    Where nothing is earlier, a sum is 0 and the latest item is NULL.
    """
    aggregate, merge = COMBINE[combine]
    fine = per_bucket.withColumn("block", F.shiftright(BUCKET, block_bits))
    before_here = Window.partitionBy("block").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    before_block = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    inner = fine.withColumn("inner_carry", aggregate(F.col(value)).over(before_here))
    last = F.max(F.struct(BUCKET, value, "inner_carry")).alias("last")
    blocks = (
        inner.groupBy("block")
        .agg(last)
        .withColumn("total", merge(F.col("last.inner_carry"), F.col(f"last.{value}")))
        .withColumn("outer_carry", aggregate(F.col("total")).over(before_block))
        .select("block", "outer_carry")
    )
    carried = merge(F.col("inner_carry"), F.col("outer_carry"))
    return inner.join(blocks, "block").select(BUCKET, carried.alias(out))


def numbered(df: DataFrame, t: str, out: str = "rn") -> DataFrame:
    """Zero-based position of every row in ascending ``t``; ``t`` must be distinct.

    Both branches read one shuffle. For that they must need the same columns, so bucket sizes are counted in two
    parts, rows with and rows without a missing value.
    """
    bucketed = df.repartition(bucket_of(t)).withColumn(BUCKET, bucket_of(t))
    lacking = functools.reduce(Column.__or__, [F.col(c).isNull() for c in df.columns])
    sizes = bucketed.groupBy(BUCKET).agg((F.count_if(lacking) + F.count_if(~lacking)).alias("size"))
    before = carry_in(sizes, "size", "sum", "before")
    place = F.row_number().over(Window.partitionBy(BUCKET).orderBy(t))
    return bucketed.withColumn("k", place).join(before, BUCKET).select(*df.columns, (F.col("before") + F.col("k") - 1).alias(out))
