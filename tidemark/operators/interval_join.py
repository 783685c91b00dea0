"""Match points in time with the spans that contain them.

The spans are those of count windows: closed and disjoint. So the span of a point, if it has one, is the latest
span that starts at or before it. That is found by one sorted pass per second of data plus a carry between
seconds, never by comparing spans with points pair by pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import BUCKET, bucket_of, bucket_tail, carry_in


def locate(points: DataFrame, spans: DataFrame, ts: str, lo: str = "start", hi: str = "stop") -> DataFrame:
    """Add ``window_id`` to the points that lie in a span; the others drop out.

    ``points`` needs distinct ``ts``: aggregate or deduplicate by time first, which also takes the weight out of
    a time that very many rows share. Span and point at the same instant meet (closed bounds).
    """
    carried = [c for c in points.columns if c != ts]
    starts = spans.select(
        F.col(lo).alias(ts),
        F.lit(0).alias("kind"),
        F.struct(F.col(lo).alias("lo"), F.col(hi).alias("hi"), "window_id").alias("span"),
    )
    stamped = points.where(F.col(ts).isNotNull()).withColumn("kind", F.lit(1))
    merged = stamped.unionByName(starts, allowMissingColumns=True).withColumn(BUCKET, bucket_of(ts))
    so_far = Window.partitionBy(BUCKET).orderBy(ts, "kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = merged.withColumn("own", F.max("span").over(so_far)).drop("span")
    earlier = carry_in(bucket_tail(placed, [ts, "kind"], "own"), "own", "latest", "earlier")
    return (
        placed.where(F.col("kind") == 1)
        .join(earlier, BUCKET)
        .withColumn("span", F.coalesce("own", "earlier"))
        .where(F.col(ts) <= F.col("span.hi"))
        .select(F.col("span.window_id").alias("window_id"), ts, *carried)
    )


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    ts: str,
    lo: str = "start",
    hi: str = "stop",
    times: DataFrame | None = None,
) -> DataFrame:
    """Every point row with the ``window_id`` of its span, times shared by many rows allowed.

    Distinct times are located first; the rows then pick up their window by an equi-join on the time, which
    adaptive execution splits where one time is heavy. Where ``points`` is costly to compute, name a cheaper
    table with the same times.
    """
    stamps = (points if times is None else times).select(ts).distinct()
    return points.join(locate(stamps, spans, ts, lo, hi), ts)
