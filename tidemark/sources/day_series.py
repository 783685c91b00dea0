"""A numbered series that is kept day by day.

A stored day holds its points with their place inside that day, and one carry row with their number. The place in
the whole series is the place in the day plus the carries of the days before, which is one row a day, so a new day is
numbered without reading any other, and a day that arrives late or again moves what follows it without rewriting
it. Count windows of a day read that day and, for the window that began before it, as many days back as its points lie.

Layout: ``points/day=D`` and ``carry/day=D``. A day that is written again replaces itself; if a job dies between the two
writes the day has to be run again, which is what a failed run asks for anyway.

Defined cases: a day without points has a carry of 0; days may come in any order; points without a time are left out;
times of a day are distinct, as everywhere in the series; nothing stored yet gives an empty series.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.ordered import numbered
from tidemark.sources.latest import names

CARRY = "n long, day date"


def add_day(points: DataFrame, path: str, day: date, t: str = "t") -> None:
    """Store one day's points (all of them, and only them)."""
    spark, schema = points.sparkSession, points.schema
    own = f"{path}/points/day={day.isoformat()}"
    numbered(points.where(F.col(t).isNotNull()), t, out="place").write.mode("overwrite").parquet(own)
    stored = spark.read.schema(StructType([*schema.fields]).add("place", "long")).parquet(own)
    stored.agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/carry/day={day.isoformat()}")


def carries(spark: SparkSession, path: str) -> DataFrame:
    """day, n, before (points of all earlier days): one row a day, some 36,500 in a century, so one task orders them."""
    if not names(spark, f"{path}/carry"):
        return spark.createDataFrame([], f"{CARRY}, before long").select("day", "n", "before")
    rows = spark.read.schema(CARRY).parquet(f"{path}/carry")
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("day", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def read_days(spark: SparkSession, path: str, schema: StructType, first: date, last: date) -> DataFrame:
    """Points of the days from ``first`` to ``last`` with ``rn``, their place in the whole series; other days aren't read."""
    if not names(spark, f"{path}/points"):
        return spark.createDataFrame([], StructType([*schema.fields]).add("day", "date").add("rn", "long"))
    stored = StructType([*schema.fields]).add("place", "long").add("day", "date")
    rows = spark.read.schema(stored).parquet(f"{path}/points").where(F.col("day").between(F.lit(first), F.lit(last)))
    placed = rows.join(carries(spark, path).select("day", "before"), "day")
    return placed.select(*schema.fieldNames(), "day", (F.col("before") + F.col("place")).alias("rn"))


def windows_ending(spark: SparkSession, path: str, schema: StructType, day: date, size: int) -> DataFrame:
    """Points, with window_id and pos, of the whole count windows whose last point lies in ``day``."""
    days = carries(spark, path)
    own = days.where(F.col("day") == F.lit(day)).select("n", "before").first()
    if own is None or not own.n:
        return read_days(spark, path, schema, day, day).where("false").select(*schema.fieldNames(), "rn", *_window(size))
    start = own.before // size * size  # the first window that isn't whole before the day
    first = days.where((F.col("before") <= start) & (F.col("before") + F.col("n") > start)).agg(F.min("day").alias("day")).first().day
    stop = (own.before + own.n) // size * size
    rows = read_days(spark, path, schema, first, day).where(F.col("rn").between(start, stop - 1))
    return rows.select(*schema.fieldNames(), "rn", *_window(size))


def _window(size: int) -> list:
    return [F.expr(f"rn DIV {size}").alias("window_id"), F.expr(f"CAST(rn % {size} AS INT)").alias("pos")]
