"""Count windows: runs of consecutive points of the price series, and the label of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import numbered
from tidemark.operators.series import MILLION, exact, exact_mean

# Window length, points compared on either side, and the width of "no change".
SIZE = 100
PRESENT_LEN = 99
FUTURE_LEN = 19
EPSILON = 0.02


def count_window_index(series: DataFrame, size: int = SIZE, t: str = "t") -> DataFrame:
    """Add ``rn`` (place in the series), ``window_id`` and ``pos`` (place in the window)."""
    # coalesce says that the id is never NULL: no null checks are added, and branches stay alike (see ordered.py).
    return numbered(series, t).select(
        "*", F.expr(f"coalesce(rn DIV {size}, 0L)").alias("window_id"), F.expr(f"CAST(rn % {size} AS INT)").alias("pos")
    )


def _mean(p: str, keep: Column | None = None) -> Column:
    price = exact(F.col(p))
    return exact_mean(price if keep is None else F.when(keep, price))


def window_summary(
    points: DataFrame,
    size: int = SIZE,
    present_len: int = PRESENT_LEN,
    future_len: int = FUTURE_LEN,
    t: str = "t",
    p: str = "p",
) -> DataFrame:
    """Bounds and prefix means of every window, the partial one at the end included."""
    pos = F.col("pos")
    return points.groupBy("window_id").agg(
        F.count("*").alias("n"),
        F.min(t).alias("start"),
        F.max(t).alias("stop"),
        _mean(p, pos < present_len).alias("present_mean"),
        _mean(p, pos < future_len).alias("head_mean"),
        _mean(p).alias("full_mean"),
    )


def with_next(summary: DataFrame, **columns: str) -> DataFrame:
    """Each window beside columns of the following one (``new_name="column"``); NULL after the last.

    Every window reports to its own id and to the one before, and the two reports are put together. That reads
    the summary once and spreads over all tasks; a ``lead`` over the table would sort all windows in one.
    """
    kinds = {f.name: f.dataType for f in summary.schema.fields}
    own = [c for c in summary.columns if c != "window_id"]
    to_self = [F.col(c) for c in own] + [F.lit(None).cast(kinds[old]).alias(new) for new, old in columns.items()]
    to_previous = [F.lit(None).cast(kinds[c]).alias(c) for c in own] + [F.col(o).alias(n) for n, o in columns.items()]
    reports = F.array(
        F.struct(F.col("window_id"), F.lit(True).alias("own"), *to_self),
        F.struct((F.col("window_id") - 1).alias("window_id"), F.lit(None).cast("boolean").alias("own"), *to_previous),
    )
    return (
        summary.select(F.inline(reports))
        .groupBy("window_id")
        .agg(F.max("own").alias("own"), *[F.max(c).alias(c) for c in [*own, *columns]])
        .where("own")
        .drop("own")
    )


def direction(present: Column, future: Column, eps: float = EPSILON) -> Column:
    """0 falls, 1 flat, 2 rises; NULL when either side is unknown."""
    return (
        F.when(F.abs(present - future) < eps, F.lit(1)).when(present > future, F.lit(0)).when(present < future, F.lit(2))
    )


def label_windows(summary: DataFrame, size: int = SIZE, eps: float = EPSILON) -> DataFrame:
    """Label every full window by where the price goes next.

    Compared with the head of the next window, or with all of it when it is the partial last one. A window
    that nothing follows has no label.
    """
    beside = with_next(summary, next_n="n", next_head="head_mean", next_full="full_mean")
    future = F.when(F.col("next_n") == size, F.col("next_head")).otherwise(F.col("next_full"))
    return (
        beside.where(F.col("n") == size)
        .withColumn("future_mean", future)
        .withColumn("label", direction(F.col("present_mean"), F.col("future_mean"), eps))
        .select("window_id", "start", "stop", "present_mean", "future_mean", "label")
    )


def window_table(points: DataFrame, t: str = "t", p: str = "p") -> DataFrame:
    """Every window as one row with its points in order: ``pts``, an array of (pos, t, p)."""
    row = F.struct("pos", F.col(t).alias("t"), F.col(p).alias("p"))
    return points.groupBy("window_id").agg(F.array_sort(F.collect_list(row)).alias("pts"))


def pivot_windows(points: DataFrame, size: int = SIZE, p: str = "p") -> DataFrame:
    """One row per window with columns ``c_0`` … in window order, NULL beyond the end of a partial window.

    The positions of a count window have no gaps, so the ordered prices are spread out by place: one shuffle,
    where a pivot takes two.
    """
    cells = [F.get("pts.p", F.lit(i)).alias(f"c_{i}") for i in range(size)]
    return window_table(points, p=p).select("window_id", *cells)


def window_arrays(points: DataFrame, size: int = SIZE, p: str = "p") -> DataFrame:
    """Full windows as one ordered price array each; the narrow form that models read."""
    return full_windows(window_table(points, p=p), size).select("window_id", "prices")


def full_windows(table: DataFrame, size: int = SIZE) -> DataFrame:
    """The full windows of a :func:`window_table` with their span and prices."""
    return table.where(F.size("pts") == size).select(
        "window_id",
        F.element_at("pts", 1)["t"].alias("start"),
        F.element_at("pts", -1)["t"].alias("stop"),
        F.col("pts.p").alias("prices"),
    )


def _mean_of_array(prices: Column) -> Column:
    known = F.filter(prices, lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0).cast("decimal(38,12)"), lambda acc, x: (acc + x).cast("decimal(38,12)"))
    return F.try_divide((total * MILLION).cast("double"), (F.size(known).cast("bigint") * MILLION).cast("double"))


def table_summary(table: DataFrame, present_len: int = PRESENT_LEN, future_len: int = FUTURE_LEN) -> DataFrame:
    """:func:`window_summary` from a :func:`window_table`.

    For jobs that need the prices as well: both sides then come from one shuffle of the points.
    """
    rows = table.withColumn("exact", F.transform("pts", lambda point: exact(point["p"])))
    return rows.select(
        "window_id",
        F.size("pts").cast("bigint").alias("n"),
        F.element_at("pts", 1)["t"].alias("start"),
        F.element_at("pts", -1)["t"].alias("stop"),
        _mean_of_array(F.slice("exact", 1, present_len)).alias("present_mean"),
        _mean_of_array(F.slice("exact", 1, future_len)).alias("head_mean"),
        _mean_of_array(F.col("exact")).alias("full_mean"),
    )
