"""Class-probability arrays: sums, the winning class, text renderings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_elementwise(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def argmax_label(values: Column) -> Column:
    """Index of the largest value; the lowest index wins a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def normalised(values: Column) -> Column:
    """Absolute values scaled to sum 1."""
    sizes = F.transform(values, lambda x: F.abs(x.cast("double")))
    total = F.aggregate(sizes, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(sizes, lambda x: x / total)


def rendered(values: Column) -> Column:
    """``[a,b,c]`` with six decimals, for audit columns."""
    parts = F.transform(values, lambda x: F.format_string("%.6f", x))
    return F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))


def signed_label(label: Column) -> Column:
    """0, 1, 2 shown as -1, 0, 1; anything else is NULL."""
    return F.when(label == 0, F.lit(-1)).when(label == 1, F.lit(0)).when(label == 2, F.lit(1))
