"""Small helpers that several operators use."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that a model is tested on: crc32 of the id as text, modulo the folds, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def texts_of(batch) -> Iterator[str]:
    """Texts of an Arrow batch one after the other, null as empty; never the whole batch as Python strings."""
    for value in batch.column("text"):
        yield value.as_py() or ""


def parallelism(spark: SparkSession) -> int:
    """Partitions for a shuffle that is asked for by number: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
