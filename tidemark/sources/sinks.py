"""Serving views as keyed Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.tables import write_csv


def append_view(view: DataFrame, path: str, day: str = "day") -> None:
    """Add a daily row. The day is the partition, so running the same day again replaces it."""
    (
        view.coalesce(1)  # one row per day
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def upsert_latest(batch: DataFrame, batch_id: int, path: str) -> None:
    """Land one micro-batch under its number. A batch that is run again overwrites itself."""
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def landed_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All landed batches. ``schema`` names ``batch_id`` too."""
    return spark.read.schema(schema).parquet(path)


def latest_rows(landed: DataFrame, key: str = "key", order: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """The newest row of every key. With an event-time ``order`` the batches may land in any order."""
    values = [c for c in landed.columns if c != key]
    newest = F.max_by(F.struct(*values), F.struct(*order))
    return landed.groupBy(key).agg(newest.alias("row")).select(key, "row.*")


def export_windows(df: DataFrame, path: str, windows_per_folder: int = 1) -> None:
    """Replay files: header CSV, one folder per window or per run of windows."""
    folder = F.expr(f"window_id DIV {windows_per_folder}")
    write_csv(df.withColumn("folder", folder), path, by="folder")
