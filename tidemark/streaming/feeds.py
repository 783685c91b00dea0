"""Stream sources and ways to run a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.sources.tables import CSV_TIME


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files: int | None = 1,
    **options,
) -> DataFrame:
    """Files of a folder as a stream, at most ``max_files`` per trigger (``None``: no cap)."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def tick_stream(spark: SparkSession, path: str, max_files: int | None = 1) -> DataFrame:
    """Numbered tick files (header CSV)."""
    return file_stream(spark, path, schemas.TICK_FILE, "csv", max_files, header=True, timestampFormat=CSV_TIME)


def post_stream(spark: SparkSession, path: str, max_files: int | None = 1) -> DataFrame:
    """Scored post files (header CSV)."""
    return file_stream(spark, path, schemas.POST_FILE, "csv", max_files, header=True, timestampFormat=CSV_TIME)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and append it to a Parquet folder, exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Process what is there batch by batch. ``handle`` must be repeatable: a failed batch is run again."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_source(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Like :func:`drain_batches`, for sources whose caps hold only under a continuous trigger."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Let a continuous query run for at most ``seconds``, then stop it; true if it ended by itself."""
    ended = bool(query.awaitTermination(seconds))
    if not ended:
        query.stop()
    return ended
