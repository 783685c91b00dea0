"""The partitioned tick and post tables, and CSV files with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions.timeparts import lenient_time


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Define both tables, as external tables below ``location`` if one is given."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, schema in (("stock", schemas.TICK_TABLE), ("post", schemas.POST_TABLE)):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        place = f" LOCATION '{location}/{table}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) "
            f"USING parquet PARTITIONED BY (ingestion_date){place}"
        )


def typed_ticks(raw: DataFrame) -> DataFrame:
    """Stored ticks with real times and days; text that is no time becomes NULL."""
    return raw.select(
        "s",
        F.col("p").cast("double").alias("p"),
        lenient_time(F.col("t").cast("string")).alias("t"),
        F.col("v").cast("double").alias("v"),
        "c",
        F.col("ingestion_date").try_cast("date").alias("ingestion_date"),
    )


def typed_posts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        "text",
        lenient_time(F.col("created_at").cast("string")).alias("created_at"),
        "source",
        F.col("ingestion_date").try_cast("date").alias("ingestion_date"),
    )


def read_ticks(spark: SparkSession, table: str | None = None, path: str | None = None) -> DataFrame:
    """Ticks from a catalogue table or from the root folder of its partitions."""
    return typed_ticks(_read(spark, schemas.TICK_TABLE, table, path))


def read_posts(spark: SparkSession, table: str | None = None, path: str | None = None) -> DataFrame:
    """Posts from a catalogue table or from the root folder of its partitions."""
    return typed_posts(_read(spark, schemas.POST_TABLE, table, path))


def _read(spark: SparkSession, schema: StructType, table: str | None, path: str | None) -> DataFrame:
    if (table is None) == (path is None):
        raise ValueError("give either a table or a path")
    return spark.table(table) if table else spark.read.schema(schema).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str = "ingestion_date") -> None:
    """Write one folder per day; days that are written again are replaced.

    The rebalance hint gives files of even size: a day with most of the rows is spread over several writers
    and small days share one.
    """
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(
        path
    )


# Fixed value: how times are written in CSV files, down to the microsecond.
CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV. A line that does not fit the schema fails the read instead of turning into NULLs."""
    options = {"header": True, "mode": "FAILFAST", "enforceSchema": False, "timestampFormat": CSV_TIME}
    return spark.read.schema(schema).options(**options).csv(path)


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    """Header CSV written by the executors. With ``by``, one folder per value of that column."""
    writer = (df.hint("rebalance", by) if by else df).write.mode("overwrite")
    writer = writer.options(header=True, timestampFormat=CSV_TIME)
    (writer.partitionBy(by) if by else writer).csv(path)
