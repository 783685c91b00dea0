"""Tables laid out by a key, so that what is joined or grouped by it again and again meets without a shuffle.

Windows, split indices and both models' probabilities share ``window_id`` and are joined by each evaluation. Written in
buckets of that key, a join of any two of them reads bucket beside bucket; what is left is a sort inside each bucket, over
rows that are in order already (Spark doesn't rely on the order of files). All tables of one family need the same number of buckets: choose it for the largest of them, so that a bucket fits a task. The key should
be one that few rows share; a bucket isn't split when the table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None, mode: str = "error") -> DataFrame:
    """Save rows as ``table`` in ``buckets`` by ``key``, each sorted and in one file; the table, as :func:`read` gives it.

    The rows are dealt to the buckets here, once. ``path`` names the folder of an external table; without it the table
    belongs to the warehouse. Rows without a key are kept, in one bucket. ``mode`` is that of Spark's writer (``error``: a table of
    that name must not exist). Appending adds a file to each bucket.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    writer = df.repartition(buckets, F.col(key)).write.format("parquet").mode(mode).bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return read(df.sparkSession, table, key, buckets)


def read(spark: SparkSession, table: str, key: str, buckets: int) -> DataFrame:
    """The table, if it is laid out in ``buckets`` by ``key``; another layout would join rightly, but with a shuffle."""
    found = layout(spark, table)
    if found != (key, buckets):
        raise ValueError(f"{table} is laid out by {found}, not by {(key, buckets)}")
    return spark.table(table)


def layout(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """Key and number of buckets of a table; None if it has none, or several keys."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    keys = facts.get("Bucket Columns", "[]").strip("[]").replace("`", "").split(", ")
    if "Num Buckets" not in facts or len(keys) != 1:
        return None
    return keys[0], int(facts["Num Buckets"])


def drop(spark: SparkSession, *tables: str) -> None:
    """Forget tables; the files of external ones stay."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
