"""Latest value of every key from a stream: a snapshot and the few batches landed after it.

Each micro-batch lands in a folder of its own, so a batch that is run again overwrites itself. Every so many batches they are
folded into a new snapshot. A snapshot counts from the moment an empty marker that names it appears: that is one file
creation, so a job that dies before leaves a folder that nobody reads, and one that dies after has lost nothing. A reader
opens the newest marker's snapshot and the batches after it: what it opens grows with the keys, never with the number
of batches. Each compaction removes what the one before it had replaced, so a reader that has opened
a table has as long as one whole compaction period to finish.

Layout: ``batches/batch_id=N``, ``snapshots/<upto>-<token>``, ``published/<upto>-<token>``.

Defined cases: a null key is a key; rows that tie in ``order`` are decided by their other columns; a batch that the published
snapshot has already is skipped; a batch that is missing (an empty one need not be landed) leaves a gap; an unpublished view
without batches is empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.sinks import upsert_latest

_DIGITS = 20


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing if it is not there."""
    files, at = _folder(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(at)) if files.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    files, at = _folder(spark, path)
    files.delete(at, True)


def published(spark: SparkSession, path: str) -> list[str]:
    """Names of the published snapshots, the newest last."""
    return names(spark, f"{path}/published")


def _upto(name: str) -> int:
    return int(name[:_DIGITS])


def _batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.removeprefix("batch_id=")) for name in names(spark, f"{path}/batches") if name.startswith("batch_id="))


def newest(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The row of every key that is last by ``order``, then by its other columns; combined before the shuffle."""
    rest = [c for c in rows.columns if c != key and c not in order]
    last = F.max(F.struct(*order, *rest)).alias("row")
    return rows.groupBy(key).agg(last).select(*[key if c == key else F.col(f"row.{c}").alias(c) for c in rows.columns])


def _opened(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of the newest published snapshot and of the batches after it; ``schema`` names batch_id too."""
    made = published(spark, path)
    upto = _upto(made[-1]) if made else -1
    after = [f"{path}/batches/batch_id={n}" for n in _batches(spark, path) if n > upto]
    rows = spark.read.schema(schema).parquet(f"{path}/snapshots/{made[-1]}") if made else spark.createDataFrame([], schema)
    if after:
        rows = rows.unionByName(spark.read.schema(schema).option("basePath", f"{path}/batches").parquet(*after))
    return rows


def read(spark: SparkSession, path: str, schema: StructType, key: str = "key", order: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """The newest row of every key. ``schema`` is that of the landed rows; batch_id says which batch a row came with."""
    return newest(_opened(spark, path, _with_batch(schema)), key, order)


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("batch_id", "long")


def compact(spark: SparkSession, path: str, schema: StructType, upto: int, key: str = "key", order: tuple[str, ...] = ("batch_id",)) -> None:
    """Write, publish, clean up. Safe to repeat from any point at which it died."""
    before = published(spark, path)
    name = f"{upto:0{_DIGITS}d}-{uuid.uuid4().hex}"
    read(spark, path, schema, key, order).write.parquet(f"{path}/snapshots/{name}")
    publish(spark, path, name)
    _clean(spark, path, keep={name, *before[-1:]}, upto=_upto(before[-1]) if before else -1)


def publish(spark: SparkSession, path: str, name: str) -> None:
    files, at = _folder(spark, f"{path}/published/{name}")
    files.create(at, False).close()


def _clean(spark: SparkSession, path: str, keep: set[str], upto: int) -> None:
    """Remove markers, then snapshots but those in ``keep``, and the batches that the older of the two has folded."""
    for part in ("published", "snapshots"):
        for name in names(spark, f"{path}/{part}"):
            if name not in keep:
                remove(spark, f"{path}/{part}/{name}")
    for n in _batches(spark, path):
        if n <= upto:
            remove(spark, f"{path}/batches/batch_id={n}")


def land(batch: DataFrame, batch_id: int, path: str, key: str = "key", order: tuple[str, ...] = ("batch_id",), every: int = 16) -> None:
    """For ``foreachBatch``: land the newest rows of one micro-batch; every so many batches fold them into a snapshot.

    One writer at a time, as a streaming query is. ``order`` is made of columns of the batch, or is its number.
    """
    spark, schema = batch.sparkSession, batch.schema
    made = published(spark, path)
    upto = _upto(made[-1]) if made else -1
    if batch_id <= upto:
        return
    within = tuple(c for c in order if c != "batch_id")
    upsert_latest(newest(batch, key, within), batch_id, f"{path}/batches")
    if len([n for n in _batches(spark, path) if upto < n <= batch_id]) >= every:
        compact(spark, path, schema, batch_id, key, order)
