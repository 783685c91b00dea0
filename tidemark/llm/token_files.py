"""A store of token ids: Parquet files with one list column, in ascending document order.

Ids are dictionary encoded (a vocabulary fits one dictionary, so an id takes 16 bits or fewer before compression),
the metadata columns are plain or delta encoded. Row groups and pages are kept small by parameters, and Parquet's page
indexes come with them, so a reader that asks for some documents, or only for counts, touches few pages.

Documents are dealt by range of id and sorted within a file. ``first`` is the position inside the file, written with
the ids; the position in the whole corpus adds the totals of the files before, read from metadata columns alone.

Defined cases: null text is empty and has the end id alone; rows with equal ids stand side by side, ordered by
text; a null id comes first; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.shared import parallelism, texts_of

ROWS = "part int, doc_id long, first long, n_tokens int, ids array<int>"
_BATCH = 2_000_000  # ids handed to the writer at once


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, row_group: int = 32 << 20, page: int = 256 << 10, page_rows: int = 5_000) -> None:
    """Encode ``docs`` (doc_id, text) and write the store to ``path``. Sizes in bytes; ``page_rows`` bounds a page's rows."""
    definition = tokens.definition_of(tokenizer_path)

    def encode(batches: Iterator) -> Iterator:
        import struct

        import numpy as np
        import pyarrow as pa

        encoder, end = tokens.encoder(definition, "white space"), struct.pack("<I", end_id)
        part, first = TaskContext.get().partitionId(), 0
        names = [x.split()[0] for x in ROWS.split(", ")]

        def made(ids, data):
            nonlocal first
            sizes = np.array([len(x) // 4 for x in data], dtype=np.int64)
            ends = np.concatenate([[0], sizes.cumsum()])
            values = pa.array(np.frombuffer(b"".join(data), dtype="<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            arrays = [pa.array([part] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(first + ends[:-1]), pa.array(sizes, pa.int32()), lists]
            first += int(ends[-1])
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            ids, data, held = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                ids.append(doc_id)
                data.append(encoder.encode(text) + end)
                held += len(data[-1]) // 4
                if held > _BATCH:
                    yield made(ids, data)
                    ids, data, held = [], [], 0
            if ids:
                yield made(ids, data)

    spread = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parallelism(docs.sparkSession), "doc_id")
    rows = spread.sortWithinPartitions("doc_id", "text").mapInArrow(encode, ROWS)
    writer = rows.write.option("compression", "zstd").option("parquet.enable.dictionary", "true").option("parquet.writer.version", "v2")
    writer = writer.option("parquet.block.size", row_group).option("parquet.page.size", page).option("parquet.page.row.count.limit", page_rows)
    writer.option("parquet.dictionary.page.size", 1 << 20).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document with its ids; filters on doc_id and column choice reach the files."""
    return spark.read.schema(ROWS).parquet(path)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start in the corpus, n_tokens, without reading ids."""
    rows = read_tokens(spark, path).select("part", "doc_id", "first", "n_tokens")
    return rows.join(_offsets(rows), "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens")


def _offsets(rows: DataFrame) -> DataFrame:
    """Ids in the files before each file: one row per file, counted in two levels."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("hundred", F.expr("part div 100"))
    ahead = Window.partitionBy("hundred").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = totals.select("part", "hundred", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("within"))
    hundreds = totals.groupBy("hundred").agg(F.sum("n").alias("n"))
    ordered = Window.orderBy("hundred").rowsBetween(Window.unboundedPreceding, -1)  # a row per hundred files
    base = hundreds.select("hundred", F.coalesce(F.sum("n").over(ordered), F.lit(0)).alias("base"))
    return within.join(base, "hundred").select("part", (F.col("within") + F.col("base")).alias("before"))


def checked(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def check(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        for batch in batches:
            lists = batch.column("ids")
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(x) for x in ("part", "doc_id", "first", "n_tokens")], pa.array(sums, pa.int64())], ["part", "doc_id", "first", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).mapInArrow(check, "part int, doc_id long, first long, n_tokens int, ids_crc32 long")
    offsets = F.broadcast(_offsets(read_tokens(spark, path)))  # a row per file of the store
    return rows.join(offsets, "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
