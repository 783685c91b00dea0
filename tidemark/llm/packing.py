"""Pack documents into sequences of a fixed number of tokens.

A document is cut into full pieces and a remainder; a remainder over half a sequence is cut once more at the half, as
pieces above the half can't stand beside each other and would force padding. The histogram of lengths (at most as many rows as a
sequence has tokens) goes to the driver, where column generation (``cutting_stock``) makes a plan of patterns. Each
pattern takes a range of ranks of each length, so a document finds its place from its rank among the documents of the
same length, with one broadcast look-up of a table bounded by the sequence length. Ranks come from two levels of counts,
so a length that a third of all documents share is still ranked in pieces.

Defined cases: null text is empty and has the end id alone; repeated ids and texts are documents of their own; an
empty table packs into nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import cutting_stock, tokens
from tidemark.llm.shared import texts_of
from tidemark.session import materialise

SEQUENCE = 1024
_RANKED_TOGETHER = 20_000
PIECES = "doc_row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, size: int = SEQUENCE) -> DataFrame:
    """Pieces of ``size`` tokens, half of it, or what is left of a document, with the checksum of their ids."""
    definition = tokens.definition_of(tokenizer_path)

    def cut(batches: Iterator) -> Iterator:
        import struct
        import zlib

        import pyarrow as pa

        encoder, end = tokens.encoder(definition, "spaces"), struct.pack("<I", end_id)
        row = TaskContext.get().partitionId() << 36
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for doc_id, text in zip(ids, texts_of(batch), strict=True):
                data = encoder.encode(text) + end
                total = len(data) // 4
                ends = [*range(size, total + 1, size), total]
                if total % size > size // 2:
                    ends.insert(-1, total // size * size + size // 2)
                start = 0
                for stop in ends:
                    if stop > start:
                        rows.append((row, doc_id, start, stop - start, zlib.crc32(data[4 * start : 4 * stop]), total))
                    start = stop
                row += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` (written, doc_row and start unique) with their rank among those of the same length."""
    groups = -(-pieces.count() // _RANKED_TOGETHER) or 1
    dealt = pieces.withColumn("deal", F.pmod(F.xxhash64("doc_row", "start"), F.lit(groups)))
    sizes = dealt.groupBy("length", "deal").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "deal", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "deal").orderBy("doc_id", "doc_row", "start")
    numbered = dealt.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(first, ["length", "deal"]).withColumn("rank", F.col("first") + F.col("place")).drop("deal", "first", "place")


def places(histogram: dict[int, int], size: int, **options) -> list[tuple[int, int, int, int, int, int]]:
    """length, first rank, end rank, copies in a sequence, first sequence, offset of the first copy."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for times, pattern in cutting_stock.plan(histogram, size, **options):
        offset = 0
        for length, copies in pattern:
            rank = used.get(length, 0)
            used[length] = rank + times * copies
            out.append((length, rank, used[length], copies, sequence, offset))
            offset += length * copies
        sequence += times
    return out


def pack(pieces: DataFrame, size: int = SEQUENCE, **options) -> DataFrame:
    """Adds sequence_id and offset to pieces of at most ``size`` tokens (doc_row, doc_id, start, length, ...).

    ``options`` go to the plan: ``gap``, how near to the optimum the linear program goes, and ``rounds`` at most.
    """
    spark = pieces.sparkSession
    pieces = materialise(pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    schema = "length long, first long, end long, copies long, first_sequence long, at long"
    plan = F.broadcast(spark.createDataFrame(places(histogram, size, **options), schema))  # bounded by `size` patterns
    local = F.col("rank") - F.col("first")
    found = ranked(pieces).join(plan, "length").where(F.col("rank").between(F.col("first"), F.col("end") - 1))
    return found.select(
        *[c for c in pieces.columns if c != "doc_row"],
        (F.col("first_sequence") + F.floor(local / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + local % F.col("copies") * F.col("length")).cast("long").alias("offset"),
    )
