"""Ticks, posts and a lexicon made from the sample tables (`events`, `documents`, `embeddings`, `labels`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.vectors import normalised
from tidemark.session import configure

# Sample lexicon, word and weight in tenths.
LEXICON = """
estion 8, ndtion -7, ingor 5, esing -5, ntble 3, oution -3, onbleea 1, thintion -9,
inging 8, nttion -7, ersch 5, ingha -5, ingan 3, onouor -3, ortion 1, ening -9,
onesnt 8, thndly -7, nding 5, oring -5, tionen 3, eation -3, ingnt 1, onlyhe -9,
sting 8, erreth -7, queque 5, thrent -5, thtionnt 3, enein -3, enlich 1, ensch -9,
mente 8, reedes -7, enver 5, stble -5, tionre 3, whtion -3, bleti 1, eable -9,
eaing 8, enble -7, ingsh 5, sttion -5, thshing 3, tiontion -3, thedre 1, enheit -9,
erntth 8, erung -7, tionan 5, chver -5, enung 3, esndha -3, orble 1, thhent -9,
tible 8, tionha -7, atshsh 5, bleble -5, idiot -8, worthless -8, stupid -8
"""
# Stop words, rows known to be bad, and words kept from the top list.
STOPWORDS = "the of and to a in is that it for was on with be by as this are at from"
BAD_IDS = (7, 77, 177)
ALLOWED_WORDS = ("en", "the", "le", "ing", "un", "er", "os", "re", "de", "la", "und", "der")


def lexicon_rows() -> list[tuple[str, int]]:
    pairs = [entry.split() for entry in LEXICON.replace("\n", " ").split(",")]
    return [(word, int(weight)) for word, weight in pairs]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_type").alias("s"),
        F.col("value").alias("p"),
        F.col("ts").alias("t"),
        F.lit(1.0).alias("v"),
        F.col("ts").cast("date").alias("ingestion_date"),
        "event_id",
    )


def dated(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a ``doc_id`` and ``created_at``: the time of the event that the document is tied to."""
    when = events(spark, sf_dir).select("event_id", F.col("ts").alias("created_at"))
    return rows.join(when, F.col("doc_id") * 5 == F.col("event_id")).drop("event_id")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, dated."""
    return dated(documents(spark, sf_dir).select("doc_id", "text", "source"), spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("id"),
        "text",
        "created_at",
        "source",
        F.col("created_at").cast("date").alias("ingestion_date"),
        "doc_id",
    )


def _inline(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    # Inline VALUES, not a parallelised list: the optimiser then knows how small the table is.
    return configure(spark).sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


def lexicon(spark: SparkSession) -> DataFrame:
    return _inline(spark, ", ".join(f"('{w}', {weight})" for w, weight in lexicon_rows()), "w, pol10")


def stopwords(spark: SparkSession) -> DataFrame:
    return _inline(spark, ", ".join(f"('{w}')" for w in STOPWORDS.split()), "w")


def bad_ids(spark: SparkSession) -> DataFrame:
    return _inline(spark, ", ".join(f"({i}L)" for i in BAD_IDS), "doc_id")


def class_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two three-class probability arrays per embedding."""
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("window_id"),
        normalised(F.slice("embedding", 1, 3)).alias("prob_stock"),
        normalised(F.slice("embedding", 4, 3)).alias("prob_posts"),
    )
