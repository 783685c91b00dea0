"""Corpus pipeline: the stages one after the other over the documents table.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame; all but the last
return the columns of documents. ``run`` writes each result to the shared folder and reads it again, so a lost executor
costs a stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import fuzzy_lines, language, packing, simhash, winnowing
from tidemark.llm.shared import held_out, table
from tidemark.session import materialise

LEAST_SCORE = 0.25  # language: a text less sure than that is rejected


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter, or that no language fits, go. ``lang`` stays what it was."""
    model = language.train(docs.where(~held_out(F.col("doc_id"))))
    found = language.identify(docs, model, *docs.columns)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each component of similar lines stays; documents that lose every line go. n_chars follows the text."""
    cleaned = fuzzy_lines.remove_repeated(docs)
    left = cleaned.where((F.col("n_removed") == 0) | (F.trim("text") != "")).select(*docs.columns, "n_removed")
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("long")
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def deduplicate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints (four-word shingles, four or fewer of 64 bits apart) stays."""
    return simhash.deduplicate(docs, words_in_shingle=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their place in sequences of 1,024 tokens."""
    return packing.pack(packing.cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language identification", identify_language),
    ("line deduplication", deduplicate_lines),
    ("SimHash near-duplicates", deduplicate_documents),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

#: Trained models, similar lines and token ids have no SQL; tests/llm checks each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
