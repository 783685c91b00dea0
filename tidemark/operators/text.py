"""Tokens, lexicon polarity and term counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a token is a run of letters, digits and underscores in any script.
TOKEN = r"[\p{L}\p{N}_]+"


def token_array(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def tokens(df: DataFrame, text: str = "text", keep: Iterable[str] = ("id",), lower: bool = True) -> DataFrame:
    """One row per token with its position."""
    source = F.lower(text) if lower else F.col(text)
    return df.select(*keep, F.posexplode(token_array(source)).alias("position", "token"))


def polarity(posts: DataFrame, lexicon: DataFrame, text: str = "text", keep: Iterable[str] = ("id",)) -> DataFrame:
    """Lexicon totals per post, equal posts merged.

    ``lexicon`` has one row per word: ``w`` and its weight in tenths ``pol10``. Rows that agree in the ``keep``
    columns and in their text become one, ``copies`` counts them, and the totals are those of one copy. Each post
    is tokenised where it lies; only its totals are shuffled, with 128 bits of hash for the text. Catalyst
    broadcasts the lexicon while its size allows and joins by shuffle beyond.
    """
    keep = list(keep)
    same_text = ["text_hash", "text_hash_2"]
    # Hashed before the tokens are laid out: in the same select it would be done for every token.
    hashed = posts.withColumns({"text_hash": F.xxhash64(text), "text_hash_2": F.xxhash64(F.lit(1), text)})
    words = hashed.select(*keep, *same_text, F.posexplode_outer(token_array(F.lower(text))).alias("position", "w"))
    first = F.col("position").isNull() | (F.col("position") == 0)
    totals = (
        words.join(lexicon.select("w", "pol10"), "w", "left")
        .groupBy(*keep, *same_text)
        .agg(
            F.count_if(first).alias("copies"),
            F.count("w").alias("n_tokens"),
            F.count("pol10").alias("hits"),
            F.coalesce(F.sum("pol10"), F.lit(0)).cast("bigint").alias("sum10"),
            F.count_if(F.col("pol10") > 0).alias("pos_hits"),
            F.count_if(F.col("pol10") < 0).alias("neg_hits"),
        )
    )
    per_copy = ["n_tokens", "hits", "sum10", "pos_hits", "neg_hits"]
    return totals.select(*keep, "copies", *[F.expr(f"{c} DIV copies").alias(c) for c in per_copy])


def polarity_share() -> Column:
    """The second score: share of positive minus share of negative tokens."""
    balance = F.col("pos_hits") - F.col("neg_hits")
    return F.when(F.col("n_tokens") > 0, balance / F.col("n_tokens")).otherwise(F.lit(0.0))


def content_digest(text: str = "text") -> Column:
    """Stands in for a text where only its equality matters, so that long texts stay out of shuffles."""
    return F.sha2(F.col(text), 256)


def term_counts(df: DataFrame, stopwords: DataFrame, text: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """Lower-cased tokens with their counts, per ``keep``.

    Stop words are matched before lower-casing: a capitalised one stays in. ``stopwords`` has the column ``w``.
    """
    return (
        df.select(*keep, F.explode(token_array(F.col(text))).alias("w"))
        .join(stopwords.select("w"), "w", "left_anti")
        .groupBy(*keep, F.lower("w").alias("term"))
        .agg(F.count("*").alias("n"))
    )


def top(counts: DataFrame, k: int = 100) -> DataFrame:
    return counts.orderBy(F.desc("n"), "term").limit(k)


def top_terms(df: DataFrame, stopwords: DataFrame, text: str = "text", k: int = 100) -> DataFrame:
    return top(term_counts(df, stopwords, text), k)


def allowed_terms(top: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """Keep chosen words of a finished top list; the list is cut first."""
    return top.where(F.col("term").isin(*allowed))
