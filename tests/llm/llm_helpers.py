"""Small tables for the tests of this folder."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, lang="en", extra: bool = False):
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # names that operators use themselves
        for name in ("id", "digest", "words", "n", "key", "fingerprint", "component", "start", "length", "score", "row", "line", "cell"):
            df = df.withColumn(name, df["doc_id"])
    return df


def prose(rng, n: int) -> str:
    """Words of a small invented language, most of them rare."""
    return " ".join("".join(rng.choice(("ta", "ke", "lo", "mir", "san", "du", "vel", "or")) for _ in range(rng.randint(1, 4))) for _ in range(n))


ODD = [None, "", "   \n\t ", "a", "a a a a", "é É ß 日本語 テキスト", "x" * 5000, "\n\n\n", "one\ntwo\none\ntwo", "<|endoftext|> and <|ENDOFTEXT|>"]
