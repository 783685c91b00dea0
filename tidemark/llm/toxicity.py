"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; every other text, labelled or not, is unlabelled. With the share of toxic texts
(the class prior) the risk of a classifier on positives and unlabelled texts estimates its risk on both classes:
prior * loss(positives as toxic) + [loss(unlabelled as clean) - prior * loss(positives as clean)]. The bracket is a risk,
so it can't be negative; where training drives it below zero, its gradient is undone instead of followed.

The classifier is logistic on which words, and which beginnings of words, a text has. It is trained on bounded samples of
positives and of unlabelled texts (``POSITIVES``, ``UNLABELLED``), drawn by a hash of the id: ids meet the labels alone, and
the few ids drawn go to the texts, which stay where they are. Candidates are the ``WORDS`` that most positives have;
numpy keeps those that positives have several times as often, and fits their weights. Every whole text is scored in
tasks.

Defined cases: null and empty texts have no words and get the score of the constant alone; without positives every score
is 0; labels without a document and documents without a label are no error; a document with several labels is toxic if one
says so; repeated rows are scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import texts_of
from tidemark.session import materialise

WORDS = 30_000
LIFT = 3.0  # a word counts if its share of the positives is that many times its share of the unlabelled
SURPRISE = 12.0  # and that unlikely by chance, as a logarithm
_BEGINNINGS = (4, 5, 6)  # letters
_FLUSH = 300_000
POSITIVES, UNLABELLED = 4_000, 8_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    """The distinct words of a text, in lower case, and beginnings of them (marked)."""
    found = set(_WORD.findall(text.lower()))
    return found.union(*[{"^" + w[:k] for w in found if len(w) > k} for k in _BEGINNINGS])


def fit(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, n_words: int, prior: float, rounds: int = 300, rate: float = 0.05, ridge: float = 1e-4) -> np.ndarray:
    """Weights of the words and a constant. ``rows`` and ``columns`` say which text has which word."""
    n = len(positive)
    rows, columns = np.concatenate([rows, np.arange(n)]), np.concatenate([columns, np.full(n, n_words)])
    weights, mean, square = np.zeros(n_words + 1), np.zeros(n_words + 1), np.zeros(n_words + 1)
    weights[-1] = np.log(prior / (1 - prior))
    p, u = positive, ~positive
    for turn in range(1, rounds + 1):
        toxic = 1 / (1 + np.exp(-np.bincount(rows, weights[columns], minlength=n)))
        as_clean = -np.log(np.maximum(1 - toxic, 1e-12))
        rest = as_clean[u].mean() - prior * as_clean[p].mean()
        slope = np.zeros(n)
        if rest >= 0:
            slope[p] = -prior * (1 - toxic[p]) / p.sum() - prior * toxic[p] / p.sum()
            slope[u] = toxic[u] / u.sum()
        else:
            slope[p] = prior * toxic[p] / p.sum()
            slope[u] = -toxic[u] / u.sum()
        gradient = np.bincount(columns, slope[rows], minlength=n_words + 1) + ridge * np.append(weights[:-1], 0)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        weights -= rate * mean / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    return weights


def _chosen(n: int, rows: int) -> Column:
    """About ``rows`` of ``n`` rows, by a hash of the id."""
    return F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, rows / max(n, 1))))


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None, n_words: int = WORDS, n_positive: int = POSITIVES, n_unlabelled: int = UNLABELLED) -> dict[str, float] | None:
    """Weight of each word ('' for the constant). ``prior``: share of toxic texts; by default their share of the labels."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = docs.select("doc_id").join(marks, "doc_id", "left").withColumn("positive", F.coalesce(F.col("toxic") == 1, F.lit(False)))
    sizes = marked.agg(*[F.count_if(x).alias(c) for c, x in (("p", F.col("positive")), ("u", ~F.col("positive")), ("known", F.col("toxic").isNotNull()))]).first()
    if not sizes["p"] or not sizes["u"]:
        return None
    prior = prior if prior is not None else min(max(sizes["p"] / sizes["known"], 1e-3), 0.9)
    drawn = F.when(F.col("positive"), _chosen(sizes["p"], n_positive)).otherwise(_chosen(sizes["u"], n_unlabelled))
    ids = materialise(marked.where(drawn).where("doc_id is not null").select("doc_id", "positive").distinct(), "training-ids")
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # about n_positive + n_unlabelled ids

    def each_word(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: Counter[str] = Counter()
        for batch in batches:
            for t in texts_of(batch):
                seen.update(words(t))
                if len(seen) > _FLUSH:
                    yield pa.RecordBatch.from_pydict({"word": list(seen), "n": pa.array(seen.values(), pa.int64())})
                    seen.clear()
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(seen.values(), pa.int64())})

    common = sample.where("positive").select("text").mapInArrow(each_word, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    listed = [r["word"] for r in common.where("n > 2").orderBy(F.desc("n"), "word").limit(n_words).collect()]
    place = {w: i for i, w in enumerate(listed)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def which(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            lists = [sorted(shared.value[w] for w in words(t) if w in shared.value) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("positive"), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "positive", "found"])

    rows = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "positive", "text")
    got = rows.mapInArrow(which, "doc_id long, positive boolean, found array<int>").toArrow().sort_by([("positive", "ascending"), ("doc_id", "ascending")])
    positive = got["positive"].to_numpy()
    if positive.all() or not positive.any():
        return None
    found = [x.as_py() for x in got["found"]]
    rows, columns = np.repeat(np.arange(len(found)), [len(x) for x in found]), np.array([i for x in found for i in x], dtype=np.int64)
    toxic, other = (np.bincount(columns[positive[rows] == x], minlength=len(listed)) for x in (True, False))
    expected = np.maximum((toxic + other) * positive.mean(), 1e-9)
    surprise = toxic * np.log(np.maximum(toxic, 1) / expected) - (toxic - expected)  # log likelihood ratio of the count
    often = toxic * (~positive).sum() > LIFT * (other + 1) * positive.sum()
    tells = np.flatnonzero(often & (surprise > SURPRISE))
    kept = np.isin(columns, tells)
    weights = fit(rows[kept], np.searchsorted(tells, columns[kept]), positive, len(tells), prior)
    return {**dict(zip([listed[i] for i in tells], weights[:-1].tolist(), strict=True)), "": float(weights[-1])}


def score(docs: DataFrame, weights: dict[str, float] | None, *keep: Column | str) -> DataFrame:
    """The columns ``keep`` of ``docs`` with score, from the column ``text`` alone."""
    rows = docs.select(F.struct(*keep).alias("kept"), "text")
    if weights is None:
        return rows.select("kept.*", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def measure(batches: Iterator) -> Iterator:
        import math

        import pyarrow as pa

        known = shared.value
        base = known[""]
        for batch in batches:
            sums = [base + math.fsum([known[w] for w in words(t) if w in known]) for t in texts_of(batch)]
            scores = [1 / (1 + math.exp(-min(max(x, -500.0), 500.0))) for x in sums]
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(scores, pa.float64())], ["kept", "score"])

    return rows.mapInArrow(measure, f"kept {rows.schema['kept'].dataType.simpleString()}, score double").select("kept.*", "score")
