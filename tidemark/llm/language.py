"""Language identification in two levels: the family first, then the language within it.

Texts become hashed counts of one to three letters in a row, over the whole text. Linear support vector machines tell
families apart (one against the rest), and one-versus-one machines the languages of the family that won. All are
trained here, by dual coordinate descent, on a sample of labelled rows whose size is bounded (``SAMPLE`` rows in all,
as many of each language); rows enter it by a hash of their id, and the whole text of each is used.

Defined cases: null text, or text without a letter, is ``und`` with score 0; a language outside ``FAMILIES`` is a family of
its own; without labelled rows every text is ``und``; with one language every other text is of it; repeated rows
are predicted alike; an empty table gives an empty result; other columns are kept by ``identify``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import texts_of
from tidemark.session import materialise

SAMPLE = 6_000
_BITS = 12
_DIMENSIONS = 1 << _BITS
_LETTER = re.compile(r"[^\W\d_]")

#: Families of ISO 639-1 codes.
FAMILIES = {
    "germanic": "en de nl sv da no is af lb".split(),
    "romance": "fr es it pt ro ca gl".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz".split(),
    "indic": "hi bn ur mr gu pa ne".split(),
}


def features(text: str) -> np.ndarray:
    """Square roots of hashed 1- to 3-gram counts of letters in lower case, scaled to length one, and a constant."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    other = (codes < 97) | (codes > 122) & (codes < 192)
    codes = np.where(other, np.uint32(32), codes)
    codes = np.concatenate([[np.uint32(32)], codes[~(other & np.roll(other, 1))], [np.uint32(32)]]).astype(np.uint32)
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ codes[1:]) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ codes[2:]) * np.uint32(0xC2B2AE35)
    counts = np.zeros(_DIMENSIONS)
    for grams in (one, two, three):
        counts += np.bincount(grams >> np.uint32(32 - _BITS), minlength=_DIMENSIONS)
    root = np.sqrt(counts)
    return np.append(root / max(float(np.sqrt(root @ root)), 1e-9), 1.0).astype(np.float32)


def train_svm(rows: np.ndarray, signs: np.ndarray, cost: float = 10.0, rounds: int = 15) -> np.ndarray:
    """Weights of an L2-loss linear support vector machine; both classes weigh the same."""
    share = np.where(signs > 0, (signs > 0).mean(), (signs < 0).mean())
    ridge = 2 * share / cost  # 1 / (2 C) with C shared out by class
    weights, duals = np.zeros(rows.shape[1]), np.zeros(len(rows))
    curve = np.einsum("ij,ij->i", rows, rows).astype(float) + ridge  # no copy of the rows: the driver's memory is small
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            slope = signs[i] * (rows[i] @ weights) - 1 + ridge[i] * duals[i]
            new = max(duals[i] - slope / curve[i], 0.0)
            if new != duals[i]:
                weights += (new - duals[i]) * signs[i] * rows[i]
                duals[i] = new
    return weights


class Model:
    """Families in order, their machines, and the pairs of languages within each."""

    def __init__(self, rows: np.ndarray, languages: np.ndarray):
        home = {x: family for family, members in FAMILIES.items() for x in members}
        of = np.array([home.get(x, x) for x in languages])
        self.families = sorted(set(of))
        self.members = {f: sorted(set(languages[of == f])) for f in self.families}
        self.weights: list[np.ndarray] = []
        self.at: dict[tuple, int] = {}
        if len(self.families) > 1:
            for f in self.families[: 1 if len(self.families) == 2 else None]:
                self._add((f,), rows, np.where(of == f, 1.0, -1.0))
        for members in self.members.values():
            for a, b in combinations(members, 2):
                pair = (languages == a) | (languages == b)
                self._add((a, b), rows[pair], np.where(languages[pair] == a, 1.0, -1.0))
        self.matrix = np.array(self.weights, dtype=np.float32).reshape(-1, _DIMENSIONS + 1)

    def _add(self, key: tuple, rows: np.ndarray, signs: np.ndarray) -> None:
        self.at[key] = len(self.weights)
        self.weights.append(train_svm(rows, signs))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not _LETTER.search(text):
            return "und", 0.0
        sure = 1 / (1 + np.exp(-4.0 * (self.matrix @ features(text)))) if len(self.matrix) else np.zeros(0)
        if len(self.families) == 1:
            family, score = self.families[0], 1.0
        elif len(self.families) == 2:
            first = float(sure[self.at[self.families[0],]])
            family, score = (self.families[0], first) if first >= 0.5 else (self.families[1], 1 - first)
        else:
            each = [float(sure[self.at[f,]]) for f in self.families]
            best = int(np.argmax(each))
            family, score = self.families[best], each[best]
        members = self.members[family]
        if len(members) == 1:
            return members[0], score
        votes, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for a, b in combinations(members, 2):
            p = float(sure[self.at[a, b]])
            votes[a if p >= 0.5 else b] += 1
            sums[a] += p
            sums[b] += 1 - p
        winner = max(members, key=lambda x: (votes[x], sums[x], x))
        return winner, score * sums[winner] / (len(members) - 1)


def sample(docs: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """About ``rows`` rows of ``docs`` (doc_id, text, lang), as many of each language, chosen by a hash of id and text.

    Languages are few by nature (a row each), so their shares go to every task.
    """
    known = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = materialise(known.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    chance = sizes.select("lang", (F.lit(rows / max(sizes.count(), 1)) / F.col("n")).alias("chance"))
    place = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return known.join(F.broadcast(chance), "lang").where(place < F.col("chance")).select("doc_id", "text", "lang")


def train(docs: DataFrame, rows: int = SAMPLE) -> Model:
    """A model from labelled ``docs``; the features of at most about ``rows`` texts come to the driver."""

    def make(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kept = [(doc, lang, features(t).astype(np.float16).tobytes()) for doc, lang, t in zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), texts_of(batch), strict=True) if _LETTER.search(t)]
            if kept:
                ids, langs, data = zip(*kept, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs), pa.array(data, pa.binary())], ["doc_id", "lang", "data"])

    got = sample(docs, rows).mapInArrow(make, "doc_id long, lang string, data binary").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    languages = np.array(got["lang"].to_pylist(), dtype=object)
    data = np.empty((got.num_rows, _DIMENSIONS + 1), dtype=np.float32)
    for i, row in enumerate(got["data"]):
        data[i] = np.frombuffer(row.as_buffer(), dtype=np.float16)
    return Model(data, languages)


def identify(docs: DataFrame, model: Model, *keep: Column | str) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score, from the column ``text`` alone.

    Only texts go to the workers and only predictions come back; the other columns wait in the JVM.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts):
        import pyarrow as pa

        found = [shared.value.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([float(s) for _, s in found], pa.float64())], ["lang_pred", "score"])

    # Declared non-deterministic so that a filter on the prediction isn't pushed below it, which would predict twice.
    predicted = F.arrow_udf(predict, "lang_pred string, score double").asNondeterministic()
    rows = docs.select(F.struct(*keep).alias("kept"), predicted(F.col("text")).alias("found"))
    return rows.select("kept.*", "found.lang_pred", "found.score")
