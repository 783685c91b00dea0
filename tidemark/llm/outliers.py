"""Quality rules: plain limits, then robust multivariate outliers, in DataFrame operations alone.

Four statistics of a text are put on scales of their own: the logarithm of the mean word length, and the shares of
symbols, of repeated lines and of words in repeated windows, each divided by the least spread that counts (``SPREAD``).
For each language and source, minimum-covariance-determinant estimates give a centre and a covariance that outliers
can't move: concentration steps keep the nearest six tenths and estimate again, from two starts (all rows; medians
and median deviations), the one with the smaller determinant going on. A reweighting step follows. Texts whose squared
Mahalanobis distance is beyond the chi-squared quantile are rejected.

A concentration step is one aggregation: counts, sums and products by group and band of distance, so a group that holds
a third of all rows is added up before the shuffle, and the nearest rows are found among a few hundred bands. Statistics
are whole numbers, so sums don't depend on the order of rows. Groups with fewer than ``LEAST_GROUP`` rows are pooled by
language, and pools that stay small in one pool over all languages.

Defined cases: null text has no words and fails the limits; null language or source is a group of its own; repeated rows
count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

SPREAD = {"length": 0.05, "symbols": 0.01, "lines": 0.05, "repeats": 0.05}
SHARE = 0.6  # of a group, kept in a concentration step
TAIL = 1e-3  # of clean texts, beyond the limit if they were normal
LEAST_GROUP = 50
_P = len(SPREAD)
_UNIT = 64  # statistics are counted in such parts of their spread
_BANDS = 64  # bands of distance in a factor of e
_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]
_NOT_SPACE = "[^\\x20\\x09-\\x0D]"


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of whole texts (doc_id, text, lang, source)."""
    rows = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), ""))
    rows = rows.withColumn("lines", F.expr(f"filter(split(text, '\\n'), x -> x rlike '{_NOT_SPACE}')".replace("\\x", "\\\\x")))
    rows = rows.withColumn("n", F.size("words"))
    window = "xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))"
    rows = rows.withColumn("windows", F.expr(f"if(n >= 3, transform(sequence(0, n - 3), i -> {window}), cast(array() as array<bigint>))"))
    rows = rows.withColumn("ordered", F.sort_array("windows"))
    rows = rows.withColumn("twice", F.expr("array_distinct(filter(ordered, (x, i) -> x = get(ordered, i - 1)))"))
    # few repeated windows: look each window up; many: sort windows with their places, and take those with an equal neighbour
    few = "filter(transform(windows, (x, i) -> if(array_contains(twice, x), i, -1)), x -> x >= 0)"
    pairs = "sort_array(transform(windows, (x, i) -> struct(x as x, i as i)))"
    many = "transform(filter(pairs, (p, j) -> p.x = get(pairs, j - 1).x or p.x = get(pairs, j + 1).x), p -> p.i)"
    rows = rows.withColumn("pairs", F.expr(f"if(size(twice) > 32, {pairs}, null)"))
    rows = rows.withColumn("places", F.expr(f"case when size(twice) = 0 then cast(array() as array<int>) when size(twice) > 32 then {many} else {few} end"))
    covered = F.size(F.expr("array_distinct(flatten(transform(places, i -> array(i, i + 1, i + 2))))"))
    symbols = F.char_length("text") - F.char_length(F.regexp_replace("text", "[#*$%&|<>]+", ""))
    return rows.select(
        "doc_id",
        "lang",
        "source",
        F.col("n").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def _measured(stats: DataFrame, spread: dict[str, float]) -> DataFrame:
    """Adds base_failed and the statistics u0, u1, ... as whole numbers."""
    n = F.greatest("n_words", F.lit(1))
    share = {
        "length": F.log(F.greatest(F.col("word_chars") / n, F.lit(1.0))),
        "symbols": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "lines": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
    }
    units = [F.round(share[name] * (_UNIT / least)).cast("long").alias(f"u{i}") for i, (name, least) in enumerate(spread.items())]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.select("*", failed.alias("base_failed"), *units)


def _grouped(rows: DataFrame, least_group: int) -> DataFrame:
    """Adds ``cell``: language and source, or the pool that stands for them."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    rows = rows.withColumn("fine", F.concat_ws("\1", name("lang"), name("source")))
    sizes = rows.where("not base_failed").groupBy("lang", "fine").agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("lang")
    small = F.col("n") < least_group
    pooled = sizes.withColumn("pool", F.sum(F.when(small, F.col("n")).otherwise(0)).over(by_lang))
    cell = F.when(~small, F.col("fine")).when(F.col("pool") >= least_group, F.concat(F.lit("pool"), name("lang"))).otherwise("rest")
    return rows.join(pooled.select("fine", cell.alias("cell")), "fine", "left").drop("fine").fillna("rest", ["cell"])


def _triangle(moments: DataFrame, factor: float) -> DataFrame:
    """cell, centre c0.., Cholesky factor l00.. of ``factor`` times the covariance plus one spread on the diagonal, log_det."""
    at = moments
    for i, j in _PAIRS:
        covariance = (F.col(f"p{i}{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n")) * (factor / _UNIT**2)
        at = at.withColumn(f"v{i}{j}", covariance + F.lit(float(i == j)))
    for i, j in _PAIRS:
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"v{i}{j}"))
        at = at.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"))
    log_det = reduce(lambda a, i: a + F.log(f"l{i}{i}"), range(_P), F.lit(0.0)).alias("log_det")
    centre = [(F.col(f"s{i}") / F.col("n") / _UNIT).alias(f"c{i}") for i in range(_P)]
    return at.select("cell", *centre, *[f"l{i}{j}" for i, j in _PAIRS], log_det)


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds the squared distance d2 from the cell's centre, by forward substitution."""
    at = rows.join(estimates, "cell", "left")
    for i in range(_P):
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"y{k}"), range(i), F.col(f"u{i}") / _UNIT - F.col(f"c{i}"))
        at = at.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    total = reduce(lambda a, i: a + F.col(f"y{i}") * F.col(f"y{i}"), range(_P), F.lit(0.0))
    return at.select(*rows.columns, total.alias("d2"))


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), *[F.sum(f"u{i}").alias(f"s{i}") for i in range(_P)], *[F.sum(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"p{i}{j}") for i, j in _PAIRS]]


_SUMMED = ["n", *[f"s{i}" for i in range(_P)], *[f"p{i}{j}" for i, j in _PAIRS]]


def _concentrate(rows: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """Estimates from the nearest ``share`` of each cell."""
    band = F.floor(F.log1p("d2") * _BANDS).alias("band")
    bands = _with_distance(rows, estimates).groupBy("cell", band).agg(*_sums())
    every = Window.partitionBy("cell")
    before = F.coalesce(F.sum("n").over(every.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = bands.withColumn("before", before).withColumn("total", F.sum("n").over(every)).where(F.col("before") < share * F.col("total"))
    moments = near.groupBy("cell").agg(*[F.sum(c).alias(c) for c in _SUMMED])
    return materialise(_triangle(moments, _consistency(share)), "estimates")


def _starts(rows: DataFrame) -> list[DataFrame]:
    """Moments of all rows; medians with median deviations in place of them."""
    middle = rows.groupBy("cell").agg(*[F.percentile(f"u{i}", 0.5).alias(f"e{i}") for i in range(_P)])  # whole numbers: few distinct values
    off = rows.join(middle, "cell").groupBy("cell").agg(*[F.first(f"e{i}").alias(f"e{i}") for i in range(_P)], *[F.percentile(F.abs(F.col(f"u{i}") - F.col(f"e{i}")), 0.5).alias(f"m{i}") for i in range(_P)])
    sums = [F.col(f"e{i}").alias(f"s{i}") for i in range(_P)]
    products = [(F.col(f"e{i}") * F.col(f"e{j}") + (F.pow(1.4826 * F.col(f"m{i}"), F.lit(2)) if i == j else F.lit(0.0))).alias(f"p{i}{j}") for i, j in _PAIRS]
    robust = off.select("cell", F.lit(1).alias("n"), *sums, *products)
    plain = rows.groupBy("cell").agg(*_sums())
    return [materialise(_triangle(x, 1.0), "estimates") for x in (plain, robust)]


def estimate(rows: DataFrame, share: float = SHARE, first_steps: int = 2, steps: int = 4) -> DataFrame:
    """Reweighted estimates of every cell of ``rows`` (cell, u0, u1, ...)."""
    candidates = []
    for start in _starts(rows):
        for _ in range(first_steps):
            start = _concentrate(rows, start, share)
        candidates.append(start)
    both = candidates[0].union(candidates[1])
    best = both.groupBy("cell").agg(F.min_by(F.struct(*both.columns[1:]), "log_det").alias("best")).select("cell", "best.*")
    best = materialise(best, "estimates")
    for _ in range(steps):
        best = _concentrate(rows, best, share)
    inner = 0.975
    near = _with_distance(rows, best).where(F.col("d2") <= quantile(inner, _P)).groupBy("cell").agg(*_sums())
    return materialise(_triangle(near, _consistency(inner)), "estimates")


def judge(docs: DataFrame, spread: dict[str, float] | None = None, tail: float = TAIL, least_group: int = LEAST_GROUP) -> DataFrame:
    """Statistics of every row of ``docs``, base_failed, distance (squared, null if its group has no estimate) and kept."""
    measured = materialise(_measured(statistics(docs), spread or SPREAD), "text-statistics")
    rows = materialise(_grouped(measured, least_group), "text-groups")
    estimates = estimate(rows.where("not base_failed").select("cell", *[f"u{i}" for i in range(_P)]))
    far = F.coalesce(F.col("d2") > quantile(1 - tail, _P), F.lit(False))
    judged = _with_distance(rows, estimates).withColumn("kept", ~F.col("base_failed") & ~far)
    return judged.select(*stats_columns(), "base_failed", F.col("d2").alias("distance"), "kept")


def stats_columns() -> list[str]:
    return ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def chi_squared(x: float, p: int) -> float:
    """Distribution function with p degrees of freedom, by the series of the lower incomplete gamma function."""
    a, half = p / 2, x / 2
    term = total = 1 / a
    k = 1
    while term > total * 1e-16:
        term *= half / (a + k)
        total += term
        k += 1
    return total * math.exp(a * math.log(half) - half - math.lgamma(a)) if x > 0 else 0.0


@cache
def quantile(share: float, p: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared(middle, p) < share else (low, middle)
    return low


def _consistency(share: float) -> float:
    """What makes the covariance of the nearest ``share`` of normal rows that of all."""
    return share / chi_squared(quantile(share, _P), _P + 2)
