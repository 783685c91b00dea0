"""Sampling, ranking, vectors, fusion and evaluation."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions.vectors import argmax_label, normalised, rendered, signed_label
from tidemark.operators import evaluation, fusion, ranking, sampling


@pytest.mark.parametrize("n", [0, 1, 10, 499, 500, 900])
def test_sample_is_exact_and_repeatable(spark, n):
    df = spark.range(500).withColumnRenamed("id", "k")
    want = sorted(range(500), key=lambda k: hashlib.md5(f"{k}:7".encode()).hexdigest())[:n]
    for parts in (1, 13):
        got = [r.k for r in sampling.sample_fixed(df.repartition(parts), n, key="k", seed=7).collect()]
        assert sorted(got) == sorted(want)


def test_split_is_stable_and_near_its_share(spark):
    df = spark.range(5000).withColumnRenamed("id", "window_id")
    one = {r.window_id: r.is_train for r in sampling.split_by_hash(df).collect()}
    two = {r.window_id: r.is_train for r in sampling.split_by_hash(df.repartition(11)).collect()}
    assert one == two and 0.67 < sum(one.values()) / 5000 < 0.73
    assert sampling.split_by_hash(df, train=1.0).where("NOT is_train").count() == 0


def test_random_split_covers_all(spark):
    left, right = sampling.split_random(spark.range(100))
    assert left.count() + right.count() == 100


def test_keep_split_is_a_filter(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "window_id long, x string")
    index = spark.createDataFrame([(2,), (2,), (9,)], "window_id long")
    kept = sampling.keep_split(df, index)
    assert kept.columns == df.columns and sorted(r.x for r in kept.collect()) == ["b", "c"]


def test_ranking(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(9)], "k int, s double")
    assert [r.k for r in ranking.bottom_k(df, "s", "k", 4).collect()] == [0, 3, 6, 1]
    assert [r.k for r in ranking.rank_slice(df, [F.desc("s"), F.col("k")], 3, 5).collect()] == [8, 1, 4]
    assert [r.k for r in ranking.preview(df, ["k"], 2).collect()] == [0, 1]


@pytest.mark.parametrize(
    ("values", "label"),
    [([0.1, 0.7, 0.2], 1), ([0.5, 0.5, 0.0], 0), ([0.0, 0.5, 0.5], 1), ([1.0, 1.0, 1.0], 0), ([0.1, 0.1, 0.9], 2)],
)
def test_ties_go_to_the_lowest_label(spark, values, label):
    df = spark.createDataFrame([(values,)], "v array<double>")
    assert df.select(argmax_label(F.col("v"))).first()[0] == label


def test_fusion_pairs_by_key(spark):
    schema = "window_id long, prob array<double>"
    stock = spark.createDataFrame([(1, [0.6, 0.1, 0.3]), (2, [0.0, 0.2, 0.8]), (5, [1.0, 0.0, 0.0])], schema)
    posts = spark.createDataFrame([(2, [0.9, 0.1, 0.0]), (1, [0.0, 0.0, 1.0]), (6, [1.0, 0.0, 0.0])], schema)
    got = {r.window_id: r.label for r in fusion.fuse(stock, posts).collect()}
    assert got == {1: 2, 2: 0}


def test_small_vector_functions(spark):
    df = spark.createDataFrame([([-1.0, 3.0], 2), ([0.5, 0.5], 3)], "v array<float>, l int")
    rows = df.select(normalised(F.col("v")).alias("n"), rendered(F.col("v")).alias("r"), signed_label(F.col("l")).alias("s"))
    assert [tuple(r) for r in rows.collect()] == [
        ([0.25, 0.75], "[-1.000000,3.000000]", 1),
        ([0.5, 0.5], "[0.500000,0.500000]", None),
    ]


def test_metrics_equal_counting_by_hand(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(2, 0)] * 4 + [(1, 2)]
    df = spark.createDataFrame(pairs, "label int, prediction int")
    row = evaluation.metrics(evaluation.confusion(df)).first()
    f1 = 0.0
    for c in range(3):
        hit = sum(a == b == c for a, b in pairs)
        truth, guess = sum(a == c for a, _ in pairs), sum(b == c for _, b in pairs)
        f1 += truth * (2 * hit / (truth + guess) if hit else 0.0)
    assert row.n == 15 and row.accuracy == pytest.approx(8 / 15) and row.f1_weighted == pytest.approx(f1 / 15)


def test_metrics_agree_with_spark(spark):
    from tidemark.operators.ml import evaluate

    df = spark.createDataFrame([(i % 3, (i * i) % 3) for i in range(50)], "label int, prediction int")
    row = evaluation.metrics(evaluation.confusion(df)).first()
    assert row.accuracy == pytest.approx(evaluate(df, "accuracy"))
    assert row.f1_weighted == pytest.approx(evaluate(df, "f1"))
