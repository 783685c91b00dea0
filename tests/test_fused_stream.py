"""Both models and their fusion on the streams themselves, against the batch and against walking over the rows."""

from datetime import timedelta

import pytest
from helpers import START
from pyspark.sql import functions as F

from tidemark.functions.sentiment import EMPTY_MEANS, FEATURES
from tidemark.operators import ml
from tidemark.streaming import feeds, jobs

WINDOW = "window_id long, start timestamp, stop timestamp, prices array<double>"
POST = "id string, created_at timestamp, hits long, sum10 long"
FAR = 400_000_000


def at(seconds):
    return START + timedelta(seconds=seconds)


def window(i, seconds=1800, prices=None):
    """Windows of half an hour; each second one crosses an hour's border by a second."""
    return (i, at(i * 2000), at(i * 2000 + seconds), prices or [10.0 + (i * 7 + k) % 5 for k in range(4)])


@pytest.fixture(scope="module")
def models(spark):
    price = [(i, i % 3, [10.0 + (i * 7 + k) % 5 for k in range(4)]) for i in range(60)]
    stock = ml.price_features(spark.createDataFrame(price, "window_id long, label int, prices array<double>"))
    posts = [(i, i % 3, i % 4, (i + 1) % 3, i % 2, -0.3 - i % 5 / 10, 0.3 + i % 4 / 10, (i % 3 - 1) / 10) for i in range(60)]
    rows = spark.createDataFrame(posts, "window_id long, label int, nr_neg long, nr_pos long, nr_neutral long, mean_neg double, mean_pos double, mean_neutral double")
    return ml.train(stock, "rf", numTrees=6), ml.train(ml.assemble(rows), "rf", numTrees=6)


@pytest.fixture
def feed(spark, tmp_path, models):
    """Land files and run the stream; twice on one checkpoint is a restart."""
    paths = {n: str(tmp_path / n) for n in ("windows", "posts", "out", "checkpoint")}

    def land(windows, posts):
        spark.createDataFrame(windows, WINDOW).coalesce(1).write.mode("append").parquet(paths["windows"])
        spark.createDataFrame(posts, POST).coalesce(1).write.mode("append").parquet(paths["posts"])
        fused = jobs.fused_labels(
            feeds.file_stream(spark, paths["windows"], WINDOW),
            feeds.file_stream(spark, paths["posts"], POST),
            *models,
            lateness="1 hour",
            longest_window="2 hours",
            salts=2,
        )
        feeds.drain(fused, paths["out"], paths["checkpoint"])
        return {r.window_id: r for r in spark.read.schema(fused.schema).parquet(paths["out"]).collect()}

    land.paths = paths
    return land


def expected(windows, posts):
    """The six features by walking over all posts for each window."""
    found = {}
    for i, start, stop, _ in windows:
        inside = {b: [] for b in ("neg", "pos", "neutral")}
        for _, t, hits, total in posts:
            if start <= t <= stop:
                score = total / (hits * 10) if hits else 0.0
                inside["neg" if score < -0.2 else "pos" if score > 0.2 else "neutral"].append(score)
        found[i] = [len(inside[b]) for b in ("neg", "pos", "neutral")] + [
            sum(inside[b]) / len(inside[b]) if inside[b] else EMPTY_MEANS[b] for b in ("neg", "pos", "neutral")
        ]
    return found


def test_labels_equal_the_batch_over_a_restart(spark, feed, models):
    windows = [window(i) for i in range(6)]
    missing = window(6, prices=[1.0, None, 2.0, 3.0])
    posts = [(f"p{k}", at(k * 97), k % 4, (k * 13) % 60 - 30 if k % 4 else 0) for k in range(100) if not 4000 <= k * 97 <= 5800]
    posts += [("first", at(2000), 1, 10), ("last", at(3800), 2, -15), ("between", at(3801), 1, 9), ("border", at(10_000), 1, 2)]
    # The first part of either side, then the rest after a restart; no window may come out before both watermarks have passed it.
    early = [p for p in posts if p[1] < at(4500)]
    assert feed(windows[:3], early) == {}
    passed = feed([*windows[3:], missing], [p for p in posts if p not in early])
    assert all(r.stop < at(10_000 - 3600) for r in passed.values())
    out = feed([window(FAR // 2000)], [("after", at(FAR), 0, 0)])
    want = expected(windows, posts)
    assert set(out) == set(want)
    for i, row in out.items():
        assert [row[f] for f in FEATURES] == pytest.approx(want[i], abs=1e-9)
    assert want[2][:3] == [0, 0, 0] and any(all(w[:3]) for w in want.values())
    batch = jobs.label_windows_of_batch(
        spark.createDataFrame([*windows, missing], WINDOW), spark.createDataFrame(posts, POST), *models
    ).collect()
    assert {r.window_id: (r.label, r.prob) for r in batch} == {i: (r.label, r.prob) for i, r in out.items()}
    again = feed([window(FAR // 2000 + 1)], [("more", at(FAR + 1), 0, 0)])
    assert set(again) == set(want) and spark.read.parquet(feed.paths["out"]).count() == len(want)


def test_a_window_with_very_many_posts_and_posts_without_id_or_time(spark, feed):
    """Hot windows lie in several salts; a post that has no id or no time is in none."""
    windows = [window(0), window(1)]
    hot = [(f"h{k}", at(100), 1, 10 if k % 3 else -10) for k in range(3000)]
    odd = [(None, at(100), 1, 10), ("timeless", None, 1, 10)]
    feed(windows, hot + odd)
    out = feed([window(FAR // 2000)], [("after", at(FAR), 0, 0)])
    assert [out[0][f] for f in FEATURES] == [1000, 2000, 0, -1.0, 1.0, 0.0]
    assert [out[1][f] for f in FEATURES] == [0, 0, 0, *(EMPTY_MEANS[b] for b in ("neg", "pos", "neutral"))]


def test_what_is_remembered_is_forgotten(spark, feed):
    """After both watermarks have passed, the stores hold the row that moved them and nothing else."""
    feed([window(i) for i in range(4)], [(f"p{k}", at(k * 20), 1, 5) for k in range(300)])
    fused = feed([window(FAR // 2000)], [("after", at(FAR), 0, 0)])
    assert len(fused) == 4
    state = spark.read.format("statestore")
    # Operators are numbered from the sink: the last join, the sums, the first join.
    sums = state.option("operatorId", 1).load(feed.paths["checkpoint"])
    assert {r.window_id for r in sums.select("key.window_id").collect()} <= {FAR // 2000}
    for operator in (0, 2):
        sides = [state.option("operatorId", operator).option("joinSide", s).load(feed.paths["checkpoint"]).count() for s in ("left", "right")]
        assert sum(sides) <= 8, (operator, sides)
