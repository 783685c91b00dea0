import random
from datetime import timedelta

from helpers import START, TICKS, series_rows
from pyspark.sql import functions as F

from tidemark.functions.sentiment import polarity_value
from tidemark.operators.interval_join import interval_join, locate
from tidemark.operators.windows import count_window_index, window_summary
from tidemark.plans.training import window_sentiment

SPANS = "window_id long, start timestamp, stop timestamp"
POSTS = "id long, ts timestamp"


def at(seconds: float):
    return START + timedelta(seconds=seconds)


def matches(spark, spans, posts):
    joined = interval_join(spark.createDataFrame(posts, POSTS), spark.createDataFrame(spans, SPANS), "ts")
    return sorted((r.id, r.window_id) for r in joined.collect())


def test_closed_bounds_and_gaps(spark):
    spans = [(0, at(10), at(20)), (1, at(21), at(21.5)), (2, at(500_000), at(500_001))]
    posts = [(1, at(10)), (2, at(20)), (3, at(20.5)), (4, at(21)), (5, at(21.5)), (6, at(9.999999)), (7, at(600_000)), (8, None)]
    assert matches(spark, spans, posts) == [(1, 0), (2, 0), (4, 1), (5, 1)]


def test_span_reaches_over_many_seconds_and_blocks(spark):
    spans = [(0, at(0), at(400_000)), (1, at(400_001), at(900_000))]
    posts = [(i, at(i * 50_000)) for i in range(20)]
    want = [(i, 0 if i <= 8 else 1) for i in range(19)]
    assert matches(spark, spans, posts) == want


def test_equal_to_checking_all_pairs(spark):
    series = series_rows(1200, seed=11)
    points = count_window_index(spark.createDataFrame(series, TICKS), size=50)
    spans = [(r.window_id, r.start, r.stop) for r in window_summary(points, size=50).collect()]
    rng = random.Random(4)
    posts = []
    for i in range(800):
        base = series[rng.randrange(len(series))][0]
        posts.append((i, base + timedelta(microseconds=rng.choice([0, 0, 1, -1, 400, 10_000_000]))))
    want = sorted((i, w) for i, ts in posts for w, lo, hi in spans if lo <= ts <= hi)
    assert matches(spark, spans, posts) == want


def test_one_instant_may_hold_most_rows(spark):
    spans = [(0, at(0), at(1)), (1, at(2), at(3))]
    posts = [(i, at(2.5)) for i in range(2000)] + [(5000, at(0.5)), (5001, at(1.5))]
    got = matches(spark, spans, posts)
    assert got == [(i, 1) for i in range(2000)] + [(5000, 0)]


def test_no_spans_or_no_points(spark):
    assert matches(spark, [(0, at(0), at(1))], []) == []
    assert matches(spark, [], [(1, at(0))]) == []


def test_other_columns_come_along(spark):
    points = spark.createDataFrame([(at(1), 7, "x")], "ts timestamp, n int, s string")
    spans = spark.createDataFrame([(3, at(0), at(2))], SPANS)
    assert [tuple(r) for r in locate(points, spans, "ts").collect()] == [(3, at(1), 7, "x")]


def test_windows_without_posts_stay(spark):
    windows = spark.createDataFrame([(0, at(0), at(10)), (1, at(20), at(30))], SPANS)
    rows = [("a", at(5), 2, 16), ("b", at(5), 1, -5), ("c", at(6), 0, 0), ("d", at(15), 1, 9)]
    scored = spark.createDataFrame(rows, "id string, created_at timestamp, hits long, sum10 long")
    got = {r.window_id: r for r in window_sentiment(windows, scored).collect()}
    assert (got[0].nr_neg, got[0].nr_pos, got[0].nr_neutral) == (1, 1, 1)
    assert (got[0].mean_neg, got[0].mean_pos, got[0].mean_neutral) == (-0.5, 0.8, 0.0)
    assert got[1].nr_neg is None and got[1].mean_pos is None


def test_polarity_value(spark):
    df = spark.createDataFrame([(0, 0), (4, 8)], "hits long, sum10 long")
    assert [r[0] for r in df.select(polarity_value().alias("v")).orderBy(F.col("v")).collect()] == [0.0, 0.2]
