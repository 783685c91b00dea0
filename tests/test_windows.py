from datetime import timedelta

import pytest
from helpers import START, TICKS, expected_labels, flat_rows, series_rows
from pyspark.sql import functions as F

from tidemark.operators.series import dense_bins, price_series
from tidemark.operators.windows import (
    count_window_index,
    label_windows,
    pivot_windows,
    table_summary,
    window_arrays,
    window_summary,
    window_table,
    with_next,
)


def labels(spark, rows, **kw):
    points = count_window_index(spark.createDataFrame(rows, TICKS), **kw)
    return {r.window_id: r.label for r in label_windows(window_summary(points, **kw), **kw).collect()}


def test_numbering_equals_sorting(spark):
    rows = series_rows(3000)
    shuffled = spark.createDataFrame(rows[::-1], TICKS).repartition(7)
    got = count_window_index(shuffled).orderBy("rn").collect()
    assert [(r.t, r.p, r.rn) for r in got] == [(t, p, i) for i, (t, p) in enumerate(rows)]
    assert all((r.window_id, r.pos) == divmod(r.rn, 100) for r in got)


@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_numbering_does_not_depend_on_partitions(spark, partitions):
    rows = series_rows(500, seed=5)
    df = spark.createDataFrame(rows, TICKS).repartition(partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = count_window_index(df).orderBy("rn").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.t for r in got] == [t for t, _ in rows]


def test_times_before_1970_are_in_order(spark):
    rows = series_rows(300, seed=9, start=START.replace(year=1969, month=12, day=31))
    got = count_window_index(spark.createDataFrame(rows, TICKS)).orderBy("rn").collect()
    assert [r.t for r in got] == [t for t, _ in rows]


@pytest.mark.parametrize("n", [99, 100, 101, 199, 200, 201, 250, 1000])
def test_labels_at_window_borders(spark, n):
    rows = series_rows(n, seed=n)
    assert labels(spark, rows) == expected_labels([p for _, p in rows])


def test_the_hundredth_and_twentieth_points_do_not_count(spark):
    prices = [1.0] * 99 + [500.0] + [1.0] * 19 + [900.0] * 81
    assert labels(spark, flat_rows(prices))[0] == 1


def test_partial_tail_counts_as_a_whole(spark):
    prices = [1.0] * 100 + [1.0] * 19 + [900.0]
    assert labels(spark, flat_rows(prices)) == {0: 2}


@pytest.mark.parametrize(("shift", "label"), [(0.019, 1), (0.0, 1), (-0.019, 1), (0.021, 2), (-0.021, 0)])
def test_flat_band(spark, shift, label):
    prices = [10.0] * 100 + [10.0 + shift] * 100
    assert labels(spark, flat_rows(prices)) == {0: label, 1: None}


def test_series_merges_equal_times_and_drops_missing_ones(spark):
    rows = [(START, 1.0), (START, 3.0), (START, float("nan")), (None, 9.0), (START + timedelta(seconds=1), None)]
    got = {r.t: r.p for r in price_series(spark.createDataFrame(rows, TICKS)).collect()}
    assert got == {START: 2.0, START + timedelta(seconds=1): None}


def test_missing_prices_are_skipped_in_means(spark):
    rows = flat_rows([1.0] * 50 + [None] * 50 + [None] * 100 + [2.0] * 10)
    assert labels(spark, rows) == {0: None, 1: None}
    summary = window_summary(count_window_index(spark.createDataFrame(rows, TICKS))).orderBy("window_id").collect()
    assert [(r.n, r.full_mean) for r in summary] == [(100, 1.0), (100, None), (10, 2.0)]


def test_wide_and_array_forms_agree(spark):
    rows = series_rows(250, seed=3)
    points = count_window_index(spark.createDataFrame(rows, TICKS))
    arrays = {r.window_id: r.prices for r in window_arrays(points).collect()}
    wide = {r.window_id: [r[f"c_{i}"] for i in range(100)] for r in pivot_windows(points).collect()}
    assert set(arrays) == {0, 1} and arrays == {w: wide[w] for w in arrays}
    assert arrays[1] == [p for _, p in rows[100:200]]


@pytest.mark.parametrize("prices", [[1.0] * 50 + [None] * 160, [float(i % 17) / 4 for i in range(230)]])
def test_both_summaries_agree(spark, prices):
    points = count_window_index(spark.createDataFrame(flat_rows(prices), TICKS))
    assert table_summary(window_table(points)).orderBy("window_id").collect() == window_summary(points).orderBy("window_id").collect()


def test_other_sizes(spark):
    rows = series_rows(35, seed=2)
    points = count_window_index(spark.createDataFrame(rows, TICKS), size=10)
    assert window_summary(points, size=10).count() == 4
    assert window_arrays(points, size=10).count() == 3


def test_next_window_skips_nothing_and_stops_at_gaps(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (3, 4.0)], "window_id long, m double")
    got = {r.window_id: (r.m, r.following) for r in with_next(df, following="m").collect()}
    assert got == {0: (1.0, 2.0), 1: (2.0, None), 3: (4.0, None)}


def test_dense_bins_fill_gaps(spark):
    rows = [(START, 1.0), (START + timedelta(days=3), 2.0)]
    df = spark.createDataFrame(rows, TICKS)
    days = dense_bins(df, "t", "day", [F.count("p").alias("n")]).orderBy("bin").collect()
    assert [r.n for r in days] == [1, None, None, 1]
    minutes = dense_bins(df, "t", "minute", [F.avg("p").alias("p")])
    assert minutes.count() == 3 * 1440 + 1 and minutes.where("p IS NOT NULL").count() == 2
    assert dense_bins(df.where("false"), "t", "minute", [F.avg("p").alias("p")]).count() == 0
    with pytest.raises(ValueError):
        dense_bins(df, "t", "hour", [])


def test_small_and_endless_prices(spark):
    rows = flat_rows([1e-7, 4e-7, float("inf"), float("nan")])
    summary = window_summary(count_window_index(price_series(spark.createDataFrame(rows, TICKS)), 4), 4, 4, 2)
    got = summary.first()
    assert abs(got.head_mean - 2.5e-7) < 1e-12 and abs(got.full_mean - 2.5e-7) < 1e-12
