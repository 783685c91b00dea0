"""The series kept day by day against the series numbered at once."""

from datetime import date, timedelta

from helpers import START, TICKS

from tidemark.sources import day_series

SIZE = 10


def days_of(spark, counts):
    """Rows of day i: counts[i] points at distinct times."""
    return [[(START + timedelta(days=d, seconds=7 * i), float(100 * d + i)) for i in range(n)] for d, n in enumerate(counts)]


def test_day_by_day_equals_all_at_once(spark, tmp_path):
    path, days = str(tmp_path / "series"), days_of(spark, [23, 4, 0, 3, 38])
    schema = spark.createDataFrame([], TICKS).schema
    dates = [START.date() + timedelta(days=d) for d in range(len(days))]
    assert day_series.read_days(spark, path, schema, dates[0], dates[-1]).count() == 0

    def stored():
        return [(r.t, r.p, r.rn) for r in day_series.read_days(spark, path, schema, dates[0], dates[-1]).orderBy("rn").collect()]

    for d in (0, 4, 3, 1, 2, 1):  # late days, and one that is run again
        day_series.add_day(spark.createDataFrame(days[d][::-1], TICKS), path, dates[d])
        assert len({rn for _, _, rn in stored()}) == len(stored())
    every = [point for day in days for point in day]
    assert stored() == [(t, p, i) for i, (t, p) in enumerate(every)]
    ended = []
    for d in range(len(days)):
        rows = day_series.windows_ending(spark, path, schema, dates[d], SIZE).collect()
        assert all((r.window_id, r.pos) == divmod(r.rn, SIZE) for r in rows)
        whole = {r.window_id for r in rows}
        assert len(rows) == SIZE * len(whole) and all(r.t.date() <= dates[d] for r in rows)
        ended += sorted(whole)
    assert ended == list(range(len(every) // SIZE))  # each whole window once, on the day that ends it
    assert day_series.windows_ending(spark, path, schema, date(2031, 1, 1), SIZE).count() == 0


def test_a_day_is_read_alone(spark, tmp_path):
    path, days = str(tmp_path / "series"), days_of(spark, [20, 20, 20])
    schema = spark.createDataFrame([], TICKS).schema
    for d, rows in enumerate(days):
        day_series.add_day(spark.createDataFrame(rows, TICKS), path, START.date() + timedelta(days=d))
    for old in (tmp_path / "series" / "points").glob(f"day={START.date()}/*.parquet"):
        old.write_bytes(b"nobody reads this")
    last = START.date() + timedelta(days=2)
    for df in (day_series.read_days(spark, path, schema, last, last), day_series.windows_ending(spark, path, schema, last, SIZE)):
        assert [r.rn for r in df.orderBy("rn").collect()] == list(range(40, 60))
        assert "PartitionFilters: [isnotnull(day" in df._jdf.queryExecution().executedPlan().toString()
