import random
from datetime import timedelta

import pytest
from helpers import START, TICKS, series_rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.windows import count_window_index, window_arrays
from tidemark.sources import sinks
from tidemark.streaming import feeds, jobs

NUMBERED = "window_id long, num int, t timestamp, p double"


def numbered(spark, n, seed=1):
    points = count_window_index(spark.createDataFrame(series_rows(n, seed), TICKS))
    return points.select("window_id", (F.col("pos") + 1).alias("num"), "t", "p")


def land(df, path, order):
    """Append one file whose rows are in the given order."""
    df.coalesce(1).sortWithinPartitions(order).write.mode("append").parquet(path)


def run_count_windows(spark, path, out, checkpoint, lateness="60 days"):
    stream = feeds.file_stream(spark, path, NUMBERED, max_files=1)
    feeds.drain(jobs.count_windows(stream, lateness=lateness), out, checkpoint)
    return {r.window_id: r.prices for r in spark.read.schema(jobs.COUNT_WINDOW).parquet(out).collect()}


def test_count_windows_across_files_repeats_and_restarts(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = numbered(spark, 450).cache()
    want = {r.window_id: r.prices for r in window_arrays(count_window_index(rows.select("t", "p"))).collect()}
    index = F.col("window_id") * 100 + F.col("num") - 1
    land(rows.where(index < 130), path, "t")
    first = run_count_windows(spark, path, out, checkpoint)
    assert set(first) == {0}
    # A second start on the same checkpoint: half a window was waiting, some points come again, two files arrive.
    land(rows.where((index >= 110) & (index < 260)), path, F.desc("num"))
    land(rows.where(index >= 260), path, "t")
    again = run_count_windows(spark, path, out, checkpoint)
    assert again == want and len(want) == 4
    assert spark.read.parquet(out).count() == 4


def test_every_point_is_accounted_for(spark, tmp_path):
    """Full, expired, late, repeated and unpriced points add up to what was sent, over restarts."""
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    at = lambda s: START + timedelta(seconds=s)
    point = lambda w, n, s, p=1.0: (w, n, at(s), p)
    first = [point(0, n, n) for n in range(1, 6)] + [point(1, n, n) for n in range(1, 4)] + [point(1, 2, 2), point(1, 9, 3, None), point(1, 8, 3, float("nan"))]
    second = [point(0, 2, 2), point(1, 3, 3), point(2, 1, 100_000)]
    third = [point(1, 4, 4), point(1, 5, 5), point(2, 2, 100_001)]
    sent = 0
    with jobs.rocksdb_state(spark):
        for rows in (first, second, third):
            spark.createDataFrame([*rows, (None, 1, at(0), 1.0)], NUMBERED).coalesce(1).write.mode("append").parquet(path)
            sent += len(rows)
            feeds.drain(jobs.accounted_windows(feeds.file_stream(spark, path, NUMBERED), "1 hour", size=5), out, checkpoint)
    back = spark.read.schema(jobs.ACCOUNTED).parquet(out).collect()
    got = {(r.window_id, r.kind): sorted(r.nums) for r in back}
    waiting = 2  # the points of window 2, whose time hasn't passed
    assert sum(r.n for r in back) + waiting == sent
    assert got[0, "full"] == [1, 2, 3, 4, 5] and got[0, "repeated"] == [2]
    assert got[1, "expired"] == [1, 2, 3] and got[1, "late"] == [4, 5] and got[1, "unpriced"] == [8, 9]
    assert sum(r.n for r in back if (r.window_id, r.kind) == (1, "repeated")) == 2 and 2 not in {w for w, _ in got}
    full = next(r for r in back if r.kind == "full")
    assert full.times == [at(n) for n in range(1, 6)] and full.prices == [1.0] * 5


class _Calls:
    """Stand-in state handle that counts the calls which would cross to the JVM."""

    def __init__(self):
        self.n, self.values, self.lists, self.maps = 0, {}, {}, {}

    def __getattr__(self, name):
        def call(*args):
            self.n += 1
            if name == "getValueState":
                return self.values.setdefault(args[0], _Calls.Value(self))
            if name == "getListState":
                return self.lists.setdefault(args[0], _Calls.List(self))
            if name == "getMapState":
                return self.maps.setdefault(args[0], _Calls.Map(self))
            return None

        return call

    class Value:
        def __init__(self, calls):
            self.calls, self.value = calls, None

        def exists(self):
            self.calls.n += 1
            return self.value is not None

        def get(self):
            self.calls.n += 1
            return self.value

        def update(self, value):
            self.calls.n += 1
            self.value = value

    class List(Value):
        def get(self):
            self.calls.n += 1
            return iter(self.value or [])

        def appendList(self, rows):
            self.calls.n += 1
            self.value = [*(self.value or []), *rows]

        def clear(self):
            self.calls.n += 1
            self.value = None

    class Map(Value):
        def containsKey(self, key):
            self.calls.n += 1
            return key in (self.value or {})

        def updateValue(self, key, value):
            self.calls.n += 1
            self.value = {**(self.value or {}), key: value}

        def iterator(self):
            self.calls.n += 1
            return iter((self.value or {}).items())

        def clear(self):
            self.calls.n += 1
            self.value = None


def test_window_state_is_touched_by_key_not_by_point():
    """A batch of many points of one window makes a few state calls, and the account stays whole."""
    import pandas as pd

    class Watermark:
        def getCurrentWatermarkInMs(self):
            return 0

    calls = _Calls()
    windows = jobs.CountWindows(100)
    windows.init(calls)
    first = pd.DataFrame({"num": list(range(1, 61)) + [5], "p": [1.0] * 61, "us": [n * 1_000_000 for n in range(1, 61)] + [5_000_000]})
    second = pd.DataFrame({"num": list(range(40, 101)), "p": [2.0] * 61, "us": [n * 1_000_000 for n in range(40, 101)]})
    start = calls.n
    got = list(windows.handleInputRows((7,), iter([first]), Watermark()))
    assert calls.n - start <= 8
    assert [(r.kind, r.n, r.nums) for r in (g.iloc[0] for g in got)] == [("repeated", 1, [5])]
    start = calls.n
    got = list(windows.handleInputRows((7,), iter([second]), Watermark()))
    assert calls.n - start <= 10
    full, repeated = (g.iloc[0] for g in got)
    assert (full.kind, full.n, full.nums) == ("full", 100, list(range(1, 101)))
    assert full.prices == [1.0] * 60 + [2.0] * 40
    assert (repeated.kind, repeated.n, repeated.nums) == ("repeated", 21, list(range(40, 61)))


def test_every_delivered_post_is_accounted_for(spark, tmp_path):
    """Kept, repeated and late add up to what was sent, over restarts; an id that was forgotten counts as new."""
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "id string, created_at timestamp, source string"
    at = lambda hours: START + timedelta(hours=hours)
    parts = [
        [("a", at(0), "x"), ("a", at(0), "y"), ("b", at(1), None)],
        [("a", at(1), "x"), ("c", at(30), "x")],
        [("d", at(2), "x"), ("b", at(2), "x"), ("c", at(31), "x")],
        [("a", at(40), "x")],
    ]
    got = []
    with jobs.rocksdb_state(spark):
        for rows in parts:
            spark.createDataFrame([*rows, (None, at(0), "x"), ("z", None, "x")], schema).coalesce(1).write.mode("append").parquet(path)
            feeds.drain(jobs.accounted_posts(feeds.file_stream(spark, path, schema), "5 hours"), out, checkpoint)
            back = spark.read.schema(jobs.ACCOUNTED_POSTS).parquet(out).collect()
            got.append(sorted((r.kind, r.id) for r in back))
    assert [len(g) for g in got] == [3, 5, 8, 9]
    assert got[0] == [("kept", "a"), ("kept", "b"), ("repeated", "a")]
    assert got[3] == [("kept", "a"), ("kept", "a"), ("kept", "b"), ("kept", "c"), ("late", "b"), ("late", "d"), ("repeated", "a"), ("repeated", "a"), ("repeated", "c")]


class _Timers(_Calls):
    """A stand-in handle that also holds the key's timers, and fires those the watermark has reached."""

    class Chunks(_Calls.List):
        def put(self, rows):
            self.calls.n += 1
            self.value = list(rows)

    def __init__(self):
        super().__init__()
        self.timers, self.lists["seen_posts"] = set(), _Timers.Chunks(self)

    def registerTimer(self, ms):
        self.n += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.n += 1
        self.timers.remove(ms)

    def fire(self, processor, key, watermark):
        for ms in sorted(t for t in self.timers if t <= watermark.getCurrentWatermarkInMs()):
            assert list(processor.handleExpiredTimer(key, watermark, None)) == []
            self.timers.remove(ms)


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _delivered(rows):
    import pandas as pd

    return pd.DataFrame({"bucket": 0, "id": [i for i, _ in rows], "us": [ms * 1000 + 7 for _, ms in rows], "source": None})


def test_post_state_is_touched_by_bucket_not_by_post():
    """A thousand ids of one bucket make a few state calls a batch, whether new, repeated or newer."""
    calls, posts = _Timers(), jobs.FirstPosts()
    posts.init(calls)
    for shift, kind, most in ((0, "kept", 4), (0, "repeated", 2), (5, "repeated", 6)):
        start = calls.n
        (got,) = posts.handleInputRows((0,), iter([_delivered([(f"p{i}", 10 + i + shift) for i in range(1000)])]), _Watermark(0))
        assert got["kind"].tolist() == [kind] * 1000 and got["id"].tolist() == [f"p{i}" for i in range(1000)]
        assert calls.n - start <= most
    assert calls.timers == {10 + 5 + 1}


def test_posts_of_a_bucket_are_remembered_one_by_one():
    """Random deliveries of few ids in one bucket, beside an account kept id by id; timers move on and ids are forgotten."""
    rng = random.Random(4)
    calls, posts, until, watermark, seen = _Timers(), jobs.FirstPosts(), {}, 0, set()
    posts.init(calls)
    for _ in range(400):
        rows = [(f"p{rng.randrange(12)}", watermark + rng.randrange(-20, 60)) for _ in range(rng.randrange(1, 7))]
        want = []
        for post, ms in rows:
            want.append("late" if ms < watermark else "repeated" if post in until else "kept")
            if ms >= watermark:
                until[post] = max(until.get(post, 0), ms + 1)
        parts = [_delivered(rows[i : i + 2]) for i in range(0, len(rows), 2)]
        got = [kind for part in posts.handleInputRows((0,), iter(parts), _Watermark(watermark)) for kind in part["kind"]]
        assert got == want
        calls.fire(posts, (0,), _Watermark(watermark))
        until = {post: ms for post, ms in until.items() if ms > watermark}
        assert posts._remembered()[0] == until and calls.timers == ({min(until.values())} if until else set())
        assert posts._remembered()[1] <= 2 * max(1, len(until)) + 12
        seen |= set(want) | ({"forgotten"} if not until else set())
        watermark += rng.choice([0, 0, 3, 15, 90])
    assert seen == {"late", "kept", "repeated", "forgotten"}


def test_posts_share_the_state_of_their_bucket(spark, tmp_path):
    """One bucket for all ids gives the account of a bucket an id, over restarts, and holds a row of state and a timer."""
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "id string, created_at timestamp, source string"
    at = lambda hours: START + timedelta(hours=hours)
    parts = [
        [("a", at(0), "x"), ("a", at(0), None), ("b", at(1), None)],
        [("a", at(1), "x"), ("c", at(30), "x")],
        [("d", at(2), "x"), ("b", at(2), "x"), ("c", at(31), "x")],
        [("a", at(40), "x"), ("c", at(41), None)],
    ]
    got = []
    with jobs.rocksdb_state(spark):
        for rows in parts:
            spark.createDataFrame([*rows, (None, at(0), "x"), ("z", None, "x")], schema).coalesce(1).write.mode("append").parquet(path)
            stream = jobs.accounted_posts(feeds.file_stream(spark, path, schema), "5 hours", buckets=1)
            query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            query.awaitTermination()
            assert max(sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress) <= 2
            back = spark.read.schema(jobs.ACCOUNTED_POSTS).parquet(out).collect()
            got.append(sorted((r.kind, r.id, r.created_at) for r in back))
    assert [len(g) for g in got] == [3, 5, 8, 10]
    assert got[3] == [
        ("kept", "a", at(0)), ("kept", "a", at(40)), ("kept", "b", at(1)), ("kept", "c", at(30)), ("late", "b", at(2)), ("late", "d", at(2)),
        ("repeated", "a", at(0)), ("repeated", "a", at(1)), ("repeated", "c", at(31)), ("repeated", "c", at(41)),
    ]


def test_windows_without_posts_come_out_with_zero(spark, tmp_path):
    at = lambda s: START + timedelta(seconds=s)
    windows, posts, out, checkpoint = (str(tmp_path / n) for n in ("w", "p", "out", "cp"))
    w_schema, p_schema = "window_id long, start timestamp, stop timestamp", "id string, created_at timestamp"
    w_rows = [(0, at(0), at(10)), (1, at(20), at(30)), (2, at(40), at(50))]
    seen = []
    for more_w, more_p in ((w_rows, [("a", at(5)), ("b", at(45)), ("c", at(46)), ("d", at(35))]), ([(9, at(10**7), at(10**7))], [("z", at(10**7))])):
        spark.createDataFrame(more_w, w_schema).coalesce(1).write.mode("append").parquet(windows)
        spark.createDataFrame(more_p, p_schema).coalesce(1).write.mode("append").parquet(posts)
        joined = jobs.pair_windows_with_posts(feeds.file_stream(spark, windows, w_schema), feeds.file_stream(spark, posts, p_schema), "1 day", "1 hour", keep_empty=True)
        feeds.drain(joined, out, checkpoint)
        rows = spark.read.schema("window_id long, id string, created_at timestamp").parquet(out)
        seen.append({r.window_id: r.n for r in jobs.posts_of_windows(rows).collect()})
    assert seen[0] == {0: 1, 2: 2} and {w: n for w, n in seen[1].items() if w != 9} == {0: 1, 1: 0, 2: 2}


def test_incomplete_windows_are_forgotten(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    early = numbered(spark, 40)
    late = numbered(spark, 100, seed=2).select(
        (F.col("window_id") + 1).alias("window_id"), "num", (F.col("t") + F.expr("INTERVAL 400 DAYS")).alias("t"), "p"
    )
    land(early, path, "t")
    run_count_windows(spark, path, out, checkpoint, "1 hour")
    land(late, path, "t")
    assert set(run_count_windows(spark, path, out, checkpoint, "1 hour")) == {1}
    land(early, path, "t")  # far too late now
    assert set(run_count_windows(spark, path, out, checkpoint, "1 hour")) == {1}


def test_label_rows_are_neither_lost_nor_doubled_by_a_restart(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "key string, window_id long, label int"
    seen = []

    def handle(batch, batch_id):
        seen.append(batch_id)
        if len(seen) == 2:
            sinks.upsert_latest(batch, batch_id, out)
            raise RuntimeError("lost after writing")
        sinks.upsert_latest(batch, batch_id, out)

    for w in range(4):
        spark.createDataFrame([("a", w, w % 3)], schema).coalesce(1).write.mode("append").parquet(path)
    stream = feeds.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    with pytest.raises(Exception, match="lost after writing"):
        feeds.drain_batches(stream, handle, checkpoint)
    feeds.drain_batches(stream, handle, checkpoint)
    landed = spark.read.schema(schema + ", batch_id long").parquet(out)
    assert sorted(r.window_id for r in landed.collect()) == [0, 1, 2, 3]
    (newest,) = sinks.latest_rows(landed, order=("window_id",)).collect()
    assert (newest.window_id, newest.label) == (3, 0) and seen.count(1) == 2


def test_running_features_equal_the_batch(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    scores = [-0.9, -0.2, 0.0, 0.2, 0.5, 0.7]
    for i in range(0, 6, 2):
        rows = [(START + timedelta(seconds=i), s, 0) for s in scores[i : i + 2]]
        spark.createDataFrame(rows, schemas.POST_FILE).coalesce(1).write.mode("append").option("header", True).csv(path)
    batches = []

    def handle(batch, batch_id):
        batches.append(batch.first())
        sinks.upsert_latest(batch, batch_id, out)

    feeds.drain_batches(jobs.running_sentiment(feeds.post_stream(spark, path)), handle, checkpoint, mode="complete")
    last = batches[-1]
    assert len(batches) == 3
    assert (last.nr_neg, last.nr_pos, last.nr_neutral) == (1, 2, 1)  # exactly ±0.2 is in no bucket here
    assert (last.mean_neg, last.mean_pos, last.mean_neutral) == (-0.9, 0.6, 0.0)


def test_repeated_ids_within_lateness(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "id string, created_at timestamp"
    for ids in (["a", "b", "a"], ["b", "c"]):
        rows = [(i, START) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    feeds.drain(jobs.distinct_posts(feeds.file_stream(spark, path, spark.read.parquet(path).schema), "1 day"), out, checkpoint)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_very_many_copies_of_one_id(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "id string, created_at timestamp"
    for i in range(3):
        rows = [("hot", START)] * 500 + [(f"x{i}", START), ("y", START + timedelta(seconds=i))]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = feeds.file_stream(spark, path, spark.read.parquet(path).schema, max_files=2)
    marked = stream.select("*", F.col("_metadata.file_name").alias("file"))
    feeds.drain(jobs.distinct_posts(marked, "1 day", copies_by="file"), out, checkpoint)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["hot", "x0", "x1", "x2", "y"]


def test_stream_join_holds_bounds(spark, tmp_path):
    at = lambda s: START + timedelta(seconds=s)
    windows = spark.createDataFrame([(0, at(0), at(10)), (1, at(20), at(30))], "window_id long, start timestamp, stop timestamp")
    posts = [("a", at(0)), ("b", at(10)), ("c", at(11)), ("d", at(25)), ("e", at(-1)), ("f", at(31))]
    posts += [(f"hot{i}", at(22)) for i in range(50)]
    rows = spark.createDataFrame(posts, "id string, created_at timestamp")
    windows.write.parquet(str(tmp_path / "w"))
    rows.write.parquet(str(tmp_path / "p"))
    joined = jobs.pair_windows_with_posts(
        feeds.file_stream(spark, str(tmp_path / "w"), windows.schema, max_files=None),
        feeds.file_stream(spark, str(tmp_path / "p"), rows.schema, max_files=None),
        "1 day",
        "7 days",
    )
    feeds.drain(joined, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = sorted((r.window_id, r.id) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted([(0, "a"), (0, "b"), (1, "d")] + [(1, f"hot{i}") for i in range(50)])


def test_open_day_stays_open(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    rows = spark.createDataFrame([(START + timedelta(hours=h), float(h)) for h in range(30)], TICKS)
    rows.write.parquet(path)
    feeds.drain(jobs.daily_ticks(feeds.file_stream(spark, path, rows.schema, max_files=None), "1 hour"), out, checkpoint)
    assert [(r["count"], r.max_price) for r in spark.read.parquet(out).collect()] == [(24, 23.0)]


def test_run_for_stops_a_running_query(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)
    stream = feeds.file_stream(spark, path, spark.read.parquet(path).schema)
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).start()
    assert feeds.run_for(query, 3) is False and not query.isActive


def test_ten_day_window_keeps_both_posts(spark, tmp_path):
    day = lambda d: START + timedelta(days=d)
    windows = spark.createDataFrame([(0, day(0), day(10))], "window_id long, start timestamp, stop timestamp")
    rows = spark.createDataFrame([("a", day(1)), ("b", day(9)), ("c", day(11))], "id string, created_at timestamp")
    windows.write.parquet(str(tmp_path / "w"))
    rows.write.parquet(str(tmp_path / "p"))
    joined = jobs.pair_windows_with_posts(
        feeds.file_stream(spark, str(tmp_path / "w"), windows.schema, max_files=None),
        feeds.file_stream(spark, str(tmp_path / "p"), rows.schema, max_files=None),
        "1 day",
        "30 days",
    )
    feeds.drain(joined, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_landed_files_stay_bounded_as_input_grows(spark):
    """the stream queries land their input at most a file a core, so triggers don't grow with the input."""
    import glob

    from tidemark.plans import stream_queries

    many = spark.range(0, 5000, numPartitions=3 * spark.sparkContext.defaultParallelism + 5)
    path, schema = stream_queries._landed(many, "landed-bound")
    files = glob.glob(path.removeprefix("file:") + "/*.parquet")
    assert 0 < len(files) <= spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in spark.read.schema(schema).parquet(path).collect()) == list(range(5000))
