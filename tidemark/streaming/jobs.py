"""The stream jobs: each works on a streaming DataFrame and can be started with any sink."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tidemark import schemas
from tidemark.functions.sentiment import EMPTY_MEANS, FEATURES, feature_columns, fill_empty_means, polarity_value, sentiment_bucket
from tidemark.functions.vectors import add_elementwise, argmax_label, rendered
from tidemark.operators.fusion import fuse
from tidemark.operators.ml import assemble, price_features, score
from tidemark.operators.transformers import SentimentFeatures
from tidemark.plans.training import window_sentiment
from tidemark.sources.payloads import parse_window_payload
from tidemark.sources.sinks import upsert_latest
from tidemark.sources.versions import Current


def running_sentiment(posts: DataFrame, closed_neutral: bool = False) -> DataFrame:
    """Features of all posts so far; run it in complete mode. Its state is one row."""
    return SentimentFeatures(closedNeutral=closed_neutral).transform(posts)


def distinct_posts(posts: DataFrame, lateness: str, copies_by: str | None = None) -> DataFrame:
    """Drop repeated ids; an id is remembered for ``lateness`` of event time.

    Where one id may come very many times, ``copies_by`` names a column that its copies differ in, such as the
    file or the partition they came from. Copies are then dropped per value of that column first, spread over all
    tasks, and only what is left meets under the id.
    """
    marked = posts.withWatermark("created_at", lateness)
    if copies_by is not None:
        marked = marked.dropDuplicatesWithinWatermark(["id", copies_by])
    return marked.dropDuplicatesWithinWatermark(["id"])


def daily_ticks(ticks: DataFrame, lateness: str) -> DataFrame:
    """The day view as a stream: a day comes out once the watermark has passed its end."""
    return (
        ticks.withWatermark("t", lateness)
        .groupBy(F.window("t", "1 day").alias("span"))
        .agg(
            F.count("*").alias("count"),
            F.min("p").alias("min_price"),
            F.max("p").alias("max_price"),
            F.avg("p").alias("avg_price"),
        )
        .select(F.col("span.start").cast("date").alias("day"), "count", "min_price", "max_price", "avg_price")
    )


COUNT_WINDOW = "window_id long, start timestamp, stop timestamp, prices array<double>"
# Times travel through Python as microseconds, so that no time zone of a worker can touch them.
_EMITTED = "window_id long, start_us long, stop_us long, prices array<double>"
_PENDING = "nums array<int>, prices array<double>, times array<long>"


def count_windows(ticks: DataFrame, lateness: str, size: int = 100) -> DataFrame:
    """Collect numbered ticks until a window has all its points, then emit it and forget it.

    ``ticks`` holds ``window_id, num, t, p``; points without one of the first three are left out. A key never holds more than ``size`` points. A point that is
    delivered twice counts once; a window that is still incomplete when the watermark has passed it by
    ``lateness`` is dropped.
    """

    def collect(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        points: dict[int, tuple] = {}
        if state.exists:
            points = {n: (p, us) for n, p, us in zip(*state.get, strict=True)}
        for part in parts:
            points |= {int(n): (float(p), int(us)) for n, p, us in zip(part["num"], part["p"], part["us"], strict=True)}
        nums = sorted(points)
        prices = [points[n][0] for n in nums]
        times = [points[n][1] for n in nums]
        if len(nums) < size:
            state.update((nums, prices, times))
            # The watermark may already be beyond this window's points, and a timeout must lie after it.
            state.setTimeoutTimestamp(max(max(times) // 1000, state.getCurrentWatermarkMs()) + 1)
            return
        if state.exists:
            state.remove()
        yield pd.DataFrame({"window_id": [key[0]], "start_us": [min(times)], "stop_us": [max(times)], "prices": [prices]})

    return (
        ticks.where("window_id IS NOT NULL AND num IS NOT NULL AND t IS NOT NULL")
        .withWatermark("t", lateness)
        .select("window_id", "num", "t", "p", F.unix_micros("t").alias("us"))
        .groupBy("window_id")
        .applyInPandasWithState(collect, _EMITTED, _PENDING, "append", GroupStateTimeout.EventTimeTimeout)
        .select(
            "window_id",
            F.timestamp_micros("start_us").alias("start"),
            F.timestamp_micros("stop_us").alias("stop"),
            "prices",
        )
    )


ACCOUNTED = "kind string, window_id long, n int, nums array<int>, prices array<double>, times array<timestamp>"
_ACCOUNTED = "kind string, window_id long, n int, nums array<int>, prices array<double>, us array<long>"


class CountWindows(StatefulProcessor):
    """Points of a window in a list, a timer on the newest of them, and what became of each point.

    A batch reads a key's held points (at most ``size``) once and appends its new ones in one call: each state call
    crosses to the JVM, so calls by point would make the work grow with the points, not the keys.
    """

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = handle.getListState("held_points", "num int, p double, us long")
        self.window = handle.getValueState("window", "done boolean, held int, timer long")

    def _rows(self, kind: str, key: tuple, points: list[tuple]) -> pd.DataFrame:
        nums, prices, us = ([list(x)] for x in zip(*sorted(points, key=lambda x: (x[0], x[2])), strict=True))
        return pd.DataFrame({"kind": [kind], "window_id": [key[0]], "n": [len(points)], "nums": nums, "prices": prices, "us": us})

    def _held(self) -> list[tuple]:
        return [tuple(point) for point in self.points.get()]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        done, held, timer = self.window.get() if self.window.exists() else (False, 0, -1)
        apart: dict[str, list[tuple]] = {"late": [], "unpriced": [], "repeated": []}
        newest = -1
        # Held points by number, read once when first needed; those of this batch are appended at its end.
        known: dict[int, tuple] | None = None if held else {}
        added: list[tuple] = []
        for part in rows:
            for num, p, us in zip(part["num"].tolist(), part["p"].tolist(), part["us"].tolist(), strict=True):
                if known is None and not done and us // 1000 >= watermark and not (p is None or p != p):
                    known = {point[0]: point for point in self._held()}
                kind = "late" if us // 1000 < watermark else "unpriced" if p is None or p != p else "repeated" if done or num in known else None
                if kind is not None:
                    apart[kind].append((num, p, us))
                    continue
                known[num] = (num, p, us)
                added.append((num, p, us))
                held, newest = held + 1, max(newest, us // 1000)
                if held == self.size:
                    yield self._rows("full", key, list(known.values()))
                    if held > len(added):
                        self.points.clear()
                    known, added = {}, []
                    done = True
        if added:
            self.points.appendList(added)
        for kind, points in apart.items():
            if points:
                yield self._rows(kind, key, points)
        if newest >= 0:
            if timer >= 0:
                self.handle.deleteTimer(timer)
            timer = max(timer, newest + 1)
            self.handle.registerTimer(timer)
            self.window.update((done, held, timer))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        done, _, _ = self.window.get()
        if not done:
            yield self._rows("expired", key, self._held())
        self.points.clear()
        self.window.clear()

    def close(self) -> None:
        pass


def accounted_windows(ticks: DataFrame, lateness: str, size: int = 100) -> DataFrame:
    """Count windows of numbered ticks (``window_id, num, t, p``) with an account of every point, by ``kind``:

    ``full``, a window with all its points; ``expired``, one that the watermark passed before; ``late``, points that came
    after the watermark; ``unpriced``, points without a price; ``repeated``, points that came before, also those of a
    full window that isn't forgotten yet. The ``n`` of all rows add up to the points sent. Each batch reads and writes the
    points it brings, not the window's others. Points without a window, number or time are left out. The state needs
    the RocksDB store (:func:`rocksdb_state`).
    """
    # The time itself doesn't reach the state, as rows behind the watermark would be dropped there without a trace.
    points = ticks.where("window_id IS NOT NULL AND num IS NOT NULL AND t IS NOT NULL").withWatermark("t", lateness)
    placed = points.select("window_id", F.col("num").cast("int").alias("num"), F.col("p").cast("double").alias("p"), F.unix_micros("t").alias("us"))
    found = placed.groupBy("window_id").transformWithStateInPandas(CountWindows(size), _ACCOUNTED, "append", "eventTime")
    return found.select("kind", "window_id", "n", "nums", "prices", F.transform("us", F.timestamp_micros).alias("times"))


ACCOUNTED_POSTS = "kind string, id string, created_at timestamp, source string"


class FirstPosts(StatefulProcessor):
    """Which posts of a bucket of ids were seen, each until the watermark passes its time; a timer on the first to go.

    A batch reads a bucket's ids once and appends those it changes in one call: each state call crosses to the JVM, so a key an
    id would make that work grow with the ids, not the buckets.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # What each batch appended, ids beside their timers. Timers only grow, so of an id the last one counts.
        self.seen = handle.getListState("seen_posts", "ids array<string>, timers array<long>")

    def _remembered(self) -> tuple[dict[str, int], int]:
        """The timer of every id, and how many entries it took to say so."""
        timers, entries = {}, 0
        for ids, until in self.seen.get():
            timers.update(zip(ids, until, strict=True))
            entries += len(ids)
        return timers, entries

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        timers, entries = self._remembered()
        before = min(timers.values(), default=None)
        changed: dict[str, int] = {}
        for part in rows:
            kinds = []
            for post, us in zip(part["id"].tolist(), part["us"].tolist(), strict=True):
                ms, timer = us // 1000, timers.get(post)
                late = ms < watermark
                kinds.append("late" if late else "repeated" if timer is not None else "kept")
                if not late and (timer is None or timer <= ms):
                    timers[post] = changed[post] = ms + 1
            yield part.assign(kind=kinds)[["kind", "id", "us", "source"]]
        if not changed:
            return
        if entries + len(changed) > 2 * len(timers):
            self.seen.put([(list(timers), list(timers.values()))])
        else:
            self.seen.appendList([(list(changed), list(changed.values()))])
        first = min(timers.values())
        if first != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(first)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        timers = {post: timer for post, timer in self._remembered()[0].items() if timer > watermark}
        if timers:
            self.seen.put([(list(timers), list(timers.values()))])
            self.handle.registerTimer(min(timers.values()))
        else:
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def accounted_posts(posts: DataFrame, lateness: str, buckets: int = 8192) -> DataFrame:
    """Posts ``id, created_at, source`` with what became of each delivery, by ``kind``: ``kept``, the first of its id; ``repeated``, another
    one while the id is remembered; ``late``, older than the watermark, which :func:`distinct_posts` would drop without a trace.

    An id is remembered until the watermark passes its newest time. Rows are as many as were sent, but for posts without id or time,
    which are left out. Ids share the state of one of ``buckets``, by a digest, and a batch reads those that its ids fall in: choose
    them so that a bucket holds some hundreds, and keep the number with the checkpoint. Needs the RocksDB store (:func:`rocksdb_state`).
    """
    known = posts.where("id IS NOT NULL AND created_at IS NOT NULL").withWatermark("created_at", lateness)
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket")
    # The time itself doesn't reach the state, as rows behind the watermark would be dropped there without a trace.
    placed = known.select(bucket, "id", F.unix_micros("created_at").alias("us"), "source")
    found = placed.groupBy("bucket").transformWithStateInPandas(FirstPosts(), "kind string, id string, us long, source string", "append", "eventTime")
    return found.select("kind", "id", F.timestamp_micros("us").alias("created_at"), "source")


_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def pair_windows_with_posts(
    windows: DataFrame,
    posts: DataFrame,
    lateness: str,
    longest_window: str,
    salts: int = 8,
    bucket_seconds: int = 3600,
    keep_empty: bool = False,
    carried: tuple[str, ...] = (),
    with_span: bool = False,
) -> DataFrame:
    """Join two streams: windows ``window_id, start, stop`` and raw posts ``id, created_at``.

    A post meets a window if it lies between its bounds, both closed. The window is laid out over the buckets of time
    that it touches, so that both sides meet under an equal bucket, and a post lies in one. Both watermarks and
    ``longest_window``, the most time a window may cover, bound what either side must remember; in a window that covers
    more, posts before its last ``longest_window`` are not met, so choose it from the data (it has no default). Windows
    are few and posts many, so each window is repeated per salt and a bucket with very many posts is spread over
    ``salts`` tasks.

    With ``keep_empty`` windows without posts come out too: what a window laid out has not met, in a bucket and salt, is
    a row with null ``id``, once both watermarks have passed it. Count ``id`` by window (:func:`posts_of_windows`).
    ``carried`` names columns of the posts that come along, ``with_span`` keeps ``start`` and ``stop`` of the window.
    """
    bucket = lambda t: F.floor(F.unix_seconds(t) / bucket_seconds)
    spread = windows.select("window_id", "start", "stop", F.explode(F.sequence(bucket("start"), bucket("stop"))).alias("bucket"))
    left = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")).withWatermark("stop", lateness)
    right = posts.select(
        "id", "created_at", bucket("created_at").alias("post_bucket"), F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("post_salt"), *carried
    ).withWatermark("created_at", lateness)
    inside = (
        (F.col("bucket") == F.col("post_bucket"))
        & (F.col("salt") == F.col("post_salt"))
        & (F.col("created_at") >= F.col("start"))
        & (F.col("created_at") <= F.col("stop"))
        & (F.col("created_at") >= F.col("stop") - F.expr(f"INTERVAL {longest_window}"))
    )
    return left.join(right, inside, "left_outer" if keep_empty else "inner").select(
        "window_id", "id", "created_at", *(("start", "stop") if with_span else ()), *carried
    )


def posts_of_windows(pairs: DataFrame) -> DataFrame:
    """window_id, n: the number of posts of every window, from landed pairs that keep empty windows."""
    return pairs.groupBy("window_id").agg(F.count("id").alias("n"))


def window_features(windows: DataFrame, posts: DataFrame, lateness: str, longest_window: str, **layout: int) -> DataFrame:
    """window_id, start, stop and the six features of each window, in append mode, while both streams run.

    ``windows`` holds ``window_id, start, stop``, ``posts`` the scored ``id, created_at, hits, sum10``, one row per post
    (:func:`distinct_posts` before, where copies come). A window comes out once, when both watermarks have passed it; one
    without posts has zero counts and the default means. What is kept are the posts and windows of the join and one row of
    sums per open window. ``layout`` is that of :func:`pair_windows_with_posts`.
    """
    pairs = pair_windows_with_posts(
        windows, posts, lateness, longest_window, keep_empty=True, carried=("hits", "sum10"), with_span=True, **layout
    )
    # A window's copy that met no post is a row without id, and belongs to no bucket.
    scored = pairs.withColumns(
        {"sentiment": polarity_value(), "sentiment_bucket": F.when(F.col("id").isNotNull(), sentiment_bucket())}
    )
    return scored.groupBy("window_id", "start", "stop").agg(*feature_columns(defaults=EMPTY_MEANS))


def fused_labels(
    windows: DataFrame, posts: DataFrame, stock_model: Model, posts_model: Model, lateness: str, longest_window: str, **layout: int
) -> DataFrame:
    """Labels of both models together, all on the streams: nothing is landed between.

    ``windows`` holds ``window_id, start, stop, prices`` and is read by both branches; ``posts`` is that of
    :func:`window_features`. The stock model scores prices as they come, the posts model features as they close, and the
    two probabilities meet under the window and its ``stop``, whose watermark bounds what the join remembers. A window with
    a missing price has no label.
    """
    features = window_features(windows.select("window_id", "start", "stop"), posts, lateness, longest_window, **layout)
    by_posts = score(posts_model, assemble(features)).withColumnRenamed("prob", "prob_posts")
    prices = price_features(windows.withWatermark("stop", lateness)).select("window_id", "stop", "features")
    by_prices = score(stock_model, prices).withColumnRenamed("prob", "prob_stock")
    both = by_posts.drop("prediction").join(by_prices.drop("prediction"), ["window_id", "stop"])
    summed = both.withColumn("prob", add_elementwise(F.col("prob_stock"), F.col("prob_posts")))
    return summed.withColumn("label", argmax_label(F.col("prob"))).select(
        "window_id", "start", "stop", *FEATURES, "prob_stock", "prob_posts", "prob", "label"
    )


def label_windows_of_batch(windows: DataFrame, scored_posts: DataFrame, stock_model: Model, posts_model: Model) -> DataFrame:
    """Both models on parsed windows and the posts inside them → fused label with the features it rests on."""
    stock_rows = price_features(windows)
    stock = score(stock_model, stock_rows.select("window_id", "features"))
    features = fill_empty_means(window_sentiment(windows.select("window_id", "start", "stop"), scored_posts))
    vector = F.array(*[F.col(c).cast("double") for c in ("nr_neg", "nr_pos", "nr_neutral")], "mean_neg", "mean_pos", "mean_neutral")
    audit = features.select("window_id", rendered(vector).alias("posts")).join(
        windows.select("window_id", rendered(F.col("prices")).alias("stock")), "window_id"
    )
    posts = score(posts_model, assemble(features).select("window_id", "features"))
    return fuse(stock, posts).select("window_id", "label", "prob").join(audit, "window_id")


def versioned_scorer(current: Current, out: str) -> Callable[[DataFrame, int], None]:
    """A batch handler that scores rows with ``features`` by the model that is current when their batch starts.

    Every row says which ``version`` made it. A batch that is run again overwrites itself, by the version then current.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        version = current.get(batch.sparkSession)
        upsert_latest(score(version.model, batch).withColumn("version", F.lit(version.number)), batch_id, out)

    return handle


def window_scorer(
    stock_model: Model, posts_model: Model, posts_path: str, out: str, size: int = 100, key: str = "key"
) -> Callable[[DataFrame, int], None]:
    """A batch handler for streams of window messages ``window_id, payload``.

    Models are loaded once, by the caller. The posts of a batch are those of its time span, found by event time
    in the landed post table, which is partitioned by the ``day`` of the post so that only those days are read.
    Copies of a post count once. Messages that can't be read or have another length are left out
    (``checked_windows`` lists them). Every window's label lands under the batch number, with the serving key.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        windows = parse_window_payload(batch, size=size)
        span = windows.agg(F.min("start").alias("lo"), F.max("stop").alias("hi")).first()
        if span["lo"] is None:
            return
        landed = spark.read.schema(schemas.SCORED_POST).parquet(posts_path)
        days = F.col("day").between(F.to_date(F.lit(span["lo"])), F.to_date(F.lit(span["hi"])))
        nearby = landed.where(days & F.col("created_at").between(F.lit(span["lo"]), F.lit(span["hi"])))
        nearby = nearby.dropDuplicates(["id", "created_at", "hits", "sum10"])  # a post may have landed more than once
        labelled = label_windows_of_batch(windows, nearby, stock_model, posts_model)
        upsert_latest(labelled.withColumn("key", F.lit(key)), batch_id, out)

    return handle
