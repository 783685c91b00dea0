"""Every operator as a named query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import sentiment as sent
from tidemark.functions.timeparts import day_of, hour_of, last_day, lenient_time, on_day
from tidemark.functions.vectors import rendered, signed_label
from tidemark.operators import evaluation, forest, fusion, ml, ranking, sampling, series, text, windows
from tidemark.operators.interval_join import interval_join, locate
from tidemark.plans import training, views
from tidemark.session import materialise, scratch_path
from tidemark.sources import bucketed, day_series, payloads, sample, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = datetime(2024, 1, 5)
NO_DATA = datetime(2030, 1, 1)
SELECTED_DAYS = ("05", "06")
# Buckets of the tables kept by window; a deployment sizes it for its largest one.
WINDOW_BUCKETS = 8


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(column: str | Column) -> Column:
    return F.round(column, 6)


def stamp(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def scored_posts(spark: SparkSession, sf_dir: str, *keep: str, docs: DataFrame | None = None) -> DataFrame:
    """Totals of the documents' texts, then the times: only numbers are joined, texts stay where they are."""
    columns = keep or ("doc_id", "created_at")
    own = [c for c in columns if c != "created_at"]
    docs = sample.documents(spark, sf_dir) if docs is None else docs
    totals = text.polarity(docs, sample.lexicon(spark), keep=own)
    dated = sample.dated(totals, spark, sf_dir)
    dated = dated if "created_at" in columns else dated.drop("created_at")
    return dated.withColumns({"sentiment": sent.polarity_value(), "score2": text.polarity_share()})


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.indexed_points(sample.ticks(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.labelled_windows(sample.ticks(spark, sf_dir))


# Scans, sources and sinks


@query
def scan_ticks(spark, sf_dir):
    ticks = sample.ticks(spark, sf_dir)
    return ticks.select("event_id", "s", "p", stamp("t").alias("t"), "v", F.col("ingestion_date").cast("string"))


@query
def scan_posts(spark, sf_dir):
    return sample.posts(spark, sf_dir).select(
        "id",
        F.md5("text").alias("text_md5"),
        stamp("created_at").alias("created_at"),
        "source",
        F.col("ingestion_date").cast("string"),
    )


@query
def partitioned_write_read(spark, sf_dir):
    """Ticks stored as the table keeps them, one folder per day, and read back with types."""
    path = scratch_path(spark, "stock")
    stored = sample.ticks(spark, sf_dir).select(
        "s", "p", stamp("t").alias("t"), "v", F.lit(None).cast("string").alias("c"), F.col("ingestion_date").cast("string")
    )
    tables.write_partitioned(stored, path)
    back = tables.read_ticks(spark, path=path)
    return back.groupBy(F.col("ingestion_date").cast("string").alias("ingestion_date")).agg(
        F.count("*").alias("n"),
        stamp(F.min("t")).alias("first_t"),
        stamp(F.max("t")).alias("last_t"),
        F.round(F.sum("p"), 2).alias("sum_p"),
    )


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "windows-csv")
    out = labelled(spark, sf_dir).select(
        "window_id", F.col("start").alias("start_timestamp"), F.col("stop").alias("stop_timestamp"), "label"
    )
    tables.write_csv(out, path)
    back = tables.read_csv(spark, path, schemas.WINDOW_FILE)
    return back.withColumns({c: stamp(c) for c in ("start_timestamp", "stop_timestamp")})


@query
def parse_post_lines(spark, sf_dir):
    posts = sample.posts(spark, sf_dir)
    line = payloads.post_line(F.col("id"), F.col("text"), stamp("created_at"), F.col("source"))
    parsed = payloads.parse_post_lines(posts.select(line.alias("value")))
    return parsed.select("id", F.md5("text").alias("text_md5"), F.col("timestamp").alias("created_at"), "source")


@query
def parse_window_payload(spark, sf_dir):
    messages = payloads.window_payload(points(spark, sf_dir))
    parsed = payloads.parse_window_payload(messages)
    return parsed.select(
        "window_id",
        F.size("prices").cast("bigint").alias("n"),
        F.element_at("prices", 1).alias("first_p"),
        F.element_at("prices", -1).alias("last_p"),
        r6(F.aggregate("prices", F.lit(0.0), lambda a, x: a + x)).alias("sum_p"),
        stamp("start").alias("start"),
        stamp("stop").alias("stop"),
    )


def _messages(spark, sf_dir) -> DataFrame:
    """Every window as a message; of every seventh one point is damaged, in one of three ways."""
    sent = payloads.window_payload(points(spark, sf_dir))
    damage = F.when(F.col("window_id") % 3 == 0, "no number").when(F.col("window_id") % 3 == 1, "2024-01-01 00:00:00,cheap,5").otherwise("someday,1.5,7")
    return sent.withColumn("payload", F.when(F.col("window_id") % 7 == 0, F.concat_ws("\n", "payload", damage)).otherwise(F.col("payload")))


@query
def quarantine_messages(spark, sf_dir):
    """Messages with a bad point, or of another length, with the reason; the others go on."""
    checked = payloads.checked_windows(_messages(spark, sf_dir), size=windows.SIZE)
    return checked.select("window_id", F.coalesce("reason", F.lit("ok")).alias("reason"))


@query
def replay_windows_ticks(spark, sf_dir):
    """All windows as numbered tick files."""
    path = scratch_path(spark, "replay-ticks")
    numbered = points(spark, sf_dir).select("t", "p", (F.col("pos") + 1).alias("num"), "window_id")
    sinks.export_windows(numbered, path, windows_per_folder=1000)
    back = tables.read_csv(spark, f"{path}/folder=*", schemas.TICK_FILE)
    return back.select("window_id", "num", stamp("t").alias("t"), "p")


@query
def replay_first_points(spark, sf_dir):
    """The first 1,500 points, one file set per window."""
    path = scratch_path(spark, "replay-first")
    earliest = series.price_series(sample.ticks(spark, sf_dir)).orderBy("t").limit(1500)
    first = windows.count_window_index(earliest)
    sinks.export_windows(first.select("t", "p", (F.col("pos") + 1).alias("num"), "window_id"), path)
    back = tables.read_csv(spark, f"{path}/folder=*", schemas.TICK_FILE)
    return back.groupBy("window_id").agg(
        F.count("*").alias("n"),
        F.min("num").cast("bigint").alias("first_num"),
        F.max("num").cast("bigint").alias("last_num"),
        r6(F.sum("p")).alias("sum_p"),
    )


@query
def replay_windows_posts(spark, sf_dir):
    """The posts inside each window's span, written beside the tick files."""
    path = scratch_path(spark, "replay-posts")
    times = sample.posts(spark, sf_dir).select("created_at")
    inside = interval_join(scored_posts(spark, sf_dir), labelled(spark, sf_dir), "created_at", times=times)
    sinks.export_windows(inside.select("created_at", "sentiment", "window_id"), path, windows_per_folder=1000)
    back = tables.read_csv(spark, f"{path}/folder=*", schemas.POST_FILE)
    return back.select("window_id", stamp("created_at").alias("created_at"), r6("sentiment").alias("sentiment"))


@query
def view_append(spark, sf_dir):
    """Two days appended to the view and one of them run again."""
    path = scratch_path(spark, "stocks-view")
    ticks = sample.ticks(spark, sf_dir)
    for day in (datetime(2024, 1, 4), AS_OF, AS_OF):
        sinks.append_view(views.stocks_daily_view(ticks, day), path)
    back = spark.read.schema(schemas.STOCKS_VIEW).parquet(path)
    return rounded(back, "avg_price").withColumn("day", F.col("day").cast("string"))


@query
def limit_preview(spark, sf_dir):
    ticks = ranking.preview(sample.ticks(spark, sf_dir), ["t", "event_id"], 100)
    return ticks.select("event_id", "s", "p", stamp("t").alias("t"))


# Filters and views


@query
def filter_last_day_ticks(spark, sf_dir):
    ticks = last_day(sample.ticks(spark, sf_dir), AS_OF)
    return ticks.select("event_id", "s", "p", stamp("t").alias("t"))


@query
def filter_today_posts(spark, sf_dir):
    return on_day(sample.posts(spark, sf_dir), AS_OF).select("id", stamp("created_at").alias("created_at"), "source")


@query
def stocks_daily_view(spark, sf_dir):
    view = views.stocks_daily_view(sample.ticks(spark, sf_dir), AS_OF)
    return rounded(view, "avg_price").withColumn("day", F.col("day").cast("string"))


def _posts_view(spark, sf_dir, as_of):
    view = views.posts_day_summary(scored_posts(spark, sf_dir, "doc_id", "source", "created_at"), as_of)
    return rounded(view, "mean_neg", "mean_pos", "mean_neutral").withColumn("day", F.col("day").cast("string"))


@query
def posts_daily_view(spark, sf_dir):
    return _posts_view(spark, sf_dir, AS_OF)


@query
def posts_daily_view_empty(spark, sf_dir):
    return _posts_view(spark, sf_dir, NO_DATA)


@query
def posts_daily_view_partitioned(spark, sf_dir):
    """The view from the table of posts, one folder per day: one folder is read, and only its texts are scored."""
    path = scratch_path(spark, "posts")
    stored = sample.posts(spark, sf_dir).select("id", "text", stamp("created_at").alias("created_at"), "source", F.col("ingestion_date").cast("string"))
    tables.write_partitioned(stored, path)
    view = views.posts_daily_view(tables.read_posts(spark, path=path), sample.lexicon(spark), AS_OF, max_lag_days=0)
    return rounded(view, "mean_neg", "mean_pos", "mean_neutral").withColumn("day", F.col("day").cast("string"))


@query
def quarantine_posts(spark, sf_dir):
    """Times in two forms and some unreadable ones; known bad rows and unreadable times drop out."""
    raw = sample.posts(spark, sf_dir).select(
        "doc_id",
        F.when(F.col("doc_id") % 50 == 0, F.lit("no time"))
        .when(F.col("doc_id") % 2 == 0, F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))
        .alias("created_text"),
    )
    good = raw.join(sample.bad_ids(spark), "doc_id", "left_anti").withColumn(
        "created_at", lenient_time(F.col("created_text"))
    )
    return good.where(F.col("created_at").isNotNull()).select("doc_id", stamp("created_at").alias("created_at"))


def _written_time() -> Column:
    """Post times as text, some of them unreadable."""
    return F.when(F.col("doc_id") % 50 == 0, F.date_format("created_at", "dd/MM/yyyy")).otherwise(
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    )


@query
def hour_day_parts(spark, sf_dir):
    written = _written_time()
    return sample.posts(spark, sf_dir).select("doc_id", hour_of(written).alias("hour"), day_of(written).alias("day"))


def _hourly_mean(spark, sf_dir, score: str) -> DataFrame:
    """Mean score per hour of the time written in the post."""
    written = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    timed = scored_posts(spark, sf_dir).withColumn("hour", hour_of(written)).dropna("any", subset=["hour"])
    return timed.groupBy("hour").agg(r6(sent.mean_score(score)).alias("mean"))


@query
def posts_per_hour_selected_days(spark, sf_dir):
    written = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    timed = sample.dated(sample.documents(spark, sf_dir).select("doc_id"), spark, sf_dir)
    posts = timed.select(hour_of(written).alias("hour"), day_of(written).alias("day")).where(F.col("day").isin(*SELECTED_DAYS))
    return posts.groupBy("hour").agg(F.count("*").alias("n")).orderBy("hour")


@query
def mean_sentiment_by_hour(spark, sf_dir):
    return _hourly_mean(spark, sf_dir, "sentiment")


@query
def mean_score2_by_hour(spark, sf_dir):
    return _hourly_mean(spark, sf_dir, "score2")


# Text


@query
def polarity_lexicon(spark, sf_dir):
    scored = scored_posts(spark, sf_dir, "doc_id")
    return scored.select("doc_id", "n_tokens", "hits", "sum10", r6("sentiment").alias("polarity"))


@query
def polarity_share(spark, sf_dir):
    return scored_posts(spark, sf_dir, "doc_id").select("doc_id", "pos_hits", "neg_hits", r6("score2").alias("share"))


def _bucket_counts(spark, sf_dir, closed: bool) -> DataFrame:
    scored = scored_posts(spark, sf_dir, "doc_id")
    bucket = F.coalesce(sent.sentiment_bucket(closed_neutral=closed), F.lit("none"))
    on_border = (F.col("hits") > 0) & (F.abs("sum10") == F.col("hits") * 2)
    return scored.groupBy(bucket.alias("bucket")).agg(
        F.count("*").alias("n"), F.count_if(on_border).alias("n_border"), r6(sent.mean_score("sentiment")).alias("mean")
    )


@query
def sentiment_bucket(spark, sf_dir):
    return _bucket_counts(spark, sf_dir, True)


@query
def sentiment_bucket_open(spark, sf_dir):
    return _bucket_counts(spark, sf_dir, False)


@query
def sentiment_features_default(spark, sf_dir):
    scored = scored_posts(spark, sf_dir, "doc_id", "source")
    features = sent.sentiment_features(scored, keys=("source",), defaults=sent.EMPTY_MEANS)
    return rounded(features, "mean_neg", "mean_pos", "mean_neutral")


@query
def tokenize_counts(spark, sf_dir):
    """Tokens and distinct tokens per language; counted per token first, so that no task holds a token set."""
    tokens = text.tokens(sample.documents(spark, sf_dir).select("lang", "text"), keep=("lang",))
    per_token = tokens.groupBy("lang", "token").agg(F.count("*").alias("n"))
    return per_token.groupBy("lang").agg(F.sum("n").alias("n_tokens"), F.count("*").alias("n_distinct"))


@query
def top_terms_positive(spark, sf_dir):
    """Terms of all posts with a positive score. Counted per document first, so that texts are never joined."""
    positive = scored_posts(spark, sf_dir, "doc_id").where(F.col("sentiment") > 0).select("doc_id")
    per_post = text.term_counts(sample.documents(spark, sf_dir), sample.stopwords(spark), keep=("doc_id",))
    return text.top(per_post.join(positive, "doc_id", "left_semi").groupBy("term").agg(F.sum("n").alias("n")))


@query
def allowed_terms(spark, sf_dir):
    return text.allowed_terms(top_terms_positive(spark, sf_dir), sample.ALLOWED_WORDS)


@query
def sample_fixed(spark, sf_dir):
    docs = sample.documents(spark, sf_dir).select("doc_id", "source")
    return sampling.sample_fixed(docs, 500, key="doc_id")


@query
def distinct_posts(spark, sf_dir):
    """Distinct (text, source) per language. Only digests are shuffled, and copies merge before they are."""
    docs = sample.documents(spark, sf_dir).select("lang", "source", text.content_digest("text").alias("digest"))
    merged = docs.groupBy("lang", "source", "digest").agg(F.count("*").alias("copies"))
    return merged.groupBy("lang").agg(F.sum("copies").alias("n"), F.count("*").alias("n_distinct"))


@query
def bottom_k_posts(spark, sf_dir):
    worst = ranking.bottom_k(scored_posts(spark, sf_dir).dropna(), "sentiment", "doc_id")
    return worst.select("doc_id", r6("sentiment").alias("sentiment"))


@query
def bottom_k_score2(spark, sf_dir):
    worst = ranking.bottom_k(scored_posts(spark, sf_dir).dropna(), "score2", "doc_id")
    return worst.select("doc_id", r6("score2").alias("score2"))


@query
def contains_slice(spark, sf_dir):
    """Posts with a term: places 61 to 100 from the top of the second score."""
    docs = sample.documents(spark, sf_dir).where(F.col("text").contains("tion"))
    scored = scored_posts(spark, sf_dir, "doc_id", docs=docs)
    places = ranking.rank_slice(scored, [F.desc("score2"), F.col("doc_id")], 61, 100)
    return places.select("doc_id", r6("score2").alias("score2"))


# Series and windows


@query
def price_series(spark, sf_dir):
    """The series of ticks stamped to the minute, so that many ticks share a time."""
    ticks = sample.ticks(spark, sf_dir).withColumn("t", F.date_trunc("minute", "t"))
    return series.price_series(ticks).select(stamp("t").alias("t"), r6("p").alias("p")).orderBy("t")


@query
def daily_counts_dense(spark, sf_dir):
    points_of_time = series.price_series(sample.ticks(spark, sf_dir))
    bins = series.dense_bins(points_of_time, "t", "day", [F.count("t").alias("n_t"), F.count("p").alias("n_p")])
    return bins.select(F.date_format("bin", "yyyy-MM-dd").alias("day"), *[_or_zero(c) for c in ("n_t", "n_p")])


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast("bigint")).alias(column)


@query
def minute_mean_price(spark, sf_dir):
    chosen = series.price_series(sample.ticks(spark, sf_dir)).where(F.dayofmonth("t") == 16)
    bins = series.dense_bins(chosen, "t", "minute", [F.avg("p").alias("p")])
    return bins.select(stamp("bin").alias("minute"), r6("p").alias("p"))


@query
def minute_counts_posts(spark, sf_dir):
    columns = ["id", "text", "created_at", "source"]
    counted = [F.count(c).alias(f"n_{c}") for c in columns]
    docs = sample.documents(spark, sf_dir).select("doc_id", *[F.when(F.col(c).isNotNull(), 1).alias(c) for c in ("text", "source")])
    posts = sample.dated(docs, spark, sf_dir).withColumn("id", F.col("doc_id"))
    bins = series.dense_bins(posts, "created_at", "minute", counted)
    return bins.select(stamp("bin").alias("minute"), *[_or_zero(f"n_{c}") for c in columns])


@query
def count_window_index(spark, sf_dir):
    return points(spark, sf_dir).select(stamp("t").alias("t"), r6("p").alias("p"), "rn", "window_id", "pos")


@query
def count_window_days(spark, sf_dir):
    """The same, kept week by week: the weeks arrive in reverse, each is numbered alone, nothing stored is rewritten."""
    path = scratch_path(spark, "series-days")
    series_points = materialise(series.price_series(sample.ticks(spark, sf_dir)).withColumn("week", F.date_trunc("week", "t").cast("date")), "series")
    weeks = sorted(r.week for r in series_points.select("week").distinct().collect())
    for week in reversed(weeks):
        day_series.add_day(series_points.where(F.col("week") == F.lit(week)).drop("week"), path, week)
    schema = series_points.drop("week").schema
    rows = day_series.read_days(spark, path, schema, weeks[0], weeks[-1])
    return rows.select(stamp("t").alias("t"), r6("p").alias("p"), "rn", F.expr("rn DIV 100").alias("window_id"), F.expr("CAST(rn % 100 AS INT)").alias("pos"))


@query
def window_bounds(spark, sf_dir):
    summary = windows.window_summary(points(spark, sf_dir))
    return summary.select("window_id", "n", stamp("start").alias("start"), stamp("stop").alias("stop"))


@query
def window_pivot(spark, sf_dir):
    wide = windows.pivot_windows(points(spark, sf_dir))
    return rounded(wide, *[f"c_{i}" for i in range(windows.SIZE)])


@query
def window_labels(spark, sf_dir):
    out = labelled(spark, sf_dir).withColumns({c: stamp(c) for c in ("start", "stop")})
    return rounded(out, "present_mean", "future_mean")


@query
def present_future_means(spark, sf_dir):
    """For display: the window's own mean beside that of the next 20 points."""
    summary = windows.window_summary(points(spark, sf_dir), future_len=20)
    beside = windows.with_next(summary, future_mean="head_mean")
    return beside.select("window_id", r6("present_mean").alias("present_mean"), r6("future_mean").alias("future_mean"))


@query
def interval_join_counts(spark, sf_dir):
    """Posts per window, zeros included: counted per instant, then per window."""
    summary = windows.window_summary(points(spark, sf_dir))
    spans = materialise(summary.where(F.col("n") == windows.SIZE).select("window_id", "start", "stop"), "spans")
    times = sample.dated(sample.documents(spark, sf_dir).select("doc_id"), spark, sf_dir)
    per_instant = times.groupBy("created_at").agg(F.count("*").alias("n"))
    found = locate(per_instant, spans, "created_at").groupBy("window_id").agg(F.sum("n").alias("n"))
    return spans.join(found, "window_id", "left").select("window_id", _or_zero("n"))


def post_windows(spark, sf_dir) -> DataFrame:
    return training.scored_post_windows(sample.ticks(spark, sf_dir), scored_posts(spark, sf_dir))


def _shown_features(df: DataFrame) -> DataFrame:
    shown = rounded(df, "mean_neg", "mean_pos", "mean_neutral").withColumns({c: stamp(c) for c in ("start", "stop")})
    return shown.select("window_id", "start", "stop", "label", *sent.FEATURES)


@query
def window_post_features(spark, sf_dir):
    return _shown_features(training.complete_post_windows(post_windows(spark, sf_dir)))


@query
def window_post_features_filled(spark, sf_dir):
    return _shown_features(training.scorable_post_windows(post_windows(spark, sf_dir)))


# Splits, vectors, fusion, evaluation


@query
def split_assign(spark, sf_dir):
    split = sampling.split_by_hash(labelled(spark, sf_dir).select("window_id"))
    return split.select("window_id", F.col("is_train").cast("int").alias("is_train"))


@query
def split_join(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    index = sampling.split_by_hash(rows.select("window_id")).where("is_train").select("window_id")
    return sampling.keep_split(rows, index).select("window_id", "label", r6("present_mean").alias("present_mean"))


@query
def true_labels_for_test(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    index = sampling.split_by_hash(rows.select("window_id")).where(~F.col("is_train")).select("window_id")
    return sampling.keep_split(rows, index).select("window_id", signed_label(F.col("label")).alias("label"))


@query
def vector_elements(spark, sf_dir):
    vectors = sample.class_vectors(spark, sf_dir).select("window_id", array_to_vector("prob_stock").alias("probability"))
    arrays = vectors.withColumn("prob", vector_to_array("probability"))
    return arrays.select("window_id", *[r6(F.col("prob")[i]).alias(f"prob_{i}") for i in range(3)])


def _two_models(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Probabilities of two models; for every pair a second one, under a negative key, in which two classes tie."""
    both = sample.class_vectors(spark, sf_dir)
    stock, posts = F.col("prob_stock"), F.col("prob_posts")
    tied = both.select(
        (-1 - F.col("window_id")).alias("window_id"),
        F.array(stock[0], stock[1], F.lit(0.0)).alias("prob_stock"),
        F.array(stock[1], stock[0], F.lit(0.0)).alias("prob_posts"),
    )
    rows = both.select("window_id", stock, posts).unionByName(tied)
    return rows.select("window_id", stock.alias("prob")), rows.select("window_id", posts.alias("prob"))


@query
def prob_join(spark, sf_dir):
    pairs = fusion.pair_probabilities(*_two_models(spark, sf_dir))
    columns = [r6(F.col(f"prob_{s}")[i]).alias(f"{s}_{i}") for s in ("stock", "posts") for i in range(3)]
    return pairs.select("window_id", *columns)


@query
def fuse_probabilities(spark, sf_dir):
    fused = fusion.fuse(*_two_models(spark, sf_dir))
    return fused.select("window_id", *[r6(F.col("prob")[i]).alias(f"sum_{i}") for i in range(3)])


@query
def fuse_argmax(spark, sf_dir):
    return fusion.fuse(*_two_models(spark, sf_dir)).select("window_id", "label")


def _by_window(df: DataFrame, name: str) -> DataFrame:
    """Rows written in buckets of their window, as one of a family of tables that are joined without a shuffle."""
    path = scratch_path(df.sparkSession, name)
    return bucketed.write(df, path.rsplit("/", 1)[1].replace("-", "_"), "window_id", WINDOW_BUCKETS, path)


@query
def fuse_bucketed(spark, sf_dir):
    """Probabilities of both models, each stored by window, fused where they lie."""
    stock, posts = _two_models(spark, sf_dir)
    return fusion.fuse(_by_window(stock, "prob-stock"), _by_window(posts, "prob-posts")).select("window_id", "label")


@query
def split_join_bucketed(spark, sf_dir):
    """Windows and both sides of the split stored by window; each side picks its rows without a shuffle of either."""
    rows = labelled(spark, sf_dir).select("window_id", "label", "present_mean")
    split = sampling.split_by_hash(rows.select("window_id"))
    stored = _by_window(rows, "windows-stored")
    sides = []
    for is_train, side in ((True, F.col("is_train")), (False, ~F.col("is_train"))):
        index = _by_window(split.where(side).select("window_id"), f"split-{int(is_train)}")
        sides.append(sampling.keep_split(stored, index).select("window_id", F.lit(is_train).alias("is_train"), "label", r6("present_mean").alias("present_mean")))
    return sides[0].unionByName(sides[1])


@query
def label_with_audit(spark, sf_dir):
    fused = fusion.fuse(*_two_models(spark, sf_dir))
    return fused.select(
        "window_id",
        F.col("label").cast("string").alias("label"),
        rendered(F.col("prob_stock")).alias("stock"),
        rendered(F.col("prob_posts")).alias("posts"),
    )


@query
def label_map(spark, sf_dir):
    return labelled(spark, sf_dir).select("window_id", signed_label(F.col("label")).alias("label"))


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion(sample.labels(spark, sf_dir), "quality", "toxic")


@query
def eval_metrics(spark, sf_dir):
    out = evaluation.metrics(evaluation.confusion(sample.labels(spark, sf_dir), "quality", "toxic"))
    return rounded(out, "accuracy", "f1_weighted")


@query
def eval_previous_label(spark, sf_dir):
    """How well the label of one window guesses that of the next."""
    beside = windows.with_next(labelled(spark, sf_dir).select("window_id", "label"), truth="label")
    known = beside.dropna("any", subset=["label", "truth"])
    return rounded(evaluation.metrics(evaluation.confusion(known, "truth", "label")), "accuracy", "f1_weighted")


# Machine learning


@query
def assemble_sentiment(spark, sf_dir):
    ready = training.complete_post_windows(post_windows(spark, sf_dir))
    arrays = ml.assemble(ready).withColumn("values", vector_to_array("features"))
    return arrays.select("window_id", *[r6(F.col("values")[i]).alias(f"f_{i}") for i in range(6)])


@query
def index_labels(spark, sf_dir):
    rows = labelled(spark, sf_dir).dropna("any", subset=["label"]).select(F.col("label").cast("string").alias("label"))
    indexed = ml.index_labels(rows).transform(rows)
    return indexed.groupBy("label", F.col("indexed_label").cast("int").alias("indexed_label")).agg(
        F.count("*").alias("n")
    )


@query
def index_features(spark, sf_dir):
    """Features after indexing of categorical ones; continuous ones pass unchanged."""
    rows = ml.assemble(training.complete_post_windows(post_windows(spark, sf_dir))).select("window_id", "features")
    rows = materialise(rows, "post-features")
    indexed = ml.index_features(rows).transform(rows).withColumn("values", vector_to_array("indexed_features"))
    return indexed.select("window_id", *[r6(F.col("values")[i]).alias(f"f_{i}") for i in range(6)])


def stock_training(spark, sf_dir) -> DataFrame:
    """Labelled price vectors with their side of the split, written once because fitting rereads them."""
    rows = training.stock_windows(sample.ticks(spark, sf_dir)).dropna("any", subset=["label"])
    ready = sampling.split_by_hash(ml.price_features(rows)).select("window_id", "label", "features", "is_train")
    return materialise(ready, "stock-training")


def post_training(spark, sf_dir) -> DataFrame:
    rows = training.complete_post_windows(post_windows(spark, sf_dir))
    ready = sampling.split_by_hash(ml.assemble(rows)).select("window_id", "label", "features", "is_train")
    return materialise(ready, "post-training")


def _fit_and_score(rows: DataFrame, kind: str) -> DataFrame:
    model = ml.train(rows.where("is_train"), kind)
    return ml.score(model, rows.where(~F.col("is_train")).drop("is_train"))


def _predicted(rows: DataFrame, kind: str) -> DataFrame:
    """Held-out windows with their label; the model's class must be the one that its stored numbers give (ties to the first)."""
    model = ml.train(rows.where("is_train"), kind)
    held_out = forest.rebuilt(model, rows.where(~F.col("is_train")).drop("is_train"))
    agrees = (F.col("prediction") == F.col("rebuilt")).cast("int").alias("agrees")
    return ml.score(model, held_out).select("window_id", "label", agrees)


@query
def rf_stock(spark, sf_dir):
    return _predicted(stock_training(spark, sf_dir), "rf")


@query
def rf_posts(spark, sf_dir):
    return _predicted(post_training(spark, sf_dir), "rf")


@query
def ovr_rf(spark, sf_dir):
    return _predicted(stock_training(spark, sf_dir), "ovr_rf")


@query
def ovr_svc(spark, sf_dir):
    return _predicted(stock_training(spark, sf_dir), "ovr_svc")


@query
def ovr_gbt(spark, sf_dir):
    return _predicted(stock_training(spark, sf_dir), "ovr_gbt")


@query
def ovr_rf_posts(spark, sf_dir):
    return _predicted(post_training(spark, sf_dir), "ovr_rf")


@query
def ovr_svc_posts(spark, sf_dir):
    return _predicted(post_training(spark, sf_dir), "ovr_svc")


@query
def ovr_gbt_posts(spark, sf_dir):
    return _predicted(post_training(spark, sf_dir), "ovr_gbt")


@query
def forest_tables(spark, sf_dir):
    """Every labelled window scored from the forest's table of nodes, beside the model itself."""
    rows = stock_training(spark, sf_dir)
    model = ml.train(rows.where("is_train"), "rf")
    nodes = forest.node_table(spark, model)
    both = ml.score(model, rows.withColumn("own", forest.probabilities(nodes, vector_to_array("features"))))
    apart = F.array_max(F.zip_with("own", "prob", lambda a, b: F.abs(a - b)))
    return both.select("window_id", F.size("own").alias("n_classes"), (apart < 1e-12).cast("int").alias("same"))


@query
def models_against_majority(spark, sf_dir):
    """Do the tree models know more of their training windows than the most frequent label? A constant model does not."""
    found = []
    for feed, rows in (("stock", stock_training(spark, sf_dir)), ("posts", post_training(spark, sf_dir))):
        seen = rows.where("is_train").drop("is_train")
        for kind in ("rf", "ovr_rf", "ovr_gbt"):
            matrix = evaluation.confusion(ml.score(ml.train(seen, kind), seen))
            by_label = matrix.groupBy("label").agg(F.sum("n").alias("n"), F.sum(F.expr("if(label = prediction, n, 0)")).alias("hits"))
            total = by_label.agg(F.sum("n").alias("n"), F.max("n").alias("majority"), F.sum("hits").alias("hits"))
            found.append(total.select(F.lit(feed).alias("feed"), F.lit(kind).alias("model"), "n", "majority", (F.col("hits") > F.col("majority")).cast("int").alias("better")))
    return reduce(DataFrame.unionByName, found)


@query
def score_windows(spark, sf_dir):
    """What must hold for every scored window: three probabilities that sum to 1, the largest one predicted."""
    rows = stock_training(spark, sf_dir)
    scored = ml.score(ml.train(rows.where("is_train"), "rf"), rows.drop("is_train"))
    total = F.aggregate("prob", F.lit(0.0), lambda a, x: a + x)
    return scored.select(
        "window_id",
        F.size("prob").alias("n_classes"),
        r6(total).alias("prob_sum"),
        (F.element_at("prob", F.col("prediction") + 1) == F.array_max("prob")).cast("int").alias("predicts_largest"),
    )


@query
def model_roundtrip(spark, sf_dir):
    """A saved and reloaded model scores as before."""
    rows = stock_training(spark, sf_dir)
    path = scratch_path(spark, "model")
    fitted = ml.train(rows.where("is_train"), "rf")
    ml.save_model(fitted, path)
    unseen = rows.where(~F.col("is_train")).select("window_id", "features")
    before = ml.score(fitted, unseen).select("window_id", F.col("prob").alias("before"))
    after = ml.score(ml.load_model(path, "rf"), unseen).select("window_id", F.col("prob").alias("after"))
    return before.join(after, "window_id").select("window_id", (F.col("before") == F.col("after")).cast("int").alias("same"))


@query
def eval_fused(spark, sf_dir):
    """The fused label on the held-out windows that both models can score: own metrics beside Spark's evaluator."""
    stock = _fit_and_score(stock_training(spark, sf_dir), "rf")
    posts = _fit_and_score(post_training(spark, sf_dir), "rf")
    fused = fusion.fuse(stock, posts).select("window_id", F.col("label").alias("prediction"))
    truth = materialise(stock.select("window_id", "label").join(fused, "window_id"), "fused")
    own = evaluation.metrics(evaluation.confusion(truth))
    agree = lambda name, theirs: (F.abs(F.col(name) - F.lit(ml.evaluate(truth, theirs))) < 1e-9).cast("int")
    return own.select("n", agree("accuracy", "accuracy").alias("accuracy_agrees"), agree("f1_weighted", "f1").alias("f1_agrees"))


# Sinks of the batch layer


@query
def posts_view_append(spark, sf_dir):
    """Two days of posts appended to the serving view and one of them run again."""
    path = scratch_path(spark, "posts-view")
    scored = materialise(scored_posts(spark, sf_dir), "scored-posts")
    for day in (datetime(2024, 1, 4), AS_OF, AS_OF):
        sinks.append_view(views.posts_day_summary(scored, day), path)
    back = spark.read.schema(schemas.POSTS_VIEW).parquet(path)
    return rounded(back, "mean_neg", "mean_pos", "mean_neutral").withColumn("day", F.col("day").cast("string"))


@query
def split_files(spark, sf_dir):
    """The split written once as files and read by both models: rows each of them gets."""
    path = scratch_path(spark, "split")
    split = sampling.split_by_hash(labelled(spark, sf_dir).select("window_id"))
    for name, side in (("train", F.col("is_train")), ("test", ~F.col("is_train"))):
        tables.write_csv(split.where(side).select("window_id"), f"{path}/{name}")
    stock = training.labelled_windows(sample.ticks(spark, sf_dir)).dropna("any", subset=["label"]).select("window_id")
    posts = training.complete_post_windows(post_windows(spark, sf_dir)).select("window_id")
    counts = []
    for model, rows in (("posts", posts), ("stock", stock)):
        for name in ("train", "test"):
            index = tables.read_csv(spark, f"{path}/{name}", schemas.SPLIT_FILE)
            kept = sampling.keep_split(rows, index).agg(F.count("*").alias("n"))
            counts.append(kept.select(F.lit(model).alias("model"), F.lit(name).alias("side"), "n"))
    out = counts[0]
    for more in counts[1:]:
        out = out.union(more)
    return out


@query
def export_predictions(spark, sf_dir):
    """Fused labels and probabilities written as files, and read back."""
    path = scratch_path(spark, "predictions")
    fused = fusion.fuse(*_two_models(spark, sf_dir))
    tables.write_csv(fused.select("window_id", "label", *[F.col("prob")[i].alias(f"prob_{i}") for i in range(3)]), path)
    back = tables.read_csv(spark, path, schemas.PREDICTION_FILE)
    return back.select("window_id", "label", *[r6(f"prob_{i}").alias(f"prob_{i}") for i in range(3)])


@query
def distinct_rows(spark, sf_dir):
    """One row of each group of posts with equal text and source: the least id, with the number of copies."""
    docs = sample.documents(spark, sf_dir).select("doc_id", "source", text.content_digest("text").alias("digest"))
    return docs.groupBy("digest", "source").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("digest")
