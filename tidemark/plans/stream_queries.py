"""The stream jobs as queries: fed from the sample tables, run until nothing is left, result read back."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions.sentiment import FEATURES
from tidemark.operators import ml, windows
from tidemark.operators.transformers import WindowPivot
from tidemark.operators.windows import full_windows, window_table
from tidemark.plans import catalogue as cat
from tidemark.plans.catalogue import points, query, r6, scored_posts, stamp
from tidemark.session import configure, materialise, scratch_path
from tidemark.sources import latest, payloads, sample, sinks, tables, versions
from tidemark.streaming import feeds, jobs, messages

# The sample tables cover one month and may be read in any file order, so nothing of them counts as late.
WHOLE_SAMPLE = "60 days"
MESSAGES_A_TRIGGER = 2_000


def _drained(stream: DataFrame, name: str, schema: StructType | str) -> DataFrame:
    spark = stream.sparkSession
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    feeds.drain(stream, out, checkpoint)
    return spark.read.schema(schema).parquet(out)


def _as_files(df: DataFrame) -> DataFrame:
    """Rows spread over as many files as the cluster has cores, however large the input: a stream capped at some files a
    trigger then runs a bounded number of triggers, each with more rows, instead of a number that grows with the input."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _numbered_files(spark, sf_dir) -> str:
    path = scratch_path(spark, "numbered-ticks")
    rows = points(spark, sf_dir).select("t", "p", (F.col("pos") + 1).alias("num"), "window_id")
    tables.write_csv(_as_files(rows), path)
    return path


def _landed(df: DataFrame, name: str) -> tuple[str, StructType]:
    """Write rows as the files that a stream will read."""
    path = scratch_path(df.sparkSession, name)
    _as_files(df).write.parquet(path)
    return path, df.schema


@query
def stream_file_scan(spark, sf_dir):
    stream = feeds.tick_stream(configure(spark), _numbered_files(spark, sf_dir), max_files=4)
    back = _drained(stream, "file-scan", schemas.TICK_FILE)
    return back.select("window_id", "num", stamp("t").alias("t"), "p")


@query
def stream_post_ingest(spark, sf_dir):
    """Post messages, rate-capped, parsed and appended to a table."""
    posts = sample.posts(spark, sf_dir)
    line = payloads.post_line(F.col("id"), F.col("text"), stamp("created_at"), F.col("source"))
    path, schema = _landed(posts.select(line.alias("value")), "post-messages")
    parsed = payloads.parse_post_lines(feeds.file_stream(spark, path, schema, max_files=4))
    back = _drained(parsed, "post-ingest", schemas.POST_LINE)
    return back.select("id", F.md5("text").alias("text_md5"), F.col("timestamp").alias("created_at"), "source")


@query
def stream_acknowledged(spark, sf_dir):
    """Post messages pulled from the acknowledged source, a cap on each trigger; the second half by a query that knows
    nothing of the first but what it acknowledged. A message that comes twice overwrites itself by its place."""
    posts = sample.posts(spark, sf_dir)
    line = payloads.post_line(F.col("id"), F.col("text"), stamp("created_at"), F.col("source"))
    lines = materialise(posts.select(line.alias("value")), "post-lines")
    path, out = scratch_path(spark, "messages-in"), scratch_path(spark, "messages-out")
    for half in range(2):
        messages.land_rows(lines.where(F.pmod(F.xxhash64("value"), F.lit(2)) == half), path, f"half{half}", per_file=100)
        feeds.drain_source(
            messages.message_stream(spark, path, max_messages=MESSAGES_A_TRIGGER),
            lambda batch, batch_id, half=half: sinks.upsert_latest(batch, batch_id, f"{out}/half={half}"),
            scratch_path(spark, "messages-checkpoint"),
        )
    landed = spark.read.schema(f"{messages.SCHEMA}, half int, batch_id long").parquet(out)
    once = landed.groupBy("file", "line").agg(F.max_by("value", F.struct("half", "batch_id")).alias("value"))
    back = payloads.parse_post_lines(once)
    return back.select("id", F.md5("text").alias("text_md5"), F.col("timestamp").alias("created_at"), "source")


@query
def stream_dedup(spark, sf_dir):
    """Every post is delivered twice and kept once."""
    posts = sample.posts(spark, sf_dir).select("id", "created_at", "source")
    path, schema = _landed(posts.unionByName(posts), "posts-twice")
    delivered = feeds.file_stream(spark, path, schema, max_files=4).select("*", F.col("_metadata.file_name").alias("file"))
    stream = jobs.distinct_posts(delivered, lateness=WHOLE_SAMPLE, copies_by="file").drop("file")
    back = _drained(stream, "dedup", schema)
    return back.select("id", stamp("created_at").alias("created_at"), "source")


@query
def stream_sentiment_running(spark, sf_dir):
    """The features after the last batch of a running aggregate in complete mode."""
    path = scratch_path(spark, "post-files")
    rows = scored_posts(spark, sf_dir).select("created_at", "sentiment", F.lit(0).cast("bigint").alias("window_id"))
    tables.write_csv(rows, path)
    out = scratch_path(spark, "running")
    feeds.drain_batches(
        jobs.running_sentiment(feeds.post_stream(spark, path, max_files=4)),
        lambda batch, batch_id: sinks.upsert_latest(batch.withColumn("key", F.lit("all")), batch_id, out),
        scratch_path(spark, "running-checkpoint"),
        mode="complete",
    )
    numbers = ", ".join(f"{f} {'long' if f.startswith('nr') else 'double'}" for f in FEATURES)
    landed = spark.read.schema(f"key string, {numbers}, batch_id long").parquet(out)
    means = [r6(f).alias(f) if f.startswith("mean") else F.col(f) for f in FEATURES]
    return sinks.latest_rows(landed).select(*means)


@query
def latest_user_event(spark, sf_dir):
    """The last event of every user, landed batch by batch; every fourth batch folds what has landed into a snapshot."""
    rows = sample.events(spark, sf_dir).select(F.col("user_id").alias("key"), "ts", "event_id", "event_type", "value")
    path, schema = _landed(rows.repartition(10, "event_id"), "user-events")
    out, order = scratch_path(spark, "latest-events"), ("ts", "event_id")
    feeds.drain_batches(
        feeds.file_stream(spark, path, schema, max_files=1),
        lambda batch, batch_id: latest.land(batch, batch_id, out, order=order, every=4),
        scratch_path(spark, "latest-checkpoint"),
    )
    newest = latest.read(spark, out, schema, order=order)
    return newest.select("key", stamp("ts").alias("ts"), "event_id", "event_type", "value")


@query
def stream_count_windows(spark, sf_dir):
    ticks = feeds.tick_stream(spark, _numbered_files(spark, sf_dir), max_files=4)
    back = _drained(jobs.count_windows(ticks, lateness=WHOLE_SAMPLE), "count-windows", jobs.COUNT_WINDOW)
    return back.select(
        "window_id",
        stamp("start").alias("start"),
        stamp("stop").alias("stop"),
        F.element_at("prices", 1).alias("first_p"),
        F.element_at("prices", -1).alias("last_p"),
        r6(F.aggregate("prices", F.lit(0.0), lambda a, x: a + x)).alias("sum_p"),
    )


@query
def stream_accounted_windows(spark, sf_dir):
    """Numbered ticks with an account of every point: a tenth come again, and the points of a third of the windows' first
    halves come only after the watermark has passed. Points by what became of them, and the windows they fall in."""
    rows = points(spark, sf_dir).select("t", "p", (F.col("pos") + 1).alias("num"), "window_id")
    held_back = (F.col("window_id") % 3 == 1) & (F.col("num") <= 50)
    path, out, checkpoint = (scratch_path(spark, f"accounted-{n}") for n in ("in", "out", "checkpoint"))
    later = F.lit("2999-01-01").cast("timestamp")
    steps = [
        rows.where(~held_back),
        rows.where(~held_back & (F.col("num") % 10 == 0)),
        spark.range(1).select(later.alias("t"), F.lit(1.0).alias("p"), F.lit(1).alias("num"), F.lit(-1).cast("long").alias("window_id")),
        rows.where(held_back),
    ]
    with jobs.rocksdb_state(spark):
        for step in steps:
            step.select("t", "p", F.col("num").cast("int").alias("num"), F.col("window_id").cast("long").alias("window_id")).write.mode("append").parquet(path)
            schema = "t timestamp, p double, num int, window_id long"
            stream = feeds.file_stream(spark, path, StructType.fromDDL(schema), max_files=None)
            feeds.drain(jobs.accounted_windows(stream, lateness=WHOLE_SAMPLE), out, checkpoint)
    back = spark.read.schema(jobs.ACCOUNTED).parquet(out).where("window_id >= 0")
    return back.groupBy("window_id", "kind").agg(F.sum("n").alias("n"), r6(F.sum(F.aggregate("prices", F.lit(0.0), lambda a, x: a + x))).alias("sum_p"))


@query
def stream_daily_ticks(spark, sf_dir):
    """Days that the watermark has closed; the last day is still open."""
    events = feeds.file_stream(configure(spark), f"{sf_dir}/events.parquet*", schemas.EVENTS, max_files=None)
    ticks = events.select(F.col("ts").alias("t"), F.col("value").alias("p"))
    schema = "day date, count long, min_price double, max_price double, avg_price double"
    back = _drained(jobs.daily_ticks(ticks, lateness="1 hour"), "daily-ticks", schema)
    return back.select(F.col("day").cast("string").alias("day"), "count", "min_price", "max_price", r6("avg_price").alias("avg_price"))


@query
def stream_interval_join(spark, sf_dir):
    """Windows and raw posts as two streams; the join finds the window of each post, and counts zero where there is none.

    Unmatched windows wait for both watermarks: once all is read, a row far in the future on either side moves them on.
    """
    spans = cat.labelled(spark, sf_dir).select("window_id", "start", "stop")
    posts = sample.dated(sample.documents(spark, sf_dir).select("doc_id"), spark, sf_dir)
    window_path, window_schema = _landed(spans, "window-messages")
    post_path, post_schema = _landed(posts.select(F.col("doc_id").cast("string").alias("id"), "created_at"), "raw-posts")
    joined = jobs.pair_windows_with_posts(
        feeds.file_stream(spark, window_path, window_schema, max_files=4),
        feeds.file_stream(spark, post_path, post_schema, max_files=4),
        lateness=WHOLE_SAMPLE,
        longest_window=WHOLE_SAMPLE,
        keep_empty=True,
    )
    out, checkpoint = scratch_path(spark, "interval-join"), scratch_path(spark, "interval-join-checkpoint")
    feeds.drain(joined, out, checkpoint)
    after = F.lit("2999-01-01").cast("timestamp")
    spark.range(1).select(F.lit(None).cast("long").alias("window_id"), after.alias("start"), after.alias("stop")).write.mode("append").parquet(window_path)
    spark.range(1).select(F.lit(None).cast("string").alias("id"), after.alias("created_at")).write.mode("append").parquet(post_path)
    feeds.drain(joined, out, checkpoint)
    back = spark.read.schema("window_id long, id string, created_at timestamp").parquet(out)
    return jobs.posts_of_windows(back.where("window_id IS NOT NULL"))


@query
def stream_fused_labels(spark, sf_dir):
    """Windows and scored posts as two streams, both models and their fusion on the streams themselves: the features that the
    posts model saw, and whether label and probabilities are those of the batch fusion."""
    stock, posts = cat.stock_training(spark, sf_dir), cat.post_training(spark, sf_dir)
    stock_model, posts_model = ml.train(stock.where("is_train"), "rf"), ml.train(posts.where("is_train"), "rf")
    spans = full_windows(window_table(points(spark, sf_dir))).select("window_id", "start", "stop", "prices")
    scored = scored_posts(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), "created_at", "hits", "sum10")
    window_path, window_schema = _landed(spans, "fused-windows")
    post_path, post_schema = _landed(scored, "fused-posts")
    batch = jobs.label_windows_of_batch(
        spark.read.schema(window_schema).parquet(window_path), spark.read.schema(post_schema).parquet(post_path), stock_model, posts_model
    )
    batch = materialise(batch.select("window_id", F.col("label").alias("batch_label"), F.col("prob").alias("batch_prob")), "fused-batch")
    fused = jobs.fused_labels(
        feeds.file_stream(spark, window_path, window_schema, max_files=4),
        feeds.file_stream(spark, post_path, post_schema, max_files=4),
        stock_model,
        posts_model,
        lateness=WHOLE_SAMPLE,
        longest_window=WHOLE_SAMPLE,
    )
    out, checkpoint = scratch_path(spark, "fused-out"), scratch_path(spark, "fused-checkpoint")
    feeds.drain(fused, out, checkpoint)
    # A window that prices can score and a post, both far in the future, move the watermarks past all others.
    after = F.lit("2999-01-01").cast("timestamp")
    flat = F.array_repeat(F.lit(1.0), windows.SIZE)
    spark.range(1).select(F.lit(-1).cast("long").alias("window_id"), after.alias("start"), after.alias("stop"), flat.alias("prices")).write.mode("append").parquet(window_path)
    spark.range(1).select(F.lit("after").alias("id"), after.alias("created_at"), F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("sum10")).write.mode("append").parquet(post_path)
    feeds.drain(fused, out, checkpoint)
    landed = spark.read.schema(fused.schema).parquet(out).where("window_id >= 0")
    same = F.coalesce((F.col("label") == F.col("batch_label")) & (F.col("prob") == F.col("batch_prob")), F.lit(False))
    both = landed.join(batch, "window_id", "full_outer").withColumns({c: stamp(c) for c in ("start", "stop")})
    return cat.rounded(both, "mean_neg", "mean_pos", "mean_neutral").select(
        "window_id", "start", "stop", *FEATURES, same.cast("int").alias("as_batch")
    )


@query
def latest_label_view(spark, sf_dir):
    """Labels arrive in batches under one key; the view shows the newest."""
    rows = cat.labelled(spark, sf_dir).dropna("any", subset=["label"]).select(F.lit("key").alias("key"), "window_id", "label")
    path, schema = _landed(rows, "labels")
    out = scratch_path(spark, "latest-label")
    feeds.drain_batches(
        feeds.file_stream(spark, path, schema, max_files=2),
        lambda batch, batch_id: sinks.upsert_latest(batch, batch_id, out),
        scratch_path(spark, "latest-label-checkpoint"),
    )
    landed = sinks.landed_rows(spark, out, schemas.LABEL_VIEW)
    return sinks.latest_rows(landed, order=("window_id", "batch_id")).select("key", "window_id", "label")


@query
def stream_score_windows(spark, sf_dir):
    """Window messages scored by both models, fused and landed; what must hold for each of them."""
    stock = cat.stock_training(spark, sf_dir)
    posts = cat.post_training(spark, sf_dir)
    stock_model, posts_model = ml.train(stock.where("is_train"), "rf"), ml.train(posts.where("is_train"), "rf")
    messages, schema = _landed(payloads.window_payload(points(spark, sf_dir)), "messages")
    landed_posts = scratch_path(spark, "scored-posts")
    scored = scored_posts(spark, sf_dir).select(F.col("doc_id").cast("string").alias("id"), "created_at", "hits", "sum10")
    tables.write_partitioned(scored.withColumn("day", F.to_date("created_at")), landed_posts, by="day")
    out = scratch_path(spark, "labels-out")
    feeds.drain_batches(
        feeds.file_stream(spark, messages, schema, max_files=4),
        jobs.window_scorer(stock_model, posts_model, landed_posts, out),
        scratch_path(spark, "labels-checkpoint"),
    )
    landed = sinks.landed_rows(spark, out, schemas.LABEL_VIEW)
    return landed.select(
        "window_id",
        F.col("label").between(0, 2).cast("int").alias("known_label"),
        r6(F.aggregate("prob", F.lit(0.0), lambda a, x: a + x)).alias("prob_sum"),
        (F.element_at("prob", F.col("label") + 1) == F.array_max("prob")).cast("int").alias("labels_largest"),
        F.size(F.split("stock", ",")).alias("n_prices"),
        F.size(F.split("posts", ",")).alias("n_features"),
    )


@query
def versioned_scores(spark, sf_dir):
    """Windows in two parts, a new model version between them and a half-written one that nobody may read."""
    rows = cat.stock_training(spark, sf_dir)
    path, out, checkpoint, feed = (scratch_path(spark, f"versioned-{part}") for part in ("models", "out", "checkpoint", "feed"))
    current = versions.Current(path, "rf")
    for part, trees in enumerate((3, 6)):
        model = ml.train(rows.where("is_train"), "rf", numTrees=trees)
        versions.publish(spark, model, path)
        ml.save_model(model.trees[0], f"{path}/versions/{9:020d}-unpublished")
        rows.where(F.pmod("window_id", F.lit(2)) == part).write.mode("append").parquet(feed)
        feeds.drain_batches(feeds.file_stream(spark, feed, rows.schema, max_files=1000), jobs.versioned_scorer(current, out), checkpoint)
    landed = sinks.landed_rows(spark, out, StructType.fromDDL("window_id long, prob array<double>, version int, batch_id long"))
    known = [versions.load(spark, path, "rf", number).model for number in (1, 2)]
    again = rows.select("window_id", "features")
    for number, model in enumerate(known, start=1):
        own = ml.score(model, again).select("window_id", F.struct(F.lit(model.getNumTrees).alias("trees"), "prob").alias(f"v{number}"))
        landed = landed.join(own, "window_id")
    made_by = F.when(F.col("version") == 1, F.col("v1")).otherwise(F.col("v2"))
    return landed.select("window_id", "version", made_by["trees"].alias("trees"), (made_by["prob"] == F.col("prob")).cast("int").alias("as_that_version"))


@query
def stream_posts_accounted(spark, sf_dir):
    """Every post is delivered twice; what became of each delivery."""
    posts = sample.posts(spark, sf_dir).select("id", "created_at", "source")
    path, schema = _landed(posts.unionByName(posts), "posts-accounted")
    with jobs.rocksdb_state(spark):
        back = _drained(jobs.accounted_posts(feeds.file_stream(spark, path, schema, max_files=4), WHOLE_SAMPLE), "accounted", jobs.ACCOUNTED_POSTS)
    return back.groupBy("kind").agg(F.count("*").alias("n"))


@query
def stream_pipeline_scores(spark, sf_dir):
    """A fitted pipeline (pivot, forest) applied to the tick stream itself, in complete mode."""
    ticks = points(spark, sf_dir).select("t", "p", (F.col("pos") + 1).alias("num"), "window_id")
    labels = cat.labelled(spark, sf_dir).dropna("any", subset=["label"])
    pivot = WindowPivot()
    rows = pivot.transform(ticks).join(labels.select("window_id", F.col("label").cast("double")), "window_id")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=ml.N_TREES, seed=ml.SEED)
    fitted = forest.fit(materialise(rows, "pipeline-training"))
    # Neither stage needs fitting again, so fitting the pipeline only strings them together.
    model = Pipeline(stages=[pivot, fitted]).fit(ticks)
    out = scratch_path(spark, "pipeline-scores")
    stream = model.transform(feeds.tick_stream(spark, _numbered_files(spark, sf_dir), max_files=None))
    feeds.drain_batches(
        stream.select("window_id", "prediction"),
        lambda batch, batch_id: sinks.upsert_latest(batch, batch_id, out),
        scratch_path(spark, "pipeline-checkpoint"),
        mode="complete",
    )
    landed = spark.read.schema("window_id long, prediction double, batch_id long").parquet(out)
    newest = sinks.latest_rows(landed, key="window_id")
    return newest.select("window_id", F.col("prediction").between(0, 2).cast("int").alias("known_label"))
