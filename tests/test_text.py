from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import sentiment as sent
from tidemark.operators import text
from tidemark.plans.views import posts_daily_view, stocks_daily_view

DAY = datetime(2024, 5, 1)
POSTS = "id string, text string, created_at timestamp, source string, ingestion_date date"


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame([("good", 8), ("bad", -7), ("fine", 2), ("meh", -2)], "w string, pol10 int")


def posts(spark, texts, day=DAY):
    return spark.createDataFrame([(str(i), t, day, "web", day.date()) for i, t in enumerate(texts)], POSTS)


def polarity_of(spark, lexicon, texts):
    rows = text.polarity(posts(spark, texts), lexicon).collect()
    return {r.id: (r.n_tokens, r.hits, r.sum10, r.pos_hits, r.neg_hits) for r in rows}


def test_polarity_counts_matches(spark, lexicon):
    got = polarity_of(spark, lexicon, ["Good, GOOD bad!", "nothing here", "", None, "fine_x fine"])
    assert got == {"0": (3, 3, 9, 2, 1), "1": (2, 0, 0, 0, 0), "2": (0,) * 5, "3": (0,) * 5, "4": (2, 1, 2, 1, 0)}


def test_whole_text_counts(spark, lexicon):
    got = polarity_of(spark, lexicon, ["word " * 30_000 + "good"])
    assert got["0"] == (30_001, 1, 8, 1, 0)


def test_equal_posts_merge_and_are_counted(spark, lexicon):
    df = posts(spark, ["good bad fine"])
    merged = text.polarity(df.union(df).union(df), lexicon).collect()
    assert [(r.copies, r.n_tokens, r.hits, r.sum10) for r in merged] == [(3, 3, 3, 3)]


def test_one_id_with_two_texts_stays_two_posts(spark, lexicon):
    df = posts(spark, ["good"]).union(posts(spark, ["bad bad"])).union(posts(spark, ["good"]))
    got = sorted((r.id, r.copies, r.hits, r.sum10) for r in text.polarity(df, lexicon).collect())
    assert got == [("0", 1, 2, -14), ("0", 2, 1, 8)]


def test_tokens_keep_other_scripts_and_positions(spark):
    df = spark.createDataFrame([(1, "Élan naïve-Wort ß_1 数据 9")], "id int, text string")
    rows = text.tokens(df).orderBy("position").collect()
    assert [r.token for r in rows] == ["élan", "naïve", "wort", "ß_1", "数据", "9"]


@pytest.mark.parametrize(
    ("sum10", "hits", "closed", "opened"),
    [
        (2, 1, "neutral", None),
        (-2, 1, "neutral", None),
        (5, 2, "pos", "pos"),
        (-5, 2, "neg", "neg"),
        (3, 2, "neutral", "neutral"),
        (0, 0, "neutral", "neutral"),
        (600, 300, "neutral", None),
        (601, 300, "pos", "pos"),
    ],
)
def test_bucket_borders(spark, sum10, hits, closed, opened):
    df = spark.createDataFrame([(sum10, hits)], "sum10 long, hits long")
    got = df.withColumn("s", sent.polarity_value()).select(
        sent.sentiment_bucket().alias("c"),
        sent.sentiment_bucket(closed_neutral=False).alias("o"),
        sent.bucket_of_score("s").alias("sc"),
        sent.bucket_of_score("s", False).alias("so"),
    )
    assert tuple(got.first()) == (closed, opened, closed, opened)


def test_no_number_is_in_no_bucket(spark):
    df = spark.createDataFrame([(float("nan"),), (None,)], "sentiment double")
    assert [r[0] for r in df.select(sent.bucket_of_score()).collect()] == [None, None]


def test_features_of_nothing(spark):
    empty = spark.createDataFrame([], "sum10 long, hits long")
    assert tuple(sent.sentiment_features(empty).first()) == (0, 0, 0, None, None, None)
    filled = sent.sentiment_features(empty, defaults=sent.EMPTY_MEANS).first()
    assert tuple(filled) == (0, 0, 0, -0.4, 0.4, 0.0)


def test_partial_features_add_up(spark):
    rows = [(i % 3, i % 2, (i * 7) % 31 - 15, i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "instant int, part int, sum10 long, hits long")
    direct = sent.sentiment_features(df, keys=("part",)).orderBy("part").collect()
    steps = sent.combine_features(sent.partial_features(df, ("part", "instant")), ("part",)).orderBy("part").collect()
    assert [tuple(r) for r in direct] == [tuple(r) for r in steps]


def test_day_view_counts_before_and_features_after_duplicates(spark, lexicon):
    df = posts(spark, ["good", "bad bad", "fine"])
    twice = df.union(df.where("id = '0'"))
    other_day = posts(spark, ["good"], day=datetime(2024, 5, 2))
    view = posts_daily_view(twice.union(other_day), lexicon, DAY).first()
    assert (view["count"], view.nr_neg, view.nr_pos, view.nr_neutral) == (4, 1, 1, 1)
    assert (view.mean_neg, view.mean_pos, view.mean_neutral) == (-0.7, 0.8, 0.2)


def test_day_views_without_rows(spark, lexicon):
    view = posts_daily_view(posts(spark, ["good"]), lexicon, datetime(2030, 1, 1)).first()
    assert view["count"] == 0 and view.nr_pos == 0 and view.mean_pos is None
    ticks = spark.createDataFrame([], "p double, ingestion_date date")
    view = stocks_daily_view(ticks, DAY).first()
    assert view["count"] == 0 and view.min_price is None and view.day == DAY.date()


def test_last_day_takes_todays_partition(spark):
    rows = [(float(d), DAY.replace(day=d).date()) for d in range(1, 6)]
    ticks = spark.createDataFrame(rows, "p double, ingestion_date date")
    at_noon = stocks_daily_view(ticks, datetime(2024, 5, 3, 12)).first()
    assert (at_noon["count"], at_noon.min_price) == (1, 3.0)


def test_view_keys_repeat(spark):
    ticks = spark.createDataFrame([(1.0, DAY.date())], "p double, ingestion_date date")
    first, again = (stocks_daily_view(ticks, DAY).first().key for _ in range(2))
    assert first == again != stocks_daily_view(ticks, datetime(2024, 5, 2)).first().key


def test_capitalised_stop_words_stay(spark):
    df = spark.createDataFrame([("The cat the THE dog Cat",)], "text string")
    stop = spark.createDataFrame([("the",)], "w string")
    top = text.top_terms(df, stop).collect()
    assert [(r.term, r.n) for r in top] == [("cat", 2), ("the", 2), ("dog", 1)]


def test_allow_list_applies_after_the_cut(spark):
    df = spark.createDataFrame([("a a a b b c",)], "text string")
    top = text.top_terms(df, spark.createDataFrame([], "w string"), k=2)
    assert [r.term for r in text.allowed_terms(top, ["b", "c"]).collect()] == ["b"]


def test_share(spark, lexicon):
    df = text.polarity(posts(spark, ["good good bad other"]), lexicon)
    assert df.select(text.polarity_share().alias("s"), F.lit(0)).first().s == 0.25
