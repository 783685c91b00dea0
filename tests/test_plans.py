"""The physical plans that large data depends on."""

import re

import pytest

from tidemark.plans import stream_queries  # noqa: F401  (registers the stream queries)
from tidemark.plans.catalogue import QUERIES

BATCH = [q for q in QUERIES if not q.startswith(("stream_", "rf_", "ovr_", "eval_fused", "score_", "model_", "latest_", "split_files", "forest_", "models_", "versioned_"))]


def executed(df) -> str:
    """The plan as it ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def scans(plan: str, column: str) -> int:
    return len(re.findall(rf"FileScan parquet \[[^\]]*{column}#", plan))


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins_and_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"NestedLoop|CartesianProduct|BatchEvalPython|ArrowEvalPython|MapInPandas", plan)


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_labels_scan_and_shuffle_ticks_once(spark, sf_dir, no_broadcast):
    plan = executed(QUERIES["window_labels"](spark, sf_dir))
    assert scans(plan, "ts") == 1
    assert "ReusedExchange" in plan
    assert "PushedFilters: [IsNotNull(ts)]" in plan


def test_training_windows_shuffle_points_once(spark, sf_dir, no_broadcast):
    from tidemark.plans.training import stock_windows
    from tidemark.sources import sample

    plan = executed(stock_windows(sample.ticks(spark, sf_dir)))
    assert scans(plan, "ts") == 1
    made = re.findall(r"(?<!Reused)Exchange hashpartitioning\(window_id#", plan)
    collected = [line for line in plan.splitlines() if "partial_collect_list" in line]
    assert len(collected) == 1 and len(made) <= 3


def test_window_features_tokenise_once(spark, sf_dir, no_broadcast):
    plan = executed(QUERIES["window_post_features"](spark, sf_dir))
    assert plan.count("posexplode") == 1


def test_texts_are_not_shuffled_for_scoring(spark, sf_dir):
    """What leaves the tokenising stage are totals per post."""
    from tidemark.operators.text import polarity
    from tidemark.sources import sample

    plan = executed(polarity(sample.posts(spark, sf_dir), sample.lexicon(spark)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    shuffles = re.findall(r"\bExchange (?:hash|Round|range)", plan)
    sent = [line for line in plan.splitlines() if "HashAggregate" in line and "partial_count" in line]
    assert len(shuffles) == 1 and len(sent) == 1 and not re.search(r"\btext#", sent[0])


def test_day_filter_reaches_the_scan(spark, sf_dir):
    plan = executed(QUERIES["stocks_daily_view"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[IsNotNull\(ts\), GreaterThanOrEqual\(ts,.*LessThan\(ts,", plan)
    assert re.search(r"ReadSchema: struct<ts:timestamp,value:double>", plan)


def test_top_k_is_not_a_sort(spark, sf_dir):
    plan = executed(QUERIES["bottom_k_posts"](spark, sf_dir))
    assert "TakeOrderedAndProject" in plan


def test_single_task_steps_see_blocks_only(spark, sf_dir, no_broadcast):
    """The only step over all data in one task runs over one row per block of buckets."""
    plan = executed(QUERIES["count_window_index"](spark, sf_dir))
    windows = [line for line in plan.splitlines() if " Window [" in line and ", [], [" not in line]
    single = [line for line in windows if re.search(r"\],? \[block#\d+L ASC", line) and "[block" in line]
    assert plan.count("Exchange SinglePartition") == 1 and single


@pytest.mark.parametrize("name", ["polarity_lexicon", "window_post_features", "posts_daily_view", "top_terms_positive", "mean_sentiment_by_hour", "minute_counts_posts", "contains_slice"])
def test_texts_stay_where_they_are(spark, sf_dir, no_broadcast, name):
    """No shuffle of a registered query carries texts, not even with nothing broadcast."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bExchange (hash|Round|range)", line):
            below = re.search(r"(Project|HashAggregate|ObjectHashAggregate) ?\((?:[^\n]*?)|\[.*", lines[i + 1])
            kept = lines[i + 1] if "HashAggregate" not in lines[i + 1] else lines[i + 1].split("functions=")[0]
            assert below is None or not re.search(r"[\[ ,]text#\d+[,\]]", kept), lines[i : i + 2]


def test_first_points_are_a_top_k(spark, sf_dir):
    from tidemark.operators.series import price_series
    from tidemark.operators.windows import count_window_index
    from tidemark.sources import sample

    plan = executed(count_window_index(price_series(sample.ticks(spark, sf_dir)).orderBy("t").limit(1500)))
    assert "TakeOrderedAndProject" in plan


def test_interval_counts_take_few_shuffles(spark, sf_dir, no_broadcast):
    plan = executed(QUERIES["interval_join_counts"](spark, sf_dir))
    assert len(re.findall(r"(?<!Reused)Exchange hash", plan)) <= 14
