"""Tables kept by window: joins without a shuffle, the same rows."""

import re
import uuid

import pytest
from pyspark.sql import functions as F
from test_plans import executed, no_broadcast  # noqa: F401  (a fixture)

from tidemark.operators import fusion, sampling
from tidemark.plans.catalogue import QUERIES
from tidemark.sources import bucketed

PROB = "window_id long, prob array<double>"


def name() -> str:
    return f"kept_{uuid.uuid4().hex}"


@pytest.fixture
def stored(spark, tmp_path):
    made = []

    def write(rows, schema, buckets=4, **kinds):
        made.append(name())
        df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, schema)
        return bucketed.write(df, made[-1], "window_id", buckets, str(tmp_path / made[-1]), **kinds)

    yield write
    bucketed.drop(spark, *made)


@pytest.mark.parametrize("query", ["fuse_bucketed", "split_join_bucketed"])
def test_registered_joins_do_not_shuffle(spark, sf_dir, no_broadcast, query):  # noqa: F811
    plan = executed(QUERIES[query](spark, sf_dir))
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "Exchange" not in plan and "Bucketed: true" in plan
    scans = re.findall(r"SelectedBucketsCount: (\d+) out of (\d+)", plan)
    assert scans and all(a == b for a, b in scans)


def test_the_same_join_shuffles_without_buckets(spark, sf_dir, no_broadcast):  # noqa: F811
    assert "Exchange hashpartitioning(window_id" in executed(QUERIES["fuse_argmax"](spark, sf_dir))


def test_fusion_is_the_same_and_null_keys_meet_nothing(spark, stored, no_broadcast):  # noqa: F811
    rows = [(i, [i % 7 / 7, i % 5 / 5, i % 3 / 3]) for i in range(200)]
    stock, posts = [*rows, (None, [1.0, 0.0, 0.0])], [(i, p[::-1]) for i, p in rows if i % 4] + [(None, [1.0, 0.0, 0.0])]
    plain = fusion.fuse(spark.createDataFrame(stock, PROB), spark.createDataFrame(posts, PROB))
    kept = fusion.fuse(stored(stock, PROB), stored(posts, PROB))
    assert sorted(kept.collect()) == sorted(plain.collect()) and kept.count() == 150
    assert stored(stock, PROB).count() == 201


def test_a_hot_key_and_an_empty_table(spark, stored, no_broadcast):  # noqa: F811
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).cast("long").alias("window_id"), "id")
    kept = sampling.keep_split(stored(hot, None), stored([(7,), (2999,), (7,)], "window_id long"))
    assert kept.count() == 1001
    assert sampling.keep_split(stored(hot, None), stored([], "window_id long")).count() == 0


def test_grouping_by_the_key_does_not_shuffle(spark, stored):
    counted = stored([(i % 20, i) for i in range(100)], "window_id long, i long").groupBy("window_id").count()
    assert "Exchange" not in executed(counted) and {r["count"] for r in counted.collect()} == {5}


def test_appended_rows_are_found(spark, tmp_path, no_broadcast):  # noqa: F811
    table, path = name(), str(tmp_path / "grown")
    for part in range(3):
        rows = spark.range(part * 100, part * 100 + 100).select(F.col("id").alias("window_id"))
        grown = bucketed.write(rows, table, "window_id", 4, path, mode="append" if part else "error")
    joined = grown.join(grown.select("window_id"), "window_id")
    assert joined.count() == 300 and "Exchange hash" not in executed(joined)
    bucketed.drop(spark, table)


def test_another_layout_is_refused(spark, stored, tmp_path):
    with pytest.raises(ValueError, match="positive"):
        stored([(1,)], "window_id long", buckets=0)
    table = name()
    bucketed.write(spark.range(10).withColumnRenamed("id", "window_id"), table, "window_id", 4, str(tmp_path / "t"))
    assert bucketed.layout(spark, table) == ("window_id", 4)
    for key, buckets in (("window_id", 8), ("other", 4)):
        with pytest.raises(ValueError, match="laid out"):
            bucketed.read(spark, table, key, buckets)
    bucketed.drop(spark, table)
    plain = name()
    spark.range(3).write.option("path", str(tmp_path / "plain")).saveAsTable(plain)
    assert bucketed.layout(spark, plain) is None
    bucketed.drop(spark, plain)
