import random

import pytest

from tidemark.operators import ml
from tidemark.sources import latest, versions
from tidemark.streaming import feeds, jobs


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(i, i % 3, [rng.gauss(i % 3, 0.2) for _ in range(3)]) for i in range(60)]
    df = spark.createDataFrame(data, "window_id long, label int, prices array<double>")
    return ml.price_features(df).select("window_id", "label", "features").cache()


@pytest.fixture(scope="module")
def fits(rows):
    return [ml.train(rows, "rf", numTrees=n) for n in (1, 2, 3)]


def test_a_version_counts_once_its_marker_is_there(spark, fits, tmp_path):
    path = str(tmp_path / "models")
    with pytest.raises(LookupError):
        versions.load(spark, path, "rf")
    versions.remove_old(spark, path)
    ml.save_model(fits[2], f"{path}/versions/{7:020d}-died-before-its-marker")
    with pytest.raises(LookupError):
        versions.Current(path, "rf").get(spark)
    assert [versions.publish(spark, fit, path) for fit in fits[:2]] == [1, 2]
    assert versions.load(spark, path, "rf").model.getNumTrees == 2
    assert versions.load(spark, path, "rf", 1).model.getNumTrees == 1
    with pytest.raises(LookupError):
        versions.load(spark, path, "rf", 7)


def test_a_running_job_sees_a_new_version_and_loads_none_twice(spark, fits, tmp_path):
    path = str(tmp_path / "models")
    current = versions.Current(path, "rf")
    versions.publish(spark, fits[0], path)
    first = current.get(spark)
    assert current.get(spark) is first
    versions.publish(spark, fits[1], path)
    assert current.get(spark).number == 2 and current.get(spark).model.getNumTrees == 2


def test_old_versions_go_marker_first(spark, fits, tmp_path):
    path = str(tmp_path / "models")
    for fit in fits:
        versions.publish(spark, fit, path)
    ml.save_model(fits[0], f"{path}/versions/{1:020d}-died")
    ml.save_model(fits[0], f"{path}/versions/{4:020d}-being-written")
    versions.remove_old(spark, path, keep=2)
    assert [int(n[:20]) for n in latest.published(spark, path)] == [2, 3]
    assert [int(n[:20]) for n in latest.names(spark, f"{path}/versions")] == [2, 3, 4]
    assert versions.publish(spark, fits[0], path) == 4


def test_rows_say_which_version_made_them(spark, rows, fits, tmp_path):
    path, feed, out, checkpoint = (str(tmp_path / n) for n in ("models", "feed", "out", "cp"))
    current = versions.Current(path, "rf")
    for part in range(2):
        versions.publish(spark, fits[part], path)
        rows.where(f"window_id % 2 = {part}").coalesce(1).write.mode("append").parquet(feed)
        feeds.drain_batches(feeds.file_stream(spark, feed, rows.schema), jobs.versioned_scorer(current, out), checkpoint)
    back = spark.read.schema("window_id long, prediction int, version int").parquet(out).collect()
    assert len(back) == 60 and all(r.version == r.window_id % 2 + 1 for r in back)
