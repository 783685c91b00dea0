import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.sentiment import FEATURES
from tidemark.operators import ml
from tidemark.operators.transformers import SentimentFeatures, WindowPivot


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(i, i % 3, [rng.gauss(i % 3, 0.2) for _ in range(5)]) for i in range(120)]
    df = spark.createDataFrame(data, "window_id long, label int, prices array<double>")
    return ml.price_features(df).select("window_id", "label", "features").cache()


@pytest.mark.parametrize("kind", ["rf", "ovr_rf", "ovr_svc", "ovr_gbt"])
def test_classifiers_learn_an_easy_case(rows, kind):
    params = {"numTrees": 10} if "rf" in kind else {}
    scored = ml.score(ml.train(rows, kind, **params), rows)
    assert ml.evaluate(scored) > (0.6 if kind == "ovr_svc" else 0.95)
    assert ("prob" in scored.columns) == (kind == "rf")


@pytest.mark.parametrize("kind", ["rf", "ovr_rf", "ovr_svc"])
def test_a_missing_class_is_no_problem(rows, kind):
    two = rows.where("label <> 1")
    params = {"numTrees": 5} if "rf" in kind else {}
    scored = ml.score(ml.train(two, kind, **params), rows)
    assert {r.prediction for r in scored.collect()} == {0, 2}
    if kind == "rf":
        assert {len(r.prob) for r in scored.collect()} == {3}


def test_same_seed_same_model(rows):
    first, second = (ml.score(ml.train(rows, "rf", numTrees=5), rows).orderBy("window_id").collect() for _ in range(2))
    assert first == second


@pytest.mark.parametrize("kind", ["rf", "ovr_svc"])
def test_saved_models_score_alike(rows, tmp_path, kind):
    params = {"numTrees": 5} if kind == "rf" else {}
    model = ml.train(rows, kind, **params)
    ml.save_model(model, str(tmp_path / "m"))
    again = ml.load_model(str(tmp_path / "m"), kind)
    assert ml.score(model, rows).orderBy("window_id").collect() == ml.score(again, rows).orderBy("window_id").collect()


def test_unknown_kind():
    with pytest.raises(ValueError):
        ml.classifier("svm")


def test_missing_numbers_are_refused_and_missing_prices_left_out(spark):
    features = spark.createDataFrame([(1, 2, 3, None, 0.4, 0.0)], "nr_neg int, nr_pos int, nr_neutral int, mean_neg double, mean_pos double, mean_neutral double")
    with pytest.raises(Exception, match="(?i)null"):
        ml.assemble(features, FEATURES).collect()
    prices = spark.createDataFrame([(1, [1.0, None]), (2, [1.0, 2.0])], "window_id long, prices array<double>")
    assert [r.window_id for r in ml.price_features(prices).collect()] == [2]


def test_label_index_order(spark):
    df = spark.createDataFrame([(x,) for x in "bbbaaccc"], "label string")
    assert ml.index_labels(df).labels == ["b", "c", "a"]


def test_feature_index(spark):
    df = ml.price_features(spark.createDataFrame([([float(i % 2) * 5, float(i)],) for i in range(30)], "prices array<double>"))
    model = ml.index_features(df)
    assert set(model.categoryMaps) == {0}


def test_pivot_stage_keeps_windows_apart(spark):
    data = [(w, n, w * 10.0 + n) for w in range(3) for n in range(1, 5)][:-1]
    df = spark.createDataFrame(data, "window_id long, num int, p double")
    out = WindowPivot(size=4).transform(df).select("window_id", vector_to_array("features").alias("f")).orderBy("window_id")
    assert [(r.window_id, r.f) for r in out.collect()] == [(0, [1.0, 2.0, 3.0, 4.0]), (1, [11.0, 12.0, 13.0, 14.0])]


def test_stages_survive_saving(spark, tmp_path):
    for stage in (WindowPivot(size=7), SentimentFeatures(closedNeutral=False)):
        path = str(tmp_path / type(stage).__name__)
        stage.save(path)
        assert {p.name: v for p, v in type(stage).load(path).extractParamMap().items()} == {
            p.name: v for p, v in stage.extractParamMap().items()
        }


def test_stages_in_a_pipeline(spark):
    df = spark.createDataFrame([(0.5,), (-0.5,), (0.2,)], "sentiment double")
    model = Pipeline(stages=[SentimentFeatures()]).fit(df)
    row = model.transform(df).first()
    assert (row.nr_neg, row.nr_pos, row.nr_neutral, row.mean_neutral) == (1, 1, 1, 0.2)
    assert model.transform(df.where(F.lit(False))).first().mean_pos == 0.4
