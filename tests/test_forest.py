import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import forest, ml

NODES = (
    "tree int, tree_weight double, depth int, node int, feature int, threshold double, left_values array<double>, "
    "left int, right int, class_weights array<double>, prediction double"
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [(i, i % 3, [rng.gauss(i % 3, 1.5) for _ in range(4)]) for i in range(150)]
    df = spark.createDataFrame(data, "window_id long, label int, prices array<double>")
    return ml.price_features(df).select("window_id", "label", "features").cache()


@pytest.mark.parametrize("kind", ["rf", "ovr_rf", "ovr_svc", "ovr_gbt"])
def test_rebuilt_classes_are_the_models(rows, kind):
    model = ml.train(rows.where("window_id % 3 < 2 OR window_id < 60"), kind, **({"numTrees": 12} if "rf" in kind else {}))
    both = ml.score(model, forest.rebuilt(model, rows)).select("prediction", "rebuilt").collect()
    assert len(both) == 150 and all(r.prediction == r.rebuilt for r in both)
    assert len({r.rebuilt for r in both}) > 1


@pytest.mark.parametrize("kind", ["rf", "ovr_rf", "ovr_svc", "ovr_gbt"])
def test_two_classes_and_no_rows(rows, kind):
    model = ml.train(rows.where("label <> 1"), kind, **({"numTrees": 5} if "rf" in kind else {}))
    both = ml.score(model, forest.rebuilt(model, rows)).select("prediction", "rebuilt").collect()
    assert all(r.prediction == r.rebuilt for r in both) and {r.rebuilt for r in both} <= {0, 2}
    assert forest.rebuilt(model, rows.limit(0)).count() == 0


def test_probabilities_and_shape(spark, rows):
    model = ml.train(rows, "rf", numTrees=9)
    nodes = forest.node_table(spark, model)
    assert nodes.select("tree").distinct().count() == 9 and nodes.count() == model.totalNumNodes
    assert nodes.where("(feature IS NULL) <> (left IS NULL)").count() == 0
    near = model.transform(rows).select(
        forest.probabilities(nodes, vector_to_array("features")).alias("a"), vector_to_array("probability").alias("b")
    )
    assert max(abs(x - y) for r in near.collect() for x, y in zip(r.a, r.b, strict=True)) < 1e-12


def test_categories(spark):
    rng = random.Random(9)
    data = [(i, float(rng.randrange(5)), rng.random()) for i in range(200)]
    df = spark.createDataFrame(data, "id int, c double, x double").withColumn("label", F.expr("double(c IN (1.0, 4.0) OR x > 0.9)"))
    vectors = VectorAssembler(inputCols=["c", "x"], outputCol="raw").transform(df)
    vectors = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(vectors).transform(vectors).cache()
    model = RandomForestClassifier(numTrees=7, seed=1).fit(vectors)
    nodes = forest.node_table(spark, model)
    assert nodes.where("left_values IS NOT NULL").count() > 0
    both = forest.rebuilt(model, model.transform(vectors)).select(F.col("prediction").cast("int").alias("p"), "rebuilt").collect()
    assert all(r.p == r.rebuilt for r in both)


def test_thresholds_ties_nan_and_trees_of_one_leaf(spark):
    nodes = spark.createDataFrame(
        [
            (0, 1.0, 1, 0, 0, 2.0, None, 1, 2, [4.0, 4.0], 0.0),
            (0, 1.0, 1, 1, None, None, None, None, None, [3.0, 1.0], -1.0),
            (0, 1.0, 1, 2, None, None, None, None, None, [1.0, 3.0], 1.0),
            (1, 0.5, 0, 0, None, None, None, None, None, [0.0, 0.0], 0.5),
        ],
        NODES,
    )
    values = spark.createDataFrame([(1, [2.0]), (2, [2.1]), (3, [float("nan")])], "id int, v array<double>")
    got = {
        r.id: (r.p, r.m)
        for r in values.select("id", forest.probabilities(nodes, F.col("v")).alias("p"), forest.boosted_margin(nodes, F.col("v")).alias("m")).collect()
    }
    assert got == {1: ([0.75, 0.25], -0.75), 2: ([0.25, 0.75], 1.25), 3: ([0.25, 0.75], 1.25)}
    assert spark.range(1).select(forest.first_largest(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("c")).first().c == 1


def test_other_models_are_refused(spark, rows):
    with pytest.raises(TypeError):
        forest.rebuilt(ml.index_features(rows), rows)


def test_nodes_are_read_once_and_rows_are_not_shuffled(spark, rows):
    model = ml.train(rows, "rf", numTrees=3)
    plan = forest.rebuilt(model, spark.range(5).select(array_to_vector(F.array(*[F.lit(1.0)] * 4)).alias("features")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    main = text.split("Subquery")[0]
    assert "Exchange" not in main and "BatchEvalPython" not in main and "Join" not in main
