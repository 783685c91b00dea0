"""Fitted classifiers as tables, scored again by built-in functions.

A tree model becomes one row for each node. Rows are scored by walking from the root of every tree along array elements, so a
forest can be read, joined and checked in SQL, and a job without the ML classes can score with it. One-vs-rest is
rebuilt from the margins of its class models.

The nodes meet the rows as one value: a fitted model has passed the driver, so its size is bounded by trees and depth already.

Defined cases: a value equal to the threshold goes left; a category that the split does not name goes right; NaN goes right; a tree that is one leaf answers
without looking; a leaf without weight does not vote; of equal classes the first wins; no rows give no rows.
"""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LinearSVCModel, OneVsRestModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

_NODE = ("node", "feature", "threshold", "left_values", "left", "right", "class_weights", "prediction")


def node_table(spark: SparkSession, model: RandomForestClassificationModel | GBTClassificationModel) -> DataFrame:
    """One row per node: tree, tree_weight, depth (of its tree), node (0 is the root), feature, threshold or left_values,
    left, right, class_weights, prediction. Leaves have no feature and no children."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    shape = [(i, float(w), t.depth) for i, (w, t) in enumerate(zip(model.treeWeights, model.trees))]
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    continuous = F.col("split.numCategories") < 0
    flat = stored.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & continuous, F.get("split.leftCategoriesOrThreshold", 0)).alias("threshold"),
        F.when(inner & ~continuous, F.col("split.leftCategoriesOrThreshold")).alias("left_values"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.col("impurityStats").alias("class_weights"),
        "prediction",
    )
    return spark.createDataFrame(shape, "tree int, tree_weight double, depth int").join(flat, "tree")


def _packed(nodes: DataFrame) -> Column:
    """All trees as one constant array, each with its nodes at the places of their numbers."""
    each = nodes.groupBy("tree", "tree_weight", "depth").agg(F.array_sort(F.collect_list(F.struct(*_NODE))).alias("nodes"))
    whole = each.agg(F.array_sort(F.collect_list(F.struct("tree", "tree_weight", "depth", "nodes"))).alias("trees"))
    # A subquery can't stand inside array functions, so the value is a literal of the plan.
    text = whole.select(F.to_json("trees")).first()[0]
    return F.from_json(F.lit(text), whole.schema["trees"].dataType)


def _leaf(tree: Column, values: Column) -> Column:
    def step(at: Column, _: Column) -> Column:
        value = F.element_at(values, at["feature"] + 1)
        # NaN is above every number; a missing category is in no list.
        goes_left = F.when(at["threshold"].isNotNull(), value <= at["threshold"]).otherwise(F.array_contains(at["left_values"], value))
        child = F.when(F.coalesce(goes_left, F.lit(False)), at["left"]).otherwise(at["right"])
        return F.when(at["feature"].isNull(), at).otherwise(F.element_at(tree["nodes"], child + 1))

    return F.aggregate(F.sequence(F.lit(1), tree["depth"] + 1), F.element_at(tree["nodes"], 1), step)


def _once(values: Column, use) -> Column:
    """``use(values)`` with the array computed once a row, however often ``use`` looks at it."""
    return F.element_at(F.transform(F.array(values), use), 1)


def _plus(a: Column, b: Column) -> Column:
    return F.when(F.size(a) == 0, b).otherwise(F.zip_with(a, b, lambda x, y: x + y))


def votes(nodes: DataFrame, values: Column) -> Column:
    """Sum over the trees of a forest of each leaf's class shares, in the order of the trees."""

    def of_leaf(tree: Column, v: Column) -> Column:
        return F.transform(F.array(_leaf(tree, v)["class_weights"]), _shares)[0]

    empty = F.array().cast("array<double>")
    trees = _packed(nodes)
    return _once(values, lambda v: F.aggregate(F.transform(trees, lambda t: of_leaf(t, v)), empty, _plus))


def _shares(weights: Column) -> Column:
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def probabilities(nodes: DataFrame, values: Column) -> Column:
    """Class probabilities of a random forest."""
    return F.transform(F.array(votes(nodes, values)), _shares)[0]


def boosted_margin(nodes: DataFrame, values: Column) -> Column:
    """Weighted sum of the leaves' numbers: above 0 means the second class."""
    trees = _packed(nodes)
    return _once(
        values,
        lambda v: F.aggregate(
            F.transform(trees, lambda t: t["tree_weight"] * _leaf(t, v)["prediction"]), F.lit(0.0), lambda a, x: a + x
        ),
    )


def linear_margin(coefficients: list[float], intercept: float, values: Column) -> Column:
    products = F.zip_with(F.array(*map(F.lit, coefficients)), values, lambda w, x: w * x)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x) + F.lit(intercept)


def first_largest(numbers: Column) -> Column:
    """Place of the largest, from 0; the first of equal ones."""
    return (F.array_position(numbers, F.array_max(numbers)) - 1).cast("int")


def _margin(spark: SparkSession, model: Model, values: Column) -> Column:
    """How strongly one class model of one-vs-rest is for its class."""
    if isinstance(model, LinearSVCModel):
        return linear_margin([float(c) for c in model.coefficients], float(model.intercept), values)
    nodes = node_table(spark, model)
    if isinstance(model, GBTClassificationModel):
        return boosted_margin(nodes, values)
    return F.element_at(votes(nodes, values), 2)


def rebuilt(model: Model, rows: DataFrame, out: str = "rebuilt", features: str = "features") -> DataFrame:
    """Add the class that the stored numbers of a model from :func:`tidemark.operators.ml.train` give each row."""
    spark, values = rows.sparkSession, vector_to_array(features)
    if isinstance(model, RandomForestClassificationModel):
        return rows.withColumn(out, first_largest(probabilities(node_table(spark, model), values)))
    if not isinstance(model, PipelineModel) or not isinstance(model.stages[0], OneVsRestModel):
        raise TypeError(f"not a forest or one-vs-rest: {type(model).__name__}")
    one_vs_rest, names = model.stages
    margins = F.array(*[_margin(spark, m, values) for m in one_vs_rest.models])
    labels = F.array(*[F.lit(int(float(x))) for x in names.getLabels()])
    return rows.withColumn(out, F.element_at(labels, first_largest(margins) + 1))
