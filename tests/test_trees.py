"""Forests that grow in the executors."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from offer_engine import config as C
from offer_engine.operators import evaluation, forest, trees
from offer_engine.functions.columns import hash32
from offer_engine.sources.models import ModelStore

PARAMS = C.ForestParams(num_trees=8, max_depth=8)


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(3)
    made = [(f"a{i}", random.random(), float(random.randrange(4)), random.gauss(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(made, "account_id string, x double, k double, z double").withColumn(
        C.LABEL, 10 * F.col("x") + 3 * F.col("k") + F.when(F.col("z") > 0, 5.0).otherwise(0.0)
    )
    vectors = VectorAssembler(inputCols=["x", "k", "z"], outputCol="features").transform(df)
    kept = vectors.withColumn("offer_type", F.lit(C.BOGO)).withColumn(
        "split", F.when(hash32("account_id") % 5 == 0, "test").otherwise("train")
    ).repartition(4, "account_id").cache()
    kept.count()
    return kept


def errors(model, rows):
    return evaluation.regression_metrics(forest.score(model, rows)).first()


def walked(model, x):
    """The prediction by plain recursion."""
    cuts, total = model._data["cuts"], 0.0
    for i in range(model.getNumTrees):
        f, b, left, v = model.tree(i)
        n = 0
        while left[n] >= 0:
            n = left[n] + int(x[f[n]] > cuts[f[n]][b[n]])
        total += v[~left[n]]
    return total / model.getNumTrees


def test_as_good_as_spark_ml(rows):
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    own = errors(forest.train_forest(train, PARAMS), test)
    theirs = RandomForestRegressor(
        featuresCol="features", labelCol=C.LABEL, numTrees=8, maxDepth=8, seed=42
    ).fit(train)
    assert own.rmse < 1.25 * evaluation.regression_metrics(theirs.transform(test)).first().rmse


@pytest.mark.parametrize("task_rows", [trees.TASK_ROWS, 200])
def test_scores_are_the_mean_of_the_trees(rows, task_rows):
    model = trees.fit(rows, C.LABEL, 5, 7, 1, task_rows)
    for r in forest.score(model, rows).limit(40).collect():
        assert r.prediction == pytest.approx(walked(model, r.features.toArray()))


def test_no_task_holds_more_rows_than_asked_for(rows):
    """Large nodes are split by histograms, and the trees are as good as others."""
    whole, cut = (trees.fit(rows, C.LABEL, 8, 8, 5, n) for n in (trees.TASK_ROWS, 300))
    assert errors(cut, rows).rmse < 1.25 * errors(whole, rows).rmse
    top = trees._Top(1000, 0.0)
    top.split({"node": 0, "found": True, "feature": 1, "bin": 2, "left_rows": 600, "right_rows": 400,
               "value": 1.0, "left_value": 0.0, "right_value": 2.0})
    assert top.large(500, 8) == [1] and top.large(500, 1) == []
    assert top.dealt(1000) == [[1, 2]] and top.dealt(700) == [[1], [2]]
    same = trees.fit(rows, C.LABEL, 8, 8, 5, 300)
    assert same.toDebugString.split("\n", 1)[1] == cut.toDebugString.split("\n", 1)[1]


def test_a_tree_takes_the_best_split_and_stops_at_pure_nodes():
    x = np.array([[0, 3], [0, 4], [1, 3], [1, 4]] * 5, np.uint8)
    y = np.array([1.0, 1.0, 7.0, 7.0] * 5)
    f, b, left, v = trees.grown(x, y, np.ones(20, np.uint8), 15, 2, np.random.default_rng(0))
    assert list(left) == [1, ~0, ~1] and f[0] == 0 and b[0] == 0 and list(v) == [1.0, 7.0]


def test_thresholds_lie_between_values():
    points, counts = np.array([3.0, 1.0, 1.0, 2.0]), np.array([1, 4, 1, 2])
    assert trees.thresholds(points, counts) == [1.5, 2.5]
    many = trees.thresholds(np.arange(1000.0), np.ones(1000, int))
    assert len(many) == trees.BINS - 1 and many == sorted(many)
    assert trees.thresholds(np.array([4.0]), np.array([9])) == []


def test_training_reads_no_row_twice_for_a_level(spark, rows):
    """a forest is a few jobs, however deep; a job for each level took the time before."""
    tracker, group = spark.sparkContext.statusTracker(), "forest jobs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        forest.train_forest(rows, C.ForestParams(num_trees=3, max_depth=14))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(tracker.getJobIdsForGroup(group)) <= 10


def test_segments_and_metrics_are_a_few_jobs(spark, rows):
    """F1 F5 F6: so are the forests of all segments; a segment took more jobs than levels before."""
    two = rows.withColumn("offer_type", F.when(F.col("k") > 1, C.BOGO).otherwise(C.DISCOUNT))
    tracker, group = spark.sparkContext.statusTracker(), "segment jobs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        models = forest.train_segments(two, params=C.ForestParams(num_trees=3, max_depth=14))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(models) == {C.BOGO, C.DISCOUNT}
    assert 0 < len(tracker.getJobIdsForGroup(group)) <= 10 * len(C.SEGMENTS)


def test_driver_holds_ten_bytes_a_node(rows):
    """F2 F3 F4: the driver held each node as objects of 100 bytes and more, and once more to save them."""
    model = trees.fit(rows, C.LABEL, 8, 12, 5)
    held = sum(model._data[k].nbytes for k in ("feature", "cut", "left", "value"))
    assert held <= 11 * model.totalNumNodes


def test_saved_forest_is_the_same_and_spark_ml_ones_are_read(spark, rows, tmp_path):
    store = ModelStore(spark, str(tmp_path / "models"))
    model = trees.fit(rows, C.LABEL, 4, 5, 9)
    assert store.save("rf_model_bogo", model, {}, {}, ["x", "k", "z"], rows) == 1
    loaded = store.load("rf_model_bogo")
    assert loaded.uid == model.uid and loaded.toDebugString == model.toDebugString
    theirs = RandomForestRegressor(labelCol=C.LABEL, numTrees=2, maxDepth=2, seed=1).fit(rows)
    path = f"{store.root}/rf_model_bogo/v=2"
    theirs.write().save(path)
    line = ("rf_model_bogo", 2, path, {}, {}, ["x"], "", "[]")
    spark.createDataFrame([line], store.runs().schema).write.parquet(f"{store.root}/model_runs/rf_model_bogo-2")
    assert store.load("rf_model_bogo").getNumTrees == 2
    assert forest.score(store.load("rf_model_bogo"), rows).filter("prediction is null").count() == 0


def test_few_rows_and_equal_ones(spark):
    """A tree's bootstrap may take no row; it predicts the mean of all then."""
    df = spark.createDataFrame([(1.0, 2.0)], "x double, total_spent double")
    one = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = forest.train_forest(one, C.ForestParams(num_trees=9, max_depth=3))
    assert [r.prediction for r in forest.score(model, one).collect()] == [2.0]


def test_nulls_are_refused(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 1.0)], "x double, total_spent double")
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    with pytest.raises(Exception, match="null"):
        forest.train_forest(rows, PARAMS)
