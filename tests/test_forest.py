import json
from multiprocessing.pool import ThreadPool
import random
import threading
import time

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fixtures import AS_OF, rows_of
from offer_engine import config as C
from offer_engine.operators import evaluation, forest, ingest, split
from offer_engine.operators.uplift import recommend_offer
from offer_engine.plans import campaign
from offer_engine.sources import testdata
from offer_engine.sources.models import ModelStore
from offer_engine.sources.tables import store

SMALL = C.ForestParams(num_trees=5, max_depth=4)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def linear(spark):
    random.seed(7)
    rows = [(f"a{i}", random.random(), random.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "account_id string, x double, z double").withColumn(
        "total_spent", 10 * F.col("x") + F.col("z")
    )
    assembler = VectorAssembler(inputCols=["x", "z"], outputCol="features")
    return split.assign_split(assembler.transform(df)).cache()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    events = ingest.flatten_interactions(testdata.interactions(spark, SF))
    profiles = ingest.clean_profile(testdata.profile(spark, SF), AS_OF)
    rows = campaign.consolidated(
        events, profiles, ingest.explode_channels(testdata.offers(spark, SF))
    )
    return store(rows, str(tmp_path_factory.mktemp("table") / "t"))


@pytest.fixture(scope="module")
def trained(splits):
    return campaign.train(splits, SMALL)


@pytest.fixture(scope="module")
def splits(table, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("splits") / "s")
    return store(campaign.model_splits(table), folder, ("offer_type", "split"))


def test_forest_beats_the_mean(linear):
    model = forest.train_forest(linear.filter("split = 'train'"), SMALL)
    row = evaluation.regression_metrics(forest.score(model, linear.filter("split = 'test'"))).first()
    assert row.r2_score > 0.8


def test_same_seed_gives_the_same_model(linear):
    train = linear.filter("split = 'train'")
    one, two = forest.train_forest(train, SMALL), forest.train_forest(train, SMALL)
    trees = [m.toDebugString.split("\n", 1)[1] for m in (one, two)]
    assert trees[0] == trees[1]


def test_score_leaves_the_model_as_it_is(linear):
    model = forest.train_forest(linear, SMALL)
    assert "pred_x" in forest.score(model, linear, "pred_x").columns
    assert model.getPredictionCol() == "prediction"


def test_train_and_save_segments(spark, splits, tmp_path):
    models_in = ModelStore(spark, str(tmp_path / "models"))
    models, metrics = campaign.train(splits, SMALL, models_in=models_in)
    assert set(models) == set(C.SEGMENTS)
    assert {r.offer_type for r in metrics.collect()} <= set(C.SEGMENTS)
    runs = {r.model: r for r in models_in.latest().collect()}
    run = runs["rf_model_bogo"]
    assert run.version == 1 and run.params["num_trees"] == "5" and "test_mae" in run.metrics

    loaded = models_in.load("rf_model_bogo")
    vectors = campaign.prepared(splits.filter("offer_type = 'bogo'"))
    assert rows_of(forest.score(loaded, vectors), "account_id", "prediction") == rows_of(
        forest.score(models["bogo"], vectors), "account_id", "prediction"
    )

    row = vectors.limit(5)
    second = models_in.save("rf_model_bogo", models["discount"], {}, {}, list(C.FEATURES), row)
    assert second == 2 and models_in.load("rf_model_bogo", 1).uid == loaded.uid
    assert models_in.load("rf_model_bogo").uid != loaded.uid
    with pytest.raises(LookupError):
        models_in.load("rf_model_bogo", 9)


def test_metrics_of_segments_equal_metrics_of_one(splits, trained):
    models, metrics = trained
    got = {r.offer_type: r.mae for r in metrics.collect()}
    vectors = campaign.prepared(splits)
    for segment, model in models.items():
        test = forest.score(model, forest.segment_rows(vectors, segment, "test"))
        alone = evaluation.regression_metrics(test).first().mae
        assert got.get(segment) == pytest.approx(alone)


def test_every_account_is_scored_once_by_every_model(trained, table):
    models = {s: m for s, m in trained[0].items() if s != "discount"}
    scored = campaign.scored_accounts(models, table)
    accounts = [r.account_id for r in scored.collect()]
    assert sorted(accounts) == sorted({r.account_id for r in table.collect()})
    row = scored.first()
    assert row.pred_bogo is not None and row.pred_discount is None
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert scored.columns[:2] == ["account_id", "total_spent"]


def test_segment_without_training_rows_has_no_model(splits):
    models = forest.train_segments(
        campaign.prepared(splits.filter("offer_type <> 'bogo'")), params=SMALL
    )
    assert "bogo" not in models and "discount" in models


def test_uplift_is_never_negative(splits, trained, table):
    scored = campaign.scored_accounts(trained[0], table)
    rows = campaign.test_uplift(splits, recommend_offer(scored))
    assert rows.filter("uplift < 0").count() == 0
    assert rows.count() == splits.filter("split = 'test'").count()
    one = campaign.one_test_row(rows)
    assert one.count() == one.select("account_id").distinct().count()


def test_versions_add_up_and_saved_models_are_evaluated(spark, splits, tmp_path):
    models_in = ModelStore(spark, str(tmp_path / "models"))
    assert models_in.runs().count() == 0 and not campaign.saved_models(models_in)
    for version in (1, 2):
        _, metrics = campaign.train(splits, SMALL, models_in=ModelStore(spark, models_in.root))
        assert {r.version for r in models_in.latest().collect()} == {version}
    again = campaign.evaluate_saved(splits, models_in, versions={"bogo": 1})
    assert rows_of(again, "offer_type", "n", "mae") == rows_of(metrics, "offer_type", "n", "mae")
    sample = json.loads(models_in.runs().first().sample)
    assert 0 < len(sample) <= 10 and all(len(x) == len(C.FEATURES) for x, _ in sample)


def test_no_model_scores_nothing(splits):
    assert forest.score_own_segment({}, campaign.prepared(splits)).count() == 0


def test_two_runs_at_once_report_their_own_versions(spark, splits, tmp_path):
    root = str(tmp_path / "models")

    def run(trees):
        params = C.ForestParams(num_trees=trees, max_depth=2)
        _, metrics = campaign.train(splits, params, models_in=ModelStore(spark, root))
        return {r.offer_type: r.model_version for r in metrics.collect()}

    with ThreadPool(2) as pool:
        first, second = pool.map(run, (2, 3))
    assert first.keys() == second.keys()
    assert all({first[s], second[s]} == {1, 2} for s in first)
    store = ModelStore(spark, root)
    for trees, versions in ((2, first), (3, second)):
        loaded = campaign.saved_models(store, tuple(versions), versions)
        assert {m.getNumTrees for m in loaded.values()} == {trees}
    assert store.samples().count() > 0


def test_few_forests_grow_at_once(splits, monkeypatch):
    """The driver holds the open nodes of AT_ONCE forests, however many segments there are."""
    running, most, lock = [], [], threading.Lock()

    def fit(train, params, label=C.LABEL):
        with lock:
            running.append(1)
            most.append(len(running))
        time.sleep(0.2)
        with lock:
            running.pop()
        return "model"

    monkeypatch.setattr(forest, "train_forest", fit)
    assert set(forest.train_segments(campaign.prepared(splits), params=SMALL)) == set(C.SEGMENTS)
    assert max(most) <= forest.AT_ONCE


def test_trees_are_not_sent_with_every_level(linear):
    assert forest.train_forest(linear, SMALL).getCacheNodeIds()
