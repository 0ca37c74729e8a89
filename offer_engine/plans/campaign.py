"""The composite jobs: ingest, consolidation, customer features, training, uplift report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from offer_engine import config as C
from offer_engine import schemas
from offer_engine.operators import dataset, evaluation, features, forest, ingest, split, uplift
from offer_engine.operators.attribution import attribute_offers
from offer_engine.operators.skew import LogSkew
from offer_engine.operators.trees import Forest
from offer_engine.sources.models import ModelStore
from offer_engine.sources.tables import (
    create_namespace,
    read_json,
    read_table,
    save_table,
    scratch,
    shared_folder,
    store,
)

VERSION = StructField("model_version", IntegerType())
# Ties of one account's rows are broken by these columns of the training table.
ROW_ORDER = ("offer_id", "has_web", "has_email", "has_mobile", "has_social")


def ingest_offers(
    spark: SparkSession, path: str, names: C.TableNames, channel_mode: str = "exploded"
) -> DataFrame:
    """The offers table: one row per channel ("exploded") or one per offer ("per_offer")."""
    shape = {"exploded": ingest.explode_channels, "per_offer": ingest.per_offer}[channel_mode]
    return save_table(shape(read_json(spark, path, schemas.OFFERS)), names.qualified("offers"))


def ingest_profile(
    spark: SparkSession, path: str, names: C.TableNames, as_of: dt.date | None = None
) -> DataFrame:
    raw = read_json(spark, path, schemas.PROFILE)
    return save_table(ingest.clean_profile(raw, as_of), names.qualified("profile"))


def ingest_transactions(
    spark: SparkSession, path: str, names: C.TableNames, schema=schemas.NUMBERED_INTERACTIONS
) -> DataFrame:
    """Flat events with the log's row numbers, which are added here where it has none."""
    raw = read_json(spark, path, schema)
    events = ingest.number_rows(ingest.flatten_interactions(raw))
    return save_table(events, names.qualified("transactions"))


def account_offers(
    events: DataFrame, skew: LogSkew | None = None, week_length: float = C.WEEK_LENGTH
) -> DataFrame:
    """Attributed events rolled up to (account, offer)."""
    return dataset.account_offer_rollup(attribute_offers(events, skew=skew), week_length)


def consolidated(
    events: DataFrame, profile: DataFrame, offers: DataFrame, skew: LogSkew | None = None
) -> DataFrame:
    """The training table: one row per account, offer and row of the offer in offers.

    With one offer row per channel each row carries that channel's flag; with one row per offer
    (channels as an array) it carries all of them.
    """
    return dataset.consolidate(
        account_offers(events, skew), profile, ingest.channel_flags(offers)
    )


def customer_features(
    events: DataFrame,
    profile: DataFrame,
    offers: DataFrame,
    skew: LogSkew | None = None,
    week_length: float = C.WEEK_LENGTH,
) -> DataFrame:
    """One row per account with all feature sets. offers has one row per offer, or per channel."""
    return features.customer_features(
        account_offers(events, skew, week_length), profile, ingest.one_row_per_offer(offers)
    )


def prepared(table: DataFrame) -> DataFrame:
    return features.prepare_features(features.encode_gender(table))


def model_splits(table: DataFrame, train_ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """The training table with filled features and a split."""
    filled = features.fill_features(features.encode_gender(table))
    return split.assign_split(filled, train_ratio, seed)


def train(
    splits: DataFrame,
    params: C.ForestParams = C.ForestParams(),
    segments: Sequence[str] = C.SEGMENTS,
    models_in: ModelStore | None = None,
) -> tuple[Mapping[str, Forest], DataFrame]:
    """Fit and evaluate a model per segment; save them where a store is given.

    splits is a stored table with a split column. Returns the models and their metrics, with the
    version that each was saved as (null without a store).
    """
    vectors = features.prepare_features(splits)
    models = forest.train_segments(vectors, segments, params)
    # One row per segment, kept so that reading it does not score the test side again.
    metrics = forest.evaluate_segments(models, vectors)
    found = metrics.collect()
    versions = {}
    if models_in is not None:
        by_segment = {r["offer_type"]: r.asDict() for r in found}
        for segment, model in models.items():
            tested = by_segment.get(segment, {})
            versions[segment] = models_in.save(
                f"rf_model_{segment}",
                model,
                {
                    "offer_type": segment,
                    "num_trees": params.num_trees,
                    "max_depth": params.max_depth,
                    "num_features": len(C.FEATURES),
                },
                {f"test_{k}": tested.get(k) for k in ("mae", "rmse", "r2")},
                list(C.FEATURES),
                forest.segment_rows(vectors, segment, "train"),
            )
    # A model without a test row has a version and no metrics.
    rows = [(*r, versions.get(r["offer_type"])) for r in found]
    names = len(metrics.columns) - 1
    rows += [(s, *[None] * names, v) for s, v in versions.items() if s not in {r[0] for r in found}]
    schema = StructType([*[StructField(f.name, f.dataType) for f in metrics.schema], VERSION])
    return models, splits.sparkSession.createDataFrame(rows, schema)


def saved_models(
    models_in: ModelStore,
    segments: Sequence[str] = C.SEGMENTS,
    versions: Mapping[str, int] | None = None,
) -> Mapping[str, Forest]:
    """The saved model of each segment that has one, the newest unless a version is given."""
    saved = {r["model"] for r in models_in.runs().select("model").distinct().collect()}
    versions = versions or {}
    return {
        s: models_in.load(f"rf_model_{s}", versions.get(s))
        for s in segments
        if f"rf_model_{s}" in saved
    }


def evaluate_saved(
    splits: DataFrame,
    models_in: ModelStore,
    segments: Sequence[str] = C.SEGMENTS,
    versions: Mapping[str, int] | None = None,
) -> DataFrame:
    """Metrics of saved models on the test side of stored splits, without fitting."""
    models = saved_models(models_in, segments, versions)
    return forest.evaluate_segments(models, features.prepare_features(splits))


def scored_accounts(
    models: Mapping[str, Forest], table: DataFrame
) -> DataFrame:
    """Every account of the training table scored by every model.

    A segment without a model predicts nothing.
    """
    accounts = forest.account_rows(table, ROW_ORDER)
    scored = forest.score_accounts(models, prepared(accounts))
    missing = [s for s in C.SEGMENTS if s not in models]
    return scored.withColumns({f"pred_{s}": F.lit(None).cast("double") for s in missing})


def test_uplift(splits: DataFrame, recommended: DataFrame) -> DataFrame:
    """Test rows with treatment flag and uplift."""
    return uplift.add_uplift(uplift.join_predictions(split.test_rows(splits), recommended))


def one_test_row(rows: DataFrame) -> DataFrame:
    """The columns of the curve, one row per account."""
    chosen = split.one_row_per_key(rows, ["account_id"], ROW_ORDER)
    return chosen.select("account_id", C.LABEL, "t", "uplift")


def campaign(
    spark: SparkSession,
    offers_path: str,
    profile_path: str,
    transactions_path: str,
    names: C.TableNames,
    as_of: dt.date | None = None,
    params: C.ForestParams = C.ForestParams(),
    interaction_schema=schemas.NUMBERED_INTERACTIONS,
    channel_mode: str = "exploded",
    models_root: str | None = None,
) -> DataFrame:
    """Everything from the three JSON inputs to the uplift report.

    Models go to models_root, by default the folder `models` in that of the schema, where versions
    add up over runs.

    Each step reads the tables of the step before it, so a lost executor repeats one step's
    tasks and never the whole chain. Returns one row per segment: model metrics and version, how
    many accounts the segment is recommended to, and the area under the uplift curve. Scratch
    folders are removed when the step that made them is done.
    """
    create_namespace(spark, names)
    # The three inputs do not depend on each other.
    steps = (
        lambda: ingest_offers(spark, offers_path, names, channel_mode),
        lambda: ingest_profile(spark, profile_path, names, as_of),
        lambda: ingest_transactions(spark, transactions_path, names, interaction_schema),
    )
    with ThreadPool(len(steps)) as pool:
        offers, profile, events = pool.map(
            lambda step: step(), map(inheritable_thread_target(spark), steps)
        )
    with scratch():
        table = save_table(consolidated(events, profile, offers), names.qualified("consolidated"))
    if models_root is None:
        location = spark.catalog.getDatabase(names.namespace).locationUri
        models_root = f"{location.rstrip('/')}/models"
    return uplift_report(table, names.qualified("splits"), models_root, params)


def uplift_report(
    table: DataFrame,
    splits_name: str,
    models_root: str,
    params: C.ForestParams = C.ForestParams(),
) -> DataFrame:
    """Splits, models and the report, one row per segment that has accounts, a model or a
    recommendation: its accounts, metrics on its test rows (null without a model or such rows), the
    version this run saved, accounts it is recommended to, and the area under the curve."""
    spark = table.sparkSession
    with scratch():
        report = _report(table, splits_name, models_root, params)
        # A row for each segment, kept so that what it was made from can go.
        return spark.createDataFrame(report.collect(), report.schema)


def _report(
    table: DataFrame, splits_name: str, models_root: str, params: C.ForestParams
) -> DataFrame:
    spark = table.sparkSession
    folder = shared_folder(spark)
    splits = save_table(
        model_splits(table), splits_name, partition_by=("offer_type", "split")
    )
    models_in = ModelStore(spark, models_root)
    trained, metrics = train(splits, params, models_in=models_in)
    # The versions of this run, whatever other runs have saved since.
    versions = {r["offer_type"]: r["model_version"] for r in metrics.collect()}
    loaded = saved_models(models_in, tuple(trained), versions)
    recommended = uplift.recommend_offer(
        store(scored_accounts(loaded, table), f"{folder}/scored")
    )
    curve_rows = store(one_test_row(test_uplift(splits, recommended)), f"{folder}/uplift")
    curve = evaluation.qini_curve(curve_rows, C.LABEL, "t", "uplift", "account_id")
    chosen = recommended.groupBy("recommended_offer").agg(
        F.count(F.lit(1)).alias("recommended_accounts")
    )
    accounts = table.na.fill(C.NO_OFFER_TYPE, ["offer_type"]).groupBy("offer_type").agg(
        F.count_distinct("account_id").alias("accounts")
    )
    # One row per segment on every side: all that have accounts, a model, or a recommendation.
    return (
        metrics.join(chosen.withColumnRenamed("recommended_offer", "offer_type"), "offer_type", "full")
        .join(accounts, "offer_type", "full")
        .na.fill(0, ["recommended_accounts", "accounts"])
        .withColumn("auuc", F.lit(evaluation.auuc(curve).first()["auuc"]))
    )
