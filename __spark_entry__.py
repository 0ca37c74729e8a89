"""Every operator as a query over the given tables, with an equal SQL query where one exists."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from offer_engine import config as C
from offer_engine import schemas
from offer_engine.operators import (
    attribution,
    dataset,
    evaluation,
    features,
    forest,
    ingest,
    ordered,
    reports,
    split,
    uplift,
)
from offer_engine.operators.skew import measure_skew
from offer_engine.plans import campaign
from offer_engine.sources import testdata
from offer_engine.sources.models import ModelStore
from offer_engine.sources.tables import (
    read_json,
    read_table,
    save_table,
    shared_folder,
    store,
    temporary_names,
)
from sql_checks import DIGITS, MONEY, ORACLE

# The training-data operators are a part that can be taken out.
LLM_QUERIES, LLM_ORACLE = {}, {}
try:
    from offer_engine.llm.queries import ORACLE as LLM_ORACLE
    from offer_engine.llm.queries import QUERIES

    LLM_QUERIES = dict(QUERIES)
    import corpus_pipeline

    LLM_QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLE = {**LLM_ORACLE, "pipeline": corpus_pipeline.ORACLE_SQL}
except ImportError:
    pass

FOREST = C.ForestParams()
CUTS_500_750 = ((750, "High Spender"), (500, "Medium Spender"))


# Inputs of the queries.


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.flatten_interactions(testdata.interactions(spark, sf))


def _attributed(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.attribute_offers(_events(spark, sf))


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.clean_profile(testdata.profile(spark, sf), testdata.AS_OF)


def _offer_channels(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.explode_channels(testdata.offers(spark, sf))


def _offers(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.per_offer(testdata.offers(spark, sf))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.enriched_events(_attributed(spark, sf), _profile(spark, sf), _offers(spark, sf))


def _consolidated(spark: SparkSession, sf: str) -> DataFrame:
    return campaign.consolidated(
        _events(spark, sf), _profile(spark, sf), _offer_channels(spark, sf)
    )


def _splits(spark: SparkSession, sf: str) -> DataFrame:
    return campaign.model_splits(_consolidated(spark, sf))


def _stored_splits(spark: SparkSession, sf: str) -> DataFrame:
    return store(_splits(spark, sf), shared_folder(spark), ("offer_type", "split"))


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer with a profile, what they spent, and fixed predictions."""
    spent = attribution.user_spend_stats(_events(spark, sf)).select("account_id", "total_spent")
    accounts = _profile(spark, sf).select("account_id").join(spent, "account_id", "left")
    return testdata.with_fixed_predictions(accounts.na.fill(0.0, ["total_spent"]))


def _uplift_rows(spark: SparkSession, sf: str) -> DataFrame:
    """account_id, total_spent, t and uplift, stored because ranking reads them three times."""
    rows = uplift.add_uplift(uplift.recommend_offer(_customers(spark, sf)))
    return store(
        rows.select("account_id", "total_spent", "t", "uplift"), shared_folder(spark)
    )


def _fixed_scores(df: DataFrame) -> DataFrame:
    return testdata.with_fixed_predictions(df).withColumnRenamed("pred_bogo", "prediction")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, DIGITS) for n in names})


# Sources and sinks.


def json_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark)
    testdata.interactions(spark, sf).write.json(path)
    return ingest.flatten_interactions(read_json(spark, path, schemas.NUMBERED_INTERACTIONS))


def _ingested(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The ingest job of one input: JSON files to a catalog table, read back."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = shared_folder(spark)
        source = {"offers": testdata.offers, "profile": testdata.profile}
        source.get(name, testdata.interactions)(spark, sf).write.json(path)
        names = temporary_names(spark)
        if name == "profile":
            return campaign.ingest_profile(spark, path, names, testdata.AS_OF)
        job = {"offers": campaign.ingest_offers, "transactions": campaign.ingest_transactions}
        return job[name](spark, path, names)

    return run


def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    name = temporary_names(spark).qualified("transactions")
    save_table(_events(spark, sf), name)
    return read_table(spark, name)


def segment_split(spark: SparkSession, sf: str) -> DataFrame:
    return _stored_splits(spark, sf).select(
        "account_id", "offer_id", "offer_type", *[f"has_{c}" for c in C.CHANNELS], "split"
    )


def union_test_splits(spark: SparkSession, sf: str) -> DataFrame:
    return split.test_rows(_stored_splits(spark, sf)).select(
        "account_id", "offer_id", "offer_type", *[f"has_{c}" for c in C.CHANNELS]
    )


# Ingest.


def clean_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf)


def offer_channel_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.channel_flags(_offer_channels(spark, sf))


def offer_channel_flags(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.channel_flags(_offers(spark, sf))


# Attribution and the tables built on it.


def extract_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.extract_transactions(_attributed(spark, sf))


def offer_events(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.offer_events(_attributed(spark, sf))


def user_spend_stats(spark: SparkSession, sf: str) -> DataFrame:
    return attribution.user_spend_stats(_events(spark, sf))


#: Rows from which the queries named heavy take an account or an instant for heavy, so that the
#: plans for skewed logs run on tables of any size.
FEW_ROWS = 2


def attribute_offers_heavy(spark: SparkSession, sf: str) -> DataFrame:
    events = store(_events(spark, sf), shared_folder(spark))
    return attribution.attribute_offers(events, skew=measure_skew(events, FEW_ROWS))


def consolidated_heavy(spark: SparkSession, sf: str) -> DataFrame:
    events = store(_events(spark, sf), shared_folder(spark))
    return campaign.consolidated(
        events, _profile(spark, sf), _offer_channels(spark, sf), measure_skew(events, FEW_ROWS)
    )


# Reports.


def daily_activity(spark: SparkSession, sf: str) -> DataFrame:
    return reports.daily_activity(_events(spark, sf))


def completions_by_type_day(spark: SparkSession, sf: str) -> DataFrame:
    return reports.completions_by_type_day(_events(spark, sf), _offer_channels(spark, sf))


def demographics(spark: SparkSession, sf: str) -> DataFrame:
    return reports.demographics(_profile(spark, sf))


def funnel_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return reports.funnel_by_type(_offer_channels(spark, sf), _events(spark, sf))


def offer_performance(spark: SparkSession, sf: str) -> DataFrame:
    return reports.offer_performance(
        _attributed(spark, sf), _profile(spark, sf), _offers(spark, sf)
    )


def spend_per_account(spark: SparkSession, sf: str) -> DataFrame:
    return reports.spend_per_account(_events(spark, sf), _profile(spark, sf))


def spend_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return reports.spend_quantiles(store(spend_per_account(spark, sf), shared_folder(spark)))


def spend_quantiles_approx(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each approximate quantile's rank is within the error asked for."""
    error = 0.01
    totals = store(spend_per_account(spark, sf), shared_folder(spark))
    found = reports.spend_quantiles(totals, error=error)
    amount = F.col("total_amount")
    tests = []
    for row in found.collect():  # one row for each quantile asked for
        share, value = dict(C.QUANTILES)[row["Percentile"]], row["Total Amount"]
        within = (F.count_if(amount < value) <= F.ceil((share + error) * F.count(amount))) & (
            F.count_if(amount <= value) >= F.floor((share - error) * F.count(amount))
        )
        tests.append(F.struct(F.lit(row["Percentile"]).alias("Percentile"), within.alias("within_error")))
    return totals.agg(F.inline(F.array(*tests))) if tests else found.select("Percentile", F.lit(True).alias("within_error"))


def _segment_offer_completion(cuts) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return reports.segment_offer_completion(
            _attributed(spark, sf), _profile(spark, sf), _offers(spark, sf), cuts
        )

    return run


# Feature sets. Accounts without a profile are left out after the events are aggregated. The
# first four sets do not look at offers, so they need no attribution.


def _known(spark: SparkSession, sf: str, table: DataFrame) -> DataFrame:
    return table.join(_profile(spark, sf).select("account_id"), "account_id", "left_semi")


def transaction_features(spark: SparkSession, sf: str) -> DataFrame:
    table = _known(spark, sf, features.transaction_features(_events(spark, sf)))
    return _rounded(table, "transaction_value_std")


def offer_features(spark: SparkSession, sf: str) -> DataFrame:
    return _known(spark, sf, features.offer_features(_events(spark, sf)))


def reward_features(spark: SparkSession, sf: str) -> DataFrame:
    return _known(spark, sf, features.reward_features(_events(spark, sf)))


def time_features(spark: SparkSession, sf: str) -> DataFrame:
    return _known(spark, sf, features.time_features(_events(spark, sf)))


def time_features_days(spark: SparkSession, sf: str) -> DataFrame:
    return _known(spark, sf, features.time_features(_events(spark, sf), week_length=7))


def offer_type_features(spark: SparkSession, sf: str) -> DataFrame:
    table = features.offer_type_features(_attributed(spark, sf), _offers(spark, sf))
    return _known(spark, sf, table)


def channel_features(spark: SparkSession, sf: str) -> DataFrame:
    table = features.channel_features(_attributed(spark, sf), _offers(spark, sf))
    return _known(spark, sf, table)


def customer_features(spark: SparkSession, sf: str) -> DataFrame:
    table = campaign.customer_features(
        _events(spark, sf), _profile(spark, sf), _offers(spark, sf), week_length=7
    )
    return _rounded(table, "transaction_value_std")


def encode_gender(spark: SparkSession, sf: str) -> DataFrame:
    return features.encode_gender(testdata.profile(spark, sf)).select("id", "gender", "gender_idx")


def prepare_features(spark: SparkSession, sf: str) -> DataFrame:
    return campaign.prepared(_consolidated(spark, sf)).select(
        "account_id", "offer_id", "offer_type", *C.FEATURES
    )


# Row choice.


def distinct_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return split.distinct_accounts(_consolidated(spark, sf))


def one_row_per_account(spark: SparkSession, sf: str) -> DataFrame:
    return forest.account_rows(_consolidated(spark, sf), campaign.ROW_ORDER)


# Metrics and uplift, with fixed predictions in place of a model's.


def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = _fixed_scores(_consolidated(spark, sf))
    return _rounded(evaluation.regression_metrics(scored), "mae", "rmse", "r2", "r2_score")


def segment_metrics(spark: SparkSession, sf: str) -> DataFrame:
    test = split.test_rows(_stored_splits(spark, sf))
    metrics = evaluation.segment_metrics(_fixed_scores(test))
    return _rounded(metrics, "mae", "rmse", "r2", "r2_score")


def recommend_offer(spark: SparkSession, sf: str) -> DataFrame:
    return uplift.recommend_offer(_customers(spark, sf))


def uplift_rows(spark: SparkSession, sf: str) -> DataFrame:
    recommended = uplift.recommend_offer(_customers(spark, sf))
    return campaign.test_uplift(_stored_splits(spark, sf), recommended).select(
        "account_id",
        "offer_id",
        "offer_type",
        *[f"has_{c}" for c in C.CHANNELS],
        "total_spent",
        "max_prediction",
        "recommended_offer",
        "t",
        "uplift",
    )


def uplift_rank(spark: SparkSession, sf: str) -> DataFrame:
    return ordered.global_rank(_uplift_rows(spark, sf), "uplift", "account_id")


def qini_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.qini_cumulative(
        _uplift_rows(spark, sf), "total_spent", "t", "uplift", "account_id"
    )


def qini_totals(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.qini_totals(_uplift_rows(spark, sf), "total_spent", "t")


def _curve(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.qini_curve(
        _uplift_rows(spark, sf), "total_spent", "t", "uplift", "account_id"
    )


def qini_curve(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_curve(spark, sf), "frac", "qini_real", "qini_random")


def auuc(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluation.auuc(_curve(spark, sf)), "auuc")


# Forests.


# A forest's numbers depend on Spark ML, so these queries return what is a function of the data,
# and whether the numbers keep the bounds that they must keep: a prediction is a mean of training
# labels, a mean error is no larger than its root mean square.


def _label_range(splits: DataFrame) -> dict[str, tuple[float, float]]:
    """Least and largest training label of each segment, widened by what rounding may add."""
    train = splits.filter("split = 'train'").groupBy("offer_type")
    rows = train.agg(F.min(C.LABEL).alias("low"), F.max(C.LABEL).alias("high")).collect()
    return {r["offer_type"]: (r["low"] - 1e-6, r["high"] + 1e-6) for r in rows}


def train_forest(spark: SparkSession, sf: str) -> DataFrame:
    splits = _stored_splits(spark, sf)
    vectors = features.prepare_features(splits)
    model = forest.train_forest(forest.segment_rows(vectors, C.BOGO, "train"), FOREST)
    scored = forest.score(model, forest.segment_rows(vectors, C.BOGO, "test"))
    in_range = F.col("prediction").between(*_label_range(splits)[C.BOGO])
    return scored.select("account_id", "offer_id", "total_spent", in_range.alias("in_range"))


def _consistent(metrics: DataFrame) -> DataFrame:
    finite = F.col("mae") <= F.col("rmse") + 1e-9
    finite = finite & (F.col("rmse") < float("inf")) & (F.col("r2") < float("inf"))
    return metrics.select("offer_type", "n", finite.alias("consistent"))


def train_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _consistent(campaign.train(_stored_splits(spark, sf), FOREST)[1])


def model_runs(spark: SparkSession, sf: str) -> DataFrame:
    models_in = ModelStore(spark, shared_folder(spark))
    campaign.train(_stored_splits(spark, sf), FOREST, models_in=models_in)
    sizes = [F.col(f"params.{p}").cast("int").alias(p) for p in ("num_trees", "max_depth")]
    return models_in.latest().select(
        "model", "version", *sizes, F.array_join("features", ",").alias("features")
    )


def evaluate_saved(spark: SparkSession, sf: str) -> DataFrame:
    """Models saved by one run, evaluated by another that fits nothing."""
    models_in = ModelStore(spark, shared_folder(spark))
    splits = _stored_splits(spark, sf)
    campaign.train(splits, FOREST, models_in=models_in)
    return _consistent(campaign.evaluate_saved(splits, ModelStore(spark, models_in.root)))


def recorded_sample(spark: SparkSession, sf: str) -> DataFrame:
    """What a run recorded of its models' input and output."""
    models_in = ModelStore(spark, shared_folder(spark))
    splits = _stored_splits(spark, sf)
    campaign.train(splits, FOREST, models_in=models_in)
    ranges = _label_range(splits)
    within = [
        (F.col("model") == f"rf_model_{s}") & F.col("prediction").between(*ranges[s]) for s in ranges
    ]
    return models_in.samples().groupBy("model", "version").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.size("features")).alias("values"),
        F.bool_and(reduce(Column.__or__, within, F.lit(False))).alias("in_range"),
    )


def tlearner_score(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    table = store(_consolidated(spark, sf), f"{folder}/table")
    splits = store(campaign.model_splits(table), f"{folder}/splits", ("offer_type", "split"))
    models, _ = campaign.train(splits, FOREST)
    ranges = _label_range(splits)
    in_range = [
        F.col(f"pred_{s}").between(*ranges.get(s, (0.0, 0.0))).alias(f"{s}_in_range")
        for s in C.SEGMENTS
    ]
    return campaign.scored_accounts(models, table).select("account_id", C.LABEL, *in_range)


def campaign_report(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_folder(spark)
    raw = {
        "offers": testdata.offers(spark, sf),
        "profile": testdata.profile(spark, sf),
        "transactions": testdata.interactions(spark, sf),
    }
    for name, df in raw.items():
        df.write.json(f"{folder}/{name}")
    report = campaign.campaign(
        spark,
        *[f"{folder}/{name}" for name in raw],
        names=temporary_names(spark),
        as_of=testdata.AS_OF,
        params=FOREST,
        interaction_schema=schemas.NUMBERED_INTERACTIONS,
    )
    consistent = (
        (F.col("mae") <= F.col("rmse") + 1e-9)
        & F.col("recommended_accounts").between(0, raw["profile"].count())
        & (F.abs("auuc") < float("inf"))
    )
    return report.filter("accounts > 0").select(
        "offer_type", "n", "accounts", "model_version", consistent.alias("consistent")
    )


def entry(spark: SparkSession) -> DataFrame:
    return _consolidated(spark, "/root/testdata/sf0.001")


def _with_rounded_money(name: str, query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: _rounded(query(spark, sf), *MONEY[name])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "consolidated": _consolidated,
        "json_scan": json_scan,
        "ingest_offers": _ingested("offers"),
        "ingest_profile": _ingested("profile"),
        "ingest_transactions": _ingested("transactions"),
        "table_roundtrip": table_roundtrip,
        "flatten_interactions": _events,
        "clean_profile": clean_profile,
        "explode_channels": _offer_channels,
        "offer_channel_rows": offer_channel_rows,
        "offer_channel_flags": offer_channel_flags,
        "attribute_offers": _attributed,
        "attribute_offers_heavy": attribute_offers_heavy,
        "consolidated_heavy": consolidated_heavy,
        "extract_transactions": extract_transactions,
        "offer_events": offer_events,
        "user_spend_stats": user_spend_stats,
        "enriched_events": _enriched,
        "daily_activity": daily_activity,
        "completions_by_type_day": completions_by_type_day,
        "demographics": demographics,
        "funnel_by_type": funnel_by_type,
        "offer_performance": offer_performance,
        "spend_per_account": spend_per_account,
        "spend_quantiles": spend_quantiles,
        "spend_quantiles_approx": spend_quantiles_approx,
        "segment_offer_completion": _segment_offer_completion(C.SPEND_SEGMENTS),
        "segment_offer_completion_500_750": _segment_offer_completion(CUTS_500_750),
        "transaction_features": transaction_features,
        "offer_features": offer_features,
        "reward_features": reward_features,
        "time_features": time_features,
        "time_features_days": time_features_days,
        "offer_type_features": offer_type_features,
        "channel_features": channel_features,
        "customer_features": customer_features,
        "encode_gender": encode_gender,
        "prepare_features": prepare_features,
        "segment_split": segment_split,
        "union_test_splits": union_test_splits,
        "distinct_accounts": distinct_accounts,
        "one_row_per_account": one_row_per_account,
        "regression_metrics": regression_metrics,
        "segment_metrics": segment_metrics,
        "recommend_offer": recommend_offer,
        "uplift": uplift_rows,
        "uplift_rank": uplift_rank,
        "qini_cumulative": qini_cumulative,
        "qini_totals": qini_totals,
        "qini_curve": qini_curve,
        "auuc": auuc,
        "train_forest": train_forest,
        "train_segments": train_segments,
        "model_runs": model_runs,
        "evaluate_saved": evaluate_saved,
        "recorded_sample": recorded_sample,
        "tlearner_score": tlearner_score,
        "campaign_report": campaign_report,
    }
    found |= {name: _with_rounded_money(name, found[name]) for name in MONEY}
    return {**found, **LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **LLM_ORACLE}
