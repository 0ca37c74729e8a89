"""Per-account feature sets and the model's feature vector."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offer_engine import config as C
from offer_engine.config import TIME
from offer_engine.functions import columns as X
from offer_engine.functions import exact
from offer_engine.operators.dataset import with_dimension

# Channels in the order of the feature table.
ENGAGEMENT = ("email", "mobile", "social", "web")


def transaction_features(events: DataFrame) -> DataFrame:
    amount = X.transaction_amount()
    total = F.coalesce(exact.exact_sum(amount), F.lit(0.0))
    return events.groupBy("account_id").agg(
        X.count_event(C.EVENT_TRANSACTION).alias("transaction_frequency"),
        total.alias("total_spend"),
        X.ratio(total, F.count(amount)).alias("avg_transaction_value"),
        F.stddev_samp(amount).alias("transaction_value_std"),
        F.max(amount).alias("max_transaction"),
        F.min(amount).alias("min_transaction"),
    )


def _offer_rates(counts: DataFrame) -> DataFrame:
    received = F.col("offers_received_count")
    viewed = F.col("offers_viewed_count")
    completed = F.col("offers_completed_count")
    return counts.withColumns(
        {
            "view_rate": X.ratio(viewed, received, 0.0),
            "completion_rate_after_view": X.ratio(completed, viewed, 0.0),
            "overall_completion_rate": X.ratio(completed, received, 0.0),
        }
    )


def offer_features(events: DataFrame) -> DataFrame:
    return _offer_rates(
        events.groupBy("account_id").agg(
            X.count_event(C.EVENT_RECEIVED).alias("offers_received_count"),
            X.count_event(C.EVENT_VIEWED).alias("offers_viewed_count"),
            X.count_event(C.EVENT_COMPLETED).alias("offers_completed_count"),
        )
    )


def reward_features(events: DataFrame) -> DataFrame:
    reward = X.completion_reward()
    total = F.coalesce(exact.exact_sum(reward), F.lit(0.0))
    return events.groupBy("account_id").agg(
        total.alias("total_rewards_earned"),
        X.ratio(total, F.count(reward)).alias("avg_reward_per_completion"),
    )


def time_features(events: DataFrame, week_length: float = C.WEEK_LENGTH) -> DataFrame:
    """Activity times; week_length is one week in the log's time unit."""
    paid_at = F.when(X.is_event(C.EVENT_TRANSACTION), F.col(TIME))
    return events.groupBy("account_id").agg(
        F.max(paid_at).alias("last_transaction_time"),
        F.min(paid_at).alias("first_transaction_time"),
        (F.max(TIME) - F.min(TIME)).alias("customer_activity_span"),
        F.count_if(paid_at <= week_length).alias("transactions_first_week"),
        F.count_if((paid_at > week_length) & (paid_at <= 2 * week_length)).alias(
            "transactions_second_week"
        ),
    )


def _rate(hit: Column, part: str, whole: str = "received") -> Column:
    """Sum of part over sum of whole among the rows hit, 0.0 where whole is zero."""
    of_part = F.coalesce(F.sum(F.when(hit, F.col(part))), F.lit(0))
    of_whole = F.coalesce(F.sum(F.when(hit, F.col(whole))), F.lit(0))
    return X.ratio(of_part, of_whole, 0.0)


def _type_rates() -> list[Column]:
    kind = F.col("offer_type")
    return [
        _rate(kind == C.BOGO, "completed").alias("bogo_completion_rate"),
        _rate(kind == C.DISCOUNT, "completed").alias("discount_completion_rate"),
        _rate(kind == C.INFORMATIONAL, "viewed").alias("informational_view_rate"),
    ]


def _channel_rates() -> list[Column]:
    return [
        _rate(F.array_contains("channels", channel), "completed").alias(f"{channel}_engagement")
        for channel in ENGAGEMENT
    ]


def _has_channels() -> Column:
    return F.coalesce(F.size("channels") > 0, F.lit(False))


def _per_offer_counts(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("offer_id").isNotNull())
        .groupBy("account_id", "offer_id")
        .agg(
            X.count_event(C.EVENT_RECEIVED).alias("received"),
            X.count_event(C.EVENT_VIEWED).alias("viewed"),
            X.count_event(C.EVENT_COMPLETED).alias("completed"),
        )
    )


def offer_type_features(events: DataFrame, offers: DataFrame) -> DataFrame:
    """Completion or view rate per offer type, for accounts with an event of a typed offer."""
    typed = offers.filter(F.col("offer_type").isNotNull()).select("offer_id", "offer_type")
    return (
        _per_offer_counts(events)
        .join(typed, "offer_id")
        .groupBy("account_id")
        .agg(*_type_rates())
    )


def channel_features(events: DataFrame, offers: DataFrame) -> DataFrame:
    """Completion rate per channel, for accounts with an event of an offer that has channels.

    An event counts for every channel of its offer.
    """
    sent = offers.filter(_has_channels()).select("offer_id", "channels")
    return (
        _per_offer_counts(events)
        .join(sent, "offer_id")
        .groupBy("account_id")
        .agg(*_channel_rates())
    )


def join_feature_sets(*sets: DataFrame) -> DataFrame:
    """One row per account present in every set."""
    return reduce(lambda left, right: left.join(right, "account_id"), sets)


def customer_features(rollup: DataFrame, profile: DataFrame, offers: DataFrame) -> DataFrame:
    """All six feature sets at once, from the (account, offer) rollup.

    Rollup rows are already placed by account. With few offers, which are broadcast, this adds no
    shuffle of its own; with many, only rows with an offer are shuffled by it. The standard
    deviation is merged from the group variances around the account's mean.
    """
    account = Window.partitionBy("account_id")
    group_mean = X.ratio(exact.total(F.col("paid_sum")), F.col("paid_count"))
    all_paid = exact.total(F.col("_paid"))
    account_mean = X.ratio(all_paid, F.sum("paid_count").over(account))
    deviation = F.col("paid_count") * (
        F.col("paid_variance") + F.pow(group_mean - account_mean, 2)
    )
    rows = (
        rollup.withColumn("_paid", exact.merged(F.col("paid_sum"), account))
        .withColumn("paid_deviation", deviation)
        .drop("_paid")
    )
    rows = with_dimension(rows, offers.select("offer_id", "offer_type", "channels"))
    spent = F.coalesce(exact.total(exact.merged(F.col("paid_sum"))), F.lit(0.0))
    rewards = F.coalesce(exact.total(exact.merged(F.col("reward_sum"))), F.lit(0.0))
    paid = F.sum("paid_count")
    features = rows.groupBy("account_id").agg(
        F.bool_or(F.col("offer_type").isNotNull()).alias("_typed"),
        F.bool_or(_has_channels()).alias("_sent"),
        *_channel_rates(),
        *_type_rates(),
        F.max("paid_last").alias("last_transaction_time"),
        F.min("paid_first").alias("first_transaction_time"),
        (F.max("seen_last") - F.min("seen_first")).alias("customer_activity_span"),
        F.sum("paid_week_1").alias("transactions_first_week"),
        F.sum("paid_week_2").alias("transactions_second_week"),
        rewards.alias("total_rewards_earned"),
        X.ratio(rewards, F.sum("reward_count")).alias("avg_reward_per_completion"),
        F.sum("transactions").alias("transaction_frequency"),
        spent.alias("total_spend"),
        X.ratio(spent, paid).alias("avg_transaction_value"),
        F.when(paid > 1, F.sqrt(F.sum("paid_deviation") / (paid - 1))).alias(
            "transaction_value_std"
        ),
        F.max("paid_max").alias("max_transaction"),
        F.min("paid_min").alias("min_transaction"),
        F.sum("received").alias("offers_received_count"),
        F.sum("viewed").alias("offers_viewed_count"),
        F.sum("completed").alias("offers_completed_count"),
    )
    complete = features.filter(F.col("_typed") & F.col("_sent")).drop("_typed", "_sent")
    return _offer_rates(complete.join(profile.select("account_id"), "account_id", "left_semi"))


def encode_gender(df: DataFrame) -> DataFrame:
    return df.withColumn("gender_idx", X.gender_index(F.col("gender")))


def fill_features(
    df: DataFrame, features=C.FEATURES, on_null: str = "fill", sentinel: float = -1.0
) -> DataFrame:
    """Zeros for missing offer attributes and the no-offer segment for a missing type.

    Forests take no nulls: the other features get a sentinel, or their row is dropped.
    """
    filled = df.na.fill(0, [c for c in C.ZERO_FILLED if c in df.columns]).na.fill(
        C.NO_OFFER_TYPE, ["offer_type"]
    )
    if on_null == "drop":
        return filled.na.drop(subset=list(features))
    return filled.na.fill(sentinel, list(features))


def prepare_features(
    df: DataFrame, features=C.FEATURES, on_null: str = "fill", sentinel: float = -1.0
) -> DataFrame:
    """Filled columns plus their vector, for a table with an encoded gender."""
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="error"
    )
    return assembler.transform(fill_features(df, features, on_null, sentinel))
