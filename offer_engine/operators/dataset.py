"""Event-level and account-offer-level tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offer_engine import config as C
from offer_engine.config import TIME
from offer_engine.functions import columns as X
from offer_engine.functions import exact

#: Rows of a dimension up to which it is broadcast, after it has been counted.
FEW_ROWS = 100_000

SPEND_DEFAULTS = {"total_transactions": 0, "total_spent": 0.0, "avg_ticket": 0.0, "max_spent": 0.0}


def with_dimension(rows: DataFrame, offers: DataFrame, few: int = FEW_ROWS) -> DataFrame:
    """rows with the attributes of their offer, null where they have none.

    The offers are counted once. Up to `few` rows of them are broadcast, so the rows stay where they
    are. Beyond, rows with an offer are shuffled by it, and rows without one, which may be most, are
    not: their attributes are null anyway. Each task holds its offers in a hash table and lets the
    rows pass, so an offer with very many rows takes time but no memory.
    """
    if offers.limit(few + 1).count() <= few:
        return rows.join(F.broadcast(offers), "offer_id", "left")
    none = F.col("offer_id").isNull() | (F.col("offer_id") == C.NO_OFFER_ID)
    joined = rows.filter(~none).join(offers.hint("shuffle_hash"), "offer_id", "left")
    # An offers table may list the missing offer itself.
    listed = offers.filter(F.col("offer_id") == C.NO_OFFER_ID)
    return joined.unionByName(rows.filter(none).join(F.broadcast(listed), "offer_id", "left"))


def join_dataset(
    offer_counts: DataFrame, profile: DataFrame, offers: DataFrame, spend: DataFrame
) -> DataFrame:
    """Funnel counts with profile, offer attributes and the account's spend."""
    return (
        offer_counts.join(profile, "account_id")
        .join(spend, "account_id", "left")
        .join(offers, "offer_id", "left")
        .na.fill(SPEND_DEFAULTS)
        .select(
            "account_id",
            "offer_id",
            *[c for c in offer_counts.columns if c not in ("account_id", "offer_id")],
            *[c for c in profile.columns if c != "account_id"],
            *[c for c in offers.columns if c != "offer_id"],
            *SPEND_DEFAULTS,
        )
    )


def account_offer_rollup(events: DataFrame, week_length: float = C.WEEK_LENGTH) -> DataFrame:
    """One row per (account, offer) with mergeable parts of every per-account figure.

    Events without an offer count under 'no offer'. Everything the account-level jobs need can
    be merged from these rows, so the log is read and shuffled once and a heavy account or offer
    leaves each map task as one row.
    """
    amount = X.transaction_amount()
    reward = X.completion_reward()
    paid_at = F.when(X.is_event(C.EVENT_TRANSACTION), F.col(TIME))
    offer = F.coalesce("offer_id", F.lit(C.NO_OFFER_ID)).alias("offer_id")
    return events.groupBy("account_id", offer).agg(
        X.count_event(C.EVENT_RECEIVED).alias("received"),
        X.count_event(C.EVENT_VIEWED).alias("viewed"),
        X.count_event(C.EVENT_COMPLETED).alias("completed"),
        X.count_event(C.EVENT_TRANSACTION).alias("transactions"),
        F.count(amount).alias("paid_count"),
        exact.sum_of(amount).alias("paid_sum"),
        F.var_pop(amount).alias("paid_variance"),
        F.max(amount).alias("paid_max"),
        F.min(amount).alias("paid_min"),
        F.count(reward).alias("reward_count"),
        exact.sum_of(reward).alias("reward_sum"),
        F.max(paid_at).alias("paid_last"),
        F.min(paid_at).alias("paid_first"),
        F.max(TIME).alias("seen_last"),
        F.min(TIME).alias("seen_first"),
        F.count_if(paid_at <= week_length).alias("paid_week_1"),
        F.count_if((paid_at > week_length) & (paid_at <= 2 * week_length)).alias("paid_week_2"),
    )


def consolidate(rollup: DataFrame, profile: DataFrame, offers: DataFrame) -> DataFrame:
    """The training table straight from the rollup.

    The account's spend is a window over its few rollup rows, which are already placed by
    account, so neither a second pass over the log nor a self-join is needed.
    """
    account = Window.partitionBy("account_id")
    counts = rollup.select(
        "account_id",
        "offer_id",
        F.col("received").alias("cnt_received"),
        F.col("viewed").alias("cnt_viewed"),
        F.col("completed").alias("cnt_completed"),
        X.converted(F.col("viewed"), F.col("completed")).alias("is_converted_valid"),
        F.sum("paid_count").over(account).alias("total_transactions"),
        exact.merged(F.col("paid_sum"), account).alias("spent"),
        F.coalesce(F.max("paid_max").over(account), F.lit(0.0)).alias("max_spent"),
    ).withColumn("total_spent", F.coalesce(exact.total(F.col("spent")), F.lit(0.0)))
    return (
        with_dimension(counts.join(profile, "account_id"), offers)
        .select(
            "account_id",
            "offer_id",
            "cnt_received",
            "cnt_viewed",
            "cnt_completed",
            "is_converted_valid",
            *[c for c in profile.columns if c != "account_id"],
            *[c for c in offers.columns if c != "offer_id"],
            "total_transactions",
            "total_spent",
            X.ratio(F.col("total_spent"), F.col("total_transactions"), 0.0).alias("avg_ticket"),
            "max_spent",
        )
    )


def enriched_events(events: DataFrame, profile: DataFrame, offers: DataFrame) -> DataFrame:
    """One row per event of a known account, with its profile and its offer's attributes.

    offers has one row per offer with channels as an array, so events are not repeated. With few
    offers the log is shuffled by account alone.
    """
    return with_dimension(events.join(profile, "account_id"), offers).select(
        *events.columns,
        *[c for c in profile.columns if c != "account_id"],
        *[c for c in offers.columns if c != "offer_id"],
    )
