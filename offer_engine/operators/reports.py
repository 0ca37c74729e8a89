"""The exploratory reports.

Reports over the event log aggregate by (account, offer) or (offer, day) first and join the
reduced rows, so joins never see raw events and a heavy key is combined on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offer_engine import config as C
from offer_engine.config import TIME
from offer_engine.functions import columns as X
from offer_engine.functions import exact
from offer_engine.operators.ordered import value_at_ranks


def daily_activity(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col(TIME).isNotNull())
        .groupBy(X.day_of(F.col(TIME)).alias("day"))
        .agg(
            X.count_event(C.EVENT_TRANSACTION).alias("transactions"),
            X.count_event(C.EVENT_RECEIVED).alias("offers_received"),
            X.count_event(C.EVENT_VIEWED).alias("offers_viewed"),
            X.count_event(C.EVENT_COMPLETED).alias("offers_completed"),
        )
        .orderBy("day")
    )


def completions_by_type_day(events: DataFrame, offers: DataFrame) -> DataFrame:
    """Completions and rewards per offer type and day.

    A completion counts once per row its offer has in offers, so with one row per channel it
    counts once per channel. Both sides are reduced before the join and multiplied after it.
    """
    copies = (
        offers.filter(F.col("offer_type").isNotNull())
        .groupBy("offer_id", "offer_type")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    completed = (
        events.filter(X.is_event(C.EVENT_COMPLETED) & F.col(TIME).isNotNull())
        .groupBy("offer_id", X.day_of(F.col(TIME)).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("completions"),
            F.sum("reward").alias("rewards"),
        )
    )
    return (
        completed.join(copies, "offer_id")
        .groupBy("offer_type", "day")
        .agg(
            F.sum(F.col("completions") * F.col("copies")).alias("completions"),
            F.sum(F.col("rewards") * F.col("copies")).alias("total_rewards"),
        )
        .orderBy("day", "offer_type")
    )


def demographics(profile: DataFrame) -> DataFrame:
    """Customers and mean credit limit per gender and age group.

    The distinct count is taken by first reducing to one row per account, which keeps the sums
    of the limits mergeable in the same pass.
    """
    limit = F.col("credit_card_limit")
    per_account = (
        profile.filter(F.col("gender").isNotNull() & F.col("age").isNotNull())
        .groupBy("gender", X.age_group(F.col("age")).alias("age_group"), "account_id")
        .agg(
            F.sum(limit).alias("limits"),
            F.count(limit).alias("limit_count"),
        )
    )
    return (
        per_account.groupBy("gender", "age_group")
        .agg(
            F.count("account_id").alias("customers"),
            F.sum("limits").alias("limits"),
            F.sum("limit_count").alias("limit_count"),
        )
        .select(
            "gender",
            "age_group",
            "customers",
            X.ratio(F.col("limits"), F.col("limit_count")).alias("avg_credit_limit"),
        )
        .orderBy("gender", "age_group")
    )


def funnel_by_type(offers: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct accounts that received, viewed and completed offers of each type, with rates.

    Distinct accounts are flags per account and offer, combined where events are read, and then
    counted.
    """
    types = offers.filter(F.col("offer_type").isNotNull()).select("offer_id", "offer_type")
    steps = {
        "received": C.EVENT_RECEIVED,
        "viewed": C.EVENT_VIEWED,
        "completed": C.EVENT_COMPLETED,
    }
    steps_taken = events.filter(
        F.col("account_id").isNotNull()
        & F.col("offer_id").isNotNull()
        & F.col("event").isin(list(steps.values()))
    )
    reached = (
        steps_taken.groupBy("account_id", "offer_id")
        .agg(*[F.max(X.is_event(e)).alias(step) for step, e in steps.items()])
    )
    counts = (
        reached.join(types.distinct(), "offer_id")
        .groupBy("account_id", "offer_type")
        .agg(*[F.max(step).alias(step) for step in steps])
        .groupBy("offer_type")
        .agg(*[F.count_if(step).alias(step) for step in steps])
    )
    return (
        types.select("offer_type")
        .distinct()
        .join(counts, "offer_type", "left")
        .na.fill(0, list(steps))
        .withColumns(
            {
                f"%_{step}_rate": F.try_divide(F.lit(100) * F.col(step), F.col("received"))
                for step in ("viewed", "completed")
            }
        )
        .orderBy(F.desc("received"), "offer_type")
    )


def offer_performance(events: DataFrame, profile: DataFrame, offers: DataFrame) -> DataFrame:
    """Share of the accounts that received an offer and completed it, best offers first.

    events carries attributed offers; accounts without a profile do not count.
    """
    per_account = (
        events.filter(F.col("offer_id").isNotNull())
        .groupBy("account_id", "offer_id")
        .agg(
            F.max(X.is_event(C.EVENT_RECEIVED)).alias("received"),
            F.max(X.is_event(C.EVENT_COMPLETED)).alias("completed"),
        )
        .join(profile.select("account_id"), "account_id", "left_semi")
    )
    counts = per_account.groupBy("offer_id").agg(
        F.count_if("received").alias("customers_received"),
        F.count_if("completed").alias("customers_completed"),
    )
    sold = (
        offers.filter(F.col("offer_type") != C.INFORMATIONAL)
        .groupBy("offer_id")
        .agg(
            F.max("offer_type").alias("offer_type"),
            F.max("discount_value").alias("discount_value"),
            F.max("min_value").alias("min_value"),
        )
    )
    return (
        counts.join(sold, "offer_id")
        .select(
            "offer_id",
            "offer_type",
            "discount_value",
            "min_value",
            X.percent(F.col("customers_completed"), F.col("customers_received")).alias(
                "completion_rate_pct"
            ),
        )
        .orderBy(F.desc("completion_rate_pct"), "offer_id")
    )


def spend_per_account(events: DataFrame, profile: DataFrame) -> DataFrame:
    """Total of all amounts of each account with a profile; null if it has none."""
    return (
        events.groupBy("account_id")
        .agg(exact.exact_sum(F.col("amount")).alias("total_amount"))
        .join(profile.select("account_id"), "account_id", "left_semi")
    )


def spend_quantiles(
    totals: DataFrame,
    quantiles: Sequence[tuple[str, float]] = C.QUANTILES,
    error: float = 0.0,
) -> DataFrame:
    """Labelled quantiles of total_amount.

    With error 0 each value is the exact one at rank ceil(q * n), found with a bucketed rank, so
    totals is read more than once: pass a stored table. Otherwise one approximate pass.
    """
    present = totals.filter(F.col("total_amount").isNotNull())
    if error == 0.0:
        return value_at_ranks(
            present, "total_amount", "account_id", dict(quantiles), "Percentile", "Total Amount"
        )
    values = present.approxQuantile("total_amount", [q for _, q in quantiles], error)
    rows = [(label, value) for (label, _), value in zip(quantiles, values)]
    return totals.sparkSession.createDataFrame(rows, "Percentile string, `Total Amount` double")


def segment_offer_completion(
    events: DataFrame,
    profile: DataFrame,
    offers: DataFrame,
    cuts: Sequence[tuple[float, str]] = C.SPEND_SEGMENTS,
) -> DataFrame:
    """Receipts and completions per spend segment and offer type, one per account and type.

    events carries attributed offers. Only accounts whose profile has an age take part.
    """
    account = Window.partitionBy("account_id")
    aged = profile.filter(F.col("age").isNotNull()).select("account_id")
    per_offer = (
        events.groupBy("account_id", "offer_id")
        .agg(
            F.max(X.is_event(C.EVENT_RECEIVED)).alias("received"),
            F.max(X.is_event(C.EVENT_COMPLETED)).alias("completed"),
            exact.sum_of(X.transaction_amount()).alias("spent"),
        )
        .withColumn("spent", exact.merged(F.col("spent"), account))
        .withColumn("total_spent", F.coalesce(exact.total(F.col("spent")), F.lit(0.0)))
        .join(aged, "account_id", "left_semi")
    )
    types = offers.filter(F.col("offer_type").isNotNull()).select("offer_id", "offer_type")
    per_type = (
        per_offer.join(types.distinct(), "offer_id")
        .groupBy("account_id", "total_spent", "offer_type")
        .agg(F.max("received").alias("received"), F.max("completed").alias("completed"))
    )
    return (
        per_type.groupBy(
            X.spending_segment(F.col("total_spent"), cuts).alias("spending_segment"), "offer_type"
        )
        .agg(
            F.count_if("received").alias("total_received"),
            F.count_if("completed").alias("total_completed"),
        )
        .withColumn(
            "completion_rate_pct", X.percent(F.col("total_completed"), F.col("total_received"))
        )
        .orderBy("spending_segment", "offer_type")
    )
