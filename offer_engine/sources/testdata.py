"""The three raw inputs, derived from the events, part and customer tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offer_engine import config as C
from offer_engine.schemas import INTERACTION_VALUE

AS_OF = dt.date(2024, 2, 1)
# How the source's vocabulary maps to the campaign's.
EVENT_NAMES = {
    "signup": C.EVENT_RECEIVED,
    "view": C.EVENT_VIEWED,
    "click": C.EVENT_COMPLETED,
    "purchase": C.EVENT_TRANSACTION,
}
GENDERS = {"HOUSEHOLD": "F", "BUILDING": "F", "MACHINERY": "M", "FURNITURE": "O"}
# End of fixed values.


def _lookup(value, table: dict[str, str], other: str | None):
    chain = None
    for key, label in table.items():
        hit = value == key
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(other)


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """The raw log: one row per event, details nested in value, time in days by the hour."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    event = _lookup(F.col("event_type"), EVENT_NAMES, "other")
    offer = F.regexp_extract("props", r'"k":\s*(\d+)', 1)
    hours = F.expr("timestampdiff(HOUR, timestamp_ntz'2024-01-01 00:00:00', ts)")
    kind = F.col("event_type")
    value = F.struct(
        F.when(kind.isin("signup", "view"), offer).alias("offer id"),
        F.when(kind == "click", offer).alias("offer_id"),
        F.when(kind == "purchase", F.col("value")).alias("amount"),
        F.when(kind == "click", F.col("value")).alias("reward"),
    ).cast(INTERACTION_VALUE)
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("account_id"),
        event.alias("event"),
        (hours.cast("double") / 24.0).alias("time_since_test_start"),
        value.alias("value"),
    )


def offers(spark: SparkSession, folder: str) -> DataFrame:
    """Raw offers, one per part; the low four bits of its size are its channels."""
    part = spark.read.parquet(f"{folder}/part.parquet")
    names = ", ".join(f"'{c}'" for c in C.CHANNELS)
    channels = F.expr(f"filter(array({names}), (c, i) -> (shiftright(p_size, i) & 1) = 1)")
    kinds = F.array(*[F.lit(k) for k in C.RECOMMENDATION_ORDER])
    return part.select(
        channels.alias("channels"),
        (F.col("p_size") % 21).cast("bigint").alias("min_value"),
        (3.0 + F.col("p_partkey") % 8).cast("double").alias("duration"),
        F.col("p_partkey").cast("string").alias("id"),
        F.get(kinds, (F.col("p_partkey") % 3).cast("int")).alias("offer_type"),
        (F.col("p_partkey") % 5).cast("bigint").alias("discount_value"),
    )


def profile(spark: SparkSession, folder: str) -> DataFrame:
    """Raw profiles, one per customer."""
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    key = F.col("c_custkey")
    registered = F.date_add(F.lit(dt.date(2013, 1, 1)), (key % 1800).cast("int"))
    return customer.select(
        key.cast("string").alias("id"),
        (18 + key % 60).alias("age"),
        F.date_format(registered, "yyyyMMdd").alias("registered_on"),
        _lookup(F.col("c_mktsegment"), GENDERS, None).alias("gender"),
        F.col("c_acctbal").alias("credit_card_limit"),
    )


def with_fixed_predictions(accounts: DataFrame) -> DataFrame:
    """Predictions by a formula with many ties, to check what follows a model exactly."""
    number = F.col("account_id").cast("bigint")
    factors = {"bogo": 7, "discount": 13, "informational": 17, "no_offer": 29}
    return accounts.withColumns(
        {f"pred_{n}": (number * f % 101).cast("double") for n, f in factors.items()}
    )
