"""Cleaning of the three raw inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offer_engine import config as C


def explode_channels(offers: DataFrame) -> DataFrame:
    """One row per offer and channel; an offer without channels has no row."""
    return offers.withColumn("channels", F.explode("channels")).withColumnsRenamed(
        {"id": "offer_id"}
    )


def per_offer(offers: DataFrame) -> DataFrame:
    """One row per offer, channels kept as an array."""
    return offers.withColumnsRenamed({"id": "offer_id"})


def one_row_per_offer(offers: DataFrame) -> DataFrame:
    """Channels as an array, from a table in either shape."""
    offers = per_offer(offers)
    if offers.schema["channels"].dataType.typeName() == "array":
        return offers
    others = [c for c in offers.columns if c not in ("offer_id", "channels")]
    return offers.groupBy("offer_id").agg(
        *[F.max(c).alias(c) for c in others],
        F.array_sort(F.collect_set("channels")).alias("channels"),
    )


def channel_flags(offers: DataFrame) -> DataFrame:
    """has_<channel> flags in place of channels, which may be a name or an array of names."""
    is_array = offers.schema["channels"].dataType.typeName() == "array"

    def flag(channel: str):
        if is_array:
            return F.array_contains("channels", channel)
        return F.col("channels").contains(channel)

    return (
        offers.withColumns({f"has_{c}": flag(c).cast("int") for c in C.CHANNELS})
        .drop("channels")
        .withColumnsRenamed({"id": "offer_id"})
    )


def clean_profile(profile: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Profiles with a gender, registration parsed and its age in days at as_of (default today).

    Text that is no date becomes null.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    registered = F.try_to_date(F.col("registered_on").cast("string"), "yyyyMMdd")
    return (
        profile.filter(F.col("gender").isNotNull())
        .withColumn("registered_on", registered)
        .withColumn("registered_on_days", F.date_diff(today, F.col("registered_on")))
        .withColumnsRenamed({"offer_id": "offer_id_user", "id": "account_id"})
    )


def flatten_value(interactions: DataFrame) -> DataFrame:
    """The fields of the value struct, whatever they are, as top-level columns."""
    fields = interactions.schema["value"].dataType.fieldNames()
    kept = [F.col(c) for c in interactions.columns if c != "value"]
    return interactions.select(*kept, *[F.col("value").getField(f).alias(f) for f in fields])


def merge_offer_id(events: DataFrame) -> DataFrame:
    """One offer_id column from the two spellings in the log."""
    if "offer id" not in events.columns:
        return events
    merged = F.col("`offer id`")
    if "offer_id" in events.columns:
        merged = F.coalesce("offer_id", merged)
    return events.withColumn("offer_id", merged).drop("offer id")


def flatten_interactions(interactions: DataFrame) -> DataFrame:
    return merge_offer_id(flatten_value(interactions))


def number_rows(events: DataFrame, row_id: str = C.ROW_ID) -> DataFrame:
    """Row numbers for rows that have none: negative ones, in the order in which they are read.

    Save the result before using the numbers.
    """
    number = F.monotonically_increasing_id() - F.lit(2**62)
    if row_id in events.columns:
        number = F.coalesce(row_id, number)
    return events.withColumn(row_id, number)
