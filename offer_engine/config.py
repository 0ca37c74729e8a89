"""Vocabulary, thresholds and table names shared by every job."""

from __future__ import annotations

from dataclasses import dataclass

# The event log's vocabulary and the campaign's categories.
EVENT_RECEIVED = "offer received"
EVENT_VIEWED = "offer viewed"
EVENT_COMPLETED = "offer completed"
EVENT_TRANSACTION = "transaction"

BOGO = "bogo"
DISCOUNT = "discount"
INFORMATIONAL = "informational"

# An event without an offer keeps this id; a row whose offer type is unknown
# falls into this model segment. The two spellings differ on purpose.
NO_OFFER_ID = "no offer"
NO_OFFER_TYPE = "no_offer"

SEGMENTS = ("informational", "bogo", "discount", "no_offer")
# Order in which equal predictions are resolved.
RECOMMENDATION_ORDER = ("bogo", "discount", "informational")
CHANNELS = ("web", "email", "mobile", "social")
GENDER_INDEX = {"F": 0.0, "M": 1.0, "O": 2.0}

FEATURES = (
    "age",
    "gender_idx",
    "credit_card_limit",
    "registered_on_days",
    "total_transactions",
    "avg_ticket",
    "max_spent",
    "min_value",
    "duration",
    "discount_value",
    "has_web",
    "has_email",
    "has_mobile",
    "has_social",
)
# Offer attributes that are 0 for rows without an offer.
ZERO_FILLED = (
    "has_web",
    "has_email",
    "has_mobile",
    "has_social",
    "discount_value",
    "duration",
    "min_value",
)
LABEL = "total_spent"

AGE_BANDS = ((30, "18-29"), (40, "30-39"), (50, "40-49"), (60, "50-59"), (70, "60-69"))
OLDEST_BAND = "70+"
SPEND_SEGMENTS = ((161, "High Spender"), (90, "Medium Spender"))
LOWEST_SEGMENT = "Low Spender"
QUANTILES = (
    ("Min", 0.0),
    ("25th Percentile", 0.25),
    ("Median", 0.5),
    ("75th Percentile", 0.75),
    ("Max", 1.0),
)
# One week in the log's time unit (hours).
WEEK_LENGTH = 168
# End of fixed values.

TIME = "time_since_test_start"
ROW_ID = "event_id"


@dataclass(frozen=True)
class TableNames:
    """Where a deployment keeps its tables."""

    schema: str = "default"
    catalog: str | None = None
    offers: str = "offers"
    transactions: str = "transactions"
    profile: str = "profile"
    consolidated: str = "data_processing"
    splits: str = "segment_splits"

    @property
    def namespace(self) -> str:
        return f"{self.catalog}.{self.schema}" if self.catalog else self.schema

    def qualified(self, table: str) -> str:
        return f"{self.namespace}.{getattr(self, table)}"


@dataclass(frozen=True)
class ForestParams:
    num_trees: int = 100
    max_depth: int = 15
    seed: int = 42
