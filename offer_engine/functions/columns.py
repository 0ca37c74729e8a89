"""Column expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from offer_engine import config as C


def is_event(name: str) -> Column:
    return F.col("event") == name


def count_event(name: str) -> Column:
    """Rows of one event kind."""
    return F.count_if(is_event(name))


def transaction_amount() -> Column:
    return F.when(is_event(C.EVENT_TRANSACTION), F.col("amount"))


def completion_reward() -> Column:
    return F.when(is_event(C.EVENT_COMPLETED), F.col("reward"))


def ratio(part: Column, whole: Column, default: float | None = None) -> Column:
    """part / whole where whole is not zero, else the default."""
    return F.when(whole != 0, part / whole).otherwise(F.lit(default))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage, null where whole is zero."""
    return F.round(F.when(whole != 0, F.lit(100.0) * part / whole), digits)


def ladder(value: Column, steps: Sequence[tuple[float, str]], last: str, below: bool) -> Column:
    """Label of the first step that value is below (or has reached)."""
    chain = None
    for limit, label in steps:
        hit = value < limit if below else value >= limit
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return F.lit(last) if chain is None else chain.otherwise(last)


def age_group(age: Column, bands=C.AGE_BANDS, oldest: str = C.OLDEST_BAND) -> Column:
    return ladder(age, bands, oldest, below=True)


def spending_segment(spent: Column, cuts=C.SPEND_SEGMENTS, lowest: str = C.LOWEST_SEGMENT) -> Column:
    return ladder(spent, cuts, lowest, below=False)


def gender_index(gender: Column) -> Column:
    """0.0 / 1.0 / 2.0, null for any other value."""
    chain = None
    for label, index in C.GENDER_INDEX.items():
        hit = gender == label
        chain = F.when(hit, index) if chain is None else chain.when(hit, index)
    return chain


def day_of(time: Column) -> Column:
    return F.floor(time).cast("bigint")


def converted(viewed: Column, completed: Column) -> Column:
    return F.when((viewed > 0) & (completed > 0), 1).otherwise(0)


def offer_key(offer: Column | str, account: Column | str) -> Column:
    """A join key for offers: the offer's id, or for rows without an offer one that spreads by
    account and meets no offer, so that these rows, which may be most, are not one hot key."""
    offer = F.col(offer) if isinstance(offer, str) else offer
    none = offer.isNull() | (offer == C.NO_OFFER_ID)
    return F.when(none, F.concat(F.lit("\0"), account)).otherwise(offer)


def hash32(*parts: Column | str) -> Column:
    """Evenly spread number in [0, 2^32), the same in every engine that has md5."""
    text = F.concat_ws("#", *[F.col(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
