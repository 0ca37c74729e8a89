"""Attribution of transactions to offers, and the per-offer and per-account event counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offer_engine import config as C
from offer_engine.config import ROW_ID, TIME
from offer_engine.functions import columns as X
from offer_engine.functions.exact import exact_sum
from offer_engine.operators.skew import LogSkew, measure_skew, place_by_account
from offer_engine.sources.tables import shared_folder, store

# Cuts of one event at one instant at most, and how many of them are compared at once.
SLICES = 4096
BLOCK = 64


def attribute_offers(
    events: DataFrame, row_id: str = ROW_ID, skew: LogSkew | None = None, slices: int = SLICES
) -> DataFrame:
    """Give a row without an offer the offer of the row before it.

    "Before" is by event name and row id among the rows of the same account at the same
    instant, one row back, over the offers as logged. row_id is a unique number, so the result
    is a function of the data.

    An even log is hashed by account once; the window and every later grouping or join by
    account then reuse that placement. With heavy accounts the rows are placed by
    (account, instant), and instants that are heavy themselves are cut into ordered slices.
    """
    skew = measure_skew(events) if skew is None else skew
    if not skew.instants:
        return _fill(place_by_account(events, skew), row_id)
    heavy = skew.heavy_instant()
    return _fill(events.filter(~heavy), row_id).unionByName(
        _fill_sliced(events.filter(heavy), row_id, skew.heavy_rows, slices)
    )


def _fill(events: DataFrame, row_id: str) -> DataFrame:
    window = Window.partitionBy("account_id", TIME).orderBy("event", row_id)
    previous = F.lag("offer_id").over(window)
    return events.withColumn("offer_id", F.coalesce("offer_id", previous))


def _fill_sliced(events: DataFrame, row_id: str, heavy_rows: int, slices: int) -> DataFrame:
    """The same fill where one instant holds too many rows for one task.

    Rows of one event at one instant are cut by row id into slices of about equal size. The
    first row of a slice takes the last offer of the slice before it.
    """
    group = F.xxhash64("account_id", TIME, "event")
    steps = F.split(F.lit(",".join(str(i / slices) for i in range(1, slices))), ",")
    # Only groups of heavy_rows rows or more get cuts, about one per heavy_rows rows.
    # measure_skew sets heavy_rows to at least HEAVY_SHARE of the log, so this table has at most
    # 1 / HEAVY_SHARE rows and about as many cuts. The cuts are approximate and depend on the order
    # in which parts are merged, so they are stored: all that reads them sees the same ones.
    spark = events.sparkSession
    grouped = events.withColumn("_group", group)
    large = grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows"))
    large = store(large.filter(F.col("_rows") >= heavy_rows), shared_folder(spark))
    sketches = (
        grouped.join(F.broadcast(large), "_group")
        .groupBy("_group", "_rows")
        .agg(F.percentile_approx(row_id, steps.cast("array<double>"), 4 * slices).alias("_cuts"))
    )
    cuts = store(
        sketches.select(
            "_group",
            _every(F.col("_cuts"), F.floor(F.lit(slices) * heavy_rows / F.col("_rows"))).alias(
                "_cuts"
            ),
        )
        .withColumn("_ends", _every(F.col("_cuts"), F.lit(BLOCK))),
        shared_folder(spark),
    )
    # The cuts below a row are counted in two steps: whole blocks, then inside the next block.
    blocks = BLOCK * F.size(F.filter("_ends", lambda c: c < F.col(row_id)))
    rest = F.slice("_cuts", blocks + 1, BLOCK)
    position = blocks + F.size(F.filter(rest, lambda c: c < F.col(row_id)))
    sliced = (
        events.withColumn("_group", group)
        .join(F.broadcast(cuts), "_group", "left")
        .withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(position))
        .drop("_group", "_cuts", "_ends")
    )

    slot = ["account_id", TIME, "event", "_slice"]
    between = Window.partitionBy("account_id", TIME).orderBy("event", "_slice")
    carried = (
        sliced.groupBy(*slot)
        .agg(F.max_by("offer_id", row_id).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(between))
        .drop("_last")
    )
    inside = Window.partitionBy(*slot).orderBy(row_id)
    numbered = sliced.withColumn("_previous", F.lag("offer_id").over(inside)).withColumn(
        "_number", F.row_number().over(inside)
    )
    same_slot = _null_safe(numbered, carried, slot)
    filled = numbered.join(carried, same_slot, "left").select(
        *[numbered[c] for c in events.columns if c != "offer_id"],
        F.coalesce(
            numbered["offer_id"],
            F.when(F.col("_number") == 1, F.col("_carried")).otherwise(F.col("_previous")),
        ).alias("offer_id"),
    )
    return filled.select(*events.columns)


def _every(values: Column, step: Column) -> Column:
    """The elements of an array at every step-th place."""
    return F.filter(values, lambda _, i: (i + 1) % F.greatest(step, F.lit(1)) == 0)


def _null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def extract_transactions(events: DataFrame) -> DataFrame:
    """The six columns the counts need."""
    return events.select("account_id", "event", TIME, "offer_id", "amount", "reward")


def offer_events(events: DataFrame) -> DataFrame:
    """Funnel counts per (account, offer); rows without an offer count as 'no offer'."""
    return (
        events.withColumn("offer_id", F.coalesce("offer_id", F.lit(C.NO_OFFER_ID)))
        .groupBy("account_id", "offer_id")
        .agg(
            X.count_event(C.EVENT_RECEIVED).alias("cnt_received"),
            X.count_event(C.EVENT_VIEWED).alias("cnt_viewed"),
            X.count_event(C.EVENT_COMPLETED).alias("cnt_completed"),
        )
        .withColumn(
            "is_converted_valid", X.converted(F.col("cnt_viewed"), F.col("cnt_completed"))
        )
    )


def user_spend_stats(events: DataFrame) -> DataFrame:
    """Count, sum, mean and maximum of an account's transaction amounts."""
    return (
        events.filter(X.is_event(C.EVENT_TRANSACTION))
        .groupBy("account_id")
        .agg(
            F.count("amount").alias("total_transactions"),
            exact_sum(F.col("amount")).alias("total_spent"),
            F.max("amount").alias("max_spent"),
        )
        .select(
            "account_id",
            "total_transactions",
            "total_spent",
            X.ratio(F.col("total_spent"), F.col("total_transactions")).alias("avg_ticket"),
            "max_spent",
        )
    )
