"""Best offer per account and its uplift over sending none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offer_engine import config as C


def recommend_offer(scored: DataFrame) -> DataFrame:
    """max_prediction and recommended_offer from the pred_ columns.

    Equal predictions go to the first of bogo, discount, informational. Nulls are skipped; an
    account without any prediction gets no offer.
    """
    names = [*C.RECOMMENDATION_ORDER, C.NO_OFFER_TYPE]
    best = F.array_max(F.array(*[F.col(f"pred_{n}") for n in names]))
    choice = None
    for name in C.RECOMMENDATION_ORDER:
        hit = F.col("max_prediction") == F.col(f"pred_{name}")
        choice = F.when(hit, name) if choice is None else choice.when(hit, name)
    return scored.withColumn("max_prediction", best).withColumn(
        "recommended_offer", choice.otherwise(C.NO_OFFER_TYPE)
    )


def add_uplift(df: DataFrame) -> DataFrame:
    """t = 1 where a real offer is recommended; uplift over the no-offer prediction."""
    offered = F.col("recommended_offer").isin(*C.RECOMMENDATION_ORDER)
    return df.withColumns(
        {
            "t": F.when(offered, 1).otherwise(0),
            "uplift": F.col("max_prediction") - F.col(f"pred_{C.NO_OFFER_TYPE}"),
        }
    )


def join_predictions(test_rows: DataFrame, recommended: DataFrame) -> DataFrame:
    """Test rows with the predictions and the recommendation of their account."""
    predictions = recommended.select(
        "account_id",
        *[f"pred_{n}" for n in (*C.RECOMMENDATION_ORDER, C.NO_OFFER_TYPE)],
        "max_prediction",
        "recommended_offer",
    )
    return test_rows.join(predictions, "account_id")
