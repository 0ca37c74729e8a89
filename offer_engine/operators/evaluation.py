"""Regression metrics, the Qini curve and the area under it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offer_engine import config as C
from offer_engine.functions import exact
from offer_engine.operators.ordered import into_buckets, running_sums


def _metrics(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label).cast("double"), F.col(prediction)
    spread = F.stddev_pop(y) * F.stddev_pop(p)
    correlation = F.when(spread != 0, F.covar_pop(y, p) / spread)
    squared = F.avg(F.pow(y - p, 2))
    return [
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(squared).alias("rmse"),
        F.coalesce(F.pow(correlation, 2), F.lit(0.0)).alias("r2"),
        F.when(F.var_pop(y) != 0, 1 - squared / F.var_pop(y)).alias("r2_score"),
    ]


def regression_metrics(
    df: DataFrame, label: str = C.LABEL, prediction: str = "prediction"
) -> DataFrame:
    """One row: mae, rmse, r2 (squared correlation, 0 if undefined) and 1 - SSE/SST."""
    return df.agg(*_metrics(label, prediction))


def segment_metrics(
    df: DataFrame, by: Sequence[str] = ("offer_type",), label: str = C.LABEL,
    prediction: str = "prediction",
) -> DataFrame:
    """The same metrics for every segment in one pass."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *_metrics(label, prediction))


def _arms(y: str, t: str) -> dict[str, Column]:
    """Outcome and size of the treated and the control arm."""
    outcome, treated = F.col(y).cast("double"), F.col(t)
    return {
        "y_treat_cum": F.when(treated == 1, outcome).otherwise(0.0),
        "y_ctrl_cum": F.when(treated == 0, outcome).otherwise(0.0),
        "n_treat_cum": treated,
        "n_ctrl_cum": 1 - treated,
    }


OUTCOMES = ("y_treat_cum", "y_ctrl_cum")


def _parts(y: str, t: str) -> dict[str, Column]:
    """The same with each outcome split into whole numbers, whose sums take any order."""
    parts: dict[str, Column] = {}
    for name, value in _arms(y, t).items():
        split = exact.limbs(value) if name in OUTCOMES else {"": value}
        parts |= {f"{name}{field}": part for field, part in split.items()}
    return parts


def _whole(name: str, prefix: str = "") -> Column:
    """An outcome from the sums of its parts."""
    return exact.from_limbs(lambda field: F.col(f"{prefix}{name}{field}"))


def qini_totals(df: DataFrame, y: str, t: str) -> DataFrame:
    """Row count, and outcome and size of both arms; a missing arm counts as size 1."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(value).alias(f"_{name}") for name, value in _parts(y, t).items()],
    ).select(
        "n",
        F.coalesce(_whole("y_treat_cum", "_"), F.lit(0.0)).alias("y_treat_total"),
        F.coalesce(_whole("y_ctrl_cum", "_"), F.lit(0.0)).alias("y_ctrl_total"),
        _or_one(F.col("_n_treat_cum")).alias("n_treat_total"),
        _or_one(F.col("_n_ctrl_cum")).alias("n_ctrl_total"),
    )


def _or_one(size: Column) -> Column:
    return F.when(size > 0, size).otherwise(1).cast("bigint")


def qini_cumulative(df: DataFrame, y: str, t: str, score: str, row_id: str, **options) -> DataFrame:
    """Rank by score, descending, with the running outcome and size of both arms."""
    ranked = running_sums(df, score, row_id, _parts(y, t), **options)
    return ranked.withColumns({name: _whole(name) for name in OUTCOMES}).select(
        *df.columns, "rank", *_arms(y, t)
    )


def qini_curve(
    df: DataFrame, y: str, t: str, score: str, row_id: str, n_bins: int = 100, **options
) -> DataFrame:
    """About n_bins points (frac, qini_real, qini_random), ordered by frac.

    Points are the ranks that are multiples of n // n_bins. The bucket table says which buckets
    hold one; only those are shuffled and sorted, so most rows are just counted. df should be a
    stored table, as it is read three times.
    """
    sums = _parts(y, t)
    placed = into_buckets(df, score, row_id, **options)
    width = F.greatest(F.floor(F.col("_total") / n_bins), F.lit(1))
    offsets = placed.offsets(sums).withColumn("_width", width)
    last = F.floor((F.col("_before") + F.col("_size")) / F.col("_width"))
    holding = offsets.filter(last > F.floor(F.col("_before") / F.col("_width")))
    ranked = placed.ranked(holding, sums, some_buckets=True)
    points = ranked.filter(F.col("rank") % F.col("_width") == 0)

    n_treat = _or_one(F.col("_total_n_treat_cum"))
    n_ctrl = _or_one(F.col("_total_n_ctrl_cum"))
    uplift = (
        _whole("y_treat_cum", "_total_") / n_treat - _whole("y_ctrl_cum", "_total_") / n_ctrl
    )
    balance = F.when(
        F.col("n_ctrl_cum") > 0, F.col("n_treat_cum") / F.col("n_ctrl_cum")
    ).otherwise(0.0)
    real = _whole("y_treat_cum") - _whole("y_ctrl_cum") * balance
    frac = F.col("rank") / F.col("_total")
    return points.select(
        frac.alias("frac"),
        real.alias("qini_real"),
        (frac * n_treat * uplift).alias("qini_random"),
    ).orderBy("frac")


def auuc(curve: DataFrame) -> DataFrame:
    """Area between the curve and the random line, by trapezoids from the first point on.

    The window runs over the few points of a curve.
    """
    along = Window.orderBy("frac")
    gap = F.col("qini_real") - F.col("qini_random")
    steps = curve.select(
        (F.col("frac") - F.lag("frac").over(along)).alias("width"),
        ((gap + F.lag(gap).over(along)) / 2).alias("height"),
    )
    return steps.agg(
        F.coalesce(F.sum(F.col("width") * F.col("height")), F.lit(0.0)).alias("auuc")
    )
