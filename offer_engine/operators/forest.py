"""One random forest per offer segment: fit, score, evaluate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offer_engine import config as C
from offer_engine.operators.evaluation import segment_metrics
from offer_engine.operators.split import one_row_per_key, segment_rows
from offer_engine.operators.trees import Forest, fit

Models = dict[str, Forest]
#: Forests that grow at the same time. The driver holds the finished trees of each of them.
AT_ONCE = 2


def train_forest(
    train: DataFrame, params: C.ForestParams = C.ForestParams(), label: str = C.LABEL
) -> Forest:
    """Fit on the features column. train is read twice and should be a stored table.

    Trees grow whole in the executors (`trees.py`), each row's node beside it, so the driver holds
    no open nodes and a forest is a few jobs, however deep it is.
    """
    return fit(train, label, params.num_trees, params.max_depth, params.seed)


def train_segments(
    splits: DataFrame,
    segments: Sequence[str] = C.SEGMENTS,
    params: C.ForestParams = C.ForestParams(),
) -> Models:
    """A model for each segment that has training rows.

    Each fit is a series of distributed jobs. AT_ONCE fits run side by side, so that one segment's
    small stages do not leave the cluster idle, and no more, so that the memory that growing takes
    does not depend on the number of segments.
    """

    def fit(segment: str) -> Forest | None:
        train = segment_rows(splits, segment, "train").select("features", C.LABEL)
        return None if train.isEmpty() else train_forest(train, params)

    with ThreadPool(AT_ONCE) as pool:
        fitted = pool.map(inheritable_thread_target(splits.sparkSession)(fit), segments, chunksize=1)
    return {segment: model for segment, model in zip(segments, fitted) if model is not None}


def score(
    model: Forest, df: DataFrame, prediction: str = "prediction"
) -> DataFrame:
    return model.copy().setPredictionCol(prediction).transform(df)


def score_own_segment(models: Mapping[str, Forest], df: DataFrame) -> DataFrame:
    """Each row scored by the model of its own segment; rows without a model are left out.

    Segments are filtered and scored apart, so a row passes through one forest, not all.
    """
    if not models:
        return df.limit(0).withColumn("prediction", F.lit(None).cast("double"))
    scored = [score(m, segment_rows(df, s)) for s, m in models.items()]
    return reduce(DataFrame.unionByName, scored)


def evaluate_segments(
    models: Mapping[str, Forest], splits: DataFrame
) -> DataFrame:
    """Metrics of every model on the test side of its segment, in one job."""
    test = splits.filter(F.col("split") == "test")
    return segment_metrics(score_own_segment(models, test))


def account_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The one row per account that the forests score."""
    return one_row_per_key(df, ["account_id"], order)


def score_accounts(
    models: Mapping[str, Forest], accounts: DataFrame
) -> DataFrame:
    """Every account scored by every segment's model, as pred_<segment> columns.

    The models are chained over the same rows, so nothing is joined or shuffled.
    """
    scored = accounts
    for segment, model in models.items():
        scored = score(model, scored, f"pred_{segment}")
    return scored.select("account_id", C.LABEL, *[f"pred_{s}" for s in models])
