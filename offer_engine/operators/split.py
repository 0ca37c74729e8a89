"""Row choice: one row per key, train/test splits, unions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from offer_engine import config as C
from offer_engine.functions.columns import hash32
from offer_engine.sources.tables import empty_table


def distinct_accounts(df: DataFrame) -> DataFrame:
    return df.select("account_id").distinct()


def one_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps one row per key in every map task before it shuffles, so a heavy key is no issue.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def assign_split(
    df: DataFrame, train_ratio: float = 0.8, seed: int = 42, key: str = "account_id"
) -> DataFrame:
    """Add split = train or test by a hash of the account.

    All rows of an account are on one side, and the split needs neither a shuffle nor the
    partition layout.
    """
    share = F.lit(round(train_ratio * 10_000))
    point = hash32(key, F.lit(seed)) % 10_000
    return df.withColumn("split", F.when(point < share, "train").otherwise("test"))


def random_split(
    df: DataFrame, train_ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Row-level split. It depends on the partition layout, so store both sides before use."""
    train, test = df.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
    return train, test


def segment_rows(df: DataFrame, segment: str, split: str | None = None) -> DataFrame:
    rows = df.filter(F.col("offer_type") == segment)
    return rows if split is None else rows.filter(F.col("split") == split)


def union_all(frames: Iterable[DataFrame], schema: StructType, session) -> DataFrame:
    """All rows of frames, by column name; an empty table if there are none."""
    return reduce(DataFrame.unionByName, frames, empty_table(session, schema))


def test_rows(splits: DataFrame, segments: Sequence[str] = C.SEGMENTS) -> DataFrame:
    """The test sides of the given segments. On a partitioned table this only lists files."""
    return union_all(
        [segment_rows(splits, s, "test") for s in segments], splits.schema, splits.sparkSession
    )
