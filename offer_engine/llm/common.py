"""Helpers shared by the operators: stored steps, packed rows, running sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offer_engine.sources.shipped import ship  # noqa: F401  for the operators
from offer_engine.sources.tables import shared_folder, store

#: Rows of a bucket that is ordered in one task: a few hundred, up to BUCKETS buckets; with more
#: rows than BUCKETS * BUCKET_ROWS, that many.
BUCKETS = 1024
BUCKET_ROWS = 1_000_000
#: Rows of a table up to which it is broadcast after it has been counted.
BROADCAST_ROWS = 50_000

#: A group with more than rows / HEAVY_GROUPS members is heavy.
HEAVY_GROUPS = 1000

def stored(df: DataFrame) -> DataFrame:
    """df written to a new shared folder and read back."""
    return store(df, shared_folder(df.sparkSession))


def packed(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The columns of df as one struct, so that working columns can't clash with them."""
    names = df.columns if columns is None else list(columns)
    return F.struct(*[F.col(f"`{n}`") for n in names]).alias("row")


def unpacked(df: DataFrame, names: Sequence[str], added: Sequence[str]) -> DataFrame:
    """The columns that packed() took, with the added ones in place of any of the same name."""
    kept = [F.col("row").getField(n).alias(n) for n in names if n not in added]
    return df.select(*kept, *added)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bucket_count(rows: int) -> int:
    return max(4, min(rows // 200, BUCKETS), rows // BUCKET_ROWS)


def hash_bucket(buckets: int, *columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def running(
    df: DataFrame,
    keys: Sequence[str],
    bucket: str,
    order: Sequence[Column | str],
    value: str,
    out: str = "before",
) -> DataFrame:
    """df with the sum of `value` over the rows before each row of its keys.

    The order is (bucket, order). Sums of buckets go through a small window and each bucket is
    ordered on its own, so no key is ordered in one task. df should be a stored table: it is
    read twice. Keys and bucket must not be null.
    """
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys, bucket, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = (
        Window.partitionBy(*keys, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = df.join(offsets, [*keys, bucket])
    before = F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return joined.withColumn(out, before).drop("_offset")


def joined_groups(
    rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, how: str = "inner"
) -> DataFrame:
    """rows joined with the stored table of their groups, whose sizes are in a column.

    Groups of more than total / HEAVY_GROUPS rows, of which there can't be HEAVY_GROUPS, come by
    broadcast, so a group of any size stays where its rows are.
    """
    is_heavy = F.col(size) > total // HEAVY_GROUPS
    heavy = groups.filter(is_heavy)
    light = groups.filter(~is_heavy)
    near = rows.join(F.broadcast(heavy), key)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return near.unionByName(rest.join(light, key, how))
