"""Heavy keys of an event log.

Two groupings of the log can hold far more rows than one task should take: one account, and
one account at one instant. Rows are counted per hash bucket of the key, which every map task
reduces to a small table; a bucket far above the average holds a heavy key. The few light keys
in such a bucket are treated as heavy too, which is harmless: results never depend on the
buckets, only the shape of the plan does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offer_engine.config import TIME

# A bucket is heavy from this many rows on, and only above this share of all rows. So at most
# 1 / HEAVY_SHARE buckets are heavy; an even bucket has less than a sixth of that share.
HEAVY_ROWS = 5_000_000
HEAVY_SHARE = 1 / 20_000
HASH_BUCKETS = 131_072
# Rows of an even log that one task takes, so that its memory does not grow with the log.
TASK_ROWS = 50_000


def _bucket(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(HASH_BUCKETS)).cast("int")


@dataclass(frozen=True)
class LogSkew:
    """Hash buckets of heavy accounts and of heavy instants, the rows that made them heavy, and the
    rows of the log (0: not counted)."""

    accounts: tuple[int, ...] = ()
    instants: tuple[int, ...] = ()
    heavy_rows: int = HEAVY_ROWS
    rows: int = field(default=0, compare=False)

    def heavy_account(self) -> Column:
        return _bucket("account_id").isin(list(self.accounts))

    def heavy_instant(self) -> Column:
        return _bucket("account_id", TIME).isin(list(self.instants))


EVEN = LogSkew()


def measure_skew(
    events: DataFrame, heavy_rows: int = HEAVY_ROWS, heavy_share: float = HEAVY_SHARE
) -> LogSkew:
    """Heavy accounts, and heavy instants if there are any. Reads two columns at most."""
    counts, total = _large_buckets(events, heavy_rows, "account_id")
    if not counts:
        return LogSkew(heavy_rows=heavy_rows, rows=total)
    floor = max(heavy_rows, int(total * heavy_share))
    accounts = tuple(sorted(b for b, n in counts.items() if n >= floor))
    skew = LogSkew(accounts, heavy_rows=floor, rows=total)
    if not accounts:
        return skew
    # An instant belongs to one account, so heavy ones can only be found here.
    instants, _ = _large_buckets(events.filter(skew.heavy_account()), floor, "account_id", TIME)
    return LogSkew(accounts, tuple(sorted(instants)), floor, total)


def tasks_for(rows: int, session: SparkSession) -> int:
    """How many tasks share so many rows: as many as a shuffle has, or more for a larger log."""
    return max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def place_by_account(events: DataFrame, skew: LogSkew | None = None) -> DataFrame:
    """Hash an even log by account, so that later groupings and joins by account stay in place.

    The tasks are as many as the log's rows ask for: left to itself, adaptive execution joins
    small partitions until each of a few tasks holds a share of the log that grows with it.
    A log with heavy accounts is left as it is: groupings then combine on the map side first.
    """
    skew = measure_skew(events) if skew is None else skew
    if skew.accounts:
        return events
    if skew.rows <= TASK_ROWS:
        return events.repartition("account_id")
    return events.repartition(tasks_for(skew.rows, events.sparkSession), "account_id")


def _large_buckets(events: DataFrame, rows: int, *key: str) -> tuple[dict[int, int], int]:
    """Buckets with at least so many rows, HASH_BUCKETS numbers at most, and the count of all."""
    counted = events.groupBy(_bucket(*key).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    large = F.collect_list(F.when(F.col("n") >= rows, F.struct("bucket", "n"))).alias("large")
    found = counted.agg(large, F.sum("n").alias("total")).first()
    return {r["bucket"]: r["n"] for r in found["large"]}, found["total"] or 0
