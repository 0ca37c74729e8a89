"""Global rank and running sums without putting all rows into one partition.

Rows are placed in buckets that follow the global order. Bucket sizes are summed up in a small
table, and each bucket is ordered on its own and shifted by what comes before it.

The order is (score, hash of id, id), with one row per id. A bucket is a pure function of the row: quantiles of the
score cut the range, and rows that share a cut value or an infinite one, which may be very many,
are cut further by the hash. Buckets are counted, and those above a bound are cut again, by
quantiles of their own or by the hash, until none is. No bucket depends on how rows are spread over
partitions, so a lost task can be run again at any time.

The input is read once for the cut points, once or more for the sizes, once for the small table and
once for the rows; it should be a stored table.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import inf, isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offer_engine.functions.columns import hash32

BUCKETS = 1024
TIE_SLICES = 256
#: Rows of a bucket that is not cut again, but at least a MOST_LARGE-th of all rows, so that the
#: table of buckets to cut has no more rows than that.
BUCKET_ROWS = 500_000
MOST_LARGE = 20_000
#: Pieces into which a round cuts a large bucket, numbers kept for them, and rounds at most: enough
#: to bring any number of rows that a 64-bit bucket can name under the bound.
PIECES = 64
PLACES = 256
ROUNDS = 5


@dataclass(frozen=True)
class Buckets:
    """Rows with their bucket and hash, and the order inside a bucket."""

    rows: DataFrame
    order: tuple[Column, ...]

    def offsets(self, sums: dict[str, Column] | None = None) -> DataFrame:
        """Per bucket: its size, and the row count and sums before it and in total.

        Has at most (2 + TIE_SLICES) * BUCKETS rows and PLACES for each bucket that was cut again,
        so one window and a broadcast can hold it.
        """
        sums = sums or {}
        sizes = self.rows.groupBy("_bucket").agg(
            F.count(F.lit(1)).alias("_size"),
            *[F.sum(value).alias(f"_sum_{name}") for name, value in sums.items()],
        )
        earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        overall = Window.partitionBy()
        zero = F.lit(0)

        def total(name: str, window) -> Column:
            return F.coalesce(F.sum(name).over(window), zero)

        return sizes.select(
            "_bucket",
            "_size",
            total("_size", earlier).alias("_before"),
            total("_size", overall).alias("_total"),
            *[total(f"_sum_{n}", earlier).alias(f"_before_{n}") for n in sums],
            *[total(f"_sum_{n}", overall).alias(f"_total_{n}") for n in sums],
        )

    def ranked(
        self,
        offsets: DataFrame,
        sums: dict[str, Column] | None = None,
        rank: str = "rank",
        some_buckets: bool = False,
    ) -> DataFrame:
        """Rank and running sums of the rows.

        Offsets are joined after the rows are ordered, so that they are not shuffled with them.
        With some_buckets, offsets list only the buckets wanted and are joined first, so that
        the other rows are not shuffled at all.
        """
        sums = sums or {}
        inside = Window.partitionBy("_bucket").orderBy(*self.order)
        running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        within = {rank: F.row_number().over(inside)} | {
            name: F.coalesce(F.sum(value).over(running), F.lit(0))
            for name, value in sums.items()
        }
        bounded = F.broadcast(offsets)
        if some_buckets:
            placed = self.rows.join(bounded, "_bucket").withColumns(within)
        else:
            placed = self.rows.withColumns(within).join(bounded, "_bucket")
        return placed.withColumns(
            {rank: F.col(rank) + F.col("_before")}
            | {name: F.col(name) + F.col(f"_before_{name}") for name in sums}
        )


def into_buckets(
    df: DataFrame,
    score: str,
    row_id: str,
    descending: bool = True,
    buckets: int = BUCKETS,
    tie_slices: int = TIE_SLICES,
    bucket_rows: int = BUCKET_ROWS,
) -> Buckets:
    """Place rows in buckets that follow the order of score, each of bucket_rows rows at most.

    Only a bucket of rows equal in score and hash can be larger."""
    steps = [i / buckets for i in range(1, buckets)]
    cuts = sorted({c for c in df.approxQuantile(score, steps, 0.5 / buckets) if isfinite(c)})
    cuts = cuts or [0.0]
    # Lower ends of the intervals, as one constant.
    floors = F.split(F.lit(",".join(["-Infinity", *map(repr, cuts)])), ",").cast("array<double>")
    rows = (
        Bucketizer(
            splits=[-inf, *cuts, inf], inputCol="_score", outputCol="_interval",
            handleInvalid="keep",
        )
        .transform(df.withColumn("_score", F.col(score).cast("double")))
        .withColumn("_interval", F.col("_interval").cast("int"))
        .withColumn("_hash", hash32(row_id))
    )
    is_number = F.col("_score").isNotNull() & ~F.isnan("_score") & (F.col("_score") != inf)
    # Position of a value: odd between cuts, even on a cut; nulls first, infinity and NaN last.
    on_cut = F.col("_score") == F.get(floors, F.col("_interval"))
    position = (
        F.when(F.col("_score").isNull(), -1)
        .when(F.isnan("_score"), 2 * len(cuts) + 4)
        .when(F.col("_score") == inf, 2 * len(cuts) + 2)
        .otherwise(2 * F.col("_interval") + F.when(on_cut, 0).otherwise(1))
    )
    if descending:
        position = -position
    tied = ~is_number | on_cut
    along = F.col("_hash") * tie_slices / F.lit(2.0**32)
    slice_ = F.when(tied, F.floor(along)).otherwise(0)
    bucket = (position * tie_slices + slice_).cast("bigint")
    # Never null; saying so spares a null check that would compute the bucket twice.
    placed = rows.withColumn("_bucket", F.coalesce(bucket, F.lit(0))).withColumns(
        # Whether all of the row's bucket share its score, and where the hash lies in the slice.
        {"_tied": tied, "_along": F.when(tied, along - F.floor(along)).otherwise(F.col("_hash") / 2.0**32)}
    )
    placed = _refined(placed.drop("_interval"), descending, bucket_rows).drop("_tied", "_along")
    by_score = F.col("_score").desc() if descending else F.col("_score").asc()
    return Buckets(placed, (by_score, F.col("_hash").asc(), F.col(row_id).asc()))


def _refined(placed: DataFrame, descending: bool, bucket_rows: int) -> DataFrame:
    """Cut the buckets that are too large, round by round.

    A bucket of equal scores is cut by the hash, any other by quantiles of its scores, where rows
    on a cut become a bucket of equal scores."""
    spark = placed.sparkSession
    most = max(bucket_rows, placed.count() // MOST_LARGE)
    steps = F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)])
    for _ in range(ROUNDS):
        sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"), F.bool_and("_tied").alias("_equal"))
        large = sizes.filter(F.col("_n") > most).collect()  # MOST_LARGE rows at most
        if not large:
            break
        names = spark.createDataFrame([(r["_bucket"], r["_equal"]) for r in large], "_bucket long, _equal boolean")
        uneven = placed.join(F.broadcast(names.filter("not _equal").select("_bucket")), "_bucket")
        quantiles = uneven.groupBy("_bucket").agg(F.percentile_approx("_score", steps, 20 * PIECES).alias("_cuts"))
        # The cuts are approximate, so they are fixed here: all that reads them sees the same ones.
        found = {r["_bucket"]: sorted(set(r["_cuts"])) for r in quantiles.collect()}
        cuts = spark.createDataFrame(
            [(r["_bucket"], found.get(r["_bucket"], [])) for r in large], "_bucket long, _cuts array<double>"
        )
        below = F.size(F.filter("_cuts", lambda c: c < F.col("_score")))
        on_cut = F.array_contains("_cuts", F.col("_score"))
        by_score = 2 * below + F.when(on_cut, 1).otherwise(0)
        scaled = F.col("_along") * PIECES
        piece = F.when(F.col("_tied"), F.floor(scaled)).otherwise(
            PLACES - 1 - by_score if descending else by_score
        )
        is_large = F.col("_cuts").isNotNull()
        placed = placed.join(F.broadcast(cuts), "_bucket", "left").withColumns(
            {
                "_bucket": F.col("_bucket") * PLACES + F.when(is_large, piece).otherwise(0),
                "_along": F.when(is_large & F.col("_tied"), scaled - F.floor(scaled)).otherwise(F.col("_along")),
                "_tied": F.col("_tied") | (is_large & F.coalesce(on_cut, F.lit(False))),
            }
        ).drop("_cuts")
    return placed


def global_rank(df: DataFrame, score: str, row_id: str, rank: str = "rank", **options) -> DataFrame:
    """row_number over all rows by score, descending unless told otherwise."""
    placed = into_buckets(df, score, row_id, **options)
    return placed.ranked(placed.offsets(), rank=rank).select(*df.columns, rank)


def running_sums(
    df: DataFrame, score: str, row_id: str, sums: dict[str, Column], **options
) -> DataFrame:
    """Rank and running sums over all rows by score."""
    placed = into_buckets(df, score, row_id, **options)
    ranked = placed.ranked(placed.offsets(sums), sums)
    return ranked.select(*df.columns, "rank", *sums)


def value_at_ranks(
    df: DataFrame,
    score: str,
    row_id: str,
    quantiles: dict[str, float],
    label: str,
    value: str,
    **options,
) -> DataFrame:
    """The scores at rank ceil(q * n), ascending. Only buckets that hold such a rank are sorted."""
    placed = into_buckets(df, score, row_id, descending=False, **options)
    wanted = F.array(
        *[
            F.struct(
                F.lit(name).alias("label"),
                F.greatest(F.ceil(F.lit(q) * F.col("_total")), F.lit(1)).alias("rank"),
            )
            for name, q in quantiles.items()
        ]
    )
    offsets = placed.offsets().withColumn("_wanted", wanted)
    holding = offsets.filter(
        F.exists(
            "_wanted",
            lambda w: (w["rank"] > F.col("_before"))
            & (w["rank"] <= F.col("_before") + F.col("_size")),
        )
    )
    hits = F.filter("_wanted", lambda w: w["rank"] == F.col("rank"))
    return (
        placed.ranked(holding, some_buckets=True)
        .select(F.explode(hits).alias("_hit"), F.col("_score").alias(value))
        .select(F.col("_hit.label").alias(label), value)
    )
