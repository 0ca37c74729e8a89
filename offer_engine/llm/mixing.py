"""Mixing sources to target weights by hash thresholds.

Sizes are summed by source and hash bucket. Running sums of the few buckets show the one in which
a source's budget ends; only that bucket is cut into finer ones by further bits of the hash,
until one document is left. The mix is then a filter: a document is taken once more if its hash
lies below its source's threshold. Nothing is sorted, and thresholds are nested: a larger budget
takes all that a smaller one takes.

Edge cases: a null or empty text has size 0 and nothing of it is taken. A null source is a source
of its own, ordered last. Rows with equal keys have equal hashes and are taken alike. A source
without words gets the target 0. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offer_engine.llm.common import packed, small, stored, unpacked

#: A hash has LEVELS * BITS bits; a level cuts a bucket into 2 ** BITS.
BITS = 12
LEVELS = 5

WORD = r"[^\x20\x09-\x0D]+"
ADDED = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_hash(key: Column) -> Column:
    """60 bits of the key's MD5."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """source, source_size, target: `share` of all sizes dealt by weight, none above `most` times
    its source's size, the excess dealt again by weight.

    The dealing again ends where each target is its weight times one level, or its limit. Sources
    are ordered by limit / weight; the level is the budget left by the limits before, over the
    weights left, at the first source that doesn't reach its limit. One row per source goes
    through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    limit = F.lit(most) * F.col("source_size")
    listed = sizes.withColumn(
        "weight", F.element_at(cycle, (F.pmod(number - 1, F.lit(len(weights))) + 1).cast("int"))
    ).withColumns({"limit": limit, "reach": limit.cast("double") / F.col("weight")})
    order = [F.col("reach"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    full = F.coalesce(F.sum("limit").over(before), F.lit(0))
    level = (budget - full) / F.sum("weight").over(after)
    levels = listed.withColumn("level", level)
    place = F.struct("reach", F.col("source").isNull().alias("last"), "source", "level")
    first = F.min(F.when(F.col("level") <= F.col("reach"), place))
    held = levels.withColumn("level", first.over(everything).getField("level"))
    limits = F.col("limit").cast("double")
    target = F.least(F.coalesce(F.col("weight") * F.col("level"), limits), limits)
    return held.select("source", "source_size", target.alias("target"))


def thresholds(slim: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source: `whole`, how often every document is taken, and `below`, the hash under which
    it is taken once more. slim (source, size, hash) is a stored table."""
    width = BITS * LEVELS
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    goals = goals.withColumn("whole", whole.cast("long"))
    need = F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    open_ = stored(goals.select("source", need.alias("need"), F.lit(0).cast("long").alias("at")))
    ends = None
    for level in range(LEVELS):
        shift = width - BITS * (level + 1)
        rows = slim.withColumn("bucket", F.shiftright("hash", shift))
        if level:
            parent = open_.select(F.col("source").alias("in_source"), F.col("at").alias("in_at"))
            inside = F.col("source").eqNullSafe(F.col("in_source")) & (
                F.shiftright("bucket", BITS) == F.col("in_at")
            )
            rows = rows.join(small(parent), inside, "left_semi")
        sums = rows.groupBy("source", "bucket").agg(
            F.sum("size").alias("sum"),
            (F.min("hash") == F.max("hash")).alias("single"),
        )
        before = (
            Window.partitionBy("source")
            .orderBy("bucket")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        lines = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0)))
        goal = open_.select(F.col("source").alias("of"), "need")
        hit = (F.col("before") <= F.col("need")) & (F.col("need") < F.col("before") + F.col("sum"))
        met = stored(
            lines.join(small(goal), F.col("source").eqNullSafe(F.col("of")))
            .filter(hit)
            .select(
                "source",
                (F.col("need") - F.col("before")).alias("need"),
                F.col("bucket").alias("at"),
                "sum",
                "single",
                F.lit(shift).alias("shift"),
            )
        )
        done = F.lit(True) if level == LEVELS - 1 else F.col("single")
        ended = met.filter(done)
        ends = ended if ends is None else ends.unionByName(ended)
        open_ = met.filter(~done)
        if open_.isEmpty():
            break
    # The bucket that is left goes to the side that comes nearer to the budget.
    more = F.when(F.col("need") * 2 > F.col("sum"), 1).otherwise(0)
    edge = (F.col("at") + more) * F.pow(F.lit(2.0), F.col("shift")).cast("long")
    ends = ends.select(F.col("source").alias("of"), edge.alias("below"))
    joined = goals.join(ends, F.col("source").eqNullSafe(F.col("of")), "left")
    return joined.select(
        "source",
        "source_size",
        "target",
        "whole",
        F.coalesce("below", F.lit(0).cast("long")).alias("below"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The named columns of docs (all by default) for every row, with size, source_size, target
    and taken. A column of docs of one of these names is replaced.

    taken / size is the number of times that the mix holds the document.
    """
    names = docs.columns if columns is None else list(columns)
    rows = docs.select(
        packed(docs, names),
        F.col(f"`{source}`").cast("string").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        key_hash(F.col(f"`{key}`")).alias("hash"),
    )
    rows = stored(rows)
    slim = rows.select("source", "size", "hash")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(thresholds(slim, stored(targets(sizes, weights, share, most))))
    plan = plan.withColumnRenamed("source", "of")
    found = rows.join(small(plan), F.col("source").eqNullSafe(F.col("of")))
    times = F.col("whole") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    result = found.select(
        "row", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )
    return unpacked(result, names, ADDED)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix holds them: none, one or several rows of each document. Documents without
    words are kept once."""
    names = docs.columns
    found = mix(docs.withColumn("__packed", packed(docs)), columns=["__packed"], **options)
    times = F.when(F.col("size") == 0, 1).otherwise((F.col("taken") / F.col("size")).cast("int"))
    copies = found.filter(times > 0).select("__packed", F.explode(F.sequence(F.lit(1), times)))
    return copies.select(*[F.col("__packed").getField(n).alias(n) for n in names])
