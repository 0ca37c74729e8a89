"""Exact dedup with a heavy-hitter split.

Misra-Gries counters find digests that hold a large share of the rows. Their winners are
verified by exact counts and broadcast, so copies of a frequent text are settled where they are
read. All other digests are grouped by an ordinary shuffle of digest and id.

Edge cases: a null text counts as the empty text; empty texts are copies of each other. Of equal
texts the row with the largest key stays, and a null key is smaller than any. Rows equal in text
and key are copies of each other, of which exactly one stays. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import packed, ship, stored, unpacked

#: Counters a task keeps. The counts are too small by rows / (COUNTERS + 1) at most.
COUNTERS = 1000
#: Share of the rows from which a digest is heavy.
HEAVY_SHARE = 1 / 500

ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def reduced(counts: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """At most `counters` counts: all go down by the largest one that must go."""
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {k: v - cut for k, v in counts.items() if v > cut}


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int = COUNTERS):
    """Frequent values of the first column of a partition, with counts that are never too high."""
    counts: dict[bytes, int] = {}
    for batch in batches:
        for pair in batch.column(0).value_counts():
            value = pair["values"].as_py()
            counts[value] = counts.get(value, 0) + pair["counts"].as_py()
        counts = reduced(counts, counters)
    yield pa.RecordBatch.from_pydict(
        {
            "digest": pa.array(list(counts), pa.binary()),
            "low": pa.array(list(counts.values()), pa.int64()),
        }
    )


def frequent(digests: DataFrame, rows: int) -> DataFrame:
    """Digests that may hold HEAVY_SHARE of the rows, among them all that do.

    The counts add up to `rows` at most and each is above the least of them, so no more than
    1 / (HEAVY_SHARE - 1 / (COUNTERS + 1)), about 1,000, can pass.
    """
    least = rows * (HEAVY_SHARE - 1 / (COUNTERS + 1))
    counts = digests.mapInArrow(misra_gries, "digest binary, low long")
    return counts.groupBy("digest").agg(F.sum("low").alias("low")).filter(F.col("low") > least)


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", columns=None):
    """The named columns of docs (all by default) for every row, with keep_id, group_size, kept
    and text_sha256. A column of docs of one of these names is replaced."""
    ship(docs.sparkSession)
    names = docs.columns if columns is None else list(columns)
    rows = stored(
        docs.select(
            packed(docs, names),
            F.col(f"`{key}`").alias("id"),
            F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    winner = [
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct("id", (-F.col("at")).alias("at"))).alias("best"),
    ]
    candidates = stored(frequent(rows.select("digest"), rows.count())).select("digest")
    heavy = stored(
        rows.select("digest", "id", "at")
        .join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(*winner)
    )
    settled = rows.join(F.broadcast(heavy), "digest")
    light = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    groups = light.select("digest", "id", "at").groupBy("digest").agg(*winner)
    found = settled.unionByName(light.join(groups, "digest"))
    result = found.select(
        "row",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("at") == -F.col("best.at")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    return unpacked(result, names, ADDED)


def without_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each text."""
    names = docs.columns
    found = exact_dedup(docs.select(packed(docs), f"`{text}`", f"`{key}`"), text, key, ["row"])
    return found.filter("kept").select(*[F.col("row").getField(n).alias(n) for n in names])
