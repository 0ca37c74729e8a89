"""Sharding by balanced label propagation, with equal texts as links.

Every document starts in a random shard. In each round, groups of equal texts want their members
in the shard where most of them lie. Wishes are summed per pair of shards, cut down to flows that
leave no shard above its quota, and granted within a pair to the groups that gain most. Members
of a group are alike, so the state is a count per group and shard: a group of any size is one row.
Documents without a link, which no cut can touch, then fill the shards to the row.

The law is `rows`: row counts of shards differ by one at most.

Edge cases: a null text has size 1, as the empty text has, and both are linked as equal. Rows
equal in everything are separate documents. A group above a shard's quota is spread over as few
shards as the rounds find. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import bucket_count, hash_bucket, packed, running, small, stored
from offer_engine.llm.common import unpacked

#: Rounds of moves at most; they end when nothing moves.
ROUNDS = 12
#: A group with more than rows / HEAVY_GROUPS members is joined by broadcast: fewer than
#: HEAVY_GROUPS can be that large.
HEAVY_GROUPS = 1000

ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def granted_flows(wanted: list[list[int]], room: list[int]) -> list[list[int]]:
    """Flows between shards, none above the wanted one, so that no shard gains more than its room.

    Where a shard would gain too much, what flows into it is cut in proportion. Cuts lessen the
    outflow of others, so it is done until all hold.
    """
    shards = range(len(room))
    flow = [row[:] for row in wanted]
    changed = True
    while changed:
        changed = False
        for t in shards:
            inflow = sum(flow[s][t] for s in shards)
            allowed = max(0, max(0, room[t]) + sum(flow[t]))
            if inflow > allowed:
                changed = True
                left = allowed
                for s in shards:
                    part = min(left, -(-flow[s][t] * allowed // inflow))
                    left -= part
                    flow[s][t] = part
    return flow


def best_shard(members: Column, open_: Sequence[bool], turn: Column) -> Column:
    """The open shard with most members; of equal ones the first after the group's own turn."""
    n = len(open_)
    ranked = [
        F.when(
            F.lit(o),
            F.struct(
                members[k].alias("members"),
                (-F.pmod(turn + k, F.lit(n))).alias("turn"),
                F.lit(k).alias("shard"),
            ),
        )
        for k, o in enumerate(open_)
    ]
    return F.greatest(*ranked, F.lit(None).cast("struct<members:bigint,turn:int,shard:int>"))[
        "shard"
    ]


def loads(groups: DataFrame, shards: int) -> list[int]:
    sums = groups.agg(*[F.sum(F.col("members")[k]) for k in range(shards)]).first()
    return [s or 0 for s in sums]


def as_members(parts: DataFrame, shards: int) -> Column:
    """Sums of `amount` by `shard`, as an array."""
    return F.array(
        *[
            F.coalesce(F.sum(F.when(F.col("shard") == k, F.col("amount"))), F.lit(0)).cast("long")
            for k in range(shards)
        ]
    ).alias("members")


def propagated(groups: DataFrame, quota: list[int], rounds: int) -> DataFrame:
    """groups (id, members array<long>) after the rounds."""
    shards = len(quota)
    size = F.aggregate("members", F.lit(0).cast("long"), lambda a, b: a + b)
    count = groups.count()
    quiet = 0
    for turn in range(rounds):
        load = loads(groups, shards)
        room = [q - x for q, x in zip(quota, load)]
        # Every other round looks past full shards, so that groups which can't have their first
        # wish still come together elsewhere.
        open_ = [True] * shards if turn % 2 == 0 or max(room) <= 0 else [r > 0 for r in room]
        aimed = groups.withColumn(
            "target", best_shard(F.col("members"), open_, F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
        ).withColumn("own", F.element_at("members", F.col("target") + 1))
        wishes = (
            aimed.select("id", "target", "own", size.alias("all"), F.posexplode("members"))
            .withColumnsRenamed({"pos": "shard", "col": "amount"})
            .filter((F.col("shard") != F.col("target")) & (F.col("amount") > 0))
            .filter(F.col("amount") <= F.col("own"))
        )
        step = F.least(F.lit(40), F.floor(F.log2(F.col("own") - F.col("amount") + 1)).cast("int"))
        spread = bucket_count(count)
        wishes = stored(
            wishes.withColumn(
                "bucket", (40 - step) * spread + hash_bucket(spread, "id")
            )
        )
        wanted = [[0] * shards for _ in range(shards)]
        for r in wishes.groupBy("shard", "target").agg(F.sum("amount").alias("n")).collect():
            wanted[r["shard"]][r["target"]] = r["n"]
        flow = granted_flows(wanted, room)
        if not sum(map(sum, flow)):
            quiet += 1
            if quiet == 2:
                break
            continue
        quiet = 0
        limit = F.array(*[F.array(*[F.lit(x).cast("long") for x in row]) for row in flow])
        most = F.element_at(F.element_at(limit, F.col("shard") + 1), F.col("target") + 1)
        moved = running(wishes, ["shard", "target"], "bucket", ["id"], "amount")
        moved = moved.withColumn(
            "moved", F.greatest(F.lit(0), F.least(F.col("amount"), most - F.col("before")))
        ).filter(F.col("moved") > 0)
        moves = moved.select(
            "id",
            F.explode(
                F.array(
                    F.struct(F.col("shard"), (-F.col("moved")).alias("amount")),
                    F.struct(F.col("target").alias("shard"), F.col("moved").alias("amount")),
                )
            ).alias("m"),
        ).select("id", "m.shard", "m.amount")
        change = moves.groupBy("id").agg(as_members(moves, shards).alias("change"))
        groups = stored(
            groups.join(change, "id", "left").select(
                "id",
                F.when(
                    F.col("change").isNotNull(),
                    F.zip_with("members", "change", lambda a, b: a + b),
                )
                .otherwise(F.col("members"))
                .alias("members"),
            )
        )
    return groups


def within_quotas(groups: DataFrame, quota: list[int]) -> DataFrame:
    """Take out of shards above their quota what is too much, from groups with fewest members
    there. What is taken out is placed with the documents that have no link."""
    shards = len(quota)
    excess = [max(0, x - q) for x, q in zip(loads(groups, shards), quota)]
    if not sum(excess):
        return groups
    spread = bucket_count(groups.count())
    parts = stored(
        groups.select("id", F.posexplode("members"))
        .withColumnsRenamed({"pos": "shard", "col": "amount"})
        .filter("amount > 0")
        .withColumn(
            "bucket",
            F.floor(F.log2("amount")).cast("int") * spread + hash_bucket(spread, "id"),
        )
    )
    limit = F.element_at(F.array(*[F.lit(x).cast("long") for x in excess]), F.col("shard") + 1)
    kept = running(parts, ["shard"], "bucket", ["id"], "amount").withColumn(
        "amount",
        F.col("amount")
        - F.greatest(F.lit(0), F.least(F.col("amount"), limit - F.col("before"))),
    )
    return stored(kept.groupBy("id").agg(as_members(kept, shards)))


def by_ranges(rank: Column, lengths: Column) -> Column:
    """The first position whose running sum of lengths is above rank; null beyond the last."""
    ends = F.transform(
        lengths,
        lambda x, i: F.aggregate(
            F.slice(lengths, 1, i + 1), F.lit(0).cast("long"), lambda a, b: a + b
        ),
    )
    at = F.size(F.filter(ends, lambda e: e <= rank))
    return F.when(at < F.size(lengths), at)


def shard(
    docs: DataFrame,
    shards: int = 8,
    rounds: int = ROUNDS,
    text: str = "text",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The named columns of docs (all by default) for every row, with size, text_crc32, law,
    shard, slot and grown_shard. A column of docs of one of these names is replaced."""
    names = docs.columns if columns is None else list(columns)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = stored(
        docs.select(
            packed(docs, names),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(body.cast("binary"))).alias("id"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    total = rows.count()
    quota = quotas(total, shards)
    spread = bucket_count(total)
    slim = rows.select("id", "at", hash_bucket(shards, "at", F.lit(1)).alias("shard"))
    groups = stored(
        slim.withColumn("amount", F.lit(1))
        .groupBy("id")
        .agg(as_members(slim, shards), F.count(F.lit(1)).alias("all"))
        .filter("all > 1")
    )
    placed = within_quotas(propagated(groups.select("id", "members"), quota, rounds), quota)
    placed = placed.join(groups.select("id", "all"), "id")
    whole = F.array_contains("members", F.col("all"))
    placed = stored(
        placed.withColumn(
            "home", F.when(whole, F.array_position("members", F.col("all")).cast("int") - 1)
        )
    )
    # Large groups come by broadcast, the others by an ordinary join.
    is_heavy = F.col("all") > total // HEAVY_GROUPS
    heavy = F.broadcast(placed.filter(is_heavy))
    light = placed.filter(~is_heavy)
    near = rows.drop("row").join(heavy, "id")
    rest = rows.drop("row").join(F.broadcast(placed.filter(is_heavy).select("id")), "id", "left_anti")
    linked = near.unionByName(rest.join(light, "id", "left"))
    linked = stored(linked.withColumn("bucket", hash_bucket(spread, "at")))
    split = linked.filter("all is not null and home is null").withColumn("one", F.lit(1))
    split = running(split, ["id"], "bucket", ["at"], "one", "rank")
    split = split.withColumn("home", by_ranges(F.col("rank"), F.col("members")))
    fixed = ["at", "bucket", "home"]
    open_rows = linked.filter("all is null").select(*fixed).unionByName(split.select(*fixed))
    settled = linked.filter("home is not null").select("at", F.col("home").alias("shard"))
    open_rows = stored(open_rows.withColumn("one", F.lit(1)))
    room = [q - x for q, x in zip(quota, loads(placed, shards))]
    loose = running(open_rows.filter("home is null"), [], "bucket", ["at"], "one", "rank")
    rooms = F.array(*[F.lit(x).cast("long") for x in room])
    loose = loose.select("at", by_ranges(F.col("rank"), rooms).alias("shard"))
    parts = open_rows.filter("home is not null").select("at", F.col("home").alias("shard"))
    homes = settled.unionByName(parts).unionByName(loose)
    homes = stored(
        homes.select("at", F.col("shard").cast("int").alias("shard")).withColumns(
            {"bucket": hash_bucket(spread, "at"), "one": F.lit(1)}
        )
    )
    slots = running(homes, ["shard"], "bucket", ["at"], "one", "slot")
    result = rows.join(slots.select("at", "shard", "slot"), "at").select(
        "row",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    return unpacked(result, names, ADDED)


def cut_links(sharded: DataFrame, group: Sequence[str]) -> DataFrame:
    """links and cut: pairs of linked documents, and those of them in different shards."""
    inside = sharded.groupBy(*group, "shard").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = inside.groupBy(*group).agg(
        (F.pow(F.sum("n"), 2) - F.sum("n")).alias("all"),
        (F.sum(F.col("n") * F.col("n")) - F.sum("n")).alias("kept"),
    )
    half = pairs.agg((F.sum("all") / 2).alias("links"), (F.sum(F.col("all") - F.col("kept")) / 2).alias("cut"))
    return half.select(*[F.coalesce(F.col(c), F.lit(0.0)).cast("long").alias(c) for c in half.columns])
