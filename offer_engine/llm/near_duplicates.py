"""N-gram Jaccard join by a MinHash LSH forest.

Texts are sets of hashed word shingles. Texts with equal sets are one class from the start, so
copies of any number are one row. A forest of TREES tries holds signatures of DEPTH values; a trie
is its classes in the order of their values, and a node those that share a prefix. Classes meet by
the longest prefix first and pairs that meet are verified on their whole sets. The similarities of
the links found tell how many links of each similarity a prefix misses; it is shortened to the
longest one that misses few enough for the target recall, and so on until the links found bear it
out. A link at the threshold is always reckoned with as not yet seen, and the shortest prefix is
the one that meets the target where all links are at the threshold.

No bucket is worked on as a whole list of pairs: members of a small bucket (SMALL at most) are
joined with each other; a larger one is cut into blocks, and each pair of blocks is one task's
matrix product, which counts links and hands on a spanning forest, not the pairs. A pair is
counted only by the longest prefix and in the first trie where it meets.

Edge cases: words are what white space separates, in lower case. A text of fewer words than a
shingle is one shingle of all its words. A text without words (null and empty ones too) is linked
to nothing and is a class of its own. Rows equal in key and text are documents of one class, like
other copies. A null key is left out of class ids where another is present. An empty table gives
an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offer_engine.llm.common import joined_groups, packed, ship, stored

SHINGLE = 5
THRESHOLD = 0.8
#: Tries, longest prefix, and the chance with which a pair at the threshold must be met.
TREES = 20
DEPTH = 8
RECALL = 0.9999
#: Bins of the similarities of links.
BINS = 20
#: Members of a bucket whose pairs are joined; members of a block of a larger one.
SMALL = 16
BLOCK = 1024
#: Bits of the filter that picks candidates' texts.
FILTER_BITS = 1 << 22

ADDED = ("class_id", "links")


def chance(similarity: np.ndarray | float, length: int, trees: int):
    """The chance that a pair of this similarity shares a prefix of this length in some trie."""
    return 1 - (1 - similarity**length) ** trees


def prefix_length(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix by which pairs at the threshold are met with the target recall."""
    length = depth
    while length > 1 and chance(threshold, length, trees) < recall:
        length -= 1
    return length


def next_length(seen: np.ndarray, length: int, least: int, threshold: float, trees: int, recall: float) -> int:
    """The longest prefix, up to the present one, that should miss few enough links.

    `seen` are the links found so far by bins of similarity, each of which stands for as many as the
    present prefix finds one of; a link at the threshold is added to them."""
    similarity = np.append(threshold + (1 - threshold) * np.arange(len(seen)) / len(seen), threshold)
    links = np.append(seen / chance(similarity[:-1], length, trees), 1.0)
    while length > least and links @ (1 - chance(similarity, length, trees)) > (1 - recall) * links.sum():
        length -= 1
    return length


class Shingler:
    """Sets of shingle hashes; remembers hashes of words."""

    def __init__(self, size: int = SHINGLE, most: int = 500_000):
        self.size, self.most = size, most
        self.known: dict[str, int] = {}
        rng = np.random.default_rng(5)
        self.odd = rng.integers(1 << 62, 1 << 63, size, dtype=np.uint64) | np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes (unsigned 64-bit); empty if there are no words."""
        known, words = self.known, (text or "").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > self.most:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.array([known[w] for w in words], np.uint64)
        n = min(self.size, len(hashes))
        total = np.full(len(hashes) - n + 1, np.uint64(n))
        for j in range(n):
            total = (total ^ hashes[j : len(hashes) - n + 1 + j]) * self.odd[j]
            total ^= total >> np.uint64(32)
        return np.unique(total)


def tail_bits(length: int, depth: int) -> int:
    """Bits for each value after the shortest prefix, all of which are one number."""
    return min(15, 60 // max(1, depth - length))


def signer(trees: int, length: int, depth: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A set's place in each trie: hashes of its first `length` values and, as one number a trie, some
    bits of each of the others up to depth."""
    rng = np.random.default_rng(7)
    n, bits = trees * depth, tail_bits(length, depth)
    a = rng.integers(1, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    mix = rng.integers(1 << 62, 1 << 63, depth, dtype=np.uint64) | np.uint64(1)
    salt = rng.integers(0, 1 << 63, trees, dtype=np.uint64)

    def sign(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = (shingles >> np.uint64(13)).astype(np.uint32)
        least = np.full(n, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(low), 1024):
            part = low[at : at + 1024, None] * a + b
            np.minimum(least, part.min(0), out=least)
        total, tail = salt.copy(), np.zeros(trees, np.uint64)
        for j, column in enumerate(least.reshape(trees, depth).T.astype(np.uint64)):
            if j < length:
                total = (total ^ column) * mix[j]
                total ^= total >> np.uint64(29)
            else:
                tail = tail << np.uint64(bits) | (column * mix[j]) >> np.uint64(64 - bits)
        return total.view(np.int64), tail.view(np.int64)

    return sign


def nodes(length: int, least: int, depth: int) -> Column:
    """The node of each trie that a class is in by a prefix of this length."""
    cut = tail_bits(least, depth) * (depth - length)
    return F.zip_with("keys", "tails", lambda k, t: F.xxhash64(k, F.shiftright(t, cut)))


def text_key(key: Column, text: Column) -> Column:
    """Names a row by its content: equal for rows equal in key and text."""
    parts = [F.coalesce(key.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")))]
    return F.unhex(F.md5(F.concat_ws("|", *parts).cast("binary")))


def signed(docs: DataFrame, text: str, key: str, trees: int, length: int, depth: int, size: int) -> DataFrame:
    """key, name, digest of the set (null without words), its places in the tries (keys and tails), at."""
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        text_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("name"),
        F.col(f"`{text}`").alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]):
        shingler, sign = Shingler(size), signer(trees, length, depth)
        for batch in batches:
            digests, places = [], []
            for value in batch.column(2):
                shingles = shingler(value.as_py())
                full = len(shingles) > 0
                digests.append(hashlib.md5(shingles.tobytes()).digest() if full else None)
                places.append(sign(shingles) if full else (None, None))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(digests, pa.binary()),
                    pa.array([k for k, _ in places], pa.list_(pa.int64())),
                    pa.array([t for _, t in places], pa.list_(pa.int64())),
                ],
                ["key", "name", "digest", "keys", "tails"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(work, f"key {kind}, name binary, digest binary, keys array<bigint>, tails array<bigint>")
    return stored(out.withColumn("at", F.monotonically_increasing_id()))


def chosen(docs: DataFrame, names: DataFrame, text: str, key: str) -> DataFrame:
    """name and text of the documents that are named.

    A filter of FILTER_BITS bits, whose table has FILTER_BITS / 64 rows at most and is broadcast,
    keeps most other texts out of the shuffle.
    """
    spot = F.pmod(F.xxhash64("name"), F.lit(FILTER_BITS))
    word = F.shiftright(spot, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(spot, F.lit(64)).cast("int"))
    marks = names.select(word.alias("word"), bit.alias("bit")).groupBy("word")
    marks = marks.agg(F.bit_or("bit").alias("bits"))
    rows = docs.select(
        text_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("name"), F.col(f"`{text}`").alias("text")
    )
    likely = rows.withColumns({"word": word, "bit": bit}).join(F.broadcast(marks), "word")
    likely = likely.filter(F.col("bits").bitwiseAND(F.col("bit")) != 0).select("name", "text")
    return likely.join(names, "name", "left_semi").dropDuplicates(["name"])


def intersections(sets: Sequence[np.ndarray], columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets of one block, or of two laid together."""
    sizes = [len(s) for s in sets]
    out = np.zeros((len(sets), len(sets)), np.float32)
    of = np.repeat(np.arange(len(sets)), sizes)
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    of, inverse = of[shared], inverse[shared]
    order = np.argsort(inverse, kind="stable")
    of, inverse = of[order], inverse[order]
    if not len(inverse):
        return out
    number = np.cumsum(np.concatenate([[0], inverse[1:] != inverse[:-1]]))
    for at in range(0, number[-1] + 1, columns):
        lo, hi = np.searchsorted(number, (at, at + columns))
        part = np.zeros((len(sets), columns), np.float32)
        part[of[lo:hi], number[lo:hi] - at] = 1
        out += part @ part.T
    return out


def forest_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least member of each member's component."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, left, before[right])
        np.minimum.at(root, right, before[left])
        root = root[root]
        if (root == before).all():
            return root


def bin_of(similarity: np.ndarray, threshold: float) -> np.ndarray:
    """The bin of each similarity from the threshold to 1."""
    share = (similarity - threshold) / max(1 - threshold, 1e-9)
    return np.clip(np.floor(share * BINS), 0, BINS - 1).astype(int)


def block_pairs(threshold: float):
    """Links of a pair of blocks: per member, the documents it is linked to and a root. The first
    member's row has the links by bins of similarity."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable").drop_duplicates("id")
        ids, weight = rows["id"].to_numpy(), rows["copies"].to_numpy()
        tree, block = int(rows["tree"].iloc[0]), rows["block"].to_numpy()
        sets = [np.asarray(s).view(np.uint64) for s in rows["shingles"]]
        sizes = np.array([len(s) for s in sets], np.float64)
        common = intersections(sets).astype(np.float64)
        union = sizes[:, None] + sizes[None] - common
        linked = common >= threshold * union - 1e-9
        np.fill_diagonal(linked, False)
        if rows["low"].iloc[0] != rows["high"].iloc[0]:
            linked &= block[:, None] != block[None]
        prefixes = np.stack(rows["prefixes"].to_list())
        for t in range(tree):
            linked &= prefixes[:, t, None] != prefixes[None, :, t]
        if rows["before"].iloc[0] is not None:
            for column in np.stack(rows["before"].to_list()).T:
                linked &= column[:, None] != column[None]
        at = bin_of(np.triu(common / union, 1)[np.triu(linked)], threshold)
        root = forest_roots(len(ids), *np.nonzero(linked))
        out = pd.DataFrame({"id": ids, "links": linked @ weight, "other": ids[root]})
        out = out[out["links"] > 0]
        seen = [np.bincount(at, minlength=BINS).tolist(), *[None] * len(out)][: len(out)]
        return out.assign(seen=pd.Series(seen, out.index, object))

    return work


def components(edges: DataFrame) -> DataFrame:
    """id and the least id of its component, for the ids of edges (id, other)."""
    both = edges.unionByName(edges.select(F.col("other").alias("id"), F.col("id").alias("other")))
    both = stored(both.filter("id <> other").distinct())
    labels = stored(both.groupBy("id").agg(F.min("other").alias("least")).select(
        "id", F.least("id", "least").alias("label")
    ))
    while True:
        near = both.join(labels.withColumnRenamed("id", "other"), "other")
        near = near.groupBy("id").agg(F.min("label").alias("near"))
        lower = stored(
            labels.join(near, "id").select(
                "id", "label", F.least("label", "near").alias("new")
            )
        )
        jump = lower.select(F.col("id").alias("new"), F.col("new").alias("next"))
        after = stored(
            lower.join(jump, "new", "left").select(
                "id", "label", F.least("new", "next").alias("new")
            )
        )
        changed = not after.filter("label <> new").isEmpty()
        labels = after.select("id", F.col("new").alias("label"))
        if not changed:
            return labels


def links_by(
    docs: DataFrame,
    groups: DataFrame,
    text: str,
    key: str,
    size: int,
    threshold: float,
    prefix: tuple[int, int | None, int, int],
    small: int,
    block: int,
) -> tuple[DataFrame, np.ndarray]:
    """Links between classes that share a prefix of a length but none of the length tried before: per
    class, documents linked to and another class it is linked to; and the links by bins of similarity.

    `prefix` is that length, the one before (None at first), the shortest and the longest one."""
    length, before, least, depth = prefix
    old = F.lit(None).cast("array<bigint>") if before is None else nodes(before, least, depth)
    groups = groups.select("id", "name", "copies", nodes(length, least, depth).alias("prefixes"), old.alias("before"))
    met = groups.select("id", F.posexplode("prefixes").alias("tree", "bucket"))
    sizes = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stored(met.join(sizes, "bucket"))
    few = members.filter(F.col("members") <= small)
    pairs = few.select("bucket", "tree", "id").join(
        few.select("bucket", F.col("id").alias("other")), "bucket"
    )
    pairs = stored(
        pairs.filter("id < other").groupBy("id", "other").agg(F.min("tree").alias("tree"))
    )
    many = members.filter(F.col("members") > small)
    ids = stored(
        pairs.select("id")
        .union(pairs.select("other"))
        .union(many.select("id"))
        .distinct()
        .join(groups, "id")
    )

    def shingled(batches: Iterator[pa.RecordBatch]):
        shingler = Shingler(size)
        for batch in batches:
            sets = [shingler(v.as_py()).view(np.int64) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["name", "shingles"]
            )

    texts = chosen(docs, ids.select("name"), text, key)
    sets = texts.mapInArrow(shingled, "name binary, shingles array<bigint>")
    sets = stored(sets.join(ids, "name").select("id", "copies", "prefixes", "before", "shingles"))

    # Pairs of small buckets: verified by Spark's own set functions.
    def side(n: int) -> DataFrame:
        return sets.withColumnsRenamed({c: f"{c}{n}" for c in sets.columns if c != "id"})

    # Rounded so that a threshold given in tenths is met where it is met exactly.
    common = F.size(F.array_intersect("shingles1", "shingles2"))
    union = F.size("shingles1") + F.size("shingles2") - F.col("common")
    first = F.array_position(
        F.zip_with("prefixes1", "prefixes2", lambda a, b: a == b), F.lit(True)
    )
    earlier = F.exists(F.zip_with("before1", "before2", lambda a, b: a == b), lambda same: same)
    known = F.coalesce(earlier, F.lit(False))
    share = (F.col("common") / union - F.lit(threshold)) / F.lit(max(1 - threshold, 1e-9))
    bin_at = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(share * BINS).cast("int")))
    verified = (
        pairs.join(side(1), "id")
        .join(side(2).withColumnRenamed("id", "other"), "other")
        .filter((first == F.col("tree") + 1) & ~known)
        .withColumn("common", common)
        .filter(F.col("common") >= F.lit(threshold) * union - F.lit(1e-9))
    )
    verified = stored(verified.select("id", "other", "copies1", "copies2", bin_at.alias("bin")))
    seen = verified.groupBy("bin").agg(F.count(F.lit(1)).alias("pairs"))
    found = verified.select("id", F.col("copies2").alias("links"), "other").unionByName(
        verified.select(
            F.col("other").alias("id"), F.col("copies1").alias("links"), F.col("id").alias("other")
        )
    )
    if not many.isEmpty():
        parts = F.ceil(F.col("members") / F.lit(block)).cast("int")
        mine = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
        units = (
            many.withColumn("parts", parts)
            .withColumn("block", mine)
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select(
                "id",
                "tree",
                "bucket",
                "block",
                F.least("block", "with").alias("low"),
                F.greatest("block", "with").alias("high"),
            )
        )
        units = units.join(sets, "id").groupBy("bucket", "low", "high")
        counted = stored(
            units.applyInPandas(block_pairs(threshold), "id long, links long, other long, seen array<long>")
        )
        found = found.unionByName(counted.drop("seen"))
        in_blocks = counted.select(F.posexplode("seen").alias("bin", "pairs"))
        seen = seen.unionByName(in_blocks).groupBy("bin").agg(F.sum("pairs").alias("pairs"))
    counts = np.zeros(BINS)
    for row in seen.collect():
        counts[row["bin"]] = row["pairs"]
    return found, counts


def near_classes(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    small: int = SMALL,
    block: int = BLOCK,
) -> DataFrame:
    """key, name, at, class_id and links of every document, as a stored table.

    links counts the other documents whose set has the threshold's Jaccard with this one's, copies
    counted each. class_id is the least key that links lead to.
    """
    ship(docs.sparkSession)
    least = prefix_length(threshold, trees, depth, recall)
    rows = signed(docs, text, key, trees, least, depth, size)
    total = rows.count()
    groups = stored(
        rows.filter("digest is not null")
        .groupBy("digest")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("key").alias("least_key"),
            F.min_by(F.struct("at", "name", "keys", "tails"), "at").alias("first"),
        )
        .select("digest", "copies", "least_key", "first.*")
        .withColumnRenamed("at", "id")
    )
    length, before, parts, seen = depth, None, [], np.zeros(BINS)
    while True:
        links, counts = links_by(docs, groups, text, key, size, threshold, (length, before, least, depth), small, block)
        parts.append(links)
        seen += counts
        shorter = next_length(seen, length, least, threshold, trees, recall)
        if shorter == length:
            break
        length, before = shorter, length
    found = reduce(DataFrame.unionByName, parts)
    links = found.groupBy("id").agg(F.sum("links").alias("linked"))
    labels = components(found.select("id", "other"))
    joined = stored(
        groups.select("id", "digest", "copies", "least_key")
        .join(labels, "id", "left")
        .join(links, "id", "left")
        .withColumn("label", F.coalesce("label", "id"))
    )
    ids = joined.groupBy("label").agg(F.min("least_key").alias("class_id"))
    classes = joined.join(ids, "label").select(
        "digest",
        "copies",
        "class_id",
        F.col("label").alias("class_at"),
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"),
    )
    with_words = rows.filter("digest is not null").select("key", "name", "at", "digest")
    full = joined_groups(with_words, stored(classes), "digest", "copies", total)
    order = ["key", "name", "at", "class_id", "class_at", "links"]
    alone = rows.filter("digest is null").select(
        "key",
        "name",
        "at",
        F.col("key").alias("class_id"),
        F.col("at").alias("class_at"),
        F.lit(0).cast("long").alias("links"),
    )
    return stored(full.select(*order).unionByName(alone))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """docs with one row of each class: that of the least key, of equal ones the first read."""
    found = near_classes(docs, text, key, **options)
    best = found.groupBy("class_at").agg(
        F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "at")).alias("best")
    )
    kept = found.join(best, "class_at").filter(F.col("at") == F.col("best.at")).select("name")
    names = docs.columns
    rows = docs.select(
        packed(docs), text_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("name")
    )
    # Classes are sets of texts, so rows equal in key and text are in one class.
    rows = rows.join(kept, "name", "left_semi").dropDuplicates(["name"])
    return rows.select(*[F.col("row").getField(n).alias(n) for n in names])
