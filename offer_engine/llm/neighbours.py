"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample of SAMPLE vectors and every vector is put into a leaf. A
query walks the tree best bin first: a priority queue holds the branches not taken, by distance of
their centre, and gives the next leaf. How many leaves to visit is calibrated on the sample: it is
widened until the recall against brute force reaches RECALL. Distances are worked out on the
original vectors in double precision.

The visits are made in two rounds. The first FIRST leaves of a query give it a distance that its
result can't exceed; in the leaves after them only vectors within that distance are handed on.

Leaves are cut into cells of bounded size by hash, and so are the queries of a leaf, so that a
leaf with a third of all vectors is many tasks' work. Each cell returns its nearest few per query.

Edge cases: vectors that are null, zero, hold null or non-finite components, have no id, or have
not the most frequent length take no part, as query or candidate. Rows with one id are one
candidate, at the distance of the nearest of them; as a query, the least of them by components
counts. Ties go to the smaller id. With fewer candidates than asked for, all are returned. An
empty table gives an empty one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offer_engine.llm.common import ship, stored

#: Bound of the sample the tree is fitted on, and of its queries for calibration.
SAMPLE = 20_000
CALIBRATION = 200
BRANCHES = 8
#: Vectors of a leaf that are aimed at, and leaves at most: a sixteenth of the sample.
LEAF_ROWS = 400
MOST_LEAVES = SAMPLE // 16
RECALL = 0.97
#: Leaves of the first round.
FIRST = 3
#: Vectors and queries of a cell at most, on average.
CELL_ROWS = 2048
CELL_QUERIES = 512


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Centres of x, fewer than k if it has fewer distinct points."""
    centres = np.unique(x[rng.permutation(len(x))[: 4 * k]], axis=0)
    centres = centres[rng.permutation(len(centres))[:k]]
    for _ in range(rounds):
        label = nearest(x, centres)
        counts = np.bincount(label, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, label, x)
        centres = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)


@dataclass
class Tree:
    """children[node]: (centres, nodes); leaf[node]: its number, or -1 inside."""

    children: dict[int, tuple[np.ndarray, list[int]]]
    leaf: list[int]

    @property
    def leaves(self) -> int:
        return max(self.leaf, default=-1) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of x."""
        out = np.zeros(len(x), np.int64)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            centres, nodes = self.children[node]
            label = nearest(x[rows], centres)
            stack += [(nodes[i], rows[label == i]) for i in np.unique(label)]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in the order of a best-bin-first walk."""
        queue = [(0.0, 0)]
        while queue:
            node = heapq.heappop(queue)[1]
            while self.leaf[node] < 0:
                centres, nodes = self.children[node]
                far = ((centres - query) ** 2).sum(1)
                best = int(far.argmin())
                for i, d in enumerate(far.tolist()):
                    if i != best:
                        heapq.heappush(queue, (d, nodes[i]))
                node = nodes[best]
            yield self.leaf[node]


def fit_tree(x: np.ndarray, leaf_rows: float, branches: int = BRANCHES, seed: int = 3) -> Tree:
    rng = np.random.default_rng(seed)
    children: dict[int, tuple[np.ndarray, list[int]]] = {}
    leaf, count = [-1], 0
    stack = [(0, np.arange(len(x)))]
    while stack:
        node, rows = stack.pop()
        centres = k_means(x[rows], branches, rng) if len(rows) > leaf_rows else x[:0]
        if len(centres) < 2:
            leaf[node] = count
            count += 1
            continue
        label = nearest(x[rows], centres)
        nodes = list(range(len(leaf), len(leaf) + len(centres)))
        leaf += [-1] * len(centres)
        children[node] = (centres, nodes)
        stack += [(n, rows[label == i]) for i, n in enumerate(nodes)]
    return Tree(children, leaf)


def calibrated(tree: Tree, x: np.ndarray, near: int, recall: float, queries: int) -> int:
    """The fewest leaf visits that find the target share of the nearest vectors of the sample."""
    leaf = tree.assign(x)
    asked = np.linspace(0, len(x) - 1, min(queries, len(x))).astype(int)
    hits = np.zeros(tree.leaves)
    total = 0
    for q in asked:
        far = ((x - x[q]) ** 2).sum(1)
        far[q] = np.inf
        best = np.argsort(far, kind="stable")[: min(near, len(x) - 1)]
        place = np.empty(tree.leaves, int)
        place[list(tree.visits(x[q]))] = np.arange(tree.leaves)
        hits += np.bincount(place[leaf[best]], minlength=tree.leaves)
        total += len(best)
    if not total:
        return tree.leaves
    return int(np.searchsorted(np.cumsum(hits) / total, recall - 1e-12)) + 1


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda c: c != 0)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def in_leaves(vectors: DataFrame, tree: Tree) -> DataFrame:
    sent = vectors.sparkSession.sparkContext.broadcast(tree)

    def work(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                leaf = sent.value.assign(matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(leaf, pa.int32())],
                    ["id", "vector", "leaf"],
                )

    return vectors.mapInArrow(work, "id long, vector array<double>, leaf int")


def with_visits(queries: DataFrame, tree: Tree, sizes: list[int], visits: int, near: int):
    """Queries with the leaves they visit: `visits` of them, and more until these hold enough."""
    sent = queries.sparkSession.sparkContext.broadcast((tree, sizes))

    def work(batches: Iterator[pa.RecordBatch]):
        walk, rows = sent.value
        for batch in batches:
            out = []
            for q in matrix(batch.column(1)):
                seen, held = [], 0
                for leaf in walk.visits(q):
                    if len(seen) >= visits and held > 2 * near:
                        break
                    seen.append(leaf)
                    held += rows[leaf]
                out.append(seen)
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))],
                    ["id", "vector", "leaves"],
                )

    return queries.mapInArrow(work, "id long, vector array<double>, leaves array<int>")


def best_of_cell(near: int):
    def work(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(rows):
            return pd.DataFrame({n: [] for n in names}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        rows = rows.sort_values("id", kind="stable")
        ids, x = rows["id"].to_numpy(), np.stack(rows["vector"].to_list())
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        out = []
        for q, v, bound in zip(queries["id"], queries["vector"], queries["bound"], strict=True):
            far = np.sqrt(((x - v) ** 2).sum(1))
            far[(ids == q) | (far > bound)] = np.inf
            # The least distance of each id, then the nearest ids.
            far = np.minimum.reduceat(far, first)
            most = min(near, len(far))
            limit = np.partition(far, most - 1)[most - 1]
            at = np.flatnonzero((far <= limit) & np.isfinite(far))
            at = at[np.argsort(far[at], kind="stable")][:near]
            out.append(pd.DataFrame({"query_id": q, "vec_id": ids[first][at], "score": far[at]}))
        return pd.concat(out)

    return work


def visited(queries: DataFrame, index: DataFrame, sizes: list[int], near: int) -> DataFrame:
    """query_id, vec_id and score of the nearest few of each cell of the leaves that the queries
    (id, vector, bound, leaves) visit, within their bounds."""
    paths = queries.select("id", F.explode("leaves").alias("leaf"))
    asks = {r["leaf"]: r["count"] for r in paths.groupBy("leaf").count().collect()}
    cells = queries.sparkSession.createDataFrame(
        [
            (i, -(-max(1, n) // CELL_ROWS), -(-max(1, asks.get(i, 0)) // CELL_QUERIES))
            for i, n in enumerate(sizes)
        ],
        "leaf int, row_parts int, query_parts int",
    )
    cells = F.broadcast(cells)  # MOST_LEAVES rows or few more
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    mine = lambda parts, *by: F.pmod(F.xxhash64("id", *by), F.col(parts)).cast("int")
    left = (
        queries.select("id", "vector", "bound", F.explode("leaves").alias("leaf"))
        .join(cells, "leaf")
        .withColumn("q", mine("query_parts"))
        .withColumn("r", every("row_parts"))
    )
    # An id may have any number of rows, so they are dealt by their own number as well.
    right = index.join(cells, "leaf").withColumn("r", mine("row_parts", "at"))
    right = right.withColumn("q", every("query_parts"))
    keys = ["leaf", "r", "q"]
    return (
        left.select(*keys, "id", "vector", "bound")
        .groupBy(*keys)
        .cogroup(right.select(*keys, "id", "vector").groupBy(*keys))
        .applyInPandas(best_of_cell(near), "query_id long, vec_id long, score double")
    )


def top(found: DataFrame, near: int) -> DataFrame:
    """The nearest of each query, ranked; each candidate once."""
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= near)


def search(
    table: DataFrame,
    is_query: Column,
    near: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    recall: float = RECALL,
    sample_rows: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest found for each row where is_query holds."""
    ship(table.sparkSession)
    rows = table.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        is_query.alias("asks"),
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    lengths = rows.groupBy(F.size("vector").alias("n")).count()
    length = lengths.orderBy(F.desc("count"), "n").first()
    if length is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    total = length["count"]
    rows = rows.filter(F.size("vector") == length["n"])
    # About sample_rows rows, drawn by row: an id with many rows has its share of them.
    unit = (F.xxhash64("id", "at") / F.lit(2.0**64)) + 0.5
    picked = rows.filter(unit < min(1.0, sample_rows / total)).select("id", "vector").toPandas()
    if picked.empty:
        picked = rows.select("id", "vector").limit(1).toPandas()
    x = np.stack(picked.sort_values("id", kind="stable")["vector"].to_list())
    leaves = max(1, min(MOST_LEAVES, total // leaf_rows))
    tree = fit_tree(x, max(1.0, len(x) / leaves))
    visits = calibrated(tree, x, near, recall, CALIBRATION)

    index = stored(in_leaves(rows.select("id", "vector"), tree).withColumn("at", F.monotonically_increasing_id()))
    by_leaf = index.groupBy("leaf", "id").count().groupBy("leaf")
    counts = {r["leaf"]: r for r in by_leaf.agg(F.sum("count").alias("rows"), F.count("id").alias("ids")).collect()}
    sizes = [counts[i]["rows"] if i in counts else 0 for i in range(tree.leaves)]
    distinct = [counts[i]["ids"] if i in counts else 0 for i in range(tree.leaves)]
    asked = rows.filter("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    asked = stored(with_visits(asked, tree, distinct, visits, near))
    first = F.slice("leaves", 1, FIRST)
    rest = F.slice("leaves", FIRST + 1, F.greatest(F.size("leaves"), F.lit(1)))
    start = asked.select("id", "vector", F.lit(float("inf")).alias("bound"), first.alias("leaves"))
    near_ones = stored(visited(start, index, sizes, near))
    bounds = top(near_ones, near).groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count(F.lit(1)) >= near, F.max("score")).alias("bound")
    )
    after = asked.join(bounds, "id", "left").select(
        "id", "vector", F.coalesce("bound", F.lit(float("inf"))).alias("bound"), rest.alias("leaves")
    )
    found = stored(top(near_ones.unionByName(visited(stored(after), index, sizes, near)), near))
    # Ids with rows in many leaves can fill a query's leaves: such a query visits all leaves.
    others = index.select("id").distinct().count() - 1
    have = found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    short = asked.join(have, "id", "left").filter(F.coalesce("n", F.lit(0)) < min(near, others))
    if not short.isEmpty():
        everywhere = short.select(
            "id", "vector", F.lit(float("inf")).alias("bound"),
            F.array(*map(F.lit, range(tree.leaves))).cast("array<int>").alias("leaves"),
        )
        found = top(found.drop("rank").unionByName(visited(stored(everywhere), index, sizes, near)), near)
    return found.select("query_id", "rank", "vec_id", "score")
