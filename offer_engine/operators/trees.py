"""Random regression forests that grow in the executors.

The trees are those of Spark ML's regressor with its defaults: Poisson bootstrap of all rows, at most
32 bins a feature, a third of the features drawn anew for each node, the split of least variance, leaves of
one row or more. A row is cut to one byte a feature and its label, and stored in blocks. One task grows
one tree: it reads the blocks, draws each row's weight from the seed, the tree and the block, and keeps every
row's node beside it. The driver gets finished trees only.

A task holds at most `task_rows` rows. While a node has more, it is split by a pass over the blocks that
holds histograms and no rows; then the tree's open nodes are dealt to tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offer_engine.sources.shipped import ship
from offer_engine.sources.tables import scratch, shared_folder, store

BINS = 32
#: Rows a task holds while it grows: about 50 bytes each.
TASK_ROWS = 3_000_000
#: Rows taken at once, so that what is worked out for them stays in the processor's cache, and the most where
#: there are many histograms; rows whose values are summed up at once.
CACHED = 65_536
CHUNK = 500_000
SUMMED = 250_000
#: Points that stand for a feature's values in one summary.
POINTS = 320
#: Gains below this share of a node's sum of squares are rounding.
ROUNDING = 1e-11

TREE = "tree int, root int, feature binary, bin binary, left binary, value binary"
SPLIT = (
    "tree int, node int, found boolean, feature int, bin int, left_rows long, right_rows long, "
    "value double, left_value double, right_value double"
)


# Bins and blocks.


def _matrix(values: pa.Array) -> np.ndarray:
    """The rows of a list column of equally long lists."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if values.null_count or np.isnan(flat).any():
        raise ValueError("features must not be null or NaN")
    return flat.reshape(len(values), -1)


def _summary(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts; beyond POINTS, that many stretches of equal counts."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= POINTS:
        return found, counts
    ends = np.cumsum(counts)
    stretch = (ends - 1) * POINTS // ends[-1]
    last = np.flatnonzero(np.r_[stretch[1:] != stretch[:-1], True])
    return found[last], np.diff(np.r_[0, ends[last]])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, part = [], TaskContext.get().partitionId()

    def told(number: int) -> pa.RecordBatch:
        columns = np.concatenate(held).T
        made = [_summary(column) for column in columns]
        return pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(range(len(made)), pa.int32()),
                "place": pa.array([part << 32 | number] * len(made), pa.int64()),
                "points": pa.array([v.tobytes() for v, _ in made], pa.binary()),
                "counts": pa.array([c.astype(np.int64).tobytes() for _, c in made], pa.binary()),
            }
        )

    number = 0
    for batch in batches:
        if batch.num_rows:
            held.append(_matrix(batch.column(0)))
        if sum(map(len, held)) >= SUMMED:
            yield told(number)
            held.clear()
            number += 1
    if held:
        yield told(number)


def thresholds(points: np.ndarray, counts: np.ndarray, bins: int = BINS) -> list[float]:
    """Cuts between values, as Spark ML places them: all of them if they fit, else by equal counts."""
    found, place = np.unique(points, return_inverse=True)
    sizes = np.bincount(place, counts, len(found))
    if len(found) <= bins:
        return ((found[:-1] + found[1:]) / 2).tolist()
    stride = sizes.sum() / bins
    target, so_far, cuts = stride, sizes[0], []
    for i in range(1, len(found)):
        before, so_far = so_far, so_far + sizes[i]
        if abs(before - target) < abs(so_far - target):
            cuts.append(float((found[i - 1] + found[i]) / 2))
            target += stride
    return cuts[: bins - 1]


def _merged(group: pa.Table) -> pa.Table:
    group = group.sort_by("place")  # the same order in every run
    points = np.frombuffer(b"".join(group["points"].to_pylist()), np.float64)
    counts = np.frombuffer(b"".join(group["counts"].to_pylist()), np.int64)
    return pa.table(
        {
            "feature": group["feature"].slice(0, 1),
            "cuts": pa.array([thresholds(points, counts)], pa.list_(pa.float64())),
        }
    )


def _cuts(rows: DataFrame) -> list[np.ndarray]:
    """The thresholds of each feature, from all rows."""
    kind = "feature int, place long, points binary, counts binary"
    summaries = rows.select("x").mapInArrow(_summaries, kind)
    merged = summaries.groupBy("feature").applyInArrow(_merged, "feature int, cuts array<double>")
    return [np.array(r["cuts"], np.float64) for r in merged.orderBy("feature").collect()]


def _binned(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """A byte for each value: how many thresholds are below it."""
    out = np.empty(values.shape, np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.searchsorted(c, values[:, f], side="left")
    return out


def _blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                y = batch.column(1)
                label = y.to_numpy(zero_copy_only=False)
                if y.null_count or np.isnan(label).any():
                    raise ValueError("labels must not be null or NaN")
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([part << 32 | number], pa.int64()),
                        "n": pa.array([batch.num_rows], pa.int64()),
                        "total": pa.array([float(label.sum())], pa.float64()),
                        "x": pa.array([_binned(_matrix(batch.column(0)), cuts).tobytes()], pa.binary()),
                        "y": pa.array([label.astype(np.float64).tobytes()], pa.binary()),
                    }
                )
                number += 1

    return rows.mapInArrow(work, "block long, n long, total double, x binary, y binary")


# Growth of one tree.


def _best(c: np.ndarray, s: np.ndarray, sw: np.ndarray, sy: np.ndarray) -> tuple:
    """Score, bin, and weight and sum on the left, of each node's best cut of one feature."""
    left, below = np.cumsum(c, axis=1)[:, :-1], np.cumsum(s, axis=1)[:, :-1]
    right, above = sw[:, None] - left, sy[:, None] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        score = below * below / left + above * above / right
    score[(left <= 0) | (right <= 0)] = -np.inf
    at = score.argmax(axis=1)
    row = np.arange(len(at))
    return score[row, at], at, left[row, at], below[row, at]


def _drawn(rng: np.random.Generator, nodes: int, features: int, few: int) -> np.ndarray:
    """The features that each node may be split by."""
    if few >= features:
        return np.tile(np.arange(features), (nodes, 1))
    return np.argpartition(rng.random((nodes, features)), few, axis=1)[:, :few]


def grown(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, few: int, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A tree over rows of bins, labels and weights: feature, bin, left child and values of leaves.

    The right child follows the left one. A leaf has ~i for its left child, i the place of its value. Rows with
    a bin above the node's go right.
    """
    features = x.shape[1]
    cells = x.reshape(-1)
    centre = float(np.average(y, weights=w))  # sums of squares lose less around the mean
    if not np.isfinite(centre):
        return np.zeros(1, np.uint8), np.zeros(1, np.uint8), np.array([-1], np.int32), np.array([centre])
    z = y - centre
    at = np.arange(len(y), dtype=np.int64) * features
    w = w.astype(np.float32)  # whole numbers
    node = np.zeros(len(y), np.int64)
    weight, total = np.array([float(w.sum(dtype=np.float64))]), np.array([float(np.dot(w, z))])
    names = np.zeros(1, np.int64)
    feature, cut, left = [np.zeros(1, np.uint8)], [np.zeros(1, np.uint8)], [np.full(1, -1, np.int32)]
    mean, made = [total / weight], 1
    for _ in range(depth):
        k = len(names)
        squares = np.zeros(k)
        for a in range(0, len(z), CACHED):
            part = z[a : a + CACHED]
            squares += np.bincount(node[a : a + CACHED], part * part * w[a : a + CACHED], k)
        mixed = squares - total * total / weight > ROUNDING * squares
        if not mixed.all():
            node, at, w, z = _kept(mixed, node, at, w, z)
            names, weight, total, squares = names[mixed], weight[mixed], total[mixed], squares[mixed]
            k = len(names)
        if not k:
            break
        drawn = np.ascontiguousarray(_drawn(rng, k, features, few).T)
        sums = np.zeros((2, len(drawn), k * BINS))
        step = min(CHUNK, max(CACHED, 4 * k * BINS))
        for a in range(0, len(z), step):
            n, v, cell = node[a : a + step], w[a : a + step].astype(np.float64), at[a : a + step]
            vz, first = v * z[a : a + step], n * BINS
            for j, of_node in enumerate(drawn):
                key = of_node.take(n)
                key += cell
                key = first + cells.take(key)
                sums[0, j] += np.bincount(key, v, k * BINS)
                sums[1, j] += np.bincount(key, vz, k * BINS)
        best = np.full(k, -np.inf)
        chosen, place, near, below = (np.zeros(k, kind) for kind in (np.int64, np.int64, float, float))
        for of_node, c, s in zip(drawn, *sums):
            score, bin_, lw, ls = _best(c.reshape(k, BINS), s.reshape(k, BINS), weight, total)
            better = score > best
            best = np.where(better, score, best)
            chosen[better], place[better] = of_node[better], bin_[better]
            near[better], below[better] = lw[better], ls[better]
        with np.errstate(invalid="ignore"):
            split = best - total * total / weight > ROUNDING * squares
        if not split.any():
            break
        chosen, place = chosen[split], place[split]
        children = made + 2 * np.arange(len(chosen))
        parents = names[split]
        # Nodes are told by number; what is known of a parent is set when its children are made.
        feature.append((parents, chosen)), cut.append((parents, place)), left.append((parents, children))
        weight = np.stack([near[split], weight[split] - near[split]], 1).reshape(-1)
        total = np.stack([below[split], total[split] - below[split]], 1).reshape(-1)
        names = np.stack([children, children + 1], 1).reshape(-1)
        mean.append(total / weight)
        made += len(names)
        node, at, w, z = _kept(split, node, at, w, z)
        for a in range(0, len(z), CACHED):
            n = node[a : a + CACHED]
            right = cells.take(at[a : a + CACHED] + chosen.take(n)) > place.take(n)
            node[a : a + CACHED] = 2 * n + right
    f, b, l = np.zeros(made, np.uint8), np.zeros(made, np.uint8), np.full(made, -1, np.int32)
    for out, told in ((f, feature), (b, cut), (l, left)):
        for parents, values in told[1:]:
            out[parents] = values
    leaf = l < 0
    l[leaf] = ~np.arange(int(leaf.sum()), dtype=np.int32)
    return f, b, l, centre + np.concatenate(mean)[leaf]


def _kept(nodes: np.ndarray, node: np.ndarray, at: np.ndarray, w: np.ndarray, z: np.ndarray) -> tuple:
    """The rows of the nodes marked, with the nodes numbered anew."""
    if nodes.all():
        return node, at, w, z
    stays = nodes.take(node)
    number = np.cumsum(nodes) - 1
    return number.take(node[stays]), at[stays], w[stays], z[stays]


def reached(
    cells: np.ndarray, features: int, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, root: int, depth: int
) -> np.ndarray:
    """The leaf that each row of bins comes to."""
    at = np.arange(0, len(cells), features, dtype=np.int64)
    node = np.full(len(at), root, np.int64)
    for _ in range(depth):
        down = left.take(node)
        inner = down >= 0
        if not inner.any():
            break
        right = cells.take(at + feature.take(node)) > cut.take(node)
        node = np.where(inner, down + right, node)
    return node


class _Top:
    """The upper part of a tree whose nodes hold too many rows for one task; one open root at first."""

    def __init__(self, rows: int, mean: float) -> None:
        # A bootstrap of very few rows may take none; the tree is a leaf then, with the mean of all.
        self.feature, self.cut, self.left, self.value = [0], [0], [-1], [mean]
        self.depth, self.rows, self.open = [0], [rows], {0}

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature, np.uint8), np.array(self.cut, np.uint8), np.array(self.left, np.int32)

    def large(self, task_rows: int, max_depth: int) -> list[int]:
        return sorted(n for n in self.open if self.rows[n] > task_rows and self.depth[n] < max_depth)

    def split(self, r) -> None:
        n = r["node"]
        self.open.discard(n)
        self.value[n] = r["value"]
        if not r["found"]:
            return
        self.feature[n], self.cut[n], self.left[n] = r["feature"], r["bin"], len(self.left)
        for rows, value in ((r["left_rows"], r["left_value"]), (r["right_rows"], r["right_value"])):
            self.open.add(len(self.left))
            self.feature.append(0), self.cut.append(0), self.left.append(-1)
            self.value.append(value), self.rows.append(rows), self.depth.append(self.depth[n] + 1)

    def dealt(self, task_rows: int) -> list[list[int]]:
        """The open nodes in groups of task_rows rows at most, or of one node."""
        groups, size = [], 0
        for n in sorted(self.open):
            if not groups or size + self.rows[n] > task_rows:
                groups.append([])
                size = 0
            groups[-1].append(n)
            size += self.rows[n]
        return groups

    def whole(self, grown: dict[int, tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The tree with what grew below its open nodes."""
        feature, cut, left = ([a] for a in self.arrays())
        made, values = len(self.left), []
        for n in range(made):
            if self.left[n] >= 0:
                continue
            f, b, l, v = grown.get(n) or (*(np.zeros(1, np.uint8),) * 2, np.array([-1], np.int32), np.array([self.value[n]]))
            l = np.where(l >= 0, l + (made - 1), l - sum(map(len, values))).astype(np.int32)
            feature[0][n], cut[0][n], left[0][n] = f[0], b[0], l[0]
            feature.append(f[1:]), cut.append(b[1:]), left.append(l[1:])
            made += len(f) - 1
            values.append(v)
        return tuple(np.concatenate(a) for a in (feature, cut, left, values))


def _for_each(blocks: DataFrame, tasks: int) -> DataFrame:
    """Every task's number with every block: a task reads the blocks itself, so nothing is shuffled."""
    numbers = blocks.sparkSession.range(0, tasks, 1, tasks).withColumnRenamed("id", "task")
    return blocks.coalesce(1).hint("shuffle_replicate_nl").crossJoin(numbers).select("task", "block", "x", "y")


def _rows_of(batches: Iterator[pa.RecordBatch], features: int, seed: int, tree_of: Sequence[int]):
    """task, block, bins, labels and weights of the rows that a tree's bootstrap takes, block by block."""
    for batch in batches:
        for task, block, x, y in zip(*(batch.column(i) for i in range(4))):
            task, block = task.as_py(), block.as_py()
            bins = np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, features)
            labels = np.frombuffer(y.as_buffer(), np.float64)
            weights = np.random.default_rng([seed, tree_of[task], block]).poisson(1.0, len(labels))
            taken = weights > 0
            yield task, block, bins[taken], labels[taken], weights[taken].astype(np.uint8)


def _splits(blocks: DataFrame, tops: list[_Top], large: dict[int, list[int]], features: int, few: int, max_depth: int, seed: int) -> list:
    """The best split of each large node, from histograms alone."""
    trees = sorted(large)
    upper = [tops[t].arrays() for t in trees]
    open_ = [large[t] for t in trees]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for task, _, x, y, w in _rows_of(batches, features, seed, trees):
            nodes = open_[task]
            if sums is None:
                drawn = np.concatenate(
                    [_drawn(np.random.default_rng([seed, trees[task], n, 1]), 1, features, few) for n in nodes]
                )
                sums = [np.zeros((few, len(nodes) * BINS)) for _ in range(3)]
                squares, mine = np.zeros(len(nodes)), task
                number = np.full(len(upper[task][0]), -1)
                number[nodes] = np.arange(len(nodes))
            node = number[reached(x.reshape(-1), features, *upper[task], 0, max_depth)]
            x, y, w, node = x[node >= 0], y[node >= 0], w[node >= 0].astype(np.float64), node[node >= 0]
            squares += np.bincount(node, w * y * y, len(nodes))
            for j in range(few):
                key = node * BINS + x[np.arange(len(x)), drawn[node, j]]
                for out, v in zip(sums, (w, w * y, None)):
                    out[j] += np.bincount(key, v, len(nodes) * BINS)
        if sums is None:
            return
        c, s, r = (a.reshape(few, len(open_[mine]), BINS) for a in sums)
        sw, sy = c[0].sum(axis=1), s[0].sum(axis=1)
        lines = []
        for i, n in enumerate(open_[mine]):
            one = slice(i, i + 1)
            tried = [_best(c[j, one], s[j, one], sw[one], sy[one]) for j in range(few)]
            j = int(np.argmax([t[0][0] for t in tried]))
            score, bin_, lw, ls = (t[0] for t in tried[j])
            found = bool(score - sy[i] * sy[i] / sw[i] > ROUNDING * squares[i])
            left_rows = int(r[j, i, : bin_ + 1].sum())
            lines.append(
                (trees[mine], n, found, int(drawn[i, j]), int(bin_), left_rows, int(r[j, i].sum()) - left_rows,
                 sy[i] / sw[i], ls / lw if found else 0.0, (sy[i] - ls) / (sw[i] - lw) if found else 0.0)
            )
        names = [c.split()[0] for c in SPLIT.split(", ")]
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in zip(names, zip(*lines))}).cast(_arrow(SPLIT))

    # Sums of doubles depend on the order of the blocks.
    ordered = blocks.coalesce(1).sortWithinPartitions("block")
    return _for_each(ordered, len(trees)).mapInArrow(work, SPLIT).collect()


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def _grow(blocks: DataFrame, tops: list[_Top], features: int, few: int, max_depth: int, seed: int, task_rows: int) -> list[tuple]:
    """The whole trees: a task for each group of a tree's open nodes."""
    tasks = [(t, group) for t, top in enumerate(tops) for group in top.dealt(task_rows)]
    tree_of = [t for t, _ in tasks]
    upper = {t: tops[t].arrays() for t in set(tree_of) if len(tops[t].left) > 1}
    depth_of = [{n: tops[t].depth[n] for n in group} for t, group in tasks]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, task = {}, None
        for task, block, x, y, w in _rows_of(batches, features, seed, tree_of):
            node = np.zeros(len(y), np.int32)
            if top := upper.get(tree_of[task]):
                node = reached(x.reshape(-1), features, *top, 0, max_depth).astype(np.int32)
                mine = np.isin(node, list(depth_of[task]))
                x, y, w, node = x[mine], y[mine], w[mine], node[mine]
            held[block] = x, y, w, node
        if task is None:
            return
        parts = [list(p) for p in zip(*(held.pop(block) for block in sorted(held)))]  # files come in any order
        node, w, y, x = (np.concatenate(parts.pop()) for _ in range(4))
        lines = []
        for n, depth in depth_of[task].items():
            mine = node == n if len(depth_of[task]) > 1 else slice(None)
            rng = np.random.default_rng([seed, tree_of[task], n])
            if not len(y[mine]):
                continue
            tree = grown(x[mine], y[mine], w[mine], max_depth - depth, few, rng)
            lines.append((tree_of[task], n, *(a.tobytes() for a in tree)))
        names = _arrow(TREE).names
        if lines:
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in zip(names, zip(*lines))}).cast(_arrow(TREE))

    found = _for_each(blocks, len(tasks)).mapInArrow(work, TREE).toArrow()
    below: list[dict[int, tuple]] = [{} for _ in tops]
    for tree, root, f, b, l, v in zip(*(found.column(i) for i in range(6))):
        below[tree.as_py()][root.as_py()] = (
            np.frombuffer(f.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8),
            np.frombuffer(l.as_buffer(), np.int32), np.frombuffer(v.as_buffer(), np.float64),
        )
    return [top.whole(grown) for top, grown in zip(tops, below)]


def fit(
    train: DataFrame, label: str, num_trees: int, max_depth: int, seed: int, task_rows: int = TASK_ROWS
) -> Forest:
    """A forest on the features column. train is read twice, and stored as blocks of bins."""
    spark, seed = train.sparkSession, seed % 2**32
    ship(spark)
    rows = train.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))
    with scratch():
        cuts = _cuts(rows)
        if not cuts:
            raise ValueError("a forest needs rows")
        features = len(cuts)
        few = features if num_trees == 1 else -(-features // 3)
        blocks = store(_blocks(rows, cuts), shared_folder(spark))
        n, mean = blocks.agg(F.sum("n"), F.sum("total") / F.sum("n")).first()
        tops = [_Top(int(0.64 * n), mean) for _ in range(num_trees)]  # a bootstrap takes 63 % of the rows
        while large := {t: nodes for t, top in enumerate(tops) if (nodes := top.large(task_rows, max_depth))}:
            for r in _splits(blocks, tops, large, features, few, max_depth, seed):
                tops[r["tree"]].split(r)
        trees = _grow(blocks, tops, features, few, max_depth, seed, task_rows)
    return Forest(f"RandomForestRegressor_{uuid.uuid4().hex[:12]}", cuts, trees, max_depth)


# The model.


class Forest:
    """Trees as arrays, at most 10 bytes for a node, with the part of Spark ML's model that jobs use.

    Their size is bounded by the number of trees and their depth. Executors get them once, by broadcast."""

    def __init__(self, uid: str, cuts: Sequence[np.ndarray], trees: list[tuple], max_depth: int) -> None:
        self.uid, self.max_depth, self._prediction, self._sent = uid, max_depth, "prediction", {}
        nodes, values = [len(t[0]) for t in trees], [len(t[3]) for t in trees]
        roots, first = np.r_[0, np.cumsum(nodes)], np.r_[0, np.cumsum(values)]
        self._data = {
            "cuts": [np.asarray(c, np.float64) for c in cuts],
            "roots": roots,
            "first": first,
            "depth": max_depth,
            **{k: np.concatenate([t[i] for t in trees]) for i, k in ((0, "feature"), (1, "cut"), (3, "value"))},
            "left": np.concatenate(
                [np.where(t[2] >= 0, t[2] + r, t[2] - v).astype(np.int32) for t, r, v in zip(trees, roots, first)]
            ),
        }

    @property
    def getNumTrees(self) -> int:  # noqa: N802  as in Spark ML
        return len(self._data["roots"]) - 1

    @property
    def numFeatures(self) -> int:  # noqa: N802
        return len(self._data["cuts"])

    @property
    def totalNumNodes(self) -> int:  # noqa: N802
        return len(self._data["left"])

    def getCacheNodeIds(self) -> bool:  # noqa: N802
        """Each row's node is kept beside it while a tree grows."""
        return True

    def getPredictionCol(self) -> str:  # noqa: N802
        return self._prediction

    def setPredictionCol(self, name: str) -> Forest:  # noqa: N802
        self._prediction = name
        return self

    def copy(self) -> Forest:
        other = object.__new__(Forest)
        other.__dict__.update(self.__dict__)  # the same arrays and the same broadcast
        return other

    def _broadcast(self, spark: SparkSession):
        ship(spark)
        context = spark.sparkContext
        if context.applicationId not in self._sent:
            self._sent[context.applicationId] = context.broadcast(self._data)
        return self._sent[context.applicationId]

    def transform(self, df: DataFrame) -> DataFrame:
        """df with the mean of the trees' values."""
        sent = self._broadcast(df.sparkSession)

        def mean(x: pa.Array) -> pa.Array:
            return pa.array(predicted(sent.value, _matrix(x)), pa.float64())

        mean.__annotations__ = {"x": pa.Array, "return": pa.Array}
        return df.withColumn(self._prediction, F.arrow_udf(mean, "double")(vector_to_array("features")))

    def tree(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return _tree(self._data, i)

    def save(self, path: str, spark: SparkSession) -> None:
        """One row for each tree, and one of what they share, written by the executors."""
        sent, trees = self._broadcast(spark), self.getNumTrees
        shared = json.dumps({"uid": self.uid, "max_depth": self.max_depth, "cuts": [c.tolist() for c in self._data["cuts"]]})

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    line = (i, 0, *(a.tobytes() for a in _tree(sent.value, i)), shared)
                    kind = _arrow(f"{TREE}, shared binary")
                    yield pa.RecordBatch.from_pydict({k: pa.array([v]) for k, v in zip(kind.names, line)}).cast(kind)

        written = spark.range(0, trees, 1, min(trees, 8)).mapInArrow(work, f"{TREE}, shared binary")
        written.write.parquet(f"{path}/{FOLDER}")

    @staticmethod
    def load(path: str, spark: SparkSession) -> Forest:
        found = spark.read.schema(f"{TREE}, shared binary").parquet(f"{path}/{FOLDER}").toArrow().sort_by("tree")
        shared = json.loads(found["shared"][0].as_py())
        kinds = (np.uint8, np.uint8, np.int32, np.float64)
        trees = [
            tuple(np.frombuffer(found[k][i].as_buffer(), kind) for k, kind in zip(("feature", "bin", "left", "value"), kinds))
            for i in range(found.num_rows)
        ]
        return Forest(shared["uid"], [np.array(c, np.float64) for c in shared["cuts"]], trees, shared["max_depth"])

    @property
    def toDebugString(self) -> str:  # noqa: N802
        lines = [f"RandomForestRegressionModel: uid={self.uid}, numTrees={self.getNumTrees}, numFeatures={self.numFeatures}"]
        for i in range(self.getNumTrees):
            lines.append(f"  Tree {i} (weight 1.0):")
            f, b, l, v = self.tree(i)
            todo = [(0, 2, "")]
            while todo:
                n, deep, sign = todo.pop()
                indent = " " * 2 * deep
                if l[n] < 0:
                    lines.append(f"{indent}{sign}Predict: {float(v[~l[n]])!r}")
                    continue
                test = f"feature {f[n]} <= {float(self._data['cuts'][f[n]][b[n]])!r}"
                lines.append(f"{indent}{sign}If ({test})")
                todo += [(int(l[n]) + 1, deep + 1, "Else "), (int(l[n]), deep + 1, "")]
        return "\n".join(lines) + "\n"


#: The folder of a saved forest, which tells it from one that Spark ML saved.
FOLDER = "forest"


def _tree(data: dict, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree of a forest, its nodes and values numbered from 0."""
    nodes, values = slice(*data["roots"][i : i + 2]), slice(*data["first"][i : i + 2])
    left = data["left"][nodes]
    left = np.where(left >= 0, left - nodes.start, left + values.start).astype(np.int32)
    return data["feature"][nodes], data["cut"][nodes], left, data["value"][values]


def predicted(data: dict, rows: np.ndarray) -> np.ndarray:
    """The mean of the trees' values for each row."""
    features = len(data["cuts"])
    cells = _binned(rows.reshape(-1, features), data["cuts"]).reshape(-1)
    total = np.zeros(len(cells) // features)
    for root in data["roots"][:-1]:
        leaf = reached(cells, features, data["feature"], data["cut"], data["left"], root, data["depth"])
        total += data["value"].take(~data["left"].take(leaf))
    return total / (len(data["roots"]) - 1)
