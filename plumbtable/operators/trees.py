"""Regression trees on binned features with the settings Spark's own trees lack, as Spark's own models.

Features are cut into bins once and rows keep their bin numbers. A level of a tree, or of many trees of a forest, is
one aggregation: every task adds gradients, hessians and row counts by tree node, feature and bin, the sums are
combined, and a window over the bins finds each node's best cut. Only one row per node returns to the driver.

* boosting: second order, ``gain = T(Gl)^2/(Hl+lambda) + T(Gr)^2/(Hr+lambda) - T(G)^2/(H+lambda)`` where T shrinks by
  ``reg_alpha``; ``min_child_weight`` bounds the hessian; cuts below ``gamma`` are undone from the leaves up; columns
  are drawn per tree, level and node.
* forest: the same sums with lambda 0 are the reduction of squared error. ``max_leaf_nodes`` keeps the cuts that best-first
  growth takes, ``ccp_alpha`` cuts the weakest links; with ``absolute_error`` a leaf predicts the exact median of its rows.

A finished ensemble is written in the layout of Spark's saved models and loaded as one, so it scores in the JVM.
"""

from __future__ import annotations

import heapq
import json
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbtable.session import fresh_path, settle

MAX_BINS = 256
#: Sums a task holds at once; more nodes take several aggregations.
CELLS = 4_000_000
#: Trees of a forest grown side by side, and rounds of boosting between written margins.
SIDE_BY_SIDE = 16
ROUNDS = 10
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Growth:
    """What a tree may become. ``columns`` are the shares drawn per tree, level and node."""

    max_depth: int = 6
    reg_lambda: float = 0.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 0.0
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_leaf_nodes: int | None = None
    ccp_alpha: float = 0.0
    columns: tuple[float, float, float] = (1.0, 1.0, 1.0)
    sample: float = 1.0
    with_replacement: bool = False
    max_bin: int = MAX_BINS


@dataclass
class Node:
    grad: float
    hess: float
    rows: int
    depth: int = 0
    feature: int = -1
    bin: int = -1
    gain: float = 0.0
    left: int = -1
    right: int = -1
    value: float = 0.0


@dataclass
class Tree:
    number: int
    features: list[int]
    nodes: list[Node] = field(default_factory=list)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array([getattr(n, a) for n in self.nodes], np.int32) for a in ("feature", "bin", "left", "right"))

    def leaves(self) -> list[int]:
        """Numbers of the leaves that the root reaches."""
        out, todo = [], [0]
        while todo:
            k = todo.pop()
            node = self.nodes[k]
            if node.left < 0:
                out.append(k)
            else:
                todo += [node.right, node.left]
        return out


def reached(arrays: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The node of each row of ``bins`` in a tree."""
    feature, cut, left, right = arrays
    at = np.zeros(len(bins), np.int32)
    while True:
        inner = np.flatnonzero(left[at] >= 0)
        if not len(inner):
            return at
        here = at[inner]
        at[inner] = np.where(bins[inner, feature[here]] <= cut[here], left[here], right[here])


def sample_weights(rows: np.ndarray, tree: int, seed: int, share: float, with_replacement: bool) -> np.ndarray:
    """How often each row is in a tree's sample, from a hash of its number: the same whoever asks."""
    if share >= 1 and not with_replacement:
        return np.ones(len(rows))
    x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + tree * 7919 + 1) & (2**63 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / 2.0**53
    if not with_replacement:
        return (u < share).astype(float)
    # Poisson draws stand for drawing with replacement.
    chance, total, weights = np.exp(-share), np.exp(-share), np.zeros(len(rows))
    for k in range(1, 12):
        weights += u >= total
        chance *= share / k
        total += chance
    return weights


def _bin_matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width)


def binned(df: DataFrame, features: str, label: str, max_bin: int) -> tuple[DataFrame, list[list[float]]]:
    """``row, label, bins`` as a written table, and each feature's cuts: bin b holds the values up to cut b."""
    rows = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("label"))
    rows = settle(rows, "tree-rows")
    width = rows.select(F.size("x")).first()
    if width is None:
        raise ValueError("no rows to train on")
    shares = F.array(*[F.lit(k / max_bin) for k in range(1, max_bin)])
    cuts = rows.agg(
        F.array(*[F.array_distinct(F.percentile_approx(F.col("x")[k], shares, 10_000)) for k in range(width[0])]).alias("c"),
        F.array(*[F.max(F.col("x")[k]) for k in range(width[0])]).alias("m"),
    ).first()
    edges = [[c for c in own if c < most] for own, most in zip(cuts["c"], cuts["m"])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            bins = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("label"), pa.array([b.tobytes() for b in bins], pa.binary())], ["row", "label", "bins"]
            )

    numbered = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "label", "x")
    return settle(numbered.mapInArrow(cut, "row long, label double, bins binary"), "tree-bins"), edges


def _histograms(trees: list[tuple], slots: dict, width: int, bins: int, growth: Growth, seed: int):
    """Sums by slot, feature and bin of the rows of a task; ``slots`` numbers the open nodes ``(tree, node)``."""
    size = len(slots) * bins

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, width, size))
        tables = []
        for number, arrays, features in trees:
            table = np.full(len(arrays[0]), -1, np.int64)
            for (tree, node), slot in slots.items():
                if tree == number:
                    table[node] = slot
            tables.append((number, arrays, features, table))
        for batch in batches:
            matrix = _bin_matrix(batch.column("bins"), width)
            rows, grad = batch.column("row").to_numpy(), batch.column("grad").to_numpy()
            for number, arrays, features, table in tables:
                weights = sample_weights(rows, number, seed, growth.sample, growth.with_replacement)
                slot = table[reached(arrays, matrix)]
                some = np.flatnonzero((slot >= 0) & (weights > 0))
                w, g, first = weights[some], grad[some] * weights[some], slot[some] * bins
                for f in features:
                    cell = first + matrix[some, f]
                    sums[0, f] += np.bincount(cell, g, size)
                    sums[1, f] += np.bincount(cell, w, size)
                    sums[2, f] += np.bincount(cell, minlength=size)
        feature, held = np.nonzero(sums[2])
        slot, place = np.divmod(held, bins)
        columns = [pa.array(c.astype(np.int32)) for c in (slot, feature, place)] + [pa.array(s[feature, held]) for s in sums]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "feature", "bin", "grad", "hess", "rows"])

    return add


def _best_cuts(sums: DataFrame, growth: Growth, allowed: DataFrame | None) -> list:
    """The best cut of each slot: one row per open node."""
    cells = sums.groupBy("slot", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("grad", "hess", "rows")])
    along = Window.partitionBy("slot", "feature").orderBy("bin")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("slot", "feature")
    names = ("grad", "hess", "rows")
    cells = cells.select(
        "slot", "feature", "bin", *[F.sum(c).over(upto).alias(f"left_{c}") for c in names], *[F.sum(c).over(whole).alias(f"all_{c}") for c in names]
    )
    cells = cells.withColumns({f"right_{c}": F.col(f"all_{c}") - F.col(f"left_{c}") for c in names})
    alpha, lam = float(growth.reg_alpha), float(growth.reg_lambda)

    def score(side):
        g = F.greatest(F.abs(f"{side}_grad") - alpha, F.lit(0.0))
        return F.coalesce(F.try_divide(g * g, F.col(f"{side}_hess") + lam), F.lit(0.0))

    least_rows, least_hess = growth.min_samples_leaf, float(growth.min_child_weight)
    fit = F.lit(True)
    for side in ("left", "right"):
        fit &= (F.col(f"{side}_rows") >= max(1, least_rows)) & (F.col(f"{side}_hess") >= least_hess)
    fit &= F.col("all_rows") >= growth.min_samples_split
    cells = cells.where(fit).withColumn("gain", score("left") + score("right") - score("all"))
    if allowed is not None:
        cells = cells.join(F.broadcast(allowed), ["slot", "feature"], "left_semi")
    # Equal gains go to the first feature and bin.
    order = F.struct("gain", -F.col("feature"), -F.col("bin"))
    kept = F.struct("feature", "bin", "gain", *[f"{s}_{c}" for s in ("left", "right") for c in names])
    return cells.where(F.col("gain") > LEAST_GAIN).groupBy("slot").agg(F.max_by(kept, order).alias("cut")).select("slot", "cut.*").collect()


def _share(items: list[int], share: float, draw: random.Random) -> list[int]:
    return items if share >= 1 else sorted(draw.sample(items, max(1, int(len(items) * share))))


def taken_first(tree: Tree, most: int) -> set[int]:
    """Nodes that growth by the largest gain cuts until ``most`` leaves are there."""
    queue, taken = [(-tree.nodes[0].gain, 0)] if tree.nodes[0].left >= 0 else [], set()
    while queue and len(taken) < most - 1:
        _, k = heapq.heappop(queue)
        taken.add(k)
        for child in (tree.nodes[k].left, tree.nodes[k].right):
            if tree.nodes[child].left >= 0:
                heapq.heappush(queue, (-tree.nodes[child].gain, child))
    return taken


def _undo(node: Node) -> None:
    node.feature = node.bin = node.left = node.right = -1


def _weakest_link(tree: Tree, total: float) -> tuple[float, int, int]:
    """``alpha, node, leaves after it is cut`` of the cut that is worth least per leaf.

    A cut's gain is what it takes off the squared error, so a subtree saves the gains of its cuts.
    """
    worst = None
    stack, saved, leaves = [(0, False)], {}, {}
    while stack:
        k, done = stack.pop()
        node = tree.nodes[k]
        if node.left < 0:
            saved[k], leaves[k] = 0.0, 1
        elif not done:
            stack += [(k, True), (node.left, False), (node.right, False)]
        else:
            saved[k] = node.gain + saved[node.left] + saved[node.right]
            leaves[k] = leaves[node.left] + leaves[node.right]
            alpha = saved[k] / total / (leaves[k] - 1)
            if worst is None or (alpha, k) < worst:
                worst = (alpha, k)
    return *worst, leaves[0] - leaves[worst[1]] + 1


def cut_weakest_links(tree: Tree, most: float) -> list[tuple[float, int]]:
    """Cut the weakest link as long as its alpha is at most ``most``: ``(alpha, leaves left)`` of each step."""
    steps = []
    while tree.nodes[0].left >= 0:
        alpha, node, leaves = _weakest_link(tree, tree.nodes[0].hess)
        if alpha > most:
            break
        _undo(tree.nodes[node])
        steps.append((alpha, leaves))
    return steps


def prune(tree: Tree, growth: Growth) -> None:
    """Undo the cuts that ``max_leaf_nodes``, ``gamma`` and ``ccp_alpha`` forbid."""
    if growth.max_leaf_nodes:
        taken = taken_first(tree, growth.max_leaf_nodes)
        for k, node in enumerate(tree.nodes):
            if node.left >= 0 and k not in taken:
                _undo(node)
    for node in reversed(tree.nodes):  # children have larger numbers
        if node.left >= 0 and node.gain < growth.gamma and all(tree.nodes[c].left < 0 for c in (node.left, node.right)):
            _undo(node)
    if growth.ccp_alpha > 0:
        cut_weakest_links(tree, growth.ccp_alpha)


def grow(data: DataFrame, trees: list[Tree], width: int, bins: int, growth: Growth, seed: int) -> None:
    """Grow ``trees``, which hold their root, level by level on ``data (row, grad, bins)``, then prune them."""
    spark = data.sparkSession
    most = max(1, CELLS // (width * bins))
    draws = {t.number: random.Random(f"{seed}-{t.number}") for t in trees}
    for depth in range(growth.max_depth):
        level = {t.number: _share(t.features, growth.columns[1], draws[t.number]) for t in trees}
        frontier = []
        for t in trees:
            taken = taken_first(t, growth.max_leaf_nodes) if growth.max_leaf_nodes else None
            parents = {c: k for k, n in enumerate(t.nodes) if n.left >= 0 for c in (n.left, n.right)}
            for k, n in enumerate(t.nodes):
                reachable = k == 0 or taken is None or parents[k] in taken
                if n.depth == depth and reachable and n.rows >= max(2, growth.min_samples_split):
                    frontier.append((t, k))
        if not frontier:
            break
        for at in range(0, len(frontier), most):
            part = frontier[at : at + most]
            slots = {(t.number, k): slot for slot, (t, k) in enumerate(part)}
            open_trees = {t.number: (t.number, t.arrays(), level[t.number]) for t, _ in part}
            allowed = None
            if growth.columns[2] < 1:
                rows = [(s, f) for s, (t, _) in enumerate(part) for f in _share(level[t.number], growth.columns[2], draws[t.number])]
                allowed = spark.createDataFrame(rows, "slot int, feature int")
            schema = "slot int, feature int, bin int, grad double, hess double, rows double"
            sums = data.select("row", "grad", "bins").mapInArrow(
                _histograms(list(open_trees.values()), slots, width, bins, growth, seed), schema
            )
            for r in _best_cuts(sums, growth, allowed):
                tree, k = part[r["slot"]]
                node = tree.nodes[k]
                node.feature, node.bin, node.gain = r["feature"], r["bin"], r["gain"]
                node.left = len(tree.nodes)
                node.right = node.left + 1
                for side in ("left", "right"):
                    tree.nodes.append(Node(r[f"{side}_grad"], r[f"{side}_hess"], int(r[f"{side}_rows"]), depth + 1))
    for t in trees:
        prune(t, growth)


def _roots(data: DataFrame, numbers: list[int], growth: Growth, seed: int) -> dict[int, Node]:
    """The sums of each tree's sample."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(numbers), 3))
        for batch in batches:
            rows, grad = batch.column("row").to_numpy(), batch.column("grad").to_numpy()
            for k, number in enumerate(numbers):
                w = sample_weights(rows, number, seed, growth.sample, growth.with_replacement)
                sums[k] += (w @ grad, w.sum(), (w > 0).sum())
        columns = [pa.array(np.array(numbers, np.int32))] + [pa.array(np.ascontiguousarray(sums[:, k])) for k in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["tree", "grad", "hess", "rows"])

    summed = data.select("row", "grad").mapInArrow(add, "tree int, grad double, hess double, rows double").groupBy("tree")
    found = summed.agg(*[F.sum(c).alias(c) for c in ("grad", "hess", "rows")]).collect()
    return {r["tree"]: Node(r["grad"], r["hess"], int(r["rows"])) for r in found}


def leaf_value(node: Node, growth: Growth) -> float:
    shrunk = max(abs(node.grad) - growth.reg_alpha, 0.0)
    return 0.0 if node.hess + growth.reg_lambda == 0 else -np.sign(node.grad) * shrunk / (node.hess + growth.reg_lambda)


def boost(data: DataFrame, width: int, bins: int, growth: Growth, rounds: int, rate: float, seed: int) -> tuple[float, list[Tree]]:
    """Boosted trees for the squared error on ``data (row, label, bins)``: the first prediction and the trees."""
    base = data.agg(F.avg("label")).first()[0]
    state = data.withColumn("margin", F.lit(float(base)))
    trees, held = [], []

    def step(tree: Tree):
        arrays, values = tree.arrays(), np.array([n.value for n in tree.nodes])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                matrix = _bin_matrix(batch.column("bins"), width)
                margin = batch.column("margin").to_numpy() + rate * values[reached(arrays, matrix)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin)], ["row", "label", "bins", "margin"])

        return run

    for number in range(rounds):
        draw = random.Random(f"{seed}+{number}")
        tree = Tree(number, _share(list(range(width)), growth.columns[0], draw))
        work = state.withColumn("grad", F.col("margin") - F.col("label"))
        tree.nodes.append(_roots(work, [number], growth, seed)[number])
        grow(work, [tree], width, bins, growth, seed)
        for node in tree.nodes:
            node.value = float(leaf_value(node, growth))
        trees.append(tree)
        if number + 1 < rounds:
            state = state.mapInArrow(step(tree), "row long, label double, bins binary, margin double")
            if (number + 1) % ROUNDS == 0:
                state = settle(state, "margins")
                for old in held:
                    old.unpersist()
                held = []
            else:
                state = state.persist(StorageLevel.MEMORY_AND_DISK)
                held.append(state)
    for old in held:
        old.unpersist()
    return float(base), trees


def forest(data: DataFrame, width: int, bins: int, growth: Growth, count: int, seed: int, medians: bool) -> list[Tree]:
    """Trees on samples of ``data (row, label, bins)``; leaves predict means, or medians."""
    work = data.withColumn("grad", -F.col("label"))
    out = []
    for at in range(0, count, SIDE_BY_SIDE):
        numbers = list(range(at, min(at + SIDE_BY_SIDE, count)))
        roots = _roots(work, numbers, growth, seed)
        trees = [Tree(n, list(range(width)), [roots[n]]) for n in numbers]
        grow(work, trees, width, bins, growth, seed)
        found = leaf_medians(data, trees, width, growth, seed) if medians else {}
        for t in trees:
            for k, node in enumerate(t.nodes):
                node.value = found.get((t.number, k), float(leaf_value(node, growth)))
        out += trees
    return out


def leaf_medians(data: DataFrame, trees: list[Tree], width: int, growth: Growth, seed: int) -> dict[tuple[int, int], float]:
    """Exact median of the labels of each leaf, rows counted as often as the tree's sample holds them.

    Rows are counted by tree, leaf and label, combined before the shuffle. The counts of a leaf are first summed in
    even parts of the label's range; only the parts that hold the middle are counted by value. One or two values
    per leaf return.
    """
    span = data.agg(F.min("label"), F.max("label")).first()
    low, step = span[0], (span[1] - span[0]) / 4096 or 1.0
    routes = [(t.number, t.arrays()) for t in trees]

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix, rows = _bin_matrix(batch.column("bins"), width), batch.column("row").to_numpy()
            for number, arrays in routes:
                w = sample_weights(rows, number, seed, growth.sample, growth.with_replacement)
                some = np.flatnonzero(w)
                leaf = reached(arrays, matrix[some])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some), number, np.int32)), pa.array(leaf),
                        batch.column("label").take(pa.array(some)), pa.array(w[some].astype(np.int64)),
                    ],
                    ["tree", "leaf", "label", "times"],
                )

    placed = data.select("row", "label", "bins").mapInArrow(leaves, "tree int, leaf int, label double, times long")
    placed = placed.withColumn("part", F.floor((F.col("label") - F.lit(low)) / F.lit(step)))
    keys = ["tree", "leaf"]
    along = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    parts = placed.groupBy(*keys, "part").agg(F.sum("times").alias("times"))
    parts = parts.withColumn("upto", F.sum("times").over(along)).withColumn("n", F.sum("times").over(Window.partitionBy(*keys)))
    before = F.col("upto") - F.col("times")
    # 0-based ranks of the middle: one value, or two for an even count.
    lower, upper = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middle = parts.where((before <= upper) & (F.col("upto") > lower)).select(*keys, "part", before.alias("before"), "n")
    # At most two parts per leaf.
    inside = placed.join(F.broadcast(middle), [*keys, "part"]).groupBy(*keys, "part", "label", "before", "n").agg(F.sum("times").alias("times"))
    within = Window.partitionBy(*keys, "part").orderBy("label").rowsBetween(Window.unboundedPreceding, 0)
    values = inside.withColumn("upto", F.col("before") + F.sum("times").over(within))
    held = lambda rank: (F.col("upto") - F.col("times") <= rank) & (F.col("upto") > rank)
    found = values.groupBy(*keys).agg(F.max(F.when(held(lower), F.col("label"))).alias("a"), F.max(F.when(held(upper), F.col("label"))).alias("b"))
    return {(r["tree"], r["leaf"]): (r["a"] + r["b"]) / 2 for r in found.collect()}


_NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def _node_rows(number: int, tree: Tree, edges: list[list[float]]) -> list[tuple]:
    """Rows of a tree in the layout of a saved model: nodes numbered from the root, left part first."""
    rows: list[tuple] = []
    order: list[int] = []
    todo = [0]
    while todo:
        k = todo.pop()
        order.append(k)
        node = tree.nodes[k]
        if node.left >= 0:
            todo += [node.right, node.left]
    place = {k: n for n, k in enumerate(order)}
    for k in order:
        node = tree.nodes[k]
        inner = node.left >= 0
        split = (node.feature, [edges[node.feature][node.bin]], -1) if inner else (-1, [], -1)
        below = (place[node.left], place[node.right]) if inner else (-1, -1)
        stats = [float(node.hess), 0.0, 0.0]
        rows.append((number, (place[k], float(node.value), 0.0, stats, node.rows, float(node.gain) if inner else -1.0, *below, split)))
    return rows


def as_spark_model(spark, trees: list[Tree], weights: list[float], edges: list[list[float]], boosted: bool, params: dict):
    """The ensemble as Spark's boosted or forest model."""
    from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel

    kind = GBTRegressionModel if boosted else RandomForestRegressionModel
    package = "org.apache.spark.ml.regression."
    path = fresh_path(spark, "trees")
    shown = {"maxDepth": 30, "impurity": "variance", "featuresCol": "features", "labelCol": "label", "predictionCol": "prediction", "leafCol": ""}
    about = {
        "class": package + kind.__name__, "timestamp": 0, "sparkVersion": spark.version, "uid": f"{kind.__name__}_{path[-12:]}",
        "paramMap": {**params, **({"maxIter": max(1, len(trees))} if boosted else {"numTrees": len(trees)})}, "defaultParamMap": shown, "numFeatures": len(edges), "numTrees": len(trees),
    }
    single = {**about, "class": package + "DecisionTreeRegressionModel", "defaultParamMap": shown, "paramMap": {}}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    rows = [r for number, t in enumerate(trees) for r in _node_rows(number, t, edges)]
    spark.createDataFrame(rows, _NODES).write.parquet(f"{path}/data")
    described = [(n, json.dumps({**single, "uid": f"tree_{n}"}), float(w)) for n, w in enumerate(weights)]
    spark.createDataFrame(described, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    return kind.load(path)
