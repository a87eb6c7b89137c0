"""Gradient boosting of two classes by histograms: features in bins, gradient sums by node, best-first leaves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavemill.operators.split import balanced_weights
from wavemill.sources.scratch import written

#: Values fall into bins 0 to 254; null and NaN have a bin of their own.
MISSING = 255
#: Gradients are summed as whole numbers of this unit, so that no order of tasks changes a sum.
UNIT = 2.0**-30
BLOCK_BYTES = 8 << 20
#: Features whose sums travel in one row.
PART = 16


@dataclass
class Tree:
    """Nodes in order of their making: feature (-1 in a leaf), last bin that goes left, whether missing values do, children, value."""

    feature: list[int] = field(default_factory=lambda: [-1])
    last: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, last: int, missing_left: bool) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.last[node], self.missing_left[node], self.left[node], self.right[node] = feature, last, missing_left, at, at + 1
        for _ in range(2):
            for column, empty in ((self.feature, -1), (self.last, 0), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, 0.0)):
                column.append(empty)
        return at, at + 1

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``bins``."""
        feature, last, missing, left, right = (np.array(c) for c in (self.feature, self.last, self.missing_left, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        moving = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(moving):
            node = at[moving]
            own = bins[moving, feature[node]]
            at[moving] = np.where(np.where(own == MISSING, missing[node], own <= last[node]), left[node], right[node])
            moving = moving[feature[at[moving]] >= 0]
        return at


@dataclass
class BoostedTrees:
    """edges[feature]: ascending values, a bin holding what is above the edge before it and not above its own."""

    edges: list[np.ndarray]
    base: float
    trees: list[Tree]

    def raw(self, bins: np.ndarray) -> np.ndarray:
        return self.base + _sum_of(self.trees, bins)


def _sum_of(trees: list[Tree], bins: np.ndarray) -> np.ndarray:
    total = np.zeros(len(bins))
    for tree in trees:
        total += np.array(tree.value)[tree.leaves(bins)]
    return total


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, width)


def _binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    bins = np.empty(values.shape, np.uint8)
    for k, own in enumerate(edges):
        bins[:, k] = np.where(np.isnan(values[:, k]), MISSING, np.searchsorted(own, values[:, k], side="left"))
    return bins


def edges_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Midpoints between distinct values, or, if those are more than ``bins``, between the values at its quantiles."""
    values = np.sort(values[~np.isnan(values)])
    distinct = np.unique(values)
    above = np.arange(1, len(distinct))
    if len(distinct) > bins:
        above = np.searchsorted(distinct, np.unique(values[np.arange(1, bins) * len(values) // bins]))
        above = above[above > 0]
    low, high = distinct[above - 1], distinct[above]
    with np.errstate(invalid="ignore", over="ignore"):
        middle = low / 2 + high / 2
    # a midpoint that rounding or an infinite end moves out of [low, high) is its lower end
    return np.unique(np.where((middle >= low) & (middle < high), middle, low))


def feature_edges(rows: DataFrame, width: int, bins: int = 255, bin_rows: int = 200_000) -> list[np.ndarray]:
    """Edges of the bins of each feature of ``features``, from about ``bin_rows`` rows drawn among all (all, if fewer).

    A batch is turned into one row of values for each feature, so a feature's values meet in one task, ``bin_rows`` numbers;
    the driver gets the edges.
    """
    total = rows.count()
    drawn = rows if total <= bin_rows else rows.sample(False, bin_rows / total, seed=0)

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column(0), width)
            offsets = np.arange(width + 1, dtype=np.int32) * len(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.T.ravel()))], ["feature", "values"])

    def cut(own: pa.Table) -> pa.Table:
        return pa.table({"feature": own["feature"][:1], "edges": pa.array([edges_of(np.asarray(own["values"].combine_chunks().flatten()), bins)], pa.list_(pa.float64()))})

    found = drawn.select("features").mapInArrow(turned, "feature int, values array<double>").groupBy("feature").applyInArrow(cut, "feature int, edges array<double>")
    edges = {row["feature"]: np.array(row["edges"]) for row in found.collect()}
    return [edges.get(k, np.zeros(0)) for k in range(width)]


def _blocks(rows: DataFrame, edges: list[np.ndarray], base: float) -> DataFrame:
    """Rows (y, weight, features) as blocks of bytes: bins, y, weight and raw scores."""
    most = max(1, BLOCK_BYTES // max(1, len(edges)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, most):
                batch = whole.slice(low, most)
                bins = _binned(_matrix(batch.column(2), len(edges)), edges)
                parts = [bins.tobytes(), np.asarray(batch.column(0), np.float64).tobytes(), np.asarray(batch.column(1), np.float64).tobytes(), np.full(len(bins), base).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["bins", "y", "weight", "raw"])

    return rows.select("y", "weight", "features").mapInArrow(pack, "bins binary, y binary, weight binary, raw binary")


def _unpack(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    for bins, *rest in zip(*(c.to_pylist() for c in batch.columns)):
        yield np.frombuffer(bins, np.uint8).reshape(-1, width), *(np.frombuffer(x, np.float64) for x in rest)


def _advanced(blocks: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """The blocks with ``trees`` added to their raw scores."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(raw + _sum_of(trees, bins)).tobytes() for bins, _, _, raw in _unpack(batch, width)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(raw, pa.binary())], batch.schema.names)

    return blocks.mapInArrow(add, blocks.schema)


def _histograms(blocks: DataFrame, trees: list[Tree], tree: Tree, nodes: list[int], width: int) -> dict[int, np.ndarray]:
    """Sums of gradients, of second derivatives, and numbers of rows by feature and bin, for leaves ``nodes`` of the tree at work.

    ``trees`` are those whose values the blocks' raw scores lack. A task adds up all its blocks before it sends a row for each
    node and ``PART`` features.
    """
    cells, parts, size = width * 256, -(-width // PART), PART * 768

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(nodes), 3, cells), np.int64)
        places = np.arange(width) * 256
        for batch in batches:
            for bins, y, weight, raw in _unpack(batch, width):
                chance = 1 / (1 + np.exp(-(raw + _sum_of(trees, bins))))
                first = np.rint(weight * (chance - y) / UNIT)
                second = np.rint(weight * chance * (1 - chance) / UNIT)
                leaf = tree.leaves(bins)
                for k, node in enumerate(nodes):
                    own = np.flatnonzero(leaf == node)
                    # whole numbers below 2^53 in a slice, so its sums of doubles are exact
                    for low in range(0, len(own), 4096):
                        some = own[low : low + 4096]
                        cell = (bins[some] + places).ravel()
                        for m, values in enumerate((first, second)):
                            sums[k, m] += np.bincount(cell, np.repeat(values[some], width), cells).astype(np.int64)
                        sums[k, 2] += np.bincount(cell, minlength=cells)
        table = np.zeros((len(nodes), parts * PART, 3, 256), np.int64)
        table[:, :width] = sums.reshape(len(nodes), 3, width, 256).transpose(0, 2, 1, 3)
        offsets = np.arange(len(nodes) * parts + 1, dtype=np.int32) * size
        keys = [pa.array(np.repeat(np.arange(len(nodes), dtype=np.int32), parts)), pa.array(np.tile(np.arange(parts, dtype=np.int32), len(nodes)))]
        yield pa.RecordBatch.from_arrays([*keys, pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.ravel()))], ["node", "part", "sums"])

    def add(own: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for chunk in own["sums"].chunks:
            total += np.asarray(chunk.flatten()).reshape(-1, size).sum(axis=0)
        return pa.table({"node": own["node"][:1], "part": own["part"][:1], "sums": pa.array([total], pa.list_(pa.int64()))})

    kind = "node int, part int, sums array<bigint>"
    found = blocks.mapInArrow(partial, kind).groupBy("node", "part").applyInArrow(add, kind).toArrow()
    out = np.zeros((len(nodes), parts, PART, 3, 256), np.int64)
    out[np.asarray(found["node"]), np.asarray(found["part"])] = np.asarray(found["sums"].combine_chunks().flatten()).reshape(-1, PART, 3, 256)
    out = out.reshape(len(nodes), -1, 3, 256)[:, :width]
    return {node: out[k] for k, node in enumerate(nodes)}


@dataclass
class Split:
    gain: float
    feature: int
    last: int
    missing_left: bool
    rows_left: int
    rows_right: int


def best_split(sums: np.ndarray, l2: float, leaf_rows: int) -> Split | None:
    """The split of highest gain of a node's histogram (feature, 3, bin), ties to the first feature, then to missing values on
    the right, then to the lowest bin; null if none gains with ``leaf_rows`` rows on both sides. Where a node has no missing
    value they go to the side with more rows."""
    whole, absent = sums[0].sum(axis=-1), sums[:, :, MISSING]
    up_to = sums[:, :, :MISSING].cumsum(axis=-1)
    score = lambda g, h: (g * UNIT) ** 2 / (h * UNIT + l2 + 1e-300)
    left = np.stack([up_to, up_to + absent[:, :, None]], axis=1)
    right = whole[None, None, :, None] - left
    gain = score(left[:, :, 0], left[:, :, 1]) + score(right[:, :, 0], right[:, :, 1]) - score(whole[0], whole[1])
    gain[(left[:, :, 2] < max(1, leaf_rows)) | (right[:, :, 2] < max(1, leaf_rows))] = -np.inf
    at = np.unravel_index(gain.argmax(), gain.shape)
    if not gain[at] > 1e-12:
        return None
    feature, side, last = (int(x) for x in at)
    rows = int(left[feature, side, 2, last]), int(right[feature, side, 2, last])
    missing_left = bool(side) if absent[feature, 2] else rows[0] >= rows[1]
    return Split(float(gain[at]), feature, last, missing_left, *rows)


def _grow(blocks: DataFrame, trees: list[Tree], width: int, leaves: int, leaf_rows: int, l2: float, rate: float) -> Tree:
    """One tree: always the leaf of highest gain is split next, until there are ``leaves``.

    A pass over the rows splits, ahead of their turn, all leaves that come to it as far as gains are known, so that a tree takes
    about as many passes as it has levels; what did not come to its turn is folded back. Of two children the one with fewer rows is summed;
    the other is the parent less that one.
    """
    draft = Tree()
    known = _histograms(blocks, trees, draft, [0], width)
    splits, made = {0: best_split(known[0], l2, leaf_rows)}, {}
    totals = {0: known[0][0].sum(axis=-1)}

    def turn() -> tuple[list[int], list[int]]:
        """Nodes in the order of their splits as far as it is known, and those among them that are not split yet."""
        order, ahead, open_ = [], [], [0]
        while len(order) < leaves - 1 and any(splits[n] for n in open_):
            node = min((n for n in open_ if splits[n]), key=lambda n: (-splits[n].gain, n))
            open_.remove(node)
            order.append(node)
            if node in made:
                open_.extend(made[node])
            else:
                ahead.append(node)
        return order, ahead

    while True:
        taken, ahead = turn()
        if not ahead:
            break
        wanted = []
        for node in ahead:
            own = splits[node]
            made[node] = draft.split(node, own.feature, own.last, own.missing_left)
            wanted.append(made[node][own.rows_left > own.rows_right])
        found = _histograms(blocks, trees, draft, wanted, width)
        for node, small in zip(ahead, wanted):
            parent = known.pop(node)
            one, two = made[node]
            for child in (one, two):
                known[child] = found[small] if child == small else parent - found[small]
                splits[child], totals[child] = best_split(known[child], l2, leaf_rows), known[child][0].sum(axis=-1)
                if splits[child] is None:
                    del known[child]
    tree, places = Tree(), {0: 0}
    for node in taken:
        own = splits[node]
        places[made[node][0]], places[made[node][1]] = tree.split(places[node], own.feature, own.last, own.missing_left)
    for node, place in places.items():
        if tree.feature[place] < 0:
            tree.value[place] = -rate * totals[node][0] * UNIT / (totals[node][1] * UNIT + l2 + 1e-300)
    return tree


def fit_boosted_trees(
    train: DataFrame,
    vector: str = "window",
    label: str = "target_value",
    rounds: int = 450,
    rate: float = 0.015,
    leaves: int = 31,
    leaf_rows: int = 30,
    l2: float = 0.1,
    bins: int = 255,
    bin_rows: int = 200_000,
    refresh: int = 25,
) -> BoostedTrees:
    """Boosting of labels 0 and 1 under logistic loss, rows weighted so that both classes weigh the same.

    Rows with another label, without a vector, or with one of another width than the widest take no part; null and NaN components
    are missing values, which go to the side of a split where they gain more. An empty table, or one of one class, gives no
    trees. Repeated rows count as often as they are there; the order of rows and tasks changes nothing but the draw for
    ``bin_rows``.

    Rows lie on the executors as blocks of bins, a byte for each feature, with raw scores, which are brought up to date every
    ``refresh`` rounds. A pass sends 6 KB for each node, feature and task; the driver gets the sums, 6 KB for each node and
    feature, and holds those of some ``leaves`` nodes, whatever the number of rows.
    """
    if not 2 <= bins <= MISSING:
        raise ValueError("bins must be 2 to 255")
    usable = train.where(F.col(label).isin(0, 1) & F.col(vector).isNotNull())
    width = usable.agg(F.max(F.size(vector))).first()[0] or 0
    rows = usable.where(F.size(vector) == width).select(F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("features"))
    classes = balanced_weights(rows, "label").select("label", "weight", "n").collect() if width else []
    if len(classes) < 2:
        return BoostedTrees([np.zeros(0)] * width, 0.0, [])
    by_class = {int(r["label"]): float(r["weight"]) for r in classes}
    share = sum(r["weight"] * r["n"] for r in classes if r["label"] == 1) / sum(r["weight"] * r["n"] for r in classes)
    base = float(np.log(share / (1 - share)))
    edges = feature_edges(rows, width, bins, bin_rows)
    weight = F.when(F.col("label") == 1, by_class[1]).otherwise(by_class[0])
    rows = rows.select(F.col("label").cast("double").alias("y"), weight.alias("weight"), "features")
    blocks = written(_blocks(rows, edges, base), "boosting").persist()
    trees, fresh = [], []
    for round_ in range(rounds):
        tree = _grow(blocks, fresh, width, leaves, leaf_rows, l2, rate)
        trees.append(tree)
        fresh.append(tree)
        if len(fresh) == refresh and round_ + 1 < rounds:
            before, blocks, fresh = blocks, written(_advanced(blocks, fresh, width), "boosting").persist(), []
            before.unpersist()
    blocks.unpersist()
    return BoostedTrees(edges, base, trees)


def predict_boosted(model: BoostedTrees, rows: DataFrame, vector: str = "window") -> DataFrame:
    """Adds probability double (of label 1) and prediction int (1 from a half on); both null without a vector of the model's width."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    width, others = len(model.edges), rows.columns
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            fit = np.asarray(pa.compute.equal(pa.compute.list_value_length(column), width).fill_null(False).to_numpy(zero_copy_only=False), bool)
            chance = np.zeros(len(fit))
            if fit.any():
                bins = _binned(_matrix(column.filter(pa.array(fit)), width), shared.value.edges)
                chance[fit] = 1 / (1 + np.exp(-shared.value.raw(bins)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(chance, mask=~fit), pa.array((chance >= 0.5).astype(np.int32), mask=~fit)], [*others, "probability", "prediction"])

    return rows.select("*", F.col(vector).cast("array<double>").alias("__features")).mapInArrow(score, f"{kinds}, probability double, prediction int")
