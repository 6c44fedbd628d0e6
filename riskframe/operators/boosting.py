"""Leaf-wise gradient-boosted trees on a binned table, several models in the same passes.

A tree grows best first: the leaf whose best split gains most is split next, until the tree has
``num_leaves`` leaves or nothing gains. Splits come from histograms of row counts, gradients and
hessians per bin. Gradients are rounded to fixed-point integers, so every sum is exact and a tree
does not depend on partitioning, on the order of rows or on the path below that found a split.

One pass over the table serves all models (specs) that are trained together: a task adds up the
histograms of all leaves whose best split is not known yet, they are summed by (model, leaf,
feature), and each reducer returns the best split of its features. The driver holds trees only. It
replays the best-first order on the splits known so far; leaves of that provisional tree with an
unknown split are the next pass's work. A tree is finished when its provisional tree has none, so it
takes about as many passes as it is deep, not one for each split.

Leaves of at most ``IN_MEMORY_ROWS`` rows are not histogrammed pass by pass: their rows go to one
task for each (model, leaf), which returns the splits of the whole subtree in its own best-first
order. Restricted to a subtree the global order is that order, so the replay gives the same tree.

A table of at most ``IN_TASK_BYTES`` of bins is trained in one task for each model, which holds it by pairs of
features: the bin numbers of two features are one number, so one count serves both. The sums, and so the
trees, are the same. Above ``MEMORY_BYTES`` the pairs are a mapped temporary file of the task's own. A larger table
goes pass by pass, and so does a run that stores its progress.

Every ``store_every`` rounds the rows' raw scores are written with the table and the trees (as JSON)
to the ``progress`` folder, if given: a run started again continues after the last stored round.
"""

from __future__ import annotations

import heapq
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field
from math import floor, log, log2

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators.binning import binary_rows, matrix_rows
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.catalog import path_exists, read_json, remove_path, write_json

IN_MEMORY_ROWS = 262_144  # about 50 MB of 200 one-byte features
IN_TASK_BYTES = 1_000_000_000  # bins that the task of a whole model holds
MEMORY_BYTES = 200_000_000  # of those in memory; more are in a file
PAIR_CELLS = 8192  # joint cells of two features; with more of them features are counted one by one
FEW_ROWS = 2048  # counted for all features in one call
CHUNK_ROWS = 65_536  # rows of a larger node counted at once
SUM_ROWS = 8192  # rows summed as doubles at once: whole numbers below 2 ** 53
MAX_CELLS = 4_000_000  # histogram cells of one pass, 24 bytes each
MIN_GAIN = 1e-9
MIN_HESSIAN = 1e-3


@dataclass(frozen=True)
class BoostSpec:
    """One model: the features it may use (positions in the bins) and its parameters."""

    name: str
    features: tuple[int, ...]
    rounds: int = 500
    learning_rate: float = 0.05
    num_leaves: int = 31
    min_child: int = 20
    feature_fraction: float = 0.8  # drawn for each tree
    row_fraction: float = 1.0  # drawn for each tree
    positive_weight: float = 1.0
    l2: float = 0.0
    seed: int = 42

    # What other kinds of trees on the same passes change: limits, and whether trees add up.
    max_depth = None
    min_split = 0
    additive = True

    def is_leaf(self, rows: int, depth: int) -> bool:
        return rows < max(2 * max(1, self.min_child), self.min_split) or self.max_depth is not None and depth >= self.max_depth

    def row_weights(self, key_hash: np.ndarray, round_no: int) -> np.ndarray:
        """How often a tree holds each row."""
        return _drawn(key_hash, self, round_no)

    def gradients(self, label: np.ndarray, margin: np.ndarray, weight: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
        return _gradients(label, margin, self, scale)

    def node_features(self, path: str) -> np.ndarray | None:
        """The features that a node may be split on, or None for all of its tree."""
        return None

    def tree_features(self, round_no: int) -> np.ndarray:
        """The features of one tree, ascending."""
        k = max(1, round(self.feature_fraction * len(self.features))) if self.features else 0
        return np.sort(np.random.default_rng((self.seed, round_no)).permutation(np.array(self.features, np.int64))[:k])


@dataclass
class BinTree:
    """Node arrays; a leaf has feature -1. Rows with bin <= ``bin`` go left."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int((self.feature < 0).sum())

    def leaf_of(self, bins: np.ndarray, depth: int | None = None) -> np.ndarray:
        """The leaf of every row, or its node at ``depth`` if that comes first."""
        node = np.zeros(len(bins), np.int64)
        rows, steps = np.arange(len(bins)), 0
        while True:
            rows = rows[self.feature[node[rows]] >= 0]
            if not len(rows) or steps == depth:
                return node
            at = node[rows]
            node[rows] = np.where(bins[rows, self.feature[at]] <= self.bin[at], self.left[at], self.right[at])
            steps += 1

    def to_json(self) -> dict:
        return {k: v.tolist() for k, v in vars(self).items()}

    @staticmethod
    def from_json(parts: dict) -> BinTree:
        return BinTree(**{k: np.array(v, np.float64 if k == "value" else np.int64) for k, v in parts.items()})


@dataclass
class BoostedModel:
    spec: BoostSpec
    base: float
    trees: list[BinTree] = field(default_factory=list)

    def margin(self, bins: np.ndarray, rounds: int | None = None) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees[:rounds]:
            out += tree.value[tree.leaf_of(bins)]
        return out


# ------------------------------------------------------------------ histograms and splits

def _histogram(bins: np.ndarray, g: np.ndarray, h: np.ndarray, slot: np.ndarray, n_slots: int, n_bins: int) -> np.ndarray:
    """(slots, features, bins, 3): rows, gradients and hessians; sums are whole numbers below 2 ** 53."""
    k = bins.shape[1]
    if len(bins) < SUM_ROWS // 4:  # few rows: one call for all features
        size = n_slots * k * n_bins
        cell = ((slot[:, None] * k + np.arange(k)) * n_bins + bins).ravel()
        parts = [np.bincount(cell, minlength=size), *(np.bincount(cell, np.repeat(values, k), size) for values in (g, h))]
        return np.stack(parts, axis=1).astype(np.int64).reshape(n_slots, k, n_bins, 3)
    out = np.zeros((k, n_slots * n_bins, 3), np.int64)
    for a in range(0, len(bins), SUM_ROWS):
        part = slice(a, a + SUM_ROWS)
        at, columns = slot[part] * n_bins, np.ascontiguousarray(bins[part].T)
        weights = g[part].astype(np.float64), h[part].astype(np.float64)
        for f in range(k):
            cell = at + columns[f]
            out[f, :, 0] += np.bincount(cell, minlength=n_slots * n_bins)
            for column, values in enumerate(weights, 1):
                out[f, :, column] += np.bincount(cell, values, n_slots * n_bins).astype(np.int64)
    return out.reshape(k, n_slots, n_bins, 3).transpose(1, 0, 2, 3)


def best_split(histogram: np.ndarray, features: np.ndarray, spec: BoostSpec, scale: float):
    """(gain, feature, bin, left sums) of the best split of a leaf, or None; ties: first feature, first bin."""
    if not len(features) or histogram.shape[1] < 2:
        return None
    left = histogram.cumsum(axis=1)[:, :-1]
    total = histogram[0].sum(axis=0)
    right = total - left
    ok = (np.minimum(left[..., 0], right[..., 0]) >= max(1, spec.min_child)) & (np.minimum(left[..., 2], right[..., 2]) >= MIN_HESSIAN * scale)
    if not ok.any():
        return None

    def score(sums):
        g, weight = sums[..., 1] / scale, sums[..., 2] / scale + spec.l2
        return g * g / np.where(weight > 0, weight, 1.0)

    gain = np.where(ok, score(left) + score(right) - score(total), -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (float(gain[f, b]), int(features[f]), int(b), tuple(left[f, b].tolist())) if gain[f, b] > MIN_GAIN else None


def node_split(histogram: np.ndarray, features: np.ndarray, spec: BoostSpec, scale: float, path: str):
    """:func:`best_split` within what the model allows at a node."""
    if not len(features) or spec.is_leaf(int(histogram[0, :, 0].sum()), len(path)):
        return None
    own = spec.node_features(path)
    if own is not None:
        keep = np.isin(features, own)
        histogram, features = histogram[keep], features[keep]
    return best_split(histogram, features, spec, scale)


def _gradients(label: np.ndarray, margin: np.ndarray, spec: BoostSpec, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-point gradients and hessians of the weighted logistic loss."""
    p = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
    w = np.where(label == 1, spec.positive_weight, 1.0) * scale
    return np.rint(w * (p - label)).astype(np.int64), np.rint(w * p * (1.0 - p)).astype(np.int64)


def _drawn(key_hash: np.ndarray, spec: BoostSpec, round_no: int) -> np.ndarray:
    """Rows that a tree is grown on, by a hash of key, seed and round."""
    if spec.row_fraction >= 1:
        return np.ones(len(key_hash), bool)
    return row_hash(key_hash, spec.seed, round_no) < np.uint64(int(spec.row_fraction * 2**64))


def row_hash(key_hash: np.ndarray, seed: int, round_no: int) -> np.ndarray:
    """Uniform 64-bit numbers by key, seed and round."""
    x = key_hash.astype(np.uint64) ^ np.uint64((seed * 1_000_003 + round_no * 7919) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


# ------------------------------------------------------------------ trees on the driver

@dataclass
class Node:
    """Sums (rows, gradient, hessian) of a node, and its best split once it is known."""

    sums: tuple[int, int, int]
    known: bool = False
    split: tuple | None = None  # gain, feature, bin, sums of the left child


class Growth:
    """One growing tree: nodes by path ('' the root, then 0 for left and 1 for right)."""

    def __init__(self, rows: int, spec: BoostSpec, features: np.ndarray):
        self.spec, self.features = spec, features
        self.nodes = {"": Node((rows, 0, 0))}

    def learn(self, path: str, sums: tuple, split: tuple | None) -> None:
        self.nodes[path] = Node(sums, True, split)
        if split:
            for side, part in (("0", split[3]), ("1", tuple(a - b for a, b in zip(sums, split[3])))):
                if path + side not in self.nodes:
                    self.nodes[path + side] = Node(part, self.spec.is_leaf(part[0], len(path) + 1))

    def best_first(self) -> tuple[set[str], list[str]]:
        """(paths of the split nodes, leaves) by the splits known so far; of equal gains the first path."""
        leaves, chosen, queue = {""}, set(), []

        def offer(path):
            node = self.nodes[path]
            if node.known and node.split:
                heapq.heappush(queue, (-node.split[0], path))

        offer("")
        while queue and len(leaves) < self.spec.num_leaves:
            path = heapq.heappop(queue)[1]
            chosen.add(path)
            leaves -= {path}
            leaves |= {path + "0", path + "1"}
            offer(path + "0"), offer(path + "1")
        return chosen, sorted(leaves)

    def tree(self, scale: float) -> tuple[BinTree, list[str]]:
        """Node arrays of the present best-first tree, and the path of each node."""
        chosen, _ = self.best_first()
        paths = [""]
        for p in paths:
            if p in chosen:
                paths += [p + "0", p + "1"]
        at = {p: i for i, p in enumerate(paths)}
        out = BinTree(*(np.full(len(paths), -1, np.int64) for _ in range(4)), np.zeros(len(paths)), np.zeros(len(paths), np.int64))
        for p, i in at.items():
            n, g, h = self.nodes[p].sums
            out.cover[i] = n
            if p in chosen:
                _, out.feature[i], out.bin[i], _ = self.nodes[p].split
                out.left[i], out.right[i] = at[p + "0"], at[p + "1"]
            if not self.spec.additive or chosen and p not in chosen:  # a boosted tree without any split adds nothing
                weight = h / scale + self.spec.l2
                out.value[i] = -self.spec.learning_rate * (g / scale) / weight if weight > 0 else 0.0
        return out, paths


def grow_in_memory(bins: np.ndarray, g: np.ndarray, h: np.ndarray, spec: BoostSpec, features: np.ndarray, n_bins: int, scale: float, root: str = "") -> list[tuple]:
    """(path, sums, split) of every node of the subtree at ``root`` grown best first to ``num_leaves`` leaves; paths from there."""
    bins = bins[:, features] if len(features) else np.zeros((len(bins), 0), np.uint8)
    position = {int(f): i for i, f in enumerate(features)}
    slot = np.zeros(len(bins), np.int64)
    sampled = spec.node_features(root) is not None  # a node counts its own features only
    found, held, queue = [], {}, []

    def explore(path, rows, histogram):
        sums = (len(rows), int(g[rows].sum()), int(h[rows].sum()))
        if sampled:
            at = np.flatnonzero(np.isin(features, spec.node_features(root + path)))
            histogram = _histogram(bins[np.ix_(rows, at)], g[rows], h[rows], slot[: len(rows)], 1, n_bins)[0]
            split = node_split(histogram, features[at], spec, scale, root + path)
            histogram = None
        else:
            split = node_split(histogram, features, spec, scale, root + path)
        found.append((path, sums, split))
        if split:
            held[path] = (rows, histogram, split)
            heapq.heappush(queue, (-split[0], path))

    everything = np.arange(len(bins))
    explore("", everything, None if sampled else _histogram(bins, g, h, slot, 1, n_bins)[0])
    for _ in range(spec.num_leaves - 1):
        if not queue:
            break
        rows, histogram, (_, feature, cut, _) = held.pop(path := heapq.heappop(queue)[1])
        goes = bins[rows, position[feature]] <= cut
        sides = {"0": rows[goes], "1": rows[~goes]}
        small = min(sides, key=lambda s: len(sides[s]))
        part = None if sampled else _histogram(bins[sides[small]], g[sides[small]], h[sides[small]], slot[: len(sides[small])], 1, n_bins)[0]
        for side, own in sides.items():
            if not spec.is_leaf(len(own), len(root + path) + 1):
                explore(path + side, own, None if sampled else part if side == small else histogram - part)
    return found


# ------------------------------------------------------------------ whole models in a task

class PairedBins:
    """The bins of some features, by pairs: row j holds the bin numbers of the features 2j and 2j + 1 as one number."""

    def __init__(self, n_rows: int, n_features: int, n_bins: int):
        self.n_bins, self.n_features = n_bins, n_features
        shape = ((n_features + 1) // 2, n_rows)
        if n_rows * n_features > MEMORY_BYTES:
            with tempfile.TemporaryFile() as file:  # the map keeps it; it has no name and goes with the task
                self.pairs = np.memmap(file, np.uint16, "w+", shape=shape)
        else:
            self.pairs = np.zeros(shape, np.uint16)

    def fill(self, at: int, bins: np.ndarray) -> None:
        """Rows from number ``at`` on."""
        part = self.pairs[:, at: at + len(bins)]
        part[:] = bins[:, 0::2].T
        part *= np.uint16(self.n_bins)
        part[: self.n_features // 2] += bins[:, 1::2].T

    def column(self, feature: int, rows: np.ndarray) -> np.ndarray:
        pair = np.asarray(self.pairs[feature // 2])[rows]
        return pair % np.uint16(self.n_bins) if feature % 2 else pair // np.uint16(self.n_bins)

    def histogram(self, features: np.ndarray, rows: np.ndarray | None, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """(features, bins, 3): rows, gradients and hessians of some rows (all by default), which g and h belong to."""
        used, b = np.unique(features // 2), self.n_bins
        n, g, h = len(g), g.astype(np.float64), h.astype(np.float64)
        if n < FEW_ROWS:
            pair = np.asarray(self.pairs[used] if rows is None else self.pairs[np.ix_(used, rows)])
            cell = np.empty((len(used), 2, n), np.int64)
            cell[:, 0], cell[:, 1] = pair // np.uint16(b), pair % np.uint16(b)
            cell += (np.arange(2 * len(used)) * b).reshape(-1, 2, 1)
            size, cell = 2 * len(used) * b, cell.ravel()
            out = np.stack([np.bincount(cell, minlength=size), *(np.bincount(cell, np.tile(x, 2 * len(used)), size).astype(np.int64) for x in (g, h))], axis=1)
            out = out.reshape(len(used), 2, b, 3)
        else:
            out = np.zeros((len(used), 2, b, 3), np.int64)
            largest = max(1.0, float(np.abs(g).max()), float(h.max()))
            step = int(max(SUM_ROWS, min(CHUNK_ROWS, 2.0**53 // largest)))  # sums of whole numbers below 2 ** 53
            for a in range(0, n, step):
                own = slice(a, a + step) if rows is None else rows[a: a + step]
                weights = None, g[a: a + step], h[a: a + step]
                for i, pair in enumerate(used):
                    self._add(out[i], np.asarray(self.pairs[pair])[own], weights)
        position = 2 * np.searchsorted(used, features // 2) + features % 2
        return out.reshape(-1, b, 3)[position]

    def _add(self, out: np.ndarray, pair: np.ndarray, weights: Sequence) -> None:
        b = self.n_bins
        if b * b > PAIR_CELLS:
            for side, cell in enumerate(np.divmod(pair.astype(np.intp), b)):
                for i, w in enumerate(weights):
                    out[side, :, i] += np.bincount(cell, w, b).astype(np.int64)
            return
        cell = pair.astype(np.intp)
        for i, w in enumerate(weights):
            joint = np.bincount(cell, w, b * b).astype(np.int64).reshape(b, b)
            out[0, :, i] += joint.sum(axis=1)
            out[1, :, i] += joint.sum(axis=0)


def _grow_paired(data: PairedBins, g: np.ndarray, h: np.ndarray, rows: np.ndarray, spec: BoostSpec, features: np.ndarray, scale: float) -> tuple[BinTree, dict[str, np.ndarray]]:
    """One tree as :func:`grow_in_memory` grows it from these rows, and the rows of its leaves by path."""
    everything = len(rows) == data.pairs.shape[1] if len(data.pairs) else False
    own = np.array(sorted(spec.features), np.int64)
    at = np.searchsorted(own, features)
    growth, leaves, held, queue = Growth(len(rows), spec, features), {"": rows}, {}, []

    def count(part):
        if not len(features):
            return np.zeros((0, data.n_bins, 3), np.int64)
        return data.histogram(at, None, g, h) if everything and part is rows else data.histogram(at, part, g[part], h[part])

    def explore(path, part, histogram):
        split = node_split(histogram, features, spec, scale, path)
        growth.learn(path, (len(part), int(g[part].sum()), int(h[part].sum())), split)
        if split:
            held[path] = histogram
            heapq.heappush(queue, (-split[0], path))

    explore("", rows, count(rows))
    for _ in range(spec.num_leaves - 1):
        if not queue:
            break
        path = heapq.heappop(queue)[1]
        part, histogram, (_, feature, cut, _) = leaves.pop(path), held.pop(path), growth.nodes[path].split
        goes = data.column(int(np.searchsorted(own, feature)), part) <= cut
        sides = {path + "0": part[goes], path + "1": part[~goes]}
        leaves |= sides
        counted = [p for p in sides if not spec.is_leaf(len(sides[p]), len(p))]
        if counted:
            small = min(sides, key=lambda p: len(sides[p]))
            few = count(sides[small])
            for p in counted:
                explore(p, sides[p], few if p == small else histogram - few)
    return growth.tree(scale)[0], leaves


def _train_paired(data: PairedBins, label: np.ndarray, hashed: np.ndarray, spec: BoostSpec, base: float, scale: float) -> list[BinTree]:
    """All trees of a model."""
    margin, trees = np.full(len(label), base), []
    own, everything = {f: i for i, f in enumerate(sorted(spec.features))}, np.arange(len(label))
    for t in range(spec.rounds):
        drawn = spec.row_weights(hashed, t) > 0
        g, h = spec.gradients(label, margin, drawn, scale)
        if drawn.all():
            tree, leaves = _grow_paired(data, g, h, everything, spec, spec.tree_features(t), scale)
        else:
            tree, leaves = _grow_paired(data, g, h, np.flatnonzero(drawn), spec, spec.tree_features(t), scale)
            leaves = _leaves_of(tree, data, own)
        trees.append(tree)
        at = {"": 0}
        for p in sorted({path[:i] for path in leaves for i in range(len(path))}, key=len):
            at[p + "0"], at[p + "1"] = tree.left[at[p]], tree.right[at[p]]
        for path, rows in leaves.items():
            margin[rows] += tree.value[at[path]]
    return trees


def _leaves_of(tree: BinTree, data: PairedBins, position: dict[int, int]) -> dict[str, np.ndarray]:
    """The rows of every leaf, drawn or not, by path."""
    out, todo = {}, [("", 0, np.arange(data.pairs.shape[1]))]
    while todo:
        path, node, rows = todo.pop()
        if tree.feature[node] < 0:
            out[path] = rows
            continue
        goes = data.column(position[int(tree.feature[node])], rows) <= tree.bin[node]
        todo += [(path + "0", tree.left[node], rows[goes]), (path + "1", tree.right[node], rows[~goes])]
    return out


def _packed(state: DataFrame, label: str):
    """Blocks (labels, hashes, bins) of rows as bytes."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y, hashed = (batch.column(c).to_numpy(zero_copy_only=False).astype(kind) for c, kind in ((label, np.float64), ("__hash", np.int64)))
                parts = [y, hashed, matrix_rows(batch.column("bins"))]
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts], names=["y", "hashed", "bins"])

    return state.select(label, "__hash", "bins").mapInArrow(pack, "y binary, hashed binary, bins binary").rdd.map(tuple)


def _fit_in_tasks(state: DataFrame, models: list[BoostedModel], n_rows: int, n_bins: int, scale: float, label: str) -> None:
    """Train every model in a task of its own."""
    sc, plan = state.sparkSession.sparkContext, [(m.spec, m.base) for m in models]
    blocks = _packed(state, label).persist(StorageLevel.MEMORY_AND_DISK)

    def train(number: int, rows: Iterator[tuple]) -> Iterator[tuple]:
        spec, base = plan[number]
        own = np.array(sorted(spec.features), np.int64)
        data = PairedBins(n_rows, len(own), n_bins)
        target, hashes, at = np.zeros(n_rows), np.zeros(n_rows, np.int64), 0
        for y, hashed, bins in rows:
            part = slice(at, at + len(hashed) // 8)
            target[part], hashes[part] = np.frombuffer(y), np.frombuffer(hashed, np.int64)
            data.fill(at, np.frombuffer(bins, np.uint8).reshape(part.stop - at, -1)[:, own])
            at = part.stop
        for t, tree in enumerate(_train_paired(data, target, hashes, spec, base, scale)):
            yield number, t, tree.to_json()

    try:
        alone = blocks.coalesce(1)
        of_models = sc.union([alone] * len(models)) if len(models) > 1 else alone
        found = of_models.mapPartitionsWithIndex(train).collect()  # the models' sizes
    finally:
        blocks.unpersist()
    for number, _, tree in sorted(found, key=lambda x: x[:2]):
        models[number].trees.append(BinTree.from_json(tree))


# ------------------------------------------------------------------ Spark passes

@dataclass
class _Work:
    """What a pass does for one model: its growing tree, the slot of each node, and trees not yet in the stored scores."""

    spec: BoostSpec
    base: float
    since: list[BinTree]
    round_no: int
    features: np.ndarray
    tree: BinTree
    slot: np.ndarray
    paths: list[str]  # of each slot


def _rows_of(batches: Iterator[pa.RecordBatch], work: dict[int, _Work], scale: float, label: str):
    """(batch, model, bins, row numbers, slot, gradients, hessians) of the rows that stand in a slot."""
    for batch in batches:
        if not batch.num_rows:
            continue
        bins = matrix_rows(batch.column("bins"))
        target = batch.column(label).to_numpy(zero_copy_only=False).astype(np.float64)
        hashed = batch.column("__hash").to_numpy(zero_copy_only=False)
        stored = matrix_rows(batch.column("raw"), np.float64)
        for model, w in work.items():
            slot = w.slot[w.tree.leaf_of(bins)]
            weight = w.spec.row_weights(hashed, w.round_no)
            rows = np.flatnonzero((slot >= 0) & (weight > 0))
            if len(rows):
                margin = stored[rows, model].copy() if w.spec.additive else np.zeros(len(rows))
                for tree in w.since:
                    margin += tree.value[tree.leaf_of(bins[rows])]
                yield batch, model, bins, rows, slot[rows], *w.spec.gradients(target[rows], margin, weight[rows], scale)


_SPLIT = "model int, slot int, path string, n long, g long, h long, gain double, feature int, cut int, left_n long, left_g long, left_h long"


def _split_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (model, slot, path, sums, split) in the schema ``_SPLIT``."""
    flat = [(m, s, p, *sums, *((split[0], split[1], split[2], *split[3]) if split else (None,) * 6)) for m, s, p, sums, split in rows]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in flat], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in _SPLIT.split(", ")])


def _histogram_pass(state: DataFrame, work: dict[int, _Work], n_bins: int, scale: float, label: str) -> list:
    """Best split of every open leaf, at most one row for each of them and reducer."""

    def parts_of(w: _Work) -> list[tuple[slice, np.ndarray]]:
        """(slots, positions of the features they count): all slots together, or each one if it has features of its own."""
        own = [w.spec.node_features(p) for p in w.paths]
        if any(o is None for o in own):
            return [(slice(0, len(own)), np.arange(len(w.features)))]
        return [(slice(i, i + 1), np.flatnonzero(np.isin(w.features, o))) for i, o in enumerate(own)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = {m: parts_of(w) for m, w in work.items()}
        total = {m: [np.zeros((s.stop - s.start, len(at), n_bins, 3), np.int64) for s, at in own] for m, own in parts.items()}
        for _, model, bins, rows, slot, g, h in _rows_of(batches, work, scale, label):
            for (slots, at), sums in zip(parts[model], total[model]):
                in_part = np.flatnonzero((slot >= slots.start) & (slot < slots.stop))
                if len(in_part):
                    sums += _histogram(bins[np.ix_(rows[in_part], work[model].features[at])], g[in_part], h[in_part], slot[in_part] - slots.start, len(sums), n_bins)
        for model, own in parts.items():
            for (slots, at), sums in zip(own, total[model]):
                slot, feature = np.nonzero(sums[..., 0].any(axis=2))
                if len(slot):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), model, np.int32)), pa.array((slot + slots.start).astype(np.int32)), pa.array(at[feature].astype(np.int32)),
                                                      binary_rows(sums[slot, feature].reshape(len(slot), -1))], names=["model", "slot", "feature", "sums"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, dict[int, np.ndarray]] = {}
        for batch in batches:
            parts = matrix_rows(batch.column("sums"), np.int64)
            for i, (m, s, f) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("model", "slot", "feature")))):
                leaf = total.setdefault((m, s), {})
                leaf[f] = leaf[f] + parts[i] if f in leaf else parts[i]
        out = []
        for (m, s), by_feature in total.items():
            order = sorted(by_feature)
            histogram = np.stack([by_feature[f] for f in order]).reshape(len(order), n_bins, 3)
            out.append((m, s, "", tuple(histogram[0].sum(axis=0).tolist()), node_split(histogram, work[m].features[order], work[m].spec, scale, work[m].paths[s])))
        if out:
            yield _split_batch(out)

    partial = state.mapInArrow(count, "model int, slot int, feature int, sums binary")
    return partial.repartition("model", "slot", "feature").mapInArrow(best, _SPLIT).collect()


def rows_by_leaf(state: DataFrame, work: dict[int, _Work], scale: float, label: str):
    """The rows of every open leaf as a group (model, slot, bins, g, h)."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, model, _, rows, slot, g, h in _rows_of(batches, work, scale, label):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), model, np.int32)), pa.array(slot.astype(np.int32)), batch.column("bins").take(pa.array(rows)),
                                              pa.array(g), pa.array(h)], names=["model", "slot", "bins", "g", "h"])

    return state.mapInArrow(rows_of, "model int, slot int, bins binary, g long, h long").groupBy("model", "slot")


def _subtree_pass(state: DataFrame, work: dict[int, _Work], n_bins: int, scale: float, label: str) -> list:
    """The whole subtrees of small open leaves, one task's group for each (model, leaf)."""

    def grow(table: pa.Table) -> pa.Table:
        model, slot = table.column("model")[0].as_py(), table.column("slot")[0].as_py()
        w = work[model]
        found = grow_in_memory(matrix_rows(table.column("bins")), table.column("g").to_numpy(), table.column("h").to_numpy(), w.spec, w.features, n_bins, scale, w.paths[slot])
        return pa.Table.from_batches([_split_batch([(model, slot, *node) for node in found])])

    return rows_by_leaf(state, work, scale, label).applyInArrow(grow, _SPLIT).collect()


def _grow_trees(state: DataFrame, models: list[BoostedModel], stored: int, active: list[int], round_no: int, n_rows: int, n_bins: int, scale: float,
                label: str, in_memory_rows: int, finish=None) -> dict[int, BinTree]:
    """One tree for every active model. ``finish`` (state, work, n_bins, scale, label) may return the whole trees
    of models whose open leaves are all small."""
    growing = {m: Growth(n_rows, models[m].spec, models[m].spec.tree_features(round_no)) for m in active}
    done: dict[int, BinTree] = {}
    while growing:
        work, leaf_at, cells = {}, {}, 0
        open_leaves = {m: [p for p in t.best_first()[1] if not t.nodes[p].known] for m, t in growing.items()}
        large = {m: [p for p in ps if growing[m].nodes[p].sums[0] > in_memory_rows] for m, ps in open_leaves.items()}
        histograms = any(large.values())  # small leaves wait for the large ones: one kind of pass at a time
        for m, t in growing.items():
            wanted = large[m] if histograms else open_leaves[m]
            if histograms:
                room = max(0 if work else 1, (MAX_CELLS - cells) // max(1, len(t.features) * n_bins))
                wanted = wanted[:room]
                cells += len(wanted) * len(t.features) * n_bins
            if wanted:
                tree, paths = t.tree(scale)
                number = {p: i for i, p in enumerate(wanted)}
                work[m] = _Work(models[m].spec, models[m].base, models[m].trees[stored:], round_no, t.features, tree, np.array([number.get(p, -1) for p in paths]), wanted)
                leaf_at[m] = wanted
        if work and finish and not histograms:
            done |= finish(state, work, n_bins, scale, label)
            growing = {m: t for m, t in growing.items() if m not in work}
        elif work:
            found: dict[tuple, tuple] = {}
            for r in (_histogram_pass if histograms else _subtree_pass)(state, work, n_bins, scale, label):
                split = (r.gain, r.feature, r.cut, (r.left_n, r.left_g, r.left_h)) if r.gain is not None else None
                at = (r.model, leaf_at[r.model][r.slot] + r.path)
                best = found.get(at)
                if best is None or split and (best[1] is None or (-split[0], split[1]) < (-best[1][0], best[1][1])):
                    found[at] = ((r.n, r.g, r.h), split)
            for (m, path), (sums, split) in sorted(found.items()):
                growing[m].learn(path, sums, split)
            for m, paths in leaf_at.items():
                for path in paths:
                    growing[m].nodes[path].known = True  # a leaf without rows in this draw has no split
        for m in [m for m, t in growing.items() if all(t.nodes[p].known for p in t.best_first()[1])]:
            done[m] = growing.pop(m).tree(scale)[0]
    return done


def _with_scores(state: DataFrame, models: list[BoostedModel], since: int) -> DataFrame:
    """The table with the trees from number ``since`` on added to every row's stored scores."""
    trees = [m.trees[since:] for m in models]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bins, raw = matrix_rows(batch.column("bins")), matrix_rows(batch.column("raw"), np.float64).copy()
                for m, own in enumerate(trees):
                    for tree in own:
                        raw[:, m] += tree.value[tree.leaf_of(bins)]
                yield batch.set_column(batch.schema.get_field_index("raw"), "raw", binary_rows(raw))

    return state.mapInArrow(add, state.schema)


def fit(binned: DataFrame, n_bins: int, specs: Sequence[BoostSpec], key: str, label: str, progress: str | None = None, store_every: int = 10,
        in_memory_rows: int = IN_MEMORY_ROWS) -> list[BoostedModel]:
    """Train all ``specs`` on a binned table (columns key, label 0/1, bins; see :mod:`riskframe.operators.binning`)."""
    spark = binned.sparkSession
    counts = binned.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")).first()
    n_rows, positives = counts.n, counts.pos or 0
    heaviest = max([1.0, *(s.positive_weight for s in specs)])
    scale = 2.0 ** min(30, floor(61 - log2(max(1, n_rows) * heaviest)))

    def base(spec):
        up, down = positives * spec.positive_weight, float(n_rows - positives)
        return log(up / down) if up > 0 and down > 0 else 0.0

    models = [BoostedModel(s, base(s)) for s in specs]
    described = [asdict(s) | {"features": list(s.features)} for s in specs]
    if progress and path_exists(spark, f"{progress}/trees.json"):
        saved = read_json(spark, f"{progress}/trees.json")
        if saved["specs"] != described or saved["rows"] != n_rows:
            raise ValueError(f"{progress} holds the progress of another run")
        for model, trees in zip(models, saved["trees"]):
            model.trees = [BinTree.from_json(t) for t in trees]
    start = max((len(m.trees) for m in models), default=0)

    bases = binary_rows(np.array([[m.base for m in models]]))[0].as_py()
    first = binned.select(key, label, "bins", F.xxhash64(key).alias("__hash"), F.lit(bytearray(bases)).alias("raw"))
    widest = max((len(s.features) for s in specs), default=0)
    if n_rows and not progress and in_memory_rows >= min(n_rows, IN_MEMORY_ROWS) and n_rows * max(1, widest) <= IN_TASK_BYTES:
        _fit_in_tasks(first, models, n_rows, n_bins, scale, label)
        return models
    folder = f"{ensure_checkpoint_dir(spark)}/boosting-{uuid.uuid4().hex}"
    state, stored = _stored(spark, _with_scores(first, models, 0), f"{folder}/{start}"), start
    rounds = max((s.rounds for s in specs), default=0)
    for t in range(start, rounds if n_rows else 0):
        active = [i for i, s in enumerate(specs) if t < s.rounds]
        for m, tree in _grow_trees(state, models, stored, active, t, n_rows, n_bins, scale, label, in_memory_rows).items():
            models[m].trees.append(tree)
        if (t + 1) % store_every == 0 and t + 1 < rounds:
            state, old = _stored(spark, _with_scores(state, models, stored), f"{folder}/{t + 1}"), f"{folder}/{stored}"
            remove_path(spark, old)
            stored = t + 1
            if progress:
                write_json(spark, {"specs": described, "rows": n_rows, "trees": [[x.to_json() for x in m.trees] for m in models]}, f"{progress}/trees.json")
    remove_path(spark, folder)
    return models


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def score(binned: DataFrame, models: Sequence[BoostedModel], key: str, label: str, at: Sequence[tuple[str, int, int]] | None = None) -> DataFrame:
    """Long (model, key, label, score): probabilities of all models in one pass.

    ``at`` lists (name, model number, rounds): the same trees cut off after fewer rounds.
    """
    wanted = list(at) if at is not None else [(m.spec.name, i, len(m.trees)) for i, m in enumerate(models)]
    types = dict(binned.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = matrix_rows(batch.column("bins"))
            for name, number, rounds in wanted if batch.num_rows else ():
                p = 1.0 / (1.0 + np.exp(-np.clip(models[number].margin(bins, rounds), -500, 500)))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(p), pa.string()), batch.column(key), batch.column(label), pa.array(p)], names=["model", key, "label", "score"])

    return binned.select(key, label, "bins").mapInArrow(run, f"model string, {key} {types[key]}, label {types[label]}, score double")
