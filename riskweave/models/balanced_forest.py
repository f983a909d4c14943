"""A random forest whose class weights are balanced in every bootstrap sample.

How often a row is in the sample of a tree is a Poisson draw that follows from a hash of its id: no
sample is stored, a lost task draws the same again, and SQL can repeat it.  A class weighs
``n / (2 n_c)`` of the tree's own sample.  Trees grow level by level from histograms: tasks count their
rows per tree, node, feature and bin, Spark adds the counts, and the best cut of a node is found where
its sum is.  Only nodes, of a number bounded by trees and depth, come to the driver, and a pass over the
rows holds histograms of bounded size; a level with more nodes takes several passes.

Counts are whole numbers, so cuts do not depend on the order or the number of tasks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from riskweave.session import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIME = 2**31 - 1
CELLS = 3_000_000  # histogram cells of one pass in a task
BLOCK = 16_384  # rows of a cell of the binned table


def poisson_bounds() -> list[int]:
    """Draws below the k-th bound mean at most k times in the sample (mean 1), as parts of :data:`PRIME`."""
    out, total, term = [], 0.0, math.exp(-1.0)
    for k in range(10):
        total += term
        out.append(math.floor(total * PRIME))
        term /= k + 1
    return out


def draw_bases(id_col: str, seed: int) -> tuple[Column, Column]:
    """Two numbers below :data:`PRIME` from the MD5 of an id; tree t draws ``(a + (t + 1) b) mod PRIME``."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("long") % PRIME for at in (1, 9))


def _times(a: np.ndarray, b: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is in the sample of a tree."""
    u = a + (tree + 1) * b
    u = (u & PRIME) + (u >> 31)  # the prime is 2^31 - 1
    u[u >= PRIME] -= PRIME
    out = np.zeros(len(u), dtype=np.int8)
    for bound in poisson_bounds():
        out += u >= bound
    return out


@dataclass
class Tree:
    """Nodes in arrays; a node without a cut has feature -1.  The right child follows the left one."""

    weights: np.ndarray  # of the two classes
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    rows: np.ndarray  # distinct rows of the sample
    times: np.ndarray  # nodes x classes: draws of the sample
    gain: np.ndarray


@dataclass
class Forest:
    cuts: list[np.ndarray]  # per feature: a row goes left of cut b where its value is at most b
    trees: list[Tree]

    def nodes(self) -> pd.DataFrame:
        """(tree, node, feature, left, rows, times_0, times_1), feature -1 for leaves."""
        return pd.concat([
            pd.DataFrame({
                "tree": t, "node": np.arange(len(x.feature)), "feature": x.feature, "left": x.left, "rows": x.rows,
                "times_0": x.times[:, 0], "times_1": x.times[:, 1], "weight_0": x.weights[0], "weight_1": x.weights[1],
            }) for t, x in enumerate(self.trees)
        ], ignore_index=True)

    def importance(self) -> np.ndarray:
        """Mean decrease of weighted impurity by feature, as shares of each tree; sums to 1 if any tree has a cut."""
        total, used = np.zeros(len(self.cuts)), 0
        for x in self.trees:
            own = np.bincount(np.maximum(x.feature, 0), np.where(x.feature >= 0, x.gain, 0), len(self.cuts))
            if own.sum() > 0:
                total, used = total + own / own.sum(), used + 1
        return total / max(used, 1)


def quantile_cuts(rows: DataFrame, size: int, bins: int, flags: int = 0) -> list[np.ndarray]:
    """Up to ``bins - 1`` cuts of each of the ``size`` components of ``x``, from one pass.

    The last ``flags`` components are 0 or 1, which one cut tells apart.
    """
    shares = [k / bins for k in range(1, bins)]
    asked = [F.percentile_approx(F.col("x")[i], shares, 10_000).alias(f"q{i}") for i in range(size - flags)]
    found = rows.agg(*asked).first() if asked else []
    return [np.unique(np.array(q if q is not None else [], dtype=float)) for q in found] + [np.zeros(1)] * flags


def _places(code: np.ndarray, tree: Tree, depth: int) -> np.ndarray:
    """Node of each row after at most ``depth`` steps; ``code`` is rows x features."""
    at, start, flat = np.zeros(len(code), dtype=np.int64), np.arange(len(code)) * code.shape[1], code.ravel()
    # a leaf leads to itself: its bin is beyond all codes
    leaf = tree.feature < 0
    feature, last = np.where(leaf, 0, tree.feature), np.where(leaf, 255, tree.bin)
    left = np.where(leaf, np.arange(len(leaf)), tree.left)
    for _ in range(depth if not leaf.all() else 0):
        at = left[at] + (flat[start + feature[at]] > last[at])
    return at


def _encoded(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """(y, a, b, code): labels, draw bases and bin numbers of up to ``BLOCK`` rows a cell, as bytes.

    All levels read them again, so Spark passes on a few cells instead of every row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            code = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
            y, a, b = (batch.column(c).to_numpy() for c in ("y", "a", "b"))
            whole = (y.astype(np.uint8), a.astype(np.uint32), b.astype(np.uint32), code)
            starts = range(0, batch.num_rows, BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[i : i + BLOCK].tobytes() for i in starts], pa.binary()) for part in whole], ["y", "a", "b", "code"]
            )

    return rows.select("y", "a", "b", "x").mapInArrow(run, "y binary, a binary, b binary, code binary")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(y, a, b, code) of each block; ``code`` is rows x features."""
    kinds = {"y": np.uint8, "a": np.uint32, "b": np.uint32, "code": np.uint8}
    for batch in batches:
        for i in range(batch.num_rows):
            y, a, b, code = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=kind) for c, kind in kinds.items())
            yield y, a.astype(np.int64), b.astype(np.int64), code.reshape(-1, size)


def _totals(counted: DataFrame, trees: int, parts: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, ...]]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((trees, 3), dtype=np.int64)
        for y, a, b, *_ in parts(batches):
            for t in range(trees):
                times = _times(a, b, t)
                out[t] += (times > 0).sum(), times[y == 0].sum(), times[y == 1].sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(trees), pa.int32()), *[pa.array(out[:, k]) for k in range(3)]], ["tree", "rows", "times_0", "times_1"]
        )

    totals = counted.mapInArrow(run, "tree int, rows long, times_0 long, times_1 long")
    return totals.groupBy("tree").agg(*[F.sum(c).alias(c) for c in ("rows", "times_0", "times_1")])


def sample_totals(rows: DataFrame, trees: int) -> DataFrame:
    """(tree, rows, times_0, times_1) of every bootstrap sample; ``rows`` has ``y``, ``a`` and ``b``."""
    columns = ("y", "a", "b")
    return _totals(rows.select(*columns), trees, lambda batches: (tuple(x.column(c).to_numpy() for c in columns) for x in batches))


def _histograms(encoded: DataFrame, size: int, trees: list[Tree], asked: dict, depth: int, bins: int) -> DataFrame:
    """(tree, node, cells): counts of rows and draws by feature and bin; ``asked`` gives (nodes, features) by tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((len(nodes), f.shape[1], bins, 3), dtype=np.int64) for t, (nodes, f) in asked.items()}
        for y, a, b, code in _blocks(batches, size):
            for t, (nodes, features) in asked.items():
                times = _times(a, b, t)
                drawn = np.flatnonzero(times)
                own = code[drawn]
                node = _places(own, trees[t], depth)
                slots = np.full(len(trees[t].feature), -1)
                slots[nodes] = np.arange(len(nodes))
                slot = slots[node]
                held = np.flatnonzero(slot >= 0)
                slot, drawn = slot[held], drawn[held]
                # rows and draws of both classes in one number, below 2^53 as a block has up to BLOCK rows
                one = 1.0 + times[drawn] * np.where(y[drawn] == 1, float(1 << 35), np.where(y[drawn] == 0, float(1 << 17), 0.0))
                start, flat = held * size, own.ravel()
                cells = sums[t].reshape(-1, features.shape[1], bins, 3)
                for j in range(features.shape[1]):
                    cell = slot * bins + flat[start + features[slot, j]]
                    packed = np.bincount(cell, one, len(nodes) * bins).astype(np.int64).reshape(-1, bins)
                    cells[:, j, :, 0] += packed & (1 << 17) - 1
                    cells[:, j, :, 1] += packed >> 17 & (1 << 18) - 1
                    cells[:, j, :, 2] += packed >> 35
        for t, (nodes, _) in asked.items():
            some = np.flatnonzero(sums[t].reshape(len(nodes), -1).any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), t), pa.int32()), pa.array(nodes[some], pa.int32()), pa.array([sums[t][i].tobytes() for i in some], pa.binary())],
                ["tree", "node", "cells"],
            )

    return encoded.mapInArrow(run, "tree int, node int, cells binary")


def best_cut(cells: np.ndarray, weights: np.ndarray, min_leaf: int) -> tuple[int, int, float, np.ndarray]:
    """(feature place, bin, gain, left counts) of the best cut of one node; place -1 if none leaves enough rows.

    ``cells`` is features x bins x (rows, draws of class 0, draws of class 1).  Ties go to the first.
    """
    whole = cells[0].sum(axis=0)
    left = cells.cumsum(axis=1)[:, :-1]
    right = whole - left

    def purity(side: np.ndarray) -> np.ndarray:
        w = side[..., 1:] * weights
        return (w * w).sum(axis=-1) / np.maximum(w.sum(axis=-1), 1e-300)

    gain = purity(left) + purity(right) - purity(whole)
    allowed = (left[..., 0] >= min_leaf) & (right[..., 0] >= min_leaf)
    gain = np.where(allowed, gain, -1.0)
    at = int(gain.argmax()) if gain.size else 0
    if not gain.size or gain.flat[at] <= 1e-9:
        return -1, 0, 0.0, whole
    place, cut = divmod(at, gain.shape[1])
    return place, cut, float(gain.flat[at]), left[place, cut]


def _cut_nodes(sums: DataFrame, trees: list[Tree], features: int, bins: int, min_leaf: int) -> list:
    """Best cuts of all nodes: one short row each."""
    weights = [t.weights for t in trees]

    def decide(group: pa.Table) -> pa.Table:
        cells = sum(np.frombuffer(c, dtype=np.int64) for c in group.column("cells").to_pylist()).reshape(features, bins, 3)
        t, node = (group.column(c)[0].as_py() for c in ("tree", "node"))
        place, cut, gain, left = best_cut(cells, weights[t], min_leaf)
        row = {"tree": t, "node": node, "place": place, "bin": cut, "gain": gain, "left": left.tolist(), "whole": cells[0].sum(axis=0).tolist()}
        return pa.Table.from_pylist([row], schema=pa.schema([
            ("tree", pa.int32()), ("node", pa.int32()), ("place", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()),
            ("left", pa.list_(pa.int64())), ("whole", pa.list_(pa.int64())),
        ]))

    schema = "tree int, node int, place int, bin int, gain double, left array<long>, whole array<long>"
    return sums.groupBy("tree", "node").applyInArrow(decide, schema).collect()


def _chosen_features(seed: int, tree: int, node: int, size: int, most: int) -> np.ndarray:
    return np.sort(np.random.default_rng([seed, tree, node]).choice(size, most, replace=False))


def fit_balanced_forest(
    rows: DataFrame, size: int, trees: int = 80, depth: int = 12, min_leaf: int = 20, bins: int = 32, seed: int = 0,
    id_col: str = "id", flags: int = 0,
) -> Forest:
    """A forest from ``rows`` (``id_col``, ``y`` 0/1, ``x`` of ``size`` numbers without gaps, the last ``flags`` 0 or 1)."""
    a, b = draw_bases(id_col, seed)
    drawn = rows.select(F.col("y").cast("int").alias("y"), a.alias("a"), b.alias("b"), F.col("x").cast("array<double>").alias("x"))
    cuts = quantile_cuts(drawn, size, bins, flags)
    encoded = staged(_encoded(drawn, cuts), "binned", group_mb=2)
    most = max(1, math.isqrt(size))
    found = {r["tree"]: r for r in _totals(encoded, trees, lambda batches: _blocks(batches, size)).collect()}
    grown = []
    for t in range(trees):
        times = np.array([found[t]["times_0"], found[t]["times_1"]]) if t in found else np.zeros(2, dtype=np.int64)
        weights = times.sum() / np.maximum(2 * times, 1)
        grown.append(Tree(weights, np.array([-1]), np.array([0]), np.array([0]), np.array([found[t]["rows"] if t in found else 0]), times[None], np.zeros(1)))
    open_nodes = [(t, 0) for t in range(trees) if grown[t].rows[0] >= 2 * min_leaf]
    share = max(1, CELLS // (most * bins * 3))
    for level in range(depth):
        following = []
        for at in range(0, len(open_nodes), share):
            asked = {}
            for t in sorted({t for t, _ in open_nodes[at : at + share]}):
                nodes = np.array(sorted(n for u, n in open_nodes[at : at + share] if u == t))
                asked[t] = nodes, np.stack([_chosen_features(seed, t, int(n), size, most) for n in nodes])
            sums = _histograms(encoded, size, grown, asked, level, bins)
            for r in sorted(_cut_nodes(sums, grown, most, bins, min_leaf), key=lambda r: (r["tree"], r["node"])):
                if r["place"] >= 0:
                    following += _split(grown[r["tree"]], r, asked[r["tree"]], min_leaf)
        open_nodes = following
        if not open_nodes:
            break
    return Forest(cuts, grown)


def _split(tree: Tree, r, asked: tuple[np.ndarray, np.ndarray], min_leaf: int) -> list[tuple[int, int]]:
    """Give a node its cut and two children; returns those that may be cut in turn."""
    nodes, features = asked
    node, left = r["node"], np.array(r["left"])
    right = np.array(r["whole"]) - left
    new = len(tree.feature)
    tree.feature[node] = features[np.searchsorted(nodes, node), r["place"]]
    tree.bin[node], tree.left[node], tree.gain[node] = r["bin"], new, r["gain"]
    tree.feature, tree.bin = np.append(tree.feature, [-1, -1]), np.append(tree.bin, [0, 0])
    tree.left, tree.gain = np.append(tree.left, [new, new + 1]), np.append(tree.gain, [0.0, 0.0])
    tree.rows = np.append(tree.rows, [left[0], right[0]])
    tree.times = np.concatenate([tree.times, [left[1:], right[1:]]])
    mixed = lambda side: side[0] >= 2 * min_leaf and side[1] > 0 and side[2] > 0
    return [(r["tree"], n) for n, side in ((new, left), (new + 1, right)) if mixed(side)]


def score_balanced_forest(rows: DataFrame, forest: Forest, depth: int = 12) -> DataFrame:
    """``rows`` (with ``x``) plus ``score``, the mean weighted share of class 1 in the leaves, and ``prediction``.

    The forest travels with the function, as Spark sends large ones once to an executor; its size is
    bounded by trees and depth.
    """
    @F.pandas_udf("double")
    def share(x: pd.Series) -> pd.Series:
        values = np.stack(x.to_numpy())
        code = np.stack([np.searchsorted(c, values[:, i]) for i, c in enumerate(forest.cuts)], axis=1)
        total = np.zeros(len(values))
        for tree in forest.trees:
            w = tree.times * tree.weights
            total += (w[:, 1] / np.maximum(w.sum(axis=1), 1e-300))[_places(code, tree, depth)]
        return pd.Series(total / len(forest.trees))

    scored = rows.withColumn("score", share("x"))
    return scored.withColumn("prediction", (F.col("score") > 0.5).cast("int"))
