"""Isolation forest: trees grown in parallel on small subsamples, whole table scored."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from riskweave import constants as K
from riskweave.models.baseline import impute_medians, prepare
from riskweave.operators.ranking import exact_quantile
from riskweave.session import staged

# the two Python functions travel inside the task, so workers need not install this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NODE = "tree int, node int, feature int, threshold double, left int, depth double"


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def subsamples(
    df: DataFrame, trees: int, rows_per_tree: int, seed: int, id_col: str = "transaction_id"
) -> DataFrame:
    """About ``rows_per_tree`` distinct rows per tree, drawn by hash.

    One hash per row cuts the table to a pool a few times the needed size; only that pool
    is paired with the trees.
    """
    n = df.count()
    scale = 1 << 30
    pool_share = min(1.0, 4.0 * trees * rows_per_tree / max(n, 1))
    slot = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(scale))
    pool = df.filter(slot < int(math.ceil(pool_share * scale)))
    expected = max(n * pool_share, 1.0)
    keep = min(scale, int(math.ceil(2.0 * rows_per_tree / expected * scale)))
    drawn = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn(
        "_h", F.xxhash64(F.col(id_col), F.lit(seed + 1), F.col("tree"))
    ).filter(F.pmod("_h", F.lit(scale)) < keep)
    # each tree now holds about 2x its rows: a bounded group
    first = F.row_number().over(Window.partitionBy("tree").orderBy("_h", id_col))
    return drawn.withColumn("_rn", first).filter(F.col("_rn") <= rows_per_tree).drop("_rn", "_h")


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Random axis splits until rows are alone, equal, or the depth is reached.

    Nodes are (node, feature, threshold, left child, path length); the right child is left + 1.
    """
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(x)), 0)]
    used = 1
    while todo:
        node, rows, depth = todo.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        open_axes = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or len(open_axes) == 0:
            # a leaf points to itself, so a fixed number of steps always ends there
            nodes.append((node, 0, math.inf, node, depth + average_path(len(rows))))
            continue
        axis = int(rng.choice(open_axes))
        cut = float(rng.uniform(low[axis], high[axis]))
        if cut >= high[axis]:  # rounding must not leave a side empty
            cut = float(low[axis])
        goes_left = part[:, axis] <= cut
        nodes.append((node, axis, cut, used, 0.0))
        todo.append((used, rows[goes_left], depth + 1))
        todo.append((used + 1, rows[~goes_left], depth + 1))
        used += 2
    return nodes


def fit_forest(
    df: DataFrame, trees: int = 100, rows_per_tree: int = 256, seed: int = K.ANOMALY_SEED,
    id_col: str = "transaction_id",
) -> pd.DataFrame:
    """Node table of the forest, at most ``trees * 2 * rows_per_tree`` small rows."""
    features = list(K.NUMERIC_FEATURES)
    sample = subsamples(df.select(id_col, *features), trees, rows_per_tree, seed, id_col)

    depth = int(math.ceil(math.log2(max(rows_per_tree, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rows = pdf.sort_values(id_col)[features].to_numpy(dtype=float)
        nodes = _grow(rows, np.random.default_rng([seed, tree]), depth)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "depth"])
        out.insert(0, "tree", tree)
        return out

    return sample.groupBy("tree").applyInPandas(grow, _NODE).toPandas()


def score_forest(
    df: DataFrame, forest: pd.DataFrame, fill: dict, rows_per_tree: int = 256
) -> DataFrame:
    """Add ``_s`` in (0, 1]: higher is more isolated.  The forest is a bounded broadcast."""
    inputs = [
        F.coalesce(F.col(c).cast("double"), F.lit(float(fill.get(c, 0.0))))
        for c in K.NUMERIC_FEATURES
    ]
    packed = []
    for _, nodes in forest.groupby("tree"):
        nodes = nodes.sort_values("node")
        packed.append(tuple(
            nodes[c].to_numpy() for c in ("feature", "threshold", "left", "depth")
        ))
    shared = df.sparkSession.sparkContext.broadcast(packed)
    norm = average_path(rows_per_tree)
    steps = int(math.ceil(math.log2(max(rows_per_tree, 2))))

    @F.pandas_udf("double")
    def isolation(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, threshold, left, depth in shared.value:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(steps):
                at = left[at] + (x[rows, feature[at]] > threshold[at])
            total += depth[at]
        return pd.Series(np.power(2.0, -total / len(shared.value) / norm))

    return df.withColumn("_s", isolation(*inputs))


def isolation_forest(
    df: DataFrame, trees: int = 100, contamination: float = K.ANOMALY_CONTAMINATION,
    rows_per_tree: int = 256, seed: int = K.ANOMALY_SEED, id_col: str = "transaction_id",
) -> DataFrame:
    """Add ``anomaly_score`` (higher is more anomalous, 0 at the cut) and ``anomaly_label``.

    Every row is scored.  Isolation trees cut between the extremes of a feature, so they
    do not depend on its scale and no standardising is needed.
    """
    fill = impute_medians(df)
    forest = fit_forest(prepare(df, fill), trees, rows_per_tree, seed, id_col)
    # the exact cut needs several passes over the scores: score only once
    scored = staged(score_forest(df, forest, fill, rows_per_tree), "isolation")
    cut = exact_quantile(scored, "_s", 1.0 - contamination)
    return scored.withColumn("anomaly_score", F.col("_s") - F.lit(cut)).withColumn(
        "anomaly_label", (F.col("anomaly_score") > 0).cast("int")
    ).drop("_s")
