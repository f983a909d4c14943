"""The forest with balanced samples against one grown row by row, and the optimum of the logistic model."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import constants as K
from riskweave.models import balanced_forest as BF

SEED = 3


def _times(key: str, tree: int) -> int:
    digest = hashlib.md5(f"{key}:{SEED}".encode()).hexdigest()
    a, b = (int(digest[i : i + 8], 16) % BF.PRIME for i in (0, 8))
    u, k, total = (a + (tree + 1) * b) % BF.PRIME, 0, math.exp(-1)
    while k < 10 and u >= math.floor(total * BF.PRIME):
        k += 1
        total += math.exp(-1) / math.factorial(k)
    return k


def _plain_tree(keys, x, y, cuts, tree, depth, min_leaf):
    """(feature, bin, left, rows, times) of one tree, all candidate cuts counted row by row."""
    k = np.array([_times(key, tree) for key in keys])
    draws = np.array([k[y == c].sum() for c in (0, 1)])
    weights = draws.sum() / np.maximum(2 * draws, 1)
    nodes = [[-1, 0, 0, int((k > 0).sum()), draws.tolist()]]
    level = [(0, np.flatnonzero(k > 0))]

    def purity(rows):
        w = np.array([k[rows][y[rows] == c].sum() for c in (0, 1)]) * weights
        return (w * w).sum() / max(w.sum(), 1e-300)

    for _ in range(depth):
        following = []
        for node, rows in level:
            labels = y[rows]
            if len(rows) < 2 * min_leaf or (node and len(set(labels.tolist())) < 2):
                continue
            best = (1e-9, None)
            for f in BF._chosen_features(SEED, tree, node, x.shape[1], max(1, math.isqrt(x.shape[1]))):
                for b, cut in enumerate(cuts[f]):
                    side = x[rows, f] <= cut
                    if min(side.sum(), (~side).sum()) >= min_leaf:
                        gain = purity(rows[side]) + purity(rows[~side]) - purity(rows)
                        if gain > best[0] * (1 + 1e-12):
                            best = (gain, (int(f), b, side))
            if best[1] is None:
                continue
            f, b, side = best[1]
            nodes[node][:3] = [f, b, len(nodes)]
            for part in (rows[side], rows[~side]):
                following.append((len(nodes), part))
                nodes.append([-1, 0, len(nodes), len(part), [int(k[part][y[part] == c].sum()) for c in (0, 1)]])
        level = following
    return nodes, weights


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 6)).round(1)
    x[:, 2] = rng.integers(0, 2, 400)
    y = ((x[:, 0] > 0.8) & (x[:, 2] == 1) | (rng.random(400) < 0.02)).astype(int)
    return [f"t{i}" for i in range(400)], x, y


def _frame(spark, data, parts=3):
    keys, x, y = data
    return spark.createDataFrame([(k, int(c), v.tolist()) for k, c, v in zip(keys, y, x)], "id string, y int, x array<double>").repartition(parts)


@pytest.mark.parametrize("cells", [BF.CELLS, 200])
def test_forest_equals_one_grown_row_by_row(spark, data, monkeypatch, cells):
    monkeypatch.setattr(BF, "CELLS", cells)  # few cells: several passes a level
    keys, x, y = data
    rows = _frame(spark, data, 3 if cells > 200 else 5)
    forest = BF.fit_balanced_forest(rows, 6, trees=3, depth=4, min_leaf=8, bins=8, seed=SEED)
    for t, tree in enumerate(forest.trees):
        nodes, weights = _plain_tree(keys, x, y, forest.cuts, t, 4, 8)
        got = [[int(f), int(b), int(c), int(r), [int(v) for v in k]] for f, b, c, r, k in zip(tree.feature, tree.bin, tree.left, tree.rows, tree.times)]
        assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in nodes]
        assert [g[2] for g in got if g[0] >= 0] == [w[2] for w in nodes if w[0] >= 0]
        assert tree.weights == pytest.approx(weights) and (tree.times[0] * tree.weights).tolist() == pytest.approx([tree.times[0].sum() / 2] * 2)
    scored = {r["id"]: r["score"] for r in BF.score_balanced_forest(rows, forest, 4).collect()}

    def plain_score(v):
        shares = []
        for tree in forest.trees:
            at = 0
            while tree.feature[at] >= 0:
                at = tree.left[at] + (v[tree.feature[at]] > forest.cuts[tree.feature[at]][tree.bin[at]])
            w = tree.times[at] * tree.weights
            shares.append(w[1] / w.sum())
        return np.mean(shares)

    assert [scored[k] for k in keys] == pytest.approx([plain_score(v) for v in x])
    importance = forest.importance()
    assert importance.sum() == pytest.approx(1) and importance.argmax() in (0, 2)
    assert np.mean([scored[k] for k, c in zip(keys, y) if c]) > 0.5 > np.mean([scored[k] for k, c in zip(keys, y) if not c])


def test_draws_are_poisson_and_independent_of_partitions(spark):
    rows = spark.range(20_000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    a, b = BF.draw_bases("id", SEED)
    drawn = rows.select("y", a.alias("a"), b.alias("b"))
    totals = [sorted(map(tuple, BF.sample_totals(drawn.repartition(n), 4).collect())) for n in (1, 7)]
    assert totals[0] == totals[1]
    for _, distinct, zero, one in totals[0]:
        assert distinct / 20_000 == pytest.approx(1 - math.exp(-1), abs=0.02)
        assert (zero + one) / 20_000 == pytest.approx(1, abs=0.03) and one / (zero + one) == pytest.approx(0.1, abs=0.01)


@pytest.mark.parametrize("labels", [[0] * 50, [1] * 50, []])
def test_forests_without_two_classes(spark, labels):
    rows = spark.createDataFrame([(str(i), c, [float(i), 1.0]) for i, c in enumerate(labels)], "id string, y int, x array<double>")
    forest = BF.fit_balanced_forest(rows, 2, trees=2, depth=3, min_leaf=2, seed=SEED)
    assert all(len(t.feature) == 1 for t in forest.trees)
    scores = [r["score"] for r in BF.score_balanced_forest(rows, forest).collect()]
    assert len(scores) == len(labels) and set(scores) <= {float(c) for c in labels}


def test_logistic_model_is_at_the_weighted_optimum(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from riskweave.models import baseline as B

    rng = np.random.default_rng(1)
    n = 600
    rows = []
    for i in range(n):
        numbers = rng.normal(size=len(K.NUMERIC_FEATURES)).round(3).tolist()
        label = int(numbers[0] + 0.5 * numbers[3] + rng.normal() > 1.8)
        rows.append((f"t{i}", label, ["USD", "EUR"][i % 2], ["ACH", "Wire", "Cash"][i % 3], *numbers))
    schema = "transaction_id string, is_laundering int, payment_currency string, payment_format string, " + ", ".join(f"{c} double" for c in K.NUMERIC_FEATURES)
    train = B.with_class_weight(spark.createDataFrame(rows, schema))
    model = Pipeline(stages=B.logistic_stages(n)).fit(train)
    out = model.transform(train).select(vector_to_array("features").alias("x"), "is_laundering", "class_weight").collect()
    x, y, w = np.array([r["x"] for r in out]), np.array([r["is_laundering"] for r in out]), np.array([r["class_weight"] for r in out])
    assert w[y == 1].sum() == pytest.approx(n / 2) and w[y == 0].sum() == pytest.approx(n / 2)
    fitted = model.stages[-1]
    beta, intercept = fitted.coefficients.toArray(), fitted.intercept
    # Newton's method on the same loss: weighted log loss plus |beta|^2 / 2, C = 1
    full = np.column_stack([x, np.ones(n)])
    ridge = np.diag([1.0] * x.shape[1] + [0.0])
    theta = np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-full @ theta))
        step = np.linalg.lstsq((full * (w * p * (1 - p))[:, None]).T @ full + ridge, full.T @ (w * (p - y)) + ridge @ theta, rcond=None)[0]
        theta = theta - step
    assert np.abs(step).max() < 1e-9
    assert beta == pytest.approx(theta[:-1], abs=2e-3) and intercept == pytest.approx(theta[-1], abs=2e-3)
