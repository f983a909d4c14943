"""Hard negatives of anchor vectors, by score bounds along a spanning tree of the anchors.

The score of a row for an anchor is their integer inner product.  An anchor's positives are the rows of
its label with the highest scores; its hard negatives for a positive are the highest rows of other labels
whose score lies in a window below the positive's score.

* Rows and anchors are packed in blocks of bounded size, components in the smallest whole type that holds
  them, and every block of rows meets every block of anchors in a join on the number of the block of rows:
  the anchors are a query set, and no table is whole in a task or in the driver.  Nothing is broadcast, as
  copies of the anchors grow with the blocks of rows and Spark's size check does not see them.
* The anchors of a block are linked by a minimum spanning tree.  Its root is scored against all rows of
  the block.  For a child c of p, Cauchy and Schwarz give |score(c, x) - score(p, x)| <= |c - p| * |x|, so
  the parent's score, or its bounds, widened by edge length times norm, bound the child's.
* Only rows whose bounds overlap what is wanted are scored again: for positives those that may reach the
  highest lower bounds, for negatives those that may lie in a window among its highest.  Bounds carry a
  margin for rounding; the scores themselves are exact.
* Each pair of blocks returns at most the wanted number of rows an anchor; a ranking keeps the best.

Rows take part if id, label, vector and all its components are there.  Of several rows with one id the
smallest by label, then vector counts.  Shorter vectors end in zeros.  Ties go to the smaller id.  An
anchor without other rows of its label returns nothing; an empty table returns no rows.  Scores must stay
below 2^63 (an error otherwise).  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import staged

ROWS, ANCHORS = 8192, 4096  # in a block
CELLS = 4_000_000  # bounds of anchors x rows held at once

_ROW_BLOCK = "rb int, ids binary, labels binary, vectors binary, width int"
_ANCHOR_BLOCK = "ab int, a_ids binary, a_labels binary, a_vectors binary, a_width int, parent binary, edge binary, targets binary"


def usable_rows(vectors: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(``_id``, ``_label``, ``_v``) of the rows that take part, one per id."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"),
        F.col(vector_col).cast("array<long>").alias("_v"),
    )
    whole = F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.col("_v").isNotNull() & F.forall("_v", lambda x: x.isNotNull())
    best = rows.filter(whole).groupBy("_id").agg(F.min(F.struct("_label", "_v")).alias("_r"))
    return best.select("_id", "_r._label", "_r._v")


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree: parents come first; the root has parent -1.

    ``parent`` and ``edge`` are by place in the order.
    """
    k = len(points)
    x = points.astype(np.float64)
    square = (x * x).sum(axis=1)
    nearest, via = np.full(k, np.inf), np.full(k, -1)
    inside = np.zeros(k, dtype=bool)
    order, parent = np.zeros(k, dtype=np.int64), np.full(k, -1, dtype=np.int64)
    place = np.zeros(k, dtype=np.int64)
    now = 0
    for t in range(k):
        order[t], inside[now], place[now] = now, True, t
        parent[t] = place[via[now]] if via[now] >= 0 else -1
        distance = np.maximum(square + square[now] - 2 * (x @ x[now]), 0)
        closer = ~inside & (distance < nearest)
        nearest[closer], via[closer] = distance[closer], now
        now = int(np.argmin(np.where(inside, np.inf, nearest)))
    gap = x[order] - x[order][np.maximum(parent, 0)]
    edge = np.where(parent < 0, 0.0, np.sqrt((gap * gap).sum(axis=1)))
    return order, parent, edge


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Rows x components; shorter rows end in zeros."""
    lists = vectors.combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0))), dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _small(x: np.ndarray) -> bytes:
    """The numbers in the smallest whole type that holds them all."""
    low, high = x.min(initial=0), x.max(initial=0)
    fits = (t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return x.astype(next(fits)).tobytes()


def _packed_rows(group: pa.Table) -> pa.Table:
    group = group.sort_by("_id")
    x = _matrix(group.column("_v"))
    return pa.table({
        "rb": pa.array([group.column("_block")[0].as_py()], pa.int32()),
        "ids": pa.array([group.column("_id").to_numpy().tobytes()], pa.binary()),
        "labels": pa.array([group.column("_label").to_numpy().tobytes()], pa.binary()),
        "vectors": pa.array([_small(x)], pa.binary()),
        "width": pa.array([x.shape[1]], pa.int32()),
    })


def _packed_anchors(wanted: int) -> Callable[[pa.Table], pa.Table]:
    """Packs anchors in tree order; ``targets`` are up to ``wanted`` (id, score) of positives each, id -1 where there is none."""

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("_id")
        x = _matrix(group.column("_v"))
        order, parent, edge = spanning_tree(x)
        targets = np.full((len(x), wanted, 3), -1, dtype=np.int64)  # used, id, score
        if "_targets" in group.column_names:
            for i, own in enumerate(group.column("_targets").to_pylist()):
                for j, p in enumerate(own):
                    targets[i, j] = 1, p["positive_id"], p["positive_score"]
        return pa.table({
            "ab": pa.array([group.column("_block")[0].as_py()], pa.int32()),
            "a_ids": pa.array([group.column("_id").to_numpy()[order].tobytes()], pa.binary()),
            "a_labels": pa.array([group.column("_label").to_numpy()[order].tobytes()], pa.binary()),
            "a_vectors": pa.array([_small(x[order])], pa.binary()),
            "a_width": pa.array([x.shape[1]], pa.int32()),
            "parent": pa.array([parent.tobytes()], pa.binary()),
            "edge": pa.array([edge.tobytes()], pa.binary()),
            "targets": pa.array([targets[order].tobytes()], pa.binary()),
        })

    return pack


def _blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows with the number of their block of about ``size`` rows, and the number of blocks."""
    n = max(1, -(-rows.count() // size))
    return rows.withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int")), n


def _pairs(rows: DataFrame, row_blocks: int, anchors: DataFrame, anchor_blocks: int) -> DataFrame:
    """Every block of rows with every block of anchors.

    Anchors are copied for each block of rows; a block of rows is copied only where there are too few for the
    tasks, once for each share of the anchor blocks.  Both sides are shuffled and merged: Spark's size check
    counts neither the copies nor what a cell holds, and would send the anchors' copies through the driver.
    """
    tasks = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = min(anchor_blocks, -(-tasks // row_blocks))
    tasks = min(tasks, 4 * row_blocks * shares)
    left = anchors.withColumn("share", F.pmod("ab", F.lit(shares))).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    right = rows.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    left, right = (side.repartition(tasks, "rb", "share") for side in (left, right))
    return left.join(right.hint("merge"), ["rb", "share"])


def _int64(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), dtype=np.int64)


def _whole(cell: pa.Scalar, rows: int, width: int) -> np.ndarray:
    """The matrix of :func:`_small`."""
    data = cell.as_buffer()
    return np.frombuffer(data, dtype=f"i{data.size // max(rows * width, 1) or 8}").reshape(rows, width).astype(np.int64)


def _numbers(x: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices, padded to one width, in the fastest type in which their products are exact."""
    width = max(x.shape[1], a.shape[1])
    x, a = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, a))
    size = [np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)).max(initial=0) for m in (x, a)]
    if size[0] * size[1] >= 2.0**62:
        raise ValueError("scores beyond 64 bits")
    return (x.astype(np.float64), a.astype(np.float64)) if size[0] * size[1] < 2.0**53 else (x, a)


Wanted = Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def bounded_scores(
    x: np.ndarray, a: np.ndarray, parent: np.ndarray, edge: np.ndarray, wanted: Wanted
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores): exact scores of the rows whose bounds ``wanted`` names, anchor by anchor.

    ``wanted(anchor, rows, low, high)`` gets the rows of a slice and their bounds and returns the
    places in the slice to score.  ``a`` is in tree order, parents first.
    """
    x, a = _numbers(x, a)
    # rounding of norms, edges and scores beyond 2^53 is far below these margins
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
    step = max(256, CELLS // max(len(a), 1))
    for begin in range(0, len(x), step):
        part, size = x[begin : begin + step], norm[begin : begin + step]
        rows = np.arange(begin, begin + len(part))
        low, high = np.empty((len(a), len(part))), np.empty((len(a), len(part)))
        for c in range(len(a)):
            if parent[c] < 0:
                exact = part @ a[c]
                low[c], high[c] = _around(exact)
                chosen = wanted(c, rows, low[c], high[c])
                yield c, rows[chosen], exact[chosen].astype(np.int64)
                continue
            reach = edge[c] * (1 + 1e-9) * size + 1e-6
            low[c], high[c] = low[parent[c]] - reach, high[parent[c]] + reach
            chosen = wanted(c, rows, low[c], high[c])
            exact = part[chosen] @ a[c]
            low[c, chosen], high[c, chosen] = _around(exact)
            yield c, rows[chosen], exact.astype(np.int64)


def _around(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if exact.dtype == np.float64:
        return exact, exact
    near = exact.astype(np.float64)
    return near - np.abs(near) * 1e-15, near + np.abs(near) * 1e-15


def _kth_highest(values: np.ndarray, k: int) -> float:
    return -np.inf if len(values) < k else float(np.partition(values, len(values) - k)[len(values) - k])


def _found(columns: dict[str, list[np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    whole = [np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for v in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array(v, t.type) for v, t in zip(whole, schema)], schema=schema)


def _pair_task(pick: Callable[..., Iterator[tuple]], names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs ``pick`` on every pair of blocks; it yields arrays for the columns ``names``."""
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cell = {n: batch.column(n)[i] for n in batch.schema.names}
                ids, a_ids = _int64(cell["ids"]), _int64(cell["a_ids"])
                x = _whole(cell["vectors"], len(ids), cell["width"].as_py())
                a = _whole(cell["a_vectors"], len(a_ids), cell["a_width"].as_py())
                out: dict[str, list[np.ndarray]] = {n: [] for n in names}
                for found in pick(
                    ids, _int64(cell["labels"]), x, a_ids, _int64(cell["a_labels"]), a, _int64(cell["parent"]),
                    np.frombuffer(cell["edge"].as_buffer()), _int64(cell["targets"]).reshape(len(a_ids), -1, 3),
                ):
                    for n, values in zip(names, found):
                        out[n].append(values)
                yield _found(out, schema)

    return run


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _picked_positives(k: int) -> Callable[..., Iterator[tuple]]:
    def pick(ids, labels, x, a_ids, a_labels, a, parent, edge, targets):
        def wanted(c: int, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            own = np.flatnonzero((labels[rows] == a_labels[c]) & (ids[rows] != a_ids[c]))
            return own[high[own] >= _kth_highest(low[own], k)]

        for c, rows, scores in bounded_scores(x, a, parent, edge, wanted):
            top = _best(ids[rows], scores, k)
            yield np.full(len(top), a_ids[c]), ids[rows[top]], scores[top]

    return pick


def _picked_negatives(k: int, least: int, most: int) -> Callable[..., Iterator[tuple]]:
    def pick(ids, labels, x, a_ids, a_labels, a, parent, edge, targets):
        def wanted(c: int, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            other = labels[rows] != a_labels[c]
            chosen = np.zeros(len(rows), dtype=bool)
            for used, _, score in targets[c].tolist():
                if used > 0:
                    bottom, top = least * score / 100, most * score / 100
                    margin = 1e-9 * abs(score) + 1e-6
                    reaches = other & (low <= top + margin)
                    sure = low[reaches & (low >= bottom + margin) & (high <= top - margin)]
                    chosen |= reaches & (high >= max(bottom - margin, _kth_highest(sure, k)))
            return np.flatnonzero(chosen)

        for c, rows, scores in bounded_scores(x, a, parent, edge, wanted):
            for used, positive, score in targets[c].tolist():
                if used > 0:
                    inside = np.flatnonzero((scores >= -(-least * score // 100)) & (scores <= most * score // 100))
                    top = inside[_best(ids[rows[inside]], scores[inside], k)]
                    size = len(top)
                    yield np.full(size, a_ids[c]), np.full(size, positive), np.full(size, score), ids[rows[top]], scores[top]

    return pick


def _highest(found: DataFrame, of: list[str], score: str, other: str, k: int) -> DataFrame:
    """The first ``k`` rows of each ``of`` by score, then id, with their ``rank``."""
    order = Window.partitionBy(*of).orderBy(F.desc(score), F.asc(other))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has whole numbers as components; ``is_anchor`` is a condition on ``_id``, the id.  For each
    of an anchor's first ``positives`` rows of its label: the first ``negatives`` rows of other labels with
    ``least`` % to ``most`` % of the positive's score.
    """
    rows = staged(usable_rows(vectors, id_col, label_col, vector_col), "vectors")
    blocked, row_blocks = _blocks(rows, ROWS)
    packed = staged(blocked.groupBy("_block").applyInArrow(_packed_rows, _ROW_BLOCK), "vector-blocks")
    chosen, anchor_blocks = _blocks(rows.filter(is_anchor), ANCHORS)
    anchors = chosen.groupBy("_block").applyInArrow(_packed_anchors(positives), _ANCHOR_BLOCK)
    names = ["anchor_id", "positive_id", "positive_score"]
    near = _pairs(packed, row_blocks, anchors, anchor_blocks).mapInArrow(
        _pair_task(_picked_positives(positives), names), ", ".join(f"{n} long" for n in names)
    )
    best = staged(_highest(near, ["anchor_id"], "positive_score", "positive_id", positives), "positives")
    targets = best.groupBy(F.col("anchor_id").alias("_id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("_targets")
    )
    asking = chosen.join(targets.hint("merge"), "_id").groupBy("_block").applyInArrow(_packed_anchors(positives), _ANCHOR_BLOCK)
    names = [*names, "negative_id", "negative_score"]
    hard = _pairs(packed, row_blocks, asking, anchor_blocks).mapInArrow(
        _pair_task(_picked_negatives(negatives, least, most), names), ", ".join(f"{n} long" for n in names)
    )
    ranked = _highest(hard, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
