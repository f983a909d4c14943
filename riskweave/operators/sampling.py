"""Exact-size, reproducible samples and splits ordered by a hash of a unique id."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave import constants as K
from riskweave.functions import rules

_BUCKET_CHARS = 4  # 65,536 hash buckets a level
_EDGE_ROWS = 100_000  # a bucket of more rows is cut by the next digits of the hash
_ALL = 1 << 62  # a quota no stratum reaches


def hash_order(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def _edge_buckets(keyed: DataFrame, ranks: dict) -> dict:
    """(hash prefix, rank inside it) of the bucket that holds the ``ranks[s]``-th row of stratum ``_s``.

    A histogram over the leading hash digits finds the bucket; while it has more than
    :data:`_EDGE_ROWS` rows, the next digits are counted inside it.  Strata with fewer rows
    than their rank are left out.  ``ranks`` holds a handful of strata, of which one row each
    is collected.
    """
    found, unsettled, length = {}, {s: ("", r) for s, r in ranks.items()}, 0
    while unsettled:
        length += _BUCKET_CHARS
        inside = reduce(Column.__or__, [(F.col("_s") == s) & F.col("_h").startswith(p) for s, (p, _) in unsettled.items()])
        bucket = F.substring("_h", 1, length)
        counts = keyed.filter(inside).groupBy("_s", bucket.alias("_b")).agg(F.count("*").alias("_n"))
        earlier = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        rank = F.create_map(*[F.lit(x) for s, (_, r) in unsettled.items() for x in (s, r)])[F.col("_s")]
        before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
        cuts = (
            counts.select("_s", "_b", "_n", before.alias("_before"), rank.alias("_r"))
            .filter((F.col("_before") < F.col("_r")) & (F.col("_r") <= F.col("_before") + F.col("_n")))
            .collect()
        )
        unsettled = {}
        for c in cuts:
            edge = (c["_b"], c["_r"] - c["_before"])
            whole = length >= 32 or c["_n"] <= _EDGE_ROWS
            (found if whole else unsettled)[c["_s"]] = edge
    return found


def first_by_hash(
    df: DataFrame, quotas: dict, stratum: Column, id_col: str, seed: int
) -> DataFrame:
    """The ``quotas[s]`` rows of each stratum ``s`` with the smallest id hash.

    :func:`_edge_buckets` finds, per stratum, the one bucket in which the quota runs out.
    Rows of earlier buckets pass with a plain filter; only that single small bucket is
    ranked.  No full sort, no big top-k merge.
    """
    keyed = df.withColumn("_s", stratum).withColumn("_h", hash_order(id_col, seed))
    wanted = {s: q for s, q in quotas.items() if q > 0}
    cut = _edge_buckets(keyed, {s: q for s, q in wanted.items() if q < _ALL})
    s = F.col("_s")
    sure, edge = F.lit(False), F.lit(False)
    need = F.lit(0)
    for key in wanted:
        if key not in cut:  # the quota exceeds the stratum
            sure = sure | (s == F.lit(key))
            continue
        prefix, rest = cut[key]
        bucket = F.substring("_h", 1, len(prefix))
        sure = sure | ((s == F.lit(key)) & (bucket < F.lit(prefix)))
        edge = edge | ((s == F.lit(key)) & (bucket == F.lit(prefix)))
        need = F.when(s == F.lit(key), F.lit(rest)).otherwise(need)
    picked = keyed.filter(sure)
    if cut:
        order = Window.partitionBy("_s").orderBy("_h", id_col)
        ranked = keyed.filter(edge).withColumn("_rn", F.row_number().over(order))
        picked = picked.unionByName(ranked.filter(F.col("_rn") <= need).drop("_rn"))
    return picked.drop("_s", "_h")


def head_sample(
    df: DataFrame, n: int, order: list[str], strict: bool = False, fraction: float = 0.001
) -> DataFrame:
    """First ``n`` rows in a total order; ``strict`` fails when there are fewer.

    A plain sort-and-limit keeps ``n`` rows per task and merges them all in one.  So a key
    a little past the ``n``-th is guessed from a sample and checked by a count; only rows up
    to that key are then sorted.  With one order column that filter also reaches the scan.
    A wrong guess (always so for a table of a few thousand rows) falls back to the plain form.
    """
    near = df
    k = int(1.5 * n * fraction) + 20
    keys = df.select(*order).sample(fraction, seed=1).orderBy(*order).limit(k)
    seen, last = keys.agg(F.count("*"), F.max(F.struct(*order))).first()
    if seen == k:
        head = df.filter(_up_to(df, order, last))
        near = head if head.count() >= n else df
    out = near.orderBy(*order).limit(n)
    if strict and out.count() < n:
        raise ValueError(f"expected at least {n} rows")
    return out


def undersample(
    df: DataFrame, negatives: int = K.NEGATIVE_SAMPLE_ROWS, seed: int = K.FEATURE_SEED,
    label: str = "is_laundering", id_col: str = "transaction_id",
) -> DataFrame:
    """Every positive plus exactly ``min(negatives, available)`` negatives."""
    return first_by_hash(df, {1: _ALL, 0: negatives}, F.col(label), id_col, seed)


def class_quotas(sizes: dict[int, int], share: float) -> dict[int, int]:
    """Test rows per class: ``ceil(share n)`` in total, by largest remainder."""
    total = math.ceil(share * sum(sizes.values()))
    exact = {c: share * n for c, n in sizes.items()}
    quotas = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(sizes, key=lambda c: (quotas[c] - exact[c], c))
    for c in by_remainder[: total - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def stratified_split(
    df: DataFrame, share: float = 0.25, seed: int = K.FEATURE_SEED,
    label: str = "is_laundering", id_col: str = "transaction_id",
) -> DataFrame:
    """Add ``split``: per class about ``share`` of the rows are ``test``, the rest ``train``."""
    sizes = {r[0]: r[1] for r in df.groupBy(label).agg(F.count("*")).collect()}
    quotas = class_quotas(sizes, share)
    base = df.drop("split")
    keyed = base.withColumn("_s", F.col(label)).withColumn("_h", hash_order(id_col, seed))
    bounds = _nth_hashes(keyed, {c: q for c, q in quotas.items() if q > 0}, id_col)
    tests = [(F.col("_s") == c) & _up_to(keyed, ["_h", id_col], bound) for c, bound in bounds.items()]
    is_test = reduce(Column.__or__, tests, F.lit(False))
    return keyed.withColumn("split", F.when(is_test, "test").otherwise("train")).drop("_s", "_h")


def _up_to(df: DataFrame, columns: list[str], bound) -> Column:
    """Rows whose ``columns``, compared left to right, are not past ``bound``."""
    marks = [F.lit(x).cast(df.schema[c].dataType) for c, x in zip(columns, bound)]
    if len(columns) == 1:
        return F.col(columns[0]) <= marks[0]
    return F.struct(*columns) <= F.struct(*[m.alias(c) for c, m in zip(columns, marks)])


def _nth_hashes(keyed: DataFrame, ranks: dict, id_col: str) -> dict:
    """(hash, id) of the ``ranks[s]``-th smallest hash per stratum ``_s``; only edge buckets are ordered."""
    cut = _edge_buckets(keyed, ranks) if ranks else {}
    if not cut:
        return {}
    s = F.col("_s")
    at = reduce(Column.__or__, [(s == k) & F.col("_h").startswith(p) for k, (p, _) in cut.items()])
    hit = reduce(Column.__or__, [(s == k) & (F.col("_rn") == r) for k, (_, r) in cut.items()])
    position = F.row_number().over(Window.partitionBy("_s").orderBy("_h", id_col))
    rows = (
        keyed.filter(at).select("_s", "_h", F.col(id_col).alias("_i"), position.alias("_rn"))
        .filter(hit).collect()
    )
    return {r["_s"]: (r["_h"], r["_i"]) for r in rows}


def use_or_make_split(
    df: DataFrame, share: float = 0.25, seed: int = K.FEATURE_SEED, label: str = "is_laundering",
) -> tuple[DataFrame, str]:
    """Keep a stored split when both sides hold both classes, else make one."""
    if "split" in df.columns:
        seen = df.agg(
            *[
                F.count_distinct(F.when(F.col("split") == side, F.col(label))).alias(side)
                for side in ("train", "test")
            ]
        ).first()
        if seen["train"] == 2 and seen["test"] == 2:
            return df.filter(F.col("split").isin("train", "test")), "stratified_random_75_25"
    return stratified_split(df, share, seed, label), "stratified_random_fallback_75_25"


def tiered_sample(
    df: DataFrame, rows: int = 10_000, share: float = 0.8, positives: int = 200,
    seed: int = K.TIER_SEED, label: str = "is_laundering", id_col: str = "transaction_id",
) -> DataFrame:
    """Positives first, then rule candidates up to ``share``, then the rest, then a fill.

    A row's tier follows from its label, its candidate score and whether its hash is
    among the first ``positives`` positives.  Once tier 3 is used up, the fill can only
    come from unpicked candidates, so it just raises their quota: no anti-joins.
    The result keeps ``_candidate_score`` and ``_tier``.
    """
    scored = df.withColumn("_candidate_score", rules.contract_raw_score())
    keyed = scored.withColumn("_h", hash_order(id_col, seed))
    n, n_pos = keyed.agg(F.count("*"), F.count_if(F.col(label) == 1)).first()
    target = min(rows, n)
    q_pos = min(positives, target, n_pos)
    chosen = F.lit(False)
    if q_pos:
        bounds = _nth_hashes(keyed.withColumn("_s", F.col(label)), {1: q_pos}, id_col)
        chosen = (F.col(label) == 1) & _up_to(keyed, ["_h", id_col], bounds[1])
    tier = (
        F.when(chosen, 1).when(F.col("_candidate_score") >= K.SCORE_FLOOR, 2).otherwise(3)
    )
    sizes = {r[0]: r[1] for r in keyed.groupBy(tier).agg(F.count("*")).collect()}
    q_cand = min(int(target * share), target - q_pos, sizes.get(2, 0))
    q_rest = min(target - q_pos - q_cand, sizes.get(3, 0))
    q_cand += target - q_pos - q_cand - q_rest
    quotas = {1: q_pos, 2: q_cand, 3: q_rest}
    tiers = keyed.withColumn("_tier", tier).drop("_h")
    return first_by_hash(tiers, quotas, F.col("_tier"), id_col, seed)


def anomaly_sample(
    df: DataFrame, size: int = K.ANOMALY_SAMPLE_ROWS, seed: int = K.ANOMALY_SEED,
    label: str = "is_laundering", id_col: str = "transaction_id",
) -> DataFrame:
    """All positives plus negatives up to ``size``; re-cut when positives alone exceed it."""
    n_pos = df.filter(F.col(label) == 1).count()
    if n_pos > size:
        pool = df.filter(F.col(label) == 1)
        return first_by_hash(pool, {1: size}, F.lit(1), id_col, seed)
    return undersample(df, size - n_pos, seed, label, id_col)
