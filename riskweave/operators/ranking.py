"""Global order without a one-task window: range partitions plus per-partition offsets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.constants import LARGE_QUANTILE
from riskweave.session import staged

_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in its lower 33 bits


def _range_sorted(df: DataFrame, order: list[Column], parts: int | None) -> DataFrame:
    """Write ``df`` range-partitioned and sorted; ``_slot`` = partition << 33 | row index.

    The written table fixes the partition ids, so the count pass and the row pass agree
    even when an executor is lost in between, and the lineage is cut.
    """
    # without a number, adaptive execution merges small neighbouring ranges
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    slots = ranged.sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id())
    return staged(slots, "ordered").withColumn("_part", F.shiftright("_slot", _ROW_BITS))


def _before(total: str, order: list[str]) -> Column:
    """Sum of ``total`` over all earlier rows of a table with one row per partition."""
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(w), F.lit(0))


def global_row_number(
    df: DataFrame, order: list[Column], name: str = "row_number", parts: int | None = None
) -> DataFrame:
    """1-based position of every row in a total order, computed in parallel.

    The only single-task window runs over one row per range partition.
    """
    staged = _range_sorted(df, order, parts)
    sizes = staged.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", _before("_n", ["_part"]).alias("_start"))
    index = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one row per partition: a few thousand at most
    return (
        staged.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + index + 1)
        .drop("_part", "_slot", "_start")
    )


def running_totals(
    df: DataFrame, order: list[Column], sums: dict[str, str], parts: int | None = None
) -> DataFrame:
    """Inclusive running totals over a global order: ``sums`` maps new name -> column."""
    staged = _range_sorted(df, order, parts)
    per_part = staged.groupBy("_part").agg(
        *[F.sum(c).alias(f"_t_{name}") for name, c in sums.items()]
    )
    starts = per_part.select(
        "_part", *[_before(f"_t_{name}", ["_part"]).alias(f"_b_{name}") for name in sums]
    )
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = staged.select(
        "*", *[F.sum(c).over(inside).alias(f"_w_{name}") for name, c in sums.items()]
    )
    joined = local.join(F.broadcast(starts), "_part")
    for name in sums:
        joined = joined.withColumn(name, F.col(f"_w_{name}") + F.col(f"_b_{name}"))
    return joined.drop(
        "_part", "_slot", *[f"{p}{name}" for name in sums for p in ("_w_", "_b_")]
    )


_ACCURACY = 100_000


def exact_quantile(df: DataFrame, col: str, q: float = LARGE_QUANTILE) -> float:
    """Exact quantile with linear interpolation at ``(n - 1) q``; empty input gives 0.0."""
    return exact_quantiles(df, col, [q])[0]


def exact_quantiles(df: DataFrame, col: str, qs: list[float]) -> list[float]:
    """Exact quantiles of one column without sorting or collecting it.

    One pass counts and one sketches a bracket around each rank, the next counts the rows
    below, on and between the bracket ends, and only the rows strictly inside a bracket (a few
    hundred-thousandths of the table) are sorted, in parallel.  The plan is the same at every size.
    """
    v = F.col("v")
    values = df.select(F.col(col).cast("double").alias("v")).filter(v.isNotNull())
    qs = [min(1.0, max(0.0, q)) for q in qs]
    n, low, high = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not n:
        return [0.0] * len(qs)
    # 0-based ranks around (n - 1) q, with the weight of the upper one
    spots = [(n - 1) * q for q in qs]
    found: dict[int, float] = {0: float(low), n - 1: float(high)}
    wanted = [[r for r in {int(p), min(int(p) + 1, n - 1)} if r not in found] for p in spots]
    reach = 2.0 / _ACCURACY + 2.0 / n  # the sketch's error, and the neighbouring rank
    marks = [min(1.0, max(0.0, q + side)) for q in qs for side in (-reach, reach)]
    ends = values.agg(F.percentile_approx("v", marks, _ACCURACY)).first()[0]
    brackets = [(ends[2 * i], ends[2 * i + 1]) for i in range(len(qs))]
    tests = []
    for lo, hi in brackets:
        tests += [v < lo, v == lo, (v > lo) & (v < hi), (v == hi) & F.lit(hi > lo)]
    counts = values.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests)]).first()
    for i, ((lo, hi), ranks) in enumerate(zip(brackets, wanted)):
        below, at_lo, inside, at_hi = counts[4 * i: 4 * i + 4]
        first, last = below + at_lo, below + at_lo + inside
        found |= {r: lo for r in ranks if below <= r < first}
        found |= {r: hi for r in ranks if last <= r < last + at_hi}
        rest = [r for r in ranks if r not in found]
        if all(first <= r < last for r in rest):
            found |= _values_at(values.filter((v > lo) & (v < hi)), first, rest)
        else:  # the sketch missed: rank the whole column instead
            found |= _values_at(values, 0, rest)
    out = []
    for p in spots:
        k, weight = int(p), p - int(p)
        upper = found[min(k + 1, n - 1)]
        out.append(found[k] if weight == 0 else found[k] * (1 - weight) + upper * weight)
    return out


def _values_at(values: DataFrame, offset: int, ranks: list[int]) -> dict[int, float]:
    """Values at the given 0-based ranks, where ``values`` starts at rank ``offset``."""
    if not ranks:
        return {}
    counted = running_totals(values.groupBy("v").agg(F.count("*").alias("n")), [F.col("v")], {"upto": "n"})
    upto, start = F.col("upto") + offset, F.col("upto") - F.col("n") + offset
    hits = reduce(Column.__or__, [(start <= r) & (upto > r) for r in ranks])
    rows = counted.filter(hits).select("v", start.alias("a"), upto.alias("b")).collect()
    return {r: float(row["v"]) for r in ranks for row in rows if row["a"] <= r < row["b"]}


def score_deciles(
    df: DataFrame, score: str = "anomaly_score", label: str = "is_laundering",
    id_col: str = "transaction_id",
) -> DataFrame:
    """Rows, positives, rate and score range per tenth of the score ranks.

    Ties in the score are ordered by id.  Rank ``r`` of ``n`` falls in bin
    ``ceil(10 (r - 1) / (n - 1))`` with the lowest rank in bin 1.
    """
    slim = df.select(F.col(score).alias("s"), F.col(label).alias("y"), F.col(id_col).alias("i"))
    ranked = global_row_number(slim, [F.col("s"), F.col("i")], "r")
    n = ranked.count()
    spread = F.lit(max(n - 1, 1))
    decile = F.greatest(F.lit(1), F.ceil((F.col("r") - 1) * 10 / spread)).cast("int")
    return (
        ranked.groupBy(decile.alias("score_decile"))
        .agg(
            F.count("*").alias("rows"),
            F.sum(F.col("y").cast("long")).alias("positive_rows"),
            F.round(F.sum(F.col("y").cast("long")) / F.count("*"), 8).alias("positive_rate"),
            F.min("s").alias("min_score"),
            F.max("s").alias("max_score"),
        )
        .orderBy(F.desc("score_decile"))
    )


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key (last write wins); null orders come last.

    The greatest first order column per key is a hash aggregation of two narrow columns with
    map-side combine.  Rows that reach it are kept by a semi join, whose skewed side Spark splits
    and whose form it chooses by measured partition sizes; only these few are compared as whole rows.
    """
    keys = [key] if isinstance(key, str) else key
    first = order[0]
    newest = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max(first).alias("_o"))
    same = [df[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    reached = df.join(newest, reduce(Column.__and__, same) & df[first].eqNullSafe(F.col("_o")), "left_semi")
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return reached.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*df.columns)


def best_model(metrics: DataFrame, by: str = "pr_auc") -> DataFrame:
    """The metrics row with the greatest ``by``."""
    return metrics.agg(F.max_by(F.struct(*metrics.columns), by).alias("b")).select("b.*")
