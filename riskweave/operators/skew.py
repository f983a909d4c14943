"""Joins that stay balanced when single keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweave.session import staged

HOT_SHARE = 0.005  # a key with more than this share of the rows is joined by broadcast


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys holding more than ``share`` of all rows: at most ``1 / share`` of them."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.count()
    rows = counts.filter((F.col("n") > share * total) & F.col(key).isNotNull()).collect()
    return [r[0] for r in rows]


def join_unique(
    left: DataFrame, right: DataFrame, key: str, how: str = "left", hot: list | None = None
) -> DataFrame:
    """Join to a side that is unique per ``key``.

    Rows of hot keys meet at most ``1 / HOT_SHARE`` right rows, a proven bound, so that
    part is a broadcast join without a shuffle; the rest joins as Spark chooses.  Both parts
    read the right side from one stored table.
    """
    hot = hot_keys(left, key) if hot is None else hot
    if not hot:
        return left.join(right, key, how)
    right = staged(right, "join-side")
    is_hot = F.col(key).isin(*hot)
    spread = left.filter(is_hot | F.col(key).isNull()).join(
        F.broadcast(right.filter(is_hot)), key, how
    )
    usual = left.filter(~is_hot).join(right.filter(~is_hot), key, how)
    return spread.unionByName(usual)
