"""Coverage, feature joins, alignment and expectation joins (all equi-joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweave.functions import columns as C
from riskweave.operators.profiling import distinct_values
from riskweave.operators.skew import join_unique

ACCOUNT_FEATURES = [
    "total_event_count", "debit_count", "credit_count", "out_amount", "in_amount",
    "max_out_amount", "counterparty_count", "cross_bank_event_count",
    "cross_currency_event_count",
]
FEATURE_DEFAULTS = {
    f"from_{c}": 0.0 if c.endswith("amount") else 0 for c in ACCOUNT_FEATURES
}


def account_coverage(dwd: DataFrame, accounts: DataFrame) -> DataFrame:
    """One wide row: transactions, rows whose from / to account is unknown, match rates.

    Rows are counted per account before the anti join, so the join sees each account once
    and no key is heavy; the join reuses the partitioning of the count.
    """
    sides = F.array(
        F.struct(F.col("from_account").alias("account_number"), F.lit(1).alias("is_from")),
        F.struct(F.col("to_account").alias("account_number"), F.lit(0).alias("is_from")),
    )
    per_account = dwd.select(F.inline(sides)).groupBy("account_number").agg(
        F.sum("is_from").alias("from_rows"),
        F.sum(1 - F.col("is_from")).alias("to_rows"),
    )
    missing = per_account.join(accounts.select("account_number"), "account_number", "left_anti")
    n_from = F.coalesce(F.sum("from_rows"), F.lit(0))
    n_to = F.coalesce(F.sum("to_rows"), F.lit(0))
    total = dwd.agg(F.count("*")).scalar()
    out = missing.agg(
        n_from.alias("from_account_missing_count"), n_to.alias("to_account_missing_count")
    ).withColumn("transaction_row_count", total)
    rows = F.col("transaction_row_count")
    for side in ("from", "to"):
        matched = F.when(
            rows > 0, F.lit(1.0) - F.col(f"{side}_account_missing_count") / rows
        ).otherwise(F.lit(0.0))
        out = out.withColumn(f"{side}_account_match_rate", matched)
    return out


def missing_account_examples(dwd: DataFrame, accounts: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` (side, account, transaction_id) with an unknown account, in id order.

    The unknown accounts are found on distinct accounts first.  They are few as a rule, so
    the detail rows then meet a small set, which Spark broadcasts at run time.
    """
    known = accounts.select("account_number")
    unknown = distinct_values(dwd, "from_account", "to_account").select(
        F.col("value").alias("account_number")
    ).join(known, "account_number", "left_anti")
    sides = F.array(
        F.struct(F.lit("from").alias("side"), F.col("from_account").alias("account_number")),
        F.struct(F.lit("to").alias("side"), F.col("to_account").alias("account_number")),
    )
    return (
        dwd.select("transaction_id", F.inline(sides))
        .join(unknown, "account_number", "left_semi")
        .select("side", F.col("account_number").alias("account"), "transaction_id")
        .orderBy("transaction_id", "side").limit(n)
    )


def join_account_features(
    tx: DataFrame, features: DataFrame, hot: list | None = None
) -> DataFrame:
    """LEFT join on the paying account; feature columns get the prefix ``from_``."""
    right = features.select(
        F.col("account_number").alias("from_account"),
        *[F.col(c).alias(f"from_{c}") for c in ACCOUNT_FEATURES],
    )
    return join_unique(tx, right, "from_account", "left", hot)


def fill_feature_defaults(df: DataFrame) -> DataFrame:
    return df.fillna(FEATURE_DEFAULTS)


def derive_features(df: DataFrame) -> DataFrame:
    """Amount, hour and ratio features from joined and filled columns."""
    angle = C.hour_angle("transaction_hour")
    return df.withColumns({
        "log_amount_paid": C.log_amount("amount_paid"),
        "hour_sin": F.sin(angle),
        "hour_cos": F.cos(angle),
        "from_out_in_ratio": C.damped_ratio("from_out_amount", "from_in_amount"),
        "from_debit_credit_ratio": C.damped_ratio("from_debit_count", "from_credit_count"),
    })


def join_features_tx(features: DataFrame, tx: DataFrame) -> DataFrame:
    """INNER join of feature rows to their transaction's time and accounts."""
    slim = tx.select("transaction_id", "timestamp", "from_account", "to_account")
    return features.join(slim, "transaction_id", "inner")


def rederive_features(stored: DataFrame, dwd: DataFrame, accounts: DataFrame) -> DataFrame:
    """The feature columns again from the warehouse, for the ids of a stored feature set."""
    from riskweave.constants import FEATURE_COLUMNS

    tx = dwd.select(
        "transaction_id", "transaction_date", "transaction_hour", "from_account", "amount_paid",
        "payment_currency", "payment_format", "is_cross_bank", "is_cross_currency",
        "is_laundering",
    )
    kept = stored.select("transaction_id", "split").join(tx, "transaction_id", "inner")
    joined = fill_feature_defaults(join_account_features(kept, accounts))
    return derive_features(joined).select(*FEATURE_COLUMNS)


def align_for_parity(
    left: DataFrame, right: DataFrame, key: str, columns: list[str]
) -> DataFrame:
    """INNER self-alignment: columns ``p_x`` and ``w_x`` for each x."""
    p = left.select(key, *[F.col(c).alias(f"p_{c}") for c in columns])
    w = right.select(key, *[F.col(c).alias(f"w_{c}") for c in columns])
    return p.join(w, key, "inner")


def state_consistency(cache: DataFrame, durable: DataFrame, n: int | None = None) -> DataFrame:
    """Per account: score and level equal as text in both stores, durable score present.

    Both sides have one row per account; ``n`` limits the check to the first accounts.
    """
    left = cache.select(
        "event_account", F.col("risk_score").cast("string").alias("cache_score"),
        F.col("risk_level").alias("cache_level"),
    )
    if n is not None:
        left = left.orderBy("event_account").limit(n)
    right = durable.select(
        "event_account", F.col("risk_score").cast("string").alias("durable_score"),
        F.col("risk_level").alias("durable_level"),
    )
    text = ["cache_score", "cache_level", "durable_score", "durable_level"]
    joined = left.join(right, "event_account", "left").fillna("", text)
    same = (
        (F.col("cache_score") == F.col("durable_score"))
        & (F.col("cache_level") == F.col("durable_level"))
        & (F.col("durable_score") != "")
    )
    return joined.select(
        "event_account", C.salted_row_key("event_account").alias("row_key"), *text,
        F.when(same, "PASS").otherwise("FAIL").alias("status"),
    )


def expected_vs_actual(
    actual: DataFrame, expected: DataFrame, key: str = "table_name",
    actual_col: str = "actual_count", expected_col: str = "expected_count",
) -> DataFrame:
    """PASS where the actual value equals the expected one; absent values fail."""
    joined = expected.select(key, expected_col).join(actual.select(key, actual_col), key, "left")
    same = F.coalesce(F.col(actual_col) == F.col(expected_col), F.lit(False))
    return joined.withColumn("status", F.when(same, "PASS").otherwise("FAIL"))


def exclude_selected(pool: DataFrame, chosen: DataFrame, key: str = "transaction_id") -> DataFrame:
    return pool.join(chosen.select(key), key, "left_anti")
