"""Rule scoring; every function maps a batch or a streaming DataFrame alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K
from riskweave.functions import rules
from riskweave.functions.columns import risk_bucket


def run_filter(df: DataFrame, run_id: str) -> DataFrame:
    return df.filter(F.col("run_id") == run_id)


def contract_filter(df: DataFrame, run_id: str, version: str = K.CONTRACT_V1) -> DataFrame:
    return df.filter((F.col("run_id") == run_id) & (F.col("contract_version") == version))


def rule_candidates(df: DataFrame, threshold: float = K.LARGE_AMOUNT) -> DataFrame:
    return df.filter(rules.rule_candidate(threshold))


def risk_rules_v0(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Replay events that meet a simple rule, with type, score and reasons."""
    kept = rule_candidates(df if run_id is None else run_filter(df, run_id))
    return kept.select(
        "run_id", "transaction_id", "tx_timestamp", "transaction_minute",
        F.col("from_account").alias("event_account"),
        F.col("to_account").alias("counterparty_account"),
        "amount_paid", "payment_currency", "payment_format", "is_laundering", "is_cross_bank",
        "is_cross_currency",
        rules.simple_rule_type().alias("risk_type"),
        rules.simple_rule_score().alias("risk_score"),
        rules.simple_rule_reasons().alias("risk_reasons"),
    )


def candidate_score(df: DataFrame, name: str = "raw_score") -> DataFrame:
    return df.withColumn(name, rules.contract_raw_score())


def score_floor(df: DataFrame, floor: int = K.SCORE_FLOOR) -> DataFrame:
    return df.filter(F.col("raw_score") >= floor)


def score_contract(
    df: DataFrame, run_id: str | None = None, version: str = K.CONTRACT_V1,
    scored_at: Column | None = None, extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Scoring events of inputs with a raw score of at least 30.

    The level follows the raw score; the output score is capped at 100.
    """
    kept = df if run_id is None else contract_filter(df, run_id, version)
    scored = score_floor(candidate_score(kept))
    now = F.current_timestamp().cast("string") if scored_at is None else scored_at
    extras = [col.alias(name) for name, col in (extra or {}).items()]
    return scored.select(
        "run_id", F.lit(version).alias("contract_version"), "transaction_id",
        F.col("tx_timestamp").alias("event_time"),
        F.col("from_account").alias("event_account"),
        F.col("to_account").alias("counterparty_account"),
        "amount_paid", "payment_currency", "payment_format", "feature_snapshot_version",
        F.least("raw_score", F.lit(100)).alias("risk_score"),
        risk_bucket("raw_score").alias("risk_level"),
        rules.contract_reasons().alias("risk_reasons"),
        rules.contract_hits().alias("rule_hits"),
        *extras,
        now.alias("scored_at"),
    )


def score_state(
    df: DataFrame, run_id: str | None = None, scored_at: Column | None = None
) -> DataFrame:
    """Scoring events that also carry the state operation and store version."""
    extra = {
        "state_operation": F.lit(K.STATE_OPERATION),
        "state_store_version": F.lit(K.STATE_STORE_VERSION),
    }
    return score_contract(df, run_id, K.CONTRACT_STATE, scored_at, extra)
