"""Leakage-free feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskweave import constants as K
from riskweave.operators.joins import (
    derive_features, fill_feature_defaults, join_account_features,
)
from riskweave.session import staged
from riskweave.operators.sampling import stratified_split, undersample

_TX = [
    "transaction_id", "transaction_date", "transaction_hour", "from_account", "amount_paid",
    "payment_currency", "payment_format", "is_laundering", "is_cross_bank", "is_cross_currency",
]


def build_features(
    dwd: DataFrame, accounts: DataFrame, negatives: int = K.NEGATIVE_SAMPLE_ROWS,
    seed: int = K.FEATURE_SEED,
) -> DataFrame:
    """24 columns per sampled transaction.

    Sampling and splitting run on the narrow transaction columns before the account join,
    so only sampled rows are joined; label-derived account columns are never selected.  The
    sample is written once because the split needs several passes over it.
    """
    sampled = staged(undersample(dwd.select(*_TX), negatives, seed), "sample", group_mb=4)
    split = stratified_split(sampled, 0.25, seed)
    joined = fill_feature_defaults(join_account_features(split, accounts))
    return derive_features(joined).select(*K.FEATURE_COLUMNS)


def ordered_features(features: DataFrame) -> DataFrame:
    """Global order by date, hour and id for writing (range partitions, no single task)."""
    keys = ["transaction_date", "transaction_hour", "transaction_id"]
    return features.repartitionByRange(*keys).sortWithinPartitions(*keys)
