"""Column layouts of every layer and stream."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: columns, their order and types -----------------------------------------

ODS_COLUMNS = [
    "timestamp",
    "from_bank",
    "from_account",
    "to_bank",
    "to_account",
    "amount_received",
    "receiving_currency",
    "amount_paid",
    "payment_currency",
    "payment_format",
    "is_laundering",
]
ACCOUNT_COLUMNS = [
    "bank_name",
    "bank_id",
    "account_number",
    "entity_id",
    "entity_name",
]

RAW_TRANSACTIONS = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("from_bank", T.StringType()),
    T.StructField("from_account", T.StringType()),
    T.StructField("to_bank", T.StringType()),
    T.StructField("to_account", T.StringType()),
    T.StructField("amount_received", T.StringType()),
    T.StructField("receiving_currency", T.StringType()),
    T.StructField("amount_paid", T.StringType()),
    T.StructField("payment_currency", T.StringType()),
    T.StructField("payment_format", T.StringType()),
    T.StructField("is_laundering", T.StringType()),
])
RAW_ACCOUNTS = T.StructType([
    T.StructField("bank_name", T.StringType()),
    T.StructField("bank_id", T.StringType()),
    T.StructField("account_number", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("entity_name", T.StringType()),
])
DWD_TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("transaction_date", T.StringType()),
    T.StructField("transaction_hour", T.IntegerType()),
    T.StructField("transaction_minute", T.StringType()),
    T.StructField("from_bank", T.StringType()),
    T.StructField("from_account", T.StringType()),
    T.StructField("to_bank", T.StringType()),
    T.StructField("to_account", T.StringType()),
    T.StructField("amount_received", T.DoubleType()),
    T.StructField("receiving_currency", T.StringType()),
    T.StructField("amount_paid", T.DoubleType()),
    T.StructField("payment_currency", T.StringType()),
    T.StructField("payment_format", T.StringType()),
    T.StructField("is_laundering", T.IntegerType()),
    T.StructField("is_cross_bank", T.IntegerType()),
    T.StructField("is_cross_currency", T.IntegerType()),
])
REPLAY_EVENT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("tx_timestamp", T.StringType()),
    T.StructField("transaction_minute", T.StringType()),
    T.StructField("from_bank", T.StringType()),
    T.StructField("from_account", T.StringType()),
    T.StructField("to_bank", T.StringType()),
    T.StructField("to_account", T.StringType()),
    T.StructField("amount_paid", T.DoubleType()),
    T.StructField("payment_currency", T.StringType()),
    T.StructField("payment_format", T.StringType()),
    T.StructField("is_laundering", T.IntegerType()),
    T.StructField("is_cross_bank", T.IntegerType()),
    T.StructField("is_cross_currency", T.IntegerType()),
])
SCORING_INPUT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("contract_version", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("tx_timestamp", T.StringType()),
    T.StructField("transaction_date", T.StringType()),
    T.StructField("transaction_hour", T.IntegerType()),
    T.StructField("from_account", T.StringType()),
    T.StructField("to_account", T.StringType()),
    T.StructField("amount_paid", T.DoubleType()),
    T.StructField("log_amount_paid", T.DoubleType()),
    T.StructField("payment_currency", T.StringType()),
    T.StructField("payment_format", T.StringType()),
    T.StructField("is_cross_bank", T.IntegerType()),
    T.StructField("is_cross_currency", T.IntegerType()),
    T.StructField("hour_sin", T.DoubleType()),
    T.StructField("hour_cos", T.DoubleType()),
    T.StructField("from_total_event_count", T.LongType()),
    T.StructField("from_debit_count", T.LongType()),
    T.StructField("from_credit_count", T.LongType()),
    T.StructField("from_out_amount", T.DoubleType()),
    T.StructField("from_in_amount", T.DoubleType()),
    T.StructField("from_max_out_amount", T.DoubleType()),
    T.StructField("from_counterparty_count", T.LongType()),
    T.StructField("from_cross_bank_event_count", T.LongType()),
    T.StructField("from_cross_currency_event_count", T.LongType()),
    T.StructField("from_out_in_ratio", T.DoubleType()),
    T.StructField("from_debit_credit_ratio", T.DoubleType()),
    T.StructField("observed_is_laundering", T.IntegerType()),
    T.StructField("split", T.StringType()),
    T.StructField("feature_snapshot_version", T.StringType()),
])
SCORING_EVENT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("contract_version", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("event_account", T.StringType()),
    T.StructField("counterparty_account", T.StringType()),
    T.StructField("amount_paid", T.DoubleType()),
    T.StructField("payment_currency", T.StringType()),
    T.StructField("payment_format", T.StringType()),
    T.StructField("feature_snapshot_version", T.StringType()),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("risk_reasons", T.StringType()),
    T.StructField("rule_hits", T.StringType()),
    T.StructField("scored_at", T.StringType()),
])
STATE_EVENT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("contract_version", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("event_account", T.StringType()),
    T.StructField("counterparty_account", T.StringType()),
    T.StructField("amount_paid", T.DoubleType()),
    T.StructField("payment_currency", T.StringType()),
    T.StructField("payment_format", T.StringType()),
    T.StructField("feature_snapshot_version", T.StringType()),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("risk_reasons", T.StringType()),
    T.StructField("rule_hits", T.StringType()),
    T.StructField("state_operation", T.StringType()),
    T.StructField("state_store_version", T.StringType()),
    T.StructField("scored_at", T.StringType()),
])
