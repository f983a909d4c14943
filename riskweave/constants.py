"""Names, thresholds, formats and word lists that results depend on."""

# --- fixed values: raw file layouts -------------------------------------------------
TRANSACTION_HEADER = [
    "Timestamp", "From Bank", "Account", "To Bank", "Account", "Amount Received",
    "Receiving Currency", "Amount Paid", "Payment Currency", "Payment Format", "Is Laundering",
]
ACCOUNT_HEADER = ["Bank Name", "Bank ID", "Account Number", "Entity ID", "Entity Name"]
PATTERN_BEGIN = "BEGIN LAUNDERING ATTEMPT"
PATTERN_END = "END LAUNDERING ATTEMPT"
TRANSACTION_ID_PREFIX = "HI_SMALL_"
TRANSACTION_ID_WIDTH = 10

# --- fixed values: warehouse rules --------------------------------------------------
LARGE_QUANTILE = 0.995
LARGE_AMOUNT = 1_000_000.0
HUGE_AMOUNT = 10_000_000.0
ODS_SAMPLE_ROWS = 100_000
REPLAY_ROWS = 10_000
HIT_QUANTILE = "amount_ge_q995"
HIT_ABSOLUTE = "amount_ge_absolute_threshold"
HIT_CROSS = "cross_bank_cross_currency_high_amount"

# (upper bound, label): left-closed amount bands starting at zero
AMOUNT_BANDS = [
    (100.0, "0-100"),
    (1_000.0, "100-1k"),
    (10_000.0, "1k-10k"),
    (100_000.0, "10k-100k"),
    (1_000_000.0, "100k-1m"),
    (10_000_000.0, "1m-10m"),
    (float("inf"), "10m+"),
]

# (lowest score, level), highest first
RISK_LEVELS = [(80, "CRITICAL"), (60, "HIGH"), (30, "MEDIUM")]
RISK_LEVEL_DEFAULT = "LOW"
ALL_RISK_LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
ALERT_LEVELS = ["HIGH", "CRITICAL"]
SCORE_FLOOR = 30

# --- fixed values: stream contracts -------------------------------------------------
CONTRACT_V1 = "p11_realtime_scoring_contract_v1"
CONTRACT_STATE = "p11v2_realtime_state_contract_v1"
STATE_OPERATION = "UPSERT"
STATE_STORE_VERSION = "hbase_account_risk_state_v1"
FEATURE_SNAPSHOT_VERSION = "p9_p10_non_leakage_v1"

# --- fixed values: features and models ----------------------------------------------
NEGATIVE_SAMPLE_ROWS = 200_000
ANOMALY_SAMPLE_ROWS = 50_000
ANOMALY_CONTAMINATION = 0.03
FEATURE_SEED = 20260609
TIER_SEED = 20260611
ANOMALY_SEED = 20260613
BOOTSTRAP_SEED = 20260615
PARITY_TOLERANCE = 1e-6

FEATURE_COLUMNS = [
    "transaction_id", "transaction_date", "split", "transaction_hour", "amount_paid",
    "log_amount_paid", "payment_currency", "payment_format", "is_cross_bank",
    "is_cross_currency", "hour_sin", "hour_cos", "from_total_event_count",
    "from_debit_count", "from_credit_count", "from_out_amount", "from_in_amount",
    "from_max_out_amount", "from_counterparty_count", "from_cross_bank_event_count",
    "from_cross_currency_event_count", "from_out_in_ratio", "from_debit_credit_ratio",
    "is_laundering",
]
NUMERIC_FEATURES = [
    "amount_paid", "log_amount_paid", "is_cross_bank", "is_cross_currency",
    "transaction_hour", "hour_sin", "hour_cos", "from_total_event_count",
    "from_debit_count", "from_credit_count", "from_out_amount", "from_in_amount",
    "from_max_out_amount", "from_counterparty_count", "from_cross_bank_event_count",
    "from_cross_currency_event_count", "from_out_in_ratio", "from_debit_credit_ratio",
]
CATEGORICAL_FEATURES = ["payment_currency", "payment_format"]
LEAKAGE_COLUMNS = [
    "laundering_event_count", "risk_score_rule",
    "from_laundering_event_count", "from_risk_score_rule",
]

# --- fixed values: search and quality -----------------------------------------------
SECRET_PATTERN = (
    r"(?i)(password|token|secret)\s*[:=]\s*[^\t\r\n ]+"
    r"|Basic [A-Za-z0-9+/=]{12,}"
    r"|CLUSTER_HADOOP.*PASSWORD\s*="
)
RAW_FILE_PATTERN = r"^(HI|LI)-.*\.csv$"
