"""Shared SQL building blocks of the equivalents (the adapters in SQL form)."""

TX = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         (user_id * 7 + event_id) % (SELECT max(user_id) + 1 FROM events) AS peer
  FROM events
),
tx AS (
  SELECT event_id, ts,
    concat('TX_', lpad(CAST(event_id + 1 AS VARCHAR), 10, '0')) AS transaction_id,
    strftime(ts, '%Y/%m/%d %H:%M') AS "timestamp",
    strftime(ts, '%Y-%m-%d') AS transaction_date,
    CAST(hour(ts) AS INTEGER) AS transaction_hour,
    strftime(ts, '%Y-%m-%d %H:%M') AS transaction_minute,
    CAST(user_id % 10 AS VARCHAR) AS from_bank,
    concat('A', CAST(user_id AS VARCHAR)) AS from_account,
    CAST(peer % 10 AS VARCHAR) AS to_bank,
    concat('A', CAST(peer AS VARCHAR)) AS to_account,
    round(value * 25000 * (1 - 0.01 * (k % 3)), 2) AS amount_received,
    concat('C', CAST((k % 5 + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END) % 5 AS VARCHAR)) AS receiving_currency,
    round(value * 25000, 2) AS amount_paid,
    concat('C', CAST(k % 5 AS VARCHAR)) AS payment_currency,
    event_type AS payment_format,
    CASE WHEN event_type = 'error' AND k % 10 = 0 THEN 1 ELSE 0 END AS is_laundering,
    CASE WHEN user_id % 10 <> peer % 10 THEN 1 ELSE 0 END AS is_cross_bank,
    CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS is_cross_currency
  FROM ev
)"""

# the text rows with faults; columns are untrimmed
RAW = TX + """,
raw AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN 'bad-time'
         WHEN event_id % 89 = 1 THEN concat(year(ts), '/', month(ts), '/', day(ts), ' ', hour(ts), ':', minute(ts))
         ELSE concat(' ', strftime(ts, '%Y/%m/%d %H:%M'), ' ') END AS "timestamp",
    from_bank, from_account, to_bank, to_account,
    format('{:,.2f}', amount_received) AS amount_received, receiving_currency,
    CASE WHEN event_id % 53 = 0 THEN 'abc' WHEN event_id % 59 = 0 THEN ''
         ELSE concat(' ', format('{:,.2f}', amount_paid)) END AS amount_paid,
    payment_currency, payment_format, CAST(is_laundering AS VARCHAR) AS is_laundering,
    ts, is_cross_bank, is_cross_currency
  FROM tx
)"""

# what a reader must make of the faulty rows
TYPED = RAW + """,
typed AS (
  SELECT event_id,
    trim("timestamp") AS "timestamp",
    CASE WHEN event_id % 97 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS transaction_date,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(hour(ts) AS INTEGER) END AS transaction_hour,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS transaction_minute,
    from_bank, from_account, to_bank, to_account,
    TRY_CAST(replace(trim(amount_received), ',', '') AS DOUBLE) AS amount_received,
    receiving_currency,
    TRY_CAST(NULLIF(replace(trim(amount_paid), ',', ''), '') AS DOUBLE) AS amount_paid,
    payment_currency, payment_format, CAST(is_laundering AS INTEGER) AS is_laundering,
    is_cross_bank, is_cross_currency,
    (event_id % 101 <> 0 AND event_id % 103 <> 0) AS well_formed
  FROM raw
),
numbered AS (
  SELECT concat('HI_SMALL_', lpad(CAST(row_number() OVER (ORDER BY event_id) AS VARCHAR), 10, '0')) AS transaction_id,
         typed.* EXCLUDE (well_formed)
  FROM typed WHERE well_formed
)"""

ACCOUNTS = """
accounts AS (
  SELECT concat('Bank of ', n_name) AS bank_name, CAST(c_nationkey AS VARCHAR) AS bank_id,
         concat('A', CAST(c_custkey AS VARCHAR)) AS account_number,
         concat('E', CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS VARCHAR)) AS entity_id, c_name AS entity_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

EVENTS = TX + """,
sides AS (
  SELECT transaction_id, "timestamp", transaction_minute, 'DEBIT' AS event_type, from_account AS event_account,
         to_account AS counterparty_account, from_bank AS bank_id, to_bank AS counterparty_bank_id,
         amount_paid AS event_amount, payment_currency AS currency, payment_format, is_laundering,
         is_cross_bank, is_cross_currency FROM tx
  UNION ALL
  SELECT transaction_id, "timestamp", transaction_minute, 'CREDIT', to_account, from_account, to_bank, from_bank,
         amount_received, receiving_currency, payment_format, is_laundering, is_cross_bank, is_cross_currency FROM tx
)"""

ACCT = EVENTS + """,
q995 AS (SELECT quantile_cont(amount_paid, 0.995) AS q FROM tx),
acct0 AS (
  SELECT event_account AS account_number, count(*) AS total_event_count,
    count(*) FILTER (event_type = 'DEBIT') AS debit_count,
    count(*) FILTER (event_type = 'CREDIT') AS credit_count,
    coalesce(CAST(sum(CAST(event_amount AS DECIMAL(18,2))) FILTER (event_type = 'DEBIT') AS DOUBLE), 0) AS out_amount,
    coalesce(CAST(sum(CAST(event_amount AS DECIMAL(18,2))) FILTER (event_type = 'CREDIT') AS DOUBLE), 0) AS in_amount,
    greatest(0.0, coalesce(max(event_amount) FILTER (event_type = 'DEBIT'), 0)) AS max_out_amount,
    count(DISTINCT counterparty_account) AS counterparty_count,
    CAST(sum(is_laundering) AS BIGINT) AS laundering_event_count,
    CAST(sum(is_cross_bank) AS BIGINT) AS cross_bank_event_count,
    CAST(sum(is_cross_currency) AS BIGINT) AS cross_currency_event_count
  FROM sides GROUP BY 1
),
acct AS (
  SELECT *, CASE WHEN laundering_event_count > 0 THEN 3 ELSE 0 END
    + CASE WHEN max_out_amount >= (SELECT q FROM q995) THEN 2 ELSE 0 END
    + CASE WHEN counterparty_count >= 20 THEN 1 ELSE 0 END
    + CASE WHEN cross_currency_event_count >= 5 THEN 1 ELSE 0 END AS risk_score_rule
  FROM acct0
)"""

KPI = """
kpi AS (
  SELECT payment_format, count(*) AS transaction_count, CAST(sum(is_laundering) AS BIGINT) AS laundering_count,
    sum(is_laundering) / count(*) AS laundering_rate,
    CAST(sum(CAST(amount_paid AS DECIMAL(18,2))) AS DOUBLE) AS total_amount_paid,
    max(amount_paid) AS max_amount_paid
  FROM tx GROUP BY 1
)"""

CANDIDATES = """
cand0 AS (
  SELECT tx.*, concat_ws(';',
      CASE WHEN amount_paid >= q THEN 'amount_ge_q995' END,
      CASE WHEN amount_paid >= 1000000 THEN 'amount_ge_absolute_threshold' END,
      CASE WHEN is_cross_bank = 1 AND is_cross_currency = 1 AND amount_paid >= 0.5 * q
           THEN 'cross_bank_cross_currency_high_amount' END) AS rule_hits
  FROM tx, (SELECT quantile_cont(amount_paid, 0.995) AS q FROM tx) t
),
cand AS (SELECT * FROM cand0 WHERE rule_hits <> '')"""

# every transaction with its account features and ratios
CONTEXT = ACCT + """,
ctx AS (
  SELECT tx.*, ln(1 + amount_paid) AS log_amount_paid,
    sin(2 * pi() * transaction_hour / 24) AS hour_sin, cos(2 * pi() * transaction_hour / 24) AS hour_cos,
    coalesce(a.total_event_count, 0) AS from_total_event_count, coalesce(a.debit_count, 0) AS from_debit_count,
    coalesce(a.credit_count, 0) AS from_credit_count, coalesce(a.out_amount, 0) AS from_out_amount,
    coalesce(a.in_amount, 0) AS from_in_amount, coalesce(a.max_out_amount, 0) AS from_max_out_amount,
    coalesce(a.counterparty_count, 0) AS from_counterparty_count,
    coalesce(a.cross_bank_event_count, 0) AS from_cross_bank_event_count,
    coalesce(a.cross_currency_event_count, 0) AS from_cross_currency_event_count,
    coalesce(a.out_amount, 0) / (abs(coalesce(a.in_amount, 0)) + 1.0) AS from_out_in_ratio,
    coalesce(a.debit_count, 0) / (abs(coalesce(a.credit_count, 0)) + 1.0) AS from_debit_credit_ratio
  FROM tx LEFT JOIN acct a ON from_account = account_number
)"""

_RULES = [
    ("amount_paid >= 10000000", "AMOUNT_GE_10M", "R_AMOUNT_10M", 35),
    ("amount_paid >= 1000000 AND amount_paid < 10000000", "AMOUNT_GE_1M", "R_AMOUNT_1M", 25),
    ("is_cross_currency = 1", "CROSS_CURRENCY", "R_CROSS_CURRENCY", 20),
    ("is_cross_bank = 1", "CROSS_BANK", "R_CROSS_BANK", 10),
    ("from_cross_currency_event_count >= 2", "ACCOUNT_CROSS_CURRENCY_GE_2", "R_ACCOUNT_CROSS_CURRENCY", 15),
    ("from_cross_bank_event_count >= 10", "ACCOUNT_CROSS_BANK_GE_10", "R_ACCOUNT_CROSS_BANK", 10),
    ("from_debit_credit_ratio >= 3", "DEBIT_CREDIT_RATIO_GE_3", "R_DEBIT_CREDIT_RATIO", 10),
    ("from_out_in_ratio >= 3", "OUT_IN_RATIO_GE_3", "R_OUT_IN_RATIO", 10),
]
RAW_SCORE = "(" + " + ".join(f"CASE WHEN {t} THEN {p} ELSE 0 END" for t, _, _, p in _RULES) + ")"
_REASONS = "concat(" + ", ".join(f"CASE WHEN {t} THEN '{r};' ELSE '' END" for t, r, _, _ in _RULES) + ")"
_HITS = "concat(" + ", ".join(f"CASE WHEN {t} THEN '{h};' ELSE '' END" for t, _, h, _ in _RULES) + ")"
LEVEL = (
    "CASE WHEN {0} >= 80 THEN 'CRITICAL' WHEN {0} >= 60 THEN 'HIGH' "
    "WHEN {0} >= 30 THEN 'MEDIUM' ELSE 'LOW' END"
)

# scoring events of every transaction (run r1)
SCORED = CONTEXT + f""",
ctx_score AS (SELECT *, {RAW_SCORE} AS raw_score FROM ctx),
scored AS (
  SELECT event_id, 'r1' AS run_id, 'p11v2_realtime_state_contract_v1' AS contract_version, transaction_id,
    "timestamp" AS event_time, from_account AS event_account, to_account AS counterparty_account,
    amount_paid, payment_currency, payment_format, 'p9_p10_non_leakage_v1' AS feature_snapshot_version,
    CAST(least(raw_score, 100) AS INTEGER) AS risk_score, {LEVEL.format('raw_score')} AS risk_level,
    {_REASONS} AS risk_reasons, {_HITS} AS rule_hits, 'UPSERT' AS state_operation,
    'hbase_account_risk_state_v1' AS state_store_version, '2024-06-01 00:00:00' AS scored_at
  FROM ctx_score WHERE raw_score >= 30
)"""

SIMPLE = TX + """,
simple AS (
  SELECT 'r1' AS run_id, transaction_id, "timestamp" AS tx_timestamp, transaction_minute,
    from_account AS event_account, to_account AS counterparty_account, amount_paid, payment_currency,
    payment_format, is_laundering, is_cross_bank, is_cross_currency,
    CASE WHEN is_laundering = 1 THEN 'LABEL_HIT'
         WHEN amount_paid >= 1000000 AND is_cross_currency = 1 THEN 'LARGE_CROSS_CURRENCY'
         WHEN amount_paid >= 1000000 AND is_cross_bank = 1 THEN 'LARGE_CROSS_BANK'
         WHEN amount_paid >= 1000000 THEN 'LARGE_AMOUNT'
         WHEN is_cross_currency = 1 THEN 'CROSS_CURRENCY' ELSE 'RULE_MATCH' END AS risk_type,
    CAST(5 * is_laundering + CASE WHEN amount_paid >= 1000000 THEN 2 ELSE 0 END + is_cross_bank
         + is_cross_currency AS INTEGER) AS risk_score,
    concat(CASE WHEN is_laundering = 1 THEN 'LABEL_HIT;' ELSE '' END,
           CASE WHEN amount_paid >= 1000000 THEN 'LARGE_AMOUNT;' ELSE '' END,
           CASE WHEN is_cross_bank = 1 THEN 'CROSS_BANK;' ELSE '' END,
           CASE WHEN is_cross_currency = 1 THEN 'CROSS_CURRENCY;' ELSE '' END) AS risk_reasons
  FROM tx WHERE is_laundering = 1 OR amount_paid >= 1000000 OR is_cross_currency = 1
)"""

# negatives kept in the sampled feature queries
NEGATIVES = 2000


def hashed(seed: int, col: str = "transaction_id") -> str:
    return f"md5(concat({col}, ':{seed}'))"


_H = hashed(20260609)


def _split(where: str) -> str:
    return f""",
samp AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT ctx.*, row_number() OVER (PARTITION BY is_laundering ORDER BY {_H}, transaction_id) AS rn FROM ctx
  ) {where}
),
cls AS (
  SELECT is_laundering AS c, count(*) AS n, floor(0.25 * count(*)) AS fl,
         0.25 * count(*) - floor(0.25 * count(*)) AS fr FROM samp GROUP BY 1
),
quota AS (
  SELECT c, fl + CASE WHEN row_number() OVER (ORDER BY fr DESC, c)
      <= (SELECT ceil(0.25 * sum(n)) - sum(fl) FROM cls) THEN 1 ELSE 0 END AS q FROM cls
),
feat AS (
  SELECT s.*, CASE WHEN row_number() OVER (PARTITION BY is_laundering ORDER BY {_H}, transaction_id) <= q
                   THEN 'test' ELSE 'train' END AS split
  FROM samp s JOIN quota ON c = is_laundering
)"""


FEATURES = CONTEXT + _split(f"WHERE is_laundering = 1 OR rn <= {NEGATIVES}")
ALL_FEATURES = CONTEXT + _split("")

FEATURE_SELECT = """
  transaction_id, transaction_date, split, transaction_hour, amount_paid,
  round(log_amount_paid, 8) AS log_amount_paid, payment_currency, payment_format, is_cross_bank,
  is_cross_currency, round(hour_sin, 8) + 0.0 AS hour_sin, round(hour_cos, 8) + 0.0 AS hour_cos,
  from_total_event_count, from_debit_count, from_credit_count, round(from_out_amount, 2) AS from_out_amount,
  round(from_in_amount, 2) AS from_in_amount, from_max_out_amount, from_counterparty_count,
  from_cross_bank_event_count, from_cross_currency_event_count,
  round(from_out_in_ratio, 6) AS from_out_in_ratio, round(from_debit_credit_ratio, 6) AS from_debit_credit_ratio,
  is_laundering"""
