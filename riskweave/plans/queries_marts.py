"""Registered queries: filters, joins, aggregations, ranking, top-k, sampling, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave import constants as K
from riskweave.functions import rules
from riskweave.operators import (
    detail as D, joins as J, marts as M, profiling as P, ranking as R, sampling as SA,
    scoring as SC, serving as SV, state as ST,
)
from riskweave.plans import inputs as I, reference_sql as Q
from riskweave.plans.catalog import query
from riskweave.sources import adapters as A, raw_files as RF

N = Q.NEGATIVES


def money(df, *cols, digits=2):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def as_double(df, *cols):
    """Decimal results as doubles, for comparison."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# --- filters ------------------------------------------------------------------------


@query("c01_valid_amounts", f"""WITH {Q.TYPED} SELECT event_id FROM typed
WHERE amount_paid IS NOT NULL AND amount_received IS NOT NULL""")
def _(spark, sf):
    from riskweave.functions.columns import parse_amount

    raw = A.raw_transactions(spark, sf).withColumns(
        {c: parse_amount(c) for c in ("amount_paid", "amount_received")}
    )
    return D.valid_amounts(raw).select("event_id")


@query("c02_rule_candidate", f"""WITH {Q.TX} SELECT transaction_id FROM tx
WHERE is_laundering = 1 OR amount_paid >= 1000000 OR is_cross_currency = 1""")
def _(spark, sf):
    return SC.rule_candidates(A.detail(spark, sf)).select("transaction_id")


@query("c03_contract_filter", f"""WITH {Q.TX} SELECT transaction_id FROM tx
WHERE payment_format = 'error' AND is_cross_bank = 1""")
def _(spark, sf):
    # the event type stands in for the run, the flag for the contract version
    tagged = A.detail(spark, sf).select(
        "transaction_id", F.col("payment_format").alias("run_id"),
        F.when(F.col("is_cross_bank") == 1, K.CONTRACT_V1).otherwise("other").alias("contract_version"),
    )
    return SC.contract_filter(tagged, "error").select("transaction_id")


@query("c04_score_floor", f"WITH {Q.SCORED} SELECT transaction_id, raw_score FROM ctx_score WHERE raw_score >= 30")
def _(spark, sf):
    scored = SC.candidate_score(I.context(spark, sf))
    return SC.score_floor(scored).select("transaction_id", "raw_score")


@query("c05_high_risk_accounts", f"WITH {Q.ACCT} SELECT account_number FROM acct WHERE risk_score_rule >= 60 OR laundering_event_count > 0")
def _(spark, sf):
    return SV.high_risk_accounts(I.account_table(spark, sf)).select("account_number")


@query("c06_investigation_filter", f"WITH {Q.SCORED} SELECT transaction_id, risk_level FROM scored WHERE risk_level IN ('HIGH', 'CRITICAL')")
def _(spark, sf):
    return SV.investigation_filter(I.state_events(spark, sf)).select("transaction_id", "risk_level")


@query("c07_large_candidates", f"""WITH {Q.TX}, {Q.CANDIDATES} SELECT transaction_id, "timestamp", transaction_minute,
  from_bank, from_account, to_bank, to_account, amount_paid, payment_currency, payment_format, is_laundering,
  is_cross_bank, is_cross_currency, rule_hits FROM cand""")
def _(spark, sf):
    return M.large_candidates(A.detail(spark, sf))


# --- joins --------------------------------------------------------------------------


@query("d01_account_coverage", f"""WITH {Q.TX}, {Q.ACCOUNTS}, m AS (
  SELECT count(*) AS n, count(*) FILTER (from_account NOT IN (SELECT account_number FROM accounts)) AS f,
         count(*) FILTER (to_account NOT IN (SELECT account_number FROM accounts)) AS t FROM tx)
SELECT f AS from_account_missing_count, t AS to_account_missing_count, n AS transaction_row_count,
  round(1.0 - f / n, 8) AS from_account_match_rate, round(1.0 - t / n, 8) AS to_account_match_rate FROM m""")
def _(spark, sf):
    out = J.account_coverage(A.detail(spark, sf), A.accounts(spark, sf))
    return money(out, "from_account_match_rate", "to_account_match_rate", digits=8)


@query("d01_missing_account_examples", f"""WITH {Q.TX}, {Q.ACCOUNTS} SELECT side, account, transaction_id FROM (
  SELECT 'from' AS side, from_account AS account, transaction_id FROM tx UNION ALL
  SELECT 'to', to_account, transaction_id FROM tx)
WHERE account NOT IN (SELECT account_number FROM accounts) ORDER BY transaction_id, side LIMIT 20""")
def _(spark, sf):
    return J.missing_account_examples(A.detail(spark, sf), A.accounts(spark, sf))


@query("d02_join_account_features", f"""WITH {Q.CONTEXT} SELECT transaction_id, from_account, from_total_event_count,
  from_debit_count, from_credit_count, round(from_out_amount, 2) AS from_out_amount,
  round(from_in_amount, 2) AS from_in_amount, from_max_out_amount, from_counterparty_count,
  from_cross_bank_event_count, from_cross_currency_event_count FROM ctx""")
def _(spark, sf):
    dwd = A.detail(spark, sf)
    slim = dwd.select("transaction_id", "from_account")
    return money(J.join_account_features(slim, M.account_base(dwd)), "from_out_amount", "from_in_amount")


@query("d03_join_features_tx", f"""WITH {Q.ALL_FEATURES} SELECT transaction_id, split, amount_paid, "timestamp", from_account, to_account FROM feat""")
def _(spark, sf):
    joined = J.join_features_tx(I.all_features(spark, sf), A.detail(spark, sf))
    return joined.select("transaction_id", "split", "amount_paid", "timestamp", "from_account", "to_account")


@query("d04_rederive_features", f"WITH {Q.ALL_FEATURES} SELECT {Q.FEATURE_SELECT} FROM feat")
def _(spark, sf):
    from riskweave.plans.queries_sources import rounded_features

    dwd = A.detail(spark, sf)
    accounts = I.account_layer(spark, sf)
    stored = I.stored(I.all_features(spark, sf, accounts), "features")
    return rounded_features(J.rederive_features(stored, dwd, accounts))


@query("d05_align_for_parity", f"""WITH {Q.TX} SELECT a.transaction_id, a.amount_paid AS p_amount_paid, b.amount_paid AS w_amount_paid,
  a.payment_format AS p_payment_format, b.payment_format AS w_payment_format
FROM tx a JOIN (SELECT * FROM tx WHERE is_cross_bank = 1) b ON a.transaction_id = b.transaction_id""")
def _(spark, sf):
    dwd = A.detail(spark, sf)
    return J.align_for_parity(
        dwd, dwd.filter("is_cross_bank = 1"), "transaction_id", ["amount_paid", "payment_format"]
    )


@query("d06_state_consistency", f"""WITH {Q.SCORED}, latest AS (
  SELECT event_account, arg_max(risk_score, transaction_id) AS risk_score, arg_max(risk_level, transaction_id) AS risk_level
  FROM scored GROUP BY 1)
SELECT event_account, CAST(risk_score AS VARCHAR) AS cache_score, risk_level AS cache_level,
  CASE WHEN event_account LIKE '%7' THEN '' ELSE CAST(risk_score AS VARCHAR) END AS durable_score,
  CASE WHEN event_account LIKE '%7' THEN '' ELSE risk_level END AS durable_level,
  CASE WHEN event_account LIKE '%7' THEN 'FAIL' ELSE 'PASS' END AS status FROM latest""")
def _(spark, sf):
    latest = ST.latest_state(I.state_events(spark, sf), ["transaction_id"])
    rows = ST.durable_state_rows(latest, I.stamp())
    # accounts ending in 7 never reached the durable store
    durable = ST.durable_view(rows).filter(~F.col("event_account").endswith("7"))
    return J.state_consistency(latest, durable).drop("row_key")


_COUNTS = """counts AS (SELECT payment_format AS table_name, count(*) AS actual_count FROM tx GROUP BY 1)"""


@query("d07_expected_vs_actual", f"""WITH {Q.TX}, {_COUNTS}, want AS (
  SELECT table_name, actual_count + CASE WHEN table_name = 'view' THEN 1 ELSE 0 END AS expected_count FROM counts
  UNION ALL SELECT 'absent', count(*) FROM tx)
SELECT table_name, expected_count, actual_count,
  CASE WHEN expected_count = actual_count THEN 'PASS' ELSE 'FAIL' END AS status
FROM want LEFT JOIN counts USING (table_name)""")
def _(spark, sf):
    dwd = A.detail(spark, sf)
    actual = dwd.groupBy(F.col("payment_format").alias("table_name")).agg(F.count("*").alias("actual_count"))
    off = F.when(F.col("table_name") == "view", 1).otherwise(0)
    want = actual.select("table_name", (F.col("actual_count") + off).alias("expected_count"))
    absent = dwd.agg(F.count("*").alias("expected_count")).select(F.lit("absent").alias("table_name"), "expected_count")
    return J.expected_vs_actual(actual, want.unionByName(absent))


@query("d08_exclude_selected", f"""WITH {Q.TX} SELECT transaction_id FROM tx
WHERE transaction_id NOT IN (SELECT transaction_id FROM tx WHERE is_cross_currency = 1)""")
def _(spark, sf):
    dwd = A.detail(spark, sf).select("transaction_id", "is_cross_currency")
    return J.exclude_selected(dwd, dwd.filter("is_cross_currency = 1")).select("transaction_id")


# --- aggregations -------------------------------------------------------------------


@query("e01_profile_transactions", f"""WITH {Q.TYPED}, ok AS (
  SELECT *, amount_paid IS NOT NULL AND amount_received IS NOT NULL AS good FROM typed WHERE well_formed)
SELECT count(*) AS row_count, min(NULLIF("timestamp", '')) AS min_timestamp, max("timestamp") AS max_timestamp,
  count(DISTINCT from_bank) AS from_bank_count, count(DISTINCT to_bank) AS to_bank_count,
  min(amount_paid) FILTER (good) AS amount_paid_min, max(amount_paid) FILTER (good) AS amount_paid_max,
  round(CAST(sum(CAST(amount_paid AS DECIMAL(18,2))) FILTER (good) AS DOUBLE), 2) AS amount_paid_sum,
  round(CAST(sum(CAST(amount_received AS DECIMAL(18,2))) FILTER (good) AS DOUBLE), 2) AS amount_received_sum,
  count(*) FILTER (NOT good) AS invalid_amount_count,
  (SELECT count(*) FROM (SELECT from_account FROM ok UNION SELECT to_account FROM ok)) AS account_count,
  (SELECT count(*) FROM typed WHERE NOT well_formed) AS malformed_count FROM ok""")
def _(spark, sf):
    raw = RF.read_transactions_csv(spark, I.transaction_file(spark, sf))
    return money(P.profile_transactions(raw), "amount_paid_sum", "amount_received_sum")


@query("e02_value_counts", f"""WITH {Q.TX} SELECT from_account AS "value", count(*) AS "count" FROM tx GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 30""")
def _(spark, sf):
    return P.value_counts(A.detail(spark, sf), "from_account")


@query("e03_profile_accounts", f"""WITH {Q.ACCOUNTS} SELECT count(*) AS row_count, count(DISTINCT bank_id) AS bank_count,
  count(DISTINCT account_number) AS account_count, count(DISTINCT entity_id) AS entity_count, 0 AS malformed_count FROM accounts""")
def _(spark, sf):
    return P.profile_accounts(A.accounts(spark, sf))


@query("e03_profile_account_file", f"""WITH {Q.ACCOUNTS}, marked AS (
  SELECT *, CAST(substr(account_number, 2) AS BIGINT) % 50 <> 0 AS good FROM accounts)
SELECT count(*) FILTER (good) AS row_count, count(DISTINCT bank_id) FILTER (good) AS bank_count,
  count(DISTINCT account_number) FILTER (good) AS account_count, count(DISTINCT entity_id) FILTER (good) AS entity_count,
  count(*) FILTER (NOT good) AS malformed_count FROM marked""")
def _(spark, sf):
    good, bad = RF.split_malformed(RF.read_accounts_csv(spark, I.account_file(spark, sf)))
    return P.profile_accounts(good, bad)


@query("e03_top_bank_ids", f"""WITH {Q.ACCOUNTS}
SELECT bank_id AS "value", count(*) AS "count" FROM accounts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(spark, sf):
    return P.top_bank_ids(A.accounts(spark, sf), 10)


@query("e04_profile_patterns", f"""WITH {Q.RAW}, k AS (
  SELECT *, CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN 'other' ELSE 'transaction' END AS kind FROM raw),
facts AS (
  SELECT 'kind' AS section, kind AS "key" FROM k
  UNION ALL SELECT 'line', 'all' FROM k
  UNION ALL SELECT 'label', is_laundering FROM k WHERE kind = 'transaction'
  UNION ALL SELECT 'kind', 'begin' FROM k WHERE event_id % 10 = 0
  UNION ALL SELECT 'line', 'all' FROM k WHERE event_id % 10 = 0
  UNION ALL SELECT 'pattern_type', concat('FAN-', payment_format) FROM k WHERE event_id % 10 = 0)
SELECT section, "key", count(*) AS "count" FROM facts GROUP BY 1, 2""")
def _(spark, sf):
    lines = A.raw_transaction_lines(spark, sf)
    begins = A.detail(spark, sf, extra=("event_id",)).filter("event_id % 10 = 0").select(
        "event_id",
        F.concat(F.lit("BEGIN LAUNDERING ATTEMPT - FAN-"), "payment_format", F.lit(": detail")).alias("value"),
    )
    return P.profile_patterns(RF.type_pattern_lines(lines.unionByName(begins)))


@query("e05_ods_summary", f"""WITH {Q.TYPED}, ok AS (SELECT * FROM typed WHERE well_formed)
SELECT 'rows_written' AS metric, CAST(count(*) AS VARCHAR) AS "value" FROM ok
UNION ALL SELECT 'malformed_rows', CAST(count(*) AS VARCHAR) FROM typed WHERE NOT well_formed
UNION ALL SELECT 'min_timestamp', min("timestamp") FROM ok
UNION ALL SELECT 'max_timestamp', max("timestamp") FROM ok
UNION ALL SELECT concat('label.', is_laundering), CAST(count(*) AS VARCHAR) FROM ok GROUP BY 1
UNION ALL SELECT concat('payment_format.', payment_format), CAST(count(*) AS VARCHAR) FROM ok GROUP BY 1""")
def _(spark, sf):
    good, bad = RF.split_malformed(RF.read_transactions_csv(spark, I.transaction_file(spark, sf)))
    return P.ods_summary(D.ods_typed(good), bad)


@query("e06_account_dim_summary", f"""WITH {Q.ACCOUNTS}, t AS (SELECT * FROM accounts UNION ALL
  SELECT * FROM accounts WHERE bank_id = '3')
SELECT count(*) AS row_count, count(DISTINCT account_number) AS unique_account_count,
  count(*) - count(DISTINCT account_number) AS duplicate_account_number_count,
  count(DISTINCT bank_id) AS bank_count, count(DISTINCT entity_id) AS entity_count FROM t""")
def _(spark, sf):
    acc = A.accounts(spark, sf)
    return P.account_dim_summary(acc.unionByName(acc.filter("bank_id = '3'")))


_MINUTE = """, parties AS (
  SELECT transaction_minute, payment_format, from_account AS a FROM {t} UNION ALL
  SELECT transaction_minute, payment_format, to_account FROM {t}),
d AS (SELECT transaction_minute, payment_format, count(DISTINCT a) AS distinct_account_count FROM parties GROUP BY 1, 2)
SELECT transaction_minute, payment_format, count(*) AS transaction_count, CAST(sum(is_laundering) AS BIGINT) AS laundering_count,
  round(sum(is_laundering) / count(*), 8) AS laundering_rate,
  round(CAST(sum(CAST(amount_paid AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_amount_paid,
  any_value(distinct_account_count) AS distinct_account_count
FROM {t} JOIN d USING (transaction_minute, payment_format) GROUP BY 1, 2"""


@query("e08_minute_kpi", f"WITH {Q.TX} {_MINUTE.format(t='tx')}")
def _(spark, sf):
    out = M.minute_kpi(A.detail(spark, sf))
    return money(money(out, "total_amount_paid"), "laundering_rate", digits=8)


# orders as transactions: only 2,406 days, so each minute key is heavy
BULK = """
bulk AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M') AS transaction_minute, concat('C', o_custkey) AS from_account,
    concat('S', l_suppkey) AS to_account, round(l_extendedprice * 100, 2) AS amount_paid,
    round(l_extendedprice * 100, 2) AS amount_received, concat(l_returnflag, l_linestatus) AS payment_format,
    CASE WHEN l_returnflag = 'R' AND l_quantity >= 49 THEN 1 ELSE 0 END AS is_laundering,
    CASE WHEN c_nationkey <> s_nationkey THEN 1 ELSE 0 END AS is_cross_bank,
    CASE WHEN cn.n_regionkey <> sn.n_regionkey THEN 1 ELSE 0 END AS is_cross_currency
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
)"""


@query("e08_minute_kpi_bulk", f"WITH {BULK} {_MINUTE.format(t='bulk')}")
def _(spark, sf):
    out = M.minute_kpi(A.bulk_detail(spark, sf))
    return money(money(out, "total_amount_paid"), "laundering_rate", digits=8)


_ACCOUNT = """account_number, total_event_count, debit_count, credit_count, round(out_amount, 2) AS out_amount,
  round(in_amount, 2) AS in_amount, round(in_amount - out_amount, 2) AS net_amount, max_out_amount, counterparty_count,
  laundering_event_count, cross_bank_event_count, cross_currency_event_count"""


def _rounded_accounts(df):
    return money(df, "out_amount", "in_amount", "net_amount")


@query("e09_account_features", f"WITH {Q.ACCT} SELECT {_ACCOUNT} FROM acct0")
def _(spark, sf):
    return _rounded_accounts(M.account_base(A.detail(spark, sf)))


@query("e09_account_features_bulk", f"""WITH {BULK}, s AS (
  SELECT from_account AS a, to_account AS p, amount_paid AS o, NULL AS i, is_laundering, is_cross_bank, is_cross_currency FROM bulk
  UNION ALL SELECT to_account, from_account, NULL, amount_received, is_laundering, is_cross_bank, is_cross_currency FROM bulk)
SELECT a AS account_number, count(*) AS total_event_count, count(o) AS debit_count, count(i) AS credit_count,
  round(coalesce(CAST(sum(CAST(o AS DECIMAL(18,2))) AS DOUBLE), 0), 2) AS out_amount,
  round(coalesce(CAST(sum(CAST(i AS DECIMAL(18,2))) AS DOUBLE), 0), 2) AS in_amount,
  round(coalesce(CAST(sum(CAST(i AS DECIMAL(18,2))) AS DOUBLE), 0) - coalesce(CAST(sum(CAST(o AS DECIMAL(18,2))) AS DOUBLE), 0), 2) AS net_amount,
  coalesce(max(o), 0.0) AS max_out_amount, count(DISTINCT p) AS counterparty_count,
  CAST(sum(is_laundering) AS BIGINT) AS laundering_event_count, CAST(sum(is_cross_bank) AS BIGINT) AS cross_bank_event_count,
  CAST(sum(is_cross_currency) AS BIGINT) AS cross_currency_event_count FROM s GROUP BY 1""")
def _(spark, sf):
    # a line is one payment; Spark counts them from the files' footers
    lines = A.table(spark, sf, "lineitem").count()
    return _rounded_accounts(M.account_base(A.bulk_detail(spark, sf), lines))


@query("e10_account_rule_score", f"WITH {Q.ACCT} SELECT {_ACCOUNT}, risk_score_rule FROM acct")
def _(spark, sf):
    return _rounded_accounts(I.account_table(spark, sf))


_KPI = """payment_format, transaction_count, laundering_count, round(laundering_rate, 8) AS laundering_rate,
  round(total_amount_paid, 2) AS total_amount_paid, round(total_amount_paid / transaction_count, 4) AS avg_amount_paid,
  max_amount_paid"""


def _rounded_kpi(df):
    out = money(df, "total_amount_paid")
    return money(money(out, "laundering_rate", digits=8), "avg_amount_paid", digits=4)


@query("e11_payment_kpi", f"WITH {Q.TX}, {Q.KPI} SELECT {_KPI} FROM kpi")
def _(spark, sf):
    return _rounded_kpi(M.payment_kpi(A.detail(spark, sf)))


@query("e11_payment_kpi_bulk", f"""WITH {BULK.replace('bulk AS', 'tx AS', 1)}, {Q.KPI} SELECT {_KPI} FROM kpi""")
def _(spark, sf):
    return _rounded_kpi(M.payment_kpi(A.bulk_detail(spark, sf)))


@query("e12_quantile", f"""WITH {Q.TX} SELECT CAST(q AS DOUBLE) AS q, round(CASE q WHEN 0.0 THEN min(amount_paid) WHEN 1.0 THEN max(amount_paid)
  WHEN 0.5 THEN quantile_cont(amount_paid, 0.5) WHEN 0.25 THEN quantile_cont(amount_paid, 0.25)
  ELSE quantile_cont(amount_paid, 0.995) END, 4) AS "value"
FROM tx, (SELECT unnest([0.0, 0.25, 0.5, 0.995, 1.0]) AS q) GROUP BY q""")
def _(spark, sf):
    dwd = A.detail(spark, sf)
    qs = [0.0, 0.25, 0.5, 0.995, 1.0]
    values = [(q, round(v, 4)) for q, v in zip(qs, R.exact_quantiles(dwd, "amount_paid", qs))]
    return spark.createDataFrame(values, "q double, value double")


@query("e12_quantile_bulk", """SELECT round(quantile_cont(l_extendedprice, 0.995), 4) AS q995,
  round(quantile_cont(l_quantity, 0.5), 4) AS q50 FROM lineitem""")
def _(spark, sf):
    line = A.table(spark, sf, "lineitem")
    row = [(round(R.exact_quantile(line, "l_extendedprice", 0.995), 4), round(R.exact_quantile(line, "l_quantity", 0.5), 4))]
    return spark.createDataFrame(row, "q995 double, q50 double")


@query("e13_label_distribution", f"""WITH {Q.TX} SELECT label, count(tx.is_laundering) AS "count",
  round(count(tx.is_laundering) / (SELECT count(*) FROM tx), 8) AS rate
FROM (SELECT unnest([0, 1]) AS label) l LEFT JOIN tx ON is_laundering = label GROUP BY 1""")
def _(spark, sf):
    return money(P.label_distribution(A.detail(spark, sf)), "rate", digits=8)


@query("e14_eda_metrics", f"""WITH {Q.TX} SELECT count(*) AS transaction_rows, CAST(sum(is_laundering) AS BIGINT) AS laundering_rows,
  CAST(count(*) - sum(is_laundering) AS BIGINT) AS non_laundering_rows, printf('%.10f', sum(is_laundering) / count(*)) AS laundering_rate,
  count(DISTINCT from_account) AS distinct_from_accounts, count(DISTINCT to_account) AS distinct_to_accounts,
  CAST(sum(is_cross_bank) AS BIGINT) AS cross_bank_rows, CAST(sum(is_cross_currency) AS BIGINT) AS cross_currency_rows,
  min(amount_paid) AS amount_paid_min, max(amount_paid) AS amount_paid_max,
  round(quantile_cont(amount_paid, 0.5), 4) AS amount_paid_p50, round(quantile_cont(amount_paid, 0.95), 4) AS amount_paid_p95,
  round(quantile_cont(amount_paid, 0.99), 4) AS amount_paid_p99 FROM tx""")
def _(spark, sf):
    return money(P.eda_metrics(A.detail(spark, sf)), "amount_paid_p50", "amount_paid_p95", "amount_paid_p99", digits=4)


_RATES = """count(*) AS transaction_count, CAST(sum(is_laundering) AS BIGINT) AS laundering_count,
  round(CAST(sum(CAST(amount_paid AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS avg_amount_paid,
  max(amount_paid) AS max_amount_paid, round(sum(is_laundering) / count(*), 8) AS laundering_rate"""


def _rounded_rates(df):
    return money(money(df, "avg_amount_paid", digits=4), "laundering_rate", digits=8)


@query("e15_group_rate", f"WITH {Q.TYPED} SELECT transaction_hour, {_RATES} FROM typed WHERE amount_paid IS NOT NULL GROUP BY 1")
def _(spark, sf):
    # the hour of an unparsable time is NULL and stays a group
    raw = A.raw_transactions(spark, sf).withColumn("transaction_id", F.lit(""))
    return _rounded_rates(P.group_rate(D.build_dwd_transactions(raw), "transaction_hour"))


@query("e16_dimension_rates", f"""WITH {Q.TX}, s AS (
  SELECT 'is_cross_bank' AS dimension, CAST(is_cross_bank AS VARCHAR) AS dimension_value, is_laundering, amount_paid FROM tx
  UNION ALL SELECT 'is_cross_currency', CAST(is_cross_currency AS VARCHAR), is_laundering, amount_paid FROM tx
  UNION ALL SELECT 'transaction_hour', CAST(transaction_hour AS VARCHAR), is_laundering, amount_paid FROM tx)
SELECT dimension, dimension_value, {_RATES} FROM s GROUP BY 1, 2""")
def _(spark, sf):
    return _rounded_rates(P.dimension_rates(A.detail(spark, sf)))


@query("e17_amount_bin_rates", f"""WITH {Q.TX}, b AS (SELECT unnest(['0-100','100-1k','1k-10k','10k-100k','100k-1m','1m-10m','10m+']) AS amount_bin,
  unnest([0, 100, 1000, 10000, 100000, 1000000, 10000000]) AS lo, unnest([100, 1000, 10000, 100000, 1000000, 10000000, 1e300]) AS hi)
SELECT amount_bin, count(amount_paid) AS transaction_count, CAST(coalesce(sum(is_laundering), 0) AS BIGINT) AS laundering_count,
  round(coalesce(sum(is_laundering) / nullif(count(amount_paid), 0), 0), 8) AS laundering_rate
FROM b LEFT JOIN tx ON amount_paid >= lo AND amount_paid < hi GROUP BY 1""")
def _(spark, sf):
    return money(P.amount_bin_rates(A.detail(spark, sf)), "laundering_rate", digits=8)


@query("e18_split_summary", f"""WITH {Q.ALL_FEATURES} SELECT split, count(*) AS "rows", CAST(sum(is_laundering) AS BIGINT) AS positive_rows,
  round(sum(is_laundering) / count(*), 8) AS positive_rate FROM feat GROUP BY 1""")
def _(spark, sf):
    return money(P.split_summary(I.all_features(spark, sf)), "positive_rate", digits=8)


@query("e18_label_split_summary", f"WITH {Q.ALL_FEATURES} SELECT split, is_laundering, count(*) AS row_count FROM feat GROUP BY 1, 2")
def _(spark, sf):
    return P.label_split_summary(I.all_features(spark, sf))


@query("e19_class_balance", f"""WITH {Q.ALL_FEATURES} SELECT unnest(['feature_rows', 'positive_rows', 'negative_rows', 'positive_rate', 'train_rows', 'test_rows']) AS metric,
  unnest([CAST(count(*) AS VARCHAR), CAST(sum(is_laundering) AS VARCHAR), CAST(count(*) - sum(is_laundering) AS VARCHAR),
    printf('%.8f', sum(is_laundering) / count(*)), CAST(count(*) FILTER (split = 'train') AS VARCHAR), CAST(count(*) FILTER (split = 'test') AS VARCHAR)]) AS "value" FROM feat""")
def _(spark, sf):
    return P.class_balance(I.all_features(spark, sf))


@query("e20_hourly_distribution", f"""WITH {Q.TX} SELECT transaction_hour, count(*) AS transaction_count,
  CAST(sum(is_laundering) AS BIGINT) AS laundering_count, round(sum(is_laundering) / count(*), 8) AS laundering_rate,
  CAST(round(sum(CAST(amount_paid AS DECIMAL(18,2))), 0) AS BIGINT) AS total_amount_paid FROM tx GROUP BY 1""")
def _(spark, sf):
    return SV.hourly_distribution(A.detail(spark, sf))


@query("e21_table_counts", """SELECT 'events' AS table_name, count(*) AS actual_count FROM events UNION ALL
SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL
SELECT 'documents', count(*) FROM documents""")
def _(spark, sf):
    return P.table_counts({t: A.table(spark, sf, t) for t in ("events", "orders", "lineitem", "documents")})


@query("e28_replay_summary", f"""WITH {Q.TX} SELECT count(*) AS rows_written, CAST(sum(is_laundering) AS BIGINT) AS laundering_rows,
  count(*) FILTER (amount_paid >= 1000000) AS large_amount_rows, CAST(sum(is_cross_bank) AS BIGINT) AS cross_bank_rows,
  CAST(sum(is_cross_currency) AS BIGINT) AS cross_currency_rows,
  count(*) FILTER (is_laundering = 1 OR amount_paid >= 1000000 OR is_cross_currency = 1) AS rule_candidate_rows
FROM (SELECT * FROM tx ORDER BY transaction_id LIMIT 10000)""")
def _(spark, sf):
    sample = SA.head_sample(A.detail(spark, sf), K.REPLAY_ROWS, ["transaction_id"])
    return P.replay_summary(D.to_replay(sample, I.RUN))


# --- ranking, top-k -------------------------------------------------------------------


@query("f01_score_deciles", """WITH r AS (SELECT *, row_number() OVER (ORDER BY value, event_id) AS rn, count(*) OVER () AS n FROM events),
d AS (SELECT *, greatest(1, CAST(ceil((rn - 1) * 10 / (n - 1)) AS INTEGER)) AS score_decile FROM r)
SELECT score_decile, count(*) AS "rows", count(*) FILTER (event_type = 'error') AS positive_rows,
  round(count(*) FILTER (event_type = 'error') / count(*), 8) AS positive_rate, min(value) AS min_score, max(value) AS max_score
FROM d GROUP BY 1""")
def _(spark, sf):
    scored = A.table(spark, sf, "events").select(
        F.col("value").alias("anomaly_score"), (F.col("event_type") == "error").cast("int").alias("is_laundering"),
        F.col("event_id").alias("transaction_id"),
    )
    return R.score_deciles(scored)


@query("f02_best_model", """WITH m AS (SELECT event_type AS model, avg(CAST(event_id AS DOUBLE)) AS pr_auc, count(*) AS n FROM events GROUP BY 1)
SELECT model, n FROM m ORDER BY pr_auc DESC LIMIT 1""")
def _(spark, sf):
    metrics = A.table(spark, sf, "events").groupBy(F.col("event_type").alias("model")).agg(
        F.avg("event_id").alias("pr_auc"), F.count("*").alias("n")
    )
    return R.best_model(metrics).select("model", "n")


@query("f03_latest_per_key", """SELECT user_id, max(event_id) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
  arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1""")
def _(spark, sf):
    events = A.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return R.latest_per_key(events, "user_id", ["ts", "event_id"]).drop("ts")


@query("g01_head_sample", f"WITH {Q.TX} SELECT transaction_id, amount_paid FROM tx ORDER BY transaction_id LIMIT 5000")
def _(spark, sf):
    return SA.head_sample(A.detail(spark, sf), 5000, ["transaction_id"]).select("transaction_id", "amount_paid")


@query("g02_large_txn_topn", f"""WITH {Q.TX}, {Q.CANDIDATES} SELECT transaction_id, transaction_minute, from_account, to_account, amount_paid,
  payment_currency, payment_format, is_laundering, rule_hits FROM cand ORDER BY amount_paid DESC, transaction_id LIMIT 20""")
def _(spark, sf):
    return SV.large_txn_topn(M.large_candidates(A.detail(spark, sf)))


_RISK = "ORDER BY risk_score_rule DESC, laundering_event_count DESC, round(out_amount, 2) DESC, account_number"


@query("g03_account_risk_topn", f"""WITH {Q.ACCT} SELECT account_number, total_event_count, debit_count, credit_count,
  CAST(round(out_amount) AS BIGINT) AS out_amount, counterparty_count, laundering_event_count, cross_bank_event_count,
  cross_currency_event_count, risk_score_rule FROM acct {_RISK} LIMIT 20""")
def _(spark, sf):
    return SV.account_risk_topn(I.account_table(spark, sf))


@query("g03_ads_account_export", f"""WITH {Q.ACCT} SELECT account_number, total_event_count, debit_count, credit_count,
  round(out_amount, 2) AS out_amount, counterparty_count, laundering_event_count, cross_bank_event_count,
  cross_currency_event_count, CAST(risk_score_rule AS DOUBLE) AS risk_score_rule, '2024-06-01 00:00:00' AS updated_at
FROM acct {_RISK} LIMIT 5000""")
def _(spark, sf):
    return as_double(SV.ads_account_export(I.account_table(spark, sf), 5000, I.stamp()), "out_amount")


@query("g04_payment_format_risk", f"""WITH {Q.TX}, {Q.KPI} SELECT payment_format, transaction_count, laundering_count,
  round(laundering_rate, 8) AS laundering_rate, CAST(round(total_amount_paid) AS BIGINT) AS total_amount_paid FROM kpi""")
def _(spark, sf):
    return SV.payment_format_risk(M.payment_kpi(A.detail(spark, sf)))


# --- sampling ---------------------------------------------------------------------------


@query("h01_undersample", f"""WITH {Q.TX} SELECT transaction_id, is_laundering FROM (SELECT *, row_number() OVER (PARTITION BY is_laundering
  ORDER BY {Q.hashed(20260609)}, transaction_id) AS rn FROM tx) WHERE is_laundering = 1 OR rn <= {N}""")
def _(spark, sf):
    return SA.undersample(A.detail(spark, sf), N).select("transaction_id", "is_laundering")


@query("h02_stratified_split", f"WITH {Q.FEATURES} SELECT transaction_id, is_laundering, split FROM feat")
def _(spark, sf):
    sample = I.stored(SA.undersample(A.detail(spark, sf), N), "sample")
    return SA.stratified_split(sample).select("transaction_id", "is_laundering", "split")


@query("h03_use_or_make_split", f"WITH {Q.FEATURES} SELECT transaction_id, split FROM feat")
def _(spark, sf):
    # a stored split without positives in its test side is replaced
    broken = I.stored(I.sampled_features(spark, sf), "features").withColumn(
        "split", F.when(F.col("is_laundering") == 1, "train").otherwise("test")
    )
    split, _how = SA.use_or_make_split(broken)
    return split.select("transaction_id", "split")


_TIER = f"""tgt AS (SELECT least(3000, count(*)) AS t, least(200, count(*) FILTER (is_laundering = 1)) AS qp FROM ctx_score),
pos AS (SELECT transaction_id AS pid FROM (SELECT transaction_id, row_number() OVER (ORDER BY {Q.hashed(20260611)}, transaction_id) AS rn
  FROM ctx_score WHERE is_laundering = 1) WHERE rn <= (SELECT qp FROM tgt)),
tier AS (SELECT ctx_score.*, CASE WHEN pid IS NOT NULL THEN 1 WHEN raw_score >= 30 THEN 2 ELSE 3 END AS tier
  FROM ctx_score LEFT JOIN pos ON transaction_id = pid),
size AS (SELECT count(*) FILTER (tier = 2) AS n2, count(*) FILTER (tier = 3) AS n3 FROM tier),
q1 AS (SELECT t, qp, n3, least(CAST(floor(t * 0.8) AS BIGINT), t - qp, n2) AS q2 FROM tgt, size),
q2 AS (SELECT qp, least(t - qp - q2, n3) AS q3, t - qp - least(t - qp - q2, n3) AS q2 FROM q1),
picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY {Q.hashed(20260611)}, transaction_id) AS rn FROM tier), q2
  WHERE rn <= CASE tier WHEN 1 THEN qp WHEN 2 THEN q2 ELSE q3 END)"""


@query("h04_tiered_sample", f"WITH {Q.SCORED}, {_TIER} SELECT transaction_id, tier, is_laundering FROM picked")
def _(spark, sf):
    sample = SA.tiered_sample(I.stored(I.context(spark, sf), "context"), 3000)
    return sample.select("transaction_id", F.col("_tier").alias("tier"), "is_laundering")


@query("e29_sample_summary", f"""WITH {Q.SCORED}, {_TIER} SELECT count(*) AS rows_written, count(*) FILTER (raw_score >= 30) AS candidate_rows_written,
  count(*) FILTER (raw_score < 30) AS non_candidate_rows_written, CAST(sum(is_laundering) AS BIGINT) AS observed_laundering_rows_written,
  (SELECT count(*) FROM ctx_score) AS joined_rows, (SELECT count(*) FROM tier WHERE tier = 2) AS candidate_rows_available FROM picked""")
def _(spark, sf):
    joined = I.stored(I.context(spark, sf), "context")
    return P.sample_summary(joined, SA.tiered_sample(joined, 3000))


@query("h05_anomaly_sample", f"""WITH {Q.TX} SELECT transaction_id FROM (SELECT *, row_number() OVER (PARTITION BY is_laundering
  ORDER BY {Q.hashed(20260613)}, transaction_id) AS rn, count(*) FILTER (is_laundering = 1) OVER () AS p FROM tx)
WHERE (is_laundering = 1 AND rn <= 1500) OR (is_laundering = 0 AND rn <= 1500 - p)""")
def _(spark, sf):
    return SA.anomaly_sample(A.detail(spark, sf), 1500).select("transaction_id")


# --- set operations -----------------------------------------------------------------------


@query("i01_bag_union", f"""WITH {Q.TX} SELECT transaction_id, payment_format FROM tx WHERE is_laundering = 1 UNION ALL
SELECT transaction_id, payment_format FROM tx WHERE amount_paid >= 1000000""")
def _(spark, sf):
    dwd = A.detail(spark, sf).select("transaction_id", "payment_format", "is_laundering", "amount_paid")
    return dwd.filter("is_laundering = 1").unionByName(dwd.filter("amount_paid >= 1000000")).select(
        "transaction_id", "payment_format"
    )


@query("i02_scalar_rows", f"""WITH {Q.TX} SELECT 'rows' AS metric, CAST(count(*) AS VARCHAR) AS "value" FROM tx
UNION ALL SELECT 'distinct_ids', CAST(count(DISTINCT transaction_id) AS VARCHAR) FROM tx
UNION ALL SELECT 'positives', CAST(sum(is_laundering) AS VARCHAR) FROM tx""")
def _(spark, sf):
    wide = A.detail(spark, sf).agg(
        F.count("*").alias("rows"), F.count_distinct("transaction_id").alias("distinct_ids"),
        F.sum("is_laundering").alias("positives"),
    )
    return P.metric_rows(wide)


@query("i03_distinct_union", f"""WITH {Q.TX} SELECT from_account AS "value" FROM tx UNION SELECT to_account FROM tx""")
def _(spark, sf):
    return P.distinct_values(A.detail(spark, sf), "from_account", "to_account")


@query("i04_field_difference", f"""WITH cols AS (SELECT unnest(['transaction_id', 'amount_paid', 'from_account', 'risk_score_rule', 'split']) AS field)
SELECT field, CASE WHEN field IN ('risk_score_rule', 'split') THEN 'FAIL' ELSE 'PASS' END AS status,
  CASE WHEN field IN ('risk_score_rule', 'split') THEN 'missing' ELSE 'present' END AS detail FROM cols""")
def _(spark, sf):
    from riskweave.operators.quality import required_scan

    return required_scan(
        A.detail(spark, sf), ["transaction_id", "amount_paid", "from_account", "risk_score_rule", "split"]
    )
