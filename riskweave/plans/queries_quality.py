"""Registered queries: data quality, features, models and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave import constants as K
from riskweave.functions import columns as C
from riskweave.models import balanced_forest as BF, baseline as B, isolation as ISO
from riskweave.operators import (
    detail as D, features as FE, joins as J, marts as M, metrics as ME, profiling as P,
    quality as QL, ranking as R, serving as SV,
)
from riskweave.plans import inputs as I, reference_sql as Q
from riskweave.plans.catalog import query
from riskweave.plans.queries_marts import money
from riskweave.plans.queries_sources import rounded_features
from riskweave.session import work_path
from riskweave.sources import adapters as A

# --- expectations -------------------------------------------------------------------------


def _checks(dwd):
    return [
        QL.expect_row_count_between(1, 10_000_000_000),
        QL.expect_columns_match_set(dwd, ["transaction_id", "amount_paid"]),
        QL.expect_columns_match_set(dwd, ["transaction_id", "risk_score"]),
        QL.expect_not_null("amount_paid"),
        QL.expect_in_set("payment_currency", ["C0", "C1", "C2", "C3"]),
        QL.expect_between("amount_paid", 0, 5_000_000),
        QL.expect_between("amount_received", 0, None),
        QL.missing_count("transaction_hour"),
        QL.row_count_positive(),
    ]


@query("q07_run_expectations", f"""WITH {Q.TYPED}, t AS (SELECT * FROM numbered)
SELECT 'row_count_between' AS expectation, 'PASS' AS status, count(*) AS observed_value, '{{"min": 1, "max": 10000000000}}' AS detail FROM t
UNION ALL SELECT 'columns_match_set', 'PASS', 0, '["amount_paid", "transaction_id"]'
UNION ALL SELECT 'columns_match_set', 'FAIL', 1, '["risk_score", "transaction_id"]'
UNION ALL SELECT 'not_null.amount_paid', CASE WHEN count(*) FILTER (amount_paid IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END, count(*) FILTER (amount_paid IS NULL), '' FROM t
UNION ALL SELECT 'in_set.payment_currency', 'FAIL', count(*) FILTER (payment_currency = 'C4'), '["C0", "C1", "C2", "C3"]' FROM t
UNION ALL SELECT 'between.amount_paid', 'FAIL', count(*) FILTER (amount_paid > 5000000 OR amount_paid < 0), '{{"min": 0, "max": 5000000}}' FROM t
UNION ALL SELECT 'between.amount_received', 'PASS', count(*) FILTER (amount_received < 0), '{{"min": 0, "max": null}}' FROM t
UNION ALL SELECT 'not_null.transaction_hour', 'FAIL', count(*) FILTER (transaction_hour IS NULL), '' FROM t
UNION ALL SELECT 'row_count_between', 'PASS', count(*), '{{"min": 1, "max": null}}' FROM t""")
def _(spark, sf):
    typed = D.typed_transactions(I.numbered(spark, sf))
    return QL.run_expectations(typed, _checks(typed))


@query("q07_expectation_totals", f"""SELECT 9 AS evaluated_expectations, 4 AS successful_expectations, 0 AS all_success""")
def _(spark, sf):
    typed = D.typed_transactions(I.numbered(spark, sf))
    totals = QL.expectation_totals(QL.run_expectations(typed, _checks(typed)))
    return totals.withColumn("all_success", F.col("all_success").cast("int"))


def _single(name, make, sql):
    @query(name, sql)
    def _(spark, sf):
        dwd = A.detail(spark, sf)
        return QL.run_expectations(dwd, [make(dwd)]).select("status", "observed_value")


_single("q01_row_count_between", lambda d: QL.expect_row_count_between(1, 500),
        "SELECT CASE WHEN count(*) BETWEEN 1 AND 500 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS observed_value FROM events")
_single("q02_columns_match_set", lambda d: QL.expect_columns_match_set(d, d.columns[1:], exact=True),
        "SELECT CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS observed_value FROM (SELECT CAST(count(*) > 0 AS INT) AS n FROM events)")
_single("q03_not_null", lambda d: QL.expect_not_null("from_account"),
        "SELECT CASE WHEN count(*) FILTER (user_id IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) FILTER (user_id IS NULL) AS observed_value FROM events")
_single("q04_in_set", lambda d: QL.expect_in_set("payment_format", ["click", "view", "purchase"]),
        "SELECT CASE WHEN count(*) FILTER (event_type NOT IN ('click','view','purchase')) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) FILTER (event_type NOT IN ('click','view','purchase')) AS observed_value FROM events")
_single("q05_between", lambda d: QL.expect_between("amount_paid", 1000, 10_000_000),
        "SELECT CASE WHEN count(*) FILTER (round(value*25000,2) NOT BETWEEN 1000 AND 10000000) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) FILTER (round(value*25000,2) NOT BETWEEN 1000 AND 10000000) AS observed_value FROM events")
_single("q06_row_count_positive", lambda d: QL.row_count_positive(),
        "SELECT CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) AS observed_value FROM events")


_RULES = [
    ("row_count", "events_twice_rows", "event_rows", "twice_metric", "transaction_rows"),
    ("row_count", "accounts_equal", "from_accounts", "equals_metric", "to_accounts"),
    ("threshold", "label_rate", "laundering_rate", "open_range", "0;0.01"),
    ("threshold", "some_rows", "transaction_rows", "positive", ""),
    ("threshold", "no_nulls", "null_amounts", "equals", "0"),
    ("boundary", "status", "null_amounts", "in_set", "0;1;2"),
    ("boundary", "absent", "never_measured", "equals", "0"),
]


def _assertions(spark, sf):
    """Seven rules over measured metrics; the rule list is configuration."""
    dwd = A.detail(spark, sf)
    metrics = P.metric_rows(dwd.agg(
        F.count("*").alias("transaction_rows"), (F.count("*") * 2).alias("event_rows"),
        F.count_distinct("from_account").alias("from_accounts"),
        F.count_distinct("to_account").alias("to_accounts"),
        F.round(F.avg("is_laundering"), 8).alias("laundering_rate"),
        F.count_if(F.col("amount_paid").isNull()).alias("null_amounts"),
    ))
    rules = spark.createDataFrame(
        [(*r, "detail table", "") for r in _RULES],
        "rule_group string, rule_name string, metric string, operator string, arg string, "
        "source string, detail string",
    )
    return QL.assert_metrics(metrics, rules)


_JUDGED = """m AS (SELECT count(*) AS n, count(DISTINCT from_account) AS f, count(DISTINCT to_account) AS t,
  sum(is_laundering) / count(*) AS r, count(*) FILTER (amount_paid IS NULL) AS z FROM tx),
j AS (SELECT 'row_count' AS rule_group, 'events_twice_rows' AS rule_name, CAST(2 * n AS VARCHAR) AS actual, TRUE AS ok FROM m
  UNION ALL SELECT 'row_count', 'accounts_equal', CAST(f AS VARCHAR), f = t FROM m
  UNION ALL SELECT 'threshold', 'label_rate', NULL, r > 0 AND r < 0.01 FROM m
  UNION ALL SELECT 'threshold', 'some_rows', CAST(n AS VARCHAR), n > 0 FROM m
  UNION ALL SELECT 'threshold', 'no_nulls', CAST(z AS VARCHAR), z = 0 FROM m
  UNION ALL SELECT 'boundary', 'status', CAST(z AS VARCHAR), z <= 2 FROM m
  UNION ALL SELECT 'boundary', 'absent', '', FALSE)"""


@query("q08_assert_metrics", f"""WITH {Q.TX}, {_JUDGED} SELECT rule_group, rule_name, CASE WHEN rule_name <> 'label_rate' THEN actual END AS actual,
  CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status FROM j""")
def _(spark, sf):
    judged = _assertions(spark, sf)
    shown = F.when(F.col("rule_name") != "label_rate", F.col("actual"))
    return judged.select("rule_group", "rule_name", shown.alias("actual"), "status")


@query("e31_quality_status_rollup", f"""WITH {Q.TX}, {_JUDGED} SELECT rule_group, count(*) AS check_count, count(*) FILTER (ok) AS pass_count, 0 AS warn_count,
  count(*) FILTER (NOT ok) AS fail_count, CASE WHEN count(*) FILTER (NOT ok) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM j GROUP BY 1""")
def _(spark, sf):
    return QL.quality_status_rollup(_assertions(spark, sf), "rule_group")


@query("e32_metrics_pivot", f"""WITH {Q.TX} SELECT CAST(count(*) AS VARCHAR) AS transaction_rows, CAST(sum(is_laundering) AS VARCHAR) AS positives FROM tx""")
def _(spark, sf):
    kv = P.metric_rows(A.detail(spark, sf).agg(
        F.count("*").alias("transaction_rows"), F.sum("is_laundering").alias("positives")
    ))
    return P.metrics_pivot(kv, ["transaction_rows", "positives"])


@query("e32_metrics_map", f"""WITH {Q.TX} SELECT CAST(count(*) AS VARCHAR) AS transaction_rows, CAST(sum(is_laundering) AS VARCHAR) AS positives FROM tx""")
def _(spark, sf):
    kv = P.metric_rows(A.detail(spark, sf).agg(
        F.count("*").alias("transaction_rows"), F.sum("is_laundering").alias("positives")
    ))
    return P.metrics_map(kv).select("metrics.transaction_rows", "metrics.positives")


# --- parity -------------------------------------------------------------------------------


def _two_feature_sets(spark, sf):
    """A stored feature set with two planted differences, and its re-derivation."""
    dwd = A.detail(spark, sf)
    accounts = I.account_layer(spark, sf)
    planted = I.all_features(spark, sf, accounts).withColumns({
        "amount_paid": F.col("amount_paid") + F.when(F.col("transaction_id").endswith("77"), 0.5).otherwise(0.0),
        "payment_format": F.when(F.col("transaction_id").endswith("33"), F.lit(None)).otherwise(F.col("payment_format")),
    })
    stored = I.stored(planted, "features")
    return stored, J.rederive_features(stored, dwd, accounts)


def _aligned(spark, sf, columns):
    stored, again = _two_feature_sets(spark, sf)
    return J.align_for_parity(stored, again, "transaction_id", columns)


@query("q09_numeric_parity", f"""WITH {Q.ALL_FEATURES}, names AS (SELECT unnest({QL.PARITY_FEATURES}) AS feature),
s AS (SELECT count(*) AS n, count(*) FILTER (transaction_id LIKE '%77') AS bad FROM feat)
SELECT feature, n AS compared_rows, CAST(CASE WHEN feature = 'amount_paid' THEN 0.5 ELSE 0 END AS DOUBLE) AS max_abs_diff,
  CASE WHEN feature = 'amount_paid' THEN bad ELSE 0 END AS mismatch_rows,
  CAST(CASE WHEN feature IN ({", ".join(repr(x) for x in QL.EXACT_FEATURES)}) THEN 0 ELSE 0.000001 END AS DOUBLE) AS tolerance,
  CASE WHEN feature = 'amount_paid' AND bad > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM names, s""")
def _(spark, sf):
    out = QL.numeric_parity(_aligned(spark, sf, QL.PARITY_FEATURES))
    return money(out, "max_abs_diff", digits=4)


@query("q10_categorical_parity", f"""WITH {Q.ALL_FEATURES}, names AS (SELECT unnest({QL.PARITY_CATEGORIES}) AS feature),
s AS (SELECT count(*) AS n, count(*) FILTER (transaction_id LIKE '%33') AS bad FROM feat)
SELECT feature, n AS compared_rows, CASE WHEN feature = 'payment_format' THEN bad ELSE 0 END AS mismatch_rows,
  CASE WHEN feature = 'payment_format' AND bad > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM names, s""")
def _(spark, sf):
    return QL.categorical_parity(_aligned(spark, sf, QL.PARITY_CATEGORIES))


@query("q11_row_parity", f"""WITH {Q.ALL_FEATURES}, s AS (SELECT count(*) AS n, CAST(sum(is_laundering) AS BIGINT) AS p FROM feat)
SELECT unnest(['feature_rows', 'distinct_transaction_id', 'positive_rows', 'warehouse_matched_rows', 'warehouse_unmatched_rows']) AS metric,
  unnest([n, n, p, n, 0]) AS "value", unnest(['PASS', 'PASS', 'FAIL', 'PASS', 'PASS']) AS status FROM s""")
def _(spark, sf):
    stored, again = _two_feature_sets(spark, sf)
    return QL.row_parity(stored, again, None, -1)


@query("q12_leakage_scan", "SELECT unnest(['laundering_event_count', 'risk_score_rule', 'from_laundering_event_count', 'from_risk_score_rule']) AS field, 'PASS' AS status")
def _(spark, sf):
    return QL.leakage_scan(I.sampled_features(spark, sf)).select("field", "status")


@query("q12_leakage_scan_accounts", """SELECT unnest(['laundering_event_count', 'risk_score_rule', 'from_laundering_event_count', 'from_risk_score_rule']) AS field,
  unnest(['FAIL', 'FAIL', 'PASS', 'PASS']) AS status""")
def _(spark, sf):
    return QL.leakage_scan(I.account_table(spark, sf)).select("field", "status")


@query("q12_required_scan", f"SELECT unnest({K.FEATURE_COLUMNS}) AS field, 'PASS' AS status")
def _(spark, sf):
    return QL.required_scan(I.sampled_features(spark, sf)).select("field", "status")


# --- text and file scans --------------------------------------------------------------------

_LINES = "lines AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents)"
_SECRET = r"(?i:(password|token|secret)\s*[:=]\s*[^\t\r\n ]+|Basic [A-Za-z0-9+/=]{12,}|CLUSTER_HADOOP.*PASSWORD\s*=)"


@query("q13_credential_scan", f"""WITH {_LINES}, h AS (SELECT count(*) AS n, count(*) FILTER (regexp_matches(line, '{_SECRET}')) AS c FROM lines)
SELECT n AS scanned_lines, c AS credential_hits, CASE WHEN c = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM h""")
def _(spark, sf):
    return QL.credential_scan(QL.text_lines(A.table(spark, sf, "documents"), "text"))


@query("q13_credential_hits", f"""WITH {_LINES} SELECT doc_id, count(*) AS hits FROM lines WHERE regexp_matches(line, '{_SECRET}') GROUP BY 1""")
def _(spark, sf):
    lines = QL.text_lines(A.table(spark, sf, "documents"), "text", "doc_id")
    return QL.credential_hits(lines).groupBy("doc_id").agg(F.count("*").alias("hits"))


# --- features ---------------------------------------------------------------------------------


@query("m01_build_features", f"WITH {Q.FEATURES} SELECT {Q.FEATURE_SELECT} FROM feat")
def _(spark, sf):
    return rounded_features(I.sampled_features(spark, sf))


@query("g08_ordered_features", f"WITH {Q.ALL_FEATURES} SELECT transaction_id, split FROM feat")
def _(spark, sf):
    return FE.ordered_features(I.all_features(spark, sf)).select("transaction_id", "split")


@query("m02_preprocess", f"""WITH {Q.ALL_FEATURES}, s AS (SELECT avg(amount_paid) AS m, stddev_samp(amount_paid) AS d,
  avg(from_debit_count) AS m2, stddev_samp(from_debit_count) AS d2 FROM feat)
SELECT transaction_id, round((amount_paid - m) / d, 6) + 0.0 AS amount_paid, round((from_debit_count - m2) / d2, 6) + 0.0 AS from_debit_count,
  dense_rank() OVER (ORDER BY payment_currency) - 1 AS currency_slot, dense_rank() OVER (ORDER BY payment_format) - 1 AS format_slot FROM feat, s""")
def _(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = I.stored(I.all_features(spark, sf), "features", group_mb=4)
    ready = B.prepare(rows, B.impute_values(rows))
    stages, out = B._encoder_stages(scale=True)
    model = Pipeline(stages=stages).fit(ready)
    x = vector_to_array(out)
    # the inputs are the scaled numbers, then one slot per currency, then one per format
    start = len(K.NUMERIC_FEATURES)
    currencies, formats = (len(labels) for labels in model.stages[0].labelsArray)

    def slot(first, size):
        return (F.array_position(F.slice(x, first + 1, size), 1.0) - 1).cast("int")

    def scaled(name):
        return F.round(x[K.NUMERIC_FEATURES.index(name)], 6).alias(name)

    return model.transform(ready).select(
        "transaction_id", scaled("amount_paid"), scaled("from_debit_count"),
        slot(start, currencies).alias("currency_slot"),
        slot(start + currencies, formats).alias("format_slot"),
    )


def _fitted(spark, sf, name):
    rows = I.stored(I.all_features(spark, sf), "features", group_mb=4)
    return B.train_baselines(rows, models=(name,)), rows


@query("m03_logreg_balanced")
def _(spark, sf):
    (fitted, test, _fill, _how), _rows = _fitted(spark, sf, "logistic_regression_balanced")
    return B.evaluate(fitted, test)


@query("m03_logreg_test_rows", f"""WITH {Q.ALL_FEATURES} SELECT count(*) FILTER (is_laundering = 1) AS positive_rows, count(*) FILTER (is_laundering = 0) AS negative_rows,
  2 AS probabilities FROM feat WHERE split = 'test'""")
def _(spark, sf):
    name = "logistic_regression_balanced"
    (fitted, test, _fill, _how), _rows = _fitted(spark, sf, name)
    scored = B.predict(fitted[name], test)
    wrong = F.count_if(~F.coalesce(F.col("score").between(0, 1), F.lit(False)) | ~F.col("prediction").eqNullSafe((F.col("score") > 0.5).cast("int")))
    return scored.agg(
        F.count_if(F.col(B.LABEL) == 1).alias("positive_rows"), F.count_if(F.col(B.LABEL) == 0).alias("negative_rows"),
        F.when(wrong == 0, 2).otherwise(0).alias("probabilities"),
    )


@query("m04_rf_balanced")
def _(spark, sf):
    (fitted, test, _fill, _how), _rows = _fitted(spark, sf, "random_forest_balanced")
    return B.evaluate(fitted, test)


_DRAWN = f"""draws AS (
  SELECT is_laundering AS y, CAST(concat('0x', substr(h, 1, 8)) AS BIGINT) % {BF.PRIME} AS a, CAST(concat('0x', substr(h, 9, 8)) AS BIGINT) % {BF.PRIME} AS b
  FROM (SELECT is_laundering, {Q.hashed(K.BOOTSTRAP_SEED)} AS h FROM feat WHERE split = 'train')),
sampled AS (
  SELECT tree, y, len(list_filter({BF.poisson_bounds()}, lambda z: z <= u)) AS k
  FROM (SELECT y, t AS tree, (a + (t + 1) * b) % {BF.PRIME} AS u FROM draws, (SELECT unnest(range(12)) AS t))),
boot AS (
  SELECT tree, count(*) FILTER (k > 0) AS sample_rows, CAST(coalesce(sum(k) FILTER (y = 0), 0) AS BIGINT) AS draws_0,
    CAST(coalesce(sum(k) FILTER (y = 1), 0) AS BIGINT) AS draws_1 FROM sampled GROUP BY 1)"""


def _subsample_forest(spark, sf, trees=12, depth=6):
    return B.train_balanced_subsample(I.stored(I.all_features(spark, sf), "features", group_mb=4), trees=trees, depth=depth)


# the rows and draws in the leaves of every tree add up to its bootstrap sample, and its weights balance that sample
@query("m04_bootstrap_weights", f"""WITH {Q.ALL_FEATURES}, {_DRAWN} SELECT CAST(tree AS INTEGER) AS tree, sample_rows, draws_0, draws_1,
  round((draws_0 + draws_1) / greatest(2 * draws_0, 1), 9) AS weight_0, round((draws_0 + draws_1) / greatest(2 * draws_1, 1), 9) AS weight_1 FROM boot""")
def _(spark, sf):
    forest, _scored, _names = _subsample_forest(spark, sf)
    nodes = spark.createDataFrame(forest.nodes())
    return nodes.filter("feature < 0").groupBy(F.col("tree").cast("int").alias("tree")).agg(
        F.sum("rows").alias("sample_rows"), F.sum("times_0").alias("draws_0"), F.sum("times_1").alias("draws_1"),
        F.round(F.max("weight_0"), 9).alias("weight_0"), F.round(F.max("weight_1"), 9).alias("weight_1"),
    )


@query("m04_rf_balanced_subsample")
def _(spark, sf):
    _forest, scored, _names = _subsample_forest(spark, sf, trees=20, depth=8)
    return B.metrics_once(scored, "random_forest_balanced_subsample")


@query("m07_importance")
def _(spark, sf):
    name = "random_forest_balanced"
    (fitted, _test, _fill, _how), rows = _fitted(spark, sf, name)
    return SV.top_features(B.importance(name, fitted[name], rows), 50)


# every number and every text of the training rows is an input, and their shares add up
@query("m07_importance_inputs", f"""WITH {Q.ALL_FEATURES} SELECT feature, 1.0 AS total_share FROM (
  SELECT unnest([{", ".join(f"'{c}'" for c in K.NUMERIC_FEATURES)}]) AS feature
  UNION ALL SELECT DISTINCT concat('payment_currency_', payment_currency) FROM feat WHERE split = 'train'
  UNION ALL SELECT DISTINCT concat('payment_format_', payment_format) FROM feat WHERE split = 'train')""")
def _(spark, sf):
    forest, _scored, names = _subsample_forest(spark, sf)
    shares = spark.createDataFrame(list(zip(names, forest.importance().tolist())), "feature string, share double")
    return shares.select("feature", F.lit(shares.agg(F.round(F.sum("share"), 9)).first()[0]).alias("total_share"))


def _scored_events(spark, sf):
    return A.table(spark, sf, "events").select(
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.round("value", 0).alias("score"), (F.col("value") >= 250).cast("int").alias("prediction"),
    )


_CELLS = """s AS (SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, round(value) AS score, CASE WHEN value >= 250 THEN 1 ELSE 0 END AS prediction FROM events),
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY 1),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM g WINDOW w AS (ORDER BY score DESC)),
auc AS (SELECT sum(pos * tp / (tp + fp)) / sum(pos) AS pr_auc, sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc FROM cum),
cells AS (SELECT count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp FROM s)"""


@query("m05_binary_metrics", f"""WITH {_CELLS} SELECT 'value' AS model, round(tp / (tp + fp), 8) AS "precision", round(tp / (tp + fn), 8) AS recall,
  round(2 * tp / (2 * tp + fp + fn), 8) AS f1, round(roc_auc, 8) AS roc_auc, round(pr_auc, 8) AS pr_auc, tn, fp, fn, tp FROM cells, auc""")
def _(spark, sf):
    out = ME.binary_metrics(_scored_events(spark, sf), "value")
    return money(out, "precision", "recall", "f1", "roc_auc", "pr_auc", digits=8)


@query("m06_confusion_long", f"""WITH {_CELLS} SELECT 'value' AS model, unnest([0, 0, 1, 1]) AS actual, unnest([0, 1, 0, 1]) AS predicted,
  unnest([tn, fp, fn, tp]) AS "count" FROM cells""")
def _(spark, sf):
    return ME.confusion_long(ME.binary_metrics(_scored_events(spark, sf), "value"))


@query("m06_confusion_report", f"""WITH {_CELLS} SELECT unnest(['true_negative', 'false_positive', 'false_negative', 'true_positive', 'test_rows',
  'actual_positive_rows', 'actual_negative_rows', 'predicted_positive_rows', 'predicted_negative_rows', 'precision', 'recall', 'pr_auc']) AS metric,
  unnest([CAST(tn AS VARCHAR), CAST(fp AS VARCHAR), CAST(fn AS VARCHAR), CAST(tp AS VARCHAR), CAST(tn + fp + fn + tp AS VARCHAR),
  CAST(tp + fn AS VARCHAR), CAST(tn + fp AS VARCHAR), CAST(tp + fp AS VARCHAR), CAST(tn + fn AS VARCHAR),
  printf('%.6f', tp / (tp + fp)), printf('%.6f', tp / (tp + fn)), printf('%.6f', pr_auc)]) AS "value" FROM cells, auc""")
def _(spark, sf):
    return ME.confusion_report(ME.binary_metrics(_scored_events(spark, sf), "value"))


@query("m10_anomaly_lift", """WITH c AS (SELECT quantile_cont(value, 0.97) AS q FROM events),
s AS (SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS p, count(*) FILTER (value > q) AS an,
  count(*) FILTER (value > q AND event_type = 'error') AS ap FROM events, c)
SELECT n AS sample_rows, p AS sample_positive_rows, round(p / n, 8) AS sample_positive_rate, an AS anomaly_rows, ap AS anomaly_positive_rows,
  round(ap / an, 8) AS anomaly_positive_rate, round((ap / an) / (p / n), 6) AS anomaly_lift_vs_sample, CAST(0.03 AS DOUBLE) AS contamination FROM s""")
def _(spark, sf):
    events = A.table(spark, sf, "events")
    cut = R.exact_quantile(events, "value", 0.97)
    scored = events.select(
        (F.col("event_type") == "error").cast("int").alias("is_laundering"),
        (F.col("value") > cut).cast("int").alias("anomaly_label"),
    )
    return ME.anomaly_lift(scored)


@query("g07_top_anomalies", """WITH c AS (SELECT quantile_cont(value, 0.97) AS q FROM events)
SELECT event_id AS transaction_id, value AS amount_paid, CASE WHEN value > q THEN 1 ELSE 0 END AS anomaly_label, event_type AS payment_format
FROM events, c ORDER BY value DESC, event_id LIMIT 50""")
def _(spark, sf):
    events = A.table(spark, sf, "events")
    cut = R.exact_quantile(events, "value", 0.97)
    scored = events.select(
        F.col("event_id").alias("transaction_id"), F.lit("").alias("split"), F.col("value").alias("amount_paid"),
        F.lit("").alias("payment_currency"), F.col("event_type").alias("payment_format"),
        F.lit(0).alias("is_cross_bank"), F.lit(0).alias("is_cross_currency"),
        (F.col("event_type") == "error").cast("int").alias("is_laundering"),
        F.col("value").alias("anomaly_score"), (F.col("value") > cut).cast("int").alias("anomaly_label"),
    )
    return SV.top_anomalies(scored).select("transaction_id", "amount_paid", "anomaly_label", "payment_format")


_IMPORTANCE = """imp AS (SELECT concat(CASE user_id % 7 WHEN 0 THEN 'payment_format_' WHEN 1 THEN 'payment_currency_' WHEN 2 THEN 'log_amount_paid'
    WHEN 3 THEN 'hour_sin' WHEN 4 THEN 'from_cross_bank_event_count' WHEN 5 THEN 'from_out_in_ratio' ELSE 'from_debit_count' END,
    CASE WHEN user_id % 7 < 2 THEN event_type ELSE '' END) AS feature,
  CAST(round(avg(CAST(value AS DECIMAL(10,2))), 2) AS DOUBLE) AS abs_importance FROM events GROUP BY 1)"""


def _importance(spark, sf):
    stems = ["payment_format_", "payment_currency_", "log_amount_paid", "hour_sin",
             "from_cross_bank_event_count", "from_out_in_ratio", "from_debit_count"]
    at = (F.col("user_id") % 7).cast("int")
    name = F.concat(
        F.element_at(F.array(*[F.lit(s) for s in stems]), at + 1),
        F.when(at < 2, F.col("event_type")).otherwise(""),
    )
    return A.table(spark, sf, "events").groupBy(name.alias("feature")).agg(
        F.round(F.avg("value"), 2).alias("abs_importance")
    )


@query("e30_feature_group_importance", f"""WITH {_IMPORTANCE}, g AS (SELECT *, CASE WHEN starts_with(feature, 'payment_format') THEN 'payment_format'
    WHEN starts_with(feature, 'payment_currency') THEN 'payment_currency' WHEN feature = 'log_amount_paid' THEN 'amount' WHEN feature = 'hour_sin' THEN 'time'
    WHEN contains(feature, 'cross_bank') THEN 'cross_institution_currency' WHEN feature LIKE '%_ratio' THEN 'account_ratio' ELSE 'account_behavior' END AS feature_group FROM imp)
SELECT feature_group, count(*) AS feature_count, round(sum(abs_importance), 2) AS total_importance, max(abs_importance) AS max_importance,
  round(sum(abs_importance) / (SELECT sum(abs_importance) FROM imp), 6) AS importance_share FROM g GROUP BY 1""")
def _(spark, sf):
    out = P.feature_group_importance(_importance(spark, sf))
    return money(money(out, "total_importance"), "importance_share", digits=6)


@query("g07_top_features", f"WITH {_IMPORTANCE} SELECT feature, abs_importance FROM imp ORDER BY abs_importance DESC, feature LIMIT 5")
def _(spark, sf):
    return SV.top_features(_importance(spark, sf), 5)


@query("m09_isolation_forest")
def _(spark, sf):
    rows = I.stored(I.all_features(spark, sf), "features", group_mb=4)
    return ISO.isolation_forest(rows).select("transaction_id", "anomaly_label", "anomaly_score")


# scores without ties: as many rows lie above the interpolated cut as the share says
@query("m09_anomaly_share", f"WITH {Q.TX} SELECT count(*) AS rows, count(*) - 1 - CAST(floor(0.97 * (count(*) - 1)) AS BIGINT) AS anomaly_rows FROM tx")
def _(spark, sf):
    rows = I.stored(I.all_features(spark, sf), "features", group_mb=4)
    return ISO.isolation_forest(rows).agg(F.count("*").alias("rows"), F.sum("anomaly_label").alias("anomaly_rows"))
