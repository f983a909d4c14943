from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from riskweave import constants as K
from riskweave.operators import (
    features as FE, joins as J, marts as M, metrics as ME, quality as Q, ranking as R, sampling as SA,
)


def hashed(i, seed):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


@pytest.fixture(scope="module")
def labelled(spark):
    data = [(f"t{i}", int(i % 11 == 0)) for i in range(1000)]
    return spark.createDataFrame(data, "transaction_id string, is_laundering int")


@pytest.mark.parametrize("n", [0, 1, 7, 500, 909, 5000])
def test_undersample_is_exact(labelled, n):
    got = {r[0] for r in SA.undersample(labelled, n, 5).select("transaction_id").collect()}
    pos = {f"t{i}" for i in range(1000) if i % 11 == 0}
    neg = sorted((f"t{i}" for i in range(1000) if i % 11), key=lambda x: hashed(x, 5))[:n]
    assert got == pos | set(neg)


def test_first_by_hash_inside_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(SA, "_BUCKET_CHARS", 1)  # few buckets: the cut falls inside one
    df = spark.createDataFrame([(f"x{i}",) for i in range(300)], "transaction_id string")
    for n in (1, 10, 123, 299, 300):
        got = [r[0] for r in SA.first_by_hash(df, {0: n}, F.lit(0), "transaction_id", 9).collect()]
        assert sorted(got) == sorted(sorted((f"x{i}" for i in range(300)), key=lambda x: hashed(x, 9))[:n])


def test_split_quotas(labelled):
    got = SA.stratified_split(labelled, 0.25, 3).groupBy("is_laundering", "split").count().collect()
    sizes = {(r[0], r[1]): r[2] for r in got}
    pos, neg = 91, 909
    assert sum(v for (c, s), v in sizes.items() if s == "test") == math.ceil(0.25 * 1000)
    assert sizes[(1, "test")] in (22, 23) and sizes[(1, "test")] + sizes[(1, "train")] == pos
    assert sizes[(0, "test")] + sizes[(0, "train")] == neg
    assert SA.class_quotas({0: 200_000, 1: 5_177}, 0.25) == {0: 50_000, 1: 1_295}


def test_stored_split_is_kept_only_when_usable(labelled):
    good = SA.stratified_split(labelled, 0.5, 1)
    kept, how = SA.use_or_make_split(good)
    assert how == "stratified_random_75_25" and kept.exceptAll(good).count() == 0
    _, how = SA.use_or_make_split(labelled.withColumn("split", F.lit("train")))
    assert how == "stratified_random_fallback_75_25"
    _, how = SA.use_or_make_split(labelled)
    assert how == "stratified_random_fallback_75_25"


def tier_frame(spark, n, candidates, positives):
    rnd = random.Random(n)
    rows = []
    for i in range(n):
        cand = i < candidates
        rows.append((f"t{i}", int(rnd.random() < positives), 2e6 if cand else 1.0, int(cand), int(cand), 0, 0, 0.0, 0.0))
    return spark.createDataFrame(
        rows, "transaction_id string, is_laundering int, amount_paid double, is_cross_bank int, is_cross_currency int, "
        "from_cross_bank_event_count long, from_cross_currency_event_count long, from_out_in_ratio double, "
        "from_debit_credit_ratio double")


@pytest.mark.parametrize("n,cand,pos,want,quota", [(500, 300, 0.1, 100, 10), (500, 30, 0.1, 100, 10), (500, 480, 0.02, 200, 5), (50, 20, 0.5, 100, 200)])
def test_tiers(spark, n, cand, pos, want, quota):
    df = tier_frame(spark, n, cand, pos)
    n_pos = df.filter("is_laundering = 1").count()
    got = SA.tiered_sample(df, want, 0.8, quota, 4)
    tiers = {r[0]: r[1] for r in got.groupBy("_tier").count().collect()}
    target = min(want, n)
    q1 = min(quota, target, n_pos)
    assert got.count() == target and got.select("transaction_id").distinct().count() == target
    assert tiers.get(1, 0) == q1
    chosen = {r[0] for r in got.filter("_tier = 1").select("transaction_id").collect()}
    left = [r for r in df.collect() if r["transaction_id"] not in chosen]
    cands = sum(r["amount_paid"] > 1 for r in left)
    q2 = min(int(target * 0.8), target - q1, cands)
    q3 = min(target - q1 - q2, len(left) - cands)
    assert tiers.get(3, 0) == q3 and tiers.get(2, 0) == target - q1 - q3


def test_anomaly_sample_recuts(labelled):
    assert SA.anomaly_sample(labelled, 50).count() == 50
    big = SA.anomaly_sample(labelled, 200)
    assert big.count() == 200 and big.filter("is_laundering = 1").count() == 91


def test_head_sample_strict(labelled):
    with pytest.raises(ValueError):
        SA.head_sample(labelled, 5000, ["transaction_id"], strict=True)


@pytest.mark.parametrize("fraction", [0.001, 0.05, 0.3])
def test_head_sample_over_guessed_cut(spark, fraction):
    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).alias("k"), (F.col("id") % 2).alias("z"))
    for order in (["k"], ["z", "k"]):
        want = [tuple(r) for r in df.orderBy(*order).limit(1500).collect()]
        got = SA.head_sample(df, 1500, order, fraction=fraction).collect()
        assert [tuple(r) for r in got] == want


def test_metrics_against_definition(spark):
    rnd = random.Random(1)
    data = [(int(rnd.random() < 0.3), round(rnd.random(), 1), int(rnd.random() < 0.4)) for _ in range(400)]
    row = ME.binary_metrics(spark.createDataFrame(data, "label int, score double, prediction int")).first()
    pos = [s for y, s, _ in data if y]
    neg = [s for y, s, _ in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, before = 0.0, 0.0
    for t in sorted({s for _, s, _ in data}, reverse=True):
        tp = sum(s >= t for s in pos)
        fp = sum(s >= t for s in neg)
        recall = tp / len(pos)
        ap += (recall - before) * tp / (tp + fp)
        before = recall
    assert row["roc_auc"] == pytest.approx(auc) and row["pr_auc"] == pytest.approx(ap)
    tp = sum(y and p for y, _, p in data)
    fp = sum((not y) and p for y, _, p in data)
    assert row["precision"] == pytest.approx(tp / (tp + fp)) and row["tp"] == tp and row["fp"] == fp
    one = spark.createDataFrame([(0, 0.1, 0), (0, 0.2, 0)], "label int, score double, prediction int")
    r = ME.binary_metrics(one).first()
    assert (r["roc_auc"], r["pr_auc"], r["precision"], r["recall"], r["f1"]) == (0, 0, 0, 0, 0)
    assert ME.confusion_report(ME.binary_metrics(one)).count() == 12


@pytest.mark.parametrize("n", [10, 23, 100])
def test_deciles(spark, n):
    df = spark.createDataFrame([(f"t{i:03d}", float(i // 3), i % 2) for i in range(n)],
                               "transaction_id string, anomaly_score double, is_laundering int")
    got = {r["score_decile"]: r["rows"] for r in R.score_deciles(df).collect()}
    want = {}
    for r in range(n):
        d = max(1, math.ceil(r * 10 / (n - 1)))
        want[d] = want.get(d, 0) + 1
    assert got == want


def test_expectation_smoke(rows):
    df = rows("transaction_id string, account_number string, amount_paid double, payment_currency string, risk_score double", [
        ("t1", "a", 10.0, "USD", 0.1), ("t2", "b", 20.0, "EUR", 0.9), ("t3", "c", 0.0, "CNY", 1.0)])
    checks = [
        Q.expect_row_count_between(1, 10), Q.expect_not_null("transaction_id"), Q.expect_not_null("account_number"),
        Q.expect_between("amount_paid", 0), Q.expect_between("risk_score", 0, 1), Q.expect_in_set("payment_currency", ["USD", "EUR", "CNY"]),
    ]
    assert Q.expectation_totals(Q.run_expectations(df, checks)).first().asDict() == {
        "evaluated_expectations": 6, "successful_expectations": 6, "all_success": True}
    blanks = df.withColumn("transaction_id", F.lit(""))
    assert Q.run_expectations(blanks, [Q.expect_not_null("transaction_id")]).first()["status"] == "PASS"
    empty = Q.run_expectations(df.limit(0), [Q.row_count_positive(), Q.expect_not_null("risk_score"),
                                             Q.expect_columns_match_set(df, ["risk_score"])])
    assert [r["status"] for r in empty.collect()] == ["FAIL", "PASS", "PASS"]


def test_quality_rollup(rows):
    checks = rows("g string, status string", [("a", "PASS"), ("a", "WARN"), ("b", "FAIL")])
    assert Q.quality_status_rollup(checks).first()["status"] == "FAIL"
    by = {r["g"]: r["status"] for r in Q.quality_status_rollup(checks, "g").collect()}
    assert by == {"a": "PASS", "b": "FAIL"}


def test_parity_finds_an_injected_difference(spark, dwd):
    from riskweave.session import staged

    accounts = staged(M.account_base(dwd), "accounts")
    feats = staged(FE.build_features(dwd, accounts, 300), "feats")
    assert feats.columns == K.FEATURE_COLUMNS
    again = J.rederive_features(feats, dwd, accounts)
    same = J.align_for_parity(feats, again, "transaction_id", Q.PARITY_FEATURES)
    assert {r["status"] for r in Q.numeric_parity(same).collect()} == {"PASS"}
    first = feats.orderBy("transaction_id").first()["transaction_id"]
    broken = feats.withColumn("hour_cos", F.when(F.col("transaction_id") == first, 9.0).otherwise(F.col("hour_cos")))
    bad = J.align_for_parity(broken, again, "transaction_id", Q.PARITY_FEATURES)
    failed = [r["feature"] for r in Q.numeric_parity(bad).collect() if r["status"] == "FAIL"]
    assert failed == ["hour_cos"]
    nothing = Q.numeric_parity(bad.limit(0))
    assert {r["status"] for r in nothing.collect()} == {"FAIL"}
    lost = Q.row_parity(feats, again.filter(F.col("transaction_id") != first), feats.count())
    assert {r["metric"]: r["status"] for r in lost.collect()}["warehouse_unmatched_rows"] == "FAIL"
    assert {r["status"] for r in Q.leakage_scan(feats).collect()} == {"PASS"}
    assert {r["status"] for r in Q.required_scan(feats).collect()} == {"PASS"}


def test_credential_scan(rows):
    df = rows("text string", [("fine\npassword: hunter2\r\nok",), ("Basic QWxhZGRpbjpvcGVu now",), ("basic training",), ("secret santa",),
                              ("TOKEN = x",), ("CLUSTER_HADOOP_X_PASSWORD =",)])
    row = Q.credential_scan(Q.text_lines(df, "text")).first()
    assert (row["scanned_lines"], row["credential_hits"], row["status"]) == (8, 4, "FAIL")


def test_isolation_forest_finds_outliers(spark):
    from riskweave.models.isolation import isolation_forest

    rnd = random.Random(2)
    names = K.NUMERIC_FEATURES
    rows = [(f"t{i}", *[rnd.gauss(0, 1) for _ in names]) for i in range(400)]
    rows += [(f"out{i}", *[rnd.choice((-1, 1)) * rnd.uniform(8, 12) for _ in names]) for i in range(8)]
    rows[3] = ("t3", None, *rows[3][2:])  # a gap is filled by the median
    df = spark.createDataFrame(rows, "transaction_id string, " + ", ".join(f"{n} double" for n in names))
    out = isolation_forest(df, trees=30, contamination=0.03).collect()
    flagged = {r["transaction_id"] for r in out if r["anomaly_label"] == 1}
    assert len(out) == 408 and {f"out{i}" for i in range(8)} <= flagged and len(flagged) <= 13
    assert all((r["anomaly_score"] > 0) == (r["anomaly_label"] == 1) for r in out)


def test_one_hot_of_unknown_value_is_zero(spark, dwd):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from riskweave.models import baseline as B

    feats = FE.build_features(dwd, M.account_base(dwd), 100).limit(60)
    ready = B.prepare(feats, B.impute_values(feats))
    stages, out = B._encoder_stages(scale=False)
    model = Pipeline(stages=stages).fit(ready)
    odd = ready.withColumns({"payment_format": F.lit("never seen"), "payment_currency": F.lit("zzz")}).limit(1)
    tail = model.transform(odd).select(F.slice(vector_to_array(out), len(K.NUMERIC_FEATURES) + 1, 100)).first()[0]
    assert tail and set(tail) == {0.0}


def test_edge_buckets_are_cut_by_further_digits(spark, monkeypatch):
    from riskweave.operators import sampling as SA

    df = spark.range(3000).select(F.col("id").alias("transaction_id"), (F.col("id") % 3 == 0).cast("int").alias("is_laundering"))
    monkeypatch.setattr(SA, "_BUCKET_CHARS", 1)
    want = {r[0] for r in SA.undersample(df, 700).select("transaction_id").collect()}
    monkeypatch.setattr(SA, "_EDGE_ROWS", 2)
    assert {r[0] for r in SA.undersample(df, 700).select("transaction_id").collect()} == want
    assert len(want) == 1700
    parts = {(r[0], r[1]): r[2] for r in SA.stratified_split(df, 0.25).groupBy("is_laundering", "split").count().collect()}
    assert parts == {(0, "test"): 500, (0, "train"): 1500, (1, "test"): 250, (1, "train"): 750}
