from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskweave.functions import rules
from riskweave.operators import joins as J, marts as M, profiling as P, ranking as R, serving as SV, skew

DWD = (
    "transaction_id string, timestamp string, transaction_minute string, from_bank string, from_account string, "
    "to_bank string, to_account string, amount_received double, amount_paid double, payment_currency string, "
    "payment_format string, is_laundering int, is_cross_bank int, is_cross_currency int"
)


def tx(i, a, b, paid, received=None, minute="m1", fmt="ACH", label=0, bank=0, currency=0):
    return (f"t{i}", "ts", minute, "1", a, "2", b, paid if received is None else received, paid, "X", fmt,
            label, bank, currency)


def brute_accounts(data):
    out = defaultdict(lambda: [0, 0, 0.0, 0.0, 0.0, set(), 0, 0, 0])
    for r in data:
        a, b, received, paid, label, bank, cur = r[4], r[6], r[7], r[8], r[11], r[12], r[13]
        x = out[a]
        x[0] += 1; x[2] += paid; x[4] = max(x[4], paid); x[5].add(b); x[6] += label; x[7] += bank; x[8] += cur
        y = out[b]
        y[1] += 1; y[3] += received; y[5].add(a); y[6] += label; y[7] += bank; y[8] += cur
    return out


def check_accounts(rows, data):
    got = {r["account_number"]: r for r in M.account_base(rows(DWD, data)).collect()}
    want = brute_accounts(data)
    assert set(got) == set(want)
    for k, (d, c, o, i, top, peers, label, bank, cur) in want.items():
        r = got[k]
        assert (r["debit_count"], r["credit_count"], r["total_event_count"]) == (d, c, d + c), k
        assert r["out_amount"] == pytest.approx(o) and r["in_amount"] == pytest.approx(i)
        assert r["net_amount"] == pytest.approx(i - o) and r["max_out_amount"] == top
        assert r["counterparty_count"] == len(peers)
        assert (r["laundering_event_count"], r["cross_bank_event_count"], r["cross_currency_event_count"]) == (label, bank, cur)


def test_account_features_with_self_transfers(rows):
    check_accounts(rows, [
        tx(1, "A", "A", 5.0, 4.0, label=1, bank=1), tx(2, "A", "B", 7.0), tx(3, "B", "A", 2.0, 1.0, currency=1),
        tx(4, "C", "A", -3.0), tx(5, "C", "C", 1.0), tx(6, "D", "B", 0.5, label=1),
    ])


def test_account_features_random_with_a_hot_account(rows):
    rnd = random.Random(7)
    data = []
    for i in range(900):
        a = "HOT" if i % 3 == 0 else f"A{rnd.randrange(25)}"
        data.append(tx(i, a, f"A{rnd.randrange(25)}", round(rnd.uniform(-5, 100), 2), round(rnd.uniform(0, 100), 2),
                       label=rnd.randrange(2), bank=rnd.randrange(2), currency=rnd.randrange(2)))
    check_accounts(rows, data)


def test_minute_kpi_counts_accounts_of_both_sides(rows):
    data = [tx(1, "A", "B", 1.0, label=1), tx(2, "B", "A", 2.0), tx(3, "C", "C", 3.0), tx(4, "A", "B", 4.0, minute="")]
    got = {r["transaction_minute"]: r for r in M.minute_kpi(rows(DWD, data)).collect()}
    assert got["m1"]["distinct_account_count"] == 3 and got["m1"]["transaction_count"] == 3
    assert got["m1"]["laundering_rate"] == pytest.approx(1 / 3) and got["m1"]["total_amount_paid"] == 6.0
    assert got[""]["transaction_count"] == 1


def test_negative_amounts_keep_a_zero_maximum(rows):
    df = rows(DWD, [tx(1, "A", "B", -1.0), tx(2, "A", "B", -2.0)])
    assert M.payment_kpi(df).first()["max_amount_paid"] == 0.0
    assert M.account_base(df).filter("account_number = 'A'").first()["max_out_amount"] == 0.0


def test_rule_score(rows):
    df = rows(
        "laundering_event_count long, max_out_amount double, counterparty_count long, cross_currency_event_count long",
        [(0, 1.0, 19, 4), (1, 1.0, 0, 0), (0, 10.0, 20, 5), (2, 10.0, 20, 5)],
    )
    assert [r[0] for r in df.select(rules.account_rule_score(10.0)).collect()] == [0, 3, 4, 7]


def test_large_candidates_hits(rows):
    df = rows(DWD, [
        tx(1, "A", "B", 500.0), tx(2, "A", "B", 2e6), tx(3, "A", "B", 6e6), tx(4, "A", "B", 3e6, bank=1, currency=1),
        tx(5, "A", "B", 600_000.0, bank=1, currency=1), tx(6, "A", "B", 600_000.0, bank=1),
    ])
    got = {r["transaction_id"]: r["rule_hits"] for r in M.large_candidates(df, 1_200_000.0).collect()}
    assert got == {
        "t2": "amount_ge_q995;amount_ge_absolute_threshold", "t3": "amount_ge_q995;amount_ge_absolute_threshold",
        "t4": "amount_ge_q995;amount_ge_absolute_threshold;cross_bank_cross_currency_high_amount",
        "t5": "cross_bank_cross_currency_high_amount",
    }


def test_negative_quantile_does_not_lose_candidates(rows):
    df = rows(DWD, [tx(1, "A", "B", -1.0, bank=1, currency=1), tx(2, "A", "B", -10.0)])
    got = {r["transaction_id"]: r["rule_hits"] for r in M.large_candidates(df, -4.0).collect()}
    assert got == {"t1": "amount_ge_q995;cross_bank_cross_currency_high_amount"}


def test_quantile_paths_agree(spark, monkeypatch):
    rnd = random.Random(3)
    # a third of the rows share one value
    data = [5.0 if i % 3 == 0 else round(rnd.uniform(0, 20), 1) for i in range(3000)]
    df = spark.createDataFrame([(x,) for x in data] + [(None,)], "x double")
    srt = sorted(data)

    def want(q):
        p = (len(srt) - 1) * q
        k = int(p)
        return srt[k] if p == k else srt[k] * (1 - (p - k)) + srt[k + 1] * (p - k)

    qs = [0.0, 0.1, 0.24, 0.5, 0.57, 0.995, 1.0]
    expected = [want(q) for q in qs]
    assert R.exact_quantiles(df, "x", qs) == pytest.approx(expected)
    for accuracy in (1000, 100, 10):
        monkeypatch.setattr(R, "_ACCURACY", accuracy)
        assert R.exact_quantiles(df, "x", qs) == pytest.approx(expected)
    assert R.exact_quantile(df.filter("x > 100"), "x") == 0.0


def test_global_row_number_and_running_totals(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"), (F.col("id") % 3).alias("v"))
    got = R.global_row_number(df, [F.col("k")], parts=5).collect()
    assert all(r["row_number"] == r["k"] + 1 for r in got) and len(got) == 1000
    total = R.running_totals(df, [F.desc("k")], {"cum": "v"}, parts=5).orderBy(F.desc("k")).collect()
    run = 0
    for r in total:
        run += r["v"]
        assert r["cum"] == run


def test_label_distribution_of_nothing(rows):
    df = rows("is_laundering int", [])
    assert [tuple(r) for r in P.label_distribution(df).collect()] == [(0, 0, 0.0), (1, 0, 0.0)]


def test_hot_key_join_equals_plain_join(rows):
    left = rows("from_account string, v int", [("H", i) for i in range(50)] + [("B", 1), (None, 2), ("Z", 3)])
    right = rows("from_account string, w int", [("H", 10), ("B", 20), ("C", 30)])
    plain = sorted(map(str, left.join(right, "from_account", "left").collect()))
    split = skew.join_unique(left, right, "from_account", "left", hot=["H"])
    assert sorted(map(str, split.collect())) == plain


def test_feature_defaults_and_ratios(rows):
    t = rows("transaction_id string, from_account string, amount_paid double, transaction_hour int", [("t1", "A", 0.0, 6), ("t2", "Q", 1.0, None)])
    acc = rows(
        "account_number string, total_event_count long, debit_count long, credit_count long, out_amount double, "
        "in_amount double, max_out_amount double, counterparty_count long, cross_bank_event_count long, "
        "cross_currency_event_count long", [("A", 4, 3, 1, 9.0, -2.0, 5.0, 2, 1, 0)],
    )
    out = {r["transaction_id"]: r for r in J.derive_features(J.fill_feature_defaults(J.join_account_features(t, acc, []))).collect()}
    assert out["t1"]["from_out_in_ratio"] == 3.0 and out["t1"]["from_debit_credit_ratio"] == 1.5
    assert out["t1"]["hour_sin"] == 1.0 and out["t2"]["hour_sin"] is None
    assert out["t2"]["from_total_event_count"] == 0 and out["t2"]["from_out_in_ratio"] == 0.0


def test_rollup_counts_high_risk_events(rows):
    schema = ("event_account string, counterparty_account string, amount_paid double, risk_score int, risk_level string, "
              "risk_reasons string, rule_hits string, payment_currency string")
    df = rows(schema, [
        (" A ", "B", 1.25, 90, "CRITICAL", "CROSS_BANK;", "", "Yuan"), ("A", "", 2.0, 40, "MEDIUM", "", "", "Euro"),
        ("A", "B", None, 61, None, None, "R_CROSS_CURRENCY;", "Yuan"), ("", "B", 9.0, 90, "HIGH", "", "", ""), (None, "B", 9.0, 90, "HIGH", "", "", ""),
    ])
    r = SV.ads_account_rollup(df, F.lit("now")).collect()
    assert len(r) == 1 and r[0]["account_number"] == "A"
    assert (r[0]["total_event_count"], r[0]["counterparty_count"], r[0]["laundering_event_count"]) == (3, 1, 2)
    assert (r[0]["cross_bank_event_count"], r[0]["cross_currency_event_count"]) == (1, 2)
    assert str(r[0]["out_amount"]) == "3.25" and r[0]["risk_score_rule"] == 90.0


def test_pairs_are_dealt_by_the_number_of_rows(spark, monkeypatch):
    dwd = spark.range(4000).select(
        F.concat(F.lit("A"), F.col("id") % 37).alias("from_account"), F.concat(F.lit("A"), F.col("id") % 41).alias("to_account"),
        (F.col("id") * 1.25).alias("amount_paid"), (F.col("id") * 1.5).alias("amount_received"),
        *[(F.col("id") % k == 0).cast("int").alias(c) for k, c in ((3, "is_laundering"), (5, "is_cross_bank"), (7, "is_cross_currency"))],
    )
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(M, "PAIR_ROWS", 4000 // (few + 5))
    assert M.account_pairs(dwd, 4000).rdd.getNumPartitions() >= few + 5
    assert sorted(M.account_base(dwd, 4000).collect()) == sorted(M.account_base(dwd).collect())
