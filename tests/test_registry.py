from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_points
from riskweave.operators import marts as M
from riskweave.sources import adapters as A


def test_every_inventory_section_is_registered():
    names = set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= names
    for name in names - set(entry_points._text_queries()[0]):
        assert re.fullmatch(r"[a-z][0-9]{2}_[a-z0-9_]+", name), name
    ids = {n.split("_")[0] for n in names}
    want = {f"a{i:02d}" for i in range(1, 11)} | {f"b{i:02d}" for i in range(1, 23)} | {f"c{i:02d}" for i in range(1, 8)}
    want |= {f"d{i:02d}" for i in range(1, 9)} | {f"e{i:02d}" for i in range(1, 33)} | {f"f{i:02d}" for i in range(1, 4)}
    want |= {f"g{i:02d}" for i in range(1, 10)} | {f"h{i:02d}" for i in range(1, 6)} | {f"i{i:02d}" for i in range(1, 5)}
    want |= {f"j{i:02d}" for i in range(1, 12)} | {f"w{i:02d}" for i in (1, 2, 4, 5, 6, 7, 8, 9, 10, 11, 12)}
    want |= {f"m{i:02d}" for i in (1, 2, 3, 4, 5, 6, 7, 9, 10)} | {f"q{i:02d}" for i in range(1, 15)}
    assert want - ids == set()


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "risk_score_rule" in df.columns


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, dwd):
    text = plan(M.large_candidates(dwd, 6e6).select("transaction_id", "amount_paid"))
    assert "GreaterThanOrEqual(amount_paid" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "payment_format" not in schema and "timestamp" not in schema


def test_no_cross_or_nested_loop_joins(spark, sf, dwd):
    for df in (M.account_base(dwd), M.minute_kpi(dwd), M.payment_kpi(dwd), A.detail(spark, sf), A.bulk_detail(spark, sf)):
        text = plan(df)
        assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["e09_account_features", "e08_minute_kpi", "j01_risk_rules_v0", "b06_build_dwd_transactions"])
def test_results_do_not_depend_on_partitioning(spark, sf, name):
    fn = entry_points.queries()[name]
    first = fn(spark, sf)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        second = fn(spark, sf)
        assert first.exceptAll(second).count() == 0 and second.exceptAll(first).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
