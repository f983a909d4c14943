from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.operators import features as FE, marts as M
from riskweave.plans import modeling, realtime
from riskweave.session import staged


def test_realtime_flow(spark, dwd, tmp_path):
    accounts = staged(M.account_base(dwd), "accounts")
    features = staged(FE.build_features(dwd, accounts, 400), "features")
    inputs = staged(realtime.make_scoring_sample(features, dwd, "r7", rows=300), "inputs")
    assert inputs.count() == 300
    root = str(tmp_path / "rt")
    row = realtime.run_scoring(inputs, root, "r7", ["transaction_id"]).first()
    assert row["status"] == "PASS" and row["raw_event_count"] > 0
    events = spark.read.parquet(f"{root}/ads_events")
    assert events.count() == row["raw_event_count"]
    assert spark.read.parquet(f"{root}/search").count() == row["raw_event_count"]
    ads = spark.read.parquet(f"{root}/ads_accounts")
    assert ads.count() == row["keys_written"]
    assert ads.agg(F.sum("total_event_count")).first()[0] == row["raw_event_count"]


def test_modeling_flow(spark, dwd, tmp_path):
    accounts = staged(M.account_base(dwd), "accounts")
    features = staged(FE.build_features(dwd, accounts, 400), "features")
    out = str(tmp_path / "ml")
    modeling.explore(dwd, out, "r1")
    best = modeling.train_and_report(features, out, "r1", trees=5, depth=3).first()
    assert best["pr_auc"] > features.filter("is_laundering = 1").count() / features.count()
    assert spark.read.parquet(f"{out}/confusion_matrix").agg(F.sum("count")).first()[0] == features.filter("split = 'test'").count()
    groups = spark.read.parquet(f"{out}/feature_groups")
    assert abs(groups.agg(F.sum("importance_share")).first()[0] - 1) < 1e-9
    lift = modeling.report_anomalies(features, out, "r1", trees=10).first()
    assert lift["sample_rows"] == features.count() and lift["anomaly_rows"] > 0
    assert spark.read.parquet(f"{out}/score_deciles").count() == 10
