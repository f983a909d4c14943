"""The modelling flow end to end: EDA, baselines, explanation and anomaly reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweave import constants as K
from riskweave.models import baseline as B, isolation as ISO
from riskweave.operators import (
    metrics as ME, profiling as P, ranking as R, sampling as SA, serving as SV,
)
from riskweave.sinks.tables import write_layer


def explore(dwd: DataFrame, out: str, run_id: str) -> dict[str, str]:
    """Label distribution, EDA metrics and label rates per dimension and amount band."""
    tables = {
        "label_distribution": P.label_distribution(dwd),
        "eda_metrics": P.metric_rows(P.eda_metrics(dwd)),
        "payment_format_rates": P.group_rate(dwd, "payment_format"),
        "payment_currency_rates": P.group_rate(dwd, "payment_currency"),
        "amount_bin_rates": P.amount_bin_rates(dwd),
        "dimension_rates": P.dimension_rates(dwd),
    }
    return {name: write_layer(df, out, name, run_id, csv=True) for name, df in tables.items()}


def train_and_report(
    features: DataFrame, out: str, run_id: str, trees: int = 80, depth: int = 12
) -> DataFrame:
    """Fit both baselines, write metrics, confusion, importance and groups; returns the best row."""
    fitted, test, _fill, strategy = B.train_baselines(features, trees=trees, depth=depth)
    metrics = B.evaluate(fitted, test)
    write_layer(metrics, out, "baseline_metrics", run_id)
    stored = features.sparkSession.read.parquet(f"{out}/baseline_metrics/run_id={run_id}")
    best = R.best_model(stored)
    name = best.first()["model"]
    importance = SV.top_features(B.importance(name, fitted[name], features), 50)
    tables = {
        "split_summary": P.split_summary(features).withColumn("strategy", F.lit(strategy)),
        "class_balance": P.class_balance(features),
        "confusion_matrix": ME.confusion_long(best),
        "confusion_report": ME.confusion_report(best),
        "feature_importance": importance,
        "feature_groups": P.feature_group_importance(importance),
    }
    for table, df in tables.items():
        write_layer(df, out, table, run_id)
    return best


def report_anomalies(
    features: DataFrame, out: str, run_id: str, trees: int = 100,
    size: int | None = None, contamination: float = K.ANOMALY_CONTAMINATION,
) -> DataFrame:
    """Isolation-forest scores with lift, deciles and the top rows; returns the lift row.

    The whole table is scored; ``size`` limits it to an anomaly sample where wanted.
    """
    rows = features if size is None else SA.anomaly_sample(features, size)
    scored = ISO.isolation_forest(rows, trees, contamination)
    lift = ME.anomaly_lift(scored, contamination)
    write_layer(SV.top_anomalies(scored), out, "top_anomalies", run_id)
    write_layer(R.score_deciles(scored), out, "score_deciles", run_id)
    write_layer(lift, out, "anomaly_summary", run_id)
    return lift
