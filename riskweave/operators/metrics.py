"""Binary-classification and anomaly metrics as distributed aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K
from riskweave.functions.columns import rate
from riskweave.operators.profiling import metric_rows
from riskweave.operators.ranking import running_totals


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return scored.agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"),
    )


def ranking_metrics(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(roc_auc, pr_auc): rank-sum AUC and average precision, ties grouped.

    Rows collapse to one per distinct score (map-side combine, so a frequent score is one
    row); running totals over the scores come from range partitions, not one task.
    With a single class both values are 0.
    """
    y = (F.col(label) == 1).cast("long")
    per_score = scored.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )
    curve = running_totals(per_score, [F.desc("s")], {"tp": "pos", "fp": "neg"})
    pos, neg = F.sum("pos"), F.sum("neg")
    ap = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.nullif(pos, F.lit(0))
    won = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2))
    auc = won / F.nullif(pos.cast("double") * neg, F.lit(0.0))
    both = (pos > 0) & (neg > 0)
    return curve.agg(
        F.when(both, auc).otherwise(F.lit(0.0)).alias("roc_auc"),
        F.when(both, ap).otherwise(F.lit(0.0)).alias("pr_auc"),
    )


def binary_metrics(
    scored: DataFrame, model: str = "model", label: str = "label", score: str = "score",
    prediction: str = "prediction",
) -> DataFrame:
    """One row: precision, recall, F1, ROC-AUC, average precision and the four cells."""
    cells = confusion(scored, label, prediction)
    ranks = ranking_metrics(scored, label, score)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.withColumns({c: ranks.select(c).scalar() for c in ("roc_auc", "pr_auc")}).select(
        F.lit(model).alias("model"),
        rate(tp, tp + fp).alias("precision"),
        rate(tp, tp + fn).alias("recall"),
        rate(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "roc_auc", "pr_auc", "tn", "fp", "fn", "tp",
    )


def confusion_long(metrics: DataFrame) -> DataFrame:
    """(model, actual, predicted, count): four rows per model."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("count"))
        for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ])
    return metrics.select("model", F.inline(cells))


def confusion_report(metrics: DataFrame) -> DataFrame:
    """Twelve (metric, value) rows about one model row."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def six(name: str) -> Column:
        return F.format_string("%.6f", F.col(name))

    return metric_rows(
        metrics.select(
            tn.alias("true_negative"), fp.alias("false_positive"), fn.alias("false_negative"),
            tp.alias("true_positive"), (tn + fp + fn + tp).alias("test_rows"),
            (tp + fn).alias("actual_positive_rows"), (tn + fp).alias("actual_negative_rows"),
            (tp + fp).alias("predicted_positive_rows"),
            (tn + fn).alias("predicted_negative_rows"),
            six("precision").alias("precision"), six("recall").alias("recall"),
            six("pr_auc").alias("pr_auc"),
        )
    )


def anomaly_lift(
    scored: DataFrame, contamination: float = K.ANOMALY_CONTAMINATION,
    label: str = "is_laundering", flag: str = "anomaly_label",
) -> DataFrame:
    """Rows, positives and rates of the sample and of its anomalies, and their ratio."""
    y, a = F.col(label) == 1, F.col(flag) == 1
    wide = scored.agg(
        F.count("*").alias("n"), F.count_if(y).alias("p"),
        F.count_if(a).alias("an"), F.count_if(a & y).alias("ap"),
    )
    overall, found = rate(F.col("p"), F.col("n")), rate(F.col("ap"), F.col("an"))
    return wide.select(
        F.col("n").alias("sample_rows"), F.col("p").alias("sample_positive_rows"),
        F.round(overall, 8).alias("sample_positive_rate"),
        F.col("an").alias("anomaly_rows"), F.col("ap").alias("anomaly_positive_rows"),
        F.round(found, 8).alias("anomaly_positive_rate"),
        F.round(F.when(overall > 0, found / overall).otherwise(F.lit(0.0)), 6)
        .alias("anomaly_lift_vs_sample"),
        F.lit(contamination).alias("contamination"),
    )
