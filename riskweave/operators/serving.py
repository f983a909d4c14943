"""Display-ready tables and dashboard queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K
from riskweave.functions.columns import money_sum, money_sum_decimal, rate, risk_bucket, strip
from riskweave.operators.ranking import global_row_number


def _bigint(amount: Column) -> Column:
    """Rounded whole units (a plain cast would truncate)."""
    return F.round(amount).cast("long")


def hourly_distribution(dwd: DataFrame) -> DataFrame:
    label = F.sum(F.col("is_laundering").cast("long"))
    return (
        dwd.groupBy("transaction_hour").agg(
            F.count("*").alias("transaction_count"),
            label.alias("laundering_count"),
            rate(label, F.count("*"), 8).alias("laundering_rate"),
            _bigint(money_sum("amount_paid")).alias("total_amount_paid"),
        ).orderBy("transaction_hour")
    )


def payment_format_risk(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        "payment_format", "transaction_count", "laundering_count",
        F.round("laundering_rate", 8).alias("laundering_rate"),
        _bigint(F.col("total_amount_paid")).alias("total_amount_paid"),
    ).orderBy(F.desc("laundering_rate"), F.desc("transaction_count"), "payment_format")


def large_txn_topn(candidates: DataFrame, n: int = 20) -> DataFrame:
    return candidates.select(
        "transaction_id", "transaction_minute", "from_account", "to_account", "amount_paid",
        "payment_currency", "payment_format", "is_laundering", "rule_hits",
    ).orderBy(F.desc("amount_paid"), "transaction_id").limit(n)




def _by_risk(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.desc("risk_score_rule"), F.desc("laundering_event_count"), F.desc("out_amount"),
        "account_number",
    )


def account_risk_topn(features: DataFrame, n: int = 20) -> DataFrame:
    return _by_risk(features).limit(n).select(
        "account_number", "total_event_count", "debit_count", "credit_count",
        _bigint(F.col("out_amount")).alias("out_amount"), "counterparty_count",
        "laundering_event_count", "cross_bank_event_count", "cross_currency_event_count",
        "risk_score_rule",
    )


def ads_account_export(features: DataFrame, n: int = 5000, updated_at: Column | None = None) -> DataFrame:
    """Warehouse accounts cast to the display layout, ``n`` riskiest."""
    counts = [
        "total_event_count", "debit_count", "credit_count", "counterparty_count",
        "laundering_event_count", "cross_bank_event_count", "cross_currency_event_count",
    ]
    cast = features.select(
        "account_number", *[F.col(c).cast("long").alias(c) for c in counts],
        F.col("out_amount").cast("decimal(20,2)").alias("out_amount"),
        F.col("risk_score_rule").cast("double").alias("risk_score_rule"),
        (F.current_timestamp() if updated_at is None else updated_at).alias("updated_at"),
    )
    return _by_risk(cast).limit(n)


def ads_account_rollup(events: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Risk events per account; ``laundering_event_count`` here means high-risk events."""
    account = strip(F.coalesce("event_account", F.lit("")))
    peer = strip(F.coalesce("counterparty_account", F.lit("")))
    score = F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0))
    reasons = F.concat_ws(
        ";", F.coalesce("risk_reasons", F.lit("")), F.coalesce("rule_hits", F.lit(""))
    )
    currency = F.coalesce("payment_currency", F.lit(""))
    high = F.coalesce(F.col("risk_level").isin(*K.ALERT_LEVELS), F.lit(False)) | (score >= 60)
    crossing = reasons.contains("CROSS_CURRENCY") | ~currency.isin("", "Yuan")
    return (
        events.withColumn("account_number", account).filter(F.col("account_number") != "")
        .groupBy("account_number").agg(
            F.count("*").alias("total_event_count"),
            F.count("*").alias("debit_count"),
            F.lit(0).cast("long").alias("credit_count"),
            money_sum_decimal(F.coalesce("amount_paid", F.lit(0.0))).alias("out_amount"),
            F.count_distinct(F.when(peer != "", peer)).alias("counterparty_count"),
            F.count_if(high).alias("laundering_event_count"),
            F.count_if(reasons.contains("CROSS_BANK")).alias("cross_bank_event_count"),
            F.count_if(crossing).alias("cross_currency_event_count"),
            F.round(F.greatest(F.lit(0.0), F.max(score)), 4).alias("risk_score_rule"),
        )
        .withColumn("updated_at", F.current_timestamp() if updated_at is None else updated_at)
    )


def account_score_buckets(ads: DataFrame) -> DataFrame:
    return (
        ads.groupBy(risk_bucket("risk_score_rule").alias("risk_bucket")).agg(
            F.count("*").alias("account_count"),
            F.round(F.avg("risk_score_rule"), 4).alias("avg_risk_score"),
            F.sum("out_amount").alias("total_out_amount"),
        ).orderBy(F.desc("avg_risk_score"))
    )


def event_score_buckets(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(risk_bucket("risk_score").alias("risk_bucket")).agg(
            F.count("*").alias("event_count"),
            F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
        ).orderBy(F.desc("avg_risk_score"))
    )


def _event_measures() -> list[Column]:
    return [
        F.count("*").alias("event_count"),
        F.round(F.avg("risk_score"), 4).alias("avg_risk_score"),
        money_sum("amount_paid").alias("total_amount_paid"),
    ]


def risk_level_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("risk_level").agg(*_event_measures()).orderBy(F.desc("avg_risk_score"))


def payment_currency_risk(events: DataFrame, n: int = 30) -> DataFrame:
    return (
        events.groupBy("payment_format", "payment_currency").agg(*_event_measures())
        .orderBy(F.desc("event_count"), F.desc("avg_risk_score"), "payment_format", "payment_currency")
        .limit(n)
    )


def high_risk_accounts(ads: DataFrame) -> DataFrame:
    return ads.filter((F.col("risk_score_rule") >= 60) | (F.col("laundering_event_count") > 0))


def high_risk_account_topn(ads: DataFrame, n: int = 20) -> DataFrame:
    return _by_risk(high_risk_accounts(ads)).limit(n).select(
        "account_number", "total_event_count", "counterparty_count", "laundering_event_count",
        "cross_bank_event_count", "cross_currency_event_count", "out_amount", "risk_score_rule",
    )


def investigation_filter(events: DataFrame) -> DataFrame:
    return events.filter(F.col("risk_level").isin(*K.ALERT_LEVELS))


def investigation_search(events: DataFrame, n: int = 5) -> DataFrame:
    return (
        investigation_filter(events)
        .orderBy(F.desc("risk_score"), "transaction_id").limit(n)
        .select("run_id", "transaction_id", "event_account", "risk_level", "risk_score",
                "payment_currency", "payment_format", "amount_paid")
    )


def top_anomalies(scored: DataFrame, n: int = 50) -> DataFrame:
    return scored.orderBy(F.desc("anomaly_score"), "transaction_id").limit(n).select(
        "transaction_id", "split", "amount_paid", "payment_currency", "payment_format",
        "is_cross_bank", "is_cross_currency", "is_laundering", "anomaly_score", "anomaly_label",
    )


def top_features(importance: DataFrame, n: int = 50) -> DataFrame:
    return importance.orderBy(F.desc("abs_importance"), "feature").limit(n)


def tail_sample(events: DataFrame, order: list[str], n: int = 50) -> DataFrame:
    return events.orderBy(*order).limit(n)


def query_results_export(results: dict[str, tuple[DataFrame, list[Column]]]) -> DataFrame:
    """Result tables of any size stacked as (query_name, row_number, row_json).

    Rows are numbered in range partitions, so no result passes through one task.
    """
    parts = [
        global_row_number(df, order).select(
            F.lit(name).alias("query_name"), "row_number",
            F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row_json"),
        )
        for name, (df, order) in results.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def dashboard_dataset(
    dwd: DataFrame, features: DataFrame, kpi: DataFrame, candidates: DataFrame,
    realtime: DataFrame,
) -> DataFrame:
    """KPI cards plus the four dashboard panels as (section, row_number, row_json)."""
    cards = kpi.agg(
        F.sum("transaction_count").alias("total_transactions"),
        F.sum("laundering_count").alias("laundering_count"),
        rate(F.sum("laundering_count"), F.sum("transaction_count"), 8).alias("laundering_rate"),
    ).withColumn("total_accounts", features.agg(F.count("*")).scalar()).withColumn(
        "realtime_keys", realtime.agg(F.count_distinct("event_account")).scalar()
    )
    panels = {
        "kpi_cards": (cards, [F.col("total_transactions")]),
        "payment_risk": (
            payment_format_risk(kpi),
            [F.desc("laundering_rate"), F.desc("transaction_count"), F.col("payment_format")],
        ),
        "hourly_risk": (hourly_distribution(dwd), [F.col("transaction_hour")]),
        "top_accounts": (
            account_risk_topn(features, 10),
            [F.desc("risk_score_rule"), F.desc("laundering_event_count"), F.desc("out_amount"),
             F.col("account_number")],
        ),
        "top_transactions": (
            large_txn_topn(candidates, 10), [F.desc("amount_paid"), F.col("transaction_id")],
        ),
    }
    return query_results_export(panels).withColumnRenamed("query_name", "section")
