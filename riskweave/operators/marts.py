"""Subject marts: minute KPIs, account features, payment KPIs, large candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K
from riskweave.functions import rules
from riskweave.functions.columns import money_sum, rate
from riskweave.operators.ranking import exact_quantile


def _flag_sum(name: str) -> Column:
    return F.sum(F.col(name).cast("long"))


def minute_kpi(dwd: DataFrame) -> DataFrame:
    """Per minute text and payment format, with distinct accounts over both sides.

    Each row becomes two account rows of which only the first carries the measures, so
    sums and the distinct count come from one aggregation.  Spark first groups by
    (minute, format, account), which spreads a hot minute over all tasks.
    """
    both = F.array(
        F.struct(F.col("from_account").alias("account"), F.lit(1).alias("first")),
        F.struct(F.col("to_account").alias("account"), F.lit(0).alias("first")),
    )
    sides = dwd.select(
        "transaction_minute", "payment_format", "is_laundering", "amount_paid", F.inline(both)
    )
    main = F.col("first") == 1
    count = F.sum("first").cast("long")
    label = F.sum(F.when(main, F.col("is_laundering")).otherwise(0)).cast("long")
    return sides.groupBy("transaction_minute", "payment_format").agg(
        count.alias("transaction_count"),
        label.alias("laundering_count"),
        rate(label, count).alias("laundering_rate"),
        money_sum(F.when(main, F.col("amount_paid"))).alias("total_amount_paid"),
        F.count_distinct("account").alias("distinct_account_count"),
    )


PAIR_ROWS = 200_000  # rows whose pairs one task holds


def account_pairs(dwd: DataFrame, rows: int | None = None) -> DataFrame:
    """One row per unordered pair of accounts with the measures of both directions.

    ``a`` is the smaller account.  ``ab_*`` describes payments a -> b, ``ba_*`` b -> a;
    a self transfer is an a -> b payment with a = b.

    Where most pairs have few payments a task's memory follows its rows.  With ``rows``, the known
    number, they are dealt to as many tasks as hold :data:`PAIR_ROWS` each, if the session's partitions
    are fewer; payments of a pair then meet in one task without being combined map side.
    """
    ends = [F.least("from_account", "to_account").alias("a"), F.greatest("from_account", "to_account").alias("b")]
    parts = -(-(rows or 0) // PAIR_ROWS)
    if parts > int(dwd.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        dwd = dwd.select(
            *ends, "from_account", "to_account", "amount_paid", "amount_received",
            "is_laundering", "is_cross_bank", "is_cross_currency",
        ).repartition(parts, "a", "b")
        ends = ["a", "b"]
    forward = F.col("from_account") <= F.col("to_account")
    amount, received = F.col("amount_paid"), F.col("amount_received")
    aggs = []
    for name, test in (("ab", forward), ("ba", ~forward)):
        aggs += [
            F.count_if(test).alias(f"{name}_count"),
            money_sum(F.when(test, amount)).alias(f"{name}_paid"),
            money_sum(F.when(test, received)).alias(f"{name}_received"),
            F.max(F.when(test, amount)).alias(f"{name}_max"),
        ]
    return dwd.groupBy(*ends).agg(
        *aggs,
        _flag_sum("is_laundering").alias("label_count"),
        _flag_sum("is_cross_bank").alias("bank_count"),
        _flag_sum("is_cross_currency").alias("currency_count"),
    )


def account_base(dwd: DataFrame, rows: int | None = None) -> DataFrame:
    """Account features without the rule score; for ``rows`` see :func:`account_pairs`.

    Payments are first combined per unordered account pair (map side first), so an account
    with a third of all rows is spread over its counterparties.  After that every pair
    gives each of its accounts one row, and the distinct counterparties are a plain count.
    """
    pairs = account_pairs(dwd, rows)
    own = F.col("a") == F.col("b")

    def view(me: str, out: str, into: str) -> Column:
        return F.struct(
            F.col(me).alias("account_number"),
            F.col(f"{out}_count").alias("debits"),
            F.when(own, F.col("ab_count")).otherwise(F.col(f"{into}_count")).alias("credits"),
            F.col(f"{out}_paid").alias("paid"),
            F.when(own, F.col("ab_received")).otherwise(F.col(f"{into}_received")).alias("received"),
            F.col(f"{out}_max").alias("top"),
            # a self transfer is one event on each side of the same account
            (F.col("label_count") * F.when(own, 2).otherwise(1)).alias("labels"),
            (F.col("bank_count") * F.when(own, 2).otherwise(1)).alias("banks"),
            (F.col("currency_count") * F.when(own, 2).otherwise(1)).alias("currencies"),
        )

    views = F.when(own, F.array(view("a", "ab", "ba"))).otherwise(
        F.array(view("a", "ab", "ba"), view("b", "ba", "ab"))
    )
    sides = pairs.select(F.inline(views))
    out_amount = F.coalesce(money_sum("paid"), F.lit(0.0))
    in_amount = F.coalesce(money_sum("received"), F.lit(0.0))
    return sides.groupBy("account_number").agg(
        (F.sum("debits") + F.sum("credits")).alias("total_event_count"),
        F.sum("debits").alias("debit_count"),
        F.sum("credits").alias("credit_count"),
        out_amount.alias("out_amount"),
        in_amount.alias("in_amount"),
        (in_amount - out_amount).alias("net_amount"),
        F.greatest(F.lit(0.0), F.max("top")).alias("max_out_amount"),
        F.count("*").alias("counterparty_count"),
        F.sum("labels").alias("laundering_event_count"),
        F.sum("banks").alias("cross_bank_event_count"),
        F.sum("currencies").alias("cross_currency_event_count"),
    )


def account_features(dwd: DataFrame, large_threshold: float | None = None) -> DataFrame:
    """Account features with the rule score; the threshold defaults to the exact q995."""
    if large_threshold is None:
        large_threshold = exact_quantile(dwd, "amount_paid", K.LARGE_QUANTILE)
    return account_base(dwd).withColumn(
        "risk_score_rule", rules.account_rule_score(large_threshold)
    )


def payment_kpi(dwd: DataFrame) -> DataFrame:
    count = F.count("*")
    label = _flag_sum("is_laundering")
    total = money_sum("amount_paid")
    return dwd.groupBy("payment_format").agg(
        count.alias("transaction_count"),
        label.alias("laundering_count"),
        rate(label, count).alias("laundering_rate"),
        total.alias("total_amount_paid"),
        rate(total, count).alias("avg_amount_paid"),
        F.greatest(F.lit(0.0), F.max("amount_paid")).alias("max_amount_paid"),
    )


def large_candidates(
    dwd: DataFrame, quantile: float | None = None, absolute: float = K.LARGE_AMOUNT
) -> DataFrame:
    """Transactions that meet at least one large-amount rule.

    The threshold is a literal, so the least amount that can hit any rule also reaches
    the Parquet scan as a pushed filter.
    """
    if quantile is None:
        quantile = exact_quantile(dwd, "amount_paid", K.LARGE_QUANTILE)
    floor = min(absolute, quantile, quantile * 0.5)
    hits = dwd.filter(F.col("amount_paid") >= floor).withColumn(
        "_hits", rules.large_hits(quantile, absolute)
    )
    return hits.filter(F.size("_hits") > 0).select(
        "transaction_id", "timestamp", "transaction_minute", "from_bank", "from_account",
        "to_bank", "to_account", "amount_paid", "payment_currency", "payment_format",
        "is_laundering", "is_cross_bank", "is_cross_currency",
        F.concat_ws(";", "_hits").alias("rule_hits"),
    )
