"""Profiles, summaries and label rates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K
from riskweave.functions import rules
from riskweave.functions.columns import amount_bin, money_sum, parse_amount, rate
from riskweave.operators.ranking import exact_quantiles


def metric_rows(wide: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A one-row table as (metric, value) text rows."""
    columns = columns or wide.columns
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) AS (metric, value)")


def metrics_pivot(kv: DataFrame, names: list[str]) -> DataFrame:
    """(metric, value) rows to one row with a column per name."""
    picks = [F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names]
    return kv.agg(*picks)


def metrics_map(kv: DataFrame) -> DataFrame:
    """(metric, value) rows to a single map column (metric tables hold tens of rows)."""
    entries = F.array_sort(F.collect_list(F.struct("metric", "value")))
    return kv.agg(F.map_from_entries(entries).alias("metrics"))


def value_counts(df: DataFrame, col: str, top: int | None = 30) -> DataFrame:
    """Rows per value, most common first, ties by value."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("count"))
    ordered = counts.orderBy(F.desc("count"), F.asc("value"))
    return ordered if top is None else ordered.limit(top)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct values over several columns of one scan (set union)."""
    return df.select(F.explode(F.array(*cols)).alias("value")).distinct()


def profile_transactions(raw: DataFrame, corrupt: str = "_corrupt") -> DataFrame:
    """One wide row about raw text transactions; amounts count only where both parse.

    Rows with a corrupt-record mark are only counted.  One scan gives the sums, a second
    one the distinct banks and accounts, as one distinct over (kind, value) keys.
    """
    whole = F.col(corrupt).isNull() if corrupt in raw.columns else F.lit(True)
    typed = raw.select(
        whole.alias("_whole"), "timestamp",
        parse_amount("amount_paid").alias("_paid"), parse_amount("amount_received").alias("_received"),
    ).withColumn("_both", F.col("_whole") & F.col("_paid").isNotNull() & F.col("_received").isNotNull())
    good, both = F.col("_whole"), F.col("_both")
    paid, received = F.when(both, F.col("_paid")), F.when(both, F.col("_received"))
    stamp = F.when(good & (F.col("timestamp") != ""), F.col("timestamp"))
    main = typed.agg(
        F.count_if(good).alias("row_count"),
        F.count_if(~good).alias("malformed_count"),
        F.coalesce(F.min(stamp), F.lit("")).alias("min_timestamp"),
        F.coalesce(F.max(stamp), F.lit("")).alias("max_timestamp"),
        F.min(paid).alias("amount_paid_min"),
        F.max(paid).alias("amount_paid_max"),
        F.coalesce(money_sum(paid), F.lit(0.0)).alias("amount_paid_sum"),
        F.coalesce(money_sum(received), F.lit(0.0)).alias("amount_received_sum"),
        F.count_if(good & ~both).alias("invalid_amount_count"),
    )
    kinds = {"from_bank": "from_bank", "to_bank": "to_bank", "from_account": "account", "to_account": "account"}
    keys = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value")) for c, kind in kinds.items()
    ])
    seen = raw.filter(whole).select(F.inline(keys)).distinct()
    counts = seen.agg(F.struct(*[
        F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in ("from_bank", "to_bank", "account")
    ]).alias("n"))
    return main.withColumn("_n", counts.scalar()).select("*", "_n.*").drop("_n")


def profile_accounts(accounts: DataFrame, malformed: DataFrame | None = None) -> DataFrame:
    """Counts over the well-formed rows, and the number of malformed ones."""
    main = accounts.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("bank_id").alias("bank_count"),
        F.count_distinct("account_number").alias("account_count"),
        F.count_distinct("entity_id").alias("entity_count"),
    )
    return main.withColumn("malformed_count", _row_count(malformed))


def top_bank_ids(accounts: DataFrame, top: int | None = 30) -> DataFrame:
    """(value, count): accounts per bank id, most common first."""
    return value_counts(accounts, "bank_id", top)


def _row_count(rows: DataFrame | None) -> Column:
    return F.lit(0).cast("long") if rows is None else rows.agg(F.count("*")).scalar()


def profile_patterns(lines: DataFrame) -> DataFrame:
    """(section, key, count) over typed pattern lines: kinds, labels and pattern types.

    One scan: each line gives its kind, and its label or type where it has one.
    """
    def fact(section: str, key: Column) -> Column:
        named = F.struct(F.lit(section).alias("section"), key.alias("key"))
        return F.when(key.isNotNull(), named)

    facts = F.array_compact(F.array(
        fact("line", F.lit("all")), *[fact(c, F.col(c)) for c in ("kind", "label", "pattern_type")]
    ))
    return (
        lines.select(F.inline(facts)).groupBy("section", "key").agg(F.count("*").alias("count"))
    )


def ods_summary(ods: DataFrame, malformed: DataFrame | None = None) -> DataFrame:
    """(metric, value) rows: totals, time range, label and payment-format counts."""
    stamp = F.when(F.col("timestamp") != "", F.col("timestamp"))
    totals = ods.agg(
        F.count("*").alias("rows_written"),
        F.coalesce(F.min(stamp), F.lit("")).alias("min_timestamp"),
        F.coalesce(F.max(stamp), F.lit("")).alias("max_timestamp"),
    )
    head = metric_rows(totals.withColumn("malformed_rows", _row_count(malformed)))
    return head.unionByName(_keyed_counts(ods, {"label": "is_laundering", "payment_format": "payment_format"}))


def _keyed_counts(df: DataFrame, sections: dict[str, str]) -> DataFrame:
    """``section.value`` counts for several columns from one scan."""
    pairs = F.array(*[
        F.concat(F.lit(f"{name}."), F.coalesce(F.col(c).cast("string"), F.lit("")))
        for name, c in sections.items()
    ])
    return (
        df.select(F.explode(pairs).alias("metric")).groupBy("metric")
        .agg(F.count("*").cast("string").alias("value"))
    )


def account_dim_summary(accounts: DataFrame) -> DataFrame:
    unique = F.count_distinct("account_number")
    return accounts.agg(
        F.count("*").alias("row_count"),
        unique.alias("unique_account_count"),
        (F.count("*") - unique).alias("duplicate_account_number_count"),
        F.count_distinct("bank_id").alias("bank_count"),
        F.count_distinct("entity_id").alias("entity_count"),
    )


def dwd_quality_summary(typed: DataFrame, coverage: DataFrame, malformed: DataFrame | None = None) -> DataFrame:
    """One wide row over all numbered rows plus the account coverage of the kept ones.

    ``payment_format_counts`` is an array of (payment_format, count) over the kept rows, sorted;
    a column of few values.
    """
    ok = F.col("amount_paid").isNotNull() & F.col("amount_received").isNotNull()
    from_coverage = [f"{side}_account_{what}" for what in ("missing_count", "match_rate") for side in ("from", "to")]
    cov = coverage.select(*from_coverage)
    formats = (
        typed.filter(ok).groupBy("payment_format").agg(F.count("*").alias("count"))
        .agg(F.array_sort(F.collect_list(F.struct("payment_format", "count"))))
    )
    main = typed.agg(
        F.count_if(ok).alias("transaction_row_count"),
        (F.count_if(ok) * 2).alias("event_row_count"),
        F.count_if(~ok).alias("invalid_amount_count"),
        F.count_if(ok & (F.col("transaction_minute") == "")).alias("invalid_timestamp_count"),
        F.count_if(ok & (F.col("is_laundering") == 1)).alias("label_1_count"),
        F.count_if(ok & (F.col("is_laundering") == 0)).alias("label_0_count"),
        F.count_if(ok & (F.col("is_cross_bank") == 1)).alias("cross_bank_count"),
        F.count_if(ok & (F.col("is_cross_currency") == 1)).alias("cross_currency_count"),
    )
    more = {c: cov.select(c).scalar() for c in from_coverage}
    return main.withColumns({
        **more, "malformed_count": _row_count(malformed), "payment_format_counts": formats.scalar(),
    })


def label_distribution(df: DataFrame) -> DataFrame:
    """Both labels always appear, with count and rate."""
    total = F.count("*")
    positive = F.sum(F.col("is_laundering").cast("long"))
    wide = df.agg(total.alias("n"), F.coalesce(positive, F.lit(0)).alias("p"))
    rows = F.array(
        F.struct(F.lit(0).alias("label"), (F.col("n") - F.col("p")).alias("count")),
        F.struct(F.lit(1).alias("label"), F.col("p").alias("count")),
    )
    return wide.select("n", F.inline(rows)).select(
        "label", "count", rate(F.col("count"), F.col("n")).alias("rate")
    )


def eda_metrics(df: DataFrame) -> DataFrame:
    """One wide row: totals, rate as 10-digit text, distinct sides, exact quantiles."""
    total, positive = F.count("*"), F.sum(F.col("is_laundering").cast("long"))
    wide = df.agg(
        total.alias("transaction_rows"),
        positive.alias("laundering_rows"),
        (total - positive).alias("non_laundering_rows"),
        F.format_string("%.10f", rate(positive, total)).alias("laundering_rate"),
        F.count_distinct("from_account").alias("distinct_from_accounts"),
        F.count_distinct("to_account").alias("distinct_to_accounts"),
        F.sum(F.col("is_cross_bank").cast("long")).alias("cross_bank_rows"),
        F.sum(F.col("is_cross_currency").cast("long")).alias("cross_currency_rows"),
        F.min("amount_paid").alias("amount_paid_min"),
        F.max("amount_paid").alias("amount_paid_max"),
    )
    values = exact_quantiles(df, "amount_paid", [0.5, 0.95, 0.99])
    names = [f"amount_paid_{p}" for p in ("p50", "p95", "p99")]
    return wide.withColumns({name: F.lit(value) for name, value in zip(names, values)})


def _rate_aggs() -> list[Column]:
    count, label = F.count("*"), F.sum(F.col("is_laundering").cast("long"))
    return [
        count.alias("transaction_count"),
        label.alias("laundering_count"),
        (money_sum("amount_paid") / F.count("amount_paid")).alias("avg_amount_paid"),
        F.max("amount_paid").alias("max_amount_paid"),
        rate(label, count).alias("laundering_rate"),
    ]


def group_rate(df: DataFrame, dim: str) -> DataFrame:
    """Label rate per value of one dimension (NULL is a value), largest group first."""
    return df.groupBy(dim).agg(*_rate_aggs()).orderBy(F.desc("transaction_count"), dim)


def dimension_rates(
    df: DataFrame, dims: tuple[str, ...] = ("is_cross_bank", "is_cross_currency", "transaction_hour")
) -> DataFrame:
    """Label rates of several dimensions, stacked, from one scan."""
    pairs = F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("dimension_value"))
        for d in dims
    ])
    return (
        df.select("is_laundering", "amount_paid", F.inline(pairs))
        .groupBy("dimension", "dimension_value").agg(*_rate_aggs())
        .orderBy("dimension", F.desc("transaction_count"), "dimension_value")
    )


def amount_bin_rates(df: DataFrame) -> DataFrame:
    """Label rate per amount band; all seven bands appear."""
    seen = df.groupBy(amount_bin("amount_paid").alias("amount_bin")).agg(
        F.count("*").alias("n"), F.sum(F.col("is_laundering").cast("long")).alias("p")
    )
    labels = [label for _, label in K.AMOUNT_BANDS]
    bands = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(x) for x in labels])).alias("_at", "amount_bin")
    )
    count = F.coalesce(F.col("n"), F.lit(0))
    label = F.coalesce(F.col("p"), F.lit(0))
    return (
        bands.join(seen, "amount_bin", "left").orderBy("_at")
        .select(
            "amount_bin", count.alias("transaction_count"), label.alias("laundering_count"),
            rate(label, count).alias("laundering_rate"),
        )
    )


def split_summary(df: DataFrame) -> DataFrame:
    label = F.sum(F.col("is_laundering").cast("long"))
    return df.groupBy("split").agg(
        F.count("*").alias("rows"), label.alias("positive_rows"),
        rate(label, F.count("*")).alias("positive_rate"),
    )


def label_split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("split", F.col("is_laundering").cast("int").alias("is_laundering")).agg(
        F.count("*").alias("row_count")
    )


def class_balance(df: DataFrame) -> DataFrame:
    label = F.count_if(F.col("is_laundering") == 1)
    return metric_rows(
        df.agg(
            F.count("*").alias("feature_rows"),
            label.alias("positive_rows"),
            (F.count("*") - label).alias("negative_rows"),
            F.format_string("%.8f", rate(label, F.count("*"))).alias("positive_rate"),
            F.count_if(F.col("split") == "train").alias("train_rows"),
            F.count_if(F.col("split") == "test").alias("test_rows"),
        )
    )


def replay_summary(replay: DataFrame, threshold: float = K.LARGE_AMOUNT) -> DataFrame:
    return replay.agg(
        F.count("*").alias("rows_written"),
        F.count_if(F.col("is_laundering") == 1).alias("laundering_rows"),
        F.count_if(F.col("amount_paid") >= threshold).alias("large_amount_rows"),
        F.count_if(F.col("is_cross_bank") == 1).alias("cross_bank_rows"),
        F.count_if(F.col("is_cross_currency") == 1).alias("cross_currency_rows"),
        F.count_if(rules.rule_candidate(threshold)).alias("rule_candidate_rows"),
    )


def sample_summary(joined: DataFrame, sample: DataFrame) -> DataFrame:
    """Sizes of a tiered sample, from the columns it keeps.

    Candidates available are those left after the positives were chosen.
    """
    hit = F.col("_candidate_score") >= K.SCORE_FLOOR
    written = sample.agg(
        F.count("*").alias("rows_written"),
        F.count_if(hit).alias("candidate_rows_written"),
        F.count_if(~hit).alias("non_candidate_rows_written"),
        F.sum(F.col("is_laundering").cast("long")).alias("observed_laundering_rows_written"),
        F.count_if(hit & (F.col("_tier") == 1)).alias("_taken"),
    )
    pool = joined.agg(
        F.count("*").alias("n"),
        F.count_if(rules.contract_raw_score() >= K.SCORE_FLOOR).alias("c"),
    )
    return (
        written.withColumn("joined_rows", pool.select("n").scalar())
        .withColumn("candidate_rows_available", pool.select("c").scalar() - F.col("_taken"))
        .drop("_taken")
    )


def feature_group_importance(importance: DataFrame) -> DataFrame:
    """Count, total, maximum and share of absolute importance per feature group."""
    from riskweave.functions.columns import feature_group

    total = importance.agg(F.sum("abs_importance")).scalar()
    return (
        importance.groupBy(feature_group("feature").alias("feature_group"))
        .agg(
            F.count("feature").alias("feature_count"),
            F.sum("abs_importance").alias("total_importance"),
            F.max("abs_importance").alias("max_importance"),
        )
        .withColumn("importance_share", rate(F.col("total_importance"), total))
        .orderBy(F.desc("total_importance"))
    )


def table_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """(table_name, actual_count[, expected_count, status]) of several tables."""
    parts = [
        df.agg(F.count("*").alias("actual_count")).select(F.lit(name).alias("table_name"), "actual_count")
        for name, df in tables.items()
    ]
    counts = reduce(DataFrame.unionByName, parts)
    if expected is None:
        return counts
    known = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    return counts.withColumn("expected_count", known[F.col("table_name")].cast("long")).withColumn(
        "status",
        F.when(F.col("expected_count").eqNullSafe(F.col("actual_count")), "PASS").otherwise("FAIL"),
    )
