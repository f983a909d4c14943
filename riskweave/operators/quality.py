"""Data-quality expectations, metric rules, parity checks and text scans."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K


@dataclass(frozen=True)
class Expectation:
    """A named check: one aggregate that observes, one test of the observation."""

    name: str
    observe: Column
    holds: Column | None = None  # test of the observed value; default: it is zero
    detail: str = ""


def expect_row_count_between(low: int | None = None, high: int | None = None) -> Expectation:
    v = F.col("observed_value")
    tests = [v >= low] if low is not None else []
    tests += [v <= high] if high is not None else []
    return Expectation(
        "row_count_between", F.count("*"), reduce(Column.__and__, tests, F.lit(True)),
        json.dumps({"min": low, "max": high}),
    )


def expect_columns_match_set(df: DataFrame, columns: list[str], exact: bool = False) -> Expectation:
    """Required columns present; ``exact`` also bars extra ones.  Needs only the schema."""
    have = set(df.columns)
    wrong = len(set(columns) - have) + (len(have - set(columns)) if exact else 0)
    return Expectation(
        "columns_match_set", F.max(F.lit(wrong)).cast("long"),
        F.coalesce(F.col("observed_value"), F.lit(wrong)) == 0, json.dumps(sorted(columns)),
    )


def expect_not_null(column: str) -> Expectation:
    return Expectation(f"not_null.{column}", F.count_if(F.col(column).isNull()))


def expect_in_set(column: str, values: list) -> Expectation:
    return Expectation(
        f"in_set.{column}", F.count_if(~F.col(column).isin(*values)), detail=json.dumps(values)
    )


def expect_between(column: str, low=None, high=None) -> Expectation:
    bad = [F.col(column) < low] if low is not None else []
    bad += [F.col(column) > high] if high is not None else []
    return Expectation(
        f"between.{column}", F.count_if(reduce(Column.__or__, bad, F.lit(False))),
        detail=json.dumps({"min": low, "max": high}),
    )


def missing_count(column: str) -> Expectation:
    return expect_not_null(column)


def row_count_positive() -> Expectation:
    return expect_row_count_between(1, None)


def run_expectations(df: DataFrame, checks: list[Expectation]) -> DataFrame:
    """All checks in one aggregation: (expectation, status, observed_value, detail)."""
    wide = df.agg(*[c.observe.cast("long").alias(f"_o{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(
            F.lit(c.name).alias("expectation"), F.col(f"_o{i}").alias("observed_value"),
            F.lit(c.detail).alias("detail"), F.lit(i).alias("_i"),
        )
        for i, c in enumerate(checks)
    ])
    status = None
    for i, c in enumerate(checks):
        test = F.col("observed_value") == 0 if c.holds is None else c.holds
        verdict = F.when(F.coalesce(test, F.lit(False)), "PASS").otherwise("FAIL")
        status = F.when(F.col("_i") == i, verdict) if status is None else status.when(
            F.col("_i") == i, verdict
        )
    return wide.select(F.inline(rows)).select(
        "expectation", status.alias("status"), "observed_value", "detail"
    )


def expectation_totals(results: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("status") == "PASS")
    return results.agg(
        F.count("*").alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        (passed == F.count("*")).alias("all_success"),
    )


# Comparison forms of metric rules; ``arg`` is a number, text, metric name or a;b pair.
def _rule_test(values: DataFrame | None = None) -> Column:
    actual, arg, op = F.col("actual"), F.col("arg"), F.col("operator")
    number = actual.try_cast("double")
    low = F.split("arg", ";")[0].try_cast("double")
    high = F.try_element_at(F.split("arg", ";"), F.lit(2)).try_cast("double")
    other = F.col("_other")
    return (
        F.when(op == "equals", actual == arg)
        .when(op == "equals_metric", actual == other)
        .when(op == "twice_metric", number == other.try_cast("double") * 2)
        .when(op == "positive", number > 0)
        .when(op == "open_range", (number > low) & (number < high))
        .when(op == "in_set", F.array_contains(F.split("arg", ";"), actual))
    )


def assert_metrics(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Judge (metric, value) rows by (rule_group, rule_name, metric, operator, arg, source, detail).

    Metric tables are small by construction (one row per metric); an absent metric fails.
    """
    known = metrics.select("metric", F.col("value").cast("string").alias("actual"))
    other = known.select(F.col("metric").alias("arg"), F.col("actual").alias("_other"))
    joined = rules.join(known, "metric", "left").join(other, "arg", "left")
    expected = F.concat_ws(" ", "operator", "arg")
    return joined.select(
        "rule_group", "rule_name", expected.alias("expected"),
        F.coalesce("actual", F.lit("")).alias("actual"),
        F.when(F.coalesce(_rule_test(), F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
        F.col("source").alias("source_evidence"), "detail",
    )


def quality_status_rollup(checks: DataFrame, group: str | None = None) -> DataFrame:
    """Check, pass, warn and fail counts; PASS only without failures."""
    s = F.col("status")
    fails = F.count_if(s == "FAIL")
    source = checks.groupBy(group) if group else checks.groupBy()
    return source.agg(
        F.count("*").alias("check_count"),
        F.count_if(s == "PASS").alias("pass_count"),
        F.count_if(s == "WARN").alias("warn_count"),
        fails.alias("fail_count"),
        F.when(fails == 0, "PASS").otherwise("FAIL").alias("status"),
    )


# fixed values: compared features; whole-number features must agree exactly
EXACT_FEATURES = [
    "transaction_hour", "is_cross_bank", "is_cross_currency", "from_total_event_count",
    "from_debit_count", "from_credit_count", "from_counterparty_count",
    "from_cross_bank_event_count", "from_cross_currency_event_count", "is_laundering",
]
PARITY_FEATURES = K.NUMERIC_FEATURES + ["is_laundering"]
PARITY_CATEGORIES = ["transaction_date", "split", "payment_currency", "payment_format"]


def numeric_parity(aligned: DataFrame, features: list[str] = PARITY_FEATURES) -> DataFrame:
    """Per feature: compared rows, greatest difference, mismatches; one aggregation.

    ``aligned`` holds ``p_x`` / ``w_x`` pairs.  NULL differences are ignored and an empty
    comparison fails.
    """
    aggs, rows = [F.count("*").alias("_n")], []
    for i, name in enumerate(features):
        tol = 0.0 if name in EXACT_FEATURES else K.PARITY_TOLERANCE
        diff = F.abs(F.col(f"p_{name}").cast("double") - F.col(f"w_{name}").cast("double"))
        aggs += [F.max(diff).alias(f"_d{i}"), F.count_if(diff > tol).alias(f"_m{i}")]
        rows.append(
            F.struct(
                F.lit(name).alias("feature"), F.col("_n").alias("compared_rows"),
                F.col(f"_d{i}").alias("max_abs_diff"), F.col(f"_m{i}").alias("mismatch_rows"),
                F.lit(tol).alias("tolerance"),
            )
        )
    ok = F.coalesce(F.col("max_abs_diff") <= F.col("tolerance"), F.lit(False))
    return aligned.agg(*aggs).select(F.inline(F.array(*rows))).withColumn(
        "status", F.when(ok, "PASS").otherwise("FAIL")
    )


def categorical_parity(aligned: DataFrame, columns: list[str] = PARITY_CATEGORIES) -> DataFrame:
    """Per column: compared rows and NULL-safe text mismatches; one aggregation."""
    aggs, rows = [F.count("*").alias("_n")], []
    for i, name in enumerate(columns):
        same = F.col(f"p_{name}").cast("string").eqNullSafe(F.col(f"w_{name}").cast("string"))
        aggs.append(F.count_if(~same).alias(f"_m{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("feature"), F.col("_n").alias("compared_rows"),
                F.col(f"_m{i}").alias("mismatch_rows"),
            )
        )
    return aligned.agg(*aggs).select(F.inline(F.array(*rows))).withColumn(
        "status", F.when(F.col("mismatch_rows") == 0, "PASS").otherwise("FAIL")
    )


def row_parity(
    stored: DataFrame, rederived: DataFrame, expected_rows: int | None = None,
    expected_positives: int | None = None,
) -> DataFrame:
    """(metric, value, status): rows, distinct ids, positives, matched and unmatched rows."""
    wide = stored.agg(
        F.count("*").alias("n"), F.count_distinct("transaction_id").alias("ids"),
        F.sum(F.col("is_laundering").cast("long")).alias("pos"),
    ).withColumn("matched", rederived.agg(F.count("*")).scalar())
    n = F.col("n")

    def row(metric: str, value: Column, ok: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), value.cast("long").alias("value"),
            F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
        )

    want_rows = F.lit(True) if expected_rows is None else n == expected_rows
    want_pos = F.lit(True) if expected_positives is None else F.col("pos") == expected_positives
    return wide.select(F.inline(F.array(
        row("feature_rows", n, want_rows),
        row("distinct_transaction_id", F.col("ids"), F.col("ids") == n),
        row("positive_rows", F.col("pos"), want_pos),
        row("warehouse_matched_rows", F.col("matched"), F.col("matched") == n),
        row("warehouse_unmatched_rows", n - F.col("matched"), F.col("matched") == n),
    )))


def _field_scan(df: DataFrame, names: list[str], present_is_ok: bool) -> DataFrame:
    """(field, status, detail) from the schema alone; no data is read."""
    have = set(df.columns)
    words = ("present", "missing") if present_is_ok else ("leakage field present", "not present")
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit("PASS" if (name in have) == present_is_ok else "FAIL").alias("status"),
            F.lit(words[0] if name in have else words[1]).alias("detail"),
        )
        for name in names
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def leakage_scan(df: DataFrame, forbidden: list[str] = K.LEAKAGE_COLUMNS) -> DataFrame:
    return _field_scan(df, forbidden, present_is_ok=False)


def required_scan(df: DataFrame, required: list[str] = K.FEATURE_COLUMNS) -> DataFrame:
    return _field_scan(df, required, present_is_ok=True)


def text_lines(df: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """Whole texts split into lines."""
    return df.select(*keep, F.explode(F.split(text_col, "\r\n|\r|\n")).alias("line"))


def credential_hits(lines: DataFrame, col: str = "line") -> DataFrame:
    return lines.filter(F.col(col).rlike(K.SECRET_PATTERN))


def credential_scan(lines: DataFrame, col: str = "line") -> DataFrame:
    """(scanned_lines, credential_hits, status): PASS only without a hit."""
    hits = F.count_if(F.col(col).rlike(K.SECRET_PATTERN))
    return lines.agg(
        F.count("*").alias("scanned_lines"), hits.alias("credential_hits"),
        F.when(hits == 0, "PASS").otherwise("FAIL").alias("status"),
    )
