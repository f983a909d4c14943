"""Risk rules as columns; the same expressions serve batch and streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from riskweave import constants as K


def _one(name: str) -> Column:
    return F.col(name) == 1


def _points(test: Column, points: int) -> Column:
    return F.when(test, points).otherwise(0)


def _trail(test: Column, text: str) -> Column:
    """``text;`` where the test holds, else nothing (stream style: trailing delimiter)."""
    return F.when(test, text + ";").otherwise("")


def rule_candidate(threshold: float = K.LARGE_AMOUNT) -> Column:
    return _one("is_laundering") | (F.col("amount_paid") >= threshold) | _one("is_cross_currency")


def simple_rule_type() -> Column:
    large = F.col("amount_paid") >= K.LARGE_AMOUNT
    return (
        F.when(_one("is_laundering"), "LABEL_HIT")
        .when(large & _one("is_cross_currency"), "LARGE_CROSS_CURRENCY")
        .when(large & _one("is_cross_bank"), "LARGE_CROSS_BANK")
        .when(large, "LARGE_AMOUNT")
        .when(_one("is_cross_currency"), "CROSS_CURRENCY")
        .otherwise("RULE_MATCH")
    )


# fixed values: (reason, points) of the simple stream rules, in output order
def _simple_rules() -> list[tuple[Column, str, int]]:
    return [
        (_one("is_laundering"), "LABEL_HIT", 5),
        (F.col("amount_paid") >= K.LARGE_AMOUNT, "LARGE_AMOUNT", 2),
        (_one("is_cross_bank"), "CROSS_BANK", 1),
        (_one("is_cross_currency"), "CROSS_CURRENCY", 1),
    ]


def simple_rule_score() -> Column:
    return reduce(Column.__add__, [_points(t, p) for t, _, p in _simple_rules()]).cast("int")


def simple_rule_reasons() -> Column:
    return F.concat(*[_trail(t, name) for t, name, _ in _simple_rules()])


# fixed values: (reason, hit code, points) of the scoring contract, in output order
def _contract_rules() -> list[tuple[Column, str, str, int]]:
    amount = F.col("amount_paid")
    return [
        (amount >= K.HUGE_AMOUNT, "AMOUNT_GE_10M", "R_AMOUNT_10M", 35),
        (
            (amount >= K.LARGE_AMOUNT) & (amount < K.HUGE_AMOUNT),
            "AMOUNT_GE_1M", "R_AMOUNT_1M", 25,
        ),
        (_one("is_cross_currency"), "CROSS_CURRENCY", "R_CROSS_CURRENCY", 20),
        (_one("is_cross_bank"), "CROSS_BANK", "R_CROSS_BANK", 10),
        (
            F.col("from_cross_currency_event_count") >= 2,
            "ACCOUNT_CROSS_CURRENCY_GE_2", "R_ACCOUNT_CROSS_CURRENCY", 15,
        ),
        (
            F.col("from_cross_bank_event_count") >= 10,
            "ACCOUNT_CROSS_BANK_GE_10", "R_ACCOUNT_CROSS_BANK", 10,
        ),
        (
            F.col("from_debit_credit_ratio") >= 3,
            "DEBIT_CREDIT_RATIO_GE_3", "R_DEBIT_CREDIT_RATIO", 10,
        ),
        (F.col("from_out_in_ratio") >= 3, "OUT_IN_RATIO_GE_3", "R_OUT_IN_RATIO", 10),
    ]


def contract_raw_score() -> Column:
    return reduce(Column.__add__, [_points(t, p) for t, _, _, p in _contract_rules()]).cast("int")


def contract_reasons() -> Column:
    return F.concat(*[_trail(t, reason) for t, reason, _, _ in _contract_rules()])


def contract_hits() -> Column:
    return F.concat(*[_trail(t, code) for t, _, code, _ in _contract_rules()])


def account_rule_score(large_threshold: float | Column) -> Column:
    """0..7 account score from the account-feature columns."""
    parts = [
        _points(F.col("laundering_event_count") > 0, 3),
        _points(F.col("max_out_amount") >= large_threshold, 2),
        _points(F.col("counterparty_count") >= 20, 1),
        _points(F.col("cross_currency_event_count") >= 5, 1),
    ]
    return reduce(Column.__add__, parts).cast("int")


def large_hits(quantile: float | Column, absolute: float = K.LARGE_AMOUNT) -> Column:
    """Names of the large-amount rules a transaction meets, as an array."""
    amount = F.col("amount_paid")
    crossing = _one("is_cross_bank") & _one("is_cross_currency")
    return F.array_compact(
        F.array(
            F.when(amount >= quantile, K.HIT_QUANTILE),
            F.when(amount >= absolute, K.HIT_ABSOLUTE),
            F.when(crossing & (amount >= F.lit(quantile) * 0.5), K.HIT_CROSS),
        )
    )
