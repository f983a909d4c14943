from __future__ import annotations

import math
import zlib
from datetime import datetime

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from riskweave.functions import columns as C


def one(df, col):
    return [r[0] for r in df.select(col).collect()]


def python_amount(text):
    cleaned = text.strip().replace(",", "")
    if cleaned == "":
        return None
    try:
        return float(cleaned)
    except ValueError:
        return None


AMOUNTS = [
    "1,234.50", " 12 ", "abc", "", "  ", "1d", "2F", "0x1p3", "inf", "-Infinity", "nan", "1e3",
    "1_000", "1__0", "_1", "-5", "+7.25", ".5", "5.", "1 2", "\t9\n", "--1", "1,2,3",
]


def test_parse_amount_matches_float_parsing(rows):
    df = rows("t string", [(t,) for t in AMOUNTS])
    got = one(df, C.parse_amount("t"))
    for text, value in zip(AMOUNTS, got):
        want = python_amount(text)
        if want is not None and math.isnan(want):
            assert math.isnan(value), text
        else:
            assert value == want, text


def test_parse_ts_keeps_bad_rows(rows):
    texts = ["2022/09/01 00:20", "2022/9/1 0:20", " 2022/09/01 23:59 ", "bad", "", "2022-09-01 00:20",
             "2022/13/01 00:00", "2022/02/30 10:00", "2022/09/01 24:00"]
    df = rows("t string", [(t,) for t in texts])
    parts = C.parse_ts("t")
    got = df.select(*[parts[k].alias(k) for k in parts if k != "event_ts"]).collect()
    for text, row in zip(texts, got):
        try:
            want = datetime.strptime(text.strip(), "%Y/%m/%d %H:%M")
        except ValueError:
            assert tuple(row) == ("", None, "", "fail"), text
        else:
            assert tuple(row) == (
                want.strftime("%Y-%m-%d"), want.hour, want.strftime("%Y-%m-%d %H:%M"), "pass"
            ), text


def test_truthy_and_int(rows):
    df = rows("t string", [(t,) for t in ("1", " true ", "True", "TRUE", "0", "yes", None, "")])
    assert one(df, C.truthy_int("t")) == [1, 1, 1, 0, 0, 0, 0, 0]
    df = rows("t string", [("1.0",), ("0",), (" 1 ",)])
    assert one(df, C.lossless_int("t")) == [1, 0, 1]


def test_amount_bins_are_left_closed(rows):
    values = [-0.01, 0.0, 99.99, 100.0, 1e3, 1e4, 1e5, 1e6, 9999999.99, 1e7, float("inf"), float("nan"), None]
    df = rows("a double", [(v,) for v in values])
    assert one(df, C.amount_bin("a")) == [
        None, "0-100", "0-100", "100-1k", "1k-10k", "10k-100k", "100k-1m", "1m-10m", "1m-10m",
        "10m+", None, None, None,
    ]


def test_risk_bucket_edges(rows):
    df = rows("s int", [(v,) for v in (100, 80, 79, 60, 59, 30, 29, 0, None)])
    assert one(df, C.risk_bucket("s")) == [
        "CRITICAL", "CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "LOW"]


def test_rate_of_zero(rows):
    df = rows("a long, b long", [(1, 3), (0, 0), (2, 0)])
    assert one(df, C.rate(F.col("a"), F.col("b"), 8)) == [0.33333333, 0.0, 0.0]


def test_normalize_time_formats(rows):
    cases = {
        "2022/09/01 00:20": "2022-09-01T00:20:00Z",
        "2022/9/1 0:20:07": "2022-09-01T00:20:07Z",
        "2022-09-01 00:20:07.5": "2022-09-01T00:20:07.500000Z",
        "2022-09-01 00:20:07.000000": "2022-09-01T00:20:07Z",
        " 2022-09-01 00:20:07 ": "2022-09-01T00:20:07Z",
        "later": "later",
        "": "",
    }
    df = rows("t string", [(t,) for t in cases])
    assert one(df, C.normalize_time("t")) == list(cases.values())
    short = ("yyyy/M/d H:m", "yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d H:m:s")
    assert one(rows("t string", [("2022/9/1 0:20:07",)]), C.normalize_time("t", short)) == ["2022/9/1 0:20:07"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=12).filter(lambda s: "\x00" not in s and s.isprintable()), min_size=1, max_size=30))
def test_salted_row_key_is_crc32(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    got = [r[0] for r in df.select(C.salted_row_key("a")).collect()]
    assert got == [f"{zlib.crc32(t.encode()) & 0xFFFFFFFF:08x}#{t}" for t in texts]


def test_feature_group_order(rows):
    names = {
        "payment_format_ACH": "payment_format", "payment_currency_Euro": "payment_currency",
        "log_amount_paid": "amount", "hour_cos": "time", "from_cross_bank_event_count": "cross_institution_currency",
        "is_cross_currency": "cross_institution_currency", "from_out_in_ratio": "account_ratio",
        "from_debit_count": "account_behavior", "zzz": "other",
    }
    df = rows("f string", [(n,) for n in names])
    assert one(df, C.feature_group("f")) == list(names.values())


def test_tsv_cell(rows):
    df = rows("t string", [("a\tb",), ("a\r\nb\rc\nd",), (None,)])
    assert one(df, C.tsv_cell("t")) == ["a b", "a b c d", ""]


def test_money_sum_is_exact_and_order_free(rows):
    amounts = [0.1] * 1000 + [1e11, 0.000001, -5.25, 123456.789]
    df = rows("a double", [(x,) for x in amounts] + [(None,)])
    exact = 100.0 + 1e11 + 0.000001 - 5.25 + 123456.789
    for parts in (1, 3, 7):
        assert df.repartition(parts).agg(C.money_sum("a")).first()[0] == exact
    assert df.filter("a is null").agg(C.money_sum("a")).first()[0] is None
    big = rows("a double", [(1e15,), (2.5,), (float("inf"),)])
    assert big.filter("a < 1e300").agg(C.money_sum("a")).first()[0] == 1e15 + 2.5
    assert big.agg(C.money_sum("a")).first()[0] == float("inf")


def test_money_sum_decimal_rounds_half_even(rows):
    def total(*xs):
        return str(rows("a double", [(x,) for x in xs]).agg(C.money_sum_decimal("a")).first()[0])

    assert total(0.1, 0.2) == "0.30"
    assert total(1.005, 0.01) == "1.02"  # 1.015 -> even
    assert total(1.005, 0.0) == "1.00"   # 1.005 -> even
    assert total(2.5e9, 0.001) == "2500000000.00"


def test_money_sums_of_large_totals(rows):
    many = rows("a double", [(9e17,)] * 40 + [(-1.25,), (0.5,)])
    assert many.agg(C.money_sum("a")).first()[0] == 3.6e19
    assert many.agg(C.money_sum_decimal("a")).first()[0] is None  # 20 whole digits
    one = rows("a double", [(9e15 + 2,), (-9e15,), (0.125,), (0.25,)])
    assert one.agg(C.money_sum("a")).first()[0] == 2.375
    assert str(one.agg(C.money_sum_decimal("a")).first()[0]) == "2.38"


def test_money_sums_with_infinity(rows):
    df = rows("a double", [(float("inf"),), (2.0,)])
    assert df.agg(C.money_sum("a")).first()[0] == float("inf")
    assert df.agg(C.money_sum_decimal("a")).first()[0] is None
    assert rows("a double", [(float("nan"),), (2.0,)]).agg(C.money_sum_decimal("a")).first()[0] is None
