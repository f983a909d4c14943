from __future__ import annotations

import csv
import io

import pytest
from pyspark.sql import functions as F

from riskweave import constants as K, schemas as S
from riskweave.operators import detail as D, joins as J, marts as M, profiling as P
from riskweave.plans import warehouse as W
from riskweave.sources import layers as L, raw_files as R

HEADER = ",".join(K.TRANSACTION_HEADER)
LINES = [
    "2022/09/01 00:20,010,8000EBD30,010,8000EBD30,3697.34,US Dollar,3697.34,US Dollar,Reinvestment,0",
    '2022/9/1 0:20, 03208 ,8000F4580,001,8000F5340,"1,234.50",Euro,"1,234.50",US Dollar,Cheque,1',
    "short,row",
    "2022/09/01 00:00,1,A,2,B,5,X,abc,X,ACH,0",
    "2022/09/01 00:00,1,A,2,B,5,X,,X,ACH,0",
    "bad,1,A,2,C,7,X,7,X,ACH,0",
    "2022/09/01 00:00,1,A,2,B,5,X,6,X,ACH,0,extra",
    "2022/09/02 10:05,1,B,1,B,8,X,8,X,Wire,0",
]


@pytest.fixture()
def raw_file(tmp_path):
    path = tmp_path / "tx.csv"
    path.write_bytes(("﻿" + "\n".join([HEADER, *LINES]) + "\n").encode("utf-8"))
    return str(path)


def python_rows():
    return [r for r in csv.reader(io.StringIO("\n".join(LINES))) if len(r) == 11]


def test_read_is_positional_and_trimmed(spark, raw_file):
    good, bad = R.split_malformed(R.read_transactions_csv(spark, raw_file))
    want = [tuple(v.strip() for v in r) for r in python_rows()]
    assert [tuple(r) for r in good.select(*S.ODS_COLUMNS).collect()] == want
    assert good.count() == 6 and bad.count() == 2


def test_pruned_reads_still_see_malformed_rows(spark, raw_file):
    good, bad = R.split_malformed(R.read_transactions_csv(spark, raw_file))
    assert good.select("from_bank").count() == 6
    assert bad.agg(F.count("*")).first()[0] == 2


def test_ids_are_dense_before_the_amount_filter(spark, raw_file):
    numbered, _ = W.numbered_raw(spark, raw_file)
    ids = [r[0] for r in numbered.orderBy("transaction_id").select("transaction_id").collect()]
    assert ids == [f"HI_SMALL_{i:010d}" for i in range(1, 7)]
    dwd = D.build_dwd_transactions(numbered).orderBy("transaction_id").collect()
    assert [r["transaction_id"][-1] for r in dwd] == ["1", "2", "5", "6"]
    assert [r["transaction_minute"] for r in dwd] == ["2022-09-01 00:20", "2022-09-01 00:20", "", "2022-09-02 10:05"]
    assert [r["transaction_hour"] for r in dwd] == [0, 0, None, 10]
    assert [r["amount_paid"] for r in dwd] == [3697.34, 1234.5, 7.0, 8.0]
    assert [r["is_cross_bank"] for r in dwd] == [0, 1, 1, 0]
    assert [r["is_cross_currency"] for r in dwd] == [0, 1, 0, 0]
    assert D.to_events(D.build_dwd_transactions(numbered)).count() == 8


def test_file_sequence_over_many_files_and_splits(spark, tmp_path):
    line = "2022/09/01 00:20,1,{i},2,B,1,X,1,X,ACH,0"
    n = 0
    for part in range(3):
        body = [HEADER]
        for _ in range(4000 + 1000 * part):
            body.append("broken" if n % 7 == 0 else line.format(i=n))
            n += 1
        (tmp_path / f"part-{part}.csv").write_text("\n".join(body) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        numbered, _ = W.numbered_raw(spark, str(tmp_path))
        assert numbered.select("_file", "_block").distinct().count() > 6
        got = numbered.select(F.col("from_account").cast("int").alias("i"), "_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {i: k + 1 for k, i in enumerate(i for i in range(n) if i % 7)}
    assert {r["i"]: r["_seq"] for r in got} == want


def test_bad_label_aborts(spark, rows):
    raw = rows(S.RAW_TRANSACTIONS, [("t", "1", "A", "2", "B", "1", "X", "1", "X", "ACH", "maybe")])
    with pytest.raises(Exception):
        D.ods_typed(raw).collect()


def test_accounts_keep_duplicates(spark, tmp_path):
    path = tmp_path / "acc.csv"
    path.write_text(",".join(K.ACCOUNT_HEADER) + "\nB1, 7 ,A,E1,Ann\nB1,7,A,E2,Bob\nB2,8,C,E1\n")
    good, bad = R.split_malformed(R.read_accounts_csv(spark, str(path)))
    acc = D.build_dwd_accounts(good)
    assert bad.count() == 1
    assert P.account_dim_summary(acc).first().asDict() == {
        "row_count": 2, "unique_account_count": 1, "duplicate_account_number_count": 1,
        "bank_count": 1, "entity_count": 2,
    }


def test_coverage_counts_and_examples(spark, rows):
    numbered = rows(
        "transaction_id string, from_account string, to_account string",
        [("t1", "A", "Z"), ("t2", "Y", "Y"), ("t3", "A", "B")],
    )
    acc = rows("account_number string", [("A",), ("A",), ("B",)])
    row = J.account_coverage(numbered, acc).first()
    assert (row["from_account_missing_count"], row["to_account_missing_count"]) == (1, 2)
    assert row["from_account_match_rate"] == pytest.approx(2 / 3)
    found = [tuple(r) for r in J.missing_account_examples(numbered, acc, 2).collect()]
    assert found == [("to", "Z", "t1"), ("from", "Y", "t2")]
    empty = J.account_coverage(numbered.limit(0), acc).first()
    assert empty["from_account_match_rate"] == 0.0


def test_pattern_lines(rows):
    text = [
        "BEGIN LAUNDERING ATTEMPT - FAN-OUT:  Max 16-degree Fan-Out",
        LINES[0], '  ' + LINES[1].replace(" 03208 ", "03208"), "", "   ", "2022,1",
        LINES[0][:-1] + "2", "END LAUNDERING ATTEMPT - FAN-OUT", "BEGIN LAUNDERING ATTEMPT - STACK",
    ]
    typed = R.type_pattern_lines(rows("value string", [(t,) for t in text]))
    got = [(r["kind"], r["pattern_type"], r["label"]) for r in typed.collect()]
    assert got == [
        ("begin", "FAN-OUT", None), ("transaction", None, "0"), ("transaction", None, "1"),
        ("other", None, None), ("other", None, None), ("end", None, None), ("begin", "STACK", None),
    ]
    profile = {(r["section"], r["key"]): r["count"] for r in P.profile_patterns(typed).collect()}
    assert profile[("line", "all")] == 7 and profile[("kind", "begin")] == 2
    assert profile[("label", "1")] == 1 and profile[("pattern_type", "STACK")] == 1


def test_header_and_inventory(spark, raw_file, tmp_path):
    assert R.check_header(spark, raw_file, K.TRANSACTION_HEADER).first()["status"] == "pass"
    assert R.check_header(spark, raw_file, K.ACCOUNT_HEADER).first()["status"] == "fail"
    assert R.check_header(spark, raw_file, None).first()["status"] == "not_applicable"
    row = R.source_inventory(spark, str(tmp_path)).first()
    assert row["file"] == "tx.csv" and row["mb"] == "0.00"
    (tmp_path / "HI-Small_Trans.csv").write_text("x")
    verdict = R.forbidden_files(R.source_inventory(spark, str(tmp_path))).first()
    assert (verdict["file_count"], verdict["bad_file_count"], verdict["status"]) == (2, 1, "FAIL")


def test_json_lines(spark, tmp_path):
    lines = ['{"run_id":"r1","transaction_id":"a","amount_paid":1.5}', "", "   ", "[1]", "{broken",
             '{"run_id":"r2","transaction_id":"b"}', '  {"run_id":"r1","transaction_id":"c","amount_paid":"x"}  ',
             '{"run_id":"r1"} tail', '{"run_id":"r1"},{"run_id":"r1"}']
    (tmp_path / "e.jsonl").write_text("\n".join(lines))
    got = L.read_jsonl_events(spark, str(tmp_path), S.REPLAY_EVENT, "r1").orderBy("transaction_id").collect()
    assert [(r["transaction_id"], r["amount_paid"]) for r in got] == [("a", 1.5), ("c", None)]


def test_profile_and_layers(spark, raw_file, tmp_path):
    row = P.profile_transactions(R.read_transactions_csv(spark, raw_file)).first()
    assert row["row_count"] == 6 and row["malformed_count"] == 2 and row["invalid_amount_count"] == 2
    assert row["account_count"] == 6 and row["amount_paid_sum"] == 3697.34 + 1234.5 + 7 + 8
    (tmp_path / "acc.csv").write_text(",".join(K.ACCOUNT_HEADER) + "\nB1,1,A,E1,Ann\n")
    out = str(tmp_path / "out")
    dwd = W.build_detail(spark, raw_file, str(tmp_path / "acc.csv"), out, "run1")
    paths = W.build_marts(dwd, out, "run1")
    assert dwd.count() == 4
    assert spark.read.parquet(f"{out}/dwd_events").count() == 8
    minutes = L.latest_run(spark.read.parquet(paths["dws_minute_kpi"]), "run")
    assert minutes.count() == 4  # the unparsable time is a minute of its own
    accounts = spark.read.parquet(paths["dws_account_features"])
    assert accounts.count() == M.account_base(dwd).count()
