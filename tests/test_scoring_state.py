from __future__ import annotations

import json

from pyspark.sql import functions as F

from riskweave import constants as K, schemas as S
from riskweave.functions import rules
from riskweave.operators import (
    contract as CT, detail as D, joins as J, scoring as SC, state as ST,
)
from riskweave.plans import inputs as I
from riskweave.sinks import state_tables as KV, tables as TB
from riskweave.sources import layers as L
from riskweave.streaming import jobs as SJ


def scoring_row(**change):
    base = dict(
        run_id="r1", contract_version=K.CONTRACT_V1, transaction_id="t", tx_timestamp="2022/09/01 00:20",
        transaction_date="2022-09-01", transaction_hour=0, from_account="A", to_account="B", amount_paid=1.0,
        log_amount_paid=0.0, payment_currency="Euro", payment_format="ACH", is_cross_bank=0, is_cross_currency=0,
        hour_sin=0.0, hour_cos=1.0, from_total_event_count=0, from_debit_count=0, from_credit_count=0,
        from_out_amount=0.0, from_in_amount=0.0, from_max_out_amount=0.0, from_counterparty_count=0,
        from_cross_bank_event_count=0, from_cross_currency_event_count=0, from_out_in_ratio=0.0,
        from_debit_credit_ratio=0.0, observed_is_laundering=0, split="train", feature_snapshot_version="f",
    )
    base.update(change)
    return tuple(base[c] for c in S.SCORING_INPUT.names)


def test_contract_scoring_edges(rows):
    everything = dict(amount_paid=1e7, is_cross_bank=1, is_cross_currency=1, from_cross_bank_event_count=10,
                      from_cross_currency_event_count=2, from_out_in_ratio=3.0, from_debit_credit_ratio=3.0)
    df = rows(S.SCORING_INPUT, [
        scoring_row(transaction_id="all", **everything),
        scoring_row(transaction_id="m30", is_cross_currency=1, is_cross_bank=1),
        scoring_row(transaction_id="m25", amount_paid=1e6),
        scoring_row(transaction_id="m35", amount_paid=1e7),
        scoring_row(transaction_id="nulls", amount_paid=None, is_cross_bank=None, is_cross_currency=1, from_debit_credit_ratio=3.0),
        scoring_row(transaction_id="run", run_id="r2", **everything),
        scoring_row(transaction_id="version", contract_version="x", **everything),
    ])
    got = {r["transaction_id"]: r for r in SC.score_contract(df, "r1", scored_at=F.lit("now")).collect()}
    assert set(got) == {"all", "m30", "m35", "nulls"}
    top = got["all"]
    assert (top["risk_score"], top["risk_level"]) == (100, "CRITICAL")
    assert top["risk_reasons"] == (
        "AMOUNT_GE_10M;CROSS_CURRENCY;CROSS_BANK;ACCOUNT_CROSS_CURRENCY_GE_2;ACCOUNT_CROSS_BANK_GE_10;"
        "DEBIT_CREDIT_RATIO_GE_3;OUT_IN_RATIO_GE_3;")
    assert top["rule_hits"] == (
        "R_AMOUNT_10M;R_CROSS_CURRENCY;R_CROSS_BANK;R_ACCOUNT_CROSS_CURRENCY;R_ACCOUNT_CROSS_BANK;"
        "R_DEBIT_CREDIT_RATIO;R_OUT_IN_RATIO;")
    assert (got["m30"]["risk_score"], got["m30"]["risk_level"]) == (30, "MEDIUM")
    assert got["m35"]["rule_hits"] == "R_AMOUNT_10M;"
    assert got["nulls"]["risk_reasons"] == "CROSS_CURRENCY;DEBIT_CREDIT_RATIO_GE_3;"
    assert [f.name for f in SC.score_contract(df).schema] == S.SCORING_EVENT.names
    assert [f.name for f in SC.score_state(df).schema] == S.STATE_EVENT.names


def test_simple_rule_types(rows):
    def event(i, label, amount, bank, cur):
        return ("r1", i, "ts", "m", "1", "A", "2", "B", amount, "X", "ACH", label, bank, cur)

    df = rows(S.REPLAY_EVENT, [
        event("label", 1, 1.0, 0, 0), event("lcc", 0, 1e6, 1, 1), event("lcb", 0, 1e6, 1, 0), event("la", 0, 1e6, 0, 0),
        event("cc", 0, 1.0, 0, 1), event("none", 0, 1.0, 1, 0), event("null", None, None, 1, None),
    ])
    got = {r["transaction_id"]: (r["risk_type"], r["risk_score"], r["risk_reasons"]) for r in SC.risk_rules_v0(df, "r1").collect()}
    assert got == {
        "label": ("LABEL_HIT", 5, "LABEL_HIT;"),
        "lcc": ("LARGE_CROSS_CURRENCY", 4, "LARGE_AMOUNT;CROSS_BANK;CROSS_CURRENCY;"),
        "lcb": ("LARGE_CROSS_BANK", 3, "LARGE_AMOUNT;CROSS_BANK;"),
        "la": ("LARGE_AMOUNT", 2, "LARGE_AMOUNT;"),
        "cc": ("CROSS_CURRENCY", 1, "CROSS_CURRENCY;"),
    }


def valid_event(**change):
    event = {
        "run_id": "r1", "contract_version": K.CONTRACT_STATE, "transaction_id": "t", "event_time": "e",
        "event_account": "A", "counterparty_account": "B", "amount_paid": 1.5, "payment_currency": "X",
        "payment_format": "ACH", "feature_snapshot_version": "f", "risk_score": 30, "risk_level": "MEDIUM",
        "risk_reasons": "", "rule_hits": "", "state_operation": "UPSERT",
        "state_store_version": K.STATE_STORE_VERSION, "scored_at": "s",
    }
    event.update(change)
    return event


def python_errors(event, contract):
    """Direct reading of the contract, to compare with."""
    kinds = {"text": str, "int": int, "number": (int, float)}
    errors = []
    for name, kind in contract.kinds().items():
        if name not in event:
            errors.append(f"missing:{name}")
        elif not isinstance(event[name], kinds[kind]):
            errors.append(f"type:{name}")
    errors += [n for n, v in contract.constants.items() if event.get(n) != v]
    score = event.get("risk_score")
    if isinstance(score, int) and not 0 <= score <= 100:
        errors.append("risk_score_range")
    if event.get("risk_level") not in K.ALL_RISK_LEVELS:
        errors.append("risk_level")
    return errors


def test_contract_errors_match_direct_check(rows):
    events = [valid_event()]
    events += [valid_event(risk_score=v) for v in (0, 100, 101, -1, 25.0, 1e300, True, "7", None, [1], {"a": 1}, 10**20)]
    events += [valid_event(amount_paid=v) for v in (1, 0, -2.5, 1e30, 10**25, True, "1.5", None)]
    events += [valid_event(risk_level=v) for v in ("LOW", "HIGH", "CRITICAL", "high", "", None, 3)]
    events += [valid_event(contract_version="x"), valid_event(state_operation=None), valid_event(state_store_version=1), valid_event(event_time=5)]
    for name in S.STATE_EVENT.names:
        gone = valid_event()
        del gone[name]
        events.append(gone)
    events.append({})
    df = rows("i int, value string", [(i, json.dumps(e)) for i, e in enumerate(events)])
    for contract in (CT.STATE, CT.SCORING):
        got = {r["i"]: r[CT.ERRORS] for r in CT.contract_errors(df, contract).collect()}
        for i, e in enumerate(events):
            assert got[i] == python_errors(e, contract), (events[i], got[i])
    valid, invalid = CT.validate_contract(df, CT.STATE)
    n_ok = sum(not python_errors(e, CT.STATE) for e in events)
    assert valid.count() == n_ok and invalid.count() == len(events) - n_ok


def test_upsert_smoke(rows):
    schema = "account_number string, risk_level string, risk_score double, updated_at string, source_event_time string"
    base = rows(schema, [
        ("acct-001", "LOW", 0.12, "2026-07-01 08:00:00", "2026-07-01 08:00:00"),
        ("acct-002", "MEDIUM", 0.51, "2026-07-01 08:01:00", "2026-07-01 08:01:00"),
        ("acct-003", "HIGH", 0.92, "2026-07-01 08:02:00", "2026-07-01 08:02:00"),
    ])
    updates = rows(schema, [
        ("acct-002", "HIGH", 0.88, "2026-07-01 08:05:00", "2026-07-01 08:05:00"),
        ("acct-002", "LOW", 0.2, "2026-07-01 08:04:00", "2026-07-01 08:04:00"),
        ("acct-004", "LOW", 0.18, "2026-07-01 08:06:00", "2026-07-01 08:06:00"),
        ("acct-003", "LOW", 0.1, "2026-07-01 08:00:00", "2026-07-01 07:00:00"),
        ("acct-001", "MEDIUM", 0.5, "x", "2026-07-01 08:00:00"),
    ])
    got = {r["account_number"]: (r["risk_level"], r["risk_score"])
           for r in ST.upsert(base, updates, "account_number", "source_event_time").collect()}
    assert got == {"acct-001": ("MEDIUM", 0.5), "acct-002": ("HIGH", 0.88), "acct-003": ("HIGH", 0.92), "acct-004": ("LOW", 0.18)}


def test_state_batches_last_one_wins(spark, rows, tmp_path):
    path = str(tmp_path / "kv")
    KV.put_batch(rows("key string, value int", [("a", 1), ("b", 1)]), path, 0)
    KV.put_batch(rows("key string, value int", [("a", 2)]), path, 1)
    KV.put_batch(rows("key string, value int", [("a", 3)]), path, 1)  # the batch runs again
    assert {tuple(r) for r in KV.read_latest(spark, path, "key").collect()} == {("a", 3), ("b", 1)}
    KV.compact(spark, path, "key", str(tmp_path / "kv2"))
    assert KV.read_latest(spark, str(tmp_path / "kv2"), "key").count() == 2


def test_consistency_flags_missing_and_different(rows):
    cache = rows("event_account string, risk_score int, risk_level string", [("A", 30, "MEDIUM"), ("B", 60, "HIGH"), ("C", 80, "CRITICAL")])
    durable = rows("event_account string, risk_score int, risk_level string", [("A", 30, "MEDIUM"), ("B", 61, "HIGH")])
    got = {r["event_account"]: r["status"] for r in J.state_consistency(cache, durable).collect()}
    assert got == {"A": "PASS", "B": "FAIL", "C": "FAIL"}
    assert J.state_consistency(cache, durable, 1).count() == 1


def test_level_and_rule_counts(rows):
    df = rows("risk_level string, rule_hits string", [("HIGH", "R_A; R_B;;"), ("HIGH", ""), ("LOW", "R_A;")])
    got = {r["metric"]: r["value"] for r in ST.level_and_rule_counts(df).collect()}
    assert got == {"risk_level.HIGH": 2, "risk_level.LOW": 1, "rule_hit.R_A": 2, "rule_hit.R_B": 1}


def _replayed(spark, events, tmp_path, schema):
    folder = str(tmp_path / "topic")
    SJ.write_replay(events, folder)
    return SJ.stream_source(spark, "files", folder, schema)


def _drain(spark, stream, tmp_path, name):
    out = str(tmp_path / name)
    SJ.event_sink(stream, "files", out, str(tmp_path / f"{name}-ck")).awaitTermination()
    return spark.read.schema(stream.schema).json(out)


def test_stream_equals_batch_for_simple_rules(spark, dwd, tmp_path):
    replay = D.to_replay(dwd, "r1")
    stream = SC.risk_rules_v0(_replayed(spark, replay, tmp_path, S.REPLAY_EVENT), "r1")
    drained = _drain(spark, stream, tmp_path, "out")
    batch = SC.risk_rules_v0(replay, "r1")
    assert drained.exceptAll(batch).count() == 0 and batch.exceptAll(drained).count() == 0


def test_stream_equals_batch_for_contracts(spark, sf, tmp_path):
    from riskweave.session import staged

    inputs = staged(I.scoring_input(spark, sf), "inputs")
    stream = _replayed(spark, inputs, tmp_path, S.SCORING_INPUT)
    at = F.lit("2024-06-01 00:00:00")
    batch = SC.score_state(inputs, "r1", at)
    drained = _drain(spark, SC.score_state(stream, "r1", at), tmp_path, "state")
    assert batch.count() > 0
    assert drained.exceptAll(batch).count() == 0 and batch.exceptAll(drained).count() == 0


def test_state_job_across_batches(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "root")
    folder.mkdir()

    def send(name, events):
        (folder / name).write_text("\n".join(json.dumps(e) for e in events))
        raw = SJ.raw_stream(spark, "files", str(folder), arrival=True)
        arrival = ["arrived", "file", "transaction_id"]
        for query in SJ.state_job(raw, CT.STATE, root, str(tmp_path / "ck"), arrival, stamp=F.lit("u"), buckets=4):
            query.awaitTermination()

    send("a.json", [valid_event(transaction_id="t1"), valid_event(transaction_id="t2", risk_score=60, risk_level="HIGH"),
                    valid_event(transaction_id="t9", event_account="Z"), valid_event(risk_score=101)])
    # a later batch wins although its transaction id sorts first
    send("b.json", [valid_event(transaction_id="t0", risk_score=80, risk_level="CRITICAL")])
    rows_ = SJ.state_table(root, "durable").read(spark).drop("batch_id")
    got = {r["event_account"]: (r["s"]["risk_score"], r["meta"]["transaction_id"]) for r in rows_.collect()}
    assert got == {"A": (80, "t0"), "Z": (30, "t9")}
    assert KV.read_batches(spark, f"{root}/invalid").count() == 1
    cache = {r["key"]: json.loads(r["value"])["risk_score"] for r in SJ.state_table(root, "cache").read(spark).collect()}
    assert cache == {"risk:latest:A": 80, "risk:latest:Z": 30}
    assert J.state_consistency(
        L.parse_events(SJ.state_table(root, "cache").read(spark), S.STATE_EVENT).drop("key", "batch_id"), ST.durable_view(rows_)
    ).filter("status <> 'PASS'").count() == 0
    assert ST.durable_state_cells(rows_).count() == 30


def test_publish_and_metrics(spark, rows, tmp_path):
    df = rows("metric string, value string", [("a\tb", "1\n2"), ("c", None)])
    TB.write_metrics(df, str(tmp_path / "m"), ["metric", "value", "status"])
    text = "".join(p.read_text() for p in (tmp_path / "m").glob("part-*.csv"))
    assert text.splitlines()[0] == "metric\tvalue\tstatus" and "a b\t1 2\t" in text
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    got = {r["table_name"]: r["status"] for r in TB.publish_tables(
        spark, {"t1": spark.range(5), "t2": spark.range(3)}, "lake", expected={"t1": 5, "t2": 4}).collect()}
    assert got == {"t1": "PASS", "t2": "FAIL"}
    again = TB.publish_tables(spark, {"t1": spark.range(2)}, "lake").first()
    assert again["actual_count"] == 2


def test_rule_points_are_total(rows):
    df = rows(S.SCORING_INPUT, [scoring_row(amount_paid=1e7, is_cross_bank=1)])
    assert df.select(rules.contract_raw_score()).first()[0] == 45


def test_latest_row_is_found_by_hash_aggregation(rows):
    from riskweave.operators.ranking import latest_per_key

    data = [("a", 1, 5, "x"), ("a", 2, 1, "y"), ("a", 2, 3, "z"), ("b", None, 1, "p"), ("b", None, 2, "q"), (None, 7, 1, "n"), ("c", 1, 1, None)]
    df = rows("k string, ts int, seq int, v string", data)
    newest = latest_per_key(df, "k", ["ts", "seq"])
    assert {(r["k"], r["v"]) for r in newest.collect()} == {("a", "z"), ("b", "q"), (None, "n"), ("c", None)}
    text = newest._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text and "shuffle_hash" not in text  # a forced hash build could not spill


def test_upsert_reads_the_base_once(rows):
    from riskweave.operators.state import upsert

    base = rows("k int, ts int, v string", [(1, 5, "a"), (2, 5, "b"), (3, None, "c"), (4, 9, "d"), (None, 1, "lost")])
    updates = rows("k int, ts int, v string", [(1, 6, "a2"), (1, 7, "a3"), (2, 5, "b2"), (3, 1, "c2"), (4, None, "d2"), (5, 1, "e"), (None, 3, "new")])
    out = upsert(base, updates, "k", "ts")
    want = {(1, "a3"), (2, "b2"), (3, "c2"), (4, "d"), (5, "e"), (None, "lost"), (None, "new")}
    assert {(r["k"], r["v"]) for r in out.collect()} == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("FullOuter") == 1
