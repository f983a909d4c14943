"""Logs, keyed streaming state, restarts, windows that close, and keyed tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T
from test_scoring_state import valid_event

from riskweave.operators import contract as CT, marts as M, state as ST
from riskweave.plans import realtime as RT
from riskweave.sinks import state_tables as KV
from riskweave.sinks.keyed_tables import BUCKET, KeyedTable
from riskweave.sources import adapters as A
from riskweave.streaming import jobs as SJ, topics as SK


def _events(n: int = 240) -> list[tuple]:
    """(partition, offset, value): accounts of which one has a third of all events; faults among them."""
    out = []
    for i in range(n):
        account = "hot" if i % 3 == 0 else f"A{i % 17}"
        change = {"risk_score": 101} if i % 20 == 5 else {}
        event = valid_event(transaction_id=f"t{(i * 37) % n:04d}", event_account=account, **{"risk_score": i % 101, **change})
        out.append((sum(account.encode()) % 3, i, json.dumps(event)))
    return out


def _latest(events: list[tuple]) -> dict[str, tuple]:
    found = {}
    for _, offset, value in sorted(events, key=lambda e: e[1]):
        event = json.loads(value)
        if event["risk_score"] <= 100:
            found[event["event_account"]] = (event["transaction_id"], event["risk_score"])
    return found


def _run(spark, log, root, checkpoint, files_per_batch):
    raw = SJ.raw_stream(spark, "topic", log, maxFilesPerTrigger=files_per_batch)
    return SJ.state_job(raw, CT.STATE, root, checkpoint, SK.POSITION, stamp=F.lit("u"), buckets=4)


def _state(spark, root):
    rows = SJ.state_table(root, "durable").read(spark).collect()
    return {r["event_account"]: (r["meta"]["transaction_id"], r["s"]["risk_score"]) for r in rows}


@pytest.mark.parametrize("files, per_batch", [(1, None), (5, 2)])
def test_latest_state_is_the_last_arrival(spark, rows, tmp_path, files, per_batch):
    log, root = str(tmp_path / "log"), str(tmp_path / "root")
    data = _events()
    # the files hold the messages in another order than they arrived in
    SK.write_topic(rows("partition int, offset long, value string", data), log, files)
    for query in _run(spark, log, root, str(tmp_path / "ck"), per_batch):
        query.awaitTermination()
    assert _state(spark, root) == _latest(data)
    cache = SJ.state_table(root, "cache").read(spark).collect()
    assert {r["key"]: json.loads(r["value"])["transaction_id"] for r in cache} == {f"risk:latest:{a}": t for a, (t, _) in _latest(data).items()}
    metrics = KV.read_batches(spark, f"{root}/metrics")
    batches = 1 if per_batch is None else 3
    assert metrics.count() >= batches
    observed = ST.observed_summary(metrics, SJ.state_table(root, "cache").read(spark)).first().asDict()
    checked = CT.contract_errors(spark.read.parquet(log).select("value"), CT.STATE)
    assert observed == ST.stream_summary(checked, F.get_json_object("value", "$.event_account")).first().asDict()
    assert observed["schema_invalid_event_count"] == sum(i % 20 == 5 for i in range(240))


def test_state_survives_a_sink_that_fails(spark, rows, tmp_path, monkeypatch):
    """The merge is cut off between the kept copy and the table; the batch runs again and nothing is lost."""
    log, root, checkpoint = (str(tmp_path / x) for x in ("log", "root", "ck"))
    data = _events()
    for part in (data[:90], data[90:150], data[150:]):
        SK.write_topic(rows("partition int, offset long, value string", part), log)
    put, calls = KeyedTable._put, []

    def failing(self, frame):
        calls.append(self.path)
        if len(calls) == 4:
            raise RuntimeError("lost while folders were replaced")
        put(self, frame)

    monkeypatch.setattr(KeyedTable, "_put", failing)
    first = _run(spark, log, root, checkpoint, 1)
    first[0].awaitTermination()
    with pytest.raises(Exception, match="lost while folders"):
        first[1].awaitTermination()
    for query in _run(spark, log, root, checkpoint, 1):
        query.awaitTermination()
    assert _state(spark, root) == _latest(data)
    assert KV.read_batches(spark, f"{root}/events").count() == sum(json.loads(v)["risk_score"] <= 100 for *_, v in data)


def test_a_stopped_replay_goes_on(spark, dwd, tmp_path):
    from riskweave import schemas as S
    from riskweave.operators import detail as D

    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "ck")
    replay = D.to_replay(dwd, "r1")
    SK.write_topic(SK.messages_of(replay, "from_account", F.substring("transaction_id", 4, 10)), log, files=6)
    files = spark.read.parquet(log).select(F.col("_metadata.file_path")).distinct().count()

    def drain(out, checkpoint, per_batch):
        events = SJ.stream_source(spark, "topic", log, S.REPLAY_EVENT, maxFilesPerTrigger=per_batch)
        return SJ.event_sink(events, "files", out, checkpoint)

    done = SK.run_batches(drain(str(tmp_path / "out"), checkpoint, 1), 2)
    query = drain(str(tmp_path / "out"), checkpoint, 1)
    query.awaitTermination()
    assert 2 <= done <= files and query.lastProgress["batchId"] + 1 == files > 3
    drain(str(tmp_path / "whole"), str(tmp_path / "ck2"), None).awaitTermination()
    schema = T.StructType([*S.REPLAY_EVENT.fields, *SK.MESSAGE.fields[:2]])
    parts, whole = (spark.read.schema(schema).json(str(tmp_path / x)) for x in ("out", "whole"))
    assert parts.count() == whole.count() == dwd.count()
    assert parts.exceptAll(whole).count() == 0


def test_minutes_close_and_count_accounts_exactly(spark, sf, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    events = A.detail(spark, sf, extra=("ts",)).withColumnRenamed("ts", "event_ts")
    # one account on a third of all payments, and accounts that are missing
    hot = F.xxhash64("transaction_id")
    events = events.withColumns({
        "from_account": F.when(hot % 3 == 0, "hot").otherwise(F.col("from_account")),
        "to_account": F.when(hot % 11 != 0, F.col("to_account")),
    })
    events.write.parquet(folder)

    def drain():
        stream = spark.readStream.schema(events.schema).parquet(folder)
        query = SJ.streaming_minute_kpi(stream).writeStream.format("parquet").option("path", out).outputMode("append")
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    drain()
    stored = spark.read.parquet(folder)
    before = spark.read.parquet(out).count()
    last = stored.agg(F.max("event_ts")).first()[0]
    SJ.heartbeat(stored, "event_ts", F.lit(last) + F.expr("INTERVAL 12 MINUTES")).write.mode("append").parquet(folder)
    drain()
    batch = M.minute_kpi(stored.filter("transaction_id IS NOT NULL"))
    streamed = spark.read.parquet(out).select(*batch.columns)
    assert before < batch.count() == streamed.count()
    assert streamed.exceptAll(batch).count() == 0


def test_keyed_table_reads_and_writes_touched_buckets_only(spark, rows, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k", "ts", buckets=8)
    schema = "k long, ts int, v string"
    table.merge(rows(schema, [(i, 5, f"a{i}") for i in range(200)]))
    files = lambda: {(r[0], r[1]) for r in spark.read.parquet(table.path).select(BUCKET, "_metadata.file_path").distinct().collect()}
    before = files()
    updates = rows(schema, [(3, 6, "newer"), (3, 4, "old"), (1000, 1, "new")])
    touched = {r[0] for r in updates.select(F.pmod(F.xxhash64("k"), F.lit(8)).cast("int")).distinct().collect()}
    assert 1 <= len(touched) <= 2
    table.merge(updates)
    after = files()
    assert {b for b, _ in before ^ after} == touched and len({b for b, _ in before}) == 8
    want = {i: f"a{i}" for i in range(200)} | {3: "newer", 1000: "new"}
    assert {r["k"]: r["v"] for r in table.read(spark).collect()} == want
    plan = table.touched(spark, sorted(touched))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan
    assert {tuple(r) for r in table.lookup(spark, [3, 77, 5000]).collect()} == {(3, 6, "newer"), (77, 5, "a77")}


def test_keyed_table_ties_nulls_and_repeats(spark, rows, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k", "ts", buckets=3)
    schema = "k string, ts int, v string"
    table.merge(rows(schema, [("a", 1, "first"), ("b", None, "no time"), ("c", 9, "stays")]))
    for _ in range(2):  # the same batch again
        table.merge(rows(schema, [("a", 1, "tie"), ("b", 0, "timed"), ("c", 8, "late"), ("d", None, "new")]), token=7)
    want = {("a", 1, "tie"), ("b", 0, "timed"), ("c", 9, "stays"), ("d", None, "new")}
    assert {tuple(r) for r in table.read(spark).collect()} == want
    table.merge(rows(schema, []), token=8)
    table.forget(spark, 7)
    assert {tuple(r) for r in table.read(spark).collect()} == want


def test_search_index_keeps_the_last_scoring(spark, rows, tmp_path):
    index = RT.search_index(str(tmp_path), buckets=2)
    schema = "run_id string, transaction_id string, event_time string, scored_at string, risk_score int"

    def put(*docs):
        RT.index_documents(rows(schema, [("r", i, "2024/01/01 00:00", at, s) for i, at, s in docs]), index, ["risk_score"])

    put(("t1", "2024-06-01 10:00:00", 5), ("t2", "2024-06-01 10:00:00", 6))
    put(("t1", "2024-06-01 09:59:59.9", 1), ("t2", "2024-06-01 10:00:00.25", 9), ("t2", "2024-06-01 10:00:00.25", 8))
    put(("t3", "bad", 4))
    assert {r["doc_id"]: r["risk_score"] for r in index.read(spark).collect()} == {"r:t1": 5, "r:t2": 9, "r:t3": 4}


@pytest.mark.parametrize("name, batch_share", [("j06_latest_state_sink", 1), ("j06_state_in_cache", 3), ("j09_observed_summary", 2)])
def test_larger_logs_have_more_files_not_larger_ones(spark, sf, monkeypatch, name, batch_share):
    """Every file of the log holds about the same number of messages, and a micro-batch the same share of the log."""
    from riskweave.plans.registry import QUERIES

    class Enough(Exception):
        pass

    asked = {}

    def stop(spark, kind, location, **options):
        asked.update(options, location=location)
        raise Enough

    monkeypatch.setattr(SK, "SEGMENT_ROWS", 10, raising=False)
    monkeypatch.setattr(SJ, "raw_stream", stop)
    with pytest.raises(Enough):
        QUERIES[name](spark, sf)
    log = spark.read.parquet(asked["location"])
    rows, sizes = log.count(), [r["count"] for r in log.groupBy(F.col("_metadata.file_path")).count().collect()]
    files = SK.segments(A.table(spark, sf, "events").count(), 6) * 6
    assert max(sizes) <= 30 and len(sizes) >= rows / 20
    assert asked["maxFilesPerTrigger"] * 6 == batch_share * files >= 12


def test_a_merge_writes_its_rows_once_and_splits_large_buckets(spark, rows, tmp_path, monkeypatch):
    """Only the updates are staged, not the merged table; a bucket beyond the advised size is written by several tasks."""
    from riskweave.sinks import keyed_tables as KT

    labels = []
    monkeypatch.setattr(KT, "staged", lambda df, label, real=KT.staged: (labels.append(label), real(df, label))[1])
    table = KeyedTable(str(tmp_path / "t"), "k", "ts", buckets=2)
    noise = F.concat(F.md5(F.col("id").cast("string")), F.md5((F.col("id") + 7).cast("string")))
    data = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("k"), F.lit(1).alias("ts"), noise.alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        table.merge(data)
        table.merge(data.filter("k % 2 = 0").withColumns({"ts": F.lit(2), "v": F.lit("new")}))
        table.merge(data.filter("k % 4 = 0").withColumn("ts", F.lit(0)))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert labels == ["updates"] * 3
    files = spark.read.parquet(table.path).groupBy(BUCKET).agg(F.count_distinct(F.col("_metadata.file_path")).alias("n")).collect()
    assert len(files) == 2 and min(r["n"] for r in files) >= 2
    kept = table.read(spark)
    assert kept.count() == 60_000 == kept.select("k").distinct().count()
    assert kept.filter((F.col("k") % 2 == 0) != (F.col("v") == "new")).count() == 0


def test_later_columns_decide_between_updates_of_a_merge(spark, rows, tmp_path):
    table = KeyedTable(str(tmp_path / "t"), "k", "ts", buckets=2)
    table.merge(rows("k int, ts int, n int", [(1, 5, 1), (1, 5, 3), (1, 5, 2), (2, 1, 1)]), later=["n"])
    table.merge(rows("k int, ts int, n int", [(1, 4, 9), (2, 1, 0), (2, None, 9)]), later=["n"])
    assert {tuple(r) for r in table.read(spark).collect()} == {(1, 5, 3), (2, 1, 0)}
