"""Registered queries: scoring, contract, state, serving, sinks and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave import constants as K, schemas as S
from riskweave.operators import (
    contract as CT, detail as D, marts as M, profiling as P, ranking as R, scoring as SC,
    serving as SV, state as ST,
)
from riskweave.plans import inputs as I, realtime as RT, reference_sql as Q
from riskweave.plans.catalog import query
from riskweave.plans.queries_marts import _MINUTE, as_double, money
from riskweave.session import staged, work_path
from riskweave.sinks import state_tables as KV, tables as TB
from riskweave.sinks.keyed_tables import KeyedTable
from riskweave.sources import adapters as A, layers as L
from riskweave.streaming import jobs as SJ, topics as SK

# --- display tables and dashboard queries -----------------------------------------------

_ROLLUP = """rollup_ AS (
  SELECT event_account AS account_number, count(*) AS total_event_count, count(*) AS debit_count, 0 AS credit_count,
    CAST(sum(CAST(amount_paid AS DECIMAL(18,2))) AS DOUBLE) AS out_amount, count(DISTINCT counterparty_account) AS counterparty_count,
    count(*) FILTER (risk_level IN ('HIGH', 'CRITICAL') OR risk_score >= 60) AS laundering_event_count,
    count(*) FILTER (contains(risk_reasons || ';' || rule_hits, 'CROSS_BANK')) AS cross_bank_event_count,
    count(*) FILTER (contains(risk_reasons || ';' || rule_hits, 'CROSS_CURRENCY') OR payment_currency NOT IN ('', 'Yuan')) AS cross_currency_event_count,
    CAST(max(risk_score) AS DOUBLE) AS risk_score_rule
  FROM scored GROUP BY 1)"""


def _ads(spark, sf):
    return SV.ads_account_rollup(I.state_events(spark, sf), I.stamp())


@query("e22_ads_account_rollup", f"WITH {Q.SCORED}, {_ROLLUP} SELECT *, '2024-06-01 00:00:00' AS updated_at FROM rollup_")
def _(spark, sf):
    return as_double(_ads(spark, sf), "out_amount")


@query("e23_account_score_buckets", f"""WITH {Q.SCORED}, {_ROLLUP} SELECT {Q.LEVEL.format('risk_score_rule')} AS risk_bucket, count(*) AS account_count,
  round(avg(risk_score_rule), 4) AS avg_risk_score, round(sum(out_amount), 2) AS total_out_amount FROM rollup_ GROUP BY 1""")
def _(spark, sf):
    return as_double(SV.account_score_buckets(_ads(spark, sf)), "total_out_amount")


@query("e23_event_score_buckets", f"""WITH {Q.SCORED} SELECT {Q.LEVEL.format('risk_score')} AS risk_bucket, count(*) AS event_count,
  round(avg(risk_score), 4) AS avg_risk_score FROM scored GROUP BY 1""")
def _(spark, sf):
    return SV.event_score_buckets(I.state_events(spark, sf))


_MEASURES = """count(*) AS event_count, round(avg(risk_score), 4) AS avg_risk_score,
  round(CAST(sum(CAST(amount_paid AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_amount_paid"""


@query("e24_risk_level_distribution", f"WITH {Q.SCORED} SELECT risk_level, {_MEASURES} FROM scored GROUP BY 1")
def _(spark, sf):
    return money(SV.risk_level_distribution(I.state_events(spark, sf)), "total_amount_paid")


@query("e25_payment_currency_risk", f"""WITH {Q.SCORED} SELECT payment_format, payment_currency, {_MEASURES} FROM scored GROUP BY 1, 2
ORDER BY event_count DESC, avg_risk_score DESC, payment_format, payment_currency LIMIT 30""")
def _(spark, sf):
    return money(SV.payment_currency_risk(I.state_events(spark, sf)), "total_amount_paid")


@query("e26_risk_type_counts", f"""WITH {Q.SIMPLE} SELECT CASE WHEN transaction_id LIKE '%9' THEN 'UNKNOWN' ELSE risk_type END AS risk_type,
  count(*) AS event_count, count(DISTINCT event_account) AS account_count FROM simple WHERE event_account <> 'A1' GROUP BY 1""")
def _(spark, sf):
    # some events lose their type and one account is blank
    events = I.simple_events(spark, sf).withColumns({
        "risk_type": F.when(~F.col("transaction_id").endswith("9"), F.col("risk_type")),
        "event_account": F.when(F.col("event_account") != "A1", F.col("event_account")).otherwise(""),
    })
    return ST.risk_type_counts(events)


@query("e27_level_and_rule_counts", f"""WITH {Q.SCORED} SELECT concat('risk_level.', risk_level) AS metric, count(*) AS "value" FROM scored GROUP BY 1
UNION ALL SELECT concat('rule_hit.', hit), count(*) FROM (SELECT unnest(string_split(rule_hits, ';')) AS hit FROM scored) WHERE hit <> '' GROUP BY 1""")
def _(spark, sf):
    return ST.level_and_rule_counts(I.state_events(spark, sf))


@query("g05_high_risk_account_topn", f"""WITH {Q.SCORED}, {_ROLLUP} SELECT account_number, total_event_count, counterparty_count,
  laundering_event_count, cross_bank_event_count, cross_currency_event_count, out_amount, risk_score_rule FROM rollup_
WHERE risk_score_rule >= 60 OR laundering_event_count > 0
ORDER BY risk_score_rule DESC, laundering_event_count DESC, out_amount DESC, account_number LIMIT 20""")
def _(spark, sf):
    return as_double(SV.high_risk_account_topn(_ads(spark, sf)), "out_amount")


@query("g06_investigation_search", f"""WITH {Q.SCORED} SELECT run_id, transaction_id, event_account, risk_level, risk_score, payment_currency,
  payment_format, amount_paid FROM scored WHERE risk_level IN ('HIGH', 'CRITICAL') ORDER BY risk_score DESC, transaction_id LIMIT 5""")
def _(spark, sf):
    return SV.investigation_search(I.state_events(spark, sf))


@query("g08_ordered_layer_write", f"""WITH {Q.TX}, {Q.KPI} SELECT payment_format, transaction_count FROM kpi""")
def _(spark, sf):
    root = work_path(spark, "ordered-layer")
    kpi = M.payment_kpi(A.detail(spark, sf))
    path = TB.write_layer(kpi, root, "dws_payment_kpi", I.RUN, csv=True, order=["payment_format"])
    return spark.read.parquet(path).select("payment_format", "transaction_count")


@query("g09_tail_sample", f"WITH {Q.SCORED} SELECT transaction_id FROM scored ORDER BY transaction_id LIMIT 50")
def _(spark, sf):
    return SV.tail_sample(I.state_events(spark, sf), ["transaction_id"]).select("transaction_id")


# --- scoring ----------------------------------------------------------------------------


@query("j01_risk_rules_v0", f"WITH {Q.SIMPLE} SELECT * FROM simple")
def _(spark, sf):
    return I.simple_events(spark, sf)


@query("j02_score_contract", f"""WITH {Q.SCORED} SELECT * EXCLUDE (event_id, state_operation, state_store_version)
  REPLACE ('p11_realtime_scoring_contract_v1' AS contract_version) FROM scored""")
def _(spark, sf):
    return SC.score_contract(I.scoring_input(spark, sf, K.CONTRACT_V1), I.RUN, scored_at=I.stamp())


@query("j03_score_state", f"WITH {Q.SCORED} SELECT * EXCLUDE (event_id) FROM scored")
def _(spark, sf):
    return I.state_events(spark, sf)


@query("j04_candidate_score", f"WITH {Q.SCORED} SELECT transaction_id, raw_score FROM ctx_score")
def _(spark, sf):
    return SC.candidate_score(I.context(spark, sf)).select("transaction_id", "raw_score")


# --- contract and state -----------------------------------------------------------------

# what each deliberate fault must be reported as; faults 5, 6, 8 and 12 never arrive
_ERRORS = """CASE event_id % 20 WHEN 0 THEN 'missing:payment_currency' WHEN 1 THEN 'type:risk_score'
  WHEN 2 THEN 'risk_score_range' WHEN 3 THEN 'risk_level' WHEN 4 THEN 'contract_version'
  WHEN 7 THEN 'type:event_time' WHEN 9 THEN 'type:risk_score' ELSE '' END"""
_ARRIVED = f"""arrived AS (SELECT *, {_ERRORS} AS errors FROM scored WHERE event_id % 20 NOT IN (5, 6, 8, 12))"""


def _raw_messages(spark, sf):
    path = work_path(spark, "messages")
    I.faulty_messages(spark, sf).select("value").write.text(path)
    return L.read_raw_events(spark, path, I.RUN)


def _raw_id():
    return F.get_json_object("value", "$.transaction_id").alias("transaction_id")


@query("j05_contract_errors", f"WITH {Q.SCORED}, {_ARRIVED} SELECT transaction_id, errors FROM arrived")
def _(spark, sf):
    checked = CT.contract_errors(_raw_messages(spark, sf), CT.STATE)
    return checked.select(_raw_id(), F.concat_ws(";", CT.ERRORS).alias("errors"))


@query("j05_valid_events", f"""WITH {Q.SCORED}, {_ARRIVED} SELECT transaction_id, risk_level,
  CASE WHEN event_id % 20 = 11 THEN 5.0 ELSE amount_paid END AS amount_paid FROM arrived WHERE errors = ''""")
def _(spark, sf):
    valid, _invalid = CT.validate_contract(_raw_messages(spark, sf), CT.STATE)
    return valid.select("transaction_id", "risk_level", "amount_paid")


@query("w09_side_output_invalid", f"WITH {Q.SCORED}, {_ARRIVED} SELECT transaction_id, errors FROM arrived WHERE errors <> ''")
def _(spark, sf):
    _valid, invalid = CT.validate_contract(_raw_messages(spark, sf), CT.STATE)
    path = work_path(spark, "invalid")
    KV.put_batch(invalid, path, 0)
    return KV.read_batches(spark, path).select(_raw_id(), F.concat_ws(";", CT.ERRORS).alias("errors"))


@query("j09_stream_summary", f"""WITH {Q.SCORED}, {_ARRIVED} SELECT count(*) AS raw_event_count,
  count(*) FILTER (errors = '') AS schema_valid_event_count, count(*) FILTER (errors <> '') AS schema_invalid_event_count,
  count(DISTINCT event_account) FILTER (errors = '') AS keys_written, 0 AS consistency_fail_count,
  CASE WHEN count(*) FILTER (errors <> '') = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM arrived""")
def _(spark, sf):
    checked = CT.contract_errors(_raw_messages(spark, sf), CT.STATE)
    return ST.stream_summary(checked, F.get_json_object("value", "$.event_account"))


def _message_log(spark, sf, files):
    """The messages with their faults as a log: partitions by account, arrival unlike the order of ids."""
    events = I.faulty_messages(spark, sf)
    i = F.col("event_id")
    # a full cycle of the numbers below a prime, again for every further block of them
    offset = F.pmod(i * 7919, F.lit(1000003)) + F.floor(i / 1000003) * 1000003
    folder = work_path(spark, "messages")
    account = F.regexp_extract("value", '"event_account":"([^"]*)"', 1)
    partition = F.pmod(F.xxhash64(account), F.lit(4)).cast("int")
    SK.write_topic(events.select(partition.alias("partition"), offset.alias("offset"), "value"), folder, files)
    return folder


def _state_job(spark, sf, stretches_per_batch, stretches=6):
    """The state job over the log, started twice: the second run takes over what arrived in between."""
    each = SK.segments(A.table(spark, sf, "events").count(), stretches)
    folder = _message_log(spark, sf, stretches * each)
    root, checkpoint = work_path(spark, "state"), work_path(spark, "ck")

    def mine():
        raw = SJ.raw_stream(spark, "topic", folder, maxFilesPerTrigger=stretches_per_batch * each)
        return raw.filter(L.decodable(F.trim("value")) & (F.get_json_object("value", "$.run_id") == I.RUN))

    queries = SJ.state_job(mine(), CT.STATE, root, checkpoint, SK.POSITION, stamp=I.stamp(), buckets=8)
    for query in queries:
        SK.run_batches(query, 2)  # stopped wherever the third batch is
    for query in SJ.state_job(mine(), CT.STATE, root, checkpoint, SK.POSITION, stamp=I.stamp(), buckets=8):
        query.awaitTermination()
    return root


@query("j09_observed_summary", f"""WITH {Q.SCORED}, {_ARRIVED} SELECT count(*) AS raw_event_count,
  count(*) FILTER (errors = '') AS schema_valid_event_count, count(*) FILTER (errors <> '') AS schema_invalid_event_count,
  count(DISTINCT event_account) FILTER (errors = '') AS keys_written, 0 AS consistency_fail_count,
  CASE WHEN count(*) FILTER (errors <> '') = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM arrived""")
def _(spark, sf):
    root = _state_job(spark, sf, stretches_per_batch=2)
    return ST.observed_summary(KV.read_batches(spark, f"{root}/metrics"), SJ.state_table(root, "durable").read(spark))


_LATEST = """latest AS (SELECT arg_max(scored, transaction_id) AS e FROM scored GROUP BY event_account),
last_ AS (SELECT unnest(e) FROM latest)"""


@query("j07_durable_state_rows", f"""WITH {Q.SCORED}, {_LATEST} SELECT event_account, risk_score, risk_level, state_operation,
  '2024-06-01 00:00:00' AS updated_at, amount_paid, payment_currency, payment_format, risk_reasons, rule_hits, run_id, transaction_id,
  event_time, contract_version, counterparty_account, feature_snapshot_version FROM last_""")
def _(spark, sf):
    latest = ST.latest_state(I.state_events(spark, sf), ["transaction_id"])
    return ST.durable_state_rows(latest, I.stamp()).select("event_account", "s.*", "m.*", "r.*", "meta.*")


@query("w06_wide_row_cells", f"""WITH {Q.SCORED}, {_LATEST} SELECT "column", count(*) AS cell_count,
  count(DISTINCT "value") AS distinct_values FROM (
  SELECT unnest(['s:risk_level', 'meta:transaction_id', 'r:rule_hits']) AS "column", unnest([risk_level, transaction_id, rule_hits]) AS "value" FROM last_)
GROUP BY 1""")
def _(spark, sf):
    latest = ST.latest_state(I.state_events(spark, sf), ["transaction_id"])
    cells = ST.durable_state_cells(ST.durable_state_rows(latest, I.stamp()))
    wanted = cells.filter(F.col("column").isin("s:risk_level", "meta:transaction_id", "r:rule_hits"))
    return wanted.groupBy("column").agg(
        F.count("*").alias("cell_count"), F.count_distinct("value").alias("distinct_values")
    )


# --- sinks --------------------------------------------------------------------------------


@query("w01_write_layer", f"WITH {Q.TX}, {Q.KPI} SELECT payment_format, transaction_count, laundering_count FROM kpi")
def _(spark, sf):
    root = work_path(spark, "layer")
    TB.write_layer(M.payment_kpi(A.detail(spark, sf)), root, "kpi", I.RUN, csv=True)
    return L.read_layer_csv(
        spark, f"{root}/kpi_csv/run_id={I.RUN}",
        "payment_format string, transaction_count long, laundering_count long, laundering_rate double, "
        "total_amount_paid double, avg_amount_paid double, max_amount_paid double",
        ["payment_format", "transaction_count", "laundering_count"],
    )


@query("w02_write_metrics", f"""WITH {Q.TX} SELECT 'rows' AS metric, CAST(count(*) AS VARCHAR) AS "value", '' AS detail FROM tx
UNION ALL SELECT 'positives', CAST(sum(is_laundering) AS VARCHAR), '' FROM tx""")
def _(spark, sf):
    path = work_path(spark, "metrics")
    wide = A.detail(spark, sf).agg(F.count("*").alias("rows"), F.sum("is_laundering").alias("positives"))
    TB.write_metrics(P.metric_rows(wide), path, ["metric", "value", "detail"])
    schema = "metric string, value string, detail string"
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path).fillna("")


@query("w04_publish_tables", f"""WITH {Q.TX}, {Q.KPI} SELECT 'riskweave_kpi' AS table_name, count(*) AS actual_count, 5 AS expected_count,
  CASE WHEN count(*) = 5 THEN 'PASS' ELSE 'FAIL' END AS status FROM kpi
UNION ALL SELECT 'riskweave_large', count(*), -1, 'FAIL' FROM tx WHERE amount_paid >= 1000000""")
def _(spark, sf):
    dwd = A.detail(spark, sf)
    tables = {"riskweave_kpi": M.payment_kpi(dwd), "riskweave_large": dwd.filter("amount_paid >= 1000000")}
    expected = {"riskweave_kpi": 5, "riskweave_large": -1}
    return TB.publish_tables(spark, tables, expected=expected, location=work_path(spark, "published"))


@query("w05_kv_state_sink", f"""WITH {Q.SCORED}, kept AS (
  SELECT arg_max(scored, ((event_id + 3) % 3, transaction_id)) AS e FROM scored GROUP BY event_account), last_ AS (SELECT unnest(e) FROM kept)
SELECT concat('risk:latest:', event_account) AS "key", transaction_id, risk_score FROM last_""")
def _(spark, sf):
    events = I.stored(I.state_events(spark, sf), "state-events")
    kv = KeyedTable(work_path(spark, "kv"), "key", "batch_id", buckets=8)
    # three micro-batches, of which the second is delivered twice
    number = F.substring("transaction_id", 4, 10).cast("long")
    third = F.pmod(number, F.lit(3))
    for batch, part in ((0, third == 1), (1, third == 2), (1, third == 2), (2, third == 0)):
        latest = ST.cache_rows(ST.latest_state(events.filter(part), ["transaction_id"]), "risk:latest")
        kv.merge(latest.withColumn("batch_id", F.lit(batch).cast("long")), token=batch)
    rows = kv.read(spark)
    return rows.select(
        "key", F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
        F.get_json_object("value", "$.risk_score").cast("int").alias("risk_score"),
    )


@query("w07_olap_load", f"WITH {Q.SCORED}, {_ROLLUP} SELECT '202406' AS yyyymm, account_number, total_event_count FROM rollup_")
def _(spark, sf):
    path = work_path(spark, "olap")
    TB.olap_load_accounts(SV.ads_account_rollup(I.state_events(spark, sf), I.stamp().cast("timestamp")), path)
    return spark.read.parquet(path).select(
        F.col("yyyymm").cast("string").alias("yyyymm"), "account_number", "total_event_count"
    )


@query("w07_olap_load_events", f"WITH {Q.SCORED} SELECT transaction_id, risk_score, '2024-06-01 00:00:00' AS ingested_at FROM scored")
def _(spark, sf):
    path = work_path(spark, "olap-events")
    TB.olap_load_events(I.state_events(spark, sf), path, I.stamp())
    return spark.read.parquet(path).select("transaction_id", "risk_score", "ingested_at")


@query("w08_search_upsert", f"""WITH {Q.SCORED} SELECT concat('r1:', transaction_id) AS doc_id,
  CASE WHEN event_id % 2 = 0 THEN 100 ELSE risk_score END AS risk_score,
  event_time AS event_time_raw, concat(replace(event_time, '/', '-')[1:10], 'T', event_time[12:16], ':00Z') AS event_time,
  '2024-06-01T00:00:00Z' AS scored_at FROM scored""")
def _(spark, sf):
    docs = ST.search_documents(I.state_events(spark, sf), I.stamp())
    number = F.substring("transaction_id", 4, 10).cast("long") - 1
    # every second document is indexed again with a new score
    again = docs.filter(number % 2 == 0).withColumn("risk_score", F.lit(100))
    out = ST.upsert(docs, again, "doc_id", "ingested_at")
    return out.select("doc_id", "risk_score", "event_time_raw", "event_time", "scored_at")


@query("w08_search_rerun", f"""WITH {Q.SCORED} SELECT concat('r1:', transaction_id) AS doc_id,
  CASE WHEN event_id % 4 = 0 THEN 100 WHEN event_id % 4 = 2 THEN 7 ELSE risk_score END AS risk_score,
  CASE WHEN event_id % 4 = 0 THEN '2024-06-01T00:00:00.500000Z' WHEN event_id % 4 = 2 THEN '2024-06-03T00:00:00Z' ELSE '2024-06-01T00:00:00Z' END AS scored_at
FROM scored""")
def _(spark, sf):
    events = I.stored(I.state_events(spark, sf), "state-events")
    number = F.substring("transaction_id", 4, 10).cast("long") - 1

    def scored(part, score, at):
        return events.filter(part).withColumns({"risk_score": F.lit(score), "scored_at": F.lit(at)})

    # reruns arrive in any order: the time of scoring decides, not the time of indexing
    index = RT.search_index(work_path(spark, "search"), buckets=8)
    RT.index_documents(scored(number % 4 == 2, 7, "2024-06-03 00:00:00"), index, [], I.stamp())
    RT.index_documents(events, index, [], I.stamp())
    RT.index_documents(scored(number % 4 == 0, 100, "2024-06-01 00:00:00.500000"), index, [], I.stamp())
    RT.index_documents(scored(number % 4 == 2, 8, "2024-05-31 23:59:59"), index, [], I.stamp())
    return index.read(spark).select("doc_id", "risk_score", "scored_at")


@query("w10_upsert", """WITH base AS (SELECT user_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value FROM events WHERE event_type <> 'error' AND user_id % 3 <> 0 GROUP BY 1),
up AS (SELECT user_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT coalesce(up.user_id, base.user_id) AS user_id,
  CASE WHEN base.user_id IS NULL OR up.ts >= base.ts THEN up.value ELSE base.value END AS value
FROM base FULL JOIN up ON base.user_id = up.user_id""")
def _(spark, sf):
    events = A.table(spark, sf, "events").select("user_id", "ts", "value", "event_id", "event_type")
    base = R.latest_per_key(
        events.filter("event_type <> 'error' AND user_id % 3 <> 0"), "user_id", ["ts", "event_id"]
    ).select("user_id", "ts", "value")
    updates = events.filter("event_type = 'error'").select("user_id", "ts", "value")
    return ST.upsert(base, updates, "user_id", "ts").select("user_id", "value")


@query("w10_upsert_buckets", """WITH step AS (SELECT user_id, ts, value, event_id FROM events),
base AS (SELECT user_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value FROM step WHERE user_id % 3 <> 0 GROUP BY 1),
up AS (SELECT user_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value FROM step WHERE user_id % 50 = 0 AND event_id % 2 = 0 GROUP BY 1)
SELECT coalesce(up.user_id, base.user_id) AS user_id, CASE WHEN base.user_id IS NULL OR up.ts >= base.ts THEN up.value + 1 ELSE base.value END AS value
FROM base FULL JOIN up ON base.user_id = up.user_id""")
def _(spark, sf):
    events = staged(A.table(spark, sf, "events").select("user_id", "ts", "value", "event_id"), "events")
    accounts = KeyedTable(work_path(spark, "accounts"), "user_id", "ts", buckets=16)
    accounts.merge(R.latest_per_key(events.filter("user_id % 3 <> 0"), "user_id", ["ts", "event_id"]).drop("event_id"))
    # only the buckets of the few updated accounts are read and written again
    few = R.latest_per_key(events.filter("user_id % 50 = 0 AND event_id % 2 = 0"), "user_id", ["ts", "event_id"])
    accounts.merge(few.drop("event_id").withColumn("value", F.col("value") + 1))
    return accounts.read(spark).select("user_id", "value")


@query("w11_query_results_export", f"""WITH {Q.SCORED}, lv AS (SELECT risk_level, {_MEASURES} FROM scored GROUP BY 1),
pc AS (SELECT payment_format, payment_currency, count(*) AS event_count FROM scored GROUP BY 1, 2)
SELECT 'levels' AS query_name, row_number() OVER (ORDER BY event_count DESC, risk_level) AS "row_number", risk_level AS first_value FROM lv
UNION ALL SELECT 'formats', row_number() OVER (ORDER BY event_count DESC, payment_format, payment_currency), payment_format FROM pc""")
def _(spark, sf):
    events = I.stored(I.state_events(spark, sf), "state-events")
    out = SV.query_results_export({
        "levels": (SV.risk_level_distribution(events), [F.desc("event_count"), F.col("risk_level")]),
        "formats": (
            SV.payment_currency_risk(events),
            [F.desc("event_count"), F.col("payment_format"), F.col("payment_currency")],
        ),
    })
    first = F.coalesce(F.get_json_object("row_json", "$.risk_level"), F.get_json_object("row_json", "$.payment_format"))
    return out.select("query_name", "row_number", first.alias("first_value"))


@query("w12_dashboard_dataset", f"""WITH {Q.SCORED}, {Q.KPI}, {Q.CANDIDATES},
cards AS (SELECT 'kpi_cards' AS section, 1 AS "row_number", concat((SELECT count(*) FROM tx), '|', (SELECT count(*) FROM acct), '|',
  (SELECT sum(is_laundering) FROM tx), '|', (SELECT count(DISTINCT event_account) FROM scored)) AS facts),
pay AS (SELECT 'payment_risk', row_number() OVER (ORDER BY round(laundering_rate, 8) DESC, transaction_count DESC, payment_format), payment_format FROM kpi),
hrs AS (SELECT 'hourly_risk', row_number() OVER (ORDER BY transaction_hour), CAST(transaction_hour AS VARCHAR) FROM (SELECT DISTINCT transaction_hour FROM tx)),
acc AS (SELECT 'top_accounts', row_number() OVER (ORDER BY risk_score_rule DESC, laundering_event_count DESC, round(out_amount) DESC, account_number) AS rn, account_number FROM acct QUALIFY rn <= 10),
big AS (SELECT 'top_transactions', row_number() OVER (ORDER BY amount_paid DESC, transaction_id) AS rn, transaction_id FROM cand QUALIFY rn <= 10)
SELECT * FROM cards UNION ALL SELECT * FROM pay UNION ALL SELECT * FROM hrs UNION ALL SELECT * FROM acc UNION ALL SELECT * FROM big""")
def _(spark, sf):
    dwd = I.stored(A.detail(spark, sf), "detail")
    threshold = R.exact_quantile(dwd, "amount_paid")
    features = I.stored(M.account_features(dwd, threshold), "accounts")
    out = SV.dashboard_dataset(
        dwd, features, M.payment_kpi(dwd), M.large_candidates(dwd, threshold), I.state_events(spark, sf)
    )

    def at(name):
        return F.get_json_object("row_json", f"$.{name}")

    cards = F.concat_ws("|", at("total_transactions"), at("total_accounts"), at("laundering_count"), at("realtime_keys"))
    facts = F.when(F.col("section") == "kpi_cards", cards).otherwise(
        F.coalesce(at("transaction_id"), at("account_number"), at("payment_format"), at("transaction_hour"))
    )
    return out.select("section", "row_number", facts.alias("facts"))


# --- streaming ------------------------------------------------------------------------------


@query("a07_stream_source", f"""WITH {Q.TX} SELECT transaction_id, CASE WHEN event_id % 10 = 3 THEN NULL ELSE amount_paid END AS amount_paid
FROM tx WHERE event_id % 10 <> 4""")
def _(spark, sf):
    # one message in ten has a bad amount, one in ten is not JSON at all
    folder, out = work_path(spark, "topic"), work_path(spark, "drained")
    replay = D.to_replay(A.detail(spark, sf), I.RUN)
    number = F.substring("transaction_id", 4, 10).cast("long") - 1
    text = F.to_json(F.struct(*replay.columns))
    bad = F.regexp_replace(text, '"amount_paid":[0-9.E]+', '"amount_paid":"many"')
    value = F.when(number % 10 == 3, bad).when(number % 10 == 4, "{broken").otherwise(text)
    replay.select(value.alias("value")).write.text(folder)
    stream = SJ.stream_source(spark, "files", folder, S.REPLAY_EVENT)
    SJ.event_sink(stream, "files", out, work_path(spark, "ck")).awaitTermination()
    return spark.read.schema(S.REPLAY_EVENT).json(out).select("transaction_id", "amount_paid")


@query("j08_event_sink", f"WITH {Q.SIMPLE} SELECT * FROM simple")
def _(spark, sf):
    folder, out = work_path(spark, "topic"), work_path(spark, "risk")
    SJ.write_replay(D.to_replay(A.detail(spark, sf), I.RUN), folder)
    scored = SC.risk_rules_v0(SJ.stream_source(spark, "files", folder, S.REPLAY_EVENT), I.RUN)
    schema = scored.schema
    SJ.event_sink(scored, "files", out, work_path(spark, "ck")).awaitTermination()
    return spark.read.schema(schema).json(out)


@query("j10_replay", f"""WITH {Q.TX} SELECT 'r2' AS run_id, count(*) AS messages, count(DISTINCT transaction_id) AS transactions FROM tx""")
def _(spark, sf):
    folder = work_path(spark, "replay")
    SJ.write_replay(D.to_replay(A.detail(spark, sf), "r2"), folder)
    events = L.read_jsonl_events(spark, folder, S.REPLAY_EVENT, "r2")
    return events.groupBy("run_id").agg(
        F.count("*").alias("messages"), F.count_distinct("transaction_id").alias("transactions")
    )


@query("j10_resumed_replay", f"""WITH {Q.TX} SELECT transaction_id, amount_paid, payment_format FROM tx""")
def _(spark, sf):
    # a log in eight stretches, two a micro-batch: the first query is stopped behind two batches, the second goes on
    folder, out, checkpoint = work_path(spark, "log"), work_path(spark, "drained"), work_path(spark, "ck")
    replay = D.to_replay(A.detail(spark, sf), I.RUN)
    number = F.substring("transaction_id", 4, 10).cast("long")
    each = SK.segments(A.table(spark, sf, "events").count(), 8)
    SK.write_topic(SK.messages_of(replay, "from_account", number), folder, files=8 * each)

    def drained():
        events = SJ.stream_source(spark, "topic", folder, S.REPLAY_EVENT, maxFilesPerTrigger=2 * each).drop(*SK.POSITION)
        return SJ.event_sink(events, "files", out, checkpoint)

    SK.run_batches(drained(), 2)
    drained().awaitTermination()
    return spark.read.schema(S.REPLAY_EVENT).json(out).select("transaction_id", "amount_paid", "payment_format")


@query("j06_latest_state_sink", f"""WITH {Q.SCORED}, {_ARRIVED}, ok AS (
  SELECT *, (event_id * 7919) % 1000003 + (event_id // 1000003) * 1000003 AS arrival FROM arrived WHERE errors = '')
SELECT event_account, arg_max(transaction_id, arrival) AS transaction_id, arg_max(risk_level, arrival) AS risk_level,
  count(*) AS valid_events FROM ok GROUP BY 1""")
def _(spark, sf):
    root = _state_job(spark, sf, stretches_per_batch=1)
    durable = SJ.state_table(root, "durable").read(spark)
    valid = KV.read_batches(spark, f"{root}/events").groupBy("event_account").agg(
        F.count("*").alias("valid_events")
    )
    return durable.select("event_account", "meta.transaction_id", "s.risk_level").join(valid, "event_account")


@query("j06_state_in_cache", f"""WITH {Q.SCORED}, {_ARRIVED}, ok AS (
  SELECT *, (event_id * 7919) % 1000003 + (event_id // 1000003) * 1000003 AS arrival FROM arrived WHERE errors = '')
SELECT "key", e.t AS transaction_id, e.s AS risk_score FROM (
  SELECT concat('risk:latest:', event_account) AS "key",
    arg_max({{'t': transaction_id, 's': CASE WHEN event_id % 20 <> 10 THEN risk_score END}}, arrival) AS e FROM ok GROUP BY 1)""")
def _(spark, sf):
    root = _state_job(spark, sf, stretches_per_batch=3)
    cached = SJ.state_table(root, "cache").read(spark)
    return cached.select(
        "key", F.get_json_object("value", "$.transaction_id").alias("transaction_id"),
        F.get_json_object("value", "$.risk_score").cast("int").alias("risk_score"),
    )


@query("j11_streaming_minute_kpi", f"WITH {Q.TX} {_MINUTE.format(t='tx')}")
def _(spark, sf):
    folder, out, checkpoint = work_path(spark, "events"), work_path(spark, "minutes"), work_path(spark, "ck")
    events = staged(A.detail(spark, sf, extra=("ts",)).withColumnRenamed("ts", "event_ts"), "timed")
    first, last = events.agg(F.min("event_ts"), F.max("event_ts")).first()
    cuts = [first, first + (last - first) / 3, first + (last - first) * 2 / 3, None]

    def drain():
        stream = spark.readStream.schema(events.schema).parquet(folder)
        query = SJ.streaming_minute_kpi(stream).writeStream.format("parquet").option("path", out).outputMode("append")
        query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    # three arrivals in the order of time, each by a query that goes on from the checkpoint
    for low, high in zip(cuts, cuts[1:]):
        part = events.filter(F.col("event_ts") >= low)
        (part if high is None else part.filter(F.col("event_ts") < high)).write.mode("append").parquet(folder)
        drain()
    SJ.heartbeat(events, "event_ts", F.lit(last) + F.expr("INTERVAL 12 MINUTES")).write.mode("append").parquet(folder)
    drain()
    return money(money(spark.read.parquet(out), "total_amount_paid"), "laundering_rate", digits=8)
