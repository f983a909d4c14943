"""Registered queries: sources and cleansing."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave import constants as K, schemas as S
from riskweave.functions import columns as C
from riskweave.operators import detail as D, marts as M, profiling as P
from riskweave.plans import inputs as I, reference_sql as Q, warehouse as W
from riskweave.plans.catalog import query
from riskweave.session import work_path
from riskweave.sources import adapters as A, layers as L, raw_files as R
from riskweave.sinks.tables import write_layer

_RAW_TEXT = """
  SELECT trim("timestamp") AS "timestamp", from_bank, from_account, to_bank, to_account, amount_received,
    receiving_currency, trim(amount_paid) AS amount_paid, payment_currency, payment_format, is_laundering
"""


@query("a01_read_transactions_csv", f"WITH {Q.RAW} {_RAW_TEXT} FROM raw WHERE event_id % 101 <> 0 AND event_id % 103 <> 0")
def _(spark, sf):
    good, _bad = R.split_malformed(R.read_transactions_csv(spark, I.transaction_file(spark, sf)))
    return good.select(*S.ODS_COLUMNS)


@query("a02_read_accounts_csv", f"""WITH {Q.ACCOUNTS}
SELECT * FROM accounts WHERE CAST(substr(account_number, 2) AS BIGINT) % 50 <> 0""")
def _(spark, sf):
    good, _bad = R.split_malformed(R.read_accounts_csv(spark, I.account_file(spark, sf)))
    return good.select(*S.ACCOUNT_COLUMNS)


@query("a03_split_malformed", f"""WITH {Q.RAW}
SELECT CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN 'malformed' ELSE 'well_formed' END AS kind,
       count(*) AS row_count FROM raw GROUP BY 1""")
def _(spark, sf):
    good, bad = R.split_malformed(R.read_transactions_csv(spark, I.transaction_file(spark, sf)))
    return P.table_counts({"well_formed": good, "malformed": bad}).select(
        F.col("table_name").alias("kind"), F.col("actual_count").alias("row_count")
    )


@query("a04_read_patterns", f"""WITH {Q.RAW}, marks AS (
  SELECT event_id, 1 AS part, concat(' BEGIN LAUNDERING ATTEMPT - ', upper(payment_format), ':  Max ', event_id % 7, ' hops') AS line,
         'begin' AS kind, upper(payment_format) AS pattern_type, NULL AS label FROM raw WHERE event_id % 10 = 0
  UNION ALL
  SELECT event_id, 2, NULL, CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN 'other' ELSE 'transaction' END, NULL,
         CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 THEN NULL ELSE is_laundering END FROM raw
  UNION ALL
  SELECT event_id, 3, NULL, 'end', NULL, NULL FROM raw WHERE event_id % 10 = 9)
SELECT event_id, part, kind, pattern_type, label FROM marks""")
def _(spark, sf):
    lines = A.raw_transaction_lines(spark, sf).join(
        A.detail(spark, sf, extra=("event_id",)).select("event_id", "payment_format"), "event_id"
    )
    i = F.col("event_id")
    begin = F.concat(
        F.lit(" BEGIN LAUNDERING ATTEMPT - "), F.upper("payment_format"), F.lit(":  Max "),
        (i % 7).cast("string"), F.lit(" hops"),
    )
    def part(at, text):
        return F.struct(F.lit(at).alias("part"), text.alias("value"))

    parts = F.array_compact(F.array(
        F.when(i % 10 == 0, part(1, begin)),
        part(2, F.col("value")),
        F.when(i % 10 == 9, part(3, F.lit("END LAUNDERING ATTEMPT - X"))),
        part(4, F.lit("   ")),
    ))
    blocks = lines.select("event_id", F.inline(parts))
    return R.type_pattern_lines(blocks).select("event_id", "part", "kind", "pattern_type", "label")


@query("a04_pattern_lines_of_documents", """
WITH lines AS (SELECT trim(unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')), E' \\t\\r\\n\\f\\v') AS line FROM documents),
kinds AS (SELECT CASE WHEN starts_with(line, 'BEGIN LAUNDERING ATTEMPT') THEN 'begin'
    WHEN starts_with(line, 'END LAUNDERING ATTEMPT') THEN 'end'
    WHEN len(string_split(line, ',')) = 11 AND trim(string_split(line, ',')[11]) IN ('0', '1') THEN 'transaction'
    ELSE 'other' END AS kind FROM lines WHERE line <> '')
SELECT kind, count(*) AS line_count FROM kinds GROUP BY 1""")
def _(spark, sf):
    from riskweave.operators.quality import text_lines

    lines = text_lines(A.table(spark, sf, "documents"), "text").toDF("value")
    return R.type_pattern_lines(lines).groupBy("kind").agg(F.count("*").alias("line_count"))


@query("a05_read_dwd", f"""WITH {Q.TX}
SELECT transaction_id, transaction_hour, amount_paid FROM tx WHERE amount_paid >= 1000000""")
def _(spark, sf):
    path = work_path(spark, "dwd")
    A.detail(spark, sf).write.parquet(path)
    pruned = L.read_dwd(spark, path, ["transaction_id", "transaction_hour", "amount_paid"])
    return pruned.filter(F.col("amount_paid") >= K.LARGE_AMOUNT)


@query("a06_read_jsonl_events", f"""WITH {Q.SCORED}
SELECT event_id, transaction_id FROM (SELECT event_id, transaction_id, event_id % 20 AS f FROM scored) t
WHERE f NOT IN (5, 6, 8, 12)""")
def _(spark, sf):
    path = work_path(spark, "jsonl")
    I.faulty_messages(spark, sf).select("value").write.text(path)
    events = L.read_jsonl_events(spark, path, S.STATE_EVENT, I.RUN)
    number = F.substring("transaction_id", 4, 10).cast("long") - 1
    return events.select(number.alias("event_id"), "transaction_id")


@query("a08_scan_table", f"""WITH {Q.TX}
SELECT payment_currency, count(*) AS by_view, count(*) AS by_path, count(*) AS by_table FROM tx GROUP BY 1""")
def _(spark, sf):
    path = write_layer(
        A.detail(spark, sf).select("payment_currency"), work_path(spark, "scan"), "dwd", "r1"
    )
    view = L.register_view(spark, "riskweave_detail", path)
    counts = [
        df.groupBy("payment_currency").agg(F.count("*").alias(name))
        for name, df in (
            ("by_view", view),
            ("by_path", L.scan_table(spark, f"parquet.`{path}`")),
            ("by_table", L.scan_table(spark, "riskweave_detail")),
        )
    ]
    return counts[0].join(counts[1], "payment_currency").join(counts[2], "payment_currency")


_RUNS = """runs AS (SELECT tx.*, concat('p3_', replace(transaction_date, '-', '')) AS run_id FROM tx)"""


@query("a09_latest_run", f"""WITH {Q.TX}, {_RUNS}
SELECT run_id, transaction_id, amount_paid FROM runs WHERE run_id = (SELECT max(run_id) FROM runs)""")
def _(spark, sf):
    run = F.concat(F.lit("p3_"), F.replace("transaction_date", F.lit("-"), F.lit("")))
    runs = A.detail(spark, sf).withColumn("run_id", run)
    return L.latest_run(runs, "p3_").select("run_id", "transaction_id", "amount_paid")


@query("a09_latest_clean_run", f"""WITH {Q.TX}, {_RUNS},
sums AS (SELECT run_id, count(*) AS rows_in_run, count(*) FILTER (amount_paid >= 10000000) AS invalid FROM runs GROUP BY 1)
SELECT * FROM sums WHERE run_id = (SELECT max(run_id) FROM sums WHERE invalid = 0)""")
def _(spark, sf):
    run = F.concat(F.lit("p3_"), F.replace("transaction_date", F.lit("-"), F.lit("")))
    runs = A.detail(spark, sf).groupBy(run.alias("run_id")).agg(
        F.count("*").alias("rows_in_run"), F.count_if(F.col("amount_paid") >= K.HUGE_AMOUNT).alias("invalid")
    )
    return L.latest_run(runs, "p3_", F.col("invalid") == 0)


_FILES = """files AS (SELECT event_type AS file, CAST(sum(length(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS bytes FROM events GROUP BY 1)"""


def _sized_files(spark, sf):
    """One text file per event type with a line per event, so that every size is known."""
    path = work_path(spark, "sized")
    events = A.table(spark, sf, "events").select("event_type", F.col("event_id").cast("string").alias("value"))
    events.repartition("event_type").write.option("lineSep", "\n").partitionBy("event_type").text(path)
    return path


@query("a10_source_inventory", f"WITH {_FILES} SELECT file, bytes, printf('%.2f', bytes / 1024 / 1024) AS mb FROM files")
def _(spark, sf):
    found = R.file_list(spark, _sized_files(spark, sf), "*.txt")
    return found.select(F.regexp_extract("path", "event_type=([^/]*)/", 1).alias("file"), "bytes", "mb")


@query("q14_forbidden_file_scan", f"""WITH {_FILES} SELECT count(*) AS file_count, count(*) FILTER (bytes > 0.009 * 1024 * 1024) AS bad_file_count,
  CASE WHEN count(*) FILTER (bytes > 0.009 * 1024 * 1024) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM files""")
def _(spark, sf):
    return R.forbidden_files(R.source_inventory(spark, _sized_files(spark, sf), "*.txt"), max_mb=0.009)


@query("a10_check_header", """SELECT event_type AS file,
  CASE WHEN event_type = 'click' THEN 'fail' ELSE 'pass' END AS status FROM events GROUP BY 1""")
def _(spark, sf):
    # one file per event type; the files of one type begin with another header
    events = A.table(spark, sf, "events").select("event_type", "event_id")
    path = work_path(spark, "headers")
    header = F.when(F.col("event_type") == "click", F.lit("a,b")).otherwise(F.lit(",".join(K.ACCOUNT_HEADER)))
    first = events.select("event_type", header.alias("line")).distinct().withColumn("at", F.lit(-1).cast("long"))
    lines = first.unionByName(events.select("event_type", F.col("event_id").cast("string").alias("line"), F.col("event_id").alias("at")))
    lines.repartition("event_type").sortWithinPartitions("event_type", "at").select("event_type", F.col("line").alias("value")) \
        .write.partitionBy("event_type").text(path)
    found = R.check_header(spark, path, K.ACCOUNT_HEADER)
    return found.select(F.regexp_extract("path", "event_type=([^/]*)/", 1).alias("file"), "status")


# --- cleansing ----------------------------------------------------------------------


@query("b01_parse_amount", f"WITH {Q.TYPED} SELECT event_id, amount_paid, amount_received FROM typed")
def _(spark, sf):
    raw = A.raw_transactions(spark, sf)
    return raw.select(
        "event_id", C.parse_amount("amount_paid").alias("amount_paid"),
        C.parse_amount("amount_received").alias("amount_received"),
    )


@query("b02_parse_ts", f"""WITH {Q.TYPED} SELECT event_id, transaction_date, transaction_hour, transaction_minute,
  CASE WHEN event_id % 97 = 0 THEN 'fail' ELSE 'pass' END AS timestamp_parse_status FROM typed""")
def _(spark, sf):
    parts = C.parse_ts("timestamp")
    parts.pop("event_ts")
    return A.raw_transactions(spark, sf).select(
        "event_id", *[col.alias(name) for name, col in parts.items()]
    )


@query("b03_ods_typed", f"""WITH {Q.TYPED} SELECT "timestamp", from_bank, from_account, to_bank, to_account,
  amount_received, receiving_currency, amount_paid, payment_currency, payment_format, is_laundering FROM typed""")
def _(spark, sf):
    raw = A.raw_transactions(spark, sf).withColumn("timestamp", C.strip("timestamp"))
    return D.ods_typed(raw)


@query("b04_assign_transaction_id", f"WITH {Q.TYPED} SELECT transaction_id, event_id FROM numbered")
def _(spark, sf):
    # by a total order; the file-order form is exercised in b06
    i = F.col("event_id")
    raw = A.raw_transactions(spark, sf).filter((i % 101 != 0) & (i % 103 != 0)).select("event_id")
    return D.assign_transaction_id(raw, ["event_id"])


@query("b05_cross_flags", f"WITH {Q.TX} SELECT transaction_id, is_cross_bank, is_cross_currency FROM tx")
def _(spark, sf):
    return A.detail(spark, sf).select(
        "transaction_id", C.differs("from_bank", "to_bank").alias("is_cross_bank"),
        C.differs("receiving_currency", "payment_currency").alias("is_cross_currency"),
    )


@query("b06_build_dwd_transactions", f"""WITH {Q.TYPED}
SELECT * EXCLUDE (event_id) FROM numbered WHERE amount_paid IS NOT NULL AND amount_received IS NOT NULL""")
def _(spark, sf):
    return D.build_dwd_transactions(I.numbered(spark, sf))


@query("b07_build_dwd_accounts", f"WITH {Q.ACCOUNTS} SELECT * FROM accounts")
def _(spark, sf):
    padded = A.accounts(spark, sf).withColumn("entity_name", F.concat(F.lit("\t "), "entity_name"))
    return D.build_dwd_accounts(padded)


@query("b08_to_events", f"WITH {Q.EVENTS} SELECT * FROM sides")
def _(spark, sf):
    return D.to_events(A.detail(spark, sf))


@query("b09_truthy_int", """
WITH t AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN '1' WHEN 1 THEN 'true' WHEN 2 THEN ' True ' WHEN 3 THEN 'TRUE'
  WHEN 4 THEN '0' WHEN 5 THEN '' WHEN 6 THEN NULL ELSE '1.0' END AS flag FROM events)
SELECT event_id, CASE WHEN trim(flag) IN ('1', 'true', 'True') THEN 1 ELSE 0 END AS truthy FROM t""")
def _(spark, sf):
    texts = F.array(*[F.lit(x) for x in ("1", "true", " True ", "TRUE", "0", "", None, "1.0")])
    flag = F.element_at(texts, (F.col("event_id") % 8 + 1).cast("int"))
    return A.table(spark, sf, "events").select("event_id", C.truthy_int(flag).alias("truthy"))


@query("b10_numeric_features", f"""WITH {Q.TX} SELECT transaction_id, round(ln(1 + amount_paid), 8) AS log_amount_paid,
  round(sin(2 * pi() * transaction_hour / 24), 8) + 0.0 AS hour_sin,
  round(cos(2 * pi() * transaction_hour / 24), 8) + 0.0 AS hour_cos FROM tx""")
def _(spark, sf):
    angle = C.hour_angle("transaction_hour")
    return A.detail(spark, sf).select(
        "transaction_id", F.round(C.log_amount("amount_paid"), 8).alias("log_amount_paid"),
        F.round(F.sin(angle), 8).alias("hour_sin"), F.round(F.cos(angle), 8).alias("hour_cos"),
    )


@query("b11_ratio_features", f"""WITH {Q.ACCT} SELECT account_number,
  round(out_amount / (abs(in_amount) + 1.0), 6) AS out_in_ratio,
  round(debit_count / (abs(credit_count) + 1.0), 6) AS debit_credit_ratio FROM acct""")
def _(spark, sf):
    return M.account_base(A.detail(spark, sf)).select(
        "account_number", F.round(C.damped_ratio("out_amount", "in_amount"), 6).alias("out_in_ratio"),
        F.round(C.damped_ratio("debit_count", "credit_count"), 6).alias("debit_credit_ratio"),
    )


@query("b12_fill_defaults", """
SELECT c_custkey, coalesce(user_events, 0) AS from_total_event_count, coalesce(top, 0.0) AS from_max_out_amount
FROM customer LEFT JOIN (SELECT user_id, count(*) AS user_events, max(value) AS top FROM events GROUP BY 1) e
  ON c_custkey = user_id""")
def _(spark, sf):
    from riskweave.operators.joins import FEATURE_DEFAULTS

    stats = A.table(spark, sf, "events").groupBy("user_id").agg(
        F.count("*").alias("from_total_event_count"), F.max("value").alias("from_max_out_amount")
    )
    customers = A.table(spark, sf, "customer").select("c_custkey")
    joined = customers.join(stats, customers.c_custkey == stats.user_id, "left").drop("user_id")
    known = {k: v for k, v in FEATURE_DEFAULTS.items() if k in joined.columns}
    return joined.fillna(known)


_BAND = """CASE WHEN a < 0 THEN NULL WHEN a < 100 THEN '0-100' WHEN a < 1000 THEN '100-1k' WHEN a < 10000 THEN '1k-10k'
  WHEN a < 100000 THEN '10k-100k' WHEN a < 1000000 THEN '100k-1m' WHEN a < 10000000 THEN '1m-10m' ELSE '10m+' END"""


@query("b13_amount_bin", f"""WITH t AS (
  SELECT concat('o', o_orderkey) AS id, o_totalprice AS a FROM orders
  UNION ALL SELECT concat('c', c_custkey), c_acctbal FROM customer
  UNION ALL SELECT concat('e', event_id), round(value * 25000, 2) FROM events)
SELECT id, {_BAND} AS amount_bin FROM t""")
def _(spark, sf):
    parts = [
        A.table(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("id"), F.col("o_totalprice").alias("a")),
        A.table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey"), "c_acctbal"),
        A.table(spark, sf, "events").select(F.concat(F.lit("e"), "event_id"), F.round(F.col("value") * 25000, 2)),
    ]
    return parts[0].union(parts[1]).union(parts[2]).select("id", C.amount_bin("a").alias("amount_bin"))


@query("b14_risk_bucket", f"SELECT event_id, {Q.LEVEL.format('value / 5')} AS risk_bucket FROM events")
def _(spark, sf):
    return A.table(spark, sf, "events").select(
        "event_id", C.risk_bucket(F.col("value") / 5).alias("risk_bucket")
    )


@query("b15_rate", """SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'error') > 0
  THEN round(count(*) FILTER (event_type = 'error' AND value > 100) / count(*) FILTER (event_type = 'error'), 8)
  ELSE 0.0 END AS error_rate FROM events GROUP BY 1""")
def _(spark, sf):
    error = F.col("event_type") == "error"
    return A.table(spark, sf, "events").groupBy("user_id").agg(
        C.rate(F.count_if(error & (F.col("value") > 100)), F.count_if(error), 8).alias("error_rate")
    )


@query("b16_normalize_time", """
WITH t AS (SELECT event_id, ts, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y/%m/%d %H:%M')
    WHEN 1 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    WHEN 3 THEN strftime(ts, ' %Y-%m-%d %H:%M:%S') ELSE 'soon' END AS text FROM events)
SELECT event_id, text AS time_raw, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:00Z')
    WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 2 THEN CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                     ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END
    WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE 'soon' END AS time_iso FROM t""")
def _(spark, sf):
    forms = ["yyyy/MM/dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS", " yyyy-MM-dd HH:mm:ss"]
    pick = F.col("event_id") % 5
    text = F.lit("soon")
    for i, form in enumerate(forms):
        text = F.when(pick == i, F.date_format("ts", form)).otherwise(text)
    return A.table(spark, sf, "events").select("event_id", text.alias("time_raw")).select(
        "event_id", "time_raw", C.normalize_time("time_raw").alias("time_iso")
    )


# CRC-32 of ASCII text, bit by bit
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, len(a) + 1), lambda i: CAST(ord(substr(a, i, 1)) AS BIGINT))),
  lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query("b17_salted_row_key", f"""WITH {Q.TX}, t AS (SELECT from_account AS a FROM tx UNION SELECT to_account FROM tx)
SELECT a AS account_number, concat(printf('%08x', {_CRC}), '#', a) AS row_key FROM t""")
def _(spark, sf):
    return M.account_base(A.detail(spark, sf)).select(
        "account_number", C.salted_row_key("account_number").alias("row_key")
    )


@query("b18_doc_id", f"WITH {Q.TX} SELECT transaction_id, concat('r1', ':', transaction_id) AS doc_id FROM tx")
def _(spark, sf):
    return A.detail(spark, sf).select(
        "transaction_id", C.doc_id(F.lit(I.RUN), "transaction_id").alias("doc_id")
    )


@query("b19_to_replay", f"""WITH {Q.TX} SELECT 'r1' AS run_id, transaction_id, "timestamp" AS tx_timestamp,
  transaction_minute, from_bank, from_account, to_bank, to_account, amount_paid, payment_currency, payment_format,
  is_laundering, is_cross_bank, is_cross_currency FROM tx""")
def _(spark, sf):
    return D.to_replay(A.detail(spark, sf), I.RUN)


@query("b20_to_contract", f"""WITH {Q.CONTEXT} SELECT 'r1' AS run_id,
  'p11v2_realtime_state_contract_v1' AS contract_version, transaction_id, "timestamp" AS tx_timestamp,
  transaction_date, transaction_hour, from_account, to_account, amount_paid, round(log_amount_paid, 8) AS log_amount_paid,
  payment_currency, payment_format, is_cross_bank, is_cross_currency, round(hour_sin, 8) + 0.0 AS hour_sin,
  round(hour_cos, 8) + 0.0 AS hour_cos, from_total_event_count, from_debit_count, from_credit_count,
  round(from_out_amount, 2) AS from_out_amount, round(from_in_amount, 2) AS from_in_amount, from_max_out_amount,
  from_counterparty_count, from_cross_bank_event_count, from_cross_currency_event_count,
  round(from_out_in_ratio, 6) AS from_out_in_ratio, round(from_debit_credit_ratio, 6) AS from_debit_credit_ratio,
  is_laundering AS observed_is_laundering, '' AS split, 'p9_p10_non_leakage_v1' AS feature_snapshot_version
FROM ctx""")
def _(spark, sf):
    return rounded_features(I.scoring_input(spark, sf))


def rounded_features(df):
    """Floating features at a fixed number of digits, for comparison."""
    digits = {
        "log_amount_paid": 8, "hour_sin": 8, "hour_cos": 8, "from_out_amount": 2,
        "from_in_amount": 2, "from_out_in_ratio": 6, "from_debit_credit_ratio": 6,
    }
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


_NAMES = ["payment_format_", "payment_currency_", "amount_paid", "log_amount_paid", "transaction_hour", "hour_sin",
          "is_cross_bank", "from_cross_currency_event_count", "from_out_in_ratio", "from_debit_count", "to_", "x_cross_bank"]
_GROUPS = ["payment_format", "payment_currency", "amount", "amount", "time", "time", "cross_institution_currency",
           "cross_institution_currency", "account_ratio", "account_behavior", "other", "cross_institution_currency"]


@query("b21_feature_group", f"""
WITH t AS (SELECT DISTINCT event_id % 12 AS i, event_type FROM events)
SELECT concat(list_extract({_NAMES}, CAST(i + 1 AS INTEGER)), CASE WHEN i IN (0, 1, 10) THEN event_type ELSE '' END) AS feature,
       list_extract({_GROUPS}, CAST(i + 1 AS INTEGER)) AS feature_group FROM t GROUP BY ALL""")
def _(spark, sf):
    at = (F.col("event_id") % 12).cast("int")
    stem = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), at + 1)
    name = F.concat(stem, F.when(at.isin(0, 1, 10), F.col("event_type")).otherwise(""))
    names = A.table(spark, sf, "events").select(name.alias("feature")).distinct()
    return names.select("feature", C.feature_group("feature").alias("feature_group"))


@query("b22_tsv_cell", """SELECT doc_id, md5(translate(replace(text, chr(13) || chr(10), ' '),
  chr(9) || chr(13) || chr(10), '   ')) AS cell_md5 FROM documents""")
def _(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", F.md5(C.tsv_cell("text")).alias("cell_md5"))


@query("e07_dwd_quality_summary", f"""WITH {Q.TYPED}, {Q.ACCOUNTS}
SELECT count(*) FILTER (ok) AS transaction_row_count, 2 * count(*) FILTER (ok) AS event_row_count,
  count(*) FILTER (NOT ok) AS invalid_amount_count,
  count(*) FILTER (ok AND transaction_minute = '') AS invalid_timestamp_count,
  count(*) FILTER (ok AND is_laundering = 1) AS label_1_count, count(*) FILTER (ok AND is_laundering = 0) AS label_0_count,
  count(*) FILTER (ok AND is_cross_bank = 1) AS cross_bank_count,
  count(*) FILTER (ok AND is_cross_currency = 1) AS cross_currency_count,
  round(1 - count(*) FILTER (ok AND from_account NOT IN (SELECT account_number FROM accounts)) / count(*) FILTER (ok), 8) AS from_account_match_rate,
  round(1 - count(*) FILTER (ok AND to_account NOT IN (SELECT account_number FROM accounts)) / count(*) FILTER (ok), 8) AS to_account_match_rate,
  count(*) FILTER (ok AND from_account NOT IN (SELECT account_number FROM accounts)) AS from_account_missing_count,
  count(*) FILTER (ok AND to_account NOT IN (SELECT account_number FROM accounts)) AS to_account_missing_count,
  (SELECT count(*) FROM raw WHERE event_id % 101 = 0 OR event_id % 103 = 0) AS malformed_count,
  (SELECT string_agg(concat(payment_format, '=', n), ';' ORDER BY payment_format) FROM (
    SELECT payment_format, count(*) AS n FROM numbered WHERE amount_paid IS NOT NULL AND amount_received IS NOT NULL GROUP BY 1)
  ) AS payment_format_counts
FROM (SELECT *, amount_paid IS NOT NULL AND amount_received IS NOT NULL AS ok FROM numbered)""")
def _(spark, sf):
    _good, bad = R.split_malformed(R.read_transactions_csv(spark, I.transaction_file(spark, sf)))
    out = W.quality_of_detail(I.numbered(spark, sf), A.accounts(spark, sf), bad)
    formats = F.transform("payment_format_counts", lambda x: F.concat(x["payment_format"], F.lit("="), x["count"].cast("string")))
    return out.withColumns({
        **{c: F.round(c, 8) for c in ("from_account_match_rate", "to_account_match_rate")},
        "payment_format_counts": F.array_join(formats, ";"),
    })
