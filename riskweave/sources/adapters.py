"""The driver's tables seen as raw, detail and account tables.

``detail`` maps ``events`` to detail transactions (one row per event, unique ids,
minutes); ``raw_transactions`` renders the same rows as text with deliberate faults;
``bulk_detail`` maps the order tables to a larger fact table without ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DETAIL = """
  concat('TX_', lpad(event_id + 1, 10, '0')) AS transaction_id
  date_format(ts, 'yyyy/MM/dd HH:mm') AS timestamp
  date_format(ts, 'yyyy-MM-dd') AS transaction_date
  hour(ts) AS transaction_hour
  date_format(ts, 'yyyy-MM-dd HH:mm') AS transaction_minute
  CAST(user_id % 10 AS STRING) AS from_bank
  concat('A', user_id) AS from_account
  CAST(peer % 10 AS STRING) AS to_bank
  concat('A', peer) AS to_account
  round(value * 25000 * (1 - 0.01D * (k % 3)), 2) AS amount_received
  concat('C', (k % 5 + IF(k % 3 = 0, 1, 0)) % 5) AS receiving_currency
  round(value * 25000, 2) AS amount_paid
  concat('C', k % 5) AS payment_currency
  event_type AS payment_format
  CAST(event_type = 'error' AND k % 10 = 0 AS INT) AS is_laundering
  CAST(user_id % 10 <> peer % 10 AS INT) AS is_cross_bank
  CAST(k % 3 = 0 AS INT) AS is_cross_currency
"""


def detail(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Detail transactions from ``events``; ``extra`` passes source columns through."""
    events = table(spark, sf_dir, "events")
    accounts = events.agg(F.max("user_id") + 1).scalar()
    peer = (F.col("user_id") * 7 + F.col("event_id")) % accounts
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    lines = [line.strip() for line in _DETAIL.strip().splitlines()]
    return events.withColumns({"peer": peer, "k": k}).selectExpr(*extra, *lines)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail rows as raw text with faults by row number.

    Every 97th time is garbage, every 89th lacks zero padding; every 53rd paid amount is
    garbage and every 59th empty; others carry thousands commas and blanks.
    """
    e = detail(spark, sf_dir, extra=("event_id", "ts")).drop("timestamp")
    i = F.col("event_id")
    stamp = (
        F.when(i % 97 == 0, "bad-time")
        .when(i % 89 == 1, F.date_format("ts", "yyyy/M/d H:m"))
        .otherwise(F.concat(F.lit(" "), F.date_format("ts", "yyyy/MM/dd HH:mm"), F.lit(" ")))
    )
    paid = (
        F.when(i % 53 == 0, "abc").when(i % 59 == 0, "")
        .otherwise(F.concat(F.lit(" "), F.format_number("amount_paid", 2)))
    )
    return e.select(
        "event_id",
        stamp.alias("timestamp"), "from_bank", "from_account", "to_bank", "to_account",
        F.format_number("amount_received", 2).alias("amount_received"), "receiving_currency",
        paid.alias("amount_paid"), "payment_currency", "payment_format",
        F.col("is_laundering").cast("string").alias("is_laundering"),
    )


def raw_transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV text lines of the raw rows; every 101st lacks a field, every 103rd has one more."""
    raw = raw_transactions(spark, sf_dir)
    quoted = [
        F.concat(F.lit('"'), F.col(c), F.lit('"')) if c.startswith("amount") else F.col(c)
        for c in raw.columns if c != "event_id"
    ]
    i = F.col("event_id")
    line = (
        F.when(i % 101 == 0, F.concat_ws(",", *quoted[:-1]))
        .when(i % 103 == 0, F.concat_ws(",", *quoted, F.lit("extra")))
        .otherwise(F.concat_ws(",", *quoted))
    )
    return raw.select("event_id", line.alias("value"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account dimension: customers with their nation; two customers share each entity."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.concat(F.lit("Bank of "), F.col("n_name")).alias("bank_name"),
        F.col("c_nationkey").cast("string").alias("bank_id"),
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("account_number"),
        F.concat(F.lit("E"), F.floor(F.col("c_custkey") / 2).cast("string")).alias("entity_id"),
        F.col("c_name").alias("entity_name"),
    )


def bulk_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transactions between customers and suppliers (no unique id)."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag",
        "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    cn = nation.toDF("cn_key", "c_region")
    sn = nation.toDF("sn_key", "s_region")
    joined = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer.join(cn, F.col("c_nationkey") == F.col("cn_key")),
              F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier.join(sn, F.col("s_nationkey") == F.col("sn_key")),
              F.col("l_suppkey") == F.col("s_suppkey"))
    )
    paid = F.round(F.col("l_extendedprice") * 100, 2)
    currency_from = F.concat(F.lit("R"), F.col("c_region").cast("string"))
    currency_to = F.concat(F.lit("R"), F.col("s_region").cast("string"))
    return joined.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("transaction_date"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm").alias("transaction_minute"),
        F.col("c_nationkey").cast("string").alias("from_bank"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("from_account"),
        F.col("s_nationkey").cast("string").alias("to_bank"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("to_account"),
        paid.alias("amount_received"), currency_to.alias("receiving_currency"),
        paid.alias("amount_paid"), currency_from.alias("payment_currency"),
        F.concat("l_returnflag", "l_linestatus").alias("payment_format"),
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49)).cast("int")
        .alias("is_laundering"),
        (F.col("c_nationkey") != F.col("s_nationkey")).cast("int").alias("is_cross_bank"),
        (currency_from != currency_to).cast("int").alias("is_cross_currency"),
    )
