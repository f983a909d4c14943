"""Derived inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave import constants as K
from riskweave.operators import (
    detail as D, features as FE, joins as J, marts as M, scoring as SC,
)
from riskweave.plans.reference_sql import NEGATIVES
from riskweave.session import staged as stored, work_path
from riskweave.sources import adapters as A

RUN = "r1"
STAMP = "2024-06-01 00:00:00"


def stamp():
    return F.lit(STAMP)


def text_file(df: DataFrame, header: list[str], label: str) -> str:
    """Write text lines (column ``value``, ordered by ``event_id``) as CSV files with a header.

    The header line of every part file is the name of the single column; quoting is off.
    """
    path = work_path(df.sparkSession, label)
    (
        df.repartitionByRange("event_id").sortWithinPartitions("event_id")
        .select(F.col("value").alias(",".join(header)))
        .write.option("header", True).option("sep", "\u0001").option("quote", "\u0000")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def transaction_file(spark: SparkSession, sf_dir: str) -> str:
    return text_file(A.raw_transaction_lines(spark, sf_dir), K.TRANSACTION_HEADER, "raw-tx")


def account_file(spark: SparkSession, sf_dir: str) -> str:
    """Account lines; every 50th customer's line lacks its last field."""
    acc = A.accounts(spark, sf_dir)
    number = F.substring("account_number", 2, 20).cast("long")
    fields = ["bank_name", "bank_id", "account_number", "entity_id"]
    short = F.concat_ws(",", *fields)
    full = F.concat_ws(" , ", *fields, F.col("entity_name"))
    lines = acc.select(
        number.alias("event_id"),
        F.when(number % 50 == 0, short).otherwise(full).alias("value"),
    )
    return text_file(lines, K.ACCOUNT_HEADER, "raw-accounts")


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskweave.plans.warehouse import numbered_raw

    return numbered_raw(spark, transaction_file(spark, sf_dir))[0]


def account_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.account_features(A.detail(spark, sf_dir))


def account_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account features as a written layer, as the later steps find them."""
    return stored(M.account_base(A.detail(spark, sf_dir)), "accounts")


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction with account features and ratios (split left blank)."""
    dwd = A.detail(spark, sf_dir)
    joined = J.join_account_features(dwd, M.account_base(dwd))
    return J.derive_features(J.fill_feature_defaults(joined)).withColumn("split", F.lit(""))


def scoring_input(spark: SparkSession, sf_dir: str, version: str = K.CONTRACT_STATE) -> DataFrame:
    return D.to_contract(context(spark, sf_dir), RUN, version)


def state_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.score_state(scoring_input(spark, sf_dir), RUN, stamp())


def simple_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.risk_rules_v0(D.to_replay(A.detail(spark, sf_dir), RUN), RUN)


def sampled_features(
    spark: SparkSession, sf_dir: str, accounts: DataFrame | None = None
) -> DataFrame:
    accounts = account_layer(spark, sf_dir) if accounts is None else accounts
    return FE.build_features(A.detail(spark, sf_dir), accounts, NEGATIVES)


def all_features(
    spark: SparkSession, sf_dir: str, accounts: DataFrame | None = None
) -> DataFrame:
    """Features of every transaction: the sampler's quota exceeds any table."""
    accounts = account_layer(spark, sf_dir) if accounts is None else accounts
    return FE.build_features(A.detail(spark, sf_dir), accounts, 1 << 62)


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages of the state events with faults by transaction number modulo 20."""
    events = state_events(spark, sf_dir)
    number = F.substring("transaction_id", 4, 10).cast("long") - 1
    text = F.to_json(F.struct(*events.columns))
    fault = number % 20

    def swap(pattern: str, new: str):
        return F.regexp_replace(text, pattern, new)

    value = (
        F.when(fault == 0, swap('"payment_currency":"[^"]*",', ""))
        .when(fault == 1, swap('"risk_score":[0-9]+', '"risk_score":"7"'))
        .when(fault == 2, swap('"risk_score":[0-9]+', '"risk_score":101'))
        .when(fault == 3, swap('"risk_level":"[A-Z]+"', '"risk_level":"SEVERE"'))
        .when(fault == 4, swap("p11v2_realtime_state_contract_v1", "p11v2_realtime_state_contract_v2"))
        .when(fault == 5, "not json")
        .when(fault == 6, swap('"run_id":"r1"', '"run_id":"r2"'))
        .when(fault == 7, swap('"event_time":"[^"]*"', '"event_time":null'))
        .when(fault == 8, F.lit("  "))
        .when(fault == 9, swap('"risk_score":[0-9]+', '"risk_score":25.0'))
        .when(fault == 10, swap('"risk_score":[0-9]+', '"risk_score":true'))
        .when(fault == 11, swap('"amount_paid":[0-9.E]+', '"amount_paid":5'))
        .when(fault == 12, F.concat(text, F.lit(" trailing")))
        .otherwise(text)
    )
    return events.select(number.alias("event_id"), value.alias("value"))
