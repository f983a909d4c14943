"""The layered build end to end: raw files -> detail -> marts, each layer a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave import constants as K
from riskweave.operators import detail as D, joins as J, marts as M, profiling as P
from riskweave.operators.ranking import exact_quantile
from riskweave.sinks.tables import write_layer
from riskweave.sources import raw_files as R


def numbered_raw(spark: SparkSession, path: str, prefix: str = K.TRANSACTION_ID_PREFIX):
    """(numbered well-formed rows, malformed rows) of a raw transaction file."""
    good, bad = R.split_malformed(R.read_transactions_csv(spark, path))
    seq = R.with_file_sequence(good)
    return seq.withColumn("transaction_id", D.transaction_id(F.col("_seq"), prefix)), bad


def build_detail(spark: SparkSession, raw_path: str, accounts_path: str, out: str, run_id: str):
    """Write the detail fact, the account dimension and the event table."""
    raw, _ = numbered_raw(spark, raw_path)
    write_layer(D.build_dwd_transactions(raw), out, "dwd_transactions", run_id)
    acc, _ = R.split_malformed(R.read_accounts_csv(spark, accounts_path))
    write_layer(D.build_dwd_accounts(acc), out, "dwd_accounts", run_id)
    dwd = spark.read.parquet(f"{out}/dwd_transactions/run_id={run_id}")
    write_layer(D.to_events(dwd), out, "dwd_events", run_id)
    return dwd


def build_marts(dwd: DataFrame, out: str, run_id: str) -> dict[str, str]:
    """Write the four marts from a written detail table; the threshold is found once."""
    threshold = exact_quantile(dwd, "amount_paid", K.LARGE_QUANTILE)
    tables = {
        "dws_minute_kpi": (M.minute_kpi(dwd), ["transaction_minute", "payment_format"]),
        "dws_account_features": (M.account_features(dwd, threshold), ["account_number"]),
        "dws_payment_kpi": (M.payment_kpi(dwd), ["payment_format"]),
        "dws_large_candidates": (M.large_candidates(dwd, threshold), None),
    }
    return {
        name: write_layer(df, out, name, run_id, order=order)
        for name, (df, order) in tables.items()
    }


def quality_of_detail(raw: DataFrame, accounts: DataFrame, malformed: DataFrame | None = None) -> DataFrame:
    typed = D.typed_transactions(raw)
    kept = D.valid_amounts(typed)
    return P.dwd_quality_summary(typed, J.account_coverage(kept, accounts), malformed)
