"""Typed raw rows, detail transactions, account dimension and debit/credit events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K, schemas as S
from riskweave.functions import columns as C
from riskweave.operators.ranking import global_row_number


def ods_typed(raw: DataFrame) -> DataFrame:
    """Amounts to double (NULL when unparsable); a bad label aborts the job (strict cast)."""
    return raw.select(
        "timestamp", "from_bank", "from_account", "to_bank", "to_account",
        C.parse_amount("amount_received").alias("amount_received"), "receiving_currency",
        C.parse_amount("amount_paid").alias("amount_paid"), "payment_currency",
        "payment_format", C.strip("is_laundering").cast("int").alias("is_laundering"),
    )


def transaction_id(sequence: Column, prefix: str = K.TRANSACTION_ID_PREFIX,
                   width: int = K.TRANSACTION_ID_WIDTH) -> Column:
    digits = sequence.cast("string")  # longer numbers keep all their digits
    padded = F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), padded)


def assign_transaction_id(
    df: DataFrame, order: list[str], prefix: str = K.TRANSACTION_ID_PREFIX,
    width: int = K.TRANSACTION_ID_WIDTH,
) -> DataFrame:
    """Ids from the dense position in a total order (file scans use the file sequence)."""
    numbered = global_row_number(df, [F.col(c) for c in order], "_seq")
    return numbered.withColumn("transaction_id", transaction_id(F.col("_seq"), prefix, width)).drop("_seq")


def typed_transactions(raw: DataFrame) -> DataFrame:
    """Every detail column for every numbered row, invalid amounts still included."""
    ts = C.parse_ts("timestamp")
    return raw.select(
        "transaction_id",
        "timestamp",
        ts["transaction_date"].alias("transaction_date"),
        ts["transaction_hour"].alias("transaction_hour"),
        ts["transaction_minute"].alias("transaction_minute"),
        "from_bank", "from_account", "to_bank", "to_account",
        C.parse_amount("amount_received").alias("amount_received"),
        "receiving_currency",
        C.parse_amount("amount_paid").alias("amount_paid"),
        "payment_currency", "payment_format",
        C.strip("is_laundering").cast("int").alias("is_laundering"),
        C.differs("from_bank", "to_bank").alias("is_cross_bank"),
        C.differs("receiving_currency", "payment_currency").alias("is_cross_currency"),
    )


def valid_amounts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("amount_paid").isNotNull() & F.col("amount_received").isNotNull())


def build_dwd_transactions(raw: DataFrame) -> DataFrame:
    """Detail fact from numbered raw rows; ids were given before invalid rows drop out."""
    return valid_amounts(typed_transactions(raw))


def build_dwd_accounts(raw: DataFrame) -> DataFrame:
    """Trimmed account dimension; duplicates stay."""
    return raw.select(*[C.strip(c).alias(c) for c in S.ACCOUNT_COLUMNS])


def to_events(dwd: DataFrame) -> DataFrame:
    """Two rows per transaction, DEBIT and CREDIT, from one scan."""
    def side(kind: str, me: str, other: str, amount: str, currency: str) -> Column:
        return F.struct(
            F.lit(kind).alias("event_type"),
            F.col(f"{me}_account").alias("event_account"),
            F.col(f"{other}_account").alias("counterparty_account"),
            F.col(f"{me}_bank").alias("bank_id"),
            F.col(f"{other}_bank").alias("counterparty_bank_id"),
            F.col(amount).alias("event_amount"),
            F.col(currency).alias("currency"),
        )

    sides = F.array(
        side("DEBIT", "from", "to", "amount_paid", "payment_currency"),
        side("CREDIT", "to", "from", "amount_received", "receiving_currency"),
    )
    shared = ["payment_format", "is_laundering", "is_cross_bank", "is_cross_currency"]
    return dwd.select(
        "transaction_id", "timestamp", "transaction_minute", F.inline(sides), *shared
    )


def to_replay(dwd: DataFrame, run_id: str) -> DataFrame:
    """The 14-field replay event of each detail row."""
    same = ["transaction_minute", "from_bank", "from_account", "to_bank", "to_account"]
    return dwd.select(
        F.lit(run_id).alias("run_id"), "transaction_id",
        F.col("timestamp").alias("tx_timestamp"), *same,
        C.parse_amount(F.col("amount_paid").cast("string")).alias("amount_paid"),
        "payment_currency", "payment_format",
        *[C.lossless_int(c).alias(c) for c in
          ("is_laundering", "is_cross_bank", "is_cross_currency")],
    )


def to_contract(
    joined: DataFrame, run_id: str, version: str = K.CONTRACT_V1,
    snapshot: str = K.FEATURE_SNAPSHOT_VERSION,
) -> DataFrame:
    """Feature rows with time and accounts, cast to the 30-field scoring input."""
    source = {"tx_timestamp": "timestamp", "observed_is_laundering": "is_laundering"}
    constant = {
        "run_id": F.lit(run_id), "contract_version": F.lit(version),
        "feature_snapshot_version": F.lit(snapshot),
    }
    cols = []
    for field in S.SCORING_INPUT.fields:
        value = constant.get(field.name)
        if value is None:
            value = F.col(source.get(field.name, field.name)).cast(field.dataType)
        cols.append(value.alias(field.name))
    return joined.select(*cols)


def as_json_lines(df: DataFrame, name: str = "value") -> DataFrame:
    """One compact JSON text per row."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))
