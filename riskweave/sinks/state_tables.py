"""Keyed stores fed from micro-batches: one partition per batch, last batch wins.

A batch writes only its own partition and overwrites it when Spark replays the batch,
which makes the sink idempotent.  Readers take the latest batch per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave.operators.ranking import latest_per_key


def put_batch(rows: DataFrame, path: str, batch_id: int) -> str:
    target = f"{path}/batch_id={batch_id}"
    rows.write.mode("overwrite").parquet(target)
    return target


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Newest row per key over all batches."""
    return latest_per_key(read_batches(spark, path), key, ["batch_id"]).drop("batch_id")


def compact(spark: SparkSession, path: str, key: str, target: str) -> None:
    """Write the current state as batch -1 of a new table, to keep reads short."""
    put_batch(read_latest(spark, path, key), target, -1)
