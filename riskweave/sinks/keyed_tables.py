"""Keyed tables in files: one row per key, in hash buckets that are rewritten only when touched.

The bucket of a row is a partition folder, so a merge reads and replaces the folders of the keys it
carries (dynamic partition overwrite), and a reader scans one row per key however many merges there
were.  A merge with a token first writes the new content of its buckets beside the table.  Where that
copy is complete, a repeated merge with the token only puts it in place again: a batch that a stream
runs twice, or that was lost while folders were being replaced, ends in the same table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweave.operators.state import upsert
from riskweave.session import path_exists, remove_path, staged

BUCKET = "_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """``order`` decides between two rows of a key: the greater one stays, among equals the later merge.

    ``buckets`` is fixed with the first merge; size it for buckets of some hundred megabytes.
    """

    path: str
    key: str
    order: str
    buckets: int = 32

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(BUCKET)

    def lookup(self, spark: SparkSession, keys: list) -> DataFrame:
        """The rows of a few keys: only their buckets are read."""
        asked = spark.createDataFrame([(k,) for k in keys], [self.key])
        asked = asked.select(F.col(self.key).cast(self.read(spark).schema[self.key].dataType).alias(self.key))
        buckets = [r[0] for r in asked.select(self._bucket()).distinct().collect()]
        wanted = spark.read.parquet(self.path).filter(F.col(BUCKET).isin(buckets)).drop(BUCKET)
        return wanted.join(asked, self.key, "left_semi")

    def touched(self, spark: SparkSession, buckets: list[int]) -> DataFrame:
        """The rows of these buckets."""
        return spark.read.parquet(self.path).filter(F.col(BUCKET).isin(buckets)).drop(BUCKET)

    def merge(self, updates: DataFrame, token: str | int | None = None, later: Sequence[str] = ()) -> None:
        """Insert new keys and replace those whose update is newer or equally new.

        ``later`` are columns that decide between updates of one key and ``order``.
        """
        spark = updates.sparkSession
        if token is None:  # Spark writes beside the folders and then replaces them, so they can be read meanwhile
            self._put(self._merged(updates, later))
            return
        ready = f"{self.path}_merges/token={token}"
        if not path_exists(spark, f"{ready}/_SUCCESS"):
            self._merged(updates, later).write.mode("overwrite").parquet(ready)
        self._put(spark.read.parquet(ready))

    def forget(self, spark: SparkSession, token: str | int) -> None:
        """Drop the copy kept for a token that cannot come again."""
        remove_path(spark, f"{self.path}_merges/token={token}")

    def _merged(self, updates: DataFrame, later: Sequence[str]) -> DataFrame:
        spark = updates.sparkSession
        updates = staged(updates, "updates")
        if not path_exists(spark, self.path):
            base = updates.limit(0)
        else:  # at most one number per bucket comes to the driver
            base = self.touched(spark, [r[0] for r in updates.select(self._bucket()).distinct().collect()])
        return upsert(base, updates, self.key, self.order, later)

    def _put(self, rows: DataFrame) -> None:
        # a bucket is written by one task or, if it is large, by several
        placed = rows.withColumn(BUCKET, self._bucket())
        (
            placed.hint("rebalance", F.col(BUCKET)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        )
