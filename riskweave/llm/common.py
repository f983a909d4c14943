"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import remove_path, work_path

MADE: list[tuple[str, str]] = []  # name and folder of the bucketed tables of this driver
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = "[\\x20\\x09-\\x0D]+"
BATCH = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """Words between ASCII white space; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % divisor


def held_out(id_col: Column, divisor: int, value: int) -> Column:
    return F.coalesce(remainder(id_col, divisor) == value, F.lit(False))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, as ``_id`` and ``_text``: other columns cannot clash."""
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))


def process_cache() -> dict:
    """A dict that lives as long as this Python process: reused workers keep loaded vocabularies and models."""
    return sys.modules.setdefault("riskweave_process_cache", ModuleType("riskweave_process_cache")).__dict__


def co_located(rows: DataFrame, key: str, label: str) -> DataFrame:
    """``rows`` as a stored table in hash buckets of ``key``: later joins on it move the other side only."""
    spark = rows.sparkSession
    name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_path(spark, label)
    rows.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    MADE.append((name, path))
    return spark.table(name)


def drop_tables(spark: SparkSession, since: int) -> None:
    """Drop the tables that :func:`co_located` has made since :data:`MADE` had ``since`` entries; nothing reads them any more."""
    for name, path in MADE[since:]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(spark, path)
    del MADE[since:]


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps.

    It does so when the driver collects the plans that made them; operators of several stored steps
    ask for that after each step.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of this session end after :data:`BATCH` bytes.

    Spark's own end after 10,000 rows or 64 MB; the JVM's vectors double as they grow, and the worker holds a batch too.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def give_back() -> None:
    """Return memory that this Python process no longer uses to the machine; a reused worker keeps it else while other steps run."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
        if trim is not None:
            trim(0)


def bounded(side: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A stored table of keys, marked for broadcast if it is proven small; else Spark shuffles the join."""
    return F.broadcast(side) if side.count() <= rows else side


def byte_column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a column in a row, and the offsets of its texts; nulls are empty."""
    column = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.zeros(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_blocks(
    batches: Iterator[pa.RecordBatch], column: str, most: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of about ``most`` bytes of text each; a longer text is a block of its own."""
    for batch in batches:
        if batch.num_rows:
            data, offsets = byte_column(batch.column(column))
            edge = np.flatnonzero(np.diff(offsets[:-1] // most, prepend=-1)).tolist() + [batch.num_rows]
            for a, b in zip(edge, edge[1:]):
                yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
