"""Message logs in files, with the columns of a Kafka topic: partition, offset and value.

A log is what the streams read where no broker is there; the position of a message in it, not the time
inside the message or the micro-batch that met it, says which of two messages came later.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

POSITION = ["partition", "offset"]
SEGMENT_ROWS = 20_000  # messages of a file, some megabytes of text
MESSAGE = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])


def messages_of(events: DataFrame, key: str, offset: Column, partitions: int = 4) -> DataFrame:
    """(partition, offset, value): a JSON message per row, in the partition of its key, as keyed producers send.

    ``offset`` numbers the rows by arrival, with gaps or not; within a partition it must not repeat.
    """
    text = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    place = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    return events.select(place.alias("partition"), offset.cast("long").alias("offset"), text.alias("value"))


def write_topic(messages: DataFrame, path: str, files: int = 1) -> None:
    """Append messages to a log as about ``files`` files, in the order of their offsets."""
    rows = messages.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in MESSAGE])
    rows.repartitionByRange(files, "offset").sortWithinPartitions("offset").write.mode("append").parquet(path)


def segments(rows: int, stretches: int) -> int:
    """Files for each of the ``stretches`` of a log of ``rows`` messages.

    A file of a micro-batch is checked by one task, so files stay of one size and a longer stretch has more of them.
    """
    return max(1, math.ceil(rows / (stretches * SEGMENT_ROWS)))


def topic_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The messages of a log as a stream; ``files_per_batch`` limits the rate."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_batches(query: StreamingQuery, batches: int, pause: float = 0.05) -> int:
    """Let a query finish some micro-batches, then stop it, wherever the next one is; returns the finished ones.

    Started again with its checkpoint, it goes on behind the last finished batch.
    """
    def done() -> int:
        last = query.lastProgress
        return 0 if last is None else last["batchId"] + 1

    while query.isActive and done() < batches:
        time.sleep(pause)
    query.stop()
    return done()
