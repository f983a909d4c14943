"""Structured Streaming jobs; the row logic is the batch functions, unchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from riskweave.functions.columns import money_sum, rate
from riskweave.operators import state as ST
from riskweave.operators.contract import ERRORS, Contract, contract_errors, split_checked
from riskweave.operators.detail import as_json_lines
from riskweave.session import remove_path
from riskweave.sinks.keyed_tables import KeyedTable
from riskweave.sinks.state_tables import put_batch
from riskweave.sources.layers import parse_events
from riskweave.streaming.topics import topic_stream


def raw_stream(spark: SparkSession, kind: str, location: str, **options: object) -> DataFrame:
    """Text messages (column ``value``) from a Kafka topic, a message log or a folder of JSON lines.

    Topics and logs also give ``partition`` and ``offset``.  For folders, ``arrival=True`` adds the time
    and name of the file a line came in (``arrived``, ``file``).  ``maxFilesPerTrigger`` (files and logs)
    or ``maxOffsetsPerTrigger`` (Kafka) limits the rate.
    """
    arrival = options.pop("arrival", False)
    if kind == "topic":
        return topic_stream(spark, location, options.get("maxFilesPerTrigger"))
    if kind == "kafka":
        topic = (
            spark.readStream.format("kafka").option("subscribe", location)
            .option("startingOffsets", "earliest").options(**options).load()
        )
        return topic.select(
            F.col("value").cast("string").alias("value"), "partition", "offset"
        )
    lines = spark.readStream.options(**options).text(location)
    place = [F.col("_metadata.file_modification_time").alias("arrived"), F.col("_metadata.file_path").alias("file")]
    return lines.select("value", *(place if arrival else []))


def stream_source(
    spark: SparkSession, kind: str, location: str, schema: T.StructType, **options: str
) -> DataFrame:
    """Typed events: bad fields become NULL, undecodable messages disappear."""
    return parse_events(raw_stream(spark, kind, location, **options), schema)


def write_replay(events: DataFrame, path: str) -> None:
    """One JSON message per row into a folder that ``stream_source`` reads."""
    as_json_lines(events).write.mode("append").text(path)


def replay_to_kafka(events: DataFrame, topic: str, servers: str) -> None:
    as_json_lines(events).write.format("kafka").option("topic", topic).option(
        "kafka.bootstrap.servers", servers
    ).save()


def event_sink(
    stream: DataFrame, kind: str, location: str, checkpoint: str, **options: str
) -> StreamingQuery:
    """Risk events to JSON files or a Kafka topic, drained once and checkpointed."""
    if kind == "kafka":
        writer = as_json_lines(stream).writeStream.format("kafka").option("topic", location)
    else:
        writer = stream.writeStream.format("json").option("path", location)
    return (
        writer.options(**options).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def valid_events(raw: DataFrame, contract: Contract) -> DataFrame:
    """The messages that keep the contract, as typed columns."""
    return split_checked(contract_errors(raw, contract), contract)[0]


def latest_by_arrival(events: DataFrame, key: str, arrival: list[str]) -> DataFrame:
    """Per key the event that arrived last, and the number of its events (``event_count``).

    On a stream this is keyed state in the state store, kept over micro-batches and restarts.  ``arrival``
    are the columns of a message's position, so neither the cut of the micro-batches nor the order of
    rows inside one matters.  Tasks combine their rows per key before the shuffle: a key with a third of
    all messages sends one row per task.
    """
    rest = [c for c in events.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*arrival)).alias("_last")
    return events.groupBy(key).agg(last, F.count("*").alias("event_count")).select(key, "_last.*", "event_count")


def event_log(
    raw: DataFrame, contract: Contract, root: str, checkpoint: str, query_name: str = "event_log"
) -> StreamingQuery:
    """Contract check: every micro-batch adds its partition to ``invalid``, ``events`` and ``metrics``.

    The counts in ``metrics`` are observed while the other two are written, not read again.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        checked = contract_errors(batch, contract).persist()
        valid, invalid = split_checked(checked, contract)
        good, bad = Observation(), Observation()
        invalid = invalid.withColumn(ERRORS, F.to_json(ERRORS)).observe(bad, F.count("*").alias("n"))
        put_batch(invalid, f"{root}/invalid", batch_id)
        put_batch(valid.observe(good, F.count("*").alias("n")), f"{root}/events", batch_id)
        checked.unpersist()
        counts = batch.sparkSession.createDataFrame([(good.get["n"], bad.get["n"])], "valid long, invalid long")
        put_batch(counts, f"{root}/metrics", batch_id)

    return (
        raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName(query_name)
        .trigger(availableNow=True).start()
    )


def latest_state_job(
    raw: DataFrame, contract: Contract, root: str, checkpoint: str, arrival: list[str],
    key: str = "event_account", key_prefix: str = "risk:latest", stamp: Column | None = None, buckets: int = 32,
) -> StreamingQuery:
    """Keyed streaming state: the last valid event of every account by arrival.

    Each micro-batch merges the accounts that changed into the keyed tables ``cache`` and ``durable``.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # computed once in every attempt, also where both tables have kept their copies: state must commit
        stored = put_batch(batch, f"{root}/changed", batch_id)
        changed = spark.read.schema(batch.schema).parquet(stored)
        for table, rows in (
            (state_table(root, "cache", buckets), ST.cache_rows(changed.select(*contract.schema.names), key_prefix)),
            (state_table(root, "durable", buckets), ST.durable_state_rows(changed, stamp)),
        ):
            table.merge(rows.withColumn("batch_id", F.lit(batch_id).cast("long")), token=batch_id)
            table.forget(spark, batch_id - 1)
        remove_path(spark, f"{root}/changed/batch_id={batch_id - 1}")

    state = latest_by_arrival(valid_events(raw, contract), key, arrival)
    return (
        state.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def state_table(root: str, name: str, buckets: int = 32) -> KeyedTable:
    """``cache`` or ``durable`` under the root of a state job."""
    return KeyedTable(f"{root}/{name}", "key" if name == "cache" else "event_account", "batch_id", buckets)


def state_job(
    raw: DataFrame, contract: Contract, root: str, checkpoint: str, arrival: list[str],
    key_prefix: str = "risk:latest", stamp: Column | None = None, buckets: int = 32,
) -> list[StreamingQuery]:
    """Contract check and latest state per account, as two queries with checkpoints of their own."""
    return [
        event_log(raw, contract, root, f"{checkpoint}/log"),
        latest_state_job(raw, contract, root, f"{checkpoint}/latest", arrival, key_prefix=key_prefix, stamp=stamp, buckets=buckets),
    ]


def heartbeat(events: DataFrame, ts: str, at: Column) -> DataFrame:
    """One message without a transaction, at a later time: it moves the watermark and counts nowhere.

    Sent when a source is finished or silent, it closes the windows that wait for later events.
    """
    fields = [(at.cast(f.dataType) if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name) for f in events.schema]
    return events.sparkSession.range(1).select(*fields)


def streaming_minute_kpi(events: DataFrame, ts: str = "event_ts", delay: str = "10 minutes") -> DataFrame:
    """The minute mart on a stream: one-minute event-time windows per payment format, exact accounts.

    Two aggregations in a row: per window, format and account, then per window and format.  The first
    one is state of one row per account and window, spreads a hot minute over its accounts, and makes the
    distinct count a plain count.  A window is emitted once, when the watermark passes its end; after
    the last event a :func:`heartbeat` closes the rest.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    # a heartbeat must pass the watermark, so it is not filtered out here but counts nothing
    real = F.col("transaction_id").isNotNull()
    sides = timed.select(
        ts, "payment_format", "is_laundering", "amount_paid",
        F.inline(F.array(
            F.struct(F.col("from_account").alias("account"), real.cast("long").alias("first")),
            F.struct(F.col("to_account").alias("account"), F.lit(0).cast("long").alias("first")),
        )),
    )
    main = F.col("first") == 1
    accounts = sides.groupBy(F.window(ts, "1 minute").alias("w"), "payment_format", "account").agg(
        F.sum("first").alias("count"),
        F.sum(F.when(main, F.col("is_laundering")).otherwise(0)).cast("long").alias("label"),
        money_sum(F.when(main, F.col("amount_paid"))).alias("paid"),
    )
    count, label = F.sum("count"), F.sum("label")
    minutes = accounts.groupBy("w", "payment_format").agg(
        count.alias("transaction_count"), label.alias("laundering_count"), rate(label, count).alias("laundering_rate"),
        money_sum("paid").alias("total_amount_paid"), F.count("account").alias("distinct_account_count"),
    )
    return minutes.filter("transaction_count > 0").select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm").alias("transaction_minute"), "payment_format", "transaction_count",
        "laundering_count", "laundering_rate", "total_amount_paid", "distinct_account_count",
    )
