"""The streaming flow end to end: sample -> replay -> score -> state -> serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskweave import constants as K, schemas as S
from riskweave.operators import (
    contract as CT, detail as D, joins as J, sampling as SA, scoring as SC, serving as SV,
    state as ST,
)
from riskweave.sinks import state_tables as KV, tables as TB
from riskweave.sinks.keyed_tables import KeyedTable
from riskweave.sources import layers as L
from riskweave.streaming import jobs as SJ


def make_scoring_sample(
    features: DataFrame, dwd: DataFrame, run_id: str, rows: int = 10_000,
    version: str = K.CONTRACT_STATE,
) -> DataFrame:
    """Tiered sample of feature rows as scoring-contract events."""
    return D.to_contract(SA.tiered_sample(J.join_features_tx(features, dwd), rows), run_id, version)


def search_index(root: str, buckets: int = 32) -> KeyedTable:
    """Search documents by id; a document that was scored later replaces one that was scored earlier."""
    return KeyedTable(f"{root}/search", "doc_id", "scored_ts", buckets)


def index_documents(events: DataFrame, index: KeyedTable, later: list[str], stamp: Column | None = None) -> None:
    """Put events into the search index; ``later`` decides between two of one id scored at the same time."""
    documents = ST.search_documents(events, stamp).withColumn("scored_ts", F.try_to_timestamp("scored_at"))
    index.merge(documents, later=later)


def run_scoring(
    inputs: DataFrame, root: str, run_id: str, order: list[str], stamp: Column | None = None
) -> DataFrame:
    """Replay the inputs, score the stream, keep state and serve it; returns the summary.

    Under ``root``: ``input`` and ``risk`` JSON lines, the keyed tables of the state job, and
    the display tables ``ads_accounts``, ``ads_events`` and ``search``.  Running again with the
    same checkpoint folder only handles new messages.
    """
    spark = inputs.sparkSession
    SJ.write_replay(inputs, f"{root}/input")
    stream = SJ.stream_source(spark, "files", f"{root}/input", S.SCORING_INPUT)
    scored = SC.score_state(stream, run_id, stamp)
    SJ.event_sink(scored, "files", f"{root}/risk", f"{root}/checkpoints/score").awaitTermination()

    raw = SJ.raw_stream(spark, "files", f"{root}/risk", arrival=True)
    mine = raw.filter(
        L.decodable(F.trim("value")) & (F.get_json_object("value", "$.run_id") == run_id)
    )
    for query in SJ.state_job(
        mine, CT.STATE, root, f"{root}/checkpoints/state", ["arrived", "file", *order], stamp=stamp
    ):
        query.awaitTermination()

    durable = SJ.state_table(root, "durable").read(spark)
    cached = SJ.state_table(root, "cache").read(spark).drop("batch_id")
    cache = L.parse_events(cached, S.STATE_EVENT).drop("key")
    consistency = J.state_consistency(cache, ST.durable_view(durable))
    logged = KV.read_batches(spark, f"{root}/events")
    events = logged.drop("batch_id", "arrived", "file")
    TB.olap_load_accounts(SV.ads_account_rollup(events), f"{root}/ads_accounts")
    TB.olap_load_events(events, f"{root}/ads_events")
    index_documents(logged.drop("batch_id"), search_index(root), ["arrived", "file"])
    return ST.observed_summary(KV.read_batches(spark, f"{root}/metrics"), cached, consistency)
