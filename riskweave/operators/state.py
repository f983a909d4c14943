"""Latest state per account: durable rows, upsert, search documents and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskweave.functions import columns as C
from riskweave.operators.ranking import latest_per_key


def latest_state(events: DataFrame, order: list[str], key: str = "event_account") -> DataFrame:
    return latest_per_key(events, key, order)


def cache_rows(latest: DataFrame, prefix: str) -> DataFrame:
    """(key, value) pairs for a key-value store: prefix + account -> event JSON."""
    return latest.select(
        F.concat_ws(":", F.lit(prefix), "event_account").alias("key"),
        F.to_json(F.struct(*latest.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


# fixed values: column families of the durable state row
_FAMILIES = {
    "s": ["risk_score", "risk_level", "state_operation", "updated_at"],
    "m": ["amount_paid", "payment_currency", "payment_format"],
    "r": ["risk_reasons", "rule_hits"],
    "meta": ["run_id", "transaction_id", "event_time", "contract_version",
             "counterparty_account", "feature_snapshot_version"],
}


def durable_state_rows(latest: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """One wide row per account: salted key and four column families."""
    now = (
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        if updated_at is None else updated_at
    )
    stamped = latest.withColumn("updated_at", now)
    return stamped.select(
        C.salted_row_key("event_account").alias("row_key"), "event_account",
        *[F.struct(*cols).alias(family) for family, cols in _FAMILIES.items()],
    )


def durable_state_cells(rows: DataFrame) -> DataFrame:
    """Wide rows as (row_key, column, value) cells, 15 per account."""
    cells = [
        F.struct(
            F.lit(f"{family}:{c}").alias("column"),
            F.coalesce(F.col(f"{family}.{c}").cast("string"), F.lit("")).alias("value"),
        )
        for family, cols in _FAMILIES.items() for c in cols
    ]
    return rows.select("row_key", F.inline(F.array(*cells)))


def durable_view(rows: DataFrame) -> DataFrame:
    """Account, score and level read back from wide rows."""
    return rows.select("event_account", "s.risk_score", "s.risk_level")


def upsert(
    base: DataFrame, updates: DataFrame, key: str, precombine: str, later: Sequence[str] = (),
) -> DataFrame:
    """New keys are inserted; a key is replaced when its update is newer or equally new.

    Within ``updates`` the greatest ``precombine`` per key wins, among equals the greatest ``later``.
    ``base`` is unique per key.  Both sides are read once, moved once and meet in one full outer
    join, whose sort can spill; tasks combine the updates of a frequent key before they move.
    """
    cols = base.columns
    newest = updates.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(precombine, *later)).alias("_new"))
    old = base.select(F.col(key).alias("_old_key"), F.struct(*cols).alias("_old"))
    new = newest.select(F.col(key).alias("_new_key"), "_new")
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
    before, after = F.col(f"_old.{precombine}"), F.col(f"_new.{precombine}")
    stays = F.col("_new_key").isNull() & F.col("_new").isNull() | (
        F.col("_old").isNotNull() & F.coalesce(after < before, after.isNull() & before.isNotNull())
    )
    return both.select(F.when(stays, F.col("_old")).otherwise(F.col("_new")).alias("r")).select("r.*")


def search_documents(events: DataFrame, ingested_at: Column | None = None,
                     formats: tuple[str, ...] = C.SEARCH_TIME_FORMATS) -> DataFrame:
    """Search documents: id, normalised times and their raw copies."""
    now = F.current_timestamp() if ingested_at is None else ingested_at
    raw = {f"{c}_raw": F.coalesce(F.col(c), F.lit("")) for c in ("event_time", "scored_at")}
    out = events.withColumns(raw)
    return out.withColumns({
        "event_time": C.normalize_time("event_time_raw", formats),
        "scored_at": C.normalize_time("scored_at_raw", formats),
        "doc_id": C.doc_id("run_id", "transaction_id"),
        "ingested_at": now,
    })


def risk_type_counts(events: DataFrame) -> DataFrame:
    """Events and distinct accounts per risk type, of events with an account; a missing type is UNKNOWN."""
    return (
        events.filter(F.coalesce("event_account", F.lit("")) != "")
        .groupBy(F.coalesce("risk_type", F.lit("UNKNOWN")).alias("risk_type"))
        .agg(F.count("*").alias("event_count"), F.count_distinct("event_account").alias("account_count"))
    )


def level_and_rule_counts(events: DataFrame) -> DataFrame:
    """``risk_level.X`` and ``rule_hit.Y`` counts from one scan."""
    hits = F.filter(
        F.transform(F.split("rule_hits", ";"), lambda h: F.trim(h)), lambda h: h != ""
    )
    keys = F.concat(
        F.array(F.concat(F.lit("risk_level."), F.col("risk_level"))),
        F.transform(hits, lambda h: F.concat(F.lit("rule_hit."), h)),
    )
    return (
        events.select(F.explode(keys).alias("metric")).groupBy("metric")
        .agg(F.count("*").alias("value"))
    )


def stream_summary(
    checked: DataFrame, account: Column, consistency: DataFrame | None = None
) -> DataFrame:
    """One row over contract-checked raw events: counts, keys and the overall verdict.

    ``checked`` has ``_validation_errors``; ``account`` reads the account of a raw event.
    """
    ok = F.size("_validation_errors") == 0
    out = checked.agg(
        F.count("*").alias("raw_event_count"),
        F.count_if(ok).alias("schema_valid_event_count"),
        F.count_if(~ok).alias("schema_invalid_event_count"),
        F.count_distinct(F.when(ok, account)).alias("keys_written"),
    )
    return _judged(out, consistency)


def observed_summary(metrics: DataFrame, state: DataFrame, consistency: DataFrame | None = None) -> DataFrame:
    """The summary of :func:`stream_summary` without a look at the events.

    ``metrics`` are the counts that each micro-batch observed while it wrote (``valid``, ``invalid``), a row
    per batch; ``state`` is a keyed table, one row per account.
    """
    valid, invalid = (F.coalesce(F.sum(c), F.lit(0)) for c in ("valid", "invalid"))
    out = metrics.agg(
        (valid + invalid).alias("raw_event_count"), valid.alias("schema_valid_event_count"),
        invalid.alias("schema_invalid_event_count"),
    ).withColumn("keys_written", state.agg(F.count("*")).scalar())
    return _judged(out, consistency)


def _judged(out: DataFrame, consistency: DataFrame | None) -> DataFrame:
    fails = (
        F.lit(0).cast("long") if consistency is None
        else consistency.agg(F.count_if(F.col("status") != "PASS")).scalar()
    )
    good = (
        (F.col("schema_valid_event_count") > 0) & (F.col("schema_invalid_event_count") == 0)
        & (F.col("keys_written") > 0) & (F.col("consistency_fail_count") == 0)
    )
    return out.withColumn("consistency_fail_count", fails).withColumn("status", F.when(good, "PASS").otherwise("FAIL"))
