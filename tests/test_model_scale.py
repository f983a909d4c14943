"""What the models do with many rows: even parts, one encoding, no needless passes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave import constants as K
from riskweave.models import balanced_forest as BF, baseline as B
from riskweave.operators import sampling as SA
from riskweave.session import staged


@pytest.fixture(scope="module")
def train(spark):
    numbers = [((F.col("id") * (7 + i)) % (11 + i)).cast("double").alias(c) for i, c in enumerate(K.NUMERIC_FEATURES)]
    return spark.range(2_000).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("transaction_id"),
        (F.col("id") % 7 == 0).cast("int").alias(B.LABEL), F.col("id").cast("int").alias("n"),
        F.concat(F.lit("C"), (F.col("id") % 3).cast("string")).alias("payment_currency"),
        F.when(F.col("id") % 5 == 0, "Wire").otherwise("Cash").alias("payment_format"), *numbers,
    )


def _sizes(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


def test_last_stage_gets_equal_parts_of_encoded_rows(spark, train, monkeypatch):
    monkeypatch.setattr(B, "TASK_ROWS", 150)
    rows, seen = B.with_class_weight(train.coalesce(1)), []
    stages = B.logistic_stages(2_000)
    whole = stages[-1].fit
    monkeypatch.setattr(stages[-1], "fit", lambda df: seen.append((_sizes(df), df.is_cached)) or whole(df))
    model = B.fit_stages(stages, rows, 2_000)
    (sizes, cached), = seen
    assert cached and len(sizes) == 16 and sum(sizes) == 2_000 and max(sizes) < 200
    usual = Pipeline(stages=B.logistic_stages(2_000)).fit(rows)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(usual.stages[-1].coefficients.toArray(), abs=1e-4)


def test_inputs_of_the_forest_are_those_of_the_encoder(spark, train):
    labels = B.forest_inputs(train)
    assert labels == [["C0", "C1", "C2"], ["Cash", "Wire"]]
    odd = train.limit(20).withColumn("payment_currency", F.when(F.col("n") % 4 == 0, "new").otherwise(F.col("payment_currency")))
    stages, out = B._encoder_stages(scale=False)
    want = Pipeline(stages=stages).fit(train).transform(odd).select("n", vector_to_array(out).alias("x"))
    got = B.encoded_rows(labels, odd).select("n", "x")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(Exception, match="no number in amount_paid"):
        B.encoded_rows(labels, odd.withColumn("amount_paid", F.lit(None).cast("double"))).select("x").collect()


def test_flags_take_one_cut(spark):
    rows = spark.range(100).select(F.array(F.col("id").cast("double"), (F.col("id") == 5).cast("double")).alias("x"))
    numbers, flag = BF.quantile_cuts(rows, 2, 4, flags=1)
    assert len(numbers) == 3 and flag.tolist() == [0.0]


def test_blocks_hold_every_row(spark, monkeypatch):
    monkeypatch.setattr(BF, "BLOCK", 7)
    rows = spark.range(100).select((F.col("id") % 2).cast("int").alias("y"), F.col("id").alias("a"), (F.col("id") + (1 << 30)).alias("b"), F.array(F.col("id").cast("double")).alias("x"))
    cells = BF._encoded(rows, [np.array([9.0, 49.0])]).toArrow().to_batches()
    y, a, b, code = (np.concatenate(parts) for parts in zip(*BF._blocks(iter(cells), 1)))
    assert a.tolist() == list(range(100)) and (b - a == 1 << 30).all() and (y == a % 2).all()
    assert code[:, 0].tolist() == [0] * 10 + [1] * 40 + [2] * 50


def test_a_quota_no_stratum_reaches_counts_nothing(spark, train, monkeypatch):
    asked, edge = [], SA._edge_buckets
    monkeypatch.setattr(SA, "_edge_buckets", lambda keyed, ranks: asked.append(ranks) or edge(keyed, ranks))
    assert SA.undersample(train, 1 << 62).count() == 2_000 and SA.undersample(train, 10).count() == 296
    assert asked == [{}, {0: 10}]


def test_small_row_groups_are_shared_by_tasks(spark):
    rows = spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("h"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3m")
    try:
        assert [len(_sizes(staged(rows.coalesce(1), "groups", group_mb=mb))) > 1 for mb in (None, 1)] == [False, True]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
