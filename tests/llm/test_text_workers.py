"""The text operators run where executors have no copy of the package."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from test_workers import run_alone  # noqa: E402

BODY = """
import random
from pyspark.sql import functions as F
from riskweave.llm import hard_negatives, periodic_runs, secret_scan, suffix_dedup
rng = random.Random(1)
passage = " ".join(str(rng.random()) for _ in range(60))
docs = spark.createDataFrame([(i, f"{i} {passage} {rng.random()}" if i < 3 else "token=abcdefghijklmn " * 9) for i in range(5)], "doc_id long, text string")
assert suffix_dedup.removal_digests(docs, passage=256).filter("n_removed > 0 and n_shared_bytes > 0").count() >= 3
assert suffix_dedup.repeated_spans(docs).count() >= 3 and suffix_dedup.removed_texts(docs).count() >= 3
assert periodic_runs.periodic_runs(docs).filter("size(runs) > 0").count() == 2
assert secret_scan.scan_secrets(docs).filter("size(spans) = 9").count() == 2
rows = spark.createDataFrame([(i, i % 2, [i % 7 + 3, i % 5 + 4]) for i in range(60)], "vec_id long, label int, vector array<long>")
assert hard_negatives.mine_hard_negatives(rows, F.col("_id") % 10 == 0).count() > 0
"""


def test_new_operators_alone(tmp_path):
    assert "all done" in run_alone(BODY, tmp_path)
