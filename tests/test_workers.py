"""Executors need no copy of the package: the functions travel with their tasks."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys, os
sys.path.insert(0, {repo!r})
from riskweave import build_session
spark = build_session("alone", "local[2]", **{{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": os.getcwd() + "/work"}})
spark.sparkContext.setLogLevel("ERROR")
{body}
print("all done")
"""


def run_alone(body: str, folder) -> str:
    """What a script prints that runs in another folder, without the repository on the path of the workers."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=str(REPO), body=body)], cwd=folder, env=env, capture_output=True, text=True, timeout=600)
    return out.stdout + out.stderr[-2000:]


def test_models_and_headers_alone(tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.csv").write_text("a,b\n1,2\n")
    body = """
from riskweave.models import balanced_forest as BF
from riskweave.sources import raw_files as R
rows = spark.createDataFrame([(str(i), i % 2, [float(i % 7), float(i % 2)]) for i in range(300)], "id string, y int, x array<double>")
forest = BF.fit_balanced_forest(rows, 2, trees=2, depth=2, min_leaf=5)
assert BF.score_balanced_forest(rows, forest).filter("prediction = y").count() > 250
assert R.check_header(spark, os.getcwd() + "/files", ["a", "b"]).first()["status"] == "pass"
"""
    assert "all done" in run_alone(body, tmp_path)
