"""Publishing without a gap, and file checks that read no more than they need."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from riskweave import constants as K
from riskweave.sinks import tables as TB
from riskweave.sources import raw_files as R


def test_a_failing_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "published")
    TB.publish_tables(spark, {"swap_a": spark.range(5)}, location=root)
    bad = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        TB.publish_tables(spark, {"swap_a": bad}, location=root)
    assert spark.table("swap_a").count() == 5
    # a reader that began before the change still finds its files
    open_before = spark.read.parquet(TB.table_location(spark, "swap_a"))
    row = TB.publish_tables(spark, {"swap_a": spark.range(3)}, location=root, expected={"swap_a": 3}).first()
    assert (row["actual_count"], row["status"]) == (3, "PASS") and open_before.count() == 5
    TB.publish_tables(spark, {"swap_a": spark.range(2)}, location=root)
    assert spark.table("swap_a").count() == 2 and len(os.listdir(f"{root}/swap_a")) == 2
    # other columns: created anew over files that are there
    TB.publish_tables(spark, {"swap_a": spark.range(4).select(F.col("id").cast("string").alias("k"))}, location=root)
    assert spark.table("swap_a").columns == ["k"] and spark.table("swap_a").count() == 4
    spark.sql("DROP TABLE swap_a")


def test_publish_into_a_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for n in (5, 6):
        assert TB.publish_tables(spark, {"t": spark.range(n)}, "shop").first()["actual_count"] == n
    spark.sql("DROP TABLE shop.t")


def test_headers_of_all_kinds(spark, tmp_path):
    line = ",".join(K.ACCOUNT_HEADER)
    files = {
        "plain.csv": f"{line}\nrow\n", "alone.csv": line, "windows.csv": f"{line}\r\nrow\r\n", "old mac+.csv": f"{line}\rrow",
        "marked.csv": "﻿" + line + "\n", "longer.csv": line + ",more\n", "shorter.csv": line[:-1] + "\n", "late.csv": "\n" + line,
        "empty.csv": "", "marked_empty.csv": "﻿", "deep/er/a b%20.csv": f"{line}\n",
    }
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    good = {"plain.csv", "alone.csv", "windows.csv", "old mac+.csv", "marked.csv", "deep/er/a b%20.csv"}
    found = R.check_header(spark, str(tmp_path), K.ACCOUNT_HEADER).collect()
    assert len(found) == len(files) and sum(r["status"] == "pass" for r in found) == len(good)
    for r in found:
        name = os.path.basename(r["path"])
        if "%" not in name:
            assert (r["status"] == "pass") == (name in good), name
    assert {r["status"] for r in R.check_header(spark, str(tmp_path), None).collect()} == {"not_applicable"}


def test_bytes_read_do_not_grow_with_the_files(spark, tmp_path):
    line = ",".join(K.ACCOUNT_HEADER)
    for k, rows in enumerate((1, 1000, 100_000)):
        (tmp_path / f"f{k}.csv").write_text(f"{line}\n" + "1,2,3,4,5\n" * rows)
    heads = R.leading_bytes(R.file_list(spark, str(tmp_path)), 64).collect()
    assert {len(r["head"]) for r in heads} == {64}
    plan = R.check_header(spark, str(tmp_path), K.ACCOUNT_HEADER)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text and "FileScan text" not in text  # the listing and the heads, no file content
    assert [r["status"] for r in plan.collect()] == ["pass"] * 3


def test_inventory_of_known_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name, size in (("a/HI-x.csv", 3), ("b.TXT", 2_000_000), ("c.parquet", 10), ("d", 0)):
        (tmp_path / name).write_bytes(b"x" * size)
    rows = {r["file"]: (r["bytes"], r["mb"]) for r in R.source_inventory(spark, str(tmp_path)).collect()}
    assert rows == {"HI-x.csv": (3, "0.00"), "b.TXT": (2_000_000, "1.91"), "c.parquet": (10, "0.00"), "d": (0, "0.00")}
    found = R.forbidden_files(R.source_inventory(spark, str(tmp_path)), max_mb=1).first()
    assert (found["file_count"], found["bad_file_count"], found["status"]) == (4, 3, "FAIL")
