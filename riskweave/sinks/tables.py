"""Writing layers, metrics, published tables and display tables."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweave.functions.columns import tsv_cell
from riskweave.operators.profiling import table_counts
from riskweave.session import child_paths, remove_path


def write_layer(df: DataFrame, root: str, name: str, run_id: str, csv: bool = False,
                order: list[str] | None = None) -> str:
    """Parquet (and optionally CSV) of one layer table under its run partition.

    ``order`` range-partitions and sorts: a global order without a single-task sort.
    Re-running a run replaces only that run's folder.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    path = f"{root}/{name}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    if csv:
        df.write.mode("overwrite").option("header", True).option("lineSep", "\n").csv(
            f"{root}/{name}_csv/run_id={run_id}"
        )
    return f"{root}/{name}"


def write_metrics(df: DataFrame, path: str, columns: list[str], fmt: str = "tsv") -> None:
    """A metric table as one TSV (cells cleaned, missing columns blank) or JSON file."""
    cells = [(tsv_cell(c) if c in df.columns else F.lit("")).alias(c) for c in columns]
    # metric tables hold tens of rows, so one file is the useful form
    if fmt == "json":
        df.coalesce(1).write.mode("overwrite").json(path)
    else:
        df.select(*cells).coalesce(1).write.mode("overwrite").option("sep", "\t").option(
            "header", True
        ).option("emptyValue", "").csv(path)


def publish_tables(
    spark: SparkSession, tables: dict[str, DataFrame], database: str | None = None,
    fmt: str = "parquet", expected: dict[str, int] | None = None, location: str | None = None,
) -> DataFrame:
    """Replace each table, then report (table, count[, expected, status]).

    The rows of a table are written whole to a new folder first; then one catalog change points the
    table there.  Readers meet the old rows or the new ones, and a write that fails changes nothing.
    ``location`` is a root folder for the files; by default a folder of the warehouse.
    """
    names = {n: f"{database}.{n}" if database else n for n in tables}
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    root = location or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/published"
    for name, df in tables.items():
        folder = f"{root}/{names[name]}"
        version = f"{folder}/version={uuid.uuid4().hex}"
        df.write.format(fmt).save(version)
        former = swap_location(spark, names[name], version, fmt)
        # readers that began before the change still have the former files
        for old in child_paths(spark, folder):
            if not _same_place(old, version) and not (former and _same_place(old, former)):
                remove_path(spark, old)
    return table_counts({n: spark.table(full) for n, full in names.items()}, expected)


def _same_place(a: str, b: str) -> bool:
    return urlparse(a).path.rstrip("/") == urlparse(b).path.rstrip("/")


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def swap_location(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> str | None:
    """Point a table at the files under ``path``; returns the folder it pointed at, None for a new table.

    With the columns of before this is one catalog change.  A table whose columns changed is created
    anew over files that are already there.
    """
    create = f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'"
    if not spark.catalog.tableExists(name):
        spark.sql(create)
        return None
    former = table_location(spark, name)
    if spark.table(name).dtypes == spark.read.format(fmt).load(path).dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(create)
    return former


def olap_load_accounts(ads: DataFrame, path: str) -> None:
    """Replace the display accounts: month partitions, sorted by account and score."""
    (
        ads.withColumn("yyyymm", F.date_format("updated_at", "yyyyMM"))
        .repartitionByRange("yyyymm", "account_number")
        .sortWithinPartitions("yyyymm", "account_number", "risk_score_rule")
        .write.mode("overwrite").partitionBy("yyyymm").parquet(path)
    )


def olap_load_events(events: DataFrame, path: str, ingested_at: Column | None = None) -> None:
    """Replace the display events, sorted by run, account and transaction."""
    now = F.current_timestamp() if ingested_at is None else ingested_at
    keys = ["run_id", "event_account", "transaction_id"]
    (
        events.withColumn("ingested_at", now)
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .write.mode("overwrite").parquet(path)
    )
