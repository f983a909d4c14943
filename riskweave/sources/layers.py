"""Reading earlier layers, catalog tables, runs and JSON-line events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_dwd(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet layer, pruned to ``columns`` at the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_layer_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, columns: list[str] | None = None
) -> DataFrame:
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by (multi-part) name, or ``parquet.`path``` directly."""
    return spark.table(name) if not name.startswith("parquet.`") else spark.sql(f"SELECT * FROM {name}")


def register_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} USING parquet OPTIONS (path '{path}')"
    )
    return spark.table(name)


def latest_run(
    df: DataFrame, prefix: str = "", predicate: Column | None = None, run_col: str = "run_id"
) -> DataFrame:
    """Rows of the newest run whose id starts with ``prefix``.

    Run ids carry a sortable stamp.  The newest id is a scalar subquery, so on a table
    partitioned by run only that partition is read.  ``predicate`` marks the rows that
    qualify a run (for example: no invalid events).
    """
    runs = df.filter(F.col(run_col).startswith(prefix)) if prefix else df
    if predicate is not None:
        runs = runs.filter(predicate)
    return df.filter(F.col(run_col) == runs.agg(F.max(run_col)).scalar())


def decodable(raw: Column) -> Column:
    """True for a text that is exactly one JSON object.

    The parser stops after the first value; inside brackets, trailing text is an error and
    a second object becomes a second element.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]")))
    alone = F.try_variant_get(wrapped, "$[1]", "variant").isNull()
    return raw.startswith("{") & wrapped.isNotNull() & alone


def parse_events(lines: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """JSON lines to columns; blank, non-object and undecodable lines disappear.

    A field of the wrong type becomes NULL while its row is kept.
    """
    raw = F.trim(F.col(text))
    data = F.from_json(raw, schema, {"mode": "PERMISSIVE"})
    keep = [c for c in lines.columns if c != text]
    return (
        lines.filter(decodable(raw))
        .select(*keep, data.alias("_event"))
        .select(*keep, "_event.*")
    )


def read_jsonl_events(
    spark: SparkSession, path: str, schema: T.StructType, run_id: str | None = None
) -> DataFrame:
    events = parse_events(spark.read.text(path), schema)
    return events if run_id is None else events.filter(F.col("run_id") == run_id)


def read_raw_events(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Object lines kept as raw text (column ``value``) for contract checks."""
    raw = spark.read.text(path).select(F.trim("value").alias("value"))
    kept = raw.filter(decodable(F.col("value")))
    if run_id is not None:
        kept = kept.filter(F.get_json_object("value", "$.run_id") == run_id)
    return kept
