"""Raw CSV and text files: positional columns, malformed rows set aside, line typing."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from riskweave import constants as K, schemas as S
from riskweave.functions.columns import strip
from riskweave.session import staged

# the function that opens files travels inside the task
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CORRUPT = "_corrupt"
_FILE, _BLOCK, _SEQ = "_file", "_block", "_seq"
MAX_BROADCAST_SPLITS = 100_000


def _read_positional(
    spark: SparkSession, path: str, columns: list[str], multiline: bool
) -> DataFrame:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (
        spark.read.schema(schema)
        .option("header", True)          # skip the header line ...
        .option("enforceSchema", True)   # ... and map by position: one name occurs twice
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # count the fields even when few are selected
        .option("multiLine", multiline)
        .option("quote", '"').option("escape", '"')
        .option("nullValue", "\u0000").option("emptyValue", "")
        .csv(path)
        .withColumn(_FILE, F.col("_metadata.file_path"))
        .withColumn(_BLOCK, F.col("_metadata.file_block_start"))
    )


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed rows) by field count.

    The length test is always true; it keeps a second column in the scan because Spark
    refuses to read the corrupt-record column alone.
    """
    first = df.columns[0]
    read = F.length(F.coalesce(F.col(first), F.lit(""))) >= 0
    good = df.filter(F.col(CORRUPT).isNull() & read).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull() & read)
    return good, bad


def _trimmed(df: DataFrame, columns: list[str]) -> DataFrame:
    keep = [c for c in df.columns if c not in columns]
    return df.select(*[F.coalesce(strip(c), F.lit("")).alias(c) for c in columns], *keep)


def read_transactions_csv(
    spark: SparkSession, path: str, multiline: bool = False
) -> DataFrame:
    """The 11 raw transaction columns as trimmed text, plus position and corrupt marker."""
    return _trimmed(_read_positional(spark, path, S.ODS_COLUMNS, multiline), S.ODS_COLUMNS)


def read_accounts_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The 5 raw account columns as trimmed text, plus position and corrupt marker."""
    return _trimmed(_read_positional(spark, path, S.ACCOUNT_COLUMNS, multiline), S.ACCOUNT_COLUMNS)


def with_file_sequence(good: DataFrame, name: str = _SEQ) -> DataFrame:
    """Dense 1-based row number in (file, offset) order, without shuffling the rows.

    The rows are parsed and written once with their position inside the input split.  The
    written table fixes the splits: planning the scan twice could cut files differently
    when executors come or go.  A row's number is its position plus the rows of all earlier
    splits; those offsets hold one row per split.
    """
    keyed = staged(good.withColumn("_mid", F.monotonically_increasing_id()), "sequenced")
    per_split = keyed.groupBy(_FILE, _BLOCK).agg(
        F.count("*").alias("_n"), F.min("_mid").alias("_first")
    )
    earlier = Window.orderBy(_FILE, _BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_split.select(
        _FILE, _BLOCK,
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    offsets = staged(offsets, "split-offsets")
    if offsets.count() <= MAX_BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    return (
        keyed.join(offsets, [_FILE, _BLOCK])
        .withColumn(name, F.col("_mid") + F.col("_shift"))
        .drop("_mid", "_shift")
    )


def type_pattern_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Classify pattern lines: ``kind`` is begin, end, transaction or other.

    ``pattern_type`` is set on begin lines and ``label`` on transaction lines.
    """
    clean = lines.withColumn("line", strip(F.regexp_replace(text, "^﻿", ""))).filter(
        F.col("line") != ""
    )
    line = F.col("line")
    # quoted commas are rare: only such lines pay for the CSV parser
    names = ", ".join(f"c{i} STRING" for i in range(len(S.ODS_COLUMNS) + 1))
    parsed = F.from_csv(line, names, {"mode": "PERMISSIVE"})
    plain = F.split(line, ",")
    width = len(S.ODS_COLUMNS)
    quoted = line.contains('"')
    full = F.when(
        quoted,
        parsed[f"c{width - 1}"].isNotNull() & parsed[f"c{width}"].isNull()
    ).otherwise(F.size(plain) == width)
    last = strip(
        F.when(quoted, parsed[f"c{width - 1}"]).otherwise(F.try_element_at(plain, F.lit(width)))
    )
    begin, end = line.startswith(K.PATTERN_BEGIN), line.startswith(K.PATTERN_END)
    is_tx = ~begin & ~end & full & last.isin("0", "1")
    kind = (
        F.when(begin, "begin").when(end, "end").when(is_tx, "transaction").otherwise("other")
    )
    head = F.substring_index(line, ":", 1)
    name = strip(F.replace(head, F.lit(K.PATTERN_BEGIN + " -"), F.lit("")))
    return clean.select(
        *[c for c in lines.columns if c != text],
        line,
        kind.alias("kind"),
        F.when(begin, name).alias("pattern_type"),
        F.when(is_tx, last).alias("label"),
    )


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    return type_pattern_lines(spark.read.text(path))


def source_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, bytes, mb) of every file below ``path``; contents are never read."""
    return file_list(spark, path, glob).select("file", "bytes", "mb")


def file_list(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, file, bytes, mb) of every file below ``path``, from the listing alone."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(path)
    # the scan leaves empty files out; the listing that planned it has them
    names = [re.sub("^file:/+", "file:/", unquote(name)) for name in found.inputFiles()]
    listed = spark.createDataFrame([(name,) for name in names], "path string")
    files = listed.join(found.select("path", "length"), "path", "left")
    return files.withColumn("bytes", F.coalesce("length", F.lit(0).cast("long"))).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file"), "bytes",
        F.format_string("%.2f", F.col("bytes") / 1024 / 1024).alias("mb"),
    )


# fixed values: file systems that Arrow opens in a task, by the scheme Spark knows them by
_ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs"}


def leading_bytes(files: DataFrame, size: int) -> DataFrame:
    """(path, head): the first ``size`` bytes of every file, however long it is; tasks read them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for path in batch.column("path").to_pylist():
                scheme, _, rest = path.partition(":")
                place = "/" + rest.lstrip("/") if scheme == "file" else "//" + rest.lstrip("/")
                uri = f"file://{quote(place)}" if scheme == "file" else f"{_ARROW_SCHEMES[scheme]}:{place}"
                store, name = FileSystem.from_uri(uri)
                with store.open_input_file(name) as stream:
                    heads.append(stream.read(size))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(heads, pa.binary())], ["path", "head"])

    return files.select("path").mapInArrow(read, "path string, head binary")


def check_header(spark: SparkSession, path: str, expected: list[str] | None) -> DataFrame:
    """(path, status) of every file: pass, fail, or not_applicable when nothing is expected.

    A file without a line fails.  Only as many bytes of a file are read as the expected line can have;
    on a store that tasks cannot open themselves Spark reads the lines.
    """
    files = file_list(spark, path).select("path")
    if expected is None:
        return files.withColumn("status", F.lit("not_applicable"))
    wanted = ",".join(expected).encode()
    schemes = {r[0] for r in files.select(F.substring_index("path", ":", 1)).distinct().collect()}
    if schemes <= set(_ARROW_SCHEMES):
        mark, head = b"\xef\xbb\xbf", F.col("head")
        found = leading_bytes(files, len(mark) + len(wanted) + 1)
        same = [
            F.startswith(head, F.lit(start + wanted)) & (
                (F.length(head) == len(start + wanted))
                | F.substring(head, len(start + wanted) + 1, 1).isin(F.lit(b"\n"), F.lit(b"\r"))
            )
            for start in (b"", mark)
        ]
        line = F.length(head) > 0
        return found.select("path", F.when(line & (same[0] | same[1]), "pass").otherwise("fail").alias("status"))
    # the first line of a file sits in the split that starts at byte 0
    first = (
        spark.read.option("recursiveFileLookup", True).text(path)
        .withColumns({"path": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_block_start")})
        .filter(F.col("_at") == 0)
        .withColumn("_i", F.monotonically_increasing_id())
        .groupBy("path").agg(F.min_by("value", "_i").alias("value"))
    )
    fields = F.split(F.regexp_replace(F.col("value"), "^\ufeff|\r$", ""), ",")
    same_line = fields == F.array(*[F.lit(name) for name in expected])
    return files.join(first, "path", "left").select(
        "path", F.when(F.coalesce(same_line, F.lit(False)), "pass").otherwise("fail").alias("status"),
    )


def forbidden_files(
    inventory: DataFrame, max_mb: float = 5, extensions: tuple[str, ...] = ("parquet",),
    name_pattern: str = K.RAW_FILE_PATTERN,
) -> DataFrame:
    """Count files that are too big, look like raw inputs or have a barred extension."""
    extension = F.lower(F.element_at(F.split("file", "\\."), -1))
    bad: Column = (
        (F.col("bytes") > max_mb * 1024 * 1024)
        | F.col("file").rlike("(?i)" + name_pattern)
        | (F.col("file").contains(".") & extension.isin(*extensions))
    )
    hits = F.count_if(bad)
    return inventory.agg(
        F.count("*").alias("file_count"), hits.alias("bad_file_count"),
        F.when(hits == 0, "PASS").otherwise("FAIL").alias("status"),
    )
