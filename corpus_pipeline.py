"""The corpus pipeline: five stages over ``documents``, each a stored table that the next one reads.

1. language identification: documents that the language models reject go;
2. near-duplicates (5-word shingles, similarity 0.8): one document of each group stays;
3. repeated byte strings: every byte of a string of 256 bytes that occurs elsewhere too is cut;
4. benchmark decontamination: documents that hold a window of 10 words of an item go;
5. byte-level BPE: token ids of every text, decoded again to prove the round trip.

Stages 1 to 4 return the columns of ``documents``.  Each learns and counts on the documents it is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import byte_bpe, decontaminate, language_id, near_dedup, suffix_dedup
from riskweave.llm.common import bounded, table
from riskweave.llm.queries import vocabulary
from riskweave.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

REPEAT_BYTES = 256  # about 50 words


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.recognised(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of one id are one document, of which one row stays."""
    groups = staged(near_dedup.near_duplicates(docs.select("doc_id", "text"), words_each=5, percent=80), "near-groups")
    removed = staged(groups.filter(~F.col("kept")).select("doc_id").distinct(), "near-removed")
    repeated = staged(
        groups.filter(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("k"))
        .filter("k > 1").select("doc_id"), "repeated-ids",
    )
    left = docs.join(bounded(removed), "doc_id", "left_anti")
    single = left.join(bounded(repeated), "doc_id", "left_anti")
    one_each = left.join(bounded(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(one_each).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = staged(suffix_dedup.removed_texts(docs.select("doc_id", "text"), REPEAT_BYTES).dropDuplicates(["_id", "_hash"]), "cut-texts")
    keys = bounded(cut.select("_id", "_hash")).alias("c")
    rows = docs.alias("d")
    whole = rows.join(keys, _same_row("c"), "left_anti")
    touched = rows.join(keys, _same_row("c"), "left_semi").alias("d").join(cut.alias("c"), _same_row("c"))
    replaced = {"text": F.col("c.kept_text"), "n_chars": F.length("c.kept_text").cast("long")}
    return whole.unionByName(touched.select(*[replaced.get(c, F.col(f"d.{c}")).alias(c) for c in docs.columns]))


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = staged(found.filter("n_hit > 0").select(F.col("doc_id").alias("_id"), "_hash").distinct(), "contaminated")
    return docs.alias("d").join(bounded(hit).alias("c"), _same_row("c"), "left_anti")


def _same_row(other: str) -> Column:
    """Id and text of a document row ``d`` are those that ``other`` names by ``_id`` and ``_hash``."""
    return F.col("d.doc_id").eqNullSafe(F.col(f"{other}._id")) & (F.xxhash64(F.col("d.text")) == F.col(f"{other}._hash"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, token_ids, round_trip)."""
    return byte_bpe.encoded_rows(docs, *vocabulary(), keep=["doc_id", "lang", "source"])


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", decontaminate_documents),
    ("byte_bpe", encode_texts),
]

ORACLE_SQL = None  # no stage can be written in SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
