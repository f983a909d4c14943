"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Base counts of every whole text (:func:`base_counts`), then named rules, each a boolean column that
rejects.  The cost and the share rejected of every rule are measured on a bounded sample; rules
run in the order of rejection per cost and a text leaves at the first rule that rejects it.  The
order changes the time only, never the verdict.

Null and empty texts have no words: all counts are 0 and the base rule rejects them.  Repeated rows
give repeated results; only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import id_text, words_of
from riskweave.session import staged

WORD = "[^\\x20\\x09-\\x0D]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean column over ``_text``, ``_words`` and the base counts."""

    name: str
    rejects: Column


def _shift(array: Column, start: int, size: Column) -> Column:
    return F.slice(array, F.lit(start), F.greatest(size, F.lit(0)))


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, first occurrence included.

    Windows are sorted with their positions, equal neighbours mark the repeated ones, and the marked
    positions in order give the number of covered words.  No step is quadratic in the text.
    """
    m = F.size(words) - 2
    grams = F.transform(
        F.arrays_zip(_shift(words, 1, m).alias("a"), _shift(words, 2, m).alias("b"), _shift(words, 3, m).alias("c")),
        lambda g, i: F.struct(F.xxhash64(g["a"], g["b"], g["c"]).alias("g"), i.alias("i")),
    )
    sorted_grams = F.array_sort(grams)
    before = F.concat(F.array(F.lit(None).cast("struct<g:bigint,i:int>")), F.slice(sorted_grams, F.lit(1), m - 1))
    after = F.concat(F.slice(sorted_grams, F.lit(2), m - 1), F.array(F.lit(None).cast("struct<g:bigint,i:int>")))
    marked = F.filter(
        F.arrays_zip(before.alias("p"), sorted_grams.alias("x"), after.alias("n")),
        lambda t: F.coalesce(t["x"]["g"] == t["p"]["g"], F.lit(False)) | F.coalesce(t["x"]["g"] == t["n"]["g"], F.lit(False)),
    )
    places = F.array_sort(F.transform(marked, lambda t: t["x"]["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    distinct = F.size(F.array_distinct(F.transform(grams, lambda g: g["g"])))
    return F.when((m < 2) | (distinct == m), F.lit(0)).otherwise(covered).cast("long")


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_text``, ``_words`` and the five counts of :data:`COUNTS` for every row."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return (
        id_text(docs, id_col, text_col)
        .withColumn("_words", words_of(F.col("_text")))
        .select(
            "_id", "_text", "_words",
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeat_words(F.col("_words")).alias("n_repeat_words"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Rules on symbols, repeated lines, letter case, word length and separators."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [
        Rule("symbols", F.col("n_symbols") > 0.2 * n),
        Rule("dup_lines", 2 * F.col("n_dup_lines") > F.size(F.split(F.coalesce("_text", F.lit("")), "\n"))),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
        Rule("upper_case", 2 * F.length(F.regexp_replace(F.coalesce("_text", F.lit("")), "[^A-Z]+", "")) > F.col("word_chars")),
        Rule("few_letters", F.size(F.filter("_words", lambda w: w.rlike("\\p{L}"))) < 0.5 * n),
    ]


def rule_costs(sample: DataFrame, rules: list[Rule], copies: int = 40, runs: int = 3) -> dict[str, tuple[float, float]]:
    """(share rejected, seconds) of every rule on ``sample``, stored rows of :func:`base_counts`.

    A rule is evaluated on many copies of the rows, and the time of the same job with a rule that does
    nothing is taken off: neither the counts nor the start of a job are part of its cost.
    """
    rows = sample.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))

    def job(test: Column) -> tuple[float, float]:
        times, share = [], 0.0
        for _ in range(runs):
            start = time.perf_counter()
            share = rows.agg(F.avg(F.coalesce(test, F.lit(False)).cast("double"))).first()[0] or 0.0
            times.append(time.perf_counter() - start)
        return share, min(times)

    idle = job(F.col("_copy") < 0)[1]
    return {r.name: (share, max(seconds - idle, 1e-5)) for r in rules for share, seconds in [job(r.rejects)]}


def rule_order(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by share rejected per second, both measured on ``sample`` (stored rows of :func:`base_counts`)."""
    cost = rule_costs(sample, rules)
    return sorted(rules, key=lambda r: cost[r.name][0] / cost[r.name][1], reverse=True)


def cascade(counted: DataFrame, ordered: list[Rule]) -> Column:
    """The name of the first rule that rejects, else null; later rules are not evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(verdict)
    return verdict


def filter_quality(
    docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 500,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, counts, base_failed, kept) for every row.

    ``sample_rows`` rows, drawn by the hash of the id from the whole table, only serve the rule order.
    """
    rules = default_rules() if rules is None else rules
    drawn = id_text(docs, id_col, text_col).orderBy(F.xxhash64("_id")).limit(sample_rows)
    ordered = rule_order(staged(base_counts(drawn, "_id", "_text"), "rule-sample"), rules)
    counted = base_counts(docs, id_col, text_col).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(counted, ordered).isNull())
    return counted.select(F.col("_id").alias(id_col), *COUNTS, "base_failed", kept.alias("kept"))
