"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A benchmark item gives windows of ``size`` consecutive words (a shorter item gives one window).  The
shingles of a window are its pairs of neighbouring words.  All of them must occur in a document that
holds the window, so one shingle is the necessary prefix: the rarest one by its count over the
whole corpus.  Windows with a shingle that never occurs are dropped.  Document shingles meet the
prefix shingles in a hash join; the shingle's place in the window fixes where the window must start
(positional bound), the text must be long enough for it (length bound), and the words of the texts
that remain are then compared exactly.

The benchmark side is broadcast only up to a stated number of rows (:func:`common.bounded`); beyond that the join is left
to Spark, which shuffles and splits skewed keys.

Null texts have no words.  Repeated documents give repeated results.  Items with equal ids are one
item; a null id counts as the text ``null``.  An empty benchmark hits nothing.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import ascii_lower, bounded, id_text
from riskweave.session import staged

BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def item_words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Hashes of the pairs of neighbouring words; a single word is its own shingle."""
    m = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(words, F.lit(1), m).alias("a"), F.slice(words, F.lit(2), m).alias("b"))
    return F.when(F.size(words) == 1, F.transform(words, lambda w: F.xxhash64(w))).otherwise(
        F.transform(pairs, lambda g: F.xxhash64(g["a"], g["b"]))
    )


def item_windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(window, items): the distinct word windows and the sorted ids, as text, of the items that have them."""
    words = id_text(benchmark, id_col, text_col).select(
        F.coalesce(F.col("_id").cast("string"), F.lit("null")).alias("item"), item_words(F.col("_text")).alias("words")
    ).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        words.select("item", "words", F.explode(starts).alias("at"))
        .select("item", F.slice("words", F.col("at"), F.least(F.lit(size), F.size("words"))).alias("window"))
        .groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _document_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).select(
        "_id", F.xxhash64("_text").alias("_hash"), item_words(F.col("_text")).alias("_words")
    )


def _places(words: DataFrame, singles: bool, *kept: str) -> DataFrame:
    """(kept columns, at, shingle): every shingle with its place; single words too where windows need them."""
    pairs = words.select(*kept, F.posexplode(shingles(F.col("_words"))).alias("at", "shingle"))
    if not singles:
        return pairs
    longer = words.filter(F.size("_words") > 1)
    return pairs.unionByName(
        longer.select(*kept, F.posexplode(F.transform("_words", lambda w: F.xxhash64(w))).alias("at", "shingle"))
    )


def prefix_index(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shingle, offset, window, items): each window under its rarest shingle, with that shingle's place."""
    placed = windows.select("window", F.posexplode(shingles(F.col("window"))).alias("offset", "shingle"))
    singles = not windows.filter(F.size("window") == 1).isEmpty()
    wanted = bounded(staged(placed.select("shingle").distinct(), "window-shingles"))
    seen = (
        _places(_document_words(docs, id_col, text_col), singles).join(wanted, "shingle")
        .groupBy("shingle").agg(F.count("*").alias("n"))
    )
    rarest = (
        placed.join(seen, "shingle", "left")
        .groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("r"))
        .filter(F.col("r.n") > 0)
    )
    return staged(
        rarest.join(windows, "window").select(F.col("r.shingle").alias("shingle"), F.col("r.offset").alias("offset"), "window", "items"),
        "window-prefixes",
    )


def find_windows(docs: DataFrame, index: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``_id``, ``_hash``, found) of the texts with a window; found is array<struct<start, window, items>>.

    Places of prefix shingles travel without the words of their text.  What passes the bounds is
    gathered by text, and only these texts are split again to compare the words.  ``start`` counts
    words from 1.
    """
    singles = not index.filter(F.size("window") == 1).isEmpty()
    words = _document_words(docs, id_col, text_col).withColumn("_n", F.size("_words"))
    start = F.col("at") - F.col("offset") + 1
    possible = (
        _places(words, singles, "_id", "_hash", "_n").join(bounded(index), "shingle")
        .filter((start >= 1) & (start + F.size("window") - 1 <= F.col("_n")))
        .groupBy("_id", "_hash").agg(F.collect_set(F.struct(start.alias("start"), "window", "items")).alias("possible"))
    )
    possible = staged(possible, "possible-windows")
    keys = bounded(possible.select(F.col("_id").alias("_i"), F.col("_hash").alias("_h")))
    some = id_text(docs, id_col, text_col).withColumn("_hash", F.xxhash64("_text"))
    some = some.join(keys, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")), "left_semi").alias("d")
    both = some.join(possible.alias("p"), F.col("d._id").eqNullSafe(F.col("p._id")) & (F.col("d._hash") == F.col("p._hash")))
    compared = both.select("d._id", "d._hash", "possible", item_words(F.col("_text")).alias("_words"))
    found = F.filter(
        "possible",
        lambda x: (x["start"] + F.size(x["window"]) - 1 <= F.size("_words"))
        & (F.slice("_words", x["start"], F.size(x["window"])) == x["window"]),
    )
    # stored before it is filtered: a filter here would be pushed down and split the texts again for each window
    told = staged(compared.select("_id", "_hash", found.alias("found")).dropDuplicates(["_id", "_hash"]), "compared-windows")
    return told.filter(F.size("found") > 0)


def _covered(spans: Column) -> Column:
    """Number of places covered by sorted (start, length) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(1).alias("next"))
    return F.aggregate(
        spans, zero,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(s["start"], acc["next"]))).alias("n"),
            F.greatest(acc["next"], s["start"] + s["length"]).alias("next"),
        ),
        lambda acc: acc["n"],
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """(id, ``_hash``, n_words, n_hit, items, spans) for every row of ``docs``.

    ``spans`` are the sorted (start, length) word spans of found windows, ``items`` the sorted ids of
    the items they belong to, as text.
    """
    windows = staged(item_windows(benchmark, size, item_col, "text"), "item-windows")
    index = prefix_index(docs, windows, id_col, text_col)
    found = F.col("found")
    hits = find_windows(docs, index, id_col, text_col).select(
        "_id", "_hash",
        F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.size(x["window"]).alias("length")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda x: x["items"])))).alias("items"),
    )
    base = _document_words(docs, id_col, text_col).select("_id", "_hash", F.size("_words").cast("long").alias("n_words")).alias("b")
    hits = hits.alias("h")
    joined = base.join(hits, F.col("b._id").eqNullSafe(F.col("h._id")) & (F.col("b._hash") == F.col("h._hash")), "left")
    return joined.select(
        F.col("b._id").alias(id_col), F.col("b._hash").alias("_hash"), "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
    )
