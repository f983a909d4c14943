"""Near-duplicate groups from bottom-k sketches of word shingles.

One hash function gives the shingles of a text; its ``k`` smallest values are the sketch.  Texts
with equal shingle sets form a class, and one row per class goes on.  Two sets of similarity t
share at least T of k values but for a chance of :data:`MISS`; T follows from the binomial
distribution (a set no larger than k is its own sketch, where the bound is exact).  So it is
enough to meet in one of the k - T + 1 values that are rarest over the corpus: these fill the
inverted lists, and a passage that many texts share fills none.

Long lists are lists of copies, so the pairs inside a list are not listed:

* Every member meets the centre of its list, the class with the fewest values of its own.  Union
  sketches filter these pairs, exact Jaccard on full sets verifies the best one of each class, and
  the links make components.
* Lists that still have several components are opened.  Every member is compared exactly with its
  centre and written as its difference to it.  Two members that are linked, and not both linked to
  the centre, share differing shingles: at least as many as their distances to the centre exceed
  their allowed distance.  A prefix-filtered join over differing shingles, rarest first, finds all
  such pairs, and the differences verify them.  No link between different texts is lost.

Null and blank texts have an empty set: they are linked with nothing.  Texts with fewer words than
a shingle have one shingle, the whole sequence.  Rows that share an id are one document; rows
without an id are linked with nothing and have a null component.  Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import ascii_lower, bounded, id_text, release_shuffles, words_of
from riskweave.session import staged

MISS = 2e-7


def shingle_set(text: Column, words_each: int) -> Column:
    """Sorted distinct 64-bit hashes of the ``words_each``-word shingles of a text."""
    return _set_of(words_of(ascii_lower(text)), words_each)


def _set_of(words: Column, words_each: int) -> Column:
    m = F.greatest(F.size(words) - words_each + 1, F.lit(0))
    zipped = F.arrays_zip(*[F.slice(words, F.lit(i + 1), m).alias(f"w{i}") for i in range(words_each)])
    many = F.transform(zipped, lambda g: F.xxhash64(*[g[f"w{i}"] for i in range(words_each)]))
    few = F.transform(F.array(F.array_join(words, " ")), lambda x: F.xxhash64(x))
    none = F.array().cast("array<bigint>")
    return F.sort_array(F.array_distinct(F.when(F.size(words) == 0, none).when(F.size(words) < words_each, few).otherwise(many)))


def needed_overlap(k: int, percent: int, miss: float = MISS) -> int:
    """The most shared values that two sketches of similar sets have, but for a chance of ``miss``."""
    t, below = percent / 100, 0.0
    for shared in range(k + 1):
        below += comb(k, shared) * t**shared * (1 - t) ** (k - shared)
        if below > miss:
            return shared
    return k


def sketches(docs: DataFrame, words_each: int, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``_id``, n, fp, sketch) for every row; ``fp`` stands for the whole set (128 bits)."""
    return (
        id_text(docs, id_col, text_col)
        .withColumn("_words", words_of(ascii_lower(F.col("_text"))))
        .withColumn("_set", _set_of(F.col("_words"), words_each))
        .select(
            "_id", F.size("_set").cast("long").alias("n"),
            F.struct(F.xxhash64("_set").alias("x"), F.xxhash64(F.lit(1), "_set").alias("y")).alias("fp"),
            F.slice("_set", 1, k).alias("sketch"),
        )
    )


def inverted_lists(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(v, node, n, own): the necessary rare values of each class that at least one other class has too.

    ``own`` is the share of the sketch that no other class has.
    """
    need = needed_overlap(k, percent)
    size = F.size("sketch")
    must = F.least(F.lit(need), F.ceil(F.lit(percent) * F.col("n") / 100).cast("int"))
    values = classes.select("node", "n", size.alias("s"), (size - must + 1).alias("p"), F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("c")).filter("c > 1")
    ordered = values.join(shared, "v").groupBy("node", "n", "s", "p").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("cv"))
    # values that no other class has come first in the order by rarity
    left = F.greatest(F.col("p") - (F.col("s") - F.size("cv")), F.lit(0))
    own = (F.col("s") - F.size("cv")) / F.col("s")
    return ordered.select("node", "n", own.alias("own"), F.explode(F.slice("cv", F.lit(1), left)).alias("cv")).select("cv.v", "node", "n", "own")


def list_centres(lists: DataFrame) -> DataFrame:
    """(v, c): the centre of each list of two or more, the class with the fewest values of its own."""
    least = F.min(F.struct("own", "node"))["node"]
    return lists.groupBy("v").agg(least.alias("c"), F.count("*").alias("k")).filter("k > 1").select("v", "c")


def centre_pairs(lists: DataFrame, centres: DataFrame) -> DataFrame:
    """(a, b): every list member with the centre of its list; as many rows as the lists have at most."""
    both = lists.select("v", "node").join(centres, "v").filter("node <> c")
    return both.select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()


def open_members(lists: DataFrame, centres: DataFrame, labels: DataFrame) -> DataFrame:
    """(c, node, label): members other than the centre of the lists that still have several components."""
    named = lists.select("v", "node").join(centres, "v").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = named.groupBy("v").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("v")
    return named.join(mixed, "v", "left_semi").filter("node <> c").select("c", "node", "label").distinct()


def _allowed(sizes: Column, percent: int) -> Column:
    """The largest symmetric difference of linked sets of so many shingles together."""
    return F.floor(sizes * (100 - percent) / (100 + percent))


def differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(c, node, label, size, centre_size, d): each member's symmetric difference to its centre."""
    own = sets.select(F.col("_id").alias("node"), F.col("set").alias("a"))
    centre = sets.select(F.col("_id").alias("c"), F.col("set").alias("b"))
    both = members.join(own, "node").join(centre, "c")
    apart = F.concat(F.array_except("a", "b"), F.array_except("b", "a"))
    return both.select("c", "node", "label", F.size("a").alias("size"), F.size("b").alias("centre_size"), apart.alias("d"))


def difference_pairs(apart: DataFrame, percent: int) -> DataFrame:
    """(c, a, b): pairs of one centre in different components that pass the prefix test on differences.

    With t the allowed difference of the pair, linked members share at least
    ``(|da| + |db| - t) / 2`` elements of their differences, so the first one they share, rarest
    first, has a rank of at most ``(|da| - |db| + t) / 2 + 1`` in a and likewise in b.
    """
    each = apart.select("c", "node", "label", "size", F.size("d").alias("nd"), F.explode("d").alias("e"))
    shared = each.groupBy("c", "e").agg(F.count("*").alias("k")).filter("k > 1")
    ranked = (
        each.join(shared, ["c", "e"]).groupBy("c", "node", "label", "size", "nd")
        .agg(F.sort_array(F.collect_list(F.struct("k", "e"))).alias("ke"))
        .select("c", "node", "label", "size", "nd", F.size("ke").alias("m"), F.posexplode("ke").alias("i", "ke"))
    )
    # elements that no other member has come first; no partner reaches a rank over its allowed difference + 1
    most = _allowed(F.col("size") * (1 + 100 / percent), percent) + 1
    rows = staged(
        ranked.select("c", "node", "label", "size", "nd", F.col("ke.e").alias("e"), (F.col("nd") - F.col("m") + F.col("i") + 1).alias("rank"))
        .filter(F.col("rank") <= most), "difference-ranks",
    )
    x, y = rows.alias("x"), rows.alias("y")
    allowed = _allowed(F.col("x.size") + F.col("y.size"), percent)
    met = x.join(
        y,
        (F.col("x.c") == F.col("y.c")) & (F.col("x.e") == F.col("y.e")) & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.label") != F.col("y.label"))
        & (2 * (F.col("x.rank") - 1) <= F.col("x.nd") - F.col("y.nd") + allowed)
        & (2 * (F.col("y.rank") - 1) <= F.col("y.nd") - F.col("x.nd") + allowed),
    )
    return met.select(F.col("x.c").alias("c"), F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def difference_links(pairs: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs that are similar enough, computed from their differences to the centre."""
    one = apart.select("c", F.col("node").alias("a"), F.col("size").alias("sa"), F.col("d").alias("da"))
    other = apart.select("c", F.col("node").alias("b"), F.col("size").alias("sb"), F.col("d").alias("db"))
    both = pairs.join(one, ["c", "a"]).join(other, ["c", "b"])
    distance = F.size("da") + F.size("db") - 2 * F.size(F.array_intersect("da", "db"))
    return both.filter(distance <= _allowed(F.col("sa") + F.col("sb"), percent)).select("a", "b").distinct()


def estimated(pairs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b, shared) of the pairs whose union sketch allows the similarity.

    The union's sketch is the k smallest values of both sketches.  Where both sketches are whole
    sets the test is exact; else the number of shared values must reach the needed overlap.
    """
    need = needed_overlap(k, percent)
    side = classes.select("node", "sketch")
    both = (
        pairs.join(side.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
        .join(side.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b")
    )
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    whole = (F.size("sa") < k) & (F.size("sb") < k)
    shared = F.when(whole, F.size(F.array_intersect("sa", "sb"))).otherwise(
        F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    )
    size = F.size(F.array_union("sa", "sb"))
    passes = F.when(whole, 100 * F.col("shared") >= percent * F.col("size")).otherwise(F.col("shared") >= F.least(F.lit(need), F.col("size")))
    return both.withColumn("shared", shared).withColumn("size", size).filter(passes).select("a", "b", "shared")


def full_sets(nodes: DataFrame, docs: DataFrame, words_each: int, id_col: str, text_col: str) -> DataFrame:
    """(``_id``, set) of the classes in ``nodes`` (``_id``), made anew from their texts."""
    return (
        id_text(docs, id_col, text_col).join(bounded(nodes), "_id", "left_semi")
        .withColumn("_words", words_of(ascii_lower(F.col("_text"))))
        .select("_id", _set_of(F.col("_words"), words_each).alias("set"))
    )


def verified(pairs: DataFrame, docs: DataFrame, words_each: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(a, b) of the pairs whose full sets are similar enough."""
    sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("_id"))
    sets = full_sets(staged(sides.select("_id").distinct(), "paired-classes"), docs, words_each, id_col, text_col)
    both = sides.join(sets, "_id").groupBy("a", "b").agg(
        F.collect_set(F.when(F.col("_id") == F.col("a"), F.col("set"))).alias("left"),
        F.collect_set(F.when(F.col("_id") == F.col("b"), F.col("set"))).alias("right"),
    )
    left, right = F.array_min("left"), F.array_min("right")
    shared = F.size(F.array_intersect(left, right))
    return both.filter(100 * shared >= percent * (F.size(left) + F.size(right) - shared)).select("a", "b")


def best_pairs(pairs: DataFrame) -> DataFrame:
    """For each class its pair with the most shared values."""
    each = pairs.select("a", "b", "shared", F.explode(F.array("a", "b")).alias("node"))
    best = each.groupBy("node").agg(F.max(F.struct("shared", "a", "b")).alias("p"))
    return best.select("p.a", "p.b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``links`` (a, b): the label is the smallest node that can be reached.

    Smallest label of the neighbours, then the label of the label, until nothing changes.  Every round
    is a stored table, so a lost executor costs one round at most.
    """
    edges = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        lower = staged(lower, "lower-labels")
        heads = lower.select(F.col("node").alias("label"), F.col("label").alias("head"))
        after = staged(
            lower.join(heads, "label", "left").select("node", F.least("label", F.coalesce("head", "label")).alias("label"), "old"), "labels"
        )
        labels = after.select("node", "label")
        if after.filter("label < old").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame, words_each: int = 5, percent: int = 80, k: int = 48, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked when ``100 * |intersection| >= percent * |union|``; ``component_id`` is the
    smallest id of the linked group, ``kept`` marks the document of that id.
    """
    rows = staged(sketches(docs, words_each, k, id_col, text_col), "sketches")
    classes = staged(
        rows.filter("n > 0 AND _id IS NOT NULL").groupBy("fp")
        .agg(F.min("_id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "classes",
    )
    lists = staged(inverted_lists(classes, k, percent), "inverted-lists")
    centres = staged(list_centres(lists), "list-centres")
    pairs = staged(best_pairs(estimated(centre_pairs(lists, centres), classes, k, percent)), "centre-pairs")
    first = staged(verified(pairs, docs, words_each, percent, id_col, text_col), "first-links")
    labels = components(first)
    release_shuffles(docs.sparkSession)
    members = staged(open_members(lists, centres, labels), "open-members")
    nodes = staged(members.select(F.explode(F.array("node", "c")).alias("_id")).distinct(), "open-classes")
    one_set = full_sets(nodes, docs, words_each, id_col, text_col).groupBy("_id").agg(F.min("set").alias("set"))
    apart = staged(differences(members, staged(one_set, "open-sets")), "differences")
    near = apart.filter(F.size("d") <= _allowed(F.col("size") + F.col("centre_size"), percent))
    direct = near.select(F.least("c", "node").alias("a"), F.greatest("c", "node").alias("b"))
    second = staged(direct.unionByName(difference_links(difference_pairs(apart, percent), apart, percent)), "second-links")
    if not second.isEmpty():
        labels = components(first.unionByName(second))
    release_shuffles(docs.sparkSession)
    found = classes.select("fp", "node").join(labels, "node", "left").select("fp", F.coalesce("label", "node").alias("label"))
    same_id = reduce(lambda x, y: x & y, [F.col("m.fp.x") == F.col("c.fp.x"), F.col("m.fp.y") == F.col("c.fp.y")])
    return (
        rows.select("_id", "n", "fp").alias("m").join(found.alias("c"), same_id, "left")
        .select(
            F.col("m._id").alias(id_col), F.col("m.n").alias("n_shingles"),
            F.when((F.col("m.n") == 0) | F.col("m._id").isNull(), F.col("m._id")).otherwise(F.col("c.label")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )
