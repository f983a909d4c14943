"""Periodic runs of words, found by joining suffix classes in the order of their common prefixes.

A run is a stretch of consecutive words with smallest period q, at least ``exponent`` periods and
``shortest`` words long, that no neighbouring word extends with that period.

* The suffixes of a text are sorted by doubling: ranks of their first 1, 2, 4, ... symbols, where a
  symbol is a window of as many words as two suffixes of a run share at least.  Windows that occur
  once in their text are told apart at once, so only repeated passages are sorted further.  The same
  ranks give the longest common prefix (LCP) of neighbours in that order.
* Neighbours are united by decreasing LCP: a union-find whose classes keep their places in order.
  Two places i < j that become adjacent in a class share exactly LCP words, so the words from i to
  j + LCP have period j - i and cannot grow to the right.  Where the distance is within the LCP this
  seeds a run, and the period is its smallest: a smaller one would have put a place between i and j
  earlier.  A seed that could grow to the left is the same run met later, and goes.

Texts are worked on in blocks of bounded size inside the tasks; nothing is shuffled.  Null texts have
no words.  Texts of any length are taken whole; a text is worked on by one task.  Repeated rows give
equal results, ties between runs are kept (all runs are listed by start, then period), an empty table
gives no row.  Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from riskweave.llm.common import byte_blocks, id_text

BLOCK = 2_000_000  # bytes of text worked on at once
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def least_prefix(exponent: int, shortest: int) -> int:
    """Words that the first two period starts of any wanted run share at least."""
    return max(1, min(max((exponent - 1) * q, shortest - q) for q in range(1, shortest + 1)))


def _window_classes(codes: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, class) of the windows of ``size`` words that occur twice or more in their text, by place.

    Fingerprints find them, the words themselves decide.
    """
    n = max(len(codes) - size + 1, 0)
    factor = np.random.default_rng(11).integers(1, 2**63, size + 1, dtype=np.uint64) | np.uint64(1)
    place = np.flatnonzero(owner[:n] == owner[size - 1 :][:n])
    if len(place) < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    mixed = owner[place].astype(np.uint64) * factor[size]
    for k in range(size):
        mixed += (codes[place + k].astype(np.uint64) + np.uint64(1)) * factor[k]
    mixed ^= mixed >> np.uint64(32)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    place = np.sort(place[order[twice]])
    columns = [codes[place + k] for k in range(size)] + [owner[place]]
    order = np.lexsort(columns)
    new = np.zeros(len(place), dtype=bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[order][1:] != column[order][:-1]
    found = np.empty(len(place), dtype=np.int64)
    found[order] = np.cumsum(new) - 1
    kept = np.bincount(found, minlength=1)[found] > 1
    return place[kept], found[kept]


def _sorted_suffixes(place: np.ndarray, kind: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, LCP in windows) of neighbours of one class in the order of their suffixes.

    ``place`` are the repeated windows by place, ``kind`` their classes, ``n`` the number of words.
    First and second are indexes into ``place``.
    """
    size = len(place)
    at = np.full(n + 1, -1, dtype=np.int64)
    at[place] = np.arange(size)
    rank = _first_of_equal(np.sort(kind))[np.argsort(np.argsort(kind, kind="stable"), kind="stable")]
    levels, step, tied = [rank], 1, np.arange(size)
    while len(tied):
        behind = place[tied] + step
        known = at[behind]
        second = np.where(known >= 0, rank[known], size + behind)
        order = np.lexsort((second, rank[tied]))
        tied, second = tied[order], second[order]
        head = rank[tied]
        split = np.concatenate(([True], (head[1:] != head[:-1]) | (second[1:] != second[:-1])))
        part = np.flatnonzero(split)[np.cumsum(split) - 1]  # index of the first of the new group
        rank = rank.copy()
        rank[tied] = head + part - _first_of_equal(head)
        levels.append(rank)
        tied = tied[np.bincount(part, minlength=len(part))[part] > 1]
        step *= 2
    order = np.argsort(rank)
    first, second = order[:-1], order[1:]
    one_class = levels[0][first] == levels[0][second]
    first, second = first[one_class], second[one_class]
    shared = np.zeros(len(first), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = at[place[first] + shared], at[place[second] + shared]
        shared += ((a >= 0) & (b >= 0) & (levels[k][a] == levels[k][b])).astype(np.int64) << k
    return first, second, shared


def _first_of_equal(values: np.ndarray) -> np.ndarray:
    """Index of the first of each stretch of equal values."""
    new = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, dtype=bool)
    return np.flatnonzero(new)[np.cumsum(new) - 1] if len(values) else np.zeros(0, dtype=np.int64)


def _united(first: list[int], second: list[int], lcp: list[int], place: list[int], exponent: int) -> list[tuple[int, int, int]]:
    """(i, j, LCP) of places that become adjacent within the LCP while classes unite, by decreasing LCP.

    A class is a sorted list of places; the smaller one goes into the larger one.
    """
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds = []

    def root(x: int) -> int:
        if x not in parent:
            parent[x], members[x] = x, [place[x]]
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b, shared in zip(first, second, lcp):
        a, b = root(a), root(b)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members.pop(b)
        parent[b] = a
        most = shared // (exponent - 1)
        slots = [bisect_left(large, x) for x in small]
        last = len(small) - 1
        for t, (x, slot) in enumerate(zip(small, slots)):
            if slot and (not t or slots[t - 1] != slot) and x - large[slot - 1] <= most:
                seeds.append((large[slot - 1], x, shared))
            if slot < len(large) and (t == last or slots[t + 1] != slot) and large[slot] - x <= most:
                seeds.append((x, large[slot], shared))
        if len(small) > 50:
            large += small
            large.sort()  # two sorted stretches: merged in linear time
        else:
            for x, slot in zip(reversed(small), reversed(slots)):
                large.insert(slot, x)
    return seeds


def find_runs(codes: np.ndarray, owner: np.ndarray, exponent: int = 4, shortest: int = 6) -> np.ndarray:
    """(start, length, period) of all runs in texts that follow each other, by start, then period.

    ``codes`` are numbers that stand for words, ``owner`` the text of each word, ascending.
    """
    size = least_prefix(exponent, shortest)
    place, kind = _window_classes(codes, owner, size)
    if not len(place):
        return np.zeros((0, 3), dtype=np.int64)
    first, second, lcp = _sorted_suffixes(place, kind, len(codes))
    lcp += size - 1
    # a class whose closest places are too far apart for its longest prefix seeds nothing
    classes = kind.max() + 1
    nearest, longest = np.full(classes, len(codes), dtype=np.int64), np.zeros(classes, dtype=np.int64)
    order = np.argsort(kind, kind="stable")
    inside = kind[order][1:] == kind[order][:-1]
    np.minimum.at(nearest, kind[order][1:][inside], np.diff(place[order])[inside])
    np.maximum.at(longest, kind[first], lcp)
    able = (exponent - 1) * nearest <= longest
    chosen = np.flatnonzero(able[kind[first]])
    chosen = chosen[np.argsort(-lcp[chosen], kind="stable")]
    seeds = _united(first[chosen].tolist(), second[chosen].tolist(), lcp[chosen].tolist(), place.tolist(), exponent)
    if not seeds:
        return np.zeros((0, 3), dtype=np.int64)
    i, j, shared = np.array(seeds, dtype=np.int64).T
    opening = (i == 0) | (owner[i - 1] != owner[i]) | (codes[i - 1] != codes[j - 1])
    long_enough = opening & (shared + j - i >= shortest)
    runs = np.stack([i, shared + j - i, j - i], axis=1)[long_enough]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def periodic_runs(
    docs: DataFrame, exponent: int = 4, shortest: int = 6, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row: its runs, and its words without their repetitions.

    A run counts from ``exponent`` (2 at least) periods and ``shortest`` words on.  ``collapsed`` are the
    words joined by one space, without those that some run contains after its first period.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, data, offsets in byte_blocks(batches, "_text", BLOCK):
            whole = data.tobytes()
            split = [whole[a:b].split() for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            sizes = np.array([len(x) for x in split], dtype=np.int64)
            words = np.empty(int(sizes.sum()), dtype=object)
            words[:] = [w for x in split for w in x]
            codes = pd.factorize(words)[0].astype(np.int64)
            owner, begin = np.repeat(np.arange(len(split)), sizes), np.concatenate(([0], np.cumsum(sizes)))
            runs = find_runs(codes, owner, exponent, shortest)
            edge = np.searchsorted(runs[:, 0], begin)
            change = np.zeros(len(codes) + 1, dtype=np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            kept = np.cumsum(change[:-1]) == 0
            touched = edge[1:] > edge[:-1]
            collapsed = [
                b" ".join(words[a:b][kept[a:b]].tolist() if hit else x)
                for x, hit, a, b in zip(split, touched.tolist(), begin.tolist(), begin[1:].tolist())
            ]
            start = runs[:, 0] - np.repeat(begin[:-1], np.diff(edge))
            listed = pa.ListArray.from_arrays(
                pa.array(edge, pa.int32()),
                pa.StructArray.from_arrays([pa.array(start), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(RUN)),
            )
            yield pa.RecordBatch.from_arrays(
                [block.column("_id"), pa.array(sizes), listed, pa.array(collapsed, pa.binary()).cast(pa.string())],
                [id_col, "n_words", "runs", "collapsed"],
            )

    schema = f"`{id_col}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(run, schema)
