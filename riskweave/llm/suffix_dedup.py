"""Removal of byte strings that occur more than once, by difference-cover suffix buckets.

Every byte of a string of ``m`` bytes that starts anywhere else too, in the same or another text, is
removed.  Suffixes are never collected as text:

* A difference cover of period v gives the cover samples: places p of a text with ``p mod v`` in the
  cover.  For any two places there is one step below v that leads both to samples.  So a repeated
  string of m bytes holds samples whose first ``m - v + 1`` bytes repeat.  Samples are ranked by a
  fingerprint of these bytes, one bucket after the other; samples of a rank of their own are dropped.
* Long ties are resolved by ranks, not byte by byte: samples of one rank are split by the fingerprint
  of all bytes from v - 1 before the sample to m behind it.  Where two samples agree in both, all v
  starts up to each of them are repeated.
* A sample that agrees with no other of its rank sends the v starts up to it, and one sample of each
  agreeing group in its rank sends the same starts for the whole group.  These starts are
  sorted in buckets by the fingerprint of their whole m bytes.

A bucket holds about :data:`BUCKET_ENTRIES` entries whatever the input, and a task sends a fingerprint
once however often it has it, so a passage in a third of all texts costs one entry per message.
Fingerprints are polynomial hashes modulo 2^64 of random byte values.  The first pass sends 40 bits:
an accidental tie there only adds work.  Rows are told apart by 64 bits of id and text.

Null texts are empty.  Texts shorter than ``m`` lose nothing.  Repeated rows repeat each other and are
emptied (from ``m`` bytes on).  Input order does not matter.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import bounded, byte_blocks, co_located, give_back, id_text, process_cache, release_shuffles, small_batches
from riskweave.session import staged

PRIME = 13  # period 13^2 + 13 + 1 = 183, 14 samples in each
PASSAGE_PRIME = 7  # for passages: period 57, 8 samples in each
BUCKET_ENTRIES = 200_000
BLOCK = 1_000_000  # bytes hashed at once
SEND = 6_000_000  # bytes of text per message
MULTIPLIER = 0x9E3779B97F4A7C15
U = np.uint64
REPEATED, ODD, SPEAKER = 1, 2, 3

Places = Callable[..., tuple[np.ndarray, np.ndarray]]


def difference_cover(q: int = PRIME) -> tuple[int, tuple[int, ...]]:
    """The cover of :func:`_cover` for ``q``, computed once in a process."""
    kept = process_cache().setdefault("difference_covers", {})
    if q not in kept:
        kept[q] = _cover(q)
    return kept[q]


def _cover(q: int) -> tuple[int, tuple[int, ...]]:
    """Period ``q^2 + q + 1`` and a perfect difference set of ``q + 1`` numbers for a prime ``q``.

    The exponents of a generator of the field of q^3 elements whose powers lie in one plane.
    """
    def times_x(a: list[int], f: tuple[int, ...]) -> list[int]:
        return [a[2] * f[0] % q, (a[0] + a[2] * f[1]) % q, (a[1] + a[2] * f[2]) % q]

    for f in product(range(q), repeat=3):
        a, period = [0, 1, 0], 1
        while f[0] and a != [1, 0, 0] and period < q**3:
            a, period = times_x(a, f), period + 1
        if period == q**3 - 1:
            found, a = [], [1, 0, 0]
            for i in range(q * q + q + 1):
                if a[2] == 0:
                    found.append(i)
                a = times_x(a, f)
            return q * q + q + 1, tuple(found)
    raise ValueError(f"{q} is not prime")


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2^64, at least ``size`` of each."""
    kept = process_cache()
    if len(kept.get("powers", ((),))[0]) < size:
        size = max(size, BLOCK + 1)
        both = []
        for base in (MULTIPLIER, pow(MULTIPLIER, -1, 2**64)):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        kept["powers"] = tuple(both)
    return kept["powers"]


class Hashes:
    """Fingerprints of substrings of one byte array."""

    def __init__(self, data: np.ndarray):
        values = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=U)
        powers, self.inverse = _powers(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, dtype=U)
        np.cumsum(values[data] * powers[: len(data)], out=self.prefix[1:])

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        h = (self.prefix[places + length] - self.prefix[places]) * self.inverse[places]
        h ^= h >> U(32)
        h *= U(0xD6E8FEB86659FD93)
        return h ^ (h >> U(29))


def _listed(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of all distinct places of a column of lists, in order."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    place = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    both = np.unique((np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) << 32) | place)
    return both >> 32, both & 0xFFFFFFFF


def _cover_places(offsets: np.ndarray, length: int, q: int = PRIME) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in it) of all cover samples that have ``length`` bytes behind them."""
    period, cover = difference_cover(q)
    step = np.array(cover, dtype=np.int64)
    sizes = np.diff(offsets) - length + 1
    rounds = np.maximum(-(-sizes // period), 0)
    text = np.repeat(np.arange(len(sizes)), rounds * len(step))
    first = np.concatenate(([0], np.cumsum(rounds)))[:-1]
    turn = np.arange(rounds.sum()) - np.repeat(first, rounds)
    place = (turn[:, None] * period + step).ravel()
    inside = place < sizes[text]
    return text[inside], place[inside]


def _messages(key: np.ndarray, place: np.ndarray, h: np.ndarray, w: np.ndarray | None, buckets: int, width: int) -> Iterator[tuple]:
    """Messages (bucket, keys, counts, places, prints, wide, many) of one block, by fingerprint ``h``.

    Entries that the block has several times (equal ``h``, and equal ``w`` where given) go out once,
    marked in ``many``.  What is to be said of the others is known: they are repeated, or with ``w`` 0
    odd.  Their places go with a message without prints.
    """
    order = np.argsort(h, kind="stable") if w is None else np.lexsort((w, h))
    equal = h[order][1:] == h[order][:-1]
    if w is not None:
        equal &= w[order][1:] == w[order][:-1]
    again = np.concatenate(([False], equal))
    twice = again.copy()
    twice[:-1] |= equal
    many = np.zeros(len(h), dtype=bool)
    many[order[twice]] = True
    known = np.sort(order[again])
    odd = np.zeros(len(known), dtype=bool) if w is None else w[known] == 0
    for own, verdict in ((known[~odd], REPEATED), (known[odd], ODD)):
        if len(own):
            yield (int(key[own[0]] % buckets), *_packed(key[own], place[own]), b"", b"", bytes([verdict]))
    sent = np.sort(order[~again])
    bucket = ((h[sent] >> U(32)) * U(buckets)) >> U(32)
    by = np.argsort(bucket.astype(np.int64), kind="stable")
    edge = np.searchsorted(bucket[by], np.arange(buckets + 1, dtype=U))
    for b in np.flatnonzero(np.diff(edge)):
        own = sent[by[edge[b] : edge[b + 1]]]
        yield (
            int(b), *_packed(key[own], place[own]), _narrow(h[own], width),
            b"" if w is None else w[own].tobytes(), many[own].tobytes(),
        )


def _narrow(h: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each fingerprint; the highest ones chose the bucket."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _widened(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _packed(keys: np.ndarray, places: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Runs of equal keys with their lengths, and the places as steps inside a run (16 bits where they fit)."""
    start = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (places[1:] <= places[:-1]))))
    counts = np.diff(np.concatenate((start, [len(keys)])))
    steps = np.diff(places, prepend=0)
    steps[start] = places[start]
    small = steps.max() < 65536
    return keys[start].astype(np.int64).tobytes(), counts.astype(np.uint32).tobytes(), (b"\2" if small else b"\4") + steps.astype(np.uint16 if small else np.uint32).tobytes()


def _unpacked(keys: bytes, counts: bytes, steps: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, count = np.frombuffer(keys, dtype=np.int64), np.frombuffer(counts, dtype=np.uint32).astype(np.int64)
    step = np.frombuffer(steps[1:], dtype=np.uint16 if steps[:1] == b"\2" else np.uint32).astype(np.int64)
    total = np.cumsum(step)
    start = np.concatenate(([0], np.cumsum(count)))[:-1]
    return key, count, total - np.repeat(total[start] - step[start], count)


def _judged(h: np.ndarray, w: np.ndarray | None, many: np.ndarray) -> np.ndarray:
    """For each entry of a bucket: 0, REPEATED, or with ``w`` also ODD (plus 4 for a SPEAKER of its group)."""
    order = np.argsort(h, kind="stable") if w is None else np.lexsort((w, h))
    new = np.concatenate(([True], h[order][1:] != h[order][:-1]))
    out = np.zeros(len(h), dtype=np.int8)
    rank = np.cumsum(new) - 1
    if w is None:
        out[order] = np.where((np.bincount(rank)[rank] > 1) | many[order], REPEATED, 0)
        return out
    split = new | np.concatenate(([True], (w[order][1:] != w[order][:-1]) | (w[order][1:] == 0)))
    group = np.cumsum(split) - 1
    told = np.bincount(group, many[order])[group] > 0
    agrees = ((np.bincount(group)[group] > 1) | told) & (w[order] != 0)
    alone = (np.bincount(rank)[rank] == 1) & ~agrees & ~told
    odd_in_rank = np.bincount(rank, ~agrees)[rank] > 0
    verdict = np.where(agrees, REPEATED, np.where(alone, 0, ODD))
    out[order] = verdict + np.where(agrees & split & odd_in_rank, 4, 0)
    return out


def _answers(width: int, slots: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        """Messages (slot, kind, keys, counts, places) of one bucket: the answers to the rows of a slot in one."""
        parts = [_unpacked(k, c, p) for k, c, p in zip(rows["keys"], rows["counts"], rows["places"])]
        h = _widened(b"".join(rows["prints"]), width)
        w = np.frombuffer(b"".join(rows["wide"]), dtype=U)
        many = b"".join(m for m, own in zip(rows["many"], rows["prints"]) if len(own))
        verdict = _judged(h, w if len(w) else None, np.frombuffer(many, dtype=bool))
        told = []
        at = 0
        for (_, _, place), own, many in zip(parts, rows["prints"], rows["many"]):
            size = len(place) if len(own) else 0
            told.append(verdict[at : at + size] if len(own) else np.full(len(place), many[0], dtype=np.int8))
            at += size
        key = np.concatenate([np.repeat(k, c) for k, c, _ in parts])
        place = np.concatenate([p for *_, p in parts])
        kinds = np.concatenate(told)
        found = []
        for kind, keep in ((REPEATED, kinds & 3 == REPEATED), (ODD, kinds & 3 == ODD), (SPEAKER, kinds > 3)):
            own, where = key[keep], place[keep]
            slot = own % slots
            order = np.lexsort((where, own, slot))
            own, where, slot = own[order], where[order], slot[order]
            cut = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1], [True]))) if len(own) else []
            found += [(int(slot[a]), kind, *_packed(own[a:b], where[a:b])) for a, b in zip(cut, cut[1:])]
        pa.default_memory_pool().release_unused()
        return pd.DataFrame(found, columns=["slot", "kind", "keys", "counts", "places"]).astype({"slot": np.int32, "kind": np.int32})

    return answer


def _ranked(rows: DataFrame, places: Places, entries: float, width: int) -> DataFrame:
    """What the buckets say of the places that ``places`` gives for each block, packed by slots of keys.

    ``places(block, data, offsets)`` yields (text, place, fingerprint, second fingerprint or None).
    ``entries`` is their expected number; it sets the number of buckets.
    """
    small_batches(rows.sparkSession)
    buckets = max(1, round(entries / BUCKET_ENTRIES))
    columns = ["bucket", "keys", "counts", "places", "prints", "wide", "many"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            key, place, h = (np.concatenate([x[i] for x in held]) for i in range(3))
            w = None if held[0][3] is None else np.concatenate([x[3] for x in held])
            rows = list(_messages(key, place, h, w, buckets, width)) if len(key) else []
            kinds = [pa.int32()] + [pa.binary()] * (len(columns) - 1)
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=columns)

        for block, data, offsets in byte_blocks(batches, "_text", BLOCK):
            text, place, h, w = places(block, data, offsets)
            held.append((block.column("_key").to_numpy()[text], place, h, w))
            size += len(data)
            if size >= SEND:
                yield flush()
                held, size = [], 0
                pa.default_memory_pool().release_unused()
        if held:
            yield flush()
        held.clear()
        give_back()

    sent = rows.mapInArrow(
        send, "bucket int, keys binary, counts binary, places binary, prints binary, wide binary, many binary"
    )
    return sent.groupBy("bucket").applyInPandas(
        _answers(width, buckets), "slot int, kind int, keys binary, counts binary, places binary"
    )


def _covered(size: int, places: np.ndarray, before: int, after: int) -> np.ndarray:
    """Whether each byte is within [place - before, place + after)."""
    change = np.zeros(size + 1, dtype=np.int32)
    np.add.at(change, np.maximum(places - before, 0), 1)
    np.add.at(change, np.minimum(places + after, size), -1)
    return np.cumsum(change[:-1]) > 0


def _array(x: object) -> np.ndarray:
    return np.zeros(0, dtype=np.int64) if x is None else np.asarray(x, dtype=np.int64)


def _places_of(told: DataFrame, **kinds: int) -> DataFrame:
    """One row per ``_key`` with the places of each named kind, null where there is none."""
    names = {k: n for n, k in kinds.items()}

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, dict[int, np.ndarray]] = {n: {} for n in kinds}
        for kind, own in rows.groupby("kind"):
            parts = [_unpacked(k, c, p) for k, c, p in zip(own["keys"], own["counts"], own["places"])]
            key = np.concatenate([np.repeat(k, c) for k, c, _ in parts])
            place = np.concatenate([p for *_, p in parts])
            order = np.lexsort((place, key))
            key, place = key[order], place[order].astype(np.int32)
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            out[names[kind]] = dict(zip(key[first].tolist(), np.split(place, first[1:])))
        keys = sorted({k for found in out.values() for k in found})
        return pd.DataFrame({"_key": np.array(keys, dtype=np.int64), **{n: [found.get(k) for k in keys] for n, found in out.items()}})

    schema = "_key long, " + ", ".join(f"{n} array<int>" for n in kinds)
    return told.groupBy("slot").applyInPandas(gather, schema)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text of every row, 64 bits of the text (``_hash``) and of both (``_key``)."""
    return id_text(docs, id_col, text_col).withColumn("_hash", F.xxhash64("_text")).withColumn("_key", F.xxhash64("_id", "_hash"))


def _suspects(docs: DataFrame, m: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(``_id``, ``_hash``, ``_text``, accepted, edges) of the texts that may lose bytes, and their keys.

    ``accepted`` are samples up to which all starts of the last period are repeated, ``edges`` single
    repeated starts.
    """
    spark = docs.sparkSession
    period, cover = difference_cover()
    if m < period + 32:
        raise ValueError(f"m must be at least {period + 32}")
    long_rows = _keyed(docs, id_col, text_col).filter(F.octet_length("_text") >= m)
    total = long_rows.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    tie = m - period + 1

    def samples(block: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        text, place = _cover_places(offsets, tie)
        return text, place, Hashes(data).at(offsets[text] + place, tie), None

    first = _ranked(long_rows.select("_key", "_text"), samples, total * len(cover) / period, 5)
    surviving = staged(_places_of(first, surviving=REPEATED), "cover-samples")
    release_shuffles(spark)
    keyed = bounded(surviving.select("_key"))
    suspects = co_located(
        long_rows.join(keyed, "_key", "left_semi").join(surviving, "_key").select("_key", "_id", "_hash", "_text", "surviving"),
        "_key", "suspects",
    )
    release_shuffles(spark)
    sizes = suspects.agg(F.sum(F.octet_length("_text").cast("long")), F.sum(F.size("surviving").cast("long"))).first()

    def ranks(block: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        text, place = _listed(block.column("surviving"))
        inside = place + tie <= np.diff(offsets)[text]
        text, place = text[inside], place[inside]
        hashes, at = Hashes(data), offsets[text] + place
        wide = np.zeros(len(place), dtype=U)
        inside = (place >= period - 1) & (place + m <= np.diff(offsets)[text])
        wide[inside] = hashes.at(at[inside] - (period - 1), period - 1 + m) | U(1)
        return text, place, hashes.at(at, tie), wide

    told = _ranked(suspects.select("_key", "_text", "surviving"), ranks, sizes[1] or 0, 5)
    told = staged(_places_of(told, accepted=REPEATED, odd=ODD, speaker=SPEAKER), "cover-ranks")
    release_shuffles(spark)
    sending = told.select("_key", F.concat(F.coalesce("odd", _none()), F.coalesce("speaker", _none())).alias("ask")).filter(F.size("ask") > 0)

    def starts(block: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        text, place = _listed(block.column("ask"))
        first = np.searchsorted(text, np.arange(block.num_rows + 1))
        own = [
            np.flatnonzero(_covered(max(n - m + 1, 0), place[a:b], period - 1, 1))
            for n, a, b in zip(np.diff(offsets), first, first[1:])
        ]
        text = np.repeat(np.arange(len(own)), [len(x) for x in own])
        place = np.concatenate(own)
        return text, place, Hashes(data).at(offsets[text] + place, m), None

    asked = suspects.select("_key", "_text").join(sending, "_key")
    edges = staged(_places_of(_ranked(asked, starts, 0.3 * (sizes[0] or 0), 7), edges=REPEATED), "repeated-starts")
    release_shuffles(spark)
    removal = told.select("_key", "accepted").join(edges, "_key", "full")
    found = suspects.join(removal, "_key", "left").select("_id", "_hash", "_text", "accepted", "edges")
    return found, suspects.select("_id", "_hash")


def shared_passages(docs: DataFrame, least: int = 256, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``_key``, shared_bytes) of the texts that share a passage of ``least`` bytes.

    A denser cover of period 57 samples every text; a sample is shared if its ``least - 56`` bytes also
    follow a sample elsewhere.  A string of ``least`` bytes that occurs twice holds such a sample in both
    places, whatever their steps to the cover, so no passage of that size is missed; one of
    ``least - 56`` bytes or more may be found.  ``shared_bytes`` are the bytes within shared samples.
    """
    period, cover = difference_cover(PASSAGE_PRIME)
    size = least - period + 1
    if size < 32:
        raise ValueError(f"least must be at least {period + 31}")
    long_rows = _keyed(docs, id_col, text_col).filter(F.octet_length("_text") >= least)
    total = long_rows.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0

    def samples(block: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        text, place = _cover_places(offsets, size, PASSAGE_PRIME)
        return text, place, Hashes(data).at(offsets[text] + place, size), None

    told = _ranked(long_rows.select("_key", "_text"), samples, total * len(cover) / period, 7)
    schema = "_key long, shared_bytes long"

    def covered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places = [np.unique(_array(x)) for x in batch["shared"]]
            size_of = [int(np.minimum(np.diff(p), size).sum()) + size if len(p) else 0 for p in places]
            yield pd.DataFrame({"_key": batch["_key"], "shared_bytes": np.array(size_of, dtype=np.int64)})

    shared = staged(_places_of(told, shared=REPEATED).mapInPandas(covered, schema), "shared-passages")
    release_shuffles(docs.sparkSession)
    return shared


def _spans(text: str, accepted: object, edges: object, m: int) -> list[dict]:
    """Sorted maximal runs of bytes to remove."""
    size = len(text.encode("utf-8", "surrogatepass"))
    gone = _covered(size, _array(accepted), difference_cover()[0] - 1, m) | _covered(size, _array(edges), 0, m)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2)
    return [{"start": int(a), "length": int(b - a)} for a, b in edge]


def _removals(batch: pd.DataFrame, m: int) -> list[tuple]:
    """(id, hash, text, spans) of rows of :func:`_suspects`."""
    return [
        (i, h, t, _spans(t, a, e, m))
        for i, h, t, a, e in zip(batch["_id"], batch["_hash"], batch["_text"], batch["accepted"], batch["edges"])
    ]


def repeated_spans(docs: DataFrame, m: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``_id``, ``_hash``, ``_text``, spans) of the texts that lose bytes.

    ``spans`` are the sorted maximal (start, length) byte runs to remove; all other rows lose
    nothing.  ``m`` must exceed the period of the cover by 32.
    """
    found, _ = _suspects(docs, m, id_col, text_col)
    kind = found.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([r for r in _removals(batch, m) if r[3]], columns=["_id", "_hash", "_text", "spans"])

    return found.mapInPandas(run, f"_id {kind}, _hash long, _text string, spans array<struct<start:int,length:int>>")


def _none() -> Column:
    return F.array().cast("array<int>")


def without(text: str | None, spans: list) -> bytes:
    """The bytes of ``text`` outside the spans, in order."""
    data = (text or "").encode("utf-8", "surrogatepass")
    parts, at = [], 0
    for s in spans:
        parts.append(data[at : s["start"]])
        at = s["start"] + s["length"]
    return b"".join(parts) + data[at:]


def _untouched(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    other = bounded(keys.select(F.col("_id").alias("_i"), F.col("_hash").alias("_h")).distinct())
    return _keyed(docs, id_col, text_col).join(other, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h")), "left_anti")


def removal_digests(docs: DataFrame, m: int = 400, id_col: str = "doc_id", text_col: str = "text", passage: int | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for every row; with ``passage`` also n_shared_bytes.

    That is 0 for a text that shares no passage of ``passage`` bytes (see :func:`shared_passages`), and tells
    the others apart also where the passage is too short for a removal.
    """
    shared = None if passage is None else shared_passages(docs, passage, id_col, text_col)
    found, keys = _suspects(docs, m, id_col, text_col)
    kind = found.schema["_id"].dataType.simpleString()
    columns = ["_key", id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for own, (key, _, text, spans) in zip(batch["_key"], _removals(batch, m)):
                kept, gone = without(text, spans), sum(s["length"] for s in spans)
                out.append((own, key, len(kept) + gone, gone, len(spans), sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=columns)

    text = F.encode(F.coalesce("_text", F.lit("")), "UTF-8")
    rest = _untouched(docs, keys, id_col, text_col).select(
        "_key", F.col("_id").alias(id_col), F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"),
    )
    schema = f"_key long, `{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    whole = found.withColumn("_key", F.xxhash64("_id", "_hash")).mapInPandas(digest, schema).unionByName(rest)
    if shared is None:
        return whole.select(*columns[1:])
    return whole.join(bounded(shared), "_key", "left").select(
        *columns[1:], F.coalesce("shared_bytes", F.lit(0)).cast("long").alias("n_shared_bytes")
    )


def removed_texts(docs: DataFrame, m: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``_id``, ``_hash``, kept_text) of the rows that lose bytes.

    A character cut by the edge of a span is dropped with it.
    """
    found, _ = _suspects(docs, m, id_col, text_col)
    kind = found.schema["_id"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [(i, h, without(t, s).decode("utf-8", "ignore")) for i, h, t, s in _removals(batch, m) if s]
            yield pd.DataFrame(kept, columns=["_id", "_hash", "kept_text"])

    return found.mapInPandas(cut, f"_id {kind}, _hash long, kept_text string")
