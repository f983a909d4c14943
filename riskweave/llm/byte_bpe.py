"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text is cut in halves until the parts are short; parts are joined pairwise up the tree.

* Pieces: the split pattern looks at most :data:`LOOK` characters past a match and never back.  All
  matches of a left part that end earlier are final.  The rest is matched again together with a
  growing window of the right part, until a match ends where a match of the right part ends; from
  there on the right part's own matches hold.
* Tokens of one long piece: the last k tokens of the left half and the first k of the right half are
  encoded again, k doubling, until the first and last token of the window come out unchanged.  A
  token sequence is the BPE encoding exactly when each adjacent pair is, so all outer tokens stand.

Decoding joins byte strings up the same tree.  Only the vocabulary, of a fixed size, is held in
memory, and a cache of short pieces with a stated bound.

Null texts count as empty: no token, empty bytes.  Texts of any length are handled whole.  Repeated
rows give repeated results; columns are added under caller-chosen names.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskweave.llm.common import byte_blocks, give_back, process_cache, small_batches

LOOK = 2  # "'re" is decided two characters past its quote; white space by one
LEAF_CHARS = 16384
LEAF_BYTES = 48
SHORT = 64
BATCH_CHARS = 1_000_000
#: Unicode's White_Space
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CACHE = 300_000


def compiled(pattern: str) -> re.Pattern:
    """``pattern`` for the standard ``re``: letter, number and space classes become explicit ranges."""
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)

    def ranges(name: str) -> str:
        return "".join(f"{re.escape(r[0])}-{re.escape(r[-1])}" for r in regex.findall(rf"\p{{{name}}}+", every))

    classes = {"\\p{L}": ranges("L"), "\\p{N}": ranges("N"), "\\s": BLANK}

    def outside(match: re.Match) -> str:
        name = match.group()
        if name.startswith("["):
            for k, v in classes.items():
                name = name.replace(k, v)
            return name
        return f"[^{BLANK}]" if name == "\\S" else f"[{classes[name]}]"

    return re.compile(re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\s|\\S", outside, pattern))


class ByteBpe:
    """Encoder and decoder for one table of ranks, given as token bytes -> rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.pattern = compiled(pattern)
        self._cache: dict[str, tuple[int, ...]] = {}
        self._size = len(ranks) + 1
        self._numbers = list(range(max(ranks.values(), default=0) + 1))
        pairs = [
            (ranks[t[:i]] * self._size + ranks[t[i:]], r)
            for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        pairs.sort()
        self._pair_keys = np.array([k for k, _ in pairs], dtype=np.int64)
        self._pair_ranks = np.array([r for _, r in pairs], dtype=np.int64)
        self._single = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)

    # pieces ------------------------------------------------------------------------------
    def pieces(self, text: str) -> list[str]:
        """All matches of the pattern, by halves."""
        if len(text) <= LEAF_CHARS:
            return self.pattern.findall(text)
        mid = len(text) // 2
        return self._join_pieces(self.pieces(text[:mid]), self.pieces(text[mid:]))

    def _join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        tail, behind = [], 0
        while left and behind < LOOK:
            behind += len(left[-1])
            tail.append(left.pop())
        loose = "".join(reversed(tail))
        width = 4
        while True:
            window = loose + "".join(right[:width])
            whole = width >= len(right)
            ends, at = {}, len(loose)
            for k, piece in enumerate(right[:width]):
                at += len(piece)
                ends[at] = k + 1
            fresh = []
            for match in self.pattern.finditer(window):
                if not whole and match.end() > len(window) - LOOK:
                    break
                fresh.append(match.group())
                if match.end() in ends:
                    return left + fresh + right[ends[match.end()]:]
            if whole:
                return left + fresh
            width *= 2

    # tokens of one piece -----------------------------------------------------------------
    def pieces_ids(self, pieces: list[str]) -> list[tuple[int, ...]]:
        """Tokens of each piece; the tokens of short pieces are kept, up to :data:`CACHE` of them."""
        found = list(map(self._cache.get, pieces))
        if None in found:
            self.learn(pieces)
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._cache.get(pieces[i]) or tuple(self.encode_bytes(pieces[i].encode("utf-8", "surrogatepass")))
        return found

    def learn(self, pieces: Iterable[str]) -> None:
        """Put the short ones among ``pieces`` into the cache, all new ones merged together."""
        new = [p for p in set(pieces) if p not in self._cache and len(p) <= SHORT]
        if len(self._cache) + len(new) > CACHE:
            self._cache.clear()
        self._cache.update(zip(new, self._merge_many([p.encode("utf-8", "surrogatepass") for p in new])))

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, or the table size where there is none."""
        keys = left * self._size + right
        at = np.searchsorted(self._pair_keys, keys)
        at[at == len(self._pair_keys)] = 0
        return np.where(self._pair_keys[at] == keys, self._pair_ranks[at], self._size)

    def _merge_many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """As :meth:`_merge` for many short pieces at once: each round merges one pair of each piece."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        number = self._numbers.__getitem__  # one object for a token, however many kept pieces hold it
        which = np.array([i for i, p in enumerate(pieces) if p], dtype=np.int64)
        sizes = np.array([len(pieces[i]) for i in which], dtype=np.int64)
        ids = self._single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        rank = np.full(len(ids), self._size)
        if len(ids) > 1:
            rank[:-1] = self._pair_rank(ids[:-1], ids[1:])
            rank[starts[1:] - 1] = self._size
        while len(which):
            low = np.minimum.reduceat(rank, starts)
            done = low == self._size
            if done.any():
                flat, cut = ids.tolist(), starts.tolist() + [len(ids)]
                for i in np.flatnonzero(done):
                    out[which[i]] = tuple(map(number, flat[cut[i] : cut[i + 1]]))
                keep = np.repeat(~done, sizes)
                ids, rank, which, sizes, low = ids[keep], rank[keep], which[~done], sizes[~done], low[~done]
                starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
                if not len(which):
                    break
            hits = np.flatnonzero(rank == np.repeat(low, sizes))
            owner = np.searchsorted(starts, hits, "right") - 1
            at = hits[np.concatenate(([True], owner[1:] != owner[:-1]))]
            ids[at] = low
            stay = np.ones(len(ids), dtype=bool)
            stay[at + 1] = False
            moved = at - np.arange(len(at))
            ids, rank = ids[stay], rank[stay]
            sizes = sizes - 1
            starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
            last = starts + sizes - 1
            rank[moved] = self._size
            inner = moved < last
            rank[moved[inner]] = self._pair_rank(ids[moved[inner]], ids[moved[inner] + 1])
            after = moved > starts
            rank[moved[after] - 1] = self._pair_rank(ids[moved[after] - 1], ids[moved[after]])
        return out

    def encode_bytes(self, data: bytes) -> list[int]:
        """Tokens of one piece, by halves."""
        rank = self.ranks.get(data)
        if rank is not None:
            return [rank]
        if len(data) <= LEAF_BYTES:
            return self._merge(data)
        mid = len(data) // 2
        return self._join_tokens(self.encode_bytes(data[:mid]), self.encode_bytes(data[mid:]))

    def _join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        k = 2
        while True:
            a, b = left[-k:], right[:k]
            window = self._merge(self.token_bytes(a) + self.token_bytes(b))
            if (k >= len(left) or window[0] == a[0]) and (k >= len(right) or window[-1] == b[-1]):
                return left[: max(0, len(left) - k)] + window + right[k:]
            k *= 2

    def _merge(self, data: bytes) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        part = [data[i : i + 1] for i in range(len(data))]
        after = list(range(1, len(data) + 1))
        before = list(range(-1, len(data) - 1))
        queue = [(r, i) for i in range(len(data) - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i = heapq.heappop(queue)
            j = after[i]
            if not part[i] or j >= len(data) or ranks.get(part[i] + part[j]) != rank:
                continue
            part[i] += part[j]
            part[j] = b""
            after[i] = after[j]
            if after[i] < len(data):
                before[after[i]] = i
                if (r := ranks.get(part[i] + part[after[i]])) is not None:
                    heapq.heappush(queue, (r, i))
            if (p := before[i]) >= 0 and (r := ranks.get(part[p] + part[i])) is not None:
                heapq.heappush(queue, (r, p))
        return [ranks[x] for x in part if x]

    # whole texts -------------------------------------------------------------------------
    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.pieces_ids(self.pieces(text or ""))))

    def token_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """Token lists in order; the new pieces of about a million characters are merged together."""
        waiting: list[list[str]] = []
        chars = 0
        for text in chain(texts, (False,)):
            if text is False or chars >= BATCH_CHARS:
                self.learn(chain.from_iterable(waiting))
                for pieces in waiting:
                    yield list(chain.from_iterable(self.pieces_ids(pieces)))
                waiting, chars = [], 0
            if text is not False:
                waiting.append(self.pieces(text or ""))
                chars += len(text or "")

    def decode(self, ids) -> bytes:
        """Bytes of a token list: concatenation up a tree of halves."""
        if len(ids) <= LEAF_CHARS:
            return self.token_bytes(ids)
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def codec(path: str, pattern: str) -> ByteBpe:
    """The codec of a rank file (base64 token and rank per line), kept by the Python process."""
    kept = process_cache()
    if (path, pattern) not in kept:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        kept[path, pattern] = ByteBpe(ranks, pattern)
    return kept[path, pattern]


def encode_column(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids of ``text_col`` as ``array<int>`` (an existing ``ids_col`` is replaced)."""
    kept = [c for c in docs.columns if c.lower() != ids_col.lower()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(path, pattern)
        for batch in batches:
            batch[ids_col] = [np.array(x, dtype=np.int32) for x in bpe.encode_batch(batch["__text"])]
            yield batch.drop(columns="__text")

    spread = docs.select(*kept, docs[text_col].cast("string").alias("__text"))
    schema = docs.select(*kept).schema.add(ids_col, T.ArrayType(T.IntegerType()))
    return spread.mapInPandas(run, schema)


def decode_column(docs: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with the decoded bytes of ``ids_col``; a null list gives empty bytes."""
    kept = [c for c in docs.columns if c.lower() != bytes_col.lower()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(path, pattern)
        for batch in batches:
            batch[bytes_col] = [b"" if x is None else bpe.decode(list(x)) for x in batch[ids_col]]
            yield batch

    return docs.select(*kept).mapInPandas(run, docs.select(*kept).schema.add(bytes_col, "binary"))


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, in one pass over the texts."""
    from hashlib import sha256

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(path, pattern)
        digits = [str(i).encode() for i in range(max(bpe.tokens) + 1)]
        for batch in batches:
            rows = []
            for ids in bpe.encode_batch(batch["_text"]):
                line = b" ".join(map(digits.__getitem__, ids))
                rows.append((len(ids), sha256(line).hexdigest(), sha256(bpe.decode(ids)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, id_col, batch["_id"].to_numpy())
            yield out

    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded_rows(docs: DataFrame, path: str, pattern: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns, n_tokens, token_ids and round_trip: whether the decoded bytes are the text's."""
    schema = docs.select(*keep).schema.add("n_tokens", "long").add("token_ids", T.ArrayType(T.IntegerType())).add("round_trip", "boolean")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern)
        for rows, _, _ in byte_blocks(batches, "__text", BATCH_CHARS):
            texts = rows.column(rows.num_columns - 1).to_pylist()
            kept, ids, sizes, same = rows.num_columns - 1, [], [], []
            for text, own in zip(texts, bpe.encode_batch(texts)):
                ids.append(np.array(own, dtype=np.int32))
                sizes.append(len(own))
                same.append(bpe.decode(own) == (text or "").encode("utf-8", "surrogatepass"))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(np.concatenate(ids) if ids else [], pa.int32())
            )
            columns = [rows.column(i) for i in range(kept)] + [pa.array(sizes, pa.int64()), lists, pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        del bpe
        process_cache().pop((path, pattern), None)  # the worker goes on with other work
        give_back()

    return docs.select(*keep, docs[text_col].cast("string").alias("__text")).mapInArrow(run, schema)
