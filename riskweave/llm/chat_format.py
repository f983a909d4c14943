"""Chat formatting with loss masks from token offsets.

A conversation is rendered whole, one turn after the other as
``<|im_start|>role<|im_sep|>text<|im_end|>``; control strings inside roles and texts are escaped
reversibly (``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|`` and so on).  The rendering is encoded
once with byte offsets.  The sorted text spans of the trained role's turns are intersected with the
sorted token spans by binary search; a token is under the loss when it lies inside such a span.
Control strings are single tokens, so no token crosses a span's edge.

A task reads its conversations in order and flushes after :data:`FLUSH_CHARS` characters, always
between turns: control tokens separate turns, so a conversation of any length is encoded
exactly and held in bounded memory.

Null texts and roles count as empty; null turns come first; equal turns are ordered by role and
text.  Empty texts give an empty span and no token.  Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.byte_bpe import ByteBpe, codec

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = re.compile("(" + "|".join(map(re.escape, (START, SEP, END))) + ")")
TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.S)
FLUSH_CHARS = 4_000_000


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{START}{escape(role)}{SEP}{escape(text)}{END}" for role, text in turns)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendering: the inverse of :func:`render`."""
    return [(unescape(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


def turn_spans(formatted: str, role: str) -> np.ndarray:
    """Byte spans (start, end) of the texts of ``role``, in order."""
    spans, at, chars = [], 0, 0
    for m in TURN.finditer(formatted):
        start = at + len(formatted[chars : m.start(2)].encode("utf-8", "surrogatepass"))
        end = start + len(m[2].encode("utf-8", "surrogatepass"))
        at, chars = end, m.end(2)
        if unescape(m[1]) == role:
            spans.append((start, end))
    return np.array(spans, dtype=np.int64).reshape(-1, 2)


def encode_with_offsets(bpe: ByteBpe, formatted: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and the byte offsets of their edges; control strings get the ids after the vocabulary."""
    first = max(bpe.tokens) + 1
    special = {s: first + i for i, s in enumerate((START, SEP, END))}
    ids: list[int] = []
    sizes: list[int] = []
    for part in CONTROL.split(formatted):
        if part in special:
            ids.append(special[part])
            sizes.append(len(part))
        else:
            own = bpe.encode(part)
            ids += own
            sizes += [len(bpe.tokens[i]) for i in own]
    return np.array(ids, dtype=np.int64), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


def loss_mask(edges: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For each token whether it lies inside one of the sorted spans; two binary searches per span."""
    steps = np.zeros(len(edges), dtype=np.int64)
    first = np.searchsorted(edges[:-1], spans[:, 0], "left")
    last = np.searchsorted(edges[1:], spans[:, 1], "right")
    full = last > first
    np.add.at(steps, first[full], 1)
    np.add.at(steps, last[full], -1)
    return np.cumsum(steps[:-1]) > 0


def masked_text(formatted: str, edges: np.ndarray, mask: np.ndarray) -> list[str]:
    """Unescaped texts of the maximal runs of masked tokens."""
    data = formatted.encode("utf-8", "surrogatepass")
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [unescape(data[edges[a] : edges[b]].decode("utf-8", "surrogatepass")) for a, b in edge.reshape(-1, 2)]


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, list[tuple[str, str]], bool]]:
    """(conversation, turns, last part?) from rows that arrive sorted by conversation and turn."""
    conv, turns, chars = None, [], 0
    begun = False
    for batch in batches:
        for key, role, text in zip(batch["_conv"], batch["_role"], batch["_text"]):
            key = None if pd.isna(key) else key
            if begun and key != conv:
                yield conv, turns, True
                turns, chars = [], 0
            elif chars >= FLUSH_CHARS:
                yield conv, turns, False
                turns, chars = [], 0
            conv, begun = key, True
            turns.append((role or "", text or ""))
            chars += len(role or "") + len(text or "")
    if begun:
        yield conv, turns, True


def _ordered(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return (
        rows.select(
            F.col(conv_col).alias("_conv"), F.col(turn_col).alias("_turn"),
            F.col(role_col).cast("string").alias("_role"), F.col(text_col).cast("string").alias("_text"),
        )
        .repartition("_conv").sortWithinPartitions("_conv", "_turn", "_role", "_text")
        .select("_conv", "_role", "_text")
    )


def format_conversations(
    rows: DataFrame, path: str, pattern: str, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", trained_role: str = "assistant",
) -> DataFrame:
    """(conv, part, formatted, token_ids, loss_mask); parts of a long conversation are numbered from 0."""
    source = _ordered(rows, conv_col, turn_col, role_col, text_col)
    kind = source.schema["_conv"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, part, out, chars = codec(path, pattern), 0, [], 0
        columns = [conv_col, "part", "formatted", "token_ids", "loss_mask"]
        for conv, turns, last in _segments(batches):
            text = render(turns)
            ids, edges = encode_with_offsets(bpe, text)
            out.append((conv, part, text, ids.astype(np.int32), loss_mask(edges, turn_spans(text, trained_role))))
            part, chars = 0 if last else part + 1, chars + len(text)
            if chars >= FLUSH_CHARS:
                yield pd.DataFrame(out, columns=columns)
                out, chars = [], 0
        yield pd.DataFrame(out, columns=columns)

    return source.mapInPandas(run, f"`{conv_col}` {kind}, part int, formatted string, token_ids array<int>, loss_mask array<boolean>")


def conversation_digests(formatted: DataFrame, path: str, pattern: str, conv_col: str = "conv_id") -> DataFrame:
    """Digests per conversation, read back from the rows of :func:`format_conversations`.

    Turns come from the formatted text, trained text from the tokens under the mask.  Parts follow
    each other inside their partition, so nothing is shuffled.
    """
    kind = formatted.schema[conv_col].dataType.simpleString()
    columns = [conv_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(path, pattern)
        first = max(bpe.tokens) + 1
        size = {**{i: len(t) for i, t in bpe.tokens.items()}, first: len(START), first + 1: len(SEP), first + 2: len(END)}
        state = None
        for batch in batches:
            done = []
            for conv, part, text, ids, mask in zip(*(batch[c] for c in (conv_col, "part", "formatted", "token_ids", "loss_mask"))):
                if part == 0:
                    if state:
                        done.append(_closed(state))
                    state = [None if pd.isna(conv) else conv, 0, sha256(), 0, sha256(), 0]
                edges = np.concatenate(([0], np.cumsum([size[i] for i in ids], dtype=np.int64)))
                for role, said in parse(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for run_text in masked_text(text, edges, np.asarray(mask, dtype=bool)):
                    state[3] += len(run_text)
                    state[4].update(run_text.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
            yield pd.DataFrame(done, columns=columns)
        if state:
            yield pd.DataFrame([_closed(state)], columns=columns)

    return formatted.mapInPandas(
        run, f"`{conv_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _closed(state: list) -> tuple:
    return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]
