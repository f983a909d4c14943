from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import SCHEMA, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.llm import byte_bpe, chat_format
from riskweave.llm.queries import vocabulary

PATH, PATTERN = vocabulary()


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def known(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_same_tokens_as_the_public_library(bpe, known, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(byte_bpe, "LEAF_CHARS", 7)
    monkeypatch.setattr(byte_bpe, "LEAF_BYTES", 5)
    small = byte_bpe.ByteBpe(bpe.ranks, PATTERN)
    texts = ["".join(rng.choices("aab '  \n\tréstvm'l'lée12三🙂.,!-\x1c\x85\u2003", k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * 3000, "ab" * 2000, " " * 900 + "x", "\n \t" * 500, "helloworld" * 900, "don't we've I'll 'r" * 30]
    assert list(small.encode_batch(texts)) == known.encode_ordinary_batch(texts)
    assert [small.encode(t) for t in texts[-6:]] == known.encode_ordinary_batch(texts[-6:])
    assert all(small.decode(i).decode() == t for i, t in zip(small.encode_batch(texts), texts))


def test_digests_and_columns(spark, bpe, known):
    docs = spark.createDataFrame(odd_documents(), SCHEMA)
    for row, got in zip(odd_documents(), byte_bpe.token_digests(docs, PATH, PATTERN).collect()):
        ids = known.encode_ordinary(row[1] or "")
        assert got["doc_id"] == row[0] and got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256((row[1] or "").encode()).hexdigest()
    coded = byte_bpe.encode_column(docs, PATH, PATTERN)
    back = byte_bpe.decode_column(coded, PATH, PATTERN)
    assert [bytes(r["decoded"]).decode() for r in back.collect()] == [r[1] or "" for r in odd_documents()]
    assert set(docs.columns) < set(back.columns)
    assert byte_bpe.token_digests(docs.limit(0), PATH, PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="<|\\im_endstar>a\n", max_size=20), st.text(alphabet="<|\\im_endstar>a\né", max_size=40)), max_size=5))
def test_rendering_is_reversible(turns):
    assert chat_format.parse(chat_format.render(turns)) == turns


def test_mask_covers_trained_texts_only(bpe):
    turns = [("user", "hi <|im_end|>"), ("assistant", "ok <|im_start|>assistant \\ <\\| done"), ("assistant", ""), ("assistant", " é🙂 ")]
    text = chat_format.render(turns)
    ids, edges = chat_format.encode_with_offsets(bpe, text)
    assert len(edges) == len(ids) + 1 and edges[-1] == len(text.encode())
    mask = chat_format.loss_mask(edges, chat_format.turn_spans(text, "assistant"))
    assert chat_format.masked_text(text, edges, mask) == [t for r, t in turns if r == "assistant" and t]


def test_loss_mask_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        edges = np.concatenate(([0], np.cumsum(rng.integers(1, 5, rng.integers(0, 30)))))
        cuts = np.unique(rng.integers(0, edges[-1] + 1, 8))
        spans = cuts[: len(cuts) // 2 * 2].reshape(-1, 2)
        want = [any(a <= s and e <= b for a, b in spans) for s, e in zip(edges, edges[1:])]
        assert chat_format.loss_mask(edges, spans).tolist() == want


def test_conversations(spark, monkeypatch):
    rows = [
        (1, 1, "assistant", "B <|im_end|>"), (1, 0, "user", "a"), (1, 2, "user", None), (2, 0, None, "x"), (2, None, "assistant", "first"),
        (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie"), (None, 0, "assistant", "lost"), (3, 0, "user", "u"),
    ]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, part string")
    want = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        loss = "".join(t or "" for _, role, t in turns if role == "assistant")
        want[conv] = (
            len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns).encode()).hexdigest(),
            len(loss), hashlib.sha256(loss.encode()).hexdigest(),
        )
    got = chat_format.conversation_digests(chat_format.format_conversations(frame, PATH, PATTERN), PATH, PATTERN).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == want
    assert chat_format.format_conversations(frame.limit(0), PATH, PATTERN).count() == 0


def test_long_conversation_in_parts(bpe):
    import pandas as pd

    batches = [pd.DataFrame({"_conv": [1] * 300, "_role": ["assistant"] * 300, "_text": ["word " * 5000] * 300})]
    parts = list(chat_format._segments(iter(batches)))
    assert len(parts) > 1 and [p[2] for p in parts] == [False] * (len(parts) - 1) + [True]
    assert sum(len(p[1]) for p in parts) == 300
