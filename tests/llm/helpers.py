"""Small documents with every odd case, and plain brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string, _hash string, node int, n int, v int"


def prose(rng: random.Random, words: int, alphabet: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(words))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join("zzz" if rng.random() < share else w for w in text.split(" "))


def odd_documents(seed: int = 1) -> list[tuple]:
    """Nulls, empty and blank texts, copies, near copies, shared passages, repeated rows, a very long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(12)]
    passage = prose(rng, 120)
    texts: list[str | None] = [None, "", " \t\n ", "one", "One two", "é ß ü – 🙂 Ünï", "...!!! 123"]
    texts += base + [base[0], base[1].upper(), base[0]]
    texts += [edited(rng, t, 0.02) for t in base[2:6] for _ in range(4)]
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(5)]
    texts += [prose(rng, 15000), "a b c " * 3000, "same line\n" * 400, "x" * 9000]
    rows = [(i, t, "en" if i % 3 else None, "s", None, "clash", "clash", "clash", 1, 2, 3) for i, t in enumerate(texts)]
    return rows + [rows[8], rows[8], rows[0], (None, base[7], "en", "s", 5, None, None, None, None, None, None)]


def shingle_set(text: str | None, k: int) -> frozenset:
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1)))


def similar_groups(docs: dict, k: int, percent: int) -> dict:
    """Smallest reachable id by id, all pairs compared."""
    sets = {i: shingle_set(t, k) for i, t in docs.items()}
    label = {i: i for i in docs}
    changed = True
    while changed:
        changed = False
        for a in docs:
            for b in docs:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def repeated_bytes(texts: list[str | None], m: int) -> list[list[bool]]:
    """For each text whether each byte lies in a string of m bytes that starts anywhere else too."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + m] for d in data for i in range(len(d) - m + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - m + 1):
            if seen[d[i : i + m]] > 1:
                gone[i : i + m] = [True] * m
        out.append(gone)
    return out


def window_hits(text: str | None, items: list[tuple], size: int) -> tuple[int, set, set]:
    """Words, hit places and items with occurring windows."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    own = word.findall((text or "").translate(LOWER))
    windows = defaultdict(set)
    for item, t in items:
        w = word.findall((t or "").translate(LOWER))
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            windows[tuple(w[i : i + size])].add("null" if item is None else str(item))
    hit, found = set(), set()
    for length in {len(w) for w in windows}:
        for i in range(len(own) - length + 1):
            key = tuple(own[i : i + length])
            if key in windows:
                hit.update(range(i, i + length))
                found |= windows[key]
    return len(own), hit, found
