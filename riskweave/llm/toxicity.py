"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Words are the time steps.  Each word enters as a learnt word vector (zero for words outside the
vocabulary) next to the mean of learnt vectors of its character trigrams.  Two gated recurrent
layers read a window of words in both directions, attention pools their states, a logistic unit
scores the window.  All overlapping windows of every whole text are scored; the document's score is
a logistic calibration of the highest window logit and the number of windows.

The network is fitted on a bounded sample of labelled rows (``sample_rows`` of each label, by hash of
the id), first on the window of each text whose words tell most by their log-odds in the sample,
then again with the window that the first network scores highest, so that a passage inside a long
text counts.

Null and empty texts have one empty window and get its score.  Without labelled rows of both kinds
every score is the share of label 1 (0.5 without any label).  Null labels are skipped, several
labels of an id are averaged and rounded.  Only the named columns are read.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import id_text, process_cache

WIDTH, STRIDE = 32, 16
HIDDEN, ATTEND, WORD_DIM, CHAR_DIM, BUCKETS = 8, 8, 12, 12, 4096
EDGE = ".,;:!?\"'()[]{}*#$%&|<>-_"
WORDS_KEPT = 200_000  # projected words that a scoring process keeps
BLOCK = 1024  # windows scored at once
TEXT_WORDS = 65_536  # words of texts that are read at once

Params = dict[str, np.ndarray]


def normal(token: str) -> str:
    return token.strip(EDGE).lower()


def trigrams(word: str) -> list[int]:
    marked = f"^{word}$"
    return [zlib.crc32(marked[i : i + 3].encode("utf-8", "surrogatepass")) % BUCKETS for i in range(max(len(marked) - 2, 1))]


def _crc_table() -> np.ndarray:
    """What CRC-32 makes of each byte; the checksum goes on from the last one by this table."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1)
    return value


CRC = _crc_table()


def all_trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of many words in a row, and how many each word has, as :func:`trigrams` gives them.

    One pass per byte of the longest trigram goes over all of them at once.
    """
    size = np.fromiter((max(len(w), 1) for w in words), dtype=np.int64, count=len(words))
    chars = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    data = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    edge = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where characters begin
    last = np.cumsum(chars)
    at = np.repeat(last - chars - (np.cumsum(size) - size), size) + np.arange(size.sum())
    begin, end = edge[at], edge[np.minimum(at + 3, np.repeat(last, size))]
    long = end - begin
    state = np.full(len(at), 0xFFFFFFFF, dtype=np.uint32)
    least = int(long.min(initial=12))
    for k in range(int(long.max(initial=0))):
        some = slice(None) if k < least else np.flatnonzero(long > k)
        own = state[some]
        state[some] = CRC[(own ^ data[begin[some] + k]) & 0xFF] ^ (own >> 8)
    return ((state ^ np.uint32(0xFFFFFFFF)) % BUCKETS).astype(np.int64), size


def window_starts(n: int) -> range:
    """Starts of the overlapping windows of a text of ``n`` words; an empty text has one."""
    return range(0, max(n - STRIDE, 1), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_params(words: int, rng: np.random.Generator) -> Params:
    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    return {
        "word": rng.normal(0, 0.3, (words + 1, WORD_DIM)), "char": rng.normal(0, 0.3, (BUCKETS, CHAR_DIM)),
        "wx": rng.normal(0, 1 / np.sqrt(d), (2, d, 3 * h)), "bx": np.zeros((2, 1, 3 * h)),
        "u": rng.normal(0, 1 / np.sqrt(h), (2, h, 3 * h)),
        "wa": rng.normal(0, 1 / np.sqrt(2 * h), (2 * h, ATTEND)), "ba": np.zeros(ATTEND),
        "v": rng.normal(0, 1, ATTEND), "w": rng.normal(0, 0.3, 2 * h), "b": np.zeros(1),
    }


def project(p: Params, x: np.ndarray) -> np.ndarray:
    """Input part of all gates in both directions: words x (2 * 3 * HIDDEN)."""
    return np.concatenate([x @ p["wx"][0] + p["bx"][0], x @ p["wx"][1] + p["bx"][1]], axis=1)


def run_network(p: Params, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Window logits from projected words (time x windows x 6 HIDDEN) and a 0/1 mask (time x windows)."""
    steps, count, h = len(gates), gates.shape[1], HIDDEN
    g = np.stack([gates[:, :, : 3 * h], gates[::-1, :, 3 * h :]], axis=1)
    m = np.stack([mask, mask[::-1]], axis=1)[..., None]
    state = np.zeros((2, count, h), dtype=gates.dtype)
    states = np.empty((steps, 2, count, h), dtype=gates.dtype)
    trace = []
    full = bool(mask.all())
    for t in range(steps):
        r_all = np.matmul(state, p["u"])
        zr = g[t, :, :, : 2 * h] + r_all[:, :, : 2 * h]
        np.negative(zr, out=zr)
        np.clip(zr, -30, 30, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :, :h], zr[:, :, h:]
        n = np.tanh(g[t, :, :, 2 * h :] + r * r_all[:, :, 2 * h :])
        new = n + z * (state - n)
        if not full:
            new = m[t] * new + (1 - m[t]) * state
        if keep:
            trace.append((state, z, r, n, r_all[:, :, 2 * h :]))
        state = new
        states[t] = state
    both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
    u = np.tanh(both @ p["wa"] + p["ba"])
    e = u @ p["v"] + np.where(mask > 0, 0, -1e4).astype(gates.dtype)
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    a = a * mask
    pooled = np.einsum("tb,tbh->bh", a, both)
    logit = pooled @ p["w"] + p["b"][0]
    return (logit, (g, m, both, u, a, pooled, trace)) if keep else logit


def window_logits(p: Params, gates: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    """The logits of :func:`run_network` up to rounding, for scoring; without a mask all windows are full.

    Windows lie along the last axis and arrays are reused, so that each step works on long rows.
    """
    (steps, count, _), h, kind = gates.shape, HIDDEN, gates.dtype
    turn = np.ascontiguousarray(np.swapaxes(p["u"], 1, 2))
    state, both = np.zeros((2, h, count), dtype=kind), np.empty((steps, 2 * h, count), dtype=kind)
    g, add, n, old = np.empty((2, 3 * h, count), dtype=kind), np.empty((2, 3 * h, count), dtype=kind), np.empty_like(state), np.empty_like(state)
    zr, z, r = add[:, : 2 * h], add[:, :h], add[:, h : 2 * h]
    for t in range(steps):
        g[0], g[1] = gates[t, :, : 3 * h].T, gates[steps - 1 - t, :, 3 * h :].T
        np.matmul(turn, state, out=add)
        zr += g[:, : 2 * h]
        np.negative(zr, out=zr)
        np.clip(zr, -30, 30, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        np.multiply(r, add[:, 2 * h :], out=n)
        n += g[:, 2 * h :]
        np.tanh(n, out=n)
        if mask is not None:
            old[...] = state
        state -= n
        state *= z
        state += n
        if mask is not None:
            for d, real in enumerate((mask[t], mask[steps - 1 - t])):
                np.copyto(state[d], old[d], where=real == 0)
        both[t, :h], both[steps - 1 - t, h:] = state[0], state[1]
    u = np.matmul(p["wa"].T, both)
    u += p["ba"][:, None]
    np.tanh(u, out=u)
    e = np.matmul(p["v"], u)
    if mask is not None:
        e[mask == 0] = -1e4
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    if mask is not None:
        a *= mask
    return (a * np.matmul(p["w"], both)).sum(axis=0) + p["b"][0]


def gradients(p: Params, kept, mask: np.ndarray, d_logit: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of the shared weights, and of the projected words (time x windows x 6 HIDDEN)."""
    g, m, both, u, a, pooled, trace = kept
    h = HIDDEN
    out = {"w": pooled.T @ d_logit, "b": np.array([d_logit.sum()])}
    d_pooled = d_logit[:, None] * p["w"]
    d_both = a[..., None] * d_pooled
    d_a = np.einsum("tbh,bh->tb", both, d_pooled)
    d_e = a * (d_a - (a * d_a).sum(axis=0))
    out["v"] = np.einsum("tba,tb->a", u, d_e)
    d_pre = d_e[..., None] * p["v"] * (1 - u * u)
    out["wa"] = np.einsum("tbh,tba->ha", both, d_pre)
    out["ba"] = d_pre.sum(axis=(0, 1))
    d_both = d_both + d_pre @ p["wa"].T
    d_states = np.stack([d_both[:, :, :h], d_both[::-1, :, h:]], axis=1)
    d_u = np.zeros_like(p["u"])
    d_gates = np.zeros_like(g)
    d_state = np.zeros_like(d_states[0])
    back = np.swapaxes(p["u"], 1, 2)
    for t in reversed(range(len(g))):
        before, z, r, n, r_n = trace[t]
        d_state = d_state + d_states[t]
        d_new = d_state * m[t]
        d_before = d_state * (1 - m[t]) + d_new * z
        d_n = d_new * (1 - z) * (1 - n * n)
        d_z = d_new * (before - n) * z * (1 - z)
        d_r = d_n * r_n * r * (1 - r)
        d_gates[t] = np.concatenate([d_z, d_r, d_n], axis=2)
        d_rec = np.concatenate([d_z, d_r, d_n * r], axis=2)
        d_u += np.matmul(np.swapaxes(before, 1, 2), d_rec)
        d_state = d_before + np.matmul(d_rec, back)
    out["u"] = d_u
    return out, np.concatenate([d_gates[:, 0], d_gates[::-1, 1]], axis=2)


class Lexicon:
    """The distinct words of the training windows with their character trigrams."""

    def __init__(self, windows: list[list[str]], least: int = 3):
        seen: dict[str, int] = {}
        for window in windows:
            for word in set(window):
                seen[word] = seen.get(word, 0) + 1
        self.index = {w: i for i, w in enumerate(sorted(seen))}
        common = [w for w in self.index if seen[w] >= least]
        self.vocabulary = {w: i + 1 for i, w in enumerate(common)}  # 0: outside
        self.word_id = np.array([self.vocabulary.get(w, 0) for w in self.index], dtype=np.int64)
        parts = [trigrams(w) for w in self.index]
        self.bucket = np.array([b for x in parts for b in x], dtype=np.int64)
        self.size = np.array([len(x) for x in parts], dtype=np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.size)))[:-1]

    def buckets(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Trigram buckets of some words in a row, and where each word's begin."""
        size = self.size[words]
        start = np.concatenate(([0], np.cumsum(size)))[:-1]
        return self.bucket[np.repeat(self.first[words] - start, size) + np.arange(size.sum())], start

    def vectors(self, p: Params, words: np.ndarray, ids: np.ndarray) -> np.ndarray:
        bucket, start = self.buckets(words)
        chars = np.add.reduceat(p["char"][bucket], start) / self.size[words][:, None]
        return np.concatenate([np.where(ids[:, None] > 0, p["word"][ids], 0), chars], axis=1)


def train_network(
    windows: list[list[str]], labels: np.ndarray, epochs: int = 8, rate: float = 0.01, batch: int = 128, seed: int = 5,
) -> tuple[Lexicon, Params]:
    """Fit the network to windows of normalised words with 0/1 labels by Adam with weight decay.

    In each step some words lose their word vector, so that the character part learns them too.
    """
    rng = np.random.default_rng(seed)
    lexicon = Lexicon(windows)
    p = new_params(len(lexicon.vocabulary), rng)
    ids = np.zeros((WIDTH, len(windows)), dtype=np.int64)
    mask = np.zeros((WIDTH, len(windows)))
    for j, window in enumerate(windows):
        own = [lexicon.index[w] for w in window[:WIDTH] if w in lexicon.index]
        ids[: len(own), j], mask[: len(own), j] = own, 1
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            words, back = np.unique(ids[:, pick], return_inverse=True)
            back = back.reshape(WIDTH, len(pick))
            own = np.where(rng.random(len(words)) < 0.3, 0, lexicon.word_id[words])
            x = lexicon.vectors(p, words, own)
            logit, kept = run_network(p, project(p, x)[back], mask[:, pick], keep=True)
            d_logit = (_sigmoid(logit) - labels[pick]) * weight[pick] / len(pick)
            grads, d_gates = gradients(p, kept, mask[:, pick], d_logit)
            d_words = np.zeros((len(words), d_gates.shape[2]))
            np.add.at(d_words, back.ravel(), d_gates.reshape(-1, d_gates.shape[2]))
            halves = np.stack([d_words[:, : 3 * HIDDEN], d_words[:, 3 * HIDDEN :]])
            grads["wx"] = np.einsum("nd,knh->kdh", x, halves)
            grads["bx"] = halves.sum(axis=1, keepdims=True)
            d_x = np.einsum("knh,kdh->nd", halves, p["wx"])
            grads["word"], grads["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
            np.add.at(grads["word"], own, d_x[:, :WORD_DIM])
            grads["word"][0] = 0
            bucket, _ = lexicon.buckets(words)
            share = np.repeat(d_x[:, WORD_DIM:] / lexicon.size[words][:, None], lexicon.size[words], axis=0)
            np.add.at(grads["char"], bucket, share)
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * grads[k]
                second[k] = 0.99 * second[k] + 0.01 * grads[k] ** 2
                p[k] = (1 - 0.01 * rate) * p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return lexicon, p


class Scorer:
    """Scores all windows of texts; projected words are kept between texts, up to a bound."""

    def __init__(self, vocabulary: dict[str, int], p: Params):
        self.vocabulary = vocabulary
        self.p = {k: v.astype(np.float32) for k, v in p.items()}
        self.rows: dict[str, int] = {}  # of words as they are written
        self.words: dict[str, int] = {}  # of normal words
        self.table = np.zeros((1024, 6 * HIDDEN), dtype=np.float32)

    def _project_new(self, tokens: list[str]) -> None:
        written = [normal(t) for t in tokens]
        words = list(dict.fromkeys(w for w in written if w not in self.words))
        if words:
            need = len(self.words) + len(words) + 1
            if need > len(self.table):
                grown = np.zeros((max(need, 2 * len(self.table)), self.table.shape[1]), dtype=np.float32)
                grown[: len(self.table)] = self.table
                self.table = grown
            bucket, sizes = all_trigrams(words)
            chars = np.add.reduceat(self.p["char"][bucket], np.cumsum(sizes) - sizes)
            ids = np.array([self.vocabulary.get(w, 0) for w in words])
            x = np.concatenate([np.where(ids[:, None] > 0, self.p["word"][ids], 0), chars / sizes[:, None]], axis=1)
            first = len(self.words) + 1
            self.table[first : first + len(words)] = project(self.p, x.astype(np.float32))
            self.words.update(zip(words, range(first, first + len(words))))
        self.rows.update(zip(tokens, map(self.words.__getitem__, written)))

    def _block(self, parts: list[list[str]]) -> Iterator[tuple[float, int, int]]:
        """(highest logit, its window, number of windows) for each of a few texts."""
        flat_tokens = list(itertools.chain.from_iterable(parts))
        new = list(set(flat_tokens).difference(self.rows))
        if new and len(self.rows) + len(new) > WORDS_KEPT:
            self.rows.clear()
            self.words.clear()
            new = list(set(flat_tokens))
        if new:
            self._project_new(sorted(new))
        flat = np.fromiter(map(self.rows.__getitem__, flat_tokens), dtype=np.int64, count=len(flat_tokens))
        flat = np.append(flat, 0)
        size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        counts = (np.maximum(size - STRIDE, 1) + STRIDE - 1) // STRIDE
        first, place = np.cumsum(size) - size, np.cumsum(counts) - counts
        start = np.repeat(first, counts) + STRIDE * (np.arange(counts.sum()) - np.repeat(place, counts))
        end = np.repeat(first + size, counts)
        logit = np.empty(len(start), dtype=np.float32)
        step = np.arange(WIDTH)[:, None]
        whole = start + WIDTH <= end
        for own, full in ((np.flatnonzero(whole), True), (np.flatnonzero(~whole), False)):
            for at in range(0, len(own), BLOCK):
                some = own[at : at + BLOCK]
                words = start[some] + step
                if full:
                    logit[some] = window_logits(self.p, np.take(self.table, flat[words], axis=0))
                else:
                    mask = words < end[some]
                    gates = np.take(self.table, flat[np.where(mask, words, len(flat) - 1)], axis=0)
                    logit[some] = window_logits(self.p, gates, mask.astype(np.float32))
        at = 0
        for n in counts.tolist():
            best = int(logit[at : at + n].argmax())
            yield float(logit[at + best]), best, n
            at += n

    def score(self, texts: list[str | None]) -> Iterator[tuple[float, int, int]]:
        waiting, words = [], 0
        for text in texts:
            waiting.append((text or "").split())
            words += len(waiting[-1])
            if words >= TEXT_WORDS:
                yield from self._block(waiting)
                waiting, words = [], 0
        if waiting:
            yield from self._block(waiting)


def telling_window(tokens: list[str], odds: dict[str, float]) -> int:
    """Start of the window whose words have the highest sum of log-odds."""
    value = np.concatenate(([0.0], np.cumsum([odds.get(t, 0.0) for t in tokens])))
    starts = np.array(window_starts(len(tokens)))
    return int(starts[np.argmax(value[np.minimum(starts + WIDTH, len(tokens))] - value[starts])])


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = _sigmoid(x @ w)
        hess = (x * (q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        w = w + np.linalg.solve(hess, x.T @ (y - q) - 1e-2 * w)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, sample_rows: int = 1200, id_col: str = "doc_id") -> DataFrame:
    """Rows (``_id``, ``_text``, ``label``): about ``sample_rows`` of each label, by hash of the id.

    The sample is drawn from the labels, so only its texts are kept by the join.
    """
    own = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.round(F.avg(label_col)).cast("int").alias("label")
    )
    count = {r["label"]: r["k"] for r in own.groupBy("label").agg(F.count("*").alias("k")).collect()}
    share = F.when(F.col("label") == 1, F.lit(min(1.0, sample_rows / max(count.get(1, 0), 1)))).otherwise(
        F.lit(min(1.0, sample_rows / max(count.get(0, 0), 1)))
    )
    chosen = own.filter(F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(1_000_000)) < share * 1_000_000)
    return docs.join(F.broadcast(chosen), "_id").select("_id", "_text", "label")


def word_odds(chosen: DataFrame, most: int = 3000) -> dict[str, float]:
    """Log-odds of label 1 for the ``most`` words whose documents differ most by label."""
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w, y) for t, y in zip(batch["_text"], batch["label"]) for w in {normal(t) for t in (t or "").split()}]
            yield pd.DataFrame(rows, columns=["word", "label"])

    total = chosen.agg(F.sum("label").alias("ones"), F.count("*").alias("n")).first()
    ones, zeros = total["ones"], total["n"] - total["ones"]
    per = chosen.mapInPandas(words, "word string, label int").groupBy("word").agg(F.sum("label").alias("a"), F.count("*").alias("n"))
    odds = F.log((F.col("a") + 0.5) / (ones + 1)) - F.log((F.col("n") - F.col("a") + 0.5) / (zeros + 1))
    found = per.filter("n >= 3").select("word", odds.alias("o")).orderBy(F.desc(F.abs("o")), "word").limit(most).collect()
    return {r["word"]: r["o"] for r in found}


def train(chosen: DataFrame) -> dict:
    """A plain dict model from the bounded rows of :func:`labelled_sample`.

    First fit: the window of each text whose words tell most, and for label 0 one more by chance.
    Second fit: these and the window of each text that the first network scores highest.
    """
    count = {r["label"]: r["k"] for r in chosen.groupBy("label").agg(F.count("*").alias("k")).collect()}
    if not count.get(0) or not count.get(1):
        total = sum(count.values())
        return {"share": 0.5 if not total else count.get(1, 0) / total}
    odds = word_odds(chosen)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, label in zip(batch["_text"], batch["label"]):
                tokens = [normal(t) for t in (text or "").split()]
                starts = [telling_window(tokens, odds)]
                if label == 0:
                    starts.append(window_starts(len(tokens))[zlib.crc32(repr(tokens[:50]).encode()) % len(window_starts(len(tokens)))])
                rows += [(label, tokens[s : s + WIDTH]) for s in starts]
            yield pd.DataFrame(rows, columns=["label", "words"])

    found = sorted((r["words"], r["label"]) for r in chosen.mapInPandas(first, "label int, words array<string>").collect())
    lexicon, p = train_network([w for w, _ in found], np.array([y for _, y in found], dtype=np.float64))

    def highest(model: dict):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer = Scorer(model["vocabulary"], model["params"])
            for batch in batches:
                rows = []
                for text, label, (logit, best, n) in zip(batch["_text"], batch["label"], scorer.score(batch["_text"].tolist())):
                    tokens = (text or "").split()[best * STRIDE : best * STRIDE + WIDTH]
                    rows.append((label, [normal(t) for t in tokens], logit, n))
                yield pd.DataFrame(rows, columns=["label", "words", "logit", "n"])

        rows = chosen.mapInPandas(run, "label int, words array<string>, logit double, n int").collect()
        return sorted((r["words"], r["label"], r["logit"], r["n"]) for r in rows)

    top = highest({"vocabulary": lexicon.vocabulary, "params": p})
    lexicon, p = train_network(
        [w for w, *_ in top] + [w for w, _ in found],
        np.array([y for _, y, *_ in top] + [y for _, y in found], dtype=np.float64),
    )
    model = {"vocabulary": lexicon.vocabulary, "params": p}
    top = highest(model)
    x = np.array([[1.0, logit, np.log(n)] for _, _, logit, n in top])
    model["calibration"] = _logistic(x, np.array([y for _, y, *_ in top], dtype=np.float64))
    return model


def score_documents(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, n_windows) for every row; all overlapping windows are scored."""
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = id(shared)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        kept = process_cache()
        if "params" in own and kept.get("toxicity", (None,))[0] != key:
            kept["toxicity"] = (key, Scorer(own["vocabulary"], own["params"]))
        for batch in batches:
            if "params" in own:
                found = list(kept["toxicity"][1].score(batch["_text"].tolist()))
                x = np.array([[1.0, logit, np.log(n)] for logit, _, n in found]).reshape(-1, 3)
                score, count = _sigmoid(x @ own["calibration"]), [n for *_, n in found]
            else:
                score = np.full(len(batch), own["share"])
                count = [len(window_starts(len((t or "").split()))) for t in batch["_text"]]
            yield pd.DataFrame({id_col: batch["_id"], "score": score, "predicted": (score >= 0.5).astype(np.int32), "n_windows": count})

    return rows.mapInPandas(run, f"`{id_col}` {kind}, score double, predicted int, n_windows int")
