"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Every whole text becomes a row of document statistics.  Standardised statistics go through random
Fourier features, which approximate a Gaussian kernel.  Every task adds up its part of the normal
equations X'X and X'y, Spark sums the parts row by row of the matrix, and the driver solves one
system of the feature count.  Isotonic regression over a fixed histogram of training scores maps
the ridge score to a share of label 1.

Null texts count as empty: their statistics are those of an empty text, and they get a score too.
Labels that are null are skipped, several labels of an id are averaged and rounded.  Without any
label every score is 0.5.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import id_text

STATS = (
    "log_chars", "log_words", "word_length", "distinct_words", "repeated_next", "upper", "digit", "symbol",
    "punctuation", "blank", "newline", "wide", "entropy", "dup_lines", "line_length", "short_words",
)
BINS = 2000
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&|<>@^~=+{}[]\\/_`",
    "punctuation": b".,;:!?\"'()-", "blank": b" \t\r\x0b\x0c", "newline": b"\n", "wide": bytes(range(128, 256)),
}


def statistics(text: str | None) -> tuple[float, ...]:
    """The numbers named in :data:`STATS` for a whole text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size = max(len(data), 1)
    share = {k: float(count[np.frombuffer(v, dtype=np.uint8)].sum()) / size for k, v in _KINDS.items()}
    p = count[count > 0] / size
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    return (
        np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / n, len(set(words)) / n,
        sum(map(str.__eq__, words, words[1:])) / n, share["upper"], share["digit"], share["symbol"],
        share["punctuation"], share["blank"], share["newline"], share["wide"], float(-(p * np.log2(p)).sum()),
        1 - len(set(lines)) / max(len(lines), 1), np.log1p(len(text) / max(len(lines), 1)),
        sum(len(w) <= 2 for w in words) / n,
    )


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``_id``, ``stats`` as array<double>) for every row."""
    rows = id_text(docs, id_col, text_col)
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"_id": batch["_id"], "stats": [statistics(t) for t in batch["_text"]]})

    return rows.mapInPandas(run, f"_id {kind}, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray  # statistics x features
    phase: np.ndarray
    weight: np.ndarray | None = None
    edges: np.ndarray | None = None  # of the calibration bins, ascending ridge scores
    level: np.ndarray | None = None  # share of label 1 by bin, never falling

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2.0 / len(self.phase)) * np.cos(z @ self.waves + self.phase)
        return np.hstack([np.ones((len(z), 1)), z, waves])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weight

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.ridge(stats), self.edges, self.level)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-falling sequence closest to ``value``: pool adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.array(batch["stats"].tolist(), dtype=np.float64).reshape(-1, len(STATS))


def _sums(rows: DataFrame, parts) -> dict[int, np.ndarray]:
    """Sums of (index, vector) parts that tasks yield, by index: first in the task, then by Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: np.ndarray | None = None
        for batch in batches:
            if len(batch):
                own = parts(batch)
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": list(total)})

    spread = rows.mapInPandas(run, "i int, v array<double>")
    flat = spread.select("i", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    out: dict[int, np.ndarray] = {}
    found = flat.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "x")))["x"].alias("v")).collect()
    for r in found:
        out[r["i"]] = np.array(r["v"])
    return out


def fit(rows: DataFrame, features: int = 192, width: float = 4.0, penalty: float = 1e-3, seed: int = 17) -> Model | None:
    """Model from rows (``stats``, ``label`` 0/1); None without any row."""
    k = len(STATS)
    moments = _sums(rows, lambda b: (lambda x: np.vstack([np.full(k, len(x)), x.sum(0), (x * x).sum(0)]))(_matrix(b)))
    if not moments:
        return None
    n, first, second = moments[0], moments[1], moments[2]
    mean = first / n
    scale = np.sqrt(np.maximum(second / n - mean**2, 0))
    rng = np.random.default_rng(seed)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(size=(k, features)) / width, rng.uniform(0, 2 * np.pi, features))

    def normal(batch: pd.DataFrame) -> np.ndarray:
        x = model.features(_matrix(batch))
        return np.hstack([x.T @ x, (x.T @ batch["label"].to_numpy(np.float64))[:, None]])

    equations = _sums(rows, normal)
    both = np.stack([equations[i] for i in range(1 + k + features)])
    left, right = both[:, :-1], both[:, -1]
    ridge = penalty * n[0] * np.eye(len(left))
    ridge[0, 0] = 0
    model.weight = np.linalg.solve(left + ridge, right)
    _calibrate(model, rows)
    return model


def _calibrate(model: Model, rows: DataFrame) -> None:
    edges = np.linspace(-0.5, 1.5, BINS + 1)

    def histogram(batch: pd.DataFrame) -> np.ndarray:
        at = np.clip(np.searchsorted(edges, model.ridge(_matrix(batch)), "right") - 1, 0, BINS - 1)
        label = batch["label"].to_numpy(np.float64)
        return np.vstack([np.bincount(at, minlength=BINS), np.bincount(at, label, BINS)]).astype(np.float64)

    found = _sums(rows, histogram)
    seen = np.flatnonzero(found[0] > 0)
    count, ones = found[0][seen], found[1][seen]
    model.edges = (edges[seen] + edges[seen + 1]) / 2
    model.level = np.clip(isotonic(ones / count, count), 0.0, 1.0)


def labelled_rows(stats: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """``stats`` with ``label``: the rounded mean of the labels of an id."""
    own = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.round(F.avg(label_col)).cast("int").alias("label")
    )
    return stats.join(own, "_id")


def score_documents(stats: DataFrame, model: Model | None, id_col: str = "doc_id") -> DataFrame:
    """(id, score, predicted) for every row of :func:`document_statistics`."""
    kind = stats.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = np.full(len(batch), 0.5) if model is None or not len(batch) else model.score(_matrix(batch))
            yield pd.DataFrame({id_col: batch["_id"], "score": score, "predicted": (score >= 0.5).astype(np.int32)})

    return stats.mapInPandas(run, f"`{id_col}` {kind}, score double, predicted int")
