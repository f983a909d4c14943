"""Language identification with interpolated Kneser-Ney character models.

Characters are lower-cased letters; everything else is one blank, runs of blanks collapse and every
text starts with blanks.  n-grams are packed into 64-bit hashes.  The counts of the longest n-grams
cover all training rows: every task counts its own rows by sorting hashes, and Spark sums the counts
per (language, n-gram).  Lower orders use Kneser-Ney continuation counts, which follow from the
distinct n-grams one order above.  The models are one stored table of n-grams per order, with the
counts of every language; no n-gram is left out, and only totals come to the driver.

Texts are scored in blocks: the distinct n-grams of each block meet the tables in joins, from the
shortest order up, and the probabilities go back to the block, whose texts are stored once in
buckets and not shuffled.  :func:`fit` makes the same models in memory, from counts that fit there.

A text gets the language of the lowest cross-entropy per character.  The rejection threshold of a
language is calibrated on all training rows: mean plus a number of standard deviations of their
cross-entropy, wider for short texts by the inverse root of the length.

Null texts, and texts without a letter, get ``und`` with score 0 and are rejected.  Texts of any
length are scored whole, in blocks.  Ties go to the first language in sorted order.  Without
training rows every text is ``und``.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.llm.common import (
    MADE, byte_blocks, co_located, drop_tables, give_back, id_text, process_cache, release_shuffles, small_batches,
)
from riskweave.session import staged

ORDER = 5
BITS = 12
BLANK = 1
UNKNOWN = "und"
BLOCK = 2_000_000
PIECE = 1_000_000  # bytes of text whose n-grams are listed at once
ZSTD_LEVEL = 5  # of stored texts; a sixth smaller than at level 1; the blocks are the most of the disk
TEXT_BLOCK, GRAM_BLOCK = 32_000_000, 1_000_000  # bytes of text and distinct n-grams that end a block of texts


def _classes() -> np.ndarray:
    """Code of every code point of the basic plane: a letter's own lower-case code, else the blank.

    Letters are folded into ``2**BITS - 2`` codes; Latin, Greek and Cyrillic letters keep one each.
    """
    kept = process_cache()
    if "letters" not in kept:
        codes = np.full(0x110000, BLANK, dtype=np.uint16)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = ord(c.lower()[0])
                codes[i] = 2 + low % ((1 << BITS) - 2)
        kept["letters"] = codes
    return kept["letters"]


def letters(text: str) -> np.ndarray:
    """Codes of a text, blanks collapsed, ``ORDER - 1`` blanks in front and one at the end."""
    codes = _classes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    codes = codes[np.concatenate(([True], (codes[1:] != BLANK) | (codes[:-1] != BLANK)))] if len(codes) else codes
    if len(codes) and codes[0] == BLANK:
        codes = codes[1:]
    if len(codes) and codes[-1] == BLANK:
        codes = codes[:-1]
    if not len(codes):
        return codes.astype(np.int64)
    edge = np.full(ORDER - 1, BLANK, dtype=np.int64)
    return np.concatenate((edge, codes.astype(np.int64), edge[:1]))


def grams(codes: np.ndarray) -> np.ndarray:
    """Packed n-grams of the longest order, one for each character after the leading blanks."""
    n = len(codes) - ORDER + 1
    packed = np.zeros(max(n, 0), dtype=np.int64)
    for k in range(ORDER):
        packed = (packed << BITS) | codes[k : k + n]
    return packed


def _batch_grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of many texts in a row, and how many each text has (0: no letter)."""
    parts = [grams(letters(t)) if t else np.zeros(0, dtype=np.int64) for t in texts]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64), np.array([len(p) for p in parts])


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``labelled`` (``_text``, ``lang``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        size = 0

        def settle() -> None:
            for lang, parts in held.items():
                own, n = np.unique(np.concatenate(parts), return_counts=True)
                if lang in counts:
                    both = np.concatenate((counts[lang][0], own))
                    own, back = np.unique(both, return_inverse=True)
                    n = np.bincount(back, np.concatenate((counts[lang][1], n))).astype(np.int64)
                counts[lang] = own, n
            held.clear()

        # a piece is a megabyte of short texts or one long text
        for rows, _, _ in byte_blocks(batches, "_text", PIECE):
            own, n = _batch_grams(rows.column("_text").to_pylist())
            langs = rows.column("lang").dictionary_encode()
            owner = np.repeat(langs.indices.to_numpy(zero_copy_only=False), n)
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                held.setdefault(lang, []).append(own[owner == k])
            size += len(own)
            if size >= PIECE:
                settle()
                size = 0
            if sum(len(x[0]) for x in counts.values()) >= BLOCK:
                yield from _frames(counts)
                counts.clear()
        settle()
        yield from _frames(counts)
        counts.clear()
        give_back()

    def _frames(counts: dict) -> Iterator[pa.RecordBatch]:
        for lang, (own, n) in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(own), dtype=np.int32))), pa.array(own, pa.int64()), pa.array(n, pa.int64())],
                ["lang", "gram", "n"],
            )

    return (
        labelled.select("_text", "lang").mapInArrow(run, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


@dataclass
class Model:
    """Models in memory: sorted hash arrays per order with log probabilities (natural) per language."""

    languages: list[str]
    hashes: list[np.ndarray] = field(default_factory=list)  # by order, from 1
    scores: list[np.ndarray] = field(default_factory=list)  # rows of hashes x languages
    backoff: list[np.ndarray] = field(default_factory=list)  # of the histories among hashes
    unseen: float = 0.0


def _continuations(grams_: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams one order below and the number of distinct characters before each."""
    below = grams_ & ((1 << (BITS * (order - 1))) - 1)
    return np.unique(below, return_counts=True)


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Interpolated Kneser-Ney models from the counts of the longest n-grams of each language."""
    languages = sorted(counts)
    model = Model(languages)
    tables: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for lang in languages:
        own, n = counts[lang]
        chain = [(own, n.astype(np.float64))]
        for order in range(ORDER, 1, -1):
            below, c = _continuations(chain[0][0], order)
            chain.insert(0, (below, c.astype(np.float64)))
        tables.append(chain)
    vocabulary = np.unique(np.concatenate([t[0][0] for t in tables]))
    base = 1.0 / (len(vocabulary) + 1)
    for order in range(1, ORDER + 1):
        hashes = np.unique(np.concatenate([t[order - 1][0] for t in tables]))
        history = hashes >> BITS
        below = hashes & ((1 << (BITS * (order - 1))) - 1)
        score = np.zeros((len(hashes), len(languages)))
        heads = np.unique(history)
        back = np.zeros((len(heads), len(languages)))
        place = np.searchsorted(heads, history)
        for j, chain in enumerate(t[order - 1] for t in tables):
            own, c = chain
            count = np.zeros(len(hashes))
            count[np.searchsorted(hashes, own)] = c
            once, twice = (c == 1).sum(), (c == 2).sum()
            discount = min(0.95, max(0.1, once / max(once + 2 * twice, 1)))
            total = np.bincount(place, count, len(heads))
            kinds = np.bincount(place, count > 0, len(heads))
            weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            under = base if order == 1 else _under(model, order - 1, below, j)
            value = np.maximum(count - discount, 0) / np.maximum(total, 1)[place] + weight[place] * under
            score[:, j] = np.log(value)
            back[:, j] = np.log(weight)
        model.hashes.append(hashes)
        model.scores.append(score.astype(np.float32))
        model.backoff.append(back.astype(np.float32))
    model.unseen = float(np.log(base))
    return model


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, wanted)
    at[at == len(table)] = 0
    return at, table[at] == wanted


def _under(model: Model, order: int, wanted: np.ndarray, j: int) -> np.ndarray:
    """Probability of n-grams of a lower order, all of which are in the table of some language."""
    at, hit = _find(model.hashes[order - 1], wanted)
    return np.where(hit, np.exp(model.scores[order - 1][at, j].astype(np.float64)), np.exp(model.unseen))


def log_probability(model: Model, grams_: np.ndarray) -> np.ndarray:
    """Log probability of each n-gram's last character under every language (rows x languages)."""
    out = np.empty((len(grams_), len(model.languages)), dtype=np.float32)
    order = ORDER
    rest, own = np.arange(len(grams_)), grams_
    added = np.zeros((len(grams_), len(model.languages)), dtype=np.float32)
    while len(rest) and order:
        at, hit = _find(model.hashes[order - 1], own)
        out[rest[hit]] = added[hit] + model.scores[order - 1][at[hit]]
        rest, own, added = rest[~hit], own[~hit], added[~hit]
        if len(rest):
            heads = _heads(model, order)
            at, known = _find(heads, own >> BITS)
            added = added + np.where(known[:, None], model.backoff[order - 1][at], 0)
            own = own & ((1 << (BITS * (order - 1))) - 1)
        order -= 1
    out[rest] = added + model.unseen
    return out


def _heads(model: Model, order: int) -> np.ndarray:
    kept = model.__dict__.setdefault("_head_tables", {})
    if order not in kept:
        kept[order] = np.unique(model.hashes[order - 1] >> BITS)
    return kept[order]


@dataclass
class Tables:
    """Models as stored tables (gram, c) per order, from 1: ``c`` holds the count of every language."""

    languages: list[str]
    counts: list[DataFrame]
    discounts: list[list[float]]
    totals: list[int]  # of the single characters
    kinds: list[int]  # distinct single characters of each language
    base: float
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None


def _sums(languages: list[str], value: Callable[[int], Column]) -> Column:
    return F.array(*[F.sum(value(j)).cast("long") for j in range(len(languages))])


def tabulate(counted: DataFrame) -> Tables | None:
    """Models from the counts (lang, gram, n) of the longest n-grams; None without any."""
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    if not languages:
        return None
    own = lambda j: F.when(F.col("lang") == languages[j], F.col("n")).otherwise(0)
    some = lambda j: (F.col("c")[j] > 0).cast("long")
    tables = [staged(counted.groupBy("gram").agg(_sums(languages, own).alias("c")), f"grams-{ORDER}")]
    for order in range(ORDER, 1, -1):
        below = F.col("gram").bitwiseAND((1 << (BITS * (order - 1))) - 1)
        tables.insert(0, staged(tables[0].groupBy(below.alias("gram")).agg(_sums(languages, some).alias("c")), f"grams-{order - 1}"))
    discounts = []
    for table in tables:
        seen = table.agg(*[_sums(languages, lambda j, k=k: (F.col("c")[j] == k).cast("long")).alias(f"c{k}") for k in (1, 2)]).first()
        discounts.append([min(0.95, max(0.1, a / max(a + 2 * b, 1))) for a, b in zip(seen["c1"], seen["c2"])])
    single = tables[0].agg(
        F.count("*").alias("n"), _sums(languages, lambda j: F.col("c")[j]).alias("totals"), _sums(languages, some).alias("kinds")
    ).first()
    return Tables(languages, tables, discounts, single["totals"], single["kinds"], 1.0 / (single["n"] + 1))


def log_probabilities(model: Tables, wanted: DataFrame) -> DataFrame:
    """(gram, p): log probability of each distinct ``gram``'s last character under every language.

    Each order joins the counts of its n-grams, the sums over their histories and the order below.
    """
    size = range(len(model.languages))
    asked = [wanted]
    for order in range(ORDER, 1, -1):
        asked.insert(0, asked[0].select(F.col("gram").bitwiseAND((1 << (BITS * (order - 1))) - 1).alias("gram")).distinct())
    found = None
    for order, (rows, table, discount) in enumerate(zip(asked, model.counts, model.discounts), 1):
        rows = rows.join(table, "gram", "left")
        if order == 1:
            totals, kinds = ([F.lit(x) for x in part] for part in (model.totals, model.kinds))
            under = [F.lit(model.base) for _ in size]
        else:
            history = table.groupBy(F.shiftright("gram", BITS).alias("head")).agg(
                _sums(model.languages, lambda j: F.col("c")[j]).alias("t"),
                _sums(model.languages, lambda j: (F.col("c")[j] > 0).cast("long")).alias("k"),
            )
            rows = rows.withColumn("head", F.shiftright("gram", BITS)).join(history, "head", "left")
            rows = rows.withColumn("below", F.col("gram").bitwiseAND((1 << (BITS * (order - 1))) - 1))
            rows = rows.join(found.select(F.col("gram").alias("below"), F.col("p").alias("under")), "below")
            totals, kinds = ([F.coalesce(F.col(part)[j], F.lit(0)) for j in size] for part in ("t", "k"))
            under = [F.col("under")[j] for j in size]
        value = [
            F.when(totals[j] > 0, (
                F.greatest(F.coalesce(F.col("c")[j], F.lit(0)) - F.lit(discount[j]), F.lit(0.0)) + F.lit(discount[j]) * kinds[j] * under[j]
            ) / totals[j]).otherwise(under[j])
            for j in size
        ]
        found = rows.select("gram", F.array(*value).alias("p"))
    return found.select("gram", F.transform("p", lambda x: F.log(x).cast("float")).alias("p"))


def entropies(look: Callable[[np.ndarray], np.ndarray], languages: int, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character (texts x languages) and the number of characters of each text.

    ``look`` gives the log probabilities of distinct n-grams; equal n-grams of a block are looked up once.
    """
    result, sizes = [np.zeros((0, languages))], [np.zeros(0, dtype=np.int64)]
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars < PIECE // 4):
            chars += len(texts[end] or "")
            end += 1
        own, n = _batch_grams(texts[at:end])
        if len(own):
            distinct, back = np.unique(own, return_inverse=True)
            score = look(distinct)
            owner = np.repeat(np.arange(len(n)), n)
            total = np.stack([np.bincount(owner, score[back, j], len(n)) for j in range(score.shape[1])], axis=1)
        else:
            total = np.zeros((len(n), languages))
        result.append(-total / np.maximum(n, 1)[:, None])
        sizes.append(n)
        at = end
    return np.concatenate(result), np.concatenate(sizes)


def _united(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The distinct values of two sorted arrays, sorted; a merge, as the stable sort finds both stretches."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return both[np.concatenate(([True], both[1:] != both[:-1]))] if len(both) else both


def _text_blocks(docs: DataFrame, text_col: str) -> DataFrame:
    """(block, rows, grams): the rows of ``docs`` packed in blocks, and the sorted distinct n-grams of each.

    A block ends after ``TEXT_BLOCK`` bytes or ``GRAM_BLOCK`` n-grams, so it fits in a task.  It comes in
    pieces, either rows or n-grams, of about a megabyte, so that no cell of the table is large.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        grams_ = np.zeros(0, dtype=np.int64)
        size = 0

        def piece(rows: bytes | None, own: np.ndarray | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([rows], pa.binary()), pa.array([own], pa.list_(pa.int64()))],
                ["block", "rows", "grams"],
            )

        def listed() -> Iterator[pa.RecordBatch]:
            for first in range(0, len(grams_), PIECE // 8):
                yield piece(None, grams_[first : first + PIECE // 8])

        for batch in batches:
            long = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
            first = 0
            while first < len(long):
                before = long[first - 1] if first else 0
                end = max(first + 1, int(np.searchsorted(long, before + PIECE, "right")))
                part = batch.slice(first, end - first)
                yield piece(_packed(part), None)
                grams_ = _united(grams_, np.unique(_batch_grams(part.column(at).to_pylist())[0]))
                size += int(long[end - 1] - before)
                first = end
                if size >= TEXT_BLOCK or len(grams_) >= GRAM_BLOCK:
                    yield from listed()
                    block, grams_, size = block + 1, np.zeros(0, dtype=np.int64), 0
                    give_back()
        yield from listed()
        grams_ = None
        give_back()

    return docs.mapInArrow(run, "block long, rows binary, grams array<long>")


def _packed(rows: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=ZSTD_LEVEL))) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _scored(
    docs: DataFrame, model: Tables, text_col: str,
    finish: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch], schema: T.StructType | str,
) -> DataFrame:
    """What ``finish`` makes of the rows of ``docs``, their cross-entropies and numbers of characters."""
    small_batches(docs.sparkSession)
    blocks = co_located(_text_blocks(docs, text_col), "block", "text-blocks")
    release_shuffles(docs.sparkSession)
    wanted = blocks.select("block", F.explode("grams").alias("gram"))
    looked = wanted.join(log_probabilities(model, wanted.select("gram").distinct()), "gram").select(F.col("block").alias("of"), "gram", "p")
    at, languages = docs.columns.index(text_col), len(model.languages)

    def run(packed: pa.Table, probabilities: pa.Table) -> pa.Table:
        known = probabilities.column("gram").to_numpy()
        order = np.argsort(known)
        known = known[order]
        scores = probabilities.column("p").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, languages)[order]
        del order, probabilities
        give_back()
        out = []
        for rows in packed.column("rows"):
            for part in pa.ipc.open_stream(rows.as_buffer()):
                h, n = entropies(lambda x: scores[np.searchsorted(known, x)], languages, part.column(at).to_pylist())
                out.append(finish(part, h, n))
        del known, scores
        give_back()
        return pa.Table.from_batches(out)

    packed_rows = blocks.filter(F.col("rows").isNotNull()).select("block", "rows")
    return packed_rows.groupBy("block").cogroup(looked.groupBy("of")).applyInArrow(run, schema)


def cross_entropies(docs: DataFrame, model: Tables, text_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, its cross-entropy under every language (``_h``) and number of characters (``_n``)."""
    at = [docs.columns.index(c) for c in keep]

    def finish(part: pa.RecordBatch, h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        own = [pa.array(list(h), pa.list_(pa.float64())), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays([part.column(i) for i in at] + own, [*keep, "_h", "_n"])

    schema = T.StructType([docs.schema[c] for c in keep]).add("_h", T.ArrayType(T.DoubleType())).add("_n", T.LongType())
    return _scored(docs, model, text_col, finish, schema)


def learn(labelled: DataFrame) -> Tables | None:
    """Models without thresholds from all rows of ``labelled`` (``_text``, ``lang``); None without any n-gram."""
    small_batches(labelled.sparkSession)
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("_text").isNotNull())
    model = tabulate(staged(count_grams(labelled), "gram-counts"))
    release_shuffles(labelled.sparkSession)
    return model


def calibrate(model: Tables, scored: DataFrame) -> None:
    """Mean and spread of the cross-entropy of all training texts (``lang``, ``_h``, ``_n``) under their own language.

    A language whose texts hold no letter has no n-gram: it is no answer of the models and has no threshold.
    """
    own = F.coalesce(*[F.when(F.col("lang") == lang, F.col("_h")[j]) for j, lang in enumerate(model.languages)])
    stats = scored.filter("_n >= 30").select("lang", own.alias("h")).filter(F.col("h").isNotNull()).groupBy("lang").agg(
        F.avg("h").alias("mean"), F.stddev_pop("h").alias("sd")
    ).collect()
    index = {lang: j for j, lang in enumerate(model.languages)}
    model.mean = np.full(len(index), np.inf)
    model.spread = np.full(len(index), 1.0)
    for r in stats:
        model.mean[index[r["lang"]]], model.spread[index[r["lang"]]] = r["mean"], max(r["sd"], 0.02)


def train(labelled: DataFrame) -> Tables | None:
    """Models and thresholds from all rows of ``labelled`` (``_id``, ``_text``, ``lang``); None without any n-gram."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("_text").isNotNull()).select(F.col("_text").cast("string").alias("_text"), "lang")
    model = learn(labelled)
    if model is not None:
        calibrate(model, cross_entropies(labelled, model, "_text", ["lang"]))
        release_shuffles(labelled.sparkSession)
    return model


def predict(
    docs: DataFrame, model: Tables | None, id_col: str = "doc_id", text_col: str = "text",
    deviations: float = 8.0, short: float = 6.0,
) -> DataFrame:
    """(id, lang_pred, score, cross_entropy, rejected) for every row.

    ``score`` is the posterior of the best language for the characters read, ties sharing it.
    """
    rows = id_text(docs, id_col, text_col)
    if model is None:
        return rows.select(
            F.col("_id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"),
        )
    scored = cross_entropies(rows, model, "_text", ["_id"]).withColumnRenamed("_id", id_col)
    return verdicts(scored, model, id_col, deviations, short)


def verdicts(scored: DataFrame, model: Tables, id_col: str = "doc_id", deviations: float = 8.0, short: float = 6.0) -> DataFrame:
    """What :func:`predict` says, from cross-entropies (id, ``_h``, ``_n``)."""
    judged, languages = _judging(model, deviations, short), len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(1).flatten().to_numpy().reshape(-1, languages)
            lang, score, best, gone = judged(h, batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(best, from_pandas=True), pa.array(gone)],
                [id_col, "lang_pred", "score", "cross_entropy", "rejected"],
            )

    kind = scored.schema[id_col].dataType.simpleString()
    return scored.select(id_col, "_h", "_n").mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")


def _judging(model: Tables, deviations: float = 8.0, short: float = 6.0) -> Callable[..., tuple[np.ndarray, ...]]:
    """(language, score, cross-entropy, rejected) from the cross-entropies and numbers of characters of texts."""
    languages, mean, spread = model.languages, model.mean, model.spread

    def judged(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        k = len(n)
        lang, score, best = np.full(k, UNKNOWN, dtype=object), np.zeros(k), np.full(k, np.nan)
        j = h.argmin(axis=1)
        low = h[np.arange(k), j]
        gap = np.minimum((h - low[:, None]) * np.maximum(n, 1)[:, None], 700)
        real = n > 0
        lang[real] = np.array(languages, dtype=object)[j[real]]
        score[real] = (1 / np.exp(-gap).sum(axis=1))[real]
        best[real] = low[real]
        limit = mean[j] + deviations * spread[j] + short / np.sqrt(np.maximum(n, 1))
        return lang, score, best, ~real | (low > limit)

    return judged


def _accepts(model: Tables, deviations: float = 8.0, short: float = 6.0) -> Column:
    """Whether a text with cross-entropies ``_h`` and ``_n`` characters is accepted, as :func:`_judging` says."""
    low = F.array_min("_h")
    best = F.array_position("_h", low).cast("int")  # the first of equal ones
    mean, spread = (F.element_at(F.array(*[F.lit(float(x)) for x in own]), best) for own in (model.mean, model.spread))
    return (F.col("_n") > 0) & (low <= mean + deviations * spread + short / F.sqrt(F.greatest("_n", F.lit(1))))


def recognised(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that models learnt from their labelled rows accept.

    Every text is scored once; the scores give the thresholds and then the answers.
    """
    labelled = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(lang_col).alias("lang"))
    model = learn(labelled)
    if model is None:
        return docs.limit(0)
    # names of the caller's columns cannot clash with those of the scores
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text, lang = (f"c{docs.columns.index(c)}" for c in (text_col, lang_col))
    made = len(MADE)
    scored = staged(cross_entropies(renamed, model, text, renamed.columns), "scored-texts")
    drop_tables(docs.sparkSession, made)  # the blocks of texts
    release_shuffles(docs.sparkSession)
    calibrate(model, scored.select(F.col(lang).alias("lang"), "_h", "_n"))
    return scored.filter(_accepts(model)).select(*renamed.columns).toDF(*docs.columns)


def accepted(docs: DataFrame, model: Tables | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the models do not reject."""
    if model is None:
        return docs.limit(0)
    judged = _judging(model)

    def finish(part: pa.RecordBatch, h: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return part.filter(pa.array(~judged(h, n)[3]))

    return _scored(docs, model, text_col, finish, docs.schema)
