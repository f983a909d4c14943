"""Learnt operators on held-out rows, the pipeline against brute force, and the registered queries."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, odd_documents, prose, repeated_bytes, similar_groups, window_hits
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from riskweave.llm import language_id, quality_model, toxicity
from riskweave.llm.common import held_out, id_text

TONGUES = {"aa": "abcde", "bb": "defgh", "cc": "xyzéß"}


def spoken(seed: int, each: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = [(prose(rng, rng.randint(5, 60), letters).title(), lang) for lang, letters in TONGUES.items() for _ in range(each)]
    rng.shuffle(rows)
    return [(i, t, lang) for i, (t, lang) in enumerate(rows)]


def test_language_models(spark):
    frame = spark.createDataFrame(spoken(1, 60), "_id long, _text string, lang string").repartition(4)
    model = language_id.train(frame)
    other = spark.createDataFrame([(i, t, lang, "clash") for i, t, lang in spoken(2, 30)] + [
        (1000, None, None, ""), (1001, "", None, ""), (1002, "12 ... !!", None, ""), (1003, "wwww qqqq jjjj kkkk wwwq jjkk " * 9, None, ""),
    ], "doc_id long, text string, lang string, lang_pred string")
    found = {r["doc_id"]: r for r in language_id.predict(other, model).collect()}
    real = [(i, lang) for i, _, lang in spoken(2, 30)]
    assert np.mean([found[i]["lang_pred"] == lang for i, lang in real]) > 0.97
    assert not any(found[i]["rejected"] for i, _ in real)
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 and found[i]["rejected"] for i in (1000, 1001, 1002))
    assert found[1003]["rejected"] and all(0 <= r["score"] <= 1 for r in found.values())
    assert {r["doc_id"] for r in language_id.accepted(other, model).collect()} == {i for i, _ in real}
    assert language_id.accepted(other, model).columns == other.columns
    assert language_id.train(frame.limit(0)) is None
    assert language_id.predict(other, None).filter("lang_pred <> 'und'").count() == 0


def test_texts_are_recognised_in_one_scoring(spark):
    rows = spoken(6, 60) + [(900, None, "x"), (901, "", None), (902, "12 ... !!", "x"), (903, "wwww qqqq jjjj kkkk wwwq jjkk " * 9, None)]
    docs = spark.createDataFrame([(*r, r[1], 7, [1.0]) for r in rows], "doc_id long, text string, lang string, _text string, _n int, _h array<double>")
    model = language_id.train(docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), "lang"))
    kept = language_id.recognised(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in language_id.accepted(docs, model).collect())
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows if r[0] < 900}
    assert language_id.recognised(docs.limit(0)).count() == 0 and language_id.recognised(docs.withColumn("lang", F.lit(None).cast("string"))).count() == 0


def test_kneser_ney_probabilities_sum_to_one():
    own, n = np.unique(language_id._batch_grams([t for _, t, _ in spoken(4, 20)])[0], return_counts=True)
    model = language_id.fit({"x": (own, n)})
    seen = model.hashes[0]
    for history in np.unique(own >> language_id.BITS)[:20]:
        grams = (int(history) << language_id.BITS) | seen
        total = np.exp(language_id.log_probability(model, grams).astype(float)).sum()
        assert total <= 1 + 1e-5 and total > 0.9  # the rest is left to characters never seen


def test_gram_counts_cover_all_rows(spark):
    rows = spoken(3, 15)
    counted = language_id.count_grams(spark.createDataFrame(rows, "_id long, _text string, lang string").repartition(5))
    want = {}
    for _, t, lang in rows:
        for g in language_id._batch_grams([t])[0].tolist():
            want[lang, g] = want.get((lang, g), 0) + 1
    assert {(r["lang"], r["gram"]): r["n"] for r in counted.collect()} == want


def test_held_out_rows(spark):
    ids = [*range(50), -3, None]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").select(held_out(F.col("i"), 5, 0)).collect()]
    assert got == [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]


def test_isotonic_regression():
    rng = np.random.default_rng(1)
    value, weight = rng.random(60), rng.integers(1, 5, 60).astype(float)
    fit = quality_model.isotonic(value, weight)
    assert (np.diff(fit) >= -1e-12).all() and abs((fit * weight).sum() - (value * weight).sum()) < 1e-9
    loss = ((fit - value) ** 2 * weight).sum()
    for _ in range(200):
        assert loss <= ((np.sort(fit + rng.normal(0, 0.05, 60)) - value) ** 2 * weight).sum() + 1e-9


def test_quality_model(spark):
    rng = random.Random(6)
    good = [(2 * i, prose(rng, rng.randint(20, 120)), 1) for i in range(150)]
    bad = [(2 * i + 1, "!! ".join([prose(rng, 8).upper()] * 6) if i % 2 else "x y " * rng.randint(9, 90), 0) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in good + bad] + [(900, None, ""), (901, "", "")], "doc_id long, text string, stats string")
    labels = spark.createDataFrame([(i, y) for i, _, y in good + bad if i % 5] + [(3, None), (1, 0)], "doc_id long, quality int")
    stats = quality_model.document_statistics(docs)
    model = quality_model.fit(quality_model.labelled_rows(stats, labels, "quality"), features=64)
    got = {r["doc_id"]: r for r in quality_model.score_documents(stats, model).collect()}
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    unseen = [(i, y) for i, _, y in good + bad if i % 5 == 0]
    assert np.mean([got[i]["predicted"] == y for i, y in unseen]) > 0.95
    assert quality_model.fit(quality_model.labelled_rows(stats, labels.limit(0), "quality")) is None
    assert {r["score"] for r in quality_model.score_documents(stats, None).collect()} == {0.5}


def toxic_rows(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words, label = prose(rng, rng.choice([3, 20, 90, 300])).split(), int(i % 3 == 0)
        for _ in range(max(1, len(words) // 80) if label else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["Nasty", "vile!", "horrid", "rotten."]))
        out.append((i, " ".join(words), label))
    return out


def test_toxicity_network(spark):
    train = toxic_rows(1, 240)
    docs = spark.createDataFrame([(i, t) for i, t, _ in train], "_id long, _text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in train] + [(5, None)], "doc_id long, toxic int")
    model = toxicity.train(toxicity.labelled_sample(docs, labels, "toxic"))
    test = toxic_rows(2, 90)
    frame = spark.createDataFrame([(i, t, "clash") for i, t, _ in test] + [(900, None, ""), (901, "", ""), (902, "nasty " * 9000, "")], "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in toxicity.score_documents(frame, model).collect()}
    assert len(got) == 93 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert np.mean([got[i]["predicted"] == y for i, _, y in test]) > 0.9
    assert got[902]["n_windows"] == len(toxicity.window_starts(9000)) and got[900]["n_windows"] == 1
    assert toxicity.train(toxicity.labelled_sample(docs, labels.limit(0), "toxic")) == {"share": 0.5}
    assert toxicity.score_documents(frame.limit(0), model).count() == 0


def test_network_gradients():
    rng = np.random.default_rng(0)
    p = toxicity.new_params(3, rng)
    gates, mask, labels = rng.normal(size=(5, 4, 6 * toxicity.HIDDEN)), np.ones((5, 4)), np.array([0, 1, 1, 0.0])
    mask[3:, 1] = 0

    def loss(p, gates):
        z = toxicity.run_network(p, gates, mask)
        return np.sum(np.log1p(np.exp(z)) - labels * z)

    logit, kept = toxicity.run_network(p, gates, mask, keep=True)
    grads, d_gates = toxicity.gradients(p, kept, mask, toxicity._sigmoid(logit) - labels)
    for name in ("u", "wa", "ba", "v", "w", "b"):
        at = tuple(rng.integers(0, s) for s in p[name].shape)
        moved = {**p, name: p[name].copy()}
        moved[name][at] += 1e-6
        assert abs((loss(moved, gates) - loss(p, gates)) / 1e-6 - grads[name][at]) < 1e-4
    moved = gates.copy()
    moved[1, 2, 7] += 1e-6
    assert abs((loss(p, moved) - loss(p, gates)) / 1e-6 - d_gates[1, 2, 7]) < 1e-4


def test_stored_texts_are_small_and_whole(spark):
    docs = spark.read.parquet(f"{entry_points.SMOKE_DIR}/documents.parquet").select("doc_id", "text")
    rows = docs.toArrow().combine_chunks().to_batches()[0]
    rows = rows.slice(0, max(1, rows.num_rows * language_id.PIECE // max(rows.nbytes, language_id.PIECE)))
    plain = pa.BufferOutputStream()
    with pa.ipc.new_stream(plain, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    packed = language_id._packed(rows)
    assert len(packed) < 0.95 * plain.tell()
    assert pa.ipc.open_stream(packed).read_all() == pa.Table.from_batches([rows])


def test_trigrams_of_many_words_equal_those_of_each():
    words = ["", "a", "ab", "abc", "naïve", "żółć", "日本語", "😀", "a😀b", "\ud800x", "long" * 300]
    bucket, size = toxicity.all_trigrams(words)
    each = [toxicity.trigrams(w) for w in words]
    assert bucket.tolist() == [b for x in each for b in x] and size.tolist() == [len(x) for x in each]
    assert [len(x) for x in toxicity.all_trigrams([])] == [0, 0]


def test_scorer_equals_the_network_window_by_window():
    rng = np.random.default_rng(4)
    vocabulary = {w: i + 1 for i, w in enumerate(("nasty", "fine", "day"))}
    p = toxicity.new_params(3, rng)
    words = ["Nasty", "nasty!", "fine", "(fine)", "day", "żółć", "tree", "#"]
    texts = [None, "", *(" ".join(rng.choice(words, n)) for n in (1, 15, 16, 17, 32, 33, 48, 49, 700, 20_000))]
    scorer = toxicity.Scorer(vocabulary, p)
    for text, (logit, best, n) in zip(texts, scorer.score(texts), strict=True):
        tokens = [toxicity.normal(t) for t in (text or "").split()]
        windows = [tokens[s : s + toxicity.WIDTH] for s in toxicity.window_starts(len(tokens))]
        mask = np.array([[float(t < len(w)) for w in windows] for t in range(toxicity.WIDTH)])
        x = np.zeros((*mask.shape, toxicity.WORD_DIM + toxicity.CHAR_DIM))
        for j, window in enumerate(windows):
            for t, w in enumerate(window):
                x[t, j, : toxicity.WORD_DIM] = p["word"][vocabulary[w]] if w in vocabulary else 0
                x[t, j, toxicity.WORD_DIM :] = p["char"][toxicity.trigrams(w)].mean(axis=0)
        want = toxicity.run_network(p, np.concatenate([x @ p["wx"][k] + p["bx"][k] for k in (0, 1)], axis=2), mask)
        assert n == len(windows) and abs(logit - want.max()) < 1e-4 and abs(want[best] - want.max()) < 1e-4
    # spellings of a word are projected once
    assert len(scorer.words) == 6 and len(scorer.rows) == 8


def test_windows_overlap_and_cover():
    for n in (0, 1, 16, 17, 32, 33, 48, 49, 500):
        starts = list(toxicity.window_starts(n))
        covered = {i for s in starts for i in range(s, min(s + toxicity.WIDTH, n))}
        assert covered == set(range(n)) and all(b - a == toxicity.STRIDE for a, b in zip(starts, starts[1:]))


@pytest.fixture(scope="module")
def stage(spark, tmp_path_factory):
    rows = odd_documents(7)
    items = [(1, " ".join(rows[8][1].split()[5:30])), (2, "nothing like it")]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    return lambda name: stages[name](spark, docs, folder), rows, items, docs


def test_stages_keep_columns(stage):
    run, rows, _, docs = stage
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontaminate", "byte_bpe"]
    for name in ("language_id", "near_dedup", "suffix_dedup", "decontaminate"):
        assert run(name).columns == docs.columns


def test_language_stage_keeps_texts_with_letters(stage):
    run, rows, *_ = stage
    kept = {r["doc_id"] for r in run("language_id").collect()}
    assert not kept & {0, 1, 2, 6}
    assert kept >= {r[0] for r in rows[7:19]}


def test_near_dedup_stage_keeps_one_of_each_group(stage):
    run, rows, *_ = stage
    label = similar_groups({r[0]: r[1] for r in rows if r[0] is not None}, 5, 80)
    got = [r["doc_id"] for r in run("near_dedup").collect()]
    assert sorted(i for i in got if i is not None) == sorted(i for i in label if label[i] == i) and got.count(None) == 1


def test_suffix_stage_cuts_repeats(stage):
    run, rows, *_ = stage
    want = []
    for row, gone in zip(rows, repeated_bytes([r[1] for r in rows], corpus_pipeline.REPEAT_BYTES)):
        kept = bytes(b for b, g in zip((row[1] or "").encode(), gone) if not g).decode("utf-8", "ignore")
        want.append((row[0] if row[0] is not None else -1, kept if any(gone) else row[1] or ""))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "") for r in run("suffix_dedup").collect()]
    assert sorted(got) == sorted(want)


def test_decontamination_stage(stage):
    run, rows, items, _ = stage
    want = sorted(-1 if r[0] is None else r[0] for r in rows if not window_hits(r[1], items, 10)[1])
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in run("decontaminate").collect()) == want


def test_encoding_stage_round_trip(stage):
    run, rows, *_ = stage
    got = run("byte_bpe").collect()
    assert len(got) == len(rows) and all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in got)


def test_pipeline_and_queries(spark, sf):
    names = set(entry_points.queries())
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count() <= docs.count() and out.filter("NOT round_trip").isEmpty()


@pytest.mark.parametrize("name", ["op5_quality_model", "op8_url_rules", "op9_chat_format"])
def test_queries_run(spark, sf, name):
    assert entry_points.queries()[name](spark, sf).count() > 0


def test_no_lost_id(spark):
    docs = spark.createDataFrame(odd_documents(), SCHEMA)
    assert id_text(docs).columns == ["_id", "_text"]


def test_language_tables_hold_every_gram(spark):
    rng = random.Random(11)
    rows = [(i, prose(rng, 2000, "abcdefghijklmnopqrstuvwxyz"), "aa" if i % 30 else "bb") for i in range(60)]
    frame = spark.createDataFrame(rows, "_id long, _text string, lang string").repartition(3)
    counts = {
        lang: np.unique(language_id._batch_grams([t for _, t, x in rows if x == lang])[0], return_counts=True) for lang in ("aa", "bb")
    }
    assert sum(len(own) for own, _ in counts.values()) > 300_000
    whole = language_id.fit(counts)
    texts = [t for _, t, _ in rows[::10]] + ["never seen ÄÖÜ, zebras", "a", None, "12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in language_id.predict(docs, language_id.train(frame)).collect()}
    for i, text in enumerate(texts):
        own = language_id._batch_grams([text])[0]
        if len(own):
            h = -language_id.log_probability(whole, own).astype(float).mean(axis=0)
            assert abs(got[i]["cross_entropy"] - h.min()) < 1e-4 and got[i]["lang_pred"] == whole.languages[h.argmin()]
        else:
            assert got[i]["lang_pred"] == "und"


def test_languages_with_few_rows_or_no_letter(spark):
    rows = spoken(5, 40) + [(900, "ωψ φω ψψφ ωωφ " * 4, "rare"), (901, "12 34 ... !!", "none"), (902, "", "none")]
    model = language_id.train(spark.createDataFrame(rows, "_id long, _text string, lang string"))
    assert model.languages == ["aa", "bb", "cc", "rare"] and np.isfinite(model.mean).all()
    docs = spark.createDataFrame([(1, "ψφω ωωφ"), (2, "34 12 !!")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()} == {1: "rare", 2: "und"}


def test_thresholds_come_from_all_rows(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, rng.randint(6, 14), "abcdefgh"), "aa") for i in range(2600)]
    model = language_id.train(spark.createDataFrame(rows, "_id long, _text string, lang string"))
    parts = [language_id._batch_grams([t])[0] for _, t, _ in rows]
    whole = language_id.fit({"aa": np.unique(np.concatenate(parts), return_counts=True)})
    h = np.array([-language_id.log_probability(whole, p).astype(float).mean() for p in parts if len(p) >= 30])
    assert abs(model.mean[0] - h.mean()) < 1e-5 and abs(model.spread[0] - h.std()) < 1e-5


def test_blocks_of_texts_come_in_small_cells(spark):
    """A block is stored in pieces of about a megabyte: large cells took the executors' memory outside the heap."""
    import random

    from riskweave.llm import language_id as L

    draw = random.Random(5)
    texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz ", k=40_000)) for _ in range(70)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(70, None), (71, "")], "i long, t string").coalesce(1)
    blocks = L._text_blocks(docs, "t").cache()
    most = blocks.agg(F.max(F.length("rows")), F.max(F.size("grams")), F.count_if(F.col("rows").isNull() == F.col("grams").isNull())).first()
    assert most[0] <= 1_300_000 and 100_000 < most[1] <= L.PIECE // 8 and most[2] == 0
    asked = blocks.select("block", F.explode("grams").alias("g"))
    per_block = asked.groupBy("block").agg(F.count("*").alias("n"), F.count_distinct("g").alias("d")).collect()
    assert len(per_block) >= 2 and all(r["n"] == r["d"] <= 2 * L.GRAM_BLOCK for r in per_block)
    seen = asked.select("g").distinct().count()
    assert seen == len(np.unique(np.concatenate([L.grams(L.letters(t)) for t in texts])))
    blocks.unpersist()


def test_python_steps_get_small_batches(spark):
    """Arrow batches of 20 MB, held by the JVM and the worker, were part of what broke the executors' limit."""
    from riskweave.llm import byte_bpe, suffix_dedup

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 9000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), 700).alias("text"), F.lit("aa").alias("lang"))
    words = docs.select(F.col("text").alias("_text"), "lang", F.col("doc_id").alias("_key"))

    def largest(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    steps = [
        lambda: language_id.learn(words),
        lambda: byte_bpe.encoded_rows(docs, "", "", ["doc_id"]),
        lambda: suffix_dedup._ranked(words.select("_key", "_text"), None, 1.0, 7),
    ]
    for step in steps:
        spark.conf.unset(key)
        step()
        assert docs.mapInArrow(largest, "n long").agg(F.max("n")).first()[0] < 5_000_000


def test_freed_memory_is_returned():
    """A worker kept what it had freed, while the next stage ran in the JVM beside it."""
    import re
    import sys

    from riskweave.llm.common import give_back

    if sys.platform != "linux":
        pytest.skip("reads /proc")

    def resident() -> int:
        return int(re.search(r"VmRSS:\s+(\d+)", open("/proc/self/status").read())[1]) // 1024

    parts = [np.ones(10_000) for _ in range(2500)]  # 200 MB in pieces that the heap serves
    last = parts[-1]  # keeps the heap's top
    del parts
    before = resident()
    give_back()
    assert before - resident() > 100 and last[0] == 1
