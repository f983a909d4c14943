"""Operators with one right result, against brute force on documents with every odd case."""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from helpers import SCHEMA, SPACED, odd_documents, prose, repeated_bytes, similar_groups, shingle_set, window_hits
from pyspark.sql import functions as F

from riskweave.llm import decontaminate, near_dedup, quality_rules, suffix_dedup, url_rules
from riskweave.session import staged


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA).repartition(5)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("m", [216, 300])
def test_repeated_byte_strings(docs, m):
    rows = odd_documents()
    want = Counter()
    for row, gone in zip(rows, repeated_bytes([r[1] for r in rows], m)):
        data = (row[1] or "").encode()
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want[(row[0], len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert Counter(tuple(r) for r in suffix_dedup.removal_digests(docs, m).collect()) == want


def test_header_on_a_third_of_all_texts(spark):
    rng = random.Random(9)
    header, footer = prose(rng, 90), prose(rng, 70)
    texts = [prose(rng, 70) + " " + prose(rng, 50) for _ in range(20)]
    texts += [header + " " + prose(rng, 30) for _ in range(12)] + [prose(rng, 30) + " " + footer for _ in range(12)] + [header, footer, footer[3:]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.removal_digests(frame, 300).collect()}
    assert got == {i: sum(gone) for i, gone in enumerate(repeated_bytes(texts, 300))} and sum(v > 0 for v in got.values()) > 20


def test_edge_samples_are_judged_without_each_other():
    u = suffix_dedup.U
    h = np.array([5, 5, 6, 7, 7, 8], dtype=u)
    w = np.array([0, 9, 0, 9, 9, 0], dtype=u)
    many = np.array([True, False, False, False, False, True])
    # an edge sample that a task had many times is odd even where no other task has it
    assert suffix_dedup._judged(h, w, many).tolist() == [2, 2, 0, 1, 1, 2]
    key, place = np.arange(6), np.zeros(6, dtype=np.int64)
    sent = list(suffix_dedup._messages(key, place, np.array([5, 5, 5, 7, 7, 8], dtype=u), np.array([0, 0, 0, 9, 9, 1], dtype=u), 1, 5))
    known = {row[-1]: suffix_dedup._unpacked(*row[1:4])[0].tolist() for row in sent if not row[4]}
    assert known == {bytes([suffix_dedup.ODD]): [1, 2], bytes([suffix_dedup.REPEATED]): [4]}


@pytest.mark.parametrize("least", [120, 256])
def test_shared_passages(spark, least):
    rng = random.Random(least)
    rows = [(i, prose(rng, rng.randint(5, 120))) for i in range(60)]
    for i, size in enumerate([least // 2, least - 57, least, least + 1, least + 40, 3 * least]):
        passage = prose(rng, 2 * least)[:size]
        rows += [(100 + 10 * i + k, prose(rng, rng.randint(0, 60)) + f" {k}" + passage + f"{k} " + prose(rng, rng.randint(0, 60))) for k in range(3)]
    rows += [(300, None), (301, ""), (302, "ab" * least), (None, rows[0][1]), rows[1], rows[1]]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, _key string, shared_bytes int")
    found = suffix_dedup.removal_digests(docs, passage=least).collect()
    assert len(found) == len(rows)
    for n, sure in ((least, True), (least - 56, False)):  # a string of ``least`` bytes is found, one below the sample never
        repeated = {i for (i, _), gone in zip(rows, repeated_bytes([t for _, t in rows], n)) if any(gone)}
        flagged = {r["doc_id"] for r in found if r["n_shared_bytes"] > 0}
        assert repeated <= flagged if sure else flagged <= repeated
    assert {r["n_bytes"] for r in found if r["n_shared_bytes"] > r["n_bytes"]} == set()
    assert suffix_dedup.removal_digests(docs.limit(0), passage=least).collect() == []


def test_repeated_byte_strings_with_many_alignments(spark):
    rng = random.Random(3)
    base = prose(rng, 300)
    texts = [prose(rng, rng.randint(0, 9)) + base[a : a + rng.randint(216, 900)] + prose(rng, 5) for a in rng.choices(range(900), k=40)]
    texts += ["ab" * 700, "ab" * 500, "ba" * 300 + "c"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.removal_digests(frame, 216).collect()}
    for i, gone in enumerate(repeated_bytes(texts, 216)):
        assert got[i] == (sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)))


def test_difference_cover_leads_any_two_places_to_samples():
    period, cover = suffix_dedup.difference_cover()
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicate_groups(docs, k, percent):
    rows = odd_documents()
    by_id = {r[0]: r[1] for r in rows if r[0] is not None}
    want = similar_groups(by_id, k, percent)
    got = near_dedup.near_duplicates(docs, k, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (want[r["doc_id"]] == r["doc_id"])
            assert r["n_shingles"] == len(shingle_set(by_id[r["doc_id"]], k))


def test_near_duplicate_chains_and_large_groups(spark):
    rng = random.Random(5)
    words = prose(rng, 150).split()
    texts = []
    for _ in range(12):  # a chain: each text is close to the next one only
        texts.append(" ".join(words))
        words[len(texts) * 11 % 140 : len(texts) * 11 % 140 + 3] = prose(rng, 3).split()
    center = prose(rng, 200)
    for _ in range(60):
        w = center.split()
        w[rng.randrange(200)] = "edit" + str(rng.random())
        w[rng.randrange(200)] = "edit" + str(rng.random())
        texts.append(" ".join(w))
    rng.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame, 3, 85).collect()}
    assert got == similar_groups(dict(enumerate(texts)), 3, 85)


def test_needed_overlap_keeps_the_stated_chance():
    from math import comb

    need = near_dedup.needed_overlap(48, 85)
    assert sum(comb(48, s) * 0.85**s * 0.15 ** (48 - s) for s in range(need)) <= near_dedup.MISS


def test_components_on_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 102), (101, 102)], "a long, b long")
    got = {r["node"]: r["label"] for r in near_dedup.components(links).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 101: 100, 102: 100}


def benchmark_rows():
    rows = odd_documents()
    return [
        (1, " ".join(rows[8][1].split()[5:30])), (2, " ".join(rows[9][1].split()[:14]).upper()), (2, "one two"), (3, "ONE"),
        (4, None), (5, ""), (None, rows[8][1][:200]), (6, prose(random.Random(9), 30)), (7, "a b c a b c a b c a b c"), (8, "ünï"),
    ]


def test_benchmark_windows(spark, docs):
    items = benchmark_rows()
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, items string")
    found = decontaminate.contamination(docs, bench)
    assert "Python" not in plan(found) and "Cartesian" not in plan(found) and "NestedLoop" not in plan(found)
    want = Counter()
    for r in odd_documents():
        n, hit, ids = window_hits(r[1], items, 10)
        want[(r[0], n, len(hit), ",".join(sorted(ids)))] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in found.collect()) == want


def test_quality_counts(docs):
    found = quality_rules.filter_quality(docs)
    assert "Python" not in plan(found)
    want = Counter()
    for r in odd_documents():
        text = r[1] or ""
        words = SPACED.findall(text)
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        grams = list(zip(words, words[1:], words[2:]))
        seen = Counter(grams)
        covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
        n = len(words)
        want[(r[0], n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
              n < 50 or 100 * len(covered) > 50 * n)] += 1
    rows = found.collect()
    assert Counter(tuple(r)[:7] for r in rows) == want
    assert not any(r["kept"] for r in rows if r["base_failed"])


def test_rule_order_does_not_change_verdicts(docs):
    counted = quality_rules.base_counts(docs)
    rules = quality_rules.default_rules()
    one = counted.select("_id", quality_rules.cascade(counted, rules).isNull().alias("k"))
    other = counted.select("_id", quality_rules.cascade(counted, rules[::-1]).isNull().alias("k"))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, other.collect()))
    assert {r.name for r in quality_rules.rule_order(counted, rules)} == {r.name for r in rules}


def test_slow_rules_go_behind_fast_ones(spark, docs):
    counted = staged(quality_rules.base_counts(docs), "counted")
    slow = F.coalesce("_text", F.lit(""))
    for _ in range(40):
        slow = F.sha2(slow, 512)
    fast, half = F.col("n_words") < 20, F.col("n_words") < 5
    rules = [quality_rules.Rule("slow", (slow != "x") & fast), quality_rules.Rule("rare", half), quality_rules.Rule("fast", fast), quality_rules.Rule("never", F.lit(False))]
    cost = quality_rules.rule_costs(counted, rules)
    assert cost["slow"][0] == cost["fast"][0] > cost["rare"][0] > cost["never"][0] == 0 and cost["slow"][1] > 3 * cost["fast"][1]
    ordered = [r.name for r in quality_rules.rule_order(counted, rules)]
    assert ordered.index("fast") < ordered.index("slow") and ordered[-1] == "never"


URLS = [
    None, "", "no scheme/en/", "http://", "https://A.Example.COM/en/x?q=1#f", "http://www.example.com/en/1", "http://example.com",
    "http://a.net/es/1", "http://net/fr/", "http://sub.www.example.com/en/x", "ftp://x.org?key=1", "http://EXAMPLE.com/EN/", "http://a.com#t://b",
    "http://bad.site.org/win/1", "http://bad.site.org/win/2?x=1", "http://good.org/win",
]
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS)] + [(None, URLS[4], None)], "page_id long, url string, rule string")
    mined = spark.createDataFrame([(1, ["host:bad", "path:win"], "host:bad", 1.0, 0.5)], "rule_id long, items array<string>, post string, confidence double, support double")
    found = url_rules.filter_urls(pages, mined, RULES)
    assert "Python" not in plan(found)
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    for r in found.collect():
        u = (URLS[r["page_id"]] if r["page_id"] is not None else URLS[4]) or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].translate(low)
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fit = [x for x in RULES if (host == x[0] or host.endswith("." + x[0])) and path.startswith(x[1])]
        rule = max(fit, key=lambda x: len(x[0] + x[1]), default=None)
        verdict = rule[2] if rule else ("block" if host == "bad.site.org" else "allow")
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule[0] + rule[1] if rule else None, verdict)
    assert found.count() == pages.count()


def test_url_rules_are_mined_and_pruned(spark):
    rows = [(f"http://bad.org/{'win' if i % 2 else 'news'}/{i}", int(i % 2)) for i in range(40)] + [("http://ok.org/win", 0)] * 5
    rules = url_rules.mine_rules(spark.createDataFrame(rows, "url string, bad int"), min_support=0.1, min_confidence=0.9)
    assert {tuple(r["items"]) for r in rules.collect()} == {("host:bad", "path:win")}
    assert url_rules.mine_rules(spark.createDataFrame([], "url string, bad int")).count() == 0


@pytest.mark.parametrize("seed, support", [(1, 0.02), (2, 0.05), (3, 0.2)])
def test_url_rules_equal_a_plain_miner(spark, seed, support):
    """All combinations of tokens of any length are counted one by one; those with a shorter rule inside go."""
    rng = random.Random(seed)
    parts = ["a", "b", "c", "d", "e", "f"]
    rows = []
    for _ in range(120):
        words = rng.sample(parts, rng.randint(0, 6))
        bad = {"a", "b"} <= set(words) or {"c", "d", "e", "f"} <= set(words)
        rows.append((f"http://h{rng.randint(1, 2)}.org/" + "/".join(words), int(bad if rng.random() < 0.95 else not bad)))
    rows += [("nothing", 1)] * 5 + [rows[0]] * 3
    tokens = [(frozenset([f"host:{u.split('/')[2].split('.')[0]}", "host:org"] + [f"path:{w}" for w in u.split("/")[3:] if w]), bad) for u, bad in rows if "://" in u]
    counts: dict = {}
    for own, bad in tokens:
        for mask in range(1, 1 << len(own)):
            some = frozenset(t for k, t in enumerate(sorted(own)) if mask >> k & 1)
            n, hits = counts.get(some, (0, 0))
            counts[some] = n + 1, hits + bad

    def lower(hits, n, z=1.96):
        p = hits / n
        return (p + z * z / n / 2 - z * ((p * (1 - p) + z * z / n / 4) / n) ** 0.5) / (1 + z * z / n)

    rules = {s for s, (n, hits) in counts.items() if hits >= support * len(tokens) and hits / n >= 0.6 and lower(hits, n) >= 0.5}
    want = {s for s in rules if not any(t < s for t in rules)}
    mined = url_rules.mine_rules(spark.createDataFrame(rows, "url string, bad int"), min_support=support).collect()
    assert {frozenset(r["items"]) for r in mined} == want and len(mined) == len(want) > 0
    single = {t: counts[frozenset([t])][0] for t in {t for s in want for t in s}}
    assert all((single[r["post"]], r["post"]) == min((single[t], t) for t in r["items"]) for r in mined)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    assert suffix_dedup.removal_digests(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert quality_rules.filter_quality(none).count() == 0
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert url_rules.filter_urls(spark.createDataFrame([], "page_id long, url string"), url_rules.mine_rules(spark.createDataFrame([], "url string, bad int"))).count() == 0
