"""Periodic runs, collocations and top-k search against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.rows import WORD, empty_documents, odd_documents, odd_rows, with_clashes
from tillmart.llm import periods, phrases, topk
from tillmart.llm.common import table
from tillmart.llm.queries import QUERIES


def brute_runs(words, min_length=24, min_periods=3):
    """Every period in turn: stretches where words that far apart are equal."""
    found = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_length, min_periods * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(rng: random.Random) -> list[str]:
    words, kinds = [], rng.choice([1, 2, 3, 9])
    while len(words) < rng.randint(1, 250):
        period = [str(rng.randrange(kinds)) for _ in range(rng.randint(1, 15))]
        words += (period * 9)[:rng.randint(1, 9 * len(period))]
        if rng.random() < 0.3:
            words += words[-rng.randint(1, len(words)):]
    return words


def test_runs_against_all_periods():
    rng = random.Random(11)
    many = 0
    for _ in range(400):
        words = repetitive(rng)
        ids = periods.numbered([w.encode() for w in words])
        for limits in ((24, 3), (6, 3), (1, 4), (40, 5)):
            assert periods.runs(ids, *limits) == brute_runs(words, *limits)
        many += len(brute_runs(words))
    assert many > 200
    with pytest.raises(ValueError):
        periods.runs(ids, 24, 2)


def test_each_place_of_a_nonterminal_derives_the_same_words():
    rng = random.Random(12)
    for _ in range(50):
        words = repetitive(rng)
        ids = periods.numbered([w.encode() for w in words])
        nodes = periods.grammar(ids) if len(ids) > 1 else periods.Nodes()
        for start, end, places in zip(nodes.start, nodes.end, nodes.places, strict=True):
            assert all(words[p:p + end - start] == words[start:end] for p in places)
        if len(ids) > 1:
            assert (0, len(ids)) in set(zip(nodes.start, nodes.end, strict=True))


def expected_runs(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_run_query_against_all_periods(spark, sample_dir):
    got = {tuple(r) for r in QUERIES["op11_periods"].run(spark, sample_dir).collect()}
    docs = table(spark, sample_dir, "documents").select("doc_id", "text").collect()
    want = {expected_runs(r.doc_id, r.text) for r in docs}
    assert got == want and sum(r[1] > 0 for r in want) > 5


def test_runs_of_odd_rows(spark):
    docs = with_clashes(odd_documents(spark)).withColumn("runs", F.lit("kept"))
    got = periods.periodic_runs(docs).collect()
    assert len(got) == len(odd_rows())
    by_text = {r[0]: r[1] for r in odd_rows()}
    for r in got:
        if r.doc_id is not None:
            words = WORD.findall(by_text[r.doc_id] or "")
            assert r.n_words == len(words) and [tuple(x) for x in r.runs] == brute_runs_of_long(words)
    assert periods.periodic_runs(empty_documents(spark)).count() == 0


def brute_runs_of_long(words):
    return brute_runs(words) if len(set(words)) > 2 or len(words) < 1000 else [(0, len(words) - 1, 1)]  # "é" 30,000 times, then "ß"


def brute_phrases(rows, least, longest=5):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, " ".join(words[i:i + k])) for i in range(len(words) - k + 1))
    return {k: n for k, n in counts.items() if n >= least}, total


def brute_collocations(rows, least, first):
    f, total = brute_phrases(rows, least)
    ranked = {}
    for (lang, phrase), a in f.items():
        words = phrase.split(" ")
        if len(words) < 2:
            continue
        inside = [p for (x, p), n in f.items() if x == lang and n >= a and len(p.split(" ")) > len(words) and f" {phrase} " in f" {p} "]
        if inside:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, " ".join(words[:k])] * f[lang, " ".join(words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        ranked.setdefault(lang, []).append((-score, -a, phrase.encode(), f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])]))
    return {
        (lang, i + 1, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in ranked.items() for i, (score, a, p, left, right) in enumerate(sorted(found)[:first])
    }


def chatter(n=300):
    rng = random.Random(13)
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(["A", "b", "C", "dé", "e", "fé"]) + rng.choice([" ", " ", "\t", "  ", ". ", "\n", ";"]) for _ in range(rng.randint(0, 50)))
        rows.append((text if rng.random() < 0.95 else None, rng.choice(["en", "fr", None])))
    return rows


@pytest.mark.parametrize(("least", "share"), [(20, 8), (4, 64)])
def test_collocations_against_brute_force(spark, monkeypatch, least, share):
    """With a share of 64 the sample proposes little, so that the border fails."""
    monkeypatch.setattr(phrases, "SHARE", share)
    rows = chatter()
    docs = spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], "doc_id long, text string, lang string, k string, phrase string")
    got = {tuple(r) for r in phrases.collocations(docs, least=least, first=30).collect()}
    assert got == brute_collocations(rows, least, 30) and len(got) > 40


def test_colliding_bitmap_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST_BITS", 64)
    monkeypatch.setattr(phrases, "MOST_BITS", 128)
    rows = chatter(120)
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = {(r.lang, r.phrase): r.f for r in phrases.frequent_phrases(docs, least=6).filter("k > 0").collect()}
    assert got == brute_phrases(rows, 6)[0]


def test_collocations_of_odd_rows(spark):
    docs = with_clashes(odd_documents(spark))
    got = {tuple(r) for r in phrases.collocations(docs, least=2, first=None).collect()}
    assert got == brute_collocations([(r[1], r[2]) for r in odd_rows()], 2, None)
    assert phrases.collocations(empty_documents(spark)).count() == 0


def test_large_products_are_exact(spark):
    big = 10 ** 12
    found = spark.createDataFrame(
        [("x", 0, "", 10 ** 15), ("x", 1, "a", big), ("x", 1, "b", 3 * big), ("x", 2, "a b", big - 1)], "lang string, k int, phrase string, f long")
    assert phrases.scored(found).first().score == 1000 * (big - 1) * 10 ** 15 // (3 * big * big)


def brute_best(rows, first=20):
    got = set()
    for i, (query, v) in enumerate(rows):
        if v is None or query is None or query % 20 or not v:
            continue
        others = [(-sum(a * b for a, b in zip(v, w, strict=True)), c is None, c or 0, c) for j, (c, w) in enumerate(rows) if j != i and w and len(w) == len(v)]
        got |= {(query, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(others)[:first])}
    return got


@pytest.mark.parametrize("blocks", [(4096, 16384), (3, 50)])
def test_best_products_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERIES", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATES", blocks[1])
    rng = random.Random(14)
    rows = [(i, [rng.randint(-40, 40) + 9 * (i % 3) for _ in range(12)]) for i in range(300)]
    rows += [(1000 + i, [7] * 12) for i in range(90)]  # one vector many times, asked for too
    rows += [(2000 + i, [0] * 12) for i in range(30)] + [(3000 + 20 * i, [i] * 5) for i in range(4)]
    rows += [rows[0], rows[20], (None, [1] * 12), (4000, None), (4020, []), (40, [10 ** 9] * 12), (60, [3 * 10 ** 8] * 12)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, vector array<long>, node string, score string")
    got = [tuple(r) for r in topk.best_products(frame, F.col("vec_id") % 20 == 0).collect()]
    assert set(got) == brute_best(rows)
    assert topk.best_products(frame.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(15)
    for width in (1, 2, 3, 7, 64):
        a, b = rng.integers(-99, 99, (40, width)).astype(float), rng.integers(-99, 99, (50, width)).astype(float)
        last = None
        for s in topk.levels_of(width):
            upper = topk.statistics(a, s) @ topk.statistics(b, s).T
            assert (upper >= a @ b.T - 1e-6).all()
            last = upper if last is None else last
        assert (upper.sum() <= last.sum() + 1e-6)


def test_product_query_with_missing_components(spark, tmp_path):
    rows = [(i, [float(i), -1.5, 0.26]) for i in range(45)] + [(60, [float("nan"), 1.0, 1.0]), (80, [None, 1.0, 1.0]), (100, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {tuple(r) for r in QUERIES["op13_topk"].run(spark, str(tmp_path)).collect()}
    assert got == brute_best([(i, [int(np.floor(64 * np.float32(x).astype(float))) for x in v]) for i, v in rows[:45]])
