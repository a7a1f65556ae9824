from __future__ import annotations

import random

import numpy as np

import corpus_pipeline
from tests.llm.rows import SCHEMA, empty_documents, odd_documents, sentence, with_clashes
from tests.llm.test_duplicates import brute_groups
from tillmart.llm import near, simhash


def brute_set(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(texts: list) -> tuple[list[int], int]:
    sets = [brute_set(t) for t in texts]
    pairs = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] == sets[j] or len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8
    ]
    return brute_groups(len(texts), pairs), sum(sets[i] != sets[j] for i, j in pairs)


def changed(rng: random.Random, text: str, times: int) -> str:
    words = text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = sentence(rng, 1) + "q"
    return " ".join(words)


def near_rows() -> list[tuple]:
    """Texts with copies of one to five changed words, which are above and below 0.8, and chains of such copies."""
    rng = random.Random(3)
    texts = []
    for _ in range(40):
        text = sentence(rng, rng.randint(100, 140))
        texts += [text, *(changed(rng, text, k) for k in (1, 2, 3, 4, 5))]
    chain = sentence(rng, 120)
    for _ in range(60):
        chain = changed(rng, chain, 2)
        texts.append(chain)
    texts += [sentence(rng, n) for n in (1, 3, 5, 6)] + [texts[0]] * 3 + ["", None, " \n"]
    rng.shuffle(texts)
    return [(k, t, "en", f"s{k % 3}", 0) for k, t in enumerate(texts)]


def test_pipeline_stage_joins_all_pairs_from_four_fifths_on(spark):
    rows = near_rows()
    groups, close = brute_components([r[1] for r in rows])
    assert close > 100 and len(set(groups)) > 60
    kept = corpus_pipeline.keep_one_of_near(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(groups))


def test_small_blocks_lose_nothing(spark):
    rows = near_rows()
    groups, _ = brute_components([r[1] for r in rows])
    found = {r.doc_id: r.component for r in near.near_copies(spark.createDataFrame(rows, SCHEMA), block=300).collect()}
    assert len(set(zip(groups, (found[k] for k in range(len(rows))), strict=True))) == len(set(groups)) == len(set(found.values()))


def test_odd_rows(spark):
    documents = with_clashes(odd_documents(spark))
    rows = documents.select("doc_id", "text").collect()
    groups, _ = brute_components([r.text for r in rows])
    kept = near.keep_one(documents)
    assert kept.columns == documents.columns and kept.count() == len(set(groups))
    assert near.keep_one(empty_documents(spark)).count() == 0


def test_pairs_at_the_limit_share_a_key():
    rng = np.random.default_rng(4)
    count, shared, hit = near.bands(0.8), 0, 0
    for _ in range(300):  # 80 of 100 in common
        numbers = rng.integers(0, 1 << 64, 100, dtype=np.uint64)
        a, b = near.band_keys(numbers[:90], count), near.band_keys(numbers[10:], count)
        shared += int((a == b).sum())
        hit += bool((a == b).any())
    assert hit == 300 and abs(shared / (300 * count) - 0.8 ** near.ROWS) < 0.03


def test_pipeline_stage_takes_candidates_from_simhash(spark, monkeypatch):
    """Links of fingerprints are candidates; only the whole sets decide."""
    asked = []

    def linked(prints, *args, **named):
        asked.append(prints.count())
        return simhash.link_fingerprints(prints, *args, **named)

    monkeypatch.setattr(near, "link_fingerprints", linked)
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(1, text), (2, text + " end"), (3, " ".join(f"v{i}" for i in range(300))), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near.keep_one(docs).collect()) == [1, 3, 4]
    assert asked and asked[0] >= 2


def test_all_sets_of_near_fingerprints_are_compared(spark, monkeypatch):
    """Without other keys, fingerprints within four bits of each other are enough to find every pair."""
    monkeypatch.setattr(near, "band_keys", lambda hashes, count: np.zeros(0, np.uint64))
    rows = near_rows()
    groups, close = brute_components([r[1] for r in rows])
    assert close > 100
    for prints, block in ((1, near.BLOCK), (16, 3000)):
        monkeypatch.setattr(near, "fingerprint_of", lambda hashes, prints=prints: int(hashes[0]) % prints if len(hashes) else 0)
        found = {r.doc_id: r.component for r in near.near_copies(spark.createDataFrame(rows, SCHEMA), block=block).collect()}
        assert len(set(zip(groups, (found[k] for k in range(len(rows))), strict=True))) == len(set(groups)) == len(set(found.values()))
