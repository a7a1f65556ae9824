from __future__ import annotations

import random
import zlib
from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from tests.llm.rows import empty_documents, odd_documents, sentence, with_clashes
from tillmart.llm import quality, subword, toxicity
from tillmart.llm.common import held_out
from tillmart.llm.queries import QUERIES

QUICK = subword.Settings(rows_per_label=400, least_steps=120)
LABELS = "doc_id long, quality int, toxic int"


def test_windows_find_one_bad_word_and_its_misspellings():
    rng = random.Random(4)
    clean = [sentence(rng, 60) for _ in range(250)]
    bad = [" ".join([sentence(rng, rng.randint(5, 60)), rng.choice(["zzgrbl", "zzgrbla", "qwxick"]), sentence(rng, 20)]) for _ in range(120)]
    settings = subword.Settings(pool="max", lower=True, word_pairs=False)
    labels = np.array([0] * 200 + [1] * 100)
    scorer = subword.Scorer(*subword.train(clean[:200] + bad[:100], labels, settings), settings)
    assert (scorer.score(clean[200:]) < 0.5).mean() > 0.95
    assert (scorer.score(bad[100:]) >= 0.5).mean() > 0.95
    assert scorer.score([sentence(rng, 300) + " ZZGRBLS " + sentence(rng, 300)])[0] >= 0.5


def test_repeated_words_share_one_bucket():
    hashes = subword.bags([b"one", b"two"], QUICK)[2][[0, 0, 1, 1, 0]]
    pairs = subword.pairs(hashes, QUICK)
    assert pairs[0] == pairs[2] == 0 and pairs[1] > 0 and pairs[3] > 0 and pairs[1] != pairs[3]


def test_score_does_not_depend_on_the_batch():
    rng = random.Random(6)
    texts = [sentence(rng, rng.randint(0, 80)) for _ in range(90)]
    for settings in (quality.SETTINGS, toxicity.SETTINGS):
        model = subword.train(texts, np.arange(90) % 2, settings)
        together = subword.Scorer(*model, settings).score(texts)
        assert np.allclose(together, [subword.Scorer(*model, settings).score([t])[0] for t in texts], atol=1e-5)


def test_odd_rows_get_a_score(spark):
    documents = with_clashes(odd_documents(spark))
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (3, 0, 1), (None, 1, 1), (20, None, None), (21, 1, 0), (99, 0, 1)], LABELS)
    for of, column in ((quality.score_quality, "score"), (toxicity.score_toxicity, "score")):
        found = of(documents, labels, held_out(), QUICK).collect()
        assert len(found) == documents.count() and all(0 <= r[column] <= 1 for r in found)
        assert {r.size for r in found} == {"kept size"}
        empty = {r[column] for r in found if not (r.text or "").split()}
        assert len(empty) == 1
        assert of(empty_documents(spark), labels, held_out(), QUICK).count() == 0
        none = of(documents, labels.limit(0), held_out(), QUICK)
        assert {r[column] for r in none.collect()} == {0.5}


def test_held_out_labels_are_never_learned(spark):
    rows = [(i, i % 2, i % 2) for i in range(200)]
    labels = spark.createDataFrame(rows, LABELS)
    learned = {r.doc_id for r in subword.labelled(labels, "quality", held_out()).collect()}
    assert learned == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_held_out_accuracy(spark, sample_dir):
    sf_dir = sample_dir.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = QUERIES["op3_quality"].run(spark, sf_dir).join(labels, "doc_id").filter("held_out")
    right = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.97
    found = QUERIES["op9_toxicity"].run(spark, sf_dir).join(labels, "doc_id").filter("held_out")
    right = found.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert right >= 0.9


def test_an_id_of_many_documents_is_one_row_to_learn_from(spark):
    rng = random.Random(12)
    rows = [(0, f"{sentence(rng, 20)} good") for _ in range(3000)] + [(k, f"{sentence(rng, 20)} {'bad' if k % 2 else 'good'}") for k in range(1, 301)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(301)] + [(0, 0)] * 900, "doc_id long, label int")
    chosen = subword.sample(documents, labels, QUICK).collect()
    assert len(chosen) == 301 and len({r.doc_id for r in chosen}) == 301 and {r.label for r in chosen} == {0, 1}
    model = subword.fit(documents, labels, QUICK)
    scores = {r.doc_id: r.score for r in subword.score(documents.filter("doc_id > 0"), model, QUICK).collect()}
    assert np.mean([scores[k] for k in range(1, 301, 2)]) > np.mean([scores[k] for k in range(2, 301, 2)]) + 0.3


def held_out_figures(spark, sf_dir, settings):
    """(recall, precision) of label toxic = 1 on the documents that nothing was learned from."""
    documents, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    scored = toxicity.score_toxicity(documents.select("doc_id", "text"), labels, held_out(), settings)
    rows = scored.filter(held_out()).select("doc_id", "score").join(labels, "doc_id").filter("toxic is not null").collect()
    hit = sum(r.score >= toxicity.LIMIT and r.toxic == 1 for r in rows)
    return hit / sum(r.toxic == 1 for r in rows), hit / max(1, sum(r.score >= toxicity.LIMIT for r in rows))


def test_windows_find_more_than_plain_averaging(spark, sample_dir):
    """The dealt method averages the whole text; the windows are a deviation, for one word in a long text."""
    sf_dir = sample_dir.replace("0.001", "0.1")
    recall, precision = held_out_figures(spark, sf_dir, toxicity.SETTINGS)
    plain = held_out_figures(spark, sf_dir, replace(toxicity.SETTINGS, pool="mean"))
    print(f"windows: recall {recall:.3f}, precision {precision:.3f}; whole texts: {plain[0]:.3f}, {plain[1]:.3f}")
    assert recall >= 0.85 and precision >= 0.75
    assert recall > plain[0] + 0.05 and precision > plain[1] + 0.3
