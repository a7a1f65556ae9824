"""Supervised subword embeddings: hashed vectors, averaged, under a linear softmax.

A word's vector is the mean of the vectors of its bag: the word itself and its
character n-grams, with ``<`` and ``>`` for its ends, each hashed into one table.
Vectors of neighbouring word pairs come from the same table. Averages of these go
through a linear softmax, and table and softmax are learned together in numpy, by
stochastic gradient steps over groups of rows with per-weight step sizes.

``pool="mean"`` averages a whole text. ``pool="max"`` averages every window of
``window`` words and takes the window with the highest score, so a few words
decide however long the text is; a text's gradient goes through that window.

Learning sees at most ``rows_per_label`` rows of each label, the ones with the
smallest hashed ids, with texts of at most ``train_bytes`` bytes; that is the only
bound. It runs in one task, so what the driver gets is one table of fixed size.
Scoring reads every whole text once, shuffles nothing, and needs only each bucket's
share of the score: the softmax is linear, so the table is multiplied out before.

Defined cases: a missing text is an empty one; texts without words get the score
of the bias alone; without rows of both labels the score is the share of label 1
(0.5 without rows); other columns are kept, result columns replace equal names.
"""

from __future__ import annotations

import gc
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.common import stored, text_of

#: Words whose score a task remembers; a fuller dictionary is emptied before the next rows.
REMEMBERED = 200_000
#: Rows that a task splits into words at a time.
ROWS = 500


@dataclass(frozen=True)
class Settings:
    pool: str = "mean"
    window: int = 3
    lower: bool = False
    word_pairs: bool = True
    char_min: int = 3
    char_max: int = 5
    buckets: int = 1 << 17
    dim: int = 8
    epochs: int = 12
    group: int = 256
    least_steps: int = 240
    rate: float = 0.3
    rows_per_label: int = 2500
    train_bytes: int = 65_536
    seed: int = 7


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def bags(words: list[bytes], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word index) of every bag member, sorted by word, and a 64-bit hash of every word."""
    coded = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words), dtype=np.int64), lengths)
    step = np.uint64(1_000_003)
    buckets, owners = [], []
    grams = np.zeros(len(coded), np.uint64)
    for n in range(1, settings.char_max + 1):
        if n > len(coded):
            break
        grams = grams[: len(coded) - n + 1] * step + coded[n - 1:] + np.uint64(1)
        if n >= settings.char_min:
            inside = np.flatnonzero(owner[: len(grams)] == owner[n - 1:])
            buckets.append(_mix(grams[inside] + np.uint64(n)) % np.uint64(settings.buckets - 1))
            owners.append(owner[inside])
    # Whole words: a sum of mixed (letter, place) pairs.
    place = np.arange(len(coded), dtype=np.int64) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = _mix(coded + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(0x5BD1E995))
    whole = np.add.reduceat(letters, np.cumsum(lengths) - lengths) if len(words) else np.zeros(0, np.uint64)
    buckets.append(_mix(whole) % np.uint64(settings.buckets - 1))
    owners.append(np.arange(len(words), dtype=np.int64))
    buckets, owners = np.concatenate(buckets).astype(np.int32), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return buckets[order] + 1, owners[order], whole


def pairs(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    """Bucket of each word with the next one. A word followed by itself always has bucket 0."""
    first, second = hashes[:-1], hashes[1:]
    made = (_mix(first * np.uint64(3) + second) % np.uint64(settings.buckets - 1)).astype(np.int32) + 1
    return np.where(first == second, 0, made)


def words_of(text: str | None, settings: Settings) -> list[bytes]:
    coded = (text or "").encode("utf-8", "replace")
    return (coded.lower() if settings.lower else coded).split()


class Group:
    """Rows of one gradient step, hashed once for all epochs."""

    def __init__(self, texts: list[list[bytes]], labels: np.ndarray, settings: Settings):
        self.labels = labels
        names: dict[bytes, int] = {}
        self.tokens = [np.fromiter((names.setdefault(w, len(names)) for w in t), np.int64, len(t)) for t in texts]
        buckets, self.owner, hashes = bags(list(names), settings)
        self.size = np.bincount(self.owner, minlength=len(names)).astype(np.float32)
        if settings.pool == "mean" and settings.word_pairs:
            made = [pairs(hashes[t], settings) for t in self.tokens]
            flat = np.concatenate([*made, np.zeros(0, np.int32)])
            found, at = np.unique(flat, return_inverse=True)
            self.tokens = [
                np.concatenate([t, len(names) + part])
                for t, part in zip(self.tokens, np.split(at, np.cumsum([len(m) for m in made])[:-1]), strict=True)
            ]
            buckets = np.concatenate([buckets, found.astype(np.int32)])
            self.owner = np.concatenate([self.owner, np.arange(len(names), len(names) + len(found))])
            self.size = np.concatenate([self.size, np.ones(len(found), np.float32)])
        self.rows, self.at = np.unique(buckets, return_inverse=True)
        self.starts = np.flatnonzero(np.diff(self.owner, prepend=-1))

    def vectors(self, table: np.ndarray) -> np.ndarray:
        return np.add.reduceat(table[self.rows][self.at], self.starts, axis=0) / self.size[:, None]


def _window(scores: np.ndarray, width: int) -> int:
    """Start of the window with the highest mean score."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    width = min(width, len(scores))
    return int(np.argmax(total[width:] - total[:-width]))


def train(texts: list[str], labels: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Each bucket's share of the score of label 1, and the bias."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(settings.buckets, np.float32), float(np.log(share / (1 - share)))
    chance = np.random.default_rng(settings.seed)
    table = chance.normal(0, 0.05, (settings.buckets, settings.dim)).astype(np.float32)
    soft = chance.normal(0, 0.3, (settings.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_table, seen_soft, seen_bias = np.full_like(table, 1e-6), np.full_like(soft, 1e-6), np.full_like(bias, 1e-6)
    words = [words_of(t, settings) for t in texts]
    weight = np.float32(len(labels)) / (2 * np.bincount(labels, minlength=2))  # both labels count the same
    # Few rows: smaller groups and more epochs, so that the number of steps stays useful.
    size = min(settings.group, max(32, len(texts) // 16))
    epochs = max(settings.epochs, -(-settings.least_steps * size // len(texts)))
    order = chance.permutation(len(words))
    groups = [
        Group([words[i] for i in part], labels[part], settings)
        for part in (order[k:k + size] for k in range(0, len(order), size))
    ]
    for epoch in range(epochs):
        rate = settings.rate * (1 - epoch / epochs)
        for g in (groups[i] for i in chance.permutation(len(groups))):
            if not len(g.rows):
                continue
            vectors = g.vectors(table)
            parts = g.tokens
            if settings.pool == "max":
                scores = vectors @ (soft[:, 1] - soft[:, 0])
                parts = []
                for tokens in g.tokens:
                    if not len(tokens):
                        parts.append(tokens)
                        continue
                    # The first epochs also learn from whole texts, until windows are worth choosing.
                    at = _window(scores[tokens], settings.window)
                    parts.append(tokens[at:at + settings.window] if 6 * epoch >= epochs else tokens)
            lengths = np.array([len(p) for p in parts])
            flat = np.concatenate(parts)
            row = np.repeat(np.arange(len(parts)), lengths)
            share_of = 1.0 / np.maximum(lengths, 1)
            mean = np.stack([np.bincount(row, vectors[flat, d], len(parts)) for d in range(settings.dim)], 1) * share_of[:, None]
            logits = mean @ soft + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            odds /= odds.sum(1, keepdims=True)
            odds[np.arange(len(parts)), g.labels] -= 1
            odds *= (weight[g.labels] / len(parts))[:, None]
            back = (odds @ soft.T) * share_of[:, None]
            by_word = np.stack([np.bincount(flat, back[row, d], len(g.size)) for d in range(settings.dim)], 1) / g.size[:, None]
            step = np.stack([np.bincount(g.at, by_word[g.owner, d], len(g.rows)) for d in range(settings.dim)], 1)
            for weights, seen, slope in ((soft, seen_soft, mean.T @ odds), (bias, seen_bias, odds.sum(0))):
                seen += slope * slope
                weights -= (rate * 0.3 * slope / np.sqrt(seen)).astype(np.float32)
            total = seen_table[g.rows] + step * step
            seen_table[g.rows] = total
            table[g.rows] -= (rate * step / np.sqrt(total)).astype(np.float32)
    return (table @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0])


class Scorer:
    """Scores texts in the task, remembering the words it has met."""

    def __init__(self, weights: np.ndarray, bias: float, settings: Settings):
        self.weights, self.bias, self.settings = weights, bias, settings
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.scores, self.hashes = np.zeros(0, np.float32), np.zeros(0, np.uint64)

    def learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 50_000):
            part = words[at:at + 50_000]
            buckets, owner, hashes = bags(part, self.settings)
            total = np.bincount(owner, self.weights[buckets], len(part)) / np.bincount(owner, minlength=len(part))
            self.index.update(zip(part, range(len(self.index), len(self.index) + len(part)), strict=True))
            self.scores = np.concatenate([self.scores, total.astype(np.float32)])
            self.hashes = np.concatenate([self.hashes, hashes])

    def score(self, texts: list[str | None]) -> np.ndarray:
        split = [words_of(t, self.settings) for t in texts]
        if len(self.index) > REMEMBERED:
            self.forget()
        self.learn(sorted(set().union(*split).difference(self.index)))
        logits = np.full(len(texts), self.bias)
        for k, words in enumerate(split):
            if not words:
                continue
            at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            scores = self.scores[at].astype(np.float64)
            if self.settings.pool == "max":
                start = _window(scores, self.settings.window)
                logits[k] += scores[start:start + self.settings.window].mean()
            elif self.settings.word_pairs:
                next_to = self.weights[pairs(self.hashes[at], self.settings)]
                logits[k] += (scores.sum() + next_to.sum(dtype=np.float64)) / (len(scores) + len(next_to))
            else:
                logits[k] += scores.mean()
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def sample(documents: DataFrame, labels: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """(doc_id, text, label): the bounded rows to learn from. ``labels`` has doc_id and label 0 or 1.

    A label counts once for an id, and of an id given to several documents one text is
    learned from, that of the smallest hash: repeated rows neither fill the sample nor the task.
    """
    texts = documents.select("doc_id", text_of(text).alias("text"))
    texts = texts.filter(F.octet_length("text") <= settings.train_bytes)
    # Chosen among the rows that can be learned from, so long texts do not thin out a label.
    known = stored(labels.filter("doc_id is not null").distinct().join(texts.select("doc_id"), "doc_id", "left_semi"), "labels")
    parts = [
        known.filter(F.col("label") == value).select("doc_id", "label")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.rows_per_label)
        for value in (0, 1)
    ]
    chosen = stored(parts[0].union(parts[1]), "label-sample")
    texts = texts.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", F.col("least.text").alias("text"), "label")


def fit(documents: DataFrame, labels: DataFrame, settings: Settings, text: str = "text") -> tuple[np.ndarray, float]:
    """Learns in one task from the bounded sample; the model has ``buckets`` numbers."""

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True)]
        rows.sort(key=lambda r: (r[0], r[2], r[1]))
        model = train([r[1] for r in rows], np.array([r[2] for r in rows], np.int64), settings)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    rows = sample(documents, labels, settings, text)
    found = rows.repartition(1).mapInArrow(learned, "model binary").first()
    return pickle.loads(found.model) if found else train([], np.zeros(0, np.int64), settings)


def score(documents: DataFrame, model: tuple[np.ndarray, float], settings: Settings, text: str = "text", column: str = "score") -> DataFrame:
    """Adds the score (0 to 1) of every whole text."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in documents.columns if c.lower() != column.lower()]
    schema = T.StructType([f for f in documents.schema.fields if f.name in kept] + [T.StructField(column, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        scorer = Scorer(*sent.value, settings)
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), ROWS):
                rows = batch.slice(at, ROWS)
                place = rows.schema.get_field_index
                made = pa.array(scorer.score(rows.column(place(text)).to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([rows.column(place(c)) for c in kept] + [made], [*kept, column])

    return documents.mapInArrow(scored, schema)


def labelled(labels: DataFrame, of: str, outside: Column) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from."""
    return labels.filter(~outside).select("doc_id", F.col(of).cast("int").alias("label")).filter(F.col("label").isin(0, 1))
