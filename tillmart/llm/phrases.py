"""Collocations: phrases that stand together more often than their parts make likely.

Toivonen's mining. A sample of the documents, at a lowered threshold, proposes the
frequent phrases. One pass over all documents then counts these and their negative
border: the border holds each phrase that was not proposed although its first and its
last words but one both were (every word is in it). A border phrase that turns out
frequent is a failure of the sample. An expansion pass over all documents counts what
the longer border brings, with all that might follow from it in turn: a phrase is
counted if each part is known to be frequent or counted in this pass. So it leaves no
frequent phrase uncounted, whatever the sample was.

The border is never listed; it would hold the square of the frequent words. What was
proposed is a bitmap of phrase hashes, at most ``MOST_BITS`` long. A task counts a
phrase where the bitmap holds both of its parts; a collision only counts a phrase too
many. The first pass counts 64-bit hashes of phrases, which are short to shuffle and can
only be too frequent; the expansion pass counts the phrases themselves, by their text,
those that the first one found and those it did not count. So all results are exact.
Tasks add up chunks of text before the shuffle, Spark adds up the rest, and the frequent
phrases are joined for scores.

Defined cases: a missing text is empty; a missing language is ``und``; texts of any
length are taken whole; repeated rows count each time; no document gives no row; columns
other than the two named are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillmart.llm.common import stored

#: One document of so many is in the sample; its threshold is so many deviations below the expected count. What a
#: high threshold misses is a few phrases for the expansion; what a low one proposes makes the border long.
SHARE, DEVIATIONS = 8, 0.5
#: Bits of the bitmap for each phrase, and in all: 32 MB.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: Bytes of text that a task counts at a time.
CHUNK = 1 << 20
#: A phrase ends at these characters; words are separated by space and tab.
BREAKS = b".,;:!?\n\x0b\x0c\r"

_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + b"." * len(BREAKS) + b" ")


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words; a single full stop stands for the end of a piece."""
    return text.translate(_PLAIN).replace(b".", b" . ").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _longer(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases, from those of all but the last word and that of the last word."""
    return _mixed(first * np.uint64(0xC2B2AE3D27D4EB4F) + word)


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _places(lang: bytes, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place: whether a word starts there, the hash of that word, and its hash as a phrase of the language."""
    numbers: dict[bytes, int] = {b".": 0}
    ids = np.array([numbers.setdefault(t, len(numbers)) for t in tokens], np.int64)
    word = np.array([xxhash.xxh64_intdigest(w) for w in numbers], np.uint64)[ids]
    return ids != 0, word, _longer(np.full(len(ids), xxhash.xxh64_intdigest(lang), np.uint64), word)


def border_hashes(
    lang: bytes, tokens: list[bytes], longest: int, bits: np.ndarray | None, seen: np.ndarray | None
) -> Iterator[np.ndarray]:
    """Hashes of the phrases, one for each place, whose parts ``bits`` holds and ``seen`` does not.

    Every word is in the border; without bits there are only words to count, and with
    ``seen`` they have been counted.
    """
    is_word, word, value = _places(lang, tokens)
    if seen is None:
        yield value[is_word]
    if bits is None:
        return
    known = _in(bits, value) & is_word
    before = _in(seen, value) & is_word if seen is not None else np.zeros(len(value), bool)
    for k in range(2, longest + 1):
        at = np.flatnonzero(known[:-1] & known[1:])
        at = at[at + k <= len(value)]
        if not len(at):
            return
        # Counted by an earlier pass: both parts were reached there by the same steps.
        old = before[at] & before[at + 1]
        value[at] = _longer(value[at], word[at + k - 1])
        yield value[at[~old]]
        known, before = np.zeros(len(value), bool), np.zeros(len(value), bool)
        known[at] = _in(bits, value[at])
        if seen is not None:
            before[at] = old & _in(seen, value[at])


def exact_phrases(
    lang: bytes, tokens: list[bytes], longest: int, bits: np.ndarray, frequent: np.ndarray
) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(number of words, phrases, counts) of all phrases that may be frequent; with 0 words the number of words.

    A phrase that the pass with ``bits`` counted may be frequent if ``frequent`` holds it.
    One that it did not count is counted now, and its parts may be such phrases in turn.
    """
    is_word, word, value = _places(lang, tokens)
    yield 0, [b""], np.array([np.count_nonzero(is_word)])
    may, before = _in(frequent, value) & is_word, _in(bits, value) & is_word
    at = np.flatnonzero(may)
    for k in range(1, longest + 1):
        if k > 1:
            at = np.flatnonzero(may[:-1] & may[1:])
            at = at[at + k <= len(value)]
            value[at] = _longer(value[at], word[at + k - 1])
            old = before[at] & before[at + 1]
            may, before = np.zeros(len(value), bool), np.zeros(len(value), bool)
            may[at] = ~old | _in(frequent, value[at])
            before[at] = old & _in(bits, value[at])
            at = at[may[at]]
        if not len(at):
            return
        counts = Counter(b" ".join(tokens[s:s + k]) for s in at.tolist())
        yield k, list(counts), np.fromiter(counts.values(), np.int64, len(counts))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Language and words of about ``CHUNK`` bytes of text at a time."""
    for batch in batches:
        waiting: dict[str, list[bytes]] = {}
        size = 0
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            text = value.as_py() or b""
            waiting.setdefault(lang, []).append(text)
            size += len(text)
            if size >= CHUNK:
                yield from ((x, words_of(b"\n".join(t))) for x, t in waiting.items())
                waiting, size = {}, 0
        yield from ((x, words_of(b"\n".join(t))) for x, t in waiting.items())


def _border_counts(documents: DataFrame, longest: int, bits: np.ndarray | None, seen: np.ndarray | None) -> DataFrame:
    """(h, f): how often each hash of a phrase of the border, or of a proposed one, stands in the documents."""
    sent = documents.sparkSession.sparkContext.broadcast((bits, seen))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, tokens in _chunks(batches):
            for hashes in border_hashes(lang.encode(), tokens, longest, *sent.value):
                found, counts = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "f"])

    return documents.mapInArrow(count, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


def _exact_counts(documents: DataFrame, longest: int, bits: np.ndarray, frequent: np.ndarray) -> DataFrame:
    """(lang, k, phrase, f) of the phrases that may be frequent; with k = 0 the number of all words of a language."""
    sent = documents.sparkSession.sparkContext.broadcast((bits, frequent))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, tokens in _chunks(batches):
            for k, phrases, counts in exact_phrases(lang.encode(), tokens, longest, *sent.value):
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(phrases), pa.string()), pa.array(np.full(len(phrases), k, np.int32)),
                    pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64)),
                ], names=["lang", "k", "phrase", "f"])

    rows = documents.mapInArrow(count, "lang string, k int, phrase string, f long")
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))


def _room(n_phrases: int, n_bits: int = 0) -> int:
    """Bits for so many phrases, at least n_bits and bounded."""
    n_bits = max(n_bits, LEAST_BITS)
    while n_bits < min(BITS_EACH * n_phrases, MOST_BITS):
        n_bits *= 2
    return n_bits


def _marked(hashes: DataFrame, n_bits: int) -> np.ndarray:
    """The bitmap of some hashes, joined by Spark; the driver takes at most n_bits."""
    slots = hashes.select(F.expr(f"shiftright(h & {n_bits - 1}L, 6)").alias("slot"), F.expr("cast(h & 63L as int)").alias("bit"))
    found = slots.groupBy("slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    bits = np.zeros(n_bits // 64, np.uint64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


def _proposed(part: DataFrame, least: int, longest: int) -> np.ndarray:
    """The bitmap of the phrases found at least so often in a sample; each pass counts phrases a word longer."""
    bits, seen = None, None
    for _ in range(longest):
        found = stored(_border_counts(part, longest, bits, seen).filter(F.col("f") >= least).select("h"), "phrase-proposals")
        n_found = found.count()
        if not n_found:
            break
        seen = np.zeros(LEAST_BITS // 64, np.uint64) if bits is None else bits
        n_bits = _room(n_found, len(seen) * 64)
        # A place in a longer bitmap has the same last bits, so copies of the old one answer alike.
        seen = np.tile(seen, n_bits // (len(seen) * 64))
        bits = seen | _marked(found, n_bits)
    return np.zeros(LEAST_BITS // 64, np.uint64) if bits is None else bits


def frequent_phrases(documents: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, longest: int = 5) -> DataFrame:
    """(lang, k, phrase, f) of all phrases of 1 to ``longest`` words with f >= least; k = 0 holds the words of a language."""
    rows = documents.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    part = stored(rows.filter(F.pmod(F.xxhash64("lang", "text"), F.lit(SHARE)) == 0), "phrase-sample")
    expected = least / SHARE
    bits = _proposed(part, max(2, int(expected - DEVIATIONS * expected ** 0.5)), longest)
    found = stored(_border_counts(rows, longest, bits, None).filter(F.col("f") >= least).select("h"), "phrase-hashes")
    frequent = _marked(found, _room(found.count()))
    counted = _exact_counts(rows, longest, bits, frequent)
    return stored(counted.filter((F.col("k") == 0) | (F.col("f") >= least)), "phrase-counts")


def scored(found: DataFrame, scale: int = 1000) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of two words or more, by the cut with the lowest score."""
    exact = "decimal(38,0)"
    words = F.split("phrase", " ")
    cuts = found.filter("k > 1").select("lang", "phrase", F.col("f").alias("a"), words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut")), " ").alias("rest"),
    )
    part = found.filter("k > 0").select("lang", "phrase", "f")
    # A table of its own, so that Spark knows how small it is: one row a language.
    totals = stored(found.filter("k = 0").select("lang", F.col("f").alias("n")), "phrase-totals")
    sized = (
        cuts.join(part.withColumnsRenamed({"phrase": "first", "f": "l"}), ["lang", "first"])
        .join(part.withColumnsRenamed({"phrase": "rest", "f": "r"}), ["lang", "rest"])
        .join(totals, "lang")
    )
    over = (F.lit(scale).cast("decimal(10,0)") * F.col("a").cast("decimal(19,0)")).cast("decimal(22,0)") * F.col("n").cast("decimal(16,0)")
    under = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")
    sized = sized.withColumns({"over": over.cast(exact), "under": under.cast(exact)}).withColumn("score", F.expr("over div under"))
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("s")
    return sized.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")


def uncovered(candidates: DataFrame, percent: int = 100) -> DataFrame:
    """Without the phrases that stand inside a longer one with at least this share of their count."""
    words = F.split("phrase", " ")
    size = F.size(words)
    inner = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice(words, i, k), " ")))))
    longer = candidates.filter(size > 2).select("lang", inner.alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left")
    return kept.filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def collocations(
    documents: DataFrame, lang: str = "lang", text: str = "text", least: int = 100, longest: int = 5, first: int | None = 2000
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases by score."""
    found = frequent_phrases(documents, lang, text, least, longest)
    kept = uncovered(stored(scored(found), "phrase-scores"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    kept = kept.withColumn("rank", F.row_number().over(order))
    if first is not None:
        kept = kept.filter(F.col("rank") <= first)
    return kept.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
