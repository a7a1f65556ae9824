"""SimHash near duplicates by the pigeonring filter.

A 64-bit fingerprint has a bit set where more than half of the hashes of the text's
word shingles have it. The 64 bits are a ring of m segments: five, or one more than
``distance`` if that is more. If two fingerprints differ in at most ``distance`` bits,
then from some segment on, every chain of l segments differs in at most
l * distance / m bits (rounded down: none in the first segment, one in the first two,
...). So candidates must agree on a segment and differ in at most one bit of the next.
Every distinct fingerprint is written under each of its m pairs of neighbouring segments
and under all one-bit changes of the second one. Far distances have short segments and
many candidates; a distance of 64 or more is refused. Rows of equal key meet, longer chains prune, and the full Hamming
distance decides.

Equal fingerprints are one row before that. Pairs never leave a task: each task
keeps a spanning forest of the links it finds, which has fewer edges than rows. A key
that would bring more than ``BLOCK`` fingerprints to one task is dealt as pairs of
blocks, so nothing is capped and no task holds an unbounded group.

Defined cases: a missing text is an empty one; texts without words have fingerprint
zero and link like any other; texts shorter than a shingle use the whole sequence;
repeated rows link; a missing id never names a component unless all its ids are
missing, then the component is missing; clashing column names do not matter, since
the result has its own columns.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.common import stored, unused
from tillmart.llm.components import components

#: Fingerprints of one key that one task compares.
BLOCK = 4096
PIECE = 1 << 15


def shingle_hashes(text: str | None, shingle: int = 4, seed: int = 42) -> np.ndarray:
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return np.zeros(0, "<u8")
    plain = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(len(words) - shingle, 0)
    spans = zip(starts[: last + 1].tolist(), ends[min(shingle, len(words)) - 1:].tolist(), strict=False)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(plain[a:b], seed) for a, b in spans], "<u8")


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    return fingerprint_of(shingle_hashes(text, shingle, seed))


def fingerprint_of(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes have it."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), PIECE):
        part = hashes[at:at + PIECE].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def add_fingerprint(documents: DataFrame, text: str = "text", column: str = "simhash", shingle: int = 4) -> DataFrame:
    """Adds the fingerprint as a signed 64-bit number, the text column being dropped."""
    kept = [c for c in documents.columns if c not in (text, column)]
    schema = T.StructType([f for f in documents.schema.fields if f.name in kept] + [T.StructField(column, T.LongType())])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        for batch in batches:
            place = batch.schema.get_field_index
            texts = batch.column(place(text))
            found = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(place(c)) for c in kept] + [pa.array(found, pa.int64())], [*kept, column])

    return documents.mapInArrow(made, schema)


def widths(distance: int) -> list[int]:
    """The bits of each segment, so many that a segment is equal if at most ``distance`` bits differ."""
    if not 0 <= distance < 64:
        raise ValueError("the distance of 64-bit fingerprints is from 0 to 63")
    count = max(5, distance + 1)
    return [64 // count + (k < 64 % count) for k in range(count)]


def _segments(prints: np.ndarray, distance: int = 4) -> list[np.ndarray]:
    wide = widths(distance)
    starts = np.cumsum([0, *wide[:-1]]).tolist()
    return [(prints >> np.uint64(s)) & np.uint64((1 << w) - 1) for s, w in zip(starts, wide, strict=True)]


def _written(batches: Iterator[pa.RecordBatch], exact: bool, distance: int) -> Iterator[pa.RecordBatch]:
    """The ring keys of each fingerprint: (start, segment, next segment), the latter with its one-bit changes."""
    wide = widths(distance)
    for batch in batches:
        everything = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(everything), 4096):
            prints = everything[at:at + 4096]
            parts, keys = _segments(prints, distance), []
            for k in range(len(parts)):
                after = (k + 1) % len(parts)
                following = parts[after]
                base = (np.uint64(k) << np.uint64(26)) | (parts[k] << np.uint64(13))
                keys.append(base | following)
                if not exact:
                    keys += [base | (following ^ np.uint64(1 << b)) for b in range(wide[after])]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(np.concatenate(keys).astype(np.int64)),
                "print": pa.array(np.tile(prints, len(keys)).view(np.int64)),
            })


def close(a: np.ndarray, b: np.ndarray, start: np.ndarray, distance: int) -> np.ndarray:
    """Whether pairs pass the chains from their start segment on, and then the whole distance."""
    apart = a ^ b
    passed = np.ones(len(apart), bool)
    counts = [np.bitwise_count(s).astype(np.int64) for s in _segments(apart, distance)]
    counts = np.stack(counts)
    total = np.zeros(len(apart), np.int64)
    here = np.arange(len(apart))
    for length in range(1, len(counts)):
        total += counts[(start + length - 1) % len(counts), here]
        passed &= total <= length * distance // len(counts)
    passed[passed] = np.bitwise_count(apart[passed]) <= distance
    return passed


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links: each node with the smallest node it reaches."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for side in (a, b):
            np.minimum.at(new, side, low)
            np.minimum.at(new, root[side], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    linked = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[linked], nodes[root[linked]]


def _compare(keys: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by key, rows of one key being compared with each other."""
    found_u, found_v = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    start = (keys >> 26).astype(np.int64)
    edges = np.flatnonzero(np.diff(keys, prepend=-1, append=-1))
    sizes = np.diff(edges)
    small = np.repeat(sizes <= 32, sizes)
    rows = np.flatnonzero(small)
    for shift in range(1, 32):
        if len(rows) <= shift:
            break
        rows = rows[rows + shift < len(keys)]
        rows = rows[keys[rows] == keys[rows + shift]]
        if not len(rows):
            break
        passed = close(prints[rows], prints[rows + shift], start[rows], distance)
        found_u.append(prints[rows[passed]])
        found_v.append(prints[rows[passed] + shift])
    for at, size in zip(edges[:-1][sizes > 32].tolist(), sizes[sizes > 32].tolist(), strict=True):
        group = prints[at:at + size]
        for low in range(0, size, 256):
            near = np.bitwise_count(group[low:low + 256, None] ^ group[None, low:])
            i, j = np.nonzero(near <= distance)
            ahead = j > i
            i, j = i[ahead] + low, j[ahead] + low
            passed = close(group[i], group[j], np.full(len(i), start[at]), distance)
            found_u.append(group[i[passed]])
            found_v.append(group[j[passed]])
            if sum(map(len, found_u)) > 1 << 20:
                u, v = forest(np.concatenate(found_u), np.concatenate(found_v))
                found_u, found_v = [u], [v]
    return np.concatenate(found_u), np.concatenate(found_v)


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, x, y, print) sorted by the first three -> a forest of this task's links."""
    held_u, held_v, count = [], [], 0
    rest = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def compared(keys, blocks, prints):
        nonlocal held_u, held_v, count
        group = np.cumsum((np.diff(keys, prepend=keys[:1]) != 0) | (np.diff(blocks, prepend=blocks[:1]) != 0))
        u, v = _compare((keys >> 26 << 26) | group, prints, distance)
        held_u.append(u)
        held_v.append(v)
        count += len(u)
        if count > 1 << 20:
            u, v = forest(np.concatenate(held_u), np.concatenate(held_v))
            held_u, held_v, count = [u], [v], 0

    for batch in batches:
        keys, x, y, prints = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        blocks = x.astype(np.int64) << 32 | y
        keys, blocks, prints = (np.concatenate(c) for c in zip(rest, (keys, blocks, prints.view(np.uint64)), strict=True))
        same = (keys == keys[-1]) & (blocks == blocks[-1]) if len(keys) else np.zeros(0, bool)
        rest = keys[same], blocks[same], prints[same]
        if not same.all():
            compared(keys[~same], blocks[~same], prints[~same])
    if len(rest[0]):
        compared(*rest)
    if held_u:
        u, v = forest(np.concatenate(held_u), np.concatenate(held_v))
        yield pa.RecordBatch.from_pydict({"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})


def link_fingerprints(prints: DataFrame, distance: int = 4, block: int = BLOCK) -> DataFrame:
    """(print long), distinct -> (u, v): links that join all fingerprints within the distance."""
    widths(distance)  # refuses what has no ring
    written = prints.mapInArrow(lambda b: _written(b, False, distance), "key long, print long")
    # A key's rows are at most the exact rows of its one-bit neighbours, so only crowded neighbourhoods can be large.
    crowded = (
        prints.mapInArrow(lambda b: _written(b, True, distance), "key long, print long")
        .groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > block // 14)
        .select(F.explode(F.concat(
            F.array("key"), F.transform(F.sequence(F.lit(0), F.lit(12)), lambda b: F.col("key").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))
        )).alias("key"), "n")
        .groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > block)
        .select(F.col("key").alias("large"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    dealt = written.join(stored(crowded, "crowded-keys"), F.col("key") == F.col("large"), "left")
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(F.col("own"), o).alias("x"), F.greatest(F.col("own"), o).alias("y")),
    )
    one = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))
    dealt = (
        dealt.withColumn("own", own)
        .select("key", "print", F.explode(F.when(F.col("large").isNull(), one).otherwise(others)).alias("at"))
        .select("key", F.col("at.x").alias("x"), F.col("at.y").alias("y"), "print")
    )
    dealt = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "print")
    return dealt.mapInArrow(lambda b: _links(b, distance), "u long, v long")


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = 4, shingle: int = 4
) -> DataFrame:
    """One row per document: doc_id, its ``simhash`` (signed), component_id, and ``text_key`` (a hash of the text)."""
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    rows = stored(add_fingerprint(rows, "text", "simhash", shingle), "simhash")
    classes = stored(rows.groupBy("simhash").agg(F.min("doc_id").alias("least")), "simhash-classes")
    found = components(link_fingerprints(classes.select(F.col("simhash").alias("print")), distance))
    classes = classes.join(found, classes["simhash"] == found["node"], "left").select(
        F.col("simhash").alias("of"), "least", F.coalesce("component", "simhash").alias("component")
    )
    named = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = stored(classes.join(named, "component").select("of", "component_id", "component"), "simhash-components")
    return rows.join(classes, rows["simhash"] == classes["of"]).select("doc_id", "simhash", "component_id", "text_key", "component")


def keep_one(documents: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id stays.

    Rows with a missing id come last; among rows of equal id the smallest text hash stays, and of
    rows equal in both any one.
    """
    return first_of_each(documents, near_duplicates(documents, distance=distance, shingle=shingle))


def first_of_each(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that come first in their component; ``found`` has doc_id, text_key and component."""
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_key")
    stay = stored(
        found.groupBy("component").agg(F.min(order).alias("first")).select(
            F.col("first.doc_id").alias("stay_id"), F.col("first.text_key").alias("stay_key")
        ).distinct(),
        "simhash-kept",
    )
    (key,) = unused(documents, "text_key")
    rows = documents.withColumn(key, F.xxhash64("text"))
    left = rows.join(stay, rows["doc_id"].eqNullSafe(stay["stay_id"]) & (rows[key] == stay["stay_key"]), "left_semi")
    return left.dropDuplicates(["doc_id", key]).drop(key)
