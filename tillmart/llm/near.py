"""Near copies: documents whose sets of word shingles have a Jaccard similarity of at least a limit.

Every document is its set of shingle hashes; equal sets are one row from the start. The
least hashes of the set under fixed permutations are taken ``ROWS`` at a time as keys.
Two sets agree in one such key with probability similarity ** ROWS, and there are so
many keys that a pair at the limit shares none of them with probability ``MISS``. A
64-bit SimHash has no such keys at 0.8: there about 10 of its bits differ.

The nearest copies are found by SimHash: all sets whose 64-bit fingerprints the pigeonring
filter of ``simhash`` joins have one more key in common, so every two sets whose
fingerprints are equal or within its distance are candidates too, as are sets that share a
key of least hashes, and only the whole sets decide. First each set is compared with those its
fingerprint names and with the smallest one of each of its keys, which joins nearly all groups.
Then the sets of a key that are still in several groups are compared with each other inside
tasks; a key that would bring more than ``BLOCK`` shingles to one task is dealt as pairs
of blocks. Tasks return no more links than rows, nothing is capped.

Defined cases: a missing text is an empty one; texts without words are one group; texts
shorter than a shingle are one shingle; repeated rows link.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.common import stored
from tillmart.llm.components import components
from tillmart.llm.simhash import fingerprint_of, first_of_each, link_fingerprints, shingle_hashes

SIMILARITY, SHINGLE = 0.8, 5
ROWS = 5
MISS = 1e-6
#: Shingles of one key that one task compares.
BLOCK = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def bands(similarity: float) -> int:
    """How many keys a set needs."""
    if not 0 < similarity <= 1:
        raise ValueError("the similarity is above 0 and at most 1")
    return 1 if similarity == 1 else max(1, math.ceil(math.log(MISS) / math.log1p(-(similarity ** ROWS))))


@lru_cache
def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.default_rng(42).integers(0, 1 << 64, (2, count), dtype=np.uint64)
    return numbers[0], numbers[1] | np.uint64(1)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle))


def band_keys(hashes: np.ndarray, count: int) -> np.ndarray:
    """The keys of a set; an empty one has none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    salt, odd = _permutations(count * ROWS)
    least = np.full(count * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 256):
        mixed = (hashes[at:at + 256, None] ^ salt) * odd
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, (mixed * MIX).min(axis=0))
    keys = np.arange(1, count + 1, dtype=np.uint64) * MIX
    for part in least.reshape(count, ROWS).T:
        keys = (keys ^ part) * MIX
        keys ^= keys >> np.uint64(29)
    return keys


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _sketched(rows: DataFrame, count: int, shingle: int) -> DataFrame:
    """(doc_id, text_key, text) -> the text as its set's number, size, fingerprint and keys."""
    schema = T.StructType([
        *[f for f in rows.schema.fields if f.name != "text"],
        T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("print", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                nodes, sizes, prints, keys = [], [], [], []
                for text in batch.column(2):
                    found = shingle_set(text.as_py(), shingle)
                    nodes.append(xxhash.xxh64_intdigest(found.tobytes(), 42))
                    sizes.append(len(found))
                    prints.append(fingerprint_of(found))
                    keys.append(band_keys(found, count))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()),
                     pa.array(np.array(prints, np.uint64).view(np.int64)), _lists(keys)],
                    ["doc_id", "text_key", "node", "n", "print", "keys"],
                )

    return rows.mapInArrow(made, schema)


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(node, text) -> (node, hashes)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                found = [shingle_set(t.as_py(), shingle) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], ["node", "hashes"])

    return rows.mapInArrow(made, "node long, hashes array<long>")


def compare(groups: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs of places of non-empty sets that join all groups with a similar pair."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    groups = groups[order]
    sizes = np.array([len(sets[k]) for k in order])
    _, flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    ends = np.cumsum(sizes)
    marked = np.zeros(flat.max() + 1, bool)
    found = []
    for i in range(len(sets) - 1):
        last = np.searchsorted(sizes, sizes[i] / similarity, "right")  # longer ones cannot be similar
        others = np.flatnonzero(groups[i + 1:last] != groups[i])
        if not len(others):
            continue
        mine = flat[ends[i] - sizes[i]:ends[i]]
        marked[mine] = True
        shared = np.add.reduceat(marked[flat[ends[i]:ends[last - 1]]], ends[i:last - 1] - ends[i], dtype=np.int64)[others]
        marked[mine] = False
        others += i + 1
        for j in others[shared / (sizes[i] + sizes[others] - shared) >= similarity].tolist():
            if groups[j] != groups[i]:
                found.append((int(order[i]), int(order[j])))
                groups[groups == groups[j]] = groups[i]
    return found


def _compared(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Rows (key, x, y, node, component, hashes) sorted by the first three -> links."""
    at, nodes, groups, sets = None, [], [], []

    def links() -> pa.RecordBatch:
        pairs = compare(np.array(groups), sets, similarity) if len(nodes) > 1 else []
        return pa.RecordBatch.from_pydict({
            "u": pa.array([nodes[i] for i, _ in pairs], pa.int64()), "v": pa.array([nodes[j] for _, j in pairs], pa.int64())
        })

    for batch in batches:
        places = zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True)
        hashes = batch.column(5)
        starts, flat = hashes.offsets.to_numpy(), hashes.values.to_numpy()
        for k, (key, x, y, node, component) in enumerate(places):
            if (key, x, y) != at:
                yield links()
                at, nodes, groups, sets = (key, x, y), [], [], []
            nodes.append(node)
            groups.append(component)
            sets.append(flat[starts[k]:starts[k + 1]].copy())
    yield links()


def _similar(a: Column, b: Column, similarity: float) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared) >= similarity


def _print_links(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two frames of what the pigeonring filter finds.

    (u, v, n_u, n_v): each set with the smallest one of its fingerprint, and those of linked fingerprints.
    (node, n, key): the sets that are not alone, with a key for all fingerprints that are joined. The links
    are a forest and name one set a fingerprint, so the pairs of a key are all still to be compared.
    """
    classes = classes.filter("n > 0")
    prints = classes.groupBy("print").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("many"))
    prints = stored(prints, "near-prints")
    links = stored(link_fingerprints(prints.select("print")), "near-print-links")
    equal = classes.join(prints, "print").filter(F.col("node") != F.col("hub.node"))
    equal = equal.select(F.col("hub.node").alias("u"), F.col("node").alias("v"), F.col("hub.n").alias("n_u"), F.col("n").alias("n_v"))
    first = prints.select(F.col("print").alias("u"), F.col("hub").alias("a"))
    second = prints.select(F.col("print").alias("v"), F.col("hub").alias("b"))
    near = links.join(first, "u").join(second, "v")
    pairs = equal.union(near.select("a.node", "b.node", "a.n", "b.n"))

    joined = prints.join(components(links), F.col("print") == F.col("node"), "left").filter("many > 1 or node is not null")
    joined = joined.select(F.col("print").alias("of"), F.xxhash64(F.lit("simhash"), F.coalesce("component", "print")).alias("key"))
    return pairs, classes.join(joined, F.col("print") == F.col("of")).select("node", "n", "key")


def _links(classes: DataFrame, documents: DataFrame, similarity: float, shingle: int, block: int) -> DataFrame:
    """(u, v): links that join all similar sets."""
    pairs, print_keys = _print_links(classes)
    keyed = classes.select("node", "n", F.explode("keys").alias("key")).union(print_keys)
    met = keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("many")).filter("many > 1")
    members = stored(keyed.join(met.select("key", "hub"), "key").filter(F.col("node") != F.col("hub.node")), "near-members")
    hubs = members.select(F.col("hub.node").alias("u"), F.col("node").alias("v"), F.col("hub.n").alias("n_u"), F.col("n").alias("n_v"))
    hubs = hubs.union(pairs)
    hubs = hubs.filter(F.least("n_u", "n_v") >= similarity * F.greatest("n_u", "n_v") - 0.5).select("u", "v").distinct()
    hubs = stored(hubs, "near-pairs")

    needed = members.select("node").union(members.select("hub.node")).union(hubs.select("u")).union(hubs.select("v")).distinct().join(classes.select("node", "doc_id", "text_key"), "node")
    needed = needed.select("node", F.col("doc_id").alias("of"), F.col("text_key").alias("of_key"))
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    texts = texts.join(needed, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_key"))).select("node", "text")
    sets = stored(_sets(texts, shingle).dropDuplicates(["node"]), "near-sets")

    pairs = hubs.join(sets.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v")
    pairs = pairs.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u")
    first = stored(pairs.filter(_similar(F.col("a"), F.col("b"), similarity)).select("u", "v"), "near-first")

    rest = members.join(components(first), "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    rest = stored(rest, "near-rest")
    open_keys = rest.groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.ceil(F.sum("n") / block).cast("int").alias("blocks")
    ).filter("a <> b").select("key", "blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(F.col("own"), o).alias("x"), F.greatest(F.col("own"), o).alias("y")),
    )
    dealt = (
        rest.join(open_keys, "key").withColumn("own", own).select("key", "node", "component", F.explode(others).alias("at"))
        .join(sets, "node").select("key", "at.x", "at.y", "node", "component", "hashes")
        .repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    )
    return first.union(dealt.mapInArrow(lambda b: _compared(b, similarity), "u long, v long").distinct())


def near_copies(
    documents: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """One row per document: doc_id, text_key (a hash of the text), and the component of its text."""
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = stored(_sketched(rows, bands(similarity), shingle), "near-sketches")
    classes = stored(rows.dropDuplicates(["node"]), "near-classes")
    found = components(_links(classes, documents, similarity, shingle, block))
    joined = rows.select("doc_id", "text_key", F.col("node").alias("of")).join(found, F.col("of") == F.col("node"), "left")
    return joined.select("doc_id", "text_key", F.coalesce("component", "of").alias("component"))


def keep_one(documents: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id stays."""
    return first_of_each(documents, near_copies(documents, similarity, shingle))
