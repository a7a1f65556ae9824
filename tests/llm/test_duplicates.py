from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.rows import empty_documents, odd_documents, sentence, with_clashes
from tillmart.llm import components, simhash, vectors
from tillmart.llm.queries import QUERIES


def brute_groups(count: int, pairs) -> list[int]:
    parent = list(range(count))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(a) for a in range(count)]


def brute_print(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for k in range(64):
            votes[k] += h >> k & 1
    return sum(1 << k for k in range(64) if votes[k] * 2 > len(shingles))


def test_fingerprint_is_the_majority_of_shingle_hashes():
    rng = random.Random(1)
    for text in [None, "", " \t", "One", "a b c", "A  b\tC d", "é É x y z", *(sentence(rng, rng.randint(1, 60)) for _ in range(40))]:
        assert simhash.fingerprint(text) == brute_print(text)


def test_ring_keys_find_every_pair_within_the_distance():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    flips = np.zeros(4000, np.uint64)
    for _ in range(4):
        flips ^= np.uint64(1) << rng.integers(0, 64, 4000, dtype=np.uint64)
    other = base ^ flips
    found = np.zeros(4000, bool)
    for k in range(5):
        a, b = simhash._segments(base), simhash._segments(other)
        meet = (a[k] == b[k]) & (np.bitwise_count(a[(k + 1) % 5] ^ b[(k + 1) % 5]) <= 1)
        found |= meet & simhash.close(base, other, np.full(4000, k), 4)
    assert found.all()
    assert not simhash.close(base, base ^ np.uint64(0b11111), np.zeros(4000, np.int64), 4).any()


def _linked_groups(spark, values, block):
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "print long")
    found = components.components(simhash.link_fingerprints(frame, 4, block))
    return {r.node: r.component for r in found.collect()}


def test_crowded_keys_are_dealt_in_blocks_without_losing_links(spark):
    rng = np.random.default_rng(3)
    centre = np.uint64(0x0123456789ABCDEF)
    values = {int(centre)}
    while len(values) < 500:  # a tight cluster, a chain away from it, and strangers
        values.add(int(centre ^ (np.uint64(1) << np.uint64(rng.integers(64))) ^ (np.uint64(1) << np.uint64(rng.integers(64)))))
    values |= {int(v) for v in rng.integers(0, 1 << 63, 200, dtype=np.uint64)}
    values = sorted(values)
    array = np.array(values, np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None]) <= 4
    want = brute_groups(len(values), np.argwhere(np.triu(near, 1)).tolist())
    for block in (4096, 64):
        got = _linked_groups(spark, values, block)
        names = [got.get(int(np.uint64(v).view(np.int64)), i) for i, v in enumerate(values)]
        assert len(set(zip(names, want, strict=True))) == len(set(names)) == len(set(want))


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(100, 190)] + [(500, i) for i in range(501, 700)] + [(900, 901), (901, 902), (902, 900), (3, 3)]
    edges += [(rng.randint(-50, 50), rng.randint(-50, 50)) for _ in range(40)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = sorted({n for e in edges for n in e})
    want = brute_groups(len(nodes), [(nodes.index(a), nodes.index(b)) for a, b in edges])
    for i, n in enumerate(nodes):
        assert found.get(n, n) == nodes[want[i]]


def test_simhash_odd_rows(spark):
    documents = with_clashes(odd_documents(spark))
    rows = documents.select("doc_id", "text").collect()
    found = simhash.near_duplicates(documents).collect()
    assert len(found) == len(rows)
    prints = [brute_print(r.text) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    groups = brute_groups(len(rows), pairs)
    least = {}
    for g, r in zip(groups, rows, strict=True):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), str(least.get(g))) for g, r in zip(groups, rows, strict=True))
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == want
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns and kept.count() == len(set(groups))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(least.values())
    assert simhash.keep_one(empty_documents(spark)).count() == 0


def test_simhash_query_against_brute_force(spark, sample_dir):
    rows = spark.read.parquet(f"{sample_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = np.array([brute_print(r.text) for r in rows], np.uint64)
    groups = brute_groups(len(rows), np.argwhere(np.triu(np.bitwise_count(prints[:, None] ^ prints[None]) <= 4, 1)).tolist())
    found = {r.doc_id: r for r in QUERIES["op7_simhash"].run(spark, sample_dir).collect()}
    for i, r in enumerate(rows):
        assert found[r.doc_id].fingerprint == f"{int(prints[i]):016x}" and found[r.doc_id].component_id == rows[groups[i]].doc_id


def _brute_vectors(rows, cosine=0.98):
    def unit(v):
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        return np.array(v, float) / np.linalg.norm(v) if ok else None

    units = [unit(r[1]) if r[2] is not None else None for r in rows]
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
        and units[i] @ units[j] >= cosine
    ]
    return pairs


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, nan, inf = [], float("nan"), float("inf")
    for k in range(240):
        if k % 3 == 2:
            base = np.array(rows[rng.integers(len(rows))][1])
            rows.append([k, (base + rng.normal(0, 0.028, 12)).tolist(), int(rng.integers(2))])
        else:
            rows.append([k, (rng.normal(0, 0.3, 12)).tolist(), int(rng.integers(2))])
    rows += [[300 + k, rows[0][1], 0] for k in range(5)]
    rows += [[310, None, 0], [311, [], 0], [312, [0.0] * 12, 0], [313, [nan] * 12, 0], [314, [inf] + [1.0] * 11, 0], [315, [None] + [1.0] * 11, 0],
             [316, rows[0][1], None], [317, rows[0][1][:5], 0], [318, [2 * x for x in rows[0][1]], 0], [319, [-0.0] + [1.0] * 11, 1], [320, [0.0] + [1.0] * 11, 1]]
    frame = spark.createDataFrame([tuple(r) for r in rows], "vec_id long, embedding array<double>, label int")
    pairs = _brute_vectors(rows)
    groups = brute_groups(len(rows), pairs)
    links = np.bincount(np.array(pairs).ravel(), minlength=len(rows))
    least = [min(rows[j][0] for j in range(len(rows)) if groups[j] == g) for g in groups]
    assert links.sum() > 100
    for block in (1024, 16):
        found = {r.vec_id: r for r in vectors.near_vectors(frame, block=block).collect()}
        assert len(found) == len(rows)
        for i, r in enumerate(rows):
            assert (found[r[0]].n_links, found[r[0]].component_id, found[r[0]].kept) == (links[i], least[i], least[i] == r[0]), (block, r[0])
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def check_vectors(found, rows):
    pairs = _brute_vectors(rows)
    groups = brute_groups(len(rows), pairs)
    links = np.bincount(np.array(pairs, int).reshape(-1, 2).ravel(), minlength=len(rows))
    found = {r.vec_id: r for r in found}
    assert len(found) == len(rows)
    for i, r in enumerate(rows):
        got = found[r[0]]
        assert (got.n_links, got.component_id, got.kept) == (links[i], rows[groups[i]][0], groups[i] == i), r[0]
    return int(links.sum())


def test_vector_query_against_brute_force(spark, sample_dir):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{sample_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect())
    check_vectors(QUERIES["op6_embedding_dedup"].run(spark, sample_dir).collect(), rows)


def test_vector_query_with_planted_links_in_many_blocks_of_one_label(spark, tmp_path, monkeypatch):
    """Clusters, chains of near copies and unlike vectors, nearly all of one label; blocks of 48."""
    monkeypatch.setattr(vectors, "BLOCK", 48)
    monkeypatch.setattr(vectors.near_vectors, "__defaults__", (*vectors.near_vectors.__defaults__[:-1], 48))
    rng = np.random.default_rng(17)
    points = list(rng.normal(size=(500, 16)))
    for _ in range(120):
        base = points[rng.integers(500)]
        points += [base + rng.normal(0, 0.06, 16) for _ in range(3)]
    step = rng.normal(size=16)
    for _ in range(60):  # a chain whose ends are far apart
        step = step / np.linalg.norm(step) + rng.normal(0, 0.03, 16)
        points.append(step)
    order = rng.permutation(len(points))
    rows = [(k, points[i].astype(np.float32).tolist(), 3 if k % 9 else 4) for k, i in enumerate(order.tolist())]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert check_vectors(QUERIES["op6_embedding_dedup"].run(spark, str(tmp_path)).collect(), rows) > 300


def test_vectors_with_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], 1, "x"), (2, [1.0, 0.001], 1, "y")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string")
    for name in ("a", "b", "component", "copies", "least", "links", "cell", "usable"):
        frame = frame.withColumn(name, F.lit("kept"))
    assert [(r.n_links, r.component_id) for r in vectors.near_vectors(frame).collect()] == [(1, 1), (1, 1)]


def test_vectors_repeated_rows_and_missing_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (6, [0.0, 1.0], 1)]
    found = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted((r.n_links, r.component_id) for r in found) == [(0, 6), (3, 5), (3, 5), (3, 5), (3, 5)]


def test_trees_prune_nothing_they_need():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 6))
    points = centres[rng.integers(20, size=400)] + rng.normal(0, 0.05, (400, 6))
    points /= np.linalg.norm(points, axis=1)[:, None]
    a, b = points[:250], points[250:]
    i, j = vectors.linked(vectors.Tree(a), vectors.Tree(b), 0.98)
    assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == [tuple(x) for x in np.argwhere(a @ b.T >= 0.98).tolist()]


def test_larger_distances_lose_no_links(spark):
    rng = np.random.default_rng(6)
    values = {int(v) for v in rng.integers(0, 1 << 63, 150, dtype=np.uint64)}
    for v in sorted(values)[:60]:  # one bit of each of five segments: within five, and equal in none of them
        values.add(v ^ sum(1 << int(s + rng.integers(12)) for s in (0, 13, 26, 39, 52)))
        values.add(v ^ sum(1 << int(b) for b in rng.choice(64, 9, replace=False)))
    values = sorted(values)
    array = np.array(values, np.uint64)
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "print long")
    for distance in (5, 9):
        near = np.bitwise_count(array[:, None] ^ array[None]) <= distance
        want = brute_groups(len(values), np.argwhere(np.triu(near, 1)).tolist())
        got = {r.node: r.component for r in components.components(simhash.link_fingerprints(frame, distance)).collect()}
        names = [got.get(int(np.uint64(v).view(np.int64)), i) for i, v in enumerate(values)]
        assert len(set(zip(names, want, strict=True))) == len(set(names)) == len(set(want)) < len(values) - 50
    for distance in (-1, 64):
        with pytest.raises(ValueError):
            simhash.link_fingerprints(frame, distance)
