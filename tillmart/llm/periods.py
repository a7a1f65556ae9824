"""Periodic runs in the words of a text, found on a Re-Pair grammar.

The most frequent pair of neighbouring symbols becomes a new nonterminal until no pair
occurs twice; the sequence that is left is closed by a balanced tree of nonterminals
that occur once. A run lies in a smallest node of the derivation, and there it crosses
the boundary between the node's two children. So the runs across each nonterminal's one
boundary are all there is to find, once for each nonterminal and not for each place it
derives. They are then moved to every place of it, and of intervals with one period
those inside another go: a run cut off at the edge of a small node is whole in a larger.

Across a boundary, one half of a run is on one side, so a few words next to the
boundary stand again one period further. Those places are the candidate periods; ranks
of word sequences of doubling length say how far each holds, in both directions.

A run has the smallest period q of its words, is not extended by a neighbouring word,
and has at least ``min_length`` words and ``min_periods`` periods.

Defined cases: a missing or empty text, or one of white space only, has no words and no
runs, and its collapsed text is empty; texts of any length are taken whole; equal texts
give equal runs; every row, repeated or with a missing id, has its own result; columns
of the input other than the two named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a result batch.
ROWS = 512


class Nodes:
    """Nodes of a derivation: start, boundary and end of one place, and all places where it starts."""

    def __init__(self) -> None:
        self.start, self.mid, self.end, self.places = [], [], [], []

    def add(self, start: int, mid: int, end: int, places: list[int]) -> None:
        self.start.append(start)
        self.mid.append(mid)
        self.end.append(end)
        self.places.append(places)


def grammar(ids: np.ndarray) -> Nodes:
    """Re-Pair of a sequence of numbers from 0, with the balanced tree above its last sequence."""
    n = len(ids)
    symbol = ids.tolist() + [-1]
    after, before = list(range(1, n + 2)), list(range(-1, n))
    where: dict[tuple[int, int], list[int]] = {}
    codes = ids[:-1].astype(np.int64) * (int(ids.max()) + 1) + ids[1:]
    order = np.argsort(codes, kind="stable")
    cuts = np.flatnonzero(np.diff(codes[order])) + 1
    edges = np.concatenate(([0], cuts, [n - 1]))
    for k in np.flatnonzero(np.diff(edges) > 1).tolist():
        at = order[edges[k]:edges[k + 1]].tolist()
        where[symbol[at[0]], symbol[at[0] + 1]] = at
    waiting = [(-len(at), pair) for pair, at in where.items()]
    heapq.heapify(waiting)
    nodes, fresh = Nodes(), int(ids.max()) + 1
    while waiting:
        _, pair = heapq.heappop(waiting)
        a, b = pair
        live, taken = [], -1
        for p in where[pair]:
            if p != taken and symbol[p] == a and symbol[after[p]] == b:
                live.append(p)
                taken = after[p]
        if len(live) < 2:
            del where[pair]
            continue
        if waiting and len(live) < -waiting[0][0]:  # other replacements took some of them
            where[pair] = live
            heapq.heappush(waiting, (-len(live), pair))
            continue
        del where[pair]
        first = live[0]
        nodes.add(first, after[first], after[after[first]], live)
        for p in live:
            q = after[p]
            symbol[p], symbol[q] = fresh, -1
            after[p] = after[q]
            if after[q] <= n:
                before[after[q]] = p
        found: dict[tuple[int, int], list[int]] = {}
        for p in sorted({*live, *(before[p] for p in live)} - {-1}):
            if after[p] < n:
                found.setdefault((symbol[p], symbol[after[p]]), []).append(p)
        for pair, at in found.items():
            if len(at) > 1:
                where[pair] = at
                heapq.heappush(waiting, (-len(at), pair))
        fresh += 1
    edges = [0]
    while edges[-1] < n:
        edges.append(after[edges[-1]])
    step, last = 1, len(edges) - 1
    while step < last:
        for i in range(0, last - step, 2 * step):
            nodes.add(edges[i], edges[i + step], edges[min(i + 2 * step, last)], [edges[i]])
        step *= 2
    return nodes


def ranks(ids: np.ndarray) -> list[np.ndarray]:
    """At k, a number for the 2**k words from each place on; ends where none of them stands twice."""
    levels = [ids.astype(np.int64)]
    while len(levels[-1]) > (step := 1 << (len(levels) - 1)):
        low = levels[-1]
        pairs = low[:-step] * (int(low.max()) + 1) + low[step:]
        values, numbers = np.unique(pairs, return_inverse=True)
        if len(values) == len(pairs):
            break
        levels.append(numbers)
    return levels


def _ahead(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal words from i and from j > i on."""
    i, j, start = i.copy(), j.copy(), i
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        inside = j < len(rank)
        equal = np.zeros(len(i), bool)
        equal[inside] = rank[i[inside]] == rank[j[inside]]
        i += equal.astype(np.int64) << k
        j += equal.astype(np.int64) << k
    return i - start


def _behind(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal words before i and before j > i."""
    i, j, start = i.copy(), j.copy(), i
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        inside = i >= 1 << k
        equal = np.zeros(len(i), bool)
        equal[inside] = rank[i[inside] - (1 << k)] == rank[j[inside] - (1 << k)]
        i -= equal.astype(np.int64) << k
        j -= equal.astype(np.int64) << k
    return start - i


def _candidates(rank: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into at, place) of the places in [low, high] that have the rank of the place at."""
    order = np.argsort(rank, kind="stable")
    width = len(rank) + 1
    keys = rank[order] * width + order
    first = np.searchsorted(keys, rank[at] * width + np.maximum(low, 0))
    last = np.searchsorted(keys, rank[at] * width + np.minimum(high, width - 1), side="right")
    many = np.maximum(last - first, 0)
    which = np.repeat(np.arange(len(at)), many)
    return which, order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)]


def runs(ids: np.ndarray, min_length: int = 24, min_periods: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers from 0, by start and period."""
    if min_periods < 3:
        raise ValueError("a run has at least three periods")
    if len(ids) < max(min_length, min_periods):
        return []
    # Half of a run is on one side of the boundary; what it holds beyond one period stands twice.
    half = [max(-(-min_length // 2), -(-min_periods * q // 2)) - q for q in range(1, max(min_length, 2) + 1)]
    level = max(min(half), 1).bit_length() - 1
    words = 1 << level
    levels = ranks(ids)
    if len(levels) <= level:  # no words are repeated that a run would repeat
        return []
    nodes = grammar(ids)
    start, mid, end = (np.array(x, np.int64) for x in (nodes.start, nodes.mid, nodes.end))
    node = np.flatnonzero(end - start >= max(min_length, min_periods))
    rank = levels[level]
    found_node, found_i, found_q = [], [], []
    right = node[mid[node] < len(rank)]
    which, place = _candidates(rank, mid[right], mid[right] + 1, mid[right] + (end[right] - mid[right]) * 2 // min_periods)
    found_node.append(right[which])
    found_i.append(mid[right[which]])
    found_q.append(place - mid[right[which]])
    left = node[mid[node] - start[node] >= words]
    foot = mid[left] - words
    which, place = _candidates(rank, foot, foot - (mid[left] - start[left]) * 2 // min_periods, foot - 1)
    found_node.append(left[which])
    found_q.append(foot[which] - place)
    found_i.append(mid[left[which]] - found_q[-1])
    at, i, q = (np.concatenate(x) for x in (found_node, found_i, found_q))
    fits = (i >= start[at]) & (i + q <= end[at])
    at, i, q = at[fits], i[fits], q[fits]
    if not len(at):
        return []
    low = i - np.minimum(_behind(levels, i, i + q), i - start[at])
    high = i + q + np.minimum(_ahead(levels, i, i + q), end[at] - i - q)
    long = high - low >= np.maximum(min_length, min_periods * q)
    at, q, low, high = at[long], q[long], low[long], high[long]
    # Of the periods of one interval the smallest counts.
    order = np.lexsort((q, high, low, at))
    at, q, low, high = at[order], q[order], low[order], high[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
    spans = {
        (period, place + s - start[k], place + e - start[k])
        for k, period, s, e in zip(at[new].tolist(), q[new].tolist(), low[new].tolist(), high[new].tolist(), strict=True)
        for place in nodes.places[k]
    }
    kept, period, reached = [], 0, 0
    for p, s, e in sorted(spans, key=lambda x: (x[0], x[1], -x[2])):
        if p != period:
            period, reached = p, 0
        if e > reached:
            kept.append((int(s), int(e - s), p))
            reached = e
    return sorted(kept, key=lambda x: (x[0], x[2]))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


def periodic_runs(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = 24,
    min_periods: int = 3,
    prepare: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(key, n_words, runs, collapsed), a row for each document.

    ``runs`` holds structs of start (a word number), length and period, by start and then
    period. ``collapsed`` is the text with one period left of each run, its words joined
    by one space. ``prepare`` may change the words of a document before the search.
    """
    out = pa.schema([
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS):
                batch = whole.slice(low, ROWS)
                counts, lists, texts = [], [], []
                for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    # On bytes, split() takes exactly the ASCII white space.
                    words = (value.as_py() or "").encode().split()
                    if prepare is not None:
                        words = prepare(name, words)
                    found = runs(numbered(words), min_length, min_periods)
                    counts.append(len(words))
                    lists.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    texts.append(b" ".join(collapsed(words, found)).decode())
                columns = [batch.column(0), *(pa.array(x, t) for x, t in zip((counts, lists, texts), out.types, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *out.names])

    rows = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spans = "array<struct<start: bigint, length: bigint, period: bigint>>"
    found = rows.mapInArrow(searched, f"id {kind}, n_words long, runs {spans}, collapsed string")
    return found.withColumnRenamed("id", key)
