"""Exact search of the highest inner products by multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... segments. With the mean and the deviation of each,

    |q - c|^2 >= sum over segments of m ((mean_q - mean_c)^2 + (dev_q - dev_c)^2)

for segments of m components, and as |q|^2 and |c|^2 are known, the bound on the
distance is one on the inner product, (|q|^2 + |c|^2 - bound) / 2. It tightens from
level to level. In a block, the exact products with some of the candidates give each
query a score that it surely reaches; from coarse to fine, candidates whose bound is
below it go, and the rest get their exact product. While most are left, bounds and
products are taken of all pairs at once, which costs less than of single ones.

The queries are a stated set and meet all rows, in blocks: blocks of queries and blocks
of candidates are dealt to tasks in pairs. A task returns the best of its candidates for
each query, and Spark takes the best of those. Equal vectors are one class before all
this: it is searched once as a query, and as a candidate no more than ``first`` + 1 of
its ids, the smallest, can be in any answer. So many copies of a vector cost nothing.

Defined cases: vectors that are missing, empty, or hold missing or non-finite components
take no part; vectors meet those of the same length only; a query is its own row only,
so a repeated row is found by its twin; ties go to the smaller id, and a missing id is
larger than any; an empty table gives no row. Columns other than the two named are not read. Products are exact
while they fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillmart.llm.common import stored

#: Rows of a block of queries and of candidates, and queries that a task takes at a time.
QUERIES, CANDIDATES, STRIP = 4096, 16384, 128
#: Candidates that give a query its first score, and pairs whose bounds are taken at a time.
SAMPLE, PAIRS = 1024, 1 << 16
#: Slack of the bounds, as a share of the product of both lengths; far above rounding.
SLACK = 1e-9
#: Whole numbers below this are exact as doubles.
EXACT = 2.0 ** 53


def levels_of(width: int) -> list[int]:
    """Numbers of segments, coarse to fine; the finest has segments of two components."""
    return [1 << k for k in range(max(width // 2, 1).bit_length())]


def statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that their inner product bounds that of the rows."""
    edges = np.linspace(0, rows.shape[1], segments + 1).astype(int)
    size = np.diff(edges)
    mean = np.add.reduceat(rows, edges[:-1], axis=1) / size
    apart = rows - np.repeat(mean, size, axis=1)
    deviation = np.sqrt(np.add.reduceat(apart * apart, edges[:-1], axis=1) / size)
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([size, size]))


def _surviving(queries: list[np.ndarray], candidates: list[np.ndarray], least: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs whose bound reaches the query's least score at every level, coarse to fine; None if most do."""
    alive, pairs = None, None
    for q_level, c_level in zip(queries, candidates, strict=True):
        if pairs is None:
            # A level that spares nearly all of a few candidates is not worth a look at all of them.
            few = c_level[::max(1, len(c_level) // SAMPLE)]
            if np.count_nonzero(q_level @ few.T >= least[:, None]) > 0.9 * len(least) * len(few):
                continue
            keep = q_level @ c_level.T >= least[:, None]
            alive = keep if alive is None else alive & keep
            if np.count_nonzero(alive) <= alive.size / 8:
                pairs = np.nonzero(alive)
        else:
            q, c = pairs
            upper = np.concatenate([np.zeros(0)] + [
                np.einsum("ij,ij->i", q_level[q[at:at + PAIRS]], c_level[c[at:at + PAIRS]]) for at in range(0, len(q), PAIRS)])
            pairs = q[upper >= least[q]], c[upper >= least[q]]
    return pairs


def best(queries: np.ndarray, candidates: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's ``first`` candidates by score; ties go to the earlier candidate."""
    rows, others = queries.astype(np.float64), candidates.astype(np.float64)
    levels = levels_of(rows.shape[1])
    of_query, of_candidate = ([statistics(x, s) for s in levels] for x in (rows, others))
    long, longest = np.sqrt((rows * rows).sum(1)), np.sqrt((others * others).sum(1)).max()
    # Whole numbers are multiplied as doubles where that is exact.
    exact = np.abs(rows).max() * np.abs(others).max() * rows.shape[1] < EXACT
    left, right = (rows, others) if exact else (queries, candidates)
    some = right[::max(1, len(right) // SAMPLE)]
    found = []
    for low in range(0, len(rows), STRIP):
        part = slice(low, low + STRIP)
        reach = None
        pairs = None
        if len(some) > first:
            # Every query reaches at least the score of its candidate number ``first`` among some of them.
            reach = np.partition(left[part] @ some.T, -first, axis=1)[:, -first]
            slack = SLACK * (long[part] * longest + 1)
            pairs = _surviving([x[part] for x in of_query], of_candidate, reach - slack)
        if pairs is None:
            score = left[part] @ right.T
            q, c = np.nonzero(score >= reach[:, None]) if reach is not None else np.nonzero(np.ones(score.shape, bool))
            score = score[q, c]
        else:
            q, c = pairs
            score = np.concatenate([np.zeros(0, left.dtype)] + [
                np.einsum("ij,ij->i", left[part][q[at:at + PAIRS]], right[c[at:at + PAIRS]]) for at in range(0, len(q), PAIRS)])
        order = np.lexsort((c, -score, q))
        q, c, score = q[order], c[order], score[order]
        stay = np.arange(len(q)) - np.searchsorted(q, q) < first
        found.append((q[stay] + low, c[stay], score[stay].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _in_pair(first: int):
    def searched(frame: pd.DataFrame) -> pd.DataFrame:
        asked = frame[frame["side"] == 0]
        # Earlier candidates win ties: those with the smaller id.
        others = frame[frame["side"] == 1].sort_values(["least", "node"], na_position="last")
        if not len(asked) or not len(others):
            return pd.DataFrame({"query": [], "candidate": [], "score": []}, dtype=np.int64)
        q, c, score = best(np.stack(asked["vector"].to_numpy()), np.stack(others["vector"].to_numpy()), first)
        return pd.DataFrame({"query": asked["node"].to_numpy()[q], "candidate": others["node"].to_numpy()[c], "score": score})

    return searched


def _pairs(classes: DataFrame) -> DataFrame:
    """Rows of both sides, once for each pair of blocks they are in."""
    sizes = classes.groupBy("width").agg(
        F.greatest(F.ceil(F.count_if("asked") / QUERIES), F.lit(1)).cast("int").alias("q_blocks"),
        F.ceil(F.count("*") / CANDIDATES).cast("int").alias("c_blocks"),
    )
    dealt = classes.join(stored(sizes, "topk-sizes"), "width")

    def block(of: str) -> Column:
        # Equal shares: nodes are numbered in no order.
        return F.pmod(F.xxhash64("node"), F.col(of)).cast("int")

    def all_of(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    sides = [
        dealt.filter("asked").select("width", block("q_blocks").alias("qb"), all_of("c_blocks").alias("cb"), F.lit(0).alias("side"), "node", "least", "vector"),
        dealt.select("width", all_of("q_blocks").alias("qb"), block("c_blocks").alias("cb"), F.lit(1).alias("side"), "node", "least", "vector"),
    ]
    return sides[0].unionByName(sides[1])


def best_products(rows: DataFrame, asked: Column, key: str = "vec_id", vector: str = "vector", first: int = 20) -> DataFrame:
    """(query_id, rank, key, score): the ``first`` rows with the highest products for each row that is asked for.

    ``vector`` holds whole numbers as array<bigint>.
    """
    usable = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull())
    rows = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.coalesce(asked, F.lit(False)).alias("asked")).filter(usable)
    # A number for each row tells repeated rows apart; written once, it stays.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    classes = rows.groupBy("vector").agg(F.max("asked").alias("asked"), F.min("id").alias("least")).select(
        F.monotonically_increasing_id().alias("node"), F.size("vector").alias("width"), "asked", "least", "vector")
    classes = stored(classes, "topk-classes")
    named = stored(rows.join(classes.select("node", "vector"), "vector").select("node", "row", "id", "asked"), "topk-names")
    smallest = Window.partitionBy("node").orderBy(F.asc_nulls_last("id"), "row")
    members = named.withColumn("place", F.row_number().over(smallest)).filter(F.col("place") <= first + 1).select("node", "row", "id")
    members = stored(members, "topk-members")

    pairs = _pairs(classes)
    kinds = "query long, candidate long, score long"
    near = pairs.groupBy("width", "qb", "cb").applyInPandas(_in_pair(first + 1), kinds)
    top = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    found = stored(near, "topk-found").join(members.withColumnRenamed("node", "candidate"), "candidate")
    found = found.withColumn("place", F.row_number().over(top)).filter(F.col("place") <= first + 1)
    found = stored(found.select("query", "place", "row", "id", "score"), "topk-best")

    # Each asked row takes its class's answer without itself.
    queries = named.filter("asked").select(F.col("node").alias("query"), F.col("row").alias("own"), F.col("id").alias("query_id"))
    own = F.coalesce(F.col("own_place"), F.lit(first + 1))
    places = found.select(F.col("query"), F.col("row").alias("own"), F.col("place").alias("own_place"))
    queries = queries.join(places, ["query", "own"], "left")
    answers = queries.join(found, "query").filter((F.col("place") != own) & (F.col("place") - (F.col("place") > own).cast("int") <= first))
    rank = F.col("place") - (F.col("place") > own).cast("int")
    return answers.select("query_id", rank.cast("int").alias("rank"), F.col("id").alias(key), "score")
