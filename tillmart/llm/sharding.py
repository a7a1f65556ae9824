"""Shards of near-equal bytes by Karmarkar-Karp differencing, groups kept whole.

A group (equal texts) starts as a partial partition of ``shards`` parts, all but one
empty. The two partial partitions with the largest spread are combined, the largest
part of one with the smallest of the other, until one is left. A third of the work of
balancing is thus never undone by a late large group.

Differencing runs inside hashed blocks of about ``GROUPS`` groups, which leaves one
partial partition a block; these are differenced by the same rule, ``FAN`` to a node,
up a tree. What would spoil a block waits for a level where it can be balanced: a group
enters where it is at most a quarter of a part of a node, so the largest enter at the
root. And at each node ``SPARE`` of its blocks enter as single groups, whose small sizes
even out what the larger ones leave: those of up to a block's bytes, with 16 shards. Beyond
that, shards differ by no more than the largest group. A node thus holds a bounded
number of partial partitions, some twenty thousand.

Group sizes are summed per task first, so a group of a third of all rows is one number.
Its rows find their shard by a join that Spark splits when skewed. Slots are counted in
chunks of a shard, so no task holds a shard; the rows of a group larger than a chunk are
dealt to several chunks, however alike they are.

Defined cases: a missing text has no bytes and is a group of its own; every row has a
byte more than its text, so empty texts are spread as well; texts of any length are
taken whole, by their size; repeated rows are rows like any other and stay with their
group; rows that are equal in every column share their slots in no fixed order; a
missing id is an id; an empty table gives no rows; a group larger than a shard's share
makes its shard that large; columns other than the two named are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import stored, text_of

#: Groups of a block, nodes below a node, blocks of a node that enter as single groups, and rows of a chunk.
GROUPS, FAN, SPARE, CHUNK = 1024, 64, 16, 1024


def difference(parts: np.ndarray) -> np.ndarray:
    """[n, k] sizes of n partial partitions -> [n, k] the final part that each of their parts joins."""
    n, k = parts.shape
    order = np.argsort(-parts, axis=1, kind="stable")
    sums = list(np.take_along_axis(parts, order, 1))
    made: list[tuple[int, int, np.ndarray]] = []
    waiting = [(int(s[-1] - s[0]), i) for i, s in enumerate(sums)]
    heapq.heapify(waiting)
    while len(waiting) > 1:
        (_, a), (_, b) = heapq.heappop(waiting), heapq.heappop(waiting)
        joined = sums[a] + sums[b][::-1]
        by_size = np.argsort(-joined, kind="stable")
        sums.append(joined[by_size])
        sums[a] = sums[b] = None
        made.append((a, b, by_size))
        heapq.heappush(waiting, (int(sums[-1][-1] - sums[-1][0]), len(sums) - 1))
    place: list = [None] * len(sums)
    place[-1] = np.arange(k)
    for i in range(len(made) - 1, -1, -1):
        a, b, by_size = made[i]
        parts_of = np.empty(k, np.int64)
        parts_of[by_size] = place[n + i]
        place[a], place[b], place[n + i] = parts_of, parts_of[::-1], None
    final = np.empty((n, k), np.int64)
    np.put_along_axis(final, order, np.stack(place[:n]), 1)
    return final


#: A partial partition by its part: that of a child node, or of a single group (then child is -1).
_ITEM = "node long, child long, a long, b int, c long, part int, bytes long"


def _assign_node(shards: int):
    """The final part, in the node, of every part of the node's partial partitions."""

    def assigned(frame: pd.DataFrame) -> pd.DataFrame:
        single = frame[frame["child"] < 0].sort_values(["bytes", "a", "b", "c"], ascending=False)
        nodes = frame[frame["child"] >= 0]
        children = np.sort(nodes["child"].unique())
        parts = np.zeros((len(single) + len(children), shards), np.int64)
        parts[:len(single), 0] = single["bytes"]
        parts[len(single) + np.searchsorted(children, nodes["child"]), nodes["part"]] = nodes["bytes"]
        final = difference(parts)
        small, large = final[:len(single), 0], final[len(single):]
        return pd.concat([
            single.assign(up=small),
            pd.DataFrame({
                "node": np.repeat(frame["node"].iloc[0], large.size), "child": np.repeat(children, shards), "a": 0, "b": 0, "c": 0,
                "part": np.tile(np.arange(shards), len(children)), "bytes": parts[len(single):].ravel(), "up": large.ravel(),
            }),
        ])

    return assigned


def assign(groups: DataFrame, shards: int) -> DataFrame:
    """(a, b, c, bytes) of distinct groups -> (a, b, c, shard)."""
    count, whole = groups.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    blocks = max(1, -(-count // GROUPS))
    top = 0
    while FAN ** top < blocks:
        top += 1
    # By size: a quarter of a part of a block, and FAN times that on each level above.
    least = max(1.0, whole / blocks / shards / 4)
    by_size = F.when(F.col("bytes") <= least, 0).otherwise(F.ceil(F.log(F.col("bytes") / least) / float(np.log(FAN))))
    # By block: of FAN blocks the first few enter one level up, of FAN * FAN the first few two levels up.
    by_block = sum(((F.col("block") % FAN ** k < min(SPARE, FAN // 2)).cast("int") for k in range(1, top + 1)), F.lit(0))
    items = groups.withColumn("block", F.pmod(F.xxhash64("a", "b", "c"), F.lit(blocks)))
    items = items.withColumn("level", F.least(F.lit(top), F.greatest(by_size, by_block)).cast("int"))
    items = stored(items.select("a", "b", "c", "bytes", "block", "level"), "shard-items")
    placed, below = [], None
    for level in range(top + 1):
        node = F.floor(F.col("block") / FAN ** level).alias("node")
        single = items.filter(F.col("level") == level).select(node, F.lit(-1).cast("long").alias("child"), "a", "b", "c", F.lit(0).alias("part"), "bytes")
        if below is not None:
            parts = below.groupBy("node", "up").agg(F.sum("bytes").alias("bytes"))
            no = [F.lit(0).cast(kind).alias(c) for c, kind in groups.dtypes if c in "abc"]
            single = single.union(parts.select(
                F.floor(F.col("node") / FAN), F.col("node"), *no, F.col("up"), "bytes"))
        below = stored(single.groupBy("node").applyInPandas(_assign_node(shards), f"{_ITEM}, up int"), "shard-nodes")
        placed.append(below)
    # From the root down: what a part of a node becomes.
    result = placed[-1].filter("child < 0").select("a", "b", "c", F.col("up").alias("shard"))
    final = placed[-1].filter("child >= 0").select(F.col("child").alias("at"), F.col("part").alias("of"), F.col("up").alias("shard"))
    for step in reversed(placed[:-1]):
        joined = step.join(final, (F.col("node") == F.col("at")) & (F.col("up") == F.col("of"))).drop("at", "of")
        joined = stored(joined, "shard-map")
        result = result.unionByName(joined.filter("child < 0").select("a", "b", "c", "shard"))
        final = joined.filter("child >= 0").select(F.col("child").alias("at"), F.col("part").alias("of"), "shard")
    return result.select("a", "b", "c", F.col("shard").cast("int").alias("shard"))


def shard_documents(documents: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every document; rows of equal text share a shard."""
    rows = stored(
        documents.select(
            F.col(key).alias("doc_id"), (F.octet_length(text_of(text)) + 1).cast("long").alias("size"),
            F.crc32(text_of(text)).alias("text_crc32"),
            F.xxhash64(text).alias("a"), F.hash(text).alias("b"), F.coalesce(F.crc32(text), F.lit(-1)).alias("c"),
        ),
        "shard-rows",
    )
    groups = stored(rows.groupBy("a", "b", "c").agg(F.sum("size").alias("bytes"), F.count("*").alias("many")), "shard-sizes")
    keyed = assign(groups.drop("many"), shards).join(groups.drop("bytes"), ["a", "b", "c"])
    # Rows of a large group may be equal: a turn that is written once deals them out.
    turn = F.when(F.col("many") > CHUNK, F.pmod(F.monotonically_increasing_id(), F.ceil(F.col("many") / CHUNK))).otherwise(0)
    placed = stored(rows.join(stored(keyed, "shard-keys"), ["a", "b", "c"]).withColumn("turn", turn).drop("many"), "shard-placed")
    chunks = max(1, -(-placed.count() // (shards * CHUNK)))
    chunked = placed.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "size", "a", "turn"), F.lit(chunks)))
    counted = chunked.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")
    counted = stored(counted.select(F.col("shard").alias("in_shard"), F.col("chunk").alias("in_chunk"), before.alias("before")), "shard-slots")
    inside = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "size", "a", "b", "c")) - 1
    slotted = chunked.withColumn("inside", inside)
    slotted = slotted.join(counted, (F.col("shard") == F.col("in_shard")) & (F.col("chunk") == F.col("in_chunk")))
    return slotted.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"))
