"""Connected components of a distributed edge table.

Alternates two star steps until the edges stop changing: every node links its larger
neighbours to its smallest one, then every node links its smaller neighbours and
itself to the smallest. What remains are stars whose centre is the smallest node of
the component. The number of rounds grows with the logarithm of the longest path.

Each round is a map-side reduced minimum and one join, written to the shared folder.
Nothing but the number of changed edges reaches the driver; a node with very many
neighbours is a skewed join key, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """``edges`` has u > v. Links the larger (else the smaller) neighbours of each node to its smallest one."""
    sides = edges if not larger else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = sides.join(least, "u")
    if larger:
        linked = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return linked.filter("u > v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u long, v long) -> (node, component) for every node that has an edge to another one."""
    now = edges.filter("u is not null and v is not null and u <> v")
    now = now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = stored(now, "edges"), None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == before:
            break
        before = state
        now = stored(_star(_star(now, True), False), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    centres = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
