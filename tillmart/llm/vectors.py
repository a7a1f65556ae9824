"""Embedding near duplicates by dual traversal of cover trees.

On the unit sphere a cosine of at least c is a distance of at most sqrt(2 - 2c), so the
pairs are those of a metric join. Equal vectors are one class before it.

The upper levels live in Spark. The classes of a label are dealt to their nearest
pivot, and each cell is cut into blocks of about ``BLOCK`` classes. A block is a node
with a centre and the largest distance of its members; pairs of blocks that are
further apart than both radii and the threshold allow are pruned, and the rest meet in
one task each. There, a tree with halving radii is built for each block, and the two
trees are walked together: a pair of nodes is pruned by the same bound, or replaced by
the pairs of their children, until single vectors are left, whose cosine is then
taken in double precision. So the result is exact, whatever the pivots are.

Pairs never leave a task: it returns, for each class, how many vectors it is linked to
and a spanning forest. Where vectors have no structure at all, nothing can be pruned
and the work is that of all pairs of a label, in blocks; that is in the nature of an
exact join.

Defined cases: vectors that are missing, empty or zero, or hold missing or non-finite
components, and vectors without a label, link with nothing; so do vectors of different
length; equal vectors link with each other, repeated rows too; each row gets its own
result; a component is named by its smallest id, a missing id only where all are; ties at the
threshold link; an empty table gives no row; columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import stored
from tillmart.llm.components import components
from tillmart.llm.simhash import forest

#: Classes of a block, the most pivots of a label, and the most labels that get pivots.
BLOCK, PIVOTS, PIVOT_LABELS = 1024, 32, 256
#: Slack of the pruning bounds, far above rounding.
SLACK = 1e-6


class Tree:
    """Nested nodes as flat arrays: centre (a row), radius, children. Leaves are single rows."""

    def __init__(self, points: np.ndarray, radius: float = 1.0, least: float = 0.05):
        self.points = points
        self.centre, self.radius, self.children = [], [], []
        self.roots = self._net(np.arange(len(points)), radius, least)

    def _net(self, rows: np.ndarray, radius: float, least: float) -> list[int]:
        """Nodes that cover the rows with balls of the radius; each is covered by half of it below."""
        nodes = []
        while len(rows):
            centre = rows[0]
            apart = distances(self.points[centre:centre + 1], self.points[rows])[0]
            inside = apart <= radius
            inside[0] = True
            members = rows[inside]
            rows = rows[~inside]
            if len(members) == 1:
                nodes.append(self._add(centre, 0.0, []))
            elif radius <= least:
                nodes.append(self._add(centre, max(float(apart[inside].max()), SLACK), [self._add(m, 0.0, []) for m in members]))
            else:
                nodes.append(self._add(centre, max(float(apart[inside].max()), SLACK), self._net(members, radius / 2, least)))
        return nodes

    def _add(self, centre: int, radius: float, children: list[int]) -> int:
        self.centre.append(int(centre))
        self.radius.append(radius)
        self.children.append(children)
        return len(self.centre) - 1


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def linked(first: Tree, second: Tree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i of the first, j of the second tree) whose cosine reaches the threshold."""
    reach = float(np.sqrt(max(2 - 2 * cosine, 0))) + SLACK
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    waiting = [(first.roots, second.roots)]
    while waiting:
        left, right = waiting.pop()
        at, to = np.array([first.centre[n] for n in left]), np.array([second.centre[n] for n in right])
        near_r = np.array([first.radius[n] for n in left])
        far_r = np.array([second.radius[n] for n in right])
        for low in range(0, len(left), 512):
            part = slice(low, low + 512)
            near = distances(first.points[at[part]], second.points[to]) <= reach + near_r[part, None] + far_r[None]
            i, j = np.nonzero(near)
            i += low
            single = (near_r[i] == 0) & (far_r[j] == 0)
            a, b = at[i[single]], to[j[single]]
            dots = np.einsum("ij,ij->i", first.points[a], second.points[b])
            found_i.append(a[dots >= cosine])
            found_j.append(b[dots >= cosine])
            for n, m in zip(i[~single].tolist(), j[~single].tolist(), strict=True):
                waiting.append((first.children[left[n]] or [left[n]], second.children[right[m]] or [right[m]]))
    return np.concatenate(found_i), np.concatenate(found_j)


def _unit(vectors: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in vectors])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _in_pair(cosine: float):
    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        sides = [frame[frame["side"] == s].sort_values("node") for s in (0, 1)]
        alone = not len(sides[1])
        trees = [Tree(_unit(s["embedding"])) for s in sides[: 1 if alone else 2]]
        i, j = linked(trees[0], trees[-1], cosine)
        if alone:
            other = i != j
            i, j = i[other], j[other]
        nodes = [s["node"].to_numpy() for s in sides]
        many = [s["copies"].to_numpy() for s in sides]
        last = 0 if alone else 1
        counts = {0: np.bincount(i, many[last][j], len(nodes[0]))}
        if not alone:
            counts[1] = np.bincount(j, many[0][i], len(nodes[1]))
        root = {}
        if len(i):
            low, high = forest(nodes[0][i], nodes[last][j])
            root = dict(zip(low.tolist(), high.tolist(), strict=True))
        out = [
            pd.DataFrame({"node": nodes[s], "links": counts[s].astype(np.int64), "root": [root.get(n, n) for n in nodes[s].tolist()]})
            for s in counts
        ]
        result = pd.concat(out)
        return result[(result["links"] > 0) | (result["root"] != result["node"])]

    return joined


def _deal(classes: DataFrame, block: int) -> DataFrame:
    """Adds cell and block to every class, by nearest pivot and then by hash."""
    counts = classes.groupBy("label", "width").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("label", "width").orderBy(F.xxhash64("node"), "node"))
    pivots: dict = {}
    if counts.count() <= PIVOT_LABELS:
        ranked = classes.withColumn("rank", rank).filter(F.col("rank") <= PIVOTS)
        chosen = ranked.join(counts.withColumnRenamed("n", "of"), ["label", "width"]).filter(
            F.col("rank") <= F.least(F.lit(PIVOTS), F.ceil(F.col("of") / block)))
        # At most PIVOT_LABELS * PIVOTS vectors.
        for row in chosen.select("label", "width", "embedding").toLocalIterator():
            pivots.setdefault((row["label"], row["width"]), []).append(row["embedding"])
    pivots = {k: _unit(pd.Series(v)) for k, v in pivots.items()}
    sent = classes.sparkSession.sparkContext.broadcast(pivots)

    def celled(frames):
        for frame in frames:
            cell = np.zeros(len(frame), np.int32)
            for key, at in frame.groupby(["label", "width"]).indices.items():
                centres = sent.value.get(key)
                if centres is not None and len(centres) > 1:
                    cell[at] = (_unit(frame["embedding"].iloc[at]) @ centres.T).argmax(1)
            yield frame.assign(cell=cell)

    schema = ", ".join(f"{n} {t}" for n, t in classes.dtypes) + ", cell int"
    dealt = stored(classes.mapInPandas(celled, schema), "vector-cells")
    sizes = dealt.groupBy("label", "width", "cell").agg(F.ceil(F.count("*") / block).alias("parts"))
    sizes = stored(sizes, "vector-cell-sizes")
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))
    return dealt.join(sizes, ["label", "width", "cell"]).withColumn("block", F.xxhash64("label", "width", "cell", part)).drop("parts", "cell")


def _summary(frame: pd.DataFrame) -> pd.DataFrame:
    points = _unit(frame["embedding"])
    centre = points.mean(0)
    radius = np.sqrt(((points - centre) ** 2).sum(1).max())
    return pd.DataFrame({"label": frame["label"].iloc[:1], "width": frame["width"].iloc[:1], "block": frame["block"].iloc[:1],
                         "centre": [centre.tolist()], "radius": [float(radius)]})


def link_classes(classes: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """(node, label, width, copies, embedding) of distinct vectors -> (node, links, root), several rows a node."""
    dealt = stored(_deal(classes, block), "vector-blocks")
    kind = dict(classes.dtypes)["label"]
    nodes = stored(
        dealt.groupBy("block").applyInPandas(_summary, f"label {kind}, width int, block long, centre array<double>, radius double"),
        "vector-nodes",
    )
    a, b = nodes.alias("a"), nodes.alias("b")
    apart = F.sqrt(F.aggregate(F.zip_with("a.centre", "b.centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    reach = float(np.sqrt(max(2 - 2 * cosine, 0))) + SLACK
    meet = a.join(b, (F.col("a.label") == F.col("b.label")) & (F.col("a.width") == F.col("b.width")) & (F.col("a.block") <= F.col("b.block")))
    meet = meet.filter(apart <= F.col("a.radius") + F.col("b.radius") + reach)
    meet = stored(meet.select(F.col("a.block").alias("one"), F.col("b.block").alias("two")), "vector-pairs")
    sides = meet.select("one", "two", F.col("one").alias("block"), F.lit(0).alias("side")).unionByName(
        meet.filter("one <> two").select("one", "two", F.col("two").alias("block"), F.lit(1).alias("side"))
    )
    rows = dealt.select("block", "node", "copies", "embedding").join(sides, "block").drop("block")
    return rows.groupBy("one", "two").applyInPandas(_in_pair(cosine), "node long, links long, root long")


def near_vectors(
    rows: DataFrame, cosine: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = BLOCK
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = rows.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"), F.col(label).alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # A class of equal vectors, told by 128 bits; unusable rows are classes of their own by having none.
    for name, seed in (("a", 1), ("b", 2)):
        rows = rows.withColumn(name, F.when(F.col("usable"), F.xxhash64(F.lit(seed), "label", F.size("embedding"), "embedding")))
    named = stored(rows.select("vec_id", "a", "b"), "vector-names")
    classes = rows.filter("usable").groupBy("a", "b").agg(
        F.first("label").alias("label"), F.first(F.size("embedding")).cast("int").alias("width"),
        F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding"),
    )
    # Written once, the number of a class stays.
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    found = stored(link_classes(classes.drop("a", "b", "least"), cosine, block), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    known = (
        classes.select("node", "a", "b", "least", "copies").join(links, "node", "left").join(joined, "node", "left")
        .select("a", "b", "least", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    )
    known = stored(known, "vector-known")
    ids = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = stored(
        known.join(ids, "component").select(
            F.col("a").alias("of"), F.col("b").alias("of_b"), (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"), "component_id"),
        "vector-results",
    )
    result = named.join(known, (F.col("a") == F.col("of")) & (F.col("b") == F.col("of_b")), "left")
    component = F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
