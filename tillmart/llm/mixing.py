"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies, target / size of
the source. The whole part is certain; the fractional part is rounded in pairs: mass,
measured in the unit of ``size``, moves at random from one document to the other until
one of the two fractions is 0 or 1. Expectations stay, and so does the sum of the
sizes taken, so a source misses its target only by the rounding of one last document.

All documents of a source start with one fraction, so a document can be paired with a
unit of others that share theirs: it becomes 0 or 1 and the unit's common fraction
moves the other way. A source is a tree of hashed blocks, ``FAN`` to a node. From the
root down, the documents that are too large for the levels below, largest first, are
paired with all the rest of their node, so the whole source offsets its largest ones
and a block never holds one that outweighs it; the fraction that is left is that of the
nodes below. In a block each document is paired with the later, smaller ones. What a
block leaves open, as a rule a small document, goes up the same tree, is paired there
document by document as a stream, until one document of each source is left and is
rounded alone. A hot source has more blocks, not larger ones. Randomness is a hash of
the row, so reruns agree, and each level is written to the shared folder.

A document that outweighs all others of its source together cannot be offset: then the
mass of the others goes to it or comes from it as far as it reaches, which keeps the
words taken as near to the target as they can be, and ties the fate of the others.

Defined cases: a missing source is a source of its own, last in order; documents of
size 0 take no mass and are rounded each for itself; sources of size 0 have target 0;
a missing size is 0; texts of any length count as a whole, by their size; rows with equal ids are separate documents, identical rows are
interchangeable; other columns are kept, the result columns replace equal names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.common import stored

#: Rows of a block on the lowest level, and blocks of a node on the levels above.
ROWS, FAN = 256, 64
#: A document stays below a node of which it would be more than this share, as one of so many.
SHARE = 8
TINY = 1e-12


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, size long) -> (source, place, n, source_size, target) of every source.

    Sources in order of code points, a missing one last, take the weights in turn. Targets share the
    whole size by weight and stop at ``most`` times the source's size; the excess is shared again.
    """
    totals = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = stored(totals.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    before, at = {}, 0
    for row in ranged.groupBy("part").count().orderBy("part").toLocalIterator():  # one row per partition
        before[row["part"]] = at
        at += row["count"]
    offset = F.lit(0)
    if before:
        offset = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("part")]
    place = offset + F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int"))
    ranked = stored(
        ranged.withColumn("place", place.cast("long")).withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * most).drop("part"),
        "sources",
    )
    whole = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # the level only rises, and settles once no further source is full
        row = ranked.agg(
            F.sum((F.col("cap") <= F.col("weight") * level).cast("long")),
            F.sum(F.when(F.col("cap") <= F.col("weight") * level, F.col("cap")).otherwise(0)),
            F.sum(F.when(F.col("cap") <= F.col("weight") * level, 0).otherwise(F.col("weight"))),
        ).first()
        if not row[2] or row[0] == full:
            break
        full, level = row[0], (whole - row[1]) / row[2]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(float(level)))
    return ranked.select("source", "place", "n", "source_size", target.alias("target"))


def _uniform(*columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _rounded(rows: pa.RecordBatch, extra: list[int], rest: list[float]) -> pa.RecordBatch:
    arrays = list(rows.columns)
    arrays[rows.schema.get_field_index("_extra")] = pa.array(extra, pa.int64())
    arrays[rows.schema.get_field_index("_p")] = pa.array(rest, pa.float64())
    return pa.RecordBatch.from_arrays(arrays, schema=rows.schema)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).tolist() for c in names]


def _against_rest(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Rounds rows sorted by (_place, _block, size descending), each against the rest of its block.

    Sets _extra, or _p where a block's row stays open. ``_total`` is the size of the block.
    """
    group, p, total = None, 0.0, 0
    for batch in batches:
        places, blocks, ps, sizes, totals, chances, lasts = _numbers(
            batch, "_place", "_block", "_p", "_size", "_total", "_chance", "_last")
        extra, rest = [0] * len(ps), [0.0] * len(ps)
        for i, size in enumerate(sizes):
            if group != (places[i], blocks[i]):
                group, p, total = (places[i], blocks[i]), ps[i], totals[i]
            total -= size
            if size <= 0:
                mine = float(chances[i] < ps[i])
            elif total <= 0 or not TINY < p < 1 - TINY:
                mine = p
            else:
                up, down = min((1 - p) * size, p * total), min(p * size, (1 - p) * total)
                if chances[i] * (up + down) < down:
                    mine, p = p + up / size, p - up / total
                else:
                    mine, p = p - down / size, p + down / total
            if not TINY < mine < 1 - TINY:
                extra[i] = int(mine > 0.5)
            elif last:
                extra[i] = int(lasts[i] < mine)
            else:
                rest[i] = mine
        yield _rounded(batch, extra, rest)


def _pivotal(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Rounds rows sorted by (_place, _block): sets _extra, or _p where a block's last row stays open.

    The open row may come from an earlier batch; then it is held back on its own.
    """
    held: pa.RecordBatch | None = None
    open_p = open_s = 0.0
    open_at, open_group, open_last = None, None, 0.0  # open_at -1: the held row

    for batch in batches:
        places, blocks, ps, sizes, chances, lasts = _numbers(batch, "_place", "_block", "_p", "_size", "_chance", "_last")
        groups = list(zip(places, blocks, strict=True))
        extra, rest = [0] * len(groups), [0.0] * len(groups)
        out = []

        def decide(at: int, more: int, left: float = 0.0, extra=extra, rest=rest, out=out) -> None:
            nonlocal held
            if at >= 0:
                extra[at], rest[at] = more, left
            else:
                out.append(_rounded(held, [more], [left]))
                held = None

        def close() -> None:
            if open_at is not None:
                decide(open_at, int(last and open_last < open_p), 0.0 if last else open_p)  # noqa: B023

        for i, (group, p, size) in enumerate(zip(groups, ps, sizes, strict=True)):
            if p <= TINY:
                continue
            if size <= 0:
                extra[i] = int(chances[i] < p)
                continue
            if open_at is None or group != open_group:
                close()
                open_at, open_group, open_p, open_s, open_last = i, group, p, size, lasts[i]
                continue
            over, back = min(open_p * open_s, (1 - p) * size), min(p * size, (1 - open_p) * open_s)
            if chances[i] * (over + back) < back:
                new, left = p + over / size, open_p - over / open_s
            else:
                new, left = p - back / size, open_p + back / open_s
            if left <= TINY or left >= 1 - TINY:
                decide(open_at, int(left > 0.5))
                open_at = None
                if TINY < new < 1 - TINY:
                    open_at, open_p, open_s, open_last = i, new, size, lasts[i]
                else:
                    extra[i] = int(new > 0.5)
            else:
                extra[i], open_p = int(new > 0.5), left
        stay = np.ones(len(groups), bool)
        if open_at is not None and open_at >= 0:
            stay[open_at] = False
            held, open_at = batch.slice(open_at, 1), -1
        done = _rounded(batch, extra, rest)
        out.append(done if stay.all() else done.filter(pa.array(stay)))
        yield from out
    if held is not None:
        yield _rounded(held, [int(last and open_last < open_p)], [0.0 if last else open_p])


def _nullable(frame: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema.fields])


def _node(level: int, block: str = "_block") -> Column:
    return F.floor(F.col(block) / FAN ** level)


def _from_the_root(rows: DataFrame, top: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Rounds the documents of the levels above the blocks; those, and (place, block, p) of the blocks below."""
    sums = stored(rows.groupBy("_place", "_block", "_level").agg(F.sum("_size").alias("_sum"), F.first("_p").alias("_p")), "mixing-sums")
    large = stored(rows.filter(F.col("_level") > 0), "mixing-large")
    done, fractions = [], sums.groupBy("_place", "_block").agg(F.first("_p").alias("_now"))
    for level in range(top, 0, -1):
        total = sums.filter(F.col("_level") <= level).groupBy("_place", _node(level).alias("_node")).agg(F.sum("_sum").alias("_total"))
        here = large.filter(F.col("_level") == level).withColumnRenamed("_block", "_home")
        here = here.join(fractions.withColumnRenamed("_block", "_home"), ["_place", "_home"]).withColumn("_p", F.col("_now")).drop("_now")
        here = here.withColumn("_node", _node(level, "_home")).join(total, ["_place", "_node"]).withColumnRenamed("_node", "_block")
        here = here.withColumn("_start", F.col("_p"))
        ordered = here.repartition("_place", "_block").sortWithinPartitions("_place", "_block", F.desc("_size"), "_order")
        rounded = stored(ordered.mapInArrow(lambda batches: _against_rest(batches, False), _nullable(here)), "mixing-root")
        mass = F.sum((F.col("_extra") + F.col("_p")) * F.col("_size"))
        below = F.first("_total") - F.sum("_size")
        left = rounded.groupBy("_place", F.col("_block").alias("_node")).agg(
            F.try_divide(F.first("_start") * F.first("_total") - mass, below).alias("_rest"))
        fractions = fractions.withColumn("_node", _node(level)).join(left, ["_place", "_node"], "left").select(
            "_place", "_block", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("_rest", "_now"))), 12).alias("_now"))
        fractions = stored(fractions, "mixing-fractions")
        done.append(rounded.drop("_block", "_start", "_total").withColumnRenamed("_home", "_block"))
    return done, fractions


def mix(
    documents: DataFrame, size: Column, source: str = "source", key: str = "doc_id",
    weights: Sequence[int] = (1, 2, 3), most: int = 3,
) -> DataFrame:
    """Adds size, source_size, target and copies (0 to ``most``) to every document."""
    names = ["size", "source_size", "target", "copies"]
    rows = documents.withColumn("_size", F.coalesce(size, F.lit(0)).cast("long")).drop(*names)
    kept = [c for c in rows.columns if c != "_size"]
    targets = stored(
        source_targets(rows.select(F.col(source).alias("source"), F.col("_size").alias("size")), weights, most), "targets"
    ).withColumnRenamed("source", "_source")
    blocks = max(1, -(-(targets.agg(F.max("n")).first()[0] or 0) // ROWS))  # of the largest source
    top = 0
    while FAN ** top < blocks:
        top += 1
    joined = rows.join(
        targets.select("_source", F.col("place").alias("_place"), F.ceil(F.col("n") / ROWS).alias("_blocks"), "source_size", "target"),
        rows[source].eqNullSafe(targets["_source"]),
    ).drop("_source")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    least = F.greatest(F.col("source_size") / F.col("_blocks") / SHARE, F.lit(1.0))
    above = F.when(F.col("_size") <= least, 0).otherwise(F.ceil(F.log(F.col("_size") / least) / float(np.log(FAN))))
    hashed = [F.col(c) for c in dict.fromkeys((key, source))] + [F.col("_size")]
    level = (
        joined.withColumn("_expected", expected).withColumn("_whole", F.floor("_expected"))
        .withColumn("_p", F.col("_expected") - F.col("_whole")).withColumn("_extra", F.lit(0).cast("long")).drop("_expected")
        .withColumn("_order", F.xxhash64(*hashed)).withColumn("_block", F.pmod(F.xxhash64("_order", F.lit(1)), F.col("_blocks")))
        .withColumn("_level", F.least(above, F.lit(top)).cast("int")).drop("_blocks")
        .withColumn("_chance", _uniform(*hashed, F.lit(2))).withColumn("_last", _uniform(*hashed, F.lit(3)))
    )
    done, opened = [], None
    if top:
        above_blocks, fractions = _from_the_root(level, top)
        level = level.filter(F.col("_level") == 0).join(fractions, ["_place", "_block"]).withColumn("_p", F.col("_now")).drop("_now")
        columns = level.columns
        for part in above_blocks:
            done.append(part.filter(F.col("_p") <= TINY).select(columns))
            rest = part.filter(F.col("_p") > TINY).select(columns)
            opened = rest if opened is None else opened.unionByName(rest)
    columns = level.columns
    dealt = level.repartition("_place", "_block")
    dealt = dealt.withColumn("_total", F.sum("_size").over(Window.partitionBy("_place", "_block")))
    rounds = _against_rest
    while True:
        final = blocks == 1
        sorted_rows = dealt.sortWithinPartitions("_place", "_block", F.desc("_size"), "_order")
        rounded = stored(sorted_rows.mapInArrow(lambda b, f=final, r=rounds: r(b, f), _nullable(dealt)), "mixing").select(columns)
        done.append(rounded.filter(F.col("_p") <= TINY))
        if final:
            break
        blocks = -(-blocks // FAN)
        level = rounded.filter(F.col("_p") > TINY)
        if opened is not None:
            level, opened = level.unionByName(opened), None
        level = level.withColumn("_block", _node(1)).withColumn("_chance", _uniform("_chance", F.lit(4)))
        dealt, rounds = level.repartition("_place", "_block"), _pivotal
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select(
        *kept, F.col("_size").alias("size"), "source_size", "target", (F.col("_whole") + F.col("_extra")).cast("long").alias("copies")
    )


def repeat(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")
