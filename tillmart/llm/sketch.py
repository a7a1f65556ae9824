"""Document fingerprints: every shingle hash below a fixed fraction of the hash space.

The sketch of a text is a fixed share of its shingles, so it grows with the text. The
sketch of two texts together is the union of theirs (:func:`merged`), and shared hashes
over the smaller sketch estimate how much of a short text a long one contains.
``likeness`` is shared over all hashes. A short text may have no hash below the fraction;
its least hash, a column of its own that merges as a minimum, then stands for it.

DataFrame functions only. Word hashes are combined to shingle hashes without building
shingle strings. The next document in id order is found inside ranges of ids: each
range also gets a copy of the first document of the following range, so the texts are
shuffled once and no task holds more than a range.

Defined cases: a missing text is an empty one, with an empty fingerprint; texts of any
length are taken whole; a text shorter than a shingle is one shingle; of a text none of
whose hashes is below the fraction the least hash is compared and shown; two empty fingerprints have likeness 1; a single
document is its own next one; a missing id comes before all others, and rows of equal
id are ordered by a hash of their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.llm.common import WORD, stored, text_of

SHINGLE, FRACTION = 5, 0.25
#: Rows of an id range, and the most ranges that are made.
RANGE, RANGES = 1024, 1 << 16


def add_sketch(rows: DataFrame, text: str, column: str, shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """Adds the sorted array of retained hashes, and as ``<column>_least`` the least hash of all."""
    limit = -(1 << 63) + int(fraction * (1 << 64))
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    at = lambda i: [F.get(f"{column}_w", i + k) for k in range(shingle)]
    all_of = F.when(
        F.size(f"{column}_w") >= shingle,
        F.transform(F.sequence(F.lit(0), F.size(f"{column}_w") - shingle), lambda i: F.xxhash64(*at(i))),
    ).when(F.size(f"{column}_w") > 0, F.array(F.xxhash64(f"{column}_w"))).otherwise(F.array().cast("array<bigint>"))
    kept = F.filter(F.col(f"{column}_h"), lambda h: h < limit)
    rows = rows.withColumn(f"{column}_w", words).withColumn(f"{column}_h", all_of).withColumn(f"{column}_k", kept)
    rows = rows.withColumn(column, F.array_sort(F.array_distinct(f"{column}_k"))).withColumn(f"{column}_least", F.array_min(f"{column}_h"))
    return rows.drop(f"{column}_w", f"{column}_h", f"{column}_k")


def merged(a: str, b: str) -> tuple[Column, Column]:
    """Sketch and least hash of two texts together."""
    return F.array_sort(F.array_union(a, b)), F.least(f"{a}_least", f"{b}_least")


def shown(sketch: str) -> Column:
    """What is compared and printed: the sketch, or the least hash where it is empty."""
    least = F.when(F.col(f"{sketch}_least").isNull(), F.col(sketch)).otherwise(F.array(f"{sketch}_least"))
    return F.when(F.size(sketch) > 0, F.col(sketch)).otherwise(least)


def fingerprint(sketch: str) -> Column:
    """The sketch as text: 16 hexadecimal digits a hash, in ascending order."""
    return F.array_join(F.transform(F.col(sketch), lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _shared(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b))


def likeness(a: str, b: str, shared: str) -> Column:
    together = F.size(a) + F.size(b) - F.col(shared)
    return F.when(together == 0, F.lit(1.0)).otherwise(F.col(shared) / together)


def containment(a: str, b: str, shared: str) -> Column:
    """Share of the smaller sketch that the other one has."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller == 0, F.lit(1.0)).otherwise(F.col(shared) / smaller)


def _range_of(key: str, cuts: list[int]) -> Column:
    """How many cuts are at most the key, by halving steps over a constant array."""
    size = len(cuts).bit_length()
    table = F.lit(cuts + [(1 << 63) - 1] * ((1 << size) - len(cuts))) if cuts else None
    if table is None:
        return F.lit(0)
    steps = F.lit([1 << k for k in range(size - 1, -1, -1)])
    found = F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & (F.element_at(table, F.least(at + step, F.lit(1 << size))) <= F.col(key)), at + step).otherwise(at),
    )
    return F.when(F.col(key).isNull(), 0).otherwise(found)


def with_next(
    documents: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame], derived: list[str]
) -> DataFrame:
    """Adds ``next_<column>`` of the next row in ascending order of doc_id; after the last row comes the first.

    ``documents`` has doc_id (an integer) and ``tie``, which orders rows of equal id. ``derive`` adds columns
    to the rows, of which ``derived`` are then taken from the next row too, without moving rows again.
    """
    spark = documents.sparkSession
    count = documents.count()
    ranges = min(max(1, count // RANGE), RANGES)
    cuts: list[int] = []
    if ranges > 1:
        shares = [k / ranges for k in range(1, ranges)]
        found = documents.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * ranges))).first()[0]
        cuts = sorted(set(found or []))
    rows = documents.withColumn("range", _range_of("doc_id", cuts))
    first = rows.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("first")).orderBy("range").collect()  # a row a range
    shifted = [(first[k - 1]["range"], r["first"]["doc_id"], r["first"]["tie"]) for k, r in enumerate(first)]
    heads = spark.createDataFrame(shifted or [(0, None, None)], "head_range int, head_id long, head_tie long")
    heads = stored(heads, "range-heads")  # so that its size is known, and the join does not move the texts
    order = ["after", F.col("doc_id").asc_nulls_first(), "tie"]
    copies = rows.join(
        heads, F.col("doc_id").eqNullSafe(F.col("head_id")) & F.col("tie").eqNullSafe(F.col("head_tie"))
    ).withColumn("range", F.col("head_range")).select(rows.columns).dropDuplicates(["range"])
    both = rows.withColumn("after", F.lit(0)).unionByName(copies.withColumn("after", F.lit(1)))
    window = Window.partitionBy("range").orderBy(*order)
    for c in columns:
        both = both.withColumn(f"next_{c}", F.lead(c).over(window))
    both = derive(both)
    for c in derived:
        both = both.withColumn(f"next_{c}", F.lead(c).over(window))
    return both.filter("after = 0").drop("after", "range")


def fingerprints_with_edits(documents: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness to each other and to the next text.

    In the edited form the last floor(n / 2) code points are replaced by the first as many (or all) of the next document.
    """
    rows = documents.select("doc_id", text_of(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    rows = with_next(rows, ["text"], _with_edit, ["sketch"])
    rows = rows.withColumn("both_edited", _shared("sketch", "edited_sketch")).withColumn("both_next", _shared("sketch", "next_sketch"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("sketch").alias("fingerprint"), fingerprint("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch", "both_edited").alias("near_edited"),
        likeness("sketch", "next_sketch", "both_next").alias("near_next"),
        containment("sketch", "edited_sketch", "both_edited").alias("inside_edited"),
        containment("sketch", "next_sketch", "both_next").alias("inside_next"),
    )


def _with_edit(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("half", F.floor(F.col("n_chars") / 2).cast("int"))
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - F.col("half")),
        F.substring("next_text", F.lit(1), F.col("half"))
    ))
    rows = add_sketch(add_sketch(rows, "text", "pure"), "edited", "edited_pure")
    rows = rows.withColumn("sketch", shown("pure")).withColumn("edited_sketch", shown("edited_pure"))
    return rows.drop("next_text", "pure", "pure_least", "edited_pure", "edited_pure_least")
