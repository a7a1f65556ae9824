"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.session import fresh_dir

#: A word is a run of characters other than the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back.

    Cuts the lineage: a lost executor costs a re-read and not a recomputation,
    and the planner knows the size of what it reads.
    """
    spark = frame.sparkSession
    path = fresh_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, where a missing one is empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str = "doc_id") -> Column:
    """The fifth of the documents that no model learns from; a missing id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def unused(frame: DataFrame, *names: str) -> list[str]:
    """Column names close to the given ones that the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
