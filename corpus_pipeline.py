"""Documents to training tokens in five stages, each written as Parquet and read again.

1. quality: documents whose quality score is below the limit go. As in the scoring
   query, nothing is learned from held-out labels.
2. lines: lines on more than a tenth of their source's distinct texts go, so copies of
   a document do not empty it; ``n_chars`` follows the new text.
3. near duplicates: of each group of documents linked by a similarity of 0.8 or more in
   five-word shingles the document with the smallest id stays.
4. mixing: sources, sized in words, are taken by weights 1, 2, 3, repeating; a document
   taken twice is two rows.
5. tokens: the ids of every whole text.

The first four return the columns of ``documents``. Learning, sampling of copies and
tokens are not SQL, so there is no SQL for the whole; tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import bpe, lines, mixing, near, quality
from tillmart.llm.common import held_out, stored, table
from tillmart.llm.queries import vocabulary_path, words


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accept(quality.score_quality(docs, table(spark, sf_dir, "labels"), held_out()))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = lines.drop_site_lines(docs, distinct=True)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(docs.columns)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(mixing.mix(docs, words()), docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(docs, vocabulary_path())
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_boilerplate),
    ("near-dedup", keep_one_of_near),
    ("mixing", mix_sources),
    ("bpe", to_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage, of all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
