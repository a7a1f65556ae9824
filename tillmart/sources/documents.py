"""JSON document folders and document collections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillmart.entities import ENTITIES
from tillmart.operators.envelope import accepted, open_envelopes, rejected

# A file carries no publish time; the value only keeps the time check quiet.
_NO_TIME = "1970-01-01 00:00:00"


def open_documents(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    """One row per ``*.json`` file: text, parsed ``doc``, ``reject_reason``."""
    try:
        # The text reader copies the Hadoop settings for every file; this one does not.
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
        rows = files.select(F.col("content").cast("string").alias("json_data"),
                            F.col("_metadata.file_path").alias("topic"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = StructType([StructField(n, StringType()) for n in ("json_data", "topic")])
        rows = spark.createDataFrame([], empty)
    envelopes = rows.withColumn("event_time", F.lit("").cast("string"))
    return open_envelopes(envelopes, schema, _NO_TIME)


def read_documents(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    """Usable documents of a folder as nested columns; malformed files are skipped."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    opened = accepted(open_documents(spark, folder, schema))
    return opened.select(*[F.col(f"doc.`{f.name}`").alias(f.name) for f in schema.fields])


def malformed_documents(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    """Path and reason of the files :func:`read_documents` skips."""
    bad = rejected(open_documents(spark, folder, schema))
    return bad.select(F.col("topic").alias("path"), "reject_reason")


def load_documents(
    spark: SparkSession,
    data_dir: str,
    out_dir: str,
    clear_before: bool = True,
    topics: Iterable[str] = tuple(ENTITIES),
) -> DataFrame:
    """Loads each topic folder into a Parquet collection; documents per topic.

    ``clear_before`` replaces the collections, otherwise rows are appended.
    """
    counts = None
    for topic in topics:
        documents = read_documents(spark, f"{data_dir}/{topic}", ENTITIES[topic].schema)
        target = f"{out_dir}/{topic}"
        before = 0
        if not clear_before:
            before = _stored_rows(spark, target)
        # A task reads a few dozen small files; the collection is gathered into large ones.
        documents.hint("rebalance").write.mode("overwrite" if clear_before else "append").parquet(target)
        row = spark.read.schema(documents.schema).parquet(target).agg(
            (F.count(F.lit(1)) - F.lit(before)).alias("documents")
        ).select(F.lit(topic).alias("topic"), "documents")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def _stored_rows(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0


def read_collection(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Full scan of a collection through any installed Spark connector."""
    df = spark.read.format(fmt).options(**options).load()
    if "_id" in df.columns:
        df = df.withColumn("_id", F.col("_id").cast("string"))
    return df
