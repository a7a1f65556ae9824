"""Envelope topics: a message log when its connector is installed, or files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "topic STRING, json_data STRING, event_time STRING"
_VALUE = "json_data STRING, event_time STRING"


def log_options(servers: str, topics: Iterable[str], per_batch: int | None = None) -> dict[str, str]:
    """Reader options: several topics, from the earliest offset."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }
    if per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def from_log_records(records: DataFrame) -> DataFrame:
    """Envelopes from ``(topic, value)`` records; a broken value has NULL fields."""
    value = F.from_json(F.col("value").cast("string"), _VALUE)
    return records.select("topic", value.alias("v")).select(
        "topic", "v.json_data", "v.event_time"
    )


def to_log_records(envelopes: DataFrame) -> DataFrame:
    value = F.to_json(F.struct("json_data", "event_time"))
    return envelopes.select("topic", value.alias("value"))


def log_stream(spark: SparkSession, servers: str, topics: Iterable[str],
               per_batch: int | None = None) -> DataFrame:
    options = log_options(servers, topics, per_batch)
    return from_log_records(spark.readStream.format("kafka").options(**options).load())


def log_batch(spark: SparkSession, servers: str, topics: Iterable[str]) -> DataFrame:
    return from_log_records(
        spark.read.format("kafka").options(**log_options(servers, topics)).load()
    )


def file_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Envelopes from a folder of JSON lines, as written by :func:`publish_files`."""
    return (
        spark.readStream.schema(ENVELOPE)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .json(folder)
    )


def publish_files(envelopes: DataFrame, folder: str) -> None:
    """Appends JSON lines, compressed: escaped documents shrink to a small part. One task reads a file."""
    envelopes.write.mode("append").option("compression", "gzip").json(folder)


def publish_log(envelopes: DataFrame, servers: str) -> None:
    (
        to_log_records(envelopes)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )
