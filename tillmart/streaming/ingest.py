"""Continuous ingest: envelopes to raw tables, dead letters and mart versions.

Every batch is written under its own ``batch_id`` partition with dynamic
overwrite. A batch that is replayed after a failure replaces its earlier
output, so at-least-once delivery gives each message exactly one raw row.
Mart targets collect versions; readers take the newest row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tillmart.entities import ENTITIES
from tillmart.operators.envelope import SENT, flatten, open_envelopes, opened_rows, with_month
from tillmart.operators.mart import TARGETS, build_target, current, read_schema
from tillmart.operators.versions import latest_by_key
from tillmart.sources.folders import NO_VALUE, complete, delete, partition_values
from tillmart.sources.messages import ENVELOPE
from tillmart.sources.sinks import read_batch, read_batches, read_folder, write_batch

DEAD_LETTERS = "dead_letters"
DEAD_SCHEMA = StructType(
    [StructField(n, StringType()) for n in ("topic", "json_data", "event_time", "reject_reason")]
)
#: Rejected messages as they wait beside the raw rows.
REFUSED = StructType([StructField(n, StringType()) for n in ("json_data", SENT, "reject_reason")])


@dataclass(frozen=True)
class Layout:
    """Folders of one ingest target."""

    root: str

    def raw(self, topic: str) -> str:
        return f"{self.root}/raw/{topic}"

    def mart(self, target: str) -> str:
        return f"{self.root}/mart/{target}"

    def merged(self, target: str) -> str:
        return f"{self.root}/merged/{target}"

    @property
    def dead(self) -> str:
        return f"{self.root}/{DEAD_LETTERS}"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


_raw_schemas: dict[str, StructType] = {}


def raw_schema(spark: SparkSession, topic: str) -> StructType:
    """Schema of a stored raw table, month column included."""
    if topic not in _raw_schemas:
        entity = ENTITIES[topic]
        opened = open_envelopes(spark.createDataFrame([], ENVELOPE), entity.schema, "1970-01-01")
        _raw_schemas[topic] = with_month(flatten(opened, entity)).schema
    return _raw_schemas[topic]


def read_raw(spark: SparkSession, layout: Layout, topic: str) -> DataFrame:
    """All raw rows; messages without a month wait to become dead letters."""
    return read_batches(spark, layout.raw(topic), raw_schema(spark, topic)).where("event_month is not null")


def read_dead_letters(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_batches(spark, layout.dead, DEAD_SCHEMA)


def merged_upto(spark: SparkSession, layout: Layout, name: str) -> int | None:
    """The newest batch that the newest complete generation of merged versions covers."""
    path = layout.merged(name)
    for newest in reversed(partition_values(spark, path, "merged_upto")):
        if complete(spark, f"{path}/merged_upto={newest}"):
            return newest
    return None


def read_versions(spark: SparkSession, layout: Layout, name: str, as_of) -> DataFrame:
    """All versions of one mart target that count, with their batch.

    These are the newest generation of merged versions and the batches after it.
    """
    source = TARGETS[name].source
    empty = spark.createDataFrame([], raw_schema(spark, source))
    schema = build_target(name, empty, as_of, by_event_time=True).schema
    batches = read_batches(spark, layout.mart(name), schema)
    last = merged_upto(spark, layout, name)
    if last is None:
        return batches
    merged = spark.read.schema(schema).parquet(f"{layout.merged(name)}/merged_upto={last}")
    merged = merged.withColumn("batch_id", F.lit(last).cast("bigint"))
    return merged.unionByName(batches.where(F.col("batch_id") > last))


def read_mart(spark: SparkSession, layout: Layout, name: str, as_of) -> DataFrame:
    """Current rows of one mart target."""
    return current(name, read_versions(spark, layout, name, as_of), ("batch_id",)).drop("batch_id")


def ingest_batch(
    batch: DataFrame, batch_id: int, layout: Layout, received_at, topics: Iterable[str]
) -> None:
    """Writes raw rows and dead letters of one micro-batch; a message is opened once.

    Nothing is kept between the two writes: opened messages are many times the size of
    what they are made of, and would fill the memory or the disks of the executors. The
    rejected ones are written beside the raw rows, where they have no month and so are in
    a folder of their own, and go once they are dead letters. A replay writes them again.
    """
    spark, waiting = batch.sparkSession, []
    dead = batch.where(F.col("topic").isNull() | ~F.col("topic").isin(*topics)).select(
        "topic", "json_data", "event_time", F.lit("unknown topic").alias("reject_reason")
    )
    for topic in topics:
        entity = ENTITIES[topic]
        opened = open_envelopes(batch.where(F.col("topic") == topic), entity.schema, received_at)
        write_batch(opened_rows(opened, entity), layout.raw(topic), batch_id, ("event_month",))
        waiting.append(f"{layout.raw(topic)}/event_month={NO_VALUE}")
        refused = read_folder(spark, f"{waiting[-1]}/batch_id={batch_id}", REFUSED)
        dead = dead.unionByName(refused.select(
            F.lit(topic).alias("topic"), "json_data", F.col(SENT).alias("event_time"), "reject_reason"
        ))
    write_batch(dead, layout.dead, batch_id)
    for folder in waiting:
        delete(spark, folder)


def cascade_batch(
    spark: SparkSession, batch_id: int, layout: Layout, as_of, topics: Iterable[str]
) -> None:
    """Derives the mart versions of one batch from its written raw rows.

    A topic is read once, whatever number of targets it feeds, and only what they need
    of it. What is read waits on disk, not in memory.
    """
    for topic in topics:
        fed = [name for name, target in TARGETS.items() if target.source == topic]
        if not fed:
            continue
        schema = read_schema(topic, raw_schema(spark, topic))
        raw = read_batch(spark, layout.raw(topic), schema, batch_id, ("event_month",))
        raw = raw.where("event_month is not null").drop("batch_id", "event_month").persist(StorageLevel.DISK_ONLY)
        try:
            for name in fed:
                write_batch(build_target(name, raw, as_of, by_event_time=True), layout.mart(name), batch_id)
        finally:
            raw.unpersist()


def start_ingest(
    envelopes: DataFrame,
    layout: Layout,
    as_of: Callable[[int], object] | object,
    topics: Iterable[str] = tuple(ENTITIES),
    once: bool = True,
    with_mart: bool = True,
    every: str = "30 seconds",
) -> StreamingQuery:
    """Starts the ingest stream; ``once`` drains what is there and stops.

    ``as_of`` is a moment, or a function of the batch id. A running stream needs the
    function: a constant would turn every later purchase time into itself.
    """
    if not once and not callable(as_of):
        raise ValueError("a running stream needs as_of as a function of the batch id")
    wanted = tuple(topics)

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = as_of(batch_id) if callable(as_of) else as_of
        ingest_batch(batch, batch_id, layout, now, wanted)
        if with_mart:
            cascade_batch(batch.sparkSession, batch_id, layout, now, wanted)

    writer = (
        envelopes.writeStream.foreachBatch(handle)
        .option("checkpointLocation", layout.checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def upsert_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    key: list[str] | None = None,
    version: str | list[str] | None = None,
    once: bool = True,
    every: str = "30 seconds",
) -> StreamingQuery:
    """Appends each batch as versions below ``path``; read with :func:`newest`.

    With ``key`` and ``version`` only the newest row per key of a batch is stored,
    chosen map-side first, so one often repeated message does not load a single task.
    """
    if (key is None) != (version is None):
        raise ValueError("key and version go together")

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(latest_by_key(batch, key, version) if key else batch, path, batch_id)

    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()


def newest(spark: SparkSession, path: str, schema: StructType, key, version) -> DataFrame:
    """Newest stored version per key; later batches win ties."""
    versions = [version] if isinstance(version, str) else list(version)
    stored = read_batches(spark, path, schema)
    return latest_by_key(stored, key, [*versions, "batch_id"]).drop("batch_id")
