"""Hourly counts, duplicate-tolerant ingest and alerts as streams that lose no late row.

A batch costs what it brings, however long the history is. What must be known of earlier
batches is keyed state in Spark's state store (which keys have come), or the few rows
that the batch before left in its own folder (running totals, open windows). A replayed
batch starts from the same state and replaces its output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tillmart.functions.numbers import percent
from tillmart.operators.quality import duplicate_alerts
from tillmart.operators.versions import latest_by_key, orderable
from tillmart.sources.folders import partition_values
from tillmart.sources.sinks import read_batch, read_batches, write_batch

_HOURLY = StructType(
    [
        StructField("table", StringType()),
        StructField("time", TimestampNTZType()),
        StructField("records", LongType()),
    ]
)


def hourly_counts(events: DataFrame, table: str, column: str) -> DataFrame:
    """Records per table and hour."""
    hour = F.date_trunc("hour", F.col(column)).cast("timestamp_ntz")
    return events.groupBy(F.col(table).alias("table"), hour.alias("time")).agg(
        F.count(F.lit(1)).alias("records")
    )


def start_hourly_counts(
    events: DataFrame, path: str, checkpoint: str, table: str, column: str,
    once: bool = True, every: str = "30 seconds",
) -> StreamingQuery:
    """Writes each batch's partial counts; read with :func:`read_hourly_counts`."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(hourly_counts(batch, table, column), path, batch_id)

    return _start(events, handle, checkpoint, once, every)


def read_hourly_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts of all batches; a row counts whenever it arrives."""
    return read_batches(spark, path, _HOURLY).groupBy("table", "time").agg(
        F.sum("records").alias("records")
    )


_ROW, _NEW_KEY = 0, 1


def _with_new_keys(events: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """All rows of a stream as (kind, row), and a line of another kind for each key that has not come before.

    The keys, and nothing else, are state; rows whose last key column is missing bring none.
    """
    named = [value.alias(name) for name, value in keys.items()]
    rows = events.select(F.lit(_ROW).alias("kind"), *named, F.struct(*events.columns).alias("row"))
    fresh = events.select(*named).dropna(subset=[*keys][-1:]).dropDuplicates(list(keys))
    return rows.unionByName(fresh.withColumn("kind", F.lit(_NEW_KEY)), allowMissingColumns=True)


def start_unique(
    events: DataFrame, path: str, checkpoint: str, key: str, version: str,
    once: bool = True, every: str = "30 seconds",
) -> StreamingQuery:
    """Stores the first row of every key, however late its repeats come.

    Of the rows of a key that share its first batch the newest version is stored, chosen
    map-side. Which keys have come is state. Rows without a key all stay.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            fresh = kept.where(F.col("kind") == _NEW_KEY).select("_key")
            rows = kept.where(F.col("kind") == _ROW).select("_key", "row.*")
            single = latest_by_key(rows.where("_key is not null"), "_key", version, ties=orderable(events, [version]))
            first = single.join(fresh, "_key", "left_semi")
            write_batch(first.unionByName(rows.where("_key is null")).drop("_key"), path, batch_id)
        finally:
            kept.unpersist()

    return _start(_with_new_keys(events, {"_key": F.col(key)}), handle, checkpoint, once, every)


_TOTALS = StructType(
    [StructField("table", StringType()), StructField("n", LongType()), StructField("keys", LongType())]
)


def start_alerts(
    events: DataFrame, path: str, checkpoint: str, table: str, key: str,
    once: bool = True, every: str = "30 seconds",
) -> StreamingQuery:
    """Evaluates the duplicate alerts after every batch; read with :func:`read_alerts`.

    Running totals, one row for each table: the totals that the batch before left, and
    the rows and new keys of this one. Which keys have come is state.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        brought = batch.groupBy("table").agg(
            F.count_if(F.col("kind") == _ROW).alias("n"), F.count_if(F.col("kind") == _NEW_KEY).alias("keys")
        )
        before = read_batch(spark, f"{path}/totals", _TOTALS, batch_id - 1).drop("batch_id")
        totals = before.unionByName(brought).groupBy("table").agg(F.sum("n").alias("n"), F.sum("keys").alias("keys"))
        write_batch(totals, f"{path}/totals", batch_id)
        totals = read_batch(spark, f"{path}/totals", _TOTALS, batch_id)
        stats = totals.select("table", percent(F.col("n") - F.col("keys"), F.col("n")).alias("duplicate_percent"))
        write_batch(duplicate_alerts(stats), f"{path}/alerts", batch_id)

    lines = _with_new_keys(events.select(table, key), {"table": F.col(table), "key": F.col(key).cast("string")})
    return _start(lines.drop("row"), handle, checkpoint, once, every)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alerts as of the newest batch."""
    last = max(partition_values(spark, f"{path}/totals", "batch_id"), default=-1)
    schema = duplicate_alerts(spark.createDataFrame([], "table string, duplicate_percent double")).schema
    return read_batch(spark, f"{path}/alerts", schema, last).drop("batch_id")


_OPEN = StructType([*_HOURLY.fields, StructField("newest", TimestampNTZType())])


def start_windows(
    events: DataFrame, path: str, checkpoint: str, table: str, column: str, delay: str = "1 hour",
    once: bool = True, every: str = "30 seconds",
) -> StreamingQuery:
    """Hourly counts that become final, with late rows set aside.

    The watermark of a batch is the newest time of all batches before it less ``delay``.
    An hour that ends at or before it is final: its count is written once, below
    ``closed``, and rows that still come for it go as they are to ``late``. Counts of
    hours that may still grow are carried from batch to batch, with the newest time. A
    row whose time is missing belongs to no hour and is late. Closed, open and late rows
    together are all rows.
    """
    lag = F.expr(f"interval '{delay}'")
    hour = F.date_trunc("hour", F.col(column)).cast("timestamp_ntz")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist()
        try:
            before = read_batch(spark, f"{path}/open", _OPEN, batch_id - 1).drop("batch_id")
            reached = before.agg(F.max("newest")).first()[0]
            mark = F.lit(None if reached is None else str(reached)).cast("timestamp_ntz") - lag
            late = F.coalesce(F.col(column).isNull() | (hour + F.expr("interval 1 hour") <= mark), F.col(column).isNull())
            write_batch(kept.where(late), f"{path}/late", batch_id)
            counts = hourly_counts(kept.where(~late), table, column)
            newest = kept.agg(F.max(column).cast("timestamp_ntz").alias("newest"))
            newest = newest.select(F.lit(None).cast("string").alias("table"), F.lit(None).cast("timestamp_ntz").alias("time"),
                                   F.lit(None).cast("bigint").alias("records"), "newest")
            found = before.unionByName(counts, allowMissingColumns=True).unionByName(newest)
            # The line without an hour carries the newest time alone.
            found = found.groupBy("table", "time").agg(F.sum("records").alias("records"), F.max("newest").alias("newest"))
            done = F.coalesce(F.col("time") + F.expr("interval 1 hour") <= mark, F.lit(False))
            write_batch(found.where(~done), f"{path}/open", batch_id)
            write_batch(found.where(done).drop("newest"), f"{path}/closed", batch_id)
        finally:
            kept.unpersist()

    return _start(events, handle, checkpoint, once, every)


def read_closed(spark: SparkSession, path: str) -> DataFrame:
    """Final counts; each hour of a table stands once."""
    return read_batches(spark, f"{path}/closed", _HOURLY).drop("batch_id")


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """Counts that may still grow, as of the newest batch."""
    last = max(partition_values(spark, f"{path}/open", "batch_id"), default=-1)
    return read_batch(spark, f"{path}/open", _OPEN, last).where("records is not null").select(*_HOURLY.names)


def read_late(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows that came after their hour was final."""
    return read_batches(spark, f"{path}/late", schema).drop("batch_id")


def _start(events: DataFrame, handle, checkpoint: str, once: bool, every: str) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()
