"""Upkeep of the stored streams: merging versions and dropping old rows.

A job that fails anywhere is repeated as it is, and the ingest may have run in between.

Merged versions are a generation of their own, beside the batches, and a generation
counts once its last file is written. Readers take the newest one and the batches after
it, so a batch that is replayed later, which is merged already, is not read again.

Retention rewrites folder by folder, and only folders that hold old rows. The rows that
stay are written aside first, with a list of the files they come from. A folder whose
files are no longer those of the list is left alone; new files are never touched.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tillmart.entities import ENTITIES
from tillmart.functions.moments import fixed_offset_clock, moment
from tillmart.operators.mart import current
from tillmart.sources.folders import (
    data_files,
    delete,
    exists,
    finished_batches,
    move,
    names,
    partition_values,
)
from tillmart.sources.sinks import CODEC
from tillmart.streaming.ingest import DEAD_SCHEMA, Layout, merged_upto, raw_schema, read_versions

#: Spark's readers pass over names that begin like this.
HIDDEN = "_kept-"


def compact_versions(spark: SparkSession, root: str, name: str, as_of) -> int:
    """Merges the versions of a mart target into one row per key; number of batches merged.

    Only batches that the stream has committed are merged, so the ingest need not
    pause. The merged rows carry the number of the newest of them, so later batches
    still win ties.
    """
    layout = Layout(root)
    path, merged = layout.mart(name), layout.merged(name)
    batches = partition_values(spark, path, "batch_id")
    finished = finished_batches(spark, layout.checkpoint)
    last = merged_upto(spark, layout, name)
    fresh = [b for b in batches if (last is None or b > last) and (finished is None or b <= finished)]
    if fresh:
        newest = fresh[-1]
        versions = read_versions(spark, layout, name, as_of).where(F.col("batch_id") <= newest)
        rows = current(name, versions, ("batch_id",)).drop("batch_id")
        rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{merged}/merged_upto={newest}")
        last = newest
    # What the generation covers is read by nobody any more; a failure before this costs only space.
    if last is not None:
        for generation in partition_values(spark, merged, "merged_upto"):
            if generation < last:
                delete(spark, f"{merged}/merged_upto={generation}")
        for batch in batches:
            if batch <= last:
                delete(spark, f"{path}/batch_id={batch}")
    return len(fresh)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path + ".part")
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    move(spark, path + ".part", path)


def _swap(spark: SparkSession, folder: str, listed: Sequence[str]) -> None:
    """Replaces the listed files of a folder by those that wait in it under hidden names."""
    for name in listed:
        if exists(spark, f"{folder}/{name}"):
            delete(spark, f"{folder}/{name}")
    left = data_files(spark, folder)
    for name in names(spark, folder):
        if name.startswith(HIDDEN):
            if all(x.startswith("kept-") for x in left):
                move(spark, f"{folder}/{name}", f"{folder}/{name[1:]}")
            else:  # the batch was written anew, in full
                delete(spark, f"{folder}/{name}")


def _bring(spark: SparkSession, staging: str, batch: int, folder: str) -> None:
    """Moves what is kept of a batch into its folder, still hidden."""
    staged = f"{staging}/rows/batch_id={batch}"
    for name in data_files(spark, staged):
        move(spark, f"{staged}/{name}", f"{folder}/{HIDDEN}{uuid.uuid4().hex}.parquet")


def _finish(spark: SparkSession, staging: str) -> None:
    """Ends the swaps that a failed run has begun, and forgets all it has not begun."""
    if exists(spark, f"{staging}/intent"):
        for row in spark.read.json(f"{staging}/intent").select("batch", "folder", "files").toLocalIterator():
            waiting = any(n.startswith(HIDDEN) for n in names(spark, row.folder))
            present = data_files(spark, row.folder)
            # Without hidden files a folder is untouched, ended, or (nothing to keep) partly deleted.
            if waiting or (present and set(present) < set(row.files)):
                _bring(spark, staging, row.batch, row.folder)
                _swap(spark, row.folder, row.files)
    delete(spark, staging)


def _drop_old(spark: SparkSession, path: str, schema: StructType, staging: str, old: Column, within: str = "") -> None:
    """Rewrites the batch folders below ``path/within`` that hold rows for which ``old`` is true.

    One month's folders of one topic, or those of the dead letters with old rows, pass
    through the driver as names.
    """
    _finish(spark, staging)
    base = f"{path}/{within}".rstrip("/")
    if not exists(spark, base):
        return
    full = StructType([*schema.fields]).add("batch_id", LongType())
    reader = spark.read.schema(full).option("basePath", path)
    touched = reader.parquet(base).where(old).select("batch_id").distinct()
    listed = {}
    for row in touched.toLocalIterator():
        folder = f"{base}/batch_id={row.batch_id}"
        listed[row.batch_id] = (folder, data_files(spark, folder))
    if not listed:
        return
    files = [f"{folder}/{name}" for folder, found in listed.values() for name in found]
    kept = reader.parquet(*files).where(~old)
    month = [n for n in kept.columns if within.startswith(f"{n}=")]
    kept = kept.drop(*month).hint("rebalance", "batch_id")
    kept.write.mode("overwrite").option("compression", CODEC).partitionBy("batch_id").parquet(f"{staging}/rows")
    lines = [json.dumps({"batch": batch, "folder": folder, "files": found}) for batch, (folder, found) in listed.items()]
    _write_text(spark, f"{staging}/intent", "\n".join(lines))
    for batch, (folder, found) in listed.items():
        if data_files(spark, folder) == found:  # else written anew since it was listed
            _bring(spark, staging, batch, folder)
            _swap(spark, folder, found)
    delete(spark, staging)


def apply_retention(
    spark: SparkSession, root: str, as_of, days: int = 180, topics: Sequence[str] = tuple(ENTITIES)
) -> None:
    """Drops raw rows and dead letters older than ``days`` before ``as_of``.

    Older months go as folders, unread. In the month that holds the limit, and among
    the dead letters, only batches that hold old rows are rewritten. A dead letter whose
    time cannot be read stays. The ingest may go on: it writes other folders. Only the
    replay of a batch at the moment its folder is swapped must be kept apart.
    """
    layout = Layout(root)
    limit = moment(as_of) - F.make_dt_interval(F.lit(days))
    edge = spark.range(1).select(F.date_format(limit, "yyyyMM").cast("int")).first()[0]
    for topic in topics:
        path = layout.raw(topic)
        for month in partition_values(spark, path, "event_month"):
            if month < edge:
                delete(spark, f"{path}/event_month={month}")
        old = F.coalesce(F.col("event_time") < limit, F.lit(False))
        _drop_old(spark, path, raw_schema(spark, topic), f"{root}/_upkeep/raw-{topic}", old, f"event_month={edge}")
    old = F.coalesce(fixed_offset_clock(F.col("event_time")) < limit, F.lit(False))
    _drop_old(spark, layout.dead, DEAD_SCHEMA, f"{root}/_upkeep/dead", old)
