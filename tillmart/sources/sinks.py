"""Result and table sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tillmart.operators.envelope import with_month

# Result file prefix, technical columns left out of files, and
# the folder used below an object-store root.
RESULT_PREFIX = "analytic_result"
TECHNICAL = ("customer_sk", "created_at")
EXPORT_FOLDER = "analytics"
FORMATS = ("table", "csv", "json")
MORE_FORMATS = ("jdbc", "export")
#: Of batches at rest: message texts take less than half of what they take by Spark's default.
CODEC = "zstd"
_NO_TABLE = r"not (exist|found)|doesn't exist|no such table|unknown table"


def dated_name(as_of: str | date | datetime, fmt: str, prefix: str = RESULT_PREFIX) -> str:
    day = date.fromisoformat(str(as_of)[:10])
    return f"{prefix}_{day:%Y_%m_%d}.{fmt}"


def write_dated(df: DataFrame, folder: str, as_of, fmt: str, files: int | None = None) -> str:
    """Result without technical columns in a dated CSV or JSON folder.

    Spark writes as many part files as there are partitions, so that no single
    task holds the whole result. ``files`` lowers that number for small results.
    """
    path = f"{folder.rstrip('/')}/{dated_name(as_of, fmt)}"
    rows = df.drop(*TECHNICAL)
    if files is not None:
        rows = rows.coalesce(files)
    writer = rows.write.mode("overwrite").option("encoding", "UTF-8")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown file format {fmt!r}")
    return path


def export_path(root: str, fmt: str, as_of) -> str:
    """Where :func:`write_dated` puts a result below an object-store root."""
    return f"{root.rstrip('/')}/{EXPORT_FOLDER}/{dated_name(as_of, fmt)}"


def export_results(df: DataFrame, root: str, as_of, formats: Sequence[str] = ("csv", "json")) -> dict[str, str]:
    """Writes dated results straight below an object-store root."""
    return write_results(df, as_of, formats, folder=f"{root.rstrip('/')}/{EXPORT_FOLDER}")


def replace_table(df: DataFrame, table: str) -> None:
    """Truncate and refill an existing catalog table; error if it is missing."""
    if not df.sparkSession.catalog.tableExists(table):
        raise RuntimeError(f"table {table} does not exist")
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.mode("overwrite").insertInto(table)


def replace_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Truncate and refill an existing JDBC table; error if it is missing.

    Other failures, such as a refused login, are raised as they are.
    """
    spark = df.sparkSession
    try:
        spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().schema
    except Exception as error:
        if not re.search(_NO_TABLE, str(error), re.IGNORECASE):
            raise
        raise RuntimeError(f"table {table} does not exist") from error
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, truncate="true", **options)
        .mode("overwrite")
        .save()
    )


def write_results(
    df: DataFrame,
    as_of,
    formats: Sequence[str] = FORMATS,
    folder: str | None = None,
    table: str | None = None,
    jdbc: dict[str, str] | None = None,
    export_root: str | None = None,
) -> dict[str, str]:
    """Writes one result to several sinks, computing it once.

    ``jdbc`` holds url, table and connector options of the ``jdbc`` sink;
    ``export`` writes dated CSV and JSON below ``export_root``. A result that the
    caller has persisted stays so.
    """
    unknown = set(formats) - {*FORMATS, *MORE_FORMATS}
    if unknown:
        raise ValueError(f"unknown sinks {sorted(unknown)}")
    held = df.storageLevel.useMemory or df.storageLevel.useDisk
    kept = df if held else df.persist()
    written = {}
    try:
        if "table" in formats:
            replace_table(kept, table)
            written["table"] = table
        if "jdbc" in formats:
            replace_jdbc(kept, **jdbc)
            written["jdbc"] = jdbc["table"]
        if "export" in formats:
            for fmt, path in export_results(kept, export_root, as_of).items():
                written[f"export_{fmt}"] = path
        for fmt in ("csv", "json"):
            if fmt in formats:
                written[fmt] = write_dated(kept, folder, as_of, fmt)
    finally:
        if not held:
            kept.unpersist()
    return written


def save_bucketed(df: DataFrame, table: str, key: Sequence[str], buckets: int) -> None:
    """Catalog table bucketed and sorted by ``key``.

    Two facts bucketed alike on the purchase id join and aggregate on it
    without a shuffle.
    """
    (
        df.repartition(buckets, *key)
        .write.mode("overwrite")
        .bucketBy(buckets, *key)
        .sortBy(*key)
        .saveAsTable(table)
    )


def append_raw(raw: DataFrame, path: str) -> None:
    """Plain append to a raw table partitioned by month."""
    with_month(raw).write.mode("append").partitionBy("event_month").parquet(path)


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replaces a table partitioned by ``partitions``.

    Rebalancing gathers each partition value into few files while AQE splits
    values that are too large for one task.
    """
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_batch(df: DataFrame, path: str, batch_id: int, partitions: Sequence[str] = ()) -> None:
    """Rows of one micro-batch; writing the same batch again replaces them.

    Batches stay for long, so they are packed with ``CODEC``.
    """
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partitions, "batch_id")
        .parquet(path)
    )


def read_folder(spark: SparkSession, path: str, schema: StructType, root: str | None = None) -> DataFrame:
    """The rows below ``path``, none where there is no such folder; partitions are those from ``root`` on."""
    try:
        return spark.read.schema(schema).option("basePath", root or path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _read_or_empty(spark: SparkSession, root: str, path: str, schema: StructType) -> DataFrame:
    return read_folder(spark, path, StructType([*schema.fields]).add("batch_id", LongType()), root)


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All batches below ``path``; an empty frame before the first write."""
    return _read_or_empty(spark, path, path, schema)


def read_batch(
    spark: SparkSession, path: str, schema: StructType, batch_id: int,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """One batch; only its own folders are listed, however long the history."""
    levels = "".join(f"/{p}=*" for p in partitions)
    return _read_or_empty(spark, path, f"{path}{levels}/batch_id={batch_id}", schema)


def write_report(report: DataFrame, path: str) -> None:
    """Small report table as JSON lines."""
    report.write.mode("overwrite").json(path)
