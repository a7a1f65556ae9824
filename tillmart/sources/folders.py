"""Folders of stored tables: listing, deleting and moving through Spark's file systems.

Only names and sizes pass through the driver, never rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Spark's writers put this file last, so a folder that holds it is complete.
COMPLETE = "_SUCCESS"
#: What Spark's writers call the partition of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _folder(spark, path)
    return system.exists(target)


def complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{COMPLETE}")


def delete(spark: SparkSession, path: str) -> None:
    system, target = _folder(spark, path)
    system.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file or folder; the new name must not exist and its parent is made."""
    system, source = _folder(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    system.mkdirs(target.getParent())
    if system.exists(target) or not system.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names one level below a folder, none where there is no folder."""
    system, target = _folder(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files of a folder that Spark would read."""
    return [n for n in names(spark, path) if not n.startswith(("_", "."))]


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Values of an integer partition column, from folder names one level below, without the missing one."""
    prefix = f"{column}="
    found = (n.removeprefix(prefix) for n in names(spark, path) if n.startswith(prefix))
    return sorted(int(n) for n in found if n != NO_VALUE)


def finished_batches(spark: SparkSession, checkpoint: str) -> int | None:
    """Newest batch that a stream has committed; None without a checkpoint."""
    if not exists(spark, checkpoint):
        return None
    return max((int(n) for n in names(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)
