"""Latest-version deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, NullType

_RANK = "_version_rank"


def orderable(df: DataFrame, skip: Sequence[str]) -> list[str]:
    """Plain columns, which can break ties."""
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skip and isinstance(f.dataType, AtomicType | NullType)
    ]


def latest_by_key(
    df: DataFrame,
    key: str | Sequence[str],
    version: str | Sequence[str],
    ties: Sequence[str] | None = None,
    within: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key: the highest version, ties broken by ``ties``.

    ``ties`` defaults to every other plain column, which makes the result
    independent of row order. ``within`` keeps one row per key and per extra
    expression, e.g. per month. Spark limits each map-side partition to one row
    per key before the shuffle, so a hot key costs at most one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    versions = [version] if isinstance(version, str) else list(version)
    if ties is None:
        ties = orderable(df, [*keys, *versions])
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (*versions, *ties)]
    window = Window.partitionBy(*keys, *within).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def dedup_by_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per combination of ``columns``, chosen the same way every run."""
    others = orderable(df, list(columns))
    if not others:
        return df.dropDuplicates(list(columns))
    return latest_by_key(df, list(columns), others[0], others[1:])
